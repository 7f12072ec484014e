"""Language identification by rank-order profiles.

A profile is the ``PROFILE`` most frequent letter n-grams (one to three letters, word ends marked by a
space) of a language, in order.  A text is given the language whose profile has the smallest out-of-place
distance: the sum, over the text's own most frequent n-grams, of how far each lies from its place there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 300
UNDETERMINED = "und"
SPACE = 32
COMBINE_AT = 1_000_000
CODE_BITS = 21  # of a code point


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a text's n-grams; both empty if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.r_[SPACE, np.where(is_letter, points, SPACE), SPACE]
    gap = points == SPACE
    points = points[~np.r_[False, gap[1:] & gap[:-1]]]
    gap = points == SPACE
    pairs = points[:-1] << CODE_BITS | points[1:]
    triples = pairs[:-1] << CODE_BITS | points[2:]
    return np.unique(np.concatenate([points[~gap], pairs, triples[~gap[1:-1]]]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes in order, ties to the smaller code."""
    if len(codes) > 4 * size:
        least = np.partition(counts, -size)[-size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """``lang, place, code``: the profile of every language of ``docs`` (``text``, ``lang``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def combined() -> pa.RecordBatch:
            langs, codes, counts = [], [], []
            for lang, parts in held.items():
                all_codes = np.concatenate([c for c, _ in parts])
                distinct, place = np.unique(all_codes, return_inverse=True)
                langs += [lang] * len(distinct)
                codes.append(distinct)
                counts.append(np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.concatenate(codes)), pa.array(np.concatenate(counts))],
                names=["lang", "code", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                codes, counts = gram_counts(text)
                if len(codes):
                    held.setdefault(lang, []).append((codes, counts))
                    waiting += len(codes)
                if waiting >= COMBINE_AT:
                    yield combined()
                    waiting = 0
        if held:
            yield combined()

    known = docs.select(F.col("lang").cast("string"), F.col("text").cast("string")).filter("lang is not null and text is not null")
    totals = known.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return totals.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size).select("lang", "place", "code")


class Profiles:
    """Places of the n-grams of all languages as one matrix."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.codes = np.unique(np.array([code for _, _, code in rows], dtype=np.int64))
        # languages by n-grams; absent n-grams and the last column lie `size` places off
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int64)
        column = {lang: at for at, lang in enumerate(self.langs)}
        for lang, place, code in rows:
            self.places[np.searchsorted(self.codes, code), column[lang]] = place - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and a score: how much farther the second language lies, from 0 to 1."""
        codes, counts = gram_counts(text)
        if not len(codes) or not self.langs:
            return UNDETERMINED, 0.0
        own = ranked(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at = np.where(self.codes[at] == own, at, len(self.codes))
        places = self.places[at]
        away = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None])).sum(axis=0)
        order = np.argsort(away, kind="stable")
        first = away[order[0]]
        second = away[order[1]] if len(order) > 1 else self.size * len(own)
        return self.langs[order[0]], float((second - first) / second) if second else 0.0


def identify_languages(docs: DataFrame, profiles: DataFrame, size: int = PROFILE) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``lang_pred`` and ``score``, for every whole ``text``.

    A text that is null or has no letter is ``und`` with score 0, as is everything when no language was
    learned.  Ties go to the language that sorts first.  Profiles hold at most ``size`` rows a language
    and are sent with the tasks.
    """
    model = Profiles([tuple(row) for row in profiles.select("lang", "place", "code").collect()], size)
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(text) for text in batch[len(kept)].to_pylist()]
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[f.name for f in kept] + ["lang_pred", "score"],
            )

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double"])
    return docs.select(*(f.name for f in kept), F.col("text").cast("string")).mapInArrow(run, ddl)
