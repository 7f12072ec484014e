"""Quality scores: ridge regression on random Fourier features of document statistics.

Random cosines approximate a Gaussian kernel over standardised statistics.  Tasks sum their rows' normal
equations, the sums are added in Spark, and one small system is solved.  Raw scores are calibrated by
isotonic regression over bins of fixed width.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import written
from claimloom.llm.labelled import labelled_sample, with_text_columns

COSINES = 192
BANDWIDTH = 4.0
RIDGE = 1.0
SEED = 20
SAMPLE_ROWS = 40_000
ROWS_PER_TASK = 10_000
BIN = 0.002
RAW_RANGE = (-1.0, 2.0)
FAR = 6.0  # standard deviations at which a statistic is cut
THRESHOLD = 0.7

# classes of UTF-8 bytes
LOWER, UPPER, DIGIT, BLANK, BREAK, STOP, SYMBOL, WIDE = range(8)
CLASSES = np.full(256, SYMBOL, dtype=np.int64)
CLASSES[128:] = WIDE
CLASSES[ord("a") : ord("z") + 1] = LOWER
CLASSES[ord("A") : ord("Z") + 1] = UPPER
CLASSES[ord("0") : ord("9") + 1] = DIGIT
CLASSES[[9, 11, 12, 13, 32]] = BLANK
CLASSES[10] = BREAK
CLASSES[[ord(c) for c in ".,;:'\"?-()"]] = STOP
STATISTICS = 15


def statistics(text: str | None) -> np.ndarray:
    """Shape of a text: lengths, repetition, letter cases, punctuation, symbols, lines; null counts as empty."""
    text = text or ""
    found = np.zeros(STATISTICS)
    words = text.split()
    if not words:
        return found
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kinds = np.bincount(CLASSES[raw], minlength=8)
    total, count = len(raw), len(words)
    letters = max(1, kinds[LOWER] + kinds[UPPER])
    seen = Counter(words)
    lines = text.split("\n")
    lone = sum(1 for word in seen if len(word) == 1)
    found[:] = (
        np.log1p(count),
        np.log1p(len(text) / count),
        len(seen) / count,
        max(seen.values()) / count,
        (count / len(seen)) ** 0.5,
        kinds[UPPER] / letters,
        kinds[DIGIT] / total,
        kinds[STOP] / total,
        kinds[SYMBOL] / total,
        kinds[SYMBOL] / count,
        kinds[BREAK] / count,
        kinds[WIDE] / total,
        len(set(lines)) / len(lines),
        lone / len(seen),
        np.log1p(count / len(lines)),
    )
    return found


def all_statistics(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(text) for text in texts]).reshape(len(texts), STATISTICS)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; a place and a value for each pool, both rising."""
    pools: list[list[float]] = []  # sum of weighted values, weight, sum of weighted places
    for x, y, w in zip(at, mean, weight):
        pools.append([y * w, w, x * w])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    table = np.array(pools)
    return table[:, 2] / table[:, 1], table[:, 0] / table[:, 1]


@dataclass
class QualityModel:
    """Everything that scores a text; a few hundred numbers. Without labels every score is ``default``."""

    mean: np.ndarray
    spread: np.ndarray
    places: np.ndarray
    values: np.ndarray
    weights: np.ndarray | None = None
    default: float = 1.0

    def cosines(self, found: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(SEED)
        frequencies = draw.normal(0, 1 / BANDWIDTH, (STATISTICS, COSINES))
        phases = draw.uniform(0, 2 * np.pi, COSINES)
        standard = np.clip((found - self.mean) / self.spread, -FAR, FAR)
        return np.c_[np.sqrt(2 / COSINES) * np.cos(standard @ frequencies + phases), np.ones(len(found))]

    def raw(self, found: np.ndarray) -> np.ndarray:
        return np.clip(self.cosines(found) @ self.weights, *RAW_RANGE)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.default)
        return np.clip(np.interp(self.raw(all_statistics(texts)), self.places, self.values), 0, 1)


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn from at most about ``rows`` labelled documents for which ``learn`` holds."""
    sample = labelled_sample(docs, labels, label, learn, rows)
    found = written(
        with_text_columns(sample, lambda texts: [all_statistics(texts)], {"found": "array<double>"}).select("found", "y"),
        "quality-statistics",
    )
    moments = found.select("y", F.posexplode("found").alias("at", "x")).groupBy("at").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"), F.count("x").alias("n")
    ).orderBy("at").collect()
    if not moments:
        none = np.zeros(STATISTICS)
        return QualityModel(none, none + 1, none, none)
    model = QualityModel(
        np.array([m["mean"] for m in moments]),
        np.array([m["spread"] if m["spread"] > 1e-9 else 1.0 for m in moments]),
        np.zeros(1),
        np.zeros(1),
    )
    tasks = max(1, -(-moments[0]["n"] // ROWS_PER_TASK))

    def equations(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((COSINES + 1, COSINES + 2))
        for frame in frames:
            if len(frame):
                z = model.cosines(np.array(frame["found"].tolist()))
                total += z.T @ np.c_[z, frame["y"].to_numpy()]
        yield pd.DataFrame({"line": range(COSINES + 1), "sums": list(total)})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": frame["line"][:1], "sums": [np.sum(frame["sums"].tolist(), axis=0)]})

    summed = (
        found.coalesce(tasks).mapInPandas(equations, "line int, sums array<double>")
        .groupBy("line").applyInPandas(added, "line int, sums array<double>")
        .orderBy("line").collect()
    )
    system = np.array([line["sums"] for line in summed])
    model.weights = np.linalg.solve(system[:, :-1] + RIDGE * np.eye(COSINES + 1), system[:, -1])

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                raw = model.raw(np.array(frame["found"].tolist()))
                yield pd.DataFrame({"bin": np.rint(raw / BIN).astype(np.int64), "y": frame["y"]})

    bins = (
        found.mapInPandas(binned, "bin long, y double").groupBy("bin")
        .agg(F.avg("y").alias("mean"), F.count("y").alias("n")).orderBy("bin").toPandas()
    )
    model.places, model.values = isotonic(bins["bin"].to_numpy() * BIN, bins["mean"].to_numpy(), bins["n"].to_numpy())
    return model


def with_quality(docs: DataFrame, model: QualityModel, score: str = "score") -> DataFrame:
    """``docs`` (any columns, with ``text``) and their quality score from 0 to 1, of whole texts.

    A null or blank text has all statistics zero and is scored like any other; repeated rows are scored
    alike; an empty table gives no rows.
    """
    return with_text_columns(docs, lambda texts: [model.score(texts)], {score: "double"})
