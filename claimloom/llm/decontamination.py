"""Benchmark items in training passages: BM25 retrieval with block-max WAND, then an overlap check.

Test items form an inverted index; a posting's weight is its BM25 contribution divided by the item's score
against itself, so one threshold fits items of any length.  Every text is cut into overlapping passages
that hold any item whole, and each passage is a query that retrieves all items at the threshold.  As in
block-max WAND, items are bounded by the largest weights that a passage's terms have in their block, and
postings are read only where a bound reaches the threshold; the bounds of all passages of a text are
evaluated at once.  A retrieved item counts if enough of its question's and of its answer's word n-grams stand in
the passage.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
BLOCK = 8
ROUNDING = 1e-9
THRESHOLD = 0.5  # of an item's score against itself
NGRAM = 4
QUESTION_OVERLAP = 0.6
ANSWER_OVERLAP = 0.5
LEAST_STRIDE = 64
INDEX_BYTES = 4_000_000  # of item texts in one index
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item's last sentence, and of what comes before; a lone sentence is parted in the middle."""
    sentences = [found for part in SENTENCE.split(text) if (found := WORD.findall(part.lower()))]
    words = [word for sentence in sentences for word in sentence]
    last = len(sentences[-1]) if len(sentences) > 1 else (len(words) + 1) // 2
    return words[: len(words) - last], words[len(words) - last :]


def ngrams(words: list, size: int = NGRAM) -> set[tuple]:
    """Distinct n-grams; of shorter lists the whole."""
    return {tuple(words[at : at + size]) for at in range(max(1, len(words) - size + 1))} if words else set()


def overlap(wanted: set[tuple], words: list, found: set[tuple]) -> float:
    """Share of ``wanted`` n-grams in a passage of ``words`` with n-grams ``found``."""
    if not wanted:
        return 1.0
    size = len(next(iter(wanted)))
    return len(wanted & (found if size == NGRAM else ngrams(words, size))) / len(wanted)


class Lists:
    """For each term a list of places and weights, one after another."""

    def __init__(self, lists: list[list[tuple[int, float]]]):
        self.starts = np.cumsum([0, *map(len, lists)])
        self.places = np.array([place for entries in lists for place, _ in entries], dtype=np.int64)
        self.weights = np.array([weight for entries in lists for _, weight in entries])

    def summed(self, terms: np.ndarray, size: int, rows: np.ndarray | None = None, n_rows: int = 1) -> np.ndarray:
        """Sum of the weights at each of ``size`` places over the lists of ``terms``, for each row of terms."""
        starts = self.starts[terms]
        lengths = self.starts[terms + 1] - starts
        before = np.cumsum(lengths) - lengths
        entries = np.arange(lengths.sum()) + np.repeat(starts - before, lengths)
        places = self.places[entries] + (np.repeat(rows * size, lengths) if n_rows > 1 else 0)
        return np.bincount(places, self.weights[entries], minlength=n_rows * size).reshape(n_rows, size)


def block_most(postings: list[tuple[int, float]]) -> list[tuple[int, float]]:
    """The largest weight of each block of items that a term occurs in."""
    most: dict[int, float] = {}
    for item, weight in postings:
        most[item // BLOCK] = max(most.get(item // BLOCK, 0.0), weight)
    return list(most.items())


class ItemIndex:
    """Inverted index of test items ``(id, text)``; items without a word are left out."""

    def __init__(self, items: list[tuple]):
        parted = [(item, *question_and_answer(text)) for item, text in items if text and WORD.search(text)]
        words = [question + answer for _, question, answer in parted]
        self.ids = [item for item, _, _ in parted]
        held = Counter(word for text in words for word in set(text))
        self.terms = {word: at for at, word in enumerate(sorted(held))}
        coded = lambda text: [self.terms[word] for word in text]
        self.questions = [ngrams(coded(question)) for _, question, _ in parted]
        self.answers = [ngrams(coded(answer)) for _, _, answer in parted]
        self.longest = max(map(len, words), default=0)
        mean = sum(map(len, words)) / max(1, len(words))
        weigh = {word: math.log(1 + (len(words) - n + 0.5) / (n + 0.5)) for word, n in held.items()}
        pairs: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for at, text in enumerate(words):
            norm = K1 * (1 - B + B * len(text) / mean)
            scores = {word: weigh[word] * n * (K1 + 1) / (n + norm) for word, n in Counter(text).items()}
            whole = sum(scores.values())
            for word, score in scores.items():
                pairs[self.terms[word]].append((at, score / whole))
        lists = [pairs[at] for at in range(len(self.terms))]
        self.postings, self.blocks = Lists(lists), Lists(list(map(block_most, lists)))
        self.stride = max(LEAST_STRIDE, self.longest)

    def retrieve(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All items whose share of their own score reaches the threshold for a passage's distinct ``terms``."""
        scores = self.postings.summed(terms, len(self.ids))[0]
        return [(item, float(scores[item])) for item in np.flatnonzero(scores >= THRESHOLD - ROUNDING).tolist()]

    def search(self, text: str | None) -> dict[int, tuple[int, float, float, float]]:
        """By item: place of the best passage's first word, BM25 share, question and answer overlap."""
        words = WORD.findall((text or "").lower())
        best: dict[int, tuple[int, float, float, float]] = {}
        if not words or not self.ids:
            return best
        none = len(self.terms)
        coded = np.fromiter(map(self.terms.get, words, repeat(none)), dtype=np.int64, count=len(words))
        # halves of passages bound each block of items by the largest weights of their distinct terms
        stripe = np.arange(len(coded)) // self.stride
        known = coded < none
        distinct = np.unique(stripe[known] * none + coded[known])
        halves = self.blocks.summed(distinct % none, -(-len(self.ids) // BLOCK), distinct // none, stripe[-1] + 1)
        bounds = halves.copy()
        bounds[:-1] += halves[1:]
        # postings are read only for passages in which some block can reach the threshold
        for at in np.flatnonzero(bounds.max(axis=1) >= THRESHOLD - ROUNDING).tolist():
            passage = coded[at * self.stride : (at + 2) * self.stride]
            terms = np.unique(passage)
            retrieved = self.retrieve(terms[:-1] if terms[-1] == none else terms)
            if not retrieved:
                continue
            passage = passage.tolist()
            grams = ngrams(passage)
            for item, score in retrieved:
                question = overlap(self.questions[item], passage, grams)
                answer = overlap(self.answers[item], passage, grams)
                if question >= QUESTION_OVERLAP and answer >= ANSWER_OVERLAP:
                    row = (at * self.stride, score, question, answer)
                    if item not in best or row[1:] > best[item][1:]:
                        best[item] = row
        return best


def item_indexes(items: DataFrame) -> list[ItemIndex]:
    """Indexes of about ``INDEX_BYTES`` of item texts each, so that each is small enough to send with tasks."""
    known = items.select("item_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // INDEX_BYTES))
    dealt = known.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    return [
        ItemIndex([(row["item_id"], row["text"]) for row in dealt.filter(F.col("_part") == part).orderBy("item_id", "text").collect()])
        for part in range(parts)
    ]


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, passage_start, score, question_overlap, answer_overlap``: items found in documents.

    One row for each row of ``docs`` (``doc_id, text``) and each of ``items`` (``item_id, text``) found in its
    whole text.  Null, empty and wordless texts and items find nothing; null ids are kept; repeated items are found
    under each of their rows; an empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fields = [("doc_id", pa.int64()), ("item_id", pa.int64()), ("passage_start", pa.int64())]
    fields += [(name, pa.float64()) for name in ("score", "question_overlap", "answer_overlap")]
    result = None
    for index in item_indexes(items):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc, index.ids[item], *row)
                    for doc, text in zip(batch[0].to_pylist(), batch[1].to_pylist())
                    for item, row in sorted(index.search(text).items())
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

        found = source.mapInArrow(
            run, "doc_id long, item_id long, passage_start long, score double, question_overlap double, answer_overlap double"
        )
        result = found if result is None else result.union(found)
    return result


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` (any columns, with ``text``) in which no item is found."""
    kept = docs
    for index in item_indexes(items):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not index.search(text) for text in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, kept.schema)
    return kept
