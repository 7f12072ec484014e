"""Log-probabilities of texts under a probabilistic suffix tree of words.

The tree's states are contexts of no, one or two words.  A context is kept if its own next-word
distribution predicts the training text better than its parent's: the leave-one-out log-likelihood ratio
of the two, summed over all its occurrences in whole steps of 1/1024 nat, must exceed ``KEEP``; such sums are the
same in any order, so no score depends on how texts are dealt to chunks.  Next-word distributions are smoothed
towards the parent's with one of two weights, whichever does better in that test; the root leaves half a
count of every known word to unknown ones.  A word is scored in the state of the longest kept suffix of
its history.

Texts are encoded once into chunks, written as a table bucketed by chunk, so that later steps bring what
a chunk needs to it without moving the chunk again.  Counts are gathered by exchange: each chunk sends its
distinct n-gram keys with its own training counts, split by key range, as sorted differences; the owner of
a range adds them up and returns totals in the order asked for.  Keys of one range are distinct within a
chunk, so no word, however frequent, makes a range large.  Keys of words have 64 bits; those of longer
n-grams have about 20 bits more than the number of tokens needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import starmap

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import written
from claimloom.llm.simhash import TO_LOWER

CHUNK_TOKENS = 2_000_000
KEYS_PER_RANGE = 2_000_000
SPARE_KEY_BITS = 20
WORD, PAIR, TRIPLE, AFTER_WORD, AFTER_PAIR = range(5)
LEAST_CONTEXT = 4  # occurrences of a context that is tested
KEEP = 2.0  # nats
GAIN_STEPS = 1024  # in one nat
WEIGHTS = ((1.0, 0.0), (1.0, 1.0))  # weight of the parent: constant, and per occurrence of the context
MIX_1, MIX_2, MIX_3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
END = b"\n"  # no word holds a line break
LOCAL_BITS = 33
BYTE_FULL = 255
SHORT_FULL = -32768


# ---- chunks


def encode_chunks(docs: DataFrame) -> DataFrame:
    """Chunks of whole documents (``doc_id, held_out, text``): sorted word hashes, and word places in text order."""
    schema = pa.schema([
        ("chunk", pa.int64()), ("tokens", pa.int64()), ("trained", pa.int64()),
        *((name, pa.binary()) for name in ("doc_ids", "no_id", "held", "lengths", "words", "places")),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        base = TaskContext.get().partitionId() << LOCAL_BITS
        seen: dict[bytes, int] = {}
        ids, held, parts, lengths = [], [], [], []
        tokens = number = 0

        def chunk() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxh64_intdigest, seen), dtype=np.uint64, count=len(seen))
            words, first = np.unique(hashes, return_inverse=True)  # equal hashes count as one word
            places = first.astype(np.uint32)[np.concatenate(parts)]
            trained = sum(n for n, h in zip(lengths, held) if not h)
            none = np.array([doc is None for doc in ids])
            values = (
                base + number, tokens, trained, np.array([doc or 0 for doc in ids], dtype=np.int64).tobytes(), none.tobytes(),
                np.array(held, dtype=bool).tobytes(), np.array(lengths, dtype=np.int64).tobytes(), words.tobytes(), places.tobytes(),
            )
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for doc, out, text in zip(*(column.to_pylist() for column in batch.columns)):
                split = (text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER).split()
                split.append(END)
                parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in split), dtype=np.int32, count=len(split)))
                ids.append(doc)
                held.append(out)
                lengths.append(len(split))
                tokens += len(split)
                if tokens >= CHUNK_TOKENS:
                    yield chunk()
                    seen, ids, held, parts, lengths = {}, [], [], [], []
                    tokens, number = 0, number + 1
        if ids:
            yield chunk()

    source = docs.select(F.col("doc_id").cast("long"), F.col("held_out").cast("boolean"), F.col("text").cast("string"))
    made = source.mapInArrow(
        run, "chunk long, tokens long, trained long, doc_ids binary, no_id binary, held binary, lengths binary, words binary, places binary"
    )
    spark = docs.sparkSession
    name = f"llm_chunks_{uuid.uuid4().hex[:12]}"
    buckets = max(1, 2 * source.rdd.getNumPartitions())
    made.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "chunk").saveAsTable(name)
    return spark.table(name)


class Chunk:
    """Keys of a chunk's n-grams, the same at every step."""

    def __init__(self, row, key_bits: int):
        self.number = int(row["chunk"])
        self.words = np.frombuffer(row["words"], dtype=np.uint64)
        # places are kept in 32 bits, as a worker's memory is some ten numbers a token
        self.at = np.frombuffer(row["places"], dtype=np.uint32).view(np.int32)
        self.lengths = np.frombuffer(row["lengths"], dtype=np.int64)
        self.held = np.frombuffer(row["held"], dtype=bool)
        self.trains = np.repeat(~self.held, self.lengths)
        shift = np.uint64(64 - key_bits)
        starts = np.cumsum(self.lengths) - self.lengths
        first, second = np.zeros(len(self.at), dtype=bool), np.zeros(len(self.at), dtype=bool)
        first[starts] = True
        second[starts[self.lengths > 1] + 1] = True
        self.has_one = np.flatnonzero(~first).astype(np.int32)
        self.has_two = np.flatnonzero(~(first | second)).astype(np.int32)
        hashes = self.words[self.at]
        pair = np.zeros(len(self.at), dtype=np.uint64)
        pair[self.has_one] = _mixed(hashes[self.has_one - 1], hashes[self.has_one])
        triple = _mixed(pair[self.has_two - 1], hashes[self.has_two])
        del hashes
        triple >>= shift
        self.triples, self.triple_at = _distinct(triple)
        del triple
        pair >>= shift
        self.pairs, self.pair_at = _distinct(pair[self.has_one])
        # place of the pair that ends at each token
        self.pair_of = np.full(len(self.at), -1, dtype=np.int32)
        self.pair_of[self.has_one] = self.pair_at

    def keys(self) -> dict[int, np.ndarray]:
        return {WORD: self.words, PAIR: self.pairs, TRIPLE: self.triples}

    def training_counts(self) -> dict[int, np.ndarray]:
        def count(at: np.ndarray, tokens: np.ndarray, size: int) -> np.ndarray:
            return np.bincount(at[self.trains[tokens]], minlength=size)

        every = np.arange(len(self.at))
        return {
            WORD: count(self.at, every, len(self.words)),
            PAIR: count(self.pair_at, self.has_one, len(self.pairs)),
            TRIPLE: count(self.triple_at, self.has_two, len(self.triples)),
        }


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two, in order."""
    x, y = left * MIX_1, right + MIX_3
    y *= MIX_2
    x ^= y
    np.right_shift(x, np.uint64(29), out=y)
    x ^= y
    x *= MIX_1
    np.right_shift(x, np.uint64(32), out=y)
    x ^= y
    return x


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the place of each key among them: ``np.unique`` in about half the memory."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    distinct = ordered[new]
    del ordered
    places = np.cumsum(new, dtype=np.int32)
    places -= 1
    at = np.empty(len(keys), dtype=np.int32)
    at[order] = places
    return distinct, at


# ---- exchange of keyed sums


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and differences of the least number of bytes that holds them all."""
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    return keys[:1].tobytes() + bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked_keys(blob: bytes) -> np.ndarray:
    width = blob[8]
    raw = np.frombuffer(blob, dtype=np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(raw) + 1, 8), dtype=np.uint8)
    steps[1:, :width] = raw
    steps = steps.view(np.uint64).ravel()
    steps[0] = np.frombuffer(blob, dtype=np.uint64, count=1)[0]
    return np.cumsum(steps, dtype=np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    """One byte each, and four more for large ones."""
    small = np.minimum(counts, BYTE_FULL).astype(np.uint8)
    return small.tobytes() + counts[small == BYTE_FULL].astype("<u4").tobytes()


def _unpacked_counts(blob: bytes, size: int) -> np.ndarray:
    counts = np.frombuffer(blob, dtype=np.uint8, count=size).astype(np.int64)
    counts[counts == BYTE_FULL] = np.frombuffer(blob, dtype="<u4", offset=size)
    return counts


def _packed_sums(sums: np.ndarray, parts: list[slice]) -> list[bytes]:
    """Whole numbers of each part in two bytes each, and eight more for large ones."""
    large = np.abs(sums) >= -SHORT_FULL
    short = np.where(large, SHORT_FULL, sums).astype("<i2")
    return [short[part].tobytes() + sums[part][large[part]].astype("<i8").tobytes() for part in parts]


def _unpacked_sums(blob: bytes, size: int) -> np.ndarray:
    sums = np.frombuffer(blob, dtype="<i2", count=size).astype(np.int64)
    sums[sums == SHORT_FULL] = np.frombuffer(blob, dtype="<i8", offset=2 * size)
    return sums


@dataclass(frozen=True)
class Ranges:
    """Key ranges of one exchange: a power of two, by a key's upper bits."""

    range_bits: int
    key_bits: int

    def split(self, kind: int, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        bits = 64 if kind in (WORD, AFTER_WORD) else self.key_bits
        bounds = np.searchsorted(keys, np.arange(1, 1 << self.range_bits, dtype=np.uint64) << np.uint64(bits - self.range_bits))
        for number, (a, b) in enumerate(zip([0, *bounds], [*bounds, len(keys)])):
            if b > a:
                yield number, slice(int(a), int(b))


def _count_requests(chunk: Chunk, ranges: Ranges) -> list[tuple]:
    counts = chunk.training_counts()
    return [
        (kind, number, chunk.number, _packed_keys(keys[part]), _packed_counts(counts[kind][part]))
        for kind, keys in chunk.keys().items() for number, part in ranges.split(kind, keys)
    ]


def _added_counts(frame: pd.DataFrame) -> pd.DataFrame:
    """Totals of one range for every chunk that asked, and once the number of distinct training keys."""
    keys = list(map(_unpacked_keys, frame["keys"]))
    counts = np.concatenate(list(starmap(_unpacked_counts, zip(frame["sums"], map(len, keys)))))
    _, at = _distinct(np.concatenate(keys))
    totals = np.bincount(at, counts).astype(np.int64)
    ends = np.cumsum(list(map(len, keys)))
    replies = [_packed_counts(totals[at[end - len(k) : end]]) for k, end in zip(keys, ends)]
    seen = np.zeros(len(frame), dtype=np.int64)
    seen[0] = (totals > 0).sum()
    return pd.DataFrame({"kind": frame["kind"], "number": frame["number"], "chunk": frame["chunk"], "sums": replies, "seen": seen})


def _added_gains(frame: pd.DataFrame) -> pd.DataFrame:
    """Which contexts of one range are kept, and with which weight: 0 for none, else the weight's place from 1."""
    keys = list(map(_unpacked_keys, frame["keys"]))
    gains = np.concatenate([_unpacked_sums(blob, len(k) * len(WEIGHTS)) for blob, k in zip(frame["sums"], keys)]).reshape(-1, len(WEIGHTS))
    _, at = _distinct(np.concatenate(keys))
    totals = np.stack([np.bincount(at, gains[:, k]) for k in range(len(WEIGHTS))], axis=1)
    chosen = np.where(totals.max(axis=1) > KEEP * GAIN_STEPS, totals.argmax(axis=1) + 1, 0).astype(np.uint8)
    ends = np.cumsum(list(map(len, keys)))
    replies = [chosen[at[end - len(k) : end]].tobytes() for k, end in zip(keys, ends)]
    return pd.DataFrame({"kind": frame["kind"], "number": frame["number"], "chunk": frame["chunk"], "sums": replies, "seen": 0})


REQUEST = "kind int, number int, chunk long, keys binary, sums binary"
REPLY = "kind int, number int, chunk long, sums binary, seen long"


def _table(rows: list[tuple]) -> pd.DataFrame:
    kinds, numbers, chunks, keys, sums = zip(*rows) if rows else ((),) * 5
    frame = pd.DataFrame({"kind": kinds, "number": numbers, "chunk": chunks, "keys": keys, "sums": sums})
    return frame.astype({"kind": "int32", "number": "int32", "chunk": "int64"})


# ---- the model, as one chunk sees it


@dataclass(frozen=True)
class Corpus:
    """Training tokens and distinct training words."""

    tokens: int
    words: int

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def root(self, count: np.ndarray) -> np.ndarray:
        """Probability of a word at the root, by its training count; unknown words are one symbol."""
        if not self.tokens:
            return np.ones(len(count))
        return np.where(count > 0, count - 0.5, 0.5 * self.words) / self.tokens


def _smoothed(count: np.ndarray, context: np.ndarray, parent: np.ndarray, weight: tuple[float, float]) -> np.ndarray:
    mass = weight[0] + weight[1] * context
    return (count + mass * parent) / (context + mass)


class View:
    """A chunk with the totals of its n-grams."""

    def __init__(self, chunk: Chunk, replies: pd.DataFrame, corpus: Corpus, ranges: Ranges):
        self.chunk, self.corpus, self.ranges = chunk, corpus, ranges
        self.replies = {kind: group.sort_values("number")["sums"].tolist() for kind, group in replies.groupby("kind")}
        self.words, self.pairs, self.triples = (self._totals(kind, keys) for kind, keys in chunk.keys().items())
        # which words and pairs are tested contexts of this chunk
        self.tested = {AFTER_WORD: self._tested(self.words, self._one_at()), AFTER_PAIR: self._tested(self.pairs, self._two_at())}

    def _one_at(self) -> np.ndarray:
        """Place of the word before each token that has one."""
        return self.chunk.at[self.chunk.has_one - 1]

    def _two_at(self) -> np.ndarray:
        """Place of the pair before each token that has two words before it."""
        return self.chunk.pair_of[self.chunk.has_two - 1]

    @staticmethod
    def _tested(totals: np.ndarray, at: np.ndarray) -> np.ndarray:
        used = np.zeros(len(totals), dtype=bool)
        used[at] = True
        return np.flatnonzero(used & (totals >= LEAST_CONTEXT))

    def _levels(self) -> Iterator[tuple]:
        """Contexts of one word, then of two: kind, their places, counts of n-gram and context, and tokens; one level in memory."""
        chunk = self.chunk
        at = self._one_at()
        yield AFTER_WORD, at, self.pairs[chunk.pair_at], self.words[at], chunk.has_one
        at = self._two_at()
        yield AFTER_PAIR, at, self.triples[chunk.triple_at], self.pairs[at], chunk.has_two

    def _totals(self, kind: int, keys: np.ndarray) -> np.ndarray:
        blobs = self.replies.get(kind, [])
        sizes = [part.stop - part.start for _, part in self.ranges.split(kind, keys)]
        return np.concatenate([_unpacked_counts(b, n) for b, n in zip(blobs, sizes)]) if blobs else np.zeros(0, np.int64)

    def gains(self) -> list[tuple]:
        """Requests that add up each tested context's leave-one-out gain over its parent."""
        chunk = self.chunk
        # what the shorter context says of each token
        below = self.corpus.root(self.words[chunk.at] - chunk.trains)
        rows = []
        for kind, at, count, context, tokens in self._levels():
            tested, keys = self.tested[kind], chunk.words if kind == AFTER_WORD else chunk.pairs
            if len(tested):
                use = chunk.trains[tokens] & (context >= LEAST_CONTEXT)
                number = np.zeros(len(keys), dtype=np.int32)
                number[tested] = np.arange(len(tested), dtype=np.int32)
                place = number[at[use]]
                n, seen, base = count[use] - 1, context[use] - 1, below[tokens[use]]
                sums = np.empty((len(tested), len(WEIGHTS)))
                for k, weight in enumerate(WEIGHTS):
                    gain = _smoothed(n, seen, base, weight)
                    gain /= base
                    np.log(gain, out=gain)
                    gain *= GAIN_STEPS
                    sums[:, k] = np.bincount(place, np.rint(gain, out=gain), len(tested))
                del use, place, n, seen, base, gain
                wanted = keys[tested]
                numbers, parts = zip(*self.ranges.split(kind, wanted))
                rows += [
                    (kind, number, chunk.number, _packed_keys(wanted[part]), packed)
                    for number, part, packed in zip(numbers, parts, _packed_sums(sums, parts))
                ]
            if kind == AFTER_WORD:
                below[tokens] = _smoothed(count - 1, context - 1, below[tokens], WEIGHTS[-1])
            del at, count, context
        return rows

    def _chosen(self, kind: int, contexts: int, at: np.ndarray) -> np.ndarray:
        chosen = np.zeros(contexts, dtype=np.uint8)
        if blobs := self.replies.get(kind):
            chosen[self.tested[kind]] = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        return chosen[at]

    def scores(self, doc_ids: bytes, no_id: bytes) -> pd.DataFrame:
        """Scores of the chunk's documents."""
        chunk = self.chunk
        word_n = self.words[chunk.at]
        probability = self.corpus.root(word_n)
        in_context = np.zeros(len(chunk.at), dtype=bool)
        for kind, at, count, context, tokens in self._levels():
            chosen = self._chosen(kind, len(chunk.words) if kind == AFTER_WORD else len(chunk.pairs), at)
            for place, weight in enumerate(WEIGHTS, start=1):
                use = chosen == place
                tok = tokens[use]
                probability[tok] = _smoothed(count[use], context[use], probability[tok], weight)
                in_context[tok] = True
            del at, count, context
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        add = lambda values: np.add.reduceat(values, starts)  # noqa: E731  (every document has its end token)
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(np.frombuffer(doc_ids, dtype=np.int64).copy(), np.frombuffer(no_id, dtype=bool).copy()),
            "held_out": chunk.held,
            "n_tokens": chunk.lengths,
            "n_known": add((word_n > 0).astype(np.int64)),
            "train_tokens": self.corpus.tokens,
            "base_score": add(self.corpus.base(word_n)),
            "score": add(np.log10(probability)),
            "n_in_context": add(in_context.astype(np.int64)),
        })


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_in_context long"
)


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id, held_out, text``) under a tree learned from those not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score`` (add-half unigrams), ``score``
    (log10 probability under the tree) and ``n_in_context`` (tokens scored below the root).  Words are runs of
    non-blanks with A-Z lower-cased; every text ends with an end token, so a null or empty text has one token.
    Null ids and repeated rows are kept; an empty table gives no rows; without training rows all
    probabilities are one; other columns are ignored.
    """
    chunks = encode_chunks(docs)
    total, trained = chunks.agg(F.sum("tokens"), F.sum("trained")).first()
    total, trained = total or 0, trained or 0
    range_bits = max(0, (-(-total // KEYS_PER_RANGE) - 1).bit_length())
    ranges = Ranges(range_bits, min(64, SPARE_KEY_BITS + max(1, total).bit_length()))
    needed = ["chunk", "held", "lengths", "words", "places"]

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                frame = _table(_count_requests(Chunk(row, ranges.key_bits), ranges))
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    asked = chunks.select(*needed).mapInArrow(requests, REQUEST)
    totals = written(asked.groupBy("kind", "number").applyInPandas(_added_counts, REPLY), "totals")
    words = totals.filter(F.col("kind") == WORD).agg(F.sum("seen")).first()[0] or 0
    corpus = Corpus(trained, words)

    def view(left: pd.DataFrame, right: pd.DataFrame) -> View:
        return View(Chunk(left.iloc[0], ranges.key_bits), right, corpus, ranges)

    def gains(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _table(view(left, right).gains() if len(left) else [])

    def scores(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return view(left, right).scores(left.iloc[0]["doc_ids"], left.iloc[0]["no_id"])

    tested = chunks.select(*needed).groupBy("chunk").cogroup(totals.drop("seen").groupBy("chunk")).applyInPandas(gains, REQUEST)
    kept = written(tested.groupBy("kind", "number").applyInPandas(_added_gains, REPLY), "kept")
    replies = totals.union(kept).drop("seen")
    return chunks.select(*needed, "doc_ids", "no_id").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(scores, SCORES)
