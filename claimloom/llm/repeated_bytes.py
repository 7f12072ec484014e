"""Bytes of texts that lie in strings of ``LENGTH`` bytes occurring elsewhere, by prefix doubling on sampled positions.

Ranking every byte position would sort as many rows as there are bytes, round after round.  So positions are
thinned first: a string of ``LENGTH`` bytes is represented by its least ``GRAM`` (the 32 bytes with the least hash
in it, the leftmost of equals).  Equal strings have their least gram at the same place, so only grams that occur
twice can lie in a repeated string.  One *position* stands for all strings with the same least gram: strings
that start ``low`` to ``high`` bytes before it.

1. First rank: the gram.  Positions whose rank is unique are dropped (a bitmap of fixed size first, exact counts
   after it).
2. Positions with equal surroundings (all bytes of all their strings) form a class; a class of two occurrences or more is
   repeated as a whole, and one member stands for it from here on.
3. Reranking: the starts of the remaining positions are divided into nodes of ``STEPS`` starts.  The bytes that all
   strings of a node share grow from round to round (32, then 165, 195 and 200 bytes); the new rank is the pair of
   the old rank and these bytes.  Spark groups the ranks; nodes with a unique rank are dropped, nodes whose whole
   surroundings occur twice are repeated, the others are divided on.  At 200 bytes, past the threshold, a rank
   that isn't unique is a repeated string.

Equal texts have equal spans, so spans are kept by text digest and joined to the documents at the end.  Ranks are 64-bit
hashes; a node is repeated only if both its rank and the hash of its whole surroundings agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from claimloom.llm.common import written

LENGTH = 200
GRAM = 32
WINDOW = LENGTH - GRAM + 1
STEPS = (36, 6, 1)
FILTER_BITS = 1 << 26
BLOCK_BITS = 1 << 15
BYTES_AT_ONCE = 1 << 21
PLACE_BITS = np.uint64(24)

SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("length", LongType())]))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    return values


_BYTES = _mixed((np.arange(256).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """Hash of every run of ``GRAM`` bytes, by doubling."""
    hashes, size, factor = _BYTES[buffer], 1, 0xA0761D6478BD642F
    while size < GRAM:
        hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
        size, factor = size * 2, factor * factor % (1 << 64)
    return _mixed(hashes)


def positions(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``rank, place, low, high``: the least grams of the strings at ``starts`` (ascending) of ``buffer``.

    The strings that start ``low`` to ``high`` bytes before ``place`` have the gram there as their least.
    """
    hashes = _gram_hashes(buffer)
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    least, reach = (hashes & ~mask) | np.arange(len(hashes)).astype(np.uint64), 1
    while 2 * reach <= WINDOW:
        least, reach = np.minimum(least[:-reach], least[reach:]), reach * 2
    least = np.minimum(least[: len(least) - (WINDOW - reach)], least[WINDOW - reach :])
    place = (least[starts] & mask).astype(np.int64)
    begins = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(starts) != 1)])
    first = np.flatnonzero(begins)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    place = place[first]
    return hashes[place], place, place - starts[last], place - starts[first]


def _portions(texts: list[bytes], most: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """``bytes, starts, text, offset``: joined texts, starts of all their strings, and number, begin and offset of each piece.

    A long text is divided into pieces that overlap, so that each of its strings starts in one piece.
    """
    pieces: list[bytes] = []
    origin: list[tuple[int, int, int]] = []
    size = 0

    def joined():
        begins = np.cumsum([0, *(len(piece) for piece in pieces[:-1])])
        starts = np.concatenate([np.arange(begin, begin + len(piece) - LENGTH + 1) for begin, piece in zip(begins, pieces)])
        table = np.array(origin, dtype=np.int64)
        return b"".join(pieces), starts, begins, table

    for number, text in enumerate(texts):
        for begin in range(0, max(0, len(text) - LENGTH + 1), most):
            piece = text[begin : begin + most + LENGTH - 1]
            pieces.append(piece)
            origin.append((number, begin, len(piece)))
            size += len(piece)
            if size >= most:
                yield joined()
                pieces, origin, size = [], [], 0
    if pieces:
        yield joined()


def _texts(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    """Distinct texts of a batch that are long enough, how often each occurs, and their digests."""
    counts: dict[bytes, int] = {}
    for text in batch.column(0).cast(pa.binary()).to_pylist():
        if text is not None and len(text) >= LENGTH:
            counts[text] = counts.get(text, 0) + 1
    return list(counts), np.fromiter(counts.values(), np.int64, len(counts)), [hashlib.md5(text).digest() for text in counts]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _surroundings(buffer: bytes, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of all bytes of all strings of each position, and of how many strings lie on either side."""
    from xxhash import xxh64_intdigest

    sides = zip((place - high).tolist(), (place - low + LENGTH).tolist(), ((high << 8) | low).tolist())
    return np.fromiter((xxh64_intdigest(buffer[begin:end], seed) for begin, end, seed in sides), np.uint64, len(place))


def _set_bits(hashes: DataFrame) -> bytes:
    """Bitmap of a column of longs, filled block by block in tasks; its fixed number of bytes reaches the driver."""
    name = hashes.columns[0]
    bits = hashes.select(F.expr(f"`{name}` & {FILTER_BITS - 1}L").alias("bit")).distinct()
    # at most BLOCK_BITS distinct bits a block
    blocks = bits.groupBy(F.expr(f"bit div {BLOCK_BITS}").alias("block")).agg(F.collect_list((F.col("bit") % BLOCK_BITS).cast("int")).alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in blocks.toLocalIterator():
        part = np.zeros(BLOCK_BITS, np.uint8)
        part[row["bits"]] = 1
        begin = row["block"] * BLOCK_BITS // 8
        bitmap[begin : begin + BLOCK_BITS // 8] = np.packbits(part, bitorder="little")
    return bitmap.tobytes()


def _has_bit(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = hashes & np.uint64(8 * len(bitmap) - 1)
    return (np.frombuffer(bitmap, np.uint8)[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _class_hash(rank: np.ndarray, around: np.ndarray) -> np.ndarray:
    return rank ^ (around >> np.uint64(11))


def _ranked(texts: DataFrame) -> DataFrame:
    """``rank, n``: how often each gram is the least of a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct, counts, _ = _texts(batch)
            for buffer, starts, begins, origin in _portions(distinct, BYTES_AT_ONCE):
                rank, place, _, _ = positions(np.frombuffer(buffer, np.uint8), starts)
                weights = counts[origin[np.searchsorted(begins, place, side="right") - 1, 0]]
                found, inverse = np.unique(rank, return_inverse=True)
                sums = np.bincount(inverse, weights=weights, minlength=len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(found)), pa.array(sums)], names=["rank", "n"])

    return texts.mapInArrow(run, "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n"))


OPEN = "rank long, around long, digest binary, place long, low int, high int, n long"


def _open_positions(texts: DataFrame, bitmap: bytes) -> DataFrame:
    """Positions, of each text once a batch, whose gram has its bit set."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct, counts, digests = _texts(batch)
            for buffer, starts, begins, origin in _portions(distinct, BYTES_AT_ONCE):
                rank, place, low, high = positions(np.frombuffer(buffer, np.uint8), starts)
                kept = np.flatnonzero(_has_bit(shared.value, rank))
                rank, place, low, high = rank[kept], place[kept], low[kept], high[kept]
                around = _surroundings(buffer, place, low, high)
                piece = np.searchsorted(begins, place, side="right") - 1
                number = origin[piece, 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signed(rank)), pa.array(_signed(around)), pa.array(digests, pa.binary()).take(pa.array(number)),
                        pa.array(place - begins[piece] + origin[piece, 1]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                        pa.array(counts[number]),
                    ],
                    names=["rank", "around", "digest", "place", "low", "high", "n"],
                )

    return texts.mapInArrow(run, OPEN)


def _contexts(texts: DataFrame, bitmap: bytes) -> DataFrame:
    """``rank, around, bytes`` of positions whose class has its bit set, each class once a task."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            distinct, _, _ = _texts(batch)
            for buffer, starts, _, _ in _portions(distinct, BYTES_AT_ONCE):
                rank, place, low, high = positions(np.frombuffer(buffer, np.uint8), starts)
                around = _surroundings(buffer, place, low, high)
                classes = _class_hash(rank, around)
                kept = [at for at in np.flatnonzero(_has_bit(shared.value, classes)).tolist() if (one := int(classes[at])) not in sent and not sent.add(one)]
                data = [buffer[place[at] - high[at] : place[at] - low[at] + LENGTH] for at in kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(rank[kept])), pa.array(_signed(around[kept])), pa.array(data, pa.binary())], names=["rank", "around", "bytes"]
                )

    return texts.mapInArrow(run, "rank long, around long, bytes binary")


def _slice(column: str, begin: Column, length: Column) -> Column:
    return F.substring(F.col(column), (begin + 1).cast("int"), length.cast("int"))


def _divided(rows: DataFrame, size: int) -> DataFrame:
    """Nodes of ``size`` starts with new rank and hash of their surroundings; ``low`` and ``high`` bound their starts."""
    nodes = rows.withColumn("node", F.explode(F.sequence(F.expr(f"low div {size}"), F.expr(f"high div {size}"))))
    near = F.col("node") * size
    far = F.least(near + size - 1, F.lit(WINDOW - 1))
    low, high = F.greatest("low", near), F.least("high", far)
    common = _slice("bytes", F.col("top") - near, LENGTH - (far - near))
    whole = _slice("bytes", F.col("top") - high, LENGTH + high - low)
    return nodes.select(
        "class_rank", "around", "n", low.cast("int").alias("low"), high.cast("int").alias("high"),
        F.xxhash64("rank", "node", common).alias("rank"), F.xxhash64(low.cast("int"), high.cast("int"), whole).alias("whole"),
    )


def _reranked(open_rows: DataFrame, contexts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """One round: starts found to be repeated (``class_rank, around, low, high``), and nodes still open."""
    name = f"nodes-{size}"
    nodes = written(_divided(open_rows.join(contexts, ["class_rank", "around"]), size), name)
    classes = nodes.groupBy("rank", "whole").agg(
        F.sum("n").alias("times"), F.count_if(F.col("n") == 1).alias("singles"), F.min(F.struct("class_rank", "around")).alias("member")
    )
    groups = classes.groupBy("rank").agg(
        F.sum("times").alias("all"), F.sum("singles").alias("single"), F.count(F.lit(1)).alias("kinds")
    ).filter("`all` > 1 AND single > 0").select("rank", "kinds")
    known = written(classes.join(groups, "rank"), f"classes-{size}")
    rows = nodes.join(known.select("rank", "whole", "times", "member", "kinds"), ["rank", "whole"])
    found = rows.filter("n = 1 AND times > 1").select("class_rank", "around", "low", "high")
    stands = (F.col("times") == 1) | (F.struct("class_rank", "around") == F.col("member"))
    still = rows.filter((F.col("kinds") > 1) & stands).select(
        "class_rank", "around", F.least("times", F.lit(2)).alias("n"), "low", "high", "rank")
    return found, still


def repeated_starts(texts: DataFrame) -> DataFrame:
    """``digest, first, last``: ranges of starts, by MD5 digest of the text, of strings that also start elsewhere.

    ``texts`` has one column ``text``, whose rows count each.  A range may come out more than once.
    """
    repeated = _ranked(texts).filter("n > 1").select("rank")
    spots = written(_open_positions(texts, _set_bits(repeated)), "positions")
    # a text in several tasks has the same positions in each
    classes = written(
        spots.groupBy("rank", "around").agg(F.sum("n").alias("n"), F.any_value("low").alias("low"), F.any_value("high").alias("high")), "classes"
    )
    mixed = classes.groupBy("rank").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("singles"))
    undecided = written(
        classes.join(mixed.filter("kinds > 1 AND singles > 0").select("rank"), "rank").select(
            F.col("rank").alias("class_rank"), "around", F.least("n", F.lit(2)).alias("n"), "low", "high"
        ), "undecided",
    )
    # as _class_hash
    bits = undecided.select(F.col("class_rank").bitwiseXOR(F.shiftrightunsigned("around", 11)).alias("hash"))
    contexts = _contexts(texts, _set_bits(bits)).withColumnRenamed("rank", "class_rank")
    tops = undecided.select("class_rank", "around", F.col("high").alias("top"))
    contexts = written(
        contexts.join(tops, ["class_rank", "around"]).groupBy("class_rank", "around", "top").agg(F.any_value("bytes").alias("bytes")), "contexts"
    )
    open_rows = undecided.withColumn("rank", F.col("class_rank"))
    parts = []
    for size in STEPS:
        found, open_rows = _reranked(open_rows, contexts, size)
        parts.append(written(found, f"found-{size}"))
    # a class of one occurrence has one text and place
    partly = parts[0]
    for part in parts[1:]:
        partly = partly.unionByName(part)
    whole = classes.filter("n > 1").select(F.col("rank").alias("class_rank"), "around", "low", "high")
    ranges = whole.unionByName(partly)
    at = spots.select(F.col("rank").alias("class_rank"), "around", "digest", "place")
    return at.join(ranges, ["class_rank", "around"]).select(
        "digest", (F.col("place") - F.col("high")).alias("first"), (F.col("place") - F.col("low")).alias("last")
    )


def _covered(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs, as start and end, of bytes that strings starting in ``ranges`` cover."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted((one["first"], one["last"]) for one in ranges):
        if runs and first <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], last + LENGTH)
        else:
            runs.append((first, last + LENGTH))
    return runs


def without_repeats(docs: DataFrame) -> DataFrame:
    """Columns of ``docs``, then ``spans`` (removed bytes of the UTF-8 text, maximal runs) and ``kept`` (the other bytes).

    A null text is empty; texts of fewer than 200 bytes lose nothing.  Repeated rows count as copies of each other and come
    out once each; an empty table gives no rows.  Columns named ``spans`` or ``kept`` are replaced, others are passed on.
    """
    others = [field.name for field in docs.schema.fields if field.name not in ("spans", "kept")]
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in others)).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = repeated_starts(rows.select("text")).groupBy("digest").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    joined = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))).join(found, "digest", "left").select("row", "text", "ranges")
    returned = StructType([joined.schema["row"], StructField("spans", SPANS), StructField("kept", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for text, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                runs = _covered(ranges or [])
                borders = [0, *(border for run in runs for border in run), len(text)]
                spans.append([{"start": a, "length": b - a} for a, b in runs])
                kept.append(b"".join(text[a:b] for a, b in zip(borders[::2], borders[1::2])) if runs else text)
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, span_type), pa.array(kept, pa.binary())], names=["row", "spans", "kept"])

    return joined.mapInArrow(run, returned).select("row.*", "spans", "kept")
