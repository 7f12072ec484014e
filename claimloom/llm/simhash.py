"""SimHash fingerprints and their links at a small Hamming distance.

A fingerprint is embedded by the number of set bits in each of its 32 two-bit segments.  The Manhattan
distance of two embeddings never exceeds the Hamming distance of the fingerprints, so pairs beyond the
radius there need no look at the bits.  The range join runs on a grid: the segments form ``blocks``
blocks, and two embeddings at distance at most two differ in at most two blocks, so every pair shares a
cell that leaves two blocks out.  Counts are kept in unary (0 as 00, 1 as 01, 2 as 11), so the Manhattan
distance is the number of differing bits of the embeddings.

A cell of more than ``CELL`` fingerprints isn't paired.  Its fingerprints are listed under every value
within one bit of them; fingerprints sharing a value are within two bits, every such pair shares one, and
no value has more than 65 of them.  Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.llm.common import written
from claimloom.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
BITS = 64
SEGMENTS = 32
BLOCKS = 5
CELL = 64
ROWS_AT_ONCE = 1 << 16
LOW_BITS = 0x5555555555555555
TO_LOWER = bytes(i + 32 if ord("A") <= i <= ord("Z") else i for i in range(256))


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included; of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    # bytes.split() cuts at exactly the ASCII blanks 0x20 and 0x09 to 0x0D
    words = (text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = (np.cumsum([len(word) + 1 for word in words]) - 1).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])]
    return np.array(hashes or [xxh64_intdigest(joined, SEED)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Fingerprint as a signed 64-bit integer: bits set in over half of the hashes; zero without any."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    little = hashes.astype("<u8")
    for at in range(0, len(little), ROWS_AT_ONCE):
        rows = little[at : at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, name: str = "fingerprint", make: Callable[[str | None], int] | None = None) -> DataFrame:
    """Columns of ``docs`` but ``text``, and the fingerprint of every whole ``text`` as a long."""
    make = make or (lambda text: majority(shingle_hashes(text)))
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([make(text) for text in batch[len(kept)].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], found], names=[*(f.name for f in kept), name])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{name}` long"])
    return docs.select(*(f.name for f in kept), F.col("text").cast("string")).mapInArrow(run, ddl)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def embedding(fingerprint: Column) -> Column:
    """Set bits of each two-bit segment, in unary."""
    low = F.lit(LOW_BITS)
    shifted = F.shiftrightunsigned(fingerprint, 1)
    any_bit = fingerprint.bitwiseOR(shifted).bitwiseAND(low)
    both_bits = fingerprint.bitwiseAND(shifted).bitwiseAND(low)
    return any_bit.bitwiseOR(F.shiftleft(both_bits, 1))


def distance(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Bits that stay when two of the blocks of segments are left out, for every such two."""
    segment_blocks = np.array_split(np.arange(SEGMENTS), blocks)
    bits = [sum(3 << (2 * int(segment)) for segment in block) for block in segment_blocks]
    everything = (1 << BITS) - 1
    return [_signed(everything & ~(bits[a] | bits[b])) for a, b in combinations(range(blocks), 2)]


def fingerprint_links(fingerprints: DataFrame, scope: str | None = None, blocks: int = BLOCKS) -> DataFrame:
    """``u, v``: links that connect exactly the ``fingerprints`` (distinct longs) within two bits of each other.

    Not every pair is listed, but linked pairs and connected groups agree with all pairs.  With ``scope``
    (a column) only fingerprints of equal scope are linked, and ``scope`` is returned too.
    """
    within = [scope] if scope else []
    cells = fingerprints.select(
        *within, "fp",
        F.explode(F.array(*(
            F.xxhash64(*within, F.lit(at), embedding(F.col("fp")).bitwiseAND(F.lit(mask))) for at, mask in enumerate(block_masks(blocks))
        ))).alias("cell"),
    )
    crowded = written(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL).select("cell"), "crowded")
    few = cells.join(crowded, "cell", "left_anti")
    left, right = few.alias("a"), few.alias("b")
    near = (
        (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (distance(embedding(F.col("a.fp")), embedding(F.col("b.fp"))) <= RADIUS)
        & (distance(F.col("a.fp"), F.col("b.fp")) <= RADIUS)
    )
    for name in within:
        near = near & (F.col(f"a.{name}") == F.col(f"b.{name}"))
    pairs = left.join(right, near).select(*(F.col(f"a.{n}").alias(n) for n in within), F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    many = cells.join(crowded, "cell", "left_semi").select(*within, "fp").distinct()
    around = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(BITS)))
    # at most 65 fingerprints lie within one bit of a value
    balls = many.select(*within, "fp", F.explode(around).alias("value")).groupBy(*within, "value").agg(F.collect_list("fp").alias("fps"))
    stars = balls.filter(F.size("fps") > 1).select(*within, F.explode("fps").alias("u"), F.array_min("fps").alias("v")).filter("u <> v")
    return pairs.union(stars.select(*within, "u", "v")).distinct()


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    ``fingerprint`` is 16 hexadecimal digits.  Rows whose fingerprints differ in at most two bits are linked;
    ``component_id`` is the smallest id reachable over links (null ids are passed over; null if there is no
    other).  A null, empty or blank text has the fingerprint zero and is linked like any other.  Repeated
    rows come out once each; an empty table gives no rows; other columns are ignored.
    """
    found = written(with_fingerprints(docs.select("doc_id", "text")), "fingerprints")
    rooted = _rooted(found.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # a written table on both sides, so that the rows of a very common fingerprint can be split
    named = written(rooted.join(names, "root").select("fp", "component_id"), "named")
    return found.join(named, found["fingerprint"] == named["fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def _rooted(fingerprints: DataFrame) -> DataFrame:
    """``fp, least, root`` of distinct fingerprints ``fp, least``; the root is the same in all of a connected group."""
    distinct = written(fingerprints, "distinct")
    roots = components(fingerprint_links(distinct))
    return written(
        distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted"
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (any columns, with ``doc_id, text``), one of each group of ``near_groups``: that with the smallest id.

    Null ids come last; among equal ids the smaller digest of the text decides; of rows equal in both one stays.
    Null, empty and blank texts are one group.  An empty table gives no rows.
    """
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    found = written(with_fingerprints(rows.select("doc_id", "digest", "text")), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    rooted = _rooted(found.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(place).alias("least")))
    first = rooted.groupBy("root").agg(F.min("least").alias("first")).select(
        F.col("first.doc_id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    times = found.groupBy("doc_id", "digest").count().filter("count > 1")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    kept = rows.drop("text").join(written(first, "first"), same).drop("first_id", "first_digest")
    times = written(times.select(F.col("doc_id").alias("first_id"), F.col("digest").alias("first_digest")), "repeated")
    if times.isEmpty():
        return kept.select("row.*")
    once = kept.join(times, same, "left_semi").withColumn(
        "place", F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.xxhash64(F.to_json("row"))))
    ).filter("place = 1")
    return kept.join(times, same, "left_anti").select("row.*").union(once.select("row.*"))
