"""Shards of equal bytes by a k-d tree over document metadata.

Every text has a place along three dimensions that depend on the text alone, so equal texts share it:
bytes per character, size (logarithm), and a hash.  Nodes are split along the dimension in which they are
widest (share of the whole table's range), at a weighted quantile, until every leaf is one shard.  The
quantile comes from histograms of ``STEP_BITS`` bits of an ordering key at a time, summed in Spark, so a
split needs no sort and nothing that grows with the data reaches the driver.

Groups of equal texts that weigh more than ``HEAVY`` of a shard are dealt first, largest to emptiest shard,
and the tree fills what room they leave; there are at most ``shards / HEAVY`` of them.  Only a group larger than a
shard is divided.  All other groups stay whole, at the cost of ``HEAVY`` of a shard a split at most.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import written

SHARDS = 8
HEAVY = 0.005
STEP_BITS = 13
STEPS = 4
PLACE_BITS = 20
CRC_BITS = 32
ROW_BITS = 33  # of monotonically_increasing_id
DIMENSIONS = ("per_char", "magnitude", "spread")


@dataclass
class Node:
    """Leaves ``first`` to ``last`` of the tree; inner nodes split at ``key`` of ``dimension``."""

    first: int
    last: int
    quota: list[float]
    dimension: str = ""
    key: int = -1
    children: list[Node] = field(default_factory=list)

    @property
    def share(self) -> float:
        """Part of the node's bytes that its left half is to get."""
        middle = (self.first + self.last + 1) // 2
        whole = sum(self.quota[self.first : self.last + 1])
        return sum(self.quota[self.first : middle]) / whole if whole > 0 else 0.5


def measured(docs: DataFrame) -> DataFrame:
    """One narrow row for each document, with a row number that is kept by writing it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.octet_length(text) / F.greatest(F.char_length(text), F.lit(1))).alias("per_char"),
        F.log2(F.octet_length(text) + F.lit(1.0)).alias("magnitude"),
        F.monotonically_increasing_id().alias("row"),
    )
    return written(rows.withColumn("spread", F.hash("text_crc32", "size") / F.lit(float(1 << 32)) + 0.5), "measured")


def _ordering_key(dimension: str, low: float, high: float) -> Column:
    """Place along a dimension, then the text's checksum: equal texts have equal keys."""
    scale = ((1 << PLACE_BITS) - 1) / (high - low) if high > low else 0.0
    place = F.floor((F.col(dimension) - F.lit(low)) * F.lit(scale)).cast("long")
    return F.shiftleft(place, CRC_BITS).bitwiseOR(F.col("text_crc32"))


def _split_keys(rows: DataFrame, nodes: dict[int, Node], ranges: dict[str, tuple[float, float]]) -> None:
    """Find the key of every node where its left part reaches its share of the bytes."""
    key = F.lit(None).cast("long")
    for at, node in nodes.items():
        key = F.when(F.col("node") == at, _ordering_key(node.dimension, *ranges[node.dimension])).otherwise(key)
    keyed = rows.filter(F.col("node").isin(list(nodes))).select("node", key.alias("key"), "size")
    prefix = {at: 0 for at in nodes}
    before = {at: 0 for at in nodes}
    whole: dict[int, int] = {}
    for step in range(STEPS):
        shift = STEP_BITS * (STEPS - 1 - step)
        top = F.shiftright("key", shift + STEP_BITS)
        inside = F.lit(False)
        for at in nodes:
            inside = inside | ((F.col("node") == at) & (top == prefix[at]))
        bucket = F.shiftright("key", shift).bitwiseAND((1 << STEP_BITS) - 1).alias("bucket")
        # at most a few nodes times 8,192 buckets
        counted = keyed.filter(inside).groupBy("node", bucket).agg(F.sum("size").alias("bytes")).collect()
        for at, node in nodes.items():
            parts = sorted((r["bucket"], r["bytes"]) for r in counted if r["node"] == at)
            whole.setdefault(at, sum(b for _, b in parts))
            wanted = whole[at] * node.share
            for place, (number, weight) in enumerate(parts):
                last = place == len(parts) - 1
                if before[at] + weight >= wanted or last:
                    prefix[at] = prefix[at] << STEP_BITS | number
                    if step == STEPS - 1:
                        # the group at the boundary goes where it errs least
                        keep_left = before[at] + weight - wanted <= wanted - before[at]
                        node.key = prefix[at] if keep_left else prefix[at] - 1
                    break
                before[at] += weight


def _deal_heavy(heavy: list, target: float, shards: int) -> tuple[list[float], list[tuple]]:
    """Room left in every shard, and ``(crc, size, from, to, shard)``: parts of the heavy groups."""
    room = [target] * shards
    parts = []
    for group in sorted(heavy, key=lambda g: (-g["bytes"], g["text_crc32"], g["size"])):
        left, start = float(group["bytes"]), 0.0
        while left > 0:
            shard = max(range(shards), key=lambda s: (room[s], -s))
            take = left if left <= target else min(left, max(room[shard], left / shards))
            stop = 1.0 if take >= left else start + take / group["bytes"]
            parts.append((group["text_crc32"], group["size"], start, stop, shard))
            room[shard] -= take
            start, left = stop, left - take if take < left else 0.0
    return [max(r, 0.0) for r in room], parts


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs`` (``doc_id, text``).

    The law is ``bytes``: shards 0 to ``shards - 1`` have nearly equal sums of ``size`` (UTF-8 bytes plus 1;
    a null text has none).  ``slot`` numbers the rows of a shard from 0 without gaps; ``grown_shard`` is null.
    Null ids and repeated rows are kept, repeated rows together; an empty table gives no rows; other columns are ignored.
    """
    rows = measured(docs)
    summary = rows.agg(
        F.sum("size").alias("bytes"),
        *(f(d).alias(f"{d}_{n}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))),
    ).first()
    total = summary["bytes"] or 0
    whole_range = {d: (summary[f"{d}_low"] or 0.0, summary[f"{d}_high"] or 0.0) for d in DIMENSIONS}
    groups = rows.groupBy("text_crc32", "size").agg(F.sum("size").alias("bytes"))
    heavy = groups.filter(F.col("bytes") > HEAVY * total / shards).collect() if total else []
    room, parts = _deal_heavy(heavy, total / shards, shards)
    schema = T.StructType([
        T.StructField("text_crc32", T.LongType()), T.StructField("size", T.LongType()), T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()), T.StructField("heavy_shard", T.IntegerType()),
    ])
    fraction = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    dealt = F.broadcast(docs.sparkSession.createDataFrame(parts, schema))  # at most shards / HEAVY groups and their parts
    placed = rows.withColumn("fraction", fraction).alias("r").join(
        dealt.alias("h"),
        (F.col("r.text_crc32") == F.col("h.text_crc32")) & (F.col("r.size") == F.col("h.size"))
        & (F.col("fraction") >= F.col("low")) & (F.col("fraction") < F.col("high")),
        "left",
    ).select("r.*", "heavy_shard")

    root = Node(0, shards - 1, room)
    light = placed.filter("heavy_shard IS NULL")
    level = {1: root} if shards > 1 else {}
    number = F.lit(1)
    while level:
        numbered = light.withColumn("node", number)
        extents = numbered.groupBy("node").agg(
            *(f(d).alias(f"{d}_{n}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max)))
        ).collect()
        extents = {e["node"]: e for e in extents}
        following: dict[int, Node] = {}
        splits: dict[int, Node] = {}
        for at, node in level.items():
            def width(d: str, at: int = at) -> float:
                low, high = whole_range[d]
                found = extents.get(at)
                return (found[f"{d}_high"] - found[f"{d}_low"]) / (high - low) if found and high > low else 0.0

            node.dimension = max(DIMENSIONS, key=width)  # the first of equally wide ones
            middle = (node.first + node.last + 1) // 2
            node.children = [Node(node.first, middle - 1, room), Node(middle, node.last, room)]
            splits[at] = node
            following |= {2 * at + side: child for side, child in enumerate(node.children) if child.first < child.last}
        _split_keys(numbered, splits, whole_range)
        for at, node in splits.items():
            right = _ordering_key(node.dimension, *whole_range[node.dimension]) > node.key
            number = F.when(number == at, F.lit(2 * at) + right.cast("int")).otherwise(number)
        level = following

    leaf = F.lit(None).cast("int")

    def walk(node: Node, at: int) -> None:
        nonlocal leaf
        if node.first == node.last:
            leaf = F.when(F.col("node") == at, F.lit(node.first)).otherwise(leaf)
        for side, child in enumerate(node.children):
            walk(child, 2 * at + side)

    walk(root, 1)
    shard = F.coalesce("heavy_shard", leaf).cast("int")
    sharded = placed.withColumn("node", number).select(
        "doc_id", "size", "text_crc32", "row", shard.alias("shard"), F.shiftright("row", ROW_BITS).alias("part")
    )
    return _with_slots(written(sharded, "sharded"))


def _with_slots(sharded: DataFrame) -> DataFrame:
    """Number rows inside each shard: places inside a written part, plus the sizes of earlier parts."""
    inside = Window.partitionBy("part", "shard").orderBy("row")
    sizes = sharded.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = sharded.withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
