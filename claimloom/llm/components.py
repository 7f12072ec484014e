"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import written


# edge tables are written in parts of about this many rows, and in at least so many parts
ROWS_PER_PART = 250_000
LEAST_PARTS = 12


def _star(neighbours: DataFrame, parts: int) -> DataFrame:
    """Link every neighbour of ``u``, and ``u`` itself, to the least of them (``u`` included).

    Both sides of the join are written tables, so that Spark can split the rows of a node with very many
    neighbours.
    """
    least = written(neighbours.groupBy("u").agg(F.min("v").alias("least")).coalesce(parts), "least")
    return neighbours.join(least.withColumn("least", F.least("u", "least")), "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge to another; the root is the least node of its component.

    ``edges`` has two long columns ``u, v``; loops, repeats and both directions are allowed.  Each round
    writes its edges, so lineage stays short; the number of rounds grows with the logarithm of a
    component's width.
    """
    current = written(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    state = None
    while (now := _state(current)) != state:
        state = now
        parts = max(LEAST_PARTS, -(-now[0] // ROWS_PER_PART))
        both = written(current.union(current.select("v", "u")).distinct().coalesce(parts), "both")
        large = _star(both, parts).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct()
        large = written(large.coalesce(parts), "large")
        # every edge now points to the smaller node
        linked = _star(large, parts)
        small = linked.select(F.col("v").alias("u"), F.col("least").alias("v")).union(linked.select("u", "least"))
        current = written(small.filter("u <> v").distinct().coalesce(parts), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select("v", "v").distinct())
