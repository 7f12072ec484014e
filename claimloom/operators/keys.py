"""Dense numbering of large tables without a single-task sort.

``dense_positions`` sorts a table into ranges, numbers every row inside its range and adds
the sizes of the earlier ranges.  The ranged table is written first: range bounds come
from a sample, so both passes must read the very same partitions.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import written

# monotonically_increasing_id packs (partition, row) into 31 and 33 bits
ROW_BITS = 33
# keys with more rows are numbered over many tasks, all others by a window
CROWDED = 200_000

def dense_positions(df: DataFrame, order: list[str], position: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the global order of ``order``."""
    ranged = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", ROW_BITS)
    row = F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # one row per range partition, so this window and broadcast stay tiny
    sizes = ranged.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(position, F.col("_before") + row)
        .drop("_slot", "_part", "_before")
    )


def dense_keys(df: DataFrame, business_key: list[str], key: str, key_type: str = "bigint") -> DataFrame:
    """Distinct business keys with a stable 1..N key in sorted order."""
    return dense_positions(df.select(*business_key).distinct(), business_key).select(
        *business_key, (F.col("position") + 1).cast(key_type).alias(key)
    )


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(and_, (F.col(name).eqNullSafe(F.col(f"{prefix}{name}")) for name in keys))


def crowded_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, as ``_key_*``, of more than ``CROWDED`` rows; nulls are a key like any other."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > CROWDED)
    return written(sizes.select(*(F.col(name).alias(f"_key_{name}") for name in keys)))


def number_within(df: DataFrame, keys: list[str], order: list[str], number: str, crowded: DataFrame | None = None) -> DataFrame:
    """1-based row number inside each key group; ``order`` must be a total order per key.

    Rows of a key meet in one sort, after which the table lies by key.  Keys of more than ``CROWDED`` rows are numbered
    in the global order of key and ``order`` instead, less the start of their key, so a key of any size is spread over
    tasks.  Null keys form a group like any other.  ``crowded`` is ``crowded_keys`` of a table that is cheaper to count.
    """
    crowded = crowded_keys(df, keys) if crowded is None else crowded
    placed = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint").alias(number)
    if crowded.isEmpty():
        return df.select("*", placed)
    few = F.broadcast(crowded)  # at most one key for each CROWDED rows
    rest = df.join(few, _same(keys, "_key_"), "left_anti").select("*", placed)
    return rest.unionByName(_number_crowded(df.join(few, _same(keys, "_key_"), "left_semi"), keys, order, number))


def _number_crowded(df: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    spread = dense_positions(df, [*keys, *order], "_position")
    starts = spread.groupBy(*keys).agg(F.min("_position").alias("_start"))
    # written, so that both sides of the join are plain scans and a large key's rows can be split
    starts = written(starts.select(*(F.col(name).alias(f"_key_{name}") for name in keys), "_start"))
    return spread.join(starts, _same(keys, "_key_")).select(
        *(F.col(name) for name in df.columns), (F.col("_position") - F.col("_start") + 1).alias(number)
    )
