"""Exact interpolated percentiles of groups of any size, by running counts over ranges of ordered values.

Values collapse to counts first.  The counts are sorted into ranges by group and value and written once; sums of
each group and range tell in which range a wanted rank lies, and only those ranges are counted through.  No step
orders more than one range, and a group that holds most rows is spread over ranges like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import written

# fewer values than this are not worth a range of their own
BINS = 8192


def values_at_ranks(counts: DataFrame, ranks: DataFrame) -> DataFrame:
    """``key, rank, value``: the value at each 0-based rank of its group's values in order.

    ``counts`` has distinct ``key, value`` (double, no nulls) and ``n``, how often the value occurs; ``ranks`` has
    ``key, rank``.  Keys are compared with nulls equal; ranks outside a group are left out.
    """
    most = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(most, counts.count() // BINS))
    ordered = written(counts.select("key", "value", "n").repartitionByRange(ranges, "key", "value").withColumn("part", F.spark_partition_id()))
    # a row for each key of a range
    held = ordered.groupBy("key", "part").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    rank, inside = F.col("rank"), F.col("inside")
    wanted = ranks.select(F.col("key").alias("wanted"), "rank").distinct()
    here = F.col("key").eqNullSafe(F.col("wanted")) & (rank >= F.col("before")) & (rank < F.col("before") + F.col("held"))
    places = written(held.join(wanted, here).select(
        F.col("key").alias("group"), F.col("part").alias("at"), "rank", (rank - F.col("before")).alias("inside")))
    met = F.col("key").eqNullSafe(F.col("group")) & (F.col("part") == F.col("at"))
    below = Window.partitionBy("key", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    counted = ordered.join(places.select("group", "at").distinct(), met, "left_semi").withColumn(
        "below", F.coalesce(F.sum("n").over(below), F.lit(0))
    )
    found = counted.join(places, met & (inside >= F.col("below")) & (inside < F.col("below") + F.col("n")))
    return found.select("key", "rank", "value")


def exact_percentiles(df: DataFrame, groups: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """One row per group with a column per named fraction (linear interpolation; nulls and NaN are passed over)."""
    key = F.struct(*groups) if groups else F.struct(F.lit(1).alias("all"))
    number = F.col(value).cast("double")
    counts = df.filter(number.isNotNull() & ~F.isnan(number)).groupBy(key.alias("key"), (number + 0.0).alias("value")).agg(F.count("*").alias("n"))
    counts = written(counts)
    sizes = counts.groupBy("key").agg((F.sum("n") - 1).alias("last"))
    places = F.array(*(
        F.struct(F.lit(name).alias("name"), (F.lit(float(share)) * F.col("last")).alias("place")) for name, share in fractions.items()
    ))
    placed = sizes.select("key", F.explode(places).alias("at")).select("key", "at.name", "at.place")
    # both neighbours of each fractional place; a whole place counts once, with full weight
    low, high = F.floor("place"), F.ceil("place")
    near = F.array_distinct(F.array(
        F.struct(low.cast("bigint").alias("rank"), (1 - (F.col("place") - low)).alias("share")),
        F.struct(high.cast("bigint").alias("rank"), F.when(high == low, 1.0).otherwise(F.col("place") - low).alias("share")),
    ))
    shares = written(placed.select("key", "name", F.explode(near).alias("at")).select("key", "name", "at.rank", "at.share"))
    values = values_at_ranks(counts, shares.select("key", "rank")).withColumnsRenamed({"key": "group", "rank": "known"})
    met = shares.join(values, F.col("key").eqNullSafe(F.col("group")) & (F.col("rank") == F.col("known")))
    picked = [F.sum(F.when(F.col("name") == name, F.col("share") * F.col("value"))).alias(name) for name in fractions]
    result = met.groupBy("key").agg(*picked)
    return result.select(*(["key.*"] if groups else []), *fractions)
