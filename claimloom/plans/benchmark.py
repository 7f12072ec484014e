"""Peer cohort benchmarks with a publication threshold, and empirical cut points of volume bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.contracts.silver import SourceContract
from claimloom.operators.percentiles import exact_percentiles

QUARTILES = {"percentile_25": 0.25, "median": 0.5, "percentile_75": 0.75}
STATISTICS = {**QUARTILES, "percentile_90": 0.9, "percentile_95": 0.95}


def peer_benchmark(df: DataFrame, cohort: list[str], value: str, volume: str | None = None, minimum_group_size: int = 11) -> DataFrame:
    """Count, mean, spread and percentiles of ``value`` per cohort; small cohorts are not published.

    Members are rows with a value.  With ``volume`` its total over the cohort is given too, as ``peer_volume``.
    """
    present = df.filter(F.col(value).isNotNull())
    total = [F.sum(F.col(volume).cast("decimal(38,0)")).cast("bigint").alias("peer_volume")] if volume else []
    groups = (
        present.groupBy(*cohort)
        .agg(
            F.count("*").alias("peer_count"),
            *total,
            F.avg(value).alias("mean"),
            F.stddev_samp(F.col(value).cast("double")).alias("standard_deviation"),
        )
        .filter(F.col("peer_count") >= minimum_group_size)
    )
    # only published cohorts are ranked
    shown = groups.select(*(F.col(c).alias(f"shown_{c}") for c in cohort))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"shown_{c}")) for c in cohort))
    percentiles = exact_percentiles(present.join(shown, same, "left_semi"), cohort, value, STATISTICS)
    joined = groups.join(percentiles, reduce(lambda a, b: a & b, (groups[c].eqNullSafe(percentiles[c]) for c in cohort)))
    return joined.select(*(groups[c] for c in cohort), "peer_count", *(["peer_volume"] if volume else []), "mean", "standard_deviation", *STATISTICS)


def cohort_levels(contract: SourceContract) -> list[tuple[str, ...]]:
    """The contracted cohort, then wider ones: the last dimension but the period is given up, one after another."""
    others = [name for name in contract.cohort if name != contract.period]
    return [(*others[:kept], contract.period) for kept in range(len(others), -1, -1)]


def contract_benchmark(silver: DataFrame, contract: SourceContract) -> DataFrame:
    """Benchmark of a family over its contracted cohort and the wider ones that peers fall back to.

    ``dimensions`` is the number of dimensions that define a row's cohort (most: the contracted one); dimensions given up are
    null.  Cohorts below the contracted number of peers aren't published.
    """
    wider = F.array(*(
        F.struct(
            F.lit(len(kept)).alias("dimensions"),
            *((F.col(name) if name in kept else F.lit(None).cast(silver.schema[name].dataType)).alias(name) for name in contract.cohort),
        )
        for kept in cohort_levels(contract)
    ))
    rows = silver.filter(F.col(contract.cohort_measure).isNotNull()).select(
        F.explode(wider).alias("cohort"), contract.cohort_measure, *([contract.cohort_volume] if contract.cohort_volume else [])
    )
    return peer_benchmark(
        rows.select("cohort.*", *rows.columns[1:]), ["dimensions", *contract.cohort], contract.cohort_measure, contract.cohort_volume, contract.minimum_peers
    )


def band_cut_points(df: DataFrame, value: str) -> DataFrame:
    """Pooled quartiles of a measure: the empirical source of its volume bands."""
    return exact_percentiles(df, [], value, QUARTILES)


def all_band_cut_points(families: list[tuple[SourceContract, DataFrame]]) -> DataFrame:
    """``family, band, measure, published`` and quartiles of every contracted band measure, all ranked together."""
    parts = [
        frame.select(
            F.lit(contract.name).alias("family"), F.lit(contract.band.column).alias("band"), F.lit(contract.band.measure).alias("measure"),
            F.col(contract.band.measure).cast("double").alias("value"),
        ).filter("value IS NOT NULL")
        for contract, frame in families
    ]
    pooled = reduce(DataFrame.unionByName, parts)
    keys = ["family", "band", "measure"]
    return pooled.groupBy(*keys).agg(F.count("*").alias("published")).join(exact_percentiles(pooled, keys, "value", QUARTILES), keys)


def band_comparison(families: list[tuple[SourceContract, DataFrame]]) -> DataFrame:
    """Each contracted band beside what the data say: rows and share inside, and the quartile that would begin the band.

    The second to fourth band of a quartile table begin above the first to third quartile; ``begins_at_quartile`` tells
    whether the contracted bound is the first whole number above it.
    """
    cuts = all_band_cut_points(families)
    spark = cuts.sparkSession
    bounds = spark.createDataFrame(
        [
            (contract.name, name, place, low, high)
            for contract, _ in families
            for place, (name, low, high) in enumerate(contract.band.ranges)
        ],
        "family string, band_name string, place int, minimum_inclusive long, maximum_inclusive long",
    )
    inside = [
        frame.groupBy(F.lit(contract.name).alias("family"), F.col(contract.band.column).alias("band_name")).agg(F.count("*").alias("members"))
        for contract, frame in families
    ]
    members = reduce(DataFrame.unionByName, inside)
    quartile = F.when(F.col("place") > 0, F.element_at(F.array(*QUARTILES), F.greatest("place", F.lit(1))))
    return (
        bounds.join(cuts, "family").join(members, ["family", "band_name"], "left")
        .select(
            "family", "band", "band_name", "minimum_inclusive", "maximum_inclusive", F.coalesce("members", F.lit(0)).alias("members"),
            (F.coalesce("members", F.lit(0)) / F.col("published")).alias("share"), quartile.alias("quartile_below"),
        )
        .withColumn("begins_at_quartile", F.col("minimum_inclusive") == F.floor("quartile_below") + 1)
    )
