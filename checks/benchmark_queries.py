"""Peer benchmarks over the contracted cohorts of five families, and cut points of every contracted band."""

from checks.oracle_numbers import half_up, scaled, whole
from checks.policy_queries import four
from checks.registry import register
from checks.silver_queries import CONTRACTS, SPECS, typed_frame
from claimloom.plans import benchmark

for family, contract in CONTRACTS.items():
    cohort, measure, volume = contract.cohort, contract.cohort_measure, contract.cohort_volume


    def level_sql(kept, family=family, cohort=cohort, measure=measure, volume=volume):
        shown = ", ".join(name if name in kept else f"NULL AS {name}" for name in cohort)
        return (
            f"SELECT {len(kept)} AS dimensions, {shown}, count(*) AS peer_count, sum({volume}) AS peer_volume, "
            f"{half_up(scaled(f'sum({measure})', 6), '1000000 * ' + whole('count(*)'))} AS mean, "
            "round(stddev_samp(v), 4) AS standard_deviation, "
            + ", ".join(f"round(quantile_cont(v, {f}), 4) AS {n}" for n, f in benchmark.STATISTICS.items())
            + f" FROM (SELECT *, CAST({measure} AS DOUBLE) AS v FROM silver_{family} WHERE {measure} IS NOT NULL) s "
            f"GROUP BY {', '.join(kept)} HAVING count(*) >= 11"
        )

    register(
        f"e21_{family}_contract_benchmark",
        lambda m, f=family, c=contract: benchmark.contract_benchmark(typed_frame(m, f), c).select(
            "dimensions", *c.cohort, "peer_count", "peer_volume", four("mean"), four("standard_deviation"), *map(four, benchmark.STATISTICS)),
        "dimensions:long " + " ".join(f"{name}:{SPECS[family][name]}" for name in cohort)
        + " peer_count:long peer_volume:long mean:num standard_deviation:num percentile_25:num median:num percentile_75:num "
        "percentile_90:num percentile_95:num",
        " UNION ALL ".join(map(level_sql, benchmark.cohort_levels(contract))),
    )


def families(model):
    return [(contract, typed_frame(model, family)) for family, contract in CONTRACTS.items()]


QUARTILE_SQL = ", ".join(f"quantile_cont(CAST({{0}} AS DOUBLE), {f}) AS {n}" for n, f in benchmark.QUARTILES.items())
register(
    "e22_all_band_cut_points",
    lambda m: benchmark.all_band_cut_points(families(m)),
    "family:text band:text measure:text published:long percentile_25:num median:num percentile_75:num",
    " UNION ALL ".join(
        f"SELECT '{c.name}' AS family, '{c.band.column}' AS band, '{c.band.measure}' AS measure, count(*) AS published, "
        f"{QUARTILE_SQL.format(c.band.measure)} FROM silver_{family} WHERE {c.band.measure} IS NOT NULL"
        for family, c in CONTRACTS.items()
    ),
)
register(
    "e22_band_comparison",
    lambda m: benchmark.band_comparison(families(m)).withColumn("share", four("share")),
    "family:text band:text band_name:text minimum_inclusive:long maximum_inclusive:long members:long share:num quartile_below:num "
    "begins_at_quartile:bool",
    "SELECT *, minimum_inclusive = floor(quartile_below) + 1 AS begins_at_quartile FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c.name}' AS family, '{c.band.column}' AS band, '{name}' AS band_name, {low} AS minimum_inclusive, "
        f"{high if high is not None else 'NULL'} AS maximum_inclusive, count(*) FILTER ({c.band.column} = '{name}') AS members, "
        f"{half_up(whole(f'count(*) FILTER ({c.band.column} = {chr(39)}{name}{chr(39)})'), whole(f'count({c.band.measure})'))} AS share, "
        + (f"quantile_cont(CAST({c.band.measure} AS DOUBLE), {place / 4})" if place else "CAST(NULL AS DOUBLE)")
        + f" AS quartile_below FROM silver_{family}"
        for family, c in CONTRACTS.items()
        for place, (name, low, high) in enumerate(c.band.ranges)
    )
    + ") compared",
)
