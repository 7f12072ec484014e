"""Quality reports of the silver tables: one pass over bronze, one over silver, one key check."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.contracts.silver import GEOGRAPHIC, LINEAGE, GeographicContract, SourceContract
from claimloom.errors import ContractError
from claimloom.functions import typing as t
from claimloom.operators.quality import (
    all_checks, count_where, duplicate_keys, report, row_difference, violations,
)
from claimloom.plans.silver import geographic_measures, source_measures


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def detail_columns(bronze: DataFrame, name: str, contract: SourceContract) -> list[str]:
    indicator = contract.indicators[name]
    if indicator.prefix is None:
        return list(indicator.measures)
    found = [c for c in bronze.columns if c.startswith(indicator.prefix) and c != name]
    if not found:
        raise ContractError(f"no detail columns for {name}")
    return found


def bronze_counts(bronze: DataFrame, contract: SourceContract) -> dict[str, Column]:
    """Counts that need the source text: numbers, fractions, tokens and suppressed details."""
    measures = source_measures(bronze, contract)
    wrong_number = [count_where(t.unparseable(F.col(n), k, ("",))) for n, k in measures.items()]
    split_count = [count_where(t.fractional(F.col(n))) for n in measures if n in contract.integers]
    counts = {"unparseable_numbers": _added(wrong_number), "fractional_counts": _added(split_count)}
    wrong_token, detail = [], []
    for name, indicator in contract.indicators.items():
        text = t.cleaned(F.col(name)) if contract.trim_tokens else F.col(name)
        wrong_token.append(count_where(text.isNotNull() & ~text.isin(*indicator.tokens)))
        empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in detail_columns(bronze, name, contract)])
        full = reduce(
            lambda a, b: a & b, [F.col(c).isNotNull() for c in detail_columns(bronze, name, contract)]
        )
        detail.append(count_where((text.isin(*indicator.tokens) & ~empty) | (text.isNull() & ~full)))
    if contract.indicators:
        counts["invalid_suppression_tokens"] = _added(wrong_token)
        counts["suppression_detail"] = _added(detail)
    return counts


def _added(counts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, counts, F.lit(0))


def silver_predicates(silver: DataFrame, contract: SourceContract) -> dict[str, Column]:
    """Row predicates on typed columns."""
    named = set(contract.targets.values()) or {
        c for c, kind in silver.dtypes
        if (kind.startswith("decimal") or kind == "bigint")
    }
    tests: dict[str, Column] = {
        "null_business_keys": any_of([F.col(k).isNull() for k in contract.key]),
        "negative_measures": any_of([F.col(m) < 0 for m in sorted(named)]),
    }
    for column, pattern in contract.patterns.items():
        fits = t.matches(F.col(column), pattern)
        tests[f"invalid_{column}"] = (
            F.col(column).isNull() | ~fits if contract.null_breaks_pattern else ~fits
        )
    for column, allowed in contract.domains.items():
        tests[f"outside_domain_{column}"] = ~F.col(column).isin(*allowed)
    tests["unknown_periods"] = ~F.col(contract.period).isin(*contract.periods)
    if contract.minimum:
        measure, least = contract.minimum
        tests["below_publication_minimum"] = F.col(measure) < least
    for low, high in contract.ordered:
        tests[f"{low}_above_{high}"] = F.col(low) > F.col(high)
    if contract.country:
        foreign = F.col(contract.country) != "US"
        tests["foreign_peer_geography"] = foreign & (
            (F.col("peer_state_fips") != "Not applicable") | (F.col("peer_ruca_code") != "Not applicable")
        )
    ranges = {"bene_avg_age": (0, 120)}
    for name in silver.columns:
        if contract.top_coded_suffix and name.endswith(contract.top_coded_suffix.lower()):
            ranges[name] = (0, contract.top_code)
        elif name.endswith("_rate"):
            ranges[name] = (0, 100)
    bounded = [(F.col(n) < low) | (F.col(n) > high) for n, (low, high) in ranges.items() if n in silver.columns]
    if bounded:
        tests["outside_range"] = any_of(bounded)
    if "bene_avg_risk_scre" in silver.columns:
        tests["nonpositive_risk_score"] = F.col("bene_avg_risk_scre") <= 0
    return tests


def observed(silver: DataFrame, contract: SourceContract) -> dict[str, Column]:
    """Reported counts that are not violations: relationships, missing dimensions, suppression."""
    names = [f"{target}_is_missing" for target in contract.unknown] + [flag for flag, _, _ in contract.flags]
    counts = {f"observed_{name}": count_where(F.col(name)) for name in names}
    for status in contract.null_groups:
        counts[f"observed_{status}_suppressed"] = count_where(F.col(status) == "suppressed")
    return counts


def silver_counts(silver: DataFrame, contract: SourceContract) -> dict[str, Column]:
    """Counts over the typed table: violations, differences and ``observed_`` information."""
    counts = {name: count_where(test) for name, test in silver_predicates(silver, contract).items()}
    if contract.top_coded_suffix:
        flags = [c for c in silver.columns if c.endswith("_is_top_coded")]
        counts["top_coding_difference"] = F.abs(
            F.coalesce(F.sum("top_coded_metric_count"), F.lit(0)) - _added([count_where(F.col(c)) for c in flags])
        )
    absent = [count_where(F.col(contract.period) == period) == 0 for period in contract.periods]
    counts["missing_periods"] = _added([test.cast("int") for test in absent])
    if len(contract.unknown) >= 2 and contract.key[0] == "hospital_ccn":
        code, text = (F.col(f"{name}_is_missing") for name in contract.unknown)
        counts["unpaired_missing_dimension"] = F.abs(count_where(code) - count_where(text))
    return {**counts, **observed(silver, contract)}


def suppression_difference(bronze: DataFrame, lineage: DataFrame, contract: SourceContract) -> DataFrame:
    """Marks in the source against rows of suppression lineage."""
    marked = F.lit(0)
    for name, indicator in contract.indicators.items():
        text = t.cleaned(F.col(name)) if contract.trim_tokens else F.col(name)
        # physician counts every mark, Part D the official ones; they agree when tokens are valid
        hit = text.isin(*indicator.tokens) if contract.trim_tokens else text.isNotNull()
        marked = marked + F.coalesce(hit, F.lit(False)).cast("int")
    sides = bronze.select(marked.alias("_n")).unionAll(lineage.select(F.lit(-1).alias("_n")))
    return report(sides, {"suppression_count_difference": F.abs(F.coalesce(F.sum("_n"), F.lit(0)))})


def silver_report(
    bronze: DataFrame, silver: DataFrame, contract: SourceContract, lineage: DataFrame | None = None, only: str = ""
) -> DataFrame:
    """(check_name, violations) of one source family; ``observed_`` rows are information.

    With ``only``, checks whose name starts so are made and nothing else is: no other column is parsed and no
    other scan or shuffle is planned.
    """
    reports = []
    for table, counts in ((bronze, bronze_counts(bronze, contract)), (silver, silver_counts(silver, contract))):
        wanted = {name: count for name, count in counts.items() if name.startswith(only)}
        if wanted:
            reports.append(report(table, wanted))
    if "duplicate_business_keys".startswith(only):
        reports.append(duplicate_keys("duplicate_business_keys", silver, list(contract.key)))
    if "row_count_difference".startswith(only):
        reports.append(row_difference("row_count_difference", bronze, silver))
    if contract.indicators and lineage is not None and "suppression_count_difference".startswith(only):
        reports.append(suppression_difference(bronze, lineage, contract))
    if not reports:
        raise ContractError(f"no check is named {only}")
    return all_checks(*reports)


def metric_nulls(silver: DataFrame, contract: SourceContract, measures: list[str]) -> DataFrame:
    """Null count of every measure, long."""
    return report(
        silver, {contract.target(m): count_where(F.col(contract.target(m)).isNull()) for m in measures}
    ).withColumnsRenamed({"check_name": "measure_name", "violations": "null_count"})


def expected_masks(groups: dict[str, tuple[str, ...]], requires: tuple[tuple[str, str], ...] = ()) -> list[int]:
    """Bit masks in which every group is wholly present or absent and no group lacks one that it requires."""
    bits, at = {}, 0
    for name, measures in groups.items():
        bits[name] = sum(1 << place for place in range(at, at + len(measures)))
        at += len(measures)
    chosen = product((False, True), repeat=len(groups))
    states = [dict(zip(groups, present, strict=True)) for present in chosen]
    return [sum(bits[name] for name in groups if state[name]) for state in states
            if all(state[needed] or not state[needing] for needing, needed in requires)]


def null_patterns(
    silver: DataFrame, groups: dict[str, tuple[str, ...]], requires: tuple[tuple[str, str], ...] = ()
) -> DataFrame:
    """``mask, row_count, expected``: rows by which measures are present, the first measure being the lowest bit.

    Expected masks without rows are listed with 0, so found and expected patterns can be held against each other.
    """
    measures = [measure for group in groups.values() for measure in group]
    present = [F.when(F.col(name).isNotNull(), 1 << place).otherwise(0) for place, name in enumerate(measures)]
    found = silver.groupBy(reduce(lambda a, b: a + b, present).cast("int").alias("mask")).agg(F.count("*").alias("_rows"))
    wanted = silver.sparkSession.createDataFrame([(mask,) for mask in expected_masks(groups, requires)], "mask int")
    return found.join(wanted.withColumn("_wanted", F.lit(True)), "mask", "full").select(
        "mask", F.coalesce("_rows", F.lit(0)).alias("row_count"), F.coalesce("_wanted", F.lit(False)).alias("expected")
    )


def schema_drift(bronze: DataFrame, contract: SourceContract, expected_columns: int | None = None) -> list[str]:
    """Differences of the column set from the contract, as texts."""
    columns = [c for c in bronze.columns if c not in LINEAGE]
    problems = [f"absent {c}" for c in (*contract.dimensions, *LINEAGE) if c not in bronze.columns]
    if expected_columns is not None and len(columns) != expected_columns:
        problems.append(f"{len(columns)} source columns instead of {expected_columns}")
    return problems


def geographic_report(
    bronze: DataFrame, silver: DataFrame, contract: GeographicContract = GEOGRAPHIC
) -> DataFrame:
    measures = geographic_measures(bronze, contract)
    tokens = (*contract.suppressed, *contract.blank, *contract.not_applicable)
    wrong = {"unparseable_numbers": _added([count_where(t.unparseable(F.col(n), k, tokens)) for n, k in measures.items()])}
    low = lambda names: any_of([F.col(n.lower()) < 0 for n in names]) if names else F.lit(False)
    counts = [n for n, k in measures.items() if k == t.WHOLE]
    payments = [n for n in measures if "PYMT" in n and n.endswith("_AMT")]
    shares = [n.lower() for n in measures if n.endswith(("_PCT", "_RATE"))]
    tests = {
        "null_business_keys": any_of([F.col(k).isNull() for k in contract.key]),
        "negative_counts": low(counts),
        "negative_payments": low(payments),
        "percentage_range": any_of([(F.col(n) < 0) | (F.col(n) > 100) for n in shares]) if shares else F.lit(False),
        "unknown_levels": ~F.col("geography_level").isin(*contract.levels),
        "unknown_ages": ~F.col("beneficiary_age_level").isin(*contract.ages),
    }
    return all_checks(
        report(bronze, wrong),
        violations(silver, tests),
        duplicate_keys("duplicate_business_keys", silver, list(contract.key)),
        row_difference("row_count_difference", bronze, silver),
    )
