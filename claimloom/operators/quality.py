"""Data-quality reports: named violation counts, as many as possible from one scan."""

from __future__ import annotations

from functools import reduce  # noqa: F401

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.errors import ContractError


def count_where(predicate: Column) -> Column:
    """Rows for which the predicate is true; unknown does not count."""
    return F.coalesce(F.count_if(predicate), F.lit(0))


def report(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """(check_name, violations) rows of aggregates computed in one pass."""
    one = df.agg(*[value.cast("bigint").alias(name) for name, value in counts.items()])
    return one.unpivot([], list(counts), "check_name", "violations")


def violations(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return report(df, {name: count_where(test) for name, test in predicates.items()})


def row_count(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def all_checks(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def duplicate_keys(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    return row_count(name, repeated)


def orphans(child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Child rows whose complete reference finds no parent; a null in the reference passes."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = [f"_p{i}" for i in range(len(columns))]
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_columns, keys, strict=True)])
    test = reduce(lambda a, b: a & b, [F.col(c) == F.col(k) for c, k in zip(columns, keys, strict=True)])
    return child.filter(complete).join(parents, test, "left_anti")


def missing_parents(
    name: str, child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]
) -> DataFrame:
    return row_count(name, orphans(child, columns, parent, parent_columns))


def rows_differ(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one of two tables but not the other, with multiplicity."""
    return row_count(name, left.exceptAll(right).unionAll(right.exceptAll(left)))


def row_difference(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Absolute difference of two row counts."""
    sides = left.select(F.lit(1).alias("_n")).unionAll(right.select(F.lit(-1).alias("_n")))
    return sides.agg(F.abs(F.coalesce(F.sum("_n"), F.lit(0))).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def failed_checks(checks: DataFrame) -> dict[str, int]:
    """Failed checks of a report; reports have one row per check."""
    return {r["check_name"]: r["violations"] for r in checks.filter("violations <> 0").collect()}


def require_passed(checks: DataFrame) -> None:
    failed = failed_checks(checks)
    if failed:
        raise ContractError("failed checks: " + ", ".join(f"{n}={v}" for n, v in sorted(failed.items())))


def compared_check_set(checks: DataFrame, contracted: set[str]) -> DataFrame:
    """Every check by whether the contract names it and whether it was carried out, with its violations."""
    named = checks.sparkSession.createDataFrame([(name, True) for name in sorted(contracted)], "check_name string, _named boolean")
    return checks.withColumn("_found", F.lit(True)).join(named, "check_name", "full").select(
        "check_name", F.col("_named").isNotNull().alias("contracted"), F.col("_found").isNotNull().alias("carried_out"), "violations"
    )


def require_check_set(checks: DataFrame, contracted: set[str]) -> None:
    """The checks carried out must be exactly those of the contract."""
    unlike = compared_check_set(checks, contracted).filter("contracted <> carried_out").select("check_name").collect()
    if unlike:
        raise ContractError(f"checks differ from contract: {sorted({r['check_name'] for r in unlike})}")
