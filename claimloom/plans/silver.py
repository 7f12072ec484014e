"""Typed projections of the six source families and their suppression lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.contracts.silver import GEOGRAPHIC, LINEAGE, GeographicContract, SourceContract
from claimloom.errors import ContractError
from claimloom.functions import typing as t


def missing_columns(df: DataFrame, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"missing source columns: {', '.join(missing)}")


def source_measures(df: DataFrame, contract: SourceContract) -> dict[str, str]:
    """Measure columns in source order with their types; unknown or absent measures are errors."""
    outside = {*contract.dimensions, *contract.indicators, *LINEAGE}
    found = [name for name in df.columns if name not in outside]
    if contract.decimals is not None:
        governed = {*contract.integers, *contract.decimals}
        unknown, absent = sorted(set(found) - governed), sorted(governed - set(found))
        if unknown or absent:
            raise ContractError(f"measure columns differ: unknown {unknown}, absent {absent}")
    return {name: t.WHOLE if name in contract.integers else t.EXACT for name in found}


def typed_silver(bronze: DataFrame, contract: SourceContract) -> DataFrame:
    """One typed row per source row; nothing is dropped, imputed or reordered."""
    require_columns(bronze, [*contract.dimensions, *contract.indicators, *LINEAGE])
    measures = source_measures(bronze, contract)
    columns: list[Column] = []
    for source, target in contract.dimensions.items():
        unknown = "Unknown" if target in contract.unknown else None
        columns.append(t.dimension(F.col(source), unknown).alias(target))
    for source, target in contract.dimensions.items():
        if target in contract.unknown:
            columns.append(t.missing(F.col(source)).alias(f"{target}_is_missing"))
    columns.append(F.col("_reporting_year").cast("int").alias(contract.period))
    for source, kind in measures.items():
        columns.append(t.measure(F.col(source), kind).alias(contract.target(source)))
    for source, indicator in contract.indicators.items():
        statuses = {token: contract.statuses[token] for token in indicator.tokens}
        status = t.token_status(F.col(source), statuses, "not_suppressed", contract.trim_tokens)
        columns.append(status.alias(f"{indicator.group}_suppression_status"))
    typed = bronze.select(*columns, *LINEAGE)
    return typed.select("*", *derived_columns(typed, measures, contract))


def derived_columns(typed: DataFrame, measures: dict[str, str], contract: SourceContract) -> list[Column]:
    """Second-level columns that read the typed ones; Catalyst merges both projections."""
    derived: list[Column] = []
    for status, governing in contract.null_groups.items():
        derived.append(t.null_status(F.col(governing)).alias(status))
    if contract.band:
        band = contract.band
        derived.append(t.band(F.col(band.measure), band.ranges, band.when_null).alias(band.column))
    if contract.country:
        country = F.col(contract.country)
        derived += [
            t.geography_scope(country).alias("provider_geography_scope"),
            t.domestic_only(F.col("provider_state_fips"), country).alias("peer_state_fips"),
            t.domestic_only(F.col("provider_ruca_code"), country).alias("peer_ruca_code"),
        ]
    for flag, left, right in contract.flags:
        derived.append(t.above(F.col(left), F.col(right), contract.flag_nulls_false).alias(flag))
    if contract.top_coded_suffix:
        capped = [contract.target(m) for m in measures if m.endswith(contract.top_coded_suffix)]
        flags = [t.top_coded(F.col(name), contract.top_code) for name in capped]
        derived += [flag.alias(f"{name}_is_top_coded") for name, flag in zip(capped, flags, strict=True)]
        derived.append(t.count_true(flags).alias("top_coded_metric_count"))
    return derived


def suppression_lineage(bronze: DataFrame, contract: SourceContract) -> DataFrame:
    """One row per suppressed measure group, from a single scan."""
    entity = contract.key[0]
    source = next(name for name, target in contract.dimensions.items() if target == entity)
    groups = []
    for name, indicator in contract.indicators.items():
        text = t.cleaned(F.col(name)) if contract.trim_tokens else F.col(name)
        statuses = {token: contract.statuses[token] for token in indicator.tokens}
        groups.append(
            F.struct(
                F.lit(indicator.group).alias("measure_group"),
                F.col(name).alias("source_indicator"),
                F.when(text.isin(*statuses), t.token_status(F.col(name), statuses, "", contract.trim_tokens))
                .alias("suppression_status"),
            )
        )
    return (
        bronze.select(
            t.cleaned(F.col(source)).alias(entity),
            F.col("_reporting_year").cast("int").alias(contract.period),
            F.explode(F.array(*groups)).alias("g"),
        )
        .select(entity, contract.period, "g.*")
        .filter(F.col("suppression_status").isNotNull())
    )


# -- geographic family ------------------------------------------------------------------------


def geographic_measures(df: DataFrame, contract: GeographicContract = GEOGRAPHIC) -> dict[str, str]:
    outside = {*contract.dimensions, *LINEAGE}
    kind = lambda name: t.WHOLE if name.endswith(contract.integer_suffixes) else t.EXACT
    return {name: kind(name) for name in df.columns if name not in outside}


def geography_id(contract: GeographicContract = GEOGRAPHIC) -> Column:
    return t.geography_identifier(
        F.col("BENE_GEO_LVL"), F.col("BENE_GEO_DESC"), F.col("BENE_GEO_CD"), contract.fixed, contract.coded
    ).alias("geography_id")


def geographic_silver(bronze: DataFrame, contract: GeographicContract = GEOGRAPHIC) -> DataFrame:
    require_columns(bronze, [*contract.dimensions, *LINEAGE])
    measures = geographic_measures(bronze, contract)
    tokens = (*contract.suppressed, *contract.blank, *contract.not_applicable)
    sources = [F.col(name) for name in measures]
    return bronze.select(
        F.col("YEAR").try_cast("int").alias("year"),
        F.col("BENE_GEO_LVL").alias("geography_level"),
        geography_id(contract),
        F.col("BENE_GEO_DESC").alias("geography_name"),
        F.col("BENE_GEO_CD").alias("source_geography_code"),
        F.col("BENE_AGE_LVL").alias("beneficiary_age_level"),
        *[t.token_measure(F.col(n), kind, tokens).alias(n.lower()) for n, kind in measures.items()],
        t.token_count(sources, contract.suppressed).alias("suppressed_measure_count"),
        t.token_count(sources, contract.not_applicable).alias("not_applicable_measure_count"),
        *LINEAGE,
    )


def geographic_value_status(bronze: DataFrame, contract: GeographicContract = GEOGRAPHIC) -> DataFrame:
    """Long list of the cells that carried a governed token instead of a number."""
    measures = list(geographic_measures(bronze, contract))
    keys = [
        F.col("YEAR").try_cast("int").alias("year"),
        F.col("BENE_GEO_LVL").alias("geography_level"),
        geography_id(contract),
        F.col("BENE_AGE_LVL").alias("beneficiary_age_level"),
    ]
    long = bronze.select(*keys, *measures).unpivot(
        list(contract.key), measures, "measure_name", "source_token"
    )
    token = t.cleaned(F.col("source_token"))
    return long.filter(token.isin(*contract.suppressed, *contract.not_applicable)).select(
        *contract.key,
        F.lower("measure_name").alias("measure_name"),
        "source_token",
        F.when(token.isin(*contract.suppressed), "suppressed").otherwise("not_applicable").alias("value_status"),
    )


def public_columns(silver: DataFrame, contract: SourceContract) -> DataFrame:
    """Without the columns that may not appear in public extracts."""
    return silver.drop(*contract.private)
