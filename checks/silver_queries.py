"""Typed silver tables, suppression lineage and their quality reports."""

from checks.bronze_model import BRONZE, bronze_frame, bronze_sql
from checks.oracle_base import SUBQUERIES
from checks.registry import register
from claimloom.contracts.silver import (
    GEOGRAPHIC, INPATIENT, LINEAGE, OUTPATIENT, PART_D, PHYSICIAN, PHYSICIAN_SERVICE,
)
from claimloom.operators.quality import duplicate_keys
from claimloom.plans import silver, silver_quality

CONTRACTS = {
    "physician": PHYSICIAN,
    "part_d": PART_D,
    "inpatient": INPATIENT,
    "outpatient": OUTPATIENT,
    "physician_service": PHYSICIAN_SERVICE,
}
for family in BRONZE:
    SUBQUERIES[f"bronze_{family}"] = bronze_sql(family)


def measures_of(family, contract):
    outside = {*contract.dimensions, *contract.indicators, *LINEAGE}
    return [c for c in BRONZE[family][1] if c not in outside]


def trimmed(column):
    return f"TRIM(CAST({column} AS VARCHAR))"


def typed(column, whole):
    return f"TRY_CAST({trimmed(column)} AS {'BIGINT' if whole else 'DECIMAL(38,6)'})"


def case_token(column, contract, indicator, otherwise):
    text = trimmed(column) if contract.trim_tokens else column
    cases = " ".join(f"WHEN {text} = '{t}' THEN '{contract.statuses[t]}'" for t in indicator.tokens)
    return f"CASE {cases} ELSE {otherwise} END"


def silver_sql(family, contract):
    inner = []
    for source, target in contract.dimensions.items():
        value = f"NULLIF({trimmed(source)}, '')"
        inner.append(f"COALESCE({value}, 'Unknown') AS {target}" if target in contract.unknown else f"{value} AS {target}")
    for source, target in contract.dimensions.items():
        if target in contract.unknown:
            inner.append(f"COALESCE({trimmed(source)} = '', TRUE) AS {target}_is_missing")
    inner.append(f"CAST(_reporting_year AS INTEGER) AS {contract.period}")
    measures = measures_of(family, contract)
    inner += [f"{typed(m, m in contract.integers)} AS {contract.target(m)}" for m in measures]
    inner += [
        f"{case_token(c, contract, i, chr(39) + 'not_suppressed' + chr(39))} AS {i.group}_suppression_status"
        for c, i in contract.indicators.items()
    ]
    inner += list(LINEAGE)
    outer = ["*"]
    for status, governing in contract.null_groups.items():
        outer.append(f"CASE WHEN {governing} IS NULL THEN 'suppressed' ELSE 'published' END AS {status}")
    if contract.band:
        band = contract.band
        cases = " ".join(
            f"WHEN {band.measure} >= {lo}" + ("" if hi is None else f" AND {band.measure} <= {hi}") + f" THEN '{label}'"
            for label, lo, hi in band.ranges
        )
        null_case = f"WHEN {band.measure} IS NULL THEN '{band.when_null}' " if band.when_null else ""
        outer.append(f"CASE {null_case}{cases} END AS {band.column}")
    if contract.country:
        home = f"{contract.country} = 'US'"
        outer += [
            f"CASE WHEN {home} THEN 'United States' ELSE 'Foreign' END AS provider_geography_scope",
            f"CASE WHEN {home} THEN provider_state_fips ELSE 'Not applicable' END AS peer_state_fips",
            f"CASE WHEN {home} THEN provider_ruca_code ELSE 'Not applicable' END AS peer_ruca_code",
        ]
    for flag, left, right in contract.flags:
        test = f"{left} > {right}"
        outer.append(f"{f'COALESCE({test}, FALSE)' if contract.flag_nulls_false else test} AS {flag}")
    if contract.top_coded_suffix:
        capped = [contract.target(m) for m in measures if m.endswith(contract.top_coded_suffix)]
        outer += [f"COALESCE({c} = 75, FALSE) AS {c}_is_top_coded" for c in capped]
        outer.append(" + ".join(f"CAST(COALESCE({c} = 75, FALSE) AS INTEGER)" for c in capped) + " AS top_coded_metric_count")
    return f"SELECT {', '.join(outer)} FROM (SELECT {', '.join(inner)} FROM bronze_{family}) typed"


def silver_spec(family, contract):
    spec = {target: "text" for target in contract.dimensions.values()}
    spec |= {f"{t}_is_missing": "bool" for t in contract.dimensions.values() if t in contract.unknown}
    spec[contract.period] = "long"
    measures = measures_of(family, contract)
    spec |= {contract.target(m): "long" if m in contract.integers else "num" for m in measures}
    spec |= {f"{i.group}_suppression_status": "text" for i in contract.indicators.values()}
    spec |= {name: "text" for name in contract.null_groups}
    spec[contract.band.column] = "text"
    if contract.country:
        spec |= {n: "text" for n in ("provider_geography_scope", "peer_state_fips", "peer_ruca_code")}
    spec |= {flag: "bool" for flag, _, _ in contract.flags}
    if contract.top_coded_suffix:
        capped = [contract.target(m) for m in measures if m.endswith(contract.top_coded_suffix)]
        spec |= {f"{c}_is_top_coded": "bool" for c in capped} | {"top_coded_metric_count": "long"}
    return spec


def text_spec(spec):
    return " ".join(f"{name}:{kind}" for name, kind in spec.items())


def typed_frame(model, family):
    return silver.typed_silver(bronze_frame(model, family), CONTRACTS[family])


PIPELINES = {"physician": "b31", "part_d": "b32", "inpatient": "b33", "outpatient": "b34", "physician_service": "b35"}
SPECS = {}
for family, contract in CONTRACTS.items():
    SUBQUERIES[f"silver_{family}"] = silver_sql(family, contract)
    SPECS[family] = silver_spec(family, contract)
    register(
        f"{PIPELINES[family]}_{family}_silver",
        lambda m, f=family: typed_frame(m, f),
        text_spec(SPECS[family]),
        f"SELECT * FROM silver_{family}",
    )


def part(name, family, *columns):
    """One expression family of a pipeline, with the business key for identity."""
    names = [*CONTRACTS[family].key, *columns]
    register(
        name,
        lambda m: typed_frame(m, family),
        text_spec({n: SPECS[family][n] for n in dict.fromkeys(names)}),
        f"SELECT * FROM silver_{family}",
    )


part("b1_typed_measures", "inpatient", "total_discharges", "average_total_payment", "average_medicare_payment")
part("b5_semantic_measure_names", "outpatient", "comprehensive_apc_services", "average_medicare_outlier_amount")
part("b6_trimmed_dimensions", "physician", "provider_middle_initial", "provider_street_address_2")
part("b7_unknown_bucket_dimensions", "physician_service", "provider_state_fips", "provider_ruca_code")
part("b8_missing_indicators", "physician_service", "provider_state_fips_is_missing", "provider_ruca_code_is_missing")
part("b9_token_suppression_status", "physician", "drug_suppression_status", "medical_suppression_status")
part("b10_null_suppression_status", "outpatient", *OUTPATIENT.null_groups)
part("b11_top_code_flags", "physician", "bene_cc_ph_diabetes_v2_pct_is_top_coded", "bene_cc_ph_cancer_v2_pct_is_top_coded")
part("b12_top_code_counts", "physician", "top_coded_metric_count")
part("b14_volume_bands", "inpatient", "discharge_volume_band")
part("b15_volume_bands_with_suppressed", "outpatient", "service_volume_band")
part("b17_relationship_flags", "outpatient", *[flag for flag, _, _ in OUTPATIENT.flags])
part("b18_country_safe_peers", "physician_service", "provider_geography_scope", "peer_state_fips", "peer_ruca_code")


def lineage_sql(family, contract):
    source = next(s for s, t in contract.dimensions.items() if t == contract.key[0])
    parts = []
    for column, indicator in contract.indicators.items():
        text = trimmed(column) if contract.trim_tokens else column
        tokens = ", ".join(f"'{t}'" for t in indicator.tokens)
        parts.append(
            f"SELECT {trimmed(source)} AS {contract.key[0]}, CAST(_reporting_year AS INTEGER) AS {contract.period}, "
            f"'{indicator.group}' AS measure_group, {column} AS source_indicator, "
            f"{case_token(column, contract, indicator, 'NULL')} AS suppression_status "
            f"FROM bronze_{family} WHERE {text} IN ({tokens})"
        )
    return " UNION ALL ".join(parts)


for family in ("physician", "part_d"):
    contract = CONTRACTS[family]
    SUBQUERIES[f"lineage_{family}"] = lineage_sql(family, contract)
    register(
        f"b21_{family}_suppression_lineage",
        lambda m, f=family: silver.suppression_lineage(bronze_frame(m, f), CONTRACTS[f]),
        f"{contract.key[0]}:text reporting_year:long measure_group:text source_indicator:text suppression_status:text",
        f"SELECT * FROM lineage_{family}",
    )

# -- geographic -------------------------------------------------------------------------------

GEO_MEASURES = {"BENES_TOTAL_CNT": True, "TOT_MDCR_PYMT_AMT": False, "BENE_FEML_PCT": False, "ACUTE_HOSP_READMSN_CNT": True}
GEO_ID = """CASE WHEN BENE_GEO_LVL = 'National' AND BENE_GEO_DESC = 'National' AND BENE_GEO_CD IS NULL THEN 'US'
  WHEN BENE_GEO_LVL = 'State' AND BENE_GEO_DESC = 'Territory' AND BENE_GEO_CD IS NULL THEN 'AGG_TERRITORY'
  WHEN BENE_GEO_LVL = 'State' AND BENE_GEO_DESC = 'ZZ' AND BENE_GEO_CD IS NULL THEN 'AGG_ZZ'
  WHEN BENE_GEO_LVL IN ('State', 'County') AND BENE_GEO_CD IS NOT NULL THEN upper(BENE_GEO_LVL) || ':' || BENE_GEO_CD
  END AS geography_id"""
GEO_KEY = f"""TRY_CAST(YEAR AS INTEGER) AS year, BENE_GEO_LVL AS geography_level, {GEO_ID},
  BENE_AGE_LVL AS beneficiary_age_level"""
geo_typed = ", ".join(
    f"CASE WHEN {trimmed(m)} NOT IN ('*', '', 'NA') THEN {typed(m, whole)} END AS {m.lower()}"
    for m, whole in GEO_MEASURES.items()
)
geo_count = lambda token: " + ".join(f"COALESCE(CAST({trimmed(m)} = '{token}' AS INTEGER), 0)" for m in GEO_MEASURES)
SUBQUERIES["silver_geographic"] = f"""
SELECT {GEO_KEY}, BENE_GEO_DESC AS geography_name, BENE_GEO_CD AS source_geography_code, {geo_typed},
  {geo_count('*')} AS suppressed_measure_count, {geo_count('NA')} AS not_applicable_measure_count,
  {', '.join(LINEAGE)} FROM bronze_geographic"""
GEO_SPEC = (
    "year:long geography_level:text geography_id:text beneficiary_age_level:text geography_name:text "
    "source_geography_code:text benes_total_cnt:long tot_mdcr_pymt_amt:num bene_feml_pct:num "
    "acute_hosp_readmsn_cnt:long suppressed_measure_count:long not_applicable_measure_count:long"
)


def geo(model):
    return silver.geographic_silver(bronze_frame(model, "geographic"))


GEO_ID_SPEC = "year:long geography_level:text geography_id:text beneficiary_age_level:text "
for name, spec in {
    "b30_geographic_silver": GEO_SPEC,
    "b2_token_aware_measures": GEO_ID_SPEC + "geography_name:text benes_total_cnt:long tot_mdcr_pymt_amt:num bene_feml_pct:num",
    "b4_suffix_typed_measures": GEO_ID_SPEC + "geography_name:text benes_total_cnt:long acute_hosp_readmsn_cnt:long",
    "b13_special_token_counts": GEO_ID_SPEC + "geography_name:text suppressed_measure_count:long not_applicable_measure_count:long",
    "b16_geography_identifiers": GEO_ID_SPEC + "geography_name:text source_geography_code:text",
}.items():
    register(name, geo, spec, "SELECT * FROM silver_geographic")
SUBQUERIES["geo_status"] = " UNION ALL ".join(
    f"SELECT {GEO_KEY}, '{m.lower()}' AS measure_name, {m} AS source_token, CASE {trimmed(m)} WHEN '*' THEN "
    f"'suppressed' ELSE 'not_applicable' END AS value_status FROM bronze_geographic WHERE {trimmed(m)} IN ('*', 'NA')"
    for m in GEO_MEASURES
)
register(
    "b20_value_status_long",
    lambda m: silver.geographic_value_status(bronze_frame(m, "geographic")),
    GEO_ID_SPEC + "measure_name:text source_token:text value_status:text",
    "SELECT * FROM geo_status",
)

# -- quality ----------------------------------------------------------------------------------


def count_rows(checks):
    """UNION ALL of (check, count) rows from {name: (table, predicate)}."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM {table} WHERE {test}"
        for name, (table, test) in checks.items()
    )


def summed(table, tests):
    return f"(SELECT unnest([{', '.join(tests)}]) AS hit FROM {table}) flags", "hit"


def silver_report_sql(family, contract):
    s, b = f"silver_{family}", f"bronze_{family}"
    measures = measures_of(family, contract)
    checks = {
        "unparseable_numbers": summed(b, [
            f"{m} IS NOT NULL AND {trimmed(m)} <> '' AND {typed(m, m in contract.integers)} IS NULL" for m in measures]),
        "fractional_counts": summed(b, [
            f"{typed(m, False)} % 1 <> 0" for m in measures if m in contract.integers]),
        "null_business_keys": (s, " OR ".join(f"{k} IS NULL" for k in contract.key)),
        "negative_measures": (s, " OR ".join(f"{contract.target(m)} < 0" for m in measures)),
        "unknown_periods": (s, f"{contract.period} NOT IN ({', '.join(map(str, contract.periods))})"),
    }
    if contract.indicators:
        wrong, detail = [], []
        for column, indicator in contract.indicators.items():
            text = trimmed(column) if contract.trim_tokens else column
            tokens = ", ".join(f"'{t}'" for t in indicator.tokens)
            names = indicator.measures or [c for c in BRONZE[family][1] if c.startswith(indicator.prefix) and c != column]
            empty = " AND ".join(f"{n} IS NULL" for n in names)
            full = " AND ".join(f"{n} IS NOT NULL" for n in names)
            wrong.append(f"{text} IS NOT NULL AND {text} NOT IN ({tokens})")
            detail.append(f"({text} IN ({tokens}) AND NOT ({empty})) OR ({text} IS NULL AND NOT ({full}))")
        checks["invalid_suppression_tokens"] = summed(b, wrong)
        checks["suppression_detail"] = summed(b, detail)
    for column, pattern in contract.patterns.items():
        test = f"NOT regexp_full_match({column}, '{pattern}')"
        checks[f"invalid_{column}"] = (s, f"{column} IS NULL OR {test}" if contract.null_breaks_pattern else test)
    for column, allowed in contract.domains.items():
        checks[f"outside_domain_{column}"] = (s, f"{column} NOT IN ({', '.join(repr(a) for a in allowed)})")
    if contract.minimum:
        checks["below_publication_minimum"] = (s, f"{contract.minimum[0]} < {contract.minimum[1]}")
    for low, high in contract.ordered:
        checks[f"{low}_above_{high}"] = (s, f"{low} > {high}")
    if contract.country:
        checks["foreign_peer_geography"] = (s, f"{contract.country} <> 'US' AND (peer_state_fips <> 'Not applicable' OR peer_ruca_code <> 'Not applicable')")
    ranges = []
    for m in measures:
        name = contract.target(m)
        if contract.top_coded_suffix and m.endswith(contract.top_coded_suffix):
            ranges.append(f"{name} < 0 OR {name} > 75")
        elif name.endswith("_rate"):
            ranges.append(f"{name} < 0 OR {name} > 100")
        elif name == "bene_avg_age":
            ranges.append(f"{name} < 0 OR {name} > 120")
        elif name == "bene_avg_risk_scre":
            checks["nonpositive_risk_score"] = (s, f"{name} <= 0")
    if ranges:
        checks["outside_range"] = (s, " OR ".join(f"({r})" for r in ranges))
    for target in contract.unknown:
        checks[f"observed_{target}_is_missing"] = (s, f"{target}_is_missing")
    for flag, _, _ in contract.flags:
        checks[f"observed_{flag}"] = (s, flag)
    for status in contract.null_groups:
        checks[f"observed_{status}_suppressed"] = (s, f"{status} = 'suppressed'")
    keys = ", ".join(contract.key)
    checks["duplicate_business_keys"] = (f"(SELECT 1 FROM {s} GROUP BY {keys} HAVING count(*) > 1) d", "TRUE")
    checks["row_count_difference"] = (s, "FALSE")
    checks["missing_periods"] = (
        f"(VALUES {', '.join(f'({p})' for p in contract.periods)}) v(p)", f"p NOT IN (SELECT {contract.period} FROM {s})")
    if contract.top_coded_suffix:
        checks["top_coding_difference"] = (s, "FALSE")
    if contract.indicators:
        checks["suppression_count_difference"] = (s, "FALSE")
    if len(contract.unknown) >= 2 and contract.key[0] == "hospital_ccn":
        checks["unpaired_missing_dimension"] = (s, " <> ".join(f"{t}_is_missing" for t in contract.unknown))
    return count_rows(checks)


def family_report(model, family, only=""):
    contract, bronze = CONTRACTS[family], bronze_frame(model, family)
    marks = silver.suppression_lineage(bronze, contract) if contract.indicators else None
    return silver_quality.silver_report(bronze, silver.typed_silver(bronze, contract), contract, marks, only)


for family, contract in CONTRACTS.items():
    SUBQUERIES[f"report_{family}"] = silver_report_sql(family, contract)
    register(f"h_{family}_silver_report", lambda m, f=family: family_report(m, f),
             "check_name:text violations:long", f"SELECT * FROM report_{family}")

# single checks of those reports, by inventory id
for name, family, prefix in (
    ("h1_row_count_preserved", "inpatient", "row_count"),
    ("h3_pattern_violations", "inpatient", "invalid_"),
    ("h4_domain_membership", "physician_service", "outside_domain"),
    ("h5_range_checks", "part_d", "outside_range"),
    ("h6_fractional_counts", "inpatient", "fractional"),
    ("h7_publication_minimum", "inpatient", "below_publication"),
    ("h8_cross_column_order", "outpatient", "average_medicare"),
    ("h9_suppression_detail_consistency", "physician", "suppression_detail"),
    ("h10_suppression_count_reconciliation", "part_d", "suppression_count"),
    ("h11_null_suppression_reconciliation", "outpatient", "observed_"),
    ("h12_top_coding_reconciliation", "physician", "top_coding"),
    ("h13_period_completeness", "outpatient", "missing_periods"),
    ("h14_paired_missing_dimensions", "inpatient", "unpaired"),
    ("h15_country_safe_peers", "physician_service", "foreign_peer"),
    ("c1_unparseable_numbers", "inpatient", "unparseable"),
):
    register(
        name,
        lambda m, f=family, p=prefix: family_report(m, f, p),
        "check_name:text violations:long",
        f"SELECT * FROM report_{family} WHERE check_name LIKE '{prefix}%'",
    )
register(
    "h2_duplicate_business_keys",
    lambda m: duplicate_keys("duplicate_geographies", geo(m), ["year", "geography_level", "geography_id", "beneficiary_age_level"]),
    "check_name:text violations:long",
    "SELECT 'duplicate_geographies' AS check_name, count(*) AS violations FROM (SELECT 1 FROM silver_geographic "
    "GROUP BY year, geography_level, geography_id, beneficiary_age_level HAVING count(*) > 1) d",
)
register(
    "h_geographic_silver_report",
    lambda m: silver_quality.geographic_report(bronze_frame(m, "geographic"), geo(m)),
    "check_name:text violations:long",
    count_rows({
        "unparseable_numbers": summed("bronze_geographic", [
            f"{m} IS NOT NULL AND {trimmed(m)} NOT IN ('*', '', 'NA') AND {typed(m, w)} IS NULL" for m, w in GEO_MEASURES.items()]),
        "null_business_keys": ("silver_geographic", "year IS NULL OR geography_level IS NULL OR geography_id IS NULL OR beneficiary_age_level IS NULL"),
        "negative_counts": ("silver_geographic", "benes_total_cnt < 0 OR acute_hosp_readmsn_cnt < 0"),
        "negative_payments": ("silver_geographic", "tot_mdcr_pymt_amt < 0"),
        "percentage_range": ("silver_geographic", "bene_feml_pct < 0 OR bene_feml_pct > 100"),
        "unknown_levels": ("silver_geographic", "geography_level NOT IN ('National', 'State', 'County')"),
        "unknown_ages": ("silver_geographic", "beneficiary_age_level NOT IN ('All', '<65', '>=65')"),
        "duplicate_business_keys": ("(SELECT 1 FROM silver_geographic GROUP BY year, geography_level, geography_id, beneficiary_age_level HAVING count(*) > 1) d", "TRUE"),
        "row_count_difference": ("silver_geographic", "FALSE"),
    }),
)
register(
    "e23_metric_null_summary",
    lambda m: silver_quality.metric_nulls(typed_frame(m, "part_d"), PART_D, measures_of("part_d", PART_D)),
    "measure_name:text null_count:long",
    " UNION ALL ".join(
        f"SELECT '{PART_D.target(m)}' AS measure_name, count(*) AS null_count FROM silver_part_d WHERE {PART_D.target(m)} IS NULL"
        for m in measures_of("part_d", PART_D)
    ),
)
register(
    "m5_public_columns",
    lambda m: silver.public_columns(typed_frame(m, "inpatient"), INPATIENT),
    text_spec({n: k for n, k in SPECS["inpatient"].items() if n not in INPATIENT.private}),
    "SELECT * FROM silver_inpatient",
)


# measures that are published or withheld together; a beneficiary count needs the summary
OUTPATIENT_GROUPS = {
    "summary": ("comprehensive_apc_services", "average_submitted_charge", "average_medicare_allowed_amount",
                "average_medicare_payment"),
    "beneficiaries": ("beneficiary_count",),
    "outliers": ("outlier_services", "average_medicare_outlier_amount"),
}
PRESENT = " + ".join(
    f"CASE WHEN {name} IS NULL THEN 0 ELSE {2 ** place} END"
    for place, name in enumerate(n for group in OUTPATIENT_GROUPS.values() for n in group)
)
register(
    "h11_null_patterns",
    lambda m: silver_quality.null_patterns(typed_frame(m, "outpatient"), OUTPATIENT_GROUPS, (("beneficiaries", "summary"),)),
    "mask:long row_count:long expected:bool",
    f"""SELECT mask, coalesce(n, 0) AS row_count, wanted IS NOT NULL AS expected
FROM (SELECT {PRESENT} AS mask, count(*) AS n FROM silver_outpatient GROUP BY 1) found
FULL JOIN (SELECT s * 15 + b * 16 + o * 96 AS mask, TRUE AS wanted
  FROM (VALUES (0), (1)) x(s), (VALUES (0), (1)) y(b), (VALUES (0), (1)) z(o) WHERE b <= s) allowed USING (mask)""",
)
