"""Silver projections on small text fixtures, including the failing variants."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from claimloom.contracts.silver import GEOGRAPHIC, INPATIENT, LINEAGE, OUTPATIENT, PHYSICIAN
from claimloom.errors import ContractError
from claimloom.operators import quality
from claimloom.plans import silver, silver_quality


def table(spark, contract, rows, extra=()):
    names = [*contract.dimensions, *extra, *LINEAGE]
    default = dict(zip(contract.dimensions, ["123456"] * 99))
    default |= {"DRG_Cd": "470", "APC_Cd": "5012", "Rndrng_Prvdr_State_FIPS": "06", "Rndrng_Prvdr_Zip5": "90210"}
    data = []
    for place, row in enumerate(rows):
        full = {**default, "_source_id": "s", "_source_file": "f.csv", "_acquired_at_utc": "t",
                "_reporting_year": contract.periods[place % len(contract.periods)], **row}
        data.append(tuple(None if full.get(n) is None else full[n] for n in names))
    schema = ", ".join(f"`{n}` {'int' if n == '_reporting_year' else 'string'}" for n in names)
    return spark.createDataFrame(data, schema)


INPATIENT_MEASURES = (*INPATIENT.integers, *INPATIENT.decimals)


def inpatient(spark, **changes):
    rows = [
        {"Tot_Dschrgs": d, "Avg_Submtd_Cvrd_Chrg": "1000", "Avg_Tot_Pymt_Amt": pay, "Avg_Mdcr_Pymt_Amt": "400.5",
         "Rndrng_Prvdr_RUCA": "1", "Rndrng_Prvdr_RUCA_Desc": "Metro"}
        for d, pay in (("11", "500"), ("14", "2000"), ("21", "500"), ("36", "500"), ("50", "500"), ("100", "500"))
    ]
    rows[2] |= {"Rndrng_Prvdr_RUCA": None, "Rndrng_Prvdr_RUCA_Desc": " "}
    rows[0] |= changes
    return table(spark, INPATIENT, rows, INPATIENT_MEASURES)


def report(bronze, contract):
    typed = silver.typed_silver(bronze, contract)
    return {r["check_name"]: r["violations"] for r in silver_quality.silver_report(bronze, typed, contract).collect()}


def test_inpatient_bands_flags_and_missing_dimensions(spark):
    typed = silver.typed_silver(inpatient(spark), INPATIENT).orderBy("reporting_year").collect()
    assert [r["discharge_volume_band"] for r in typed] == ["low", "medium", "high", "very_high", "very_high", "very_high"]
    assert [r["total_payment_above_covered_charge"] for r in typed] == [False, True] + [False] * 4
    assert (typed[2]["hospital_ruca_code"], typed[2]["hospital_ruca_code_is_missing"]) == ("Unknown", True)
    found = report(inpatient(spark), INPATIENT)
    assert {n: v for n, v in found.items() if v and not n.startswith("observed_")} == {}
    assert found["observed_hospital_ruca_code_is_missing"] == 1


@pytest.mark.parametrize(
    "changes, check",
    [
        ({"Tot_Dschrgs": "not-a-number"}, "unparseable_numbers"),
        ({"Tot_Dschrgs": "12.5"}, "fractional_counts"),
        ({"Tot_Dschrgs": "10"}, "below_publication_minimum"),
        ({"Avg_Mdcr_Pymt_Amt": "900"}, "average_medicare_payment_above_average_total_payment"),
        ({"Avg_Mdcr_Pymt_Amt": "-1"}, "negative_measures"),
        ({"DRG_Cd": "47"}, "invalid_ms_drg_code"),
        ({"Rndrng_Prvdr_CCN": " "}, "null_business_keys"),
        ({"_reporting_year": 2031}, "missing_periods"),
        ({"Rndrng_Prvdr_RUCA": None}, "unpaired_missing_dimension"),
    ],
)
def test_inpatient_violations_are_counted(spark, changes, check):
    assert report(inpatient(spark, **changes), INPATIENT)[check] == 1


def test_schema_drift_is_refused(spark):
    with pytest.raises(ContractError, match="DRG_Cd"):
        silver.typed_silver(inpatient(spark).drop("DRG_Cd"), INPATIENT)
    with pytest.raises(ContractError, match="Extra"):
        silver.typed_silver(inpatient(spark).withColumn("Extra", F.lit("1")), INPATIENT)
    assert silver_quality.schema_drift(inpatient(spark), INPATIENT, 15) == []
    assert silver_quality.schema_drift(inpatient(spark), INPATIENT, 16)
    assert silver.missing_columns(inpatient(spark).drop("DRG_Cd"), [*INPATIENT.dimensions]) == ["DRG_Cd"]


def test_outpatient_suppression_by_nulls(spark):
    measures = (*OUTPATIENT.integers, *OUTPATIENT.decimals)
    full = dict(zip(measures, ["12", "25", "11", "300", "200", "150", "170"]))
    rows = [full, dict.fromkeys(measures), {**full, "Bene_Cnt": None, "Outlier_Srvcs": None, "Avg_Mdcr_Outlier_Amt": None}]
    typed = silver.typed_silver(table(spark, OUTPATIENT, rows, measures), OUTPATIENT).orderBy("reporting_period").collect()
    status = [tuple(r[s] for s in OUTPATIENT.null_groups) for r in typed]
    assert status == [("published",) * 3, ("suppressed",) * 3, ("published", "suppressed", "suppressed")]
    assert [r["service_volume_band"] for r in typed] == ["medium", "suppressed", "medium"]
    assert [r["outlier_amount_above_regular_payment"] for r in typed] == [True, None, None]


PHYSICIAN_MEASURES = ("Tot_Benes", "Drug_Tot_Benes", "Drug_Pymt", "Med_Tot_Benes", "Bene_CC_A_Pct", "Bene_Avg_Risk_Scre")


def physician(spark, **changes):
    base = dict(zip(PHYSICIAN_MEASURES, ["25", "12", "3.5", "13", "40", "1.1"]))
    rows = [{**base, "Rndrng_NPI": f"{n:010d}", "Drug_Sprsn_Ind": None, "Med_Sprsn_Ind": None} for n in range(6)]
    rows[1] |= {"Drug_Sprsn_Ind": "*", "Drug_Tot_Benes": None, "Drug_Pymt": None, "Bene_CC_A_Pct": "75"}
    rows[2] |= {"Med_Sprsn_Ind": "#", "Med_Tot_Benes": None, "Tot_Benes": "1250"}
    rows[0] |= changes
    return table(spark, PHYSICIAN, rows, (*PHYSICIAN_MEASURES, *PHYSICIAN.indicators))


def physician_report(bronze):
    typed = silver.typed_silver(bronze, PHYSICIAN)
    lineage = silver.suppression_lineage(bronze, PHYSICIAN)
    return {r["check_name"]: r["violations"] for r in silver_quality.silver_report(bronze, typed, PHYSICIAN, lineage).collect()}


def test_physician_suppression_and_top_coding(spark):
    bronze = physician(spark)
    typed = silver.typed_silver(bronze, PHYSICIAN).orderBy("provider_npi").collect()
    assert [r["drug_suppression_status"] for r in typed[:3]] == ["not_suppressed", "primary_suppressed_fewer_than_11", "not_suppressed"]
    assert (typed[1]["bene_cc_a_pct_is_top_coded"], typed[1]["top_coded_metric_count"]) == (True, 1)
    assert typed[2]["provider_size_band"] == "very_large"
    lineage = {(r["measure_group"], r["source_indicator"]) for r in silver.suppression_lineage(bronze, PHYSICIAN).collect()}
    assert lineage == {("drug", "*"), ("medical", "#")}
    assert {n for n, v in physician_report(bronze).items() if v} == set()


@pytest.mark.parametrize(
    "changes, check",
    [
        ({"Drug_Sprsn_Ind": "*"}, "suppression_detail"),
        ({"Med_Tot_Benes": None}, "suppression_detail"),
        ({"Drug_Sprsn_Ind": "?", }, "invalid_suppression_tokens"),
        ({"Drug_Sprsn_Ind": "?", }, "suppression_count_difference"),
        ({"Bene_CC_A_Pct": "76"}, "outside_range"),
        ({"Bene_Avg_Risk_Scre": "0"}, "nonpositive_risk_score"),
        ({"Rndrng_NPI": "12"}, "invalid_provider_npi"),
    ],
)
def test_physician_violations_are_counted(spark, changes, check):
    assert physician_report(physician(spark, **changes))[check] == 1


def test_geographic_identifiers_tokens_and_statuses(spark):
    rows = [("2014", "National", "National", None, "All", "*", "10.5"), ("2015", "State", "Territory", None, "<65", " NA ", ""),
            ("2016", "County", "Place", "01001", ">=65", "12", "x"), ("2017", "County", "Place", None, "All", "-1", "3")]
    bronze = spark.createDataFrame(
        [(*r, "s", 2014, "f", "t") for r in rows],
        "YEAR string, BENE_GEO_LVL string, BENE_GEO_DESC string, BENE_GEO_CD string, BENE_AGE_LVL string, "
        "BENES_TOTAL_CNT string, TOT_MDCR_PYMT_AMT string, _source_id string, _reporting_year int, _source_file string, _acquired_at_utc string")
    typed = silver.geographic_silver(bronze).orderBy("year").collect()
    assert [r["geography_id"] for r in typed] == ["US", "AGG_TERRITORY", "COUNTY:01001", None]
    assert [r["benes_total_cnt"] for r in typed] == [None, None, 12, -1]
    assert [(r["suppressed_measure_count"], r["not_applicable_measure_count"]) for r in typed] == [(1, 0), (0, 1), (0, 0), (0, 0)]
    statuses = sorted((r["measure_name"], r["value_status"]) for r in silver.geographic_value_status(bronze).collect())
    assert statuses == [("benes_total_cnt", "not_applicable"), ("benes_total_cnt", "suppressed")]
    found = {r["check_name"]: r["violations"] for r in silver_quality.geographic_report(bronze, silver.geographic_silver(bronze)).collect()}
    assert (found["unparseable_numbers"], found["null_business_keys"], found["negative_counts"]) == (1, 1, 1)
    assert dataclasses.asdict(GEOGRAPHIC)["years"][0] == 2014


def test_reports_can_be_required(spark):
    checks = spark.createDataFrame([("a", 0), ("b", 2)], "check_name string, violations bigint")
    with pytest.raises(ContractError, match="b=2"):
        quality.require_passed(checks)
    quality.require_passed(checks.filter("check_name = 'a'"))
    with pytest.raises(ContractError, match="'c'"):
        quality.require_check_set(checks, {"a", "b", "c"})


def test_null_patterns_against_expected_masks(spark):
    groups, requires = {"one": ("a", "b"), "two": ("c",)}, (("two", "one"),)
    assert silver_quality.expected_masks(groups, requires) == [0, 3, 7]
    rows = spark.createDataFrame([(1, 1, 1), (1, 1, None), (1, 1, None), (1, None, 1)], "a int, b int, c int")
    found = {r["mask"]: (r["row_count"], r["expected"]) for r in silver_quality.null_patterns(rows, groups, requires).collect()}
    assert found == {0: (0, True), 3: (2, True), 7: (1, True), 5: (1, False)}
    assert all(not r["row_count"] for r in silver_quality.null_patterns(rows.limit(0), groups, requires).collect())
