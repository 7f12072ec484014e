"""Star schema on a one-claim fixture, and mart arithmetic on hand-made facts."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from claimloom.errors import ContractError
from claimloom.plans import conformed, cost, integrity
from claimloom.plans.star import Star

D = Decimal
DAY = date(2026, 1, 10)
PAID = (D("100.00"), D("80.00"), D("10.00"))


def source(spark, billing="PRV1"):
    make = spark.createDataFrame
    header = ("logical string, logical_claim_id string, claim_version_number int, prior_claim_id string, member_id string, "
              "plan_id string, billing_provider_id string, rendering_provider_id string, claim_type string, "
              "claim_status string, service_from_date date, service_through_date date, received_date date, "
              "adjudication_date date, principal_diagnosis_code string, total_charge_amount decimal(18,2), "
              "total_allowed_amount decimal(18,2), total_member_liability_amount decimal(18,2)").replace("logical string", "claim_id string", 1)
    common = ("M1", "PLN1", billing, None, "professional")
    dates = (DAY, DAY, date(2026, 1, 12), date(2026, 1, 20), "I10")
    second = (DAY, DAY, date(2026, 1, 22), None, "I10")
    line = ("claim_line_id string, claim_id string, line_number int, rendering_provider_id string, service_code_system string, "
            "service_code string, service_date date, place_of_service_code string, units decimal(18,4), "
            "charge_amount decimal(18,2), allowed_amount decimal(18,2), member_liability_amount decimal(18,2)")
    return {
        "member": make([("M1", "ST")], "member_id string, state_code string"),
        "plan": make([("PLN1", "HMO")], "plan_id string, plan_type string"),
        "provider": make([("PRV1", "cardiology")], "provider_id string, specialty_group string"),
        "membership_month": make(
            [("M1", "PLN1", m, m, m, "active") for m in (date(2025, 12, 1), date(2026, 1, 1))],
            "member_id string, plan_id string, coverage_month date, coverage_start_date date, coverage_end_date date, coverage_status string"),
        "claim_header": make(
            [("C1V1", "L1", 1, None, *common, "paid", *dates, *PAID),
             ("C1V2", "L1", 2, "C1V1", *common, "adjusted", *second, D("120.00"), D("90.00"), D("10.00"))], header),
        "claim_line": make(
            [("LIN1", "C1V1", 1, None, "MS-DRG", "470", DAY, None, D("1"), *PAID),
             ("LIN2", "C1V2", 1, "PRV1", "HCPCS", "99213", DAY, "11", D("1"), D("120.00"), D("90.00"), D("10.00"))], line),
        "payment_transaction": make(
            [("PAY1", "C1V1", 1, date(2026, 1, 21), "payment", D("70.00"), None),
             ("PAY2", "C1V2", 1, date(2026, 1, 25), "payment", D("80.00"), "PAY1")],
            "payment_transaction_id string, claim_id string, transaction_sequence_number int, transaction_date date, "
            "transaction_type string, signed_transaction_amount decimal(18,2), reverses_transaction_id string"),
        "claim_review": make([("R1", "C1V1", "completed", DAY, date(2026, 2, 1), "amount"), ("R2", "C1V2", "queued", None, None, None)],
                             "review_id string, claim_id string, review_status string, selected_date date, completed_date date, selection_reason string"),
        "audit_outcome": make([("A1", "R1", "C1V1", "no_issue", D("0.00"), date(2026, 2, 1))],
                              "audit_id string, review_id string, claim_id string, outcome string, confirmed_amount decimal(18,2), outcome_date date"),
        "policy_assignment": make([("P1", "PRV1", "POL", "treated", date(2026, 1, 1), None)],
                                  "policy_assignment_id string, provider_id string, policy_id string, treatment_group string, assignment_start_date date, assignment_end_date date"),
        "anomaly_injection": make(
            [("INJ1", "PI010", "claim_header", "C1V2", "C1V2", None, None, "PRV1", date(2026, 1, 1), "claim", None, D("0.00"))],
            "injection_id string, rule_id string, target_table string, target_record_id string, claim_id string, claim_line_id string, "
            "payment_transaction_id string, provider_id string, reporting_period date, label_scope string, overlap_group string, expected_financial_exposure decimal(18,2)"),
    }


def test_star_resolves_keys_versions_and_ledger(spark):
    star = Star(source(spark), date(2026, 1, 1)).tables()
    claims = {r["claim_id"]: r for r in star["fact_claim"].collect()}
    assert [claims[c]["is_current_version"] for c in ("C1V1", "C1V2")] == [False, True]
    assert claims["C1V2"]["prior_claim_key"] == claims["C1V1"]["claim_key"] == 1
    assert (claims["C1V2"]["net_paid_amount"], claims["C1V2"]["line_count"]) == (D("80.00"), 1)
    assert claims["C1V2"]["adjudication_date_key"] is None and claims["C1V1"]["rendering_provider_key"] is None
    services = {r["service_code"]: r["service_category"] for r in star["dim_service"].collect()}
    assert services == {"470": "ms_drg", "99213": "hcpcs"}
    dates = star["dim_date"].orderBy("date_key").collect()
    assert [r["date_key"] for r in dates] == list(range(1, len(dates) + 1))
    assert {r["policy_period"] for r in dates if r["calendar_date"] < date(2026, 1, 1)} == {"pre_policy"}
    assert star["fact_payment_transaction"].filter("reverses_transaction_key = 1").count() == 1
    reviews = {r["review_id"]: (r["audit_outcome"], r["confirmed_amount"]) for r in star["fact_claim_review"].collect()}
    assert reviews == {"R1": ("no_issue", D("0.00")), "R2": (None, D("0.00"))}
    assert star["bridge_claim_anomaly"].first()["claim_key"] == 2
    facts = conformed.from_star({n: t for n, t in star.items() if n != "bridge_claim_anomaly"})
    assert facts.claims.count() == 2 and facts.lines.first()["service_date"] == DAY


def test_star_facts_build_only_what_is_asked_for(spark):
    built = []
    star = Star(source(spark), date(2026, 1, 1))
    unlabelled = star.lazy_tables([name for name in star.TABLES if name != "bridge_claim_anomaly"])
    facts = conformed.StarFacts(unlabelled, keep=lambda name, build: (built.append(name), build())[1])
    assert cost.monthly_payment_cash_flow(facts).count() == 1
    assert sorted(built) == ["claims", "payments"]
    assert not {"fact_claim_line", "fact_membership_month", "fact_claim_review"} & set(vars(star))
    other = conformed.replace(facts, lines=facts.payments)
    assert other.lines is facts.payments and "lines" not in built and "memberships" not in built
    whole = conformed.from_star({n: t for n, t in star.tables().items() if n != "bridge_claim_anomaly"})
    for name in ("claims", "lines", "payments", "memberships", "reviews", "assignments"):
        assert sorted(map(str, getattr(facts, name).collect())) == sorted(map(str, getattr(whole, name).collect()))
    with pytest.raises(ContractError):
        conformed.StarFacts(star.lazy_tables(star.TABLES))


def test_coverage_on_service_counts_months_years_and_nulls(spark):
    header = "member_id string, plan_id string, billing_provider_id string, service_from_date date"
    claims = [("M1", "P", "X", date(2025, 12, 31)), ("M1", "P", "X", date(2026, 1, 1)), ("M1", "P", "X", date(2026, 12, 1)),
              ("M1", "Q", "X", date(2026, 1, 5)), ("M2", "P", None, date(2026, 1, 5)), (None, "P", "X", date(2026, 1, 5)),
              ("M1", None, "X", date(2026, 1, 5)), ("M1", "P", "X", None), ("M3", "P", "X", date(2026, 2, 3))]
    months = [("M1", "P", date(2025, 12, 1)), ("M1", "P", date(2026, 1, 1)), ("M1", "P", date(2026, 1, 1)), (None, "P", date(2026, 1, 1)),
              ("M2", "P", None), ("M3", "P", date(2026, 2, 2))]
    make = spark.createDataFrame
    found = integrity.eligibility_checks({
        "claim_header": make(claims, header), "membership_month": make(months, "member_id string, plan_id string, coverage_month date"),
        "provider_contract": make([("X", "P")], "provider_id string, plan_id string")})
    # 2026-12, plan Q, M2 and M3 (covered from a day that begins no month); Q has no contract either
    assert {r["check_name"]: r["violations"] for r in found.collect()} == {"service_without_coverage": 4, "service_without_contract": 1}
    shuffled = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in shuffled


def test_unresolved_required_key_fails(spark):
    with pytest.raises(Exception, match="unresolved billing_provider_id: NOBODY"):
        Star(source(spark, billing="NOBODY"), date(2026, 1, 1)).fact_claim.collect()


def test_integrity_reports_on_the_fixture(spark):
    tables = source(spark)
    versions = {r["check_name"]: r["violations"] for r in integrity.version_checks(tables["claim_header"]).collect()}
    assert set(versions.values()) == {0}
    amounts = {r["check_name"]: r["violations"] for r in integrity.amount_checks(
        tables["claim_header"], tables["claim_line"], tables["payment_transaction"]).collect()}
    assert set(amounts.values()) == {0}
    broken = tables["claim_header"].withColumn("prior_claim_id", tables["claim_header"]["claim_id"])
    found = {r["check_name"]: r["violations"] for r in integrity.version_checks(broken).collect()}
    assert found["first_version_with_link"] == 1 and found["version_not_following"] == 2


def mart_facts(spark, with_exposure=True):
    make = spark.createDataFrame
    january, before = date(2026, 1, 1), date(2025, 1, 1)
    claims = [("C1", 1, january, 7, "paid", True, D("30.00"), D("20.00")), ("C2", 1, january, 8, "denied", True, D("5.00"), D("0.00")),
              ("C3", 1, before, 7, "paid", True, D("10.00"), D("10.00")), ("C0", 1, january, 7, "paid", False, D("99.00"), D("99.00"))]
    lines = [("C1", january, "S", "a", D("3"), D("30.00")), ("C2", january, "S", "a", D("9"), D("5.00")), ("C3", before, "S", "a", D("2"), D("10.00"))]
    months = [("active", january, 1)] * 3 + [("suspended", january, 1)] + ([("active", before, 1)] if with_exposure else [])
    payments = [("C1", "payment", D("20.00"), january), ("C0", "payment", D("99.00"), january), ("C0", "adjustment", D("-9.00"), january)]
    return conformed.Facts(
        claims=make(claims, "claim_id string, plan_key bigint, service_month date, billing_provider_key bigint, claim_status string, "
                            "is_current_version boolean, total_allowed_amount decimal(18,2), net_paid_amount decimal(18,2)"),
        lines=make(lines, "claim_id string, service_date date, service_code_system string, service_code string, units decimal(18,4), allowed_amount decimal(18,2)"),
        payments=make(payments, "claim_id string, transaction_type string, signed_transaction_amount decimal(18,2), transaction_date date"),
        memberships=make(months, "coverage_status string, coverage_month date, plan_key bigint"),
        reviews=None, assignments=None, service_categories=None,
    )


def test_monthly_cost_counts_current_claims_and_rounds_half_up(spark):
    rows = {r["service_month"]: r for r in cost.monthly_cost_utilization(mart_facts(spark)).collect()}
    now = rows[date(2026, 1, 1)]
    assert (now["eligible_member_months"], now["claim_count"], now["paid_claim_count"]) == (3, 2, 1)
    assert (now["allowed_pmpm"], now["paid_pmpm"], now["claims_per_1000"]) == (D("10.0000"), D("6.6667"), D("666.6667"))
    assert now["units_per_1000"] == D("1000.0000") and now["allowed_per_claim"] == D("30.0000")


def test_claims_without_exposure_fail(spark):
    with pytest.raises(Exception, match="without member exposure"):
        cost.monthly_cost_utilization(mart_facts(spark, with_exposure=False)).collect()


def test_cash_flow_covers_all_versions_and_other_types_count_as_reversals(spark):
    row = cost.monthly_payment_cash_flow(mart_facts(spark)).first()
    assert (row["transaction_count"], row["payment_count"], row["reversal_count"], row["net_payment_cash_flow"]) == (3, 2, 1, D("110.00"))


def test_decomposition_adds_up(spark):
    row = cost.cost_change_decomposition(mart_facts(spark)).first()
    # price 5 -> 10, units 2 -> 3
    assert (row["price_effect"], row["utilization_effect"], row["mix_effect"]) == (D("10.00"), D("5.00"), D("5.00"))
    assert row["total_cost_change"] == D("20.00") and row["reconciliation_residual"] == 0


def test_early_warning_uses_median_and_deviation_of_the_past(spark):
    values = [10, 11, 10, 12, 11, 10, 40, 10]
    rows = [(date(2025, i + 1, 1), 1, 500, *[D(v)] * 4) for i, v in enumerate(values)]
    table = spark.createDataFrame(rows, "service_month date, plan_key bigint, eligible_member_months bigint, allowed_pmpm decimal(18,4), "
                                  "paid_pmpm decimal(18,4), claims_per_1000 decimal(18,4), units_per_1000 decimal(18,4)")
    signals = {r["service_month"].month: r for r in cost.early_warning_signals(table).filter("metric_name = 'paid_pmpm'").collect()}
    assert signals[6]["signal_status"] == "insufficient_history" and signals[6]["baseline_median"] is None
    hit = signals[7]
    assert (hit["baseline_median"], hit["baseline_mad"], hit["signal_status"]) == (D("10.5000"), D("0.5000"), "warning")
    assert (hit["robust_z_score"], hit["relative_change"]) == (D("59.0000"), D("2.8095"))
    assert signals[8]["signal_status"] == "normal"
    thin = cost.early_warning_signals(table.withColumn("eligible_member_months", table["plan_key"]))
    assert {r["signal_status"] for r in thin.collect()} == {"insufficient_history"}


def test_constant_history_has_no_scale(spark):
    rows = [(date(2025, i + 1, 1), 1, 500, *[D("5")] * 4) for i in range(7)]
    table = spark.createDataFrame(rows, "service_month date, plan_key bigint, eligible_member_months bigint, allowed_pmpm decimal(18,4), "
                                  "paid_pmpm decimal(18,4), claims_per_1000 decimal(18,4), units_per_1000 decimal(18,4)")
    last = cost.early_warning_signals(table).filter("service_month = '2025-07-01'").first()
    assert last["robust_z_score"] is None and last["signal_status"] == "normal"


def test_rows_without_a_reference_are_dealt_out(spark):
    from pyspark.sql import functions as F

    frame = spark.range(4000).selectExpr("concat('C', id) AS claim_id", "IF(id % 4 = 0, concat('C', id + 1), NULL) AS prior")
    keys = spark.range(3000).selectExpr("concat('C', id) AS claim_id", "id AS claim_key")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = Star({}, date(2000, 1, 1))._look_up(frame, keys, "claim_id", "prior", "prior_key", False)
        assert found.columns == ["claim_id", "prior", "prior_key"]
        assert {r["claim_id"]: r["prior_key"] for r in found.collect()} == {
            f"C{i}": i + 1 if i % 4 == 0 and i < 2999 else None for i in range(4000)}
        most = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 1000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
