"""Star-schema tables, keys and version operators."""

from datetime import date

from checks.oracle_base import SUBQUERIES
from checks.registry import register
from claimloom.operators.keys import dense_keys, number_within
from claimloom.plans import conformed
from claimloom.plans.star import Star


def star_of(model):
    return Star(model.tables(), date(2000, 1, 1), model.service_categories, layers=model.layers)


def key_sql(table: str, business_key: str, key: str) -> str:
    return f"SELECT {business_key}, row_number() OVER (ORDER BY {business_key}) AS {key} FROM {table}"


SUBQUERIES["k_member"] = key_sql("op_member", "member_id", "member_key")
SUBQUERIES["k_claim"] = key_sql("op_claim_header", "claim_id", "claim_key")
SUBQUERIES["k_line"] = key_sql("op_claim_line", "claim_line_id", "claim_line_key")
SUBQUERIES["k_payment"] = key_sql("op_payment_transaction", "payment_transaction_id", "payment_transaction_key")
SUBQUERIES["k_service"] = """
SELECT *, row_number() OVER (ORDER BY service_code_system, service_code) AS service_key
FROM (SELECT DISTINCT service_code_system, service_code FROM op_claim_line) pairs"""
SUBQUERIES["dim_date"] = """
SELECT row_number() OVER (ORDER BY calendar_date) AS date_key, calendar_date,
  year(calendar_date) AS calendar_year, quarter(calendar_date) AS calendar_quarter,
  month(calendar_date) AS calendar_month, CAST(date_trunc('month', calendar_date) AS DATE) AS month_start_date,
  strftime(calendar_date, '%Y-%m') AS year_month,
  CASE WHEN calendar_date >= DATE '2000-01-01' THEN 'post_policy' ELSE 'pre_policy' END AS policy_period
FROM (
  SELECT coverage_month AS calendar_date FROM op_membership_month
  UNION SELECT coverage_end_date FROM op_membership_month
  UNION SELECT service_from_date FROM op_claim_header UNION SELECT service_through_date FROM op_claim_header
  UNION SELECT received_date FROM op_claim_header UNION SELECT adjudication_date FROM op_claim_header
  UNION SELECT service_date FROM op_claim_line UNION SELECT transaction_date FROM op_payment_transaction
  UNION SELECT selected_date FROM op_claim_review UNION SELECT completed_date FROM op_claim_review
  UNION SELECT outcome_date FROM op_audit_outcome
  UNION SELECT assignment_start_date FROM op_policy_assignment
  UNION SELECT assignment_end_date FROM op_policy_assignment
  UNION SELECT reporting_period FROM op_anomaly_injection) used
WHERE calendar_date IS NOT NULL"""
SUBQUERIES["dim_service"] = """
SELECT service_key, service_code_system, service_code,
  coalesce(mapped, lower(replace(service_code_system, '-', '_'))) AS service_category
FROM k_service LEFT JOIN k_category USING (service_code)"""
SUBQUERIES["fact_membership_month"] = """
SELECT row_number() OVER (ORDER BY member_id, plan_id, coverage_month) AS membership_month_key, member_key,
  plan_key, date_key AS coverage_month_date_key, member_id, plan_id, coverage_month, coverage_status
FROM op_membership_month JOIN k_member USING (member_id) JOIN k_plan USING (plan_id)
JOIN dim_date ON coverage_month = calendar_date"""
SUBQUERIES["fact_claim"] = """
SELECT c.claim_key, p.claim_key AS prior_claim_key, member_key, f.plan_key, f.billing_provider_key,
  r.provider_key AS rendering_provider_key, d1.date_key AS service_date_key,
  d2.date_key AS service_through_date_key, d3.date_key AS received_date_key,
  d4.date_key AS adjudication_date_key, f.claim_id, f.logical_claim_id, f.claim_version_number,
  f.prior_claim_id, f.claim_type, f.claim_status, f.principal_diagnosis_code, f.is_current_version,
  f.total_charge_amount, f.total_allowed_amount, f.total_member_liability_amount, f.net_paid_amount,
  coalesce(line_count, 0) AS line_count
FROM f_claims f JOIN k_claim c ON c.claim_id = f.claim_id LEFT JOIN k_claim p ON p.claim_id = f.prior_claim_id
JOIN k_member m ON m.member_id = f.member_id
LEFT JOIN k_provider r ON r.provider_id = f.rendering_provider_id
LEFT JOIN (SELECT claim_id, count(*) AS line_count FROM op_claim_line GROUP BY claim_id) l
  ON l.claim_id = f.claim_id
LEFT JOIN dim_date d1 ON d1.calendar_date = f.service_from_date
LEFT JOIN dim_date d2 ON d2.calendar_date = f.service_through_date
LEFT JOIN dim_date d3 ON d3.calendar_date = f.received_date
LEFT JOIN dim_date d4 ON d4.calendar_date = f.adjudication_date"""
SUBQUERIES["fact_claim_line"] = """
SELECT claim_line_key, claim_key, provider_key AS rendering_provider_key, service_key,
  date_key AS service_date_key, l.claim_line_id, l.claim_id, line_number, place_of_service_code, units,
  charge_amount, allowed_amount, member_liability_amount,
  allowed_amount - member_liability_amount AS plan_paid_amount
FROM op_claim_line l JOIN k_line USING (claim_line_id) JOIN k_claim c ON c.claim_id = l.claim_id
LEFT JOIN k_provider r ON r.provider_id = rendering_provider_id
JOIN k_service s ON s.service_code_system = l.service_code_system AND s.service_code = l.service_code
JOIN dim_date ON service_date = calendar_date"""
SUBQUERIES["fact_payment_transaction"] = """
SELECT k.payment_transaction_key, claim_key, date_key AS transaction_date_key,
  v.payment_transaction_key AS reverses_transaction_key, t.payment_transaction_id, t.claim_id,
  transaction_sequence_number, transaction_type, signed_transaction_amount, reverses_transaction_id
FROM op_payment_transaction t JOIN k_payment k ON k.payment_transaction_id = t.payment_transaction_id
JOIN k_claim c ON c.claim_id = t.claim_id
LEFT JOIN k_payment v ON v.payment_transaction_id = t.reverses_transaction_id
JOIN dim_date ON transaction_date = calendar_date"""
SUBQUERIES["fact_claim_review"] = """
SELECT row_number() OVER (ORDER BY r.review_id) AS review_key, claim_key, d1.date_key AS selected_date_key,
  d2.date_key AS completed_date_key, d3.date_key AS audit_outcome_date_key, r.review_id, r.claim_id,
  review_status, selection_reason, outcome AS audit_outcome, coalesce(confirmed_amount, 0) AS confirmed_amount
FROM op_claim_review r LEFT JOIN op_audit_outcome a ON a.review_id = r.review_id
JOIN k_claim c ON c.claim_id = r.claim_id
LEFT JOIN dim_date d1 ON d1.calendar_date = selected_date
LEFT JOIN dim_date d2 ON d2.calendar_date = completed_date
LEFT JOIN dim_date d3 ON d3.calendar_date = outcome_date"""
SUBQUERIES["bridge_provider_policy"] = """
SELECT row_number() OVER (ORDER BY policy_assignment_id) AS provider_policy_key, provider_key,
  d1.date_key AS assignment_start_date_key, d2.date_key AS assignment_end_date_key, policy_assignment_id,
  policy_id, treatment_group
FROM op_policy_assignment JOIN k_provider USING (provider_id)
LEFT JOIN dim_date d1 ON d1.calendar_date = assignment_start_date
LEFT JOIN dim_date d2 ON d2.calendar_date = assignment_end_date"""
SUBQUERIES["bridge_claim_anomaly"] = """
SELECT row_number() OVER (ORDER BY injection_id) AS anomaly_injection_key, c.claim_key, l.claim_line_key,
  payment_transaction_key, date_key AS reporting_period_date_key, injection_id,
  rule_id, label_scope, target_table, target_record_id, provider_id, expected_financial_exposure,
  TRUE AS evaluation_only
FROM op_anomaly_injection a LEFT JOIN k_claim c ON c.claim_id = a.claim_id
LEFT JOIN k_line l ON l.claim_line_id = a.claim_line_id
LEFT JOIN k_payment p ON p.payment_transaction_id = a.payment_transaction_id LEFT JOIN dim_date ON reporting_period = calendar_date"""

SPECS = {
    "i1_dim_member": ("dim_member", "member_key:long member_id:text birth_year:long sex_code:text state_code:text",
                      "SELECT * FROM k_member JOIN op_member USING (member_id)"),
    "i1_dim_provider": ("dim_provider", "provider_key:long provider_id:text provider_entity_type:text "
                        "specialty_group:text",
                        "SELECT * FROM (SELECT provider_id, provider_key FROM k_provider) k "
                        "JOIN op_provider USING (provider_id)"),
    "i1_dim_plan": ("dim_plan", "plan_key:long plan_id:text plan_type:text effective_date:date",
                    "SELECT * FROM k_plan JOIN op_plan USING (plan_id)"),
    "i2_dim_date": ("dim_date", "date_key:long calendar_date:date calendar_year:long calendar_quarter:long "
                    "calendar_month:long month_start_date:date year_month:text policy_period:text", None),
    "i3_dim_service": ("dim_service", "service_key:long service_code_system:text service_code:text "
                       "service_category:text", None),
    "i4_fact_membership_month": ("fact_membership_month", "membership_month_key:long member_key:long "
                                 "plan_key:long coverage_month_date_key:long member_id:text plan_id:text "
                                 "coverage_month:date coverage_status:text", None),
    "i5_fact_claim": ("fact_claim", "claim_key:long prior_claim_key:long member_key:long plan_key:long "
                      "billing_provider_key:long rendering_provider_key:long service_date_key:long "
                      "service_through_date_key:long received_date_key:long adjudication_date_key:long "
                      "claim_id:text logical_claim_id:text claim_version_number:long prior_claim_id:text "
                      "claim_type:text claim_status:text principal_diagnosis_code:text "
                      "is_current_version:bool total_charge_amount:num total_allowed_amount:num "
                      "total_member_liability_amount:num net_paid_amount:num line_count:long", None),
    "i6_fact_claim_line": ("fact_claim_line", "claim_line_key:long claim_key:long rendering_provider_key:long "
                           "service_key:long service_date_key:long claim_line_id:text claim_id:text "
                           "line_number:long place_of_service_code:text units:num charge_amount:num "
                           "allowed_amount:num member_liability_amount:num plan_paid_amount:num", None),
    "i7_fact_payment_transaction": ("fact_payment_transaction", "payment_transaction_key:long claim_key:long "
                                    "transaction_date_key:long reverses_transaction_key:long "
                                    "payment_transaction_id:text transaction_sequence_number:long "
                                    "transaction_type:text signed_transaction_amount:num", None),
    "i8_fact_claim_review": ("fact_claim_review", "review_key:long claim_key:long selected_date_key:long "
                             "completed_date_key:long audit_outcome_date_key:long review_id:text "
                             "review_status:text audit_outcome:text confirmed_amount:num", None),
    "i9_bridge_provider_policy": ("bridge_provider_policy", "provider_policy_key:long provider_key:long "
                                  "assignment_start_date_key:long assignment_end_date_key:long "
                                  "policy_assignment_id:text treatment_group:text", None),
    "i10_bridge_claim_anomaly": ("bridge_claim_anomaly", "anomaly_injection_key:long claim_key:long "
                                 "claim_line_key:long payment_transaction_key:long "
                                 "reporting_period_date_key:long injection_id:text rule_id:text "
                                 "label_scope:text expected_financial_exposure:num evaluation_only:bool", None),
}
for name, (table, spec, sql) in SPECS.items():
    register(name, lambda m, table=table: getattr(star_of(m), table), spec, sql or f"SELECT * FROM {table}")

register(
    "g1_dense_claim_keys",
    lambda m: dense_keys(m.claim_header, ["claim_id"], "claim_key"),
    "claim_id:text claim_key:long",
    "SELECT * FROM k_claim",
)
register(
    "f1_current_claim_version",
    lambda m: conformed.with_current_flag(m.claim_header),
    "claim_id:text logical_claim_id:text claim_version_number:long is_current_version:bool",
    "SELECT * FROM f_claims",
)
register(
    "d7_prior_version_link",
    lambda m: m.claim_header.filter("prior_claim_id is not null").alias("n").join(
        m.claim_header.alias("o"), on=[m_col("n.prior_claim_id") == m_col("o.claim_id")]
    ).selectExpr(
        "n.claim_id", "n.prior_claim_id", "n.logical_claim_id = o.logical_claim_id as same_logical_claim",
        "o.claim_version_number + 1 = n.claim_version_number as next_version",
    ),
    "claim_id:text prior_claim_id:text same_logical_claim:bool next_version:bool",
    "SELECT n.claim_id, n.prior_claim_id, n.logical_claim_id = o.logical_claim_id AS same_logical_claim, "
    "o.claim_version_number + 1 = n.claim_version_number AS next_version "
    "FROM op_claim_header n JOIN op_claim_header o ON n.prior_claim_id = o.claim_id",
)


def m_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


register(
    "g2_line_numbers_hot_path",
    lambda m: number_within(
        m.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                                  "l_extendedprice", "l_quantity"),
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"],
        "line_number"),
    "l_orderkey:long l_linenumber:long l_partkey:long l_suppkey:long line_number:long",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, line_number FROM w_numbered",
)
