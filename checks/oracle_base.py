"""DuckDB text of the operational claims tables, as reusable named sub-queries.

``compose`` puts the sub-queries a statement mentions (and what those mention) in front of it.
"""

from __future__ import annotations

import re


def pad(prefix: str, number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, greatest(length({text}), {width})::INTEGER, '0')"


def member(number: str) -> str:
    return pad("MBR", number, 12)


def provider(number: str) -> str:
    return pad("PRV", number, 10)


def claim(number: str) -> str:
    return pad("CLM", number, 12)


def line(prefix: str, order: str, number: str) -> str:
    return f"{pad(prefix, order, 12)} || {pad('', number, 6)}"


EXACT = "(l_orderkey % 61 = 7)"
NEAR = "(l_orderkey % 67 = 11 AND l_orderkey % 61 <> 7)"

SUBQUERIES: dict[str, str] = {}

SUBQUERIES["op_member"] = f"""
SELECT {member('c_custkey')} AS member_id, CAST(1940 + c_custkey % 60 AS SMALLINT) AS birth_year,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex_code, n_name AS state_code,
  TRUE AS synthetic_record
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

SUBQUERIES["op_provider"] = f"""
SELECT {provider('s_suppkey')} AS provider_id,
  CASE WHEN s_suppkey % 3 = 0 THEN 'organization' ELSE 'individual' END AS provider_entity_type,
  n_name AS specialty_group, r_name AS state_code, 'warehouse' AS calibration_source_id,
  '1' AS calibration_version, TRUE AS synthetic_record
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

SUBQUERIES["op_plan"] = """
SELECT DISTINCT c_mktsegment AS plan_id,
  CASE WHEN c_mktsegment < 'H' THEN 'HMO' ELSE 'PPO' END AS plan_type, 'medical' AS product_line,
  DATE '1995-01-01' AS effective_date, CAST(NULL AS DATE) AS termination_date
FROM customer"""

SUBQUERIES["op_provider_contract"] = f"""
SELECT {provider('s_suppkey')} || '-' || segment AS contract_id, {provider('s_suppkey')} AS provider_id,
  segment AS plan_id, DATE '1995-01-01' AS effective_date, CAST(NULL AS DATE) AS termination_date,
  'fee_schedule' AS reimbursement_method
FROM supplier, (SELECT DISTINCT c_mktsegment AS segment FROM customer WHERE c_mktsegment IS NOT NULL) v
WHERE (s_suppkey + length(segment)) % 7 <> 0"""

SUBQUERIES["op_membership_month"] = f"""
SELECT {member('c_custkey')} AS member_id, c_mktsegment AS plan_id, coverage_month,
  coverage_month AS coverage_start_date, last_day(coverage_month) AS coverage_end_date,
  CASE WHEN (c_custkey + 3 * month_index) % 17 = 0 THEN 'suspended' ELSE 'active' END AS coverage_status
FROM customer, (
  SELECT CAST(i AS INTEGER) AS month_index,
    CAST(DATE '1995-01-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS coverage_month
  FROM (SELECT unnest(range(start, stop)) AS i FROM (
    SELECT least(0, min(m)) AS start, greatest(79, max(m)) + 1 AS stop
    FROM (SELECT datediff('month', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS m FROM orders) o) b) r) months
WHERE (c_custkey + month_index) % 10 <> 0"""

SUBQUERIES["op_policy_assignment"] = f"""
SELECT {pad('POL', 's_suppkey', 10)} AS policy_assignment_id, {provider('s_suppkey')} AS provider_id,
  'POLICY_2000_REVIEW' AS policy_id,
  CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'treated' ELSE 'comparison' END AS treatment_group,
  DATE '2000-01-01' AS assignment_start_date, DATE '2000-06-30' AS assignment_end_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

SUBQUERIES["w_orders"] = """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS service_from_date,
  CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'denied' ELSE 'adjusted' END AS claim_status
FROM orders"""

SUBQUERIES["w_numbered"] = """
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_shipdate, l_extendedprice, l_quantity) AS line_number,
  count(*) OVER (PARTITION BY l_orderkey) AS order_lines
FROM lineitem"""

SUBQUERIES["w_lines"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS ship_date, line_number,
  units, charge_amount, allowed_amount,
  CAST(round(allowed_amount * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS member_liability_amount
FROM (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS charge_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
      * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS allowed_amount
  FROM (
    SELECT * EXCLUDE (line_number), line_number, CAST(l_quantity AS DECIMAL(18,4)) AS units FROM w_numbered
    UNION ALL
    SELECT * EXCLUDE (line_number), order_lines + 1 AS line_number,
      CAST(CAST(l_quantity AS DECIMAL(18,4)) + CASE WHEN {NEAR} THEN 0.25 ELSE 0 END AS DECIMAL(18,4))
    FROM w_numbered WHERE line_number = 1 AND ({EXACT} OR {NEAR})
  ) copied
) priced"""

SUBQUERIES["op_claim_line"] = f"""
SELECT {line('LIN', 'l_orderkey', 'line_number')} AS claim_line_id, {claim('l_orderkey')} AS claim_id,
  CAST(line_number AS INTEGER) AS line_number, {provider('l_suppkey')} AS rendering_provider_id,
  'SYS-' || (l_partkey % 25) AS service_code_system, CAST(l_partkey AS VARCHAR) AS service_code,
  service_from_date AS service_date,
  CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS place_of_service_code,
  units, charge_amount, allowed_amount, member_liability_amount
FROM w_lines JOIN w_orders ON l_orderkey = o_orderkey"""

SUBQUERIES["w_totals"] = """
SELECT l_orderkey, sum(charge_amount) AS charge, sum(allowed_amount) AS allowed,
  sum(member_liability_amount) AS liability, min(l_suppkey) AS billing, max(l_suppkey) AS rendering
FROM w_lines GROUP BY l_orderkey"""

SUBQUERIES["w_versions"] = f"""
SELECT *, row_number() OVER versions AS claim_version_number, lag(o_orderkey) OVER versions AS prior_order,
  {pad('LCL', 'o_custkey', 12)} || strftime(service_from_date, '%Y%m') AS logical_claim_id
FROM w_orders
WINDOW versions AS (PARTITION BY o_custkey, date_trunc('month', service_from_date)
  ORDER BY service_from_date, o_orderkey)"""

SUBQUERIES["op_claim_header"] = f"""
SELECT logical_claim_id, CAST(claim_version_number AS INTEGER) AS claim_version_number,
  {claim('o_orderkey')} AS claim_id, {member('o_custkey')} AS member_id, c_mktsegment AS plan_id,
  {provider('coalesce(billing, 1)')} AS billing_provider_id, {provider('rendering')} AS rendering_provider_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'inpatient' WHEN '2-HIGH' THEN 'outpatient'
    WHEN '5-LOW' THEN 'pharmacy' ELSE 'professional' END AS claim_type,
  claim_status, service_from_date,
  service_from_date + CAST(o_orderkey % 4 AS INTEGER) AS service_through_date,
  service_from_date + CAST(o_orderkey % 4 + 5 AS INTEGER) AS received_date,
  CASE WHEN o_orderkey % 101 <> 0 THEN service_from_date + CAST(o_orderkey % 4 + 15 AS INTEGER) END
    AS adjudication_date,
  ['I10', 'E119', 'M1711', 'J449', 'F329', 'Z0000'][CAST(o_orderkey % 6 + 1 AS INTEGER)]
    AS principal_diagnosis_code,
  CAST(coalesce(charge, 0) AS DECIMAL(18,2)) AS total_charge_amount,
  CAST(coalesce(allowed, 0) + CASE WHEN o_orderkey % 97 = 13 THEN 10 ELSE 0 END AS DECIMAL(18,2))
    AS total_allowed_amount,
  CAST(coalesce(liability, 0) AS DECIMAL(18,2)) AS total_member_liability_amount,
  CASE WHEN prior_order IS NOT NULL THEN {claim('prior_order')} END AS prior_claim_id
FROM w_versions LEFT JOIN w_totals ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey"""

SUBQUERIES["op_payment_transaction"] = f"""
SELECT {line('PAY', 'l_orderkey', 'line_number')} AS payment_transaction_id, {claim('l_orderkey')} AS claim_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY transaction_date, line_number) AS INTEGER)
    AS transaction_sequence_number,
  transaction_date, CASE WHEN reversal THEN 'reversal' ELSE 'payment' END AS transaction_type,
  CAST(CASE WHEN reversal THEN -net ELSE net + extra END AS DECIMAL(18,2)) AS signed_transaction_amount,
  CASE WHEN reversal THEN {line('PAY', 'l_orderkey', '1')} END AS reverses_transaction_id
FROM (
  SELECT l_orderkey, line_number, l_returnflag = 'R' AND line_number > 1 AS reversal,
    CASE WHEN ship_date >= service_from_date OR l_orderkey % 50 = 0 THEN ship_date
      ELSE service_from_date + CAST(line_number AS INTEGER) END AS transaction_date,
    allowed_amount - member_liability_amount AS net,
    CASE WHEN l_orderkey % 89 = 5 AND line_number = 1 THEN CAST(5000 AS DECIMAL(18,2)) ELSE 0 END AS extra
  FROM w_lines JOIN w_orders ON l_orderkey = o_orderkey WHERE claim_status <> 'denied') dated"""

SUBQUERIES["op_adjudication_event"] = f"""
SELECT {line('ADJ', 'o_orderkey', 'step')} AS adjudication_event_id, {claim('o_orderkey')} AS claim_id,
  step AS event_sequence_number,
  CAST(service_from_date + CAST(o_orderkey % 4 + step * 5 AS INTEGER) AS TIMESTAMP) AS event_timestamp,
  CASE WHEN step = 2 THEN 'received' END AS prior_status,
  CASE WHEN step = 2 THEN claim_status ELSE 'received' END AS resulting_status,
  CAST(NULL AS VARCHAR) AS reason_code
FROM w_orders, (VALUES (1), (2)) v(step)"""

SUBQUERIES["op_denial_outcome"] = """
SELECT 'DEN' || substr(claim_id, 4) AS denial_id, claim_id, received_date AS denial_date,
  'coverage' AS denial_reason_code, total_charge_amount AS denied_amount
FROM op_claim_header WHERE claim_status = 'denied'"""

SUBQUERIES["op_claim_review"] = f"""
SELECT {pad('REV', 'o_orderkey', 12)} AS review_id, {claim('o_orderkey')} AS claim_id,
  CASE WHEN o_orderkey % 40 = 0 THEN 'completed' ELSE 'in_review' END AS review_status,
  service_from_date + 20 AS selected_date,
  CASE WHEN o_orderkey % 40 = 0 THEN service_from_date + 30 END AS completed_date,
  CASE WHEN o_orderkey % 60 = 0 THEN 'random' ELSE 'amount' END AS selection_reason
FROM w_orders WHERE o_orderkey % 20 = 0"""

SUBQUERIES["op_audit_outcome"] = f"""
SELECT {pad('AUD', 'o_orderkey', 12)} AS audit_id, {pad('REV', 'o_orderkey', 12)} AS review_id,
  {claim('o_orderkey')} AS claim_id,
  CASE WHEN o_orderkey % 120 = 0 THEN 'confirmed_overpayment' ELSE 'no_issue' END AS outcome,
  CAST(CASE WHEN o_orderkey % 120 = 0 THEN 25.50 ELSE 0 END AS DECIMAL(18,2)) AS confirmed_amount,
  service_from_date + 30 AS outcome_date
FROM w_orders WHERE o_orderkey % 40 = 0"""

SUBQUERIES["op_anomaly_injection"] = f"""
SELECT 'INJ-' || rule_id || '-' || target_record_id AS injection_id, *, CAST(NULL AS VARCHAR) AS provider_id
FROM (
  SELECT CASE WHEN {EXACT} THEN 'PI001' ELSE 'PI002' END AS rule_id, 'claim_line' AS label_scope,
    'claim_line' AS target_table, {line('LIN', 'l_orderkey', 'line_number')} AS target_record_id,
    {claim('l_orderkey')} AS claim_id, {line('LIN', 'l_orderkey', 'line_number')} AS claim_line_id,
    CAST(date_trunc('month', service_from_date) AS DATE) AS reporting_period,
    CAST(allowed_amount - member_liability_amount AS DECIMAL(18,2)) AS expected_financial_exposure,
    CAST(NULL AS VARCHAR) AS payment_transaction_id
  FROM w_lines JOIN w_orders ON l_orderkey = o_orderkey WHERE {EXACT} OR {NEAR}
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY line_number DESC) = 1
  UNION ALL
  SELECT 'PI005', 'claim', 'claim_header', {claim('o_orderkey')}, {claim('o_orderkey')}, NULL,
    CAST(date_trunc('month', service_from_date) AS DATE), 10.00, NULL
  FROM w_orders WHERE o_orderkey % 97 = 13
  UNION ALL
  SELECT 'PI006', 'claim', 'payment_transaction', {claim('o_orderkey')}, {claim('o_orderkey')}, NULL,
    CAST(date_trunc('month', service_from_date) AS DATE), 5000.00, {line('PAY', 'o_orderkey', '1')}
  FROM w_orders WHERE o_orderkey % 89 = 5 AND claim_status <> 'denied'
    AND o_orderkey IN (SELECT l_orderkey FROM lineitem)
) labels"""


def mentioned(text: str, library: dict[str, str]) -> list[str]:
    words = set(re.findall(r"\b[a-z][a-z0-9_]*\b", text))
    return [name for name in library if name in words]


def compose(body: str, library: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the sub-queries it needs, in dependency order."""
    library = SUBQUERIES if library is None else library
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in mentioned(text, library):
            if name not in ordered:
                visit(library[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    blocks = ",\n".join(f"{name} AS MATERIALIZED ({library[name]})" for name in ordered)
    return f"WITH {blocks}\n{body}"
