"""Review rules, selection, matching and evaluation."""

from datetime import date

from pyspark.sql import functions as F

from checks.oracle_base import SUBQUERIES
from checks.oracle_numbers import half_even, half_up, scaled, whole
from checks.registry import register
from claimloom.contracts.review_rules import RULES, RuleSettings
from claimloom.plans import evaluation, rules

SETTINGS = RuleSettings(run_id="warehouse-rules", deterministic_seed=42, policy_start=date(2000, 1, 1))


def limits_of(model):
    """Every other part may be billed once per claim."""
    return model.service_categories.filter(F.col("service_code").cast("bigint") % 2 == 0).select(
        "service_code_system", "service_code", F.lit(1).alias("limit")
    )


NEAR = (
    "claim_id, rendering_provider_id, service_code_system, service_code, service_date, "
    "place_of_service_code, charge_amount, allowed_amount, member_liability_amount"
)


def candidate_sql(rule, scope, table, target, amount, explanation, evidence, observed, threshold, rank,
                  source, claim="claim_id", line="NULL", payment="NULL", provider="NULL", period="NULL"):
    return f"""
SELECT '{rule}' AS rule_id, '{scope}' AS label_scope, '{table}' AS target_table,
  {target} AS target_record_id, CAST(greatest({amount}, 0) AS DECIMAL(18,2)) AS amount_at_risk,
  '{explanation}' AS explanation, '{evidence}' AS evidence_name, CAST({observed} AS VARCHAR) AS observed_value,
  CAST({threshold} AS VARCHAR) AS threshold_value, CAST({claim} AS VARCHAR) AS claim_id,
  CAST({line} AS VARCHAR) AS claim_line_id, CAST({payment} AS VARCHAR) AS payment_transaction_id,
  CAST({provider} AS VARCHAR) AS provider_id, CAST({period} AS DATE) AS reporting_period,
  CAST({rank} AS HUGEINT) AS ranking_value
FROM ({source}) rule_source"""


CENTS = lambda value: scaled(value, 2)
PEER = "PARTITION BY specialty_group, service_code_system"
LIMIT7 = half_even(f"{CENTS('comparison')} * 125", "100", 0)
CANDIDATES = {}
CANDIDATES["PI001"] = candidate_sql(
    "PI001", "claim_line", "fact_claim_line", "claim_line_id", "plan_paid_amount",
    "Claim line exactly duplicates another service line.", "duplicate_line_count", "2", "1",
    "CAST(substr(claim_line_id, 4) AS BIGINT)",
    f"""SELECT * FROM (SELECT *, count(*) OVER same AS size, min(line_number) OVER same AS first_line,
      max(line_number) OVER (PARTITION BY claim_id) AS last_line
    FROM f_lines WINDOW same AS (PARTITION BY {NEAR}, units)) g
    WHERE size = 2 AND first_line = 1 AND line_number = last_line""", line="claim_line_id")
CANDIDATES["PI002"] = candidate_sql(
    "PI002", "claim_line", "fact_claim_line", "claim_line_id", "plan_paid_amount",
    "Claim line is a near duplicate with changed service units.", "near_duplicate_units", "units",
    "'[''' || array_to_string(list_sort(list_distinct(list_transform(all_units, lambda u: CAST(u AS VARCHAR)))), "
    "''', ''') || ''']'", CENTS("plan_paid_amount"),
    f"""SELECT * FROM (SELECT *, list(units) OVER same AS all_units, min(line_number) OVER same AS first_line,
      max(line_number) OVER (PARTITION BY claim_id) AS last_line
    FROM f_lines WINDOW same AS (PARTITION BY {NEAR})) g
    WHERE len(list_distinct(all_units)) > 1 AND first_line = 1 AND line_number = last_line AND units % 1 <> 0
      AND (list_contains(all_units, CAST(units - 0.25 AS DECIMAL(18,4)))
        OR list_contains(all_units, CAST(units + 0.25 AS DECIMAL(18,4))))""", line="claim_line_id")
CANDIDATES["PI003"] = candidate_sql(
    "PI003", "payment_transaction", "fact_payment_transaction", "payment_transaction_id",
    "signed_transaction_amount", "Positive repayment remains after a full reversal sequence.",
    "unresolved_repayment", "signed_transaction_amount", "'0.00'", CENTS("signed_transaction_amount"),
    """SELECT * FROM (SELECT *, max(CASE WHEN transaction_type = 'reversal' THEN 1 ELSE 0 END) OVER
      (PARTITION BY claim_id ORDER BY transaction_sequence_number ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING) AS reversal_seen FROM op_payment_transaction) p
    WHERE reversal_seen = 1 AND transaction_type = 'payment' AND signed_transaction_amount > 0""",
    payment="payment_transaction_id")
CANDIDATES["PI004"] = candidate_sql(
    "PI004", "payment_transaction", "fact_payment_transaction", "payment_transaction_id", "0",
    "Payment transaction date precedes the claim service date.", "transaction_date", "transaction_date",
    "service_from_date", "0",
    "SELECT p.*, service_from_date FROM op_payment_transaction p JOIN op_claim_header USING (claim_id) "
    "WHERE transaction_date < service_from_date", payment="payment_transaction_id")
CANDIDATES["PI005"] = candidate_sql(
    "PI005", "claim", "fact_claim", "claim_id", "abs(total_allowed_amount - line_total)",
    "Claim header allowed amount does not reconcile to its lines.", "header_allowed_amount",
    "total_allowed_amount", "line_total", CENTS("abs(total_allowed_amount - line_total)"),
    """SELECT h.claim_id, total_allowed_amount, CAST(coalesce(s, 0) AS DECIMAL(18,2)) AS line_total
    FROM op_claim_header h LEFT JOIN (SELECT claim_id, sum(allowed_amount) AS s FROM op_claim_line
      GROUP BY claim_id) l USING (claim_id) WHERE total_allowed_amount <> coalesce(s, 0)""")
GOVERNED = "CAST(total_allowed_amount - total_member_liability_amount AS DECIMAL(18,2))"
CANDIDATES["PI006"] = candidate_sql(
    "PI006", "claim", "fact_claim", "claim_id", f"net_paid_amount - {GOVERNED}",
    "Net payment exceeds allowed amount less member liability.", "net_paid_amount", "net_paid_amount",
    GOVERNED, CENTS(f"net_paid_amount - {GOVERNED}"),
    f"SELECT * FROM f_claims WHERE net_paid_amount > {GOVERNED}")
CANDIDATES["PI007"] = candidate_sql(
    "PI007", "provider", "fact_claim_line", "claim_line_id", "allowed_amount - comparison",
    "Provider line amount exceeds the specialty peer threshold.", "allowed_amount", "allowed_amount",
    "threshold", f"CASE WHEN threshold <> 0 THEN ({CENTS('allowed_amount')} * 2000000000000 + "
    f"{CENTS('threshold')}) // (2 * {CENTS('threshold')}) "
    f"ELSE {CENTS('allowed_amount')} * 10000000000 END",
    f"""SELECT * FROM (SELECT *, CAST({LIMIT7} / 100 AS DECIMAL(18,2)) AS threshold
      FROM (SELECT l.claim_line_id, l.claim_id, l.allowed_amount, c.billing_provider_id AS provider_id,
          count(*) OVER ({PEER}) AS peers,
          lag(l.allowed_amount) OVER ({PEER} ORDER BY l.allowed_amount, l.claim_line_id) AS comparison
        FROM f_lines l JOIN f_claims c USING (claim_id)) ranked
      WHERE peers >= 11 AND comparison IS NOT NULL) t WHERE allowed_amount >= threshold""",
    line="claim_line_id", provider="provider_id")
SUBQUERIES["f_provider_months"] = """
SELECT * FROM (
  SELECT provider_id, reporting_period, claims, paid,
    count(*) FILTER (WHERE year(reporting_period) < 2000) OVER past AS months,
    sum(claims) FILTER (WHERE year(reporting_period) < 2000) OVER past AS history
  FROM (SELECT billing_provider_id AS provider_id, service_month AS reporting_period, count(*) AS claims,
      sum(net_paid_amount) AS paid FROM f_claims GROUP BY ALL) monthly
  WINDOW past AS (PARTITION BY provider_id ORDER BY reporting_period
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) counted
WHERE months >= 6 AND history >= 11"""
CANDIDATES["PI008"] = candidate_sql(
    "PI008", "provider_period", "fact_claim", "provider_id || ':' || CAST(reporting_period AS VARCHAR)",
    "paid", "Provider monthly claim volume exceeds its historical baseline.", "provider_month_claim_count",
    "claims", f"printf('%.4f', {half_even(whole('history * 3'), whole('months'))})", CENTS("paid"),
    "SELECT * FROM f_provider_months WHERE year(reporting_period) >= 2000 AND claims * months > history * 3",
    claim="NULL", provider="provider_id", period="reporting_period")
CANDIDATES["PI009"] = candidate_sql(
    "PI009", "claim", "fact_claim", "claim_id", "excess",
    "Procedure frequency exceeds the configured claim limit.", "service_code_frequency", "2", "1", "newest",
    """SELECT o.claim_id, o.service_code_system, o.service_code,
      coalesce(sum(plan_paid_amount) FILTER (WHERE place > 1), 0) AS excess,
      max(CAST(substr(claim_line_id, 4) AS BIGINT)) AS newest
    FROM (SELECT claim_id, service_code_system, service_code FROM f_lines
        WHERE CAST(service_code AS BIGINT) % 2 = 0 AND CAST(service_code AS BIGINT) % 10 <> 0
        GROUP BY ALL HAVING count(*) = 2) o
    JOIN (SELECT *, row_number() OVER (PARTITION BY claim_id, service_code ORDER BY claim_line_id) AS place
      FROM f_lines) l ON l.claim_id = o.claim_id AND l.service_code = o.service_code
    GROUP BY ALL""")
DIAGNOSIS = (
    "CASE principal_diagnosis_code WHEN 'I10' THEN 'cardiovascular' WHEN 'E119' THEN 'endocrine' "
    "WHEN 'M1711' THEN 'musculoskeletal' WHEN 'J449' THEN 'respiratory' WHEN 'F329' THEN 'behavioral' "
    "ELSE 'preventive' END"
)
CANDIDATES["PI010"] = candidate_sql(
    "PI010", "claim", "fact_claim", "claim_id", "0",
    "Principal diagnosis is incompatible with the governed procedure category.",
    "diagnosis_procedure_categories", f"{DIAGNOSIS} || ':' || category", "'compatible category mapping'", "0",
    """SELECT c.claim_id, principal_diagnosis_code, category
    FROM (SELECT claim_id, min(mapped) AS category FROM f_lines JOIN k_category USING (service_code)
      GROUP BY claim_id HAVING count(DISTINCT mapped) = 1) s JOIN f_claims c USING (claim_id)
    WHERE (category, principal_diagnosis_code) IN (('cardiovascular', 'M1711'), ('endocrine', 'J449'),
      ('musculoskeletal', 'F329'), ('respiratory', 'E119'), ('behavioral', 'I10'))""")

CANDIDATE_SPEC = (
    "rule_id:text label_scope:text target_table:text target_record_id:text amount_at_risk:num "
    "explanation:text evidence_name:text observed_value:text threshold_value:text claim_id:text "
    "claim_line_id:text payment_transaction_id:text provider_id:text reporting_period:date"
)
BUILDERS = {
    "r1_exact_duplicate_lines": ("PI001", lambda m: rules.exact_duplicates(m.facts)),
    "r2_near_duplicate_lines": ("PI002", lambda m: rules.near_duplicates(m.facts)),
    "r3_repayment_after_reversal": ("PI003", lambda m: rules.repayments_after_reversal(m.facts)),
    "r4_impossible_payment_dates": ("PI004", lambda m: rules.impossible_dates(m.facts)),
    "r5_header_line_mismatch": ("PI005", lambda m: rules.header_mismatches(m.facts)),
    "r6_overpaid_claims": ("PI006", lambda m: rules.overpayments(m.facts)),
    "r7_unusual_peer_amounts": ("PI007", lambda m: rules.unusual_amounts(m.facts, SETTINGS)),
    "r8_utilization_surges": ("PI008", lambda m: rules.utilization_surges(m.facts, SETTINGS)),
    "r9_repeated_procedures": ("PI009", lambda m: rules.repeated_procedures(m.facts, limits_of(m))),
    "r10_diagnosis_procedure_mismatch": ("PI010", lambda m: rules.diagnosis_mismatches(m.facts, SETTINGS)),
}
for name, (rule, build) in BUILDERS.items():
    SUBQUERIES[f"cand_{rule.lower()}"] = CANDIDATES[rule]
    register(name, build, CANDIDATE_SPEC, f"SELECT * FROM cand_{rule.lower()}")

register(
    "f5_provider_month_history",
    lambda m: rules.provider_months(m.facts, SETTINGS).selectExpr(
        "provider_id", "reporting_period", "_claims as claims", "_months as months", "_history as history"
    ),
    "provider_id:text reporting_period:date claims:long months:long history:long",
    "SELECT * FROM f_provider_months",
)
register(
    "f4_peer_neighbour_amounts",
    lambda m: rules.peer_amounts(m.facts, SETTINGS).selectExpr(
        "specialty_group", "service_code_system", "allowed_amount", "_lower as lower_amount"
    ),
    "specialty_group:text service_code_system:text allowed_amount:num lower_amount:num",
    """SELECT specialty_group, service_code_system, allowed_amount,
      lag(allowed_amount) OVER (PARTITION BY specialty_group, service_code_system ORDER BY allowed_amount)
        AS lower_amount
    FROM (SELECT *, sum(n) OVER (PARTITION BY specialty_group, service_code_system) AS peers
      FROM (SELECT specialty_group, service_code_system, l.allowed_amount, count(*) AS n
        FROM f_lines l JOIN f_claims c USING (claim_id) GROUP BY ALL) v) w WHERE peers >= 11""",
)

RULE_VALUES = ", ".join(f"('{a}', '{b}', '{c}', CAST({d} AS DECIMAL(18,4)))" for a, b, c, d in RULES)
SUBQUERIES["r_selected"] = f"""
SELECT 'FND' || lpad(CAST(row_number() OVER (ORDER BY rule_id, target_record_id) AS VARCHAR), 10, '0')
    AS finding_id, '{SETTINGS.run_id}' AS run_id, *
FROM (
  SELECT *, row_number() OVER (PARTITION BY rule_id, target_record_id ORDER BY place) AS repeat
  FROM (
    SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY ranking_value DESC, target_record_id) AS place
    FROM ({' UNION ALL '.join(f'SELECT * FROM cand_pi{n:03d}' for n in range(1, 11))}) all_rules) ranked
  WHERE place <= 50) capped
JOIN (VALUES {RULE_VALUES}) meta(rule_id, rule_name, severity, confidence) USING (rule_id)
WHERE repeat = 1"""


def selected(model):
    """Written before any label is read: the freeze."""
    return model.layers.keep(
        "selected_findings", lambda: rules.run_rules(model.facts, SETTINGS, limits_of(model)), SETTINGS
    )


register(
    "r11_selected_findings",
    lambda m: rules.findings_table(selected(m)),
    "finding_id:text run_id:text rule_id:text rule_name:text label_scope:text target_table:text "
    "target_record_id:text claim_id:text claim_line_id:text payment_transaction_id:text provider_id:text "
    "reporting_period:date severity:text confidence:num amount_at_risk:num explanation:text",
    "SELECT * FROM r_selected",
)
register(
    "r11_finding_evidence",
    lambda m: rules.evidence_table(selected(m)),
    "finding_id:text evidence_sequence:long evidence_name:text observed_value:text "
    "comparison_operator:text threshold_value:text source_table:text source_record_id:text",
    "SELECT *, 1 AS evidence_sequence, CASE WHEN threshold_value IS NOT NULL THEN '>' END "
    "AS comparison_operator, target_table AS source_table, target_record_id AS source_record_id FROM r_selected",
)
CANONICAL = """CASE label_scope WHEN 'claim' THEN claim_id WHEN 'claim_line' THEN claim_line_id
  WHEN 'payment_transaction' THEN payment_transaction_id WHEN 'provider' THEN provider_id || ':' || target_record_id
  ELSE provider_id || ':' || CAST(reporting_period AS VARCHAR) END"""
register(
    "r12_canonical_targets",
    lambda m: rules.findings_table(selected(m)).withColumn(
        "canonical_target_id", evaluation.canonical_target()
    ),
    "finding_id:text rule_id:text canonical_target_id:text",
    f"SELECT finding_id, rule_id, {CANONICAL} AS canonical_target_id FROM r_selected",
)
SUBQUERIES["r_matches"] = f"""
SELECT 'MAT' || lpad(CAST(row_number() OVER (ORDER BY rule_id, canonical_target_id) AS VARCHAR), 10, '0')
    AS match_id, finding_id, injection_id, rule_id, coalesce(f.label_scope, l.label_scope) AS label_scope,
  canonical_target_id,
  CASE WHEN finding_id IS NOT NULL AND injection_id IS NOT NULL THEN 'true_positive'
    WHEN finding_id IS NOT NULL THEN 'false_positive' ELSE 'false_negative' END AS match_status,
  coalesce(amount_at_risk, 0) AS amount_at_risk,
  coalesce(expected_financial_exposure, 0) AS expected_financial_exposure
FROM (SELECT *, {CANONICAL} AS canonical_target_id FROM r_selected) f
FULL JOIN (SELECT *, {CANONICAL} AS canonical_target_id FROM op_anomaly_injection) l
  USING (rule_id, canonical_target_id)"""


def matches(model):
    return evaluation.match_labels(rules.findings_table(selected(model)), model.anomaly_injection, SETTINGS)


register(
    "r13_label_matches",
    matches,
    "match_id:text finding_id:text injection_id:text rule_id:text label_scope:text "
    "canonical_target_id:text match_status:text amount_at_risk:num expected_financial_exposure:num",
    "SELECT * FROM r_matches",
)
SUBQUERIES["r_eligible"] = """
SELECT r.rule_id, n AS eligible_target_count FROM (
  SELECT ['PI001', 'PI002'] AS ids, count(*) AS n FROM op_claim_line
  UNION ALL SELECT ['PI003', 'PI004'], count(*) FROM op_payment_transaction
  UNION ALL SELECT ['PI005', 'PI006', 'PI010'], count(*) FROM op_claim_header
  UNION ALL SELECT ['PI007'], coalesce(sum(peers), 0) FROM (SELECT count(*) AS peers FROM f_lines
    JOIN f_claims USING (claim_id) GROUP BY specialty_group, service_code_system HAVING count(*) >= 11) g
  UNION ALL SELECT ['PI008'], count(*) FROM f_provider_months
  UNION ALL SELECT ['PI009'], count(*) FROM (SELECT DISTINCT claim_id, service_code_system, service_code
    FROM op_claim_line) d) sizes, unnest(ids) r(rule_id)"""
register(
    "e10_eligible_targets",
    lambda m: evaluation.eligible_targets(m.facts, SETTINGS),
    "rule_id:text eligible_target_count:long",
    "SELECT * FROM r_eligible",
)
ORDER = "CASE WHEN rule_id = 'ALL' THEN 11 ELSE CAST(substr(rule_id, 3) AS INTEGER) END"
SUBQUERIES["r_counts"] = f"""
SELECT rule_id, eligible_target_count, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn,
  coalesce(labeled, 0) AS labeled, coalesce(detected, 0) AS detected
FROM r_eligible LEFT JOIN (
  SELECT rule_id, count(*) FILTER (WHERE match_status = 'true_positive') AS tp,
    count(*) FILTER (WHERE match_status = 'false_positive') AS fp,
    count(*) FILTER (WHERE match_status = 'false_negative') AS fn,
    sum(expected_financial_exposure) FILTER (WHERE injection_id IS NOT NULL) AS labeled,
    sum(expected_financial_exposure) FILTER (WHERE match_status = 'true_positive') AS detected
  FROM r_matches GROUP BY rule_id) m USING (rule_id)"""
W = whole
SUBQUERIES["r_evaluation"] = f"""
SELECT 'EVA' || lpad(CAST({ORDER} AS VARCHAR), 10, '0') AS evaluation_id,
  CASE WHEN rule_id = 'ALL' THEN 'overall' ELSE 'rule' END AS evaluation_scope, rule_id,
  eligible_target_count, tp AS true_positive_count, fp AS false_positive_count, fn AS false_negative_count,
  tn AS true_negative_count, {half_even(W('tp'), W('tp + fp'))} AS "precision",
  {half_even(W('tp'), W('tp + fn'))} AS recall, {half_even(W('fp'), W('fp + tn'))} AS false_positive_rate,
  labeled AS labeled_expected_exposure, detected AS detected_expected_exposure,
  {half_even(CENTS('detected'), CENTS('labeled'))} AS exposure_recall,
  coalesce(tp * 100 >= 70 * nullif(tp + fp, 0), FALSE) AS precision_threshold_passed,
  coalesce(tp * 100 >= 85 * nullif(tp + fn, 0), FALSE) AS recall_threshold_passed,
  coalesce(fp * 100 < 10 * nullif(fp + tn, 0), FALSE) AS false_positive_rate_threshold_passed
FROM (SELECT *, greatest(eligible_target_count - tp - fp - fn, 0) AS tn FROM (
  SELECT * FROM r_counts UNION ALL
  SELECT 'ALL', sum(eligible_target_count), sum(tp), sum(fp), sum(fn), sum(labeled), sum(detected)
  FROM r_counts) u) c"""
EVALUATION_SPEC = (
    "evaluation_id:text evaluation_scope:text rule_id:text eligible_target_count:long "
    "true_positive_count:long false_positive_count:long false_negative_count:long "
    "true_negative_count:long precision:num recall:num false_positive_rate:num "
    "labeled_expected_exposure:num detected_expected_exposure:num exposure_recall:num "
    "precision_threshold_passed:bool recall_threshold_passed:bool "
    "false_positive_rate_threshold_passed:bool"
)
for name in ("r14_rule_evaluation", "e11_confusion_metrics"):
    rule_filter = "rule_id = 'ALL'" if name.startswith("e11") else "true"
    register(
        name,
        lambda m, keep=rule_filter: evaluation.evaluate(
            matches(m), evaluation.eligible_targets(m.facts, SETTINGS), SETTINGS
        ).filter(keep),
        EVALUATION_SPEC,
        f"SELECT * FROM r_evaluation WHERE {rule_filter}",
    )
register(
    "r15_run_summary",
    lambda m: evaluation.run_summary(rules.findings_table(selected(m)), SETTINGS),
    "run_id:text run_status:text enabled_rule_count:long finding_count:long total_amount_at_risk:num "
    "findings_frozen:bool ground_truth_accessed_during_detection:bool",
    f"SELECT '{SETTINGS.run_id}' AS run_id, 'completed' AS run_status, 10 AS enabled_rule_count, "
    "count(*) AS finding_count, sum(amount_at_risk) AS total_amount_at_risk, TRUE AS findings_frozen, "
    "FALSE AS ground_truth_accessed_during_detection FROM r_selected",
)
