"""Key, reference, amount, date and mart integrity reports."""

from checks.cost_queries import cost
from checks.oracle_base import SUBQUERIES
from checks.policy_queries import panel
from checks.registry import register
from checks.rule_queries import SETTINGS, matches, selected
from checks.silver_queries import count_rows
from checks.star_queries import star_of
from claimloom.operators import quality
from claimloom.plans import evaluation, integrity, rules

SPEC = "check_name:text violations:long"
ORACLE_TABLES = {n: f"op_{n}" for n in integrity.OPERATIONAL_KEYS if n != "recovery_transaction"}
SUBQUERIES["op_recovery_transaction"] = """
SELECT 'RCV' || substr(audit_id, 4) AS recovery_transaction_id, audit_id, claim_id,
  outcome_date + 15 AS recovery_date, CAST(12.75 AS DECIMAL(18,2)) AS recovered_amount,
  'partial' AS recovery_status
FROM op_audit_outcome WHERE confirmed_amount > 0"""
ORACLE_TABLES["recovery_transaction"] = "op_recovery_transaction"


def duplicates(table, keys):
    return f"(SELECT 1 FROM {table} GROUP BY {', '.join(keys)} HAVING count(*) > 1) d", "TRUE"


key_counts = {}
for table, keys in integrity.OPERATIONAL_KEYS.items():
    key_counts[f"{table}_duplicate_keys"] = duplicates(ORACLE_TABLES[table], keys)
    key_counts[f"{table}_null_keys"] = (ORACLE_TABLES[table], " OR ".join(f"{k} IS NULL" for k in keys))
register("h17_key_uniqueness", lambda m: integrity.key_checks(m.tables(), integrity.OPERATIONAL_KEYS), SPEC,
         count_rows(key_counts))

reference_counts = {}
for child, columns, text in integrity.REFERENCES:
    parent, parents = integrity.parse_reference(text)
    same = " AND ".join(f"p.{p} = c.{c}" for p, c in zip(parents, columns))
    whole = " AND ".join(f"c.{c} IS NOT NULL" for c in columns)
    reference_counts[f"{child}_{'_'.join(columns)}"] = (
        f"op_{child} c", f"{whole} AND NOT EXISTS (SELECT 1 FROM op_{parent} p WHERE {same})")
register("h18_reference_integrity", lambda m: integrity.reference_checks(m.tables()), SPEC,
         count_rows(reference_counts))
register(
    "d13_claims_without_contract",
    lambda m: quality.orphans(m.claim_header, ["billing_provider_id", "plan_id"], m.provider_contract,
                              ["provider_id", "plan_id"]),
    "claim_id:text billing_provider_id:text plan_id:text",
    "SELECT * FROM op_claim_header c WHERE NOT EXISTS (SELECT 1 FROM op_provider_contract p "
    "WHERE p.provider_id = c.billing_provider_id AND p.plan_id = c.plan_id)",
)
FORMATS = {
    "member_id": ("member", "MBR[0-9]{12}"),
    "claim_id": ("claim_header", "CLM[0-9]{12}"),
    "claim_line_id": ("claim_line", "LIN[0-9]{12}[0-9]{6}"),
    "payment_transaction_id": ("payment_transaction", "PAY[0-9]{12}"),  # too short on purpose
}
register(
    "c5_identifier_formats",
    lambda m: integrity.format_checks(m.tables(), FORMATS),
    SPEC,
    count_rows({f"{c}_format": (f"op_{t}", f"NOT regexp_full_match({c}, '{p}')") for c, (t, p) in FORMATS.items()}),
)
SUBQUERIES["v_linked"] = """
SELECT h.*, p.claim_id AS prior, p.claim_version_number AS prior_version, p.adjudication_date AS prior_decided,
  p.billing_provider_id AS prior_billing, p.claim_type AS prior_type, p.logical_claim_id AS prior_logical
FROM op_claim_header h LEFT JOIN op_claim_header p ON p.claim_id = h.prior_claim_id"""
VERSION_COUNTS = {
    "current_versions_not_one": ("(SELECT 1 FROM f_claims WHERE is_current_version GROUP BY logical_claim_id HAVING count(*) <> 1) d", "TRUE"),
    "version_without_link": ("v_linked", "claim_version_number > 1 AND prior IS NULL"),
    "first_version_with_link": ("v_linked", "claim_version_number = 1 AND prior_claim_id IS NOT NULL"),
    "version_not_following": ("v_linked", "prior_version + 1 <> claim_version_number"),
    "version_identity_changed": ("v_linked", "prior IS NOT NULL AND (prior_billing <> billing_provider_id OR prior_type <> claim_type OR prior_logical <> logical_claim_id)"),
    "received_before_prior_decision": ("v_linked", "received_date <= prior_decided"),
}
register("h25_version_links", lambda m: integrity.version_checks(m.claim_header), SPEC, count_rows(VERSION_COUNTS))
register(
    "h19_one_current_version",
    lambda m: integrity.version_checks(m.claim_header).filter("check_name = 'current_versions_not_one'"),
    SPEC,
    count_rows({"current_versions_not_one": VERSION_COUNTS["current_versions_not_one"]}),
)
SUBQUERIES["v_amounts"] = """
SELECT f.*, coalesce(charge, 0) AS charge, coalesce(allowed, 0) AS allowed, coalesce(liability, 0) AS liability,
  claim_id IN (SELECT claim_id FROM op_anomaly_injection WHERE rule_id = 'PI005') AS waived
FROM f_claims f LEFT JOIN (SELECT claim_id, sum(charge_amount) AS charge, sum(allowed_amount) AS allowed,
  sum(member_liability_amount) AS liability FROM op_claim_line GROUP BY claim_id) l USING (claim_id)"""
GOVERNED = "total_allowed_amount - total_member_liability_amount"
AMOUNTS = {
    "header_differs_from_lines": ("v_amounts", "NOT waived AND (total_charge_amount <> charge OR total_allowed_amount <> allowed OR total_member_liability_amount <> liability)"),
    "ledger_differs_from_governed": ("v_amounts", f"claim_status <> 'denied' AND net_paid_amount <> {GOVERNED}"),
    "denied_with_positive_net": ("v_amounts", "claim_status = 'denied' AND net_paid_amount > 0"),
    "negative_line_amounts": ("op_claim_line", "charge_amount < 0 OR allowed_amount < 0 OR member_liability_amount < 0"),
    "allowed_above_charge": ("op_claim_line", "allowed_amount > charge_amount"),
    "liability_above_allowed": ("op_claim_line", "member_liability_amount > allowed_amount"),
}


def amounts(model):
    waived = model.anomaly_injection.filter("rule_id = 'PI005'")
    return integrity.amount_checks(model.claim_header, model.claim_line, model.payment_transaction, waived)


for name, wanted in {
    "h20_header_equals_lines": ["header_differs_from_lines"],
    "h21_ledger_and_denials": ["ledger_differs_from_governed", "denied_with_positive_net"],
    "h24_amount_ordering": ["negative_line_amounts", "allowed_above_charge", "liability_above_allowed"],
}.items():
    keep = "check_name in (" + ", ".join(f"'{w}'" for w in wanted) + ")"
    register(name, lambda m, keep=keep: amounts(m).filter(keep), SPEC, count_rows({w: AMOUNTS[w] for w in wanted}))
register(
    "h22_coverage_and_contract_on_service",
    lambda m: integrity.eligibility_checks(m.tables()),
    SPEC,
    count_rows({
        "service_without_coverage": ("f_claims c", "NOT EXISTS (SELECT 1 FROM op_membership_month p WHERE p.member_id = c.member_id AND p.plan_id = c.plan_id AND p.coverage_month = c.service_month)"),
        "service_without_contract": ("f_claims c", "NOT EXISTS (SELECT 1 FROM op_provider_contract p WHERE p.provider_id = c.billing_provider_id AND p.plan_id = c.plan_id)"),
    }),
)
REVIEWS = "(SELECT r.*, adjudication_date FROM op_claim_review r JOIN op_claim_header USING (claim_id)) r"
register(
    "h23_date_chronology",
    lambda m: integrity.chronology_checks(m.claim_header, m.claim_review),
    SPEC,
    count_rows({
        "service_dates_reversed": ("op_claim_header", "service_from_date > service_through_date"),
        "received_before_service": ("op_claim_header", "service_through_date > received_date"),
        "decided_before_received": ("op_claim_header", "received_date > adjudication_date"),
        "reviewed_before_decision": (REVIEWS, "selected_date <= adjudication_date"),
        "completed_before_selected": (REVIEWS, "completed_date < selected_date"),
    }),
)
PAIRS = "(SELECT r.claim_id AS review_claim, a.*, completed_date, r.review_id AS rid FROM (SELECT * FROM op_claim_review WHERE review_status = 'completed') r FULL JOIN op_audit_outcome a ON a.review_id = r.review_id) p"
register(
    "h26_review_audit_pairs",
    lambda m: integrity.workflow_checks(m.claim_review, m.audit_outcome, m.recovery_transaction),
    SPEC,
    count_rows({
        "repeated_audits": duplicates("op_audit_outcome", ["review_id"]),
        "review_without_audit": (PAIRS, "audit_id IS NULL"),
        "audit_without_review": (PAIRS, "review_claim IS NULL"),
        "audit_of_other_claim": (PAIRS, "review_claim <> claim_id"),
        "audit_date_differs": (PAIRS, "completed_date <> outcome_date"),
        "negative_confirmed_amount": (PAIRS, "confirmed_amount < 0"),
        "recovered_above_confirmed": ("op_recovery_transaction JOIN op_audit_outcome USING (audit_id)", "recovered_amount > confirmed_amount"),
    }),
)
register(
    "h27_source_rows_retained",
    lambda m: integrity.retention_checks(m.tables(), star_of(m).tables()),
    SPEC,
    count_rows({f"{f}_rows_lost": (f, "FALSE") for f in ("fact_claim", "fact_claim_line", "fact_payment_transaction", "bridge_claim_anomaly")}),
)
register(
    "h28_cost_mart_invariants",
    lambda m: integrity.cost_mart_checks(cost.cost_marts(m.facts)),
    SPEC,
    count_rows({
        "monthly_keys_repeated": duplicates("mart_cost", ["service_month", "plan_key"]),
        "negative_exposure": ("mart_cost", "eligible_member_months < 0"),
        "pmpm_differs": ("mart_cost", "abs(allowed_pmpm - CAST(allowed_amount AS DOUBLE) / eligible_member_months) > 0.0001"),
        "utilization_differs": ("mart_cost", "abs(units_per_1000 - CAST(service_units AS DOUBLE) * 1000 / eligible_member_months) > 0.0001"),
        "concentration_out_of_bounds": ("mart_concentration", "top_10_share < 0 OR top_10_share > 1 OR hhi < 0 OR hhi > 1"),
        "decomposition_residual": ("mart_decomposition", "abs(reconciliation_residual) > 0.01"),
        "signal_unexplained": ("mart_signals", "length(explanation) = 0 OR signal_status NOT IN ('insufficient_history', 'normal', 'warning')"),
    }),
)
BY_PROVIDER = "(SELECT provider_key, count(*) AS months, count(DISTINCT treatment_group) AS cohorts FROM p_panel GROUP BY provider_key) g"
register(
    "h29_panel_invariants",
    lambda m: integrity.panel_checks(panel(m), 18),
    SPEC,
    count_rows({
        "panel_keys_repeated": duplicates("p_panel", ["provider_key", "reporting_month"]),
        "unbalanced_providers": (BY_PROVIDER, "months <> 18"),
        "treatment_not_fixed": (BY_PROVIDER, "cohorts <> 1"),
        "interaction_wrong": ("p_panel", "treatment_post <> (treatment_indicator AND post_policy_indicator)"),
        "cohort_missing": ("(SELECT count(DISTINCT treatment_group) AS n FROM p_panel) c", "n <> 2"),
    }),
)


def finding_report(model):
    chosen = selected(model)
    found = matches(model)
    scores = evaluation.evaluate(found, evaluation.eligible_targets(model.facts, SETTINGS), SETTINGS)
    return integrity.finding_checks(
        rules.findings_table(chosen), rules.evidence_table(chosen), model.anomaly_injection, found, scores
    )


register(
    "h30_finding_quality",
    finding_report,
    SPEC,
    count_rows({
        "finding_keys_repeated": duplicates("r_selected", ["rule_id", "label_scope", "target_record_id"]),
        "finding_unexplained": ("r_selected", "length(explanation) = 0"),
        "negative_amount": ("r_selected", "amount_at_risk < 0"),
        "finding_without_evidence": ("r_selected", "FALSE"),
        "label_not_evaluated": ("op_anomaly_injection", "injection_id NOT IN (SELECT injection_id FROM r_matches WHERE injection_id IS NOT NULL)"),
        "match_keys_repeated": duplicates("r_matches", ["rule_id", "canonical_target_id"]),
        "confusion_does_not_add_up": ("r_evaluation", "eligible_target_count <> true_positive_count + false_positive_count + false_negative_count + true_negative_count"),
    }),
)
register(
    "g13_set_difference",
    lambda m: quality.rows_differ(
        "billing_or_rendering_only",
        m.claim_header.selectExpr("billing_provider_id as provider_id", "plan_id"),
        m.claim_header.selectExpr("rendering_provider_id as provider_id", "plan_id"),
    ),
    SPEC,
    "SELECT 'billing_or_rendering_only' AS check_name, (SELECT count(*) FROM ("
    "SELECT billing_provider_id, plan_id FROM op_claim_header EXCEPT ALL SELECT rendering_provider_id, plan_id FROM op_claim_header) a) + "
    "(SELECT count(*) FROM (SELECT rendering_provider_id, plan_id FROM op_claim_header EXCEPT ALL "
    "SELECT billing_provider_id, plan_id FROM op_claim_header) b) AS violations",
)
