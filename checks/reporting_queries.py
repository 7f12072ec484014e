"""Dashboard extracts, reconciliation, manifests and load validation."""

from pyspark.sql import functions as F

from checks.oracle_base import SUBQUERIES
from checks.policy_queries import estimates, panel
from checks.registry import register
from checks.rule_queries import selected
from checks.silver_queries import count_rows
from claimloom.operators import quality
from claimloom.plans import cost, reporting, rules
from claimloom.sources.layers import LazyTables


def findings(model):
    return rules.findings_table(selected(model))


class _Marts:
    """Marts of a model as attributes, each written when it is first asked for."""

    def __init__(self, model):
        self._model = model

    def __getattr__(self, name):
        return self._model.layers.keep(name, lambda: getattr(cost, name)(self._model.facts))

    @property
    def cost_early_warning_signal(self):
        return self._model.layers.keep(
            "cost_early_warning_signal", lambda: cost.early_warning_signals(self.monthly_cost_utilization)
        )


def marts(model):
    """The five marts, written once: extracts and reconciliation read them repeatedly."""
    return LazyTables(_Marts(model), (
        "monthly_cost_utilization", "monthly_payment_cash_flow", "provider_service_concentration",
        "cost_change_decomposition", "cost_early_warning_signal",
    ))


def effects(model):
    return estimates(model)["policy_effect_estimate"]


SUBQUERIES["b_leads"] = """
SELECT rule_id, rule_name, severity, CASE WHEN members >= 11 THEN leads END AS review_lead_count,
  CASE WHEN members >= 11 THEN amount END AS amount_at_risk, members AS distinct_member_count,
  CASE WHEN members >= 11 THEN 'published' ELSE 'suppressed' END AS privacy_status
FROM (SELECT rule_id, rule_name, severity, count(DISTINCT finding_id) AS leads, sum(amount_at_risk) AS amount,
    count(DISTINCT member_id) AS members
  FROM r_selected LEFT JOIN (SELECT claim_id, member_id FROM op_claim_header) h USING (claim_id)
  GROUP BY rule_id, rule_name, severity) g"""
LEAD_SPEC = (
    "rule_id:text rule_name:text severity:text review_lead_count:long amount_at_risk:num "
    "distinct_member_count:long privacy_status:text"
)
for name in ("e12_review_lead_summary", "m1_small_cell_suppression"):
    register(name, lambda m: reporting.review_lead_summary(findings(m), m.claim_header), LEAD_SPEC, "SELECT * FROM b_leads")
register(
    "d14_findings_with_members",
    lambda m: findings(m).join(m.claim_header.select("claim_id", "member_id"), "claim_id", "left"),
    "finding_id:text claim_id:text member_id:text",
    "SELECT finding_id, claim_id, member_id FROM r_selected LEFT JOIN (SELECT claim_id, member_id FROM op_claim_header) h USING (claim_id)",
)
D = lambda v: f"CAST({v} AS DOUBLE)"
KPI = {
    "BI001": ("mart_cost", D("sum(allowed_amount)")),
    "BI002": ("mart_cost", D("sum(paid_amount)")),
    "BI003": ("mart_cost", f"{D('sum(allowed_amount)')} / {D('sum(eligible_member_months)')}"),
    "BI004": ("mart_cost", f"{D('sum(paid_amount)')} / {D('sum(eligible_member_months)')}"),
    "BI005": ("mart_cost", f"{D('sum(claim_count) * 1000')} / {D('sum(eligible_member_months)')}"),
    "BI006": ("mart_cost", f"{D('sum(service_units) * 1000')} / {D('sum(eligible_member_months)')}"),
    "BI007": ("mart_cash", D("sum(net_payment_cash_flow)")),
    "BI008": ("r_selected", D("count(DISTINCT finding_id)")),
    "BI009": ("r_selected", D("sum(amount_at_risk)")),
    "BI010": ("mart_concentration", f"sum({D('top_10_share')} * {D('total_allowed_amount')}) / sum({D('total_allowed_amount')})"),
    "BI011": ("mart_concentration", f"sum({D('hhi')} * {D('total_allowed_amount')}) / sum({D('total_allowed_amount')})"),
    "BI012": ("mart_decomposition", D("sum(CAST(total_cost_change AS DECIMAL(38,2)))")),
    "BI013": ("mart_signals", D("count(*) FILTER (WHERE signal_status = 'warning')")),
    "BI014": ("l_effects", "max(coefficient) FILTER (WHERE specification = 'balanced_panel' AND outcome_name = 'paid_pmpm')"),
}
NAMES = {metric: (display, role) for metric, display, role in reporting.INDICATORS}
SUBQUERIES["b_kpi"] = " UNION ALL ".join(
    f"SELECT '{metric}' AS metric_id, '{NAMES[metric][0]}' AS display_name, '{NAMES[metric][1]}' AS date_role, "
    f"round({value}, 4) AS metric_value FROM {table}"
    for metric, (table, value) in KPI.items()
)


def indicators(model):
    m = marts(model)
    return reporting.executive_indicators(
        m["monthly_cost_utilization"], m["monthly_payment_cash_flow"], findings(model),
        m["provider_service_concentration"], m["cost_change_decomposition"], m["cost_early_warning_signal"],
        effects(model),
    )


KPI_SPEC = "metric_id:text display_name:text date_role:text metric_value:num"
for name in ("e13_executive_indicators", "d16_metric_display_names"):
    register(
        name,
        lambda m: indicators(m).withColumn("metric_value", F.round("metric_value", 4)),
        KPI_SPEC, "SELECT * FROM b_kpi",
    )
register(
    "e14_weighted_averages",
    lambda m: marts(m)["provider_service_concentration"].groupBy("entity_type").agg(
        F.round(reporting.weighted_average(F.col("hhi"), F.col("total_allowed_amount")), 6).alias("weighted_hhi")),
    "entity_type:text weighted_hhi:num",
    f"SELECT entity_type, round(sum({D('hhi')} * {D('total_allowed_amount')}) / sum({D('total_allowed_amount')}), 6) "
    "AS weighted_hhi FROM mart_concentration GROUP BY entity_type",
)


def extracts(model):
    return reporting.dashboard_extracts(marts(model), findings(model), model.claim_header, effects(model))


register(
    "m2_dashboard_extract_sizes",
    lambda m: quality.all_checks(*[
        quality.row_count(name, frame) for name, (frame, _) in extracts(m).items()
    ]).withColumnsRenamed({"check_name": "extract", "violations": "row_count"}),
    "extract:text row_count:long",
    "SELECT 'executive_kpi' AS extract, count(*) AS row_count FROM b_kpi UNION ALL SELECT 'cost_and_utilization', count(*) FROM mart_cost "
    "UNION ALL SELECT 'payment_cash_flow', count(*) FROM mart_cash "
    "UNION ALL SELECT 'payment_integrity_review_leads', count(*) FROM b_leads "
    "UNION ALL SELECT 'provider_service_concentration', count(*) FROM mart_concentration "
    "UNION ALL SELECT 'policy_impact', count(*) FROM l_effects UNION ALL SELECT 'methodology_signals', count(*) FROM mart_signals",
)


# extract: its SQL and, of its columns, those that are summed
EXTRACT_SQL = {
    "executive_kpi": ("b_kpi", ["metric_value"]),
    "cost_and_utilization": ("mart_cost", ["eligible_member_months", "claim_count", "allowed_amount", "paid_amount", "allowed_pmpm"]),
    "payment_cash_flow": ("mart_cash", ["net_payment_cash_flow"]),
    "payment_integrity_review_leads": ("b_leads", ["review_lead_count", "amount_at_risk", "distinct_member_count"]),
    "provider_service_concentration": ("mart_concentration", ["total_allowed_amount", "hhi", "top_10_share"]),
    "policy_impact": ("l_effects", ["coefficient", "standard_error", "p_value", "observation_count"]),
    "methodology_signals": ("mart_signals", ["metric_value", "history_month_count"]),
}


def extract_contents(model):
    """Values and exact total of the measures of each extract, long; one aggregate row an extract."""
    parts = []
    for name, (frame, order) in extracts(model).items():
        measures = [
            F.struct(F.lit(column).alias("measure"), F.count(column).alias("filled"),
                     F.sum(F.round(column, 4).cast("decimal(28,4)")).alias("total"))
            for column in EXTRACT_SQL[name][1]
        ]
        one = frame.agg(F.array(*measures).alias("_measures"), F.count_distinct(*order).alias("keys"))
        parts.append(one.select(F.lit(name).alias("extract"), F.inline("_measures"), "keys").select(
            "extract", "measure", "filled", "total", "keys"))
    return quality.reduce(lambda a, b: a.unionByName(b), parts)


EXTRACT_ORDER = {
    "executive_kpi": "metric_id", "cost_and_utilization": "service_month, plan_key", "payment_cash_flow": "payment_month, plan_key",
    "payment_integrity_review_leads": "rule_id, severity", "provider_service_concentration": "service_month, plan_key, entity_type",
    "policy_impact": "outcome_name, specification", "methodology_signals": "service_month, plan_key, metric_name",
}
register(
    "m2_dashboard_extract_contents",
    extract_contents,
    "extract:text measure:text filled:long total:num keys:long",
    " UNION ALL ".join(
        f"SELECT '{name}' AS extract, '{column}' AS measure, count({column}) AS filled, "
        f"sum(CAST(round({column}, 4) AS DECIMAL(28,4))) AS total, count(DISTINCT ({EXTRACT_ORDER[name]})) AS keys FROM {table}"
        for name, (table, columns) in EXTRACT_SQL.items() for column in columns
    ),
)


def extract_report(model):
    m = marts(model)
    leads = reporting.review_lead_summary(findings(model), model.claim_header)
    return reporting.extract_checks(indicators(model), leads, m["monthly_cost_utilization"],
                                    m["monthly_payment_cash_flow"], findings(model))


register(
    "h34_extract_checks", extract_report, "check_name:text violations:long",
    "SELECT unnest(['metric_without_value', 'suppressed_value_shown', 'lead_count_differs', 'allowed_total_differs', "
    "'date_roles_mixed']) AS check_name, 0 AS violations",
)

# -- reconciliation ----------------------------------------------------------------------------
SUBQUERIES["x_metrics"] = """
SELECT 'SAS001' AS metric_id, 'ALL' AS comparison_scope, 'row_count' AS metric_type, CAST(count(*) AS DOUBLE) AS value FROM f_claims
UNION ALL SELECT 'SAS002', 'ALL', 'distinct_key_count', count(DISTINCT claim_id) FROM f_claims
UNION ALL SELECT 'SAS003', 'ALL', 'financial', sum(total_allowed_amount) FROM f_claims WHERE is_current_version AND claim_status = 'paid'
UNION ALL SELECT 'SAS004', 'ALL', 'financial', sum(net_paid_amount) FROM f_claims WHERE is_current_version AND claim_status = 'paid'
UNION ALL SELECT 'SAS005', 'ALL', 'row_count', count(*) FROM op_membership_month WHERE coverage_status = 'active'
UNION ALL SELECT 'SAS006', CAST(service_month AS VARCHAR) || '|' || plan_key, 'rate', allowed_pmpm FROM mart_cost
UNION ALL SELECT 'SAS007', CAST(service_month AS VARCHAR) || '|' || plan_key, 'rate', units_per_1000 FROM mart_cost
UNION ALL SELECT 'SAS008', rule_id, 'row_count', count(*) FROM r_selected GROUP BY rule_id
UNION ALL SELECT 'SAS009', rule_id, 'financial', sum(amount_at_risk) FROM r_selected GROUP BY rule_id
UNION ALL SELECT 'SAS010', treatment_group, 'row_count', count(*) FROM p_panel GROUP BY treatment_group
UNION ALL SELECT 'SAS011', outcome_name, 'coefficient', coefficient FROM l_effects WHERE specification = 'balanced_panel'
UNION ALL SELECT 'SAS012', outcome_name, 'p_value', p_value FROM l_effects WHERE specification = 'balanced_panel'"""


def metrics(model):
    return reporting.reconciliation_metrics(
        model.facts.claims, model.membership_month, marts(model)["monthly_cost_utilization"], findings(model),
        panel(model), effects(model),
    )


for name in ("e20_reconciliation_metrics", "m4_reference_metric_table"):
    register(name, metrics, "metric_id:text comparison_scope:text metric_type:text value:num", "SELECT * FROM x_metrics")


def shifted(model):
    """A recomputation that misses one metric and differs slightly or too much in others."""
    value, metric = F.col("value"), F.col("metric_id")
    moved = F.when(metric == "SAS003", value + 0.01).when(metric == "SAS004", value + 0.02).otherwise(value)
    return metrics(model).filter("metric_id <> 'SAS005'").withColumn(
        "value", moved.cast(reporting.VALUE))


def comparison(model):
    return reporting.compare_metrics(metrics(model), shifted(model), "run-1")


SUBQUERIES["x_compared"] = """
SELECT 'run-1' AS execution_id, metric_id, comparison_scope, metric_type,
  metric_id <> 'SAS004' AND metric_id <> 'SAS005' AS passed, metric_id = 'SAS005' AS missing,
  CASE WHEN metric_id = 'SAS005' THEN NULL WHEN metric_id = 'SAS003' THEN 0.01 WHEN metric_id = 'SAS004' THEN 0.02 ELSE 0 END
    AS absolute_difference,
  CASE metric_type WHEN 'financial' THEN 0.01 WHEN 'rate' THEN 0.0001 WHEN 'coefficient' THEN 0.001
    WHEN 'p_value' THEN 0.001 ELSE 0 END AS tolerance
FROM x_metrics"""
for name in ("h31_tolerance_comparison", "d15_reference_to_recomputed"):
    register(name, comparison,
             "execution_id:text metric_id:text comparison_scope:text metric_type:text absolute_difference:num "
             "tolerance:num passed:bool", "SELECT * FROM x_compared")
register(
    "h32_reconciliation_set_checks",
    lambda m: reporting.comparison_checks(comparison(m), metrics(m)),
    "check_name:text violations:long",
    count_rows({
        "reference_without_result": ("x_compared", "FALSE"), "result_without_reference": ("x_compared", "FALSE"),
        "missing_values": ("x_compared", "missing"), "failed_comparisons": ("x_compared", "NOT passed"),
        "mixed_executions": ("x_compared", "FALSE"),
    }),
)

# -- manifests ---------------------------------------------------------------------------------
KEYS = {
    "monthly_cost_utilization": ["service_month", "plan_key"],
    "monthly_payment_cash_flow": ["payment_month", "plan_key"],
    "provider_service_concentration": ["service_month", "plan_key", "entity_type"],
    "rule_finding": ["finding_id"],
}
MEASURES = {
    "monthly_cost_utilization": ["eligible_member_months", "allowed_amount"],
    "monthly_payment_cash_flow": ["net_payment_cash_flow"],
    "rule_finding": ["amount_at_risk"],
}
ORACLE = {"monthly_cost_utilization": "mart_cost", "monthly_payment_cash_flow": "mart_cash",
          "provider_service_concentration": "mart_concentration", "rule_finding": "r_selected"}


def manifest(model):
    m = marts(model)
    tables = {n: findings(model) if n == "rule_finding" else m[n] for n in KEYS}
    return reporting.table_manifest(tables, KEYS, MEASURES)


parts = []
for table, keys in KEYS.items():
    access = reporting.access_of(table)
    head = f"SELECT '{table}' AS table_name, '{access}' AS access, "
    parts.append(head + f"'row_count' AS check_type, CAST(count(*) AS DOUBLE) AS value FROM {ORACLE[table]}")
    parts.append(head + f"'distinct_key_count', count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {ORACLE[table]}) d")
    for measure in MEASURES.get(table, []):
        parts.append(head + f"'sum_{measure}', sum({measure}) FROM {ORACLE[table]}")
SUBQUERIES["x_manifest"] = " UNION ALL ".join(parts)
MANIFEST_SPEC = "table_name:text access:text check_type:text value:num"
for name in ("g9_table_manifest", "m3_access_classes", "e16_distinct_composite_keys", "e17_governed_totals"):
    test = {"e16_distinct_composite_keys": "check_type = 'distinct_key_count'",
            "e17_governed_totals": "check_type LIKE 'sum_%'"}.get(name, "true")
    register(name, lambda m, t=test: manifest(m).filter(t), MANIFEST_SPEC, f"SELECT * FROM x_manifest WHERE {test}")


def load_validation(model):
    """All published tables as managed tables, one of them short of its first row."""
    m = marts(model)
    tables = {n: findings(model) if n == "rule_finding" else m[n] for n in KEYS}
    first = tables["rule_finding"].agg(F.min("finding_id").alias("first"))
    tables["rule_finding"] = tables["rule_finding"].join(first, F.col("finding_id") == F.col("first"), "left_anti")
    schema = "load_" + model.layers.root.rpartition("/")[2]
    return reporting.load_and_validate(tables, manifest(model), KEYS, MEASURES, schema, strict=False)


register(
    "h33_load_validation",
    load_validation,
    "table_name:text check_type:text expected_value:num actual_value:num passed:bool",
    """SELECT table_name, check_type, value AS expected_value, value - gone AS actual_value, abs(gone) <= allowed AS passed FROM (
  SELECT *, CASE WHEN check_type LIKE 'sum_%' THEN 0.01 ELSE 0 END AS allowed,
    CASE WHEN table_name <> 'rule_finding' THEN 0 WHEN check_type LIKE 'sum_%' THEN first_amount ELSE least(n, 1) END AS gone
  FROM x_manifest, (SELECT count(*) AS n, CAST(coalesce(min_by(amount_at_risk, finding_id), 0) AS DOUBLE) AS first_amount FROM r_selected) f) d""",
)
