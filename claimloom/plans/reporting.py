"""Dashboard extracts, privacy suppression, cross-tool reconciliation and table manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions.numbers import MONEY, WIDE_MONEY, total
from claimloom.operators.quality import all_checks, report, row_count, violations
from claimloom.sources.publish import save_managed

MINIMUM_MEMBERS = 11

# fixed values: metric names and date roles of the published indicator list
INDICATORS = (
    ("BI001", "Total allowed amount", "service_month"),
    ("BI002", "Total paid amount", "service_month"),
    ("BI003", "Allowed PMPM", "service_month"),
    ("BI004", "Paid PMPM", "service_month"),
    ("BI005", "Claims per 1000 member months", "service_month"),
    ("BI006", "Units per 1000 member months", "service_month"),
    ("BI007", "Net payment cash flow", "payment_month"),
    ("BI008", "Review lead count", "run_timestamp"),
    ("BI009", "Amount at risk", "run_timestamp"),
    ("BI010", "Top 10 concentration share", "service_month"),
    ("BI011", "HHI concentration", "service_month"),
    ("BI012", "Total cost change", "service_month"),
    ("BI013", "Active early warning count", "service_month"),
    ("BI014", "Simulated policy effect", "policy_event_month"),
)
# fixed values: tolerances of the reconciliation contract
TOLERANCES = {
    "row_count": "0",
    "distinct_key_count": "0",
    "financial": "0.01",
    "rate": "0.0001",
    "coefficient": "0.001",
    "p_value": "0.001",
}
ACCESS = {
    "ordinary_analytics": (
        "dim_member", "dim_provider", "dim_plan", "dim_date", "dim_service", "fact_membership_month",
        "fact_claim", "fact_claim_line", "fact_payment_transaction", "fact_claim_review",
        "bridge_provider_policy", "monthly_cost_utilization", "monthly_payment_cash_flow",
        "provider_service_concentration", "cost_change_decomposition", "cost_early_warning_signal",
    ),
    "governed_review_leads": ("rule_run", "rule_finding", "finding_evidence"),
    "synthetic_policy_analysis": (
        "provider_month_policy_panel", "policy_effect_estimate", "event_study_estimate", "policy_diagnostic",
    ),
    "restricted_not_for_ordinary_analytics": (
        "bridge_claim_anomaly", "finding_ground_truth_match", "rule_evaluation",
    ),
}


def access_of(table: str) -> str:
    for access, tables in ACCESS.items():
        if table in tables:
            return access
    raise ContractError(f"table {table} has no access class")


def review_lead_summary(findings: DataFrame, claims: DataFrame) -> DataFrame:
    """Leads per rule with values withheld where fewer than eleven members are concerned."""
    # findings are a capped list, so they may travel to the claims
    wanted = findings.select("claim_id").filter(F.col("claim_id").isNotNull()).distinct()
    members = (
        claims.select("claim_id", "member_id").join(wanted, "claim_id", "left_semi").dropDuplicates(["claim_id"])
    )
    summary = (
        findings.join(members, "claim_id", "left")
        .groupBy("rule_id", "rule_name", "severity")
        .agg(
            F.count_distinct("finding_id").alias("_leads"),
            total(F.col("amount_at_risk")).alias("_amount"),
            F.count_distinct("member_id").alias("distinct_member_count"),
        )
    )
    return summary.select(
        "rule_id", "rule_name", "severity",
        *suppressed({"review_lead_count": F.col("_leads"), "amount_at_risk": F.col("_amount")},
                    F.col("distinct_member_count")),
        "distinct_member_count",
        F.when(F.col("distinct_member_count") >= MINIMUM_MEMBERS, "published")
        .otherwise("suppressed")
        .alias("privacy_status"),
    )


def suppressed(values: dict[str, Column], members: Column, minimum: int = MINIMUM_MEMBERS) -> list[Column]:
    """Values of groups of at least ``minimum`` members, else null."""
    return [F.when(members >= minimum, value).alias(name) for name, value in values.items()]


def weighted_average(value: Column, weight: Column) -> Column:
    """Sum of products over the sum of weights, in doubles."""
    return F.try_divide(
        F.sum(value.cast("double") * weight.cast("double")), F.sum(weight.cast("double"))
    )


def executive_indicators(
    cost: DataFrame, cash: DataFrame, findings: DataFrame, concentration: DataFrame,
    decomposition: DataFrame, signals: DataFrame, effects: DataFrame,
) -> DataFrame:
    """The fourteen headline metrics, one aggregate row per mart turned long."""
    double = lambda c: c.cast("double")
    members = double(F.sum("eligible_member_months"))
    summed = lambda name: double(F.sum(name))
    per_member = lambda amount: F.try_divide(amount, members)
    share, weight = F.col("top_10_share"), F.col("total_allowed_amount")
    chosen = (F.col("specification") == "balanced_panel") & (F.col("outcome_name") == "paid_pmpm")
    parts = [
        (cost, {
            "BI001": summed("allowed_amount"),
            "BI002": summed("paid_amount"),
            "BI003": per_member(summed("allowed_amount")),
            "BI004": per_member(summed("paid_amount")),
            "BI005": per_member(double(F.sum("claim_count") * 1000)),
            "BI006": per_member(double(F.sum("service_units") * 1000)),
        }),
        (cash, {"BI007": summed("net_payment_cash_flow")}),
        (findings, {"BI008": double(F.count_distinct("finding_id")), "BI009": summed("amount_at_risk")}),
        (concentration, {
            "BI010": weighted_average(share, weight),
            "BI011": weighted_average(F.col("hhi"), weight),
        }),
        (decomposition, {"BI012": summed("total_cost_change")}),
        (signals, {"BI013": double(F.count_if(F.col("signal_status") == "warning"))}),
        (effects, {"BI014": double(F.first(F.when(chosen, F.col("coefficient")), ignorenulls=True))}),
    ]
    long = [
        frame.agg(*[value.alias(name) for name, value in metrics.items()]).unpivot(
            [], list(metrics), "metric_id", "metric_value"
        )
        for frame, metrics in parts
    ]
    values = reduce(DataFrame.unionByName, long)
    names = values.sparkSession.createDataFrame(
        list(INDICATORS), "metric_id string, display_name string, date_role string"
    )
    return F.broadcast(names).join(values, "metric_id", "left").select(
        "metric_id", "display_name", "date_role", "metric_value"
    )


def dashboard_extracts(marts: dict[str, DataFrame], findings: DataFrame, claims: DataFrame,
                       effects: DataFrame) -> dict[str, tuple[DataFrame, list[str]]]:
    """Seven extracts with their published order."""
    cost, cash = marts["monthly_cost_utilization"], marts["monthly_payment_cash_flow"]
    concentration = marts["provider_service_concentration"]
    signals = marts["cost_early_warning_signal"]
    kpi = executive_indicators(cost, cash, findings, concentration, marts["cost_change_decomposition"],
                               signals, effects)
    return {
        "executive_kpi": (kpi, ["metric_id"]),
        "cost_and_utilization": (cost, ["service_month", "plan_key"]),
        "payment_cash_flow": (cash, ["payment_month", "plan_key"]),
        "payment_integrity_review_leads": (review_lead_summary(findings, claims), ["rule_id", "severity"]),
        "provider_service_concentration": (concentration, ["service_month", "plan_key", "entity_type"]),
        "policy_impact": (effects, ["outcome_name", "specification"]),
        "methodology_signals": (signals, ["service_month", "plan_key", "metric_name"]),
    }


def extract_checks(kpi: DataFrame, leads: DataFrame, cost: DataFrame, cash: DataFrame,
                   findings: DataFrame) -> DataFrame:
    """Metric list complete, counts exact, small cells withheld, date roles apart."""
    hidden = F.col("privacy_status") == "suppressed"
    mixed = int("payment_month" in cost.columns) + int("service_month" in cash.columns)

    def differs(check: str, metric: str, recomputed: DataFrame, tolerance: float) -> DataFrame:
        shown = kpi.filter(F.col("metric_id") == metric).select(F.col("metric_value").alias("_v"))
        both = shown.unionAll(recomputed.select(-F.col("_v")))
        return report(both, {check: (F.abs(F.sum("_v")) > tolerance).cast("bigint")})

    leads_counted = findings.agg(F.count_distinct("finding_id").cast("double").alias("_v"))
    allowed = cost.agg(F.sum("allowed_amount").cast("double").alias("_v"))
    return all_checks(
        violations(kpi, {"metric_without_value": F.col("metric_value").isNull()}),
        violations(leads, {"suppressed_value_shown": hidden & F.col("amount_at_risk").isNotNull()}),
        differs("lead_count_differs", "BI008", leads_counted, 0.0),
        differs("allowed_total_differs", "BI001", allowed, 0.01),
        report(kpi, {"date_roles_mixed": F.max(F.lit(mixed))}),
    )


VALUE = "decimal(28,4)"


def reconciliation_metrics(
    claims: DataFrame, memberships: DataFrame, cost: DataFrame, findings: DataFrame, panel: DataFrame,
    effects: DataFrame,
) -> DataFrame:
    """(metric_id, comparison_scope, metric_type, value) to be recomputed elsewhere and compared."""
    def rows(df: DataFrame, metric: str, scope: Column, kind: str, value: Column) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric_id"), scope.cast("string").alias("comparison_scope"),
            F.lit(kind).alias("metric_type"), value.cast(VALUE).alias("value"),
        )

    everything = F.lit("ALL")
    paid = F.col("is_current_version") & (F.col("claim_status") == "paid")
    claim_totals = claims.agg(
        F.count("*").alias("rows"),
        F.count_distinct("claim_id").alias("keys"),
        total(F.when(paid, F.col("total_allowed_amount")), WIDE_MONEY).alias("allowed"),
        total(F.when(paid, F.col("net_paid_amount")), WIDE_MONEY).alias("net"),
    )
    active = memberships.agg(F.count_if(F.col("coverage_status") == "active").alias("active"))
    month_plan = F.concat_ws("|", F.col("service_month").cast("string"), F.col("plan_key").cast("string"))
    per_rule = findings.groupBy("rule_id").agg(
        F.count("*").alias("leads"), total(F.col("amount_at_risk"), WIDE_MONEY).alias("amount")
    )
    per_group = panel.groupBy("treatment_group").agg(F.count("*").alias("months"))
    primary = effects.filter(F.col("specification") == "balanced_panel")
    col = F.col
    parts = [
        rows(claim_totals, "SAS001", everything, "row_count", col("rows")),
        rows(claim_totals, "SAS002", everything, "distinct_key_count", col("keys")),
        rows(claim_totals, "SAS003", everything, "financial", col("allowed")),
        rows(claim_totals, "SAS004", everything, "financial", col("net")),
        rows(active, "SAS005", everything, "row_count", col("active")),
        rows(cost, "SAS006", month_plan, "rate", col("allowed_pmpm")),
        rows(cost, "SAS007", month_plan, "rate", col("units_per_1000")),
        rows(per_rule, "SAS008", col("rule_id"), "row_count", col("leads")),
        rows(per_rule, "SAS009", col("rule_id"), "financial", col("amount")),
        rows(per_group, "SAS010", col("treatment_group"), "row_count", col("months")),
        rows(primary, "SAS011", col("outcome_name"), "coefficient", col("coefficient")),
        rows(primary, "SAS012", col("outcome_name"), "p_value", col("p_value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def compare_metrics(reference: DataFrame, recomputed: DataFrame, execution_id: str) -> DataFrame:
    """Reference metrics against recomputed ones; a missing value never passes."""
    tolerance = F.lit(None).cast(VALUE)
    for kind, value in TOLERANCES.items():
        tolerance = F.when(F.col("metric_type") == kind, F.lit(value).cast(VALUE)).otherwise(tolerance)
    key = ["metric_id", "comparison_scope"]
    joined = reference.withColumnRenamed("value", "reference_value").join(
        recomputed.select(*key, F.col("value").alias("recomputed_value")), key, "left"
    )
    difference = F.abs(F.col("reference_value") - F.col("recomputed_value"))
    return joined.select(
        F.lit(execution_id).alias("execution_id"),
        *key,
        "metric_type",
        "reference_value",
        "recomputed_value",
        difference.alias("absolute_difference"),
        tolerance.alias("tolerance"),
        F.coalesce(difference <= tolerance, F.lit(False)).alias("passed"),
    )


def comparison_checks(results: DataFrame, reference: DataFrame) -> DataFrame:
    """Same keys on both sides, nothing missing, nothing failed, one execution."""
    key = ["metric_id", "comparison_scope"]
    executions = results.agg(F.count_distinct("execution_id").alias("_n"))
    return all_checks(
        row_count("reference_without_result", reference.join(results, key, "left_anti")),
        row_count("result_without_reference", results.join(reference, key, "left_anti")),
        violations(results, {"missing_values": F.col("recomputed_value").isNull(), "failed_comparisons": ~F.col("passed")}),
        violations(executions, {"mixed_executions": F.col("_n") != 1}),
    )


def table_manifest(
    tables: dict[str, DataFrame], keys: dict[str, list[str]], measures: dict[str, list[str]]
) -> DataFrame:
    """Rows, distinct keys and governed totals of each table, one scan per table, long."""
    parts = []
    for name, df in tables.items():
        aggregates = {
            "row_count": F.count("*").cast(VALUE),
            "distinct_key_count": F.count_distinct(*keys[name]).cast(VALUE),
            **{f"sum_{m}": F.coalesce(F.sum(m), F.lit(0)).cast(VALUE) for m in measures.get(name, [])},
        }
        long = df.agg(*[v.alias(k) for k, v in aggregates.items()]).unpivot(
            [], list(aggregates), "check_type", "value"
        )
        parts.append(long.select(F.lit(name).alias("table_name"), F.lit(access_of(name)).alias("access"),
                                 "check_type", "value"))
    return reduce(DataFrame.unionByName, parts)


def load_and_validate(
    tables: dict[str, DataFrame], manifest: DataFrame, keys: dict[str, list[str]], measures: dict[str, list[str]],
    schema: str, strict: bool = True,
) -> DataFrame:
    """Load managed tables, read them back and hold them against the manifest.

    The results are saved as the table ``load_validation`` of the schema; with ``strict`` a failed check raises.
    """
    loaded = {name: save_managed(df, schema, name) for name, df in tables.items()}
    results = save_managed(validate_against_manifest(manifest, table_manifest(loaded, keys, measures)), schema, "load_validation")
    failed = [f"{row['table_name']} {row['check_type']}" for row in results.filter("NOT passed").collect()]
    if strict and failed:
        raise ContractError(f"failed load checks: {', '.join(sorted(failed))}")
    return results


def validate_against_manifest(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Loaded totals against the manifest: counts exactly, sums within a cent."""
    key = ["table_name", "check_type"]
    actual = loaded.select(*key, F.col("value").alias("actual_value"))
    allowed = F.when(F.col("check_type").startswith("sum_"), F.lit("0.01").cast(VALUE)).otherwise(
        F.lit(0).cast(VALUE)
    )
    joined = manifest.withColumnRenamed("value", "expected_value").join(actual, key, "left")
    difference = F.abs(F.col("expected_value") - F.col("actual_value"))
    return joined.select(*key, "expected_value", "actual_value",
                         F.coalesce(difference <= allowed, F.lit(False)).alias("passed"))
