"""Cost, utilization, cash flow, concentration, decomposition and early-warning marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.dates import month_of
from claimloom.functions.numbers import MONEY, RATE, UNITS, count_as_decimal, or_fail, rate, ratio, total
from claimloom.plans.conformed import Facts, with_service_category

SIGNAL_METRICS = ("allowed_pmpm", "paid_pmpm", "claims_per_1000", "units_per_1000")


@dataclass(frozen=True)
class WarningPolicy:
    """When a monthly rate counts as unusual against its own recent past."""

    window_months: int = 12
    minimum_history_months: int = 6
    minimum_member_months: int = 100
    warning_z_score: str = "3.0"
    minimum_relative_change: str = "0.20"


def current_claims(facts: Facts) -> DataFrame:
    return facts.claims.filter("is_current_version")


def exposure(facts: Facts) -> DataFrame:
    """Active member months by coverage month and plan."""
    return (
        facts.memberships.filter(F.col("coverage_status") == "active")
        .groupBy(month_of(F.col("coverage_month")).alias("service_month"), "plan_key")
        .agg(F.count("*").alias("eligible_member_months"))
    )


def paid_current_lines(facts: Facts) -> DataFrame:
    """Lines of current paid claims, under the claim's plan and the line's own service month."""
    paid = current_claims(facts).filter(F.col("claim_status") == "paid").select("claim_id", "plan_key")
    return (
        facts.lines.select(
            "claim_id",
            month_of(F.col("service_date")).alias("service_month"),
            "service_code_system",
            "service_code",
            "units",
            "allowed_amount",
        )
        .join(paid, "claim_id")
    )


def monthly_cost_utilization(facts: Facts) -> DataFrame:
    """One row per exposed month and plan; a claim or line without exposure is an error."""
    paid = F.col("claim_status") == "paid"
    key = ["service_month", "plan_key"]
    active = facts.memberships.filter(F.col("coverage_status") == "active").select(
        month_of(F.col("coverage_month")).alias("service_month"), "plan_key", F.lit(1).alias("_member")
    )
    claims = current_claims(facts).select(
        *key,
        F.lit(1).alias("_claim"),
        paid.cast("int").alias("_paid_claim"),
        F.when(paid, F.col("total_allowed_amount")).alias("_allowed"),
        F.when(paid, F.col("net_paid_amount")).alias("_paid"),
    )
    units = paid_current_lines(facts).select(*key, F.col("units").alias("_units"))
    # three kinds of rows side by side: one aggregation instead of three and two joins
    stacked = active.unionByName(claims, allowMissingColumns=True).unionByName(
        units, allowMissingColumns=True
    )
    count = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    cells = stacked.groupBy(*key).agg(
        F.sum("_member").alias("_members"),
        count("_claim").alias("claim_count"),
        count("_paid_claim").alias("paid_claim_count"),
        total(F.col("_units"), UNITS).alias("service_units"),
        total(F.col("_allowed")).alias("allowed_amount"),
        total(F.col("_paid")).alias("paid_amount"),
    )
    cells = cells.select(
        *key,
        or_fail(F.col("_members"), "claim activity without member exposure", "bigint").alias(
            "eligible_member_months"
        ),
        *[name for name in cells.columns if name not in (*key, "_members")],
    )
    members = count_as_decimal(F.col("eligible_member_months"))
    return cells.select(
        "*",
        rate(F.col("allowed_amount"), members).alias("allowed_pmpm"),
        rate(F.col("paid_amount"), members).alias("paid_pmpm"),
        rate((F.col("claim_count") * 1000).cast("decimal(18,0)"), members).alias("claims_per_1000"),
        rate((F.col("service_units") * 1000).cast("decimal(22,4)"), members).alias("units_per_1000"),
        rate(F.col("allowed_amount"), count_as_decimal(F.col("paid_claim_count"))).alias("allowed_per_claim"),
    )


def monthly_payment_cash_flow(facts: Facts) -> DataFrame:
    """Ledger movements by payment month and plan, over all claim versions."""
    plans = facts.claims.select("claim_id", "plan_key")
    moved = facts.payments.select(
        "claim_id", "transaction_type", "signed_transaction_amount",
        month_of(F.col("transaction_date")).alias("payment_month"),
    ).join(plans, "claim_id", "left")
    payment = F.col("transaction_type") == "payment"
    known = or_fail(F.col("plan_key"), "payment of an unknown claim", "bigint")
    return moved.groupBy("payment_month", known.alias("plan_key")).agg(
        F.count("*").alias("transaction_count"),
        F.count_if(payment).alias("payment_count"),
        F.count_if(~payment).alias("reversal_count"),
        total(F.col("signed_transaction_amount")).alias("net_payment_cash_flow"),
    )


def concentration_of(amounts: DataFrame, entity_type: str) -> DataFrame:
    """Top-ten share and squared-share index over entity totals named ``amount``.

    The index is a ratio of two sums, so entity rows are aggregated once and never regrouped; the
    top ten come from a rank filter that Spark limits before its shuffle.
    """
    key = ["service_month", "plan_key"]
    amount = F.col("amount")
    sums = amounts.groupBy(*key).agg(
        F.count("*").alias("entity_count"),
        total(amount).alias("total_allowed_amount"),
        F.sum(amount * amount).alias("_squares"),
    )
    ranked = Window.partitionBy(*key).orderBy(amount.desc())
    top = (
        amounts.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= 10)
        .groupBy(*key)
        .agg(total(amount).alias("top_10_allowed_amount"))
    )
    whole = F.col("total_allowed_amount").cast("double")
    return sums.join(top, key).select(
        *key,
        F.lit(entity_type).alias("entity_type"),
        "entity_count",
        "total_allowed_amount",
        "top_10_allowed_amount",
        rate(F.col("top_10_allowed_amount"), F.col("total_allowed_amount")).alias("top_10_share"),
        F.round(F.try_divide(F.col("_squares").cast("double"), whole * whole), 4).cast(RATE).alias("hhi"),
    )


def provider_amounts(facts: Facts) -> DataFrame:
    return (
        current_claims(facts)
        .filter(F.col("claim_status") == "paid")
        .groupBy("service_month", "plan_key", "billing_provider_key")
        .agg(total(F.col("total_allowed_amount")).alias("amount"))
    )


def service_amounts(facts: Facts) -> DataFrame:
    return (
        paid_current_lines(facts)
        .groupBy("service_month", "plan_key", "service_code_system", "service_code")
        .agg(total(F.col("allowed_amount")).alias("amount"))
    )


def provider_service_concentration(facts: Facts) -> DataFrame:
    return concentration_of(provider_amounts(facts), "provider").unionByName(
        concentration_of(service_amounts(facts), "service")
    )


def category_totals(facts: Facts) -> DataFrame:
    """Allowed amount and units of current paid lines by month, plan and service category.

    Lines are summed per service first, so the category lookup meets aggregates only.
    """
    sums = lambda amount: (
        total(F.col(amount)).alias("amount"), total(F.col("units"), UNITS).alias("units")
    )
    key = ["service_month", "plan_key"]
    services = (
        paid_current_lines(facts)
        .groupBy(*key, "service_code_system", "service_code")
        .agg(*sums("allowed_amount"))
    )
    return (
        with_service_category(services, facts.service_categories)
        .groupBy(*key, "service_category")
        .agg(*sums("amount"))
    )


def cost_change_decomposition(facts: Facts) -> DataFrame:
    """Year-over-year change of each month, plan and category split into price, volume and mix."""
    totals = category_totals(facts).filter(F.col("units") != 0)
    current = totals.select(
        F.col("service_month").alias("reporting_month"),
        F.add_months("service_month", -12).alias("base_month"),
        "plan_key",
        "service_category",
        F.col("amount").alias("_now"),
        F.col("units").alias("_now_units"),
    )
    base = totals.select(
        F.col("service_month").alias("base_month"),
        "plan_key",
        "service_category",
        F.col("amount").alias("_was"),
        F.col("units").alias("_was_units"),
    )
    now, was = F.col("_now"), F.col("_was")

    def scaled(amount: Column, times: Column, per: Column) -> Column:
        # one division at the end keeps a dozen digits
        return ratio((amount * times).cast("decimal(28,6)"), per.cast("decimal(16,4)"))

    price = scaled(now, F.col("_was_units"), F.col("_now_units")) - was
    volume = scaled(was, F.col("_now_units"), F.col("_was_units")) - was
    money = lambda value: F.round(value, 2).cast(MONEY)
    split = current.join(base, ["base_month", "plan_key", "service_category"]).select(
        "*", (now - was).alias("_change"), price.alias("_price"), volume.alias("_volume")
    )
    mix = F.col("_change") - F.col("_price") - F.col("_volume")
    return split.select(
        "reporting_month",
        "base_month",
        "plan_key",
        "service_category",
        was.alias("base_allowed_amount"),
        now.alias("current_allowed_amount"),
        money(F.col("_change")).alias("total_cost_change"),
        money(F.col("_price")).alias("price_effect"),
        money(F.col("_volume")).alias("utilization_effect"),
        money(mix).alias("mix_effect"),
        money(F.col("_change") - F.col("_price") - F.col("_volume") - mix).alias("reconciliation_residual"),
    )


def exact_median(values: Column) -> Column:
    """Median of an array of four-digit decimals, rounded half up to four digits."""
    ordered = F.array_sort(values)
    size = F.size(values)
    lower = F.element_at(ordered, F.floor((size + 1) / 2).cast("int"))
    upper = F.element_at(ordered, F.floor(size / 2 + 1).cast("int"))
    return F.round((lower + upper) / F.lit(2).cast("decimal(1,0)"), 4).cast(RATE)


def early_warning_signals(cost: DataFrame, policy: WarningPolicy = WarningPolicy()) -> DataFrame:
    """Compare each monthly rate with the median of its previous months.

    A series has one row per month, so every window is bounded by the calendar.
    """
    long = cost.unpivot(
        ["service_month", "plan_key", "eligible_member_months"],
        list(SIGNAL_METRICS),
        "metric_name",
        "metric_value",
    )
    past = (
        Window.partitionBy("plan_key", "metric_name")
        .orderBy("service_month")
        .rowsBetween(-policy.window_months, -1)
    )
    history = long.withColumn("_past", F.collect_list("metric_value").over(past)).withColumn(
        "history_month_count", F.size("_past").cast("bigint")
    )
    enough = (F.col("history_month_count") >= policy.minimum_history_months) & (
        F.col("eligible_member_months") >= policy.minimum_member_months
    )
    centered = history.withColumn("baseline_median", F.when(enough, exact_median(F.col("_past"))))
    center = F.col("baseline_median")
    scaled = centered.withColumn(
        "baseline_mad",
        F.when(enough, exact_median(F.transform("_past", lambda x: F.abs(x - center).cast(RATE)))),
    )
    distance = F.col("metric_value") - center
    scored = scaled.withColumn("robust_z_score", rate(distance, F.col("baseline_mad"))).withColumn(
        "relative_change", rate(distance, center)
    )
    unusual = (F.col("robust_z_score") >= F.lit(policy.warning_z_score).cast(RATE)) & (
        F.abs("relative_change") >= F.lit(policy.minimum_relative_change).cast(RATE)
    )
    return scored.withColumn(
        "signal_status",
        F.when(~enough, "insufficient_history")
        .when(F.coalesce(unusual, F.lit(False)), "warning")
        .otherwise("normal"),
    ).select(
        "service_month",
        "plan_key",
        "metric_name",
        "metric_value",
        "history_month_count",
        "baseline_median",
        "baseline_mad",
        "robust_z_score",
        "relative_change",
        "signal_status",
        F.concat(
            "metric_name", F.lit(": "), "signal_status", F.lit("; history_months="),
            F.col("history_month_count").cast("string"),
        ).alias("explanation"),
    )


def cost_marts(facts: Facts) -> dict[str, DataFrame]:
    """All five marts by contract name."""
    cost = monthly_cost_utilization(facts)
    return {
        "monthly_cost_utilization": cost,
        "monthly_payment_cash_flow": monthly_payment_cash_flow(facts),
        "provider_service_concentration": provider_service_concentration(facts),
        "cost_change_decomposition": cost_change_decomposition(facts),
        "cost_early_warning_signal": early_warning_signals(cost),
    }
