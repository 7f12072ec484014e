"""Score review leads against labels that detection never saw."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.contracts.review_rules import RULES, RuleSettings
from claimloom.functions.numbers import MONEY, RATE, even_rate, total
from claimloom.operators.keys import dense_positions
from claimloom.operators.marks import may_match
from claimloom.plans.conformed import Facts
from claimloom.plans.rules import PEERS, SERVICE, peer_lines, provider_months, with_repeated_services
from claimloom.session import written


def canonical_target() -> Column:
    """Identity of a finding or label: the record of its scope, or provider with target or period."""
    scope = F.col("label_scope")
    return (
        F.when(scope == "claim", F.col("claim_id"))
        .when(scope == "claim_line", F.col("claim_line_id"))
        .when(scope == "payment_transaction", F.col("payment_transaction_id"))
        .when(scope == "provider", F.concat_ws(":", "provider_id", "target_record_id"))
        .otherwise(F.concat_ws(":", "provider_id", F.col("reporting_period").cast("string")))
    )


def resolve_labels(star: dict[str, DataFrame]) -> DataFrame:
    """Bridge rows with the identifiers their keys stand for."""
    lookups = (
        ("fact_claim", "claim_key", "claim_id"),
        ("fact_claim_line", "claim_line_key", "claim_line_id"),
        ("fact_payment_transaction", "payment_transaction_key", "payment_transaction_id"),
    )
    labels = bridge = written(star["bridge_claim_anomaly"])
    for table, key, name in lookups:
        named = bridge.select(key).filter(F.col(key).isNotNull())
        labels = labels.join(may_match(star[table].select(key, name), key, named), key, "left")
    dates = star["dim_date"].select(
        F.col("date_key").alias("reporting_period_date_key"), F.col("calendar_date").alias("reporting_period")
    )
    return labels.join(dates, "reporting_period_date_key", "left")


def match_labels(findings: DataFrame, labels: DataFrame, settings: RuleSettings) -> DataFrame:
    """Full outer match on rule and canonical target; of several labels on one target the last id counts."""
    key = ["rule_id", "canonical_target_id"]
    found = findings.withColumn("canonical_target_id", canonical_target()).select(
        *key, F.col("label_scope").alias("_found_scope"), "finding_id", "amount_at_risk"
    )
    known = labels.withColumn("canonical_target_id", canonical_target()).select(
        *key, F.col("label_scope").alias("_known_scope"), "injection_id", "expected_financial_exposure"
    )
    # aggregated, so that a target with very many labels needs no window
    known = known.groupBy(*key).agg(
        F.max(F.struct("injection_id", "_known_scope", "expected_financial_exposure")).alias("_last")
    ).select(*key, "_last.*")
    finding, label = F.col("finding_id"), F.col("injection_id")
    money = lambda name: F.coalesce(name, F.lit(0)).cast(MONEY).alias(name)
    matched = found.join(known, key, "full").select(
        *key,
        "finding_id",
        "injection_id",
        F.coalesce("_found_scope", "_known_scope").alias("label_scope"),
        F.when(finding.isNotNull() & label.isNotNull(), "true_positive")
        .when(finding.isNotNull(), "false_positive")
        .otherwise("false_negative")
        .alias("match_status"),
        money("amount_at_risk"),
        money("expected_financial_exposure"),
    )
    number = (F.col("position") + 1).cast("string")
    wide = F.lpad(number, F.greatest(F.length(number), F.lit(10)), F.lit("0"))
    return dense_positions(matched, key).select(
        F.concat(F.lit("MAT"), wide).alias("match_id"),
        F.lit(settings.run_id).alias("run_id"),
        "finding_id", "injection_id", "rule_id", "label_scope", "canonical_target_id", "match_status",
        "amount_at_risk", "expected_financial_exposure",
        F.lit(True).alias("evaluation_only"),
    )


def eligible_targets(facts: Facts, settings: RuleSettings) -> DataFrame:
    """Size of the population each rule looks at."""
    size = F.count("*").alias("eligible_target_count")

    def for_rules(frame: DataFrame, *rules: str) -> DataFrame:
        names = F.explode(F.array(*[F.lit(rule) for rule in rules])).alias("rule_id")
        return frame.agg(size).select(names, "eligible_target_count")

    groups = peer_lines(facts).groupBy(*PEERS).agg(F.count("*").alias("_peers"))
    large = groups.filter(F.col("_peers") >= settings.minimum_peer_count)
    parts = [
        for_rules(facts.lines, "PI001", "PI002"),
        for_rules(facts.payments, "PI003", "PI004"),
        for_rules(facts.claims, "PI005", "PI006", "PI010"),
        large.agg(F.coalesce(F.sum("_peers"), F.lit(0)).alias("eligible_target_count")).select(
            F.lit("PI007").alias("rule_id"), "eligible_target_count"
        ),
        for_rules(provider_months(facts, settings), "PI008"),
        services_in_claims(facts).select(F.lit("PI009").alias("rule_id"), "eligible_target_count"),
    ]
    return reduce(DataFrame.unionByName, parts)


def services_in_claims(facts: Facts) -> DataFrame:
    """Number of distinct pairs of claim and service, as one row; only claims that may repeat a service are looked into."""
    repeated = with_repeated_services(facts).lines
    signed = lambda frame, sign: frame.agg((F.count("*") * sign).alias("_n"))
    pairs = repeated.select("claim_id", *SERVICE).distinct()
    parts = [signed(facts.lines, 1), signed(repeated, -1), signed(pairs, 1)]
    return reduce(DataFrame.unionByName, parts).agg(F.sum("_n").alias("eligible_target_count"))


def evaluate(matches: DataFrame, eligible: DataFrame, settings: RuleSettings) -> DataFrame:
    """Confusion counts, rates and thresholds per rule and overall."""
    status = F.col("match_status")
    exposure = F.col("expected_financial_exposure")
    counts = [
        F.count_if(status == "true_positive").alias("true_positive_count"),
        F.count_if(status == "false_positive").alias("false_positive_count"),
        F.count_if(status == "false_negative").alias("false_negative_count"),
        total(F.when(F.col("injection_id").isNotNull(), exposure)).alias("labeled_expected_exposure"),
        total(F.when(status == "true_positive", exposure)).alias("detected_expected_exposure"),
    ]
    spark = matches.sparkSession
    rules = spark.createDataFrame([(rule[0],) for rule in RULES], "rule_id string")
    per_rule = rules.join(matches.groupBy("rule_id").agg(*counts), "rule_id", "left").join(
        eligible, "rule_id", "left"
    )
    names = [c for c in per_rule.columns if c != "rule_id"]
    money = ("labeled_expected_exposure", "detected_expected_exposure")
    per_rule = per_rule.select(
        "rule_id",
        *[F.coalesce(n, F.lit(0)).cast(MONEY if n in money else "bigint").alias(n) for n in names],
    )
    overall = per_rule.agg(
        *[F.sum(n).cast(MONEY if n in money else "bigint").alias(n) for n in names]
    ).withColumn("rule_id", F.lit("ALL"))
    rows = per_rule.unionByName(overall)
    col = F.col
    tp, fp, fn = col("true_positive_count"), col("false_positive_count"), col("false_negative_count")
    rows = rows.withColumn(
        "true_negative_count", F.greatest(col("eligible_target_count") - tp - fp - fn, F.lit(0))
    )
    decimal = lambda count: count.cast("decimal(16,0)")
    exact = lambda n, d: F.try_divide(decimal(n), decimal(d))
    tn = col("true_negative_count")
    limit = lambda text: F.lit(text).cast(RATE)
    passed = lambda test: F.coalesce(test, F.lit(False))
    # the fixed rule list has eleven rows, overall last
    order = F.when(col("rule_id") == "ALL", len(RULES) + 1).otherwise(F.substring("rule_id", 3, 3).cast("int"))
    return rows.select(
        F.concat(F.lit("EVA"), F.lpad(order.cast("string"), 10, "0")).alias("evaluation_id"),
        F.lit(settings.run_id).alias("run_id"),
        F.when(col("rule_id") == "ALL", "overall").otherwise("rule").alias("evaluation_scope"),
        "rule_id",
        "eligible_target_count",
        "true_positive_count",
        "false_positive_count",
        "false_negative_count",
        "true_negative_count",
        even_rate(decimal(tp), decimal(tp + fp)).alias("precision"),
        even_rate(decimal(tp), decimal(tp + fn)).alias("recall"),
        even_rate(decimal(fp), decimal(fp + tn)).alias("false_positive_rate"),
        *money,
        even_rate(col(money[1]), col(money[0])).alias("exposure_recall"),
        passed(exact(tp, tp + fp) >= limit(settings.minimum_precision)).alias("precision_threshold_passed"),
        passed(exact(tp, tp + fn) >= limit(settings.minimum_recall)).alias("recall_threshold_passed"),
        passed(exact(fp, fp + tn) < limit(settings.maximum_false_positive_rate)).alias(
            "false_positive_rate_threshold_passed"
        ),
        F.lit(True).alias("evaluation_only"),
    )


def run_summary(findings: DataFrame, settings: RuleSettings) -> DataFrame:
    """One row describing the run."""
    return findings.agg(
        F.count("*").alias("finding_count"), total(F.col("amount_at_risk")).alias("total_amount_at_risk")
    ).select(
        F.lit(settings.run_id).alias("run_id"),
        F.lit(settings.contract_version).alias("contract_version"),
        F.lit(settings.source_variant).alias("source_variant"),
        F.lit(settings.deterministic_seed).cast("bigint").alias("deterministic_seed"),
        F.lit("completed").alias("run_status"),
        F.lit(len(RULES)).alias("enabled_rule_count"),
        "finding_count",
        "total_amount_at_risk",
        F.lit(True).alias("findings_frozen"),
        F.lit(False).alias("ground_truth_accessed_during_detection"),
    )
