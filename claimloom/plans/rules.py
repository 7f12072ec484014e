"""Ten review rules over conformed claims facts.

Each rule returns candidates in one shape.  Groups inside a claim, a peer group or a provider are
reduced by aggregation and joined back, so no rule gathers a whole group in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.contracts.review_rules import (
    COMPATIBLE_DIAGNOSES, DIAGNOSIS_CATEGORIES, FINDING_TEXTS, RULES, RuleSettings,
)
from claimloom.functions.numbers import MONEY, RATE, total
from claimloom.operators.marks import bit_of, may_match
from claimloom.plans.conformed import Facts, replace
from claimloom.session import written

RANK = "decimal(38,12)"
BUCKET = 10_000  # a money bucket holds at most a million distinct cent amounts
LEAST_TIMES = 1.02  # up to this multiple, rounding to cents could flag two amounts of one growing bucket

SERVICE = ("service_code_system", "service_code")
NEAR_SIGNATURE = (
    "rendering_provider_id", *SERVICE, "service_date", "place_of_service_code", "charge_amount",
    "allowed_amount", "member_liability_amount",
)


def candidate(
    rule_id: str,
    target: Column,
    amount: Column,
    observed: Column,
    threshold: Column | None = None,
    rank: Column | None = None,
    **ids: Column,
) -> list[Column]:
    """Columns of a candidate row; the rank defaults to the raw amount."""
    scope, target_table, explanation, evidence = FINDING_TEXTS[rule_id]
    text = lambda name: ids.get(name, F.lit(None)).cast("string").alias(name)
    return [
        F.lit(rule_id).alias("rule_id"),
        F.lit(scope).alias("label_scope"),
        F.lit(target_table).alias("target_table"),
        target.alias("target_record_id"),
        F.bround(F.greatest(amount, F.lit(0)), 2).cast(MONEY).alias("amount_at_risk"),
        F.lit(explanation).alias("explanation"),
        F.lit(evidence).alias("evidence_name"),
        observed.cast("string").alias("observed_value"),
        (F.lit(None) if threshold is None else threshold).cast("string").alias("threshold_value"),
        text("claim_id"),
        text("claim_line_id"),
        text("payment_transaction_id"),
        text("provider_id"),
        ids.get("reporting_period", F.lit(None)).cast("date").alias("reporting_period"),
        (amount if rank is None else rank).cast(RANK).alias("ranking_value"),
    ]


def last_lines(facts: Facts) -> DataFrame:
    return facts.lines.groupBy("claim_id").agg(F.max("line_number").alias("_last_line"))


def with_repeated_first_lines(facts: Facts) -> Facts:
    """The facts with, of all lines, those of claims whose first line may share its signature with another.

    A claim keeps one bit for each signature of its first lines and of its others, so only one row a claim is
    aggregated.  Other claims can't hold a duplicate; those kept by a shared bit are judged in full like the rest.
    """
    bit = bit_of(F.pmod(F.xxhash64(*NEAR_SIGNATURE), F.lit(64)))
    first = F.coalesce(F.col("line_number") == 1, F.lit(False))
    claims = written(
        facts.lines.groupBy("claim_id")
        .agg(
            F.bit_or(F.when(first, bit).otherwise(0)).alias("_first"),
            F.bit_or(F.when(first, 0).otherwise(bit)).alias("_others"),
            F.count_if(first).alias("_firsts"),
        )
        .filter((F.col("_first").bitwiseAND(F.col("_others")) != 0) | (F.col("_firsts") > 1))
        .select("claim_id")
    )
    kept = facts.lines.select("claim_id", "line_number", "claim_line_id", *NEAR_SIGNATURE, "units", "plan_paid_amount")
    return replace(facts, lines=written(may_match(kept, "claim_id", claims).join(claims, "claim_id", "left_semi")))


def with_repeated_services(facts: Facts) -> Facts:
    """The facts with, of all lines, those of claims that may bill a service twice, by two words of bits a claim."""
    place = F.pmod(F.xxhash64(*SERVICE), F.lit(128))
    bits = lambda half: F.bit_or(F.when(F.floor(place / 64) == half, bit_of(place % 64)).otherwise(0))
    claims = written(
        facts.lines.groupBy("claim_id")
        .agg(F.count("*").alias("_lines"), bits(0).alias("_low"), bits(1).alias("_high"))
        .filter(F.col("_lines") > F.bit_count("_low") + F.bit_count("_high"))
        .select("claim_id")
    )
    kept = facts.lines.select("claim_id", "claim_line_id", *SERVICE, "plan_paid_amount")
    known = claims.select(F.col("claim_id").alias("_claim"))
    return replace(facts, lines=written(
        may_match(kept, "claim_id", claims).join(known, F.col("claim_id").eqNullSafe(F.col("_claim")), "left_semi")))


def id_number(identifier: Column) -> Column:
    return F.substr(identifier, F.lit(4)).cast("bigint")


def exact_duplicates(facts: Facts, repeated: Facts | None = None) -> DataFrame:
    """PI001: exactly two equal lines, the first of the claim and its last.

    Groups keep numbers only, which hash-aggregate; the few flagged lines are looked up afterwards.
    ``repeated`` is ``with_repeated_first_lines(facts)``, where another rule shares it.
    """
    facts = repeated or with_repeated_first_lines(facts)
    groups = (
        facts.lines.groupBy("claim_id", *NEAR_SIGNATURE, "units")
        .agg(
            F.count("*").alias("_size"),
            F.min("line_number").alias("_first"),
            F.max("line_number").alias("line_number"),
        )
        .filter((F.col("_size") == 2) & (F.col("_first") == 1))
        .select("claim_id", "line_number", "_size")
    )
    flagged = groups.join(last_lines(facts), "claim_id").filter(F.col("line_number") == F.col("_last_line"))
    copies = facts.lines.select("claim_id", "line_number", "claim_line_id", "plan_paid_amount").join(
        flagged, ["claim_id", "line_number"]
    )
    line = F.col("claim_line_id")
    return copies.select(
        *candidate(
            "PI001", line, F.col("plan_paid_amount"),
            F.col("_size"), F.lit(1), id_number(line), claim_id=F.col("claim_id"), claim_line_id=line,
        )
    )


def near_duplicates(facts: Facts, repeated: Facts | None = None) -> DataFrame:
    """PI002: a last line repeating another with units a quarter apart."""
    facts = repeated or with_repeated_first_lines(facts)
    key = ["claim_id", *NEAR_SIGNATURE]
    groups = (
        facts.lines.groupBy(*key)
        .agg(F.min("line_number").alias("_first"), F.min("units").alias("_low"), F.max("units").alias("_high"))
        .filter((F.col("_first") == 1) & (F.col("_low") != F.col("_high")))
        .select(*key)
    )
    same = lambda left, right: reduce(
        lambda a, b: a & b, [left[name].eqNullSafe(right[name]) for name in key]
    )
    member = facts.lines.select(*key, "claim_line_id", "line_number", "units", "plan_paid_amount")
    grouped = member.alias("m").join(groups.alias("g"), same(member, groups), "left_semi")
    last = grouped.join(last_lines(facts), "claim_id").filter(
        (F.col("line_number") == F.col("_last_line")) & (F.col("units") % 1 != 0)
    )
    quarter = F.lit("0.25").cast("decimal(18,4)")
    wanted = last.select(
        "*", F.explode(F.array(F.col("units") - quarter, F.col("units") + quarter)).alias("_other_units")
    )
    others = grouped.select(*[F.col(name).alias(f"o_{name}") for name in [*key, "units"]])
    pairs = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"o_{name}")) for name in key]
    ) & (F.col("_other_units") == F.col("o_units"))
    flagged = wanted.join(others, pairs, "left_semi").dropDuplicates(["claim_line_id"])
    # the evidence lists every distinct unit value of the flagged group
    listed = (
        flagged.select(*key, "claim_line_id", "units", "plan_paid_amount")
        .join(
            others,
            reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"o_{name}")) for name in key]),
        )
        .groupBy("claim_id", "claim_line_id", "units", "plan_paid_amount")
        .agg(F.array_sort(F.collect_set(F.col("o_units").cast("string"))).alias("_units"))
    )
    line = F.col("claim_line_id")
    text = F.concat(F.lit("['"), F.array_join("_units", "', '"), F.lit("']"))
    return listed.select(
        *candidate(
            "PI002", line, F.col("plan_paid_amount"),
            F.col("units"), text, claim_id=F.col("claim_id"), claim_line_id=line,
        )
    )


def repayments_after_reversal(facts: Facts) -> DataFrame:
    """PI003: positive payment after any reversal of the same claim."""
    reversed_at = (
        facts.payments.filter(F.col("transaction_type") == "reversal")
        .groupBy("claim_id")
        .agg(F.min("transaction_sequence_number").alias("_reversed_at"))
    )
    amount = F.col("signed_transaction_amount")
    payment = F.col("payment_transaction_id")
    later = (
        facts.payments.filter((F.col("transaction_type") == "payment") & (amount > 0))
        .join(reversed_at, "claim_id")
        .filter(F.col("transaction_sequence_number") > F.col("_reversed_at"))
    )
    return later.select(
        *candidate(
            "PI003", payment, amount,
            amount, F.lit("0.00"), claim_id=F.col("claim_id"), payment_transaction_id=payment,
        )
    )


def impossible_dates(facts: Facts) -> DataFrame:
    """PI004: payment dated before the service."""
    payment = F.col("payment_transaction_id")
    # one row a claim tells which have such a payment, and few do
    earliest = facts.payments.groupBy("claim_id").agg(F.min("transaction_date").alias("_earliest"))
    claims = written(facts.claims.select("claim_id", "service_date").join(earliest, "claim_id").filter(
        F.col("_earliest") < F.col("service_date")).drop("_earliest"))
    early = may_match(facts.payments, "claim_id", claims).join(claims, "claim_id").filter(
        F.col("transaction_date") < F.col("service_date")
    )
    return early.select(
        *candidate(
            "PI004", payment, F.lit(0).cast(MONEY),
            F.col("transaction_date"), F.col("service_date"),
            claim_id=F.col("claim_id"), payment_transaction_id=payment,
        )
    )


def header_mismatches(facts: Facts) -> DataFrame:
    """PI005: header allowed amount differs from its lines; no lines count as zero."""
    sums = facts.lines.groupBy("claim_id").agg(total(F.col("allowed_amount")).alias("_lines"))
    header = F.col("total_allowed_amount")
    lines = F.coalesce("_lines", F.lit(0)).cast(MONEY)
    claim = F.col("claim_id")
    return (
        facts.claims.join(sums, "claim_id", "left")
        .filter(header != lines)
        .select(
            *candidate(
                "PI005", claim, F.abs(header - lines),
                header, lines, claim_id=claim,
            )
        )
    )


def overpayments(facts: Facts) -> DataFrame:
    """PI006: net payment above allowed less member liability."""
    governed = (F.col("total_allowed_amount") - F.col("total_member_liability_amount")).cast(MONEY)
    paid, claim = F.col("net_paid_amount"), F.col("claim_id")
    return facts.claims.filter(paid > governed).select(
        *candidate(
            "PI006", claim, paid - governed,
            paid, governed, claim_id=claim,
        )
    )


def peer_lines(facts: Facts) -> DataFrame:
    billing = facts.claims.select(
        "claim_id", F.col("billing_provider_id").alias("provider_id"), "specialty_group"
    )
    return facts.lines.select("claim_line_id", "claim_id", "service_code_system", "allowed_amount").join(
        billing, "claim_id"
    )


PEERS = ("specialty_group", "service_code_system")


def peer_amounts(facts: Facts, settings: RuleSettings, times: float | None = None) -> DataFrame:
    """Distinct amounts of every large enough peer group, each with its lower neighbour.

    Peer groups are few and large.  Equal amounts collapse first; the neighbour then comes from the
    same money bucket or, for a bucket's lowest amount, from the nearest lower bucket.

    With ``times`` amounts from one up that can't be so many times their neighbour are left out: buckets then grow with
    their amounts, by less than that, so of each only the lowest counts, and all combine before the shuffle.
    """
    amount = F.col("allowed_amount")
    bucket, single = F.floor(amount / BUCKET), amount
    if times is not None and times > LEAST_TIMES:
        growing = F.floor(F.ln(amount.cast("double")) / math.log((1 + times) / 2)) + 1
        bucket, single = F.when(amount < 1, bucket).otherwise(growing), F.when(amount < 1, amount)
    key = [*PEERS, "_bucket", "_single"]
    known = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in (*PEERS, "_bucket", "allowed_amount")])
    # the filter keeps both uses of ``distinct`` alike, so that they share one exchange
    distinct = (
        peer_lines(facts)
        .withColumn("_bucket", bucket)
        .withColumn("_single", single)
        .filter(known)
        .groupBy(*key)
        .agg(F.min("allowed_amount").alias("allowed_amount"), F.max("allowed_amount").alias("_highest"), F.count("*").alias("_lines"))
    )
    buckets = distinct.groupBy(*PEERS, "_bucket").agg(
        F.max("_highest").alias("_top"), F.sum("_lines").alias("_bucket_lines")
    )
    ordered = Window.partitionBy(*PEERS).orderBy("_bucket")
    everything = Window.partitionBy(*PEERS)
    below = buckets.select(
        *PEERS,
        "_bucket",
        F.lag("_top").over(ordered).alias("_below"),
        F.sum("_bucket_lines").over(everything).alias("_peers"),
    ).filter(F.col("_peers") >= settings.minimum_peer_count)
    inside = Window.partitionBy(*PEERS, "_bucket").orderBy("allowed_amount")
    return distinct.join(below, [*PEERS, "_bucket"]).withColumn(
        "_lower", F.coalesce(F.lag("_highest").over(inside), "_below")
    )


def unusual_amounts(facts: Facts, settings: RuleSettings) -> DataFrame:
    """PI007: amount at least the multiple of the next lower amount among its peers."""
    times = F.lit(settings.peer_threshold_multiplier).cast("decimal(6,4)")
    limit = lambda value: F.bround(value * times, 2).cast(MONEY)
    amount, lower = F.col("allowed_amount"), F.col("_lower")
    values = peer_amounts(facts, settings, float(settings.peer_threshold_multiplier))
    above_lower = lower.isNotNull() & (amount >= limit(lower))
    # later lines of a tie compare with an equal amount, which passes only at or below two cents
    passes_tied = (F.col("_lines") > 1) & (amount >= limit(amount))
    flagged = written(values.filter(above_lower | passes_tied).select(
        *PEERS, "allowed_amount", "_lower", above_lower.alias("_first_flagged"), passes_tied.alias("_rest_flagged")
    ))
    # each flagged amount above zero is the multiple of the one below, so a peer group has some 200 at most
    marks = flagged.filter(amount > 0).select("service_code_system", "allowed_amount").distinct()
    marked = F.broadcast(marks.withColumn("_marked", F.lit(True)))
    lines = facts.lines.select("claim_line_id", "claim_id", "service_code_system", "allowed_amount")
    lines = lines.join(marked, ["service_code_system", "allowed_amount"], "left").filter((amount <= 0) | F.col("_marked"))
    matched = peer_lines(replace(facts, lines=lines)).join(flagged, [*PEERS, "allowed_amount"])
    firsts = matched.groupBy(*PEERS, "allowed_amount").agg(F.min("claim_line_id").alias("_first_line"))
    is_first = F.col("claim_line_id") == F.col("_first_line")
    compared = matched.join(firsts, [*PEERS, "allowed_amount"]).filter(
        (is_first & F.col("_first_flagged")) | (~is_first & F.col("_rest_flagged"))
    ).withColumn("_comparison", F.when(is_first, lower).otherwise(amount))
    threshold = limit(F.col("_comparison"))
    line = F.col("claim_line_id")
    return compared.select(
        *candidate(
            "PI007", line, amount - F.col("_comparison"),
            amount, threshold,
            F.when(threshold != 0, F.try_divide(amount, threshold).cast(RANK)).otherwise(amount.cast(RANK)),
            claim_id=F.col("claim_id"), claim_line_id=line, provider_id=F.col("provider_id"),
        )
    )


def provider_months(facts: Facts, settings: RuleSettings) -> DataFrame:
    """Provider months with enough history; windows run over one row per month."""
    monthly = facts.claims.groupBy(
        F.col("billing_provider_id").alias("provider_id"), F.col("service_month").alias("reporting_period")
    ).agg(F.count("*").alias("_claims"), total(F.col("net_paid_amount")).alias("_paid"))
    past = Window.partitionBy("provider_id").orderBy("reporting_period").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = F.year("reporting_period") < settings.policy_start.year
    return monthly.select(
        "*",
        F.sum(counts.cast("int")).over(past).alias("_months"),
        F.sum(F.when(counts, F.col("_claims"))).over(past).alias("_history"),
    ).filter(
        (F.col("_months") >= settings.minimum_historical_months)
        & (F.col("_history") >= settings.minimum_historical_claims)
    )


def utilization_surges(facts: Facts, settings: RuleSettings) -> DataFrame:
    """PI008: provider month far above the provider's earlier monthly average."""
    factor = F.lit(settings.utilization_surge_factor).cast("decimal(6,2)")
    decimal = lambda name: F.col(name).cast("decimal(16,0)")
    surge = provider_months(facts, settings).filter(
        (F.year("reporting_period") >= settings.policy_start.year)
        & (decimal("_claims") * decimal("_months") > decimal("_history") * factor)
    )
    threshold = F.bround((decimal("_history") * factor).cast("decimal(18,2)") / decimal("_months"), 4)
    target = F.concat_ws(":", "provider_id", F.col("reporting_period").cast("string"))
    return surge.select(
        *candidate(
            "PI008", target, F.col("_paid"), F.col("_claims"), threshold.cast(RATE),
            provider_id=F.col("provider_id"), reporting_period=F.col("reporting_period"),
        )
    )


def repeated_procedures(facts: Facts, limits: DataFrame) -> DataFrame:
    """PI009: a service billed exactly once more than its limit within a claim.

    ``limits`` holds (service_code_system, service_code, limit).
    """
    # from a limit of one up, only claims that bill a service twice can exceed it
    if limits.filter(F.col("limit") < 1).isEmpty():
        facts = with_repeated_services(facts)
    counted = facts.lines.groupBy("claim_id", *SERVICE).agg(F.count("*").alias("_count"))
    over = counted.join(limits.withColumnRenamed("limit", "_limit"), list(SERVICE)).filter(
        F.col("_count") == F.col("_limit") + 1
    )
    # groups are now limit + 1 lines long, plus the same code under other systems
    matching = facts.lines.select("claim_id", "service_code", "claim_line_id", "plan_paid_amount").join(
        over, ["claim_id", "service_code"]
    )
    place = F.row_number().over(
        Window.partitionBy("claim_id", *SERVICE).orderBy("claim_line_id")
    )
    excess = matching.withColumn("_place", place).groupBy("claim_id", *SERVICE, "_count", "_limit").agg(
        total(F.when(F.col("_place") > F.col("_limit"), F.col("plan_paid_amount"))).alias("_excess"),
        F.max(id_number(F.col("claim_line_id"))).alias("_newest"),
    )
    claim = F.col("claim_id")
    return excess.select(
        *candidate(
            "PI009", claim, F.col("_excess"),
            F.col("_count"), F.col("_limit"), F.col("_newest"), claim_id=claim,
        )
    )


def constant_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(item) for pair in mapping.items() for item in pair])


def diagnosis_mismatches(facts: Facts, settings: RuleSettings) -> DataFrame:
    """PI010: the single procedure category of a claim rules out its principal diagnosis."""
    diagnoses = {code: name for name, codes in DIAGNOSIS_CATEGORIES.items() for code in codes}
    never = {
        category: code
        for category, code in settings.incompatible_diagnosis.items()
        if diagnoses.get(code) not in COMPATIBLE_DIAGNOSES[category]
    }
    names = F.array(*[F.lit(name) for name in never])
    # categories as numbers, which hash-aggregate; zero for those that rule nothing out
    mapping = facts.service_categories.select(*SERVICE, F.array_position(names, F.col("service_category")).alias("_number"))
    single = (
        facts.lines.select("claim_id", *SERVICE)
        .join(mapping, list(SERVICE))
        .groupBy("claim_id")
        .agg(F.min("_number").alias("_number"), F.max("_number").alias("_other"))
        .filter((F.col("_number") == F.col("_other")) & (F.col("_number") > 0))
        .select("claim_id", F.get(names, (F.col("_number") - 1).cast("int")).alias("_category"))
    )
    claim, diagnosis = F.col("claim_id"), F.col("principal_diagnosis_code")
    return (
        single.join(facts.claims.select("claim_id", "principal_diagnosis_code"), "claim_id")
        .filter(diagnosis == F.element_at(constant_map(never), F.col("_category")))
        .select(
            *candidate(
                "PI010", claim, F.lit(0).cast(MONEY),
                F.concat_ws(":", F.element_at(constant_map(diagnoses), diagnosis), "_category"),
                F.lit("compatible category mapping"), claim_id=claim,
            )
        )
    )


def rule_candidates(facts: Facts, settings: RuleSettings, limits: DataFrame) -> dict[str, DataFrame]:
    """Candidates of every rule."""
    repeated = with_repeated_first_lines(facts)
    return {
        "PI001": exact_duplicates(facts, repeated),
        "PI002": near_duplicates(facts, repeated),
        "PI003": repayments_after_reversal(facts),
        "PI004": impossible_dates(facts),
        "PI005": header_mismatches(facts),
        "PI006": overpayments(facts),
        "PI007": unusual_amounts(facts, settings),
        "PI008": utilization_surges(facts, settings),
        "PI009": repeated_procedures(facts, limits),
        "PI010": diagnosis_mismatches(facts, settings),
    }


def top_candidates(candidates: DataFrame, settings: RuleSettings) -> DataFrame:
    """The strongest candidates of each rule, one per target.

    The cap is the published size of the review list; the rank filter is limited before the shuffle.
    """
    ranked = Window.partitionBy("rule_id").orderBy(F.desc("ranking_value"), "target_record_id")
    capped = candidates.withColumn("_place", F.row_number().over(ranked)).filter(
        F.col("_place") <= settings.maximum_findings_per_rule
    )
    repeat = Window.partitionBy("rule_id", "target_record_id").orderBy("_place")
    return capped.withColumn("_repeat", F.row_number().over(repeat)).filter("_repeat = 1")


def select_findings(candidates: DataFrame, settings: RuleSettings) -> DataFrame:
    """Numbered review leads with rule metadata; at most rules x cap rows, so one sort numbers them."""
    ordered = Window.orderBy("rule_id", "target_record_id")
    rules = candidates.sparkSession.createDataFrame(
        [(*rule[:3], rule[3]) for rule in RULES], "rule_id string, rule_name string, severity string, _c string"
    ).withColumn("confidence", F.col("_c").cast(RATE))
    number = F.row_number().over(ordered)
    return (
        top_candidates(candidates, settings)
        .withColumn("finding_id", F.concat(F.lit("FND"), F.lpad(number.cast("string"), 10, "0")))
        .join(F.broadcast(rules.drop("_c")), "rule_id")
        .withColumn("run_id", F.lit(settings.run_id))
    )


FINDING_COLUMNS = (
    "finding_id", "run_id", "rule_id", "rule_name", "label_scope", "target_table", "target_record_id",
    "claim_id", "claim_line_id", "payment_transaction_id", "provider_id", "reporting_period", "severity",
    "confidence", "amount_at_risk", "explanation",
)


def findings_table(selected: DataFrame) -> DataFrame:
    return selected.select(*FINDING_COLUMNS)


def evidence_table(selected: DataFrame) -> DataFrame:
    return selected.select(
        "finding_id",
        F.lit(1).alias("evidence_sequence"),
        "evidence_name",
        "observed_value",
        F.when(F.col("threshold_value").isNotNull(), ">").alias("comparison_operator"),
        "threshold_value",
        F.col("target_table").alias("source_table"),
        F.col("target_record_id").alias("source_record_id"),
    )


def run_rules(facts: Facts, settings: RuleSettings, limits: DataFrame) -> DataFrame:
    """All selected review leads."""
    parts = rule_candidates(facts, settings, limits).values()
    # each rule is cut to its own top before the union, so only short lists travel on
    capped = [top_candidates(part, settings).drop("_place", "_repeat") for part in parts]
    return select_findings(reduce(DataFrame.unionByName, capped), settings)
