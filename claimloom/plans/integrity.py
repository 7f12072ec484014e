"""Integrity reports over operational tables, the star schema and the marts.

Every function returns (check_name, violations) rows.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions.numbers import MONEY, count_as_decimal, rate, total
from claimloom.operators.quality import (
    all_checks, count_where, duplicate_keys, missing_parents, orphans, report, row_count, row_difference,
    violations,
)
from claimloom.plans.conformed import ledger_net

# table: (primary key, identifier pattern of its first column)
OPERATIONAL_KEYS = {
    "member": ("member_id",),
    "plan": ("plan_id",),
    "provider": ("provider_id",),
    "provider_contract": ("contract_id",),
    "membership_month": ("member_id", "plan_id", "coverage_month"),
    "claim_header": ("claim_id",),
    "claim_line": ("claim_line_id",),
    "adjudication_event": ("adjudication_event_id",),
    "payment_transaction": ("payment_transaction_id",),
    "claim_review": ("review_id",),
    "denial_outcome": ("denial_id",),
    "policy_assignment": ("policy_assignment_id",),
    "audit_outcome": ("audit_id",),
    "recovery_transaction": ("recovery_transaction_id",),
}

# child table, referencing columns, "parent(columns)"
REFERENCES = (
    ("provider_contract", ("provider_id",), "provider(provider_id)"),
    ("membership_month", ("member_id",), "member(member_id)"),
    ("membership_month", ("plan_id",), "plan(plan_id)"),
    ("claim_header", ("member_id",), "member(member_id)"),
    ("claim_header", ("billing_provider_id",), "provider(provider_id)"),
    ("claim_header", ("prior_claim_id",), "claim_header(claim_id)"),
    ("claim_header", ("billing_provider_id", "plan_id"), "provider_contract(provider_id, plan_id)"),
    ("claim_line", ("claim_id",), "claim_header(claim_id)"),
    ("claim_line", ("rendering_provider_id",), "provider(provider_id)"),
    ("payment_transaction", ("claim_id",), "claim_header(claim_id)"),
    ("payment_transaction", ("reverses_transaction_id",), "payment_transaction(payment_transaction_id)"),
    ("claim_review", ("claim_id",), "claim_header(claim_id)"),
    ("audit_outcome", ("review_id",), "claim_review(review_id)"),
    ("policy_assignment", ("provider_id",), "provider(provider_id)"),
)


def key_checks(tables: dict[str, DataFrame], keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """Repeated and incomplete keys of every table."""
    reports = []
    for table, key in keys.items():
        if table in tables:
            reports.append(duplicate_keys(f"{table}_duplicate_keys", tables[table], list(key)))
            empty = [F.col(c).isNull() for c in key]
            test = empty[0]
            for other in empty[1:]:
                test = test | other
            reports.append(violations(tables[table], {f"{table}_null_keys": test}))
    return all_checks(*reports)


def parse_reference(text: str) -> tuple[str, list[str]]:
    found = re.fullmatch(r"(\w+)\(([\w, ]+)\)", text)
    if found is None:
        raise ContractError(f"malformed reference {text}")
    return found.group(1), [name.strip() for name in found.group(2).split(",")]


def reference_checks(tables: dict[str, DataFrame], references=REFERENCES) -> DataFrame:
    """Complete references without a parent row."""
    reports = []
    for child, columns, text in references:
        parent, parent_columns = parse_reference(text)
        if child in tables and parent in tables:
            name = f"{child}_{'_'.join(columns)}"
            reports.append(missing_parents(name, tables[child], list(columns), tables[parent], parent_columns))
    return all_checks(*reports)


def format_checks(tables: dict[str, DataFrame], patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """Identifiers not fitting their pattern; ``patterns`` maps column to (table, pattern)."""
    return all_checks(
        *[
            violations(tables[table], {f"{column}_format": ~F.col(column).rlike(f"^(?:{pattern})$")})
            for column, (table, pattern) in patterns.items()
        ]
    )


def version_checks(headers: DataFrame) -> DataFrame:
    """One current version each; later versions follow and agree with their prior one."""
    newest = headers.groupBy("logical_claim_id").agg(F.max("claim_version_number").alias("_newest"))
    current = (
        headers.join(newest, "logical_claim_id")
        .filter(F.col("claim_version_number") == F.col("_newest"))
        .groupBy("logical_claim_id")
        .count()
        .filter("count <> 1")
    )
    stable = ("logical_claim_id", "member_id", "plan_id", "billing_provider_id", "claim_type")
    prior = headers.select(
        F.col("claim_id").alias("_prior"),
        F.col("claim_version_number").alias("_version"),
        F.col("adjudication_date").alias("_adjudicated"),
        *[F.col(c).alias(f"_{c}") for c in stable],
    )
    linked = headers.join(prior, F.col("prior_claim_id") == F.col("_prior"), "left")
    changed = F.lit(False)
    for column in stable:
        changed = changed | ~F.col(column).eqNullSafe(F.col(f"_{column}"))
    later = F.col("claim_version_number") > 1
    return all_checks(
        row_count("current_versions_not_one", current),
        violations(
            linked,
            {
                "version_without_link": later & F.col("_prior").isNull(),
                "first_version_with_link": ~later & F.col("prior_claim_id").isNotNull(),
                "version_not_following": F.col("_version") + 1 != F.col("claim_version_number"),
                "version_identity_changed": F.col("_prior").isNotNull() & changed,
                "received_before_prior_decision": F.col("received_date") <= F.col("_adjudicated"),
            },
        ),
    )


def amount_checks(
    headers: DataFrame, lines: DataFrame, payments: DataFrame, waived: DataFrame | None = None
) -> DataFrame:
    """Header equals lines (waived claims excepted), ledger equals governed payment, ordering of amounts.

    ``waived`` holds claim ids whose header may differ.
    """
    sums = lines.groupBy("claim_id").agg(
        total(F.col("charge_amount")).alias("_charge"),
        total(F.col("allowed_amount")).alias("_allowed"),
        total(F.col("member_liability_amount")).alias("_liability"),
    )
    joined = headers.join(sums, "claim_id", "left").join(ledger_net(payments), "claim_id", "left")
    excused = F.lit(False)
    if waived is not None:
        marks = waived.select("claim_id").distinct().withColumn("_waived", F.lit(True))
        joined = joined.join(marks, "claim_id", "left")
        excused = F.col("_waived").isNotNull()
    zero = lambda name: F.coalesce(name, F.lit(0)).cast(MONEY)
    differs = (
        (F.col("total_charge_amount") != zero("_charge"))
        | (F.col("total_allowed_amount") != zero("_allowed"))
        | (F.col("total_member_liability_amount") != zero("_liability"))
    )
    net = zero("net_paid_amount")
    governed = F.col("total_allowed_amount") - F.col("total_member_liability_amount")
    denied = F.col("claim_status") == "denied"
    return all_checks(
        violations(
            joined,
            {
                "header_differs_from_lines": differs & ~excused,
                "ledger_differs_from_governed": ~denied & (net != governed),
                "denied_with_positive_net": denied & (net > 0),
            },
        ),
        violations(
            lines,
            {
                "negative_line_amounts": (F.col("charge_amount") < 0)
                | (F.col("allowed_amount") < 0)
                | (F.col("member_liability_amount") < 0),
                "allowed_above_charge": F.col("allowed_amount") > F.col("charge_amount"),
                "liability_above_allowed": F.col("member_liability_amount") > F.col("allowed_amount"),
            },
        ),
    )


def chronology_checks(headers: DataFrame, reviews: DataFrame) -> DataFrame:
    """Order of service, receipt, decision and review dates."""
    decided = headers.select("claim_id", F.col("adjudication_date").alias("_decided"))
    return all_checks(
        violations(
            headers,
            {
                "service_dates_reversed": F.col("service_from_date") > F.col("service_through_date"),
                "received_before_service": F.col("service_through_date") > F.col("received_date"),
                "decided_before_received": F.col("received_date") > F.col("adjudication_date"),
            },
        ),
        violations(
            reviews.join(decided, "claim_id"),
            {
                "reviewed_before_decision": F.col("selected_date") <= F.col("_decided"),
                "completed_before_selected": F.col("completed_date") < F.col("selected_date"),
            },
        ),
    )


def eligibility_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Claims outside covered months or without a provider contract.

    The months of a year are one number, put together in the tasks, so a twelfth of the member months is shuffled.
    """
    service, month = F.col("service_from_date"), F.col("coverage_month")
    bit = lambda day: F.expr(f"shiftleft(1, month({day}) - 1)")
    claims = tables["claim_header"].withColumn("_year", F.year(service))
    covered_years = tables["membership_month"].filter(month == F.trunc(month, "MM")).groupBy(
        "member_id", "plan_id", F.year(month).alias("_year")
    ).agg(F.bit_or(bit("coverage_month")).alias("_months"))
    reference = ["member_id", "plan_id", "_year"]
    complete = reduce(and_, [F.col(name).isNotNull() for name in reference])
    covered = claims.filter(complete).join(covered_years, reference, "left").filter(
        F.coalesce(F.col("_months"), F.lit(0)).bitwiseAND(bit("service_from_date")) == 0
    )
    contracted = orphans(
        claims, ["billing_provider_id", "plan_id"], tables["provider_contract"], ["provider_id", "plan_id"]
    )
    return all_checks(row_count("service_without_coverage", covered),
                      row_count("service_without_contract", contracted))


def workflow_checks(reviews: DataFrame, audits: DataFrame, recoveries: DataFrame) -> DataFrame:
    """One audit per completed review, dated with it; recoveries within confirmed amounts."""
    completed = reviews.filter(F.col("review_status") == "completed")
    pairs = completed.select(
        "review_id", F.col("claim_id").alias("_claim"), "completed_date"
    ).join(audits, "review_id", "full")
    recovered = recoveries.groupBy("audit_id").agg(total(F.col("recovered_amount")).alias("_recovered"))
    return all_checks(
        duplicate_keys("repeated_audits", audits, ["review_id"]),
        violations(
            pairs,
            {
                "review_without_audit": F.col("audit_id").isNull(),
                "audit_without_review": F.col("_claim").isNull(),
                "audit_of_other_claim": F.col("_claim") != F.col("claim_id"),
                "audit_date_differs": F.col("completed_date") != F.col("outcome_date"),
                "negative_confirmed_amount": F.col("confirmed_amount") < 0,
            },
        ),
        violations(
            audits.join(recovered, "audit_id"),
            {"recovered_above_confirmed": F.col("_recovered") > F.col("confirmed_amount")},
        ),
    )


def retention_checks(source: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """Every source row survives into the star schema."""
    pairs = (
        ("claim_header", "fact_claim"),
        ("claim_line", "fact_claim_line"),
        ("payment_transaction", "fact_payment_transaction"),
        ("anomaly_injection", "bridge_claim_anomaly"),
    )
    return all_checks(*[row_difference(f"{f}_rows_lost", source[s], star[f]) for s, f in pairs if f in star])


def cost_mart_checks(marts: dict[str, DataFrame]) -> DataFrame:
    """Invariants of the cost marts, rates recomputed."""
    members = count_as_decimal(F.col("eligible_member_months"))
    cost = marts["monthly_cost_utilization"]
    share = lambda c: (F.col(c) < 0) | (F.col(c) > 1)
    known = ("insufficient_history", "normal", "warning")
    return all_checks(
        duplicate_keys("monthly_keys_repeated", cost, ["service_month", "plan_key"]),
        violations(
            cost,
            {
                "negative_exposure": F.col("eligible_member_months") < 0,
                "pmpm_differs": ~F.col("allowed_pmpm").eqNullSafe(rate(F.col("allowed_amount"), members)),
                "utilization_differs": ~F.col("units_per_1000").eqNullSafe(
                    rate((F.col("service_units") * 1000).cast("decimal(22,4)"), members)
                ),
            },
        ),
        violations(
            marts["provider_service_concentration"],
            {"concentration_out_of_bounds": share("top_10_share") | share("hhi")},
        ),
        violations(
            marts["cost_change_decomposition"],
            {"decomposition_residual": F.abs("reconciliation_residual") > F.lit("0.01").cast(MONEY)},
        ),
        violations(
            marts["cost_early_warning_signal"],
            {"signal_unexplained": (F.length("explanation") == 0) | ~F.col("signal_status").isin(*known)},
        ),
    )


def panel_checks(panel: DataFrame, months: int) -> DataFrame:
    """Balanced, fixed in treatment, interaction right; one aggregate per provider."""
    providers = panel.groupBy("provider_key").agg(
        F.count("*").alias("_months"), F.count_distinct("treatment_group").alias("_groups")
    )
    cohorts = panel.agg(F.count_distinct("treatment_group").alias("_cohorts"))
    product = F.col("treatment_indicator") & F.col("post_policy_indicator")
    return all_checks(
        duplicate_keys("panel_keys_repeated", panel, ["provider_key", "reporting_month"]),
        violations(providers, {"unbalanced_providers": F.col("_months") != months,
                               "treatment_not_fixed": F.col("_groups") != 1}),
        violations(panel, {"interaction_wrong": F.col("treatment_post") != product}),
        violations(cohorts, {"cohort_missing": F.col("_cohorts") != 2}),
    )


def estimate_checks(effects: DataFrame, events: DataFrame, diagnostics: DataFrame) -> DataFrame:
    inside = F.col("coefficient").between(
        F.col("confidence_interval_lower"), F.col("confidence_interval_upper")
    )
    return all_checks(
        violations(effects, {"interval_wrong": ~inside | (F.col("standard_error") < 0)}),
        violations(events, {"reference_period_estimated": F.col("event_time") == -1}),
        violations(diagnostics, {"diagnostic_unexplained": F.length("explanation") == 0}),
    )


def finding_checks(
    findings: DataFrame, evidence: DataFrame, labels: DataFrame, matches: DataFrame, evaluation: DataFrame
) -> DataFrame:
    """Findings unique, explained and evidenced; every label evaluated; confusion counts add up."""
    ids = lambda frame, name: frame.select(F.col(name).alias("_id"))
    parts = (
        F.col("true_positive_count") + F.col("false_positive_count") + F.col("false_negative_count")
        + F.col("true_negative_count")
    )
    return all_checks(
        duplicate_keys("finding_keys_repeated", findings, ["run_id", "rule_id", "label_scope", "target_record_id"]),
        violations(
            findings,
            {"finding_unexplained": F.length("explanation") == 0, "negative_amount": F.col("amount_at_risk") < 0},
        ),
        row_count(
            "finding_without_evidence",
            ids(findings, "finding_id").join(ids(evidence, "finding_id"), "_id", "left_anti"),
        ),
        row_count(
            "label_not_evaluated",
            ids(labels, "injection_id").join(
                ids(matches.filter(F.col("injection_id").isNotNull()), "injection_id"), "_id", "left_anti"
            ),
        ),
        duplicate_keys("match_keys_repeated", matches, ["rule_id", "canonical_target_id"]),
        violations(evaluation, {"confusion_does_not_add_up": F.col("eligible_target_count") != parts}),
    )
