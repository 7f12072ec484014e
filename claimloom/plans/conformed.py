"""Claims facts in one conformed shape, from operational tables or from the star schema.

Marts, rules and the policy panel read this shape only.  It never contains labels.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from copy import copy
from dataclasses import dataclass
from dataclasses import replace as changed
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions.dates import month_of
from claimloom.functions.numbers import MONEY, total
from claimloom.operators.keys import dense_keys
from claimloom.operators.marks import divide
from claimloom.session import broadcast_if_few, written
from claimloom.sources.layers import LayerStore

LABEL_TABLES = ("anomaly_injection", "bridge_claim_anomaly")


@dataclass(frozen=True)
class Facts:
    """``claims`` one row per claim version; ``lines``, ``payments`` and ``reviews`` its children."""

    claims: DataFrame
    lines: DataFrame
    payments: DataFrame
    memberships: DataFrame
    reviews: DataFrame
    assignments: DataFrame
    service_categories: DataFrame | None = None


def replace(facts: Facts, **tables: DataFrame) -> Facts:
    """``facts`` with other tables; those of ``StarFacts`` that weren't built stay so."""
    if isinstance(facts, Facts):
        return changed(facts, **tables)
    other = copy(facts)
    vars(other).update(tables)
    return other


def label_tables(names) -> list[str]:
    """Those of the named tables that hold labels."""
    return sorted(set(names) & set(LABEL_TABLES))


def refuse_labels(names) -> None:
    found = label_tables(names)
    if found:
        raise ContractError(f"label tables may not be read here: {', '.join(found)}")


def with_current_flag(headers: DataFrame) -> DataFrame:
    """Mark the highest version of every logical claim.

    An aggregate joined back, so a logical claim with very many versions never meets in one sort.
    """
    # most logical claims have one version, which needs no join
    version = F.col("claim_version_number")
    several = written(
        headers.groupBy("logical_claim_id").agg(F.count("*").alias("_rows"), F.max("claim_version_number").alias("_newest"))
        .filter("_rows > 1").select("logical_claim_id", "_newest")
    )
    some, single = divide(headers.filter(F.col("logical_claim_id").isNotNull()), "logical_claim_id", several)
    flagged = some.join(several, "logical_claim_id", "left").withColumn(
        "is_current_version", version == F.coalesce("_newest", version)
    )
    return flagged.drop("_newest").unionByName(single.withColumn("is_current_version", version == version))


def ledger_net(payments: DataFrame) -> DataFrame:
    """Signed ledger total per claim."""
    return payments.groupBy("claim_id").agg(total(F.col("signed_transaction_amount")).alias("net_paid_amount"))


def from_operational(
    tables: dict[str, DataFrame],
    service_categories: DataFrame | None = None,
    layers: LayerStore | None = None,
) -> Facts:
    """Conform operational tables; plan and provider keys are the dense keys of the star schema.

    With a layer store, keys and conformed claims are written once and shared by later steps.
    """
    refuse_labels(tables)
    keep = layers.keep if layers else lambda name, build: build()
    plan_keys = keep("plan_key", lambda: dense_keys(tables["plan"], ["plan_id"], "plan_key"))
    provider_keys = keep(
        "provider_key", lambda: dense_keys(tables["provider"], ["provider_id"], "provider_key")
    )

    def conformed_claims() -> DataFrame:
        providers = tables["provider"].join(provider_keys, "provider_id").select(
            F.col("provider_id").alias("billing_provider_id"),
            F.col("provider_key").alias("billing_provider_key"),
            "specialty_group",
        )
        return (
            with_current_flag(tables["claim_header"])
            .join(ledger_net(tables["payment_transaction"]), "claim_id", "left")
            .withColumn("net_paid_amount", F.coalesce("net_paid_amount", F.lit(0)).cast(MONEY))
            .join(plan_keys, "plan_id")
            .join(broadcast_if_few(providers), "billing_provider_id")
            .withColumn("service_month", month_of(F.col("service_from_date")))
            .withColumnRenamed("service_from_date", "service_date")
        )

    plan_paid = (F.col("allowed_amount") - F.col("member_liability_amount")).cast(MONEY)
    return Facts(
        claims=keep("conformed_claims", conformed_claims),
        lines=tables["claim_line"].withColumn("plan_paid_amount", plan_paid),
        payments=tables["payment_transaction"],
        memberships=tables["membership_month"].join(plan_keys, "plan_id"),
        reviews=tables["claim_review"],
        assignments=tables["policy_assignment"].join(provider_keys, "provider_id"),
        service_categories=service_categories,
    )


def with_service_category(lines: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Category from the mapping of (system, code); else the system name in lower snake case."""
    system = F.lower(F.translate("service_code_system", "-", "_"))
    if categories is None:
        return lines.withColumn("service_category", system)
    keys = ["service_code_system", "service_code"]
    mapped = categories.select(*keys, F.col("service_category").alias("_mapped"))
    return (
        lines.join(mapped, keys, "left")
        .withColumn("service_category", F.coalesce("_mapped", system))
        .drop("_mapped")
    )


class StarFacts:
    """``Facts`` of star-schema tables, each conformed when it is first asked for.

    A mart over claims and payments so reads neither lines nor memberships.  ``star`` may build its tables lazily too;
    with ``keep`` the conformed tables are written once and shared by later steps.
    """

    def __init__(
        self,
        star: Mapping[str, DataFrame],
        service_categories: DataFrame | None = None,
        keep: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None,
    ):
        refuse_labels(star)
        self._star, self.service_categories = star, service_categories
        self._keep = keep or (lambda name, build: build())

    def _dated(self, frame: DataFrame, key: str, name: str) -> DataFrame:
        # bounded by the calendar
        role = self._star["dim_date"].select(F.col("date_key").alias(key), F.col("calendar_date").alias(name))
        return frame.join(role, key, "left")

    @cached_property
    def claims(self) -> DataFrame:
        return self._keep("claims", self._claims)

    def _claims(self) -> DataFrame:
        providers = self._star["dim_provider"].select(
            F.col("provider_key").alias("billing_provider_key"),
            F.col("provider_id").alias("billing_provider_id"),
            "specialty_group",
        )
        members = self._star["dim_member"].select("member_key", "member_id")
        claims = self._dated(self._star["fact_claim"], "service_date_key", "service_date")
        claims = claims.join(broadcast_if_few(providers), "billing_provider_key").join(members, "member_key")
        return claims.withColumn("service_month", month_of(F.col("service_date")))

    @cached_property
    def lines(self) -> DataFrame:
        return self._keep("lines", self._lines)

    def _lines(self) -> DataFrame:
        lines = self._dated(self._star["fact_claim_line"], "service_date_key", "service_date").join(
            self._star["dim_service"], "service_key"
        )
        providers = self._star["dim_provider"].select(
            F.col("provider_key").alias("rendering_provider_key"),
            F.col("provider_id").alias("rendering_provider_id"),
        )
        return lines.join(broadcast_if_few(providers), "rendering_provider_key", "left")

    @cached_property
    def payments(self) -> DataFrame:
        return self._keep(
            "payments",
            lambda: self._dated(self._star["fact_payment_transaction"], "transaction_date_key", "transaction_date"),
        )

    @cached_property
    def memberships(self) -> DataFrame:
        return self._keep("memberships", lambda: self._star["fact_membership_month"])

    @cached_property
    def reviews(self) -> DataFrame:
        return self._keep("reviews", lambda: self._star["fact_claim_review"])

    @cached_property
    def assignments(self) -> DataFrame:
        return self._star["bridge_provider_policy"]


def from_star(star: Mapping[str, DataFrame], service_categories: DataFrame | None = None) -> Facts:
    """Conform star-schema tables by resolving dimension and date keys."""
    facts = StarFacts(star, service_categories)
    return Facts(**{name: getattr(facts, name) for name in Facts.__dataclass_fields__})
