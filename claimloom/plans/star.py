"""Keyed star schema over operational claims tables.

Surrogate keys are 1..N in the sorted order of the business key.  Every table is lazy, so
building one table only numbers the keys it refers to.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import month_of
from claimloom.functions.numbers import MONEY, or_fail
from claimloom.operators.keys import dense_keys, dense_positions
from claimloom.operators.marks import may_match
from claimloom.plans.conformed import ledger_net, with_current_flag, with_service_category
from claimloom.session import few_rows, written
from claimloom.sources.layers import LayerStore, LazyTables

# date columns that feed the calendar, by operational table
DATE_COLUMNS = {
    "membership_month": ("coverage_month", "coverage_start_date", "coverage_end_date"),
    "claim_header": ("service_from_date", "service_through_date", "received_date", "adjudication_date"),
    "claim_line": ("service_date",),
    "payment_transaction": ("transaction_date",),
    "claim_review": ("selected_date", "completed_date"),
    "audit_outcome": ("outcome_date",),
    "policy_assignment": ("assignment_start_date", "assignment_end_date"),
    "anomaly_injection": ("reporting_period",),
}


class Star:
    """Star-schema tables of one set of operational tables."""

    def __init__(
        self,
        source: dict[str, DataFrame],
        policy_start: date,
        service_categories: DataFrame | None = None,
        source_variant: str = "anomalous_evaluation",
        layers: LayerStore | None = None,
    ):
        self.source = source
        self.policy_start = policy_start
        self.service_categories = service_categories
        self.source_variant = source_variant
        self.layers = layers

    def _keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Key tables are read by several facts, so they are written once where a store is given."""
        return self.layers.keep(name, build) if self.layers else build()

    # -- keys -------------------------------------------------------------------------------

    def _keys(self, table: str, business_key: str, key: str) -> DataFrame:
        return self._keep(key, lambda: dense_keys(self.source[table], [business_key], key))

    @cached_property
    def member_keys(self) -> DataFrame:
        return self._keys("member", "member_id", "member_key")

    @cached_property
    def provider_keys(self) -> DataFrame:
        return self._keys("provider", "provider_id", "provider_key")

    @cached_property
    def plan_keys(self) -> DataFrame:
        return self._keys("plan", "plan_id", "plan_key")

    @cached_property
    def claim_keys(self) -> DataFrame:
        return self._keys("claim_header", "claim_id", "claim_key")

    @cached_property
    def line_keys(self) -> DataFrame:
        return self._keys("claim_line", "claim_line_id", "claim_line_key")

    @cached_property
    def payment_keys(self) -> DataFrame:
        return self._keys("payment_transaction", "payment_transaction_id", "payment_transaction_key")

    @cached_property
    def service_keys(self) -> DataFrame:
        pair = ["service_code_system", "service_code"]
        return self._keep(
            "service_key", lambda: dense_keys(self.source["claim_line"], pair, "service_key")
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every date used anywhere, numbered in order."""
        day = F.col("calendar_date")

        def used_days() -> DataFrame:
            # one pass over each table for all of its date roles
            parts = [
                self.source[table]
                .select(F.explode(F.array_distinct(F.array(*names))).alias("calendar_date"))
                .distinct()
                for table, names in DATE_COLUMNS.items()
                if table in self.source
            ]
            return reduce(DataFrame.unionByName, parts).filter(day.isNotNull())

        numbered = self._keep("date_key", lambda: dense_keys(used_days(), ["calendar_date"], "date_key", "int"))
        return numbered.select(
            "date_key",
            day,
            F.year(day).cast("smallint").alias("calendar_year"),
            F.quarter(day).cast("tinyint").alias("calendar_quarter"),
            F.month(day).cast("tinyint").alias("calendar_month"),
            month_of(day).alias("month_start_date"),
            F.date_format(day, "yyyy-MM").alias("year_month"),
            F.when(day >= F.lit(self.policy_start), "post_policy").otherwise("pre_policy").alias("policy_period"),
        )

    # -- lookups ----------------------------------------------------------------------------

    def _look_up(
        self, frame: DataFrame, keys: DataFrame, business_key: str, column: str, name: str, required: bool
    ) -> DataFrame:
        """Add surrogate key ``name`` for ``column``; unresolved required keys fail the job."""
        surrogate = keys.columns[-1]
        few = few_rows(keys)
        pairs = keys.select(F.col(business_key).alias(f"_{name}"), F.col(surrogate).alias(name))
        whole = lambda rows: rows.join(F.broadcast(pairs) if few else pairs, F.col(column) == F.col(f"_{name}"), "left").drop(f"_{name}")
        if required:
            message = F.concat(F.lit(f"unresolved {column}: "), F.coalesce(F.col(column), F.lit("null")))
            return whole(frame).withColumn(name, or_fail(F.col(name), message, "bigint"))
        if few:
            return whole(frame)
        # rows without a reference stay where they are, or they would all meet in one task; the frame is read twice
        none = F.lit(None).cast(keys.schema[surrogate].dataType)
        return whole(frame.filter(F.col(column).isNotNull())).unionByName(frame.filter(F.col(column).isNull()).withColumn(name, none))

    def _date(self, frame: DataFrame, column: str, name: str) -> DataFrame:
        # the calendar is small whatever the facts hold
        role = self.dim_date.select(F.col("calendar_date").alias(column), F.col("date_key").alias(name))
        return frame.join(role, column, "left")

    def _variant(self) -> Column:
        return F.lit(self.source_variant).alias("source_variant")

    # -- dimensions -------------------------------------------------------------------------

    def _dimension(self, table: str, keys: DataFrame) -> DataFrame:
        business_key, key = keys.columns
        return self.source[table].join(keys, business_key).select(key, *self.source[table].columns)

    @cached_property
    def dim_member(self) -> DataFrame:
        return self._dimension("member", self.member_keys)

    @cached_property
    def dim_provider(self) -> DataFrame:
        return self._dimension("provider", self.provider_keys)

    @cached_property
    def dim_plan(self) -> DataFrame:
        return self._dimension("plan", self.plan_keys)

    @cached_property
    def dim_service(self) -> DataFrame:
        return with_service_category(self.service_keys, self.service_categories).select(
            "service_key", "service_code_system", "service_code", "service_category"
        )

    # -- facts ------------------------------------------------------------------------------

    @cached_property
    def fact_membership_month(self) -> DataFrame:
        rows = self.source["membership_month"]
        natural = ["member_id", "plan_id", "coverage_month"]
        numbered = dense_positions(rows, natural).withColumn("membership_month_key", F.col("position") + 1)
        numbered = self._look_up(numbered, self.member_keys, "member_id", "member_id", "member_key", True)
        numbered = self._look_up(numbered, self.plan_keys, "plan_id", "plan_id", "plan_key", True)
        numbered = self._date(numbered, "coverage_month", "coverage_month_date_key")
        return numbered.select(
            "membership_month_key", "member_key", "plan_key", "coverage_month_date_key", *rows.columns
        )

    @cached_property
    def fact_claim(self) -> DataFrame:
        look = self._look_up
        lines = self.source["claim_line"].groupBy("claim_id").agg(F.count("*").alias("_line_count"))
        # what reads its frame twice comes first, while that is a scan
        claims = with_current_flag(self.source["claim_header"])
        claims = look(claims, self.claim_keys, "claim_id", "prior_claim_id", "prior_claim_key", False)
        claims = look(
            claims, self.provider_keys, "provider_id", "rendering_provider_id", "rendering_provider_key", False
        )
        claims = look(
            claims, self.provider_keys, "provider_id", "billing_provider_id", "billing_provider_key", True
        )
        claims = look(claims, self.plan_keys, "plan_id", "plan_id", "plan_key", True)
        claims = look(claims, self.member_keys, "member_id", "member_id", "member_key", True)
        # joins by claim follow each other, so that they share one shuffle
        claims = claims.join(ledger_net(self.source["payment_transaction"]), "claim_id", "left")
        claims = claims.join(lines, "claim_id", "left")
        claims = look(claims, self.claim_keys, "claim_id", "claim_id", "claim_key", True)
        claims = self._date(claims, "service_from_date", "service_date_key")
        claims = self._date(claims, "service_through_date", "service_through_date_key")
        claims = self._date(claims, "received_date", "received_date_key")
        claims = self._date(claims, "adjudication_date", "adjudication_date_key")
        return claims.select(
            "claim_key", "prior_claim_key", "member_key", "plan_key", "billing_provider_key",
            "rendering_provider_key", "service_date_key", "service_through_date_key", "received_date_key",
            "adjudication_date_key", "claim_id", "logical_claim_id", "claim_version_number", "prior_claim_id",
            "claim_type", "claim_status", "principal_diagnosis_code", "is_current_version",
            "total_charge_amount", "total_allowed_amount", "total_member_liability_amount",
            F.coalesce("net_paid_amount", F.lit(0)).cast(MONEY).alias("net_paid_amount"),
            F.coalesce("_line_count", F.lit(0)).cast("int").alias("line_count"),
            self._variant(),
        )

    @cached_property
    def fact_claim_line(self) -> DataFrame:
        look = self._look_up
        lines = look(
            self.source["claim_line"], self.provider_keys, "provider_id", "rendering_provider_id",
            "rendering_provider_key", False,
        )
        lines = look(lines, self.line_keys, "claim_line_id", "claim_line_id", "claim_line_key", True)
        lines = look(lines, self.claim_keys, "claim_id", "claim_id", "claim_key", True)
        lines = lines.join(self.service_keys, ["service_code_system", "service_code"])
        lines = self._date(lines, "service_date", "service_date_key")
        return lines.select(
            "claim_line_key", "claim_key", "rendering_provider_key", "service_key", "service_date_key",
            "claim_line_id", "claim_id", "line_number", "place_of_service_code", "units", "charge_amount",
            "allowed_amount", "member_liability_amount",
            (F.col("allowed_amount") - F.col("member_liability_amount")).cast(MONEY).alias("plan_paid_amount"),
            self._variant(),
        )

    @cached_property
    def fact_payment_transaction(self) -> DataFrame:
        look = self._look_up
        payment = "payment_transaction_id"
        rows = look(self.source["payment_transaction"], self.payment_keys, payment, "reverses_transaction_id",
                    "reverses_transaction_key", False)
        rows = look(rows, self.payment_keys, payment, payment, "payment_transaction_key", True)
        rows = look(rows, self.claim_keys, "claim_id", "claim_id", "claim_key", True)
        rows = self._date(rows, "transaction_date", "transaction_date_key")
        return rows.select(
            "payment_transaction_key", "claim_key", "transaction_date_key", "reverses_transaction_key",
            payment, "claim_id", "transaction_sequence_number", "transaction_type",
            "signed_transaction_amount", "reverses_transaction_id", self._variant(),
        )

    @cached_property
    def fact_claim_review(self) -> DataFrame:
        audits = self.source["audit_outcome"].select(
            "review_id", F.col("outcome").alias("audit_outcome"), "confirmed_amount", "outcome_date"
        )
        review_keys = self._keys("claim_review", "review_id", "review_key")
        rows = self.source["claim_review"].join(audits, "review_id", "left")
        rows = self._look_up(rows, review_keys, "review_id", "review_id", "review_key", True)
        rows = self._look_up(rows, self.claim_keys, "claim_id", "claim_id", "claim_key", True)
        rows = self._date(rows, "selected_date", "selected_date_key")
        rows = self._date(rows, "completed_date", "completed_date_key")
        rows = self._date(rows, "outcome_date", "audit_outcome_date_key")
        return rows.select(
            "review_key", "claim_key", "selected_date_key", "completed_date_key", "audit_outcome_date_key",
            "review_id", "claim_id", "review_status", "selection_reason", "audit_outcome",
            F.coalesce("confirmed_amount", F.lit(0)).cast(MONEY).alias("confirmed_amount"), self._variant(),
        )

    # -- bridges ----------------------------------------------------------------------------

    @cached_property
    def bridge_provider_policy(self) -> DataFrame:
        key = "policy_assignment_id"
        rows = self.source["policy_assignment"]
        rows = self._look_up(rows, self._keys("policy_assignment", key, "provider_policy_key"), key, key,
                             "provider_policy_key", True)
        rows = self._look_up(rows, self.provider_keys, "provider_id", "provider_id", "provider_key", True)
        rows = self._date(rows, "assignment_start_date", "assignment_start_date_key")
        rows = self._date(rows, "assignment_end_date", "assignment_end_date_key")
        return rows.select(
            "provider_policy_key", "provider_key", "assignment_start_date_key", "assignment_end_date_key",
            key, "policy_id", "treatment_group",
        )

    @cached_property
    def bridge_claim_anomaly(self) -> DataFrame:
        """Labels with resolved keys, for evaluation only."""
        rows = self.source["anomaly_injection"]
        rows = labels = written(self._look_up(rows, self._keys("anomaly_injection", "injection_id", "anomaly_injection_key"),
                                              "injection_id", "injection_id", "anomaly_injection_key", True))
        # labels are few beside the records they may name
        for keys in (self.claim_keys, self.line_keys, self.payment_keys):
            name, key = keys.columns
            named = labels.select(name).filter(F.col(name).isNotNull())
            rows = self._look_up(rows, may_match(keys, name, named), name, name, key, False)
        rows = self._date(rows, "reporting_period", "reporting_period_date_key")
        return rows.select(
            "anomaly_injection_key", "claim_key", "claim_line_key", "payment_transaction_key",
            "reporting_period_date_key", "injection_id", "rule_id", "label_scope", "target_table",
            "target_record_id", "provider_id", "expected_financial_exposure", "overlap_group",
            F.lit(True).alias("evaluation_only"),
        )

    TABLES = (
        "dim_member", "dim_provider", "dim_plan", "dim_date", "dim_service", "fact_membership_month",
        "fact_claim", "fact_claim_line", "fact_payment_transaction", "fact_claim_review",
        "bridge_provider_policy", "bridge_claim_anomaly",
    )

    def lazy_tables(self, names: Sequence[str]) -> Mapping[str, DataFrame]:
        """The named tables, each built when it is first asked for."""
        return LazyTables(self, names)

    def tables(self) -> dict[str, DataFrame]:
        names = [name for name in self.TABLES if name != "bridge_claim_anomaly" or "anomaly_injection" in self.source]
        return {name: getattr(self, name) for name in names}
