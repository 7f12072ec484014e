"""Operational claims tables derived from an orders warehouse.

Customers act as members, suppliers as providers, orders as claim versions and line items as
claim lines.  Every mapping is deterministic, so the same tables can be rebuilt in plain SQL.
A few modulus rules plant known irregularities (duplicate lines, header differences,
overpayments) together with the labels that name them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.operators.keys import crowded_keys, number_within
from claimloom.plans.conformed import Facts, from_operational
from claimloom.sources.layers import LayerStore, LazyTables

MONEY = "decimal(18,2)"
UNITS = "decimal(18,4)"

REPORTING_START = "1995-01-01"
REPORTING_END = "2001-08-31"
POLICY_START = "2000-01-01"
POLICY_END = "2000-06-30"

# seed recorded with planted labels
LABEL_SEED = 42

# part types stand for procedure categories
PART_TYPE_CATEGORY = {
    "ECONOMY": "evaluation_management",
    "LARGE": "cardiovascular",
    "MEDIUM": "endocrine",
    "PROMO": "musculoskeletal",
    "SMALL": "respiratory",
    "STANDARD": "behavioral",
}

# declared, so opening a table reads no footers
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
}

# orders of a customer in a month are versions of one claim
VERSIONED = ("o_custkey", "_month")

LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
    "l_quantity",
]


def padded(prefix: str, number: Column, width: int) -> Column:
    """Identifier text; wider numbers keep all their digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def member_id(key: Column) -> Column:
    return padded("MBR", key, 12)


def provider_id(key: Column) -> Column:
    return padded("PRV", key, 10)


def claim_id(order_key: Column) -> Column:
    return padded("CLM", order_key, 12)


def line_id(prefix: str, order_key: Column, line: Column) -> Column:
    text = line.cast("string")
    return F.concat(
        padded(prefix, order_key, 12), F.lpad(text, F.greatest(F.length(text), F.lit(6)), F.lit("0"))
    )


def code_system(part_key: Column) -> Column:
    """One of 25 code systems."""
    return F.concat(F.lit("SYS-"), (part_key % 25).cast("string"))


def exact_copy(order_key: Column) -> Column:
    return order_key % 61 == 7


def near_copy(order_key: Column) -> Column:
    return (order_key % 67 == 11) & ~exact_copy(order_key)


def raised_header(order_key: Column) -> Column:
    return order_key % 97 == 13


def overpaid(order_key: Column) -> Column:
    return order_key % 89 == 5


class WarehouseModel:
    """Lazy operational tables over ``region nation customer supplier part orders lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.layers = LayerStore(spark, folder)
        self._sources: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._sources:
            reader = self.spark.read.schema(SOURCE_SCHEMAS[name])
            self._sources[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    @cached_property
    def nation_region(self) -> DataFrame:
        # 25 nations in 5 regions by definition of the warehouse
        return (
            self.read("nation")
            .join(F.broadcast(self.read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )

    @cached_property
    def member(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.read("customer")
            .join(F.broadcast(self.nation_region), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                member_id(key).alias("member_id"),
                (F.lit(1940) + key % 60).cast("smallint").alias("birth_year"),
                F.when(key % 2 == 0, "F").otherwise("M").alias("sex_code"),
                F.col("n_name").alias("state_code"),
                F.lit(True).alias("synthetic_record"),
            )
        )

    @cached_property
    def provider(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.read("supplier")
            .join(F.broadcast(self.nation_region), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                provider_id(key).alias("provider_id"),
                F.when(key % 3 == 0, "organization").otherwise("individual").alias("provider_entity_type"),
                F.col("n_name").alias("specialty_group"),
                F.col("r_name").alias("state_code"),
                F.lit("warehouse").alias("calibration_source_id"),
                F.lit("1").alias("calibration_version"),
                F.lit(True).alias("synthetic_record"),
            )
        )

    @cached_property
    def plan(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return (
            self.read("customer")
            .select(segment)
            .distinct()
            .select(
                segment.alias("plan_id"),
                F.when(segment < "H", "HMO").otherwise("PPO").alias("plan_type"),
                F.lit("medical").alias("product_line"),
                F.lit(REPORTING_START).cast("date").alias("effective_date"),
                F.lit(None).cast("date").alias("termination_date"),
            )
        )

    @cached_property
    def provider_contract(self) -> DataFrame:
        key = F.col("s_suppkey")
        # one row with the names of all plans, a small dimension
        plans = self.read("customer").agg(F.collect_set("c_mktsegment").alias("_plans"))
        offered = self.read("supplier").crossJoin(plans).select("s_suppkey", F.explode("_plans").alias("c_mktsegment"))
        return offered.filter((key + F.length("c_mktsegment")) % 7 != 0).select(
            F.concat_ws("-", provider_id(key), F.col("c_mktsegment")).alias("contract_id"),
            provider_id(key).alias("provider_id"),
            F.col("c_mktsegment").alias("plan_id"),
            F.lit(REPORTING_START).cast("date").alias("effective_date"),
            F.lit(None).cast("date").alias("termination_date"),
            F.lit("fee_schedule").alias("reimbursement_method"),
        )

    @cached_property
    def membership_month(self) -> DataFrame:
        return self.layers.keep("membership_month", lambda: self._membership_month)

    @cached_property
    def _membership_month(self) -> DataFrame:
        key, month = F.col("c_custkey"), F.col("coverage_month")
        start, index = F.lit(REPORTING_START).cast("date"), F.col("month_index")
        claimed = F.trunc(F.col("o_orderdate").cast("date"), "MM")
        # one row: the reported months, and beyond them those of earlier and later claims
        months = self.read("orders").agg(
            F.least(start, F.min(claimed)).alias("_first"),
            F.greatest(F.trunc(F.lit(REPORTING_END).cast("date"), "MM"), F.max(claimed)).alias("_last"),
        )
        # each customer becomes a row a month, so even a small file of customers is dealt to all tasks
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return (
            self.read("customer")
            .select("c_custkey", "c_mktsegment")
            .repartition(tasks)
            .crossJoin(F.broadcast(months))
            .select("c_custkey", "c_mktsegment", F.explode(F.expr("sequence(_first, _last, interval 1 month)")).alias("coverage_month"))
            .withColumn("month_index", F.months_between(month, start).cast("int"))
            .filter((key + index) % 10 != 0)
            .select(
                member_id(key).alias("member_id"),
                F.col("c_mktsegment").alias("plan_id"),
                month,
                month.alias("coverage_start_date"),
                F.last_day(month).alias("coverage_end_date"),
                F.when((key + 3 * index) % 17 == 0, "suspended").otherwise("active").alias("coverage_status"),
            )
        )

    @cached_property
    def policy_assignment(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.read("supplier")
            .join(F.broadcast(self.nation_region), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                padded("POL", key, 10).alias("policy_assignment_id"),
                provider_id(key).alias("provider_id"),
                F.lit("POLICY_2000_REVIEW").alias("policy_id"),
                F.when(F.col("r_name").isin("AMERICA", "EUROPE"), "treated")
                .otherwise("comparison")
                .alias("treatment_group"),
                F.lit(POLICY_START).cast("date").alias("assignment_start_date"),
                F.lit(POLICY_END).cast("date").alias("assignment_end_date"),
            )
        )

    @cached_property
    def _orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.read("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("service_from_date"),
            F.when(status == "F", "paid").when(status == "O", "denied").otherwise("adjusted").alias(
                "claim_status"
            ),
        )

    @cached_property
    def _numbered_lines(self) -> DataFrame:
        lines = self.read("lineitem").select("l_orderkey", *LINE_ORDER, "l_discount", "l_tax", "l_returnflag")
        return number_within(lines, ["l_orderkey"], LINE_ORDER, "line_number", self._crowded_orders)

    @cached_property
    def _crowded_orders(self) -> DataFrame:
        return crowded_keys(self.read("lineitem"), ["l_orderkey"])

    @cached_property
    def _lines(self) -> DataFrame:
        """Priced lines plus the planted exact and near copies of first lines."""
        order_key = F.col("l_orderkey")
        copied = exact_copy(order_key) | near_copy(order_key)
        counts = (
            self.read("lineitem")
            .filter(copied)
            .groupBy(order_key.alias("_order"))
            .agg(F.count("*").alias("_lines"))
        )
        units = F.col("l_quantity").cast(UNITS)
        planted = (
            F.when(near_copy(order_key), units + F.lit("0.25").cast("decimal(4,2)")).otherwise(units).cast(UNITS)
        )
        line = F.struct("line_number", units.alias("units"))
        copy = F.struct((F.col("_lines") + 1).alias("line_number"), planted.alias("units"))
        # a copied first line becomes two lines in place, so that lines are numbered once
        repeated = F.when(copied & (F.col("line_number") == 1), F.array(line, copy)).otherwise(F.array(line))
        price = F.col("l_extendedprice").cast(MONEY)
        discount = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
        allowed = F.round(price * discount, 2).cast(MONEY)
        liability = F.round(F.col("allowed_amount") * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY)
        return (
            self._numbered_lines.join(counts, order_key == F.col("_order"), "left")
            .select("*", F.explode(repeated).alias("_line"))
            .drop("line_number", "_order", "_lines")
            .select("*", "_line.line_number", "_line.units")
            .withColumn("charge_amount", price)
            .withColumn("allowed_amount", allowed)
            .withColumn("member_liability_amount", liability)
            .drop("_line", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
        )

    @cached_property
    def _dated_lines(self) -> DataFrame:
        return self.layers.keep("dated_lines", lambda: self._build_dated_lines)

    @cached_property
    def _build_dated_lines(self) -> DataFrame:
        """Lines with their order and place in its ledger, all by order key; ``_copy`` tells orders of one key apart."""
        line = F.col("line_number")
        same_key = Window.partitionBy("o_orderkey").orderBy("service_from_date", "claim_status")
        orders = self._orders.select("o_orderkey", "service_from_date", "claim_status", F.row_number().over(same_key).alias("_copy"))
        ship, service = F.col("l_shipdate").cast("date"), F.col("service_from_date")
        dated = self._lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "*",
            (F.col("claim_status") == "denied").alias("_denied"),
            F.when((ship >= service) | (F.col("l_orderkey") % 50 == 0), ship)
            .otherwise(F.date_add(service, line.cast("int")))
            .alias("transaction_date"),
        ).drop("o_orderkey", "l_shipdate")
        # denied claims have no ledger and come last
        return number_within(dated, ["l_orderkey"], ["_denied", "transaction_date", "line_number"], "_sequence", self._crowded_orders)

    @cached_property
    def claim_line(self) -> DataFrame:
        order_key, line = F.col("l_orderkey"), F.col("line_number")
        return self._dated_lines.select(
            line_id("LIN", order_key, line).alias("claim_line_id"),
            claim_id(order_key).alias("claim_id"),
            line.cast("int").alias("line_number"),
            provider_id(F.col("l_suppkey")).alias("rendering_provider_id"),
            code_system(F.col("l_partkey")).alias("service_code_system"),
            F.col("l_partkey").cast("string").alias("service_code"),
            F.col("service_from_date").alias("service_date"),
            F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("place_of_service_code"),
            "units",
            "charge_amount",
            "allowed_amount",
            "member_liability_amount",
        )

    @cached_property
    def _monthly_orders(self) -> DataFrame:
        return self._orders.withColumn("_month", F.trunc("service_from_date", "MM"))

    @cached_property
    def _crowded_versions(self) -> DataFrame:
        return crowded_keys(self._monthly_orders, [*VERSIONED])

    @cached_property
    def _versions(self) -> DataFrame:
        versions = number_within(
            self._monthly_orders, [*VERSIONED], ["service_from_date", "o_orderkey"], "claim_version_number", self._crowded_versions
        )
        logical = F.concat(padded("LCL", F.col("o_custkey"), 12), F.date_format("_month", "yyyyMM"))
        return versions.withColumn("logical_claim_id", logical).withColumn(
            "claim_version_number", F.col("claim_version_number").cast("int")
        )

    @cached_property
    def claim_header(self) -> DataFrame:
        return self.layers.keep("claim_header", lambda: self._claim_header)

    @cached_property
    def _claim_header(self) -> DataFrame:
        headers = self._headers
        first = ["logical_claim_id", "claim_version_number"]
        return headers.select(*first, *(name for name in headers.columns if name not in (*first, "prior_claim_id")), "prior_claim_id")

    @cached_property
    def _linked_versions(self) -> DataFrame:
        """Versions with the claim of the version before; met on narrow rows where a key's versions are spread over tasks."""
        if self._crowded_versions.isEmpty():
            # the versions of a key lie together already
            before = F.lag(claim_id(F.col("o_orderkey"))).over(Window.partitionBy(*VERSIONED).orderBy("claim_version_number"))
            known = F.col("o_custkey").isNotNull() & F.col("_month").isNotNull()
            return self._versions.withColumn("_before", before).withColumn("prior_claim_id", F.when(known, F.col("_before"))).drop("_before")
        prior = self._versions.select(
            F.col("o_custkey").alias("_custkey"),
            F.col("_month").alias("_prior_month"),
            (F.col("claim_version_number") + 1).alias("_next_version"),
            claim_id(F.col("o_orderkey")).alias("prior_claim_id"),
        )
        same = (
            (F.col("o_custkey") == F.col("_custkey")) & (F.col("_month") == F.col("_prior_month"))
            & (F.col("claim_version_number") == F.col("_next_version"))
        )
        return self._versions.join(prior, same, "left").drop("_custkey", "_prior_month", "_next_version")

    @cached_property
    def _headers(self) -> DataFrame:
        order_key, customer = F.col("o_orderkey"), F.col("o_custkey")
        service = F.col("service_from_date")
        zero = F.lit(0).cast(MONEY)
        totals = self._dated_lines.filter("_copy = 1").groupBy("l_orderkey").agg(
            F.sum("charge_amount").cast(MONEY).alias("_charge"),
            F.sum("allowed_amount").cast(MONEY).alias("_allowed"),
            F.sum("member_liability_amount").cast(MONEY).alias("_liability"),
            F.min("l_suppkey").alias("_billing"),
            F.max("l_suppkey").alias("_rendering"),
        )
        return (
            self._linked_versions.join(totals, order_key == F.col("l_orderkey"), "left")
            .join(self.read("customer").select("c_custkey", "c_mktsegment"), customer == F.col("c_custkey"))
            .select(
                claim_id(order_key).alias("claim_id"),
                "logical_claim_id",
                "claim_version_number",
                member_id(customer).alias("member_id"),
                F.col("c_mktsegment").alias("plan_id"),
                provider_id(F.coalesce("_billing", F.lit(1))).alias("billing_provider_id"),
                provider_id(F.col("_rendering")).alias("rendering_provider_id"),
                F.when(F.col("o_orderpriority") == "1-URGENT", "inpatient")
                .when(F.col("o_orderpriority") == "2-HIGH", "outpatient")
                .when(F.col("o_orderpriority") == "5-LOW", "pharmacy")
                .otherwise("professional")
                .alias("claim_type"),
                "claim_status",
                "service_from_date",
                F.date_add(service, (order_key % 4).cast("int")).alias("service_through_date"),
                F.date_add(service, (order_key % 4 + 5).cast("int")).alias("received_date"),
                F.when(order_key % 101 != 0, F.date_add(service, (order_key % 4 + 15).cast("int"))).alias(
                    "adjudication_date"
                ),
                F.element_at(
                    F.array(*[F.lit(code) for code in ("I10", "E119", "M1711", "J449", "F329", "Z0000")]),
                    (order_key % 6 + 1).cast("int"),
                ).alias("principal_diagnosis_code"),
                F.coalesce("_charge", zero).alias("total_charge_amount"),
                (
                    F.coalesce("_allowed", zero)
                    + F.when(raised_header(order_key), F.lit(10)).otherwise(F.lit(0)).cast(MONEY)
                )
                .cast(MONEY)
                .alias("total_allowed_amount"),
                F.coalesce("_liability", zero).alias("total_member_liability_amount"),
                "prior_claim_id",
            )
        )

    @cached_property
    def payment_transaction(self) -> DataFrame:
        order_key, line = F.col("l_orderkey"), F.col("line_number")
        reversal = (F.col("l_returnflag") == "R") & (line > 1)
        net = F.col("allowed_amount") - F.col("member_liability_amount")
        extra = F.when(overpaid(order_key) & (line == 1), F.lit(5000)).otherwise(F.lit(0)).cast(MONEY)
        ledger = self._dated_lines.filter(~F.col("_denied")).select(
            "l_orderkey", "line_number", "transaction_date", "_sequence", reversal.alias("_reversal"),
            net.alias("_net"), extra.alias("_extra"),
        )
        return ledger.select(
            line_id("PAY", order_key, line).alias("payment_transaction_id"),
            claim_id(order_key).alias("claim_id"),
            F.col("_sequence").cast("int").alias("transaction_sequence_number"),
            "transaction_date",
            F.when(F.col("_reversal"), "reversal").otherwise("payment").alias("transaction_type"),
            F.when(F.col("_reversal"), -F.col("_net"))
            .otherwise(F.col("_net") + F.col("_extra"))
            .cast(MONEY)
            .alias("signed_transaction_amount"),
            F.when(F.col("_reversal"), line_id("PAY", order_key, F.lit(1))).alias("reverses_transaction_id"),
        )

    @cached_property
    def adjudication_event(self) -> DataFrame:
        order_key = F.col("o_orderkey")
        steps = F.explode(F.array(F.lit(1), F.lit(2))).alias("event_sequence_number")
        step = F.col("event_sequence_number")
        return self._orders.select("o_orderkey", "service_from_date", "claim_status", steps).select(
            line_id("ADJ", order_key, step).alias("adjudication_event_id"),
            claim_id(order_key).alias("claim_id"),
            "event_sequence_number",
            F.date_add("service_from_date", (order_key % 4 + step * 5).cast("int"))
            .cast("timestamp_ntz")
            .alias("event_timestamp"),
            F.when(step == 2, "received").alias("prior_status"),
            F.when(step == 2, F.col("claim_status")).otherwise("received").alias("resulting_status"),
            F.lit(None).cast("string").alias("reason_code"),
        )

    @cached_property
    def denial_outcome(self) -> DataFrame:
        headers = self.claim_header
        return headers.filter(F.col("claim_status") == "denied").select(
            F.regexp_replace("claim_id", "^CLM", "DEN").alias("denial_id"),
            "claim_id",
            F.col("received_date").alias("denial_date"),
            F.lit("coverage").alias("denial_reason_code"),
            F.col("total_charge_amount").alias("denied_amount"),
        )

    @cached_property
    def claim_review(self) -> DataFrame:
        order_key = F.col("o_orderkey")
        completed = order_key % 40 == 0
        service = F.col("service_from_date")
        return self._orders.filter(order_key % 20 == 0).select(
            padded("REV", order_key, 12).alias("review_id"),
            claim_id(order_key).alias("claim_id"),
            F.when(completed, "completed").otherwise("in_review").alias("review_status"),
            F.date_add(service, 20).alias("selected_date"),
            F.when(completed, F.date_add(service, 30)).alias("completed_date"),
            F.when(order_key % 60 == 0, "random").otherwise("amount").alias("selection_reason"),
        )

    @cached_property
    def audit_outcome(self) -> DataFrame:
        order_key = F.col("o_orderkey")
        confirmed = order_key % 120 == 0
        return self._orders.filter(order_key % 40 == 0).select(
            padded("AUD", order_key, 12).alias("audit_id"),
            padded("REV", order_key, 12).alias("review_id"),
            claim_id(order_key).alias("claim_id"),
            F.when(confirmed, "confirmed_overpayment").otherwise("no_issue").alias("outcome"),
            F.when(confirmed, F.lit("25.50")).otherwise(F.lit("0.00")).cast(MONEY).alias("confirmed_amount"),
            F.date_add("service_from_date", 30).alias("outcome_date"),
        )

    @cached_property
    def recovery_transaction(self) -> DataFrame:
        recovered = self.audit_outcome.filter(F.col("confirmed_amount") > 0)
        return recovered.select(
            F.regexp_replace("audit_id", "^AUD", "RCV").alias("recovery_transaction_id"),
            "audit_id",
            "claim_id",
            F.date_add("outcome_date", 15).alias("recovery_date"),
            (F.col("confirmed_amount") / 2).cast(MONEY).alias("recovered_amount"),
            F.lit("partial").alias("recovery_status"),
        )

    @cached_property
    def anomaly_injection(self) -> DataFrame:
        """Labels for the planted irregularities."""
        order_key = F.col("l_orderkey")
        copies = self._dated_lines.filter(exact_copy(order_key) | near_copy(order_key))
        last = copies.groupBy("l_orderkey").agg(
            F.max_by(
                F.struct("line_number", "allowed_amount", "member_liability_amount", "service_from_date"),
                "line_number",
            ).alias("_last")
        )
        line_labels = last.select(
            F.when(exact_copy(order_key), "PI001").otherwise("PI002").alias("rule_id"),
            F.lit("claim_line").alias("label_scope"),
            F.lit("claim_line").alias("target_table"),
            line_id("LIN", order_key, F.col("_last.line_number")).alias("target_record_id"),
            claim_id(order_key).alias("claim_id"),
            line_id("LIN", order_key, F.col("_last.line_number")).alias("claim_line_id"),
            F.lit(None).cast("string").alias("payment_transaction_id"),
            F.lit("row_insertion").alias("injection_method"),
            F.trunc("_last.service_from_date", "MM").alias("reporting_period"),
            (F.col("_last.allowed_amount") - F.col("_last.member_liability_amount"))
            .cast(MONEY)
            .alias("expected_financial_exposure"),
        )
        claim_key = F.col("o_orderkey")
        def claim_labels(rule, planted, amount, method, source):
            return source.filter(planted).select(
                F.lit(rule).alias("rule_id"),
                F.lit("claim").alias("label_scope"),
                F.lit("claim_header" if rule == "PI005" else "payment_transaction").alias("target_table"),
                claim_id(claim_key).alias("target_record_id"),
                claim_id(claim_key).alias("claim_id"),
                F.lit(None).cast("string").alias("claim_line_id"),
                # the amount too much is paid with the first line
                (line_id("PAY", claim_key, F.lit(1)) if rule == "PI006" else F.lit(None).cast("string")).alias("payment_transaction_id"),
                F.lit(method).alias("injection_method"),
                F.trunc("service_from_date", "MM").alias("reporting_period"),
                F.lit(amount).cast(MONEY).alias("expected_financial_exposure"),
            )

        raised = claim_labels("PI005", raised_header(claim_key), "10.00", "field_mutation", self._orders)
        paid_orders = self._orders.filter(F.col("claim_status") != "denied").join(
            self.read("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"
        )
        overpayments = claim_labels("PI006", overpaid(claim_key), "5000.00", "ledger_mutation", paid_orders)
        return (
            line_labels.unionByName(raised)
            .unionByName(overpayments)
            .select(
                F.concat_ws("-", F.lit("INJ"), "rule_id", "target_record_id").alias("injection_id"),
                "rule_id",
                "target_table",
                "target_record_id",
                "claim_id",
                "claim_line_id",
                "payment_transaction_id",
                F.lit(None).cast("string").alias("provider_id"),
                "reporting_period",
                "injection_method",
                "label_scope",
                F.lit(None).cast("string").alias("overlap_group"),
                "expected_financial_exposure",
                F.lit(LABEL_SEED).alias("deterministic_seed"),
                F.lit(1).alias("contract_version"),
                F.lit(True).alias("synthetic_record"),
            )
        )

    def tables(self) -> Mapping[str, DataFrame]:
        """All operational tables by contract name, each built when it is first asked for."""
        names = (
            "member plan provider provider_contract membership_month claim_header claim_line "
            "adjudication_event payment_transaction claim_review denial_outcome policy_assignment "
            "audit_outcome recovery_transaction anomaly_injection"
        ).split()
        return LazyTables(self, names)

    @cached_property
    def service_categories(self) -> DataFrame:
        """Category mapping of most services; the rest fall back to their system's name."""
        return self.read("part").filter(F.col("p_partkey") % 10 != 0).select(
            code_system(F.col("p_partkey")).alias("service_code_system"),
            F.col("p_partkey").cast("string").alias("service_code"),
            F.element_at(
                F.create_map(*[F.lit(x) for pair in PART_TYPE_CATEGORY.items() for x in pair]), F.col("p_type")
            ).alias("service_category"),
        )

    @cached_property
    def facts(self) -> Facts:
        """The tables in conformed shape, labels left out."""
        names = (
            "plan provider membership_month claim_header claim_line payment_transaction claim_review "
            "policy_assignment"
        ).split()
        unlabelled = {name: getattr(self, name) for name in names}
        return from_operational(unlabelled, self.service_categories, self.layers)
