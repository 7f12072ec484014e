"""Plant labelled irregularities in claims tables to back-test the review rules.

Targets are the lowest digests among eligible records, so a run can be repeated exactly.  Each
seeder returns changed tables, labels, and the change of every touched field.  Target lists are
bounded by ``target_count`` per rule, which is what allows them to be broadcast.  Whether a record is
eligible is looked up in digest order, in shares of the table that widen up to the whole of it, so the
large tables are scanned and not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.contracts.review_rules import COMPATIBLE_DIAGNOSES, DIAGNOSIS_CATEGORIES, INCOMPATIBLE_DIAGNOSIS
from claimloom.errors import ContractError
from claimloom.functions.hashing import digest, select_ranked
from claimloom.functions.numbers import MONEY, UNITS, total
from claimloom.operators.keys import dense_positions, number_within
from claimloom.session import written

PAYABLE = ("paid", "adjusted")
# rows looked at for each target, and by how much they grow where too few of them are eligible
FIRST_LOOK = 16
HEADER_OF_LINE = {
    "total_charge_amount": "charge_amount",
    "total_allowed_amount": "allowed_amount",
    "total_member_liability_amount": "member_liability_amount",
}
# fixed values: target table, injection method and label scope of each rule
METHODS = {
    "PI001": ("claim_line", "row_insertion", "claim_line"),
    "PI002": ("claim_line", "row_insertion", "claim_line"),
    "PI003": ("payment_transaction", "ledger_mutation", "payment_transaction"),
    "PI004": ("payment_transaction", "field_mutation", "payment_transaction"),
    "PI005": ("claim_header", "field_mutation", "claim"),
    "PI006": ("payment_transaction", "ledger_mutation", "claim"),
    "PI007": ("claim_line", "field_mutation", "provider"),
    "PI008": ("claim_header", "provider_period_pattern", "provider_period"),
    "PI009": ("claim_line", "row_insertion", "claim"),
    "PI010": ("claim_header", "field_mutation", "claim"),
}


@dataclass(frozen=True)
class SeedSettings:
    seed: int
    target_count: int = 50
    peer_multiplier: str = "1.25"
    minimum_peers: int = 11
    surge_factor: float = 3.0
    minimum_months: int = 6
    minimum_claims: int = 11
    policy_start: date = date(2026, 1, 1)
    contract_version: int = 1


@dataclass(frozen=True)
class Seeded:
    """Tables after seeding, with the labels and field changes collected so far."""

    tables: dict[str, DataFrame]
    labels: DataFrame | None = None
    changes: DataFrame | None = None
    keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = field(default=lambda name, build: build())
    # tables before the first step, and the rows inserted since
    original: dict[str, DataFrame] | None = None
    added: dict[str, list[DataFrame]] = field(default_factory=dict)

    def extended(self, tables: dict[str, DataFrame], labels: DataFrame, changes: DataFrame,
                 added: dict[str, DataFrame] | None = None) -> Seeded:
        joined = lambda old, new: new if old is None else old.unionByName(new)
        return replace(
            self, tables={**self.tables, **tables}, labels=joined(self.labels, labels),
            changes=joined(self.changes, changes), original=self.original or self.tables,
            added=self.added | {name: [*self.added.get(name, []), rows] for name, rows in (added or {}).items()},
        )

    def before(self, table: str) -> DataFrame:
        return (self.original or self.tables)[table]

    def numbers(self, table: str, column: str, where: Column | None = None, name: str = "") -> tuple[str, int, int]:
        """Prefix, highest number and digit count of an identifier column; the large table is looked through once."""
        of = lambda df: identifier_numbers(df if where is None else df.filter(where), column)
        parts = [self.keep(f"seed_numbers_{name}{column}", lambda: of(self.before(table))), *map(of, self.added.get(table, []))]
        row = reduce(DataFrame.unionByName, parts).agg(
            F.max("top").alias("top"), F.max("size").alias("size"), F.first("prefix", ignorenulls=True).alias("prefix")).first()
        return row["prefix"], row["top"], row["size"] - 3

    def unlabelled(self, headers: DataFrame) -> DataFrame:
        """Headers of claims without a label; labels are a bounded list."""
        if self.labels is None:
            return headers
        taken = self.labels.select("claim_id").distinct()
        return headers.join(taken, "claim_id", "left_anti")


def required(targets: DataFrame, count: int, what: str) -> None:
    found = targets.count()
    if found < count:
        raise ContractError(f"need {count} {what}, found {found}")


def identifier_numbers(df: DataFrame, column: str) -> DataFrame:
    """Prefix, highest number and longest text of an identifier column, in one row."""
    return df.agg(
        F.max(F.substr(F.col(column), F.lit(4)).cast("bigint")).alias("top"),
        F.max(F.length(column)).alias("size"),
        F.first(F.substring(column, 1, 3), ignorenulls=True).alias("prefix"),
    )


def new_identifier(numbers: tuple[str, int, int], offset: Column) -> Column:
    """Identifier ``offset`` (from 1) places after the highest existing one."""
    prefix, top, digits = numbers
    text = (F.lit(top) + offset).cast("bigint").cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0")))


def with_match(few: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of the small written table ``few`` that have their ``key`` in ``rows``, which are narrowed to its keys first."""
    return few.join(rows.join(few.select(key), key, "left_semi").select(key).distinct(), key, "left_semi")


def lowest_eligible(pool: DataFrame, rows: int, eligible: Callable[[DataFrame], DataFrame], seed: int, namespace: str, identity: str,
                    wanted: int) -> DataFrame:
    """Eligible rows of ``pool`` that hold the ``wanted`` lowest digests of all eligible ones.

    ``eligible`` judges each row (or group of rows, by its lowest digest) by itself, so it is asked about all rows below a digest,
    ``FIRST_LOOK`` times as many as wanted at first; where too few are eligible, ``FIRST_LOOK`` times more, and in the end all.
    ``rows`` is about the size of ``pool``; it sets how many are asked about, not what is found.
    """
    look = FIRST_LOOK * wanted
    while look < rows:
        below = F.lit(f"{(look << 64) // rows:016x}")
        found = written(eligible(written(pool.filter(digest(seed, namespace, F.col(identity)) < below))))
        if found.count() >= wanted:
            return found
        look *= FIRST_LOOK
    return eligible(pool)


def value_tag(kind: str) -> str:
    """Governed type name of a Spark type."""
    if kind.startswith("decimal"):
        return "DECIMAL_18_4" if kind.endswith(",4)") else "DECIMAL_18_2"
    return {"date": "DATE", "timestamp_ntz": "DATE", "timestamp": "DATE", "boolean": "BOOLEAN", "int": "INTEGER",
            "bigint": "INTEGER", "smallint": "INTEGER"}.get(kind, "VARCHAR")


def change(operation: str, table: str, record: Column, column: str, kind: str, before: Column | None,
           after: Column, violation: bool) -> Column:
    before = F.lit(None) if before is None else before
    known = F.coalesce(after.cast("string"), before.cast("string"))
    return F.struct(
        F.lit(operation).alias("field_operation"),
        F.lit(table).alias("target_table"),
        record.alias("target_record_id"),
        F.lit(column).alias("column_name"),
        F.when(known.isNull(), "NULL").otherwise(value_tag(kind)).alias("governed_value_type"),
        before.cast("string").alias("before_value"),
        after.cast("string").alias("after_value"),
        F.lit(violation).alias("expected_contract_violation"),
    )


def inserted(df_types: list[tuple[str, str]], table: str, record: Column, row: str, marked: set[str]) -> list[Column]:
    """One change per column of an inserted row held in struct ``row``."""
    return [
        change("insert", table, record, name, kind, None, F.col(f"{row}.{name}"), name in marked)
        for name, kind in df_types
    ]


def listed_changes(df: DataFrame, changes: Column) -> DataFrame:
    """Numbered changes of one array per injection."""
    return df.select("injection_id", F.posexplode(changes).alias("_place", "_change")).select(
        "injection_id", (F.col("_place") + 1).cast("int").alias("change_sequence_number"), "_change.*"
    )


def label_rows(df: DataFrame, rule: Column, settings: SeedSettings) -> DataFrame:
    """Label columns from a frame with target_record_id, claim_id, ..., exposure."""
    pick = lambda place: reduce(
        lambda other, item: F.when(rule == item[0], item[1][place]).otherwise(other), METHODS.items(), F.lit(None)
    )
    names = ("claim_line_id", "payment_transaction_id")
    optional = [(F.col(n) if n in df.columns else F.lit(None)).cast("string").alias(n) for n in names]
    return df.select(
        "injection_id",
        rule.alias("rule_id"),
        pick(0).alias("target_table"),
        "target_record_id",
        "claim_id",
        *optional,
        "provider_id",
        "reporting_period",
        pick(1).alias("injection_method"),
        pick(2).alias("label_scope"),
        F.lit(None).cast("string").alias("overlap_group"),
        F.col("exposure").cast(MONEY).alias("expected_financial_exposure"),
        F.lit(settings.seed).alias("deterministic_seed"),
        F.lit(settings.contract_version).alias("contract_version"),
        F.lit(True).alias("synthetic_record"),
    )


def injection_id(first: int, order: Column) -> Column:
    return F.concat(F.lit("INJ"), F.lpad((order + first).cast("string"), 10, "0"))


def first_of(df: DataFrame, key: str, order: str, name: str, latest: bool = False) -> DataFrame:
    """Per key, the row with the lowest (or highest) ``order`` as struct ``name``."""
    best = F.max_by if latest else F.min_by
    return df.groupBy(key).agg(best(F.struct(*df.columns), order).alias(name))


def with_header_deltas(headers: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add per-claim amounts; ``deltas`` holds one row per target claim."""
    joined = headers.join(deltas, "claim_id", "left")
    for total_name, line_name in HEADER_OF_LINE.items():
        moved = F.coalesce(F.col(f"d_{line_name}"), F.lit(0))
        joined = joined.withColumn(total_name, (F.col(total_name) + moved).cast(MONEY))
    return joined.select(*headers.columns)


def with_payment_deltas(payments: DataFrame, deltas: DataFrame) -> DataFrame:
    joined = payments.join(deltas, "payment_transaction_id", "left")
    amount = F.col("signed_transaction_amount") + F.coalesce("d_payment", F.lit(0))
    return joined.withColumn("signed_transaction_amount", amount.cast(MONEY)).select(*payments.columns)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def seed_record_level(state: Seeded, settings: SeedSettings) -> Seeded:
    """PI001, PI002, PI005, PI006: copied lines, raised headers, raised payments."""
    headers, lines, payments = (state.tables[t] for t in ("claim_header", "claim_line", "payment_transaction"))
    rules = ("PI001", "PI002", "PI005", "PI006")
    payable = headers.filter(F.col("claim_status").isin(*PAYABLE)).select("claim_id")
    ranked = (settings.seed, "record_level_target", "claim_id")

    def eligible(claims: DataFrame) -> DataFrame:
        """Claims with lines and payments, with the first line, the last line's number and the last payment."""
        own = lambda df: written(df.join(claims, "claim_id", "left_semi"))
        billed, paid = own(lines), own(payments)
        return (
            claims.join(first_of(billed, "claim_id", "line_number", "l"), "claim_id")
            .join(billed.groupBy("claim_id").agg(F.max("line_number").alias("_last")), "claim_id")
            .join(first_of(paid, "claim_id", "payment_transaction_id", "p", latest=True), "claim_id")
        )

    chosen = state.keep(
        "seed_record_targets",
        lambda: select_ranked(lowest_eligible(payable, state.before("claim_header").count(), eligible, *ranked, settings.target_count * len(rules)), *ranked,
                              settings.target_count, rules),
    )
    required(chosen, settings.target_count * len(rules), "claims for record-level rules")
    targets = chosen
    line_numbers = state.numbers("claim_line", "claim_line_id")
    billed = headers.join(targets.select("claim_id"), "claim_id", "left_semi")
    detail = targets.join(billed.select("claim_id", F.struct(*headers.columns).alias("h")), "claim_id")
    rule = F.col("bucket")
    copied = rule.isin("PI001", "PI002")
    overrides = {
        "claim_line_id": new_identifier(line_numbers, F.col("selection_order") + 1),
        "line_number": F.col("_last") + 1,
        "units": F.when(rule == "PI002", F.col("l.units") + F.lit("0.25").cast(UNITS)).otherwise(F.col("l.units")),
    }
    copy = F.struct(
        *[overrides.get(n, F.col(f"l.{n}")).cast(k).alias(n) for n, k in lines.dtypes]
    )
    net = F.col("n.allowed_amount") - F.col("n.member_liability_amount")
    governed = F.col("h.total_allowed_amount") - F.col("h.total_member_liability_amount")
    ten = F.lit("10.00").cast(MONEY)
    raised = governed + ten - F.col("p.signed_transaction_amount")
    detail = detail.withColumn("n", F.when(copied, copy)).withColumn(
        "exposure", F.when(copied, net).when(rule == "PI005", ten).otherwise(raised).cast(MONEY)
    )
    detail = detail.withColumn("injection_id", injection_id(1, F.col("selection_order")))
    detail = detail.withColumn("provider_id", F.col("h.billing_provider_id")).withColumn(
        "reporting_period", month_start(F.col("h.service_from_date"))
    )
    detail = state.keep("seed_record_detail", lambda: detail)
    new_lines = detail.filter(copied).select("n.*")
    header_deltas = detail.filter(rule != "PI006").select(
        "claim_id",
        *[
            F.when(copied, F.col(f"n.{n}")).otherwise(ten if n == "allowed_amount" else F.lit(0)).cast(MONEY)
            .alias(f"d_{n}")
            for n in HEADER_OF_LINE.values()
        ],
    )
    payment_deltas = detail.filter(rule != "PI005").select(
        F.col("p.payment_transaction_id").alias("payment_transaction_id"), F.col("exposure").alias("d_payment")
    )
    claim, amount = F.col("claim_id"), F.col("p.signed_transaction_amount")
    payment_change = lambda violation: change(
        "update", "payment_transaction", F.col("p.payment_transaction_id"), "signed_transaction_amount",
        "decimal(18,2)", amount, (amount + F.col("exposure")).cast(MONEY), violation,
    )
    header_change = lambda name, delta, violation: change(
        "update", "claim_header", claim, name, "decimal(18,2)", F.col(f"h.{name}"),
        (F.col(f"h.{name}") + delta).cast(MONEY), violation,
    )
    for_copies = F.array(
        *inserted(lines.dtypes, "claim_line", F.col("n.claim_line_id"), "n",
                  {"service_code", "service_date", "units"}),
        *[header_change(t, F.col(f"n.{n}"), False) for t, n in HEADER_OF_LINE.items()],
        payment_change(False),
    )
    changes = F.when(copied, for_copies).when(
        rule == "PI005", F.array(header_change("total_allowed_amount", ten, True))
    ).otherwise(F.array(payment_change(True)))
    labelled = detail.withColumn(
        "target_record_id", F.when(copied, F.col("n.claim_line_id")).otherwise(claim)
    ).withColumn("claim_line_id", F.col("n.claim_line_id")).withColumn(
        "payment_transaction_id", F.when(rule == "PI006", F.col("p.payment_transaction_id"))
    )
    return state.extended(
        {
            "claim_line": lines.unionByName(new_lines),
            "claim_header": with_header_deltas(headers, header_deltas),
            "payment_transaction": with_payment_deltas(payments, payment_deltas),
        },
        label_rows(labelled, rule, settings),
        listed_changes(detail, changes),
        {"claim_line": new_lines},
    )


def seed_ledger(state: Seeded, settings: SeedSettings) -> Seeded:
    """PI003 reversal with partial repayment; PI004 payment dated before service."""
    headers, payments = state.tables["claim_header"], state.tables["payment_transaction"]
    rules = ("PI003", "PI004")
    open_claims = state.unlabelled(headers.select("claim_id"))
    paid = payments.filter((F.col("transaction_type") == "payment") & (F.col("signed_transaction_amount") > 0))
    eligible = lambda some: with_match(some, open_claims, "claim_id")
    ranked = (settings.seed, "ledger_temporal_target", "payment_transaction_id")
    chosen = state.keep(
        "seed_ledger_targets",
        lambda: select_ranked(lowest_eligible(paid, state.before("payment_transaction").count(), eligible, *ranked, settings.target_count * len(rules)), *ranked,
                              settings.target_count, rules),
    )
    required(chosen, settings.target_count * len(rules), "payments for ledger rules")
    numbers = state.numbers("payment_transaction", "payment_transaction_id")
    first = state.labels.count() + 1
    order, rule = F.col("selection_order"), F.col("bucket")
    amount = F.col("signed_transaction_amount")
    repaid = F.bround(amount * F.lit("0.40").cast("decimal(4,2)"), 2).cast(MONEY)
    types = dict(payments.dtypes)

    def added(offset: int, sequence: int, days: int, kind: str, value: Column, reverses: Column) -> Column:
        fields = {
            "payment_transaction_id": new_identifier(numbers, order * 2 + offset),
            "claim_id": F.col("claim_id"),
            "transaction_sequence_number": F.lit(sequence),
            "transaction_date": F.date_add("transaction_date", days),
            "transaction_type": F.lit(kind),
            "signed_transaction_amount": value,
            "reverses_transaction_id": reverses,
        }
        return F.struct(*[fields[n].cast(types[n]).alias(n) for n in payments.columns])

    service = headers.select("claim_id", F.col("service_from_date").alias("_service"),
                             F.col("billing_provider_id").alias("provider_id"))
    own = F.col("payment_transaction_id")
    detail = service.join(chosen, "claim_id").select(
        "*",
        injection_id(first, order).alias("injection_id"),
        added(1, 2, 1, "reversal", -amount, own).alias("r"),
        added(2, 3, 2, "payment", repaid, F.lit(None)).alias("n"),
        F.when(rule == "PI003", repaid).otherwise(F.lit(0)).cast(MONEY).alias("exposure"),
        month_start(F.col("_service")).alias("reporting_period"),
        F.date_sub("_service", 1).alias("_early"),
    )
    detail = state.keep("seed_ledger_detail", lambda: detail)
    inserted_rows = detail.filter(rule == "PI003").select(F.explode(F.array("r", "n")).alias("_row")).select("_row.*")
    early = detail.filter(rule == "PI004").select("payment_transaction_id", "_early")
    moved = payments.join(early, "payment_transaction_id", "left").withColumn(
        "transaction_date", F.coalesce("_early", "transaction_date")
    )
    marked = {"transaction_type", "signed_transaction_amount"}
    record = lambda row: F.col(f"{row}.payment_transaction_id")
    changes = F.when(
        rule == "PI003",
        F.array(*inserted(payments.dtypes, "payment_transaction", record("r"), "r", set()),
                *inserted(payments.dtypes, "payment_transaction", record("n"), "n", marked)),
    ).otherwise(
        F.array(change("update", "payment_transaction", own, "transaction_date", "date",
                       F.col("transaction_date"), F.col("_early"), True))
    )
    target = F.when(rule == "PI003", F.col("n.payment_transaction_id")).otherwise(own)
    labelled = detail.withColumn("target_record_id", target).withColumn("payment_transaction_id", target)
    return state.extended(
        {"payment_transaction": moved.select(*payments.columns).unionByName(inserted_rows)},
        label_rows(labelled, rule, settings),
        listed_changes(detail, changes),
        {"payment_transaction": inserted_rows},
    )


def seed_outlier_amounts(state: Seeded, settings: SeedSettings) -> Seeded:
    """PI007: raise one line per claim above every peer; later targets of a group exceed earlier ones."""
    headers, lines, payments = (state.tables[t] for t in ("claim_header", "claim_line", "payment_transaction"))
    providers = state.tables["provider"].select(F.col("provider_id").alias("billing_provider_id"), "specialty_group")
    group = ["specialty_group", "service_code_system"]
    billed = headers.select("claim_id", "billing_provider_id", "claim_status", "service_from_date")

    def peer_groups() -> DataFrame:
        placed = lines.select("claim_id", "service_code_system", "allowed_amount").join(
            billed.select("claim_id", "billing_provider_id").join(providers, "billing_provider_id"), "claim_id")
        return placed.groupBy(*group).agg(
            F.count("*").alias("_peers"), F.max("allowed_amount").alias("_top")
        ).filter(F.col("_peers") >= settings.minimum_peers)

    real = payments.filter(F.col("transaction_type") == "payment")
    ranked = (settings.seed, "pi007_target", "claim_line_id")

    def eligible(some: DataFrame) -> DataFrame:
        """One line of each claim, the one with the lowest digest, and the claim's first payment."""
        claims = billed.filter(F.col("claim_status").isin(*PAYABLE)).join(some.select("claim_id"), "claim_id", "left_semi")
        placed = some.join(written(claims.join(providers, "billing_provider_id")), "claim_id")
        candidates = (
            state.unlabelled(placed)
            .join(state.keep("seed_outlier_groups", peer_groups), group)
            .withColumn("_digest", digest(settings.seed, "pi007_target", F.col("claim_line_id")))
        )
        one_each = candidates.groupBy("claim_id").agg(
            F.min_by(F.struct(*[c for c in candidates.columns if c != "claim_id"]), "_digest").alias("_line")
        )
        paid = written(real.join(some.select("claim_id"), "claim_id", "left_semi"))
        return one_each.select("claim_id", "_line.*").join(first_of(paid, "claim_id", "payment_transaction_id", "p"), "claim_id")

    def targets() -> DataFrame:
        found = lowest_eligible(lines, state.before("claim_line").count(), eligible, *ranked, settings.target_count)
        return found.orderBy("_digest").limit(settings.target_count).withColumn(
            "selection_order", F.row_number().over(Window.orderBy("_digest")) - 1)

    chosen = state.keep("seed_outlier_targets", targets)
    required(chosen, settings.target_count, "lines for PI007")
    times = F.lit(settings.peer_multiplier).cast("decimal(6,4)")
    turn = F.row_number().over(Window.partitionBy(*group).orderBy("selection_order"))
    allowed, charge, liability = (F.col(n) for n in ("allowed_amount", "charge_amount", "member_liability_amount"))
    # each earlier target of the group has itself become the peer maximum
    raised = F.aggregate(
        F.sequence(F.lit(1), F.col("_turn")), F.col("_top"), lambda top, _: F.round(top * times, 2).cast(MONEY)
    )
    scaled = lambda value: F.bround(
        F.try_divide((F.col("_allowed") * value).cast("decimal(32,4)"), allowed.cast("decimal(14,2)")), 2
    ).cast(MONEY)
    first = state.labels.count() + 1
    money = lambda name: F.coalesce(name, F.lit(0)).cast(MONEY)
    detail = (
        chosen.withColumn("_turn", turn)
        .withColumn("_allowed", raised)
        .withColumn("_charge", scaled(charge))
        .withColumn("_liability", money(scaled(liability)))
        .join(
            headers.join(chosen.select("claim_id"), "claim_id", "left_semi").select("claim_id", F.struct(*headers.columns).alias("h")),
            "claim_id",
        )
        .withColumn("d_charge_amount", F.col("_charge") - charge)
        .withColumn("d_allowed_amount", F.col("_allowed") - allowed)
        .withColumn("d_member_liability_amount", F.col("_liability") - liability)
        .withColumn("exposure", (F.col("d_allowed_amount") - F.col("d_member_liability_amount")).cast(MONEY))
        .withColumn("injection_id", injection_id(first, F.col("selection_order")))
        .withColumn("provider_id", F.col("billing_provider_id"))
        .withColumn("reporting_period", month_start(F.col("service_from_date")))
    )
    detail = state.keep("seed_outlier_detail", lambda: detail)
    new_values = detail.select("claim_line_id", "_charge", "_allowed", "_liability")
    changed = lines.join(new_values, "claim_line_id", "left")
    for name in ("charge", "allowed", "liability"):
        column = "member_liability_amount" if name == "liability" else f"{name}_amount"
        changed = changed.withColumn(column, F.coalesce(f"_{name}", column).cast(MONEY))
    line, amount = F.col("claim_line_id"), F.col("p.signed_transaction_amount")
    updates = [
        change("update", "claim_line", line, n, "decimal(18,2)", F.col(n), F.col(v), n != "member_liability_amount")
        for n, v in (("charge_amount", "_charge"), ("allowed_amount", "_allowed"), ("member_liability_amount", "_liability"))
    ] + [
        change("update", "claim_header", F.col("claim_id"), t, "decimal(18,2)", F.col(f"h.{t}"),
               (F.col(f"h.{t}") + F.col(f"d_{n}")).cast(MONEY), False)
        for t, n in HEADER_OF_LINE.items()
    ] + [
        change("update", "payment_transaction", F.col("p.payment_transaction_id"), "signed_transaction_amount",
               "decimal(18,2)", amount, (amount + F.col("exposure")).cast(MONEY), False)
    ]
    payment = F.col("p.payment_transaction_id")
    labelled = detail.withColumn("target_record_id", line).withColumn("payment_transaction_id", payment)
    return state.extended(
        {
            "claim_line": changed.select(*lines.columns),
            "claim_header": with_header_deltas(headers, detail.select("claim_id", *[f"d_{n}" for n in HEADER_OF_LINE.values()])),
            "payment_transaction": with_payment_deltas(
                payments, detail.select(payment.alias("payment_transaction_id"), F.col("exposure").alias("d_payment"))
            ),
        },
        label_rows(labelled, F.lit("PI007"), settings),
        listed_changes(detail, F.array(*updates)),
    )


def seed_surges(state: Seeded, settings: SeedSettings) -> Seeded:
    """PI008: clone claims of a provider month until it clearly exceeds the provider's history."""
    headers, lines = state.tables["claim_header"], state.tables["claim_line"]
    events, payments = state.tables["adjudication_event"], state.tables["payment_transaction"]
    period = ["billing_provider_id", "_month"]
    dated = headers.withColumn("_month", month_start(F.col("service_from_date")))
    before = F.col("_month") < F.lit(settings.policy_start)
    positive = payments.filter(F.col("signed_transaction_amount") > 0).select("claim_id")
    name = F.concat_ws(":", "billing_provider_id", F.col("_month").cast("string"))
    periods = dated.filter(~before).select(*period).distinct().withColumn("_period", name)
    ranked = (settings.seed, "pi008_target", "_period")

    def usable(some: DataFrame) -> DataFrame:
        """Claims of some provider months that may be cloned."""
        claims = dated.filter(~before).join(some.select(*period), period, "left_semi")
        return written(with_match(written(state.unlabelled(claims).select(*dated.columns)), positive, "claim_id"))

    looked_at = []

    def eligible(some: DataFrame) -> DataFrame:
        monthly = dated.join(some.select("billing_provider_id"), "billing_provider_id", "left_semi").groupBy(*period).agg(
            F.count("*").alias("_claims"))
        history = monthly.filter(before).groupBy("billing_provider_id").agg(
            F.count("*").alias("_months"), F.sum("_claims").alias("_history")
        ).filter((F.col("_months") >= settings.minimum_months) & (F.col("_history") >= settings.minimum_claims))
        looked_at.append(usable(some))
        sizes = looked_at[-1].groupBy(*period).agg(F.count("*").alias("_templates"))
        return sizes.join(monthly, period).join(history, "billing_provider_id").withColumn("_period", name)

    chosen = state.keep(
        "seed_surge_targets",
        lambda: select_ranked(lowest_eligible(periods, periods.count(), eligible, *ranked, settings.target_count), *ranked,
                              settings.target_count, ("PI008",)),
    )
    required(chosen, settings.target_count, "provider months for PI008")
    first = state.labels.count() + 1
    average = F.col("_history").cast("double") / F.col("_months")
    needed = F.greatest(F.col("_claims") + 1, F.floor(average * settings.surge_factor) + 1) - F.col("_claims")
    wanted = chosen.select(
        *period, "_period", "_templates", "selection_order",
        injection_id(first, F.col("selection_order")).alias("injection_id"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), needed - 1)).alias("_offset"),
    ).withColumn("_template", F.col("_offset") % F.col("_templates") + 1)

    def cloned() -> DataFrame:
        known = looked_at[-1] if looked_at else usable(chosen)
        templates = number_within(
            known.join(chosen.select(*period), period, "left_semi"), period, ["claim_id"], "_template"
        )
        claim_numbers = state.numbers("claim_header", "claim_id")
        logical_numbers = state.numbers("claim_header", "logical_claim_id")
        place = F.col("_clone") + 1
        return dense_positions(wanted, ["selection_order", "_offset"], "_clone").join(
            templates.select(*period, "_template", F.struct(*headers.columns).alias("h")), [*period, "_template"]
        ).select(
            "injection_id", "_period", "billing_provider_id", "_month", "_clone",
            new_identifier(claim_numbers, place).alias("claim_id"),
            new_identifier(logical_numbers, place).alias("_logical"), "h",
        )

    clones = state.keep("seed_surge_clones", cloned)
    own = {"claim_id": F.col("claim_id"), "logical_claim_id": F.col("_logical"),
           "claim_version_number": F.lit(1), "prior_claim_id": F.lit(None)}
    new_headers = clones.select(
        "injection_id", "_clone",
        F.struct(*[own.get(n, F.col(f"h.{n}")).cast(k).alias(n) for n, k in headers.dtypes]).alias("_row"),
    )
    source = clones.select("injection_id", "_clone", F.col("claim_id").alias("_new_claim"),
                           F.col("h.claim_id").alias("claim_id"))

    def children(rows: DataFrame, identity: str, fixed: dict[str, Column], name: str, numbers: Callable[[], tuple[str, int, int]]) -> DataFrame:
        """Copies of child rows under the new claims, with new identifiers in clone order."""

        def build() -> DataFrame:
            # written, as sorting into ranges reads its rows twice
            own = written(rows.join(source.select("claim_id"), "claim_id", "left_semi"))
            copied = dense_positions(own.join(source, "claim_id"), ["_clone", identity], "_copy")
            values = {identity: new_identifier(numbers(), F.col("_copy") + 1), "claim_id": F.col("_new_claim"), **fixed}
            row = F.struct(*[values.get(n, F.col(n)).cast(k).alias(n) for n, k in rows.dtypes])
            return copied.select("injection_id", "_clone", row.alias("_row"))

        return state.keep(f"seed_surge_{name}", build)

    is_payment = F.col("transaction_type") == "payment"
    parts = {
        "claim_header": (headers, "claim_id", new_headers),
        "claim_line": (lines, "claim_line_id", children(
            lines, "claim_line_id", {}, "lines", lambda: state.numbers("claim_line", "claim_line_id"))),
        "adjudication_event": (events, "adjudication_event_id", children(
            events, "adjudication_event_id", {}, "events", lambda: state.numbers("adjudication_event", "adjudication_event_id"))),
        "payment_transaction": (
            payments, "payment_transaction_id",
            children(payments.filter(is_payment), "payment_transaction_id",
                     {"transaction_sequence_number": F.lit(1), "reverses_transaction_id": F.lit(None)}, "payments",
                     lambda: state.numbers("payment_transaction", "payment_transaction_id", is_payment, "real_")),
        ),
    }
    exposure = parts["payment_transaction"][2].groupBy("injection_id").agg(
        total(F.col("_row.signed_transaction_amount")).alias("exposure")
    )
    claims = clones.groupBy("injection_id").agg(
        F.min_by("claim_id", "_clone").alias("claim_id"), F.first("_period").alias("target_record_id"),
        F.first("billing_provider_id").alias("provider_id"), F.first("_month").alias("reporting_period"),
    )
    labelled = claims.join(exposure, "injection_id")
    stacked = []
    for order, (table, (rows, identity, added)) in enumerate(parts.items()):
        marked = {"claim_id"} if table == "claim_header" else set()
        values = inserted(rows.dtypes, table, F.col(f"_row.{identity}"), "_row", marked)
        stacked.append(
            added.select("injection_id", "_clone", F.lit(order).alias("_table"),
                         F.posexplode(F.array(*values)).alias("_column", "_change"))
        )
    every = reduce(DataFrame.unionByName, stacked).select("injection_id", "_clone", "_table", "_column", "_change.*")
    told = [c for c in every.columns if c not in ("injection_id", "_clone", "_table", "_column")]
    changes = state.keep(
        "seed_surge_changes",
        lambda: number_within(every, ["injection_id"], ["_clone", "_table", "target_record_id", "_column"], "_sequence").select(
            "injection_id", F.col("_sequence").cast("int").alias("change_sequence_number"), *told),
    )
    return state.extended(
        {table: rows.unionByName(added.select("_row.*")) for table, (rows, _, added) in parts.items()},
        label_rows(labelled, F.lit("PI008"), settings),
        changes,
        {table: added.select("_row.*") for table, (_, _, added) in parts.items()},
    )


def seed_repeated_procedures(state: Seeded, settings: SeedSettings, limits: DataFrame) -> Seeded:
    """PI009: repeat a limited service until the claim holds one more than its limit."""
    headers, lines, payments = (state.tables[t] for t in ("claim_header", "claim_line", "payment_transaction"))
    service = ["service_code_system", "service_code"]
    open_claims = state.unlabelled(
        headers.filter(F.col("claim_status").isin(*PAYABLE) & F.col("claim_type").isin("professional", "outpatient"))
    ).select("claim_id")
    positive = payments.filter((F.col("transaction_type") == "payment") & (F.col("signed_transaction_amount") > 0))
    ranked = (settings.seed, "pi009_target", "claim_id")

    def eligible(claims: DataFrame) -> DataFrame:
        paid = first_of(written(positive.join(claims, "claim_id", "left_semi")), "claim_id", "payment_transaction_id", "p")
        usable = written(lines.join(claims, "claim_id", "left_semi"))
        last = usable.groupBy("claim_id").agg(F.max("line_number").alias("_last"))
        counted = usable.groupBy("claim_id", *service).agg(
            F.count("*").alias("_current"), F.min_by(F.struct(*lines.columns), "line_number").alias("l")
        )
        below = counted.join(limits.withColumnRenamed("limit", "_limit"), service).filter(F.col("_current") <= F.col("_limit"))
        # the line that comes first in the claim decides which service is repeated
        return below.groupBy("claim_id").agg(
            F.min_by(F.struct("l", "_current", "_limit"), "l.line_number").alias("_pick")
        ).select("claim_id", "_pick.*").join(last, "claim_id").join(paid, "claim_id")

    chosen = state.keep(
        "seed_repeat_targets",
        lambda: select_ranked(lowest_eligible(open_claims, state.before("claim_header").count(), eligible, *ranked, settings.target_count), *ranked,
                              settings.target_count, ("PI009",)),
    )
    required(chosen, settings.target_count, "claims for PI009")
    first, numbers = state.labels.count() + 1, state.numbers("claim_line", "claim_line_id")
    only = lambda df: df.join(chosen.select("claim_id"), "claim_id", "left_semi")
    copies = F.col("_limit") - F.col("_current") + 1
    # bounded targets, so a running sum over them may sit in one task
    earlier = F.coalesce(F.sum(copies).over(Window.orderBy("selection_order").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    detail = (
        chosen.withColumn("_earlier", earlier)
        .join(only(headers).select("claim_id", F.struct(*headers.columns).alias("h")), "claim_id")
        .withColumn("_copies", copies)
        .withColumn("exposure", ((F.col("l.allowed_amount") - F.col("l.member_liability_amount")) * copies).cast(MONEY))
        .withColumn("injection_id", injection_id(first, F.col("selection_order")))
        .withColumn("claim_line_id", new_identifier(numbers, F.col("_earlier") + 1))
        .withColumn("target_record_id", F.col("claim_line_id"))
        .withColumn("provider_id", F.col("h.billing_provider_id"))
        .withColumn("reporting_period", month_start(F.col("h.service_from_date")))
    )
    detail = state.keep("seed_repeat_detail", lambda: detail)
    step = F.col("_step")
    overrides = {"claim_line_id": new_identifier(numbers, F.col("_earlier") + step), "line_number": F.col("_last") + step}
    steps = detail.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_step")).withColumn(
        "n", F.struct(*[overrides.get(n, F.col(f"l.{n}")).cast(k).alias(n) for n, k in lines.dtypes])
    )
    running = lambda t, n, times: (F.col(f"h.{t}") + F.col(f"l.{n}") * times).cast(MONEY)
    line_changes = F.array(
        *inserted(lines.dtypes, "claim_line", F.col("n.claim_line_id"), "n", set(service)),
        *[
            change("update", "claim_header", F.col("claim_id"), t, "decimal(18,2)", running(t, n, step - 1),
                   running(t, n, step), False)
            for t, n in HEADER_OF_LINE.items()
        ],
    )
    per_step = len(lines.columns) + len(HEADER_OF_LINE)
    amount = F.col("p.signed_transaction_amount")
    payment = F.col("p.payment_transaction_id")
    first_part = steps.select("injection_id", "_step", F.posexplode(line_changes).alias("_place", "_change")).select(
        "injection_id", ((step - 1) * per_step + F.col("_place") + 1).cast("int").alias("change_sequence_number"), "_change.*"
    )
    second_part = detail.select(
        "injection_id", (F.col("_copies") * per_step + 1).cast("int").alias("change_sequence_number"),
        change("update", "payment_transaction", payment, "signed_transaction_amount", "decimal(18,2)", amount,
               (amount + F.col("exposure")).cast(MONEY), False).alias("_change"),
    ).select("injection_id", "change_sequence_number", "_change.*")
    deltas = detail.select("claim_id", *[
        (F.col(f"l.{n}") * F.col("_copies")).cast(MONEY).alias(f"d_{n}") for n in HEADER_OF_LINE.values()
    ])
    return state.extended(
        {
            "claim_line": lines.unionByName(steps.select("n.*")),
            "claim_header": with_header_deltas(headers, deltas),
            "payment_transaction": with_payment_deltas(
                payments, detail.select(payment.alias("payment_transaction_id"), F.col("exposure").alias("d_payment"))
            ),
        },
        label_rows(detail.withColumn("payment_transaction_id", payment), F.lit("PI009"), settings),
        first_part.unionByName(second_part),
        {"claim_line": steps.select("n.*")},
    )


def seed_diagnoses(state: Seeded, settings: SeedSettings, categories: DataFrame) -> Seeded:
    """PI010: replace the principal diagnosis by one that never fits the claim's only category."""
    headers, lines = state.tables["claim_header"], state.tables["claim_line"]
    diagnoses = {code: name for name, codes in DIAGNOSIS_CATEGORIES.items() for code in codes}
    never = {c: code for c, code in INCOMPATIBLE_DIAGNOSIS.items() if diagnoses[code] not in COMPATIBLE_DIAGNOSES[c]}
    service = ["service_code_system", "service_code"]
    open_claims = state.unlabelled(
        headers.filter(
            F.col("claim_status").isin(*PAYABLE) & F.col("claim_type").isin("professional", "inpatient", "outpatient")
        )
    ).select("claim_id")
    codes = F.create_map(*[F.lit(x) for pair in never.items() for x in pair])
    ranked = (settings.seed, "pi010_target", "claim_id")

    def eligible(claims: DataFrame) -> DataFrame:
        billed = lines.join(claims, "claim_id", "left_semi").select("claim_id", *service)
        named = billed.join(categories.select(*service, "service_category"), service, "left")
        single = named.groupBy("claim_id").agg(
            F.min("service_category").alias("_low"), F.max("service_category").alias("_high"),
            F.count_if(F.col("service_category").isNull()).alias("_unknown"),
        ).filter((F.col("_low") == F.col("_high")) & (F.col("_unknown") == 0) & F.col("_low").isin(*never))
        return single.join(claims, "claim_id").select("claim_id", codes[F.col("_low")].alias("_code"))

    chosen = state.keep(
        "seed_diagnosis_targets",
        lambda: select_ranked(lowest_eligible(open_claims, state.before("claim_header").count(), eligible, *ranked, settings.target_count), *ranked,
                              settings.target_count, ("PI010",)),
    )
    required(chosen, settings.target_count, "claims for PI010")
    first = state.labels.count() + 1
    joined = headers.join(chosen, "claim_id", "left")
    old = F.col("principal_diagnosis_code")
    detail = state.keep("seed_diagnosis_detail", lambda: joined.filter(F.col("_code").isNotNull()).select(
        "claim_id", old, "_code", F.col("claim_id").alias("target_record_id"),
        F.col("billing_provider_id").alias("provider_id"), month_start(F.col("service_from_date")).alias("reporting_period"),
        F.lit(0).alias("exposure"), injection_id(first, F.col("selection_order")).alias("injection_id"),
    ))
    changes = F.array(change("update", "claim_header", F.col("claim_id"), "principal_diagnosis_code", "string", old,
                             F.col("_code"), True))
    return state.extended(
        {"claim_header": joined.withColumn("principal_diagnosis_code", F.coalesce("_code", old)).select(*headers.columns)},
        label_rows(detail, F.lit("PI010"), settings),
        listed_changes(detail, changes),
    )


def seed_all(state: Seeded, settings: SeedSettings, limits: DataFrame, categories: DataFrame) -> Seeded:
    """All ten seeders in contract order, on disjoint claims."""
    for step in (seed_record_level, seed_ledger, seed_outlier_amounts, seed_surges):
        state = step(state, settings)
    return seed_diagnoses(seed_repeated_procedures(state, settings, limits), settings, categories)
