"""What changed between two versions of a keyed table: rows by digest, then fields of the rows that differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions.hashing import whole_row_digest
from claimloom.session import written

# into so many buckets keys are dealt to find those that hold a change
BUCKETS = 1 << 14

INSERT, DELETE, UPDATE = "insert", "delete", "update"


def unique_key(df: DataFrame, key: str) -> bool:
    """Whether no key comes twice or is null."""
    name = F.col(key)
    return df.groupBy(name.alias("_key")).agg(F.count("*").alias("_rows")).filter("_key is null or _rows > 1").isEmpty()


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int").alias("_bucket")


def unlike_buckets(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Those of ``BUCKETS`` buckets of keys, as ``_bucket``, whose rows differ.

    A bucket's rows are told by sums of four words of 32 bits of their digests, which combine in the tasks.
    """
    sides = []
    for df, sign in ((before, 1), (after, -1)):
        rows = df.select(_bucket(key), whole_row_digest(before.columns).alias("_digest"))
        words = rows.select("_bucket", *[F.xxhash64("_digest", F.lit(n)).alias(f"_{n}") for n in range(2)])
        halves = {f"_{n}{half}": part for n in range(2) for half, part in (
            ("low", F.col(f"_{n}").bitwiseAND(F.lit(0xFFFFFFFF))), ("high", F.shiftrightunsigned(f"_{n}", 32)))}
        sides.append(words.groupBy("_bucket").agg(
            *[(F.lit(sign) * part).alias(name) for name, part in {"_rows": F.count("*"), **{n: F.sum(p) for n, p in halves.items()}}.items()]))
    names = sides[0].columns[1:]
    sums = sides[0].unionByName(sides[1]).groupBy("_bucket").agg(*[F.sum(name).alias(name) for name in names])
    return sums.filter(" or ".join(f"{name} <> 0" for name in names)).select("_bucket")


def row_changes(before: DataFrame, after: DataFrame, key: str, unique: bool | None = None) -> DataFrame:
    """``record_id, operation`` of every row inserted, deleted or updated; ``key`` is meant to be unique and never null.

    Most rows are the same in both versions, so rows are compared one by one only in buckets of keys that differ; of
    those, keys and digests are shuffled.  ``unique`` tells whether keys of ``before`` are unique and never null, where
    that is known; otherwise all rows are compared, as each of a key's rows is held against each of the other version.
    Both sides must have the same columns; their order does not count.
    """
    if set(before.columns) != set(after.columns):
        raise ContractError(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    sides = before, after
    if unique_key(before, key) if unique is None else unique:
        # at most BUCKETS rows
        unlike = F.broadcast(written(unlike_buckets(before, after, key)))
        sides = [df.join(unlike, _bucket(key) == F.col("_bucket"), "left_semi") for df in sides]
    digest = whole_row_digest(before.columns)
    was, now = (df.select(F.col(key).alias("record_id"), digest.alias(name)) for df, name in zip(sides, ("_was", "_now"), strict=True))
    operation = F.when(F.col("_was").isNull(), INSERT).when(F.col("_now").isNull(), DELETE).otherwise(UPDATE)
    return was.join(now, "record_id", "full").filter(~F.col("_was").eqNullSafe(F.col("_now"))).select(
        "record_id", operation.alias("operation")
    )


def stays_unique(after: DataFrame, key: str, changed: DataFrame) -> bool:
    """Whether keys are unique and never null after ``changed``, the rows of ``row_changes``, if they were before.

    Two unlike rows of a key can't both be the one of before, so only the keys of ``changed`` are looked at.
    """
    ids = changed.select(F.col("record_id").alias("_id"))
    return ids.filter("_id is null").isEmpty() and unique_key(after.join(ids, F.col(key) == F.col("_id"), "left_semi"), key)


def field_changes(before: DataFrame, after: DataFrame, key: str, changed: DataFrame | None = None) -> DataFrame:
    """``record_id, operation, column_name, before_value, after_value``, values as text.

    Updated rows give the fields that differ; inserted and deleted rows give every field.  ``changed`` are the rows
    of ``row_changes``, where they are at hand; other rows are never compared field by field.
    """
    changed = row_changes(before, after, key) if changed is None else changed
    ids = changed.select(F.col("record_id").alias("_id"))
    sides = []
    for df, name in ((before, "_b"), (after, "_a")):
        texts = F.struct(*[F.col(c).cast("string").alias(c) for c in before.columns])
        # whole rows are met by few changes, so only those travel
        met = df.join(ids, F.col(key) == F.col("_id"), "left_semi")
        sides.append(met.select(F.col(key).alias("record_id"), texts.alias(name)))
    both = changed.join(sides[0], "record_id", "left").join(sides[1], "record_id", "left")

    def field(name: str) -> Column:
        return F.struct(F.lit(name).alias("column_name"), F.col(f"_b.{name}").alias("before_value"), F.col(f"_a.{name}").alias("after_value"))

    fields = both.select("record_id", "operation", F.explode(F.array(*[field(c) for c in before.columns])).alias("_f"))
    differs = ~F.col("before_value").eqNullSafe(F.col("after_value"))
    return fields.select("record_id", "operation", "_f.*").filter((F.col("operation") != UPDATE) | differs)


def net_changes(log: DataFrame, order: list[str]) -> DataFrame:
    """First value before and last value after of every field that a change log names, in the form of ``field_changes``.

    ``log`` has ``target_table, target_record_id, field_operation, column_name, before_value, after_value``; updates
    that end where they began are no change.
    """
    place = F.struct(*order)
    net = log.groupBy("target_table", F.col("target_record_id").alias("record_id"), F.col("field_operation").alias("operation"), "column_name").agg(
        F.min_by("before_value", place).alias("before_value"), F.max_by("after_value", place).alias("after_value")
    )
    return net.filter((F.col("operation") != UPDATE) | ~F.col("before_value").eqNullSafe(F.col("after_value")))


def unlike_fields(found: DataFrame, logged: DataFrame) -> DataFrame:
    """Field changes that only one side has, or that have other values there."""
    names = ["record_id", "operation", "column_name", "before_value", "after_value"]
    sides = found.select(*names, F.lit(1).alias("_side")).unionByName(logged.select(*names, F.lit(-1).alias("_side")))
    return sides.groupBy(*names).agg(F.sum("_side").alias("surplus")).filter(F.col("surplus") != 0)
