"""Reproducible ranks, fractions and fingerprints from SHA-256."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.errors import ContractError


def digest(seed: int, namespace: str, value: Column) -> Column:
    """Hex digest of ``seed:namespace:value``; its order is the selection order."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(namespace), value.cast("string")), 256)


def unit(seed: int, namespace: str, value: Column) -> Column:
    """Fraction in [0, 1) from the digest's first eight bytes."""
    head = F.conv(F.substring(digest(seed, namespace, value), 1, 16), 16, 10).cast("decimal(20,0)")
    return head.cast("double") / F.lit(float(2**64))


def bounded_integer(seed: int, namespace: str, value: Column, low: int, high: int) -> Column:
    if low > high:
        raise ContractError(f"empty range {low}..{high} for {namespace}")
    return F.lit(low) + F.floor(unit(seed, namespace, value) * (high - low + 1)).cast("int")


def normalized_weights(entries: Sequence[tuple[str, float]]) -> list[tuple[str, float]]:
    total = sum(weight for _, weight in entries)
    if total <= 0:
        raise ContractError("weights must be positive")
    return [(name, weight / total) for name, weight in entries]


def weighted_choice(fraction: Column, entries: Sequence[tuple[str, float]]) -> Column:
    """Entry whose cumulative weight first exceeds the fraction; weights must sum to one."""
    if not entries or abs(sum(weight for _, weight in entries) - 1.0) > 1e-9:
        raise ContractError("weights must sum to one")
    result, cumulative = F, 0.0
    for name, weight in entries[:-1]:
        cumulative += weight
        result = result.when(fraction < cumulative, name)
    return result.otherwise(entries[-1][0]) if len(entries) > 1 else F.lit(entries[0][0])


def select_ranked(
    df: DataFrame, seed: int, namespace: str, identity: str, per_bucket: int, buckets: Sequence[str]
) -> DataFrame:
    """First ``per_bucket`` rows by digest for each bucket in turn, disjoint.

    Only the selected rows are sorted in full: Spark keeps the smallest digests of every partition.
    """
    wanted = per_bucket * len(buckets)
    chosen = df.withColumn("_digest", digest(seed, namespace, F.col(identity))).orderBy("_digest").limit(wanted)
    place = F.row_number().over(Window.orderBy("_digest")) - 1
    names = F.array(*[F.lit(name) for name in buckets])
    return chosen.withColumn("selection_order", place).withColumn(
        "bucket", F.element_at(names, F.floor(F.col("selection_order") / per_bucket).cast("int") + 1)
    ).drop("_digest")


# text that JSON holds as it stands
PLAIN_TEXT = r"^[ !#-\[\]-~]*\z"
DAYS = ("0001-01-01", "9999-12-31")


def json_of(column: str, kind: str) -> Column:
    """A value as ``{"v":value}``, ``{}`` if null, as ``to_json`` writes it.

    Ordinary values are put together by concatenation, as ``to_json`` builds a writer for each.
    """
    value = F.col(column)
    general = F.coalesce(F.to_json(F.struct(value.alias("v"))), F.lit("{}"))
    quoted = F.concat(F.lit('{"v":"'), value.cast("string"), F.lit('"}'))
    null = F.when(value.isNull(), F.lit("{}"))
    if kind == "string":
        return null.when(value.rlike(PLAIN_TEXT), quoted).otherwise(general)
    if kind == "date":
        return null.when(value.between(*(F.lit(day).cast("date") for day in DAYS)), quoted).otherwise(general)
    # decimals of more than six places may be written with an exponent
    whole = kind in ("boolean", "tinyint", "smallint", "int", "bigint")
    if whole or (kind.startswith("decimal") and int(kind[:-1].split(",")[1]) <= 6):
        return null.otherwise(F.concat(F.lit('{"v":'), value.cast("string"), F.lit("}")))
    return general


def row_digest(columns: Sequence[tuple[str, str]]) -> Column:
    """Digest of a row as canonical JSON, nulls kept in place; ``columns`` are names and types."""
    return F.sha2(F.concat_ws(",", *[json_of(name, kind) for name, kind in columns]), 256)


def whole_row_digest(columns: Sequence[str]) -> Column:
    """Binary digest of a row as one JSON object, to tell versions of a row apart."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def content_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and order-insensitive content fingerprint.

    Sums of digest words detect added, lost and changed rows without any sort.  A word of 60 bits is summed in three
    parts, so that sums are whole numbers of 64 bits over any table.
    """
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    starts, parts, bits = (1, 16, 31, 46), 3, 20
    hashed = df.select(row_digest([(name, kinds[name]) for name in names]).alias("_d"))
    words = hashed.select(*[F.conv(F.substring("_d", s, 15), 16, 10).cast("bigint").alias(f"_{s}") for s in starts])

    def word(start: int) -> Column:
        part = lambda place: F.shiftright(f"_{start}", bits * place).bitwiseAND(F.lit((1 << bits) - 1))
        scaled = [F.sum(part(p)).cast("decimal(20,0)") * F.lit(1 << bits * p).cast("decimal(13,0)") for p in range(parts)]
        return reduce(add, scaled).cast("decimal(38,0)")

    return words.agg(
        F.count("*").alias("row_count"),
        F.sha2(
            F.concat_ws(
                ":", F.count("*").cast("string"),
                *[F.coalesce(word(s), F.lit(0)).cast("string") for s in starts]
            ),
            256,
        ).alias("content_sha256"),
    )


def schema_fingerprint(df: DataFrame, skip_prefix: str = "_") -> str:
    """Digest of column names and types; lineage columns do not count."""
    columns = [
        {"name": f.name, "type": f.dataType.simpleString()}
        for f in df.schema.fields
        if not f.name.startswith(skip_prefix)
    ]
    return hashlib.sha256(json.dumps(columns, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
