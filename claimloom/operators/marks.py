"""Bits that stand for keys: a small broadcast leaves most rows of a large table out of a join's shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# one bit for each remainder of a key's hash, in rows of 512 words: 8 MB at most
MARKS = 1 << 26
WORD, ROW = 64, 512


def bit_of(place: Column) -> Column:
    """A word with the bit of ``place``, from 0 to 63."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _with_words(df: DataFrame, key: str, wanted: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """Rows beside the words of their key's row of marks, and whether the key is marked; null without such a row."""
    place = F.pmod(F.xxhash64(key), F.lit(MARKS))
    word = F.floor(place / WORD)
    words = wanted.select(word.alias("_word"), bit_of(place % WORD).alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    held = F.map_from_entries(F.collect_list(F.struct((F.col("_word") % ROW).cast("int"), "_bits")))
    each = F.sequence(F.lit(0), F.lit(ROW - 1))
    rows = words.groupBy(F.floor(F.col("_word") / ROW).alias("_row")).agg(held.alias("_held")).select(
        "_row", F.transform(each, lambda n: F.coalesce(F.try_element_at("_held", n), F.lit(0))).alias("_words"))
    marked = F.get("_words", (word % ROW).cast("int")).bitwiseAND(bit_of(place % WORD)) != 0
    return df.join(F.broadcast(rows), F.floor(word / ROW) == F.col("_row"), how), marked


def may_match(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the column of that name of ``wanted``, and a few others that share its bit.

    An exact join is to follow; it then shuffles little more than the rows it keeps, while some millions of keys are
    wanted at most.  ``wanted`` is read beside the join, so it should be a written table.
    """
    rows, marked = _with_words(df, key, wanted, "inner")
    return rows.filter(marked).select(*df.columns)


def divide(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``may_match`` and all others, whose keys are certainly not wanted; reads ``df`` twice."""
    rows, marked = _with_words(df, key, wanted, "left")
    return may_match(df, key, wanted), rows.filter(~F.coalesce(marked, F.lit(False))).select(*df.columns)
