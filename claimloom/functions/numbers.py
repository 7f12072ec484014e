"""Money, rates and rounding.

Marts round half up; review rules and their scores round half to even.
A ratio over zero is null, never zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
UNITS = "decimal(18,4)"
RATE = "decimal(18,4)"
# sums over a whole table
WIDE_MONEY = "decimal(38,2)"


def zero(kind: str = MONEY) -> Column:
    return F.lit(0).cast(kind)


def total(amount: Column, kind: str = MONEY) -> Column:
    """Sum that is zero, not null, over no rows."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast(kind)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact decimal quotient; null over zero.  Operands stay narrow so many digits survive."""
    return F.try_divide(numerator, denominator)


def rate(numerator: Column, denominator: Column, kind: str = RATE) -> Column:
    """Quotient rounded half up to four digits."""
    return F.round(ratio(numerator, denominator), 4).cast(kind)


def count_as_decimal(count: Column) -> Column:
    return count.cast("decimal(14,0)")


def even_rate(numerator: Column, denominator: Column) -> Column:
    """Quotient of two counts or sums, rounded half to even at four digits."""
    return F.bround(ratio(numerator, denominator), 4).cast(RATE)


def or_fail(value: Column, message: Column | str, kind: str) -> Column:
    """``value``, or a runtime error where it is null."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.coalesce(value, F.raise_error(text).cast(kind))
