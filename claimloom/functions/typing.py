"""Column factories that turn all-text landings into typed, annotated columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "bigint"
EXACT = "decimal(38,6)"


def cleaned(source: Column) -> Column:
    return F.trim(source.cast("string"))


def present(source: Column) -> Column:
    """Trimmed text, null when blank."""
    return F.nullif(cleaned(source), F.lit(""))


def parsed(text: Column, kind: str) -> Column:
    """Number of a text, null if it is none.  Whole numbers round half up, they never truncate."""
    exact = text.try_cast(EXACT)
    return F.round(exact, 0).try_cast(WHOLE) if kind == WHOLE else exact


def measure(source: Column, kind: str) -> Column:
    return parsed(cleaned(source), kind)


def token_measure(source: Column, kind: str, tokens: Sequence[str]) -> Column:
    """Measure whose governed tokens (suppressed, not applicable, blank) mean null."""
    text = cleaned(source)
    return parsed(F.when(~text.isin(*tokens), text), kind)


def unparseable(source: Column, kind: str, exempt: Sequence[str] | None = None) -> Column:
    """True for non-null text that should be a number and is not.

    ``exempt`` lists allowed texts; ``None`` exempts nothing but nulls.
    """
    text = cleaned(source)
    wrong = source.isNotNull() & parsed(text, kind).isNull()
    return wrong & ~text.isin(*exempt) if exempt else wrong


def fractional(source: Column) -> Column:
    """True when the text is a number with a fraction; looks at the text, not the rounded value."""
    value = cleaned(source).try_cast(EXACT)
    return F.coalesce(value % 1 != 0, F.lit(False))


def dimension(source: Column, unknown: str | None = None) -> Column:
    text = present(source)
    return F.coalesce(text, F.lit(unknown)) if unknown else text


def missing(source: Column) -> Column:
    return present(source).isNull()


def token_status(source: Column, statuses: dict[str, str], otherwise: str, trim: bool = True) -> Column:
    """Status named by an indicator token."""
    text = cleaned(source) if trim else source
    result = F.lit(otherwise)
    for token, status in statuses.items():
        result = F.when(text == token, status).otherwise(result)
    return result


def null_status(value: Column) -> Column:
    """Status of a measure that is withheld by leaving it empty."""
    return F.when(value.isNull(), "suppressed").otherwise("published")


def top_coded(value: Column, bound: int) -> Column:
    return F.coalesce(value == bound, F.lit(False))


def count_true(flags: Sequence[Column]) -> Column:
    """How many of the row's flags hold."""
    total = F.lit(0)
    for flag in flags:
        total = total + F.coalesce(flag, F.lit(False)).cast("int")
    return total


def token_count(sources: Sequence[Column], tokens: Sequence[str]) -> Column:
    return count_true([cleaned(source).isin(*tokens) for source in sources])


def band(value: Column, bands: Sequence[tuple[str, int, int | None]], when_null: str | None = None) -> Column:
    """Label of the inclusive range holding the value; the last range may be open."""
    result = F.when(value.isNull(), F.lit(when_null)) if when_null else None
    for label, low, high in bands:
        inside = value >= low if high is None else value.between(low, high)
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result


def above(left: Column, right: Column, null_is_false: bool) -> Column:
    """Reported relationship; three-valued unless nulls count as false."""
    test = left > right
    return F.coalesce(test, F.lit(False)) if null_is_false else test


def domestic_only(value: Column, country: Column, domestic: str = "US") -> Column:
    """Peer geography is compared inside the home country only."""
    return F.when(country == domestic, value).otherwise("Not applicable")


def geography_scope(country: Column, domestic: str = "US") -> Column:
    return F.when(country == domestic, "United States").otherwise("Foreign")


def geography_identifier(
    level: Column, name: Column, code: Column, fixed: Sequence[tuple[str, str, str]], coded: Sequence[str]
) -> Column:
    """Fixed (level, name) pairs without a code first, then LEVEL:code for coded levels, else null."""
    result = None
    for fixed_level, fixed_name, identifier in fixed:
        test = (level == fixed_level) & (name == fixed_name) & code.isNull()
        result = F.when(test, identifier) if result is None else result.when(test, identifier)
    return result.when(
        level.isin(*coded) & code.isNotNull(), F.concat(F.upper(level), F.lit(":"), code)
    )


def matches(value: Column, pattern: str) -> Column:
    """The whole text fits the pattern."""
    return value.rlike(f"^(?:{pattern})$")
