"""Exact decimal rounding in DuckDB, where ``/`` on decimals would fall back to doubles."""

from __future__ import annotations


def scaled(value: str, digits: int) -> str:
    """A decimal of at most ``digits`` fraction digits as a whole number."""
    return f"CAST(({value}) * CAST(1{'0' * digits} AS DECIMAL(10,0)) AS HUGEINT)"


def whole(value: str) -> str:
    return f"CAST({value} AS HUGEINT)"


def half_up(numerator: str, denominator: str, digits: int = 4) -> str:
    """Whole-number quotient times 10^digits, rounded half away from zero, as a double; null over 0."""
    n, d = f"(({numerator}) * {10 ** digits})", f"({denominator})"
    rounded = f"((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0))"
    return f"(CAST(sign({n}) * sign({d}) * {rounded} AS DOUBLE) / {10 ** digits})"


def half_even(numerator: str, denominator: str, digits: int = 4) -> str:
    """The same with ties to even."""
    n, d = f"abs(({numerator}) * {10 ** digits})", f"nullif(abs({denominator}), 0)"
    quotient, rest = f"({n} // {d})", f"({n} % {d})"
    up = f"CASE WHEN 2 * {rest} > {d} OR (2 * {rest} = {d} AND {quotient} % 2 = 1) THEN 1 ELSE 0 END"
    sign = f"sign({numerator}) * sign({denominator})"
    return f"(CAST({sign} * ({quotient} + {up}) AS DOUBLE) / {10 ** digits})"
