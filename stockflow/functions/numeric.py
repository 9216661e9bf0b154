"""Exact rounding and threshold arithmetic, as SQL expression text.

Ratios are rounded half away from zero from their exact integer numerator and
denominator, so no intermediate double or truncated decimal can move a value
across a rounding edge or a threshold. Arguments are SQL expressions: whole numbers,
bigint where the range is known to be small, ``decimal(38,0)`` for money totals.
"""

from __future__ import annotations

MONEY = "decimal(18,2)"
#: Money without a practical bound.
WIDE_MONEY = "decimal(38,2)"
WIDE = "decimal(38,0)"


def money(amount: str) -> str:
    return f"cast({amount} AS {MONEY})"


def cents(amount: str) -> str:
    """A two-digit decimal as a whole number of hundredths."""
    return f"cast(({amount}) * 100 AS bigint)"


def sum_cents(column: str) -> str:
    """Sum of a two-digit decimal column in hundredths.

    Adding bigints is many times cheaper than adding wide decimals, and reaches further
    than the ``decimal(18,2)`` result does; past that, ANSI arithmetic raises.
    """
    return f"sum({cents(column)})"


def from_cents(total: str) -> str:
    return f"cast(cast({total} AS decimal(19,0)) * 0.01 AS {MONEY})"


def sum_money(column: str) -> str:
    """Sum of a two-digit decimal column, exact, as money."""
    return from_cents(sum_cents(column))


def wide(total: str) -> str:
    """A whole number with room to be scaled up; for totals, once per group."""
    return f"cast({total} AS {WIDE})"


def ratio_round(num: str, den: str, digits: int) -> str:
    """``round(num / den, digits)``; NULL when either side is NULL or ``den`` is not positive."""
    scale = 10**digits
    whole = f"((abs({num}) * {2 * scale} + ({den})) div (2 * ({den})))"
    signed = f"CASE WHEN ({num}) < 0 THEN -{whole} ELSE {whole} END"
    exact = f"cast({signed} AS decimal(19,0)) * {1 / scale:.{digits}f}"
    return f"CASE WHEN ({den}) > 0 THEN cast({exact} AS decimal(18,{digits})) END"


def percent(part: str, whole: str, digits: int) -> str:
    """``round(part / whole * 100, digits)`` with the same guards as :func:`ratio_round`."""
    return ratio_round(f"({part}) * 100", whole, digits)


def mean_round(column: str, digits: int = 2) -> str:
    """``round(avg(column), digits)`` of a two-digit decimal, from its exact sum and count."""
    return ratio_round(wide(sum_cents(column)), wide(f"count({column}) * 100"), digits)


def cover_below(stock: str, units: str, days: str, limit: int) -> str:
    """True when ``stock / (units / days) < limit``, compared without dividing."""
    return f"coalesce({units} > 0 AND {stock} * {days} < {limit} * {units}, false)"


def cover_above(stock: str, units: str, days: str, limit: int) -> str:
    """True when ``stock / (units / days) > limit``, compared without dividing."""
    return f"coalesce({units} > 0 AND {stock} * {days} > {limit} * {units}, false)"
