"""Expressions shared by staging, marts and reports, as SQL expression text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.functions.numeric import MONEY, ratio_round

# Cover limits in days.
REORDER_COVER_DAYS = 21
OVERSTOCK_COVER_DAYS = 90
CRITICAL_COVER_DAYS = 7
WARNING_COVER_DAYS = 14
REORDER_SUPPLY_DAYS = 30

#: What a staged money column holds; a sale of this amount or more is stored apart.
AMOUNT_LIMIT = 10**14


def exprs(*texts: str) -> list[Column]:
    return [F.expr(text) for text in texts]


def date(day: dt.date) -> str:
    return f"DATE '{day.isoformat()}'"


def instant(at: dt.datetime) -> str:
    """A time literal; without an offset it is read in the session's zone."""
    return f"TIMESTAMP '{at.isoformat(sep=' ')}'"


def upper_clean(text: str) -> str:
    """Upper case without surrounding spaces; tabs and newlines stay."""
    return f"upper(trim({text}))"


def lower_clean(text: str) -> str:
    return f"lower(trim({text}))"


def local_time(ts: str, business_tz: str | None) -> str:
    """The wall-clock time that calendar columns are cut from."""
    return ts if business_tz is None else f"from_utc_timestamp({ts}, '{business_tz}')"


def week_start(day: str) -> str:
    """Monday of the week."""
    return f"trunc({day}, 'week')"


def month_start(day: str) -> str:
    return f"trunc({day}, 'month')"


def exact_line(quantity: str, price: str) -> str:
    """Quantity times a two-digit price, in a type that holds any product of the two."""
    return f"(cast({quantity} AS decimal(10,0)) * cast({price} AS decimal(12,2)))"


def exact_net(quantity: str, unit_price: str, discount_pct: str) -> str:
    """The line less its discount; a negative discount is a surcharge."""
    kept = f"cast(100 - {discount_pct} AS decimal(6,2))"
    return f"round({exact_line(quantity, unit_price)} * {kept} * 0.01, 2)"


def fits_money(amount: str) -> str:
    """Whether an exact amount is one that money columns, and sums of many, can hold."""
    return f"coalesce(abs({amount}) < {AMOUNT_LIMIT}, true)"


def line_amount(quantity: str, price: str) -> str:
    """Quantity times a two-digit price; NULL where no money column holds it."""
    return f"try_cast({exact_line(quantity, price)} AS {MONEY})"


def net_revenue(quantity: str, unit_price: str, discount_pct: str) -> str:
    """Uses the discount as received: an unknown discount gives an unknown net amount."""
    return f"try_cast({exact_net(quantity, unit_price, discount_pct)} AS {MONEY})"


def direction(delta: str) -> str:
    return f"CASE WHEN {delta} > 0 THEN 'inbound' WHEN {delta} < 0 THEN 'outbound' ELSE 'neutral' END"


def days_on_hand(stock: str, units: str, days: str) -> str:
    """Days of cover at the mean rate ``units / days``; NULL when nothing sold."""
    return ratio_round(f"({stock} * {days})", units, 1)


def urgency_tier(stock: str, days: str) -> str:
    """Tier from cover rounded to one digit; unknown cover with stock left is healthy."""
    return f"""CASE WHEN {stock} = 0 THEN 'OUT_OF_STOCK'
        WHEN {days} < {CRITICAL_COVER_DAYS} THEN 'CRITICAL'
        WHEN {days} < {WARNING_COVER_DAYS} THEN 'WARNING'
        WHEN {days} < {REORDER_COVER_DAYS} THEN 'LOW'
        ELSE 'HEALTHY' END"""


def reorder_quantity(velocity_30d: str, stock: str) -> str:
    """Units to order for 30 days of supply at the rounded velocity, never negative."""
    wanted = f"{velocity_30d} * {REORDER_SUPPLY_DAYS} - cast({stock} AS decimal(19,0))"
    return f"cast(greatest(ceil({wanted}), 0) AS int)"
