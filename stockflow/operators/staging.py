"""Cleaned staging rows from raw events, and the incremental read of new raw rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import scalars as S


_SALE = "event_id IS NOT NULL AND sku IS NOT NULL AND quantity > 0 AND unit_price > 0"
_AMOUNTS_FIT = " AND ".join(
    S.fits_money(amount)
    for amount in (S.exact_line("quantity", "unit_price"), S.exact_net("quantity", "unit_price", "discount_pct"))
)


def valid_sales(raw: DataFrame) -> DataFrame:
    """Identified rows with a positive quantity and price; NULLs fail the test.

    Rows whose amounts no money column holds go to ``oversized_sales``. The amounts are computed
    with room for any quantity and price, so the order of the tests does not matter.
    """
    return raw.filter(f"{_SALE} AND {_AMOUNTS_FIT}")


def oversized_sales(raw: DataFrame) -> DataFrame:
    """Valid rows but for an amount out of range, with a reason; the hourly run stores them."""
    return raw.filter(f"{_SALE} AND NOT ({_AMOUNTS_FIT})").selectExpr("*", "'amount out of range' AS reason")


def valid_movements(raw: DataFrame) -> DataFrame:
    """Identified rows that change stock."""
    return raw.filter("event_id IS NOT NULL AND sku IS NOT NULL AND delta <> 0")


def stg_sales(raw: DataFrame, business_tz: str | None = None) -> DataFrame:
    """Clean sales. ISO week goes with the calendar year, so 2024-12-30 is week 1 of 2024."""
    at = S.local_time("ts", business_tz)
    return valid_sales(raw).selectExpr(
        "event_id",
        "transaction_id",
        "sku",
        f"{S.upper_clean('category')} AS category",
        f"{S.lower_clean('channel')} AS channel",
        "size",
        "color",
        "cast(ts AS timestamp) AS event_ts",
        f"cast({at} AS date) AS event_date",
        f"weekofyear({at}) AS event_week",
        f"month({at}) AS event_month",
        f"year({at}) AS event_year",
        "cast(quantity AS int) AS quantity",
        "cast(unit_price AS decimal(12,2)) AS unit_price",
        "cast(coalesce(discount_pct, 0) AS decimal(5,2)) AS discount_pct",
        f"{S.line_amount('quantity', 'unit_price')} AS gross_revenue",
        f"{S.net_revenue('quantity', 'unit_price', 'discount_pct')} AS net_revenue",
        "cast(ingested_at AS timestamp) AS ingested_at",
    )


def stg_stock_movements(raw: DataFrame, business_tz: str | None = None) -> DataFrame:
    """Clean stock movements with direction and absolute size."""
    return valid_movements(raw).selectExpr(
        "event_id",
        "reference_id",
        "sku",
        f"{S.upper_clean('category')} AS category",
        f"{S.upper_clean('warehouse')} AS warehouse",
        f"{S.lower_clean('event_type')} AS movement_type",
        f"{S.lower_clean('reason')} AS reason",
        "cast(ts AS timestamp) AS event_ts",
        f"cast({S.local_time('ts', business_tz)} AS date) AS event_date",
        "cast(delta AS int) AS stock_delta",
        f"{S.direction('delta')} AS direction",
        "cast(abs(delta) AS int) AS units_moved",
        "cast(ingested_at AS timestamp) AS ingested_at",
    )


def high_water_mark(target: DataFrame) -> dt.datetime | None:
    """Latest ingest time in the target, or None when it is empty (one value to the driver)."""
    micros = target.agg(F.expr("unix_micros(max(ingested_at)) AS mark")).first()["mark"]
    if micros is None:
        return None
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


def newer_than(
    raw: DataFrame, mark: dt.datetime | None, overlap: dt.timedelta | None = None
) -> DataFrame:
    """Raw rows past the mark, as a literal comparison that prunes files and row groups.

    No mark means take everything. ``overlap`` re-reads a margin for rows that were
    stamped with the mark but stored after it was read; the upsert absorbs repeats.
    """
    if mark is None:
        return raw
    since = mark - overlap if overlap else mark
    return raw.filter(f"ingested_at > {S.instant(since)}")
