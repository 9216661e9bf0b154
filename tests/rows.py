"""Small raw and staged rows for the unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from stockflow.sources import schemas
from stockflow.operators import staging

D0 = dt.date(2024, 3, 4)  # a Monday
T0 = dt.datetime(2024, 3, 4, 12, 0, 0)


def day(n: int) -> dt.date:
    return D0 + dt.timedelta(days=n)


def _frame(spark, schema, defaults, rows):
    data = [tuple({**defaults(i), **r}[f.name] for f in schema) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def raw_sales(spark, *rows):
    def defaults(i):
        return dict(
            event_id=f"s{i}", event_type="sale", ts=T0, sku="A", category="Tops", channel="web",
            quantity=1, unit_price=Decimal("10.00"), discount_pct=Decimal("0.00"), size="M",
            color="Navy", transaction_id=f"t{i}", ingested_at=T0,
        )

    return _frame(spark, schemas.RAW_SALES, defaults, rows)


def raw_moves(spark, *rows):
    def defaults(i):
        return dict(
            event_id=f"m{i}", event_type="adjustment", ts=T0, sku="A", category="Tops",
            warehouse="WH-WEST", delta=1, reason="damage", reference_id=f"r{i}", ingested_at=T0,
        )

    return _frame(spark, schemas.RAW_STOCK_MOVEMENTS, defaults, rows)


def raw_deliveries(spark, *rows):
    def defaults(i):
        return dict(
            event_id=f"d{i}", event_type="delivery", ts=T0, sku="A", category="Tops",
            supplier_id="SUP-1", po_number=f"PO-{i}", quantity=10, unit_cost=Decimal("2.00"),
            expected_date=D0, actual_date=D0, ingested_at=T0,
        )

    return _frame(spark, schemas.RAW_SUPPLIER_DELIVERIES, defaults, rows)


def at(n: int) -> dt.datetime:
    return T0 + dt.timedelta(days=n)


def sales(spark, *rows):
    """Staged sales; each row may give ``d``, a day number."""
    return staging.stg_sales(raw_sales(spark, *[_dated(r) for r in rows]))


def moves(spark, *rows):
    return staging.stg_stock_movements(raw_moves(spark, *[_dated(r) for r in rows]))


def _dated(row):
    row = dict(row)
    return {**({"ts": at(row.pop("d"))} if "d" in row else {}), **row}


def listed(df, *columns, by=None):
    """Rows as sorted tuples."""
    got = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(got, key=by or (lambda t: tuple((x is None, str(x)) for x in t)))
