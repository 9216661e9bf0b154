"""Topics, wire schemas, table schemas and reorder thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic names.
SALES_TOPIC = "fashion.pos.sales"
STOCK_TOPIC = "fashion.warehouse.stock_movement"
SUPPLIER_TOPIC = "fashion.supplier.deliveries"

# Reorder threshold per category, matched exactly as received.
REORDER_THRESHOLDS = {
    "Dresses": 30,
    "Tops": 50,
    "Denim": 25,
    "Footwear": 20,
    "Accessories": 60,
    "Outerwear": 15,
    "Swimwear": 10,
}
DEFAULT_THRESHOLD = 20


_TEXT, _INT, _LONG, _DAY, _TIME = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DateType(),
    T.TimestampType(),
)
_PRICE, _PERCENT = T.DecimalType(12, 2), T.DecimalType(5, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_HEAD = {
    "event_id": _TEXT,
    "event_type": _TEXT,
    "timestamp": _TIME,
    "sku": _TEXT,
    "category": _TEXT,
}
SALES_WIRE = _struct(
    **_HEAD,
    channel=_TEXT,
    quantity=_INT,
    unit_price=_PRICE,
    discount_pct=_PERCENT,
    size=_TEXT,
    color=_TEXT,
    transaction_id=_TEXT,
)
STOCK_WIRE = _struct(**_HEAD, warehouse=_TEXT, delta=_INT, reason=_TEXT, reference_id=_TEXT)
SUPPLIER_WIRE = _struct(
    **_HEAD,
    supplier_id=_TEXT,
    po_number=_TEXT,
    quantity=_INT,
    unit_cost=_PRICE,
    expected_date=_DAY,
    actual_date=_DAY,
)


def _raw(wire: T.StructType) -> T.StructType:
    """The stored form: ``timestamp`` becomes ``ts`` and the ingest time is added."""
    fields = [T.StructField("ts" if f.name == "timestamp" else f.name, f.dataType) for f in wire]
    return T.StructType([*fields, T.StructField("ingested_at", _TIME)])


RAW_SALES = _raw(SALES_WIRE)
RAW_STOCK_MOVEMENTS = _raw(STOCK_WIRE)
RAW_SUPPLIER_DELIVERIES = _raw(SUPPLIER_WIRE)
REORDER_ALERTS = _struct(
    sku=_TEXT,
    category=_TEXT,
    threshold=_INT,
    current_stock=_LONG,
    alert_ts=_TIME,
    resolved=T.BooleanType(),
)
QUARANTINE = _struct(
    letter_id=_TEXT,
    topic=_TEXT,
    key=_TEXT,
    value=_TEXT,
    raw_value=T.BinaryType(),
    reason=_TEXT,
    ingested_at=_TIME,
)
#: Stock of a SKU after a batch that changed it.
SKU_STOCK = _struct(sku=_TEXT, stock=_LONG, as_of_batch=_LONG)

#: topic -> (raw table name, wire schema)
ROUTES = {
    SALES_TOPIC: ("raw_sales", SALES_WIRE),
    STOCK_TOPIC: ("raw_stock_movements", STOCK_WIRE),
    SUPPLIER_TOPIC: ("raw_supplier_deliveries", SUPPLIER_WIRE),
}

#: table name -> schema of every table that ingest creates
INGEST_TABLES = {
    "raw_sales": RAW_SALES,
    "raw_stock_movements": RAW_STOCK_MOVEMENTS,
    "raw_supplier_deliveries": RAW_SUPPLIER_DELIVERIES,
    "reorder_alerts": REORDER_ALERTS,
    "dead_letters": QUARANTINE,
}

#: table name -> the column that no two of its rows share
KEY_OF = {**{table: "event_id" for table, _ in ROUTES.values()}, "dead_letters": "letter_id"}

#: table name -> the day that its rows are compacted by
DAY_OF = {
    **{table: "cast(ts AS date)" for table, _ in ROUTES.values()},
    "reorder_alerts": "cast(alert_ts AS date)",
    "dead_letters": "cast(ingested_at AS date)",
}
