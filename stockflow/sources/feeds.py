"""Raw retail feeds derived from the star-schema tables and the ``events`` table.

``arrival_key`` makes the arrival order total and is dropped once duplicates are gone.
The feeds repeat event ids on purpose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators.dedup import first_wins
from stockflow.sources.schemas import SALES_TOPIC, STOCK_TOPIC, SUPPLIER_TOPIC

ARRIVAL = ["ingested_at", "arrival_key"]


#: Columns the feeds read; stating them saves a schema-inference job per read.
_COLUMNS = {
    "lineitem": {
        "l_orderkey": T.LongType(),
        "l_partkey": T.LongType(),
        "l_suppkey": T.LongType(),
        "l_linenumber": T.IntegerType(),
        "l_quantity": T.DoubleType(),
        "l_discount": T.DoubleType(),
        "l_tax": T.DoubleType(),
        "l_returnflag": T.StringType(),
        "l_linestatus": T.StringType(),
        "l_shipdate": T.TimestampNTZType(),
    },
    "part": {
        "p_partkey": T.LongType(),
        "p_name": T.StringType(),
        "p_brand": T.StringType(),
        "p_type": T.StringType(),
        "p_size": T.IntegerType(),
        "p_retailprice": T.DoubleType(),
    },
    "orders": {
        "o_orderkey": T.LongType(),
        "o_custkey": T.LongType(),
        "o_orderpriority": T.StringType(),
    },
    "customer": {"c_custkey": T.LongType(), "c_mktsegment": T.StringType()},
    "events": {
        "event_id": T.LongType(),
        "ts": T.TimestampNTZType(),
        "user_id": T.LongType(),
        "event_type": T.StringType(),
        "value": T.DoubleType(),
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, t) for c, t in _COLUMNS[name].items()])
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, condition: str = "true") -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(condition)
    return lines.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))


_AFTER_SHIP = "timestampadd(SECOND, cast({} AS int), cast(l_shipdate AS timestamp))"


def _common(prefix: str) -> list[str]:
    second = "l_orderkey % 86400"
    return [
        f"concat('{prefix}', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS event_id",
        f"{_AFTER_SHIP.format(second)} AS ts",
        "concat(upper(substr(p_type, 1, 2)), '-', lpad(substr(p_brand, 7), 4, '0')) AS sku",
        "CASE WHEN l_linenumber % 2 = 1 THEN concat(' ', lower(p_type), ' ') ELSE p_type END AS category",
        f"{_AFTER_SHIP.format(f'{second} + (l_partkey % 240) * 60')} AS ingested_at",
        "concat(lpad(cast(l_partkey AS string), 10, '0'), lpad(cast(l_suppkey AS string), 10, '0')) "
        "AS arrival_key",
    ]


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = (
        _lines(spark, sf_dir, "l_returnflag = 'N'")
        .join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    )
    return base.selectExpr(
        *_common("S"),
        "'sale' AS event_type",
        "concat(c_mktsegment, ' ') AS channel",
        "cast(l_quantity AS int) AS quantity",
        "cast(p_retailprice AS decimal(12,2)) AS unit_price",
        "CASE WHEN l_discount = 0 AND l_linenumber = 1 THEN NULL "
        "ELSE cast(l_discount * 100 AS decimal(5,2)) END AS discount_pct",
        "cast(p_size AS string) AS size",
        "substring_index(p_name, ' ', 1) AS color",
        "cast(l_orderkey AS string) AS transaction_id",
    )


def movements_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _lines(spark, sf_dir, "l_returnflag IN ('A', 'R')").join(
        table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")
    )
    return base.selectExpr(
        *_common("M"),
        "CASE WHEN l_returnflag = 'A' THEN ' Adjustment' WHEN l_linestatus = 'F' THEN 'TRANSFER' "
        "ELSE 'writeoff' END AS event_type",
        "CASE l_suppkey % 3 WHEN 0 THEN 'wh-north' WHEN 1 THEN 'WH-SOUTH ' ELSE 'WH-WEST' END AS warehouse",
        "cast(CASE WHEN l_returnflag = 'A' THEN l_quantity * 2 - 10 "
        "WHEN l_linestatus = 'F' THEN l_quantity - 25 ELSE -(l_quantity % 20) END AS int) AS delta",
        "lower(o_orderpriority) AS reason",
        "cast(l_orderkey AS string) AS reference_id",
    )


def deliveries_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).selectExpr(
        *_common("D"),
        "'delivery' AS event_type",
        "concat('SUP-', cast(l_suppkey AS string)) AS supplier_id",
        "concat('PO-', cast(l_orderkey AS string)) AS po_number",
        "cast(l_quantity AS int) AS quantity",
        "cast(round(cast(p_retailprice AS decimal(12,2)) * 0.4, 2) AS decimal(12,2)) AS unit_cost",
        "cast(l_shipdate AS date) AS expected_date",
        "CASE WHEN l_tax = 0 THEN NULL ELSE date_add(cast(l_shipdate AS date), l_linenumber - 4) END "
        "AS actual_date",
    )


Feed = Callable[[SparkSession, str], DataFrame]


def raw(feed: Feed, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table of a feed: first arrival of each event id."""
    return first_wins(feed(spark, sf_dir), "event_id", ARRIVAL).drop("arrival_key")


def envelope_events(spark: SparkSession, sf_dir: str, one_category: bool = False) -> DataFrame:
    """Topic, arrival, time and payload fields of the stream derived from ``events``.

    Every tenth event repeats the id of the event five before it; errors go to a topic
    nothing handles. SKUs have several categories, or one each with ``one_category``.
    """
    kind = "user_id % 50 % 4" if one_category else "user_id % 4"
    return table(spark, sf_dir, "events").selectExpr(
        f"CASE event_type WHEN 'purchase' THEN '{SALES_TOPIC}' WHEN 'click' THEN '{SUPPLIER_TOPIC}' "
        f"WHEN 'view' THEN '{STOCK_TOPIC}' WHEN 'signup' THEN '{STOCK_TOPIC}' "
        "ELSE 'fashion.pos.returns' END AS topic",
        "event_id AS arrival",
        "cast(ts AS timestamp) AS ts",
        "concat('E', cast(event_id - CASE WHEN event_id % 10 = 9 THEN 5 ELSE 0 END AS string)) AS msg_id",
        "concat('SK-', lpad(cast(user_id % 50 AS string), 4, '0')) AS sku",
        f"CASE {kind} WHEN 0 THEN 'Dresses' WHEN 1 THEN 'Swimwear' WHEN 2 THEN 'Denim' "
        "ELSE 'Other' END AS category",
        "cast(floor(value) AS int) - 45 AS delta",
    )


def envelope(spark: SparkSession, sf_dir: str, one_category: bool = False) -> DataFrame:
    """``envelope_events`` as keyed JSON messages (topic, key, value, timestamp, arrival)."""
    head = """msg_id AS event_id, '{}' AS event_type,
        date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") AS timestamp, sku, category"""
    movement = f"""struct({head.format('adjustment')}, 'WH-WEST' AS warehouse, delta,
        'cycle_count' AS reason, msg_id AS reference_id)"""
    sale = f"""struct({head.format('sale')}, 'ecommerce' AS channel, 1 AS quantity,
        10.5D AS unit_price, 5 AS discount_pct, 'M' AS size, 'Navy' AS color,
        msg_id AS transaction_id)"""
    delivery = f"""struct({head.format('delivery')}, 'SUP-1' AS supplier_id, msg_id AS po_number,
        delta AS quantity, 7.25D AS unit_cost, date_format(ts, 'yyyy-MM-dd') AS expected_date,
        date_format(ts, 'yyyy-MM-dd') AS actual_date)"""
    # Messages cost far more to write and parse than rows to send: few row groups are dealt to all cores.
    dealt = envelope_events(spark, sf_dir, one_category).repartition("arrival", "ts", "sku", "delta")
    return dealt.selectExpr(
        "topic",
        "cast(sku AS binary) AS key",
        f"cast(CASE topic WHEN '{STOCK_TOPIC}' THEN to_json({movement}) WHEN '{SUPPLIER_TOPIC}' "
        f"THEN to_json({delivery}) ELSE to_json({sale}) END AS binary) AS value",
        "ts AS timestamp",
        "arrival",
    )
