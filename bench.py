"""Time the headline queries: one JSON line with seconds per query.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs
after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stockflow.plans import catalog  # noqa: E402
from stockflow.sources import feeds  # noqa: E402
from stockflow.streaming.ingest import start_ingest  # noqa: E402

HEADLINE = [
    "stg_sales",
    "stg_stock_movements",
    "fct_inventory_snapshot",
    "fct_sales_velocity",
    "mv_category_daily_summary",
    "mv_sku_reorder_watchlist",
    "mv_channel_revenue_weekly",
    "mv_supplier_performance",
    "vw_daily_kpis",
    "reorder_alerts",
    "dispatch_payload",
]
STREAM_FILES = 4


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stockflow-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column without keeping or sending them anywhere."""
    df.write.format("noop").mode("overwrite").save()


def stream_once(spark: SparkSession, source: str, schema) -> None:
    work = tempfile.mkdtemp(prefix="stockflow-bench-")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = start_ingest(stream, f"{work}/tables", f"{work}/checkpoint", arrival=["arrival"])
    query.awaitTermination()


def timed(action, runs: int) -> float:
    action()
    seconds = []
    for _ in range(runs):
        began = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - began)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    queries = catalog.registered()
    times = {n: timed(lambda n=n: drain(queries[n](spark, sf_dir)), runs) for n in HEADLINE}

    source = tempfile.mkdtemp(prefix="stockflow-bench-source-")
    messages = feeds.envelope(spark, sf_dir)
    messages.repartitionByRange(STREAM_FILES, "arrival").write.mode("overwrite").parquet(source)
    events = messages.count()
    times["stream_ingest"] = timed(lambda: stream_once(spark, source, messages.schema), 1)
    print(
        json.dumps(
            {
                "metric": "headline query seconds (warm median)",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "stream_events_per_sec": round(events / times["stream_ingest"]),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
