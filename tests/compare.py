"""Compare every registered query with its DuckDB statement: python tests/compare.py [sf] [names...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


_SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "double": "DOUBLE",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a DuckDB result; empty when nothing does."""
    found = []
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
    types = {name: kind for name, kind, *_ in con.execute("DESCRIBE want").fetchall()}
    for name, dtype in df.dtypes:
        want = _SAME_TYPE.get(dtype, dtype.upper())
        if want != types.get(name):
            found.append(f"type of {name}: spark {want}, duckdb {types.get(name)}")
    if sorted(df.columns) != sorted(types):
        return [*found, f"columns: spark {sorted(df.columns)}, duckdb {sorted(types)}"]
    con.register("arrow_got", df.toArrow())
    instants = [name for name, dtype in df.dtypes if dtype == "timestamp"]
    cells = [f"{c} AT TIME ZONE 'UTC' AS {c}" if c in instants else c for c in df.columns]
    con.execute(f"CREATE OR REPLACE TEMP TABLE got AS SELECT {', '.join(cells)} FROM arrow_got")
    con.unregister("arrow_got")
    names = ", ".join(df.columns)
    for here, there in (("got", "want"), ("want", "got")):
        only = f"SELECT {names} FROM {here} EXCEPT ALL SELECT {names} FROM {there}"
        rows = con.execute(f"SELECT count(*) FROM ({only})").fetchone()[0]
        if rows:
            found.append(f"{rows} rows only in {here}: {con.execute(only + ' LIMIT 2').fetchall()}")
    return found


def main() -> None:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without statement:", sorted(set(queries) - set(oracle)))
    failed = 0
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = differences(df, con, oracle[name])
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s", flush=True)
        for line in found:
            print("     ", line[:1500])
    print("failed:", failed)


if __name__ == "__main__":
    main()
