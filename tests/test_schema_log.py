from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stockflow.operators import staging, upsert
from stockflow.plans import staging_tables
from stockflow.sources import tables
from tests.rows import at, listed, raw_sales

NAME = "stg_sales"


def older(raw):
    """An earlier build: a column less, one more, two narrower."""
    narrow = {"quantity": F.expr("cast(quantity AS smallint)"), "unit_price": F.expr("cast(unit_price AS decimal(8,2))")}
    return staging.stg_sales(raw).withColumns({**narrow, "retired": F.lit(1)}).drop("color")


def changed_type(raw):
    return staging.stg_sales(raw).withColumn("quantity", F.expr("cast(quantity AS string)"))


def files(root):
    """Data files with their times."""
    found = {}
    for folder, _, names in os.walk(f"{root}/{NAME}"):
        found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def step(root, newer, build=staging.stg_sales):
    return staging_tables.refresh_days(newer, build, root, NAME, days_fixed=True, newer=newer)


@pytest.fixture
def old(spark):
    return raw_sales(spark, *[{"event_id": f"e{i}", "ts": at(i), "quantity": i + 1} for i in range(4)])


@pytest.fixture
def new(spark):
    return raw_sales(spark, {"event_id": "e1", "ts": at(1), "quantity": 70_000}, {"event_id": "n", "ts": at(1)}, {"event_id": "m", "ts": at(9)})


def same(got, want):
    assert sorted(got.dtypes) == sorted(want.dtypes)
    names = want.columns
    assert listed(got, *names) == listed(want, *names)


def test_widening_leaves_the_files_of_other_days(spark, tmp_path, old, new):
    root = str(tmp_path)
    staging_tables.refresh(old, older, root, NAME)
    before = files(root)
    found = step(root, new)
    want = upsert.upsert(older(old), staging.stg_sales(new))
    same(found.table, want)
    same(tables.read_current(spark, root, NAME), want)
    after = files(root)
    touched = {p for p in before if "event_date=2024-03-05" in p}
    assert len(touched) == 1 and {p: t for p, t in before.items() if p not in touched}.items() <= after.items()
    assert not touched & set(after) and tables.current_path(spark, root, NAME).endswith("version=0")
    assert found.days is None
    # From here on nothing changes but the days of new rows.
    again = step(root, new.filter("event_id = 'm'"))
    assert len(again.days) == 1
    same(again.table, want)


def test_no_new_rows_change_the_schema_alone(spark, tmp_path, old):
    root = str(tmp_path)
    staging_tables.refresh(old, older, root, NAME)
    before = files(root)
    found = step(root, old.filter("false"))
    same(found.table, upsert.upsert(older(old), staging.stg_sales(old.filter("false"))))
    assert files(root) == before


def test_another_type_rebuilds(spark, tmp_path, old, new):
    root = str(tmp_path)
    staging_tables.refresh(old, staging.stg_sales, root, NAME)
    found = step(root, new, changed_type)
    same(found.table, upsert.upsert(staging.stg_sales(old), changed_type(new)))
    assert tables.current_path(spark, root, NAME).endswith("version=1")


def test_a_narrower_type_rebuilds(spark, tmp_path, old):
    root = str(tmp_path)
    staging_tables.refresh(old, staging.stg_sales, root, NAME)
    step(root, old.filter("event_id = 'e1'"), older)
    assert tables.current_path(spark, root, NAME).endswith("version=1")


def test_a_dropped_name_does_not_bring_back_its_values(spark, tmp_path, old, new):
    root = str(tmp_path)
    staging_tables.refresh(old, staging.stg_sales, root, NAME)
    step(root, old.filter("false"), lambda raw: staging.stg_sales(raw).drop("color"))
    found = step(root, new.filter("event_id = 'm'"))
    got = dict(listed(found.table, "event_id", "color"))
    assert got.pop("m") is not None
    assert set(got) == {"e0", "e1", "e2", "e3"} and set(got.values()) == {None}


def test_interrupted_before_and_after_the_schema_is_noted(spark, tmp_path, old, new):
    want = upsert.upsert(older(old), staging.stg_sales(new))
    for noted in (False, True):
        root = str(tmp_path / str(noted))
        staging_tables.refresh(old, older, root, NAME)
        path, rows = tables.current_path(spark, root, NAME), staging.stg_sales(new)
        target = spark.read.schema(rows.schema).parquet(path).select(rows.columns)
        staging_tables._prepare(target, rows, root, NAME, True)
        if noted:
            tables.log_schema(spark, path, rows.schema)
        same(step(root, new).table, want)
