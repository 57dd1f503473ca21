"""Cases in which rows were once lost, doubled or shifted."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.functions import version_id
from tideline.operators.incremental import high_water, newer_than
from tideline.operators.scd import as_of, scd2_rebuild
from tideline.operators.skew import HOT_ROWS_SETTING, hot_tokens
from tideline.operators.upsert import upsert
from tideline.sources.store import StoredTable

T = [datetime(2024, 1, 1, h) for h in (0, 3, 6)]


@pytest.fixture(params=["UTC", "America/Toronto", "Asia/Tokyo"])
def zone(request, monkeypatch):
    monkeypatch.setenv("TZ", request.param)
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_cursor_does_not_depend_on_the_zone_of_the_driver(spark, zone, kind):
    assert os.environ["TZ"]
    rows = spark.createDataFrame([(i, t.isoformat(sep=" ")) for i, t in enumerate(T)], "id int, at string")
    rows = rows.withColumn("at", F.col("at").cast(kind))
    since = high_water(rows.filter("id = 0"), "at")
    assert sorted(r[0] for r in newer_than(rows, "at", since).select("id").collect()) == [1, 2]
    assert newer_than(rows, "at", since, timedelta(hours=1)).count() == 3


def test_as_of_does_not_depend_on_the_zone_of_the_driver(spark, zone):
    rows = spark.sql("select 1 id, timestamp_ntz'2024-01-01 00:00:00' valid_from, timestamp_ntz'2024-01-01 03:00:00' valid_to")
    assert [as_of(rows, t).count() for t in T] == [1, 0, 0]


@pytest.mark.parametrize("limit", ["10", "1000000"])
def test_null_change_times_begin_no_version_at_any_hot_limit(spark, limit):
    log = [(k, T[0] + timedelta(hours=h)) for k in (1, 2) for h in range(50)] + [(1, None), (3, None)]
    spark.conf.set(HOT_ROWS_SETTING, limit)
    try:
        out = scd2_rebuild(spark.createDataFrame(log, "k int, at timestamp_ntz"), "k", "at").collect()
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert len(out) == 100 and all(r["valid_from"] is not None for r in out)


def test_all_hot_keys_are_found(spark):
    spark.conf.set(HOT_ROWS_SETTING, "2")
    try:
        assert len(hot_tokens(spark.range(9_000).select((F.col("id") % 3_000).alias("k")), "k")) == 3_000
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)


def test_composite_version_ids_stay_apart(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None)], "x string, y string").withColumn("at", F.lit(1))
    assert rows.select(version_id(["x", "y"], "at")).distinct().count() == 4


def test_repeated_batch_keys_give_one_row(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    table = StoredTable(spark, str(tmp_path / "t"), "k")
    table.upsert(batch)
    assert [tuple(r) for r in table.read().collect()] == [(1, "b")]
    assert upsert(batch.limit(0), batch, "k").count() == 1


def test_other_layout_columns_or_null_keys_raise(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(k, "a") for k in range(20)], "k int, v string")
    StoredTable(spark, root, "k", 16).upsert(rows)
    with pytest.raises(ValueError):
        StoredTable(spark, root, "k", 32).upsert(rows)
    with pytest.raises(ValueError):
        StoredTable(spark, root, "k", 16).insert_if_absent(rows.select("k"))
    with pytest.raises(Exception, match="null key"):
        StoredTable(spark, root, "k", 16).insert_if_absent(spark.createDataFrame([(None, "a")], "k int, v string"))
    StoredTable(spark, root, "k", 16).upsert(rows.select("v", "k"))
    assert StoredTable(spark, root, "k", 16).read().count() == 20
