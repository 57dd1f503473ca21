import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators.scd import scd2_apply, scd2_rebuild, snowflake_as_of
from tideline.operators.skew import HOT_ROWS_SETTING
from tideline.operators.timeline import late_versions, scd2_late, snowflake_timeline

T0 = datetime(2025, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def frame(spark, rows, schema="k int, v string, at timestamp_ntz"):
    return spark.createDataFrame(rows, schema)


def counted(df):
    # The open end lies outside the range of Python's local times.
    return Counter(map(tuple, df.withColumn("valid_to", F.col("valid_to").cast("string")).collect()))


@pytest.fixture(params=[None, "4"])
def hot(request, spark):
    """The plain forms, and the sliced ones with hot keys from five rows on."""
    if request.param:
        spark.conf.set(HOT_ROWS_SETTING, request.param)
    yield
    spark.conf.unset(HOT_ROWS_SETTING)


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.schema(df.schema).parquet(str(path))


def test_late_changes_in_any_order_equal_the_rebuild(spark, hot, tmp_path):
    chance = random.Random(7)
    rows = [(chance.choice([None, 1, 2, 3, 3, 3]), f"v{chance.randrange(3)}", day(chance.randrange(15))) for _ in range(40)]
    rows += [(1, None, day(3)), (2, "x", None)]
    chance.shuffle(rows)
    expected = counted(scd2_rebuild(frame(spark, rows), "k", "at"))
    dim = stored(scd2_rebuild(frame(spark, rows[:14]), "k", "at"), tmp_path / "first")
    for i, part in enumerate((rows[14:30], rows[30:], rows[14:30])):
        dim = stored(scd2_late(dim, frame(spark, part), "k", "at"), tmp_path / str(i))
    assert counted(dim) == expected


def test_only_versions_that_change_are_returned(spark):
    dim = scd2_rebuild(frame(spark, [(1, "a", day(0)), (1, "b", day(10)), (1, "c", day(20)), (2, "a", day(0))]), "k", "at")
    fresh = late_versions(dim, frame(spark, [(1, "x", day(5)), (1, "c", day(20)), (3, "n", day(1))]), "k", "at")
    found = sorted((r["k"], r["v"], r["f"], r["t"]) for r in fresh.selectExpr("k", "v", "date(valid_from) f", "string(date(valid_to)) t").collect())
    assert found == [
        (1, "a", day(0).date(), "2025-01-06"), (1, "x", day(5).date(), "2025-01-11"), (3, "n", day(1).date(), "9999-12-31"),
    ]
    assert late_versions(dim, frame(spark, []), "k", "at").isEmpty()
    # The snapshot rule passes over the same change.
    assert counted(scd2_apply(dim, frame(spark, [(1, "x", day(5))]), "k", "at")) == counted(dim)


def test_timeline_holds_every_instant(spark, hot, tmp_path):
    chance = random.Random(3)
    staff = [(e, chance.choice([None, 1, 1, 1, 2, 9]), f"n{i}", day(chance.randrange(30))) for i, e in enumerate([1, 2, 3, 4] * 6)]
    stores = [(chance.choice([1, 1, 2]), f"s{i}", day(5 + chance.randrange(25))) for i in range(14)]
    dim = scd2_rebuild(frame(spark, staff, "e int, k int, name string, at timestamp_ntz"), "e", "at").withColumnRenamed("scd_id", "staff_id")
    outer = scd2_rebuild(frame(spark, stores), "k", "at").withColumnRenamed("scd_id", "store_id")
    dim, outer = stored(dim, tmp_path / "dim"), stored(outer, tmp_path / "outer")
    plan = snowflake_timeline(dim, outer, "k", "e")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    pieces = stored(snowflake_timeline(dim, outer, "k", "e"), tmp_path / "pieces")
    assert pieces.filter("valid_from >= valid_to").isEmpty()
    for d in (-1, 4, 11, 23, 60):
        at = F.lit(str(day(d))).cast("timestamp_ntz")
        there = pieces.filter((F.col("valid_from") <= at) & (F.col("valid_to") > at)).select("e", "k", "name", "staff_id", "v", "store_id")
        expected = snowflake_as_of(dim, outer, "k", day(d)).select(*there.columns)
        assert Counter(map(tuple, there.collect())) == Counter(map(tuple, expected.collect()))


def test_timeline_of_empty_sides(spark, tmp_path):
    empty = scd2_rebuild(frame(spark, []), "k", "at")
    one = scd2_rebuild(frame(spark, [(1, "a", day(0)), (1, "b", day(4))]), "k", "at")
    one, empty = stored(one, tmp_path / "one"), stored(empty, tmp_path / "empty")
    outer = lambda df: df.select("k", F.col("v").alias("w"), F.col("scd_id").alias("other_id"), "valid_from", "valid_to")
    assert snowflake_timeline(empty, outer(one), "k", "k").isEmpty()
    assert snowflake_timeline(one, outer(empty), "k", "k").filter("w IS NULL").count() == 2
