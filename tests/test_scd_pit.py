import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators import skew
from tideline.operators.pit import choose_strategy, coverage_gap, pit_join, pit_join_closed
from tideline.operators.scd import as_of, current, scd1, scd2_apply, scd2_first, scd2_open, scd2_rebuild, snowflake_as_of, version_floor
from tideline.operators.skew import HOT_ROWS_SETTING, hot_tokens, slice_bounds, slice_of
from tideline.sources.dimension import DimensionTable

T = datetime(2024, 1, 1)
CHANGES = "k bigint, v string, at timestamp_ntz"
OPEN = datetime(9999, 12, 31)


@pytest.fixture
def hot(spark):
    """Sets the number of rows above which a key counts as hot."""
    yield lambda n: spark.conf.set(HOT_ROWS_SETTING, str(n))
    spark.conf.unset(HOT_ROWS_SETTING)


def day(n):
    return T + timedelta(days=n)


def changes(spark, *rows):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in rows], CHANGES)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def spans(df):
    return rows(df, "k", "v", "valid_from", "valid_to")


def random_changes(spark, seed, n=400, skewed=True):
    rng = random.Random(seed)
    keys = [1] * 4 + list(range(2, 12)) if skewed else list(range(20))
    return spark.createDataFrame(
        [(rng.choice(keys), f"v{rng.randrange(50)}", T + timedelta(hours=rng.randrange(600))) for _ in range(n)], CHANGES
    )


def test_rebuild_closes_each_version_by_the_next(spark):
    dim = scd2_rebuild(changes(spark, (1, "a", 0), (1, "b", 5), (2, "x", 3), (1, "B", 5)), "k", "at")
    assert spans(dim) == [(1, "a", day(0), day(5)), (1, "b", day(5), OPEN), (2, "x", day(3), OPEN)]
    assert dim.select("scd_id").distinct().count() == 3


def test_apply_rules(spark):
    dim = scd2_first(changes(spark, (1, "a", 1), (2, "b", 1), (3, "c", 1)), "k", "at")
    batch = changes(spark, (1, "a2", 4), (2, "older", 0), (4, "new", 2))
    once = scd2_apply(dim, batch, "k", "at")
    assert spans(once) == [
        (1, "a", day(1), day(4)),
        (1, "a2", day(4), OPEN),
        (2, "b", day(1), OPEN),
        (3, "c", day(1), OPEN),
        (4, "new", day(2), OPEN),
    ]
    assert spans(scd2_apply(once, batch, "k", "at")) == spans(once)


@pytest.mark.parametrize("seed", range(3))
def test_fold_of_snapshots_equals_rebuild(spark, tmp_path, seed):
    log = random_changes(spark, seed, skewed=False)
    dim = DimensionTable(spark, str(tmp_path / "dim"), "k", 4)
    latest = None
    for cut in (200, 400, 600):
        seen = log.filter(F.col("at") < F.lit(T + timedelta(hours=cut)).cast("timestamp_ntz"))
        dim.snapshot(seen, "at")
        winners = seen.groupBy("k").agg(F.max_by(F.struct("v", "at"), F.struct("at", "v")).alias("w")).select("k", "w.*")
        latest = winners if latest is None else latest.unionByName(winners).distinct()
    assert spans(dim.read()) == spans(scd2_rebuild(latest, "k", "at"))
    assert spans(dim.read_open()) == spans(current(dim.read()))
    assert current(dim.read()).groupBy("k").count().filter("count > 1").isEmpty()


def test_snapshot_of_an_unchanged_source_writes_nothing(spark, tmp_path):
    dim = DimensionTable(spark, str(tmp_path / "dim"), "k", 4)
    batch = changes(spark, (1, "a", 0), (2, "b", 0))
    dim.snapshot(batch, "at")
    version = dim.state()["version"]
    dim.snapshot(batch, "at")
    assert dim.state()["version"] == version


def test_snapshot_rewrites_open_versions_and_appends_history(spark, tmp_path):
    dim = DimensionTable(spark, str(tmp_path / "dim"), "k", 1)
    for i in range(4):
        dim.snapshot(changes(spark, (1, f"v{i}", i), (2, "x", 0)), "at")
    units = dim.state()["units"]
    assert len(units["open-0"]) == 1 and len(units["closed-0"]) == 3
    assert dim.read().count() == 5 and rows(dim.read_open(), "k", "v") == [(1, "v3"), (2, "x")]


@pytest.mark.parametrize("seed", range(3))
def test_sliced_rebuild_equals_plain(spark, hot, seed):
    log = random_changes(spark, seed)
    plain = rows(scd2_rebuild(log, "k", "at"))
    hot(50)
    assert hot_tokens(log, "k")
    assert rows(scd2_rebuild(log, "k", "at")) == plain


def test_sliced_rebuild_with_copies_of_one_instant(spark, hot):
    log = spark.createDataFrame([(1, f"v{i % 7}", T if i % 2 else day(i % 5)) for i in range(300)], CHANGES)
    plain = rows(scd2_rebuild(log, "k", "at"))
    hot(10)
    assert rows(scd2_rebuild(log, "k", "at")) == plain


def test_hot_tokens_are_exact_and_ignore_ordinary_keys(spark, hot):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, -1, id) AS k").repartition(8)
    assert hot_tokens(df, "k") == {}
    hot(100)
    assert list(hot_tokens(df, "k").values()) == [10_000]
    assert hot_tokens(df.limit(0), "k") == {}


def test_hot_tokens_shuffle_cells_where_no_key_is_hot(spark, hot, monkeypatch):
    """Cells above the limit in which no key is, and fewer cells than keys: what comes back does not depend on them."""
    df = spark.range(40_000).selectExpr("IF(id % 4 = 0, -1, id % 5000) AS k").repartition(4)
    counts = []
    for cells, named in ((1, 256), (7, 256), (1 << 14, 256), (1 << 14, 0)):
        monkeypatch.setattr(skew, "CELLS", cells)
        monkeypatch.setattr(skew, "NAMED_CELLS", named)
        for limit in (8, 9_000, 20_000):
            hot(limit)
            counts.append((limit, sorted(hot_tokens(df, "k").values())))
    expected = {limit: sorted(n for n in df.groupBy("k").count().toPandas()["count"] if n > limit) for limit in (8, 9_000, 20_000)}
    assert all(found == expected[limit] for limit, found in counts) and expected[9_000] == [10_000] and not expected[20_000]


def test_slices_split_a_hot_key_evenly(spark, hot):
    hot(1000)
    df = spark.range(10_000).selectExpr("1 AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, id) AS at")
    (total,) = hot_tokens(df, "k").values()
    bounds = slice_bounds(df, "at", total, 500)
    sizes = [r["count"] for r in df.groupBy(slice_of(F.col("at"), bounds).alias("s")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 600


def test_as_of_and_floor(spark):
    dim = scd2_rebuild(changes(spark, (1, "a", 0), (1, "b", 5)), "k", "at")
    assert rows(as_of(dim, day(5)), "v") == [("b",)]
    assert rows(as_of(dim, day(4)), "v") == [("a",)]
    assert as_of(dim, day(-1)).isEmpty()
    assert rows(version_floor(dim, "k")) == [(1, day(0))]


def test_snowflake_keeps_timelines_apart(spark):
    staff = scd2_rebuild(
        spark.createDataFrame([(1, 10, day(0)), (2, 10, day(3)), (1, 20, day(4))], "e bigint, k bigint, at timestamp_ntz"), "e", "at"
    ).withColumnRenamed("scd_id", "staff_id")
    stores = scd2_rebuild(changes(spark, (10, "s", 0), (10, "s2", 2), (20, "t", 0)), "k", "at")
    assert rows(snowflake_as_of(staff, stores, "k", day(3)), "e", "k", "v") == [(1, 10, "s2"), (2, 10, "s2")]


def test_scd1(spark):
    df = changes(spark, (1, "a", 0), (1, "b", 1))
    assert rows(scd1(df, "k", "at", ["v"], "k_key")) == [(1, 1, "b")]


def pit_data(spark):
    dim = scd2_rebuild(changes(spark, (1, "a", 2), (1, "b", 5), (2, "x", 0)), "k", "at")
    events = spark.createDataFrame(
        [(0, 1, day(1)), (1, 1, day(2)), (2, 1, day(5)), (3, 1, day(9)), (4, 2, day(3)), (5, 3, day(3)), (6, None, day(3)), (7, 1, None)],
        "e bigint, k bigint, t timestamp_ntz",
    )
    return events, dim


@pytest.mark.parametrize("strategy", ["range", "binned", "asof", "auto"])
@pytest.mark.parametrize("floor", [False, True])
def test_point_in_time_boundaries(spark, strategy, floor):
    events, dim = pit_data(spark)
    got = pit_join(events, dim, {"k": "k"}, "t", {"v": "found"}, floor, strategy)
    first = "a" if floor else None
    assert rows(got, "e", "found") == [
        (0, first), (1, "a"), (2, "b"), (3, "b"), (4, "x"), (5, None), (6, None), (7, None),
    ]


def test_closed_intervals_match_twice_at_a_change(spark):
    events, dim = pit_data(spark)
    got = pit_join_closed(events, dim, {"k": "k"}, "t", {"v": "found"})
    assert rows(got.filter("e = 2"), "found") == [("a",), ("b",)]
    between = (F.col("t") >= F.col("valid_from")) & (F.col("t") <= F.col("valid_to"))
    plain = events.join(dim.withColumnRenamed("k", "dk"), (F.col("k") == F.col("dk")) & between, "left")
    assert rows(got, "e", "found") == rows(plain, "e", "v")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("floor", [False, True])
def test_join_forms_agree(spark, hot, seed, floor):
    dim = scd2_rebuild(random_changes(spark, seed), "k", "at")
    # A gap in the validity of some versions.
    gap = F.when(F.col("v") < "v2", F.col("valid_from") + F.expr("interval 1 hour")).otherwise(F.col("valid_to"))
    dim = dim.withColumn("valid_to", F.least("valid_to", gap))
    events = random_changes(spark, seed + 100, 600).withColumnRenamed("at", "t").select("k", "t", F.monotonically_increasing_id().alias("e"))
    events.write.mode("overwrite").saveAsTable("pit_events")
    events = spark.table("pit_events")

    def found(strategy):
        got = pit_join(events, dim, {"k": "k"}, "t", {"scd_id": "id", "v": "v2"}, floor, strategy)
        return rows(got, "e", "id", "v2")

    expected = found("range")
    assert len(expected) == 600
    assert found("binned") == expected
    assert found("asof") == expected
    hot(50)
    assert found("asof") == expected


def test_auto_looks_at_versions_per_key_and_size(spark, monkeypatch):
    events, dim = pit_data(spark)
    assert choose_strategy(dim, "k", 2) == "range"
    assert choose_strategy(dim, "k", 1) == "binned"
    plan = pit_join(events, dim, {"k": "k"}, "t", {"v": "f"}, max_versions=1)._jdf.queryExecution().optimizedPlan()
    assert "rightHint=(strategy=broadcast)" in plan.toString()
    monkeypatch.setattr("tideline.operators.pit.BINNED_ROWS", 2)
    assert choose_strategy(dim, "k", 1) == "asof"
    plan = pit_join(events, dim, {"k": "k"}, "t", {"v": "f"}, strategy="binned")._jdf.queryExecution().optimizedPlan()
    assert "broadcast" not in plan.toString()
    assert choose_strategy(dim.limit(0), "k") == "range"


def test_coverage_gap_counts_per_key(spark):
    events, dim = pit_data(spark)
    row = coverage_gap(events, version_floor(dim, "k"), {"k": "k"}, "t").first()
    assert (row["n_events"], row["before_own_floor"], row["before_global_floor"]) == (8, 1, 0)


def test_open_versions_come_from_the_latest_rows(spark):
    log = changes(spark, (1, "a", 0), (1, "b", 2), (1, "c", 2), (2, "x", 1))
    late = scd2_open(log, "k", "at")
    expected = current(scd2_rebuild(log, "k", "at"))
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, expected.select(late.columns).collect()))
    assert "WindowGroupLimit" in late._jdf.queryExecution().executedPlan().toString()
