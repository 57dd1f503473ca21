import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators.changes import changed_intervals, in_intervals
from tideline.operators.observed import Watch, written_counts
from tideline.operators.pit import pit_join
from tideline.operators.scd import scd2_rebuild
from tideline.plans.facts import ChangedLink, VersionLink, orders_fact, orders_fact_increment
from tideline.functions.calendar import calendar
from tideline.plans.queries import QUERIES
from tideline.sources.dimension import DimensionTable
from tideline.sources.store import StoredTable

T0 = datetime(2025, 1, 1)


def day(n):
    return T0 + timedelta(days=n)


def jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_watched_writes_count_without_further_jobs(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5, None), (2, None, "a"), (3, 70, "b"), (4, 80, None)], "id int, n int, s string")
    table, watch = StoredTable(spark, str(tmp_path / "t"), "id", 4), Watch(["id", "s"], ["n < 60", "n > 0"])
    with pytest.raises(RuntimeError):
        watch.broken()
    table.overwrite(rows, watch)
    found, started = jobs(spark, "watched", lambda: (watch.rows, watch.broken()))
    assert found == (4, {"s is not null": 2, "n < 60": 2}) and started == 0
    assert sorted(map(tuple, watch.violations(spark).collect())) == [("n < 60", 2), ("s is not null", 2)]
    # The counts end up in the plan that writes, not in a plan of their own.
    unwatched = StoredTable(spark, str(tmp_path / "u"), "id", 4)
    _, plain = jobs(spark, "plain", lambda: unwatched.overwrite(rows))
    _, counted = jobs(spark, "counted", lambda: StoredTable(spark, str(tmp_path / "v"), "id", 4).overwrite(rows, watch))
    assert plain == counted
    assert written_counts({"t": watch}) == {"t": 4}


def test_a_watch_holds_the_counts_of_its_last_write(spark, tmp_path):
    watch = Watch(["id"], [])
    spark.createDataFrame([(None,), (1,)], "id int").transform(watch).write.parquet(str(tmp_path / "a"))
    assert watch.broken() == {"id is not null": 1}
    spark.createDataFrame([], "id int").transform(watch).write.parquet(str(tmp_path / "b"))
    assert watch.broken() == {} and watch.rows == 0


def versions(spark, changes):
    return scd2_rebuild(spark.createDataFrame([(k, f"v{v}", day(d)) for k, d, v in changes], "k int, v string, at timestamp_ntz"), "k", "at")


@pytest.mark.parametrize("floor", [False, True])
def test_results_change_only_inside_the_intervals(spark, floor):
    chance = random.Random(floor)
    for _ in range(4):
        old = [(chance.randrange(4), chance.randrange(0, 40, 3), chance.randrange(3)) for _ in range(chance.randrange(1, 12))]
        new = old[chance.randrange(2) :] + [(chance.randrange(5), chance.randrange(0, 40, 2), chance.randrange(3)) for _ in range(chance.randrange(4))]
        before, after = versions(spark, old), versions(spark, new or old)
        events = spark.createDataFrame([(k, day(d)) for k in range(6) for d in range(-2, 44)] + [(None, day(1)), (1, None)], "key int, t timestamp_ntz")
        on, columns = {"key": "k"}, {"scd_id": "id", "v": "v"}
        states = [pit_join(events, v, on, "t", columns, floor, "range").collect() for v in (before, after)]
        one, two = ({(r["key"], r["t"]): (r["id"], r["v"]) for r in rows} for rows in states)
        ranges = changed_intervals(before, after, "k", ["scd_id", "v"], floor)
        touched = {tuple(r) for r in in_intervals(events, "t", on, ranges).collect()}
        assert touched == {event for event in one if one[event] != two[event]}


def test_closing_a_version_touches_its_new_end_only(spark):
    before, after = versions(spark, [(1, 0, 1), (2, 0, 1)]), versions(spark, [(1, 0, 1), (1, 10, 2), (2, 0, 1)])
    ranges = {(r["k"], r["_low"], r["_high"].year) for r in changed_intervals(before, after, "k", floor=True).collect()}
    assert ranges == {(1, day(10), 9999)}
    assert changed_intervals(after, after, "k", floor=True).count() == 0


def test_a_small_batch_rewrites_few_units_of_a_fact(spark, tmp_path):
    """Forty months of orders; a late version of one product reaches two lines in two months."""
    headers = spark.createDataFrame([(i, i % 3, day(15 + 30 * i)) for i in range(40)], "order_id int, customer_id int, at timestamp_ntz")
    lines = spark.createDataFrame([(10 * i + j, i, (i + j) % 4) for i in range(40) for j in range(2)], "line_id int, order_id int, product_id int")
    dates = calendar(spark, [(headers, "at")])
    customers = versions(spark, [(c, 0, 1) for c in range(3)])
    old = [(p, 0, 1) for p in range(4)] + [(2, 400, 2)]
    late = [*old, (2, 250, 3)]
    columns = ["line_id", "order_id", "customer_scd_id", "product_scd_id", "order_date_id"]

    def links(products):
        return [VersionLink("customer_scd_id", customers, {"customer_id": "k"})], [VersionLink("product_scd_id", products, {"product_id": "k"})]

    def whole(products):
        return orders_fact(headers, lines, "order_id", "at", *links(products), dates, columns)

    fact = StoredTable(spark, str(tmp_path / "fact"), "line_id", 2, (F.col("order_date_id") / 100).cast("int"), "order_date_id")
    fact.overwrite(whole(versions(spark, old)))
    units = fact.state()["units"]
    changed = [[ChangedLink(link, before.versions) for link, before in zip(*pair)] for pair in zip(links(versions(spark, late)), links(versions(spark, old)))]
    none = lines.limit(0)
    rows = orders_fact_increment(headers, lines, "order_id", "line_id", "at", *changed, dates, columns, none, none)
    touched = {r["line_id"] for r in rows.collect()}
    assert len(touched) == 2 and touched == {10 * i + j for i in range(40) for j in range(2) if (i + j) % 4 == 2 and 250 <= 15 + 30 * i < 400}
    fact.upsert(rows)
    assert sorted(fact.read().select(*columns).collect()) == sorted(whole(versions(spark, late)).collect())
    rewritten = [u for u, runs in fact.state()["units"].items() if runs != units.get(u)]
    assert 0 < len(rewritten) <= 2 < len(units)
    # New lines and orders are recomputed whole, whatever the dimensions say.
    added = orders_fact_increment(
        headers, lines, "order_id", "line_id", "at", *changed, dates, columns, headers.filter("order_id = 5"), lines.filter("line_id = 90")
    )
    assert {r["line_id"] for r in added.collect()} == touched | {50, 51, 90}


def test_dimension_batches_are_checked(spark, tmp_path):
    rows = "k int, name string, at timestamp_ntz"
    dim = DimensionTable(spark, str(tmp_path / "dim"), "k", 2)
    with pytest.raises(Exception, match="null key"):
        dim.snapshot(spark.createDataFrame([(None, "x", day(1)), (1, "y", day(1))], rows), "at")
    for _ in range(3):
        dim.snapshot(spark.createDataFrame([(1, "y", day(1))], rows), "at")
    assert dim.read().count() == 1
    with pytest.raises(Exception, match="null key"):
        dim.snapshot(spark.createDataFrame([(None, "x", day(2)), (1, "z", day(2))], rows), "at")
    with pytest.raises(ValueError, match="attributes"):
        dim.snapshot(spark.createDataFrame([(1, day(3))], "k int, at timestamp_ntz"), "at")
    assert dim.read().count() == 1


def small_tables(spark, folder):
    """Orders around the cut of the loads, with lines that were shipped before and after it."""
    at = [datetime(1999, 6, 1), datetime(1999, 12, 20), datetime(2000, 2, 1), datetime(2000, 9, 1)]
    orders = [(k, k % 3, "O", 10.0 * k, at[k % 4], "1-URGENT") for k in range(24)]
    lines = [
        (k, (k + n) % 5, n % 2, n, 2.0 * n, 7.5 * n, 0.0, 0.1, "RN"[(k + n) % 2], "OF"[n % 2], at[k % 4] + timedelta(days=9 * n))
        for k in range(24)
        for n in (1, 1, 2, 3)
    ]
    kinds = "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    tables = {
        "customer": ([(k, f"c{k}", k, 1.0, "BUILDING") for k in range(2)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, f"l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, {kinds}, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_the_incremental_fact_merges_starts_of_versions_in_place_of_ids(spark, tmp_path, monkeypatch):
    """No text is moved or stored by the merges, and the reader's ids are those of the whole fact."""
    batches, folder = [], small_tables(spark, tmp_path)
    for name in ("overwrite", "upsert"):
        write = getattr(StoredTable, name)
        monkeypatch.setattr(StoredTable, name, lambda self, df, *rest, write=write, **more: batches.append(df.dtypes) or write(self, df, *rest, **more))
    found, whole = (QUERIES[name](spark, folder) for name in ("fact_orders_incremental", "fact_orders"))
    assert len(batches) == 3 and all(kind != "string" for batch in batches for _, kind in batch)
    assert found.dtypes == whole.dtypes and found.count() == whole.count() == 72
    assert found.exceptAll(whole).count() == 0
