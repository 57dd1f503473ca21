from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideline.functions import day_key, full_name
from tideline.functions.calendar import calendar, day_attributes, day_range
from tideline.operators import quality as q
from tideline.operators import wide as wide_module
from tideline.operators.wide import Entry, FanOutError, WideConfigError, build_wide, check_entries, join_keys
from tideline.operators.skew import HOT_ROWS_SETTING
from tideline.plans.facts import deliveries_fact
from tideline.sources.catalog import Catalog, table_counts

A = Entry("a", "a", ["id", ("x", "ax")])


def tables(spark):
    return {
        "a": spark.createDataFrame([(1, "p"), (2, None)], "id bigint, x string"),
        "b": spark.createDataFrame([(1, 10), (1, 11)], "id bigint, line int"),
        "c": spark.createDataFrame([(10, "c10")], "line int, name string"),
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_wide_keeps_anchor_rows_without_matches(spark):
    entries = [
        A,
        Entry("b", "b", ["line"], on="a.id = b.id"),
        Entry("c", "c", [("name", "c_name")], on="b.line = c.line", lookup_key=["line"]),
    ]
    wide = build_wide(tables(spark), entries, {"full": full_name("ax", "c_name")})
    assert rows(wide) == [(1, "p", 10, "c10", "p c10"), (1, "p", 11, None, None), (2, None, None, None, None)]


def test_join_keys_are_the_equated_columns():
    entry = Entry("b", "b", [], on="a.id = b.id AND b.k=a.k2 AND b.line > 1.5 AND b.x = b.y")
    assert join_keys(entry) == ["id", "k"]


def test_wide_with_a_hot_expansion_key(spark):
    lines = spark.range(300).selectExpr("IF(id % 3 = 0, 1, id) AS id", "CAST(id AS int) AS line")
    entries = [A, Entry("b", "b", ["line"], on="a.id = b.id AND b.line > 1.5")]
    anchors = spark.range(100).selectExpr("id", "CAST(id AS string) AS x")
    plain = rows(build_wide({"a": anchors, "b": lines}, entries))
    spark.conf.set(HOT_ROWS_SETTING, "50")
    try:
        hot = build_wide({"a": anchors, "b": lines}, entries)
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert "LeftAnti" in hot._jdf.queryExecution().optimizedPlan().toString()
    assert rows(hot) == plain and len(plain) > 190


@pytest.mark.parametrize(
    "entries",
    [
        [],
        [Entry("a", "a", ["id"], on="a.id = b.id")],
        [A, Entry("b", "b", ["line"])],
        [A, Entry("b", "a", ["line"], on="a.id = a.id")],
        [A, Entry("c", "c", ["name"], on="b.line = c.line"), Entry("b", "b", ["line"], on="a.id = b.id")],
        [A, Entry("b", "b", [("line", "ax")], on="a.id = b.id")],
    ],
)
def test_wide_config_errors(entries):
    with pytest.raises(WideConfigError):
        check_entries(entries)


def test_wide_refuses_a_lookup_that_fans_out(spark):
    entries = [A, Entry("b", "b", ["line"], on="a.id = b.id", lookup_key=["id"])]
    with pytest.raises(FanOutError):
        build_wide(tables(spark), entries)
    assert build_wide(tables(spark), entries, verify=False).count() == 3


def test_calendar_attributes(spark):
    days = {r["calendar_date"]: r for r in day_range(spark, date(2020, 2, 28), date(2021, 1, 4)).select(*day_attributes("calendar_date")).collect()}
    leap, new_year, sunday = days[date(2020, 2, 29)], days[date(2021, 1, 1)], days[date(2021, 1, 3)]
    assert (leap["date_id"], leap["day_name"], leap["is_weekend"], leap["quarter"]) == (20200229, "Saturday", True, 1)
    assert (new_year["week_of_year"], new_year["month_name"]) == (53, "January")
    assert (sunday["day_of_week"], sunday["is_weekend"], days[date(2021, 1, 4)]["week_of_year"]) == (1, True, 1)


def test_calendar_spans_all_sources_with_padding(spark):
    one = spark.createDataFrame([(date(2024, 3, 1),)], "d date")
    two = spark.createDataFrame([(datetime(2024, 2, 1, 23),), (None,)], "t timestamp_ntz")
    got = calendar(spark, [(one, "d"), (two, "t")])
    low, high, n = got.agg(F.min("calendar_date"), F.max("calendar_date"), F.count("*")).first()
    assert (low, high, n) == (date(2024, 1, 2), date(2024, 3, 31), 90)
    assert calendar(spark, [(one.limit(0), "d")]).count() == 0


def test_day_key(spark):
    assert spark.range(1).select(day_key(F.lit(datetime(2024, 12, 31, 23, 59)))).first()[0] == 20241231


def test_column_rules_in_one_scan(spark):
    df = spark.createDataFrame([(1, None), (-1, "a"), (None, "b")], "n int, s string")
    assert rows(q.not_null(df, ["n", "s"])) == [("n", 1), ("s", 1)]
    assert rows(q.expression_is_true(df, ["n >= 0", "n < 9"])) == [("n >= 0", 1)]
    found = q.column_rules(df, ["s"], ["n > 0"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert rows(found) == [("n > 0", 1), ("s is not null", 1)]


def test_keys_and_relationships(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert rows(q.unique(child, "fk")) == [(1, 2), (9, 2)]
    assert rows(q.relationships(child, "fk", parent, "id")) == [(9, 2)]


def test_grain_counts_and_freshness(spark):
    two, three = spark.range(2), spark.range(3)
    assert q.grain(two, two).isEmpty()
    assert rows(q.grain(two, three)) == [(2, 3)]
    assert rows(q.count_consistency({"a": two, "b": three}, "a <> b")) == [(2, 3)]
    now = datetime(2024, 1, 2)
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "at timestamp_ntz")
    assert q.freshness(df, "at", now, timedelta(hours=25)).isEmpty()
    assert q.freshness(df, "at", now, timedelta(hours=23)).count() == 1
    assert q.freshness(df.limit(0), "at", now, timedelta(hours=23)).count() == 1


def test_quality_gate(spark):
    clean = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    dirty = spark.createDataFrame([(1, None), (1, "b"), (None, "c"), (None, "d")], "k int, v string")

    def part(df):
        return q.Measures(df, {"null_k": "k", "null_v": "v"}, "dup_k", "k")

    assert q.quality_gate([part(clean)]).isEmpty()
    assert q.quality_gate([part(clean.limit(0))]).isEmpty()
    assert q.quality_gate([part(dirty)]).first().asDict() == {"null_k": 2, "null_v": 1, "dup_k": 2}


def test_gate_stops_on_errors_only_and_selects_tags(spark):
    bad = lambda: spark.range(2)
    warn, error = q.Check("w", bad, q.WARN), q.Check("e", bad, tags=frozenset({"ci"}))
    assert [r.failures for r in q.gate("s", [warn])] == [2]
    with pytest.raises(q.GateFailed, match="e: 2"):
        q.gate("s", [warn, error])
    assert [r.check.name for r in q.run_checks([warn, error], tags=["ci"])] == ["e"]


def test_no_cross_joins(spark):
    df = spark.range(3)
    for found in (q.grain(df, df), q.quality_gate([q.Measures(df, {"n": "id"}, "d", "id")])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_deliveries_fact_keeps_missing_costs_and_unknown_keys(spark):
    deliveries = spark.createDataFrame(
        [("d1", 1, 1, date(2024, 1, 1), 3, Decimal("1.50")), ("d2", 9, 9, date(1999, 1, 1), 3, None)],
        "delivery_id string, supplier_id bigint, product_id bigint, delivery_date date, quantity int, unit_cost decimal(10,2)",
    )
    suppliers = spark.createDataFrame([(1,)], "supplier_id bigint")
    open_end = datetime(9999, 12, 31)
    products = spark.createDataFrame(
        [(1, "old", datetime(2024, 1, 1)), (1, "now", open_end)], "product_id bigint, scd_id string, valid_to timestamp_ntz"
    )
    days = calendar(spark, [(deliveries.limit(1), "delivery_date")])
    got = rows(deliveries_fact(deliveries, suppliers, products, days))
    assert got == [
        ("d1", 1, "now", 20240101, 3, Decimal("1.50"), False, Decimal("4.50")),
        ("d2", None, None, None, 3, None, True, None),
    ]


def test_catalog_and_counts(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "four.parquet"))
    names = Catalog.of_folder(spark, str(tmp_path), ["four"])
    names["two"] = spark.range(2)
    assert rows(table_counts({n: names[n] for n in ("four", "two")})) == [("four", 4), ("two", 2)]
    with pytest.raises(KeyError, match="unknown table"):
        names["none"]


def test_bucketed_tables_join_without_a_shuffle(spark):
    orders = spark.range(100).selectExpr("id AS order_id", "id % 7 AS c")
    for name, df in (("b_orders", orders), ("b_lines", orders.selectExpr("order_id", "order_id * 2 AS line"))):
        df.write.bucketBy(4, "order_id").sortBy("order_id").mode("overwrite").saveAsTable(name)
    names = Catalog(spark, {"orders": "table:b_orders", "lines": "table:b_lines"})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = names["orders"].join(names["lines"], "order_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_lookups_of_lines_join_the_lines_alone(spark, monkeypatch):
    """Parts meet lines before orders do, so that join moves no column of an order; the rows stay the same."""
    moved, join = [], wide_module._left_join
    monkeypatch.setattr(wide_module, "_left_join", lambda left, *rest: moved.append(set(left.columns)) or join(left, *rest))
    tables = {
        "orders": spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, note string"),
        "lines": spark.createDataFrame([(1, 10), (1, 11), (1, 99), (1, None), (4, 10)], "k long, part long"),
        "parts": spark.createDataFrame([(10, "x"), (11, "y"), (None, "z")], "part long, name string"),
    }
    entries = [
        Entry("orders", "o", [("k", "order_id"), "note"]),
        Entry("lines", "l", [("part", "part_id")], on="o.k = l.k"),
        Entry("parts", "p", ["name"], on="l.part = p.part", lookup_key=["part"]),
    ]
    wide = build_wide(tables, entries)
    assert rows(wide) == [
        (1, "a", 10, "x"), (1, "a", 11, "y"), (1, "a", 99, None), (1, "a", None, None), (2, "b", None, None), (None, "c", None, None),
    ]
    assert moved == [{"l__k", "l__part"}, {"o__k", "o__note"}]
