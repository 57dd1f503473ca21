import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.operators import wide_delta
from tideline.operators.wide import Entry, FanOutError, build_wide, join_order
from tideline.operators.wide_delta import KeySet, changed_rows, replace_anchors, touched_anchors, used_columns, wide_increment

SCHEMAS = {
    "orders": "id int, customer int, rate string, note string",
    "lines": "order_id int, part int, n int",
    "customers": "c int, nation int, name string",
    "parts": "p int, title string",
    "nations": "n int, label string",
    "rates": "r string, low int, high int, share int",
}
ENTRIES = [
    Entry("orders", "o", ["id", "customer", "note"]),
    Entry("lines", "l", ["part", "n"], on="o.id = l.order_id"),
    Entry("customers", "c", ["name", ("nation", "nation_id")], on="o.customer = c.c", lookup_key=["c"]),
    Entry("parts", "p", ["title"], on="l.part = p.p", lookup_key=["p"]),
    Entry("nations", "s", ["label"], on="c.nation = s.n", lookup_key=["n"]),
    # Not made of equalities alone, over two earlier entries, and true for orders without a line.
    Entry("rates", "r", ["share"], on="o.rate = r.r AND coalesce(l.n, 0) >= r.low AND coalesce(l.n, 0) < r.high"),
]


def derived():
    return {"both": F.concat("name", F.lit(" "), "label")}


def some(chance, values):
    return chance.choice([None, *values])


def state(chance):
    return {
        "orders": [(i, some(chance, range(6)), some(chance, "xy"), chance.choice("ab")) for i in range(14) if chance.random() < 0.9]
        + [(None, 1, "x", "no id")] * chance.randrange(2),
        "lines": [(some(chance, range(16)), some(chance, range(5)), chance.randrange(9)) for _ in range(25)],
        "customers": [(c, some(chance, range(3)), f"c{c}{chance.choice('ab')}") for c in range(6) if chance.random() < 0.8],
        "parts": [(p, f"p{p}{chance.choice('ab')}") for p in range(5) if chance.random() < 0.8],
        "nations": [(n, f"n{n}{chance.choice('ab')}") for n in range(3) if chance.random() < 0.8],
        "rates": [("x", 0, 4, chance.randrange(3)), ("x", 4, 9, 2), ("y", 0, chance.randrange(1, 9), 3)],
    }


def frames(spark, rows):
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("changing", [["orders"], ["lines"], ["customers"], ["parts"], ["nations"], ["rates"], list(SCHEMAS), []])
def test_increment_equals_rebuild(spark, changing):
    chance = random.Random("+".join(changing))
    old = state(chance)
    new = {name: rows if name in changing else old[name] for name, rows in state(chance).items()}
    before, after = frames(spark, old), frames(spark, new)
    changes = {name: changed_rows(before[name], after[name]) for name in changing}
    touched, rows = wide_increment(after, changes, ENTRIES, ["id"], derived())
    wide = build_wide(before, ENTRIES, derived())
    expected = counted(build_wide(after, ENTRIES, derived()))
    assert counted(replace_anchors(wide, touched, rows, ENTRIES, ["id"])) == expected
    # Nothing but the rows of touched anchors was joined again.
    ids = {r[0] for r in touched.collect()}
    assert {r["id"] for r in rows.collect()} <= ids
    if not changing:
        assert not ids


def test_one_changed_lookup_row_touches_its_anchors_only(spark):
    rows = state(random.Random(5))
    rows["orders"] = [(i, i % 6, "x", "a") for i in range(14)]
    rows["customers"] = [(c, c % 3, f"c{c}") for c in range(6)]
    after = frames(spark, rows)
    changes = {"nations": spark.createDataFrame([(2, "new"), (2, "old")], SCHEMAS["nations"])}
    found = {r[0] for r in touched_anchors(after, changes, ENTRIES, ["id"]).collect()}
    assert found == {i for i in range(14) if i % 6 % 3 == 2}
    plan = touched_anchors(after, changes, ENTRIES, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "order_id" not in plan  # the lines are not on the way


def test_changed_lookups_are_checked(spark):
    rows = state(random.Random(1))
    rows["parts"] = [(1, "a"), (1, "b"), (2, "c")]
    after = frames(spark, rows)
    with pytest.raises(FanOutError):
        wide_increment(after, {"parts": after["parts"].filter("title = 'b'")}, ENTRIES, ["id"])
    wide_increment(after, {"parts": after["parts"].filter("p = 2")}, ENTRIES, ["id"])


def test_changed_rows_count_copies_and_nulls(spark):
    one = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, None)], "a int, b string")
    two = spark.createDataFrame([(1, None), (2, "b"), (None, None)], "a int, b string")
    assert counted(changed_rows(one, two)) == Counter([(1, None), (2, "a"), (2, "b")])


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_keys_are_told_apart_as_masks_and_by_joins(spark, monkeypatch, most):
    monkeypatch.setattr(wide_delta, "MASK_ROWS", most)
    numbers = [None, 0, 1, 63, 64, 65, -1, -64, -65, 2**62, -(2**63), 2**63 - 1]
    rows = spark.createDataFrame([(n, i) for i in range(2) for n in numbers], "n long, i int")
    for some in (numbers[1::2], numbers[::2], [None], []):
        keys = KeySet(spark.createDataFrame([(n,) for n in [*some, *some]], "k long"), ["k"])
        assert (keys.masks is None) == (most == 0 and bool(some))
        for among in (True, False):
            for nulls in (True, False):
                expected = [(n, i) for n, i in counted(rows) if (n in some and (nulls or n is not None)) == among]
                assert counted(keys.cut(rows, ["n"], among, nulls)) == Counter(expected)


def test_increment_without_masks(spark, monkeypatch):
    monkeypatch.setattr(wide_delta, "MASK_ROWS", 0)
    chance = random.Random(11)
    before, after = frames(spark, state(chance)), frames(spark, state(chance))
    changes = {}
    for name in SCHEMAS:
        columns = used_columns(ENTRIES, name, ["id"])
        changes[name] = changed_rows(before[name].select(*columns), after[name].select(*columns))
    touched, rows = wide_increment(after, changes, ENTRIES, ["id"], derived())
    kept = replace_anchors(build_wide(before, ENTRIES, derived()), touched, rows, ENTRIES, ["id"])
    assert counted(kept) == counted(build_wide(after, ENTRIES, derived()))


def test_lookups_of_the_anchor_come_before_lines():
    assert [e.alias for e in join_order(ENTRIES)] == ["o", "c", "s", "l", "p", "r"]


def test_kept_rows_are_not_shuffled(spark):
    rows = state(random.Random(3))
    rows["orders"] = [(i, i % 6, "x", "a") for i in range(14)]
    tables = frames(spark, rows)
    changes = {"orders": tables["orders"].filter("id < 9")}
    wide = build_wide(tables, ENTRIES, derived(), verify=False).localCheckpoint()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        touched, rows = wide_increment(tables, changes, ENTRIES, ["id"], derived(), verify=False)
        kept = replace_anchors(wide, touched, rows.limit(0), ENTRIES, ["id"])
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan and "strategy=broadcast" in plan
        assert {r["id"] for r in kept.collect()} == set(range(9, 14))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
