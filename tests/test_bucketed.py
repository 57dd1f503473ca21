"""Tables stored by bucket, and the fact that joins them."""

import os
import re

import pytest

from tideline.operators.skew import HOT_ROWS_SETTING
from tideline.plans import queries
from tideline.plans import standins as s
from tideline.sources.bucketed import bucketed_table

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_one_file_per_bucket_and_no_shuffle(spark, no_broadcast, tmp_path):
    rows = spark.range(1_000).selectExpr("IF(id % 10 = 0, NULL, id % 50) AS k", "id")
    left = bucketed_table(rows, "k", 4, path=str(tmp_path / "left"))
    assert sorted(left.collect(), key=repr) == sorted(rows.collect(), key=repr)
    assert len(list((tmp_path / "left").glob("part-*"))) <= 4
    right = bucketed_table(spark.range(50).withColumnRenamed("id", "k"), "k", 4)
    joined = left.join(right, "k")
    assert "Exchange" not in physical(joined) and joined.count() == 900
    assert "Exchange" not in physical(left.groupBy("k").count())


def test_empty_table(spark):
    assert bucketed_table(spark.range(0), "id", 4).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")
def test_the_fact_is_not_shuffled_by_order(spark, no_broadcast):
    plan = physical(queries.bucketed_fact(s.tables(spark, SF)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and not [keys for keys in exchanges if "order_id#" in keys]
    # Versions are renamed before they join: those of customers, stores and products move, those of orders do not.
    assert len([keys for keys in exchanges if keys.startswith("_k0#")]) == 3


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")
def test_orders_with_many_lines_leave_their_bucket(spark, no_broadcast):
    t = s.tables(spark, SF)
    expected = sorted(queries.orders_fact_of(t).collect())
    spark.conf.set(HOT_ROWS_SETTING, "5")
    try:
        fact = queries.bucketed_fact(t)
        assert "BroadcastHashJoin" in physical(fact)
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert sorted(fact.collect()) == expected


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not available")
def test_version_ids_are_formed_after_the_joins(spark):
    links = queries.fact_links(s.tables(spark, SF))
    assert [link.marker for link in links] == ["valid_from"] * 4 and all("scd_id" not in link.versions.columns for link in links)
