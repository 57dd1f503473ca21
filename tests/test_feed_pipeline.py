from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.data import FEED, FEED_HEADER, LIFE, ROWS, T0, source_tables, write_feed
from tideline.operators import quality
from tideline.operators.quality import GateFailed
from tideline.plans import retail
from tideline.plans.pipeline import FEED as FEED_TABLE
from tideline.plans.pipeline import FRESHNESS, Freshness, RetailPipeline
from tideline.schemas import PRIMARY_KEY
from tideline.session import scratch_dir
from tideline.sources.extract import extract_since
from tideline.sources.feed import clean_feed, counted_rejects, read_feed, rejected_feed, stream_feed
from tideline.sources.loader import load_sources
from tideline.sources.store import StoredTable
from tideline.streaming.merge import Sink, merge_stream, run_to_end, suppress_duplicates

RUN = datetime(2026, 1, 1)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_feed_types_blanks_and_rejects(spark, tmp_path):
    write_feed(tmp_path / "f", "2025-11.csv", [*FEED, "DEL-9,SUP-1,North,P-12,2025-11-08,1,1.00", "DEL-8,SUP-1,North,1,soon,1,1.00"])
    raw = read_feed(spark, str(tmp_path / "f"))
    clean = clean_feed(raw)
    assert clean.count() == 4 and dict(clean.dtypes)["unit_cost"] == "decimal(10,2)"
    missing = clean.filter("is_unit_cost_missing").select("delivery_id", "unit_cost").distinct()
    assert rows(missing) == [("DEL-2", None)]
    assert rows(rejected_feed(raw), "delivery_id", "reason") == [("DEL-8", "delivery_date"), ("DEL-9", "product_id")]


def test_identical_rejects_of_a_file_are_counted(spark, tmp_path):
    short = "DEL-7,SUP-1"
    write_feed(tmp_path / "f", "a.csv", [*FEED, short, short, short, "DEL-6,SUP-1"])
    write_feed(tmp_path / "f", "b.csv", [short])
    table = StoredTable(spark, str(tmp_path / "rejects"), "reject_id", 2)
    sink = Sink(table, "source_file", counted_rejects)
    run_to_end(merge_stream(stream_feed(spark, str(tmp_path / "f")), [sink], str(tmp_path / "cp")))
    assert rows(table.read(), "line", "n_lines") == [("DEL-6,SUP-1", 1), (short, 1), (short, 3)]


def test_feed_lines_of_another_length_or_without_id_are_rejected(spark, tmp_path):
    write_feed(tmp_path / "f", "a.csv", [*FEED, "DEL-7,SUP-1", "DEL-6,SUP-1,North,1,2025-11-08,1,1.00,9", ",SUP-1,North,1,2025-11-08,1,1.00"])
    raw = read_feed(spark, str(tmp_path / "f"))
    assert clean_feed(raw).count() == 4
    got = rows(rejected_feed(raw), "delivery_id", "reason", "line")
    assert got == [
        ("DEL-6", "fields", "DEL-6,SUP-1,North,1,2025-11-08,1,1.00,9"),
        ("DEL-7", "fields", "DEL-7,SUP-1"),
        (None, "delivery_id", None),
    ]


def test_feed_with_another_header_raises(spark, tmp_path):
    (tmp_path / "f").mkdir()
    names = FEED_HEADER.split(",")
    (tmp_path / "f" / "a.csv").write_text("\n".join([",".join([names[1], names[0], *names[2:]]), *FEED]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        clean_feed(read_feed(spark, str(tmp_path / "f"))).collect()


def test_stream_reads_each_file_once_and_later_files_win(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), "delivery_id", 4)

    def load():
        sink = Sink(table, ["delivery_date", "source_file"], clean_feed)
        run_to_end(merge_stream(stream_feed(spark, str(tmp_path / "f")), [sink], str(tmp_path / "cp")))

    write_feed(tmp_path / "f", "2025-11.csv", FEED)
    load()
    version = table.state()["version"]
    load()
    assert table.state()["version"] == version and table.read().count() == 3
    write_feed(tmp_path / "f", "2025-12.csv", ["DEL-1,SUP-1,North,1,2025-11-05,99,4.50", "DEL-4,SUP-1,North,1,2025-11-01,1,1"])
    load()
    got = dict(rows(table.read(), "delivery_id", "quantity"))
    assert got == {"DEL-1": 99, "DEL-2": 20, "DEL-3": 5, "DEL-4": 1}


def test_a_new_checkpoint_is_a_new_count_of_batches(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), "delivery_id", 4)
    for i, line in enumerate(["DEL-1,S,N,1,2025-11-05,1,1", "DEL-2,S,N,1,2025-11-05,1,1"]):
        write_feed(tmp_path / f"f{i}", "a.csv", [line])
        stream = stream_feed(spark, str(tmp_path / f"f{i}"))
        run_to_end(merge_stream(stream, [Sink(table, "delivery_date", clean_feed)], str(tmp_path / f"cp{i}")))
    assert table.read().count() == 2


def test_a_retried_batch_is_applied_once_per_sink(spark, tmp_path):
    log, strict = StoredTable(spark, str(tmp_path / "log"), "delivery_id", 4), StoredTable(spark, str(tmp_path / "s"), "delivery_id", 4)
    write_feed(tmp_path / "f", "a.csv", FEED)
    broken = {"now": True}

    def fail_once(raw):
        if broken["now"]:
            raise RuntimeError("lost executor")
        return clean_feed(raw)

    def load():
        sinks = [Sink(log, "delivery_date", clean_feed), Sink(strict, "delivery_date", fail_once)]
        run_to_end(merge_stream(stream_feed(spark, str(tmp_path / "f")), sinks, str(tmp_path / "cp")))

    with pytest.raises(Exception, match="lost executor"):
        load()
    assert log.state()["version"] == 1 and not strict.exists()
    broken["now"] = False
    load()
    assert log.state()["version"] == 1 and strict.read().count() == 3


def test_load_sources_inserts_unseen_keys_only(spark, tmp_path):
    header = "store_id,store_name,city,province,country,created_timestamp,updated_timestamp,is_active"
    path = tmp_path / "stores.csv"

    def load(*lines):
        path.write_text("\n".join([header, *lines]) + "\n")
        return rows(load_sources(spark, str(tmp_path / "raw"), {"stores": str(path)}, 2))

    one = "1,Store 1,City,Prov,CA,2025-03-01 10:00:00,2025-03-02 11:00:00,Y"
    assert load(one) == [("stores", 1)]
    assert load(one) == [("stores", 1)]
    assert load(one.replace("Store 1", "Changed"), one.replace("1,", "2,", 1)) == [("stores", 2)]
    table = StoredTable(spark, str(tmp_path / "raw" / "stores"))
    assert rows(table.read(), "store_id", "store_name") == [(1, "Store 1"), (2, "Store 1")]
    with pytest.raises(Exception, match="MALFORMED|store_id"):
        load("x1,Store 1,City,Prov,CA,2025-03-01 10:00:00,2025-03-02 11:00:00,Y")


def test_suppress_duplicates(spark, tmp_path):
    events = spark.createDataFrame([(i, T0 + timedelta(minutes=i)) for i in range(20)], "id bigint, ts timestamp_ntz")
    for _ in range(2):
        events.write.mode("append").parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    query = (
        suppress_duplicates(stream, "id", "ts", "1 hour")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    run_to_end(query)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(20))


def test_extract_since(spark):
    df = spark.createDataFrame([(1, "a", T0), (1, "b", T0 + timedelta(1)), (2, "c", T0)], "k bigint, v string, at timestamp_ntz")
    assert rows(extract_since(df, "at", "k"), "k", "v") == [(1, "b"), (2, "c")]
    assert rows(extract_since(df, "at", "k", T0), "k", "v") == [(1, "b")]


def test_scratch_lies_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(base)


class Session:
    """The parts of a session without a checkpoint folder that `scratch_dir` looks at."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master
        self.folder = None

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_without_a_checkpoint_folder():
    local = Session("local[2]")
    assert scratch_dir(local, "x").startswith(local.folder)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"), "x")


# The rows of the tests are older than the runs.
AGES = {name: Freshness(limits.cursor, timedelta(days=365), timedelta(days=365)) for name, limits in FRESHNESS.items()}


def pipeline(spark, tmp_path, tables, run_ts=RUN, **options):
    options.setdefault("freshness", AGES)
    return RetailPipeline(spark, str(tmp_path / "lake"), tables, str(tmp_path / "feed"), run_ts, buckets=2, **options)


def changed_rows(**changes):
    return {**ROWS, **{name: [*ROWS[name], *more] for name, more in changes.items()}}


def test_declared_tests():
    groups = [retail.SILVER_TESTS, retail.WIDE_TESTS, retail.GOLD_TESTS]
    tests = [t for group in groups for t in group.values()]
    kinds = [sum(len(getattr(t, kind)) for t in tests) for kind in ("not_null", "unique", "relationships", "expressions")]
    assert kinds == [83, 20, 9, 5]


def test_pipeline_end_to_end(spark, tmp_path):
    write_feed(tmp_path / "feed", "2025-11.csv", FEED)
    first = pipeline(spark, tmp_path, source_tables(spark))
    results = first.run()
    assert all(r.failures == 0 for r in results)
    fact = first.gold("fact_orders")
    assert fact.count() == len(ROWS["order_items"]) == first.silver("wide").count()
    assert fact.filter("order_date_id IS NULL OR current_order_status <> 'open'").isEmpty()
    amounts = rows(first.gold("fact_supplier_deliveries"), "delivery_id", "delivery_amount", "is_unit_cost_missing")
    assert amounts == [("DEL-1", Decimal("45.00"), False), ("DEL-2", None, True), ("DEL-3", Decimal("6.25"), False)]
    assert first.gold("dim_products_current").count() == len(ROWS["products"])

    # An unchanged source changes nothing.
    before = {n: rows(first.gold(n)) for n in ("fact_orders", "dim_customers", "dim_date")}
    dims = first.table("gold", "dim_customers").state()["version"]
    pipeline(spark, tmp_path, source_tables(spark), RUN + timedelta(days=1)).run()
    assert {n: rows(first.gold(n)) for n in before} == before
    assert first.table("gold", "dim_customers").state()["version"] == dims

    # A changed customer, a closed order and one new delivery.
    later = T0 + timedelta(days=30)
    customer = (1, "Renamed", "Last1", "c1@example.com", "1", "City", "Prov", "CA", T0, later, "Y")
    order = (5, 1, 3, T0 + timedelta(days=5), "card", "closed", Decimal(50), T0, later, "Y")
    write_feed(tmp_path / "feed", "2025-12.csv", ["DEL-4,SUP-2,South,1,2025-12-01,1,1.00"])
    third = pipeline(spark, tmp_path, source_tables(spark, changed_rows(customers=[customer], orders=[order])), RUN + timedelta(days=2))
    assert all(r.failures == 0 for r in third.run())
    versions = rows(third.gold("dim_customers").filter("customer_id = 1"), "customer_first_name", "valid_from", "valid_to")
    assert versions == [("First1", LIFE[1], later), ("Renamed", later, datetime(9999, 12, 31))]
    assert rows(third.gold("fact_orders").filter("order_id = 5"), "current_order_status") == [("closed",)] * 3
    # Orders keep the customer version of their own time.
    old = third.gold("dim_customers").filter("customer_first_name = 'First1'").first()["scd_id"]
    of_customer = third.silver("orders").filter("customer_id = 1").select("order_id")
    assert third.gold("fact_orders").join(of_customer, "order_id").filter(F.col("customer_scd_id") != old).isEmpty()
    assert third.gold("fact_supplier_deliveries").count() == 4


def test_pipeline_stops_at_a_broken_gate(spark, tmp_path):
    write_feed(tmp_path / "feed", "2025-11.csv", FEED)
    orphan = (999, 1, 77, 1, Decimal(1), Decimal(1), *LIFE)
    run = pipeline(spark, tmp_path, source_tables(spark, changed_rows(order_items=[orphan])))
    with pytest.raises(GateFailed, match="order_items_product_id_in_products: 1"):
        run.run()
    assert not run.table("gold", "fact_orders").exists()


def test_pipeline_reports_orders_without_lines(spark, tmp_path):
    write_feed(tmp_path / "feed", "2025-11.csv", FEED)
    empty = (50, 1, 1, T0, "card", "open", Decimal(1), *LIFE)
    with pytest.raises(GateFailed, match="wide_grain"):
        pipeline(spark, tmp_path, source_tables(spark, changed_rows(orders=[empty]))).run()


def test_feed_freshness(spark, tmp_path):
    write_feed(tmp_path / "feed", "2025-11.csv", FEED)
    only = {FEED_TABLE: FRESHNESS[FEED_TABLE]}

    def failures(hours):
        run = pipeline(spark, tmp_path, source_tables(spark), RUN + timedelta(hours=hours), freshness=only)
        return {r.check.severity: r.failures for r in quality.run_checks(run.freshness_checks())}

    assert failures(0) == {"warn": 1, "error": 1}
    run = pipeline(spark, tmp_path, source_tables(spark))
    run.ingest_feed()
    assert failures(24) == {"warn": 0, "error": 0}
    assert failures(26) == {"warn": 1, "error": 0}
    assert failures(51) == {"warn": 1, "error": 1}
    assert rows(run.table("bronze", "supplier_deliveries_rejected").read()) == []


def test_rejected_lines_are_kept_once(spark, tmp_path):
    run = pipeline(spark, tmp_path, source_tables(spark))
    for name in ("a.csv", "b.csv"):
        write_feed(tmp_path / "feed", name, [*FEED, "DEL-7,SUP-1", "DEL-7,SUP-1"])
        run.ingest_feed()
    assert run.table("bronze", "supplier_deliveries").read().count() == 3
    assert run.table("bronze", "supplier_deliveries_rejected").read().count() == 2  # one per file


def test_stale_orders_stop_the_run_before_silver(spark, tmp_path):
    write_feed(tmp_path / "feed", "2025-11.csv", FEED)
    run = pipeline(spark, tmp_path, source_tables(spark), freshness=FRESHNESS)
    with pytest.raises(GateFailed, match="orders_fresh_error"):
        run.run()
    assert not run.table("silver", "orders", "order_id").exists()


def test_a_missing_table_fails_its_gate(spark, tmp_path):
    run = pipeline(spark, tmp_path, source_tables(spark))
    with pytest.raises(GateFailed, match="gold: never written: .*fact_orders"):
        run.check(retail.GOLD_TESTS, run.gold, "gold")


def test_a_small_second_run_reads_and_writes_little(spark, tmp_path):
    write_feed(tmp_path / "feed", "2025-11.csv", FEED)
    pipeline(spark, tmp_path, source_tables(spark)).run()
    later = T0 + timedelta(days=40)
    line = (999, 1, 2, 1, Decimal(1), Decimal(1), later, later, "Y")
    run = pipeline(spark, tmp_path, source_tables(spark, changed_rows(order_items=[line])), RUN + timedelta(days=1))
    tables = [run.table(layer, n, key) for n, key in PRIMARY_KEY.items() for layer in ("bronze", "silver")]
    before = {t.root: t.state() for t in tables}
    run.run()
    after = {t.root: t.state() for t in tables}
    changed = {
        root.rsplit("/", 1)[1] + ":" + unit: 1
        for root, state in after.items()
        for unit, runs in state["units"].items()
        if runs != before[root]["units"].get(unit)
    }
    assert len(changed) == 1 and next(iter(changed)).startswith("order_items:202512")
    bronze = run.table("bronze", "order_items", "order_item_id")
    assert bronze.changed(before[bronze.root]["version"], bronze.state()).count() == 1
    assert bronze.state()["marks"]["updated_timestamp"] == str(later)
