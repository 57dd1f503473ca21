"""The registered queries: every operator on the test tables."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import full_name, literal, version_id
from tideline.functions.calendar import calendar
from tideline.operators import quality
from tideline.operators.incremental import high_water, high_water_frame, newer_than
from tideline.operators.key_bitmaps import distinct_positions, key_bitmaps, repeated_keys
from tideline.operators.latest import distinct_rows, latest_row
from tideline.operators.observed import Watch
from tideline.operators.pit import choose_strategy, coverage_gap, pit_join, pit_join_closed
from tideline.operators.scd import as_of, prepare, scd1, scd2_open, scd2_rebuild, snowflake_as_of, version_floor
from tideline.operators.timeline import scd2_late, snowflake_timeline
from tideline.operators.upsert import upsert
from tideline.operators.wide import build_wide
from tideline.operators.wide_delta import changed_rows, replace_anchors, used_columns, wide_increment
from tideline.plans import standins as s
from tideline.plans.facts import (
    ChangedLink, VersionLink, deliveries_fact, finished, orders_fact, orders_fact_bucketed, orders_fact_increment, with_current, with_markers,
)
from tideline.plans.models import incremental_model
from tideline.schemas import FEED_COLUMNS
from tideline.session import configure, scratch_dir
from tideline.sources.bucketed import bucketed_table
from tideline.sources.catalog import Catalog, table_counts
from tideline.sources.cursor import cursor_stream
from tideline.sources.dimension import DimensionTable
from tideline.sources.extract import extract_since
from tideline.sources.feed import clean_feed, read_feed, rejected_feed, stream_feed
from tideline.sources.store import StoredTable
from tideline.streaming.merge import Sink, merge_stream, run_to_end, suppress_duplicates, suppress_repeats

RUN_1 = datetime(2024, 2, 1)
RUN_2 = datetime(2024, 2, 2)
FRESH_NOW = datetime(2024, 2, 5)
FRESH_LIMIT = timedelta(hours=25)
LATE_SPAN = timedelta(days=12)
OBSERVED_RULES = ["total_amount >= 1000", "quantity < 50", "store_id >= 0"]

QUERIES = {}


def query(name: str):
    """Register a function of the test tables."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(s.tables(configure(spark), sf_dir))
        return fn

    return register


def versions_out(df: DataFrame) -> DataFrame:
    """Versions for comparison: the open end lies outside the range of some clients' timestamps."""
    return df.withColumn("valid_to", F.col("valid_to").cast("string"))


def store(t: Catalog, label: str, key) -> StoredTable:
    return StoredTable(t.spark, scratch_dir(t.spark, label), key=key, buckets=8)


# --- scans, sources, sinks -----------------------------------------------------------------------


def write_feed(t: Catalog, *drops) -> list[str]:
    """Write the feed as CSV folders, one per filter."""
    feed, paths = s.delivery_feed(t), []
    for drop in drops:
        paths.append(scratch_dir(t.spark, "feed"))
        feed.filter(drop).write.option("header", True).csv(paths[-1])
    return paths


@query("feed_batch")
def feed_batch(t):
    (path,) = write_feed(t, F.lit(True))
    return clean_feed(read_feed(t.spark, path)).drop("source_file")


@query("feed_rejects")
def feed_rejects(t):
    """The feed with damaged lines: cut short, one field too many, without an id, and with unreadable values."""
    fields = [F.col(c).cast("string") for c in FEED_COLUMNS]
    number = F.regexp_extract("delivery_id", "([0-9]+)$", 1).cast("int")
    texts = {c: F.coalesce(f, F.lit("")) for c, f in zip(FEED_COLUMNS, fields)}
    texts["delivery_id"] = F.when(number != 3, texts["delivery_id"]).otherwise("")
    texts["delivery_date"] = F.when(number != 4, texts["delivery_date"]).otherwise("soon")
    texts["quantity_received"] = F.when(number != 5, texts["quantity_received"]).otherwise("x")
    whole = F.concat_ws(",", *texts.values())
    line = F.when(number == 1, F.concat_ws(",", *list(texts.values())[:2])).when(number == 2, F.concat(whole, F.lit(",9")))
    path = scratch_dir(t.spark, "damaged")
    rows = s.delivery_feed(t).select(line.otherwise(whole).alias(",".join(FEED_COLUMNS)))
    rows.write.options(header=True, sep="\x01", quote="").csv(path)
    return rejected_feed(read_feed(t.spark, path)).select("delivery_id", "supplier_id", "reason", "line")


DELIVERY_ORDER = ["delivery_date", "product_id", "supplier_id", "supplier_name", "quantity", "unit_cost"]


@query("feed_clean")
def feed_clean(t):
    (path,) = write_feed(t, F.lit(True))
    bronze = clean_feed(read_feed(t.spark, path)).drop("source_file")
    silver = store(t, "deliveries", "delivery_id")
    silver.upsert(bronze, DELIVERY_ORDER)
    return silver.read()


@query("feed_stream")
def feed_stream(t):
    root = scratch_dir(t.spark, "stream")
    bronze = store(t, "bronze", "delivery_id")
    split = F.lit("1998-01-01").cast("date")
    feed = s.delivery_feed(t)
    for drop in (F.col("delivery_date") < split, F.col("delivery_date") >= split):
        feed.filter(drop).write.mode("append").option("header", True).csv(f"{root}/feed")
        sink = Sink(bronze, DELIVERY_ORDER, lambda raw: clean_feed(raw).drop("source_file"))
        run_to_end(merge_stream(stream_feed(t.spark, f"{root}/feed"), [sink], f"{root}/checkpoint"))
    return bronze.read()


def stream_events(t: Catalog, path: str) -> DataFrame:
    return t.spark.readStream.schema(t["events"].schema).parquet(path)


@query("stream_dedup")
def stream_dedup(t):
    root = scratch_dir(t.spark, "redelivered")
    target = store(t, "events", "event_id")
    for _ in range(2):
        t["events"].write.mode("append").parquet(f"{root}/feed")
        sink = Sink(target, "ts", insert_only=True)
        run_to_end(merge_stream(stream_events(t, f"{root}/feed"), [sink], f"{root}/checkpoint"))
    return target.read()


@query("stream_dedup_window")
def stream_dedup_window(t):
    """Every event delivered twice; the delay spans the whole feed, so no first delivery counts as late."""
    root = scratch_dir(t.spark, "repeats")
    for _ in range(2):
        t["events"].write.mode("append").parquet(f"{root}/feed")
    stream = suppress_duplicates(stream_events(t, f"{root}/feed"), "event_id", "ts", "60 days")
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    writer = rows.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    run_to_end(writer.format("parquet").start(f"{root}/out"))
    return t.spark.read.schema(t["events"].schema).parquet(f"{root}/out")


@query("stream_dedup_state")
def stream_dedup_state(t):
    """Every event delivered three times: again at once, where state drops it, and after its key was forgotten, where the merge does."""
    root = scratch_dir(t.spark, "forgotten")
    target = store(t, "events", "event_id")
    for deliveries in (2, 1):
        for _ in range(deliveries):
            t["events"].write.mode("append").parquet(f"{root}/feed")
        stream = suppress_repeats(stream_events(t, f"{root}/feed"), "event_id", "0 seconds")
        run_to_end(merge_stream(stream, [Sink(target, "ts", insert_only=True)], f"{root}/checkpoint"))
    return target.read()


@query("late_rows")
def late_rows(t):
    """Clicks from the cut on arrive after all other events; the lookback reaches back to the cut and no further."""
    root = scratch_dir(t.spark, "late")
    bronze, silver = store(t, "bronze", "event_id"), store(t, "silver", "event_id")
    late = (F.col("ts") >= literal(s.EVENTS_CUT)) & (F.col("event_type") == "click")
    for drop in (~late, late):
        t["events"].filter(drop).write.mode("append").parquet(f"{root}/feed")
        run_to_end(merge_stream(stream_events(t, f"{root}/feed"), [Sink(bronze, "ts")], f"{root}/checkpoint"))
        incremental_model(bronze.read(), silver, "ts", lookback=LATE_SPAN)
    return silver.read()


@query("extract_since")
def extract_since_cursor(t):
    """The last line shipped of every order that had one shipped after the cut."""
    return extract_since(t["lineitem"], "l_shipdate", "l_orderkey", s.ORDERS_CUT)


def shipped_before_cut():
    return F.col("l_shipdate") < literal(s.ORDERS_CUT)


@query("extract_stream")
def extract_stream(t):
    """Lines shipped before the cut, then the rest: each run takes the rows above the cursor of the one before."""
    root = scratch_dir(t.spark, "extract")
    target = store(t, "lines", s.LINE_KEY)
    for load in (shipped_before_cut(), ~shipped_before_cut()):
        t["lineitem"].filter(load).write.mode("append").parquet(f"{root}/source")
        stream = cursor_stream(t.spark, f"{root}/source", "l_shipdate")
        run_to_end(merge_stream(stream, [Sink(target, "l_shipdate")], f"{root}/checkpoint"))
    return target.read()


@query("insert_if_absent")
def insert_if_absent(t):
    target = store(t, "loaded", s.LINE_KEY)
    first = t["lineitem"].filter(shipped_before_cut())
    for batch in (first, first, t["lineitem"]):
        target.insert_if_absent(batch, "l_shipdate")
    return target.read()


@query("table_counts")
def counts(t):
    return table_counts({n: t[n] for n in s.TABLES})

# --- latest row, incremental models, merge -------------------------------------------------------


@query("latest_row")
def latest(t):
    return s.lines(t)


@query("incremental_filter")
def incremental_filter(t):
    target = t["events"].filter(F.col("ts") < literal(s.EVENTS_CUT))
    return newer_than(t["events"], "ts", high_water(target, "ts"))


@query("high_water")
def high_water_mark(t):
    events = t["events"]
    marks = {"events": events, "nothing": events.filter(F.lit(False))}
    one, two = [high_water_frame(df, "ts").withColumn("target", F.lit(n)) for n, df in marks.items()]
    return one.unionByName(two)


@query("incremental_model")
def incremental(t):
    silver = store(t, "lines", s.LINE_KEY)
    incremental_model(t["lineitem"].filter(shipped_before_cut()), silver, "l_shipdate", run_ts=RUN_1)
    incremental_model(t["lineitem"], silver, "l_shipdate", run_ts=RUN_2)
    return silver.read()


@query("upsert")
def merge_guarded(t):
    """Newer rows first, older rows second: the older ones must not win."""
    target = store(t, "merged", s.LINE_KEY)
    target.upsert(t["lineitem"].filter(~shipped_before_cut()), "l_shipdate")
    target.upsert(t["lineitem"].filter(shipped_before_cut()), "l_shipdate")
    return target.read()


@query("upsert_replace")
def upsert_replace(t):
    newer = latest_row(t["lineitem"].filter(~shipped_before_cut()), s.LINE_KEY, "l_shipdate")
    older = latest_row(t["lineitem"].filter(shipped_before_cut()), s.LINE_KEY, "l_shipdate")
    return upsert(newer, older, s.LINE_KEY)


@query("distinct_rows")
def distinct(t):
    return distinct_rows(t["orders"], ["o_custkey", "o_orderpriority"])

# --- the wide table ------------------------------------------------------------------------------


def stored(t: Catalog, **builders: Callable[[Catalog], DataFrame]) -> list[DataFrame]:
    """Write tables side by side and read them back: built once, with known sizes, like a pipeline's layers."""
    root = scratch_dir(t.spark, "tables")
    with ThreadPoolExecutor(len(builders)) as pool:
        list(pool.map(lambda item: item[1](t).write.parquet(f"{root}/{item[0]}"), builders.items()))
    return [t.spark.read.parquet(f"{root}/{name}") for name in builders]


def silver_lines(t: Catalog) -> DataFrame:
    """The latest lines as a stored table, written once per query, with the columns that the wide table and the fact take."""
    if "lines" not in t.entries:
        (t["lines"],) = stored(t, lines=lambda c: s.lines(c, s.LINE_COLUMNS))
    return t["lines"]


def customer_name() -> dict:
    return {"customer_name": full_name("customer_first_name", "customer_last_name")}


def wide_table(t: Catalog, verify: bool = False) -> DataFrame:
    return build_wide(s.wide_inputs(t, silver_lines(t)), s.WIDE, customer_name(), verify)


@query("obt")
def obt(t):
    return wide_table(t, verify=True)


def earlier_states(t: Catalog) -> list[dict[str, DataFrame]]:
    """The inputs of the wide table as they were before two loads, and as they are now.

    First orders from the cut on are missing, late lines too, some lines are there that go later, and customers, parts and
    nations have other values; then only amounts and nations differ.
    """
    now = s.wide_inputs(t, silver_lines(t))
    lines = now["lines"]
    gone = lines.filter("quantity < 3").withColumn("line_id", F.col("line_id") + 50)
    more = lines.withColumn("quantity", F.when(F.col("line_amount") > 50_000, F.col("quantity") + 1).otherwise(F.col("quantity")))
    nation = now["nation"].withColumn("n_name", F.when(F.col("n_regionkey") == 0, F.lower("n_name")).otherwise(F.col("n_name")))
    moved = F.when(F.col("c_acctbal") < 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    first = {
        "orders": now["orders"].filter(F.col("o_orderdate") < literal(s.ORDERS_CUT)).withColumn("o_orderstatus", F.lit("O")),
        "lines": more.filter(F.col("l_shipdate") < literal(s.ORDERS_CUT)).unionByName(gone),
        "customer": now["customer"].withColumn("c_nationkey", moved.cast(now["customer"].schema["c_nationkey"].dataType)),
        "part": now["part"].withColumn("p_brand", F.when(F.col("p_size") > 40, "old").otherwise(F.col("p_brand"))),
        "nation": nation,
    }
    return [first, {**now, "lines": more, "nation": nation}, now]


@query("obt_incremental")
def obt_incremental(t):
    """The wide table kept over two loads with changes in every input, lines that come and lines that go."""
    states = earlier_states(t)
    (wide,) = stored(t, wide=lambda _: build_wide(states[0], s.WIDE, customer_name(), verify=False))
    for before, after in zip(states, states[1:]):
        used = {name: used_columns(s.WIDE, name, ["o_orderkey"]) for name in after if after[name] is not before[name]}
        changes = {name: changed_rows(before[name].select(*columns), after[name].select(*columns)) for name, columns in used.items()}
        touched, rows = wide_increment(after, changes, s.WIDE, ["o_orderkey"], customer_name())
        kept = replace_anchors(wide, touched, rows, s.WIDE, ["o_orderkey"])
        (wide,) = stored(t, wide=lambda _: kept)
    return wide


# --- dimensions ----------------------------------------------------------------------------------


def both_calendars(t: Catalog) -> DataFrame:
    return calendar(t.spark, [(t["lineitem"], "l_shipdate"), (t["orders"], "o_orderdate")])


@query("dim_date")
def dim_date(t):
    return both_calendars(t)


@query("dim_supplier")
def dim_supplier(t):
    return scd1(s.delivery_feed(t), "supplier_id", "delivery_date", ["supplier_name"], "supplier_key")


@query("dim_prep")
def dim_prep(t):
    names = {
        "o_orderkey": "order_id", "o_orderpriority": "payment_method", "o_orderstatus": "order_status",
        "o_custkey": "customer_id",
    }
    return prepare(t["orders"], names, "o_orderdate")


@query("dim_prep_products")
def dim_prep_products(t):
    latest = latest_row(s.product_changes(t), "product_id", "changed_at")
    products = t["part"].join(latest, F.col("p_partkey") == F.col("product_id"))
    names = {"product_id": "product_id", "p_name": "product_name", "p_type": "category", "p_brand": "brand", "price": "price"}
    return prepare(products, names, "changed_at")


@query("scd2_rebuild")
def rebuild(t):
    return versions_out(scd2_rebuild(s.event_changes(t), "user_id", "ts"))


@query("scd2_apply")
def apply_snapshots(t):
    dim = DimensionTable(t.spark, scratch_dir(t.spark, "dimension"), "user_id", buckets=8)
    for cut in (s.LATE_CUT, s.EVENTS_CUT, None):
        changes = s.event_changes(t)
        seen = changes if cut is None else changes.filter(F.col("ts") < literal(cut))
        for _ in range(2):  # the second application changes nothing
            dim.snapshot(seen, "ts")
    return versions_out(dim.read())


@query("scd2_late")
def late_changes(t):
    """The changes in three batches, the oldest last and twice; the first makes the dimension."""
    changes, recent = s.event_changes(t), F.col("ts") >= literal(s.LATE_CUT)
    click = F.col("event_type") == "click"
    (dim,) = stored(t, dim=lambda _: scd2_rebuild(changes.filter(recent & ~click), "user_id", "ts"))
    for batch in (click, ~recent, ~recent):
        merged = scd2_late(dim, changes.filter(batch), "user_id", "ts")
        (dim,) = stored(t, dim=lambda _: merged)
    return versions_out(dim)


@query("dim_current")
def dim_current(t):
    return scd2_open(s.product_changes(t), "product_id", "changed_at").select("scd_id", "product_id", "price")


@query("dim_asof")
def dim_asof(t):
    return versions_out(as_of(s.customer_versions(t), s.AS_OF_ORDERS))


@query("snowflake_asof")
def snowflake_asof(t):
    staff = scd2_rebuild(s.staff_changes(t), "employee_id", "changed_at").withColumnRenamed("scd_id", "employee_scd_id")
    stores = s.store_versions(t).withColumnRenamed("scd_id", "store_scd_id")
    return snowflake_as_of(staff, stores, "store_id", s.AS_OF_ORDERS)


@query("snowflake_timeline")
def staff_timeline(t):
    staff, stores = stored(t, staff=lambda c: scd2_rebuild(s.staff_changes(c), "employee_id", "changed_at"), stores=s.store_versions)
    staff, stores = staff.withColumnRenamed("scd_id", "employee_scd_id"), stores.withColumnRenamed("scd_id", "store_scd_id")
    return versions_out(snowflake_timeline(staff, stores, "store_id", "employee_id"))


@query("version_floor")
def floors(t):
    return version_floor(s.product_versions(t), "product_id")

# --- point-in-time joins and facts ---------------------------------------------------------------


def sold_lines(t: Catalog) -> DataFrame:
    """Order lines with the time of their order."""
    orders = t["orders"].select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_timestamp"))
    return s.order_lines(t).join(orders, "order_id")


def product_events(t: Catalog) -> DataFrame:
    return sold_lines(t).select("order_item_id", "product_id", "order_timestamp")


PRODUCT = {"product_id": "product_id"}
PRODUCT_COLUMNS = {"scd_id": "product_scd_id", "price": "price"}
PRODUCT_STARTS = {"valid_from": "product_start", "price": "price"}


def product_pit(t: Catalog, floor: bool, strategy: str | None = None) -> DataFrame:
    (versions,) = stored(t, versions=s.product_versions)
    strategy = strategy or choose_strategy(versions, "product_id")
    events = stored(t, events=product_events)[0] if strategy == "asof" else product_events(t)
    return pit_join(events, versions, PRODUCT, "order_timestamp", PRODUCT_COLUMNS, floor, strategy)


@query("pit_strict")
def pit_strict(t):
    return product_pit(t, False)


@query("pit_floor")
def pit_floor(t):
    return product_pit(t, True)


@query("pit_asof")
def pit_asof(t):
    return product_pit(t, True, "asof")


@query("pit_binned")
def pit_binned(t):
    """Few stores with many versions each: the case for sliced versions."""
    (versions,) = stored(t, versions=s.store_versions)
    events = s.order_headers(t).select("order_id", "store_id", "order_timestamp")
    links, columns = {"store_id": "store_id"}, {"scd_id": "store_scd_id"}
    return pit_join(events, versions, links, "order_timestamp", columns, floor=True, strategy="binned")


@query("pit_closed")
def pit_closed(t):
    events, versions = stored(t, events=product_events, versions=lambda c: s.product_versions(c).drop("scd_id"))
    found = pit_join_closed(events, versions, PRODUCT, "order_timestamp", PRODUCT_STARTS, floor=True)
    # Ids follow from key and start, so the joins carry the start alone.
    scd_id = F.when(F.col("product_start").isNotNull(), version_id(["product_id"], "product_start"))
    return found.select(*events.columns, scd_id.alias("product_scd_id"), "price")


@query("coverage_gap")
def gap(t):
    floor = version_floor(s.product_versions(t), "product_id")
    return coverage_gap(product_events(t), floor, PRODUCT, "order_timestamp")

FACT_COLUMNS = [
    "order_id", "order_item_id", "product_id", "customer_scd_id", "product_scd_id", "store_scd_id",
    "order_scd_id", "order_date_id", "quantity", "line_amount", "total_amount",
]


def fact_links(t: Catalog) -> list[VersionLink]:
    """The dimensions of the fact as stored tables: those of the order first, then the product. Ids follow from key and start."""
    builders = {"orders": s.order_versions, "customers": s.customer_versions, "products": s.product_versions, "stores": s.store_versions}
    orders, customers, products, stores = stored(t, **{name: lambda c, f=f: f(c).drop("scd_id") for name, f in builders.items()})
    return [
        VersionLink("customer_scd_id", customers, {"customer_id": "customer_id"}),
        VersionLink("store_scd_id", stores, {"store_id": "store_id"}),
        VersionLink("order_scd_id", orders, {"order_id": "order_id"}),
        VersionLink("product_scd_id", products, PRODUCT),
    ]


def orders_fact_of(t: Catalog, links: list[VersionLink] | None = None, form=finished) -> DataFrame:
    links = links or fact_links(t)
    return orders_fact(
        s.order_headers(t), s.order_lines(t), "order_id", "order_timestamp", links[:3], links[3:], both_calendars(t), FACT_COLUMNS, form
    )


@query("fact_orders")
def fact_orders(t):
    return orders_fact_of(t)


def bucketed_fact(t: Catalog) -> DataFrame:
    customers, stores, orders, products = fact_links(t)
    inputs = {"headers": s.order_headers(t), "lines": s.order_lines(t), "versions": orders.versions}
    with ThreadPoolExecutor(len(inputs)) as pool:
        headers, lines, versions = pool.map(lambda df: bucketed_table(df, "order_id", 8), inputs.values())
    order_link, links = VersionLink(orders.output, versions, orders.on), [customers, stores, products]
    return orders_fact_bucketed(headers, lines, "order_id", "order_timestamp", order_link, links, both_calendars(t), FACT_COLUMNS)


@query("fact_orders_bucketed")
def fact_orders_bucketed(t):
    """The fact from orders, lines and order versions stored by bucket of the order."""
    return bucketed_fact(t)


@query("fact_orders_incremental")
def fact_orders_incremental(t):
    """The fact kept over three loads: what was shipped and ordered before the cut, the rest, and late shipments.

    It is stored with the starts of versions, which merges move in place of ids; its reader forms the ids."""
    late = shipped_before_cut() & (F.col("l_returnflag") == "R")
    ordered = F.col("o_orderdate") < literal(s.ORDERS_CUT)
    loads = [(shipped_before_cut() & ~late, ordered), (~late, F.lit(True)), (F.lit(True), F.lit(True))]
    month = (F.col("order_date_id") / 100).cast("int")
    fact = StoredTable(t.spark, scratch_dir(t.spark, "fact"), "order_item_id", 4, month, "order_date_id")
    before, shipped, known = None, F.lit(False), F.lit(False)
    for lines, orders in loads:
        now = Catalog(t.spark, {**t.entries, "lineitem": t["lineitem"].filter(lines), "orders": t["orders"].filter(orders)})
        links = fact_links(now)
        if before is None:
            fact.overwrite(orders_fact_of(now, links, with_markers))
        else:
            silver_lines(now)  # read several times below
            changed = [ChangedLink(link, old.versions) for link, old in zip(links, before)]
            new_lines = t["lineitem"].filter(lines & ~shipped).select(s.line_id().alias("order_item_id"))
            new_orders = t["orders"].filter(orders & ~known).select(F.col("o_orderkey").alias("order_id"))
            rows = orders_fact_increment(
                s.order_headers(now), s.order_lines(now), "order_id", "order_item_id", "order_timestamp", changed[:3], changed[3:],
                both_calendars(now), FACT_COLUMNS, new_orders, new_lines, with_markers,
            )
            fact.upsert(rows)
        before, shipped, known = links, lines, orders
    return finished(fact.read(), before, FACT_COLUMNS)


@query("fact_orders_status")
def fact_orders_status(t):
    return with_current(
        sold_lines(t).select("order_id", "order_item_id"), scd2_open(s.order_changes(t), "order_id", "changed_at"),
        {"order_id": "order_id"},
        {"order_status": "current_order_status"},
    )


@query("fact_deliveries")
def fact_deliveries(t):
    rows = latest_row(s.deliveries(t), "delivery_id", "delivery_date")
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("supplier_id"))
    products = scd2_open(s.product_changes(t), "product_id", "changed_at")
    return deliveries_fact(rows, suppliers, products, both_calendars(t))


# --- data quality --------------------------------------------------------------------------------


@query("dq_not_null")
def dq_not_null(t):
    return quality.not_null(wide_table(t), ["order_id", "product_id", "store_id", "customer_id", "order_item_id"])


@query("dq_observed")
def dq_observed(t):
    """Column rules of the wide table, counted while it is written."""
    watch = Watch(["order_id", "product_id", "store_id", "customer_id", "order_item_id"], OBSERVED_RULES)
    wide_table(t).transform(watch).write.parquet(scratch_dir(t.spark, "wide"))
    return watch.violations(t.spark)


@query("dq_unique")
def dq_unique(t):
    return quality.unique(t["lineitem"], s.LINE_KEY)


def loads_by_year(t: Catalog, position) -> tuple[DataFrame, DataFrame]:
    """Lines stored by year of shipping, and the bitmaps of each year, which a load writes beside its rows."""
    root = scratch_dir(t.spark, "loads")
    t["lineitem"].withColumn("load", F.year("l_shipdate")).write.partitionBy("load").parquet(f"{root}/rows")
    rows = t.spark.read.parquet(f"{root}/rows")
    key_bitmaps(rows, position, "load").write.partitionBy("load").parquet(f"{root}/bitmaps")
    return rows, t.spark.read.parquet(f"{root}/bitmaps")


@query("dq_distinct_sketch")
def dq_distinct_sketch(t):
    """The repeats of `dq_unique` over the loads of all years, from the buckets that can hold any."""
    position = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows, bitmaps = loads_by_year(t, position)
    return repeated_keys(rows, bitmaps, s.LINE_KEY, position, "load")


@query("distinct_by_load")
def distinct_by_load(t):
    """Orders and lines over the loads of all years, from their bitmaps."""
    return distinct_positions(loads_by_year(t, F.col("l_orderkey"))[1])


@query("dq_relationship")
def dq_relationship(t):
    """Orders that no line refers to."""
    return quality.relationships(t["orders"], "o_orderkey", t["lineitem"], "l_orderkey")


@query("dq_expression")
def dq_expression(t):
    return quality.expression_is_true(t["lineitem"], ["l_quantity > 0", "l_quantity < 50", "l_discount < 0.05"])


@query("dq_grain")
def dq_grain(t):
    return quality.grain(wide_table(t), silver_lines(t))


@query("dq_fact_grain")
def dq_fact_grain(t):
    """The fact against the raw lines, in which keys repeat."""
    return quality.grain(orders_fact_of(t), t["lineitem"])


@query("dq_distinct_grain")
def dq_distinct_grain(t):
    return quality.distinct_grain(s.order_lines(t), t["lineitem"], "l_orderkey")


@query("dq_join_nulls")
def dq_join_nulls(t):
    broken = quality.null_rows(wide_table(t), ["product_name", "customer_name", "store_name"])
    return broken.select("order_id", "order_item_id", "product_name", "customer_name", "store_name")


@query("dq_counts")
def dq_counts(t):
    lines = silver_lines(t)
    wide, fact = stored(t, wide=wide_table, fact=orders_fact_of)
    tables = {"wide_rows": wide, "line_rows": lines, "fact_rows": fact}
    return quality.count_consistency(tables, "wide_rows <> line_rows OR fact_rows < 1")


@query("dq_gate")
def dq_gate(t):
    silver_lines(t)
    wide, fact = stored(t, wide=wide_table, fact=orders_fact_of)
    scds = ["customer_scd_id", "product_scd_id", "store_scd_id", "order_scd_id"]
    parts = [
        quality.Measures(
            wide, {"wide_null_order": "order_id", "wide_null_line": "order_item_id"},
            "wide_duplicate_line", "order_item_id",
        ),
        quality.Measures(
            fact, {f"fact_null_{c}": c for c in ["order_item_id", *scds]}, "fact_duplicate_line", "order_item_id"
        ),
    ]
    return quality.quality_gate(parts)


@query("dq_freshness")
def dq_freshness(t):
    return quality.freshness(t["events"], "ts", FRESH_NOW, FRESH_LIMIT)


@query("dq_fanout")
def dq_fanout(t):
    return quality.fan_out(t["supplier"], "s_nationkey")


@query("dq_open_versions")
def dq_open_versions(t):
    staff = scd2_rebuild(s.staff_changes(t), "employee_id", "changed_at")
    return quality.open_versions(staff, "store_id")
