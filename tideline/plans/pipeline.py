"""The retail pipeline: ingest, silver, wide table, dimensions, facts, with a gate after each layer."""

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.calendar import calendar
from tideline.operators import quality
from tideline.operators.incremental import newer_than, stamp
from tideline.operators.observed import Watch
from tideline.operators.quality import Check, GateFailed, Measures, Result
from tideline.operators.scd import prepare, scd1
from tideline.operators.wide import build_wide
from tideline.plans import retail
from tideline.plans.facts import VersionLink, deliveries_fact, orders_fact, with_current
from tideline.plans.models import layer_model
from tideline.schemas import PRIMARY_KEY
from tideline.sources.dimension import DimensionTable
from tideline.sources.feed import clean_feed, counted_rejects, stream_feed
from tideline.sources.store import StoredTable
from tideline.streaming.merge import Sink, merge_stream, run_to_end

CI = frozenset({"ci"})
FEED = "supplier_deliveries"
# Tables that exist only where there is a feed.
OF_FEED = {FEED, "dim_supplier", "fact_supplier_deliveries"}
EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Freshness:
    """How old the latest value of a source's cursor may be before the run warns, and before it stops."""

    cursor: str
    warn: timedelta | None = None
    error: timedelta | None = None


# Fixed value: how old the latest feed load may be. Orders come daily, other tables may rest.
DAY = timedelta(hours=25)
FRESHNESS = {
    FEED: Freshness("loaded_at", DAY, 2 * DAY),
    "orders": Freshness(retail.CURSOR, DAY, 7 * DAY),
    "order_items": Freshness(retail.CURSOR, DAY, 7 * DAY),
} | {name: Freshness(retail.CURSOR, 30 * DAY) for name in ("customers", "stores", "products", "employees")}
# Tables that grow with time lie below the month a row was created in, so a batch touches few units.
BY_MONTH = {"orders": "created_timestamp", "order_items": "created_timestamp"}


class RetailPipeline:
    """One run over six source tables and the feed folder, into stored tables below `root`.

    All dimensions are built before any fact. A gate that finds violations stops the run.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        sources: Mapping[str, DataFrame],
        feed: str | None,
        run_ts: datetime,
        buckets: int = 16,
        lookback: timedelta | None = None,
        freshness: Mapping[str, Freshness] = FRESHNESS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sources = sources
        self.feed = feed
        self.run_ts = run_ts
        self.buckets = buckets
        self.lookback = lookback
        self.freshness = freshness
        # Counts of the tables that this run wrote whole.
        self.watched: dict[str, Watch] = {}

    def table(self, layer: str, name: str, key=()) -> StoredTable:
        created = BY_MONTH.get(name) if key else None
        label = F.date_format(created, "yyyyMM") if created else None
        return StoredTable(self.spark, f"{self.root}/{layer}/{name}", key, self.buckets, label, created or ())

    def silver(self, name: str) -> DataFrame:
        return self.table("silver", name).read()

    def gold(self, name: str) -> DataFrame:
        return self.table("gold", name).read()

    def dimension(self, name: str) -> DimensionTable:
        return DimensionTable(self.spark, f"{self.root}/gold/{name}", retail.DIMENSIONS[name].key, self.buckets)

    def refresh(self, layer: str, name: str, df: DataFrame) -> None:
        """Replace a table whole; the write counts its rows and the violations of its declared column rules."""
        declared = (retail.WIDE_TESTS | retail.GOLD_TESTS).get(name, retail.Tests())
        self.watched[name] = Watch(declared.not_null, declared.expressions)
        self.table(layer, name).overwrite(df, self.watched[name])

    @staticmethod
    def _all(step: Callable[[str], None], names) -> None:
        """Run independent jobs side by side; the first error is raised."""
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(step, names))

    # --- layers ------------------------------------------------------------------------------------

    def run(self) -> list[Result]:
        self.ingest()
        results = quality.gate("sources", self.freshness_checks())
        self.build_silver()
        results += self.check(retail.SILVER_TESTS, self.silver, "silver")
        self.build_wide()
        results += self.check(retail.WIDE_TESTS, self.silver, "wide", self.wide_checks())
        self.build_dimensions()
        self.build_facts()
        return results + self.check(retail.GOLD_TESTS, self.gold, "gold", self.gold_checks())

    def ingest(self) -> None:
        def poll(name: str) -> None:
            bronze = self.table("bronze", name, PRIMARY_KEY[name])
            since = bronze.high_water(retail.CURSOR)
            bronze.upsert(newer_than(self.sources[name], retail.CURSOR, since, self.lookback), retail.CURSOR)

        self._all(poll, PRIMARY_KEY)
        if self.feed:
            self.ingest_feed()

    def ingest_feed(self) -> None:
        """Merge newly arrived files; malformed rows go to a reject table."""
        bronze = self.table("bronze", "supplier_deliveries", "delivery_id")
        rejects = self.table("bronze", "supplier_deliveries_rejected", "reject_id")

        def stamped(clean: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
            return lambda raw: clean(raw).withColumn("loaded_at", stamp(self.run_ts))

        sinks = [
            Sink(bronze, ["delivery_date", "source_file"], stamped(clean_feed)),
            Sink(rejects, "source_file", stamped(counted_rejects)),
        ]
        run_to_end(merge_stream(stream_feed(self.spark, self.feed), sinks, f"{self.root}/checkpoints/feed"))

    def build_silver(self) -> None:
        def model(name: str) -> None:
            source, target = (self.table(layer, name, PRIMARY_KEY[name]) for layer in ("bronze", "silver"))
            layer_model(source, target, retail.CURSOR, self.run_ts, self.lookback)

        self._all(model, PRIMARY_KEY)
        # Files arrive by month, so a day can grow after it was loaded: the load stamp is the cursor.
        source, target = (self.table(layer, FEED, "delivery_id") for layer in ("bronze", "silver"))
        layer_model(source, target, "loaded_at", self.run_ts)

    def build_wide(self) -> None:
        tables = {e.table: self.silver(e.table) for e in retail.WIDE}
        derived = retail.wide_derived() | {"wide_processed_at": stamp(self.run_ts)}
        self.refresh("silver", "wide", build_wide(tables, retail.WIDE, derived))

    def build_dimensions(self) -> None:
        def build(name: str) -> None:
            spec = retail.DIMENSIONS[name]
            dim, rows = self.dimension(name), self.silver(spec.source)
            state = dim.state()
            if state is not None and "silver" in state["batches"]:
                # Rows merged since the last snapshot that changed anything, its own run included.
                last = EPOCH + timedelta(microseconds=state["batches"]["silver"])
                rows = rows.filter(F.col("processed_at") >= stamp(last))
            mark = ("silver", (self.run_ts - EPOCH) // timedelta(microseconds=1))
            dim.snapshot(prepare(rows, spec.columns, retail.CURSOR), retail.CURSOR, mark)

        self._all(build, retail.DIMENSIONS)
        dates = [(self.silver("orders"), "order_timestamp")]
        deliveries = self.silver("supplier_deliveries")
        if deliveries is not None:
            dates.append((deliveries, "delivery_date"))
            suppliers = scd1(deliveries, "supplier_id", "delivery_date", ["supplier_name"], "supplier_key")
            self.refresh("gold", "dim_supplier", suppliers)
        self.refresh("gold", "dim_date", calendar(self.spark, dates))
        now = self.dimension("dim_products").read_open().select(*retail.PRODUCTS_CURRENT)
        self.refresh("gold", "dim_products_current", now)

    def build_facts(self) -> None:
        def link(output: str, dim: str) -> VersionLink:
            key = retail.DIMENSIONS[dim].key
            return VersionLink(output, self.gold(dim), {key: key})

        headers = self.silver("orders").select("order_id", "customer_id", "store_id", "order_timestamp", "total_amount")
        lines = self.silver("order_items").select(
            "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_amount"
        )
        fact = orders_fact(
            headers,
            lines,
            "order_id",
            "order_timestamp",
            [
                link("customer_scd_id", "dim_customers"),
                link("store_scd_id", "dim_stores"),
                link("order_scd_id", "dim_orders"),
            ],
            [link("product_scd_id", "dim_products")],
            self.gold("dim_date"),
            retail.FACT_ORDERS,
        )
        status = {"order_status": "current_order_status"}
        fact = with_current(fact, self.dimension("dim_orders").read_open(), {"order_id": "order_id"}, status)
        self.refresh("gold", "fact_orders", fact)
        deliveries = self.silver("supplier_deliveries")
        if deliveries is not None:
            products = self.dimension("dim_products").read_open()
            rows = deliveries_fact(deliveries, self.gold("dim_supplier"), products, self.gold("dim_date"))
            self.refresh("gold", "fact_supplier_deliveries", rows)

    # --- checks ------------------------------------------------------------------------------------

    def check(
        self, tests: Mapping[str, retail.Tests], read: Callable[[str], DataFrame], stage: str, more: list[Check] = ()
    ) -> list[Result]:
        """The declared tests and `more`. A table that was never written fails the gate, but for those of an absent feed."""
        tables = {name: read(name) for name in tests}
        missing = [n for n, df in tables.items() if df is None and not (self.feed is None and n in OF_FEED)]
        if missing:
            raise GateFailed(f"{stage}: never written: {', '.join(missing)}")
        checks = declared_checks(tests, {n: df for n, df in tables.items() if df is not None}, read, self.watched)
        return quality.gate(stage, [*checks, *more])

    def wide_checks(self) -> list[Check]:
        wide, lines = self.silver("wide"), self.silver("order_items")
        names = ["product_name", "customer_name", "store_name"]
        return [
            Check("wide_grain", lambda: quality.grain(wide, lines), tags=CI),
            Check("wide_join_nulls", lambda: quality.null_rows(wide, names), tags=CI),
        ]

    def gold_checks(self) -> list[Check]:
        wide, lines, fact = self.silver("wide"), self.silver("order_items"), self.gold("fact_orders")
        scds = ["customer_scd_id", "product_scd_id", "store_scd_id", "order_scd_id"]
        wide_rows, fact_rows = self.watched["wide"].rows, self.watched["fact_orders"].rows
        parts = [
            Measures(
                wide,
                {"wide_null_order_ids": "order_id", "wide_null_order_item_ids": "order_item_id"},
                "wide_duplicate_order_items",
                "order_item_id",
            ),
            Measures(
                fact, {f"fact_null_{c}": c for c in ["order_item_id", *scds]}, "fact_duplicate_order_items", "order_item_id"
            ),
        ]
        checks = [
            Check("fact_orders_grain", lambda: int(fact_rows != lines.count()), tags=CI),
            Check("row_counts", lambda: int(wide_rows != lines.count() or fact_rows < 1), tags=CI),
            Check("quality_gate", lambda: quality.quality_gate(parts), tags=CI),
        ]
        for name, spec in retail.DIMENSIONS.items():
            dim = self.dimension(name).read_open()
            checks.append(Check(f"{name}_open_versions", lambda d=dim, k=spec.key: quality.open_versions(d, k)))
        return checks

    def freshness_checks(self) -> list[Check]:
        """Each source's latest row must be recent at the time of the run. A source that was never loaded fails its
        checks, but for the feed where there is none."""
        checks = []
        for name, limits in self.freshness.items():
            if name == FEED and self.feed is None:
                continue
            rows = self.table("bronze", name).read()
            for severity, limit in ((quality.WARN, limits.warn), (quality.ERROR, limits.error)):
                if limit is None:
                    continue
                if rows is None:
                    rows = self.spark.createDataFrame([], f"{limits.cursor} timestamp_ntz")
                stale = partial(quality.freshness, rows, limits.cursor, self.run_ts, limit)
                checks.append(Check(f"{name}_fresh_{severity}", stale, severity))
        return checks


def declared_checks(
    tests: Mapping[str, retail.Tests],
    tables: Mapping[str, DataFrame],
    read: Callable[[str], DataFrame],
    watched: Mapping[str, Watch] = {},
) -> list[Check]:
    """The declared tests: one check for all column rules of a table, one per unique or foreign key.

    The column rules of a watched table were counted by its write and need no scan."""
    checks = []
    for name, df in tables.items():
        t = tests[name]
        if name in watched:
            checks.append(Check(f"{name}_columns", lambda w=watched[name]: len(w.broken())))
        else:
            checks.append(Check(f"{name}_columns", lambda df=df, t=t: quality.column_rules(df, t.not_null, t.expressions)))
        for c in t.unique:
            checks.append(Check(f"{name}_{c}_unique", lambda df=df, c=c: quality.unique(df, c)))
        for c, (parent, key) in t.relationships.items():
            checks.append(
                Check(
                    f"{name}_{c}_in_{parent}",
                    lambda df=df, c=c, parent=parent, key=key: quality.relationships(df, c, read(parent), key),
                )
            )
    return checks
