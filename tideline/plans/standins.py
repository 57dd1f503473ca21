"""The retail roles played by the TPC-H-like test tables."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.latest import latest_row
from tideline.operators.scd import scd2_rebuild
from tideline.operators.wide import Entry
from tideline.sources.catalog import Catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
# What the wide table and the fact take from a line.
LINE_COLUMNS = [*LINE_KEY, "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]

# Instants used to simulate batches and to look at dimensions.
EVENTS_CUT = datetime(2024, 1, 20)
LATE_CUT = datetime(2024, 1, 10)
ORDERS_CUT = datetime(2000, 1, 1)
AS_OF_ORDERS = datetime(1998, 6, 1)

MONEY = "decimal(12,2)"


def tables(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog.of_folder(spark, sf_dir, TABLES)


def line_id() -> Column:
    """One number per order line; null where the order has no line."""
    return F.col("l_orderkey") * 100 + F.col("l_linenumber")


def lines(t: Catalog, columns: list[str] | None = None) -> DataFrame:
    """Latest row per order line."""
    return latest_row(t["lineitem"], LINE_KEY, "l_shipdate", columns=columns)


def deliveries(t: Catalog) -> DataFrame:
    """All delivery rows as the supplier feed reports them, typed; ids repeat."""
    cost = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice").cast("decimal(10,2)"))
    return t["lineitem"].select(
        F.format_string("DEL-%d-%d", "l_orderkey", "l_linenumber").alias("delivery_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("delivery_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        cost.alias("unit_cost"),
    )


def delivery_feed(t: Catalog) -> DataFrame:
    """The same rows with the columns of the CSV feed."""
    named = deliveries(t).join(
        t["supplier"].select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name")),
        "supplier_id",
        "left",
    )
    return named.select(
        "delivery_id", "supplier_id", "supplier_name", "product_id", "delivery_date",
        F.col("quantity").alias("quantity_received"), "unit_cost",
    )


# --- change logs: a natural key, attributes, and the time of the change --------------------------


def event_changes(t: Catalog) -> DataFrame:
    return t["events"].select("user_id", "event_type", "value", "ts")


def customer_changes(t: Catalog) -> DataFrame:
    return t["orders"].select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("changed_at"),
    )


def product_changes(t: Catalog) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_shipdate").alias("changed_at"),
    )


def order_changes(t: Catalog) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linestatus").alias("order_status"),
        F.col("l_shipdate").alias("changed_at"),
    )


def store_changes(t: Catalog) -> DataFrame:
    """One change per store and month: the number of orders, reduced before any key-wise work."""
    joined = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    return joined.groupBy(F.col("c_nationkey").alias("store_id"), month.alias("changed_at")).agg(
        F.count("*").alias("n_orders")
    )


def staff_changes(t: Catalog) -> DataFrame:
    """Suppliers as staff of a store, changing with every shipping month."""
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    worked = t["lineitem"].groupBy("l_suppkey", month.alias("changed_at")).agg(F.count("*").alias("n_lines"))
    staff = t["supplier"].select("s_suppkey", F.col("s_nationkey").alias("store_id"), "s_name")
    return worked.join(staff, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("employee_id"), "store_id", F.col("s_name").alias("employee_name"), "n_lines", "changed_at"
    )


def customer_versions(t: Catalog) -> DataFrame:
    return scd2_rebuild(customer_changes(t), "customer_id", "changed_at")


def product_versions(t: Catalog) -> DataFrame:
    return scd2_rebuild(product_changes(t), "product_id", "changed_at")


def order_versions(t: Catalog) -> DataFrame:
    return scd2_rebuild(order_changes(t), "order_id", "changed_at")


def store_versions(t: Catalog) -> DataFrame:
    return scd2_rebuild(store_changes(t), "store_id", "changed_at")


# --- the wide table ------------------------------------------------------------------------------

WIDE = [
    Entry("orders", "o", [
        ("o_orderkey", "order_id"), ("o_custkey", "customer_id"), ("o_orderdate", "order_timestamp"),
        ("o_orderpriority", "payment_method"), ("o_orderstatus", "order_status"), ("total_amount", "total_amount"),
    ]),
    Entry("lines", "oi", [
        ("line_id", "order_item_id"), ("l_partkey", "product_id"), ("quantity", "quantity"),
        ("l_shipdate", "order_item_updated_timestamp"), ("line_amount", "line_amount"),
    ], on="o.o_orderkey = oi.l_orderkey"),
    Entry("customer", "c", [
        ("c_name", "customer_first_name"), ("c_mktsegment", "customer_last_name"), ("c_nationkey", "store_id"),
    ], on="o.o_custkey = c.c_custkey", lookup_key=["c_custkey"]),
    Entry("part", "p", [("p_name", "product_name"), ("p_brand", "brand"), ("p_type", "category")],
          on="oi.l_partkey = p.p_partkey", lookup_key=["p_partkey"]),
    Entry("nation", "s", [("n_name", "store_name")], on="c.c_nationkey = s.n_nationkey", lookup_key=["n_nationkey"]),
]


def order_lines(t: Catalog) -> DataFrame:
    """Latest lines under the names of the fact, from the stored ones where a query keeps them."""
    latest = t["lines"] if "lines" in t.entries else lines(t, LINE_COLUMNS)
    return latest.select(
        line_id().alias("order_item_id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast(MONEY).alias("line_amount"),
    )


def order_headers(t: Catalog) -> DataFrame:
    """Orders with their customer's store."""
    joined = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("store_id"), F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
    )


def wide_inputs(t: Catalog, latest_lines: DataFrame) -> dict[str, DataFrame]:
    slim = latest_lines.select(
        line_id().alias("line_id"), "l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"),
        "l_shipdate", F.col("l_extendedprice").cast(MONEY).alias("line_amount"),
    )
    orders = t["orders"].withColumn("total_amount", F.col("o_totalprice").cast(MONEY))
    return {"orders": orders, "lines": slim, "customer": t["customer"], "part": t["part"], "nation": t["nation"]}
