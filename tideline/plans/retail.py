"""The retail model: silver tables, wide table, dimensions, facts and their checks, as declarations."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from tideline.functions import full_name
from tideline.operators.wide import Entry
from tideline.schemas import PRIMARY_KEY

CURSOR = "updated_timestamp"

# --- wide table ----------------------------------------------------------------------------------


def _life_cycle(prefix: str) -> list[tuple[str, str]]:
    names = {"created_timestamp": "created_timestamp", CURSOR: CURSOR, "is_active": "is_active", "processed_at": "processed_at"}
    return [(c, f"{prefix}_{name}") for c, name in names.items()]


def _prefixed(prefix: str, *columns: str) -> list[tuple[str, str]]:
    return [(c, f"{prefix}_{c}") for c in columns]


# Tables, join conditions and column names of the wide table. Lines are joined before
# products, whose condition refers to them.
WIDE = [
    Entry(
        "orders",
        "o",
        ["order_id", "store_id", "customer_id", "order_timestamp", "payment_method", "order_status", "total_amount"]
        + _life_cycle("order"),
    ),
    Entry(
        "customers",
        "c",
        _prefixed("customer", "first_name", "last_name", "email", "phone", "city", "province", "country")
        + _life_cycle("customer"),
        on="o.customer_id = c.customer_id",
        lookup_key=["customer_id"],
    ),
    Entry(
        "order_items",
        "oi",
        ["order_item_id", ("order_id", "order_item_order_id"), "product_id", "quantity", "unit_price", "line_amount"]
        + _life_cycle("order_item"),
        on="o.order_id = oi.order_id",
    ),
    Entry(
        "products",
        "p",
        ["product_name", "category", "brand", "price"] + _life_cycle("product"),
        on="oi.product_id = p.product_id",
        lookup_key=["product_id"],
    ),
    Entry(
        "stores",
        "s",
        [("store_id", "store_store_id"), "store_name"]
        + _prefixed("store", "city", "province", "country")
        + _life_cycle("store"),
        on="o.store_id = s.store_id",
        lookup_key=["store_id"],
    ),
]


def wide_derived() -> dict[str, Column]:
    return {"customer_name": full_name("customer_first_name", "customer_last_name")}


# --- dimensions ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dimension:
    """A type-2 dimension: its silver table, key and attributes (source column to output name)."""

    source: str
    key: str
    columns: Mapping[str, str]


def _names(*columns: str, **renamed: str) -> dict[str, str]:
    return {c: c for c in columns} | renamed


# Keys and attributes of the dimensions.
DIMENSIONS = {
    "dim_customers": Dimension(
        "customers",
        "customer_id",
        _names("customer_id")
        | dict(_prefixed("customer", "first_name", "last_name", "email", "phone", "city", "province", "country", "is_active")),
    ),
    "dim_products": Dimension(
        "products",
        "product_id",
        _names("product_id", "product_name", "category", "brand", "price", is_active="product_is_active"),
    ),
    "dim_stores": Dimension(
        "stores",
        "store_id",
        _names("store_id", "store_name") | dict(_prefixed("store", "city", "province", "country", "is_active")),
    ),
    "dim_orders": Dimension(
        "orders",
        "order_id",
        _names("order_id", "payment_method", "order_status", "order_timestamp", is_active="order_is_active"),
    ),
    "dim_employees": Dimension(
        "employees",
        "employee_id",
        _names("employee_id", "job_title", "salary", "store_id")
        | dict(_prefixed("employee", "first_name", "last_name", "email", "is_active")),
    ),
}

PRODUCTS_CURRENT = ["scd_id", "product_id", "product_name", "category", "brand", "price", "product_is_active"]

FACT_ORDERS = [
    "order_id",
    "order_item_id",
    "product_id",
    "customer_scd_id",
    "product_scd_id",
    "store_scd_id",
    "order_scd_id",
    "order_date_id",
    "quantity",
    "unit_price",
    "line_amount",
    "total_amount",
]

# --- checks --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tests:
    """Declared tests of one table: foreign keys map a column to (parent table, parent column)."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    expressions: list[str] = field(default_factory=list)


def _parent(table: str) -> tuple[str, str]:
    return table, PRIMARY_KEY[table]


# The declared tests per layer and table.
SILVER_TESTS = {
    "customers": Tests(["customer_id", "email"], ["customer_id"]),
    "employees": Tests(["employee_id", "store_id"], ["employee_id"], {"store_id": _parent("stores")}),
    "orders": Tests(
        ["order_id", "customer_id", "store_id"],
        ["order_id"],
        {"customer_id": _parent("customers"), "store_id": _parent("stores")},
        ["total_amount >= 0"],
    ),
    "order_items": Tests(
        ["order_item_id", "product_id", "order_id"],
        ["order_item_id"],
        {"product_id": _parent("products"), "order_id": _parent("orders")},
        ["quantity > 0"],
    ),
    "products": Tests(["product_id", "category"], ["product_id"], {}, ["price > 0"]),
    "stores": Tests(["store_id", "store_name"], ["store_id"]),
    "supplier_deliveries": Tests(
        ["delivery_id", "product_id", "supplier_id", "supplier_name", "delivery_date", "quantity"],
        ["delivery_id"],
        {"product_id": _parent("products")},
        ["quantity > 0"],
    ),
}

WIDE_TESTS = {
    "wide": Tests(
        ["order_id", "product_id", "store_id", "customer_id", "order_item_id", "customer_name"],
        ["order_item_id"],
        {},
        ["total_amount >= 0"],
    )
}

GOLD_TESTS = {
    "dim_date": Tests(
        ["date_id", "calendar_date", "year", "quarter", "month", "day", "is_weekend"], ["date_id", "calendar_date"]
    ),
    "dim_supplier": Tests(["supplier_id", "supplier_name"], ["supplier_id"]),
    "dim_products_current": Tests(
        ["scd_id", "product_id", "product_name", "category", "brand", "price"], ["scd_id", "product_id"]
    ),
    "dim_customers": Tests(["scd_id", "customer_id", "valid_from", "valid_to", "customer_email"], ["scd_id"]),
    "dim_employees": Tests(
        ["scd_id", "employee_id", "store_id", "job_title", "salary", "employee_is_active"], ["scd_id"]
    ),
    "dim_orders": Tests(
        ["scd_id", "order_id", "valid_from", "valid_to", "order_status", "payment_method"], ["scd_id"]
    ),
    "dim_products": Tests(
        ["scd_id", "product_id", "valid_from", "valid_to", "product_name", "category", "brand", "price"], ["scd_id"]
    ),
    "dim_stores": Tests(["scd_id", "store_id", "valid_from", "valid_to", "store_name"], ["scd_id"]),
    "fact_orders": Tests(
        ["order_item_id", "order_id", "customer_scd_id", "product_scd_id", "store_scd_id", "order_scd_id"],
        ["order_item_id"],
    ),
    "fact_supplier_deliveries": Tests(
        ["delivery_id", "supplier_id", "product_scd_id", "delivery_date_id", "quantity", "is_unit_cost_missing"],
        ["delivery_id"],
        {
            "supplier_id": ("dim_supplier", "supplier_id"),
            "product_scd_id": ("dim_products", "scd_id"),
            "delivery_date_id": ("dim_date", "date_id"),
        },
    ),
}
