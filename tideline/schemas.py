"""Fixed schemas of the source tables and the feed."""

# The six source tables. Every table also has the three life-cycle columns.
LIFE_CYCLE = "created_timestamp timestamp_ntz, updated_timestamp timestamp_ntz, is_active string"

SOURCE_TABLES = {
    "customers": "customer_id bigint, first_name string, last_name string, email string, phone string, "
    "city string, province string, country string, " + LIFE_CYCLE,
    "stores": "store_id bigint, store_name string, city string, province string, country string, " + LIFE_CYCLE,
    "products": "product_id bigint, product_name string, category string, brand string, price decimal(10,2), "
    + LIFE_CYCLE,
    "employees": "employee_id bigint, store_id bigint, first_name string, last_name string, email string, "
    "job_title string, salary decimal(10,2), " + LIFE_CYCLE,
    "orders": "order_id bigint, customer_id bigint, store_id bigint, order_timestamp timestamp_ntz, "
    "payment_method string, order_status string, total_amount decimal(12,2), " + LIFE_CYCLE,
    "order_items": "order_item_id bigint, order_id bigint, product_id bigint, quantity int, "
    "unit_price decimal(10,2), line_amount decimal(12,2), " + LIFE_CYCLE,
}

PRIMARY_KEY = {
    "customers": "customer_id",
    "stores": "store_id",
    "products": "product_id",
    "employees": "employee_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}

# The columns of the supplier feed.
FEED_COLUMNS = [
    "delivery_id",
    "supplier_id",
    "supplier_name",
    "product_id",
    "delivery_date",
    "quantity_received",
    "unit_cost",
]
