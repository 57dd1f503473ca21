"""The registered queries as SQL over the same tables, for comparison."""

# Lines: latest row per key, ties broken by the remaining columns in table order.
LINE_TIES = (
    "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, "
    "l_returnflag DESC, l_linestatus DESC"
)


def latest_lines(where: str = "true", extra: str = "") -> str:
    return f"""SELECT * EXCLUDE (rn){extra} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {LINE_TIES}) AS rn
        FROM lineitem WHERE {where}) WHERE rn = 1"""


CUT = "l_shipdate < TIMESTAMP '2000-01-01'"

DELIVERIES = """SELECT 'DEL-' || l_orderkey || '-' || l_linenumber AS delivery_id, l_partkey AS product_id,
    l_suppkey AS supplier_id, CAST(l_shipdate AS DATE) AS delivery_date, CAST(l_quantity AS INTEGER) AS quantity,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(10,2)) END AS unit_cost FROM lineitem"""

FEED = f"""SELECT delivery_id, product_id, CAST(supplier_id AS VARCHAR) AS supplier_id, s_name AS supplier_name,
    delivery_date, quantity, unit_cost, unit_cost IS NULL AS is_unit_cost_missing
    FROM ({DELIVERIES}) LEFT JOIN supplier ON supplier_id = s_suppkey"""

CLEAN_FEED = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY delivery_id ORDER BY
    delivery_date DESC, product_id DESC, supplier_id DESC, supplier_name DESC, quantity DESC,
    unit_cost DESC NULLS LAST) AS rn FROM ({FEED})) WHERE rn = 1"""

WIDE = f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_timestamp,
    o_orderpriority AS payment_method, o_orderstatus AS order_status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
    c_name AS customer_first_name, c_mktsegment AS customer_last_name, c_nationkey AS store_id,
    l_orderkey * 100 + l_linenumber AS order_item_id, l_partkey AS product_id,
    CAST(l_quantity AS INTEGER) AS quantity, l_shipdate AS order_item_updated_timestamp,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS line_amount, p_name AS product_name, p_brand AS brand,
    p_type AS category, n_name AS store_name, c_name || ' ' || c_mktsegment AS customer_name
    FROM orders LEFT JOIN ({latest_lines()}) ON o_orderkey = l_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN nation ON c_nationkey = n_nationkey"""

SOLD = f"SELECT * FROM ({WIDE}) WHERE order_item_id IS NOT NULL"


def versions(changes: str, key: str, at: str, attributes: list[str]) -> str:
    """Row versions: one row per key and time, closed by the next."""
    ties = ", ".join(f"{a} DESC NULLS LAST" for a in attributes)
    return f"""SELECT {key}, {", ".join(attributes)}, md5({key} || '|' || CAST({at} AS VARCHAR)) AS scd_id,
        {at} AS valid_from,
        coalesce(lead({at}) OVER (PARTITION BY {key} ORDER BY {at}), TIMESTAMP '9999-12-31') AS valid_to
        FROM (SELECT *, row_number() OVER (PARTITION BY {key}, {at} ORDER BY {ties}) AS vn FROM ({changes}))
        WHERE vn = 1"""


EVENT_VERSIONS = versions("SELECT user_id, event_type, value, ts FROM events", "user_id", "ts", ["event_type", "value"])
CUSTOMER_VERSIONS = versions(
    "SELECT o_custkey AS customer_id, o_orderpriority AS priority, o_orderdate AS changed_at FROM orders",
    "customer_id", "changed_at", ["priority"],
)
PRODUCT_VERSIONS = versions(
    "SELECT l_partkey AS product_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_shipdate AS changed_at FROM lineitem",
    "product_id", "changed_at", ["price"],
)
ORDER_VERSIONS = versions(
    "SELECT l_orderkey AS order_id, l_linestatus AS order_status, l_shipdate AS changed_at FROM lineitem",
    "order_id", "changed_at", ["order_status"],
)
STORE_VERSIONS = versions(
    "SELECT c_nationkey AS store_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS changed_at, "
    "count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
    "store_id", "changed_at", ["n_orders"],
)
STAFF_VERSIONS = versions(
    "SELECT s_suppkey AS employee_id, s_nationkey AS store_id, s_name AS employee_name, n_lines, changed_at FROM "
    "(SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS changed_at, count(*) AS n_lines "
    "FROM lineitem GROUP BY 1, 2) JOIN supplier ON l_suppkey = s_suppkey",
    "employee_id", "changed_at", ["store_id", "employee_name", "n_lines"],
)


def shown(sql: str) -> str:
    return f"SELECT * REPLACE (CAST(valid_to AS VARCHAR) AS valid_to) FROM ({sql})"


def pit(versions_sql: str, key: str, outputs: str, floor: bool, events: str, closed: bool = False) -> str:
    """Range join; with floor, events before the first version of a key take that version."""
    before = "OR (e.order_timestamp < v.first_from AND v.valid_from = v.first_from)" if floor else ""
    return f"""SELECT e.*, {outputs} FROM ({events}) e LEFT JOIN
        (SELECT *, min(valid_from) OVER (PARTITION BY {key}) AS first_from FROM ({versions_sql})) v
        ON e.{key} = v.{key} AND ((e.order_timestamp >= v.valid_from AND e.order_timestamp {"<=" if closed else "<"} v.valid_to) {before})"""


EVENTS = f"SELECT order_item_id, product_id, order_timestamp FROM ({SOLD})"
PIT_OUT = "v.scd_id AS product_scd_id, v.price AS price"

CALENDAR = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS calendar_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, CAST(weekofyear(d) AS INTEGER) AS week_of_year
    FROM (SELECT CAST(unnest(generate_series(lo - 30, hi + 30, INTERVAL 1 DAY)) AS DATE) AS d FROM (
        SELECT min(lo) AS lo, max(hi) AS hi FROM (
            SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem
            UNION ALL SELECT CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) FROM orders)))"""

_F = SOLD
for _sql, _key, _out in [
    (ORDER_VERSIONS, "order_id", "order_scd_id"),
    (CUSTOMER_VERSIONS, "customer_id", "customer_scd_id"),
    (PRODUCT_VERSIONS, "product_id", "product_scd_id"),
    (STORE_VERSIONS, "store_id", "store_scd_id"),
]:
    _F = pit(_sql, _key, f"v.scd_id AS {_out}", True, _F)
FACT = f"""SELECT order_id, order_item_id, product_id, customer_scd_id, product_scd_id, store_scd_id, order_scd_id,
    date_id AS order_date_id, quantity, line_amount, total_amount
    FROM ({_F}) LEFT JOIN ({CALENDAR}) ON CAST(strftime(order_timestamp, '%Y%m%d') AS INTEGER) = date_id"""

SNAPSHOT_TIMES = " UNION ".join(
    f"SELECT user_id, max(ts) AS ts FROM events WHERE {w} GROUP BY user_id"
    for w in ("ts < TIMESTAMP '2024-01-10'", "ts < TIMESTAMP '2024-01-20'", "true")
)

ORACLES = {
    "feed_batch": FEED,
    "feed_rejects": f"""SELECT CASE WHEN n <> 3 THEN delivery_id END AS delivery_id, CAST(supplier_id AS VARCHAR) AS supplier_id,
        CASE n WHEN 1 THEN 'fields' WHEN 2 THEN 'fields' WHEN 3 THEN 'delivery_id' WHEN 4 THEN 'delivery_date'
            ELSE 'quantity_received' END AS reason,
        CASE n WHEN 1 THEN delivery_id || ',' || supplier_id
            WHEN 2 THEN concat_ws(',', delivery_id, supplier_id, s_name, product_id, delivery_date, quantity,
                coalesce(CAST(unit_cost AS VARCHAR), ''), '9') END AS line
        FROM (SELECT *, CAST(string_split(delivery_id, '-')[3] AS INTEGER) AS n FROM ({DELIVERIES}))
        LEFT JOIN supplier ON supplier_id = s_suppkey WHERE n <= 5""",
    "feed_clean": CLEAN_FEED,
    "feed_stream": CLEAN_FEED,
    "stream_dedup": "SELECT * FROM events",
    "stream_dedup_window": "SELECT * FROM events",
    "stream_dedup_state": "SELECT * FROM events",
    "late_rows": "SELECT * FROM events",
    "extract_since": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC, {LINE_TIES.replace("l_quantity", "l_linenumber DESC, l_quantity")}) AS rn
        FROM lineitem WHERE l_shipdate > TIMESTAMP '2000-01-01') WHERE rn = 1""",
    "extract_stream": latest_lines(),
    "insert_if_absent": f"""WITH a AS ({latest_lines(CUT)}), b AS ({latest_lines()})
        SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (
            SELECT 1 FROM a WHERE a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "latest_row": latest_lines(),
    "incremental_filter": """SELECT * FROM events
        WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE ts < TIMESTAMP '2024-01-20')""",
    "high_water": """SELECT 'events' AS target, max(ts) AS high_water FROM events
        UNION ALL SELECT 'nothing', TIMESTAMP '1900-01-01'""",
    "incremental_model": latest_lines(
        extra=f", CASE WHEN {CUT} THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS processed_at"
    ),
    "upsert": latest_lines(),
    "upsert_replace": f"""WITH newer AS ({latest_lines(f"NOT ({CUT})")}), older AS ({latest_lines(CUT)})
        SELECT * FROM older UNION ALL SELECT * FROM newer WHERE (l_orderkey, l_linenumber) NOT IN (
            SELECT (l_orderkey, l_linenumber) FROM older)""",
    "distinct_rows": "SELECT DISTINCT o_custkey, o_orderpriority FROM orders",
    "obt": WIDE,
    "obt_incremental": WIDE,
    "dim_date": CALENDAR,
    "dim_supplier": "SELECT s_suppkey AS supplier_key, s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier "
    "WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)",
    "dim_prep": "SELECT o_orderkey AS order_id, o_orderpriority AS payment_method, o_orderstatus AS order_status, "
    "o_custkey AS customer_id, o_orderdate FROM orders",
    "dim_prep_products": """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
        price, changed_at FROM part JOIN (SELECT l_partkey, l_shipdate AS changed_at,
            CAST(l_extendedprice AS DECIMAL(12,2)) AS price, row_number() OVER (PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn FROM lineitem) ON p_partkey = l_partkey AND rn = 1""",
    "scd2_rebuild": shown(EVENT_VERSIONS),
    "scd2_apply": shown(
        versions(
            f"SELECT user_id, event_type, value, ts FROM events JOIN ({SNAPSHOT_TIMES}) USING (user_id, ts)",
            "user_id", "ts", ["event_type", "value"],
        )
    ),
    "scd2_late": shown(EVENT_VERSIONS),
    "snowflake_timeline": f"""WITH e AS ({STAFF_VERSIONS}), s AS ({STORE_VERSIONS}),
        pieces AS (SELECT e.*, s.n_orders, s.scd_id AS store_scd_id, greatest(e.valid_from, s.valid_from) AS lo, least(e.valid_to, s.valid_to) AS hi
            FROM e JOIN s ON e.store_id = s.store_id AND s.valid_from < e.valid_to AND s.valid_to > e.valid_from
            UNION ALL SELECT e.*, NULL, NULL, e.valid_from, least(e.valid_to, coalesce(lo, e.valid_to))
            FROM e LEFT JOIN (SELECT store_id, min(valid_from) AS lo FROM s GROUP BY 1) f ON e.store_id = f.store_id
            WHERE lo IS NULL OR e.valid_from < lo)
        SELECT employee_id, store_id, employee_name, n_lines, scd_id AS employee_scd_id, n_orders, store_scd_id, lo AS valid_from,
            CAST(hi AS VARCHAR) AS valid_to FROM pieces""",
    "dim_current": f"SELECT scd_id, product_id, price FROM ({PRODUCT_VERSIONS}) WHERE valid_to = TIMESTAMP '9999-12-31'",
    "dim_asof": shown(
        f"SELECT * FROM ({CUSTOMER_VERSIONS}) WHERE valid_from <= TIMESTAMP '1998-06-01' AND valid_to > TIMESTAMP '1998-06-01'"
    ),
    "snowflake_asof": f"""SELECT e.employee_id, e.store_id, e.employee_name, e.n_lines, e.scd_id AS employee_scd_id,
        s.n_orders, s.scd_id AS store_scd_id FROM ({STAFF_VERSIONS}) e LEFT JOIN (SELECT * FROM ({STORE_VERSIONS})
            WHERE valid_from <= TIMESTAMP '1998-06-01' AND valid_to > TIMESTAMP '1998-06-01') s ON e.store_id = s.store_id
        WHERE e.valid_from <= TIMESTAMP '1998-06-01' AND e.valid_to > TIMESTAMP '1998-06-01'""",
    "version_floor": f"SELECT product_id, min(valid_from) AS earliest_valid_from FROM ({PRODUCT_VERSIONS}) GROUP BY 1",
    "pit_strict": pit(PRODUCT_VERSIONS, "product_id", PIT_OUT, False, EVENTS),
    "pit_floor": pit(PRODUCT_VERSIONS, "product_id", PIT_OUT, True, EVENTS),
    "pit_asof": pit(PRODUCT_VERSIONS, "product_id", PIT_OUT, True, EVENTS),
    "pit_binned": pit(
        STORE_VERSIONS, "store_id", "v.scd_id AS store_scd_id", True,
        "SELECT o_orderkey AS order_id, c_nationkey AS store_id, o_orderdate AS order_timestamp FROM orders "
        "LEFT JOIN customer ON o_custkey = c_custkey",
    ),
    "pit_closed": pit(PRODUCT_VERSIONS, "product_id", PIT_OUT, True, EVENTS, closed=True),
    "coverage_gap": f"""WITH f AS (SELECT l_partkey AS product_id, min(l_shipdate) AS low FROM lineitem GROUP BY 1)
        SELECT count(*) AS n_events, count(*) FILTER (order_timestamp < low) AS before_own_floor,
        count(*) FILTER (order_timestamp < (SELECT min(low) FROM f)) AS before_global_floor
        FROM ({EVENTS}) LEFT JOIN f USING (product_id)""",
    "fact_orders": FACT,
    "fact_orders_bucketed": FACT,
    "fact_orders_incremental": FACT,
    "fact_orders_status": f"""SELECT e.order_id, e.order_item_id, v.order_status AS current_order_status
        FROM ({SOLD}) e LEFT JOIN (SELECT * FROM ({ORDER_VERSIONS}) WHERE valid_to = TIMESTAMP '9999-12-31') v
        ON e.order_id = v.order_id""",
    "fact_deliveries": f"""SELECT delivery_id, s_suppkey AS supplier_id, scd_id AS product_scd_id,
        date_id AS delivery_date_id, quantity, unit_cost, unit_cost IS NULL AS is_unit_cost_missing,
        CAST(quantity * unit_cost AS DECIMAL(21,2)) AS delivery_amount
        FROM (SELECT *, row_number() OVER (PARTITION BY delivery_id ORDER BY delivery_date DESC, supplier_id DESC,
            product_id DESC, quantity DESC, unit_cost DESC NULLS LAST) AS rn FROM ({DELIVERIES})) d
        LEFT JOIN supplier ON supplier_id = s_suppkey
        LEFT JOIN (SELECT * FROM ({PRODUCT_VERSIONS}) WHERE valid_to = TIMESTAMP '9999-12-31') v ON d.product_id = v.product_id
        LEFT JOIN ({CALENDAR}) ON CAST(strftime(delivery_date, '%Y%m%d') AS INTEGER) = date_id WHERE rn = 1""",
    "dq_not_null": f"""SELECT * FROM (
        {" UNION ALL ".join(f"SELECT '{c}' AS rule, count(*) AS n_rows FROM ({WIDE}) WHERE {c} IS NULL"
            for c in ("order_id", "product_id", "store_id", "customer_id", "order_item_id"))}) WHERE n_rows > 0""",
    "dq_observed": f"""SELECT * FROM (
        {" UNION ALL ".join(f"SELECT '{c} is not null' AS rule, count(*) AS n_rows FROM ({WIDE}) WHERE {c} IS NULL"
            for c in ("order_id", "product_id", "store_id", "customer_id", "order_item_id"))} UNION ALL
        {" UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) AS n_rows FROM ({WIDE}) WHERE NOT ({r})"
            for r in ("total_amount >= 1000", "quantity < 50", "store_id >= 0"))}) WHERE n_rows > 0""",
    "dq_unique": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "dq_distinct_sketch": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "distinct_by_load": "SELECT count(DISTINCT l_orderkey) AS n_keys, count(l_orderkey) AS n_rows FROM lineitem",
    "dq_relationship": """SELECT o_orderkey, count(*) AS n_rows FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""",
    "dq_expression": " UNION ALL ".join(
        f"SELECT '{r}' AS rule, count(*) AS n_rows FROM lineitem WHERE NOT ({r}) HAVING count(*) > 0"
        for r in ("l_quantity > 0", "l_quantity < 50", "l_discount < 0.05")
    ),
    "dq_grain": f"""SELECT * FROM (SELECT (SELECT count(*) FROM ({WIDE})) AS output_rows,
        (SELECT count(*) FROM ({latest_lines()})) AS source_rows) WHERE output_rows <> source_rows""",
    "dq_fact_grain": f"""SELECT * FROM (SELECT (SELECT count(*) FROM ({FACT})) AS output_rows,
        (SELECT count(*) FROM lineitem) AS source_rows) WHERE output_rows <> source_rows""",
    "dq_distinct_grain": f"""SELECT * FROM (SELECT (SELECT count(*) FROM ({latest_lines()})) AS output_rows,
        (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS source_keys) WHERE output_rows <> source_keys""",
    "dq_join_nulls": f"""SELECT order_id, order_item_id, product_name, customer_name, store_name FROM ({WIDE})
        WHERE product_name IS NULL OR customer_name IS NULL OR store_name IS NULL""",
    "dq_counts": f"""SELECT * FROM (SELECT (SELECT count(*) FROM ({WIDE})) AS wide_rows,
        (SELECT count(*) FROM ({latest_lines()})) AS line_rows, (SELECT count(*) FROM ({FACT})) AS fact_rows)
        WHERE wide_rows <> line_rows OR fact_rows < 1""",
    "dq_gate": f"""WITH w AS ({WIDE}), f AS ({FACT}), m AS (SELECT
        (SELECT count(*) FROM w WHERE order_id IS NULL) AS wide_null_order,
        (SELECT count(*) FROM w WHERE order_item_id IS NULL) AS wide_null_line,
        (SELECT count(*) FROM (SELECT 1 FROM w GROUP BY order_item_id HAVING count(*) > 1)) AS wide_duplicate_line,
        {" ".join(f"(SELECT count(*) FROM f WHERE {c} IS NULL) AS fact_null_{c}," for c in
            ("order_item_id", "customer_scd_id", "product_scd_id", "store_scd_id", "order_scd_id"))}
        (SELECT count(*) FROM (SELECT 1 FROM f GROUP BY order_item_id HAVING count(*) > 1)) AS fact_duplicate_line)
        SELECT * FROM m WHERE wide_null_order + wide_null_line + wide_duplicate_line + fact_null_order_item_id +
            fact_null_customer_scd_id + fact_null_product_scd_id + fact_null_store_scd_id + fact_null_order_scd_id +
            fact_duplicate_line > 0""",
    "dq_freshness": """SELECT max(ts) AS latest FROM events
        HAVING max(ts) IS NULL OR max(ts) < TIMESTAMP '2024-02-05' - INTERVAL 25 HOUR""",
    "dq_fanout": "SELECT s_nationkey, count(*) AS n_rows FROM supplier GROUP BY 1 HAVING count(*) > 1",
    "dq_open_versions": f"""SELECT store_id, count(*) AS n_rows FROM ({STAFF_VERSIONS})
        WHERE valid_to = TIMESTAMP '9999-12-31' GROUP BY 1 HAVING count(*) > 1""",
}
