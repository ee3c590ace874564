"""DuckDB statements of the registered queries (the driver's correctness oracle).

They restate, in plain SQL over the driver's views, the adapter mapping of
``strata.sources.adapters`` and the reference's model SQL.  Spark-specific results are spelled
out so that both engines agree exactly:

* ``initcap``: DuckDB has none; words split on single spaces, first letter upper, rest lower.
* ``round(avg(decimal(p,2)), 2)``: Spark's average is decimal with scale 6 (half-up), then
  rounded half-up to 2 — computed here in integer cents.
* ``round(decimal / bigint, 2)``: half-up of the exact quotient, in integer cents.
* ``round(double, 2)``: Spark rounds the shortest decimal form of the double half-up; done here
  on the ``VARCHAR`` form of the double.
* Spark types are matched with explicit casts (``sum`` of int is HUGEINT in DuckDB, etc.).
"""

from __future__ import annotations

from collections.abc import Sequence

# Fixed values shared with the Spark side (mirrors of strata.sources.adapters).
T1, T2, T3 = (f"TIMESTAMP '{t}'" for t in ("1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"))
LTV_AS_OF = "DATE '2001-08-02'"
SINCE = "TIMESTAMP '2000-01-01 00:00:00'"
CUTOFF = "TIMESTAMP '2000-01-01 00:00:00'"


def initcap(x: str) -> str:
    """Spark's ``initcap`` in DuckDB: split on single spaces, upper first letter, lower the rest."""
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform("
        f"string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END)"
    )


def spark_round_avg_cents(x: str, target: str) -> str:
    """Spark ``round(avg(x), 2)`` for a non-negative decimal(p,2) column, as a decimal."""
    s = f"sum(CAST({x} * 100 AS HUGEINT))"
    c = f"CAST(count({x}) AS HUGEINT)"
    a6 = f"((2 * {s} * 10000 + {c}) // (2 * {c}))"
    cents = f"((2 * {a6} + 10000) // 20000)"
    return f"CAST(CAST({cents} AS DECIMAL(38,0)) * 0.01 AS {target})"


def half_up_div_cents(num: str, den: str, target: str) -> str:
    """Half-up ``round(num / den, 2)`` for a non-negative decimal(p,2) ``num`` and positive ``den``."""
    s = f"CAST({num} * 100 AS HUGEINT)"
    c = f"CAST({den} AS HUGEINT)"
    cents = f"((2 * {s} + {c}) // (2 * {c}))"
    return f"CAST(CAST({cents} AS DECIMAL(38,0)) * 0.01 AS {target})"


def spark_round_double(x: str) -> str:
    """Spark's ``round(double, 2)``: half-up on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), 2) AS DOUBLE)"


def latest(src: str, key: str, order_col: str, cols: Sequence[str]) -> str:
    """Keep-latest per key with the same deterministic tie-break as ``keep_latest``."""
    ties = [c for c in cols if c not in (key, order_col)]
    order = ", ".join(f"{c} DESC" for c in (order_col, *ties))
    return f"(SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


SIGNUP = "CAST(DATE '1990-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS TIMESTAMP)"


def b_customers(run: int) -> str:
    """The Bronze customers mapping (``run`` 2 = the changed extract), as in the adapters."""
    city = "n.n_name"
    where = ""
    if run == 2:
        city = "CASE WHEN c.c_mktsegment = 'MACHINERY' THEN n.n_name || ' NEW' ELSE n.n_name END"
        where = "WHERE coalesce(c.c_acctbal >= 0, true)"
    return f"""SELECT c.c_custkey AS customer_id,
        '  ' || upper(c.c_name) || ' ' AS first_name,
        c.c_mktsegment || '  ' AS last_name,
        c.c_name || '@EXAMPLE.COM' AS email,
        CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') END AS phone,
        CAST(c.c_custkey AS VARCHAR) || ' Main St' AS address_line,
        {city} AS city,
        r.r_name AS state,
        n.n_name AS country,
        CASE WHEN c.c_nationkey % 4 = 0 THEN NULL ELSE lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') END AS postal_code,
        {SIGNUP} AS signup_date,
        c.c_acctbal >= 0 AS is_active,
        {SIGNUP} AS created_at,
        {SIGNUP} AS updated_at
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    {where}"""


def b_products(run: int) -> str:
    """The Bronze products mapping (``run`` 2 = the changed extract), as in the adapters."""
    price = "CAST(p_retailprice AS DECIMAL(10,2))"
    stock = "CAST(p_size * 3 - 20 AS INTEGER)"
    discontinued = "p_size > 45"
    if run == 2:
        discontinued = "(p_size > 45 OR p_size = 20)"
        price = f"CASE WHEN p_size <= 10 THEN CAST({price} + 10 AS DECIMAL(10,2)) ELSE {price} END"
        stock = f"CASE WHEN p_type = 'PROMO' THEN {stock} + 7 ELSE {stock} END"
    return f"""SELECT p_partkey AS product_id,
        p_name || ' ' AS product_name,
        p_type AS category,
        CASE WHEN p_size % 10 = 0 THEN NULL ELSE lower(p_type) || '_DEPT ' END AS sub_category,
        p_brand AS brand,
        {price} AS price,
        {stock} AS stock_qty,
        {discontinued} AS is_discontinued,
        TIMESTAMP '1995-01-01 00:00:00' AS created_at,
        TIMESTAMP '1995-01-01 00:00:00' AS updated_at
    FROM part"""


ORDER_COLS_SQL = """o_orderkey AS order_id,
        o_custkey AS customer_id,
        o_orderdate AS order_date,
        CASE WHEN o_orderpriority = '5-LOW' THEN ' cancelled '
             WHEN o_orderstatus = 'F' THEN 'Delivered'
             WHEN o_orderstatus = 'O' THEN 'shipped'
             ELSE 'PENDING' END AS status,
        CASE WHEN o_orderkey % 3 = 0 THEN ' san francisco'
             WHEN o_orderkey % 3 = 1 THEN 'NEW YORK '
             ELSE NULL END AS shipping_city,
        'US' AS shipping_country,
        CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
        o_orderdate AS created_at,
        o_orderdate AS updated_at"""

CUSTOMER_COLS = (
    "customer_id first_name last_name email phone address_line city state country "
    "postal_code signup_date is_active created_at updated_at"
).split()
PRODUCT_COLS = "product_id product_name category sub_category brand price stock_qty is_discontinued created_at updated_at".split()
ORDER_COLS = "order_id customer_id order_date status shipping_city shipping_country total_amount created_at updated_at".split()
PAYMENT_COLS = "payment_id order_id amount method status paid_at created_at updated_at".split()
CUSTOMER_SNAP = (
    "customer_id first_name last_name email phone address_line city state country postal_code "
    "signup_date is_active updated_at"
).split()
CUSTOMER_CHECK = "first_name last_name email phone address_line city state country postal_code is_active".split()
PRODUCT_SNAP = "product_id product_name category sub_category brand price stock_qty is_discontinued updated_at".split()
PRODUCT_CHECK = "product_name category sub_category brand price is_discontinued".split()


def snapshot_run(hist: str | None, extract: str, key: str, cols: Sequence[str], check: Sequence[str], t: str) -> str:
    """One check-strategy snapshot run in SQL (full outer join of open versions and extract)."""
    scd = f"sha256(CAST({key} AS VARCHAR) || '|' || strftime(dbt_valid_from, '%Y-%m-%d %H:%M:%S.%f'))"
    col_list = ", ".join(cols)
    if hist is None:
        return (
            f"SELECT {col_list}, {scd} AS dbt_scd_id, dbt_valid_from, dbt_valid_to FROM "
            f"(SELECT {col_list}, {t} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM {extract})"
        )
    changed = " OR ".join(f"h.{c} IS DISTINCT FROM e.{c}" for c in check)
    h_cols = ", ".join(f"h.{c} AS {c}" for c in cols)
    e_cols = ", ".join(f"e.{c} AS {c}" for c in cols)
    return f"""SELECT {col_list}, dbt_scd_id, dbt_valid_from, dbt_valid_to FROM {hist} WHERE dbt_valid_to IS NOT NULL
    UNION ALL
    SELECT {h_cols}, h.dbt_scd_id, h.dbt_valid_from,
           CASE WHEN e.{key} IS NULL OR ({changed}) THEN {t} ELSE h.dbt_valid_to END AS dbt_valid_to
    FROM (SELECT * FROM {hist} WHERE dbt_valid_to IS NULL) h
    LEFT JOIN {extract} e ON h.{key} = e.{key}
    UNION ALL
    SELECT {col_list}, {scd} AS dbt_scd_id, dbt_valid_from, dbt_valid_to FROM (
        SELECT {e_cols}, {t} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
        FROM {extract} e
        LEFT JOIN (SELECT * FROM {hist} WHERE dbt_valid_to IS NULL) h ON h.{key} = e.{key}
        WHERE h.{key} IS NULL OR ({changed}))"""


# --- named CTEs with their dependencies ----------------------------------------------------------
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, deps: Sequence[str] = ()) -> None:
    """Register a named CTE and the CTEs it reads."""
    CTES[name] = (body, tuple(deps))


cte("b_customers", b_customers(1))
cte("b_customers_r2", b_customers(2))
cte("b_products", b_products(1))
cte("b_products_r2", b_products(2))
cte("b_orders", f"SELECT {ORDER_COLS_SQL} FROM orders")
cte("b_orders_before", f"SELECT {ORDER_COLS_SQL} FROM orders WHERE o_orderdate < {CUTOFF}")
cte(
    "b_orders_batch",
    f"""SELECT {ORDER_COLS_SQL} FROM orders WHERE o_orderdate >= {CUTOFF}
    UNION ALL
    SELECT * REPLACE ('DELIVERED' AS status, updated_at + INTERVAL 1 DAY AS updated_at)
    FROM (SELECT {ORDER_COLS_SQL} FROM orders WHERE o_orderdate < {CUTOFF} AND o_orderstatus = 'O')""",
)
cte(
    "b_order_items",
    """SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
        l_orderkey AS order_id,
        l_partkey AS product_id,
        CASE WHEN (l_orderkey * 10 + l_linenumber) % 50 = 7 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
        CAST(CASE WHEN (l_orderkey * 10 + l_linenumber) % 50 = 12 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(10,2)) AS unit_price,
        l_shipdate AS created_at
    FROM lineitem""",
)
cte(
    "b_payments",
    """SELECT l_orderkey * 10 + l_linenumber AS payment_id,
        l_orderkey AS order_id,
        CAST(CASE WHEN (l_orderkey * 10 + l_linenumber) % 50 = 3 THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(12,2)) AS amount,
        CASE WHEN l_linenumber % 4 = 0 THEN 'card' WHEN l_linenumber % 4 = 1 THEN ' UPI'
             WHEN l_linenumber % 4 = 2 THEN 'NetBanking ' ELSE 'COD' END AS method,
        CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_returnflag = 'A' THEN 'SUCCESS'
             ELSE 'initiated' END AS status,
        l_shipdate AS paid_at,
        l_shipdate AS created_at,
        l_shipdate AS updated_at
    FROM lineitem""",
)
cte(
    "b_clicks",
    """SELECT CAST(event_id AS VARCHAR) AS event_id,
        CASE WHEN event_type = 'view' THEN 'PAGE_VIEW' WHEN event_type = 'click' THEN 'product_view'
             WHEN event_type = 'signup' THEN 'add_to_cart' WHEN event_type = 'purchase' THEN 'checkout_start'
             WHEN event_type = 'error' THEN 'search' ELSE event_type END AS event_type,
        CASE WHEN event_id % 40 <> 11 THEN ts END AS event_time,
        CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
        CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END AS customer_id,
        CASE WHEN event_id % 4 = 0 THEN 'DESKTOP' WHEN event_id % 4 = 1 THEN 'iPhone 15'
             WHEN event_id % 4 = 2 THEN ' Tablet ' ELSE NULL END AS device,
        '/p/' || (props ->> '$.k') AS page_url,
        CAST(NULL AS VARCHAR) AS referrer,
        CAST(NULL AS VARCHAR) AS user_agent,
        CAST(NULL AS VARCHAR) AS ip_address,
        CAST(props ->> '$.k' AS INTEGER) AS product_id,
        CAST(NULL AS INTEGER) AS quantity,
        CAST(NULL AS VARCHAR) AS search_term,
        value AS cart_value
    FROM events""",
)

# second deliveries, one day later and changed
cte(
    "d_customers",
    """SELECT * FROM b_customers UNION ALL
    SELECT * REPLACE (CASE WHEN customer_id % 14 <> 3 THEN email END AS email, lower(city) AS city,
        updated_at + INTERVAL 1 DAY AS updated_at) FROM b_customers WHERE customer_id % 7 = 3""",
    ["b_customers"],
)
cte(
    "d_products",
    """SELECT * FROM b_products UNION ALL
    SELECT * REPLACE (CAST(CASE WHEN product_id % 14 = 3 THEN -1 ELSE price + 1 END AS DECIMAL(10,2)) AS price,
        updated_at + INTERVAL 1 DAY AS updated_at) FROM b_products WHERE product_id % 7 = 3""",
    ["b_products"],
)
cte(
    "d_orders",
    """SELECT * FROM b_orders UNION ALL
    SELECT * REPLACE (CASE WHEN order_id % 14 <> 3 THEN total_amount END AS total_amount,
        CASE WHEN order_id % 21 <> 10 THEN status END AS status,
        CASE WHEN order_id % 35 = 24 THEN -customer_id ELSE customer_id END AS customer_id,
        updated_at + INTERVAL 1 DAY AS updated_at) FROM b_orders WHERE order_id % 7 = 3""",
    ["b_orders"],
)

# Silver
cte(
    "s_customers",
    f"""SELECT customer_id, {initcap('trim(first_name)')} AS first_name, {initcap('trim(last_name)')} AS last_name,
        lower(trim(email)) AS email, phone, address_line, {initcap('trim(city)')} AS city, state, country,
        postal_code, signup_date, is_active, created_at, updated_at
    FROM {latest('d_customers', 'customer_id', 'updated_at', CUSTOMER_COLS)}
    WHERE email IS NOT NULL AND customer_id IS NOT NULL""",
    ["d_customers"],
)
cte(
    "s_products",
    f"""SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
        trim(sub_category) AS sub_category, trim(brand) AS brand, price, stock_qty, is_discontinued,
        created_at, updated_at
    FROM {latest('d_products', 'product_id', 'updated_at', PRODUCT_COLS)}
    WHERE price >= 0""",
    ["d_products"],
)
cte(
    "s_orders",
    f"""SELECT order_id, customer_id, order_date, upper(trim(status)) AS status,
        {initcap('trim(shipping_city)')} AS shipping_city, shipping_country, total_amount, created_at, updated_at
    FROM {latest('d_orders', 'order_id', 'updated_at', ORDER_COLS)}
    WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount >= 0""",
    ["d_orders"],
)
cte(
    "s_order_items",
    """SELECT order_item_id, order_id, product_id, quantity, unit_price,
        CAST(quantity * unit_price AS DECIMAL(21,2)) AS line_total, created_at
    FROM b_order_items WHERE quantity > 0 AND unit_price >= 0""",
    ["b_order_items"],
)
cte(
    "s_payments",
    f"""SELECT payment_id, order_id, amount, upper(trim(method)) AS method, upper(trim(status)) AS status,
        paid_at, created_at, updated_at
    FROM {latest('b_payments', 'payment_id', 'updated_at', PAYMENT_COLS)}
    WHERE amount >= 0""",
    ["b_payments"],
)
cte(
    "s_sessions",
    """SELECT event_id, event_type, event_time, session_id, customer_id, device, page_url, referrer,
        user_agent, ip_address, product_id, quantity, search_term, cart_value,
        CAST(rn AS INTEGER) AS event_sequence_in_session,
        prev_type AS previous_event_type,
        CASE WHEN prev_time IS NOT NULL
             THEN CAST(epoch(date_trunc('second', event_time)) AS BIGINT)
                  - CAST(epoch(date_trunc('second', prev_time)) AS BIGINT) END AS seconds_since_previous_event,
        customer_id IS NULL AS is_anonymous_session
    FROM (
        SELECT *, row_number() OVER w AS rn, lag(event_time) OVER w AS prev_time, lag(event_type) OVER w AS prev_type
        FROM (SELECT * REPLACE (lower(trim(event_type)) AS event_type) FROM b_clicks WHERE event_time IS NOT NULL)
        WINDOW w AS (PARTITION BY session_id ORDER BY event_time, event_id))""",
    ["b_clicks"],
)

# Gold
def daily_sql(orders: str) -> str:
    """Daily sales of a table of order rows, in which ids may repeat."""
    return f"""SELECT CAST(order_date AS DATE) AS order_day,
        count(DISTINCT order_id) AS total_orders,
        count(DISTINCT order_id) FILTER (WHERE status = 'DELIVERED') AS delivered_orders,
        count(DISTINCT order_id) FILTER (WHERE status = 'CANCELLED') AS cancelled_orders,
        count(DISTINCT order_id) FILTER (WHERE status IN ('PENDING', 'CONFIRMED', 'SHIPPED')) AS in_flight_orders,
        CAST(sum(total_amount) AS DECIMAL(22,2)) AS gross_revenue,
        CAST(coalesce(sum(total_amount) FILTER (WHERE status <> 'CANCELLED'), 0) AS DECIMAL(22,2)) AS net_revenue,
        count(DISTINCT customer_id) AS unique_customers,
        {spark_round_avg_cents('total_amount', 'DECIMAL(13,2)')} AS avg_order_value
    FROM {orders} GROUP BY ALL"""


def ltv_sql(orders: str, payments: str) -> str:
    """Customer lifetime value over tables of order and payment rows, in which ids may repeat."""
    return f"""WITH per_customer AS (
            SELECT customer_id,
                count(DISTINCT order_id) AS n_orders,
                count(DISTINCT order_id) FILTER (WHERE status = 'DELIVERED') AS n_delivered,
                count(DISTINCT order_id) FILTER (WHERE status = 'CANCELLED') AS n_cancelled,
                coalesce(sum(total_amount) FILTER (WHERE status <> 'CANCELLED'), 0) AS revenue,
                min(order_date) AS first_at,
                max(order_date) AS last_at
            FROM {orders} GROUP BY ALL),
        attempts AS (
            SELECT customer_id,
                count(DISTINCT payment_id) AS n_attempts,
                count(DISTINCT payment_id) FILTER (WHERE {payments}.status = 'FAILED') AS n_failed
            FROM {orders} JOIN {payments} USING (order_id) GROUP BY ALL)
    SELECT customer_id, first_name, last_name, email, city, country, signup_date, is_active,
        coalesce(n_orders, 0) AS total_orders,
        coalesce(n_delivered, 0) AS delivered_orders,
        coalesce(n_cancelled, 0) AS cancelled_orders,
        CAST(coalesce(revenue, 0) AS DECIMAL(22,2)) AS lifetime_revenue,
        first_at AS first_order_date,
        last_at AS most_recent_order_date,
        coalesce(n_attempts, 0) AS total_payment_attempts,
        coalesce(n_failed, 0) AS failed_payments,
        CASE WHEN n_orders > 0 THEN {half_up_div_cents('revenue', 'n_orders', 'DECIMAL(23,2)')}
             ELSE CAST(0 AS DECIMAL(23,2)) END AS avg_order_value,
        CAST(date_diff('day', CAST(last_at AS DATE), {LTV_AS_OF}) AS INTEGER) AS days_since_last_order
    FROM s_customers LEFT JOIN per_customer USING (customer_id) LEFT JOIN attempts USING (customer_id)"""


cte("g_daily", daily_sql("s_orders"), ["s_orders"])
cte("g_ltv", ltv_sql("s_orders", "s_payments"), ["s_customers", "s_orders", "s_payments"])
# the same over rows whose ids repeat: every delivery of an order, every attempt of a payment
cte("r_orders", "SELECT * REPLACE (upper(trim(status)) AS status) FROM d_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount >= 0", ["d_orders"])
cte("r_payments", "SELECT * REPLACE (upper(trim(status)) AS status) FROM b_payments", ["b_payments"])
cte("r_ltv", ltv_sql("r_orders", "r_payments"), ["s_customers", "r_orders", "r_payments"])

# Snapshots: three runs (base, changed + deleted, restored)
_c_snap = ", ".join(CUSTOMER_SNAP)
_p_snap = ", ".join(PRODUCT_SNAP)
cte("c_e1", f"SELECT {_c_snap} FROM b_customers", ["b_customers"])
cte("c_e2", f"SELECT {_c_snap} FROM b_customers_r2", ["b_customers_r2"])
cte("c_h1", snapshot_run(None, "c_e1", "customer_id", CUSTOMER_SNAP, CUSTOMER_CHECK, T1), ["c_e1"])
cte("c_h2", snapshot_run("c_h1", "c_e2", "customer_id", CUSTOMER_SNAP, CUSTOMER_CHECK, T2), ["c_h1", "c_e2"])
cte("c_hist", snapshot_run("c_h2", "c_e1", "customer_id", CUSTOMER_SNAP, CUSTOMER_CHECK, T3), ["c_h2", "c_e1"])
cte("p_e1", f"SELECT {_p_snap} FROM b_products", ["b_products"])
cte("p_e2", f"SELECT {_p_snap} FROM b_products_r2", ["b_products_r2"])
cte("p_h1", snapshot_run(None, "p_e1", "product_id", PRODUCT_SNAP, PRODUCT_CHECK, T1), ["p_e1"])
cte("p_h2", snapshot_run("p_h1", "p_e2", "product_id", PRODUCT_SNAP, PRODUCT_CHECK, T2), ["p_h1", "p_e2"])
cte("p_hist", snapshot_run("p_h2", "p_e1", "product_id", PRODUCT_SNAP, PRODUCT_CHECK, T3), ["p_h2", "p_e1"])
cte("p_flag", "SELECT *, dbt_valid_to IS NULL AS is_current FROM p_hist", ["p_hist"])


def with_ctes(select: str, *needed: str) -> str:
    """``WITH`` the needed CTEs (and their dependencies, in order) followed by ``select``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{select}"


# --- data tests (the 39 declared tests) ---------------------------------------------------------
# The declared tests, listed here on their own: (model, not null, unique, accepted values).
DECLARED = [
    ("bronze.customers", ('customer_id',), ('customer_id',), {}),
    ("bronze.products", ('product_id',), ('product_id',), {}),
    ("bronze.orders", ('order_id', 'customer_id'), ('order_id',), {}),
    ("bronze.order_items", ('order_item_id',), ('order_item_id',), {}),
    ("bronze.payments", ('payment_id',), ('payment_id',), {}),
    ("bronze.clickstream_events", ('event_id',), ('event_id',), {}),
    ("silver_customers", ('customer_id', 'email'), ('customer_id', 'email'), {}),
    ("silver_products", ('product_id',), ('product_id',), {}),
    ("silver_orders", ('order_id', 'customer_id'), ('order_id',), {"status": ('PENDING', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED')}),
    ("silver_order_items", ('order_item_id',), ('order_item_id',), {}),
    ("silver_payments", ('payment_id',), ('payment_id',), {"status": ('INITIATED', 'SUCCESS', 'FAILED', 'REFUNDED')}),
    ("silver_clickstream_sessions", ('event_id',), ('event_id',), {"event_type": ('page_view', 'product_view', 'search', 'add_to_cart', 'remove_from_cart', 'checkout_start')}),
    ("gold_daily_sales_summary", ('order_day',), ('order_day',), {}),
    ("gold_customer_ltv", ('customer_id',), ('customer_id',), {}),
    ("customers_snapshot", ('dbt_scd_id',), ('dbt_scd_id',), {}),
    ("products_snapshot", ('dbt_scd_id',), ('dbt_scd_id',), {}),
]


def _dq_sql() -> str:
    tables = {
        "bronze.customers": "b_customers",
        "bronze.products": "b_products",
        "bronze.orders": "b_orders",
        "bronze.order_items": "b_order_items",
        "bronze.payments": "b_payments",
        "bronze.clickstream_events": "b_clicks",
        "silver_customers": "s_customers",
        "silver_products": "s_products",
        "silver_orders": "s_orders",
        "silver_order_items": "s_order_items",
        "silver_payments": "s_payments",
        "silver_clickstream_sessions": "s_sessions",
        "gold_daily_sales_summary": "g_daily",
        "gold_customer_ltv": "g_ltv",
        "customers_snapshot": "c_hist",
        "products_snapshot": "p_hist",
    }
    parts = []
    for model, not_null, unique, accepted in DECLARED:
        t = tables[model]
        for c in not_null:
            parts.append(f"SELECT 'not_null', '{model}', '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM {t}")
        for c, vals in accepted.items():
            lst = ", ".join(f"'{v}'" for v in vals)
            parts.append(
                f"SELECT 'accepted_values', '{model}', '{c}', "
                f"count(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst})) FROM {t}"
            )
        for c in unique:
            parts.append(
                f"SELECT 'unique', '{model}', '{c}', (SELECT count(*) FROM (SELECT {c} FROM {t} "
                f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
            )
    union = "\nUNION ALL ".join(parts)
    select = (
        "SELECT test_name, model, column_name, CAST(failures AS BIGINT) AS failures, "
        "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
        f"{union}) AS t(test_name, model, column_name, failures)"
    )
    return with_ctes(select, *tables.values())


HIST_VIEW = "product_id, price, is_discontinued, is_current, dbt_valid_from, dbt_valid_to"

ORACLE_SQL: dict[str, str] = {
    "silver_customers": with_ctes("SELECT * FROM s_customers", "s_customers"),
    "silver_products": with_ctes("SELECT * FROM s_products", "s_products"),
    "silver_orders": with_ctes("SELECT * FROM s_orders", "s_orders"),
    "silver_order_items": with_ctes("SELECT * FROM s_order_items", "s_order_items"),
    "silver_payments": with_ctes("SELECT * FROM s_payments", "s_payments"),
    "silver_clickstream_sessions": with_ctes("SELECT * FROM s_sessions", "s_sessions"),
    "gold_daily_sales_summary": with_ctes("SELECT * FROM g_daily ORDER BY order_day", "g_daily"),
    "gold_customer_ltv": with_ctes("SELECT * FROM g_ltv", "g_ltv"),
    "daily_sales_of_deliveries": with_ctes(daily_sql("r_orders"), "r_orders"),
    "customer_ltv_of_deliveries": with_ctes("SELECT * FROM r_ltv", "r_ltv"),
    "gold_clickstream_funnel": with_ctes(
        f"""SELECT * FROM (WITH reached AS (
                SELECT bool_or(event_type = 'page_view') AS pv, bool_or(event_type = 'product_view') AS prv,
                       bool_or(event_type = 'add_to_cart') AS atc, bool_or(event_type = 'checkout_start') AS co,
                       bool_or(is_anonymous_session) AS anon
                FROM s_sessions GROUP BY session_id),
            totals AS (
                SELECT count(*) AS total_sessions,
                       CAST(sum(CAST(coalesce(anon, false) AS INTEGER)) AS BIGINT) AS anonymous_sessions,
                       CAST(sum(CAST(coalesce(pv, false) AS INTEGER)) AS BIGINT) AS sessions_page_view,
                       CAST(sum(CAST(coalesce(prv, false) AS INTEGER)) AS BIGINT) AS sessions_product_view,
                       CAST(sum(CAST(coalesce(atc, false) AS INTEGER)) AS BIGINT) AS sessions_add_to_cart,
                       CAST(sum(CAST(coalesce(co, false) AS INTEGER)) AS BIGINT) AS sessions_checkout
                FROM reached)
        SELECT *, total_sessions - anonymous_sessions AS identified_sessions,
            {spark_round_double('sessions_product_view / nullif(sessions_page_view, 0) * 100')} AS pct_page_to_product,
            {spark_round_double('sessions_add_to_cart / nullif(sessions_product_view, 0) * 100')} AS pct_product_to_cart,
            {spark_round_double('sessions_checkout / nullif(sessions_add_to_cart, 0) * 100')} AS pct_cart_to_checkout,
            {spark_round_double('sessions_checkout / nullif(sessions_page_view, 0) * 100')} AS pct_overall_conversion
        FROM totals)""",
        "s_sessions",
    ),
    "customers_snapshot": with_ctes("SELECT * FROM c_hist", "c_hist"),
    "products_snapshot": with_ctes("SELECT * FROM p_hist", "p_hist"),
    "customers_current_flag": with_ctes("SELECT *, dbt_valid_to IS NULL AS is_current FROM c_hist", "c_hist"),
    "products_current_flag": with_ctes("SELECT * FROM p_flag", "p_flag"),
    "customer_profile_history": with_ctes(
        """SELECT customer_id,
            count(*) AS total_profile_versions,
            count(*) - 1 AS number_of_profile_changes,
            min(dbt_valid_from) AS first_seen_at,
            max(dbt_valid_from) FILTER (WHERE dbt_valid_to IS NULL) AS current_version_since,
            count(*) > 1 AS has_relocated
        FROM c_hist GROUP BY ALL""",
        "c_hist",
    ),
    "as_of_price_at_sale": with_ctes(
        """SELECT i.*, h.price AS catalog_price, h.dbt_valid_from AS price_valid_from
        FROM s_order_items i LEFT JOIN p_hist h
          ON i.product_id = h.product_id AND i.created_at >= h.dbt_valid_from
         AND (h.dbt_valid_to IS NULL OR i.created_at < h.dbt_valid_to)""",
        "s_order_items",
        "p_hist",
    ),
    "click_order_join": with_ctes(
        """SELECT c.customer_id, c.click_events, c.click_sessions, c.checkout_events,
            coalesce(o.total_orders, 0) AS total_orders,
            CAST(coalesce(o.net_revenue, 0) AS DECIMAL(22,2)) AS net_revenue
        FROM (SELECT customer_id, count(*) AS click_events, count(DISTINCT session_id) AS click_sessions,
                     count(*) FILTER (WHERE event_type = 'checkout_start') AS checkout_events
              FROM s_sessions WHERE customer_id IS NOT NULL GROUP BY customer_id) c
        LEFT JOIN (SELECT customer_id, count(*) AS total_orders,
                          sum(CASE WHEN status != 'CANCELLED' THEN total_amount ELSE 0 END) AS net_revenue
                   FROM s_orders GROUP BY customer_id) o ON c.customer_id = o.customer_id""",
        "s_sessions",
        "s_orders",
    ),
    "upsert_orders": with_ctes(
        f"""SELECT * FROM b_orders_before t
            WHERE NOT EXISTS (SELECT 1 FROM b_orders_batch b WHERE b.order_id = t.order_id)
        UNION ALL
        SELECT * FROM {latest('b_orders_batch', 'order_id', 'updated_at', ORDER_COLS)}""",
        "b_orders_before",
        "b_orders_batch",
    ),
    "upsert_orders_stored": with_ctes(
        f"""SELECT * FROM (
            SELECT * FROM b_orders_before t WHERE NOT EXISTS (SELECT 1 FROM b_orders_batch b WHERE b.order_id = t.order_id)
            UNION ALL
            SELECT * FROM {latest('b_orders_batch', 'order_id', 'updated_at', ORDER_COLS)}) WHERE order_id % 11 <> 5
        UNION ALL
        SELECT * REPLACE ('pending' AS status, created_at + INTERVAL 40 DAY AS created_at,
                          updated_at + INTERVAL 40 DAY + INTERVAL 2 HOUR AS updated_at)
        FROM b_orders WHERE order_id % 11 = 5""",
        "b_orders_before",
        "b_orders_batch",
        "b_orders",
    ),
    "incremental_extract": with_ctes(f"SELECT * FROM b_orders WHERE updated_at > {SINCE}", "b_orders"),
    "dq_report": _dq_sql(),
    "foreign_key_violations": with_ctes(
        """SELECT 'orders.customer_id -> customers' AS relationship, CAST(customer_id AS BIGINT) AS key_value,
                  count(*) AS child_rows
           FROM d_orders x WHERE customer_id IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM b_customers p WHERE p.customer_id = x.customer_id) GROUP BY customer_id
        UNION ALL
        SELECT 'order_items.order_id -> orders', CAST(order_id AS BIGINT), count(*)
           FROM b_order_items x WHERE order_id IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM b_orders p WHERE p.order_id = x.order_id) GROUP BY order_id
        UNION ALL
        SELECT 'order_items.product_id -> products', CAST(product_id AS BIGINT), count(*)
           FROM b_order_items x WHERE product_id IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM b_products p WHERE p.product_id = x.product_id) GROUP BY product_id
        UNION ALL
        SELECT 'payments.order_id -> orders', CAST(order_id AS BIGINT), count(*)
           FROM b_payments x WHERE order_id IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM b_orders p WHERE p.order_id = x.order_id) GROUP BY order_id""",
        "b_orders",
        "d_orders",
        "b_customers",
        "b_order_items",
        "b_products",
        "b_payments",
    ),
    "events_per_type": with_ctes(
        "SELECT event_type, count(*) AS event_count FROM b_clicks GROUP BY event_type ORDER BY event_count DESC, event_type",
        "b_clicks",
    ),
    "row_counts": with_ctes(
        """SELECT 'bronze.customers' AS table_name, count(*) AS row_count FROM b_customers
        UNION ALL SELECT 'bronze.products', count(*) FROM b_products
        UNION ALL SELECT 'bronze.orders', count(*) FROM b_orders
        UNION ALL SELECT 'bronze.order_items', count(*) FROM b_order_items
        UNION ALL SELECT 'bronze.payments', count(*) FROM b_payments
        UNION ALL SELECT 'bronze.clickstream_events', count(*) FROM b_clicks""",
        "b_customers",
        "b_products",
        "b_orders",
        "b_order_items",
        "b_payments",
        "b_clicks",
    ),
    "repriced_products": with_ctes(
        f"""SELECT {HIST_VIEW} FROM p_flag
        WHERE product_id IN (SELECT product_id FROM p_hist GROUP BY product_id HAVING count(*) > 1)
        ORDER BY product_id, dbt_valid_from""",
        "p_flag",
        "p_hist",
    ),
    "discontinued_top10": with_ctes(
        f"SELECT {HIST_VIEW} FROM p_flag WHERE is_discontinued = true ORDER BY dbt_valid_from DESC, product_id LIMIT 10",
        "p_flag",
    ),
    "customer_history": with_ctes("SELECT * FROM c_hist WHERE customer_id = 1 ORDER BY dbt_valid_from", "c_hist"),
    "product_price_history": with_ctes(
        f"SELECT {HIST_VIEW} FROM p_flag WHERE product_id = 2 ORDER BY dbt_valid_from", "p_flag"
    ),
    "top_customers_ltv": with_ctes("SELECT * FROM g_ltv ORDER BY lifetime_revenue DESC, customer_id LIMIT 10", "g_ltv"),
    "order_status_breakdown": with_ctes(
        """SELECT 'delivered' AS status_group, CAST(sum(delivered_orders) AS BIGINT) AS order_count FROM g_daily
        UNION ALL SELECT 'cancelled', CAST(sum(cancelled_orders) AS BIGINT) FROM g_daily
        UNION ALL SELECT 'in_flight', CAST(sum(in_flight_orders) AS BIGINT) FROM g_daily
        UNION ALL SELECT 'other', CAST(sum(total_orders) - sum(delivered_orders) - sum(cancelled_orders)
                                       - sum(in_flight_orders) AS BIGINT) FROM g_daily""",
        "g_daily",
    ),
    "bronze_customers": with_ctes("SELECT * FROM b_customers", "b_customers"),
    # Lenient decoding of the same messages: quoted ids and "$" prices are repaired, and an
    # epoch-millisecond time is read as the event time truncated to milliseconds.
    "stream_decode_events_lenient": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        upper(event_type) AS event_type,
        CASE WHEN event_id % 4 = 0 THEN ts
             WHEN event_id % 4 IN (1, 2) THEN date_trunc('second', ts)
             ELSE date_trunc('millisecond', ts) END AS event_time,
        CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
        CAST(CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END AS INTEGER) AS customer_id,
        CAST(NULL AS VARCHAR) AS device,
        CAST(NULL AS VARCHAR) AS page_url,
        CAST(NULL AS VARCHAR) AS referrer,
        CAST(NULL AS VARCHAR) AS user_agent,
        CAST(NULL AS VARCHAR) AS ip_address,
        CAST(props ->> '$.k' AS INTEGER) AS product_id,
        CAST(NULL AS INTEGER) AS quantity,
        CAST(NULL AS VARCHAR) AS search_term,
        value AS cart_value,
        ts AS kafka_timestamp,
        CAST(NULL AS VARCHAR) AS _corrupt_record
    FROM events""",
    # Expected drift counts, from the rules that build the messages (quoted ids, "$" prices and
    # epoch-millisecond times are lost by strict decoding and repaired by lenient decoding).
    "stream_message_split": """SELECT CAST(event_id AS VARCHAR) AS event_id,
            CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
            CASE WHEN event_id % 20 = 7 THEN '{"_meta_source_version":"v2"}' END AS unknown,
            CAST(NULL AS VARCHAR) AS message, CAST(NULL AS VARCHAR) AS reason
        FROM events WHERE event_id % 23 NOT IN (4, 9, 14)
        UNION ALL
        SELECT NULL, NULL, NULL,
            CASE event_id % 23 WHEN 4 THEN '{"event_id":' WHEN 9 THEN '"a text"' ELSE '{"event_type":"SEARCH"}' END,
            CASE event_id % 23 WHEN 4 THEN 'not json' WHEN 9 THEN 'not an object' ELSE 'no event_id' END
        FROM events WHERE event_id % 23 IN (4, 9, 14)""",
    "stream_drift_report": """WITH m AS (SELECT event_id AS eid, user_id AS uid FROM events)
        SELECT 'event_time' AS field, count(*) FILTER (WHERE eid % 4 = 3) AS lost_strict,
               count(*) FILTER (WHERE eid % 4 = 3) AS repaired, CAST(0 AS BIGINT) AS unreadable FROM m
        UNION ALL SELECT 'customer_id', count(*) FILTER (WHERE uid % 5 <> 0 AND uid % 7 = 0),
               count(*) FILTER (WHERE uid % 5 <> 0 AND uid % 7 = 0), 0 FROM m
        UNION ALL SELECT 'product_id', 0, 0, 0
        UNION ALL SELECT 'quantity', 0, 0, 0
        UNION ALL SELECT 'cart_value', count(*) FILTER (WHERE eid % 10 = 3), count(*) FILTER (WHERE eid % 10 = 3), 0 FROM m
        UNION ALL SELECT '<message>', 0, 0, 0""",
    # The stream drain's result, stated as the decoded projection of the same messages:
    # ISO-with-offset times keep microseconds, the two second-precision patterns truncate,
    # epoch-millisecond times are NULL (L13); quoted ints and "$" prices are NULL (L12).
    "stream_decode_events": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        upper(event_type) AS event_type,
        CASE WHEN event_id % 4 = 0 THEN ts
             WHEN event_id % 4 IN (1, 2) THEN date_trunc('second', ts)
             ELSE NULL END AS event_time,
        CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
        CAST(CASE WHEN user_id % 5 = 0 OR user_id % 7 = 0 THEN NULL ELSE user_id END AS INTEGER) AS customer_id,
        CAST(NULL AS VARCHAR) AS device,
        CAST(NULL AS VARCHAR) AS page_url,
        CAST(NULL AS VARCHAR) AS referrer,
        CAST(NULL AS VARCHAR) AS user_agent,
        CAST(NULL AS VARCHAR) AS ip_address,
        CAST(props ->> '$.k' AS INTEGER) AS product_id,
        CAST(NULL AS INTEGER) AS quantity,
        CAST(NULL AS VARCHAR) AS search_term,
        CASE WHEN event_id % 10 = 3 THEN NULL ELSE value END AS cart_value,
        ts AS kafka_timestamp
    FROM events""",
}
