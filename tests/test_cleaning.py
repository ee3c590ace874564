"""WIN-1/FLT-4 keep-latest, Silver cleaners DS-1..5, ledger L5/L7/L9/L10/L11."""

from decimal import Decimal

from conftest import rows, ts

from strata.operators.cleaning import (
    silver_customers,
    silver_order_items,
    silver_orders,
    silver_payments,
    silver_products,
)
from strata.operators.dedup import keep_latest

CUST_SCHEMA = (
    "customer_id int, first_name string, last_name string, email string, phone string, address_line string, "
    "city string, state string, country string, postal_code string, signup_date timestamp, is_active boolean, "
    "created_at timestamp, updated_at timestamp"
)


def cust(cid, first, email, city, updated, last="smith"):
    t = ts("2024-01-01 00:00:00")
    return (cid, first, last, email, None, None, city, "ST", "US", None, t, True, t, ts(updated))


def test_win1_keep_latest_picks_greatest_with_ties(spark):
    df = spark.createDataFrame(
        [(1, ts("2024-01-01"), "a"), (1, ts("2024-01-02"), "b"), (1, ts("2024-01-02"), "c"), (2, None, "x"), (2, ts("2020-01-01"), "y")],
        "k int, u timestamp, v string",
    )
    out = keep_latest(df, ["k"], ["u"], ["v"])
    assert rows(out, "k", "v") == [(1, "c"), (2, "y")]  # NULL order values lose (DESC NULLS LAST)


def test_keep_latest_without_order_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(keep_latest(df, ["k"], [])) == [(1,), (2,)]


def test_keep_latest_skips_unorderable_ties(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, u int, m map<string,int>")
    assert rows(keep_latest(df, ["k"], ["u"], ["m"]), "k", "u") == [(1, 2)]


def test_win1_plan_limits_before_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as u")
    plan = keep_latest(df, ["k"], ["u"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # partial top-1 per key before the exchange


def test_ds1_silver_customers_cleaning_and_l11_initcap(spark):
    df = spark.createDataFrame(
        [cust(1, "  o'BRIEN-smith ", " John@X.COM ", "  new YORK", "2024-01-02", last="MC DONALD  ")],
        CUST_SCHEMA,
    )
    r = silver_customers(df).collect()[0]
    assert r.first_name == "O'brien-smith"
    assert r.last_name == "Mc Donald"
    assert r.email == "john@x.com"
    assert r.city == "New York"
    assert r.state == "ST"  # L10: state passes through uncleaned


def test_l7_latest_row_invalid_drops_key(spark):
    df = spark.createDataFrame(
        [cust(1, "a", "a@x", "c", "2024-01-01"), cust(1, "a", None, "c", "2024-01-05"), cust(2, "b", "b@x", "c", "2024-01-01")],
        CUST_SCHEMA,
    )
    assert rows(silver_customers(df), "customer_id") == [(2,)]


def test_ds3_silver_orders_filters_and_status(spark):
    schema = (
        "order_id int, customer_id int, order_date timestamp, status string, shipping_city string, "
        "shipping_country string, total_amount decimal(12,2), created_at timestamp, updated_at timestamp"
    )
    t = ts("2024-01-01")
    df = spark.createDataFrame(
        [
            (1, 10, t, " shipped ", "  san francisco", "US", Decimal("5.00"), t, t),
            (2, None, t, "PENDING", None, "US", Decimal("5.00"), t, t),
            (3, 10, t, "PENDING", None, "US", Decimal("-1.00"), t, t),
            (4, 10, t, "PENDING", None, "US", None, t, t),  # L9: NULL amount fails >= 0
        ],
        schema,
    )
    out = silver_orders(df).collect()
    assert [(r.order_id, r.status, r.shipping_city) for r in out] == [(1, "SHIPPED", "San Francisco")]


def test_ds2_ds4_ds5_products_items_payments(spark):
    t = ts("2024-01-01")
    prods = spark.createDataFrame(
        [(1, " Widget ", "TOOLS_DEPT ", None, " acme", Decimal("1.50"), -3, False, t, t), (2, "x", "c", None, None, Decimal("-1.00"), 0, False, t, t)],
        "product_id int, product_name string, category string, sub_category string, brand string, price decimal(10,2), "
        "stock_qty int, is_discontinued boolean, created_at timestamp, updated_at timestamp",
    )
    p = silver_products(prods).collect()
    assert [(r.product_id, r.product_name, r.category, r.brand, r.stock_qty) for r in p] == [(1, "Widget", "TOOLS_DEPT", "acme", -3)]

    items = spark.createDataFrame(
        [(1, 1, 1, 3, Decimal("2.50"), t), (2, 1, 1, 0, Decimal("2.50"), t), (3, 1, 1, 1, Decimal("-1.00"), t)],
        "order_item_id int, order_id int, product_id int, quantity int, unit_price decimal(10,2), created_at timestamp",
    )
    it = silver_order_items(items)
    assert it.schema["line_total"].dataType.simpleString() == "decimal(21,2)"
    assert rows(it, "order_item_id", "line_total") == [(1, Decimal("7.50"))]

    pays = spark.createDataFrame(
        [
            (1, 1, Decimal("9.00"), " upi", "failed", t, t, ts("2024-01-01")),
            (1, 1, Decimal("9.00"), " upi", "success ", t, t, ts("2024-01-02")),
            (2, 1, Decimal("-9.00"), "COD", "FAILED", t, t, t),
        ],
        "payment_id int, order_id int, amount decimal(12,2), method string, status string, paid_at timestamp, "
        "created_at timestamp, updated_at timestamp",
    )
    assert rows(silver_payments(pays), "payment_id", "method", "status") == [(1, "UPI", "SUCCESS")]
