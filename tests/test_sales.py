"""DS-12 daily sales, DS-13 customer LTV; ledger L17/L18/L19."""

from decimal import Decimal

from conftest import rows, ts
from pyspark.sql import functions as F

from strata.operators.sales import customer_ltv, daily_sales

ORDER_SCHEMA = (
    "order_id int, customer_id int, order_date timestamp, status string, total_amount decimal(12,2)"
)
CUST_SCHEMA = (
    "customer_id int, first_name string, last_name string, email string, city string, country string, "
    "signup_date timestamp, is_active boolean"
)
PAY_SCHEMA = "payment_id int, order_id int, status string"


def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10, ts("2024-01-01 10:00:00"), "DELIVERED", Decimal("10.00")),
            (2, 10, ts("2024-01-01 23:59:59"), "CANCELLED", Decimal("5.00")),
            (3, 11, ts("2024-01-02 00:00:00"), None, Decimal("2.01")),  # L19
            (4, 11, ts("2024-01-02 08:00:00"), "SHIPPED", Decimal("1.00")),
            (5, 12, ts("2024-01-03 08:00:00"), "CANCELLED", Decimal("7.00")),
        ],
        ORDER_SCHEMA,
    )


def test_ds12_daily_sales(spark):
    out = {r.order_day.isoformat(): r for r in daily_sales(orders(spark)).collect()}
    d1, d2 = out["2024-01-01"], out["2024-01-02"]
    assert (d1.total_orders, d1.delivered_orders, d1.cancelled_orders, d1.in_flight_orders) == (2, 1, 1, 0)
    assert (d1.gross_revenue, d1.net_revenue, d1.unique_customers) == (Decimal("15.00"), Decimal("10.00"), 1)
    assert d1.avg_order_value == Decimal("7.50")
    # L19: NULL status is in gross, and counted as "not cancelled" in net (NULL -> else 0 ... sum 0)
    assert (d2.gross_revenue, d2.net_revenue, d2.in_flight_orders) == (Decimal("3.01"), Decimal("1.00"), 1)
    assert d2.avg_order_value == Decimal("1.51")  # 1.505 half-up


def test_ds12_distinct_and_plain_counts_agree(spark):
    dup = orders(spark).unionByName(orders(spark))  # duplicate ids: only the distinct form is exact
    a = rows(daily_sales(orders(spark), unique_orders=True))
    b = rows(daily_sales(orders(spark), unique_orders=False))
    assert a == b
    c = {r.order_day.isoformat(): r.total_orders for r in daily_sales(dup, unique_orders=False).collect()}
    assert c["2024-01-01"] == 2


def test_ds13_customer_ltv_edges(spark):
    t = ts("2020-01-01 00:00:00")
    customers = spark.createDataFrame(
        [(10, "A", "B", "a@x", "C", "US", t, True), (12, "C", "D", "c@x", "C", "US", t, True), (13, "E", "F", "e@x", "C", "US", t, False)],
        CUST_SCHEMA,
    )
    pays = spark.createDataFrame([(100, 1, "FAILED"), (101, 1, "SUCCESS"), (102, 2, "FAILED"), (103, 99, "FAILED")], PAY_SCHEMA)
    for unique in (True, False):
        out = {r.customer_id: r for r in customer_ltv(customers, orders(spark), pays, as_of="2024-01-11", unique_keys=unique).collect()}
        a = out[10]
        assert (a.total_orders, a.delivered_orders, a.cancelled_orders) == (2, 1, 1)
        assert a.lifetime_revenue == Decimal("10.00")
        assert a.avg_order_value == Decimal("5.00")  # L17: non-cancelled revenue / all orders
        assert (a.total_payment_attempts, a.failed_payments) == (3, 2)
        assert a.days_since_last_order == 10
        c = out[12]  # all orders cancelled
        assert (c.lifetime_revenue, c.avg_order_value, c.total_payment_attempts) == (Decimal("0.00"), Decimal("0.00"), 0)
        e = out[13]  # no orders at all
        assert (e.total_orders, e.lifetime_revenue, e.first_order_date, e.days_since_last_order) == (0, Decimal("0.00"), None, None)
        assert e.avg_order_value == 0
        assert 11 not in out  # customers drive the rows


def test_ds13_plan_has_no_fanout_join(spark):
    customers = spark.createDataFrame([], CUST_SCHEMA)
    pays = spark.createDataFrame([], PAY_SCHEMA)
    plan = customer_ltv(customers, orders(spark), pays, as_of="2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    # payments are aggregated per order before they meet orders
    assert plan.count("Aggregate") >= 2


def _random_orders(seed, n):
    import random

    r = random.Random(seed)
    statuses = ["DELIVERED", "CANCELLED", "SHIPPED", "PENDING", "LOST", None]
    return [(r.choice([None, r.randint(-40, 40), 70_000]), r.choice([None, r.randint(1, 12)]), ts(f"2024-01-0{r.randint(1, 4)} 10:00:00"), r.choice(statuses), r.choice([None, Decimal(r.randint(0, 999)) / 100])) for _ in range(n)]


def _plain_daily(data):
    out = {}
    for day in {d[2].date() for d in data}:
        of = [d for d in data if d[2].date() == day]
        ids = lambda ok: len({d[0] for d in of if d[0] is not None and ok(d[3])})
        amounts = [d[4] for d in of if d[4] is not None]
        net = [d[4] if d[3] is not None and d[3] != "CANCELLED" else Decimal(0) for d in of]
        net = [x for x in net if x is not None]
        out[day.isoformat()] = (
            ids(lambda s: True), ids(lambda s: s == "DELIVERED"), ids(lambda s: s == "CANCELLED"), ids(lambda s: s in ("PENDING", "CONFIRMED", "SHIPPED")),
            sum(amounts) if amounts else None, sum(net) if net else None, len({d[1] for d in of if d[1] is not None}),
        )
    return out


def _daily_rows(df):
    names = "total_orders delivered_orders cancelled_orders in_flight_orders gross_revenue net_revenue unique_customers".split()
    return {r.order_day.isoformat(): tuple(r[n] for n in names) for r in df.collect()}


def test_distinct_counts_on_repeated_ids(spark):
    """Two-level counts, bitmaps, and bitmaps of two batches merged: all as counted row by row."""
    from strata.operators.sales import daily_sales_of, daily_sales_partials, merge_daily_sales

    for seed in range(3):
        a, b = _random_orders(seed, 60), _random_orders(seed + 100, 30)
        fa, fb = (spark.createDataFrame(x, ORDER_SCHEMA) for x in (a, b))
        want = _plain_daily(a + b)
        both = fa.unionByName(fb)
        assert _daily_rows(daily_sales(both)) == want
        assert _daily_rows(daily_sales_of(daily_sales_partials(both))) == want
        merged = merge_daily_sales(daily_sales_partials(fa).unionByName(daily_sales_partials(fb)))
        assert _daily_rows(daily_sales_of(merged)) == want
        again = merge_daily_sales(merged.unionByName(daily_sales_partials(fb)))  # ids of a batch met before change no count
        assert {k: v[:4] + v[6:] for k, v in _daily_rows(daily_sales_of(again)).items()} == {k: v[:4] + v[6:] for k, v in want.items()}
        means = lambda df: sorted((str(r.order_day), r.avg_order_value) for r in df.collect())
        plain = both.groupBy(F.to_date("order_date").alias("order_day")).agg(F.round(F.avg("total_amount"), 2).alias("avg_order_value"))
        assert means(daily_sales(both)) == means(plain) == means(daily_sales_of(merged))
        assert daily_sales(both).dtypes == daily_sales(both, unique_orders=True).dtypes == daily_sales_of(merged).dtypes


def test_text_ids_are_counted_and_not_put_in_bitmaps(spark):
    import pytest

    from strata.operators.sales import daily_sales_partials

    text = orders(spark).withColumn("order_id", F.col("order_id").cast("string"))
    assert rows(daily_sales(text)) == rows(daily_sales(orders(spark)))
    with pytest.raises(TypeError, match="order_id"):
        daily_sales_partials(text)


def test_ltv_on_repeated_ids(spark):
    """Conditional distinct counts differ from plain ones here."""
    t = ts("2020-01-01 00:00:00")
    customers = spark.createDataFrame([(10, "A", "B", "a@x", "C", "US", t, True)], CUST_SCHEMA)
    twice = spark.createDataFrame(
        [(1, 10, ts("2024-01-01"), "DELIVERED", Decimal("10.00")), (1, 10, ts("2024-01-02"), "CANCELLED", Decimal("4.00")), (1, 10, ts("2024-01-03"), "DELIVERED", Decimal("1.00"))],
        ORDER_SCHEMA,
    )
    pays = spark.createDataFrame([(100, 1, "FAILED"), (100, 1, "FAILED"), (100, 1, "SUCCESS"), (101, 1, "SUCCESS"), (None, 1, "FAILED")], PAY_SCHEMA)
    r = customer_ltv(customers, twice, pays, as_of="2024-01-11").first()
    assert (r.total_orders, r.delivered_orders, r.cancelled_orders) == (1, 1, 1)
    assert (r.lifetime_revenue, r.total_payment_attempts, r.failed_payments, r.days_since_last_order) == (Decimal("11.00"), 2, 1, 8)
