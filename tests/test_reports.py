"""RPT-1..11 reports and JOIN-8 on hand-written fixtures."""

from decimal import Decimal

from conftest import rows, ts

from strata.operators.joins import click_order_join
from strata.plans import reports

HIST = "product_id int, price decimal(10,2), is_discontinued boolean, dbt_valid_from timestamp, dbt_valid_to timestamp"


def history(spark):
    return spark.createDataFrame(
        [
            (1, Decimal("1.00"), False, ts("2024-01-01"), ts("2024-02-01")),
            (1, Decimal("2.00"), True, ts("2024-02-01"), None),
            (2, Decimal("5.00"), True, ts("2024-01-01"), None),
            (3, Decimal("7.00"), True, ts("2024-02-01"), None),
        ],
        HIST,
    )


def test_rpt3_repriced_products_only_keys_with_versions(spark):
    out = reports.repriced_products(history(spark)).collect()
    assert [(r.product_id, r.price, r.is_current) for r in out] == [
        (1, Decimal("1.00"), False),
        (1, Decimal("2.00"), True),
    ]  # ordered by product, then version start


def test_rpt4_discontinued_top_k_with_deterministic_ties(spark):
    out = reports.discontinued_latest(history(spark), k=2).collect()
    assert [r.product_id for r in out] == [1, 3]  # both opened 2024-02-01: product id breaks the tie


def test_rpt6_product_price_history(spark):
    out = reports.product_price_history(history(spark), product_id=1).collect()
    assert [(r.price, r.is_current) for r in out] == [(Decimal("1.00"), False), (Decimal("2.00"), True)]


def test_rpt1_rpt10_events_and_status_breakdown(spark):
    ev = spark.createDataFrame([("a",), ("b",), ("a",)], "event_type string")
    assert [tuple(r) for r in reports.events_per_type(ev).collect()] == [("a", 2), ("b", 1)]
    daily = spark.createDataFrame([(5, 2, 1, 1), (3, 0, 1, 2)], "total_orders long, delivered_orders long, "
                                  "cancelled_orders long, in_flight_orders long")
    got = dict(tuple(r) for r in reports.order_status_breakdown(daily).collect())
    assert got == {"delivered": 2, "cancelled": 2, "in_flight": 3, "other": 1}
    assert sum(got.values()) == 8  # the tile adds up to all orders


def test_join8_clicks_and_orders_per_customer(spark):
    sessions = spark.createDataFrame(
        [("1", "s1", 10, "page_view"), ("2", "s1", 10, "checkout_start"), ("3", "s2", 10, "page_view"),
         ("4", "s3", None, "page_view"), ("5", "s4", 11, "page_view")],
        "event_id string, session_id string, customer_id int, event_type string",
    )
    orders = spark.createDataFrame(
        [(1, 10, "DELIVERED", Decimal("3.00")), (2, 10, "CANCELLED", Decimal("9.00")), (3, 10, "SHIPPED", Decimal("1.00"))],
        "order_id int, customer_id int, status string, total_amount decimal(12,2)",
    )
    got = rows(click_order_join(sessions, orders))
    # customer 10: 3 clicks over 2 sessions, 1 checkout; 3 orders, net 4.00 (no click x order fan-out)
    assert got == [(10, 3, 2, 1, 3, Decimal("4.00")), (11, 1, 1, 0, 0, Decimal("0.00"))]
