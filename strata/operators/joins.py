"""Clickstream <-> orders per customer (JOIN-8).

The reference names this join as an aim without SQL.  Ours: both sides are aggregated to one
row per customer *before* the join (partial aggregation map-side), so the join is 1:1 and
cannot multiply clicks by orders or be skewed by a hot customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sales import CANCELLED


def click_order_join(sessions: DataFrame, orders: DataFrame, customer_col: str = "customer_id") -> DataFrame:
    """Per identified customer: clicks, sessions, checkouts, and their orders and net revenue."""
    clicks = (
        sessions.filter(F.col(customer_col).isNotNull())
        .groupBy(customer_col)
        .agg(
            F.count(F.lit(1)).alias("click_events"),
            F.count_distinct("session_id").alias("click_sessions"),
            F.count_if(F.col("event_type") == "checkout_start").alias("checkout_events"),
        )
    )
    per_customer = orders.groupBy(customer_col).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.when(F.col("status") != CANCELLED, F.col("total_amount")).otherwise(F.lit(0))).alias("net_revenue"),
    )
    j = clicks.join(per_customer, customer_col, "left")
    return j.select(
        customer_col,
        "click_events",
        "click_sessions",
        "checkout_events",
        F.coalesce(F.col("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.col("net_revenue"), F.lit(0)).alias("net_revenue"),
    )
