"""Reporting and validation queries over Bronze/Silver/Gold (RPT-1..RPT-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.scd2 import VALID_FROM, VALID_TO, current_flag

HISTORY_VIEW_COLS = ("product_id", "price", "is_discontinued", "is_current", VALID_FROM, VALID_TO)


def events_per_type(events: DataFrame) -> DataFrame:
    """RPT-1: events per type, most frequent first (AGG-16, ORD-2)."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).orderBy(F.desc("event_count"), "event_type")


def repriced_products(products_history: DataFrame) -> DataFrame:
    """RPT-3: every version of products that have more than one version (JOIN-4, AGG-14, ORD-3).

    The ``IN (select ... having count(*) > 1)`` subquery is a count over the product's versions, so
    the history is built once.
    """
    versions = F.count(F.lit(1)).over(Window.partitionBy("product_id"))
    return (
        current_flag(products_history)
        .withColumn("_versions", versions)
        .filter(F.col("_versions") > 1)
        .select(*HISTORY_VIEW_COLS)
        .orderBy("product_id", VALID_FROM)
    )


def discontinued_latest(products_history: DataFrame, k: int = 10) -> DataFrame:
    """RPT-4: the ``k`` most recently opened versions of discontinued products (FLT-12, ORD-4).

    The top-k is the feature.  ``product_id`` breaks ties on the open time, which makes the pick
    deterministic; Spark plans it as ``TakeOrderedAndProject`` (per-task top-k, then a merge).
    """
    flagged = current_flag(products_history)
    return (
        flagged.filter(F.col("is_discontinued"))
        .orderBy(F.col(VALID_FROM).desc(), F.col("product_id").asc())
        .limit(k)
        .select(*HISTORY_VIEW_COLS)
    )


def customer_history(customers_history: DataFrame, customer_id: int) -> DataFrame:
    """RPT-5: all versions of one customer (FLT-13), oldest first."""
    return customers_history.filter(F.col("customer_id") == customer_id).orderBy(VALID_FROM)


def product_price_history(products_history: DataFrame, product_id: int) -> DataFrame:
    """RPT-6: repricing history of one product with its current flag."""
    return (
        current_flag(products_history)
        .filter(F.col("product_id") == product_id)
        .select(*HISTORY_VIEW_COLS)
        .orderBy(VALID_FROM)
    )


def top_customers(ltv: DataFrame, k: int | None = 10) -> DataFrame:
    """RPT-8: customers by lifetime revenue, highest first; ``k`` keeps the top-k (the feature)."""
    ordered = ltv.orderBy(F.col("lifetime_revenue").desc(), F.col("customer_id").asc())
    return ordered.limit(k) if k else ordered


def order_status_breakdown(daily: DataFrame) -> DataFrame:
    """RPT-10: the dashboard's status tile — DS-12's status counts unpivoted and summed."""
    totals = daily.agg(
        F.sum("delivered_orders").alias("delivered"),
        F.sum("cancelled_orders").alias("cancelled"),
        F.sum("in_flight_orders").alias("in_flight"),
        (F.sum("total_orders") - F.sum("delivered_orders") - F.sum("cancelled_orders") - F.sum("in_flight_orders")).alias(
            "other"
        ),
    )
    return totals.unpivot([], ["delivered", "cancelled", "in_flight", "other"], "status_group", "order_count")
