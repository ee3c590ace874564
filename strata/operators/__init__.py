"""DataFrame -> DataFrame operators."""

from strata.operators.cleaning import (
    silver_customers,
    silver_order_items,
    silver_orders,
    silver_payments,
    silver_products,
)
from strata.operators.dedup import keep_latest
from strata.operators.joins import click_order_join
from strata.operators.quality import (
    accepted_values_violations,
    foreign_key_violations,
    not_null_violations,
    row_counts,
    run_checks,
    unique_violations,
)
from strata.operators.sales import customer_ltv, daily_sales
from strata.operators.scd2 import as_of_join, current_flag, snapshot, snapshot_changes, version_stats
from strata.operators.sequence import sequence_within_groups
from strata.operators.sessions import funnel, session_events, sessionize
from strata.operators.upsert import merge_frames

__all__ = [
    "silver_customers",
    "silver_order_items",
    "silver_orders",
    "silver_payments",
    "silver_products",
    "keep_latest",
    "click_order_join",
    "accepted_values_violations",
    "foreign_key_violations",
    "not_null_violations",
    "row_counts",
    "run_checks",
    "unique_violations",
    "customer_ltv",
    "daily_sales",
    "as_of_join",
    "current_flag",
    "snapshot",
    "snapshot_changes",
    "version_stats",
    "sequence_within_groups",
    "funnel",
    "session_events",
    "sessionize",
    "merge_frames",
]
