"""Clickstream sequencing (DS-6) and the conversion funnel (DS-14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.math import pct
from strata.functions.text import lower_trim
from strata.functions.time import elapsed_seconds
from strata.operators.sequence import sequence_within_groups

# The decoded event columns carried into Silver, in output order.
EVENT_COLUMNS = (
    "event_id event_type event_time session_id customer_id device page_url referrer "
    "user_agent ip_address product_id quantity search_term cart_value"
).split()

# Funnel stages (event type -> output column stem), in funnel order.
FUNNEL_STAGES = (
    ("page_view", "page_view"),
    ("product_view", "product_view"),
    ("add_to_cart", "add_to_cart"),
    ("checkout_start", "checkout"),
)


def session_events(
    events: DataFrame,
    time_col: str = "event_time",
    type_col: str = "event_type",
    customer_col: str = "customer_id",
) -> DataFrame:
    """The per-event part of Silver sessions, without the sequence: drops events whose time
    failed to parse (FLT-3), normalises the type (PRJ-8) and adds the per-event anonymous flag
    (PRJ-10, ledger L14).  Aggregates over sessions (funnel, per-customer clicks) need only this."""
    passthrough = [c for c in EVENT_COLUMNS if c in events.columns]
    return (
        events.filter(F.col(time_col).isNotNull())
        .withColumn(type_col, lower_trim(type_col))
        .select(*passthrough, F.col(customer_col).isNull().alias("is_anonymous_session"))
    )


def sessionize(
    events: DataFrame,
    session_col: str = "session_id",
    time_col: str = "event_time",
    type_col: str = "event_type",
    customer_col: str = "customer_id",
    tie_cols: Sequence[str] = ("event_id",),
) -> DataFrame:
    """Silver ``silver_clickstream_sessions``: one row per event with its place in the session.

    ``session_events`` plus the sequence: events numbered by time within the session with
    ``tie_cols`` as tie-break (WIN-2, ledger L8), the previous event's time and type (WIN-3,
    WIN-4) and the whole-second gap (PRJ-9).  A big session is spread over tasks by the hour (see
    ``sequence_within_groups``).
    """
    src = session_events(events, time_col, type_col, customer_col)
    ties = [c for c in tie_cols if c in src.columns]  # without a tie column: time order only, as in SQL
    seq = sequence_within_groups(
        src,
        group_col=session_col,
        order_cols=[time_col, *ties],
        carry_cols=[time_col, type_col],
    )
    passthrough = [c for c in EVENT_COLUMNS if c in events.columns]
    return seq.select(
        *passthrough,
        F.col("_seq").cast("int").alias("event_sequence_in_session"),
        F.col(f"_prev_{type_col}").alias("previous_event_type"),
        elapsed_seconds(time_col, f"_prev_{time_col}").alias("seconds_since_previous_event"),
        "is_anonymous_session",
    )


def funnel(
    sessions: DataFrame,
    session_col: str = "session_id",
    type_col: str = "event_type",
    anonymous_col: str = "is_anonymous_session",
) -> DataFrame:
    """Gold ``gold_clickstream_funnel``: one row, independent "ever reached" stage flags (L15).

    Stage 1 is a group-by on the session (partial aggregation before the shuffle, so a hot
    session is reduced map-side); stage 2 is a global aggregate of one row per session.  Over
    zero sessions the result is one row with count 0 and NULL sums and rates (L21).
    """
    flags = sessions.groupBy(session_col).agg(
        *[
            F.max(F.when(F.col(type_col) == etype, 1).otherwise(0)).alias(f"reached_{stem}")
            for etype, stem in FUNNEL_STAGES
        ],
        F.max(F.when(F.col(anonymous_col), 1).otherwise(0)).alias("is_anonymous"),
    )
    counts = flags.agg(
        *[F.sum(f"reached_{stem}").alias(f"sessions_{stem}") for _, stem in FUNNEL_STAGES],
        F.sum("is_anonymous").alias("anonymous_sessions"),
        F.count(F.lit(1)).alias("total_sessions"),
    )
    return counts.select(
        "total_sessions",
        "anonymous_sessions",
        (F.col("total_sessions") - F.col("anonymous_sessions")).alias("identified_sessions"),
        "sessions_page_view",
        "sessions_product_view",
        "sessions_add_to_cart",
        "sessions_checkout",
        pct("sessions_product_view", "sessions_page_view").alias("pct_page_to_product"),
        pct("sessions_add_to_cart", "sessions_product_view").alias("pct_product_to_cart"),
        pct("sessions_checkout", "sessions_add_to_cart").alias("pct_cart_to_checkout"),
        pct("sessions_checkout", "sessions_page_view").alias("pct_overall_conversion"),
    )
