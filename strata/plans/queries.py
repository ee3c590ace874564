"""The registered queries: every Silver/Gold model, snapshot, report and ingest step of the
reference, run over the driver's tables through the adapters (SURVEY §7.3).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the *whole* tables.  It is lazy but for the
queries of stored things, which write them first: the streams, ``upsert_orders_stored`` and ``dq_report``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import upper_trim
from strata.operators.cleaning import (
    silver_customers,
    silver_order_items,
    silver_orders,
    silver_payments,
    silver_products,
)
from strata.operators.joins import click_order_join
from strata.operators.quality import ALL_RULES, foreign_key_violations, row_counts, run_checks
from strata.operators.sales import customer_ltv, daily_sales, daily_sales_of, daily_sales_partials, merge_daily_sales
from strata.operators.scd2 import VALID_FROM, as_of_join, current_flag, snapshot_series, version_stats
from strata.operators.sessions import funnel, session_events, sessionize
from strata.operators.upsert import merge_frames
from strata.plans import reports
from strata.plans.pipeline import CUSTOMER_SNAPSHOT, PRODUCT_SNAPSHOT
from strata.session import scratch_path
from strata.sinks.metrics import known_failures, observed, rule_aggregates
from strata.sinks.tables import buckets_of_rows, upsert_table
from strata.sources import adapters as A
from strata.sources.incremental import extract_incremental

# --- Silver ------------------------------------------------------------------------------
def q_silver_customers(spark: SparkSession, d: str) -> DataFrame:
    """DS-1 (WIN-1, FLT-4, FLT-5, PRJ-3)."""
    return silver_customers(A.customers_delivered(spark, d))


def q_silver_products(spark: SparkSession, d: str) -> DataFrame:
    """DS-2 (WIN-1, FLT-8, PRJ-4)."""
    return silver_products(A.products_delivered(spark, d))


def q_silver_orders(spark: SparkSession, d: str) -> DataFrame:
    """DS-3 (WIN-1, FLT-6, PRJ-5)."""
    return silver_orders(A.orders_delivered(spark, d))


def q_silver_order_items(spark: SparkSession, d: str) -> DataFrame:
    """DS-4 (FLT-9, PRJ-7)."""
    return silver_order_items(A.order_items(spark, d))


def q_silver_payments(spark: SparkSession, d: str) -> DataFrame:
    """DS-5 (WIN-1, FLT-7, PRJ-6)."""
    return silver_payments(A.payments(spark, d))


def q_silver_clickstream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """DS-6 (FLT-3, PRJ-8..10, WIN-2..4)."""
    return sessionize(A.clickstream_events(spark, d))


# --- Gold --------------------------------------------------------------------------------
def q_gold_daily_sales_summary(spark: SparkSession, d: str) -> DataFrame:
    """DS-12 / RPT-7 (AGG-3..7, AGG-12, ORD-1)."""
    return daily_sales(q_silver_orders(spark, d)).orderBy("order_day")


def q_gold_customer_ltv(spark: SparkSession, d: str) -> DataFrame:
    """DS-13 (JOIN-1..3, PRJ-12..14)."""
    return customer_ltv(
        q_silver_customers(spark, d),
        q_silver_orders(spark, d),
        q_silver_payments(spark, d),
        as_of=A.LTV_AS_OF,
        unique_keys=True,  # keep_latest has just made them so
    )


def _cleaned(orders: DataFrame) -> DataFrame:
    """Order rows with the status as ``silver_orders`` writes it, but no dedup: ids repeat."""
    valid = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("total_amount") >= 0)
    return orders.filter(valid).withColumn("status", upper_trim("status"))


def q_daily_sales_of_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """AGG-3..7 on repeated ids: orders with their second deliveries (changed status, amount and customer), merged from
    the partial results of two batches."""
    first = _cleaned(A.orders(spark, d))
    second = _cleaned(A.orders_delivered_again(spark, d))
    return daily_sales_of(merge_daily_sales(daily_sales_partials(first).unionByName(daily_sales_partials(second))))


def q_customer_ltv_of_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """DS-13 on repeated ids: every delivery of an order and every attempt of a payment is a row (AGG-4, JOIN-3)."""
    payments = A.payments(spark, d).withColumn("status", upper_trim("status"))
    return customer_ltv(q_silver_customers(spark, d), _cleaned(A.orders_delivered(spark, d)), payments, as_of=A.LTV_AS_OF)


def q_gold_clickstream_funnel(spark: SparkSession, d: str) -> DataFrame:
    """DS-14 / RPT-9 (AGG-10, AGG-11, AGG-15, PRJ-15, PRJ-16)."""
    # the funnel reads session, type and anonymous flag only: the sequence is not needed
    return funnel(session_events(A.clickstream_events(spark, d)))


# --- Snapshots (three runs: base, changed/deleted, restored) -------------------------------
def customers_history(spark: SparkSession, d: str, only: int | None = None) -> DataFrame:
    """SCD-2: three snapshot runs of customers (base, moved and deleted, restored); ``only`` one key's, read with the
    key pushed into the scan (histories of different keys are independent)."""
    key, check, cols = CUSTOMER_SNAPSHOT
    return snapshot_series(_of_key(A.customers_runs(spark, d), key, only).select("_run", *cols), key, check, A.SNAPSHOT_RUNS)


def products_history(spark: SparkSession, d: str, only: int | None = None) -> DataFrame:
    """SCD-3: three snapshot runs of products (base, repriced and discontinued, restored); ``only`` as above."""
    key, check, cols = PRODUCT_SNAPSHOT
    return snapshot_series(_of_key(A.products_runs(spark, d), key, only).select("_run", *cols), key, check, A.SNAPSHOT_RUNS)


def _of_key(extract: DataFrame, key: str, only: int | None) -> DataFrame:
    return extract if only is None else extract.filter(F.col(key) == only)


def q_customers_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """DS-10 (SCD-1, SCD-2, JOIN-6)."""
    return customers_history(spark, d)


def q_products_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """DS-11 (SCD-1, SCD-3, SCD-4)."""
    return products_history(spark, d)


def q_customers_current_flag(spark: SparkSession, d: str) -> DataFrame:
    """DS-8 (SCD-5, PRJ-11)."""
    return current_flag(customers_history(spark, d))


def q_products_current_flag(spark: SparkSession, d: str) -> DataFrame:
    """DS-9 (SCD-5, PRJ-11)."""
    return current_flag(products_history(spark, d))


def q_customer_profile_history(spark: SparkSession, d: str) -> DataFrame:
    """DS-7 (SCD-6, AGG-13, PRJ-17)."""
    return version_stats(customers_history(spark, d), "customer_id")


def q_as_of_price_at_sale(spark: SparkSession, d: str) -> DataFrame:
    """Each order line with the catalogue price valid when it was created (NULL before the first version)."""
    items = q_silver_order_items(spark, d)
    priced = as_of_join(
        items,
        products_history(spark, d),
        key="product_id",
        fact_time="created_at",
        columns=["price", VALID_FROM],
        prefix="catalog_",
    )
    return priced.withColumnRenamed(f"catalog_{VALID_FROM}", "price_valid_from")


# --- Joins, upsert, ingest ---------------------------------------------------------------------
def q_click_order_join(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-8."""
    return click_order_join(session_events(A.clickstream_events(spark, d)), q_silver_orders(spark, d))


def q_upsert_orders(spark: SparkSession, d: str) -> DataFrame:
    """SNK-3 / JOIN-5: Bronze orders as of the cutoff merged with the batch since."""
    return merge_frames(A.orders_before(spark, d), A.orders_batch_since(spark, d), ["order_id"], ["updated_at"])


def q_upsert_orders_stored(spark: SparkSession, d: str) -> DataFrame:
    """SNK-2, SNK-3, PIPE-1: a Bronze table stored by key and year, created and upserted twice, read back.

    The second batch is ``upsert_orders``'s; the third has two rows of each of its keys, and moves some to another year.
    The writes happen when the query is built; the files that the table points to afterwards are the result.  The number of
    buckets follows the number of orders, so that what one task sorts and joins does not grow with them.
    """
    root = scratch_path(spark, "upsert-orders")
    buckets = buckets_of_rows(A.orders(spark, d).count())
    name = f"strata_upsert_{uuid.uuid4().hex[:12]}"
    year = F.year("created_at")
    for batch in (A.orders_before(spark, d), A.orders_batch_since(spark, d), A.orders_rescheduled(spark, d)):
        upsert_table(spark, name, batch.withColumn("_created_year", year), ["order_id"], ["updated_at"], root=root, partition_by=["_created_year"], buckets=buckets)
    stored = spark.table(name)
    out = spark.read.schema(stored.drop("_created_year").schema).parquet(*stored.inputFiles())
    spark.sql(f"DROP TABLE {name}")  # external: the files stay until the session's scratch folder goes
    return out


def q_incremental_extract(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1 / FLT-1: rows above the watermark, pushed into the scan."""
    return extract_incremental(A.orders(spark, d), "updated_at", A.INCREMENTAL_SINCE)


# --- Data tests ----------------------------------------------------------------------------
def bronze_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The Bronze tables that the data tests read."""
    return {
        "bronze.customers": A.customers(spark, d),
        "bronze.products": A.products(spark, d),
        "bronze.orders": A.orders(spark, d),
        "bronze.order_items": A.order_items(spark, d),
        "bronze.payments": A.payments(spark, d),
        "bronze.clickstream_events": A.clickstream_events(spark, d),
    }


def q_dq_report(spark: SparkSession, d: str) -> DataFrame:
    """DQ-1..3, DQ-5: the 39 declared tests, as a run of the models tests them.

    The Silver tables that Gold reads are written first; their row-wise tests are observed by those writes, and the others
    and Gold read what was written.  The remaining tables are read once each.
    """
    rules = {r.model: r for r in ALL_RULES}
    tables = bronze_tables(spark, d)
    tables["silver_products"] = silver_products(A.products_delivered(spark, d))
    tables["silver_order_items"] = silver_order_items(tables["bronze.order_items"])
    # every column with a test is there without the sequence
    tables["silver_clickstream_sessions"] = session_events(tables["bronze.clickstream_events"])
    tables["customers_snapshot"] = customers_history(spark, d)
    tables["products_snapshot"] = products_history(spark, d)
    known = {}
    for name, model in (
        ("silver_customers", silver_customers(A.customers_delivered(spark, d))),
        ("silver_orders", silver_orders(A.orders_delivered(spark, d))),
        ("silver_payments", silver_payments(tables["bronze.payments"])),
    ):
        path = scratch_path(spark, name)
        out, seen = observed(model, **rule_aggregates(rules[name]))
        out.write.parquet(path)
        known[name] = known_failures(seen.get, rules[name])
        tables[name] = spark.read.schema(model.schema).parquet(path)
    tables["gold_daily_sales_summary"] = daily_sales(tables["silver_orders"], unique_orders=True)
    tables["gold_customer_ltv"] = customer_ltv(*(tables[f"silver_{n}"] for n in ("customers", "orders", "payments")), as_of=A.LTV_AS_OF, unique_keys=True)
    return run_checks(tables, ALL_RULES, known)


def q_foreign_key_violations(spark: SparkSession, d: str) -> DataFrame:
    """DQ-4 over the four source relationships."""
    customers, orders = A.customers(spark, d), A.orders_delivered(spark, d)
    items, products, pays = A.order_items(spark, d), A.products(spark, d), A.payments(spark, d)
    checks = [
        ("orders.customer_id -> customers", orders, "customer_id", customers, "customer_id"),
        ("order_items.order_id -> orders", items, "order_id", orders, "order_id"),
        ("order_items.product_id -> products", items, "product_id", products, "product_id"),
        ("payments.order_id -> orders", pays, "order_id", orders, "order_id"),
    ]
    out = None
    for name, child, fk, parent, pk in checks:
        part = foreign_key_violations(child, fk, parent, pk).select(
            F.lit(name).alias("relationship"), F.col(fk).cast("bigint").alias("key_value"), "child_rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


def q_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """DQ-6 / RPT-2."""
    return row_counts(spark, bronze_tables(spark, d))


# --- Reports -----------------------------------------------------------------------------------
def q_events_per_type(spark: SparkSession, d: str) -> DataFrame:
    """RPT-1 (AGG-16, ORD-2)."""
    return reports.events_per_type(A.clickstream_events(spark, d))


def q_repriced_products(spark: SparkSession, d: str) -> DataFrame:
    """RPT-3 (JOIN-4, AGG-14, ORD-3)."""
    return reports.repriced_products(products_history(spark, d))


def q_discontinued_top10(spark: SparkSession, d: str) -> DataFrame:
    """RPT-4 (FLT-12, ORD-4)."""
    return reports.discontinued_latest(products_history(spark, d), k=10)


def q_customer_history(spark: SparkSession, d: str) -> DataFrame:
    """RPT-5 (FLT-13)."""
    return reports.customer_history(customers_history(spark, d, only=1), customer_id=1)


def q_product_price_history(spark: SparkSession, d: str) -> DataFrame:
    """RPT-6 (FLT-13)."""
    return reports.product_price_history(products_history(spark, d, only=2), product_id=2)


def q_top_customers_ltv(spark: SparkSession, d: str) -> DataFrame:
    """RPT-8 (ORD-5)."""
    return reports.top_customers(q_gold_customer_ltv(spark, d), k=10)


def q_order_status_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """RPT-10."""
    return reports.order_status_breakdown(daily_sales(q_silver_orders(spark, d)))


def q_bronze_customers(spark: SparkSession, d: str) -> DataFrame:
    """RPT-11: the Bronze customers table."""
    return A.customers(spark, d)


def q_stream_decode_events(spark: SparkSession, d: str) -> DataFrame:
    from strata.streaming.ingest import drain

    sink = drain(A.event_message_stream(spark, d))
    # ingestion time is not reproducible; event time compared zone-free
    return sink.drop("_ingested_at", "_source_system").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("event_time", "kafka_timestamp")}
    )


def q_stream_decode_events_lenient(spark: SparkSession, d: str) -> DataFrame:
    """The same drain with lenient decoding: drifted fields and epoch-millisecond times repaired."""
    from strata.streaming.ingest import drain

    sink = drain(A.event_message_stream(spark, d), mode="lenient")
    return sink.drop("_ingested_at", "_source_system").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("event_time", "kafka_timestamp")}
    )


def q_stream_message_split(spark: SparkSession, d: str) -> DataFrame:
    """STR-2, STR-6, SNK-5: every message of a stream with broken ones, from the table it ended in: events with the keys
    that the schema does not know, dead letters with text and reason."""
    from strata.streaming.batches import ingest_batches, read_batches

    root = scratch_path(spark, "stream-batches")
    name = f"strata_events_{uuid.uuid4().hex[:12]}"
    typed = A.broken_message_stream(spark, d).select(F.col("value").cast("string"), F.col("timestamp").cast("timestamp"))
    ingest_batches(typed, f"{root}/_checkpoint", name, f"{root}/table")
    events, dead = read_batches(spark, name, drop=True)
    no = F.lit(None).cast("string")
    return events.select("event_id", "session_id", F.to_json("_unknown").alias("unknown"), no.alias("message"), no.alias("reason")).unionByName(
        dead.select(no.alias("event_id"), no.alias("session_id"), no.alias("unknown"), F.col("json_value").alias("message"), F.col("_reason").alias("reason"))
    )


def q_stream_drift_report(spark: SparkSession, d: str) -> DataFrame:
    """Per field: values the strict decode loses, the lenient decode repairs, or nobody can read."""
    from strata.streaming.decode import drift_report

    return drift_report(A.event_messages(spark, d))


QUERIES = {
    "silver_customers": q_silver_customers,
    "silver_products": q_silver_products,
    "silver_orders": q_silver_orders,
    "silver_order_items": q_silver_order_items,
    "silver_payments": q_silver_payments,
    "silver_clickstream_sessions": q_silver_clickstream_sessions,
    "gold_daily_sales_summary": q_gold_daily_sales_summary,
    "gold_customer_ltv": q_gold_customer_ltv,
    "daily_sales_of_deliveries": q_daily_sales_of_deliveries,
    "customer_ltv_of_deliveries": q_customer_ltv_of_deliveries,
    "gold_clickstream_funnel": q_gold_clickstream_funnel,
    "customers_snapshot": q_customers_snapshot,
    "products_snapshot": q_products_snapshot,
    "customers_current_flag": q_customers_current_flag,
    "products_current_flag": q_products_current_flag,
    "customer_profile_history": q_customer_profile_history,
    "as_of_price_at_sale": q_as_of_price_at_sale,
    "click_order_join": q_click_order_join,
    "upsert_orders": q_upsert_orders,
    "upsert_orders_stored": q_upsert_orders_stored,
    "incremental_extract": q_incremental_extract,
    "dq_report": q_dq_report,
    "foreign_key_violations": q_foreign_key_violations,
    "events_per_type": q_events_per_type,
    "row_counts": q_row_counts,
    "repriced_products": q_repriced_products,
    "discontinued_top10": q_discontinued_top10,
    "customer_history": q_customer_history,
    "product_price_history": q_product_price_history,
    "top_customers_ltv": q_top_customers_ltv,
    "order_status_breakdown": q_order_status_breakdown,
    "bronze_customers": q_bronze_customers,
    "stream_decode_events": q_stream_decode_events,
    "stream_decode_events_lenient": q_stream_decode_events_lenient,
    "stream_message_split": q_stream_message_split,
    "stream_drift_report": q_stream_drift_report,
}
