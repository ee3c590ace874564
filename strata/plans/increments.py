"""The model step for what a run changed (PIPE-3, SNK-6), instead of every table whole.

The ledger tells which landed batches no model step has seen.  Their keys are the changed orders, lines and payments; the
events ingested since are the changed sessions.  Only these rows of Silver are computed, from Bronze, and replaced by key;
only the days of changed orders (where they were and where they are now) are summed anew for Gold.  A key whose
row is no longer valid, or whose day has no order left, goes.

Tables that change this way are stored by key and a day or month (``part_format``), as ``<name>__stored``; ``<name>`` is a view
of the model's columns.  Rewritten are the partitions that hold changed keys, and nothing else.  The tables that
depend on all rows or on today (lifetime value, funnel, clicks with orders, the dimensions) are rebuilt from Silver
as in ``pipeline.build_layers``.  The result equals a full rebuild.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.time import to_day
from strata.operators.cleaning import silver_order_items, silver_orders, silver_payments
from strata.operators.sales import daily_sales
from strata.operators.sessions import EVENT_COLUMNS, sessionize
from strata.session import remove_path
from strata.sinks.tables import create_keyed, replace_keys, stored_partitions, vacuum_versions, values_filter

KEY, PART = "_key", "_part"


class Changes:
    """The keys that landed since the last model step, per table, and the instants between which events were ingested."""

    def __init__(self, spark: SparkSession, landed: dict[str, list[str]], events_after: str | None, events_upto: str | None):
        self.spark, self.landed = spark, landed
        self.events_after, self.events_upto = events_after, events_upto

    def keys(self, table: str, key: str) -> DataFrame | None:
        """The changed keys of a Bronze table; None if nothing landed."""
        if not self.landed.get(table):
            return None
        return self.spark.read.parquet(*self.landed[table]).select(key).distinct()


class Ledger(Protocol):
    """The finished tables of a model step."""

    def has(self, name: str) -> bool: ...

    def location(self, name: str) -> str | None: ...

    def finished(self, name: str, location: str | None) -> None: ...


class KeyedModels:
    """Model tables that are replaced by key."""

    def __init__(self, spark: SparkSession, db: str, root: str, part_format: str, buckets: int, retain: int):
        self.spark, self.db, self.root = spark, db, root
        self.part_format, self.buckets, self.retain = part_format, buckets, retain

    def stored(self, name: str) -> str:
        return f"{self.db}.{name}__stored"

    def there(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.stored(name))

    def laid_out(self, rows: DataFrame, key: Column, time: str) -> DataFrame:
        return rows.withColumns({KEY: key, PART: F.date_format(F.col(time).cast("timestamp"), self.part_format)})

    def create(self, name: str, rows: DataFrame, key: Column, time: str) -> None:
        """Store a model whole, and show it under its name."""
        create_keyed(self.laid_out(rows, key, time), self.stored(name), self.root, [KEY], [PART], self.buckets)
        kind = next((t.tableType for t in self.spark.catalog.listTables(self.db) if t.name == name), None)
        if kind is not None and kind != "VIEW":  # it was built whole before
            self.spark.sql(f"DROP TABLE {self.db}.{name}")
        listed = ", ".join(f"`{c}`" for c in rows.columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.db}.{name} AS SELECT {listed} FROM {self.stored(name)}")

    def replace(self, name: str, rows: DataFrame, key: Column, time: str, gone: DataFrame) -> str:
        """Replace the rows of the ``gone`` keys (column ``_key``) by ``rows``, whose keys are among them."""
        path = replace_keys(self.spark, self.stored(name), self.laid_out(rows, key, time), [KEY], [PART], gone)
        vacuum_versions(self.spark, self.stored(name), keep=self.retain)
        return path

    def of_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The stored rows of some keys (column ``_key``), from the partitions that have them."""
        table = self.spark.table(self.stored(name))
        parts = [tuple(r) for r in stored_partitions(table, keys, [KEY], [PART]).collect()]
        return table.filter(values_filter(parts, [PART])).join(keys, KEY, "left_semi")


def ingested_upto(events: DataFrame | None) -> str | None:
    """The last instant at which an event was ingested, as text."""
    if events is None:
        return None
    return events.agg(F.date_format(F.max("_ingested_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first().t


def _between(events: DataFrame, after: str | None, upto: str | None) -> DataFrame:
    at = F.col("_ingested_at")
    if upto is None:
        return events.filter(F.lit(False))
    newer = events.filter(at <= F.lit(upto).cast("timestamp"))
    return newer if after is None else newer.filter(at > F.lit(after).cast("timestamp"))


def build_changed(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    silver: KeyedModels,
    gold: KeyedModels,
    changes: Changes,
    ledger: Ledger,
) -> None:
    """Bring the keyed Silver and Gold tables up to date; what ``ledger`` has as done is left alone."""
    done, finished = ledger.has, ledger.finished

    def update(name: str, table: str, key: str, time: str, model: Callable[[DataFrame], DataFrame]) -> None:
        if done(name):
            return
        if not silver.there(name):
            silver.create(name, model(bronze[table]), F.col(key), time)
            path = "whole"
        elif (keys := changes.keys(table, key)) is None:
            path = None
        else:
            rows = model(bronze[table].join(keys, key, "left_semi"))
            path = silver.replace(name, rows, F.col(key), time, keys.withColumnRenamed(key, KEY))
        finished(name, path)

    # the days of changed orders: those they are stored under now, before they are replaced, and those of their new rows
    if not done("gold_daily_sales_summary") and not done("silver_orders") and silver.there("silver_orders") and gold.there("gold_daily_sales_summary"):
        keys = changes.keys("orders", "order_id")
        days = f"{silver.root.rstrip('/')}/_pending/days-{uuid.uuid4().hex[:12]}"  # outlives this driver
        if keys is not None:
            before = silver.of_keys("silver_orders", keys.withColumnRenamed("order_id", KEY)).select(to_day("order_date").alias(KEY))
            after = silver_orders(bronze["orders"].join(keys, "order_id", "left_semi")).select(to_day("order_date").alias(KEY))
            before.unionByName(after).distinct().write.parquet(days)
            finished("changed_days", days)
    update("silver_orders", "orders", "order_id", "order_date", silver_orders)
    update("silver_payments", "payments", "payment_id", "created_at", silver_payments)
    update("silver_order_items", "order_items", "order_item_id", "created_at", silver_order_items)

    if not done("gold_daily_sales_summary"):
        name = "gold_daily_sales_summary"
        orders = spark.table(silver.stored("silver_orders"))
        if not gold.there(name):
            gold.create(name, daily_sales(orders, unique_orders=True), F.col("order_day"), "order_day")
            path = "whole"
        elif not changes.landed.get("orders"):
            path = None
        else:
            days = spark.read.parquet(ledger.location("changed_days"))
            parts = [tuple(r) for r in days.select(F.date_format(F.col(KEY).cast("timestamp"), silver.part_format)).distinct().collect()]
            own = orders.filter(values_filter(parts, [PART])).withColumn(KEY, to_day("order_date")).join(days, KEY, "left_semi")
            path = gold.replace(name, daily_sales(own, unique_orders=True), F.col("order_day"), "order_day", days)
            remove_path(spark, ledger.location("changed_days"))
        finished(name, path)

    name = "silver_clickstream_sessions"
    if "clickstream_events" in bronze and not done(name):
        key = F.coalesce(F.col("session_id"), F.lit(""))
        columns = [c for c in EVENT_COLUMNS if c in bronze["clickstream_events"].columns]
        if not silver.there(name):
            silver.create(name, sessionize(_between(bronze["clickstream_events"], None, changes.events_upto)), key, "event_time")
            path = "whole"
        elif changes.events_upto == changes.events_after:
            path = None
        else:
            new = _between(bronze["clickstream_events"], changes.events_after, changes.events_upto).select(*columns)
            keys = new.filter("event_time is not null").select(key.alias(KEY)).distinct()
            # a session's earlier events are in Silver already, cleaned, which cleaning again leaves as they are
            whole = silver.of_keys(name, keys).select(*columns).unionByName(new)
            path = silver.replace(name, sessionize(whole), key, "event_time", keys)
        finished(name, path)


def noted_events(detail: str | None) -> str | None:
    """The instant up to which the last model step had taken events."""
    return json.loads(detail).get("events_upto") if detail else None


def note_events(upto: str | None) -> str:
    return json.dumps({"events_upto": upto})

