"""The medallion pipeline: setup (DDL-1..3), batch + stream ingest (PIPE-1, PIPE-2), transform
(snapshot -> silver -> gold -> tests, PIPE-3) and the whole run (PIPE-4).

Every model is a function call on DataFrames; a layer is stored only where the reference
stores it (SNK-6).  Model tables are rebuilt into fresh version folders and repointed, so
readers of the previous version are unaffected and nothing overwrites what it reads; snapshots
append one partition per run (``sinks/snapshots.py``); old versions are pruned to ``RETAIN``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strata.operators.cleaning import (
    silver_customers,
    silver_order_items,
    silver_orders,
    silver_payments,
    silver_products,
)
from strata.operators.joins import click_order_join
from strata.operators.quality import ALL_RULES, FOREIGN_KEYS, REPORT_SCHEMA, row_counts, run_checks, run_relationships
from strata.operators.sales import customer_ltv, daily_sales
from strata.operators.scd2 import version_stats
from strata.operators.sessions import funnel, sessionize
from strata.plans.increments import Changes, KeyedModels, build_changed, ingested_upto, note_events, noted_events
from strata.plans.ledger import Run, RunLedger
from strata.sinks.snapshots import compact_snapshot, compacted_run, snapshot_run, vacuum_snapshot
from strata.sinks.metrics import ROWS, as_note, current_metrics, known_failures, observed, rule_aggregates
from strata.sinks.tables import hadoop_path, materialize, table_location, vacuum_versions
from strata.sources.incremental import TABLES_CONFIG, TableConfig, ensure_control_table, ingest_all
from strata.streaming.batches import ingest_batches
from strata.streaming.ingest import ingest_stream

# Layer schemas, and the snapshot configurations (key, check columns, columns).
LAYERS = ("landing", "bronze", "silver", "gold")
STEPS = ("ingest", "snapshot", "models", "test")
# Versions of each rebuilt table (and runs of each snapshot's open partition) kept on storage.
RETAIN = 3
# Runs of a snapshot after which its closed versions are merged into one partition.
COMPACT_AFTER = 96
# The ledger's note that a model step has built all of its tables.
MODELS_DONE = "models_done"
CUSTOMER_SNAPSHOT = (
    "customer_id",
    "first_name last_name email phone address_line city state country postal_code is_active".split(),
    "customer_id first_name last_name email phone address_line city state country postal_code "
    "signup_date is_active updated_at".split(),
)
PRODUCT_SNAPSHOT = (
    "product_id",
    "product_name category sub_category brand price is_discontinued".split(),
    "product_id product_name category sub_category brand price stock_qty is_discontinued updated_at".split(),
)


def schema_name(custom: str | None, default: str) -> str:
    """SNK-8: a custom schema is used verbatim (trimmed), else the target's."""
    return custom.strip() if custom is not None else default


def safe_create(spark: SparkSession, statement: str) -> bool:
    """DDL-1: run a CREATE; an object that already exists (or a location it already owns) is not
    an error, anything else is re-raised.  Returns whether something was created."""
    try:
        spark.sql(statement)
        return True
    except AnalysisException as e:
        condition = e.getCondition() or ""
        if condition.endswith("ALREADY_EXISTS") or condition == "LOCATION_OVERLAP":
            return False
        raise


@dataclass(frozen=True)
class Layout:
    root: str
    prefix: str = ""
    schemas: dict[str, str] | None = None  # custom names of layers (SNK-8)

    def db(self, layer: str) -> str:
        return schema_name((self.schemas or {}).get(layer), f"{self.prefix}{layer}")

    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing/raw_files"

    @property
    def tables(self) -> str:
        return f"{self.root.rstrip('/')}/tables"

    @property
    def control_table(self) -> str:
        return f"{self.db('bronze')}._ingestion_control"

    @property
    def ledger_table(self) -> str:
        return f"{self.db('bronze')}._run_ledger"

    def checkpoint(self, name: str) -> str:
        return f"{self.landing}/_checkpoints/{name}"


def setup(spark: SparkSession, layout: Layout) -> list[str]:
    """DDL-1..3: layer databases at their locations, the landing folder, the control table."""
    for layer in LAYERS:
        safe_create(
            spark,
            f"CREATE DATABASE IF NOT EXISTS {layout.db(layer)} LOCATION '{layout.root.rstrip('/')}/{layer}'",
        )
    fs, landing = hadoop_path(spark, layout.landing)
    fs.mkdirs(landing)
    ensure_control_table(spark, layout.control_table, layout.tables)
    RunLedger(spark, layout.ledger_table, layout.tables).log.ensure()
    return [r[0] for r in spark.sql("SHOW DATABASES").collect()]


def list_layers(spark: SparkSession, layout: Layout) -> DataFrame:
    """DDL-3: the tables and views of every layer, as a DataFrame ``(layer, name, kind)``."""
    rows = [
        (layer, t.name, t.tableType)
        for layer in LAYERS
        if spark.catalog.databaseExists(layout.db(layer))
        for t in spark.catalog.listTables(layout.db(layer))
    ]
    return spark.createDataFrame(rows, "layer string, name string, kind string")


class Steps:
    """The finished pieces of one step of a run, kept in the ledger."""

    def __init__(self, step: str, ledger: RunLedger, run_: Run):
        self.step, self.ledger, self.run = step, ledger, run_

    def has(self, name: str = "") -> bool:
        return self.run.has(self.step, name)

    def location(self, name: str) -> str | None:
        return self.run.done.get((self.step, name))

    def finished(self, name: str = "", location: str | None = None, detail: str | None = None) -> None:
        self.ledger.finished(self.run, self.step, name, location, detail)


def ingest_batch(
    spark: SparkSession,
    layout: Layout,
    sources: dict[str, DataFrame],
    configs: Sequence[TableConfig] = TABLES_CONFIG,
    run_date: _dt.date | str | None = None,
    steps: Steps | None = None,
):
    """PIPE-1 for every configured table, in order; the first failure aborts the run.  Tables that ``steps`` has as
    done are left out."""
    left = [cfg for cfg in configs if steps is None or not steps.has(cfg.source_table)]
    note = (lambda r: steps.finished(r.table, r.landed_path)) if steps is not None else None
    return ingest_all(spark, sources, layout.landing, layout.db("bronze"), layout.control_table, layout.tables, left, run_date, note)


def ingest_events(spark: SparkSession, layout: Layout, stream: DataFrame, mode: str = "strict", wait: bool = True, sink: str = "append"):
    """PIPE-2: drain the event stream into ``bronze.clickstream_events``.

    ``sink`` is ``append`` (the reference's file sink) or ``batches`` (``streaming.batches``: registered micro-batches that can be
    compacted, unknown keys kept, and ``bronze.clickstream_events_dead_letters`` for the messages that are no event)."""
    name = f"{layout.db('bronze')}.clickstream_events"
    if sink == "batches":
        return ingest_batches(stream, layout.checkpoint("clickstream_events"), name, f"{layout.tables}/{name.replace('.', '/')}", mode, wait)
    if sink != "append":
        raise ValueError(f"unknown event sink {sink!r}")
    return ingest_stream(stream, layout.checkpoint("clickstream_events"), table=name, mode=mode, wait=wait)


def build_models(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The Silver cleaning models as lazy DataFrames (nothing is stored here)."""
    models: dict[str, DataFrame] = {}
    models["silver_customers"] = silver_customers(bronze["customers"])
    models["silver_products"] = silver_products(bronze["products"])
    models["silver_orders"] = silver_orders(bronze["orders"])
    models["silver_order_items"] = silver_order_items(bronze["order_items"])
    models["silver_payments"] = silver_payments(bronze["payments"])
    if "clickstream_events" in bronze:
        models["silver_clickstream_sessions"] = sessionize(bronze["clickstream_events"])
    return models


BRONZE_TABLES = ("customers", "products", "orders", "order_items", "payments", "clickstream_events")
SILVER_TABLES = (
    "silver_customers",
    "silver_products",
    "silver_orders",
    "silver_order_items",
    "silver_payments",
    "silver_clickstream_sessions",
    "silver_customer_profile_history",
)
GOLD_TABLES = ("gold_daily_sales_summary", "gold_customer_ltv", "gold_clickstream_funnel")
SNAPSHOTS = ("customers_snapshot", "products_snapshot")


def _tables(spark: SparkSession, db: str, names) -> dict[str, DataFrame]:
    return {n: spark.table(f"{db}.{n}") for n in names if spark.catalog.tableExists(f"{db}.{n}")}


def now_text(spark: SparkSession) -> str:
    """This instant, from Spark and in the session's zone, as snapshots read it."""
    return spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss')").first()[0]


def snapshot_all(
    spark: SparkSession, layout: Layout, as_of: _dt.datetime | str | None = None, retain: int = RETAIN, steps: Steps | None = None, compact_after: int = COMPACT_AFTER
) -> None:
    """The snapshot step: one run of each type-2 history, read from Bronze (L22), appended (SNK-7).
    Superseded open partitions older than the last ``retain`` runs are removed; closed versions are merged into one
    partition once more than ``compact_after`` runs have added to them."""
    bronze = _tables(spark, layout.db("bronze"), BRONZE_TABLES)
    snap_at = str(as_of or now_text(spark))  # one instant for the whole run
    for name, (key, check, cols), src in zip(SNAPSHOTS, (CUSTOMER_SNAPSHOT, PRODUCT_SNAPSHOT), ("customers", "products"), strict=True):
        if steps is not None and steps.has(name):
            continue
        view = f"{layout.db('silver')}.{name}"
        n = snapshot_run(spark, view, bronze[src].select(*cols), key, check, snap_at, layout.tables)
        if n - compacted_run(spark, view) > compact_after:
            compact_snapshot(spark, view, key, layout.tables)
        vacuum_snapshot(spark, view, keep_runs=retain)
        if steps is not None:
            steps.finished(name, str(n))


def _flag_views(spark: SparkSession, silver_db: str) -> None:
    # thin persistent views over the snapshots (L23: views, not copies); same as current_flag()
    for flag_view, snap in (
        ("silver_customers_current_flag", "customers_snapshot"),
        ("silver_products_current_flag", "products_snapshot"),
    ):
        spark.sql(
            f"CREATE OR REPLACE VIEW {silver_db}.{flag_view} AS "
            f"SELECT *, dbt_valid_to IS NULL AS is_current FROM {silver_db}.{snap}"
        )


def build_layers(
    spark: SparkSession,
    layout: Layout,
    ltv_as_of: _dt.date | str | None = None,
    retain: int = RETAIN,
    steps: Steps | None = None,
    changed: Changes | None = None,
    part_format: str = "yyyy-MM",
    buckets: int = 4,
) -> None:
    """The model step: Silver then Gold, each table materialised before the models that read it
    (in the reference's DAG order), so later models read stored tables.  Each table keeps its
    last ``retain`` versions.  Row counts, NULLs and values outside the accepted ones are observed by each write and
    recorded, so the test step need not read for them.

    Tables that ``steps`` has as done, and that still lie where they were written, are left out.  With ``changed`` the
    large tables are brought up to date by key instead of rebuilt (``increments``), in partitions of ``part_format``."""
    silver_db, gold_db = layout.db("silver"), layout.db("gold")
    bronze = _tables(spark, layout.db("bronze"), BRONZE_TABLES)
    stored = _tables(spark, silver_db, SNAPSHOTS)
    rules = {r.model: r for r in ALL_RULES}
    if steps is None:
        ledger = RunLedger(spark, layout.ledger_table, layout.tables)
        ledger.log.ensure()
        steps = Steps("models", ledger, ledger.loose())

    def store(name: str, model: Callable[[], DataFrame], db: str) -> None:
        full = f"{db}.{name}"
        if not (steps.has(name) and spark.catalog.tableExists(full) and _same_folder(table_location(spark, full), steps.location(name))):
            if changed is None and spark.catalog.tableExists(f"{full}__stored"):  # it was kept by key before
                spark.sql(f"DROP VIEW IF EXISTS {full}")
                spark.sql(f"DROP TABLE {full}__stored")
            out, seen = observed(model(), **rule_aggregates(rules.get(name)))
            path = materialize(out, full, layout.tables)
            vacuum_versions(spark, full, keep=retain)
            steps.finished(name, path, as_note(seen.get))
        stored[name] = spark.table(full)

    keyed: tuple[str, ...] = ()
    if changed is not None:
        silver = KeyedModels(spark, silver_db, layout.tables, part_format, buckets, retain)
        gold = KeyedModels(spark, gold_db, layout.tables, part_format, 0, retain)
        build_changed(spark, bronze, silver, gold, changed, steps)
        keyed = ("silver_orders", "silver_payments", "silver_order_items", "silver_clickstream_sessions", "gold_daily_sales_summary")
        stored.update(_tables(spark, silver_db, keyed))
    for name, df in build_models(bronze).items():
        if name not in keyed:
            store(name, lambda df=df: df, silver_db)
    _flag_views(spark, silver_db)
    store("silver_customer_profile_history", lambda: version_stats(stored["customers_snapshot"], "customer_id"), silver_db)
    if "gold_daily_sales_summary" not in keyed:
        store("gold_daily_sales_summary", lambda: daily_sales(stored["silver_orders"], unique_orders=True), gold_db)
    store(
        "gold_customer_ltv",
        lambda: customer_ltv(stored["silver_customers"], stored["silver_orders"], stored["silver_payments"], ltv_as_of, unique_keys=True),
        gold_db,
    )
    if "silver_clickstream_sessions" in stored:
        store("gold_clickstream_funnel", lambda: funnel(stored["silver_clickstream_sessions"]), gold_db)
        store("gold_click_order_join", lambda: click_order_join(stored["silver_clickstream_sessions"], stored["silver_orders"]), gold_db)


def _same_folder(a: str | None, b: str | None) -> bool:
    return bool(a and b) and a.rstrip("/").rsplit("/", 1)[-1] == b.rstrip("/").rsplit("/", 1)[-1]


def stored_metrics(spark: SparkSession, layout: Layout) -> dict[str, dict[str, int]]:
    """What the last write of each Silver and Gold table observed, as far as the table still lies where it wrote."""
    names = [(layout.db("silver"), n) for n in SILVER_TABLES] + [(layout.db("gold"), n) for n in (*GOLD_TABLES, "gold_click_order_join")]
    lies = {n: path for db, n in names if spark.catalog.tableExists(f"{db}.{n}") and (path := table_location(spark, f"{db}.{n}"))}
    log = RunLedger(spark, layout.ledger_table, layout.tables).log
    return current_metrics(log.rows().filter("step = 'models'"), lies) if log.exists() else {}


def stored_row_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """DQ-6 for the stored Silver and Gold tables, from their writes; a table whose figures do not hold is counted."""
    known = {name: m[ROWS] for name, m in stored_metrics(spark, layout).items()}
    tables = _tables(spark, layout.db("silver"), SILVER_TABLES) | _tables(spark, layout.db("gold"), GOLD_TABLES)
    told = spark.createDataFrame([(n, known[n]) for n in tables if n in known], "table_name string, row_count bigint")
    return told.unionByName(row_counts(spark, {n: df for n, df in tables.items() if n not in known}))


def run_data_tests(spark: SparkSession, layout: Layout) -> DataFrame:
    """The test step: every declared data test and foreign key on the stored tables; the report (DQ-4, DQ-5).  What the
    writes of the tables have observed is not read again."""
    tables = {f"bronze.{k}": v for k, v in _tables(spark, layout.db("bronze"), BRONZE_TABLES).items()}
    tables.update(_tables(spark, layout.db("silver"), SILVER_TABLES + SNAPSHOTS))
    tables.update(_tables(spark, layout.db("gold"), GOLD_TABLES))
    metrics = stored_metrics(spark, layout)
    known = {r.model: known_failures(metrics[r.model], r) for r in ALL_RULES if r.model in metrics}
    return run_checks(tables, ALL_RULES, known).unionByName(run_relationships(tables, FOREIGN_KEYS))


def transform(
    spark: SparkSession,
    layout: Layout,
    as_of: _dt.datetime | str | None = None,
    ltv_as_of: _dt.date | str | None = None,
    retain: int = RETAIN,
) -> DataFrame:
    """PIPE-3: snapshot -> silver -> gold -> tests; returns the test report (DQ-5)."""
    snapshot_all(spark, layout, as_of, retain)
    build_layers(spark, layout, ltv_as_of, retain)
    return run_data_tests(spark, layout)


def run(
    spark: SparkSession,
    layout: Layout,
    sources: dict[str, DataFrame],
    stream: DataFrame | None = None,
    run_date: _dt.date | str | None = None,
    as_of: _dt.datetime | str | None = None,
    ltv_as_of: _dt.date | str | None = None,
    steps: tuple[str, ...] = STEPS,
    retain: int = RETAIN,
    event_sink: str = "append",
    incremental: bool = False,
    configs: Sequence[TableConfig] = TABLES_CONFIG,
    part_format: str = "yyyy-MM",
) -> DataFrame:
    """PIPE-4: setup -> {batch ingest || stream drain} -> transform; returns the test report.

    ``retain`` is how many versions of rebuilt tables (and superseded snapshot partitions) stay.
    ``steps`` selects a subset of ``("ingest", "snapshot", "models", "test")`` (the order is
    fixed); without ``"test"`` the report is empty.  ``incremental`` updates the large model tables by the keys that
    changed since the last model step (``increments``) instead of rebuilding them.

    The stream query runs on its own thread of the same session while the batch tables are
    ingested; the transform starts once both have finished.

    Every finished table is noted in the run ledger.  If the last run did not end and had the same settings, this one goes on
    where it died: with its snapshot instant, and without the tables that it has finished.
    """
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps {sorted(unknown)}")
    setup(spark, layout)
    ledger = RunLedger(spark, layout.ledger_table, layout.tables)
    asked = {"steps": list(steps), "run_date": run_date, "as_of": as_of, "ltv_as_of": ltv_as_of, "event_sink": event_sink, "incremental": incremental}
    asked = {k: v if v is None or isinstance(v, bool | list) else str(v) for k, v in asked.items()}
    this = ledger.begin(asked, {"snapshot_at": str(as_of or now_text(spark))})
    of = {step: Steps(step, ledger, this) for step in STEPS}
    if "ingest" in steps:
        query = ingest_events(spark, layout, stream, wait=False, sink=event_sink) if stream is not None else None
        try:
            ingest_batch(spark, layout, sources, configs, run_date=run_date, steps=of["ingest"])
        finally:
            if query is not None:
                query.awaitTermination()
    if "snapshot" in steps:
        snapshot_all(spark, layout, this.settings["snapshot_at"], retain, of["snapshot"])
    if "models" in steps:
        bronze = _tables(spark, layout.db("bronze"), BRONZE_TABLES)
        upto = ingested_upto(bronze.get("clickstream_events"))
        if this.has("models", "events_upto"):  # as the run that died saw them
            upto = this.done["models", "events_upto"]
        else:
            of["models"].finished("events_upto", upto)
        changed = Changes(spark, ledger.landed_since(MODELS_DONE), noted_events(ledger.last_detail(MODELS_DONE)), upto) if incremental else None
        build_layers(spark, layout, ltv_as_of, retain, of["models"], changed, part_format)
        ledger.finished(this, MODELS_DONE, detail=note_events(upto))
    report = run_data_tests(spark, layout) if "test" in steps else spark.createDataFrame([], REPORT_SCHEMA)
    ledger.end(this)
    return report
