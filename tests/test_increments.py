"""PIPE-3, PIPE-4, SNK-6: only what changed is rewritten; a run that died goes on."""

import os
import uuid
from decimal import Decimal as D

import pytest
from conftest import rows, ts

from strata.plans import pipeline as P
from strata.plans.ledger import RunLedger
from strata.sinks.snapshots import committed_run
from strata.sinks.tables import _partition_location, _partitions, table_location
from strata.streaming.ingest import MESSAGE_SCHEMA, file_stream

CUSTOMERS = (
    "customer_id int, first_name string, last_name string, email string, phone string, address_line string, city string, "
    "state string, country string, postal_code string, signup_date timestamp, is_active boolean, created_at timestamp, updated_at timestamp"
)
PRODUCTS = "product_id int, product_name string, category string, sub_category string, brand string, price decimal(10,2), stock_qty int, is_discontinued boolean, created_at timestamp, updated_at timestamp"
ORDERS = "order_id int, customer_id int, order_date timestamp, status string, shipping_city string, shipping_country string, total_amount decimal(12,2), created_at timestamp, updated_at timestamp"
ITEMS = "order_item_id int, order_id int, product_id int, quantity int, unit_price decimal(10,2), created_at timestamp"
PAYMENTS = "payment_id int, order_id int, amount decimal(12,2), method string, status string, paid_at timestamp, created_at timestamp, updated_at timestamp"


def order(k, day, amount, status="delivered", updated=None):
    at = ts(f"2024-01-{day:02d} 10:00:00")
    return (k, k % 3 + 1, at, status, "oslo", "NO", None if amount is None else D(amount), at, updated or at)


def first_sources(spark):
    t = ts("2024-01-01")
    return {
        "customers": spark.createDataFrame([(i, f"n{i}", "x", f"A{i}@X.COM", None, None, "oslo", None, "NO", None, t, True, t, t) for i in (1, 2, 3)], CUSTOMERS),
        "products": spark.createDataFrame([(1, "w", "c", None, None, D("1.50"), 3, False, t, t)], PRODUCTS),
        "orders": spark.createDataFrame([order(k, 1 + k % 4, f"{k}.50") for k in range(1, 13)], ORDERS),
        "order_items": spark.createDataFrame([(k, k, 1, 2, D("1.50"), ts(f"2024-01-{1 + k % 4:02d}")) for k in range(1, 13)], ITEMS),
        "payments": spark.createDataFrame([(k, k, D("9.50"), "card", "success", t, ts(f"2024-01-{1 + k % 4:02d}"), ts(f"2024-01-{1 + k % 4:02d}")) for k in range(1, 13)], PAYMENTS),
    }


def second_sources(spark):
    """A new day, an order that moves to another day, one that is no longer valid, one that is paid again."""
    late = ts("2024-02-01")
    first = first_sources(spark)
    more = {
        "customers": [],
        "products": [],
        "orders": [order(50, 9, "7.00"), order(1, 3, "1.50", "cancelled", late), order(2, 3, None, "shipped", late)],
        "order_items": [(50, 50, 1, 1, D("7.00"), ts("2024-01-09 10:00:00"))],
        "payments": [(50, 50, D("7.00"), "upi", "failed", late, ts("2024-01-09"), late), (3, 3, D("-1.00"), "card", "success", late, ts("2024-01-04"), late)],
    }
    return {n: df.unionByName(spark.createDataFrame(more[n], df.schema)) for n, df in first.items()}


EVENTS = [
    [("e1", "page_view", "2024-01-01T10:00:00", "s1"), ("e2", "product_view", "2024-01-01T10:05:00", "s1"), ("e3", "page_view", "2024-01-02T10:00:00", "s2"), ("e4", "page_view", "2024-01-02T11:00:00", None), ("bad", "page_view", "soon", "s2")],
    [("e5", "add_to_cart", "2024-01-01T10:03:00", "s1"), ("e6", "PAGE_VIEW ", "2024-01-09T10:00:00", "s3"), ("e7", "search", "2024-01-02T10:30:00", None), ("e8", "search", "never", "s9")],
]


def send(spark, folder, batch):
    messages = [(f'{{"event_id":"{i}","event_type":"{k}","event_time":"{at}"' + (f',"session_id":"{s}"' if s else "") + "}", ts("2024-01-01")) for i, k, at, s in batch]
    spark.createDataFrame(messages, MESSAGE_SCHEMA).write.mode("append").parquet(folder)


def layout_of(root):
    return P.Layout(os.path.join(root, f"lake-{uuid.uuid4().hex[:6]}"), prefix=f"i{uuid.uuid4().hex[:6]}_")


def go(spark, layout, sources, events, **more):
    return P.run(spark, layout, sources, stream=file_stream(spark, events), run_date="2024-02-02", as_of=more.pop("as_of", "2024-02-02 00:00:00"), ltv_as_of="2024-03-01", **more)


def tables(spark, layout):
    silver = ("silver_orders", "silver_payments", "silver_order_items", "silver_clickstream_sessions", "silver_customers", "silver_products")
    gold = ("gold_daily_sales_summary", "gold_customer_ltv", "gold_clickstream_funnel", "gold_click_order_join")
    return {n: rows(spark.table(f"{layout.db(layer)}.{n}")) for layer, names in (("silver", silver), ("gold", gold)) for n in names}


def places(spark, stored):
    return {p: _partition_location(spark, stored, p) for p in _partitions(spark, stored)}


def test_changed_rows_only_and_equal_to_a_full_rebuild(spark, tmp_root):
    events = os.path.join(tmp_root, "events")
    inc, full = layout_of(tmp_root), layout_of(tmp_root)
    daily = f"{inc.db('gold')}.gold_daily_sales_summary__stored"
    orders = f"{inc.db('silver')}.silver_orders__stored"
    sessions = f"{inc.db('silver')}.silver_clickstream_sessions__stored"
    known, was = {}, None
    for no, sources in enumerate((first_sources(spark), second_sources(spark), second_sources(spark))):
        if no < 2:
            send(spark, events, EVENTS[no])
        report = go(spark, inc, sources, events, incremental=True, part_format="yyyy-MM-dd", event_sink="batches", as_of=f"2024-02-0{no + 2} 00:00:00")
        failed = [tuple(r) for r in report.filter("status = 'fail'").collect()]
        assert failed == [], failed
        now = {n: places(spark, n) for n in (daily, orders, sessions)}
        if no == 1:
            changed = {n: {p for p in now[n] | known[n] if now[n].get(p) != known[n].get(p)} for n in now}
            assert changed[orders] == changed[daily] == {f"_part=2024-01-{d}" for d in ("02", "03", "09")}
            assert changed[sessions] == {f"_part=2024-01-{d}" for d in ("01", "02", "09")}
        if no == 2:  # nothing new: nothing is rewritten
            assert now == known and tables(spark, inc) == was
        known, was = now, tables(spark, inc)
    go(spark, full, second_sources(spark), events)
    assert tables(spark, full) == was
    # and a full rebuild takes tables back that were kept by key
    P.build_layers(spark, inc, "2024-03-01")
    assert tables(spark, inc) == was and not spark.catalog.tableExists(orders)


def test_a_run_killed_after_silver_goes_on_at_gold(spark, tmp_root, monkeypatch, incremental=True):
    events = os.path.join(tmp_root, "events")
    send(spark, events, EVENTS[0])
    layout = layout_of(tmp_root)
    sources = first_sources(spark)

    def dies(*_a, **_k):
        raise RuntimeError("killed")

    monkeypatch.setattr(P, "customer_ltv", dies)
    with pytest.raises(RuntimeError, match="killed"):
        go(spark, layout, sources, events, incremental=incremental, as_of=None)
    monkeypatch.undo()
    ledger = RunLedger(spark, layout.ledger_table, layout.tables)
    first = {r.run_id for r in ledger.log.rows().collect()}
    silver = f"{layout.db('silver')}.silver_customers"
    before = table_location(spark, silver)
    snapshot_from = spark.table(f"{layout.db('silver')}.customers_snapshot").first().dbt_valid_from

    read = []
    ingest = P.ingest_all
    monkeypatch.setattr(P, "ingest_all", lambda *a, **k: (read.extend(c.source_table for c in a[6]), ingest(*a, **k))[1])
    report = go(spark, layout, sources, events, incremental=incremental, as_of=None)
    monkeypatch.undo()
    assert read == []  # every table was ingested by the run that died
    assert table_location(spark, silver) == before  # Silver stands
    assert committed_run(spark, f"{layout.db('silver')}.customers_snapshot") == 1
    assert spark.table(f"{layout.db('silver')}.customers_snapshot").first().dbt_valid_from == snapshot_from
    assert {r.run_id for r in ledger.log.rows().collect()} == first  # the same run, ended now
    assert report.filter("status = 'fail'").count() == 0 and spark.table(f"{layout.db('gold')}.gold_customer_ltv").count() == 3
    # the next run is a new one, and rebuilds
    P.run(spark, layout, sources, as_of=None, steps=("models",))
    assert table_location(spark, silver) != before
    assert len({r.run_id for r in ledger.log.rows().collect()}) == 2


def test_other_settings_start_a_new_run(spark, tmp_root):
    layout = layout_of(tmp_root)
    P.setup(spark, layout)
    ledger = RunLedger(spark, layout.ledger_table, layout.tables)
    a = ledger.begin({"x": 1}, {"at": "t1"})
    ledger.finished(a, "ingest", "orders", "/landed/1")
    b = ledger.begin({"x": 1}, {"at": "t2"})
    assert b.resumed and b.run_id == a.run_id and b.settings["at"] == "t1" and b.done["ingest", "orders"] == "/landed/1"
    c = ledger.begin({"x": 2}, {"at": "t3"})
    assert not c.resumed and c.run_id != a.run_id and c.done == {}
    ledger.end(c)
    assert not ledger.begin({"x": 2}, {"at": "t4"}).resumed
    assert ledger.landed_since("models_done") == {"orders": ["/landed/1"]}


def test_control_log_is_trimmed(spark, tmp_root):
    from pyspark.sql import functions as F

    from strata.sinks.log import ControlLog

    db = f"c{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    log = ControlLog(spark, f"{db}.l", tmp_root, "k int")
    log.ensure()
    for k in range(5):
        log.add([(k,)])
    log.trim(F.col("k") >= 3, files=4)
    assert sorted(r.k for r in log.rows().collect()) == [3, 4] and len(log.rows().inputFiles()) == 1
    log.add([(9,)])
    assert log.rows().count() == 3


def test_test_step_reads_no_table_for_what_was_observed(spark, tmp_root):
    events = os.path.join(tmp_root, "events")
    send(spark, events, EVENTS[0])
    layout = layout_of(tmp_root)
    report = go(spark, layout, first_sources(spark), events)
    metrics = P.stored_metrics(spark, layout)
    assert metrics["silver_orders"]["rows"] == 12 and metrics["silver_orders"]["not_null:order_id"] == 0
    counts = {r.table_name: r.row_count for r in P.stored_row_counts(spark, layout).collect()}
    assert counts == {n: spark.table(f"{layout.db('gold' if n.startswith('gold') else 'silver')}.{n}").count() for n in counts} and len(counts) >= 9
    from strata.operators.quality import ALL_RULES, run_checks

    whole = {f"bronze.{k}": v for k, v in P._tables(spark, layout.db("bronze"), P.BRONZE_TABLES).items()}
    whole |= P._tables(spark, layout.db("silver"), P.SILVER_TABLES + P.SNAPSHOTS) | P._tables(spark, layout.db("gold"), P.GOLD_TABLES)
    assert rows(report.filter("test_name <> 'relationships'")) == rows(run_checks(whole, ALL_RULES))
    plan = report._jdf.queryExecution().executedPlan().toString()
    # Gold needs a read for uniqueness only: of one column
    assert "ReadSchema: struct<order_day:date>" in plan


def test_job_options(tmp_root):
    from strata.plans.job import parse_args, schema_names, sized_configs

    args = parse_args(["--root", "/r", "--jdbc-url", "u", "--schema-names", "gold=marts, silver=core", "--incremental", "--event-sink", "batches"])
    assert schema_names(args.schema_names) == {"gold": "marts", "silver": "core"} and args.incremental and args.event_sink == "batches"
    assert P.Layout("/r", "p_", schema_names("gold= marts ")).db("gold") == "marts" and schema_names("") is None
    with pytest.raises(ValueError, match="platinum"):
        schema_names("platinum=x")
    assert {c.buckets for c in sized_configs(7, None)} == {7}
    assert {c.buckets for c in sized_configs(None, 100 << 40)} == {4096}
