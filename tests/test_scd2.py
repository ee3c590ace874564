"""SCD-1..7: snapshot cases, invariants, current flag, version stats, as-of join (L24/L25/L26/L32)."""

import datetime as dt
import uuid
from decimal import Decimal

from conftest import rows, ts
from pyspark.sql import functions as F

from strata.operators.scd2 import as_of_join, current_flag, snapshot, version_stats

SCHEMA = "id int, a string, b string, stock int, updated_at timestamp"
CHECK = ["a", "b"]


def ext(spark, data):
    return spark.createDataFrame([(i, a, b, s, ts("2024-01-01")) for i, a, b, s in data], SCHEMA)


def versions(hist, key=1):
    return [
        (r.a, r.b, r.dbt_valid_from.isoformat(), r.dbt_valid_to.isoformat() if r.dbt_valid_to else None)
        for r in hist.filter(F.col("id") == key).orderBy("dbt_valid_from").collect()
    ]


def run(spark, hist, data, at, **kw):
    return snapshot(hist, ext(spark, data), "id", CHECK, at, **kw)


def test_scd_new_changed_same_and_stock_only(spark):
    h = run(spark, None, [(1, "x", "y", 1), (2, "p", "q", 1)], "2024-01-01 00:00:00")
    h = run(spark, h, [(1, "x", "z", 1), (2, "p", "q", 99), (3, "n", "n", 1)], "2024-02-01 00:00:00")
    assert versions(h, 1) == [("x", "y", "2024-01-01T00:00:00", "2024-02-01T00:00:00"), ("x", "z", "2024-02-01T00:00:00", None)]
    assert versions(h, 2) == [("p", "q", "2024-01-01T00:00:00", None)]  # stock only: no version (L32)
    assert h.filter("id = 2").first().stock == 1  # unchecked column frozen at open
    assert versions(h, 3) == [("n", "n", "2024-02-01T00:00:00", None)]


def test_scd_aba_delete_return_and_null_flip(spark):
    h = run(spark, None, [(1, "A", None, 0), (2, "d", "d", 0), (3, None, "x", 0)], "2024-01-01 00:00:00")
    h = run(spark, h, [(1, "B", None, 0), (3, "x", None, 0)], "2024-02-01 00:00:00")  # 2 deleted; L26 swap
    h = run(spark, h, [(1, "A", None, 0), (2, "d", "d", 0), (3, None, "x", 0)], "2024-03-01 00:00:00")
    assert [v[0] for v in versions(h, 1)] == ["A", "B", "A"]
    assert versions(h, 2) == [
        ("d", "d", "2024-01-01T00:00:00", "2024-02-01T00:00:00"),
        ("d", "d", "2024-03-01T00:00:00", None),
    ]
    assert len(versions(h, 3)) == 3  # (NULL,'x') -> ('x',NULL) -> (NULL,'x') are all changes


def test_scd_invariants_and_idempotent_rerun(spark):
    h = run(spark, None, [(1, "A", "a", 0), (2, "B", "b", 0)], "2024-01-01 00:00:00")
    h = run(spark, h, [(1, "A2", "a", 0)], "2024-02-01 00:00:00")
    again = run(spark, h, [(1, "A2", "a", 0)], "2024-02-01 00:00:00")
    assert sorted(map(str, again.collect())) == sorted(map(str, h.collect()))  # equal extract: no-op
    assert h.filter(F.col("dbt_valid_to").isNull()).groupBy("id").count().filter("count > 1").count() == 0
    assert h.select("dbt_scd_id").distinct().count() == h.count()
    kept = run(spark, h, [], "2024-03-01 00:00:00", close_missing=False)  # L25 off: nothing closes
    assert kept.filter(F.col("dbt_valid_to").isNull()).count() == 1


def test_scd_extract_with_duplicate_keys_takes_latest(spark):
    data = spark.createDataFrame(
        [(1, "old", "x", 0, ts("2024-01-01")), (1, "new", "x", 0, ts("2024-01-05"))], SCHEMA
    )
    h = snapshot(None, data, "id", CHECK, "2024-01-10 00:00:00")
    assert [r.a for r in h.collect()] == ["new"]


def test_scd5_scd6_flag_and_stats_l24(spark):
    h = run(spark, None, [(1, "A", "a", 0), (2, "B", "b", 0)], "2024-01-01 00:00:00")
    h = run(spark, h, [(1, "A", "changed-name", 0), (2, "B", "b", 0)], "2024-02-01 00:00:00")
    flags = {(r.id, r.b): r.is_current for r in current_flag(h).collect()}
    assert flags == {(1, "a"): False, (1, "changed-name"): True, (2, "b"): True}
    stats = {r.id: r for r in version_stats(h, "id").collect()}
    assert (stats[1].total_profile_versions, stats[1].number_of_profile_changes, stats[1].has_relocated) == (2, 1, True)
    assert stats[1].current_version_since.isoformat() == "2024-02-01T00:00:00"
    assert stats[2].has_relocated is False


def test_scd7_as_of_join(spark):
    hist = spark.createDataFrame(
        [
            (7, Decimal("1.00"), ts("2024-01-01"), ts("2024-02-01")),
            (7, Decimal("2.00"), ts("2024-02-01"), None),
        ],
        "id int, price decimal(10,2), dbt_valid_from timestamp, dbt_valid_to timestamp",
    )
    facts = spark.createDataFrame(
        [(1, 7, ts("2023-12-31")), (2, 7, ts("2024-01-15")), (3, 7, ts("2024-02-01")), (4, 8, ts("2024-03-01"))],
        "sale_id int, id int, sold_at timestamp",
    )
    for how in ("left", "left_outer", "inner"):
        got = as_of_join(facts, hist, "id", "sold_at", ["price"], how=how)
        out = {r.sale_id: r.price for r in got.collect()}
        missing = {} if how == "inner" else {1: None, 4: None}
        assert out == {2: Decimal("1.00"), 3: Decimal("2.00"), **missing}, how
        assert got.columns == ["sale_id", "id", "sold_at", "price"]


def by_range(facts, history, key, at, columns):
    """The as-of join as SQL states it: every fact against every version of its key."""
    h = history.select(F.col(key).alias("hk"), F.col("dbt_valid_from").alias("hf"), F.col("dbt_valid_to").alias("ht"), *columns)
    t = F.col(at)
    return facts.join(h, (F.col(key) == F.col("hk")) & (t >= F.col("hf")) & (F.col("ht").isNull() | (t < F.col("ht"))), "left").drop("hk", "hf", "ht")


def test_scd7_equals_range_join_on_random_histories(spark):
    import random

    rnd = random.Random(11)
    hist, facts = [], []
    for k in [1, 2, 3, None]:
        t, n = 0, (300 if k == 1 else rnd.randrange(1, 6))  # key 1: a hot key with many versions
        for v in range(n):
            start = t + rnd.randrange(0, 3)  # 0: back-to-back versions
            end = start + rnd.randrange(1, 5)
            last = v == n - 1 and rnd.random() < 0.5
            hist.append((k, v, ts("2024-01-01") + dt.timedelta(hours=start),
                         None if last else ts("2024-01-01") + dt.timedelta(hours=end)))
            t = end
        for i in range(60):
            at = None if rnd.random() < 0.05 else ts("2024-01-01") + dt.timedelta(hours=rnd.randrange(-2, t + 3))
            facts.append((len(facts), k, at))
    h = spark.createDataFrame(hist, "id int, ver int, dbt_valid_from timestamp, dbt_valid_to timestamp")
    f = spark.createDataFrame(facts, "fid int, id int, at timestamp")
    want = sorted(map(tuple, by_range(f, h, "id", "at", ["ver"]).collect()), key=str)
    for unit in ("MONTH", "HOUR"):  # one slice, and many
        got = as_of_join(f, h, "id", "at", ["ver"], slice_unit=unit)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_snk7_stored_history_equals_in_memory_and_appends(spark, tmp_root):
    import uuid

    from strata.sinks.snapshots import committed_run, snapshot_run

    db = f"s{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    view = f"{db}.hist"
    runs = [
        ([(1, "A", "a", 0), (2, "B", "b", 0)], "2024-01-01 00:00:00"),
        ([(1, "A2", "a", 0), (3, "C", "c", 0)], "2024-02-01 00:00:00"),
        ([(1, "A", "a", 0), (2, "B", "b", 0), (3, "C", "c", 5)], "2024-03-01 00:00:00"),
    ]
    mem = None
    for data, at in runs:
        snapshot_run(spark, view, ext(spark, data), "id", CHECK, at, tmp_root)
        mem = run(spark, mem, data, at)
    assert committed_run(spark, view) == 3
    cols = ["id", "a", "b", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to"]
    assert sorted(map(tuple, spark.table(view).select(*cols).collect())) == sorted(
        map(tuple, mem.select(*cols).collect())
    )
    parts = {(r.run_no, r._open) for r in spark.table(f"{view}__versions").select("run_no", "_open").distinct().collect()}
    assert (1, True) in parts and (3, True) in parts  # run 1's open rows stay on disk, superseded


def test_chain_of_n_runs_has_n_minus_1_joins(spark):
    def _history(extracts, key, check):
        hist = None
        for extract, as_of in extracts:
            hist = snapshot(hist, extract, key, check, as_of=as_of)
        return hist


    def chain(n):
        runs = [(ext(spark, [(1, f"A{i}", "a", 0), (2 + i, "B", "b", 0)]), f"2024-0{i + 1}-01 00:00:00") for i in range(n)]
        return _history(runs, "id", CHECK)

    for n in range(2, 7):
        plan = chain(n)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join FullOuter") == n - 1 and plan.count("LogicalRDD") == n
    h = chain(4)
    assert [v[0] for v in versions(h, 1)] == ["A0", "A1", "A2", "A3"]
    assert len(versions(h, 2)) == 1 and versions(h, 2)[0][3] == "2024-02-01T00:00:00"


def test_point_lookup_pushes_the_key(spark):
    from strata.plans.queries import q_customer_history, q_product_price_history

    for q, col in ((q_customer_history, "c_custkey"), (q_product_price_history, "p_partkey")):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"EqualTo({col},") == 1  # one scan for all runs, with the key


def test_snk7_crashed_run_stays_invisible_and_is_replaced(spark, tmp_root):
    import uuid

    from strata.sinks.snapshots import committed_run, snapshot_run

    db = f"c{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    view = f"{db}.hist"
    snapshot_run(spark, view, ext(spark, [(1, "A", "a", 0)]), "id", CHECK, "2024-01-01 00:00:00", tmp_root)
    # a run that died after registering its partitions, before the commit (the view replace)
    bogus = run(spark, None, [(9, "ZZ", "z", 0)], "2024-01-15 00:00:00")
    bogus.write.parquet(f"{tmp_root}/crashed/_open=true")
    spark.sql(f"ALTER TABLE {view}__versions ADD PARTITION (run_no=2, _open=true) LOCATION '{tmp_root}/crashed/_open=true'")
    assert committed_run(spark, view) == 1
    assert [r.id for r in spark.table(view).collect()] == [1]  # the orphan is not visible
    snapshot_run(spark, view, ext(spark, [(1, "B", "a", 0)]), "id", CHECK, "2024-02-01 00:00:00", tmp_root)
    assert committed_run(spark, view) == 2
    assert sorted((r.id, r.a) for r in spark.table(view).collect()) == [(1, "A"), (1, "B")]


def test_snk7_vacuum_drops_superseded_open_partitions_only(spark, tmp_root):
    import uuid

    from strata.sinks.snapshots import snapshot_run, vacuum_snapshot

    db = f"w{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    view = f"{db}.hist"
    for i, data in enumerate([[(1, "A", "a", 0)], [(1, "B", "a", 0)], [(1, "C", "a", 0)], [(1, "C", "a", 0)]]):
        snapshot_run(spark, view, ext(spark, data), "id", CHECK, f"2024-0{i + 1}-01 00:00:00", tmp_root)
    before = sorted(map(str, spark.table(view).collect()))
    deleted = vacuum_snapshot(spark, view, keep_runs=2)
    assert len(deleted) == 2  # the open partitions of runs 1 and 2
    assert sorted(map(str, spark.table(view).collect())) == before
    parts = {(r.run_no, r._open) for r in spark.table(f"{view}__versions").select("run_no", "_open").distinct().collect()}
    assert (1, True) not in parts and (2, True) not in parts and (4, True) in parts


def _scan_rows(df) -> int:
    """Rows that the scans of an executed query have put out: those of the row groups and pages that were read."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, n = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.getClass().getSimpleName().endswith("QueryStageExec"):  # a stage that has run holds its plan
            leaf = leaf.plan().collectLeaves().apply(0)
        n += leaf.metrics().get("numOutputRows").get().value()
    return n


def test_lookup_of_a_key_reads_few_row_groups(spark, tmp_root):
    from strata.sinks.snapshots import compact_snapshot, snapshot_run, vacuum_snapshot, versions_of

    db = f"l{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    view, n = f"{db}.h", 40_000
    small = {"parquet.block.size": str(64 << 10), "parquet.page.size": str(8 << 10), "parquet.page.row.count.limit": "500"}
    shuffled = "cast(pmod(id * 7919, 40000) as int) as k"
    for run in range(1, 5):
        extract = spark.range(n).selectExpr(shuffled, f"concat('v', if(id % 3 = {run % 3}, {run}, 0)) as v", "timestamp'2024-01-01' as updated_at")
        snapshot_run(spark, view, extract, "k", ["v"], f"2024-01-0{run} 00:00:00", tmp_root, options=small)
    everything = sorted(map(str, spark.table(view).collect()))
    total = len(everything)
    found = versions_of(spark, view, "k", 12_345)
    got = [(r.v, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in found.collect()]
    assert got and _scan_rows(found) < total / 20
    # nothing of a key that lies between two others
    none = versions_of(spark, view, "k", 50_000)
    assert none.count() == 0 or none.collect() == []
    # compaction changes where rows lie, not which there are
    assert compact_snapshot(spark, view, "k", tmp_root, small) == 4
    assert sorted(map(str, spark.table(view).collect())) == everything
    again = versions_of(spark, view, "k", 12_345)
    assert [(r.v, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in again.collect()] == got and _scan_rows(again) < total / 20
    assert vacuum_snapshot(spark, view, keep_runs=1)
    assert sorted(map(str, spark.table(view).collect())) == everything
    # and runs go on after it
    extract = spark.range(n).selectExpr(shuffled, "'z' as v", "timestamp'2024-01-01' as updated_at")
    snapshot_run(spark, view, extract, "k", ["v"], "2024-02-01 00:00:00", tmp_root, options=small)
    assert spark.table(view).count() == total + n and spark.table(view).filter("dbt_valid_to is null").count() == n
    assert compact_snapshot(spark, view, "k", tmp_root, small) == 5
    vacuum_snapshot(spark, view, keep_runs=1)
    assert spark.table(view).count() == total + n


def _random_extracts(seed):
    import random

    r = random.Random(seed)
    out = []
    for run in range(1, r.randint(2, 6)):
        for k in [None, *range(8)]:
            for _ in range(r.choice([0, 1, 1, 1, 2])):
                out.append((run, k, r.choice(["a", "b", None]), r.choice([1, 2, None]), r.randint(0, 9), ts(f"2024-01-0{r.randint(1, 3)}")))
    return out


def test_series_equals_runs_one_by_one(spark):
    from strata.operators.scd2 import snapshot_series

    schema = "_run int, k int, a string, b int, free int, updated_at timestamp"
    times = [f"2024-0{m}-01 00:00:00" for m in range(1, 8)]
    for seed in range(6):
        data = _random_extracts(seed)
        runs = max(d[0] for d in data)
        frame = spark.createDataFrame(data, schema)
        for close in (True, False):
            hist = None
            for run in range(1, runs + 1):
                hist = snapshot(hist, frame.filter(f"_run = {run}").drop("_run"), "k", ["a", "b"], times[run - 1], close_missing=close)
            series = snapshot_series(frame, "k", ["a", "b"], times[:runs], close_missing=close)
            assert series.columns == hist.columns
            assert rows(series) == rows(hist), (seed, close)


def test_series_is_two_shuffles(spark):
    import re

    from strata.operators.scd2 import snapshot_series

    frame = spark.createDataFrame(_random_extracts(1), "_run int, k int, a string, b int, free int, updated_at timestamp")
    plan = snapshot_series(frame, "k", ["a", "b"], ["2024-01-01"] * 6)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hash", plan)) == 2 and "Join" not in plan
