"""SNK-3, PIPE-1, SRC-1: tables stored by key, splits at quantiles, figures from the write."""

import datetime as dt
import random
import re
import uuid

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F
from test_ingest import DERBY, SCHEMA, derby_url, write_source

from strata.sinks.metrics import observed
from strata.sinks.tables import (
    _bucket_count,
    _partitions,
    bucket_count,
    buckets_of_rows,
    materialize,
    replaced_rows,
    stored_partitions,
    upsert_table,
    vacuum_versions,
)
from strata.sources.incremental import key_cuts, jdbc_source, land, range_predicates

SMOKE = "/root/testdata/sf0.001"
T = "k bigint, v string, updated_at timestamp, month string"


@pytest.fixture()
def db(spark, tmp_root):
    name = f"b{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_root}/{name}'")
    return name


def stored(spark, db, root, n=300, buckets=4):
    first = spark.range(n).selectExpr("id as k", "'a' as v", "timestamp'2024-01-01' as updated_at", "concat('2024-0', 1 + id % 5) as month")
    upsert_table(spark, f"{db}.t", first, ["k"], root=root, partition_by=["month"], buckets=buckets)
    return f"{db}.t"


def test_only_the_batch_is_shuffled(spark, db, tmp_root):
    t = stored(spark, db, tmp_root)
    batch = spark.createDataFrame([(3, "b", ts("2024-02-01"), "2024-09")], T).repartition(4, "k")
    for df in (stored_partitions(spark.table(t), batch, ["k"], ["month"]), replaced_rows(spark.table(t), batch, batch, ["k"])):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        above, at = [], depth(lines[scan])
        for x in reversed(lines[:scan]):
            if depth(x) < at:
                above.append(x)
                at = depth(x)
        join = next(i for i, x in enumerate(above) if "SortMergeJoin" in x)
        assert not any("Exchange" in x for x in above[:join]), above
        assert "SelectedBucketsCount: 4 out of 4" in lines[scan]


def test_upsert_of_random_batches_equals_a_dictionary(spark, db, tmp_root):
    r = random.Random(3)
    t = stored(spark, db, tmp_root, n=60)
    have = {k: ("a", f"2024-0{1 + k % 5}") for k in range(60)}
    for step in range(4):
        batch = [(r.randint(0, 90), f"s{step}-{i}", ts("2024-02-01") + dt.timedelta(minutes=i), r.choice(["2024-01", "2024-03", "2024-08", None, "x/y=z 1"])) for i in range(25)]
        upsert_table(spark, t, spark.createDataFrame(batch, T), ["k"], root=tmp_root, partition_by=["month"])
        have |= {k: (v, m) for k, v, _, m in batch}
        got = rows(spark.table(t), "k", "v", "month")
        assert got == sorted([(k, v, m) for k, (v, m) in have.items()], key=lambda x: tuple((y is None, str(y)) for y in x))
        assert _bucket_count(spark, t) == 4
        assert len(_partitions(spark, t)) == len({m for _, m in have.values()})
    vacuum_versions(spark, t, keep=1)
    assert spark.table(t).count() == len(have)


def test_vacuum_keeps_what_partitions_point_to(spark, db, tmp_root):
    import glob

    t = stored(spark, db, tmp_root, n=20)
    for i in range(4):
        upsert_table(spark, t, spark.createDataFrame([(1, f"v{i}", ts("2024-02-01"), "2024-02")], T), ["k"], partition_by=["month"])
    folders = lambda: len(glob.glob(f"{tmp_root}/{db}/t/v-*/month=2024-02"))
    assert folders() == 5
    assert len(vacuum_versions(spark, t, keep=2)) == 3 and folders() == 2
    assert len(glob.glob(f"{tmp_root}/{db}/t/v-*/month=2024-05")) == 1  # never rewritten, never deleted
    assert rows(spark.table(t).filter("k = 1"), "v") == [("v3",)] and spark.table(t).count() == 20


def test_a_write_that_dies_changes_nothing(spark, db, tmp_root, monkeypatch):
    from strata.sinks import tables

    t = stored(spark, db, tmp_root, n=20)
    before = rows(spark.table(t))

    def dies(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(tables, "_point_partitions", dies)
    batch = spark.createDataFrame([(1, "new", ts("2024-02-01"), "2024-04"), (50, "n", ts("2024-02-01"), "2024-01")], T)
    with pytest.raises(RuntimeError):
        upsert_table(spark, t, batch, ["k"], partition_by=["month"])
    monkeypatch.undo()
    assert rows(spark.table(t)) == before
    upsert_table(spark, t, batch, ["k"], partition_by=["month"])
    assert spark.table(t).count() == 21 and rows(spark.table(t).filter("k = 1"), "v", "month") == [("new", "2024-04")]


def test_death_between_partitions_loses_no_row_and_is_mended(spark, db, tmp_root, monkeypatch):
    from strata.sinks import tables

    t = stored(spark, db, tmp_root, n=20)
    point = tables._point_partitions

    def first_only(spark, name, path, partitions, known):
        point(spark, name, path, partitions[:1], known)
        raise RuntimeError("gone")

    # key 1 moves from 2024-02 to a new partition, which is pointed first
    batch = spark.createDataFrame([(1, "new", ts("2024-02-01"), "2024-08")], T)
    monkeypatch.setattr(tables, "_point_partitions", first_only)
    with pytest.raises(RuntimeError):
        upsert_table(spark, t, batch, ["k"], partition_by=["month"])
    monkeypatch.undo()
    spark.catalog.refreshTable(t)
    assert {r.k for r in spark.table(t).collect()} == set(range(20))
    upsert_table(spark, t, batch, ["k"], partition_by=["month"])
    assert spark.table(t).count() == 20 and rows(spark.table(t).filter("k = 1"), "v", "month") == [("new", "2024-08")]


def test_unpartitioned_bucketed_table(spark, db, tmp_root):
    t = f"{db}.d"
    upsert_table(spark, t, spark.range(50).selectExpr("id as k", "'a' as v"), ["k"], order_cols=(), root=tmp_root, buckets=3)
    upsert_table(spark, t, spark.createDataFrame([(7, "b"), (70, "n")], "k bigint, v string"), ["k"], order_cols=())
    assert _bucket_count(spark, t) == 3 and spark.table(t).count() == 51 and rows(spark.table(t).filter("v <> 'a'")) == [(7, "b"), (70, "n")]


def test_new_columns_keep_the_table_readable_at_every_moment(spark, db, tmp_root, monkeypatch):
    """A column that is added: the table is never dropped; an old reader's files stay."""
    materialize(spark.createDataFrame([(1, "a")], "k int, v string"), f"{db}.m", tmp_root)
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **b: (said.append(q), sql(self, q, *a, **b))[1])
    materialize(spark.createDataFrame([(2, "b", 2.5)], "k int, v string, w double"), f"{db}.m", tmp_root)
    assert rows(spark.table(f"{db}.m")) == [(2, "b", 2.5)]
    assert not any("DROP TABLE" in q or "RENAME" in q for q in said)


def test_changed_columns_swap_by_name_and_recover(spark, db, tmp_root):
    materialize(spark.createDataFrame([(1, "a")], "k int, v string"), f"{db}.m", tmp_root)
    materialize(spark.createDataFrame([("x", 7)], "v string, k bigint"), f"{db}.m", tmp_root)
    assert rows(spark.table(f"{db}.m"), "v", "k") == [("x", 7)]
    assert not spark.catalog.tableExists(f"{db}.m__next") and not spark.catalog.tableExists(f"{db}.m__last")
    spark.sql(f"ALTER TABLE {db}.m RENAME TO {db}.m__next")  # as a run leaves it that dies between the two names
    materialize(spark.createDataFrame([("y", 8)], "v string, k bigint"), f"{db}.m", tmp_root)
    assert rows(spark.table(f"{db}.m"), "v", "k") == [("y", 8)] and not spark.catalog.tableExists(f"{db}.m__next")


def test_bucket_count():
    assert bucket_count(1) == 1 and bucket_count(10 << 30) == 40
    assert bucket_count(100_000_000_000_000, partitions=84) == 4435


def test_buckets_of_rows():
    assert (buckets_of_rows(0), buckets_of_rows(2_000_000), buckets_of_rows(54_000_000)) == (4, 4, 108)


def test_buckets_of_the_stored_upsert_follow_its_orders(spark, monkeypatch):
    from strata.plans import queries

    few = queries.q_upsert_orders_stored(spark, SMOKE)
    monkeypatch.setattr(queries, "buckets_of_rows", lambda n: buckets_of_rows(n, bucket_rows=100))
    many = queries.q_upsert_orders_stored(spark, SMOKE)
    buckets = lambda df: {re.search(r"_(\d{5})\.c", f)[1] for f in df.inputFiles()}
    assert len(buckets(few)) == 4 and len(buckets(many)) == -(-few.count() // 100)
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()


def test_landing_observes_rows_and_watermark(spark, tmp_root):
    df = spark.createDataFrame([(1, "a", ts("2024-01-01")), (2, "b", ts("2024-01-03 04:05:06.7")), (3, "c", None)], SCHEMA)
    path, n, w = land(df, tmp_root, "x", "2024-01-04", "b1", "updated_at")
    assert (n, w) == (3, "2024-01-03 04:05:06.700000") and spark.read.parquet(path).count() == 3
    assert land(df.limit(0), tmp_root, "x", "2024-01-04", "b2", "updated_at")[1:] == (0, None)


def test_observed_figures_need_no_second_job(spark, tmp_root):
    df = spark.range(100)
    out, seen = observed(df, n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    out.write.parquet(f"{tmp_root}/o")
    assert seen.get == {"n": 100, "odd": 50}


def skewed_source(spark, url):
    """90 % of the new rows in 1 % of the key range."""
    r = random.Random(1)
    ids = set(r.sample(range(500_000, 505_000), 1800)) | set(r.sample(range(500_000), 200))
    df = spark.createDataFrame([(i, f"n{i}", ts("2024-02-01")) for i in ids], SCHEMA)
    old = spark.createDataFrame([(i, "old", ts("2023-01-01")) for i in range(600_000, 601_000)], SCHEMA)
    write_source(df.unionByName(old), url, "SKEW")
    return ids


def test_splits_at_quantiles(spark):
    url = derby_url()
    ids = skewed_source(spark, url)
    newer = ("updated_at", "2024-01-01 00:00:00")
    split = jdbc_source(spark, url, "SKEW", DERBY, partition_column="id", num_partitions=8, newer_than=newer)
    new = split.filter("updated_at > '2024-01-01'")
    sizes = [r.n for r in new.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert split.rdd.getNumPartitions() == 8 and max(sizes) < 2 * len(ids) / 8
    assert sorted(r.id for r in new.collect()) == sorted(ids)
    assert split.count() == len(ids) + 1000  # rows out of the measured range are in the outer ranges
    for bins in (4, 16):  # more levels
        cuts = key_cuts(spark, url, "SKEW", "id", 8, DERBY, newer, bins=bins)
        edges = [-1, *cuts, 10**9]
        assert len(cuts) == 7 and max(sum(a <= i < b for i in ids) for a, b in zip(edges, edges[1:], strict=False)) < 2 * len(ids) / 8


def test_splits_of_few_rows_and_predicates(spark):
    url = derby_url()
    write_source(spark.createDataFrame([(5, "a", ts("2024-01-01"))], SCHEMA), url, "ONE")
    assert jdbc_source(spark, url, "ONE", DERBY, partition_column="id", num_partitions=8).count() == 1
    none = jdbc_source(spark, url, "ONE", DERBY, partition_column="id", num_partitions=8, newer_than=("updated_at", "2025-01-01 00:00:00"))
    assert none.rdd.getNumPartitions() == 1
    assert range_predicates("k", [3, 9]) == ["k < 3 OR k IS NULL", "k >= 3 AND k < 9", "k >= 9"]
