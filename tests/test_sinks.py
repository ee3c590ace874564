"""SNK-2/3/6: versioned rebuilds and upserts never touch the files a reader may be using."""

import uuid

from conftest import rows, ts

from strata.sinks.tables import materialize, upsert_table


def test_materialize_rebuild_repoints_and_keeps_old_version(spark, tmp_root):
    db = f"m{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    first = materialize(spark.createDataFrame([(1, "a")], "k int, v string"), f"{db}.t", tmp_root)
    old_reader = spark.read.parquet(first)
    second = materialize(spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), f"{db}.t", tmp_root)
    assert first != second
    assert rows(spark.table(f"{db}.t")) == [(2, "b"), (3, "c")]
    assert rows(old_reader) == [(1, "a")]  # the previous version is still readable


def test_materialize_follows_a_schema_change(spark, tmp_root):
    db = f"s{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    materialize(spark.createDataFrame([(1, "a")], "k int, v string"), f"{db}.t", tmp_root)
    materialize(spark.createDataFrame([(1, "a", 2.5)], "k int, v string, w double"), f"{db}.t", tmp_root)
    assert spark.table(f"{db}.t").columns == ["k", "v", "w"]
    assert rows(spark.table(f"{db}.t")) == [(1, "a", 2.5)]


def test_materialize_partitioned(spark, tmp_root):
    db = f"p{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, day string")
    materialize(df, f"{db}.t", tmp_root, partition_by=["day"])
    assert rows(spark.table(f"{db}.t").filter("day = '2024-01-02'"), "k") == [(2,)]
    materialize(df.filter("k = 1"), f"{db}.t", tmp_root, partition_by=["day"])
    assert rows(spark.table(f"{db}.t"), "k", "day") == [(1, "2024-01-01")]


def test_upsert_table_parquet_path(spark, tmp_root):
    db = f"u{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    schema = "k int, v string, updated_at timestamp"
    t = f"{db}.t"
    upsert_table(spark, t, spark.createDataFrame([(1, "a", ts("2024-01-01"))], schema), ["k"], root=tmp_root)
    before = spark.table(t)
    batch = spark.createDataFrame([(1, "a2", ts("2024-01-02")), (2, "b", ts("2024-01-02"))], schema)
    upsert_table(spark, t, batch, ["k"], root=tmp_root)
    upsert_table(spark, t, batch, ["k"], root=tmp_root)  # idempotent
    assert rows(spark.table(t), "k", "v") == [(1, "a2"), (2, "b")]
    assert before.count() == 1  # a DataFrame planned on the old version still reads it


def test_upsert_rewrites_only_touched_partitions(spark, tmp_root):
    import glob

    db = f"d{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    schema = "k int, v string, updated_at timestamp, month string"
    t = f"{db}.t"
    first = spark.createDataFrame(
        [(1, "a", ts("2024-01-01"), "2024-01"), (2, "b", ts("2024-02-01"), "2024-02")], schema
    )
    upsert_table(spark, t, first, ["k"], root=tmp_root, partition_by=["month"])
    loc = spark.sql(f"DESCRIBE TABLE EXTENDED {t}").filter("col_name = 'Location'").first()["data_type"]
    jan_before = sorted(glob.glob(f"{loc.replace('file:', '')}/month=2024-01/*.parquet"))
    batch = spark.createDataFrame([(2, "b2", ts("2024-02-05"), "2024-02"), (3, "c", ts("2024-02-06"), "2024-02")], schema)
    upsert_table(spark, t, batch, ["k"], root=tmp_root, partition_by=["month"])
    upsert_table(spark, t, batch, ["k"], root=tmp_root, partition_by=["month"])  # idempotent
    assert rows(spark.table(t), "k", "v", "month") == [(1, "a", "2024-01"), (2, "b2", "2024-02"), (3, "c", "2024-02")]
    jan_after = sorted(glob.glob(f"{loc.replace('file:', '')}/month=2024-01/*.parquet"))
    assert jan_before and jan_after == jan_before  # the untouched partition kept its files


def test_partitioned_upsert_on_driver_orders_matches_query(spark, tmp_root):
    import os

    from pyspark.sql import functions as F

    from strata.plans import queries as Q
    from strata.sources import adapters as A

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        return
    month = {"_created_month": F.date_format("created_at", "yyyy-MM")}
    db = f"o{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    t = f"{db}.orders"
    upsert_table(spark, t, A.orders_before(spark, d).withColumns(month), ["order_id"], root=tmp_root,
                 partition_by=["_created_month"])
    upsert_table(spark, t, A.orders_batch_since(spark, d).withColumns(month), ["order_id"], root=tmp_root,
                 partition_by=["_created_month"])
    assert rows(spark.table(t).drop("_created_month")) == rows(Q.q_upsert_orders(spark, d))


def test_vacuum_versions_keeps_the_newest(spark, tmp_root):
    import glob
    import time

    from strata.sinks.tables import vacuum_versions

    db = f"v{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    for i in range(5):
        materialize(spark.createDataFrame([(i,)], "k int"), f"{db}.t", tmp_root)
        time.sleep(0.05)
    folders = glob.glob(f"{tmp_root}/{db}/t/v-*")
    assert len(folders) == 5
    deleted = vacuum_versions(spark, f"{db}.t", keep=2)
    assert len(deleted) == 3 and len(glob.glob(f"{tmp_root}/{db}/t/v-*")) == 2
    assert rows(spark.table(f"{db}.t")) == [(4,)]


def test_upsert_moves_a_key_whose_partition_changed(spark, tmp_root):
    db = f"k{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    schema = "k int, v string, updated_at timestamp, month string"
    t = f"{db}.t"
    first = [(k, "a", ts("2024-01-01"), f"2024-0{k % 3 + 1}") for k in range(1, 10)] + [(20, "only", ts("2024-01-01"), "2023-12"), (21, "n", ts("2024-01-01"), None)]
    upsert_table(spark, t, spark.createDataFrame(first, schema), ["k"], root=tmp_root, partition_by=["month"])
    batch = spark.createDataFrame([(2, "moved", ts("2024-02-01"), "2024-05"), (20, "left", ts("2024-02-01"), "2024-01"), (21, "z", ts("2024-02-01"), None), (30, "new", ts("2024-02-01"), "2024-02")], schema)
    for _ in range(2):  # a second time changes nothing
        upsert_table(spark, t, batch, ["k"], root=tmp_root, partition_by=["month"])
        got = {r.k: (r.v, r.month) for r in spark.table(t).collect()}
        assert spark.table(t).count() == len(got) == 12
        assert got[2] == ("moved", "2024-05") and got[20] == ("left", "2024-01") and got[21] == ("z", None) and got[30] == ("new", "2024-02")
        assert got[5] == ("a", "2024-03")
        assert spark.table(t).filter("month = '2023-12'").count() == 0


def test_upsert_reads_only_touched_partitions(spark, tmp_root):
    from strata.sinks.tables import values_filter

    db = f"f{uuid.uuid4().hex[:6]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_root}/{db}'")
    df = spark.range(30).selectExpr("id as k", "concat('2024-0', id % 9) as month")
    materialize(df, f"{db}.t", tmp_root, partition_by=["month"])
    plan = spark.table(f"{db}.t").filter(values_filter([("2024-01",), ("2024-02",)], ["month"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan and "IN (2024-01,2024-02)" in plan
