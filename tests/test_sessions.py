"""WIN-2..4 skew-proof sequencing, DS-6 sessions, DS-14 funnel; ledger L14/L15/L16/L21."""

import datetime as dt
import random

from conftest import rows, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.sequence import sequence_within_groups
from strata.operators.sessions import funnel, sessionize

EV_SCHEMA = (
    "event_id string, event_type string, event_time timestamp, session_id string, customer_id int, device string, "
    "page_url string, referrer string, user_agent string, ip_address string, product_id int, quantity int, "
    "search_term string, cart_value double"
)


def ev(eid, etype, t, sid, cust=1):
    return (eid, etype, ts(t) if t else None, sid, cust, None, None, None, None, None, None, None, None, None)


def reference_sequence(df):
    w = Window.partitionBy("g").orderBy("t", "e")
    return df.select(
        "g", "t", "e", "v",
        F.row_number().over(w).cast("long").alias("seq"),
        F.lag("t").over(w).alias("pt"),
        F.lag("v").over(w).alias("pv"),
    )


def sequenced(df, **kw):
    got = sequence_within_groups(df, "g", ["t", "e"], ["t", "v"], **kw)
    return got.select("g", "t", "e", "v", F.col("_seq").alias("seq"), F.col("_prev_t").alias("pt"), F.col("_prev_v").alias("pv"))


def test_sequence_matches_window_with_hot_group(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):  # one hot group with ~60% of rows, NULL group and times, many small groups
        g = "hot" if rnd.random() < 0.6 else (None if rnd.random() < 0.05 else f"s{rnd.randrange(200)}")
        data.append((g, None if i % 97 == 0 else rnd.randrange(10_000), i, f"v{i}"))
    df = spark.createDataFrame(data, "g string, t long, e long, v string")
    assert rows(sequenced(df)) == rows(reference_sequence(df))
    assert rows(sequenced(df, slice_by=F.lit(1))) == rows(reference_sequence(df))
    names = df.select("g", F.col("e").cast("string").alias("t"), "e", "v")  # a type that is not cut
    assert rows(sequenced(names)) == rows(reference_sequence(names))


def test_sequence_keeps_nan_nulls_and_late_times(spark):
    t0 = ts("2499-12-31 22:30:00")
    data = []
    for i in range(400):  # one session holds half the rows and spans many hours, beyond what pandas can hold
        g = "hot" if i % 2 else f"s{i % 20}"
        data.append((g, t0 + dt.timedelta(minutes=7 * (i * 37 % 400)), i, float("nan") if i % 5 == 0 else (None if i % 7 == 0 else i / 3)))
    df = spark.createDataFrame(data, "g string, t timestamp, e long, v double")
    got, want = sequenced(df), reference_sequence(df)
    as_text = lambda x: rows(x.select(*[F.col(c).cast("string") for c in x.columns]))
    assert as_text(got) == as_text(want)
    assert "NaN" in {r[-1] for r in as_text(got)}


def test_sequence_splits_a_hot_group_and_runs_nothing_early(spark):
    df = spark.range(4000).selectExpr("if(id >= 0, 'hot', 'none') as g", "id as t", "id as e", "cast(id as string) as v")
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "lazy")
    got = sequence_within_groups(df, "g", ["t", "e"], ["t"])
    assert not sc.statusTracker().getJobIdsForGroup("lazy")
    sc._jsc.sc().clearJobGroup()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g#" in plan and "_slice" in plan and "Python" not in plan and "Pandas" not in plan
    assert got.filter(F.col("_seq") != F.col("t") + 1).count() == 0


def test_ds6_sessionize(spark):
    df = spark.createDataFrame(
        [
            ev("a1", " PAGE_VIEW ", "2024-01-01 00:00:00.900", "s1"),
            ev("a2", "product_view", "2024-01-01 00:00:01.100", "s1", cust=None),
            ev("a3", "Add_To_Cart", "2024-01-01 00:00:01.100", "s1"),  # tie on time: event_id decides
            ev("b1", "search", None, "s2"),  # FLT-3: unparsable time dropped
        ],
        EV_SCHEMA,
    )
    out = {r.event_id: r for r in sessionize(df).collect()}
    assert set(out) == {"a1", "a2", "a3"}
    assert (out["a1"].event_sequence_in_session, out["a1"].previous_event_type, out["a1"].seconds_since_previous_event) == (1, None, None)
    assert out["a1"].event_type == "page_view"
    assert out["a2"].seconds_since_previous_event == 1  # L16: 00.9 -> 01.1 is 1 whole second
    assert (out["a3"].event_sequence_in_session, out["a3"].previous_event_type) == (3, "product_view")
    assert out["a2"].is_anonymous_session and not out["a1"].is_anonymous_session  # L14: per event
    spark.catalog.clearCache()


def test_ds14_funnel_l14_l15(spark):
    df = spark.createDataFrame(
        [
            ev("1", "page_view", "2024-01-01 00:00:00", "s1"),
            ev("2", "product_view", "2024-01-01 00:00:01", "s1", cust=None),
            ev("3", "checkout_start", "2024-01-01 00:00:00", "s2"),  # L15: checkout without page view
            ev("4", "page_view", "2024-01-01 00:00:00", "s3"),
        ],
        EV_SCHEMA,
    )
    r = funnel(sessionize(df)).collect()[0]
    assert (r.total_sessions, r.anonymous_sessions, r.identified_sessions) == (3, 1, 2)
    assert (r.sessions_page_view, r.sessions_product_view, r.sessions_add_to_cart, r.sessions_checkout) == (2, 1, 0, 1)
    assert r.pct_page_to_product == 50.0
    assert r.pct_product_to_cart == 0.0
    assert r.pct_cart_to_checkout is None  # division by zero -> NULL
    assert r.pct_overall_conversion == 50.0
    spark.catalog.clearCache()


def test_l21_funnel_over_zero_sessions(spark):
    empty = spark.createDataFrame([], EV_SCHEMA)
    r = funnel(sessionize(empty)).collect()
    assert len(r) == 1
    r = r[0]
    assert r.total_sessions == 0 and r.anonymous_sessions is None and r.identified_sessions is None
    assert r.pct_page_to_product is None
    spark.catalog.clearCache()


def test_forward_fill_equals_window(spark):
    rnd = random.Random(5)
    data = []
    for i in range(2500):
        g = "hot" if rnd.random() < 0.5 else (None if rnd.random() < 0.05 else f"s{rnd.randrange(50)}")
        data.append((g, rnd.randrange(5000), i, None if rnd.random() < 0.6 else rnd.randrange(100)))
    df = spark.createDataFrame(data, "g string, t long, e long, f long")
    cols = ("g", "t", "e", "f", "_seq", "_fill_f")
    got = sequence_within_groups(df, "g", ["t", "e"], [], fill_cols=["f"])
    w = Window.partitionBy("g").orderBy("t", "e")
    want = df.select(
        "*",
        F.row_number().over(w).cast("long").alias("_seq"),
        F.last("f", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_fill_f"),
    )
    assert rows(got, *cols) == rows(want, *cols)


def test_sessionize_without_event_id(spark):
    df = spark.createDataFrame(
        [("s", ts("2024-01-01 00:00:00"), "page_view"), ("s", ts("2024-01-01 00:00:05"), "checkout_start")],
        "session_id string, event_time timestamp, event_type string",
    ).withColumn("customer_id", F.lit(None).cast("int"))
    out = sorted((r.event_sequence_in_session, r.previous_event_type) for r in sessionize(df).collect())
    assert out == [(1, None), (2, "page_view")]


def test_sequence_by_text_is_cut_and_equal_to_a_window(spark):
    from strata.operators.sequence import default_slice

    r = random.Random(8)
    texts = [None, "", "a", "ab", "abcd", "abcde", "abcdz", "é", "日本語文字", "\U0001F600", "Z", "z" * 9]
    data = [(r.choice([None, 1, 2]), r.choice(texts), i, r.choice([None, i])) for i in range(300)]
    df = spark.createDataFrame(data, "g int, t string, i int, v int")
    w = Window.partitionBy("g").orderBy(F.col("t").asc_nulls_first(), "i")
    plain = df.select("*", F.row_number().over(w).alias("s"), F.lag("i").over(w).alias("p"), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("f"))
    cut = sequence_within_groups(df, "g", ["t", "i"], ["i"], fill_cols=["v"])
    assert sorted(map(str, cut.selectExpr("g", "t", "i", "v", "_seq", "_prev_i", "_fill_v").collect())) == sorted(x.replace(" s=", " _seq=").replace(" p=", " _prev_i=").replace(" f=", " _fill_v=") for x in map(str, plain.collect()))
    assert df.select(default_slice(df, "t")).distinct().count() > 5
