"""DQ-1..6 data tests and SNK-3 upsert (ledger L5, invariants)."""

from conftest import rows, ts

from strata.operators.quality import (
    TableRules,
    accepted_values_violations,
    foreign_key_violations,
    row_counts,
    run_checks,
    unique_violations,
)
from strata.operators.upsert import merge_frames


def test_dq_unique_not_null_accepted(spark):
    df = spark.createDataFrame(
        [(1, "PENDING"), (1, "bad"), (2, None), (None, "bad"), (3, "worse"), (3, "SHIPPED")], "id int, status string"
    )
    assert rows(unique_violations(df, "id"), "id", "n_records") == [(1, 2), (3, 2)]
    assert rows(accepted_values_violations(df, "status", ["PENDING", "SHIPPED"]), "status", "n_records") == [
        ("bad", 2),
        ("worse", 1),
    ]
    report = run_checks(
        {"t": df},
        [TableRules("t", unique=["id"], not_null=["id", "status"], accepted_values={"status": ["PENDING", "SHIPPED"]})],
    )
    got = {(r.test_name, r.column_name): (r.failures, r.status) for r in report.collect()}
    assert got == {
        ("unique", "id"): (2, "fail"),  # two duplicated values
        ("not_null", "id"): (1, "fail"),
        ("not_null", "status"): (1, "fail"),
        ("accepted_values", "status"): (2, "fail"),  # two distinct bad values; NULL passes
    }


def test_dq_passing_report_and_fk(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(1,), (1,), (3,), (3,), (None,)], "fk int")
    assert rows(foreign_key_violations(child, "fk", parent, "pk"), "fk", "child_rows") == [(3, 2)]
    ok = run_checks({"p": parent}, [TableRules("p", unique=["pk"], not_null=["pk"])])
    assert {r.status for r in ok.collect()} == {"pass"}
    counts = rows(row_counts(spark, {"p": parent, "c": child}), "table_name", "row_count")
    assert counts == [("c", 5), ("p", 2)]


SCHEMA = "k int, v string, updated_at timestamp"


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", ts("2024-01-05")), (2, "b", ts("2024-01-01"))], SCHEMA)
    batch = spark.createDataFrame(
        [(1, "older", ts("2024-01-01")), (3, "new", ts("2024-01-02")), (3, "newer", ts("2024-01-03"))], SCHEMA
    )
    once = merge_frames(target, batch, ["k"])
    # L5: the batch wins even with an older row; duplicate batch keys reduce to the latest
    assert rows(once, "k", "v") == [(1, "older"), (2, "b"), (3, "newer")]
    twice = merge_frames(once, batch, ["k"])
    assert rows(twice) == rows(once)


def test_tests_of_an_absent_table_fail(spark):
    rules = TableRules("gone", unique=["a"], not_null=["a"], accepted_values={"b": ["x"]})
    out = run_checks({"here": spark.range(1)}, [TableRules("here", not_null=["id"]), rules])
    got = sorted((r.test_name, r.model, r.column_name, r.failures, r.status) for r in out.collect())
    assert got == [("accepted_values", "gone", "b", 1, "fail"), ("not_null", "gone", "a", 1, "fail"), ("not_null", "here", "id", 0, "pass"), ("unique", "gone", "a", 1, "fail")]
