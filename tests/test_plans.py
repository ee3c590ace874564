"""Plan shapes the design relies on (what `.explain()` must show), on the driver's smoke tables."""

import os
import re

import pytest

from strata.operators.quality import TableRules, run_checks, run_table_checks
from strata.operators.sales import daily_sales
from strata.operators.sessions import sessionize
from strata.plans import queries as Q
from strata.sources import adapters as A
from strata.sources.incremental import extract_incremental

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", p))


def test_unique_ids_remove_expand(spark):
    orders = Q.q_silver_orders(spark, SMOKE)
    assert "Expand" not in plan(daily_sales(orders, unique_orders=True))
    assert "Expand" not in plan(daily_sales(orders, unique_orders=False))  # nor do repeated ones bring it back
    assert "Expand" not in plan(Q.q_customer_ltv_of_deliveries(spark, SMOKE))


def test_watermark_reaches_the_parquet_scan(spark):
    p = plan(extract_incremental(A.orders(spark, SMOKE), "updated_at", "2000-01-01 00:00:00"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_orderdate", p)


def test_all_tests_of_a_table_share_one_pass(spark):
    rules = TableRules("t", unique=["order_id", "customer_id"], not_null=["order_id"], accepted_values={"status": ["X"]})
    p = plan(run_table_checks(Q.q_silver_orders(spark, SMOKE), rules))
    assert "Expand" not in p and p.count("FileScan parquet") == 1 and exchanges(p) == 3  # one of them is the dedup's


def test_counts_of_all_tests_are_hashed_not_sorted(spark):
    df = spark.range(100).selectExpr("id", "cast(id % 7 as string) as kind")
    rules = TableRules("t", unique=["id", "kind"], not_null=["id"], accepted_values={"kind": ["1"]})
    p = plan(run_checks({"t": df}, [rules]))
    assert "SortAggregate" not in p and "Sort [" not in p and exchanges(p) == 2


def test_sessions_are_cut_by_the_hour_without_python(spark):
    p = plan(sessionize(A.clickstream_events(spark, SMOKE)))
    assert "hashpartitioning(session_id#" in p and "_slice#" in p
    assert "Pandas" not in p and "Python" not in p and "SinglePartition" not in p


def test_static_plan_broadcasts_nothing_unmeasured(spark):
    from strata.operators.cleaning import silver_customers, silver_orders, silver_payments
    from strata.operators.sales import customer_ltv

    fresh = customer_ltv(
        silver_customers(A.customers(spark, SMOKE)),
        silver_orders(A.orders(spark, SMOKE)),
        silver_payments(A.payments(spark, SMOKE)),
        as_of="2001-08-02",
    )
    p = plan(fresh)  # static plan, before AQE has measured anything
    assert p.count("BroadcastExchange") == 0  # AQE broadcasts what it has measured as small
