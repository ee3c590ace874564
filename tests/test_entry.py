"""Driver contract: entry() smoke, every query has an oracle, and all match DuckDB at sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["order_day", "total_orders"]


def test_every_query_has_an_oracle():
    from strata.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_queries_match_oracle_sf0001(spark):
    from oracle_check import compare

    from strata.plans.queries import QUERIES

    problems = {n: p for n, p in compare(spark, SMOKE, list(QUERIES), log=lambda *_: None).items() if p}
    spark.catalog.clearCache()
    assert problems == {}
