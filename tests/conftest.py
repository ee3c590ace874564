from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from strata.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[4]").appName("strata-tests")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = "4"
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="strata-wh-")
    conf["spark.driver.extraJavaOptions"] = f"-Dderby.system.home={tempfile.mkdtemp(prefix='strata-derby-')}"
    for k, v in conf.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, *cols, order=None):
    """Collect as sorted tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
