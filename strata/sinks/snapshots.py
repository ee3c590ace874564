"""Storage of a type-2 history that grows without being rewritten (SNK-7 at scale).

A snapshot run only changes *open* versions (one per key): it closes some, keeps the others
and opens new ones.  So the history is kept as one table partitioned by ``(run_no, _open)``:

* every run writes its changes once (``snapshot_changes``: all previously open versions in
  their new state, plus new versions) into a fresh folder, split by ``_open``;
* the committed history is a view: every *closed* partition up to the committed run plus the
  *open* partition of that run.  Replacing the view (which also records the run number in its
  properties) is the single, atomic commit; a run that dies before it stays invisible and its
  partitions are dropped by the next run.

Work per run is proportional to the number of keys, not to the length of the history; closed
versions are written once, and again only by ``compact_snapshot``.

Layout for lookups of one key (FLT-13, RPT-5, RPT-6): files are range-partitioned and sorted by the key, so
that the minima and maxima of row groups and pages leave out nearly all of a file, and a Parquet bloom
filter on the key leaves out the rest.  Many runs leave many small closed partitions;
``compact_snapshot`` merges them, sorted anew, and the same view commits that in one step.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.scd2 import VALID_FROM, VALID_TO, snapshot_changes

RUN_PROPERTY = "strata.committed_run"
COMPACTED_PROPERTY = "strata.compacted_run"


def _mkdirs(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def _property(spark: SparkSession, view: str, name: str) -> int:
    if not spark.catalog.tableExists(view):
        return 0
    rows = spark.sql(f"SHOW TBLPROPERTIES {view}").filter(F.col("key") == name).collect()
    return int(rows[0]["value"]) if rows else 0


def committed_run(spark: SparkSession, view: str) -> int:
    """The run number recorded by the last commit of ``view`` (0 before the first run)."""
    return _property(spark, view, RUN_PROPERTY)


def compacted_run(spark: SparkSession, view: str) -> int:
    """The last run whose closed versions lie in the compacted partition (0: none)."""
    return _property(spark, view, COMPACTED_PROPERTY)


def _commit(spark: SparkSession, view: str, cols: Sequence[str], run: int, compacted: int) -> None:
    """Show the versions of ``run``: its open ones, the closed ones of the runs since ``compacted``, and those of the runs up
    to it from partition ``-compacted``.  Replacing the view is the commit."""
    col_list = ", ".join(f"`{c}`" for c in cols)
    closed = f"run_no > {compacted} AND run_no <= {run}" + (f" OR run_no = {-compacted}" if compacted else "")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{RUN_PROPERTY}' = '{run}', '{COMPACTED_PROPERTY}' = '{compacted}') AS "
        f"SELECT {col_list} FROM {view}__versions WHERE (NOT _open AND ({closed})) OR (_open AND run_no = {run})"
    )
    spark.catalog.refreshTable(f"{view}__versions")


def _write_by_key(df: DataFrame, folder: str, key: str, options: dict[str, str] | None) -> None:
    """Write versions split by ``_open``, each part range-partitioned and sorted by the key, with a bloom filter on it."""
    out = df.withColumn("_open", F.col(VALID_TO).isNull())
    out = out.repartitionByRange("_open", key).sortWithinPartitions("_open", key)
    bloom = {f"parquet.bloom.filter.enabled#{key}": "true"}
    out.write.mode("errorifexists").options(**bloom, **(options or {})).partitionBy("_open").parquet(folder)


def open_versions(spark: SparkSession, view: str) -> DataFrame | None:
    """The open versions of the committed history (reads one partition), or None on the first run."""
    n = committed_run(spark, view)
    if n == 0:
        return None
    return spark.table(f"{view}__versions").filter((F.col("run_no") == n) & F.col("_open")).drop("run_no", "_open")


def snapshot_run(
    spark: SparkSession,
    view: str,
    extract: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of,
    root: str,
    close_missing: bool = True,
    order_col: str | None = "updated_at",
    options: dict[str, str] | None = None,
) -> int:
    """Run one snapshot into ``view`` (created on first use); returns the committed run number.  ``options`` go to the
    Parquet writer, such as ``parquet.block.size``."""
    table = f"{view}__versions"
    n = committed_run(spark, view)
    changes = snapshot_changes(open_versions(spark, view), extract, key, check_cols, as_of, close_missing, order_col)
    cols = changes.columns
    base = f"{root.rstrip('/')}/{view.replace('.', '/')}"
    folder = f"{base}/run-{uuid.uuid4().hex[:12]}"
    _write_by_key(changes, folder, key, options)
    if not spark.catalog.tableExists(table):
        ddl = changes.schema.toDDL()
        spark.sql(
            f"CREATE TABLE {table} ({ddl}, run_no INT, _open BOOLEAN) USING parquet "
            f"PARTITIONED BY (run_no, _open) LOCATION '{base}/versions'"
        )
    run = n + 1
    for flag in ("true", "false"):
        _mkdirs(spark, f"{folder}/_open={flag}")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_no={run}, _open={flag})")
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (run_no={run}, _open={flag}) LOCATION '{folder}/_open={flag}'")
    _commit(spark, view, cols, run, compacted_run(spark, view))
    return run


def compact_snapshot(spark: SparkSession, view: str, key: str, root: str, options: dict[str, str] | None = None) -> int:
    """Merge the closed versions of all committed runs into one partition sorted by key; returns the run up to which.

    The merged rows go to a new partition (numbered below 0, so no run meets it), and the view switches to it in one
    step.  The partitions it replaces stay for readers of the old view until ``vacuum_snapshot`` drops them.
    """
    run = committed_run(spark, view)
    if run == 0 or compacted_run(spark, view) == run:
        return run
    table, shown = f"{view}__versions", spark.table(view)
    folder = f"{root.rstrip('/')}/{view.replace('.', '/')}/compact-{uuid.uuid4().hex[:12]}"
    _write_by_key(shown.filter(F.col(VALID_TO).isNotNull()), folder, key, options)
    _mkdirs(spark, f"{folder}/_open=false")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_no={-run}, _open=false)")
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (run_no={-run}, _open=false) LOCATION '{folder}/_open=false'")
    _commit(spark, view, shown.columns, run, run)
    return run


def versions_of(spark: SparkSession, view: str, key: str, value) -> DataFrame:
    """All versions of one key of a stored history, oldest first (FLT-13): reads the row groups that can have it."""
    return spark.table(view).filter(F.col(key) == F.lit(value)).orderBy(VALID_FROM)


def vacuum_snapshot(spark: SparkSession, view: str, keep_runs: int = 3) -> list[str]:
    """Drop the superseded *open* partitions of runs older than the last ``keep_runs``, and the *closed* ones of such runs
    that a compaction has replaced, and delete their folders.  Closed versions are history and never lost; what the
    committed view shows is always kept.  Returns the deleted paths."""
    table = f"{view}__versions"
    run, compacted = committed_run(spark, view), compacted_run(spark, view)
    if run == 0:
        return []
    deleted = []
    oldest = run - max(keep_runs, 1)
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = dict(item.split("=", 1) for item in row[0].split("/"))
        run_no, is_open = int(spec["run_no"]), spec["_open"]
        replaced = run_no <= compacted if run_no > 0 else run_no != -compacted
        if abs(run_no) > oldest or (is_open == "false" and not replaced):
            continue
        loc = (
            spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (run_no={run_no}, _open={is_open})")
            .filter(F.col("col_name") == "Location")
            .first()
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_no={run_no}, _open={is_open})")
        if loc is not None:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(loc["data_type"])
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
            deleted.append(loc["data_type"])
    spark.catalog.refreshTable(table)
    return deleted
