"""Table writers: full rebuild (SNK-2, SNK-6) and upsert into a table (SNK-3, SNK-4).

Without a transactional table format (no Delta/Iceberg jar here), nothing overwrites the files
it reads: every write goes to a fresh version folder, and the external table, or the partitions
that a batch touched, is pointed there afterwards.  Readers of the previous state keep valid
files, and a write that fails leaves the table as it was.

A table that is upserted is stored by its key: bucketed and sorted by it (Spark's ``bucketBy``), so
that a batch finds its stored keys, and replaces them, in joins that shuffle the batch alone.
When the catalog supports row-level MERGE, ``mergeInto`` is used instead.  ``vacuum_versions``
keeps the newest versions, of the table or of each partition, and deletes older folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.dedup import default_ties, keep_latest
from strata.session import remove_path, scratch_path


def table_exists(spark: SparkSession, name: str) -> bool:
    """SRC-8: ``spark.catalog.tableExists``."""
    return spark.catalog.tableExists(name)


# Table formats whose catalogs execute MERGE row by row.
ROW_LEVEL_FORMATS = ("delta", "iceberg", "hudi")


def _provider(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _version_path(base: str) -> str:
    return f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _folders(fs, parent) -> list[tuple[str, int]]:
    """(path, modification time) of the folders in a folder, newest first."""
    if not fs.exists(parent):
        return []
    found = [(st.getPath().toString().rstrip("/"), st.getModificationTime()) for st in fs.listStatus(parent) if st.isDirectory()]
    return sorted(found, key=lambda x: -x[1])


def vacuum_versions(spark: SparkSession, name: str, keep: int = 3) -> list[str]:
    """Delete all but the ``keep`` newest version folders of a versioned table (``v-*`` next to
    its current location), or of each partition of a partitioned one; what the table points to is
    always kept.  Returns the deleted paths.

    Readers planned on one of the kept versions are unaffected; keep enough versions to cover
    the longest reader.
    """
    current = (_location(spark, name) or "").rstrip("/")
    if "/v-" not in current:
        return []
    fs, parent = hadoop_path(spark, current.rsplit("/", 1)[0])
    versions = [(path, at) for path, at in _folders(fs, parent) if path.rsplit("/", 1)[1].startswith("v-")]
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    deleted = []
    if not _partition_columns(spark, name):
        for path, _ in versions[max(keep, 1) :]:
            if not path.endswith(current.rsplit("/", 1)[1]):
                fs.delete(jpath(path), True)
                deleted.append(path)
        return deleted
    depth = len(_partition_columns(spark, name))
    by_partition: dict[str, list[str]] = {}
    for version, _ in versions:
        level = [version]
        for _ in range(depth):
            level = [path for folder in level for path, _ in _folders(fs, jpath(folder)) if "=" in path.rsplit("/", 1)[1]]
        for path in level:
            by_partition.setdefault(path[len(version) + 1 :], []).append(path)
    for partition, paths in by_partition.items():
        if len(paths) <= max(keep, 1):
            continue
        used = _partition_location(spark, name, partition)  # asked for partitions with spare folders only
        for path in paths[max(keep, 1) :]:
            if used is None or not used.endswith(path[path.index("/v-") :]):
                fs.delete(jpath(path), True)
                deleted.append(path)
    for version, _ in versions:  # folders that have lost all their partitions
        if not version.endswith(current.rsplit("/", 1)[1]) and not _folders(fs, jpath(version)):
            fs.delete(jpath(version), True)
    return deleted


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _spec(partition: str) -> str:
    """The PARTITION clause of a registered partition such as ``month=2024-01/kind=a``."""
    pairs = (item.split("=", 1) for item in partition.split("/"))
    value = lambda v: "NULL" if v == "__HIVE_DEFAULT_PARTITION__" else "'" + unquote(v).replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"`{k}`={value(v)}" for k, v in pairs) + ")"


def _partition_location(spark: SparkSession, name: str, partition: str) -> str | None:
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {_spec(partition)}").filter("col_name = 'Location'").collect()
    except AnalysisException:  # no such partition any more
        return None
    return rows[0]["data_type"].rstrip("/") if rows else None


def _partitions(spark: SparkSession, name: str) -> list[str]:
    """The registered partitions (metadata, one row each)."""
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def materialize(
    df: DataFrame,
    name: str,
    root: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    coalesce_to: int | None = None,
) -> str:
    """Full rebuild of a model table (``+materialized: table``) as an external table.

    The new state goes to a fresh version folder under ``root/<name>``; the table is created or
    repointed afterwards, so a model may even read its own previous state.  ``coalesce_to``
    trims the number of output files (small-file compaction) without a shuffle.
    """
    spark = df.sparkSession
    path = _version_path(f"{root.rstrip('/')}/{name.replace('.', '/')}")
    out = df.coalesce(coalesce_to) if coalesce_to else df
    writer = out.write.format(fmt).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    _point_table(spark, name, path, fmt, df, partition_by)
    return path


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where a table's files lie; None for a view."""
    return _location(spark, name)


def _point_table(spark: SparkSession, name: str, path: str, fmt: str, df: DataFrame, partition_by, buckets: int = 0, keys: Sequence[str] = ()) -> None:
    """Point the table at a version folder, creating it or changing its columns if need be.

    New columns at the end are added to the table before it is pointed there (old files read as NULL in them), so it
    is there and whole at every moment.  Other changes of columns need another table: it is made complete under a name
    of its own, and takes over the name by renaming; the old one goes last.
    """
    parts = list(partition_by)
    fields = [f for f in df.schema.fields if f.name not in parts] + [f for p in parts for f in df.schema.fields if f.name == p]
    if not table_exists(spark, name):
        if table_exists(spark, f"{name}__next"):  # a run died while it renamed
            spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
            return _point_table(spark, name, path, fmt, df, partition_by, buckets, keys)
        return _create_table(spark, name, path, fmt, fields, parts, buckets, keys)
    have = {f.name: f.dataType for f in spark.table(name).schema.fields}
    want = {f.name: f.dataType for f in fields}
    if list(_partition_columns(spark, name)) != parts or _bucket_count(spark, name) != buckets or any(want.get(c) != t for c, t in have.items()):
        spark.sql(f"DROP TABLE IF EXISTS {name}__next")
        _create_table(spark, f"{name}__next", path, fmt, fields, parts, buckets, keys)
        spark.sql(f"DROP TABLE IF EXISTS {name}__last")
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__last")
        spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
        spark.sql(f"DROP TABLE {name}__last")  # its data folders are untouched
        return None
    if added := [f for f in fields if f.name not in have]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({StructType(added).toDDL()})")
    if parts:
        # partitions are pointed one by one, each in one step; those that are gone go last
        before = set(_partitions(spark, name))
        now = _folder_partitions(spark, path, len(parts))
        _point_partitions(spark, name, path, now, before)
        for partition in before - set(now):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_spec(partition)}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _create_table(spark, name, path, fmt, fields, parts, buckets, keys) -> None:
    part = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    by = ", ".join(keys)
    bucketed = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE {name} ({StructType(fields).toDDL()}) USING {fmt}{part}{bucketed} LOCATION '{path}'")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _point_partitions(spark: SparkSession, name: str, path: str, partitions: Sequence[str], known: set[str]) -> None:
    for partition in partitions:
        at = f"{path}/{partition}"
        if partition in known:
            spark.sql(f"ALTER TABLE {name} {_spec(partition)} SET LOCATION '{at}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {_spec(partition)} LOCATION '{at}'")


def _folder_partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partitions that lie in a version folder, such as ``month=2024-01``."""
    fs, top = hadoop_path(spark, path)
    level = [""]
    for _ in range(depth):
        level = [f"{own}{found.rsplit('/', 1)[1]}/" for own in level for found, _ in _folders(fs, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{own}") if own else top) if "=" in found.rsplit("/", 1)[1]]
    return sorted(x.rstrip("/") for x in level)


def _bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else 0


def bucket_count(input_bytes: int, partitions: int = 1, file_bytes: int = 256 << 20) -> int:
    """Buckets of a stored table of that size: files of about ``file_bytes`` in each of its partitions."""
    return max(1, -(-input_bytes // (max(partitions, 1) * file_bytes)))


def buckets_of_rows(rows: int, least: int = 4, bucket_rows: int = 500_000) -> int:
    """Buckets of a stored table of so many narrow rows: one task handles a bucket, in all partitions that a batch touches, so its
    memory is that of about ``bucket_rows`` rows however many the table has."""
    return max(least, -(-rows // bucket_rows))


def _write_version(df: DataFrame, name: str, path: str, keys: Sequence[str], partition_by: Sequence[str], buckets: int) -> None:
    """Write a version folder; bucketed files need a table to be written through, which is dropped and leaves them."""
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not buckets:
        writer.save(path)
        return
    staging = f"{name}__w{uuid.uuid4().hex[:8]}"
    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(staging)
    df.sparkSession.sql(f"DROP TABLE {staging}")


def _values(df: DataFrame, parts: Sequence[str]) -> list[tuple]:
    return [tuple(r) for r in df.select(*parts).distinct().collect()]


def values_filter(values: list[tuple], parts: Sequence[str]) -> Column:
    """A literal filter on partition columns, which prunes the scan; NULL partitions included."""

    def is_in(p: str, own: set) -> Column:
        known = F.col(p).isin(*sorted((v for v in own if v is not None), key=str))
        return (known | F.col(p).isNull()) if None in own else known

    if len(parts) == 1:
        return is_in(parts[0], {v[0] for v in values})
    rows = F.lit(False)
    for v in values:
        row = F.lit(True)
        for p, x in zip(parts, v, strict=True):
            row = row & F.col(p).eqNullSafe(F.lit(x))
        rows = rows | row
    return rows


def upsert_table(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = ("updated_at",),
    root: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int = 0,
) -> str:
    """Create on first run (SNK-2), else upsert on ``keys`` (SNK-3): matched -> replace, else insert.

    A MERGE-capable table format gets ``mergeInto``, which rewrites only the files holding matched rows.  Otherwise:

    1. The batch is reduced to its latest row per key and written, as later steps read it several times.
    2. The partitions that it touches are those it writes to and those in which its keys are stored now, found by a
       semi-join over keys and partition values.  Of a table with ``buckets`` only the batch is shuffled: the stored
       side lies bucketed by key.
    3. The touched partitions (literal partition filters; the whole table if it has none) without the batch's keys, and the
       batch, go to a new version folder, again without a shuffle of stored rows.
    4. Each touched partition is pointed at its new folder, in one step; one that is left empty is dropped.  New homes
       of a key are pointed before old ones, so a job that dies on the way loses no row, and its repetition (the
       watermark advances last) mends what is there twice.  A key whose partition changed moves.

    A stored table keeps the ``buckets`` it was created with.
    """
    order = [c for c in order_cols if c in batch.columns]
    # several rows per key in one batch: the latest wins (a MERGE would reject them)
    deduped = keep_latest(batch, keys, order, default_ties(batch.columns, keys, order))
    parts = list(partition_by)
    if not table_exists(spark, name):
        if root is None:
            raise ValueError("root is needed to create the table")
        if fmt != "parquet":
            return materialize(deduped, name, root, fmt, partition_by=partition_by)
        return create_keyed(deduped, name, root, keys, parts, buckets)
    if _provider(spark, name) in ROW_LEVEL_FORMATS:
        target = name.split(".")[-1]
        cond = " AND ".join(f"{target}.{k} = s.{k}" for k in keys)
        deduped.alias("s").mergeInto(name, F.expr(cond)).whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return name
    return replace_keys(spark, name, deduped, keys, parts)


def create_keyed(df: DataFrame, name: str, root: str, keys: Sequence[str], partition_by: Sequence[str] = (), buckets: int = 0) -> str:
    """Create a table stored by key, bucketed and sorted if it has ``buckets``; returns its version folder."""
    path = _version_path(f"{root.rstrip('/')}/{name.replace('.', '/')}")
    _write_version(df.repartition(buckets, *keys) if buckets else df, name, path, keys, partition_by, buckets)
    _point_table(df.sparkSession, name, path, "parquet", df, partition_by, buckets, keys)
    return path


def replace_keys(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (), gone: DataFrame | None = None) -> str:
    """Replace all stored rows of a batch's keys by the batch's rows; ``gone`` has further keys, whose rows go.

    Steps 1 to 4 of ``upsert_table``; a key may have several rows here, on either side.  Returns the new version folder.
    """
    current, parts = spark.table(name), list(partition_by)
    buckets = _bucket_count(spark, name)
    base = (_location(spark, name) or "").rstrip("/")
    path = _version_path(base.rsplit("/", 1)[0] if "/v-" in base else base)
    spot = scratch_path(spark, "upsert-batch")
    batch.select(*current.columns).write.parquet(f"{spot}/rows")
    staged = spark.read.schema(current.schema).parquet(f"{spot}/rows")
    replaced = staged.select(*keys)
    if gone is not None:
        gone.select(*keys).write.parquet(f"{spot}/gone")
        replaced = replaced.unionByName(spark.read.schema(replaced.schema).parquet(f"{spot}/gone"))
    if buckets:
        staged, replaced = staged.repartition(buckets, *keys), replaced.repartition(buckets, *keys)
    touched: list[tuple] = []
    if parts:
        # partition values are metadata-sized: one row per touched partition
        touched = _values(stored_partitions(current, replaced, keys, parts).unionByName(staged.select(*parts)), parts)
        if not touched:
            remove_path(spark, spot)
            return base
    stored = current.filter(values_filter(touched, parts)) if parts else current
    merged = replaced_rows(stored, replaced, staged, keys)
    _write_version(merged, name, path, keys, parts, buckets)
    remove_path(spark, spot)
    if not parts:
        _point_table(spark, name, path, "parquet", merged, (), buckets, keys)
        return path
    now, known = _folder_partitions(spark, path, len(parts)), set(_partitions(spark, name))
    _point_partitions(spark, name, path, sorted(now, key=lambda p: p in known), known)
    own = {tuple(_text(v) for v in values) for values in touched}
    for partition in known - set(now):
        if _partition_values(partition) in own:  # touched, and nothing is left of it
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_spec(partition)}")
    spark.catalog.refreshTable(name)
    return path


def stored_partitions(stored: DataFrame, batch: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """The partition values under which a batch's keys are stored: reads keys and partition values alone."""
    return stored.select(*keys, *parts).join(batch.select(*keys), list(keys), "left_semi").select(*parts).distinct()


def replaced_rows(stored: DataFrame, replaced: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows without the replaced keys, and the new rows."""
    return stored.join(replaced.select(*keys), list(keys), "left_anti").select(*stored.columns).unionByName(rows.select(*stored.columns))


def _text(value) -> str | None:
    return str(value).lower() if isinstance(value, bool) else None if value is None else str(value)


def _partition_values(partition: str) -> tuple[str | None, ...]:
    values = (item.split("=", 1)[1] for item in partition.split("/"))
    return tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for v in values)
