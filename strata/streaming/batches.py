"""An event table made of micro-batches, each there once and as a whole (STR-4, STR-6, SNK-5), and its dead letters (STR-2).

Every input message ends in exactly one of two tables: ``<name>`` has the events, with the keys that the schema does
not know as a VARIANT, ``<name>_dead_letters`` the messages that are no event, with their text and the reason.

A micro-batch is written to a fresh folder and then registered, events and dead letters together, as partitions of
``<name>__batches`` that are named by stream and batch id.  Registering is the commit.  A batch that dies before it leaves
an unused folder and is repeated; one that is repeated after it (the checkpoint had not noted its end) is found
registered and skipped.  So each event is there once whatever dies when, without a log that the table must keep its files for:
``compact`` rewrites many small batches as one, and the two names are views that switch to it in one step.

A stream is named by its checkpoint folder: a new checkpoint (replay, STR-8) counts its batches anew and adds
another stream to the table.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import remove_path
from strata.sinks.tables import hadoop_path
from strata.streaming.decode import decode_all

COMPACTED = "strata.compacted"  # view property: {"into": partition, "upto": {stream: last batch}}
_PARTS = ("_dead", "_stream", "_batch")
_DEAD_COLUMNS = ("json_value", "_reason", "kafka_timestamp", "_ingested_at", "_source_system")


def stream_name(checkpoint: str) -> str:
    """The name of a stream in the table: the same for every run on one checkpoint folder."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _state(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == COMPACTED).collect()
    return json.loads(rows[0]["value"]) if rows else {"into": None, "upto": {}}


def _show(spark: SparkSession, name: str, columns: list[str], state: dict) -> None:
    """(Re)create the two views over the batches that ``state`` leaves, the events' last: that is the commit."""
    old = " OR ".join(f"(_stream = '{s}' AND _batch <= {n})" for s, n in sorted(state["upto"].items()))
    shown = f"(_stream NOT LIKE 'compacted-%' AND NOT ({old or 'false'}))" + (f" OR _stream = '{state['into']}'" if state["into"] else "")
    events = [c for c in columns if c not in ("json_value", "_reason")]
    for view, cols, dead in ((f"{name}_dead_letters", _DEAD_COLUMNS, "true"), (name, events, "false")):
        listed = ", ".join(f"`{c}`" for c in cols)
        spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{COMPACTED}' = '{json.dumps(state)}') AS SELECT {listed} FROM {name}__batches WHERE _dead = {dead} AND ({shown})")


def ensure_tables(spark: SparkSession, name: str, schema: StructType, root: str) -> None:
    """Create the table of batches and the views of events and dead letters if missing."""
    if not spark.catalog.tableExists(f"{name}__batches"):
        parts = "_dead BOOLEAN, _stream STRING, _batch BIGINT"
        spark.sql(f"CREATE TABLE {name}__batches ({schema.toDDL()}, {parts}) USING parquet PARTITIONED BY ({', '.join(_PARTS)}) LOCATION '{root.rstrip('/')}/registered'")
    if not spark.catalog.tableExists(name):
        _show(spark, name, schema.names, {"into": None, "upto": {}})


def _registered(spark: SparkSession, name: str, stream: str, batch: int) -> bool:
    if batch <= _state(spark, name)["upto"].get(stream, -1):
        return True
    return bool(spark.sql(f"SHOW PARTITIONS {name}__batches PARTITION (_dead=false, _stream='{stream}', _batch={batch})").take(1))


def _register(spark: SparkSession, name: str, folder: str, stream: str, batch: int) -> None:
    """Both partitions of a batch, in one step."""
    specs = []
    for dead in ("false", "true"):
        fs, path = hadoop_path(spark, f"{folder}/_dead={dead}")
        fs.mkdirs(path)
        specs.append(f"PARTITION (_dead={dead}, _stream='{stream}', _batch={batch}) LOCATION '{folder}/_dead={dead}'")
    spark.sql(f"ALTER TABLE {name}__batches ADD {' '.join(specs)}")
    spark.catalog.refreshTable(f"{name}__batches")


def write_batch(df: DataFrame, batch: int, name: str, root: str, stream: str, files: int | None = None) -> None:
    """One micro-batch of decoded messages (``decode_all``): written and registered, or skipped if it is already."""
    spark = df.sparkSession
    if _registered(spark, name, stream, batch):
        return
    folder = f"{root.rstrip('/')}/b-{uuid.uuid4().hex[:12]}"
    out = df.withColumn("_dead", F.col("_reason").isNotNull()).withColumn("json_value", F.when(F.col("_reason").isNotNull(), F.col("json_value")))
    (out.coalesce(files) if files else out).write.mode("errorifexists").partitionBy("_dead").parquet(folder)
    _register(spark, name, folder, stream, batch)


def ingest_batches(
    source: DataFrame,
    checkpoint: str,
    name: str,
    root: str,
    mode: str = "strict",
    wait: bool = True,
    files_per_batch: int | None = None,
):
    """Drain a streaming source (STR-4: ``availableNow``) into ``name`` and ``<name>_dead_letters``; block until drained.

    Each message is read and decoded once.  Returns the number of micro-batches run, or the running query when
    ``wait`` is false.
    """
    decoded = decode_all(source, mode)
    ensure_tables(source.sparkSession, name, decoded.schema, root)
    stream = stream_name(checkpoint)
    query = (
        decoded.writeStream.foreachBatch(lambda df, batch: write_batch(df, batch, name, root, stream, files_per_batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if not wait:
        return query
    query.awaitTermination()
    return len(query.recentProgress)


def read_batches(spark: SparkSession, name: str, drop: bool = False) -> tuple[DataFrame, DataFrame]:
    """The files of events and of dead letters that the views show now; ``drop`` removes the views and the table, whose files stay."""
    out = []
    for view in (name, f"{name}_dead_letters"):
        shown = spark.table(view)
        files = shown.inputFiles()
        out.append(spark.read.schema(shown.schema).parquet(*files) if files else spark.createDataFrame([], shown.schema))
    if drop:
        for statement in (f"DROP VIEW {name}", f"DROP VIEW {name}_dead_letters", f"DROP TABLE {name}__batches"):
            spark.sql(statement)
    return out[0], out[1]


def compact(spark: SparkSession, name: str, root: str, files: int = 1) -> int:
    """Rewrite all registered batches as one of few files; returns how many there were.  The views switch to it in one
    step, so no message is missing or there twice at any moment; ``vacuum`` drops what it replaces."""
    state = _state(spark, name)
    parts = [dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}__batches").collect()]
    batches = {(p["_stream"], int(p["_batch"])) for p in parts if not p["_stream"].startswith("compacted-") and int(p["_batch"]) > state["upto"].get(p["_stream"], -1)}
    if not batches:
        return 0
    upto = dict(state["upto"])
    for stream, batch in batches:
        upto[stream] = max(batch, upto.get(stream, -1))
    into = f"compacted-{uuid.uuid4().hex[:12]}"
    folder = f"{root.rstrip('/')}/{into}"
    own = F.lit(False)
    for stream, last in sorted(upto.items()):
        own = own | ((F.col("_stream") == stream) & (F.col("_batch") <= last) & (F.col("_batch") > state["upto"].get(stream, -1)))
    shown = own if state["into"] is None else own | (F.col("_stream") == state["into"])
    table = spark.table(f"{name}__batches")
    rows = table.filter(shown).drop("_stream", "_batch")
    rows.repartition(files, F.col("_dead"), F.floor(F.rand(7) * files)).write.mode("errorifexists").partitionBy("_dead").parquet(folder)
    _register(spark, name, folder, into, 0)
    _show(spark, name, [c for c in table.columns if c not in _PARTS], {"into": into, "upto": upto})
    return len(batches)


def vacuum(spark: SparkSession, name: str) -> int:
    """Drop the batches that a compaction has replaced and delete their folders; returns how many partitions went.  Readers
    planned before the compaction must have ended."""
    state, gone = _state(spark, name), 0
    for row in spark.sql(f"SHOW PARTITIONS {name}__batches").collect():
        p = dict(x.split("=", 1) for x in row[0].split("/"))
        if p["_stream"].startswith("compacted-"):
            kept = p["_stream"] == state["into"]
        else:
            kept = int(p["_batch"]) > state["upto"].get(p["_stream"], -1)
        if kept:
            continue
        spec = f"PARTITION (_dead={p['_dead']}, _stream='{p['_stream']}', _batch={p['_batch']})"
        where = spark.sql(f"DESCRIBE TABLE EXTENDED {name}__batches {spec}").filter("col_name = 'Location'").first()
        spark.sql(f"ALTER TABLE {name}__batches DROP IF EXISTS {spec}")
        if where is not None:
            remove_path(spark, where["data_type"])
        gone += 1
    spark.catalog.refreshTable(f"{name}__batches")
    return gone
