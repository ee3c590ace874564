"""Shared helpers: batch sizes, written intermediate tables, checked broadcasts and connected components."""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import remove_path, scratch_path


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Sets the session to hand Python tasks batches of some megabytes, unless it asks for smaller ones: rows hold
    whole texts, so a number of rows (10,000 by default) is no bound on a task's memory."""
    if int(spark.conf.get(_BATCH_BYTES, str(2**31 - 1))) > most:
        spark.conf.set(_BATCH_BYTES, str(most))


def lean(work):
    """The work of a Python task on its batches, which after each of its results gives back what Arrow and the C library have
    kept of freed memory: workers live on for later tasks, and several of them count against one executor."""

    @functools.wraps(work)
    def run(batches):
        for result in work(batches):
            yield result
            del result
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()

    return run


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written to a fresh folder under spark.checkpoint.dir and read back, and that folder, for ``remove_path`` once
    nothing reads it any more.  What the write has shuffled goes when it ends, not when the driver happens to collect
    its garbage: nothing reads it again."""
    spark = df.sparkSession
    path, before = scratch_path(spark, purpose), spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh folder under spark.checkpoint.dir and read back: later steps neither
    recompute it nor depend on an executor's disk.  The folder goes with the session's other scratch."""
    return stored(df, purpose)[0]


def beside(table: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A written table of narrow rows as a join's smaller side: broadcast if it has that many rows at most (its
    count comes from the files' footers), else left to a shuffled join, which gives the same result."""
    return F.broadcast(table) if table.count() <= rows else table


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the undirected ``edges`` (a, b); label is the smallest node
    that it is connected with.

    Large-star and small-star steps in turn (joins and minima, no list of neighbours is ever
    collected) until nothing changes: O(log^2 n) rounds even for long chains.  Self-loops and
    repeated edges change nothing; null ends are dropped.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    spark = edges.sparkSession
    stars, folder = stored(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "star")
    seen = None
    while True:
        print_of = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (mark := (print_of.n, print_of.s)) == seen or not print_of.n:
            break
        seen = mark
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        before = folder
        stars, folder = stored(small.select("e.*").where("a <> b").distinct(), "star")
        remove_path(spark, before)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(stars.select("b", "b")).distinct()
