"""A small control table to which runs add rows (DDL-2), such as the ledger of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.tables import materialize, vacuum_versions


class ControlLog:
    """An external Parquet table of ``schema`` plus ``at``, the time a row was added.

    Every addition is one small file; ``trim`` rewrites what is still wanted as one.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, schema: str):
        self.spark, self.name, self.root, self.schema = spark, name, root, schema

    def ensure(self) -> None:
        """Create the table if missing."""
        if not self.exists():
            empty = self.spark.createDataFrame([], self.schema).withColumn("at", F.current_timestamp())
            materialize(empty, self.name, self.root, coalesce_to=1)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def add(self, rows: Sequence[tuple]) -> None:
        """Append rows, in one write."""
        if rows:
            self.spark.createDataFrame(list(rows), self.schema).withColumn("at", F.current_timestamp()).coalesce(1).write.insertInto(self.name)
            self.spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        """All rows, read anew."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def trim(self, wanted: Column, files: int = 64) -> None:
        """Once the table has more than so many files, keep the wanted rows only, in one."""
        if len(self.rows().inputFiles()) > files:
            materialize(self.rows().filter(wanted), self.name, self.root, coalesce_to=1)
            vacuum_versions(self.spark, self.name, keep=2)
