"""Figures of a table that come from the write that makes it (DQ-1..3, DQ-6, AGG-2).

``df.observe`` adds aggregates to a write; they arrive with it, so row counts, NULLs, values outside an
accepted list and the new watermark cost no second read.  Only aggregates that need no shuffle can be
observed: uniqueness still takes a pass of its own (``quality.run_checks``).

The figures of stored tables are noted in the ledger of runs, with the version folder that they are of.  They hold for a
table as long as it points to that folder, so a table that something else has rewritten is read again instead.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.quality import TableRules

ROWS = "rows"


def observed(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates over its rows; the observation has them once an action on it is done."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in aggregates.items()]), seen


def rule_aggregates(rules: TableRules | None) -> dict[str, Column]:
    """The rows, and per test that needs no shuffle the rows against it: ``not_null:<column>``, ``accepted_values:<column>``."""
    out = {ROWS: F.count(F.lit(1))}
    if rules is not None:
        out |= {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in rules.not_null}
        out |= {f"accepted_values:{c}": F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in rules.accepted_values.items()}
    return out


def known_failures(metrics: dict[str, int], rules: TableRules) -> dict[tuple[str, str], int]:
    """Failure counts per (test, column) that a table's metrics tell.  ``accepted_values`` counts distinct values, which
    rows tell only when there are none: a column with offending rows is left to a read."""
    out = {("not_null", c): metrics[f"not_null:{c}"] for c in rules.not_null if f"not_null:{c}" in metrics}
    out |= {("accepted_values", c): 0 for c in rules.accepted_values if metrics.get(f"accepted_values:{c}") == 0}
    return out


def current_metrics(noted: DataFrame, locations: dict[str, str]) -> dict[str, dict[str, int]]:
    """The metrics of the tables that lie where ``locations`` (table -> folder) says, from notes (name, location, detail
    as JSON, at): a row a table reaches the driver."""
    if not locations:
        return {}
    folder = {_folder(path): table for table, path in locations.items()}
    known = noted.filter(F.col("name").isin(*locations) & F.col("detail").isNotNull()).groupBy("name", "location").agg(F.max_by("detail", "at").alias("detail"))
    return {r.name: json.loads(r.detail) for r in known.collect() if folder.get(_folder(r.location)) == r.name}


def as_note(figures: dict) -> str:
    """Observed figures as the text that ``current_metrics`` reads."""
    return json.dumps({k: int(v or 0) for k, v in figures.items()})


def _folder(path: str) -> str:
    """The version folder of a path, whatever form its scheme has."""
    return path.rstrip("/").rsplit("/", 1)[-1]
