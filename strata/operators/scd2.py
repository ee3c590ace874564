"""Type-2 versioned dimensions: snapshot (SCD-1..4), current flag (SCD-5), version statistics
(SCD-6) and the point-in-time join (SCD-7 / JOIN-7).

A history is a DataFrame of the extract's columns plus ``dbt_scd_id``, ``dbt_valid_from`` and
``dbt_valid_to`` (NULL = open); the column names follow the reference's snapshot tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.compare import changed, version_id
from strata.operators.dedup import default_ties, keep_latest
from strata.operators.sequence import sequence_within_groups

# Metadata column names of a snapshot table.
SCD_ID = "dbt_scd_id"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


def _as_of_col(as_of, like_type) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast(like_type)
    # string -> timestamp: zone-free for timestamp_ntz, session zone for timestamp
    return F.lit(str(as_of)).cast(like_type)


def snapshot(
    history: DataFrame | None,
    extract: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: str | _dt.datetime | Column,
    close_missing: bool = True,
    order_col: str | None = "updated_at",
) -> DataFrame:
    """One snapshot run with the ``check`` strategy; returns the whole new history.

    * key new in the extract            -> open version from ``as_of``
    * open version, any check column differs (NULL-safe, ledger L26) -> close at ``as_of`` and
      open a new version
    * open version, all equal           -> untouched (re-running an equal extract is a no-op)
    * open version, key gone and ``close_missing`` -> close at ``as_of`` (hard delete)
    * closed versions                   -> untouched; a key that returns opens a new version

    One full outer join of history and extract, on the key and only for open versions: closed ones
    pass through it unmatched, so a chain of n runs reads each extract once and has n - 1 joins.
    Unchecked columns are frozen at the moment a version opens (ledger L32).
    """
    return snapshot_changes(history, extract, key, check_cols, as_of, close_missing, order_col)


def snapshot_changes(
    open_versions: DataFrame | None,
    extract: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: str | _dt.datetime | Column,
    close_missing: bool = True,
    order_col: str | None = "updated_at",
) -> DataFrame:
    """The given versions in their new state (kept or closed at ``as_of``; closed ones as they are) plus
    the versions the run opens.  ``open_versions=None`` is the first run.

    The extract is reduced to its latest row per key first, so the full outer join with the
    open versions (one per key) is 1:1: nothing can fan out, and a run over the open versions costs in
    proportion to the number of keys, not to the length of the history.
    """
    cols = list(extract.columns)
    ts_type = extract.schema[order_col].dataType if order_col else "timestamp"
    as_of_c = _as_of_col(as_of, ts_type)
    if order_col:
        ext = keep_latest(extract, [key], [order_col], default_ties(cols, [key], [order_col]))
    else:
        ext = extract.dropDuplicates([key])

    def opened(prefix: str = "") -> Column:
        fields = [F.col(f"{prefix}{c}").alias(c) for c in cols]
        return F.struct(
            *fields,
            as_of_c.alias(VALID_FROM),
            F.lit(None).cast(ts_type).alias(VALID_TO),
        )

    if open_versions is None:
        first = ext.select(opened().alias("v")).select("v.*")
        return first.withColumn(SCD_ID, version_id([key], VALID_FROM)).select(*cols, SCD_ID, VALID_FROM, VALID_TO)

    hist_cols = [*cols, SCD_ID, VALID_FROM, VALID_TO]
    open_ = open_versions.select(*[F.col(c).alias(f"h_{c}") for c in hist_cols])
    e = ext.select(*[F.col(c).alias(f"e_{c}") for c in cols])

    is_open = F.col(f"h_{VALID_TO}").isNull()
    j = open_.withColumn("has_h", F.lit(True)).join(
        e.withColumn("has_e", F.lit(True)), F.col(f"h_{key}").eqNullSafe(F.col(f"e_{key}")) & is_open, "full_outer"
    )
    has_h, has_e = F.col("has_h").isNotNull(), F.col("has_e").isNotNull()
    diff = has_h & has_e & changed("h_", "e_", check_cols)
    gone = has_h & is_open & ~has_e & F.lit(bool(close_missing))

    kept_or_closed = F.struct(
        *[F.col(f"h_{c}").alias(c) for c in cols],
        F.col(f"h_{VALID_FROM}").alias(VALID_FROM),
        F.when(diff | gone, as_of_c).otherwise(F.col(f"h_{VALID_TO}")).alias(VALID_TO),
    )
    new_version = opened("e_")
    # Each joined row yields the old version (if any) and a new one (if new or changed): a
    # narrow per-row expansion, no second pass over the join.
    rows = F.array(
        F.when(has_h, kept_or_closed),
        F.when(has_e & (~has_h | diff), new_version),
    )
    return (
        j.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))
        .withColumn(SCD_ID, version_id([key], VALID_FROM))
        .select(*hist_cols)
    )


def snapshot_series(
    extracts: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Sequence[str | _dt.datetime],
    run_col: str = "_run",
    close_missing: bool = True,
    order_col: str | None = "updated_at",
) -> DataFrame:
    """The history after ``len(as_of)`` snapshot runs, from all their extracts in one pass (a backfill).

    ``extracts`` has the rows of every extract with its number in ``run_col`` (1, 2, ...; run r happened at ``as_of[r - 1]``).
    The result is that of ``snapshot`` run after run.  A key's rows in order of the runs tell its versions: one opens where
    the key is new, comes back or differs from the run before, and ends where the next one opens or the key is missing.
    That is two windows over a few rows a key, on one shuffle (and one for the latest row per key and run), instead of a join a run.
    """
    cols = [c for c in extracts.columns if c != run_col]
    ts_type = extracts.schema[order_col].dataType if order_col else T.TimestampType()
    times = F.array(*[_as_of_col(t, ts_type) for t in as_of])
    at = lambda run: F.element_at(times, run.cast("int"))
    if order_col:
        ext = keep_latest(extracts, [key, run_col], [order_col], default_ties(cols, [key], [order_col]))
    else:
        ext = extracts.dropDuplicates([key, run_col])
    runs = Window.partitionBy(key).orderBy(run_col)
    checked = F.struct(run_col, *check_cols)
    seen = ext.withColumns({"_before": F.lag(checked).over(runs), "_after": F.lead(checked).over(runs)})

    def differs(other: str) -> Column:
        """Not the same version in that run: changed, or (unless gaps are kept open) not the neighbouring run."""
        equal = F.lit(True)
        for c in check_cols:
            equal = equal & F.col(c).eqNullSafe(F.col(f"{other}.{c}"))
        return ~equal | (F.lit(bool(close_missing)) & (F.abs(F.col(run_col) - F.col(f"{other}.{run_col}")) != 1))

    opens = F.col("_before").isNull() | differs("_before")
    missing_next = F.lit(bool(close_missing)) & (F.col(run_col) < len(as_of)) & ~F.col(f"_after.{run_col}").eqNullSafe(F.col(run_col) + 1)
    ends = F.when(missing_next, at(F.col(run_col) + 1)).when(F.col("_after").isNotNull() & differs("_after"), at(F.col(f"_after.{run_col}")))
    onward = runs.rowsBetween(0, Window.unboundedFollowing)
    versions = seen.select(*cols, run_col, opens.alias("_opens"), ends.alias("_ends")).withColumn(VALID_TO, F.first("_ends", ignorenulls=True).over(onward))
    return (
        versions.filter("_opens")
        .withColumn(VALID_FROM, at(F.col(run_col)))
        .withColumn(SCD_ID, version_id([key], VALID_FROM))
        .select(*cols, SCD_ID, VALID_FROM, VALID_TO)
    )


def current_flag(history: DataFrame) -> DataFrame:
    """``select *, dbt_valid_to is null as is_current`` (PRJ-11); a view, not a copy (L23)."""
    return history.withColumn("is_current", F.col(VALID_TO).isNull())


def version_stats(history: DataFrame, key: str = "customer_id") -> DataFrame:
    """Per-key version statistics (DS-7 ``silver_customer_profile_history``).

    ``has_relocated`` is true for *any* profile change, not only an address change (L24).
    """
    stats = history.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_profile_versions"),
        (F.count(F.lit(1)) - 1).alias("number_of_profile_changes"),
        F.min(VALID_FROM).alias("first_seen_at"),
        F.max(F.when(F.col(VALID_TO).isNull(), F.col(VALID_FROM))).alias("current_version_since"),
    )
    return stats.withColumn("has_relocated", F.col("number_of_profile_changes") > 0)


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    fact_time: str,
    columns: Sequence[str],
    prefix: str = "",
    how: str = "left",
    fact_key: str | None = None,
    slice_unit: str = "MONTH",
) -> DataFrame:
    """Attach to each fact the version valid at its time: ``from <= t < coalesce(to, +inf)``.

    Versions of a key must not overlap and have distinct starts, as snapshots make them; a fact then
    matches at most one and nothing fans out.  Facts before the first version, in a gap after a hard
    delete, or without key or time get NULLs (``how="inner"`` leaves them out).

    Facts and versions are merged in time order per key and the latest version, with its columns, is carried forward
    (``sequence_within_groups``, which spreads a hot key over tasks by ``slice_unit``): O(n log n) whatever the number of
    versions, and no join of facts with the history.
    """
    inner = how == "inner"
    if not inner and how not in ("left", "leftouter", "left_outer"):
        raise ValueError("how must be 'left' or 'inner'")
    fk = fact_key or key
    version = F.struct(F.col(VALID_FROM).alias("_from"), F.col(VALID_TO).alias("_to"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    versions = history.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields],
        F.col(key).alias("_k"), F.col(VALID_FROM).alias("_t"), F.lit(0).alias("_kind"), version.alias("_v"),
    )
    events = facts.select(
        *facts.columns, F.col(fk).alias("_k"), F.col(fact_time).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(versions.schema["_v"].dataType).alias("_v"),
    ).unionByName(versions)
    # a version starting at the fact's instant covers it: versions sort before facts on ties
    timed = isinstance(events.schema["_t"].dataType, T.TimestampType | T.TimestampNTZType | T.DateType)
    cut = F.date_trunc(slice_unit, "_t") if timed else None
    filled = sequence_within_groups(events, "_k", ["_t", "_kind"], [], fill_cols=["_v"], slice_by=cut).filter(F.col("_kind") == 1)
    v = F.col("_fill__v")
    valid = F.col("_k").isNotNull() & F.col("_t").isNotNull() & v.isNotNull() & (v["_to"].isNull() | (F.col("_t") < v["_to"]))
    out = filled.filter(valid) if inner else filled
    return out.select(*facts.columns, *[F.when(valid, v[f"_c{i}"]).alias(f"{prefix}{c}") for i, c in enumerate(columns)])
