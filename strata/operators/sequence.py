"""Skew-proof ``row_number``, ``lag`` and forward fill (``last(..., ignorenulls)``) within groups
(WIN-2..WIN-4; the forward fill also carries the as-of join).

``Window.partitionBy(group)`` puts every row of a group into one task; one session holding a
third of all events would then sort a third of the data on one core.  Instead the rows of a
group are cut into slices by a function of the first order column that never decreases (the hour
of a time, blocks of 1,024 of a number, the first letters of a text), so the cut is a property of the data: every reader, and every
recomputation after a lost executor, sees the same one.

1. A window over (group, slice) numbers the rows of a slice and takes the previous row's values.
2. An aggregate over (group, slice) keeps each slice's row count, last row and last non-null fill
   values; a window over that table, one row per slice, gives each slice its offset and what it
   carries on from the slices before it.
3. Both join on (group, slice).

Result: exact SQL semantics (``row_number()``/``lag`` over ``partition by group order by
order_cols``) by one path whatever the sizes, JVM-side, and nothing runs until an action does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def default_slice(df: DataFrame, order_col: str) -> Column:
    """The hour of a time, a number's block of 1,024, a text's first four characters; other types are not cut."""
    kind = df.schema[order_col].dataType
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        return F.date_trunc("HOUR", order_col)
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(order_col) / 1024)
    if isinstance(kind, T.StringType):
        return F.substring(order_col, 1, 4)  # a longer text is never before its beginning
    return F.lit(None).cast("int")


def sequence_within_groups(
    df: DataFrame,
    group_col: str,
    order_cols: Sequence[str],
    carry_cols: Sequence[str],
    seq_col: str = "_seq",
    prev_prefix: str = "_prev_",
    fill_cols: Sequence[str] = (),
    fill_prefix: str = "_fill_",
    slice_by: Column | None = None,
) -> DataFrame:
    """Add ``seq_col`` (1-based position in the group), ``prev_prefix + c`` for each carry column
    (the previous row's value) and ``fill_prefix + c`` for each fill column (the last non-null
    value up to and including the row: a forward fill).

    Ordering is ascending with NULLs first on ``group_col`` and ``order_cols``; give order columns
    that make the order total (ties are otherwise broken arbitrarily, as in SQL).  ``slice_by``
    must not decrease along ``order_cols[0]``; by default ``default_slice``.
    """
    sliced = df.withColumn("_slice", default_slice(df, order_cols[0]) if slice_by is None else slice_by)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    place = F.struct(*order_cols)
    carried = F.struct(F.lit(True).alias("_row"), *carry_cols)

    inside = Window.partitionBy(group_col, "_slice").orderBy(*order)
    rows = sliced.select(
        "*",
        F.row_number().over(inside).cast("long").alias("_lseq"),
        F.lag(carried).over(inside).alias("_lprev"),
        *[F.last(c, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_lfill_{c}") for c in fill_cols],
    )
    edges = sliced.groupBy(F.col(group_col).alias("_g"), F.col("_slice").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(carried, place).alias("_tail"),
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_last_{c}") for c in fill_cols],
    )
    across = Window.partitionBy("_g").orderBy(F.col("_s").asc_nulls_first())
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    starts = edges.select(
        "_g",
        "_s",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.lag("_tail").over(across).alias("_cprev"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_cfill_{c}") for c in fill_cols],
    )
    joined = rows.join(starts, F.col(group_col).eqNullSafe(F.col("_g")) & F.col("_slice").eqNullSafe(F.col("_s")))
    prev = F.coalesce("_lprev", "_cprev")
    return joined.select(
        *df.columns,
        (F.col("_lseq") + F.col("_offset")).alias(seq_col),
        *[prev[c].alias(f"{prev_prefix}{c}") for c in carry_cols],
        *[F.coalesce(f"_lfill_{c}", f"_cfill_{c}").alias(f"{fill_prefix}{c}") for c in fill_cols],
    )
