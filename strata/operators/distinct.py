"""Exact distinct counts that add up: bitmaps per group and bucket of ids (AGG-3..5).

``count(distinct case when ...)`` over several conditions and columns makes Spark copy every row once per distinct
expression (``Expand``), and its result cannot be merged with that of other rows.  Here an id is one bit: bucket
``bitmap_bucket_number(id)``, position ``bitmap_bit_position(id)``.  A partial result is a bitmap of 32,768 bits per
(group, bucket, condition).  Partials of two batches are merged by OR, with sums added, and a count is the number
of set bits over a group's buckets: the same ids count once, whichever batch they came in.

Ids must be integers.  A bitmap costs 4 KB before compression however few ids its bucket has, so this suits ids that lie
densely (surrogate keys), of which a day sees many per bucket; for groups of a few rows (a customer's payments) counting
groups of (group, id) is the better way, as ``sales.customer_ltv`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDS, BUCKET = "_ids", "_bucket"


def countable(df: DataFrame, *id_cols: str) -> bool:
    """Whether the columns are integers, which bitmaps need."""
    return all(isinstance(df.schema[c].dataType, T.IntegralType) for c in id_cols)


def distinct_partials(df: DataFrame, by: Sequence[str], distinct: dict[str, tuple[str, Column | None]], sums: dict[str, Column]) -> DataFrame:
    """Mergeable partial results per ``by``: a bitmap for each name of ``distinct`` (id column, condition or None), a sum for each of ``sums``.

    One pass and one shuffle.  Each row gives one entry per id column; sums ride on the first one's.
    """
    ids = list(dict.fromkeys(c for c, _ in distinct.values()))
    if not countable(df, *ids):
        raise TypeError(f"bitmaps need integer ids: {ids}")
    kept = df.select(
        *by, *[F.col(c).cast("long").alias(f"_id{i}") for i, c in enumerate(ids)],
        *[(F.lit(True) if when is None else when).alias(f"_if_{name}") for name, (_, when) in distinct.items()],
        *[value.alias(f"_sum_{name}") for name, value in sums.items()],
    )
    types = {f.name: f.dataType for f in kept.schema.fields}

    def entry(i: int) -> Column:
        bit = F.bitmap_bit_position(F.col(f"_id{i}"))
        flags = [F.when(F.col(f"_if_{name}"), bit).alias(name) if c == ids[i] else F.lit(None).cast("long").alias(name) for name, (c, _) in distinct.items()]
        own = [(F.col(f"_sum_{n}") if i == 0 else F.lit(None).cast(types[f"_sum_{n}"])).alias(f"_sum_{n}") for n in sums]
        return F.struct(F.lit(ids[i]).alias(IDS), F.bitmap_bucket_number(F.col(f"_id{i}")).alias(BUCKET), *flags, *own)

    entries = kept.select(*by, F.explode(F.array(*[entry(i) for i in range(len(ids))])).alias("_e")).select(*by, "_e.*")
    return entries.groupBy(*by, IDS, BUCKET).agg(
        *[F.bitmap_construct_agg(F.col(name)).alias(name) for name in distinct],
        *[F.sum(f"_sum_{n}").alias(n) for n in sums],
    )


def merge_partials(partials: DataFrame, by: Sequence[str], distinct: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Partials of several batches (a union of them) as one: bitmaps by OR, sums added."""
    types = {f.name: f.dataType for f in partials.schema.fields}
    return partials.groupBy(*by, IDS, BUCKET).agg(
        *[F.bitmap_or_agg(F.col(name)).alias(name) for name in distinct],
        *[F.sum(n).cast(types[n]).alias(n) for n in sums],
    )


def finish_partials(partials: DataFrame, by: Sequence[str], distinct: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The distinct counts and sums per ``by`` of merged partials."""
    types = {f.name: f.dataType for f in partials.schema.fields}
    return partials.groupBy(*by).agg(
        *[F.sum(F.bitmap_count(F.col(name))).alias(name) for name in distinct],
        *[F.sum(n).cast(types[n]).alias(n) for n in sums],
    )
