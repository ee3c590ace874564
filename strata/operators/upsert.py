"""Upsert (SNK-3, SNK-4, JOIN-5) as a pure DataFrame transformation.

``merge_frames`` is the semantics of ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``
without a transactional table format: the batch wins on every key it carries (even with an
older row — ledger L5), target rows it does not carry are kept, nothing is deleted.
Writing the result is ``strata.sinks.tables.upsert_table``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.operators.dedup import default_ties, keep_latest


def merge_frames(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = ("updated_at",),
    dedup_batch: bool = True,
) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch (latest row per key).

    A MERGE with several source rows per key is an error; here the batch is first reduced to
    its latest row per key (keep-latest, map-side limited).  Both sides are then unique per
    key, so the anti-join is 1:1 and cannot be skewed by a hot key.
    """
    b = batch
    if dedup_batch:
        order = [c for c in order_cols if c in batch.columns]
        b = keep_latest(batch, keys, order, default_ties(batch.columns, keys, order))
    b = b.select(*target.columns)
    untouched = target.join(b.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(b)
