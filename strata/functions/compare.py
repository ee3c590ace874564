"""Null-safe change detection and version ids for SCD-2 (ledger L26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed(left_prefix: str, right_prefix: str, cols: Sequence[str]) -> Column:
    """True when any check column differs, treating NULL = NULL as equal.

    A hash of ``concat_ws('|', ...)`` would confuse (NULL, 'x') with ('x', NULL); a column-wise
    ``<=>`` cannot.
    """
    if not cols:
        return F.lit(False)
    same = [F.col(f"{left_prefix}{c}").eqNullSafe(F.col(f"{right_prefix}{c}")) for c in cols]
    out = ~same[0]
    for s in same[1:]:
        out = out | ~s
    return out


def version_id(key_cols: Sequence[str], valid_from: str) -> Column:
    """Surrogate id of a version: sha256 hex of ``<key>|<valid_from as yyyy-MM-dd HH:mm:ss.SSSSSS>``.

    With one key column the fixed-width timestamp suffix makes the text unambiguous; several key
    columns are encoded as JSON first, whose quoting keeps them apart.
    """
    if len(key_cols) == 1:
        k = F.col(key_cols[0]).cast("string")
    else:
        k = F.to_json(F.struct(*[F.col(c) for c in key_cols]))
    stamp = F.date_format(F.col(valid_from), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.concat_ws("|", k, stamp), 256)
