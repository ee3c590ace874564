"""Guarded arithmetic (PRJ-13, PRJ-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (``a / nullif(b, 0)``)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """round(num / nullif(den, 0) * 100, scale) as a double (half-up)."""
    return F.round(safe_ratio(_c(num).cast("double"), _c(den).cast("double")) * 100, scale)


def half_up_div(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """round(num / den, scale) with decimal half-up rounding, 0 when den is not positive."""
    return F.when(_c(den) > 0, F.round(_c(num) / _c(den), scale)).otherwise(F.lit(0))
