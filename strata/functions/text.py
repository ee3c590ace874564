"""Text normalisers used by the Silver cleaners (PRJ-3..6, PRJ-8).

``initcap`` lower-cases the rest of every space-separated word (ledger L11), so
``o'BRIEN-smith`` becomes ``O'brien-smith``; that is kept as is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trimmed(col: str | Column) -> Column:
    """``trim`` (spaces at both ends)."""
    return F.trim(_c(col))


def upper_trim(col: str | Column) -> Column:
    """``upper(trim(x))``: status and method codes."""
    return F.upper(F.trim(_c(col)))


def lower_trim(col: str | Column) -> Column:
    """``lower(trim(x))``: emails, event types."""
    return F.lower(F.trim(_c(col)))


def initcap_trim(col: str | Column) -> Column:
    """``initcap(trim(x))``: names and cities (L11)."""
    return F.initcap(F.trim(_c(col)))
