"""Time helpers: tolerant event-time parsing (STR-3), elapsed seconds (PRJ-9), day bucket (AGG-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fallback patterns tried after the default ISO parse, in this order.
EVENT_TIME_PATTERNS = ("yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_event_time(col: str | Column, mode: str = "strict") -> Column:
    """String -> timestamp; the first pattern that parses wins, failures give NULL.

    ``strict`` reproduces the three attempts of the stream notebook (ledger L13: an
    epoch-millisecond string gives NULL).  ``lenient`` adds a fourth attempt that reads a
    run of 12-13 digits as epoch milliseconds.
    """
    c = _c(col)
    attempts = [F.try_to_timestamp(c)]
    attempts += [F.try_to_timestamp(c, F.lit(p)) for p in EVENT_TIME_PATTERNS]
    if mode == "lenient":
        millis = F.when(c.rlike(r"^\s*\d{12,13}\s*$"), F.trim(c).try_cast("bigint"))
        attempts.append(F.timestamp_millis(millis))
    elif mode != "strict":
        raise ValueError(f"unknown decode mode {mode!r}")
    return F.coalesce(*attempts)


def elapsed_seconds(later: str | Column, earlier: str | Column) -> Column:
    """Whole-second difference; NULL when either side is NULL (ledger L16)."""
    return F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))


def to_day(col: str | Column) -> Column:
    """The calendar day of a timestamp (``date(x)``)."""
    return F.to_date(_c(col))
