"""Column expressions (built-in Spark functions only; everything stays in whole-stage codegen)."""

from strata.functions.compare import changed, version_id
from strata.functions.math import half_up_div, pct, safe_ratio
from strata.functions.text import initcap_trim, lower_trim, trimmed, upper_trim
from strata.functions.time import elapsed_seconds, parse_event_time, to_day

__all__ = [
    "changed",
    "version_id",
    "half_up_div",
    "pct",
    "safe_ratio",
    "initcap_trim",
    "lower_trim",
    "trimmed",
    "upper_trim",
    "elapsed_seconds",
    "parse_event_time",
    "to_day",
]
