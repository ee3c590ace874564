"""strata: a Spark-native medallion (landing -> bronze -> silver -> gold) retail library.

Every operator takes DataFrames plus column names and returns a DataFrame, so Catalyst
sees whole pipelines as one plan; storing an intermediate is always the caller's choice.
"""

from strata.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
