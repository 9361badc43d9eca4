"""harborlens: operations analytics as PySpark DataFrame and Structured Streaming operators.

Every operator is a function from DataFrames to a DataFrame, built from Spark's
own joins, windows, aggregations, higher-order functions and watermarks.
"""

from harborlens.session import build_session, checkpoint_dir, cluster_settings

__all__ = ["build_session", "checkpoint_dir", "cluster_settings"]
