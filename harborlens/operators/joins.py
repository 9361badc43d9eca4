"""Join helpers: broadcast only behind a size check, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a side may have to be broadcast to every executor.  Rule tables (CIDRs,
# allowlists, node groups, expected endpoints) stay far below it.
DEFAULT_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows.

    The check is a ``limit(max_rows + 1).count()`` job on the small side, so it
    stops reading as soon as the bound is exceeded.  Above the bound the
    DataFrame is returned untouched and Spark plans a shuffle join (AQE may
    still switch to broadcast at run time from real sizes)."""
    n = df.limit(max_rows + 1).count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False
