"""M6: request SLIs computed continuously.

Tumbling windows per service under a watermark: a window is emitted once the
watermark passes its end (append mode), rows later than that are dropped, and
state holds only the open windows.  The percentile is ``percentile_approx``
(bounded memory per window), the batch twin uses ``exact=False`` to match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.functions.scalars import ratio
from harborlens.streaming.queue import as_event_time


def sli_stream(stream: DataFrame, width: str = "1 minute", delay: str = "2 minutes", by: str = "service",
               ts: str = "ts", latency: str = "latency_ms", status: str = "status",
               q: float = 0.95) -> DataFrame:
    s = as_event_time(stream, ts).withWatermark(ts, delay)
    agg = s.groupBy(by, F.window(ts, width).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count(F.when(F.col(status) >= 500, 1)).alias("errors"),
        F.percentile_approx(latency, F.lit(q), F.lit(10000)).alias("p"))
    return agg.select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "requests", "errors", ratio("errors", "requests").alias("error_ratio"),
                      F.round("p", 6).alias("p95_ms"))
