"""M1, M2 and E2 from stored sketches: read raw rows once, answer for any window or union later.

*Latency.*  ``latency_sketches`` keeps, for each service and minute, the requests, the
errors and a KLL quantile sketch.  Sketches merge: an hour is made of its minutes, a
day of its hours, and a percentile of any of them comes from the merged sketch.  The
rank of the value given differs from the asked one by at most ``rank_error(k)`` of the
rows (99 % of the time), however many merges lie between; a window of up to ``k`` rows
is exact.

*Distinct events.*  ``event_sketches`` keeps a theta sketch of the event ids of each
period or replica.  Unions and intersections of them say how many events two periods
or replicas share, within ``relative_error(lg)`` (one standard error) of the larger
count; up to 2 ** lg events are exact.

A sketch's size is bounded by its parameter and not by its rows, so tasks send one
bounded value for each group, hot groups included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.functions.scalars import ratio

K = 4096
LG = 16


def rank_error(k: int = K) -> float:
    """Largest difference of ranks, as a share of the rows, that a KLL sketch of size ``k`` makes 99 % of the time."""
    return 2.296 / k ** 0.9021


def relative_error(lg: int = LG) -> float:
    """Standard error of a theta sketch of 2 ** lg entries, as a share of the distinct values."""
    return 1 / math.sqrt((1 << lg) - 2)


# ------------------------------------------------------------------ latency

def latency_sketches(requests: DataFrame, width: str = "1 minute", by: str = "service", ts: str = "ts", latency: str = "latency_ms",
                     status: str = "status", k: int = K) -> DataFrame:
    """(service, window_start, requests, errors, latencies): one row for each window with requests; works on streams with a watermark.

    NULL and NaN latencies are requests without a latency."""
    v = F.col(latency).cast("double")
    rows = requests.select(by, F.window(ts, width).alias("w"), F.col(status).alias("_status"), F.when(~F.isnan(v), v).alias("_v"))
    return rows.groupBy(by, "w").agg(F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("_status") >= 500, 1)).alias("errors"),
                                     F.kll_sketch_agg_double("_v", F.lit(k)).alias("latencies")).select(
        by, F.col("w.start").alias("window_start"), "requests", "errors", "latencies")


def rolled_up(sketches: DataFrame, width: str, by: str = "service", k: int = K) -> DataFrame:
    """The same rows for wider windows, from the narrower ones alone; ``width`` holds a whole number of them."""
    rows = sketches.select(by, F.window("window_start", width).alias("w"), "requests", "errors", "latencies")
    return rows.groupBy(by, "w").agg(F.sum("requests").alias("requests"), F.sum("errors").alias("errors"),
                                     F.kll_merge_agg_double("latencies", F.lit(k)).alias("latencies")).select(
        by, F.col("w.start").alias("window_start"), "requests", "errors", "latencies")


def slis(sketches: DataFrame, width: str, by: str = "service", q: float = 0.95) -> DataFrame:
    """M1 and M2 of windows of ``width``: requests, errors, error_ratio and the value at rank q, NULL without latencies."""
    p = F.when(F.kll_sketch_get_n_double("latencies") > 0, F.kll_sketch_get_quantile_double("latencies", F.lit(q)))
    return sketches.select(by, "window_start", (F.col("window_start") + F.expr(f"INTERVAL {width}")).alias("window_end"), "requests", "errors",
                           ratio("errors", "requests").alias("error_ratio"), F.round(p, 6).alias("p95_ms"))


# ------------------------------------------------------------------ distinct events

def event_sketches(deliveries: DataFrame, by: str | Sequence[str] | Column, key: str = "event_id", lg: int = LG) -> DataFrame:
    """(by columns, deliveries, events): deliveries and a theta sketch of the event ids; NULL ids are deliveries of no event."""
    cols = [by] if isinstance(by, (str, Column)) else list(by)
    return deliveries.groupBy(*cols).agg(F.count(F.lit(1)).alias("deliveries"), F.theta_sketch_agg(key, F.lit(lg)).alias("events"))


def _count(sketch) -> Column:
    return F.round(F.theta_sketch_estimate(sketch)).cast("bigint")


def duplicate_totals(sketches: DataFrame, by: str | Sequence[str], lg: int = LG) -> DataFrame:
    """E2 of unions of sketches: deliveries, distinct_events, duplicates and dup_ratio per ``by`` (coarser than the sketches' groups)."""
    cols = [by] if isinstance(by, str) else list(by)
    out = sketches.groupBy(*cols).agg(F.sum("deliveries").alias("deliveries"), _count(F.theta_union_agg("events", F.lit(lg))).alias("distinct_events"))
    out = out.withColumn("duplicates", F.greatest(F.lit(0).cast("bigint"), F.col("deliveries") - F.col("distinct_events")))
    return out.withColumn("dup_ratio", ratio("duplicates", "deliveries"))


def overlap_with_previous(sketches: DataFrame, period: str, previous: Column, by: Sequence[str] = ()) -> DataFrame:
    """Events a period shares with the one before it: period, previous, distinct_events, shared.

    ``previous`` gives the period before from a row's own; it is NULL in the result, and
    ``shared`` 0, where that has no deliveries.  An equi-join of one row a period."""
    other = sketches.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(period).alias("_before"), F.col("events").alias("_events"))
    on = previous == F.col("_before")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rows = sketches.join(other, on, "left")
    return rows.select(*by, period, F.col("_before").alias("previous"), _count("events").alias("distinct_events"),
                       F.coalesce(_count(F.theta_intersection("events", "_events")), F.lit(0).cast("bigint")).alias("shared"))


def overlap_with_next(sketches: DataFrame, n: int, replica: str = "replica") -> DataFrame:
    """Events a replica shares with the one a redelivery moves to, (replica + 1) mod n: replica, next, shared.

    An equi-join on the next replica: n pairs, one for each replica that has a next one with deliveries."""
    other = sketches.select(F.col(replica).alias("next"), F.col("events").alias("_events"))
    rows = sketches.withColumn("next", ((F.col(replica) + 1) % n).cast("int")).join(other.withColumn("next", F.col("next").cast("int")), "next")
    return rows.select(replica, "next", _count(F.theta_intersection("events", "_events")).alias("shared"))
