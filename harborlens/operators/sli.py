"""SLIs, alerts and retention.

Scale notes.  M1/M2 are one aggregation keyed by (service, window) with map-side
partial aggregation.  The exact percentile orders only the values that a bounded
sketch leaves in question; ``exact=False`` is the sketch alone, for streams.
M3/M4 run windows over the per-window series only, never over raw requests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlens.functions.scalars import epoch_micros, ratio, ts_literal


def _window(ts: str, width: str) -> Column:
    return F.window(ts, width)


SKETCH = 10_000


def latency_p95(requests: DataFrame, width: str = "1 minute", by: str = "service", ts: str = "ts",
                latency: str = "latency_ms", q: float = 0.95, exact: bool = True,
                resolution: float | None = None) -> DataFrame:
    """M1: p95 latency per service and tumbling window (empty windows: no row).

    The exact percentile (interpolated between neighbours) is found in two steps.
    A bounded sketch per group, whose rank error is at most 1 / SKETCH, gives two
    values that certainly enclose it; then only the values between them, well under
    a thousandth of the rows, are counted and ordered, and everything below is one
    number.  ``resolution`` (e.g. 1.0 for whole milliseconds) rounds values first.
    ``exact=False`` is the sketch alone."""
    v = F.col(latency)
    if resolution:
        v = F.round(v / F.lit(resolution)) * F.lit(resolution)
    rows = requests.select(by, _window(ts, width).alias("w"), v.cast("double").alias("v"))
    key = [by, "window_start", "window_end"]
    rows = rows.select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "v")
    if not exact:
        return (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("requests"), F.percentile_approx("v", F.lit(q), F.lit(SKETCH)).alias("p"))
                .select(*key, "requests", F.round("p", 6).alias("p95_ms")))
    around = [max(0.0, q - 2 / SKETCH), min(1.0, q + 2 / SKETCH)]
    bounds = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("requests"), F.count("v").alias("n"),
        F.percentile_approx("v", F.array(*[F.lit(x) for x in around]), F.lit(SKETCH)).alias("b"),
        F.array(F.min("v"), F.max("v")).alias("all"))
    # The margins are rows of a group only where it is large; a small group is ordered whole.
    bounds = bounds.withColumn("b", F.when(F.col("n") > SKETCH, F.col("b")).otherwise(F.col("all"))).drop("all")
    # Null-safe on the service; windows are never NULL where there is a timestamp.
    other = bounds.select(F.col(by).alias("_by"), F.col("window_start").alias("_start"), "n", "b")
    near = rows.join(other, rows[by].eqNullSafe(F.col("_by")) & (rows["window_start"] == F.col("_start")))
    # All values below the bounds share the key NULL, which sorts first.
    value = F.when(F.col("v") >= F.col("b")[0], F.col("v"))
    counted = (near.where(F.col("v") <= F.col("b")[1]).groupBy(*key, "n", value.alias("value")).agg(F.count(F.lit(1)).alias("c")))
    reached = F.sum("c").over(Window.partitionBy(*key).orderBy("value"))
    rank = F.lit(q) * (F.col("n") - 1)
    ranked = counted.withColumn("reached", reached).withColumn("rank", rank)
    at = lambda r: F.min(F.when(F.col("reached") > r, F.col("value")))
    found = ranked.groupBy(*key).agg(at(F.floor("rank")).alias("lo"), at(F.ceil("rank")).alias("hi"),
                                     F.any_value(F.col("rank") - F.floor("rank")).alias("part"))
    p = F.col("lo") + F.col("part") * (F.col("hi") - F.col("lo"))
    found = found.select(F.col(by).alias("_by"), F.col("window_start").alias("_start"), p.alias("p"))
    return (bounds.join(found, bounds[by].eqNullSafe(F.col("_by")) & (bounds["window_start"] == F.col("_start")), "left")
            .select(*key, "requests", F.round("p", 6).alias("p95_ms")))


def error_ratio(requests: DataFrame, width: str = "1 minute", by: str = "service", ts: str = "ts",
                is_error: Column | None = None) -> DataFrame:
    """M2: share of failed requests per service and window.  Default error =
    HTTP 5xx; pass ``is_error`` for other signals (e.g. failed worker attempts)."""
    err = is_error if is_error is not None else (F.col("status") >= 500)
    w = _window(ts, width)
    return (requests.groupBy(by, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count(F.when(err, 1)).alias("errors"))
            .select(by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "requests", "errors", ratio("errors", "requests").alias("error_ratio")))


def alert_episodes(series: DataFrame, threshold: float, for_n: int, width_s: int, by: str = "service",
                   ts: str = "window_start", value: str = "error_ratio") -> DataFrame:
    """M3: runs of consecutive windows with ``value > threshold`` lasting at least
    ``for_n`` windows.  Consecutive means adjacent in time: a missing window
    breaks the run.  Islands = window index minus row number among breaches."""
    idx = F.floor(epoch_micros(ts, series.schema[ts].dataType) / F.lit(int(width_s) * 1_000_000)).cast("bigint")
    breach = series.where(F.col(value) > threshold).select(by, ts, value, idx.alias("idx"))
    w = Window.partitionBy(by).orderBy("idx")
    isl = breach.withColumn("grp", F.col("idx") - F.row_number().over(w))
    ep = (isl.groupBy(by, "grp")
          .agg(F.min(ts).alias("start_ts"), F.max(ts).alias("last_window_ts"),
               F.count(F.lit(1)).alias("windows"), F.max(value).alias("peak")))
    return (ep.where(F.col("windows") >= for_n)
            .select(by, "start_ts", F.timestamp_add("SECOND", F.lit(int(width_s)), F.col("last_window_ts"))
                    .alias("end_ts"), "windows", F.round("peak", 6).alias("peak")))


def slo_attainment(series: DataFrame, objective: float, target: float, by: str = "service",
                   value: str = "p95_ms", higher_is_worse: bool = True) -> DataFrame:
    """M4: share of windows meeting the objective, and whether that share
    reaches the target."""
    good = (F.col(value) <= objective) if higher_is_worse else (F.col(value) >= objective)
    return (series.groupBy(by)
            .agg(F.count(F.lit(1)).alias("windows"), F.count(F.when(good, 1)).alias("good_windows"))
            .select(by, "windows", "good_windows", ratio("good_windows", "windows").alias("attainment"),
                    (F.col("good_windows") >= F.lit(target) * F.col("windows")).alias("met")))


def write_by_date(df: DataFrame, path: str, ts: str = "ts", date_col: str = "dt", mode: str = "append") -> None:
    """Store samples in ``dt=YYYY-MM-DD`` directories so retention prunes files."""
    (df.withColumn(date_col, F.to_date(F.col(ts))).hint("rebalance", date_col)  # AQE-sized files per day
     .write.mode(mode).partitionBy(date_col).parquet(path))


def retain_partitioned(df: DataFrame, ts: str = "ts", keep: str = "7 days",
                       as_of: dt.datetime | str | None = None, date_col: str = "dt") -> DataFrame:
    """M5 on date-partitioned storage: the same cutoff also on the partition
    column, so whole day directories are skipped at planning time."""
    out = retain(df, ts, keep, as_of)
    if as_of is None:
        return out
    as_of = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    n, unit = keep.split()
    cutoff = as_of - dt.timedelta(seconds=int(n) * _UNIT_SECS[unit])
    return out.where(F.col(date_col) >= F.lit(cutoff.date()))


_UNIT_SECS = {"day": 86400, "days": 86400, "hour": 3600, "hours": 3600, "minutes": 60, "minute": 60,
              "seconds": 1, "second": 1}


def retain(df: DataFrame, ts: str = "ts", keep: str = "7 days", as_of: dt.datetime | str | None = None) -> DataFrame:
    """M5: drop rows older than the retention: keep ``as_of - keep <= ts``.

    A literal cutoff so the predicate reaches the scan (parquet row-group
    statistics, and partition pruning when the data is laid out by date)."""
    if as_of is None:
        cutoff = F.expr(f"current_timestamp() - INTERVAL {keep}")
        return df.where(F.col(ts) >= cutoff)
    as_of = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    n, unit = keep.split()
    secs = int(n) * _UNIT_SECS[unit]
    return df.where(F.col(ts) >= ts_literal(as_of - dt.timedelta(seconds=secs)))
