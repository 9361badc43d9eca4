"""Backlog and capacity: backlog series, replica demand, stability, recovery,
utilisation and node-group capacity.

Scale notes.  Raw rows are only ever aggregated (partial aggregation, shuffle on
the group keys); every window function runs over the per-poll series, which
has one row per (queue, poll) whatever the message volume, partitioned by
(queue, day), with what one day hands to the next carried by a series of one row
a day.  Dense poll grids are made day by day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlens.functions.scalars import cpu_millis, epoch_micros, micros_between
from harborlens.operators.joins import bounded_broadcast
from harborlens.session import materialised


def poll_after(ts: Column, step_s: int) -> Column:
    """The first poll strictly after ``ts`` on a grid of ``step_s`` seconds from the epoch."""
    return F.window(ts, f"{int(step_s)} seconds")["end"]


def poll_deltas(jobs: DataFrame, step_s: int = 10, by: str = "queue", arrived: str = "arrived_ts", done: str = "done_ts",
                completions: DataFrame | None = None) -> DataFrame:
    """(queue, poll_ts, arrived, done): messages that arrived and completed since the poll before; polls without either are not there."""
    def change(ts, arr, dn):
        return F.struct(F.col(ts).alias("ts"), F.lit(arr).alias("arr"), F.lit(dn).alias("dn"))

    if completions is None:                                   # one pass over the messages
        changes = jobs.select(by, F.inline(F.array(change(arrived, 1, 0), change(done, 0, 1))))
    else:
        changes = jobs.select(by, change(arrived, 1, 0).alias("c")).unionByName(completions.select(by, change(done, 0, 1).alias("c"))).select(by, "c.*")
    deltas = changes.where(F.col("ts").isNotNull()).select(by, poll_after(F.col("ts"), step_s).alias("poll_ts"), "arr", "dn")
    return deltas.groupBy(by, "poll_ts").agg(F.sum("arr").alias("arrived"), F.sum("dn").alias("done"))


def backlog_series(jobs: DataFrame, step_s: int = 10, by: str = "queue", arrived: str = "arrived_ts",
                   done: str = "done_ts", completions: DataFrame | None = None) -> DataFrame:
    """B1: backlog seen at each poll = messages arrived before the poll minus
    those completed before it.  One row per (queue, poll) on a dense grid from
    the first to the last poll that sees a change.

    ``jobs`` holds arrivals (and completions in ``done`` when ``completions``
    is not given); ``completions`` is a separate ``(queue, done)`` table."""
    return series_of(poll_deltas(jobs, step_s, by, arrived, done, completions), step_s, by)


def series_of(per_poll: DataFrame, step_s: int = 10, by: str = "queue") -> DataFrame:
    """B1 from ``poll_deltas`` rows, one for each (queue, poll) at most."""
    # The grid is made day by day and then poll by poll, so no array is longer than
    # the days between a queue's first and last poll or the polls of one day.
    tt = per_poll.schema["poll_ts"].dataType
    step = F.expr(f"INTERVAL {int(step_s)} SECONDS")
    spans = per_poll.groupBy(by).agg(F.min("poll_ts").alias("lo"), F.max("poll_ts").alias("hi"))
    days = spans.select(by, "lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"), F.expr("INTERVAL 1 DAY"))).alias("begin"))
    days = days.withColumn("begin", F.col("begin").cast(tt))
    skipped = F.ceil(micros_between("begin", "lo", tt) / (int(step_s) * 1_000_000)).cast("bigint")
    first = F.when(F.col("begin") > F.col("lo"), F.timestamp_add("SECOND", skipped * int(step_s), F.col("lo"))).otherwise(F.col("lo"))
    last = F.least(F.col("hi"), F.timestamp_add("MICROSECOND", F.lit(-1), F.timestamp_add("DAY", F.lit(1), F.col("begin"))))
    grid = (days.select(by, first.alias("first"), last.alias("last")).where(F.col("first") <= F.col("last"))
            .select(by, F.explode(F.sequence("first", "last", step)).alias("poll_ts")))
    other = per_poll.select(F.col(by).alias("_by"), F.col("poll_ts").alias("_poll"), "arrived", "done")
    dense = grid.join(other, grid[by].eqNullSafe(F.col("_by")) & (grid["poll_ts"] == F.col("_poll")), "left").select(
        by, "poll_ts", F.coalesce("arrived", F.lit(0)).cast("bigint").alias("arrived"), F.coalesce("done", F.lit(0)).cast("bigint").alias("done"))
    change = F.col("arrived") - F.col("done")
    rows, days = _by_day(dense, by, "poll_ts", _c=F.sum(change))
    w = Window.partitionBy(by).orderBy("day")
    before = F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = _hand(rows, by, days.select(by, "day", before.alias("before")))
    inside = F.sum(change).over(_in_day(by, "poll_ts").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(by, "poll_ts", "arrived", "done", (inside + F.col("before")).cast("bigint").alias("backlog"))


def _in_day(by: str, ts: str):
    """Rows of one (queue, day), in time order."""
    return Window.partitionBy(by, "day").orderBy(ts)


def _by_day(df: DataFrame, by: str, ts: str, inside: dict[str, Column] | None = None, **per_day: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, days): the series with its day and ``inside`` columns (windows within
    the day), and one row a day with ``per_day`` aggregates.

    The series is written to the shared folder once, since both sides read it: no
    window spans more than a day of rows, however long or busy a queue is, and a
    chain of these operators does not compute its input again and again."""
    rows = df.withColumn("day", F.to_date(F.col(ts)))
    rows = materialised(rows.withColumns(inside or {}), "series")
    return rows, rows.groupBy(by, "day").agg(*[c.alias(k) for k, c in per_day.items()])


def _hand(rows: DataFrame, by: str, days: DataFrame) -> DataFrame:
    """``rows`` with what a queue's other days hand to their day (one row a day)."""
    other = days.withColumnsRenamed({by: "_by", "day": "_day"})
    return rows.join(other, rows[by].eqNullSafe(F.col("_by")) & (rows["day"] == F.col("_day"))).drop("_by", "_day")


def _earlier(w, c: str) -> Column:
    """The last value of ``c`` that is not NULL on an earlier day."""
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))


def replica_demand(backlog: DataFrame, per: int = 5, lo: int = 0, hi: int = 5, cooldown_s: int = 60,
                   by: str = "queue", ts: str = "poll_ts", value: str = "backlog") -> DataFrame:
    """B2: workers wanted at each poll: ``clamp(ceil(backlog/per), lo, hi)``;
    it may fall to zero only when no poll in the last ``cooldown_s`` seconds
    (the current one included) saw a backlog, otherwise it stays at least 1.

    The cooldown asks for the last poll with a backlog, which is carried from day
    to day, and not for a window over the queue."""
    busy = F.when(F.col(value) > 0, F.col(ts))
    rows, days = _by_day(backlog.select(by, ts, value), by, ts, _c=F.max(busy))
    w = Window.partitionBy(by).orderBy("day")
    rows = _hand(rows, by, days.select(by, "day", _earlier(w, "_c").alias("earlier")))
    last_busy = F.coalesce(F.max(busy).over(_in_day(by, ts).rowsBetween(Window.unboundedPreceding, 0)), F.col("earlier"))
    secs = lambda c: F.floor(epoch_micros(c, backlog.schema[ts].dataType) / 1_000_000)
    rows = rows.withColumn("last_busy", last_busy)
    recent = F.coalesce(secs(ts) - secs("last_busy") < int(cooldown_s), F.lit(False))
    raw = F.least(F.greatest(F.ceil(F.col(value) / F.lit(per)).cast("int"), F.lit(lo)), F.lit(hi))
    floor_ = F.when(recent, F.greatest(F.lit(lo), F.lit(min(1, hi)))).otherwise(F.lit(lo))
    return rows.select(by, ts, value, F.greatest(raw, floor_).cast("int").alias("replicas"))


def scaling_stability(demand: DataFrame, window: str = "1 day", by: str = "queue", ts: str = "poll_ts",
                      value: str = "replicas") -> DataFrame:
    """Per queue and tumbling window: polls, scale changes and direction
    reversals (a change whose sign differs from the previous change's)."""
    sign = lambda c: F.when(c != 0, F.signum(c))
    step = F.col(value) - F.lag(value).over(_in_day(by, ts))   # NULL at the first poll of a day
    rows, days = _by_day(demand.select(by, ts, value), by, ts, {"step": step}, first=F.min_by(value, ts), last=F.max_by(value, ts),
                         sign=F.max_by(sign(F.col("step")), F.when(F.col("step") != 0, F.col(ts))))
    w = Window.partitionBy(by).orderBy("day")
    days = days.withColumn("earlier", F.lag("last").over(w))
    days = days.withColumn("sign", F.coalesce("sign", sign(F.col("first") - F.col("earlier"))))
    rows = _hand(rows, by, days.select(by, "day", "earlier", _earlier(w, "sign").alias("earlier_sign")))
    rows = rows.withColumn("delta", F.coalesce("step", F.col(value) - F.col("earlier"))).withColumn("sign", sign(F.col("delta")))
    prev = F.coalesce(F.last("sign", ignorenulls=True).over(_in_day(by, ts).rowsBetween(Window.unboundedPreceding, -1)), F.col("earlier_sign"))
    return (rows.withColumn("prev_sign", prev).groupBy(by, F.window(ts, window)["start"].alias("window_start"))
            .agg(F.count(F.lit(1)).alias("polls"),
                 F.count(F.when(F.col("delta") != 0, 1)).alias("scale_changes"),
                 F.count(F.when(F.col("sign") != F.col("prev_sign"), 1)).alias("reversals")))


def backlog_recovery(backlog: DataFrame, threshold: int, by: str = "queue", ts: str = "poll_ts",
                     value: str = "backlog") -> DataFrame:
    """Episodes of consecutive polls above ``threshold``: start, last poll
    above, peak, the poll at which the backlog was back to normal (NULL if it
    never was) and the seconds that took from the start."""
    series = backlog.select(by, ts, value, F.coalesce(F.col(value) > threshold, F.lit(False)).alias("above"))
    w = _in_day(by, ts)
    rows, days = _by_day(series, by, ts, {"next_in": F.lead(ts).over(w), "above_before": F.lag("above").over(w)},
                         first_ts=F.min(ts), first=F.min_by("above", ts), last=F.max_by("above", ts),
                         begins=F.count_if(F.col("above") & ~F.col("above_before")))
    d = Window.partitionBy(by).orderBy("day")
    days = days.withColumn("earlier", F.coalesce(F.lag("last").over(d), F.lit(False))).withColumn("later", F.lead("first_ts").over(d))
    days = days.withColumn("begins", F.col("begins") + (F.col("first") & ~F.col("earlier")).cast("int"))
    before = F.coalesce(F.sum("begins").over(d.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = _hand(rows, by, days.select(by, "day", "earlier", "later", before.alias("before")))
    begins = (F.col("above") & ~F.coalesce("above_before", "earlier")).cast("int")
    grp = F.col("before") + F.sum(begins).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ep = (rows.withColumn("grp", grp).withColumn("next_ts", F.coalesce("next_in", "later")).where("above").groupBy(by, "grp")
          .agg(F.min(ts).alias("start_ts"), F.max(ts).alias("last_above_ts"), F.max(value).alias("peak"),
               F.count(F.lit(1)).alias("polls_above"),
               # next poll after the last one above; NULL when the series ends above
               F.when(F.count("next_ts") == F.count(F.lit(1)), F.max("next_ts")).alias("recovered_ts")))
    micros = micros_between("recovered_ts", "start_ts", backlog.schema[ts].dataType)
    return ep.select(by, "start_ts", "last_above_ts", F.col("peak").cast("bigint").alias("peak"), "polls_above",
                     "recovered_ts", F.floor(micros / 1_000_000).cast("bigint").alias("recovery_s"))


def utilisation(samples: DataFrame, capacity=2000, width_s: int = 15, node: str = "node", ts: str = "ts",
                usage: str = "cpu_m") -> DataFrame:
    """Mean usage over capacity per node and window, plus a total row per
    window (``node`` NULL, ``is_total`` true) from ``rollup``.

    ``capacity`` is milli-CPU for every node, or a DataFrame ``(node, capacity_m)``
    joined by broadcast behind a row-count check."""
    win = F.window(ts, f"{int(width_s)} seconds")["start"].alias("window_start")
    # Fixed point (millionths) so totals do not depend on summation order.
    per_node = (samples.groupBy(win, node).agg(F.sum(usage).alias("s"), F.count(F.lit(1)).alias("n"))
                .select("window_start", node,
                        _div_round("s * 1000000", "n").alias("mean_u")))
    if isinstance(capacity, DataFrame):
        cap, _ = bounded_broadcast(capacity.select(node, F.col("capacity_m").cast("bigint").alias("capacity_m")))
        per_node = per_node.join(cap, node, "left")
    else:
        per_node = per_node.withColumn("capacity_m", F.lit(int(capacity)).cast("bigint"))
    r = (per_node.rollup("window_start", node)
         .agg(F.sum("mean_u").alias("mean_u"), F.sum("capacity_m").alias("capacity_m"),
              F.grouping(node).alias("g_node"), F.grouping("window_start").alias("g_win"))
         .where(F.col("g_win") == 0))
    return r.select("window_start", node, (F.col("g_node") == 1).alias("is_total"),
                    (F.col("mean_u") / 1_000_000).alias("mean_m"), F.col("capacity_m"),
                    (_div_round("mean_u", "capacity_m") / 1_000_000).alias("utilisation"))


def _div_round(num: str, den: str) -> Column:
    """Integer division rounded half up (non-negative SQL operands), exact in BIGINT."""
    return F.expr(f"(({num}) * 2 + ({den})) div (({den}) * 2)")


def capacity_gap(pods: DataFrame, groups: DataFrame | None = None, group: str = "namespace",
                 min_nodes: int = 1, max_nodes: int = 2, node_cpu_m: int = 2000,
                 containers: DataFrame | None = None) -> DataFrame:
    """Requested CPU per node group, nodes needed within [min, max] and the
    CPU left unmet at the maximum.  Aggregate demand only; placement is not
    modelled.  ``pods`` are nested pods, or (pod, group) rows beside
    ``containers`` (pod, init, requests; one row a container), which are then summed per
    pod map-side before they meet the pods; init containers run before the
    others and add nothing.  ``groups`` may give ``(group, min_nodes, max_nodes, node_cpu_m)``
    per group (broadcast behind a row-count check)."""
    if containers is None:
        per = pods.select(group, F.explode_outer("containers").alias("c")).select(group, cpu_millis(F.col("c.requests.cpu")).alias("m"))
    else:
        main = containers.where(~F.coalesce(F.col("init"), F.lit(False)))
        sums = main.groupBy("pod").agg(F.sum(cpu_millis(F.col("requests.cpu"))).alias("m"))
        per = pods.select("pod", group).join(sums, "pod", "left")
    req = per.groupBy(group).agg(F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("requested_m"))
    if groups is not None:
        g, _ = bounded_broadcast(groups)
        req = req.join(g, group, "left")
    else:
        req = req.select("*", F.lit(min_nodes).alias("min_nodes"), F.lit(max_nodes).alias("max_nodes"),
                         F.lit(node_cpu_m).alias("node_cpu_m"))
    needed = F.least(F.greatest(F.ceil(F.col("requested_m") / F.col("node_cpu_m")), F.col("min_nodes")),
                     F.col("max_nodes")).cast("int")
    return req.select(group, "requested_m", needed.alias("nodes"),
                      F.greatest(F.col("requested_m") - needed * F.col("node_cpu_m"), F.lit(0))
                      .cast("bigint").alias("unmet_m"))
