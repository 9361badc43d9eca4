"""Stored sketches: merged answers within the stated errors, exact while small, edge rows, a stream."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from harborlens.operators import sketches
from harborlens.streaming import queue

T0 = dt.datetime(2024, 1, 1)
R = "service string, ts timestamp_ntz, latency_ms double, status int"


def test_merged_percentiles_are_within_the_rank_error(spark):
    n = 200_000
    df = spark.range(n).select(F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(2))).alias("service"),
                               (F.lit(T0) + F.make_dt_interval(secs=F.pmod(F.xxhash64("id", F.lit(1)), F.lit(86400)).cast("decimal(10,0)"))).cast("timestamp_ntz").alias("ts"),
                               F.exp(F.randn(5) * 2).alias("latency_ms"), F.when(F.col("id") % 10 == 0, 500).otherwise(200).alias("status")).cache()
    k = 256
    minutes = sketches.latency_sketches(df, "1 minute", k=k).cache()
    day = sketches.rolled_up(sketches.rolled_up(minutes, "1 hour", k=k), "1 day", k=k)
    for q in (0.5, 0.95, 0.99):
        for r in sketches.slis(day, "1 day", q=q).collect():
            own = df.where(F.col("service") == r.service)
            assert r.requests == own.count() and r.errors == own.where("status >= 500").count()
            below = own.where(F.col("latency_ms") <= r.p95_ms + 1e-6).count() / r.requests
            assert abs(below - q) <= sketches.rank_error(k) + 2 / r.requests
    assert minutes.agg(F.max(F.length("latencies"))).first()[0] < 20 * k


def test_small_windows_are_exact_and_odd_rows_counted(spark):
    g = random.Random(1)
    rows = [("a", T0 + dt.timedelta(minutes=g.randint(0, 300)), g.choice([g.random(), None, float("nan")]), g.choice([200, 500, None])) for _ in range(500)]
    rows += [(None, T0, 5.0, 200), ("quiet", T0, None, 503)]
    hours = sketches.rolled_up(sketches.latency_sketches(spark.createDataFrame(rows, R)), "1 hour")
    got = {(r.service, r.window_start): (r.requests, r.errors, r.p95_ms) for r in sketches.slis(hours, "1 hour").collect()}
    want = {}
    for s, t, v, st in rows:
        want.setdefault((s, t.replace(minute=0)), []).append((v, st))
    for key, vs in want.items():
        values = sorted(v for v, _ in vs if v is not None and not math.isnan(v))
        p = round(values[math.ceil(0.95 * len(values)) - 1], 6) if values else None
        assert got[key] == (len(vs), sum(1 for _, st in vs if st and st >= 500), p)
    assert set(got) == set(want)
    empty = sketches.latency_sketches(spark.createDataFrame([], R))
    assert sketches.slis(sketches.rolled_up(empty, "1 hour"), "1 hour").count() == 0


def test_sketches_from_a_stream_answer_wider_windows(spark, scratch):
    rows = [("a", T0 + dt.timedelta(minutes=i), float(i), 200) for i in range(130)]
    df = spark.createDataFrame(rows, R)
    queue.stage_files(df, f"{scratch}/in", 4, order="ts")
    s = queue.as_event_time(queue.queue_ingest(spark, f"{scratch}/in", df.schema), "ts").withWatermark("ts", "2 minutes")
    queue.run_available(sketches.latency_sketches(s), f"{scratch}/out", f"{scratch}/ck")
    hours = sketches.rolled_up(spark.read.parquet(f"{scratch}/out"), "1 hour")
    got = sorted((r.requests, r.p95_ms) for r in sketches.slis(hours, "1 hour").collect())
    assert got[-2:] == [(60, 56.0), (60, 116.0)]


def test_overlaps(spark):
    rows = [(e, f"d{d}", d % 3) for d in range(4) for e in range(d * 10, d * 10 + 15)] + [(None, "d0", 0), (1, "d0", 0)]
    df = spark.createDataFrame(rows, "event_id long, day string, replica int")
    before = F.concat(F.lit("d"), (F.substring("day", 2, 9).cast("int") - 1).cast("string"))
    got = {r.day: (r.previous, r.distinct_events, r.shared) for r in sketches.overlap_with_previous(sketches.event_sketches(df, "day"), "day", before).collect()}
    assert got == {"d0": (None, 15, 0), "d1": ("d0", 15, 5), "d2": ("d1", 15, 5), "d3": ("d2", 15, 5)}
    pairs = {(r.replica, r.next): r.shared for r in sketches.overlap_with_next(sketches.event_sketches(df, "replica"), 3).collect()}
    ids = {k: {e for e, _, r in rows if r == k and e is not None} for k in range(3)}
    assert pairs == {(k, (k + 1) % 3): len(ids[k] & ids[(k + 1) % 3]) for k in range(3)}
    per = sketches.duplicate_totals(sketches.event_sketches(df.withColumn("all", F.lit("x")), ["all", "day"]), "all").first()
    assert (per.deliveries, per.distinct_events, per.duplicates) == (62, 45, 17)
    big = spark.range(60_000).select((F.col("id") % 40_000).alias("event_id"), F.floor(F.col("id") / 30_000).cast("string").alias("day"))
    lg = 10
    rows = sketches.overlap_with_previous(sketches.event_sketches(big, "day", lg=lg), "day", F.when(F.col("day") == "1", "0")).orderBy("day").collect()
    assert all(abs(r.distinct_events - 30_000) < 5 * sketches.relative_error(lg) * 30_000 for r in rows)
    assert abs(rows[1].shared - 20_000) < 5 * sketches.relative_error(lg) * 30_000
