"""Streams: late rows beyond and within the watermark, restart from the
checkpoint, replayed batches, and batch twins."""

import datetime as dt
import os

from pyspark.sql import functions as F

from harborlens.operators import sli
from harborlens.plans import bindings as b
from harborlens.sources.tables import Tables
from harborlens.streaming import dedup, queue, sli_stream
from tests.conftest import SF_SMALL

SCHEMA = "event_id bigint, attempt int, delivered_ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1, 12)
M = dt.timedelta(minutes=1)


def drop_file(spark, rows, path, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, name))


def test_dedup_stream_late_rows_and_restart(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    drop_file(spark, [(1, 1, T0), (2, 1, T0 + 30 * M), (1, 2, T0 + 5 * M)], src, "b1")

    def run():
        s = queue.queue_ingest(spark, src + "/*", spark.createDataFrame([], SCHEMA).schema, max_files=1)
        queue.run_available(dedup.dedup_stream(s, "event_id", "delivered_ts", "10 minutes"), out, ck)

    run()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2]
    # watermark is now 30 - 10 = 20 minutes past T0
    drop_file(spark, [(3, 1, T0 + 5 * M),      # late: before the watermark, dropped
                      (2, 2, T0 + 35 * M),     # duplicate within the watermark, dropped
                      (4, 1, T0 + 40 * M)], src, "b2")
    run()  # restart from the checkpoint: b1 is not read again
    got = sorted((r.event_id, r.attempt) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1), (2, 1), (4, 1)]


def test_idempotent_write_replay_and_history(spark, scratch):
    sink = os.path.join(scratch, "sink")
    write = dedup.idempotent_writer(sink, key="event_id", buckets=4)
    b0 = spark.createDataFrame([(1, 1, T0), (2, 1, T0), (2, 2, T0)], SCHEMA)
    write(b0, 0)
    write(b0, 0)  # replay of the same batch after a failure
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == [1, 2]
    b1 = spark.createDataFrame([(2, 3, T0), (3, 1, T0)], SCHEMA)
    write(b1, 1)
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.event_id for r in rows) == [1, 2, 3]
    assert {r.batch_id for r in rows if r.event_id == 2} == {0}


def test_queue_ingest_consumes_each_file_once(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    drop_file(spark, [(1, 1, T0)], src, "m1")
    drop_file(spark, [(2, 1, T0)], src, "m2")
    schema = spark.createDataFrame([], SCHEMA).schema
    for _ in range(2):  # the second run finds nothing new
        queue.run_available(queue.queue_ingest(spark, src + "/*", schema, max_files=1), out, ck)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_sli_stream_equals_batch_twin_on_closed_windows(spark, scratch):
    r = b.requests(Tables(spark, SF_SMALL))
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    queue.stage_files(r, src, 2, order="ts")
    s = queue.queue_ingest(spark, src, r.schema, max_files=2)
    queue.run_available(sli_stream.sli_stream(s, width="1 day", delay="1 hour"), out, ck)
    stream_rows = sorted(
        (x.service, x.window_start.replace(tzinfo=None), x.requests, x.errors, x.p95_ms)
        for x in spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
        .collect())
    max_ts = r.agg(F.max("ts")).first()[0]
    watermark = max_ts - dt.timedelta(hours=1)
    p95 = sli.latency_p95(r, width="1 day", exact=False)
    err = sli.error_ratio(r, width="1 day")
    batch = p95.join(err.select("service", "window_start", "errors"), ["service", "window_start"]) \
        .where(F.col("window_end") <= F.lit(watermark))
    batch_rows = sorted((x.service, x.window_start, x.requests, x.errors, x.p95_ms) for x in batch.collect())
    assert stream_rows == batch_rows and len(batch_rows) > 0


def test_queue_ingest_clean_source_archives_consumed_files(spark, scratch):
    src, out, ck, arch = (os.path.join(scratch, x) for x in ("in", "out", "ck", "archive"))
    os.makedirs(src)
    drop_file(spark, [(1, 1, T0)], src, "m1")
    schema = spark.createDataFrame([], SCHEMA).schema
    s = queue.queue_ingest(spark, src + "/*", schema, max_files=1, clean_source="archive", archive_dir=arch)
    queue.run_available(s, out, ck)
    drop_file(spark, [(2, 1, T0)], src, "m2")
    queue.run_available(queue.queue_ingest(spark, src + "/*", schema, max_files=1, clean_source="archive",
                                           archive_dir=arch), out, ck)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [1, 2]
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".parquet")]
    assert len(archived) >= 1  # acknowledged messages left the queue directory


def test_log_route_stream_matches_batch(spark, scratch):
    from harborlens.sources import logs
    rec = b.log_records(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "in")
    queue.stage_files(rec, src, 3)
    s = queue.queue_ingest(spark, src, rec.schema, max_files=1)
    q = logs.route_stream(s, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), "c1")
    q.awaitTermination(300)
    got = logs.read_group(spark, os.path.join(scratch, "out"))
    batch = logs.log_route(rec, "c1")
    cols = ["seq", "namespace_name", "log_group", "log_stream", "log"]
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(tuple(r) for r in batch.select(cols).collect())
    one = logs.read_group(spark, os.path.join(scratch, "out"), namespace="src0")
    assert {r.log_group for r in one.select("log_group").distinct().collect()} <= {"/aws/eks/c1/src0"}


def test_sli_stream_drops_rows_later_than_the_watermark(spark, scratch):
    schema = "service string, ts timestamp_ntz, latency_ms double, status int"
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    h = dt.timedelta(hours=1)

    def drop(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, name))

    def run():
        s = queue.queue_ingest(spark, src + "/*", spark.createDataFrame([], schema).schema, max_files=1)
        queue.run_available(sli_stream.sli_stream(s, width="1 hour", delay="10 minutes"), out, ck)

    drop([("a", T0 + 5 * M, 10.0, 200), ("a", T0 + h + 5 * M, 10.0, 200), ("a", T0 + 2 * h + 30 * M, 10.0, 200)],
         "b1")
    run()  # watermark: 12:30 + 2 h - 10 min; windows 12:00 and 13:00 are closed
    drop([("a", T0 + 20 * M, 10.0, 500),               # window 12:00 already emitted: dropped as late
          ("a", T0 + 2 * h + 25 * M, 10.0, 500),       # inside the open 14:00 window: counted
          ("a", T0 + 3 * h + 30 * M, 10.0, 200)], "b2")  # moves the watermark past 14:00
    run()
    got = {r.window_start.replace(tzinfo=None): (r.requests, r.errors)
           for r in spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
           .collect()}
    assert got[T0] == (1, 0)
    assert got[T0 + h] == (1, 0)
    assert got[T0 + 2 * h] == (2, 1)
    assert T0 + 3 * h not in got  # still open
