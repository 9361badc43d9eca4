"""E4 by event time: redeliveries that overtake their first delivery, late rows, restarts."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from harborlens.streaming import first_delivery, queue

SCHEMA = "event_id long, attempt int, delivered_ts timestamp_ntz, note string"
T0 = dt.datetime(2024, 1, 1, 12)
M = dt.timedelta(minutes=1)


class Drill:
    """Batches handed to the stream one after the other; a new query on the same checkpoint after ``restart``."""

    def __init__(self, spark, base, within="15m", delay="30 minutes"):
        self.spark, self.base, self.args, self.n, self.q = spark, base, (within, delay), 0, None
        os.makedirs(f"{base}/in")

    def start(self):
        s = queue.queue_ingest(self.spark, f"{self.base}/in", self.spark.createDataFrame([], SCHEMA).schema, options={"recursiveFileLookup": "true"})
        out = first_delivery.first_deliveries(s, "event_id", "delivered_ts", ("attempt",), *self.args)
        self.q = out.writeStream.option("checkpointLocation", f"{self.base}/ck").format("parquet").option("path", f"{self.base}/out").start()

    def batch(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.base}/in/{self.n}")
        self.n += 1
        if self.q is None:
            self.start()
        self.q.processAllAvailable()
        return self

    def restart(self):
        self.q.stop()
        self.q = None
        return self

    def rows(self):
        return sorted(((r.event_id, r.attempt, r.note) for r in self.spark.read.parquet(f"{self.base}/out").collect()), key=repr)


def test_the_first_by_time_wins_whatever_comes_first(spark, scratch):
    d = Drill(spark, scratch)
    d.batch([(1, 3, T0 + 10 * M, "third"), (2, 1, T0, "only"), (None, 1, T0, "no key"), (None, 1, T0, "no key")])
    d.batch([(1, 2, T0 + 5 * M, "second"), (3, 2, T0 + 6 * M, "tie b"), (3, 1, T0 + 6 * M, "tie a")])
    assert d.rows() == [(None, 1, "no key"), (None, 1, "no key")]          # nothing is given out before its time
    d.restart()                                                            # held rows and timers are in the checkpoint
    d.batch([(1, 1, T0, "first"), (4, 1, T0 + 40 * M, "later")])           # watermark: 10 minutes past T0
    d.batch([(9, 1, T0 + 60 * M, "beat")])                                 # watermark: 30 minutes past T0
    want = [(1, 1, "first"), (2, 1, "only"), (3, 1, "tie a")]
    assert [r for r in d.rows() if r[0]] == want
    d.batch([(2, 2, T0 + 5 * M, "late"), (5, 1, T0 + 3 * M, "late")])      # behind the watermark: dropped
    d.batch([(9, 1, T0 + 500 * M, "beat")])
    d.q.stop()
    assert [r for r in d.rows() if r[0]] == [*want, (4, 1, "later"), (9, 1, "beat")]


def test_random_arrival_equals_the_batch_answer(spark, scratch):
    g = random.Random(6)
    firsts = {k: T0 + g.randint(0, 200) * M for k in range(80)}
    rows = [(k, a, ts + (a - 1) * 5 * M, f"{k}-{a}") for k, ts in firsts.items() for a in range(1, g.randint(1, 3) + 1)]
    # each row arrives up to 20 minutes after its time; batches of ten minutes of arrival
    arrival = sorted((r[2] + g.randint(0, 20) * M, r) for r in rows)
    d = Drill(spark, scratch)
    for lo in range(0, 240, 40):
        some = [r for at, r in arrival if lo * M <= at - T0 < (lo + 40) * M]
        if some:
            d.batch(some)
    d.batch([(10 ** 6, 1, T0 + 2000 * M, "beat")])
    d.q.stop()
    assert d.rows() == sorted(((k, 1, f"{k}-1") for k in firsts), key=repr)


def test_slices_are_staged_once_and_released_in_order(spark, scratch):
    df = spark.range(100).select(F.col("id"), (F.lit(T0) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"))
    slices = queue.stage_slices(df, f"{scratch}/staged", "ts", 30 * M)
    assert [spark.read.parquet(s).agg(F.min("id"), F.max("id")).first()[:] for s in slices] == [(0, 29), (30, 59), (60, 89), (90, 99)]
    seen = []

    def start(s):
        return (s.writeStream.option("checkpointLocation", f"{scratch}/ck")
                .foreachBatch(lambda b, i: seen.append(b.agg(F.min("id"), F.max("id"), F.count("*")).first()[:])).start())

    assert queue.run_slices(df, f"{scratch}/run", "ts", 30 * M, start) == 4
    assert [x for x in seen if x[2]] == [(0, 29, 30), (30, 59, 30), (60, 89, 30), (90, 99, 10)]
    assert queue.run_slices(df.limit(0), f"{scratch}/none", "ts", 30 * M, start) == 0


def test_state_is_kept_by_bucket(spark, scratch):
    """400 keys cost a few state rows; keys of any type stay apart; rows without a key are all given out."""
    rows = [(k, a, T0 + (k % 7 + a) * M, f"{k}-{a}") for k in range(400) for a in (2, 1)] + [(None, a, T0, "no key") for a in range(20)]
    d = Drill(spark, scratch)
    s = queue.queue_ingest(spark, f"{scratch}/in", spark.createDataFrame([], SCHEMA).schema, options={"recursiveFileLookup": "true"})
    out = first_delivery.first_deliveries(s.withColumn("event_id", F.col("event_id").cast("string")), "event_id", "delivered_ts", ("attempt",), "15m", "30 minutes", buckets=5)
    d.q = out.writeStream.option("checkpointLocation", f"{scratch}/ck").format("parquet").option("path", f"{scratch}/out").start()
    d.batch(rows)
    assert 0 < max(op["numRowsTotal"] for p in d.q.recentProgress for op in p["stateOperators"]) <= 5
    d.batch([(10 ** 6, 1, T0 + 2000 * M, "beat")])
    d.q.stop()
    assert d.rows() == sorted([(str(k), 1, f"{k}-1") for k in range(400)] + [(None, a, "no key") for a in range(20)], key=repr)
