"""E7 and R5 on time: verdicts without a new row, any order of arrival, restarts, remembered decisions."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from harborlens.operators.recovery import job_outcome
from harborlens.streaming import due, queue

T0 = dt.datetime(2024, 1, 1, 12)
M = dt.timedelta(minutes=1)
S = dt.timedelta(seconds=1)
JOBS = "job long, ts timestamp_ntz, phase string"
TRIES = "event_id long, attempt int, delivered_ts timestamp_ntz, outcome string"


class Drill:
    def __init__(self, spark, base, schema, operator):
        self.spark, self.base, self.schema, self.operator, self.n, self.q = spark, base, schema, operator, 0, None
        os.makedirs(f"{base}/in")

    def batch(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.base}/in/{self.n}")
        self.n += 1
        if self.q is None:
            s = queue.queue_ingest(self.spark, f"{self.base}/in", self.spark.createDataFrame([], self.schema).schema, options={"recursiveFileLookup": "true"})
            self.q = (self.operator(s).writeStream.option("checkpointLocation", f"{self.base}/ck").format("parquet")
                      .option("path", f"{self.base}/out").start())
        self.q.processAllAvailable()
        return self

    def stop(self):
        self.q.stop()
        self.q = None
        return self

    def rows(self):
        return sorted(tuple(x.replace(tzinfo=None) if isinstance(x, dt.datetime) else x for x in r)
                      for r in self.spark.read.parquet(f"{self.base}/out").collect() if r[0] >= 0)


def test_verdicts_when_they_are_due(spark, scratch):
    d = Drill(spark, scratch, JOBS, lambda s: due.outcomes_due(s, timeout_s=600, delay="5 minutes", keep="1h"))
    d.batch([(1, T0, "InProgress"), (2, T0, "InProgress"), (2, T0 + 3 * M, "Completed"), (3, T0 + 9 * M, "Failed"), (5, T0 + M, "InProgress")])
    assert d.rows() == [(2, T0, T0 + 3 * M, "completed")]                                                         # watermark: 4 minutes
    d.batch([(3, T0 + 8 * M, "InProgress"), (4, T0 + 9 * M, "InProgress"), (-1, T0 + 12 * M, "InProgress")])      # watermark: 7 minutes
    assert d.rows() == [(2, T0, T0 + 3 * M, "completed")]
    d.stop().batch([(1, T0 + 8 * M, "InProgress"), (-1, T0 + 15 * M, "InProgress")])                             # 10 minutes, after a restart
    assert d.rows() == [(1, T0, T0 + 10 * M, "timed_out"), (2, T0, T0 + 3 * M, "completed"), (3, T0 + 8 * M, T0 + 9 * M, "failed")]
    d.batch([(1, T0 + 15 * M, "Completed"), (5, T0 + 11 * M, "PartiallyFailed"), (-1, T0 + 40 * M, "InProgress")])  # too late for 1, in time for 5
    d.batch([(-1, T0 + 400 * M, "InProgress")]).stop()
    assert d.rows() == [(1, T0, T0 + 10 * M, "timed_out"), (2, T0, T0 + 3 * M, "completed"), (3, T0 + 8 * M, T0 + 9 * M, "failed"),
                        (4, T0 + 9 * M, T0 + 19 * M, "timed_out"), (5, T0 + M, T0 + 11 * M, "failed")]


def test_random_jobs_equal_the_batch_twin(spark, scratch):
    g = random.Random(8)
    rows = []
    for j in range(60):
        at = T0 + g.randint(0, 3000) * S
        rows += [(j, at, "InProgress")] + [(j, at + g.randint(0, 1300) * S, g.choice(["Completed", "Failed", "PartiallyFailed", "InProgress"])) for _ in range(g.randint(0, 3))]
    batch = job_outcome(spark.createDataFrame(rows, JOBS), T0 + dt.timedelta(days=9), 600)
    decided = F.when(F.col("outcome") == "timed_out", F.col("start_ts") + F.expr("INTERVAL 600 SECONDS")).otherwise(F.col("end_ts"))
    want = sorted(tuple(r) for r in batch.select("job", "start_ts", decided, "outcome").collect())
    d = Drill(spark, scratch, JOBS, lambda s: due.outcomes_due(s, timeout_s=600, delay="10 minutes"))
    arrival = sorted((ts + g.randint(0, 500) * S, (j, ts, p)) for j, ts, p in rows)
    for lo in range(0, 6000, 900):
        some = [r for at, r in arrival if lo * S <= at - T0 < (lo + 900) * S]
        if some:
            d.batch(some)
    d.batch([(-1, T0 + 2000 * M, "InProgress")]).stop()
    assert d.rows() == want


def test_retries_when_they_are_due(spark, scratch):
    d = Drill(spark, scratch, TRIES, lambda s: due.retries_due(s, base_s=60, max_attempts=3, delay="5 minutes", keep="1h"))
    d.batch([(1, 1, T0, "failed"), (2, 1, T0, "ok"), (3, 1, T0, "failed"), (3, 2, T0 + 59 * S, "failed"),       # 3: tried again before it was due
             (4, 2, T0 + 3 * M, "failed"), (None, 1, T0, "failed")])
    assert d.rows() == []
    d.batch([(4, 1, T0, "failed"), (5, 3, T0 + 2 * M, "failed"), (-1, 1, T0 + 7 * M, "ok")])                      # overtaken; watermark 2 minutes
    first = [(1, 1, T0 + M, "retry"), (4, 1, T0 + M, "retry")]
    assert d.rows()[:2] == first
    d.stop().batch([(1, 2, T0 + 6 * M, "failed"), (-1, 1, T0 + 20 * M, "ok")])
    d.batch([(1, 3, T0 + 18 * M, "failed"), (-1, 1, T0 + 30 * M, "ok")])
    d.batch([(-1, 1, T0 + 300 * M, "ok")]).stop()
    assert d.rows() == sorted([*first, (3, 2, T0 + 59 * S + 2 * M, "retry"), (4, 2, T0 + 5 * M, "retry"), (5, 3, T0 + 2 * M, "exhausted"),
                               (1, 2, T0 + 8 * M, "retry"), (1, 3, T0 + 18 * M, "exhausted")])


def _state_rows(d):
    ops = [op for p in d.q.recentProgress for op in p["stateOperators"]]
    return {op["numShufflePartitions"] for op in ops}, max(op["numRowsTotal"] for op in ops)


def test_state_is_kept_by_bucket(spark, scratch):
    """300 jobs and 300 events cost a few state rows, in no more partitions than asked for, and none is lost."""
    jobs = [(j, T0 + j * S, "InProgress") for j in range(300)] + [(j, T0 + (j + 60) * S, "Completed") for j in range(0, 300, 2)]
    tries = [(e, a, T0 + (e + 70 * a) * S, "failed") for e in range(300) for a in (1, 2, 3)][:-300]
    with queue.state_partitions(spark, 3):
        one = Drill(spark, f"{scratch}/jobs", JOBS, lambda s: due.outcomes_due(s, buckets=5)).batch(jobs)
        two = Drill(spark, f"{scratch}/tries", TRIES, lambda s: due.retries_due(s, max_attempts=2, buckets=5)).batch(tries)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    for d in (one, two):
        partitions, rows = _state_rows(d)
        assert partitions == {3} and 0 < rows <= 5
    one.batch([(-1, T0 + 2000 * M, "InProgress")])
    two.batch([(-1, 1, T0 + 2000 * M, "ok")])
    one.stop()
    two.stop()
    assert one.rows() == sorted((j, T0 + j * S, T0 + (j + 600 if j % 2 else j + 60) * S, "timed_out" if j % 2 else "completed") for j in range(300))
    last = {}
    for e, a, ts, _ in tries:
        last.setdefault(e, {})[a] = ts
    want = [(e, a, ts if a >= 2 else ts + 30 * S, "exhausted" if a >= 2 else "retry") for e, seen in last.items() for a, ts in seen.items()]
    assert two.rows() == sorted(want)
