"""B1 and B2 live: closed polls are the batch series', whatever the order of arrival, replays included."""

import datetime as dt
import os
import random

from harborlens.operators import capacity as cap
from harborlens.streaming import backlog_live as live
from harborlens.streaming import queue

T0 = dt.datetime(2024, 1, 1, 12)
M = dt.timedelta(minutes=1)
A = "event_id long, queue string, arrived_ts timestamp_ntz"
C = "event_id long, done_ts timestamp_ntz"


class Platform:
    def __init__(self, spark, base):
        self.spark, self.base, self.n, self.q = spark, base, 0, None
        for side in ("a", "c"):
            os.makedirs(f"{base}/{side}")

    def put(self, arrivals, completions):
        for side, rows, schema in (("a", arrivals, A), ("c", completions, C)):
            if rows:
                self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{self.base}/{side}/{self.n}")
        self.n += 1
        if self.q is None:
            a, c = (queue.queue_ingest(self.spark, f"{self.base}/{s}", self.spark.createDataFrame([], t).schema, options={"recursiveFileLookup": "true"})
                    for s, t in (("a", A), ("c", C)))
            self.q = live.follow_backlog(a, c, f"{self.base}/changes", f"{self.base}/ck", step_s=60, max_service="30m", delay="5 minutes")
        self.q.processAllAvailable()

    def stop(self):
        self.q.stop()
        self.q = None

    def series(self, closed=None):
        rows = live.closed_backlog(self.spark, f"{self.base}/changes", 60, closed, "30m").collect()
        return {(r.queue, r.poll_ts.replace(tzinfo=None)): (r.arrived, r.done, r.backlog) for r in rows}


def test_closed_polls_equal_the_batch_series(spark, scratch):
    g = random.Random(3)
    jobs = [(k, g.choice(["x", "y"]), T0 + g.randint(0, 90) * M) for k in range(150)]
    done = [(k, at + g.randint(0, 29) * M) for k, _, at in jobs if k % 6]          # every sixth is never completed
    batch = cap.backlog_series(spark.createDataFrame(jobs, A), 60, completions=spark.createDataFrame(
        [(k, q, d) for (k, d) in done for (j, q, _) in jobs if j == k], "event_id long, queue string, done_ts timestamp_ntz"))
    want = {(r.queue, r.poll_ts): (r.arrived, r.done, r.backlog) for r in batch.collect()}
    p = Platform(spark, scratch)
    late = lambda rows, at, lo: [r for r in rows if lo <= (r[at] - T0) // M + r[0] % 4 < lo + 30]  # noqa: E731  arrives up to 4 minutes late
    for lo in range(0, 150, 30):
        p.put(late(jobs, 2, lo), late(done, 1, lo))
        if lo == 60:
            mark = live.watermark_of(p.q)
            closed = p.series(mark)
            last = mark - 30 * M
            assert closed and max(t for _, t in closed) <= last
            assert {k: v for k, v in want.items() if k[1] <= last and k in closed} == closed
            p.stop()                                                               # and on from the checkpoint
    beat = T0 + 400 * M
    p.put([(-1, live.HEARTBEAT, beat)], [(-1, beat)])
    p.stop()
    assert p.series() == want
    # a batch whose changes are written again replaces its own
    a = spark.createDataFrame([(1, "x", T0, None)], "event_id long, queue string, arrived_ts timestamp_ntz, done_ts timestamp_ntz")
    write = live.changes_writer(f"{scratch}/again", 60)
    write(a, 0)
    write(a, 0)
    assert [r.backlog for r in live.closed_backlog(spark, f"{scratch}/again", 60).collect()] == [1]


def test_outer_join_of_messages(spark, scratch):
    """A completion before its arrival, too long after it, without one, or twice."""
    p = Platform(spark, scratch)
    p.put([(1, "x", T0), (2, "x", T0), (3, "x", T0)], [(1, T0 - M), (2, T0 + 31 * M), (9, T0), (3, T0 + M), (3, T0 + 2 * M)])
    p.put([(-1, live.HEARTBEAT, T0 + 300 * M)], [(-1, T0 + 300 * M)])
    p.stop()
    got = p.series()
    total = [sum(v[i] for v in got.values()) for i in (0, 1)]
    assert total == [4, 2]          # message 3 is completed twice, 1 and 2 never in time
