"""E7 and R5 on time: rows that fall due without a new row arriving.

Of each event or job is kept the moment at which its next thing is due: a retry at its
backoff, a job's verdict at its timeout.  State is a value and a timer per bucket of
events or jobs (``first_delivery.Bucketed``), not per key.  The timer
fires when the watermark passes that moment, that is when every row up to it is there,
so what is given out is what the batch operator would say at that moment, whatever the
order of arrival within ``delay``.  State and timers are in the checkpoint: after a
restart what was due in between is given out, once.  A decided key is remembered for
``keep``, so that rows that come after its decision do not open it again.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.operators.recovery import TERMINAL_FAILED, TERMINAL_OK, ttl_seconds
from harborlens.streaming.first_delivery import BUCKETS, Bucketed, bucket_of, use_rocksdb
from harborlens.streaming.queue import as_event_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need not have this package


def _ms(micros: int) -> int:
    """Timers are in milliseconds, a moment in microseconds: the first timer not before it."""
    return -(-micros // 1000)


def _values(frames, *names):
    for f in frames:
        yield from zip(*(f[c].tolist() for c in names))


class _Due(Bucketed):
    gives: tuple[str, ...]

    def given(self, rows):
        return iter([pd.DataFrame(rows, columns=list(self.gives))] if rows else [])


class _Outcome(_Due):
    """Of each job: start, first terminal time and phase, the moment its verdict is due or, once decided, forgotten."""

    gives = ("name", "start", "decided", "outcome")

    def __init__(self, timeout: int, keep: int, ok, failed):
        self.timeout, self.keep, self.ok, self.failed = timeout, keep, ok, failed

    def wakes(self, held):
        return _ms(held[3])

    def handleInputRows(self, key, rows, timerValues):
        kept, timer = self.load()
        for job, micros, said in _values(rows, "name", "micros", "phase"):
            start, finish, phase, _, decided = kept.get(job, (micros, None, None, None, False))
            if decided:
                continue
            start = min(start, micros)
            if said in self.ok + self.failed and (finish is None or (micros, said) < (finish, phase)):
                finish, phase = micros, said
            kept[job] = (start, finish, phase, start + self.timeout if finish is None else min(finish, start + self.timeout), False)
        self.save(kept, timer)
        return self.given([])

    def due_by(self, now, kept):
        out = []
        for job, (start, finish, phase, due, decided) in list(kept.items()):
            if _ms(due) > now:
                continue
            if decided:
                del kept[job]
                continue
            in_time = finish is not None and finish <= start + self.timeout
            outcome = "timed_out" if not in_time else "completed" if phase in self.ok else "failed"
            kept[job] = (start, finish, phase, due + self.keep, True)
            out.append((job, start, due, outcome))
        return out


class _Retry(_Due):
    """Of each event the attempts seen so far, as {attempt: (time, failed, open)}: a failed one is open until it is due, and
    only rows up to then decide whether it is still to be tried again."""

    gives = ("name", "attempt", "due", "status")

    def __init__(self, base: int, most: int, keep: int):
        self.base, self.most, self.keep = base, most, keep

    def due(self, attempt: int, at: int) -> int:
        return at + self.base * 2 ** (attempt - 1) if attempt < self.most else at

    def forget(self, seen) -> int:
        return max(at for at, _, _ in seen.values()) + self.keep

    def wakes(self, seen):
        return _ms(min([self.forget(seen), *(self.due(a, at) for a, (at, _, waits) in seen.items() if waits)]))

    def handleInputRows(self, key, rows, timerValues):
        kept, timer = self.load()
        for event, a, at, failed in _values(rows, "name", "attempt", "micros", "failed"):
            seen = kept.setdefault(event, {})
            if a not in seen or seen[a][0] < at:             # an attempt that is reported again: its last report
                seen[a] = (at, failed, failed)
        self.save(kept, timer)
        return self.given([])

    def due_by(self, now, kept):
        out = []
        for event, seen in list(kept.items()):
            for a, (at, failed, waits) in sorted(seen.items()):
                due = self.due(a, at)
                if waits and _ms(due) <= now:
                    seen[a] = (at, failed, False)
                    if not any(b > a and other <= due for b, (other, _, _) in seen.items()):
                        out.append((event, a, due, "retry" if a < self.most else "exhausted"))
            if _ms(self.forget(seen)) <= now:
                del kept[event]
        return out


def _by_bucket(rows: DataFrame, delay: str, buckets: int, *needed: str):
    """Rows with a name and a moment (and what else is ``needed``), grouped by bucket, with event time as microseconds.

    In pandas batches names that start with an underscore get lost."""
    use_rocksdb(rows.sparkSession)
    s = as_event_time(rows, "moment").withWatermark("moment", delay)
    for c in ("name", "moment", *needed):
        s = s.where(F.col(c).isNotNull())
    return s.withColumns({"micros": F.unix_micros("moment"), "bucket": bucket_of("name", buckets)}).groupBy("bucket")


def _type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def outcomes_due(status_rows: DataFrame, timeout_s: int = 600, delay: str = "10 minutes", keep: str = "7d", job: str = "job",
                 ts: str = "ts", phase: str = "phase", buckets: int = BUCKETS) -> DataFrame:
    """R5 on a stream: each job's verdict once, when it is due: job, start_ts, decided_ts, outcome.

    ``completed`` or ``failed`` at its first terminal phase, ``timed_out`` at start +
    ``timeout_s`` if none has come by then.  Jobs without a key and rows without a time are left out."""
    rows = status_rows.select(F.col(job).alias("name"), F.col(ts).alias("moment"), F.col(phase).alias("phase"))
    out = _by_bucket(rows, delay, buckets).transformWithStateInPandas(
        statefulProcessor=_Outcome(timeout_s * 1_000_000, ttl_seconds(keep) * 1_000_000, TERMINAL_OK, TERMINAL_FAILED),
        outputStructType=f"name {_type(rows, 'name')}, start long, decided long, outcome string", outputMode="append", timeMode="EventTime")
    return out.select(F.col("name").alias(job), F.timestamp_micros("start").alias("start_ts"), F.timestamp_micros("decided").alias("decided_ts"), "outcome")


def retries_due(attempts: DataFrame, base_s: int = 30, max_attempts: int = 3, delay: str = "10 minutes", keep: str = "7d", key: str = "event_id",
                attempt: str = "attempt", ts: str = "delivered_ts", outcome: str = "outcome", buckets: int = BUCKETS) -> DataFrame:
    """E7 on a stream: (event_id, attempt, due_ts, status): ``retry`` when the backoff after a failed attempt is over and no later
    attempt was made until then, ``exhausted`` at the failure of the last attempt allowed.  ``keep`` must be longer than any
    backoff.  Rows without a key, time or attempt are left out."""
    rows = attempts.select(F.col(key).alias("name"), F.col(ts).alias("moment"), F.col(attempt).cast("int").alias("attempt"),
                           F.coalesce(F.col(outcome) == "failed", F.lit(False)).alias("failed"))
    out = _by_bucket(rows, delay, buckets, "attempt").transformWithStateInPandas(
        statefulProcessor=_Retry(base_s * 1_000_000, max_attempts, ttl_seconds(keep) * 1_000_000),
        outputStructType=f"name {_type(rows, 'name')}, attempt int, due long, status string", outputMode="append", timeMode="EventTime")
    return out.select(F.col("name").alias(key), "attempt", F.timestamp_micros("due").alias("due_ts"), "status")
