"""E4 with the first delivery by event time, whatever the order of arrival.

Each key holds the least row seen so far by (ts, order columns) and a moment ``within``
after that row's time.  When the watermark passes that moment the row is given out and
the key's state goes.  A later arrival with an earlier time replaces the held row and
moves the moment back, so a redelivery that overtakes its first delivery does not win.
State is bounded by the keys of one ``within`` and one watermark ``delay``, however
long the stream, and lives in the checkpoint: after a restart rows fall due as before.

State is kept per bucket of keys (:class:`Bucketed`): one value and one timer for all
keys of a bucket, read and written once a micro-batch, so a key costs no state call of
its own.

Two bounds that drop-duplicates mixes up are apart here: ``delay``, how late a row may
arrive (the watermark), and ``within``, how long after a key's first delivery others
of that key are its redeliveries.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from harborlens.operators.recovery import ttl_seconds
from harborlens.streaming.queue import as_event_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need not have this package

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


#: Buckets of keys in the state of one stream.  Fixed for the life of a checkpoint.
BUCKETS = 256


class Bucketed(StatefulProcessor):
    """State of a bucket of keys: ``kept``, what is held of each, and one timer for the earliest moment (in
    milliseconds, by ``wakes``) that any of them waits for."""

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("bucket", "kept binary, timer long")

    def wakes(self, held) -> int:
        raise NotImplementedError

    def load(self) -> tuple[dict, int | None]:
        got = self.state.get()
        return (pickle.loads(bytes(got[0])), got[1]) if got else ({}, None)

    def save(self, kept: dict, timer: int | None, fired: bool = False):
        """A timer that fires is deleted after its handler: the next one is another moment."""
        new = min(map(self.wakes, kept.values()), default=None)
        if fired:
            new = None if new is None else max(new, timer + 1)
        elif timer is not None and new != timer:
            self.handle.deleteTimer(timer)
        if new is None:
            self.state.clear()
            return
        if new != timer:
            self.handle.registerTimer(new)
        self.state.update((pickle.dumps(kept, 5), new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        kept, _ = self.load()
        timer = expiredTimerInfo.getExpiryTimeInMs()
        out = self.due_by(max(timer, timerValues.getCurrentWatermarkInMs()), kept)
        self.save(kept, timer, fired=True)
        return self.given(out)

    def due_by(self, now: int, kept: dict) -> list[tuple]:
        """What is due at ``now``, taken out of ``kept``."""
        raise NotImplementedError

    def given(self, rows: list[tuple]):
        """Result rows in the form that the stream's operator hands on."""
        raise NotImplementedError

    def close(self):
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk; a micro-batch checkpoints its changes, not its files."""
    spark.conf.set(STORE, ROCKSDB)
    spark.conf.set(CHANGELOG, "true")


def bucket_of(key: str, buckets: int, otherwise=None):
    """Column: the bucket of a key; rows without one are dealt out by ``otherwise``."""
    name = F.xxhash64(key)
    return F.pmod(name if otherwise is None else F.coalesce(otherwise, name), F.lit(buckets)).cast("int")


class _First(Bucketed):
    def __init__(self, names: Sequence[str], key: str, order: Sequence[str], within: int):
        self.names, self.within = list(names), within
        self.key, self.micros, *self.order = (self.names.index(c) for c in (key, "_micros", *order))

    def rank(self, row):
        return tuple((row[i] is not None, row[i]) for i in (self.micros, *self.order))

    def wakes(self, held):
        return (held[self.micros] + self.within) // 1000

    def handleInputRows(self, key, rows, timerValues):
        kept, timer = self.load()
        alone, at = [], None
        for r in rows:
            at = at or [r.__fields__.index(c) for c in self.names]
            row = tuple(r[i] for i in at)
            name = row[self.key]
            if name is None or row[self.micros] is None:      # no key or no time: given out as they are
                alone.append(row)
            elif name not in kept or self.rank(row) < self.rank(kept[name]):
                kept[name] = row
        self.save(kept, timer)
        return self.given(alone)

    def due_by(self, now, kept):
        return [kept.pop(name) for name, held in list(kept.items()) if self.wakes(held) <= now]

    def given(self, rows):
        made = Row(*self.names)
        return (made(*r) for r in rows)


def first_deliveries(stream: DataFrame, key: str = "event_id", ts: str = "delivered_ts", order: Sequence[str] = ("attempt",),
                     within: str = "15m", delay: str = "15 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Of each key's rows the first by (``ts``, ``order``), given out once the watermark is ``within`` past it.

    Rows of that key up to ``within`` later are its redeliveries and dropped; rows
    behind the watermark are late and dropped.  Rows without a key, or without a time,
    cannot be told apart or ordered: all are given out, at once.  NULLs in ``order``
    come first.  ``buckets`` stays as it is for the life of a checkpoint.  Uses the
    RocksDB state store (session setting ``spark.sql.streaming.stateStore.providerClass``)."""
    use_rocksdb(stream.sparkSession)
    timed = as_event_time(stream, ts).withWatermark(ts, delay)
    # state holds event time as microseconds: no time zone comes in
    held = timed.withColumn("_micros", F.unix_micros(ts))
    row = T.StructType([f for f in held.schema if f.name != ts])
    alone = F.when(F.col(key).isNull() | F.col(ts).isNull(), F.xxhash64(*[c for c in stream.columns if c != ts]))
    firsts = held.withColumn("_bucket", bucket_of(key, buckets, alone)).groupBy("_bucket").transformWithState(
        statefulProcessor=_First(row.names, key, order, ttl_seconds(within) * 1_000_000), outputStructType=row, outputMode="append", timeMode="EventTime")
    return firsts.withColumn(ts, F.timestamp_micros("_micros")).select(*timed.columns)
