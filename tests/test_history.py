"""E5 over a long history: one manifest, bounded reads, merged blocks, replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from harborlens.streaming.history import History, may_hold, _positions

SCHEMA = "event_id long, attempt int, delivered_ts timestamp_ntz, payload string"
T0 = dt.datetime(2024, 1, 1)


def batches(seed, n, size=60, keys=400, moving=True):
    """At-least-once deliveries: batch b's keys move on with time, some come again later."""
    g = random.Random(seed)
    out = []
    for b in range(n):
        lo = b * size // 2 if moving else 0
        out.append([(None if g.random() < .02 else lo + g.randint(0, size) if g.random() < .9 else g.randint(0, max(1, lo)), g.randint(1, 3),
                     T0 + dt.timedelta(minutes=b * 10 + g.randint(0, 9)), f"{b}-{i}") for i in range(size)])
    return out


def brute(rows):
    """First batch that holds the key, and in it the first by time and attempt; every row without a key."""
    seen, out = set(), []
    for batch in rows:
        firsts = {}
        for r in sorted(batch, key=lambda r: (r[2], r[1], r[3])):
            if r[0] is None:
                out.append(r)
            elif r[0] not in seen:
                firsts.setdefault(r[0], r)
        out += firsts.values()
        seen |= set(firsts)
    return sorted(out, key=repr)


def stored(history):
    return sorted((tuple(r[c] for c in ("event_id", "attempt", "delivered_ts", "payload")) for r in history.read().collect()), key=repr)


def add(spark, history, rows, batch_id):
    return history.add(spark.createDataFrame(rows, SCHEMA).coalesce(2), batch_id, order=("delivered_ts", "attempt", "payload"))


def test_many_batches_leave_what_one_pass_would(spark, scratch):
    rows = batches(1, 14)
    history = History(spark, f"{scratch}/sink", buckets=4, every=3)
    for b, some in enumerate(rows):
        add(spark, history, some, b)
        if b in (5, 6, 9):
            add(spark, history, some, b)                 # run again after a failure, also right after a merge
    assert stored(history) == brute(rows)
    levels = {r.level for r in history.blocks().select("level").distinct().collect()}
    assert max(levels) >= 2                              # merged, and merged again
    per = history.blocks().groupBy("bucket", "level").count().agg(F.max("count")).first()[0]
    assert per <= 2 * history.every
    # a batch that is run again later on sees the history as it was then
    add(spark, history, rows[13], 13)
    assert stored(history) == brute(rows)
    old = History(spark, f"{scratch}/sink", buckets=4, every=3).read(before=7)
    assert sorted(r.payload for r in old.collect()) == sorted(r[3] for r in brute(rows[:7]))


def test_reads_follow_the_batch_not_the_history(spark, scratch):
    """Keys that grow with time: files that cannot hold the batch's keys are not read."""
    history = History(spark, f"{scratch}/sink", buckets=2, every=50)
    read = [add(spark, history, [(1000 * b + i, 1, T0, f"{b}-{i}") for i in range(30)], b) for b in range(8)]
    assert read == [0] * 8
    again = [(1000 * 3 + i, 2, T0, "again") for i in range(3)] + [(10 ** 6, 1, T0, "new")]
    assert 1 <= add(spark, history, again, 8) <= 2
    assert stored(history) == sorted([(1000 * b + i, 1, T0, f"{b}-{i}") for b in range(8) for i in range(30)] + [(10 ** 6, 1, T0, "new")], key=repr)
    # scattered keys: ranges say nothing, the Bloom bits do
    g = random.Random(2)
    every = g.sample(range(10 ** 9), 40 * 6)
    other = History(spark, f"{scratch}/other", buckets=1, every=50)
    for b in range(5):
        add(spark, other, [(k, 1, T0, "") for k in every[40 * b:40 * b + 40]], b)
    files = other.blocks().select("file").distinct().count()
    assert add(spark, other, [(every[7], 2, T0, "again"), (every[210], 1, T0, "new")], 5) < files
    assert other.read().count() == 201


def test_no_bloom_bit_is_missed(spark):
    keys = spark.range(500).select((F.col("id") * 7919).alias("k"))
    bits = F.lit(640)
    words = (keys.select(F.explode(_positions(F.col("k"), bits)).alias("p")).groupBy(F.shiftright("p", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(p % 64))")).alias("x")).agg(F.map_from_entries(F.collect_list(F.struct("w", "x"))).alias("m"))
             .select(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda w: F.coalesce(F.element_at("m", w), F.lit(0).cast("long"))).alias("words")))
    assert keys.crossJoin(words).where(may_hold(F.col("k"), F.col("words"))).count() == 500
    assert keys.select(may_hold(F.col("k"), F.array_repeat(F.lit(0).cast("long"), 10)).alias("x")).where("x").count() == 0


def test_a_failed_batch_leaves_nothing_behind(spark, scratch, monkeypatch):
    rows = batches(3, 4)
    history = History(spark, f"{scratch}/sink", buckets=3, every=2)
    add(spark, history, rows[0], 0)
    add(spark, history, rows[1], 1)
    real = History._describe

    def broken(self, part, *args):
        if part.startswith("batch-2"):
            raise RuntimeError("executor lost")
        return real(self, part, *args)

    monkeypatch.setattr(History, "_describe", broken)
    with pytest.raises(RuntimeError):
        add(spark, history, rows[2], 2)
    assert stored(history) == brute(rows[:2])            # rows are there, but no manifest entry names them
    monkeypatch.undo()
    add(spark, history, rows[2], 2)
    add(spark, history, rows[3], 3)
    assert stored(history) == brute(rows)
    gone = {r.file for r in history.obsolete().collect()}
    live = {r.file for r in history.blocks().select("file").collect()}
    assert gone and not {g.split("/sink/")[1] for g in gone} & {f.split("/sink/")[1] for f in live}


def test_other_columns_and_empty_batches(spark, scratch):
    history = History(spark, f"{scratch}/sink", buckets=3)
    assert history.read() is None and history.blocks() is None and history.obsolete() is None
    add(spark, history, [], 0)
    add(spark, history, [(1, 1, T0, "a"), (1, 2, T0, "b"), (None, 1, T0, "n"), (None, 1, T0, "n")], 1)
    assert sorted(r.payload for r in history.read().collect()) == ["a", "n", "n"]
    with pytest.raises(ValueError):
        history.add(spark.createDataFrame([(2, "x", T0, "p")], SCHEMA.replace("attempt int", "attempt string")), 2)
    with pytest.raises(ValueError):
        History(spark, f"{scratch}/sink", buckets=3).add(spark.createDataFrame([(2, 1, T0)], "event_id long, attempt int, new timestamp_ntz"), 2, order=("new",))
    text = History(spark, f"{scratch}/text", key="payload", buckets=3)
    text.add(spark.createDataFrame([(1, 1, T0, "x"), (2, 1, T0, "y")], SCHEMA), 0)
    text.add(spark.createDataFrame([(3, 1, T0, "x"), (4, 1, T0, "z")], SCHEMA), 1)
    assert sorted((r.payload, r.event_id) for r in text.read().collect()) == [("x", 1), ("y", 2), ("z", 4)]
