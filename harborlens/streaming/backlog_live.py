"""B1 and B2 while messages come and go: backlog from a stream of arrivals and one of completions.

The two streams are joined on the message within an interval, a completion belonging
to an arrival at most ``max_service`` before it.  It is an outer join: a message
without a completion is given out too, once the watermark says that none can come any
more, so it stays in the backlog as it does in the batch series.  State is the messages
of one ``max_service`` and one ``delay``.

Each micro-batch adds what it found to a table of changes per poll, under its batch
number, so a batch that is run again replaces its own rows.  A poll is *closed* when
the watermark is ``max_service`` past it: no arrival before it is undecided then, and
its backlog, the sum of all changes up to it, is the batch series' value for good.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.functions.scalars import ts_literal
from harborlens.operators.capacity import poll_deltas, series_of
from harborlens.operators.recovery import ttl_seconds
from harborlens.streaming.queue import as_event_time

HEARTBEAT = "heartbeat"     # queue of messages that only move the watermark


def served_messages(arrivals: DataFrame, completions: DataFrame, max_service: str = "1h", delay: str = "10 minutes", key: str = "event_id",
                    by: str = "queue", arrived: str = "arrived_ts", done: str = "done_ts") -> DataFrame:
    """(key, queue, arrived, done): each arrival with its completion, ``done`` NULL for one that has none within ``max_service``.

    A message that is completed again (a redelivery) has a row for each completion; completions
    without an arrival are not given out.  Rows behind the watermark are late and dropped."""
    a = as_event_time(arrivals.select(key, by, arrived), arrived).withWatermark(arrived, delay)
    c = as_event_time(completions.select(F.col(key).alias("_key"), done), done).withWatermark(done, delay)
    seconds = ttl_seconds(max_service)
    inside = (F.col(done) >= F.col(arrived)) & (F.col(done) <= F.col(arrived) + F.expr(f"INTERVAL {seconds} SECONDS"))
    return a.join(c, (F.col(key) == F.col("_key")) & inside, "left_outer").select(key, by, arrived, done)


def changes_writer(table: str, step_s: int, by: str = "queue"):
    """``foreachBatch`` function: a batch's changes per poll, under its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # here and not in the stream: Spark would filter before it looks at event times
        poll_deltas(batch.where(F.col(by) != HEARTBEAT), step_s, by).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    return write


def follow_backlog(arrivals: DataFrame, completions: DataFrame, table: str, checkpoint: str, step_s: int = 10, max_service: str = "1h",
                   delay: str = "10 minutes", by: str = "queue", trigger: dict | None = None):
    """Start the query that keeps the table of changes.

    Messages of the queue ``HEARTBEAT`` are not counted: a platform that has gone quiet
    sends one, with a key, into both streams, so that the last polls close.  Messages
    without a queue are not counted either."""
    found = served_messages(arrivals, completions, max_service, delay, by=by)
    w = found.writeStream.option("checkpointLocation", checkpoint).foreachBatch(changes_writer(table, step_s, by))
    return (w.trigger(**trigger) if trigger else w).start()


def watermark_of(query) -> dt.datetime | None:
    """The query's watermark after its last batch, without a time zone (UTC)."""
    seen = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in (p["eventTime"] or {})]
    return dt.datetime.fromisoformat(seen[-1].replace("Z", "+00:00")).replace(tzinfo=None) if seen else None


def closed_backlog(spark: SparkSession, table: str, step_s: int = 10, closed: dt.datetime | None = None, max_service: str = "1h",
                   by: str = "queue") -> DataFrame:
    """The backlog series (B1) of the polls that a watermark of ``closed`` has closed; all polls if it is None.

    The batches' changes are added up first (a row for each poll and batch that changed
    it), so reading the series costs what the polls cost, not what the messages did."""
    every = spark.read.parquet(table).groupBy(by, "poll_ts").agg(F.sum("arrived").alias("arrived"), F.sum("done").alias("done"))
    if closed is not None:
        last = closed - dt.timedelta(seconds=ttl_seconds(max_service))
        every = every.where(F.col("poll_ts") <= ts_literal(last).cast(every.schema["poll_ts"].dataType))
    return series_of(every, step_s, by)
