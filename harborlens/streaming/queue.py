"""S2 queue ingest and the plumbing to run a stream to completion.

A file directory stands in for the queue: each file is a message batch.  The
checkpoint records which files were consumed, and that commit is the
acknowledgement; ``clean_source`` ("archive"/"delete") makes it physical, like
deleting a received message.  Delivery is at-least-once: a batch that fails
before its commit is replayed, so sinks downstream must be idempotent (E5).
Kafka is the same operator with ``format("kafka")`` and its options.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def queue_ingest(spark: SparkSession, path: str | None, schema: T.StructType | None, fmt: str = "parquet",
                 max_files: int | None = None, clean_source: str | None = None, archive_dir: str | None = None,
                 options: dict | None = None) -> DataFrame:
    """Streaming DataFrame over the files arriving in ``path``.

    ``max_files`` is the receive batch: at most so many files per micro-batch; the
    default is no limit, so that one drain is one micro-batch.  A watermark stream
    must be read without a limit unless files arrive in event-time order: the
    watermark moves between micro-batches, and rows behind it are late.

    ``options`` pass straight to the source, so a message broker is the same
    call, e.g. ``fmt="kafka", path=None, schema=None, options={
    "kafka.bootstrap.servers": ..., "subscribe": ..., "maxOffsetsPerTrigger": ...}``
    (needs that connector on the classpath; not installed here)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if max_files is not None and fmt != "kafka":
        r = r.option("maxFilesPerTrigger", max_files)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path) if path is not None else r.load()


def stage_files(df: DataFrame, path: str, n_files: int | None = None, order: str | None = None, fmt: str = "parquet") -> None:
    """Drop ``df`` into a queue directory the way producers do: every task writes
    its own message batch.  ``order`` range-splits the rows first, so that files
    follow each other in that order; ``n_files`` is for tests that need a number."""
    if order:
        df = (df.repartitionByRange(n_files, order) if n_files else df.repartitionByRange(order)).sortWithinPartitions(order)
    elif n_files:
        df = df.repartition(n_files)
    df.write.mode("overwrite").format(fmt).save(path)


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet", foreach_batch=None, timeout_s: int | None = None) -> None:
    """Process everything available now, then stop (the graceful drain).
    Waits for the drain to finish unless ``timeout_s`` is given."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink).start()
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream into {sink} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


def as_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); values are UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Streams started inside keep state in as many partitions as there are cores (or ``n``), if
    ``spark.sql.shuffle.partitions`` is not less anyway.

    Every micro-batch opens and commits each state partition, whatever it holds: partitions beyond
    the cores add that cost to every batch.  The number stays with the checkpoint."""
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    spark.conf.set(name, str(min(int(old), n or max(1, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def stage_slices(df: DataFrame, path: str, order: str, length: dt.timedelta) -> list[str]:
    """Write ``df`` once, ``length`` of event time to a folder, and name the folders in time order.

    The input is scanned for its first event time and for the write, whatever the number of slices."""
    lo = df.agg(F.min(order)).first()[0]
    if lo is None:
        return []
    micros = F.expr(f"timestampdiff(MICROSECOND, {_literal(lo)}, `{order}`)")
    which = F.floor(micros / F.lit(length // dt.timedelta(microseconds=1))).cast("long")
    # behind a rebalance on the slice: few files a slice, a large slice split
    df.withColumn("slice_no", which).hint("rebalance", "slice_no").write.mode("overwrite").partitionBy("slice_no").parquet(path)
    _, fs, folder = _files(df.sparkSession, path)
    names = [f.getPath().toString() for f in fs.listStatus(folder) if f.getPath().getName().startswith("slice_no=")]
    return sorted(names, key=lambda n: int(n.rsplit("=", 1)[1]) if not n.endswith("__") else 1 << 62)


def release_slices(spark: SparkSession, slices: list[str], path: str, query) -> None:
    """Hand slices to a running ``query`` over ``path`` (read with ``recursiveFileLookup``) one after the other:
    a slice's folder appears there as a whole, and the next one follows when it has been processed."""
    jvm, fs, folder = _files(spark, path)
    fs.mkdirs(folder)
    for k, name in enumerate(slices):
        fs.rename(jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.hadoop.fs.Path(f"{path}/s{k:09d}"))
        query.processAllAvailable()


def run_slices(df: DataFrame, base: str, order: str, length: dt.timedelta, start) -> int:
    """Feed ``df`` slice by slice to the one query that ``start(stream)`` starts, and stop it; returns the number of slices.

    A slice is one micro-batch, so no slice holds rows that a watermark of an earlier one could drop, if event
    time is ``order``; state and watermark live in the query and its checkpoint."""
    spark = df.sparkSession
    slices = stage_slices(df, f"{base}/staged", order, length)
    _, fs, folder = _files(spark, f"{base}/in")
    fs.mkdirs(folder)
    query = start(queue_ingest(spark, f"{base}/in", df.schema, options={"recursiveFileLookup": "true"}))
    try:
        release_slices(spark, slices, f"{base}/in", query)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return len(slices)


def _literal(ts: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def feed_in_time_order(df: DataFrame, path: str, order: str, length: dt.timedelta, run, reduce=None) -> int:
    """Drop ``df`` into the queue directory ``path`` in consecutive slices of
    ``length`` of event time, calling ``run()`` (one ``availableNow`` drain on the
    same checkpoint) after each: the stream sees the data arrive over time, in
    order, with its state and watermark carried in the checkpoint.

    A drain must read all files of its slice in one micro-batch (no file limit):
    then no slice holds rows older than the watermark that an earlier one set.
    State spans about one slice and the watermark's delay.  ``reduce`` is applied
    to a slice before it is written.  Slices are written by all tasks in parallel;
    only the first and last event time reach the driver.  Returns the number of
    slices."""
    from harborlens.functions.scalars import ts_literal

    lo, hi = df.agg(F.min(order), F.max(order)).first()
    if lo is None:
        return 0
    n = 0
    while lo + length * n <= hi:
        part = df.where((F.col(order) >= ts_literal(lo + length * n)) & (F.col(order) < ts_literal(lo + length * (n + 1))))
        (reduce(part) if reduce else part).write.mode("append").parquet(path)
        run()
        n += 1
    return n
