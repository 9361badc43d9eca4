"""E4 dedup within a watermark and E5 an idempotent sink across a short history
(``history`` is the sink for a long one, ``first_delivery`` the dedup by event time).

E4 keeps state per key only until the watermark passes it: memory is bounded
by the keys seen within ``delay``, whatever the stream's length.

E5 makes the sink itself the memory.  Each micro-batch (``foreachBatch``): the
first delivery of each key in the batch, minus the keys already in the sink, is
written.  The sink is laid out ``bucket=K/batch_id=B``: ``K`` is a hash of the
key, so the lookup of earlier keys lists and reads only the buckets this batch
touches, and ``batch_id`` makes a replayed batch overwrite its own output
instead of appending twice, and lets the lookup skip that output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlens.operators.events import dedup
from harborlens.streaming.queue import as_event_time

NULL_BUCKET = -1


def dedup_stream(stream: DataFrame, key: str = "event_id", ts: str = "delivered_ts",
                 delay: str = "15 minutes") -> DataFrame:
    """First arrival per key wins; duplicates arriving within ``delay`` of
    event time are dropped; rows older than the watermark are dropped as late.

    Arrival is by micro-batch.  Rows of one key in the same micro-batch arrive
    together, and any of them may stay; where the first delivery is wanted, the
    producer reduces its batch with E3 (see ``feed_in_time_order``)."""
    s = as_event_time(stream, ts).withWatermark(ts, delay)
    return s.dropDuplicatesWithinWatermark([key])


def bucket_of(key: str, buckets: int):
    """Bucket of a key; rows without a key have a bucket of their own."""
    return F.when(F.col(key).isNull(), F.lit(NULL_BUCKET)).otherwise(F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))


def _written(spark: SparkSession, sink: str, buckets: Sequence[int]) -> list[str]:
    """Folders of those buckets that the sink has: one listing of its top folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    have = {f.getPath().getName() for f in fs.listStatus(top)} if fs.exists(top) else set()
    return [f"{sink}/bucket={b}" for b in buckets if f"bucket={b}" in have]


def read_buckets(spark: SparkSession, sink: str, buckets: Sequence[int], schema) -> DataFrame | None:
    """Rows of the given buckets, None if none of them has been written yet.  Files of other buckets are not listed."""
    paths = _written(spark, sink, buckets)
    if not paths:
        return None
    return spark.read.option("basePath", sink).schema(schema).parquet(*paths)


def idempotent_writer(sink: str, key: str = "event_id", buckets: int = 1024, order: Sequence[str] = ("delivered_ts", "attempt")):
    """E5: a ``foreachBatch`` function writing only keys the sink has never seen.

    Within a batch the first delivery by ``order`` wins; across batches the batch
    that came first.  Rows without a key cannot be told apart: all are kept, each
    batch's once however often it is replayed.  A sink that does not have the
    batch's columns is an error."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = dedup(batch, key, order).withColumn("bucket", bucket_of(key, buckets)).persist()
        try:
            # one job: the buckets this batch touches (at most ``buckets``) and its key range
            touched, lo, hi = fresh.agg(F.collect_set("bucket"), F.min(key), F.max(key)).first()
            if not touched:
                return
            schema = T.StructType([batch.schema[key], T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())])
            history = read_buckets(spark, sink, [b for b in touched if b != NULL_BUCKET], schema)
            new = fresh
            if history is not None:
                _check_sink(spark, sink, touched, batch)
                # The batch's key range skips row groups of the key-sorted files: where
                # keys grow with time, most of the old history.  Spark knows the cached
                # batch's size and broadcasts it while it is small, so that history is
                # scanned one column wide and not shuffled.
                earlier = history.where((F.col("batch_id") != batch_id) & F.col(key).between(F.lit(lo), F.lit(hi))).select(key)
                seen = earlier.join(fresh.select(key), key, "left_semi").distinct()
                new = fresh.join(seen, key, "left_anti")
            # few files per touched bucket, skewed buckets split
            (new.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", "bucket")
             .sortWithinPartitions("bucket", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "batch_id").parquet(sink))
        finally:
            fresh.unpersist()

    return write


def _check_sink(spark: SparkSession, sink: str, touched: Sequence[int], batch: DataFrame) -> None:
    paths = _written(spark, sink, touched)
    have = {f.name: f.dataType for f in spark.read.option("basePath", sink).parquet(paths[0]).schema}
    missing = [f.name for f in batch.schema if have.get(f.name) != f.dataType]
    if missing:
        raise ValueError(f"sink {sink} does not hold the batch's columns {missing}")


def idempotent_write(batch: DataFrame, sink: str, key: str = "event_id", batch_id: int = 0,
                     buckets: int = 1024, order: Sequence[str] = ("delivered_ts", "attempt")) -> None:
    """E5 for one batch: write the keys ``sink`` has never seen, under
    ``batch_id`` (a replay of the same id replaces its own output)."""
    idempotent_writer(sink, key, buckets, order)(batch, batch_id)


def read_sink(spark, sink: str) -> DataFrame:
    return spark.read.parquet(sink)
