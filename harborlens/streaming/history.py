"""E5's memory: a sink of unique keys over a long history, with a manifest.

The sink is a folder of two tables:

``rows/part=<name>``     the rows, sorted by (bucket, key) in each file;
``manifest/<entry>``     one row for each *block*, the rows of one bucket in one file:
                         bucket, file, level, number of rows, first and last key, Bloom bits.

A manifest entry is ``delta-<B>``, the blocks that batch B added, or ``snapshot-<B>``,
all blocks of the batches before B.  The history as batch B sees it is the newest
snapshot up to B and the deltas from there up to B, B itself left out, so a batch that
is run again after a failure sees what it saw the first time and replaces what it wrote.

A batch asks the manifest, by an equi-join on the bucket, which blocks its keys can lie
in (key range, then Bloom bits) and reads those files only; where keys grow with time
that is next to nothing, however long the history.  On the driver there are one listing
of the manifest's folder and the names of the files to be read.

Every ``every`` batches a bucket with that many blocks of one level has its blocks of
this and lower levels merged to one of the next level, and the manifest becomes one
snapshot.  A row is rewritten once a level, so about log(batches) times in all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlens.operators.events import dedup
from harborlens.session import materialised

NULL_BUCKET = -1
EVERY = 8
HASHES = 4
BITS_PER_KEY = 12
MOST_BITS = 1 << 20           # of a block: 128 kB


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key; rows without a key have a bucket of their own."""
    return F.when(F.col(key).isNull(), F.lit(NULL_BUCKET)).otherwise(F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))


def _positions(key: Column, bits: Column) -> Column:
    """The key's places among a block's Bloom bits."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), bits.cast("long")) for i in range(HASHES)])


def may_hold(key: Column, words: Column) -> Column:
    """Whether a block with these Bloom words can hold the key; never false for one it holds."""
    return F.forall(_positions(key, F.size(words) * 64),
                    lambda p: F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0)


class History:
    """One sink of unique ``key`` values.  ``buckets`` and ``every`` must stay as they were when it was begun."""

    def __init__(self, spark: SparkSession, sink: str, key: str = "event_id", buckets: int = 1024, every: int = EVERY):
        self.spark, self.sink, self.key, self.buckets, self.every = spark, sink.rstrip("/"), key, buckets, every
        self.schema: T.StructType | None = None                 # of the rows, once it has been compared with a batch

    # -------------------------------------------------------------- manifest

    def entries(self) -> list[str]:
        """Names of the committed manifest entries: one listing."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.sink}/manifest")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        # an entry counts once its job has been committed
        done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.sink}/manifest/*/_SUCCESS"))
        return [s.getPath().getParent().getName() for s in done]

    def blocks(self, before: int | None = None) -> DataFrame | None:
        """The blocks of all batches before ``before`` (all if None), None if there are none."""
        names = [(kind, int(number)) for kind, number in (e.rsplit("-", 1) for e in self.entries())]
        seen = [n for kind, n in names if kind == "snapshot" and (before is None or n <= before)]
        since = max(seen) if seen else None
        live = [f"{self.sink}/manifest/delta-{n}" for kind, n in names if kind == "delta" and (since is None or n >= since) and (before is None or n < before)]
        live += [f"{self.sink}/manifest/snapshot-{since}"] if seen else []
        if not live:
            return None
        reader = self.spark.read
        if self.schema is not None:                              # spares the job that looks for a schema
            key = self.schema[self.key].dataType.simpleString()
            reader = reader.schema(f"bucket int, file string, level int, n long, first {key}, last {key}, words array<long>")
        return reader.parquet(*live)

    def _describe(self, part: str, key_field: T.StructField, bits: int, level: int = 0) -> DataFrame:
        """Blocks of the rows that have just been written under ``part``, by what is there; ``bits`` Bloom bits each."""
        schema = T.StructType([T.StructField("bucket", T.IntegerType()), key_field])
        rows = self.spark.read.schema(schema).parquet(f"{self.sink}/rows/part={part}")
        key = F.col(self.key)
        places = F.when(key.isNotNull(), _positions(key, F.lit(bits))).otherwise(F.array_repeat(F.lit(-1).cast("long"), HASHES))
        rows = rows.select("bucket", F.col("_metadata.file_path").alias("file"), key.alias("key"), F.explode(places).alias("p"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))
        word = rows.groupBy("bucket", "file", F.shiftright("p", 6).cast("int").alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"), F.bit_or(one).alias("x"))
        block = word.groupBy("bucket", "file").agg(F.expr(f"sum(n) div {HASHES}").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
                                                   F.map_from_entries(F.collect_list(F.when(F.col("w") >= 0, F.struct("w", "x")))).alias("m"))
        full = F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda w: F.coalesce(F.element_at("m", w), F.lit(0).cast("long")))
        return block.select("bucket", "file", F.lit(level).alias("level"), "n", "first", "last", F.when(F.size("m") > 0, full).alias("words"))

    def _bits(self, rows: int) -> int:
        """Bloom bits of each block when so many rows are written; blocks that get more of them are told apart less well."""
        return min(MOST_BITS, max(64, -(-rows * BITS_PER_KEY // (64 * self.buckets)) * 64))

    def _write_rows(self, rows: DataFrame, part: str) -> None:
        """Files of whole buckets where these are small, several files of a bucket with many rows."""
        (rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key)
         .write.mode("overwrite").parquet(f"{self.sink}/rows/part={part}"))

    # -------------------------------------------------------------- reading

    def files_for(self, keys: DataFrame, before: int | None = None) -> list[str]:
        """Files that can hold one of the (bucket, key) rows' keys."""
        blocks = self.blocks(before)
        if blocks is None:
            return []
        near = keys.select("bucket", F.col(self.key).alias("key")).join(blocks.select("bucket", "file", "first", "last", "words"), "bucket")
        near = near.where(F.col("key").between(F.col("first"), F.col("last")) & may_hold(F.col("key"), F.col("words")))
        return sorted(r.file for r in near.select("file").distinct().collect())

    def read(self, before: int | None = None) -> DataFrame | None:
        """All rows, or those of the batches before ``before``; None if there are none."""
        blocks = self.blocks(before)
        if blocks is None:
            return None
        live = blocks.select("bucket", "file")
        files = [r.file for r in live.select("file").distinct().collect()]
        rows = self.spark.read.parquet(*files).withColumn("file", F.col("_metadata.file_path"))
        return rows.join(live, ["bucket", "file"], "left_semi").drop("bucket", "file") if files else None

    # -------------------------------------------------------------- writing

    def add(self, batch: DataFrame, batch_id: int, order: Sequence[str] = ("delivered_ts", "attempt")) -> int:
        """Write the first row by ``order`` of each key that the history has not seen; returns how many files were read for that."""
        if batch_id and batch_id % self.every == 0:
            self.compact(batch_id)
        fresh = dedup(batch, self.key, order).withColumn("bucket", bucket_of(self.key, self.buckets)).persist()
        try:
            self._check(batch, batch_id)
            files = self.files_for(fresh, batch_id)
            new = fresh
            if files:
                history = self.spark.read.schema(T.StructType([fresh.schema["bucket"], batch.schema[self.key]])).parquet(*files)
                seen = history.join(fresh.select(self.key), self.key, "left_semi").select(self.key).distinct()
                new = fresh.join(seen, self.key, "left_anti")
            bits = self._bits(fresh.count())
            self._write_rows(new, f"batch-{batch_id}")
            self._describe(f"batch-{batch_id}", batch.schema[self.key], bits).coalesce(1).write.mode("overwrite").parquet(f"{self.sink}/manifest/delta-{batch_id}")
            return len(files)
        finally:
            fresh.unpersist()

    def compact(self, before: int) -> int:
        """Merge full levels of the batches before ``before`` and write their snapshot; returns how many blocks were merged."""
        if f"snapshot-{before}" in self.entries():
            return 0                                            # the batch is being run again
        blocks = self.blocks(before)
        if blocks is None:
            return 0
        blocks = materialised(blocks, "manifest")
        full = (blocks.groupBy("bucket", "level").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= self.every)
                .groupBy("bucket").agg(F.max("level").alias("up_to")))
        merged = materialised(blocks.join(full, "bucket").where("level <= up_to").select("bucket", "file", "up_to", "n"), "merged")
        files = [r.file for r in merged.select("file").distinct().collect()]
        kept = blocks
        if files:
            rows = self.spark.read.parquet(*files)
            rows = rows.withColumn("file", F.col("_metadata.file_path")).join(merged.select("bucket", "file"), ["bucket", "file"], "left_semi").drop("file")
            self._write_rows(rows, f"merged-{before}")
            levels = merged.groupBy("bucket").agg((F.max("up_to") + 1).cast("int").alias("up"))
            bits = self._bits(merged.agg(F.sum("n")).first()[0])
            new = self._describe(f"merged-{before}", rows.schema[self.key], bits).join(levels, "bucket").withColumn("level", F.col("up"))
            kept = blocks.join(merged.select("bucket", "file"), ["bucket", "file"], "left_anti").unionByName(new.select(*blocks.columns))
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.sink}/manifest/snapshot-{before}")
        return merged.count()

    def obsolete(self) -> DataFrame | None:
        """Files of rows that no block of the newest state lies in: what may be deleted once no batch before the newest snapshot can be run again."""
        blocks = self.blocks()
        if blocks is None:
            return None
        here = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.sink}/rows").select(F.col("path").alias("file"))
        return here.join(blocks.select(F.regexp_replace("file", "^file:/+", "file:/").alias("file")).distinct(), "file", "left_anti")

    def _check(self, batch: DataFrame, batch_id: int) -> None:
        """A sink that does not have the batch's columns is an error; looked at once."""
        if self.schema is None and (blocks := self.blocks(batch_id)) is not None and (some := blocks.select("file").first()):
            have = {f.name: f.dataType for f in self.spark.read.parquet(some.file).schema}
            missing = [f.name for f in batch.schema if have.get(f.name) != f.dataType]
            if missing:
                raise ValueError(f"sink {self.sink} does not hold the batch's columns {missing}")
        elif self.schema is not None and self.schema != batch.schema:
            raise ValueError(f"sink {self.sink} was given other columns: {batch.schema.simpleString()}")
        self.schema = batch.schema


def history_writer(sink: str, key: str = "event_id", buckets: int = 1024, every: int = EVERY, order: Sequence[str] = ("delivered_ts", "attempt")):
    """E5 as a ``foreachBatch`` function: a batch's first rows of keys that the sink has never seen."""

    histories: list[History] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not histories:
            histories.append(History(batch.sparkSession, sink, key, buckets, every))
        histories[0].add(batch, batch_id, order)

    return write
