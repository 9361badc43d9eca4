"""Mixing sources to target weights.

Words are summed per source.  Sources, in code-point order with null last, weigh
1, 2, 3, 1, 2, 3, ... and share all words by weight; a target stops at
``max_rate`` times its source's words and the excess is shared again by weight
until no source is above.  A source's repetition rate is target / words; each of
its documents is taken floor(rate) times, plus once more if a number in [0, 1)
hashed from seed and doc_id lies below the fraction.

Defined results: null or empty text has size 0; null sources form one source,
last; a source without words has target 0 and takes nothing; rows that share a
doc_id draw alike; a null doc_id draws as the empty key; an empty table gives no
rows.  Nothing depends on row order or partitions, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborlens.llm.textkit import SPACE, fresh, stored, text_chunks, utf8

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
SEED = "mix"


def word_counts(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size): words ``[^\\x20\\x09-\\x0D]+`` of each whole text, 0 for null."""
    def run(batches):
        for b in text_chunks(batches):
            data, off = utf8(b.column("text"))
            solid = ~SPACE[data]
            first = solid.copy()
            first[1:] &= ~solid[:-1]
            cut = off[:-1][off[:-1] < len(data)]
            first[cut] = solid[cut]
            total = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(total[off[1:]] - total[off[:-1]])],
                                             names=["doc_id", "source", "size"])

    return (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, source string, size long"))


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with its 0-based position in the given order, without one task seeing all rows.

    Rows are range-partitioned and stored; a partition's rows are numbered inside
    it and shifted by the sizes of the partitions before (one row per partition)."""
    placed = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return (placed.withColumn("_inside", inside).join(before, "_part")
            .withColumn("rank", F.col("_before") + F.col("_inside") - 1).drop("_part", "_inside", "_before"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, weight, target) from (source, size) rows.

    Each sharing round is one aggregation over the sources that hands the driver
    three sums; a round caps at least one more source or is the last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = (F.col("source").isNull().asc(), F.col("source").asc())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = stored(ranked(per, *order).select("source", "source_size", w.alias("weight")), "source-weights")
    cap = F.col("source_size") * max_rate
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, before = None, -1
    while True:
        above = F.lit(False) if level is None else cap < F.lit(level) * F.col("weight")
        n, capped, free = per.agg(F.count_if(above), F.sum(F.when(above, cap).otherwise(0)),
                                  F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if n == before or not free:
            break
        before, level = n, (total - capped) / free
    level = 0.0 if level is None else level
    return per.withColumn("target", F.when(cap < F.lit(level) * F.col("weight"), cap.cast("double"))
                          .otherwise(F.lit(level) * F.col("weight")))


def unit_draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 48 bits of md5(seed:key)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def _with_copies(df: DataFrame, targets: DataFrame, source: Column, doc_id: Column, seed: str) -> tuple[DataFrame, list[str]]:
    """``df`` with size, target, rate and copies of each row's source, in columns of the names returned.

    Targets are a row per source, read from a stored table: Spark knows its size
    and broadcasts it where it is small, or else joins by shuffle and splits a
    source that holds many rows."""
    size, target, rate, copies, name = fresh(df, "_size", "_target", "_rate", "_copies", "_source")
    of = F.when(F.col(size) > 0, F.col(target) / F.col(size)).otherwise(F.lit(0.0))
    extra = (unit_draw(doc_id, seed) < F.col(rate) - F.floor(rate)).cast("long")
    per = targets.select(F.col("source").alias(name), F.col("source_size").alias(size), F.col("target").alias(target))
    out = df.join(per, source.eqNullSafe(F.col(name))).withColumn(rate, of).withColumn(copies, F.floor(rate) + extra)
    return out, [size, target, rate, copies]


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken), one row per row of ``df``.

    Texts are read once and never shuffled: sizes are stored, sums per source are
    combined map-side."""
    docs = stored(word_counts(df, id_col, text_col, source_col), "mix-sizes")
    targets = source_targets(docs, weights, max_rate)
    out, (total, target, rate, copies) = _with_copies(docs, targets, F.col("source"), F.col("doc_id"), seed)
    return out.select("doc_id", "source", "size", F.col(total).alias("source_size"), F.col(target).alias("target"),
                      F.col(rate).alias("rate"), F.col(copies).alias("copies"), (F.col("size") * F.col(copies)).alias("taken"))


def repeat_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     weights=WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with df's columns alone, whatever their names.

    Null ids and sources are kept as such, null and empty texts have size 0, repeated
    rows draw alike, and an empty table gives no row."""
    targets = source_targets(word_counts(df, id_col, text_col, source_col), weights, max_rate)
    taken, (*_, copies) = _with_copies(df, targets, F.col(source_col).cast("string"), F.col(id_col).cast("long"), seed)
    (copy,) = fresh(taken, "_copy")
    return (taken.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in df.columns]))
