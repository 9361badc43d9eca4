"""Line deduplication: repeated runs of lines, found by prefix doubling over line-id sequences.

Every line of every document is a symbol (its id: a 64-bit hash of the line; a run
of ``min_lines`` lines is only confused with another if that many hashes in a row
collide).  Suffixes of the line sequences get ranks by prefix doubling: a suffix's
rank by its first 2k lines follows from its rank by k lines and the rank of the
suffix k lines on.  Ranks are dense positions in the sorted order of these pairs,
found in range partitions, so no task sorts or sees all suffixes.  A suffix whose
rank is its own alone can start no repeated run and leaves before the next round,
so rounds shrink to what repeats.  Doubling stops at depth ``min_lines`` (its last
step overlaps): suffixes of equal rank are then the intervals with a common prefix
of at least ``min_lines`` lines.  In each interval all but the first suffix (by
document, then line) start a later copy; later copies are deleted, and adjoining
ones make a maximal repeated run.

With ``min_words`` a run of fewer lines, down to one, counts too if it has that many
words (``[^\\x20\\x09-\\x0D]+``).  Ranks are then taken one line deeper at a time, as
the shared ranks of every depth up to ``min_lines`` are needed; suffixes of equal
rank have the same lines and so the same number of words.

DataFrame operations only; no Python runs on the executors.

Defined results: a line ends at ``\\n``; a null text is empty and has one empty
line; documents are ordered by doc_id, null first, then by a hash of their text;
rows that repeat an earlier row exactly are the same document and get its result;
runs never cross documents; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborlens.llm.textkit import new_path, stored, text_view

MIN_LINES = 4
MIN_WORDS = 50
_AT = ("d", "t", "pos")


def line_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_words: bool = False) -> DataFrame:
    """(d, t, pos, rank): document key, text hash, line number and line id, once a document; or words of the line too."""
    docs = text_view(df, id_col, text_col)
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("t"), "text")
    words = [F.regexp_count("line", F.lit(r"[^\x20\x09-\x0D]+")).alias("words")] if with_words else []
    return keyed.select("d", "t", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(*_AT, F.xxhash64("line").alias("rank"), *words)


def _shared(suffixes: DataFrame, *key: str) -> DataFrame:
    """Keys that more than one suffix has, with the first such suffix and a dense rank in key order."""
    first = F.min(F.struct(*_AT)).alias("first")
    groups = suffixes.groupBy(*key).agg(F.count("*").alias("n"), first).where("n > 1").drop("n")
    placed = stored(groups.repartitionByRange(*key).withColumn("_part", F.spark_partition_id()), "line-ranks")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*key))
    return (placed.withColumn("_inside", inside).join(before, "_part")
            .select(*key, "first", (F.col("_before") + F.col("_inside")).alias("next_rank")))


def _ranked(suffixes: DataFrame, *key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(d, t, pos, rank, first) and ``keep`` of the suffixes whose key is shared."""
    named = suffixes.join(_shared(suffixes, *key), list(key))
    return stored(named.select(*_AT, F.col("next_rank").alias("rank"), "first", *keep), "line-suffixes")


def repeated_starts(lines: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(d, t, pos, rank, first): every suffix that shares its first ``min_lines`` lines with another."""
    # A row that repeats another one is the same document.
    ranks = _ranked(lines.dropDuplicates([*_AT]), "rank")
    depth = 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        later = ranks.select("d", "t", (F.col("pos") - step).alias("pos"), F.col("rank").alias("rank2"))
        ranks = _ranked(ranks.drop("first").join(later, list(_AT)), "rank", "rank2")
        depth += step
    return ranks


def wordy_starts(lines: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(d, t, pos, first, size): every suffix that shares its first ``min_lines`` lines with another, or fewer
    that have ``min_words`` words; size is the number of lines."""
    one = lines.dropDuplicates([*_AT]).withColumn("line_words", F.col("words"))
    carried = ("words", "line_words")
    ranks = _ranked(one, "rank", keep=carried)
    found = []
    for depth in range(1, min_lines):
        found.append(ranks.where(F.col("words") >= min_words).select(*_AT, "first", F.lit(depth).alias("size")))
        later = ranks.select("d", "t", (F.col("pos") - 1).alias("pos"), F.col("rank").alias("rank2"), F.col("words").alias("words2"))
        longer = ranks.drop("first").join(later, list(_AT)).withColumn("words", F.col("line_words") + F.col("words2"))
        ranks = _ranked(longer, "rank", "rank2", keep=carried)
    out = ranks.select(*_AT, "first", F.lit(min_lines).alias("size"))
    for more in found:
        out = out.unionByName(more)
    return out


def deleted_runs(starts: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(d, t, begin, end): maximal runs of lines covered by later copies, end exclusive."""
    later = starts.where(F.struct(*_AT) != F.col("first")).select(*_AT)
    w = W.partitionBy("d", "t").orderBy("pos")
    fresh = F.coalesce(F.col("pos") > F.lag("pos").over(w) + min_lines, F.lit(True))
    runs = later.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(w))
    return runs.groupBy("d", "t", "run").agg(F.min("pos").alias("begin"), (F.max("pos") + min_lines).alias("end"))


def deleted_passages(starts: DataFrame) -> DataFrame:
    """(d, t, begin, end) as :func:`deleted_runs`, of starts that cover ``size`` lines each."""
    later = starts.where(F.struct(*_AT) != F.col("first")).select(*_AT, (F.col("pos") + F.col("size")).alias("end"))
    w = W.partitionBy("d", "t").orderBy("pos", "end")
    before = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("pos") > before, F.lit(True))
    runs = later.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy("d", "t", "run").agg(F.min("pos").alias("begin"), F.max("end").alias("end"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES,
                min_words: int | None = None) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_removed, n_runs), one row per row of ``df``.

    A run has ``min_lines`` lines, or with ``min_words`` fewer lines of that many words.
    The texts are shuffled once, to meet their runs (one array per document, no
    longer than the document)."""
    lines = stored(line_ids(df, id_col, text_col, min_words is not None), "line-ids")
    if min_words is None:
        gone = deleted_runs(repeated_starts(lines, min_lines), min_lines)
    else:
        gone = deleted_passages(wordy_starts(lines, min_lines, min_words))
    runs = (gone.groupBy("d", "t")
            .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("runs")))
    docs = text_view(df, id_col, text_col).withColumns(
        {"d": F.coalesce("doc_id", F.lit(-(1 << 63))), "t": F.xxhash64("text")})
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda _, i: ~F.exists("runs", lambda r: (i >= r["begin"]) & (i < r["end"])))
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["begin"]))
    return (docs.join(runs, ["d", "t"], "left")
            .select("doc_id", F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs")))


def write_deduplicated(df: DataFrame, name: str = "line-dedup", **options) -> str:
    """Write the deduplicated documents into the shared folder; returns the path."""
    path = new_path(df.sparkSession, name)
    dedup_lines(df, **options).write.parquet(path)
    return path
