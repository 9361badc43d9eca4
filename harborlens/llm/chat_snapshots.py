"""Chat formatting after cumulative-snapshot collapse.

Loggers often store a conversation again after each turn, so shorter records are
prefixes of longer ones.  Each conversation's turns are numbered in turn order and
every prefix gets a rolling hash: the sum over its turns of two 64-bit hashes of
(number, role, text), 128 bits in all.  A conversation whose whole hash is the
hash of a proper prefix of another, longer one is a snapshot and is dropped by an
anti-join, as are repeats of an equal conversation (the smallest conv_id stays).
The maximal conversations are rendered into chat markup, one row per segment of
``segment`` turns.

Numbers and sums run over stretches of ``stretch`` turn values and then over the
stretches' totals, so a conversation that holds a third of all turns is still
spread over many tasks; prefixes are reduced to distinct hashes before the join,
so a first turn that a third of all conversations share is one row there.  No
pairs of conversations are made.

Defined results: null roles and texts are empty; null turns come first; equal
turn numbers are ordered by role, then text; a row that repeats (conv_id, turn,
role, text) counts once; rows with a null conv_id form one conversation; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STRETCH = 256
SEGMENT = 32
_NONE = -(1 << 63)


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(has_id, conv, turn, role, text), without repeated rows."""
    return df.select(F.col(conv_col).isNotNull().alias("has_id"), F.coalesce(F.col(conv_col).cast("long"), F.lit(0)).alias("conv"),
                     F.coalesce(F.col(turn_col).cast("long"), F.lit(_NONE)).alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()


def _running(df: DataFrame, value, out: str, order: list[str], stretch: int):
    """``df`` with the running sum of ``value`` over a conversation, in two levels."""
    part = F.floor(F.col("turn") / stretch)
    df = df.withColumn("_stretch", part)
    key = ["has_id", "conv", "_stretch"]
    inner = F.sum(value).over(W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    total = df.groupBy(*key).agg(F.sum(value).alias("_total"))
    before = total.select(*key, (F.sum("_total").over(W.partitionBy("has_id", "conv").orderBy("_stretch")) - F.col("_total")).alias("_before"))
    return df.withColumn(out, inner).join(before, key).withColumn(out, F.col(out) + F.col("_before")).drop("_stretch", "_before")


def prefix_hashes(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Turns with their number ``n`` (from 1) and the rolling hash (h1, h2) of the prefix that ends there.

    Sums are over 64-bit hashes in DECIMAL(38, 0) and so never overflow or wrap."""
    order = ["turn", "role", "text"]
    numbered = _running(turns, F.lit(1).cast("long"), "n", order, stretch)
    wide = lambda seed: F.xxhash64(F.lit(seed), F.col("n"), F.col("role"), F.col("text")).cast("decimal(20,0)")
    out = _running(numbered, wide(1), "h1", order, stretch)
    return _running(out, wide(2), "h2", order, stretch)


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(has_id, conv, n_turns, h1, h2) of conversations that are no prefix and no repeat of another."""
    conv = ["has_id", "conv"]
    length = prefixes.groupBy(*conv).agg(F.max("n").alias("n_turns"))
    marked = prefixes.select(*conv, "n", "h1", "h2").join(length, conv)
    whole = marked.where("n = n_turns").select(*conv, "n_turns", "h1", "h2")
    # null conv_id sorts before every other
    first = whole.groupBy("n_turns", "h1", "h2").agg(F.min(F.struct(*conv)).alias("k")).select("k.has_id", "k.conv", "n_turns", "h1", "h2")
    proper = marked.where("n < n_turns").select(F.col("n").alias("n_turns"), "h1", "h2").distinct()
    return first.join(proper, ["n_turns", "h1", "h2"], "left_anti")


def render_turn(role, text):
    """``<|role|>`` line, then the text, then an end mark on its own line."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 segment: int = SEGMENT, stretch: int = STRETCH) -> DataFrame:
    """(conv_id, n_turns, segment, first_turn, segment_turns, rendered): maximal conversations as chat markup.

    Segments in order, laid end to end, are the whole conversation; each is a
    bounded number of turns, so no row grows with a conversation."""
    prefixes = prefix_hashes(turns_of(df, conv_col, turn_col, role_col, text_col), stretch)
    kept = maximal_conversations(prefixes).select("has_id", "conv", "n_turns")
    parts = prefixes.join(kept, ["has_id", "conv"]).select(
        "has_id", "conv", "n_turns", "n", F.floor((F.col("n") - 1) / segment).alias("segment"),
        render_turn(F.col("role"), F.col("text")).alias("piece"))
    pieces = F.array_sort(F.collect_list(F.struct("n", "piece")))
    return (parts.groupBy("has_id", "conv", "n_turns", "segment").agg(F.min("n").alias("first_turn"), F.count("*").alias("segment_turns"),
                                                                    pieces.alias("pieces"))
            .select(F.when(F.col("has_id"), F.col("conv")).alias("conv_id"), "n_turns", "segment", "first_turn", "segment_turns",
                    F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("rendered")))
