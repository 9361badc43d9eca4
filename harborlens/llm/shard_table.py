"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table, a
permutation given by an offset and a skip hashed from its name.  Shards take
turns; at its turn a shard claims the first slot of its order that is still
free, until the table is full.  Shards then own almost equally many slots, and
adding or removing a shard moves few of them.  The table depends on the shard
names and its size only, never on the data; it is broadcast (``slots`` rows, the
proven bound) and places each row by one lookup of hash mod slots.

Defined results: a null key is placed by its text (null text: empty), so rows
without key spread as well; equal keys share a shard; an empty table gives no
rows; an input column named like an output column is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.llm.textkit import fresh

SLOTS = 8191
SHARDS = 64


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the owning shard for each slot."""
    if slots < max(3, len(names)) or any(slots % p == 0 for p in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime and at least the number of shards")
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    at = [number(f"offset:{n}") % slots for n in names]
    skip = [number(f"skip:{n}") % (slots - 1) + 1 for n in names]
    owner: list[int] = [-1] * slots
    claimed = 0
    while claimed < slots:
        for i in range(len(names)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            owner[at[i]] = i
            claimed += 1
            if claimed == slots:
                break
    return owner


def slot_of(key: Column, fallback: Column, slots: int = SLOTS) -> Column:
    """Slot of a row: the first 60 bits of md5 of its key (or else of its text) modulo slots."""
    text = F.coalesce(F.concat(F.lit("k:"), key.cast("string")), F.concat(F.lit("t:"), fallback), F.lit("t:"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as (slot, shard) rows, made by Spark from one literal."""
    owners = ",".join(str(x) for x in lookup_table(names, slots))
    return (spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("_table_slot", "_owner"))
            .select(F.col("_table_slot").cast("long").alias("_table_slot"), F.col("_owner").cast("int").alias("_owner")))


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def assign_shards(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", names: list[str] | None = None,
                  slots: int = SLOTS, slot_out: str = "slot", shard_out: str = "shard") -> DataFrame:
    """``df`` with its slot and shard; no shuffle, no Python in the plan.

    Columns named like ``slot_out`` and ``shard_out`` are replaced, all others kept as
    they are.  A row without a key goes by its text, one without both by the empty
    text; an empty table gives no row."""
    names = shard_names(SHARDS) if names is None else names
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (slot_out, shard_out)]
    placed = df.select(*kept, slot_of(F.col(key_col), F.col(text_col), slots).alias(slot_out))
    at, owner = fresh(placed, "_table_slot", "_owner")
    table = F.broadcast(table_frame(df.sparkSession, names, slots).toDF(at, owner))
    out = placed.join(table, F.col(slot_out) == F.col(at))
    return out.select(*[F.col(f"`{c}`") for c in placed.columns], F.col(owner).alias(shard_out))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write the rows into one folder per shard; large shards are split over several files."""
    out = assign_shards(df, **options)
    out.hint("rebalance", F.col(options.get("shard_out", "shard"))).write.partitionBy(options.get("shard_out", "shard")).parquet(path)
