"""Connected components by contraction: each round joins nodes to labels and keeps only edges between labels.

A round gives every node the least of itself and its neighbours as parent, follows
parents ``JUMPS`` times, and relabels the edges; edges inside a label go.  A node,
its parent and theirs are joined by edges, so no link between labels is lost, and the
least node of a component only ever points to itself.  Rounds end when no edge is
left; they work on labels, so each has far fewer rows than the one before.  Neighbour
sets are never collected: a round is one map-side combined minimum and equi-joins."""

from __future__ import annotations

import gc
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.llm.textkit import stored

JUMPS = 2


def release(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of steps whose results are stored: its cleaner waits for the driver's
    garbage collection, which an iteration over small tables may not bring about for a long time."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _relabelled(edges: DataFrame, to: DataFrame) -> DataFrame:
    """Distinct edges (u > v) between the labels of ``edges``' ends; ``to`` is (u, p)."""
    e = edges.join(to.select("u", F.col("p").alias("x")), "u").join(to.select(F.col("u").alias("v"), F.col("p").alias("y")), "v")
    return e.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(s, c) of every node of the (a, b) edges, c being its component's least node; edges of a node with itself are left out."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    steps = []
    while e.limit(1).count():
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = both.groupBy("u").agg(F.least("u", F.min("v")).alias("p"))
        for _ in range(JUMPS):
            up = stored(up, "parents")
            up = up.join(up.select(F.col("u").alias("p"), F.col("p").alias("g")), "p").select("u", F.col("g").alias("p"))
        up = stored(up, "parents")
        steps.append(up)
        e = stored(_relabelled(e, up), "links")
        release(e)
    if not steps:
        return e.select(F.col("u").alias("s"), F.col("v").alias("c"))
    return stored(reduce(_followed, steps).select(F.col("u").alias("s"), F.col("p").alias("c")), "components")


def _followed(at: DataFrame, step: DataFrame) -> DataFrame:
    on = at.join(step.select(F.col("u").alias("p"), F.col("p").alias("next")), "p", "left")
    return on.select("u", F.coalesce("next", "p").alias("p"))


def joined(classes: DataFrame, found: DataFrame) -> DataFrame:
    """The (s, c) classes after the (a, b) links ``found`` join some of them; only links between labels are worked on."""
    label = classes.select(F.col("s").alias("a"), F.col("c").alias("x"))
    between = found.join(label, "a", "left").join(label.withColumnsRenamed({"a": "b", "x": "y"}), "b", "left")
    moved = components(between.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    new = moved.select("s").join(classes.select("s"), "s", "left_anti").select("s", F.col("s").alias("c"))
    every = classes.select("s", "c").unionAll(new).join(moved.select(F.col("s").alias("c"), F.col("c").alias("to")), "c", "left")
    return stored(every.select("s", F.coalesce("to", "c").alias("c")), "components")
