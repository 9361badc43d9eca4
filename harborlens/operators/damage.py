"""R3 on large tables: where does the table after a restore differ from the one before?

Both sides are reduced to a tree of digests.  A leaf is a bucket of keys, its digest
the number of its rows and the sums of two 64-bit row hashes; the digests of a node's
children add up to its own, so a level is made from the one below by adding.  The tree
of the table before can be stored with its backup (``write_tree``), and so costs
nothing when a restore is verified.

The trees are compared from the root: a level's nodes are compared only where their
parents differ.  Rows are looked at again only in leaves that differ, and only those
go through R3's outer join, so what is shuffled after the leaves' digests grows with
the damage and not with the table.  Damage that lies together (a lost namespace) stays
together if ``within`` names the column it follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlens.operators.joins import bounded_broadcast
from harborlens.operators.recovery import comparable, restore_verify
from harborlens.session import materialised

FAN = 256
DEPTH = 2


def _names(x: str | Sequence[str] | None) -> list[str]:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


def leaf_of(schema: T.StructType, key: str | Sequence[str], within: str | Sequence[str] | None = None,
            fan: int = FAN, depth: int = DEPTH) -> Column:
    """Number of the leaf a row lies in.  With ``within``, the upper half of the levels follows those columns."""
    def spread(cols, nodes):
        return F.pmod(F.xxhash64(*[comparable(c, schema[c].dataType) for c in cols]), F.lit(nodes))

    if not _names(within):
        return spread(_names(key), fan ** depth)
    low = fan ** (depth - depth // 2)
    return spread(_names(within), fan ** (depth // 2)) * low + spread(_names(key), low)


def digest_tree(df: DataFrame, key: str | Sequence[str], within: str | Sequence[str] | None = None,
                fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """(level, node, n, d1, d2): level 0 is the root, level ``depth`` the leaves; nodes without rows are not there.

    One scan and one map-side combined aggregation to at most fan ** depth rows; the
    levels above come from those.  Column names and values enter the digests, NULLs
    told apart from values; the order of rows and columns does not."""
    values = [comparable(c, df.schema[c].dataType) for c in sorted(df.columns)]
    h = [F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)") for seed in (1, 2)]
    leaves = df.groupBy(leaf_of(df.schema, key, within, fan, depth).alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h[0]).alias("d1"), F.sum(h[1]).alias("d2"))
    every = F.array(*[F.struct(F.lit(level).alias("level"), F.expr(f"leaf div {fan ** (depth - level)}").alias("node")) for level in range(depth + 1)])
    rows = leaves.select(F.explode(every).alias("at"), "n", "d1", "d2").select("at.level", "at.node", "n", "d1", "d2")
    return rows.groupBy("level", "node").agg(F.sum("n").alias("n"), F.sum("d1").alias("d1"), F.sum("d2").alias("d2"))


def write_tree(tree: DataFrame, path: str) -> None:
    """Store a tree by level, so that a comparison reads the levels it comes to."""
    tree.repartition("level").write.mode("overwrite").partitionBy("level").parquet(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def differing_leaves(before: DataFrame, after: DataFrame, fan: int = FAN, depth: int = DEPTH) -> tuple[DataFrame | None, list[tuple[int, int, int]]]:
    """Leaves whose digests differ, None if there are none, and for each level reached (level, nodes compared, nodes that differ)."""
    parents, seen = None, []
    for level in range(depth + 1):
        sides = []
        for name, tree in (("b", before), ("a", after)):
            rows = tree.where(F.col("level") == level)
            if parents is not None:
                rows = rows.join(parents, F.expr(f"node div {fan}") == F.col("parent"), "left_semi")
            sides.append(rows.select("node", F.struct("n", "d1", "d2").alias(name)))
        both = sides[0].join(sides[1], "node", "full_outer").select("node", (~F.col("a").eqNullSafe(F.col("b"))).alias("differs"))
        both = materialised(both, f"tree-level-{level}")
        compared, differ = both.agg(F.count("*"), F.count_if("differs")).first()
        seen.append((level, compared, differ))
        if not differ:
            return None, seen
        nodes = both.where("differs").select(F.col("node").alias("parent"))
        parents, _ = bounded_broadcast(nodes)
    return nodes.select(F.col("parent").alias("leaf")), seen


def damaged_rows(df: DataFrame, leaves: DataFrame, key: str | Sequence[str], within: str | Sequence[str] | None = None,
                 fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """The rows of ``df`` in ``leaves``; a filter by scan while the leaves are few enough to be sent to every task."""
    few, _ = bounded_broadcast(leaves)
    name = "leaf"
    while name in df.columns:
        name += "_"
    few = few.withColumnRenamed("leaf", name)
    return df.join(few, leaf_of(df.schema, key, within, fan, depth) == F.col(name), "left_semi")


def restore_damage(before: DataFrame, after: DataFrame, key: str | Sequence[str], within: str | Sequence[str] | None = None,
                   tree_before: DataFrame | None = None, tree_after: DataFrame | None = None,
                   fan: int = FAN, depth: int = DEPTH, seen: list | None = None) -> DataFrame:
    """The keys that R3 calls ``missing``, ``extra`` or ``changed``, with that status.

    ``tree_before`` and ``tree_after`` are stored trees made with the same key, within,
    fan and depth.  ``seen`` receives what was compared at each level.  Sides that
    differ in a column's name or type differ everywhere, and sides that differ in a
    key's or ``within``'s type cannot share leaves: both go through R3 whole."""
    types = [{f.name: f.dataType for f in df.schema} for df in (before, after)]
    if types[0] != types[1]:
        return restore_verify(before, after, key).where("status <> 'same'")
    if tree_before is None:
        tree_before = materialised(digest_tree(before, key, within, fan, depth), "tree-before")
    if tree_after is None:
        tree_after = materialised(digest_tree(after, key, within, fan, depth), "tree-after")
    leaves, levels = differing_leaves(tree_before, tree_after, fan, depth)
    if seen is not None:
        seen.extend(levels)
    if leaves is None:
        return restore_verify(before.limit(0), after.limit(0), key)
    sides = [damaged_rows(df, leaves, key, within, fan, depth) for df in (before, after)]
    keys = _names(key)
    if not set(_names(within)) <= set(keys):
        # a key's rows can lie in several leaves, some of them unharmed: all rows of the keys found are looked at
        found = materialised(sides[0].select(*keys).unionAll(sides[1].select(*keys)).distinct(), "tree-keys")
        few, _ = bounded_broadcast(found.select(*[F.col(k).alias(f"found_{i}") for i, k in enumerate(keys)]))
        sides = [df.select(*[F.col(c) for c in keys], F.struct(*[F.col(c) for c in df.columns]).alias("whole"))
                 .join(few, _same(keys), "left_semi").select("whole.*") for df in (before, after)]
    return restore_verify(*sides, key).where("status <> 'same'")


def _same(keys: list[str]) -> Column:
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"found_{i}"))
    return on
