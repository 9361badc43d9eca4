"""R3 by digest trees: R3's verdicts, and work that follows the damage."""

import random

import pytest
from pyspark.sql import functions as F

from harborlens.operators import damage
from harborlens.operators.recovery import restore_verify

SCHEMA = "k long, ns string, v double, tags map<string,string>, leaf long, node string"


def verdicts(df, key="k"):
    keys = [key] if isinstance(key, str) else key
    return sorted(((tuple(r[c] for c in keys), r.status) for r in df.collect()), key=repr)


def rows(seed, n=400):
    g = random.Random(seed)
    out = [(g.choice([None, g.randint(0, n)]) if g.random() < .1 else g.randint(0, n), g.choice(["a", "b", None]), g.choice([None, 0.0, 1.5, float("nan")]),
            g.choice([None, {}, {"x": "1", "y": None}]), g.choice([None, 3]), g.choice(["", None])) for _ in range(n)]
    return out + out[:20]


@pytest.mark.parametrize("seed,within,fan,depth", [(1, None, 16, 4), (2, "ns", 16, 4), (3, None, 2, 1), (4, ["ns"], 4, 3), (5, None, 3, 0)])
def test_verdicts_are_those_of_the_full_join(spark, seed, within, fan, depth):
    g = random.Random(seed + 50)
    before = rows(seed)
    after = [r for r in before if g.random() > .1]
    after = [(r[0], r[1], 9.0, *r[3:]) if g.random() < .1 else (r[0], "moved", *r[2:]) if g.random() < .05 else r for r in after] + rows(seed + 9, 15)
    g.shuffle(after)
    x, y = (spark.createDataFrame(d, SCHEMA) for d in (before, after))
    for key in ("k", ["k", "ns"])[:1 + (seed == 2)]:
        want = verdicts(restore_verify(x, y, key).where("status <> 'same'"), key)
        assert verdicts(damage.restore_damage(x, y, key, within, fan=fan, depth=depth), key) == want and len(want) > 20


def test_equal_tables_stop_at_the_root(spark):
    x = spark.createDataFrame(rows(7), SCHEMA)
    seen = []
    assert damage.restore_damage(x, x.repartition(5), "k", seen=seen).count() == 0
    assert seen == [(0, 1, 0)]
    seen = []
    assert damage.restore_damage(x.limit(0), x.limit(0), "k", seen=seen).count() == 0 and seen == [(0, 0, 0)]
    assert verdicts(damage.restore_damage(x.limit(0), x, "k")) == verdicts(restore_verify(x.limit(0), x, "k"))


def test_stored_tree_and_added_columns(spark, scratch):
    x = spark.createDataFrame(rows(8), SCHEMA)
    y = x.where("k > 30 OR k IS NULL")
    damage.write_tree(damage.digest_tree(x, "k"), f"{scratch}/tree")
    tree = damage.read_tree(spark, f"{scratch}/tree")
    assert verdicts(damage.restore_damage(x, y, "k", tree_before=tree)) == verdicts(restore_verify(x, y, "k").where("status <> 'same'"))
    wider = y.withColumn("new", F.lit(None).cast("string"))
    assert verdicts(damage.restore_damage(x, wider, "k")) == verdicts(restore_verify(x, wider, "k").where("status <> 'same'"))
    other = y.withColumn("k", F.col("k").cast("int"))
    assert verdicts(damage.restore_damage(x, other, "k")) == verdicts(restore_verify(x, other, "k").where("status <> 'same'"))


def test_work_follows_the_damage(spark):
    """200,000 keys, 12 of them damaged, or one namespace of 500 lost: few nodes compared, few rows joined."""
    x = spark.range(200_000).select(F.col("id").alias("k"), F.concat(F.lit("ns"), F.floor(F.col("id") / 400)).alias("ns"), (F.col("id") * 2).alias("v"))
    y = x.withColumn("v", F.when(F.col("k") % 17_000 == 5, -1).otherwise(F.col("v")))
    seen, tree = [], {"fan": 16, "depth": 4}
    assert damage.restore_damage(x, y, "k", seen=seen, **tree).count() == 12
    assert [s[0] for s in seen] == [0, 1, 2, 3, 4] and all(c <= 16 * 12 and d <= 12 for _, c, d in seen)
    leaves, _ = damage.differing_leaves(damage.digest_tree(x, "k", **tree), damage.digest_tree(y, "k", **tree), **tree)
    assert damage.damaged_rows(x, leaves, "k", **tree).count() <= 12 * 20
    lost = x.where("ns <> 'ns77'")
    seen, whole = [], []
    assert damage.restore_damage(x, lost, "k", within="ns", seen=seen, **tree).count() == 400
    damage.restore_damage(x, lost, "k", seen=whole, **tree)
    assert sum(c for _, c, _ in seen) < sum(c for _, c, _ in whole) / 3                 # damage that lies together is found together
    leaves, _ = damage.differing_leaves(damage.digest_tree(x, "k", "ns", **tree), damage.digest_tree(lost, "k", "ns", **tree), **tree)
    assert damage.damaged_rows(x, leaves, "k", "ns", **tree).count() <= 400 * 20


def test_a_key_with_a_third_of_all_rows(spark):
    x = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    y = x.where("v <> 3 AND v <> 8")
    assert verdicts(damage.restore_damage(x, y, "k")) == [((7,), "changed"), ((8,), "missing")]
