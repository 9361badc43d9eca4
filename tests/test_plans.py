"""Plan shape guarantees, checked on every catalog query, and behaviour when one
key holds a third of all rows."""

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from harborlens.operators import capacity as cap
from harborlens.operators import events as ev
from harborlens.operators import recovery as rec
from harborlens.plans import bindings as b
from harborlens.plans.catalog import all_oracles, all_queries
from harborlens.sources.tables import Tables
from tests.conftest import SF_SMALL
from tools.plan_audit import BAD, plan_text


@pytest.fixture(scope="module")
def plans(spark):
    qs = all_queries()
    return {name: plan_text(fn(spark, SF_SMALL)) for name, fn in qs.items()}


def test_no_plan_shape_that_does_not_scale(plans):
    bad = {name: [k for k, p in BAD.items() if re.search(p, text)] for name, text in plans.items()}
    assert {k: v for k, v in bad.items() if v} == {}


def test_scans_read_only_needed_columns(plans):
    # the widest driver table read anywhere is lineitem with 11 columns; no query reads all of any table
    for name, text in plans.items():
        for schema in re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*/(\w+)\.parquet\]\s*\n(?:.*\n)*?"
                                 r"ReadSchema: (struct<.*>)", text):
            table, cols = schema
            if table == "lineitem":
                assert cols.count(":") < 11, (name, cols)


def explained(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_retention_filter_reaches_the_scan(spark):
    text = explained(all_queries()["retain"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", text)


def test_first_per_key_aggregates_map_side(spark):
    text = explained(ev.dedup(b.deliveries(Tables(spark, SF_SMALL))))
    assert "partial_min_by" in text and "Window" not in text


def hot_rows(n_hot, n_cold):
    """A key holding a third of all rows next to many cold keys."""
    return [(0, i) for i in range(n_hot)] + [(1 + i, i) for i in range(n_cold)]


def test_dedup_with_a_hot_key(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, 1 + i % 3, t0 + dt.timedelta(seconds=i)) for k, i in hot_rows(20000, 40000)]
    df = spark.createDataFrame(rows, "event_id bigint, attempt int, delivered_ts timestamp_ntz").repartition(8)
    out = {r.event_id: (r.attempt, r.delivered_ts) for r in ev.dedup(df).collect()}
    assert len(out) == 40001 and out[0] == (1, t0)


def test_backlog_with_a_hot_queue(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot" if k == 0 else f"q{k % 50}", t0 + dt.timedelta(seconds=7 * i), t0 + dt.timedelta(seconds=7 * i + 90))
            for k, i in hot_rows(30000, 60000)]
    df = spark.createDataFrame(rows, "queue string, arrived_ts timestamp_ntz, done_ts timestamp_ntz").repartition(8)
    s = cap.backlog_series(df, step_s=60)
    text = explained(s)
    # raw rows are aggregated (partial, map-side) before any window runs
    assert text.index("Window") < text.index("partial_sum")
    hot = s.where("queue = 'hot'").agg(F.sum("arrived"), F.sum("done"), F.min("backlog")).first()
    assert hot[0] == 30000 and hot[1] == 30000 and hot[2] >= 0


def test_rpo_rto_with_a_hot_system_spreads_over_buckets(spark):
    t0 = dt.datetime(2024, 1, 1)
    d = dt.timedelta
    inc = spark.createDataFrame([(i, 0, t0 + d(minutes=17 * i)) for i in range(3000)],
                                "incident bigint, system bigint, ts timestamp_ntz")
    bk = spark.createDataFrame([(i, 0, t0 + d(minutes=17 * i - 5)) for i in range(0, 3000, 3)],
                               "backup bigint, system bigint, ts timestamp_ntz")
    rs = spark.createDataFrame([(i, 0, t0 + d(minutes=17 * i + 7)) for i in range(0, 3000, 2)],
                               "restore bigint, system bigint, ts timestamp_ntz")
    out = rec.rpo_rto(inc, bk, rs, bucket="1 hour")
    assert "Window" in explained(out) and "partitioning(system" in explained(out).replace("hashpartitioning(", "partitioning(")
    got = {r.incident: (r.rpo_s, r.rto_s) for r in out.collect()}
    for i in (0, 1, 2, 2999):
        last_b = max(j for j in range(0, 3000, 3) if 17 * j - 5 <= 17 * i)
        next_r = min((j for j in range(0, 3000, 2) if 17 * j + 7 > 17 * i), default=None)
        assert got[i][0] == (17 * (i - last_b) + 5) * 60.0
        assert got[i][1] == (None if next_r is None else (17 * (next_r - i) + 7) * 60.0)


def test_bounded_broadcast_respects_its_bound(spark):
    from harborlens.operators.joins import bounded_broadcast
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100000).withColumnRenamed("id", "k")
        rules = spark.range(50).withColumnRenamed("id", "k")
        small_side, ok = bounded_broadcast(rules, max_rows=50)
        assert ok and "BroadcastExchange" in explained(big.join(small_side, "k"))
        not_small, ok2 = bounded_broadcast(rules, max_rows=49)
        assert not ok2 and "BroadcastExchange" not in explained(big.join(not_small, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_no_row_caps_except_the_tail(plans):
    # a limit is allowed only where it is the feature: S5's `tail -n`
    for name, text in plans.items():
        capped = re.search(r"GlobalLimit|CollectLimit|LocalLimit|TakeOrderedAndProject|Sample", text)
        assert (capped is not None) == (name == "append_and_tail"), name
    for name, sql in all_oracles().items():
        capped = re.search(r"\bLIMIT\b|\bUSING SAMPLE\b|\bTABLESAMPLE\b", sql, re.I)
        assert (capped is not None) == (name == "append_and_tail"), name
