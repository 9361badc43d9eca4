"""
conservation, bounds, empty inputs, NULL keys, ties."""

import datetime as dt

from pyspark.sql import functions as F

from harborlens.operators import capacity as cap
from harborlens.operators import events as ev
from harborlens.operators import inventory as inv
from harborlens.operators import network as net
from harborlens.operators import recovery as rec
from harborlens.operators import sli
from harborlens.plans import bindings as b
from harborlens.sources.tables import Tables
from harborlens.streaming import admission
from tests.conftest import SF_SMALL


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedup_idempotent(spark):
    d = b.deliveries(Tables(spark, SF_SMALL))
    once = ev.dedup(d)
    assert sorted_rows(ev.dedup(once)) == sorted_rows(once)
    assert once.count() == d.select("event_id").distinct().count()


def test_dedup_first_delivery_wins_ties_by_attempt(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 2, t), (1, 1, t), (1, 3, t - dt.timedelta(seconds=1)), (2, 1, t), (None, 1, t), (None, 2, t)]
    df = spark.createDataFrame(rows, "event_id bigint, attempt int, delivered_ts timestamp_ntz")
    got = sorted((r.event_id or 0, r.attempt) for r in ev.dedup(df).collect())
    assert got == [(0, 1), (0, 2), (1, 3), (2, 1)]   # rows without a key are all kept


def test_restore_verify_self_is_same(spark):
    o = b.objects_before(Tables(spark, SF_SMALL))
    out = rec.restore_verify(o, o, "k")
    assert {r.status for r in out.select("status").distinct().collect()} == {"same"}
    assert out.count() == o.count()


def test_admission_conserves_pods(spark):
    p = b.pods(Tables(spark, SF_SMALL))
    admitted, denied = admission.split(p)
    assert admitted.count() + denied.count() == p.count()


def test_replica_demand_bounds(spark):
    j = b.jobs(Tables(spark, SF_SMALL))
    d = cap.replica_demand(cap.backlog_series(j, step_s=600), per=5, lo=0, hi=5, cooldown_s=1200)
    lo, hi = d.agg(F.min("replicas"), F.max("replicas")).first()
    assert 0 <= lo and hi <= 5


def test_backlog_never_negative_and_ends_at_zero(spark):
    j = b.jobs(Tables(spark, SF_SMALL))
    s = cap.backlog_series(j, step_s=3600)
    assert s.where("backlog < 0").count() == 0
    last = s.groupBy("queue").agg(F.max_by("backlog", "poll_ts").alias("b")).collect()
    assert all(r.b == 0 for r in last)


def test_inventory_kinds_sum_to_total(spark):
    inv_df = inv.resource_inventory(b.cloud_sources(Tables(spark, SF_SMALL)))
    per_kind = inv_df.groupBy("kind").count().collect()
    assert sum(r["count"] for r in per_kind) == inv_df.count()
    assert {r.kind for r in per_kind} == {"ec2", "ebs", "nat", "elb", "eks", "rds"}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "event_id bigint, user_id bigint, event_type string, "
                                      "value decimal(18,2), attempt int, delivered_ts timestamp_ntz")
    assert ev.duplicate_report(empty).count() == 0
    assert ev.dedup(empty).count() == 0
    req = spark.createDataFrame([], "service string, ts timestamp_ntz, latency_ms double, status int")
    assert sli.latency_p95(req).count() == 0 and sli.error_ratio(req).count() == 0


def test_alert_episode_broken_by_missing_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    h = dt.timedelta(hours=1)
    # breaches at hours 0,1 then no row at 2, breach at 3,4,5
    rows = [("s", t0 + i * h, 0.5) for i in (0, 1, 3, 4, 5)]
    df = spark.createDataFrame(rows, "service string, window_start timestamp_ntz, error_ratio double")
    eps = sorted((r.windows, r.start_ts) for r in sli.alert_episodes(df, 0.25, 2, 3600).collect())
    assert eps == [(2, t0), (3, t0 + 3 * h)]


def test_rpo_rto_ties_and_missing(spark):
    t = dt.datetime(2024, 1, 5, 12)
    d = dt.timedelta
    inc = spark.createDataFrame([(1, 7, t), (2, 8, t)], "incident bigint, system bigint, ts timestamp_ntz")
    bk = spark.createDataFrame([(10, 7, t), (11, 7, t - d(days=3))], "backup bigint, system bigint, ts timestamp_ntz")
    rs = spark.createDataFrame([(20, 7, t), (21, 7, t + d(days=2, seconds=5))],
                               "restore bigint, system bigint, ts timestamp_ntz")
    got = {r.incident: r for r in rec.rpo_rto(inc, bk, rs).collect()}
    assert got[1].rpo_s == 0.0 and got[1].rto_s == 2 * 86400 + 5.0
    assert got[2].rpo_s is None and got[2].rto_s is None


def test_cidr_longest_prefix_and_port(spark):
    rules = spark.createDataFrame([("wide", "10.0.0.0/8", None, "-1"), ("narrow", "10.1.2.0/24", 443, "tcp"),
                                   ("edge", "10.1.2.255/32", None, "-1")],
                                  "rule string, cidr string, port int, protocol string")
    flows = spark.createDataFrame([("10.1.2.3", 443, "tcp"), ("10.1.2.3", 80, "tcp"), ("10.1.2.255", 443, "tcp"), ("11.0.0.1", 443, "tcp"),
                                   ("10.1.2.0", 443, "tcp"), ("10.1.2.9", 443, "udp")], "src_ip string, port int, proto string")
    got = {(r.src_ip, r.port): r.rule for r in net.cidr_match(flows, rules, protocol="proto").collect()}
    assert got == {("10.1.2.3", 443): "narrow", ("10.1.2.3", 80): "wide", ("10.1.2.255", 443): "edge",
                   ("11.0.0.1", 443): None, ("10.1.2.0", 443): "narrow", ("10.1.2.9", 443): "wide"}
    odd = rules.union(spark.createDataFrame([("bare", "10.1.2.7", None, "-1"), ("bad", "nowhere", None, "-1")], rules.schema))
    got = {r.src_ip: r.rule for r in net.cidr_match(flows.union(spark.createDataFrame([("10.1.2.7", 443, "tcp")], flows.schema)), odd).collect()}
    assert got["10.1.2.7"] == "bare" and got["10.1.2.3"] == "wide"   # without a protocol column, only any-protocol rules match


def test_upsert_never_deletes(spark):
    t = Tables(spark, SF_SMALL)
    out = inv.upsert_only_merge(b.desired(t), b.actual(t))
    actions = {r.action for r in out.select("action").distinct().collect()}
    assert "delete" not in actions and {"create", "retained", "not_owned", "noop", "update"} <= actions


def test_assign_replica_spreads_and_moves_on_redelivery(spark):
    df = spark.range(2000).select(F.col("id").alias("key"), F.lit(1).alias("attempt"))
    r1 = ev.assign_replica(df, "key", "attempt", n=5)
    counts = [r["count"] for r in r1.groupBy("replica").count().collect()]
    assert len(counts) == 5 and min(counts) > 300
    r2 = ev.assign_replica(df.withColumn("attempt", F.lit(2)), "key", "attempt", n=5)
    moved = r1.join(r2.withColumnRenamed("replica", "r2"), "key").where("r2 = (replica + 1) % 5").count()
    assert moved == 2000


def test_retain_prunes_date_directories(spark, scratch):
    import contextlib
    import io
    r = b.requests(Tables(spark, SF_SMALL))
    sli.write_by_date(r, scratch)
    stored = spark.read.parquet(scratch)
    kept = sli.retain_partitioned(stored, keep="7 days", as_of=dt.datetime(2024, 1, 30))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        kept.explain()
    assert "PartitionFilters: [isnotnull(dt" in buf.getvalue()
    assert kept.count() == sli.retain(r, keep="7 days", as_of=dt.datetime(2024, 1, 30)).count()


def test_latency_resolution_and_pivoted_matrix(spark):
    t = Tables(spark, SF_SMALL)
    r = b.requests(t)
    exact = {(x.service, x.window_start): x.p95_ms for x in sli.latency_p95(r, width="1 day").collect()}
    coarse = {(x.service, x.window_start): x.p95_ms
              for x in sli.latency_p95(r, width="1 day", resolution=0.01).collect()}
    assert exact.keys() == coarse.keys()
    assert all(abs(exact[k] - coarse[k]) <= 0.01 for k in exact)
    flows = b.flows(t)
    long = net.traffic_matrix(flows)
    wide = net.traffic_matrix(flows, pivot_ports=[443, 5432])
    total_long = long.agg(F.sum("bytes")).first()[0]
    total_wide = wide.agg(F.sum(F.coalesce(F.col("443"), F.lit(0)) + F.coalesce(F.col("5432"), F.lit(0)))).first()[0]
    assert total_long == total_wide


def test_restore_leaves_volumes_out_unless_asked(spark):
    rows = [("k1", "ns1", "config", "nightly"), ("k2", "ns1", "volume", "nightly"), ("k3", "ns2", "config", "nightly"),
            ("k4", "ns1", "config", "weekly")]
    df = spark.createDataFrame(rows, "k string, namespace string, kind string, backup_name string")
    assert sorted(r.k for r in rec.restore_select(df, "nightly", ["ns1"]).collect()) == ["k1"]
    assert sorted(r.k for r in rec.restore_select(df, "nightly", ["ns1"], include_volumes=True).collect()) == ["k1", "k2"]


def test_upsert_domain_filter(spark):
    d = spark.createDataFrame([("a.example.com", "1"), ("b.other.org", "2")], "k string, v string")
    a = spark.createDataFrame([("b.other.org", "9", "me")], "k string, v string, owner string")
    out = inv.upsert_only_merge(d, a, domain=F.col("k").endswith(".example.com")).collect()
    assert [(r.k, r.action) for r in out] == [("a.example.com", "create")]


def test_admission_policy_subset(spark):
    p = b.pods(Tables(spark, SF_SMALL))
    _, denied_all = admission.split(p)
    _, denied_latest = admission.split(p, policies=("block-latest-tag",))
    assert 0 < denied_latest.count() < denied_all.count()


def test_append_and_tail_five_after_two_appends(spark, scratch):
    from harborlens.sources import logs
    recs = b.log_records(Tables(spark, SF_SMALL))
    first = recs.where("seq < 100")
    logs.append_lines(first, scratch)
    last5 = logs.append_and_tail(recs.where("seq >= 100"), scratch, 5)  # a second writer appends
    want = sorted(r.seq for r in recs.orderBy(F.col("seq").desc()).limit(5).collect())
    assert sorted(r.seq for r in last5.collect()) == want
    assert spark.read.parquet(scratch).count() == recs.count()
