"""Cases that once went wrong: restore checks, ownership, API responses, sinks, late rows, hot keys, stray times."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from harborlens.operators import capacity as cap
from harborlens.operators import events as ev
from harborlens.operators import inventory as inv
from harborlens.operators import policy as pol
from harborlens.operators import recovery as rec
from harborlens.operators import sli
from harborlens.plans import bindings as b
from harborlens.sources import inventory_json as ij
from harborlens.streaming import dedup as sd
from harborlens.streaming import queue
from harborlens.streaming.sli_stream import sli_stream

T0 = dt.datetime(2024, 1, 1)


# ---------------------------------------------------------------- R3, R4, A6

def status(before, after):
    return {r.k: r.status for r in rec.restore_verify(before, after, "k").collect()}


def test_restore_tells_null_positions_apart(spark):
    ddl = "k bigint, a string, b string, m map<string,int>"
    before = spark.createDataFrame([(1, "x", None, {"p": 1, "q": 2}), (2, "x", "y", None), (None, "n", "n", {}), (4, "z", None, {"p": None})], ddl)
    after = spark.createDataFrame([(1, None, "x", {"q": 2, "p": 1}), (2, "x", "y", None), (None, "n", "n", {}), (5, "z", None, None)], ddl)
    assert status(before, after) == {1: "changed", 2: "same", None: "same", 4: "missing", 5: "extra"}
    assert set(status(before, before).values()) == {"same"}


def test_restore_sees_a_new_column_and_copies(spark):
    before = spark.createDataFrame([(1, "x")], "k bigint, a string")
    assert status(before, before.withColumn("more", F.lit(1))) == {1: "changed"}
    assert status(before, before.union(before)) == {1: "changed"}
    nested = spark.createDataFrame([(1, (None, "y"))], "k bigint, s struct<a:string,b:string>")
    swapped = spark.createDataFrame([(1, ("y", None))], "k bigint, s struct<a:string,b:string>")
    assert status(nested, swapped) == {1: "changed"}


def test_backups_expire_by_their_own_time(spark, scratch):
    o = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, namespace string")
    rec.backup_snapshot(o, ["a"], "short", T0, scratch, ttl="1h")
    rec.backup_snapshot(o, ["b"], "long", T0, scratch, ttl="720h0m0s")
    all_ = rec.read_backups(spark, scratch)
    gone = rec.expire_backups(all_, T0 + dt.timedelta(hours=2))
    assert {r.backup_name for r in gone.collect()} == {"short"}
    assert rec.ttl_seconds("7d") == 604800
    with pytest.raises(ValueError):
        rec.ttl_seconds("soon")


def test_upsert_leaves_what_nobody_owns(spark):
    want = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None), (6, "f")], "k bigint, v string")
    have = spark.createDataFrame([(1, "x", None), (2, "b", "me"), (4, None, None), (5, "e", "me"), (6, "f", "me")], "k bigint, v string, owner string")
    got = {r.k: r.action for r in inv.upsert_only_merge(want, have).collect()}
    assert got == {1: "not_owned", 2: "update", 3: "create", 4: "not_owned", 5: "retained", 6: "noop"}
    got = {r.k for r in inv.upsert_only_merge(want, have, domain=F.col("k") < 3).collect()}
    assert got == {1, 2}


# ------------------------------------------------------------------ S4, A1-A3

RESPONSES = {
    "ec2": {"Reservations": [{"ReservationId": "r", "Instances": [{"InstanceId": "i-1", "State": {"Name": "running"}, "InstanceType": "t3",
            "Placement": {"AvailabilityZone": "z"}, "Tags": [{"Key": "Project", "Value": "p1"}]}]}]},
    "ebs": {"Volumes": [{"VolumeId": "vol-1", "State": "available", "VolumeType": "gp3", "Size": 8, "AvailabilityZone": "z",
            "Tags": [{"Key": "Project", "Value": "p1"}]}]},
    "nat": {"NatGateways": [{"NatGatewayId": "nat-1", "State": "available", "SubnetId": "sub", "VpcId": "vpc",
            "NatGatewayAddresses": [{"PublicIp": "1.2.3.4"}], "Tags": [{"Key": "Project", "Value": "p1"}]}]},
    "elb": {"LoadBalancers": [{"LoadBalancerName": "lb", "Type": "network", "State": {"Code": "active"}, "Scheme": "internal",
            "DNSName": "lb.example", "VpcId": "vpc", "Tags": [{"Key": "Project", "Value": "p1"}]}]},
    "eks": {"clusters": ["c1"]},
    "rds": {"DBInstances": [{"DBInstanceIdentifier": "db", "DBInstanceStatus": None, "DBInstanceClass": "db.t3", "AllocatedStorage": 20,
            "AvailabilityZone": "z", "TagList": [{"Key": "Project", "Value": "p1"}]}]},
}


@pytest.fixture
def responses(spark, tmp_path):
    for kind, doc in RESPONSES.items():
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "page.json").write_text(json.dumps(doc, indent=2))
    return {k: ij.read_inventory(spark, str(tmp_path / k), k) for k in RESPONSES}


def test_responses_as_a_command_line_prints_them(responses):
    got = {r.kind: r for r in inv.resource_inventory(responses).collect()}
    assert set(got) == set(RESPONSES)
    assert (got["nat"].subnet, got["nat"].vpc, got["nat"].public_ip) == ("sub", "vpc", "1.2.3.4")
    assert (got["elb"].scheme, got["elb"].dns_name) == ("internal", "lb.example")
    assert (got["rds"].id, got["rds"].type, got["rds"].size_gb, got["rds"].az) == ("db", "db.t3", 20, "z")


def test_leaks_of_every_tagged_kind(spark, responses):
    scoped = inv.tag_scope(inv.resource_inventory(responses), {"Project": "p1"})
    reasons = {r.kind: r.exclusion_reason for r in scoped.collect()}
    assert reasons == {"ec2": None, "ebs": None, "nat": None, "elb": None, "eks": "missing_tag", "rds": "state"}   # NULL state: not live
    known = spark.createDataFrame([("ec2", "i-1")], "kind string, id string")
    assert {r.kind: r.leaked for r in inv.leak_report(scoped, known).collect()} == {"ebs": 1, "nat": 1, "elb": 1}


def test_truncated_page_is_not_lost(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(RESPONSES["ec2"], indent=1))
    (tmp_path / "b.json").write_text(json.dumps(RESPONSES["ec2"], indent=1)[:-40])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        inv.flatten_ec2(ij.read_inventory(spark, str(tmp_path), "ec2")).collect()
    assert inv.flatten_ec2(ij.read_inventory(spark, str(tmp_path), "ec2", strict=False)).count() == 1
    assert [r.file.endswith("b.json") for r in ij.rejected_pages(spark, str(tmp_path), "ec2").collect()] == [True]


def test_endpoint_check_end_to_end(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"VpcEndpoints": [
        {"VpcEndpointId": "vpce-1", "ServiceName": "s3", "VpcEndpointType": "Gateway", "State": "Available"},
        {"VpcEndpointId": "vpce-2", "ServiceName": "sts", "VpcEndpointType": "Interface", "State": "available", "PrivateDnsEnabled": True},
        {"VpcEndpointId": "vpce-3", "ServiceName": "ecr", "VpcEndpointType": "Interface", "State": "available", "PrivateDnsEnabled": False},
        {"VpcEndpointId": "vpce-4", "ServiceName": "sts", "VpcEndpointType": "Interface", "State": "pending", "PrivateDnsEnabled": True}]}, indent=2))
    seen = inv.flatten_endpoints(ij.read_inventory(spark, str(tmp_path), "endpoints"))
    want = spark.createDataFrame([("s3", "Gateway", "available", None), ("sts", "Interface", "available", True),
                                  ("ecr", "Interface", "available", True), ("logs", "Interface", "available", True)],
                                 "service string, want_type string, want_state string, want_dns boolean")
    rules = {"want_type": "type", "want_state": "state", "want_dns": "private_dns"}
    got = {r.service: (r.status, r.reason) for r in inv.expected_vs_actual(want, seen, "service", rules).collect()}
    assert got == {"s3": ("PASS", "ok"), "sts": ("FAIL", "wrong_attr"), "ecr": ("FAIL", "wrong_attr"), "logs": ("FAIL", "missing")}


# ------------------------------------------------------------------ E4, E5, E6

def late(spark, n=600):
    rows = [(i, 1 + (i % 9 == 0 and k), T0 + dt.timedelta(minutes=i, seconds=7 * k)) for i in range(n) for k in range(1 + (i % 9 == 0))]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "event_id bigint, attempt int, delivered_ts timestamp_ntz")


def test_slices_of_many_mixed_files_lose_nothing(spark, scratch):
    """Each file spans its slice's times, and there are far more files than cores."""
    d = late(spark)
    n = queue.feed_in_time_order(d.repartition(40), f"{scratch}/in", "delivered_ts", dt.timedelta(hours=3), lambda: queue.run_available(
        sd.dedup_stream(queue.queue_ingest(spark, f"{scratch}/in", d.schema)), f"{scratch}/out", f"{scratch}/ck"), reduce=lambda p: ev.dedup(p).select(*d.columns))
    assert n == 4
    got = sorted((r.event_id, r.attempt) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [(i, 1) for i in range(600)]


def test_stream_slis_equal_the_batch(spark, scratch):
    r = late(spark).select(F.lit("s").alias("service"), F.col("delivered_ts").alias("ts"), F.col("event_id").cast("double").alias("latency_ms"),
                           F.when(F.col("event_id") % 5 == 0, 500).otherwise(200).alias("status"))
    queue.feed_in_time_order(r.repartition(40), f"{scratch}/in", "ts", dt.timedelta(hours=2), lambda: queue.run_available(
        sli_stream(queue.queue_ingest(spark, f"{scratch}/in", r.schema), "1 hour", "1 minute"), f"{scratch}/out", f"{scratch}/ck"))
    got = spark.read.parquet(f"{scratch}/out")
    want = sli.latency_p95(r, "1 hour", exact=False)
    assert got.count() == 9   # the last hour is still open
    assert {(x.window_start.replace(tzinfo=None), x.requests, x.p95_ms) for x in got.collect()} <= {
        (x.window_start, x.requests, x.p95_ms) for x in want.collect()}


def test_sink_keeps_first_deliveries_and_rows_without_key(spark, scratch):
    sink = f"{scratch}/sink"
    t = lambda s: T0 + dt.timedelta(seconds=s)
    ddl = "event_id bigint, attempt int, delivered_ts timestamp_ntz"
    one = spark.createDataFrame([(1, 2, t(9)), (1, 1, t(3)), (None, 1, t(0)), (None, 1, t(0)), (2, 1, t(4))], ddl)
    two = spark.createDataFrame([(1, 3, t(20)), (3, 1, t(21)), (None, 1, t(0))], ddl)
    for batch_id, batch in ((0, one), (1, two), (1, two)):   # the second batch is replayed
        sd.idempotent_write(batch, sink, batch_id=batch_id, buckets=8)
    got = sorted((r.event_id or 0, r.attempt) for r in sd.read_sink(spark, sink).collect())
    assert got == [(0, 1), (0, 1), (0, 1), (1, 1), (2, 1), (3, 1)]


def test_sink_reads_only_its_buckets_and_refuses_another_shape(spark, scratch):
    sink = f"{scratch}/sink"
    rows = spark.range(200).select(F.col("id").alias("event_id"), F.lit(1).alias("attempt"), F.lit(T0).cast("timestamp_ntz").alias("delivered_ts"))
    sd.idempotent_write(rows, sink, batch_id=0, buckets=64)
    some = rows.where("event_id < 2").select(sd.bucket_of("event_id", 64).alias("b")).distinct()
    touched = [r.b for r in some.collect()]
    files = sd.read_buckets(spark, sink, touched, rows.schema).inputFiles()
    assert files and all(any(f"bucket={x}/" in f for x in touched) for f in files)
    bad = rows.withColumnRenamed("attempt", "tries").withColumn("attempt", F.lit("x"))
    with pytest.raises(ValueError, match="does not hold"):
        sd.idempotent_write(bad, sink, batch_id=1, buckets=64)


def test_consistency_uses_the_first_delivery(spark):
    rows = [(1, 7, 10, 1, T0), (1, 7, 99, 2, T0 + dt.timedelta(minutes=1)), (2, 8, 5, 1, T0)]
    d = spark.createDataFrame(rows, "event_id bigint, user_id bigint, value int, attempt int, delivered_ts timestamp_ntz")
    truth = spark.createDataFrame([(7, 10), (8, 5)], "user_id bigint, value int")
    out = ev.replica_consistency(d, truth)
    got = {(r.replicas, r.mode): r.keys_differ for r in out.collect()}
    assert got == {(1, "naive"): 0, (1, "idempotent"): 0, (2, "naive"): 1, (2, "idempotent"): 0, (5, "naive"): 1, (5, "idempotent"): 0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") <= 4


# ------------------------------------------------------------- M1, B1, G1-G4, B6

def test_exact_percentile_of_large_groups(spark):
    n = 30_000
    r = spark.range(n).select(F.lit("s").alias("service"), F.lit(T0).cast("timestamp_ntz").alias("ts"),
                              ((F.col("id") * 7919) % n).cast("double").alias("latency_ms"))
    r = r.union(spark.createDataFrame([("t", T0, float(x)) for x in (4, 1, 9, 9, 2)] + [("t", T0, None), ("u", T0, None)], r.schema))
    for q in (0.0, 0.5, 0.95, 0.999, 1.0):
        out = sli.latency_p95(r, "1 day", q=q)
        got = {x.service: x.p95_ms for x in out.collect()}
        small = sorted((4, 1, 9, 9, 2))
        at = q * 4
        want = small[int(at)] + (at - int(at)) * (small[min(4, int(at) + 1)] - small[int(at)])
        assert got["s"] == pytest.approx(q * (n - 1), abs=1e-6) and got["t"] == pytest.approx(want, abs=1e-6) and got["u"] is None
        assert "percentile(" not in out._jdf.queryExecution().executedPlan().toString()


def test_stray_time_does_not_make_one_huge_array(spark):
    rows = [("q", T0, T0 + dt.timedelta(seconds=35)), ("q", T0 + dt.timedelta(days=40), None), (None, T0, T0 + dt.timedelta(seconds=1))]
    jobs = spark.createDataFrame(rows, "queue string, arrived_ts timestamp_ntz, done_ts timestamp_ntz")
    out = cap.backlog_series(jobs, step_s=10)
    assert out.where("queue = 'q'").count() == 40 * 8640 + 1
    last = out.where("queue = 'q'").orderBy(F.desc("poll_ts")).first()
    assert (last.poll_ts, last.arrived, last.backlog) == (T0 + dt.timedelta(days=40, seconds=10), 1, 1)
    demand = cap.replica_demand(out)
    assert demand.where("replicas > 0 and queue = 'q'").agg(F.max("poll_ts")).first()[0] == last.poll_ts
    assert cap.backlog_recovery(out, threshold=0).where("queue = 'q'").count() == 2


def test_one_order_with_a_third_of_all_lines(spark):
    lines = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("pod"), (F.col("id") % 7 == 0).alias("init"),
        F.lit("r/app:latest").alias("image"), F.lit(None).cast("boolean").alias("privileged"),
        F.struct(F.lit("10m").alias("cpu"), F.lit("1Mi").alias("memory")).alias("requests"),
        F.struct(F.lit("10m").alias("cpu"), F.lit("1Mi").alias("memory")).alias("limits"))
    pods = spark.range(30_000).select(F.col("id").alias("pod"), F.lit("demo").alias("namespace"))
    out = pol.deny_latest(pods, lines)
    assert out.count() == 30_000 and out.where("pod = '1' and violates").count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "collect" not in plan
    main = lines.where(~F.col("init")).count()
    assert cap.capacity_gap(pods, containers=lines).first().requested_m == 10 * main


def test_nested_and_flat_pods_agree(spark):
    from harborlens.sources.tables import Tables
    from tests.conftest import SF_SMALL
    t = Tables(spark, SF_SMALL)
    flat = pol.policy_violations(b.pod_heads(t), containers=b.container_rows(t))
    nested = pol.policy_violations(b.pods(t))
    assert flat.exceptAll(nested).count() == 0 and nested.exceptAll(flat).count() == 0 and flat.count() > 0


def test_a6_a_null_key_is_one_key(spark):
    desired = spark.createDataFrame([(None, "x"), ("a", "1"), ("b", "2")], "k string, v string")
    actual = spark.createDataFrame([(None, "y", "me"), ("b", "2", "me"), ("c", "3", "you")], "k string, v string, owner string")
    got = {r.k: r.action for r in inv.upsert_only_merge(desired, actual).collect()}
    assert got == {None: "update", "a": "create", "b": "noop", "c": "retained"}
