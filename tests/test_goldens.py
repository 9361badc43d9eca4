"""Hand-derived goldens: pods, endpoints, tags, namespaces, scaling and job
rules taken from the platform's own manifests and scripts (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from harborlens.operators import capacity as cap
from harborlens.operators import events as ev
from harborlens.operators import inventory as inv
from harborlens.operators import policy as pol
from harborlens.operators import recovery as rec
from harborlens.plans import bindings as b
from harborlens.sources.tables import Tables
from tests.conftest import SF_MID

CONTAINER = ("struct<name:string,image:string,privileged:boolean,requests:struct<cpu:string,memory:string>,"
             "limits:struct<cpu:string,memory:string>>")
POD_SCHEMA = f"namespace string, pod string, containers array<{CONTAINER}>, initContainers array<{CONTAINER}>"


def c(image, privileged=None, req=(None, None), lim=(None, None)):
    return ("app", image, privileged, req, lim)


# The pods the platform's own files would run.
REFERENCE_PODS = [
    ("default", "sqs-worker", [c("amazon/aws-cli:2")], None),
    ("default", "cpu-hog", [c("registry.k8s.io/pause:3.10", req=("900m", "128Mi"))], None),
    ("demo-velero", "demo-velero", [c("hashicorp/http-echo:1.0.0")], None),
    ("demo-velero", "demo-velero-curl", [c("curlimages/curl:8.6.0")], None),
    ("demo-storage", "writer", [c("busybox:1.36")], None),
    ("demo-storage", "reader", [c("busybox:1.36")], None),
    ("demo-ingress", "web", [c("hashicorp/http-echo:1.0")], None),
    ("demo-tls", "echo", [c("hashicorp/http-echo:1.0")], None),
    ("demo-security", "bad-pod", [c("nginx:latest", privileged=True)], None),
    ("kube-system", "cluster-autoscaler", [c("registry.k8s.io/autoscaling/cluster-autoscaler:v1.30.0")], None),
    ("kube-system", "metrics-server", [c("registry.k8s.io/metrics-server/metrics-server:v0.7.2")], None),
]


def pods_df(spark, rows=REFERENCE_PODS):
    return spark.createDataFrame(rows, POD_SCHEMA)


def test_policy_goldens(spark):
    v = pol.policy_violations(pods_df(spark)).collect()
    assert len(v) == 11
    by_policy = {}
    for r in v:
        by_policy.setdefault(r.policy, set()).add(r.pod)
    assert by_policy["block-latest-tag"] == {"bad-pod"}
    assert by_policy["disallow-privileged"] == {"bad-pod"}
    assert len(by_policy["require-requests-limits"]) == 9
    assert not any(r.namespace == "kube-system" for r in v)
    pods_in_scope = {r.pod for r in v}
    assert len(pods_in_scope) == 9


def test_image_tag_rules(spark):
    rows = [("ns", "p1", [c("reg:5000/app")], None), ("ns", "p2", [c("reg:5000/app@sha256:ab")], None),
            ("ns", "p3", [c("reg:5000/app:v1")], None), ("ns", "p4", [c("nginx")], None),
            ("ns", "p5", [], None), ("ns", "p6", [c(None)], None)]
    got = {r.pod: r.violates for r in pol.check_pods(pods_df(spark, rows), "block-latest-tag").collect()}
    assert got == {"p1": True, "p2": False, "p3": False, "p4": True, "p5": False, "p6": False}


def test_privileged_readings(spark):
    rows = [("ns", "t", [c("a:1", privileged=True)], None), ("ns", "f", [c("a:1", privileged=False)], None),
            ("ns", "n", [c("a:1")], None), ("ns", "init", [c("a:1")], [c("b:1", privileged=True)])]
    df = pods_df(spark, rows)
    default = {r.pod: r.violates for r in pol.check_pods(df, "disallow-privileged").collect()}
    strict = {r.pod: r.violates for r in pol.disallow_privileged(df, strict=True).collect()}
    assert default == {"t": True, "f": False, "n": False, "init": True}
    assert strict == {"t": True, "f": True, "n": False, "init": True}


def test_require_resources_empty_and_null(spark):
    rows = [("ns", "ok", [c("a:1", req=("1", "1Mi"), lim=("1", "1Mi"))], None),
            ("ns", "empty", [c("a:1", req=("1", ""), lim=("1", "1Mi"))], None),
            ("ns", "none", [], None)]
    got = {r.pod: r.violates for r in pol.check_pods(pods_df(spark, rows), "require-requests-limits").collect()}
    assert got == {"ok": False, "empty": True, "none": False}


ENDPOINT_RULES = [("s3", "Gateway", None), ("ecr.api", "Interface", True), ("ecr.dkr", "Interface", True),
                  ("sts", "Interface", True)]
PROVISIONED = [("s3", "Gateway", True), ("ecr.api", "Interface", True), ("ecr.dkr", "Interface", True),
               ("sts", "Interface", True)]


def endpoint_check(spark, actual):
    exp = spark.createDataFrame(ENDPOINT_RULES, "service string, want_type string, want_dns boolean")
    act = spark.createDataFrame(actual, "service string, type string, private_dns boolean")
    out = inv.expected_vs_actual(exp, act, key="service", rules={"want_type": "type", "want_dns": "private_dns"})
    return {r.service: (r.status, r.reason, r.n_actual) for r in out.collect()}


def test_endpoint_goldens(spark):
    assert all(v[0] == "PASS" for v in endpoint_check(spark, PROVISIONED).values())
    no_s3 = endpoint_check(spark, PROVISIONED[1:])
    assert no_s3["s3"] == ("FAIL", "missing", 0) and no_s3["sts"][0] == "PASS"
    s3_iface = endpoint_check(spark, [("s3", "Interface", False)] + PROVISIONED[1:])
    assert s3_iface["s3"][:2] == ("FAIL", "wrong_attr")
    ecr_dns = endpoint_check(spark, [PROVISIONED[0], ("ecr.api", "Interface", False)] + PROVISIONED[2:])
    assert ecr_dns["ecr.api"][:2] == ("FAIL", "wrong_attr")
    sts_twice = endpoint_check(spark, PROVISIONED + [("sts", "Interface", False)])
    assert sts_twice["sts"] == ("FAIL", "wrong_attr", 2)


def test_readiness_worst_status_wins(spark):
    checks = spark.createDataFrame([("a", "PASS"), ("a", "FAIL"), ("a", "INFO"), ("b", "INFO"), ("b", "PASS"),
                                    ("c", "INFO")], "group string, status string")
    got = {r.group: r.status for r in inv.readiness_rollup(checks).collect()}
    assert got == {"a": "FAIL", "b": "PASS", "c": "INFO"}


def test_terraform_tags_under_audit_filter_are_all_missing(spark):
    tags = [("Project", "platform-x"), ("Env", "dev"), ("Owner", "admin"), ("ManagedBy", "Terraform")]
    rows = [("ec2", "i-1", "running", tags), ("ebs", "vol-1", "in-use", tags), ("nat", "nat-1", "available", tags)]
    df = spark.createDataFrame(rows, "kind string, id string, state string, "
                                     "tags array<struct<Key:string,Value:string>>")
    got = inv.tag_scope(df, {"Project": "platform-x", "Environment": "dev"}).collect()
    assert {r.exclusion_reason for r in got} == {"missing_tag"}
    assert not any(r.in_scope for r in got)


def test_namespace_label_goldens(spark):
    names = ["default", "demo-storage", "demo-ingress", "demo-tls", "demo-velero", "demo-security",
             "kube-system", "kyverno", "cert-manager", "external-dns", "logging", "observability", "velero", "keda"]
    df = spark.createDataFrame([(n, {"team": "x"}) for n in names], "namespace string, labels map<string,string>")
    got = {r.namespace: r for r in pol.label_targets(df).collect()}
    assert got["default"].action == "labelled_explicit"
    assert {n for n, r in got.items() if r.action == "labelled_prefix"} == {
        "demo-storage", "demo-ingress", "demo-tls", "demo-velero", "demo-security"}
    assert {n for n, r in got.items() if r.action == "excluded"} == {
        "kube-system", "kyverno", "cert-manager", "external-dns", "logging", "observability"}
    assert got["velero"].action == "no_match" and got["keda"].action == "no_match"
    assert got["default"].carries_pss and not got["velero"].carries_pss
    assert '"team":"x"' in got["demo-tls"].labels_json and "enforce-version" in got["demo-tls"].labels_json


def test_label_overwrite(spark):
    df = spark.createDataFrame([("demo-a", {"pod-security.kubernetes.io/enforce": "privileged"})],
                               "namespace string, labels map<string,string>")
    r = pol.label_targets(df).first()
    assert '"pod-security.kubernetes.io/enforce":"baseline"' in r.labels_json


def test_replica_demand_goldens(spark):
    t0 = dt.datetime(2024, 1, 1)
    # backlog per 10 s poll; the first six polls hold zero (a whole 60 s cooldown)
    series = [0] * 7 + [0, 1, 5, 6, 20, 25, 30, 0]
    rows = [("q", t0 + dt.timedelta(seconds=10 * i), v) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "queue string, poll_ts timestamp_ntz, backlog bigint")
    got = [r.replicas for r in cap.replica_demand(df, per=5, lo=0, hi=5, cooldown_s=60).orderBy("poll_ts").collect()]
    assert got[:8] == [0] * 8
    assert got[8:14] == [1, 1, 2, 4, 5, 5]
    assert got[14] == 1  # zero, but the cooldown has not passed


def test_job_outcome_goldens(spark):
    t0 = dt.datetime(2001, 1, 1)
    s = dt.timedelta(seconds=1)
    rows = [("a", t0, "InProgress"), ("a", t0 + 599 * s, "Completed"),
            ("b", t0, "InProgress"), ("b", t0 + 500 * s, "Failed"),
            ("c", t0, "InProgress"), ("c", t0 + 600 * s, "PartiallyFailed"),
            ("d", t0, "InProgress"), ("d", t0 + 601 * s, "Completed"),
            ("e", t0, "InProgress")]
    df = spark.createDataFrame(rows, "job string, ts timestamp_ntz, phase string")
    at600 = {r.job: r.outcome for r in rec.job_outcome(df, t0 + 600 * s).collect()}
    assert at600 == {"a": "completed", "b": "failed", "c": "failed", "d": "timed_out", "e": "running"}
    at601 = {r.job: r.outcome for r in rec.job_outcome(df, t0 + 601 * s).collect()}
    assert at601["e"] == "timed_out"


def test_replica_consistency_figures(spark):
    t = Tables(spark, SF_MID)
    truth = t.events.select("user_id", F.col("value").cast("decimal(18,2)").alias("value"))
    got = {(r.replicas, r.mode): (r.keys, r.keys_differ)
           for r in ev.replica_consistency(b.deliveries(t), truth, replicas=(1, 2, 5)).collect()}
    assert got[(1, "naive")] == (150, 0)
    assert got[(2, "naive")] == (150, 150)
    assert got[(5, "naive")] == (150, 150)
    assert all(got[(n, "idempotent")] == (150, 0) for n in (1, 2, 5))


def test_duplicate_report_figures(spark):
    t = Tables(spark, SF_MID)
    got = {r.event_type: (r.deliveries, r.distinct_events, r.duplicates)
           for r in ev.duplicate_report(b.deliveries(t)).collect()}
    assert got == {"click": (2323, 2006, 317), "error": (2360, 2014, 346), "purchase": (2334, 1981, 353),
                   "signup": (2385, 2017, 368), "view": (2313, 1982, 331)}
