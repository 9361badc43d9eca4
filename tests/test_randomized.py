"""Randomised checks against brute force in plain Python on small inputs."""

import datetime as dt
import ipaddress
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harborlens.operators import capacity as cap
from harborlens.operators import events as ev
from harborlens.operators import network as net
from harborlens.operators import recovery as rec
from harborlens.operators import sli

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

events_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3 * 86400)), min_size=0, max_size=25)


@SETTINGS
@given(inc=events_st, bk=events_st, rs=events_st, bucket_h=st.sampled_from([1, 6, 24]))
def test_rpo_rto_matches_brute_force(spark, inc, bk, rs, bucket_h):
    def df(rows, name):
        return spark.createDataFrame([(i, s, T0 + dt.timedelta(seconds=x)) for i, (s, x) in enumerate(rows)],
                                     f"{name} bigint, system bigint, ts timestamp_ntz")
    out = rec.rpo_rto(df(inc, "incident"), df(bk, "backup"), df(rs, "restore"), bucket=f"{bucket_h} hours")
    got = {r.incident: (r.rpo_s, r.rto_s) for r in out.collect()}
    want = {}
    for i, (s, x) in enumerate(inc):
        last_b = max((y for t, y in bk if t == s and y <= x), default=None)
        next_r = min((y for t, y in rs if t == s and y > x), default=None)
        want[i] = (None if last_b is None else float(x - last_b), None if next_r is None else float(next_r - x))
    assert got == want


@SETTINGS
@given(jobs=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20 * 3600), st.integers(0, 5 * 3600)),
                     min_size=1, max_size=30))
def test_backlog_series_matches_brute_force(spark, jobs):
    rows = [(f"q{q}", T0 + dt.timedelta(seconds=a), T0 + dt.timedelta(seconds=a + d)) for q, a, d in jobs]
    df = spark.createDataFrame(rows, "queue string, arrived_ts timestamp_ntz, done_ts timestamp_ntz")
    got = {(r.queue, r.poll_ts): r.backlog for r in cap.backlog_series(df, step_s=3600).collect()}
    for (q, poll), backlog in got.items():
        want = sum(1 for qq, a, d in rows if qq == q and a < poll) - sum(1 for qq, a, d in rows if qq == q and d < poll)
        assert backlog == want
    for q in {r[0] for r in rows}:
        polls = sorted(p for qq, p in got if qq == q)
        assert all((b - a) == dt.timedelta(hours=1) for a, b in zip(polls, polls[1:]))


@SETTINGS
@given(flags=st.lists(st.booleans(), min_size=1, max_size=30), for_n=st.integers(1, 3))
def test_alert_episodes_match_brute_force(spark, flags, for_n):
    rows = [("s", T0 + dt.timedelta(hours=i), 0.9 if f else 0.1) for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "service string, window_start timestamp_ntz, error_ratio double")
    got = sorted((r.start_ts, r.windows) for r in sli.alert_episodes(df, 0.5, for_n, 3600).collect())
    want, run = [], None
    for i, f in enumerate(flags + [False]):
        if f and run is None:
            run = i
        elif not f and run is not None:
            if i - run >= for_n:
                want.append((T0 + dt.timedelta(hours=run), i - run))
            run = None
    assert got == want


cidr_st = st.tuples(st.integers(0, 3), st.integers(0, 255), st.sampled_from([8, 16, 20, 24, 28, 32]),
                    st.sampled_from([None, 443, 80]))


@SETTINGS
@given(rules=st.lists(cidr_st, min_size=1, max_size=8), ips=st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 255), st.integers(0, 255), st.sampled_from([443, 80])),
    min_size=1, max_size=20))
def test_cidr_match_matches_brute_force(spark, rules, ips):
    rule_rows = []
    for i, (b2, b3, p, port) in enumerate(rules):
        net_ = ipaddress.ip_network(f"10.{b2}.{b3}.0/{p}", strict=False)
        rule_rows.append((f"r{i}", str(net_), port, "-1"))
    flows = [(f"10.{a}.{b}.{c}", port) for a, b, c, port in ips]
    rdf = spark.createDataFrame(rule_rows, "rule string, cidr string, port int, protocol string")
    fdf = spark.createDataFrame(flows, "src_ip string, port int")
    got = sorted((r.src_ip, r.port, r.rule) for r in net.cidr_match(fdf, rdf).collect())
    want = []
    for ip, port in flows:
        cands = [(-ipaddress.ip_network(c).prefixlen, p is None, name) for name, c, p, _ in rule_rows
                 if ipaddress.ip_address(ip) in ipaddress.ip_network(c) and (p is None or p == port)]
        want.append((ip, port, min(cands)[2] if cands else None))
    assert got == sorted(want)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.integers(1, 3), st.integers(0, 600)), min_size=0, max_size=30))
def test_dedup_matches_brute_force(spark, rows):
    data = [(k, a, T0 + dt.timedelta(seconds=s)) for k, a, s in rows]
    df = spark.createDataFrame(data, "event_id bigint, attempt int, delivered_ts timestamp_ntz")
    got = sorted(tuple(r) for r in ev.dedup(df).collect())
    first = {}
    for k, a, ts in data:
        if k not in first or (ts, a) < (first[k][1], first[k][0]):
            first[k] = (a, ts)
    assert got == sorted((k, a, ts) for k, (a, ts) in first.items())


@SETTINGS
@given(backlog=st.lists(st.integers(0, 40), min_size=1, max_size=30), cooldown=st.sampled_from([10, 30, 60]))
def test_replica_demand_matches_formula(spark, backlog, cooldown):
    rows = [("q", T0 + dt.timedelta(seconds=10 * i), v) for i, v in enumerate(backlog)]
    df = spark.createDataFrame(rows, "queue string, poll_ts timestamp_ntz, backlog bigint")
    got = [r.replicas for r in cap.replica_demand(df, cooldown_s=cooldown).orderBy("poll_ts").collect()]
    for i, v in enumerate(backlog):
        raw = min(max(math.ceil(v / 5), 0), 5)
        recent = [backlog[j] for j in range(len(backlog)) if 0 <= 10 * (i - j) < cooldown]
        assert got[i] == max(raw, 1 if max(recent) > 0 else 0)


@SETTINGS
@given(jobs=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1200),
                               st.sampled_from([None, "Completed", "Failed", "PartiallyFailed"])),
                     min_size=1, max_size=12), as_of=st.integers(0, 1500))
def test_job_outcome_matches_brute_force(spark, jobs, as_of):
    rows = []
    for j, (start, after, phase) in enumerate(jobs):
        rows.append((f"j{j}", T0 + dt.timedelta(seconds=start), "InProgress"))
        if phase:
            rows.append((f"j{j}", T0 + dt.timedelta(seconds=start + after), phase))
    df = spark.createDataFrame(rows, "job string, ts timestamp_ntz, phase string")
    now = T0 + dt.timedelta(seconds=as_of)
    got = {r.job: r.outcome for r in rec.job_outcome(df, now, timeout_s=600).collect()}
    for j, (start, after, phase) in enumerate(jobs):
        dur = after if phase else (now - (T0 + dt.timedelta(seconds=start))).total_seconds()
        want = ("timed_out" if dur > 600 else "completed" if phase == "Completed"
                else "failed" if phase else "running")
        assert got[f"j{j}"] == want


@SETTINGS
@given(series=st.lists(st.integers(0, 12), min_size=1, max_size=30), threshold=st.integers(0, 8))
def test_backlog_recovery_matches_brute_force(spark, series, threshold):
    rows = [("q", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "queue string, poll_ts timestamp_ntz, backlog bigint")
    got = sorted((r.start_ts, r.polls_above, r.peak, r.recovery_s) for r in cap.backlog_recovery(df, threshold).collect())
    want, i = [], 0
    while i < len(series):
        if series[i] > threshold:
            j = i
            while j < len(series) and series[j] > threshold:
                j += 1
            rec_s = (j - i) * 3600 if j < len(series) else None
            want.append((T0 + dt.timedelta(hours=i), j - i, max(series[i:j]), rec_s))
            i = j
        else:
            i += 1
    assert got == want


@SETTINGS
@given(reps=st.lists(st.integers(0, 5), min_size=1, max_size=40))
def test_scaling_stability_matches_brute_force(spark, reps):
    rows = [("q", T0 + dt.timedelta(hours=i), r) for i, r in enumerate(reps)]
    df = spark.createDataFrame(rows, "queue string, poll_ts timestamp_ntz, replicas int")
    got = {r.window_start: (r.polls, r.scale_changes, r.reversals)
           for r in cap.scaling_stability(df, window="1 day").collect()}
    want, prev_sign = {}, None
    for i, r in enumerate(reps):
        day = (T0 + dt.timedelta(hours=i)).replace(hour=0)
        p, c, v = want.get(day, (0, 0, 0))
        delta = None if i == 0 else r - reps[i - 1]
        changed = delta is not None and delta != 0
        reversed_ = False
        if changed:
            sign = 1 if delta > 0 else -1
            reversed_ = prev_sign is not None and sign != prev_sign
            prev_sign = sign
        want[day] = (p + 1, c + changed, v + reversed_)
    assert got == want


@SETTINGS
@given(samples=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 7200), st.integers(0, 3000)),
                        min_size=1, max_size=30))
def test_utilisation_matches_brute_force(spark, samples):
    rows = [(f"n{n}", T0 + dt.timedelta(seconds=s), v) for n, s, v in samples]
    df = spark.createDataFrame(rows, "node string, ts timestamp_ntz, cpu_m bigint")
    got = {(r.window_start, r.node): (r.mean_m, r.utilisation) for r in cap.utilisation(df, 2000, 3600).collect()}
    groups = {}
    for node, ts, v in rows:
        w = ts.replace(minute=0, second=0)
        groups.setdefault((w, node), []).append(v)
    def half_up(num, den):  # the operator's documented rounding (Python's round() is half-to-even)
        return (2 * num + den) // (2 * den)

    per_node = {k: half_up(sum(v) * 10 ** 6, len(v)) for k, v in groups.items()}
    for (w, node), mean_u in per_node.items():
        assert abs(got[(w, node)][0] - mean_u / 1e6) < 1e-6
    for w in {k[0] for k in per_node}:
        tot = sum(u for (ww, _), u in per_node.items() if ww == w)
        cap_ = 2000 * sum(1 for (ww, _) in per_node if ww == w)
        assert abs(got[(w, None)][1] - half_up(tot, cap_) / 1e6) < 1e-9
