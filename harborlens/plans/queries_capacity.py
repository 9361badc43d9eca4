"""B1-B6 bound to jobs, samples and pods.  Oracle parameters: poll step 1 hour,
cooldown 2 hours, utilisation width 1 hour (the defaults are 10 s, 60 s, 15 s)."""

from __future__ import annotations

from harborlens.operators import capacity as cap
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import bucket_end_sql, bucket_start_sql, with_bindings
from harborlens.plans.catalog import register

STEP_S = 3600
COOLDOWN_S = 7200
RECOVERY_THRESHOLD = 5
UTIL_WIDTH_S = 3600
NODE_CPU_M = 2000

_BACKLOG = f"""
, deltas AS (
  SELECT queue, {bucket_end_sql('arrived_ts', STEP_S)} AS poll_ts, 1 AS arr, 0 AS dn FROM jobs
  UNION ALL
  SELECT queue, {bucket_end_sql('done_ts', STEP_S)}, 0, 1 FROM jobs WHERE done_ts IS NOT NULL)
, per_poll AS (SELECT queue, poll_ts, sum(arr) AS arrived, sum(dn) AS done FROM deltas GROUP BY queue, poll_ts)
, grid AS (SELECT queue, unnest(generate_series(min(poll_ts), max(poll_ts), INTERVAL '{STEP_S} seconds')) AS poll_ts
           FROM per_poll GROUP BY queue)
, dense AS (SELECT g.queue, g.poll_ts, coalesce(p.arrived, 0) AS arrived, coalesce(p.done, 0) AS done
            FROM grid g LEFT JOIN per_poll p ON g.queue = p.queue AND g.poll_ts = p.poll_ts)
, backlog AS (SELECT queue, poll_ts, CAST(arrived AS BIGINT) AS arrived, CAST(done AS BIGINT) AS done,
  CAST(sum(arrived - done) OVER (PARTITION BY queue ORDER BY poll_ts
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS backlog FROM dense)"""

DEMAND_SQL = _BACKLOG + f"""
, recent AS (SELECT *, max(backlog) OVER (PARTITION BY queue ORDER BY CAST(epoch(poll_ts) AS BIGINT)
             RANGE BETWEEN {COOLDOWN_S - 1} PRECEDING AND CURRENT ROW) AS recent FROM backlog)
, demand AS (SELECT queue, poll_ts, backlog,
  CAST(greatest(least(greatest(CAST(ceil(backlog / 5) AS INTEGER), 0), 5),
                CASE WHEN recent > 0 THEN 1 ELSE 0 END) AS INTEGER) AS replicas FROM recent)"""


def _backlog(t):
    return cap.backlog_series(b.jobs(t), step_s=STEP_S)


def _demand(t):
    return cap.replica_demand(_backlog(t), per=5, lo=0, hi=5, cooldown_s=COOLDOWN_S)


@register("backlog_series", with_bindings(_BACKLOG + "\nSELECT * FROM backlog", "jobs"))
def q_backlog_series(t):
    """B1 per queue, hourly polls."""
    return _backlog(t)


@register("replica_demand", with_bindings(DEMAND_SQL + "\nSELECT * FROM demand", "jobs"))
def q_replica_demand(t):
    """B2: 5 messages per worker, 0..5 workers, 2 h cooldown."""
    return _demand(t)


@register("scaling_stability", with_bindings(DEMAND_SQL + """
, s1 AS (SELECT queue, poll_ts, replicas - lag(replicas) OVER (PARTITION BY queue ORDER BY poll_ts) AS delta
         FROM demand)
, s2 AS (SELECT *, CASE WHEN delta <> 0 THEN sign(delta) END AS sgn FROM s1)
, s3 AS (SELECT *, last_value(sgn IGNORE NULLS) OVER (PARTITION BY queue ORDER BY poll_ts
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_sign FROM s2)
SELECT queue, date_trunc('day', poll_ts) AS window_start, count(*) AS polls,
  count(*) FILTER (WHERE delta <> 0) AS scale_changes, count(*) FILTER (WHERE sgn <> prev_sign) AS reversals
FROM s3 GROUP BY 1, 2""", "jobs"))
def q_scaling_stability(t):
    """B3 per queue and day."""
    return cap.scaling_stability(_demand(t), window="1 day")


@register("backlog_recovery", with_bindings(_BACKLOG + f"""
, s AS (SELECT queue, poll_ts, backlog, lead(poll_ts) OVER (PARTITION BY queue ORDER BY poll_ts) AS next_ts,
        backlog > {RECOVERY_THRESHOLD} AS above,
        row_number() OVER (PARTITION BY queue ORDER BY poll_ts) AS rn FROM backlog)
, isl AS (SELECT *, rn - row_number() OVER (PARTITION BY queue ORDER BY poll_ts) AS grp FROM s WHERE above)
, ep AS (SELECT queue, min(poll_ts) AS start_ts, max(poll_ts) AS last_above_ts, CAST(max(backlog) AS BIGINT) AS peak,
         count(*) AS polls_above, CASE WHEN count(next_ts) = count(*) THEN max(next_ts) END AS recovered_ts
         FROM isl GROUP BY queue, grp)
SELECT queue, start_ts, last_above_ts, peak, polls_above, recovered_ts,
  CAST(floor((epoch_us(recovered_ts) - epoch_us(start_ts)) / 1000000) AS DOUBLE) AS recovery_s FROM ep""", "jobs"))
def q_backlog_recovery(t):
    """Episodes with more than 5 messages waiting."""
    out = cap.backlog_recovery(_backlog(t), threshold=RECOVERY_THRESHOLD)
    return out.withColumn("recovery_s", out["recovery_s"].cast("double"))


@register("utilisation", with_bindings(f"""
, per_node AS (SELECT {bucket_start_sql('ts', UTIL_WIDTH_S)} AS window_start, node,
               (sum(cpu_m) * 1000000 * 2 + count(*)) // (count(*) * 2) AS mean_u,
               CAST({NODE_CPU_M} AS BIGINT) AS capacity_m FROM samples GROUP BY 1, 2)
, r AS (SELECT window_start, node, grouping(node) = 1 AS is_total, CAST(sum(mean_u) AS BIGINT) AS mean_u,
        CAST(sum(capacity_m) AS BIGINT) AS capacity_m
        FROM per_node GROUP BY ROLLUP (window_start, node) HAVING grouping(window_start) = 0)
SELECT window_start, node, is_total, mean_u / 1000000 AS mean_m, capacity_m,
  ((mean_u * 2 + capacity_m) // (capacity_m * 2)) / 1000000 AS utilisation FROM r""", "samples"))
def q_utilisation(t):
    """2000 m per node, hourly windows."""
    return cap.utilisation(b.samples(t), capacity=NODE_CPU_M, width_s=UTIL_WIDTH_S)


@register("capacity_gap", with_bindings(f"""
, req AS (SELECT namespace, CAST(coalesce(sum(CASE WHEN req_cpu LIKE '%m' THEN ceil(CAST(rtrim(req_cpu, 'm') AS DOUBLE))
                                                  ELSE ceil(CAST(req_cpu AS DOUBLE) * 1000) END), 0) AS BIGINT) AS requested_m
          FROM (SELECT namespace, CASE WHEN NOT init THEN req_cpu END AS req_cpu FROM containers) GROUP BY namespace)
, n AS (SELECT *, CAST(least(greatest(ceil(requested_m / {NODE_CPU_M}), 1), 2) AS INTEGER) AS nodes FROM req)
SELECT namespace, requested_m, nodes, CAST(greatest(requested_m - nodes * {NODE_CPU_M}, 0) AS BIGINT) AS unmet_m
FROM n""", "containers"))
def q_capacity_gap(t):
    """Namespace as node group, 1..2 nodes of 2000 m."""
    return cap.capacity_gap(b.pod_heads(t), min_nodes=1, max_nodes=2, node_cpu_m=NODE_CPU_M, containers=b.container_rows(t))
