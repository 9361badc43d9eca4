"""SQL twins of ``harborlens.plans.bindings`` for the DuckDB oracle.

Each text is valid in DuckDB on the driver's views.  ``with_bindings`` puts the
needed ones in front of a query as CTEs, dependencies first.
"""

from __future__ import annotations

import re

BINDING_SQL: dict[str, str] = {
    "deliveries": """
SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, a AS attempt,
  ts + INTERVAL '5' MINUTE * (a - 1) AS delivered_ts
FROM events CROSS JOIN (VALUES (1),(2),(3)) r(a)
WHERE a = 1 OR (a = 2 AND event_id % 7 = 0) OR (a = 3 AND event_id % 35 = 0)""",
    "attempts": """
SELECT event_id, attempt, delivered_ts,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS outcome FROM deliveries""",
    "jobs": """
SELECT event_id, concat('q', CAST(user_id % 4 AS VARCHAR)) AS queue, ts AS arrived_ts,
  ts + INTERVAL '1' SECOND * CAST(floor(CAST(value AS DECIMAL(18,2)) * 60) AS BIGINT) AS done_ts
FROM events""",
    "requests": """
SELECT event_id, concat('svc', CAST(user_id % 4 AS VARCHAR)) AS service, ts, value AS latency_ms,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status FROM events""",
    "samples": """
SELECT ts, concat('node', CAST(user_id % 8 AS VARCHAR)) AS node,
  CAST(floor(CAST(value AS DECIMAL(18,2)) * 10) AS BIGINT) AS cpu_m FROM events""",
    "instances": """
SELECT c_custkey AS id, c_nationkey AS reservation,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'running' WHEN 'BUILDING' THEN 'pending'
    WHEN 'FURNITURE' THEN 'stopping' WHEN 'HOUSEHOLD' THEN 'stopped' ELSE 'terminated' END AS state,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'p1' END AS tag_project,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'main' ELSE 'dev' END AS tag_environment,
  CASE WHEN c_custkey % 2 = 0 THEN c_name END AS tag_name FROM customer""",
    "volumes": """
SELECT p_partkey AS id, p_type AS type, p_size AS size_gb,
  CASE WHEN p_partkey % 4 = 0 THEN 'available' ELSE 'in-use' END AS state FROM part""",
    "nat": """
SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'available' WHEN 1 THEN 'pending'
  WHEN 2 THEN 'deleting' ELSE 'deleted' END AS state FROM supplier""",
    "containers": """
SELECT o_orderkey AS pod,
  CASE o_custkey % 10 WHEN 0 THEN 'kube-system' WHEN 1 THEN 'kyverno' WHEN 2 THEN 'default'
    ELSE concat('demo-', CAST(o_custkey % 10 AS VARCHAR)) END AS namespace,
  CASE WHEN l_orderkey IS NULL THEN NULL
    WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN 'reg:5000/app:latest'
    WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN 'reg:5000/app'
    WHEN l_linenumber = 3 THEN 'reg:5000/app@sha256:ab'
    ELSE concat('reg:5000/app:v', CAST(l_linenumber AS VARCHAR)) END AS image, coalesce(l_linenumber = 7, FALSE) AS init,
  CASE WHEN l_linenumber = 2 AND l_linestatus = 'F' THEN TRUE WHEN l_linenumber = 3 THEN FALSE
    WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN TRUE END AS privileged,
  CASE WHEN l_linenumber <> 4 THEN concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), 'm') END AS req_cpu,
  CASE WHEN l_linenumber = 5 THEN '' ELSE '128Mi' END AS lim_mem
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "endpoints_expected": """
SELECT o_orderkey AS item, o_orderstatus AS want, CASE WHEN o_orderkey % 2 = 0 THEN 'Interface' END AS want_type,
  CASE WHEN o_orderkey % 5 = 0 THEN TRUE END AS want_dns FROM orders""",
    "endpoints_actual": """
SELECT l_orderkey AS item, l_linestatus AS attr, CASE WHEN l_linenumber < 7 THEN 'Interface' ELSE 'Gateway' END AS type,
  CASE WHEN l_linenumber <> 6 THEN l_returnflag <> 'R' END AS private_dns FROM lineitem""",
    "desired": """
SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 13 <> 0""",
    "actual": """
SELECT k, v, owner FROM records WHERE k % 3 <> 0""",
    "records": """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS v,
  CASE WHEN o_orderkey % 11 = 0 THEN 'other' WHEN o_orderkey % 23 <> 0 THEN 'me' END AS owner FROM orders""",
    "objects_before": """
SELECT o_orderkey AS k, o_orderpriority AS namespace, o_totalprice AS v FROM orders""",
    "objects_after": """
SELECT o_orderkey AS k, o_orderpriority AS namespace,
  CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v
FROM orders WHERE o_orderkey % 19 <> 0
UNION ALL SELECT -o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 1000 = 7""",
    "phases": """
SELECT o_orderkey AS job, CASE WHEN o_orderkey % 3 = 0 THEN 'restore' ELSE 'backup' END AS kind, o_orderdate AS ts,
  'InProgress' AS phase FROM orders
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'restore' ELSE 'backup' END, o_orderdate + INTERVAL '1' SECOND * (o_orderkey % 1200),
  CASE max(l_returnflag) WHEN 'R' THEN 'Completed' WHEN 'N' THEN 'PartiallyFailed' ELSE 'Failed' END
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 4 <> 0 GROUP BY o_orderkey, o_orderdate""",
    "incidents": """
SELECT event_id AS incident, user_id AS system, ts FROM events WHERE event_type = 'error'""",
    "backups": """
SELECT event_id AS backup, user_id AS system, ts FROM events WHERE event_type = 'purchase'""",
    "backups_with_expiry": """
SELECT *, CASE WHEN backup % 11 <> 0 THEN ts + INTERVAL '1' HOUR * (300 + backup % 900) END AS expires_ts FROM backups""",
    "restores": """
SELECT event_id AS restore, user_id AS system, ts FROM events WHERE event_type = 'signup'""",
    "flows": """
SELECT s_nationkey AS src, c_nationkey AS dst, CASE WHEN l_partkey % 2 = 0 THEN 443 ELSE 5432 END AS port,
  CASE WHEN l_suppkey % 5 = 0 THEN 'udp' ELSE 'tcp' END AS protocol, CAST(l_quantity AS BIGINT) AS bytes,
  concat('10.0.', CAST(l_partkey % 104 AS VARCHAR), '.', CAST(l_suppkey % 256 AS VARCHAR)) AS src_ip
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey""",
    "allow": """
SELECT DISTINCT x.src, x.dst, 443 AS port FROM (
  SELECT n_nationkey AS src, min(n_nationkey) OVER (PARTITION BY n_regionkey) AS dst FROM nation
  UNION ALL SELECT min(n_nationkey) OVER (PARTITION BY n_regionkey), n_nationkey FROM nation) x""",
    "expected_resources": """
SELECT 'ec2' AS kind, concat('i-', CAST(c_custkey AS VARCHAR)) AS id FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'ebs', concat('vol-', CAST(p_partkey AS VARCHAR)) FROM part WHERE p_size <= 25""",
    "inventory": """
SELECT 'ec2' AS kind, concat('i-', CAST(id AS VARCHAR)) AS id, state, 't3.medium' AS type,
  CAST(NULL AS BIGINT) AS size_gb, concat('zone-', CAST(reservation % 3 AS VARCHAR)) AS az, tag_name AS name,
  tag_project, tag_environment, NULL AS subnet, NULL AS vpc, NULL AS public_ip, NULL AS scheme, NULL AS dns_name FROM instances
UNION ALL SELECT 'ebs', concat('vol-', CAST(id AS VARCHAR)), state, type, CAST(size_gb AS BIGINT),
  concat('zone-', CAST(id % 3 AS VARCHAR)), CASE WHEN id % 2 = 0 THEN concat('data-', CAST(id AS VARCHAR)) END,
  CASE WHEN id % 3 <> 0 THEN 'p1' END, CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN 'main' ELSE 'dev' END,
  NULL, NULL, NULL, NULL, NULL FROM volumes
UNION ALL SELECT 'nat', concat('nat-', CAST(id AS VARCHAR)), state, NULL, NULL, NULL,
  CASE WHEN id % 2 = 0 THEN concat('gw-', CAST(id AS VARCHAR)) END, CASE WHEN id % 3 <> 0 THEN 'p1' END,
  CASE WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN 'main' ELSE 'dev' END,
  concat('subnet-', CAST(id % 4 AS VARCHAR)), 'vpc-1', concat('203.0.113.', CAST(id % 256 AS VARCHAR)), NULL, NULL FROM nat
UNION ALL SELECT 'elb', concat('lb-', n_name), CASE WHEN n_nationkey % 5 = 0 THEN 'failed' ELSE 'active' END,
  CASE WHEN n_regionkey % 2 = 0 THEN 'application' ELSE 'network' END, NULL, NULL, concat('lb-', n_name),
  CASE WHEN n_nationkey % 3 <> 0 THEN 'p1' END, CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 7 = 0 THEN 'main' ELSE 'dev' END,
  NULL, 'vpc-1', NULL, CASE WHEN n_nationkey % 2 = 0 THEN 'internal' ELSE 'internet-facing' END, concat('lb-', n_name, '.elb')
FROM nation
UNION ALL SELECT 'eks', concat('cluster-', lower(r_name)), 'ACTIVE', NULL, NULL, NULL, concat('cluster-', lower(r_name)),
  NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM region
UNION ALL SELECT 'rds', concat('db-', CAST(s_suppkey AS VARCHAR)), CASE WHEN s_acctbal < 0 THEN 'stopped' ELSE 'available' END,
  'db.t3.micro', CAST(20 + s_nationkey AS BIGINT), concat('zone-', CAST(s_suppkey % 3 AS VARCHAR)),
  concat('db-', CAST(s_suppkey AS VARCHAR)), CASE WHEN s_suppkey % 3 <> 0 THEN 'p1' END,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 7 = 0 THEN 'main' ELSE 'dev' END,
  NULL, NULL, NULL, NULL, NULL FROM supplier""",
    "log_records": """
SELECT doc_id AS seq, source AS namespace_name, text AS log FROM documents""",
    "namespaces": """
SELECT concat(CASE WHEN p_partkey % 3 = 0 THEN 'demo-' WHEN p_partkey % 3 = 1 THEN 'logging' ELSE 'team-' END,
  CASE WHEN p_partkey % 3 = 1 THEN '' ELSE CAST(p_partkey AS VARCHAR) END) AS namespace, p_brand AS old_enforce FROM part""",
}


def _deps(name: str) -> list[str]:
    body = BINDING_SQL[name]
    return [d for d in BINDING_SQL if d != name and re.search(rf"\b(?:FROM|JOIN)\s+{d}\b", body, re.I)]


def with_bindings(sql: str, *names: str) -> str:
    """``WITH <bindings> <sql>``; extra CTEs of the query itself may follow
    after a comma if ``sql`` starts with ``, name AS (...)``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({BINDING_SQL[n].strip()})" for n in order)
    sql = sql.strip()
    if sql.startswith(","):
        return f"WITH {ctes}{sql}"
    return f"WITH {ctes}\n{sql}"


def bucket_start_sql(col: str, step_s: int) -> str:
    """Start of the epoch-aligned ``step_s`` bucket holding ``col`` (DuckDB)."""
    us = int(step_s) * 1_000_000
    return f"make_timestamp(CAST(floor(epoch_us({col}) / {us}) * {us} AS BIGINT))"


def bucket_end_sql(col: str, step_s: int) -> str:
    """First epoch-aligned ``step_s`` boundary strictly after ``col`` (DuckDB)."""
    us = int(step_s) * 1_000_000
    return f"make_timestamp(CAST((floor(epoch_us({col}) / {us}) + 1) * {us} AS BIGINT))"
