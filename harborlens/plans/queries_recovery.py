"""R1-R6 bound to the object tables (orders), job phases and event-derived
incidents, backups and restores."""

from __future__ import annotations

import datetime as dt
import uuid

from harborlens.operators import damage
from harborlens.operators import recovery as rec
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import with_bindings
from harborlens.plans.catalog import register
from harborlens.session import scratch_path

BACKUP_NAME = "nightly"
BACKUP_AT = dt.datetime(2024, 1, 1)
BACKUP_NAMESPACES = ("1-URGENT", "2-HIGH")
RESTORE_NAMESPACES = ("1-URGENT",)
EXPIRE_AS_OF = dt.datetime(2024, 2, 10)
JOBS_AS_OF = dt.datetime(2001, 9, 1)
JOB_TIMEOUT_S = 600


def _ts(d: dt.datetime) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def _in(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)


def _snapshot(t):
    path = scratch_path(t.spark, f"backups-{uuid.uuid4().hex}")
    return rec.backup_snapshot(b.objects_before(t), BACKUP_NAMESPACES, BACKUP_NAME, BACKUP_AT, path)


_SNAP_SQL = f"""
, snap AS (SELECT k, namespace, v, {_ts(BACKUP_AT)} AS created_ts,
  {_ts(BACKUP_AT)} + INTERVAL '720 hours' AS expires_ts, '{BACKUP_NAME}' AS backup_name
  FROM objects_before WHERE namespace IN ({_in(BACKUP_NAMESPACES)}))"""


@register("backup_snapshot", with_bindings(_SNAP_SQL + "\nSELECT * FROM snap", "objects_before"))
def q_backup_snapshot(t):
    """Two priorities backed up as 'nightly' with a 720 h ttl, read back from storage."""
    return _snapshot(t).select("k", "namespace", "v", "created_ts", "expires_ts", "backup_name")


@register("restore_select", with_bindings(_SNAP_SQL + f"""
SELECT k, namespace, v FROM snap WHERE backup_name = '{BACKUP_NAME}' AND namespace IN ({_in(RESTORE_NAMESPACES)})""",
                                          "objects_before"))
def q_restore_select(t):
    """R2: one namespace restored from the 'nightly' backup."""
    return rec.restore_select(_snapshot(t), BACKUP_NAME, RESTORE_NAMESPACES).select("k", "namespace", "v")


@register("restore_verify", with_bindings("""
SELECT coalesce(b.k, a.k) AS k,
  CASE WHEN a.k IS NULL THEN 'missing' WHEN b.k IS NULL THEN 'extra'
    WHEN b.namespace IS NOT DISTINCT FROM a.namespace AND b.v IS NOT DISTINCT FROM a.v THEN 'same'
    ELSE 'changed' END AS status
FROM objects_before b FULL OUTER JOIN objects_after a ON a.k = b.k""", "objects_before", "objects_after"))
def q_restore_verify(t):
    """Before vs after the drill, per object key."""
    return rec.restore_verify(b.objects_before(t), b.objects_after(t), key="k")


@register("restore_damage", with_bindings("""
, j AS (SELECT coalesce(b.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' WHEN b.k IS NULL THEN 'extra'
    WHEN b.namespace IS NOT DISTINCT FROM a.namespace AND b.v IS NOT DISTINCT FROM a.v THEN 'same' ELSE 'changed' END AS status
  FROM objects_before b FULL OUTER JOIN objects_after a ON a.k = b.k)
SELECT k, status FROM j WHERE status <> 'same'""", "objects_before", "objects_after"))
def q_restore_damage(t):
    """R3 by digest trees: the damaged objects, the tree of the objects before stored beforehand, as a backup would."""
    before, after = b.objects_before(t), b.objects_after(t)
    path = scratch_path(t.spark, f"tree-{uuid.uuid4().hex}")
    damage.write_tree(damage.digest_tree(before, "k", within="namespace"), path)
    return damage.restore_damage(before, after, "k", within="namespace", tree_before=damage.read_tree(t.spark, path))


@register("expire_backups", with_bindings(f"""
SELECT backup, system, ts, expires_ts FROM backups_with_expiry WHERE expires_ts <= {_ts(EXPIRE_AS_OF)}""",
                                          "backups_with_expiry"))
def q_expire_backups(t):
    """Every backup's own expiry, as of 2024-02-10."""
    return rec.expire_backups(b.backups_with_expiry(t), EXPIRE_AS_OF).select("backup", "system", "ts", "expires_ts")


@register("job_outcome", with_bindings(f"""
, g AS (SELECT job, max(kind) AS kind, min(ts) AS start_ts,
    arg_max(phase, (ts, phase <> 'InProgress')) AS last_phase,
    min(ts) FILTER (WHERE phase IN ('Completed', 'Failed', 'PartiallyFailed')) AS end_ts,
    arg_min(phase, ts) FILTER (WHERE phase IN ('Completed', 'Failed', 'PartiallyFailed')) AS end_phase
  FROM phases GROUP BY job)
, d AS (SELECT *, (epoch_us(coalesce(end_ts, {_ts(JOBS_AS_OF)})) - epoch_us(start_ts)) / 1000000 AS duration_s FROM g)
SELECT job, kind, start_ts, end_ts, end_phase, last_phase, duration_s,
  CASE WHEN duration_s > {JOB_TIMEOUT_S} THEN 'timed_out' WHEN end_phase = 'Completed' THEN 'completed'
    WHEN end_phase IN ('Failed', 'PartiallyFailed') THEN 'failed' ELSE 'running' END AS outcome
FROM d""", "phases"))
def q_job_outcome(t):
    """600 s timeout, as of 2001-09-01, for backup and restore jobs."""
    return rec.job_outcome(b.phases(t), JOBS_AS_OF, timeout_s=JOB_TIMEOUT_S, carry=("kind",)).select(
        "job", "kind", "start_ts", "end_ts", "end_phase", "last_phase", "duration_s", "outcome")


@register("rpo_rto", with_bindings("""
, x AS (SELECT i.incident, i.system, i.ts,
    (SELECT max(b.ts) FROM backups b WHERE b.system = i.system AND b.ts <= i.ts) AS last_backup_ts,
    (SELECT min(r.ts) FROM restores r WHERE r.system = i.system AND r.ts > i.ts) AS first_restore_ts
  FROM incidents i)
SELECT incident, system, ts, last_backup_ts, first_restore_ts,
  (epoch_us(ts) - epoch_us(last_backup_ts)) / 1000000 AS rpo_s,
  (epoch_us(first_restore_ts) - epoch_us(ts)) / 1000000 AS rto_s FROM x""", "incidents", "backups", "restores"))
def q_rpo_rto(t):
    """Per incident, gap to the last backup and to the next restore."""
    return rec.rpo_rto(b.incidents(t), b.backups(t), b.restores(t))
