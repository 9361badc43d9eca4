"""The platform's everyday checks as compositions of operators.

Each function returns named DataFrames; nothing runs until an action is taken,
so Catalyst plans every result on its own and shares scans where it can.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.operators import capacity, events, inventory, recovery


def readiness_check(expected: DataFrame, actual: DataFrame, key: str, rules: Mapping[str, str],
                    group: str | None = None) -> dict[str, DataFrame]:
    """Expected vs actual per item (A4), rolled up worst-first (A5)."""
    items = inventory.expected_vs_actual(expected, actual, key, rules)
    by = F.col(group) if group else F.lit("all")
    checks = items.select(by.alias("group"), "status")
    return {"items": items, "summary": inventory.readiness_rollup(checks, by="group")}


def resource_audit(sources: Mapping[str, DataFrame], tags: Mapping[str, str],
                   expected: DataFrame) -> dict[str, DataFrame]:
    """Inventory of all kinds (A1), tag scope with exclusion reasons (A2) and
    live resources nobody declared, by kind (A3)."""
    inv = inventory.resource_inventory(sources)
    scoped = inventory.tag_scope(inv, tags)
    return {"inventory": inv, "scope": scoped.drop("tags"),
            "leaks": inventory.leak_report(scoped, expected)}


def backup_restore_drill(before: DataFrame, after: DataFrame, key: str, namespaces: Sequence[str],
                         name: str, at: dt.datetime, path: str, status_rows: DataFrame | None = None,
                         as_of: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Back up the namespaces (R1), select them back (R2), compare the live
    table after the drill with the one before (R3) and, given job phases,
    the backup/restore job outcomes (R5)."""
    snap = recovery.backup_snapshot(before, namespaces, name, at, path)
    out = {"backup": snap, "restored": recovery.restore_select(snap, name, namespaces),
           "verify": recovery.restore_verify(before, after, key)}
    if status_rows is not None:
        out["jobs"] = recovery.job_outcome(status_rows, as_of or at)
    return out


def queue_drill(deliveries: DataFrame, jobs: DataFrame, step_s: int = 10, per: int = 5, lo: int = 0,
                hi: int = 5, cooldown_s: int = 60, by: str = "event_type") -> dict[str, DataFrame]:
    """Produce -> queue -> scale -> consume: backlog per poll (B1), workers
    wanted (B2) and their stability (B3), duplicates seen by consumers (E2) and
    what is left after dedup (E3)."""
    backlog = capacity.backlog_series(jobs, step_s=step_s)
    demand = capacity.replica_demand(backlog, per=per, lo=lo, hi=hi, cooldown_s=cooldown_s)
    return {"backlog": backlog, "demand": demand, "stability": capacity.scaling_stability(demand),
            "duplicates": events.duplicate_report(deliveries, by=by), "deduplicated": events.dedup(deliveries)}
