"""G1-G4 and G6 bound to pods (orders with their line items as containers) and
to namespaces (parts)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from harborlens.operators import policy as pol
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import with_bindings
from harborlens.plans.catalog import register


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_EXCL = ", ".join(_q(n) for n in pol.POLICY_EXCLUDED_NAMESPACES)

_PER_POD = """
, tagged AS (SELECT *, CASE WHEN image IS NULL OR image LIKE '%@%' THEN NULL
    WHEN regexp_extract(regexp_extract(image, '[^/]*$'), ':([^:@]+)$', 1) = '' THEN 'latest'
    ELSE regexp_extract(regexp_extract(image, '[^/]*$'), ':([^:@]+)$', 1) END AS tag FROM containers)
, per_pod AS (SELECT namespace, CAST(pod AS VARCHAR) AS pod,
    coalesce(bool_or(tag = 'latest' AND NOT init), FALSE) AS g1,
    coalesce(bool_or(image IS NOT NULL AND NOT init AND (coalesce(length(req_cpu), 0) = 0 OR coalesce(length(lim_mem), 0) = 0)),
             FALSE) AS g2,
    coalesce(bool_or(privileged), FALSE) AS g3
  FROM tagged GROUP BY namespace, pod)"""

_LONG = _PER_POD + "\n, long AS (" + "\n  UNION ALL ".join(
    f"SELECT namespace, pod, {_q(p)} AS policy, {_q(pol.POLICY_MESSAGES[p])} AS message FROM per_pod "
    f"WHERE {g} AND namespace NOT IN ({_EXCL})"
    for p, g in zip(pol.POLICIES, ("g1", "g2", "g3"))) + ")"


@register("deny_latest", with_bindings(_PER_POD + "\nSELECT namespace, pod, g1 AS violates FROM per_pod",
                                       "containers"))
def q_deny_latest(t):
    """G1 on every pod."""
    return pol.deny_latest(b.pod_heads(t), b.container_rows(t))


@register("require_resources", with_bindings(_PER_POD + "\nSELECT namespace, pod, g2 AS violates FROM per_pod",
                                             "containers"))
def q_require_resources(t):
    """G2 on every pod."""
    return pol.require_resources(b.pod_heads(t), b.container_rows(t))


@register("disallow_privileged", with_bindings(_PER_POD + "\nSELECT namespace, pod, g3 AS violates FROM per_pod",
                                               "containers"))
def q_disallow_privileged(t):
    """G3 (default reading: only privileged=true violates) on every pod."""
    return pol.disallow_privileged(b.pod_heads(t), b.container_rows(t))


@register("policy_violations", with_bindings(_LONG + "\nSELECT * FROM long", "containers"))
def q_policy_violations(t):
    """G4 long rows outside kube-system and kyverno."""
    return pol.policy_violations(b.pod_heads(t), containers=b.container_rows(t))


@register("policy_counts", with_bindings(_LONG + """
SELECT policy, namespace, count(*) AS violations FROM long GROUP BY policy, namespace""", "containers"))
def q_policy_counts(t):
    """G4 counts per policy and namespace."""
    return pol.policy_report(b.pod_heads(t), containers=b.container_rows(t))[1]


_LABELLED_JSON = json.dumps(dict(sorted(pol.pss_labels().items())), separators=(",", ":"))
_ENFORCE_KEY = pol.PSS_PREFIX + "enforce"


@register("label_targets", with_bindings(f"""
, a AS (SELECT namespace, old_enforce,
  CASE WHEN namespace IN ({", ".join(_q(n) for n in pol.PSS_DEFAULT_EXCLUDE)}) THEN 'excluded'
    WHEN namespace IN ({", ".join(_q(n) for n in pol.PSS_DEFAULT_EXPLICIT)}) THEN 'labelled_explicit'
    WHEN {" OR ".join(f"starts_with(namespace, {_q(p)})" for p in pol.PSS_DEFAULT_PREFIXES)} THEN 'labelled_prefix'
    ELSE 'no_match' END AS action FROM namespaces)
SELECT namespace, action,
  CASE WHEN action LIKE 'labelled%' THEN {_q(_LABELLED_JSON)}
    ELSE '{{"{_ENFORCE_KEY}":"' || old_enforce || '"}}' END AS labels_json,
  TRUE AS carries_pss
FROM a""", "namespaces"))
def q_label_targets(t):
    """G6 with the labelling script's defaults; existing enforce label from the part brand."""
    ns = b.namespaces(t).select("namespace", F.create_map(F.lit(_ENFORCE_KEY), F.col("old_enforce")).alias("labels"))
    return pol.label_targets(ns)
