"""Workload policies and namespace labels.

Each policy is a Column predicate over a pod row (``containers`` and
``initContainers`` arrays of structs), evaluated with higher-order functions
(``exists``) in the JVM, next to the compiled expressions of the same stage.  Every container predicate is wrapped
in ``coalesce(..., false)`` so an unset field cannot turn into "no violation"
through NULL logic.  G4 evaluates all policies in one pass into an array of
violations and explodes it: one scan, no union of per-policy scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.functions.scalars import image_tag, merge_labels, sorted_map_json

# Policy names and messages, as the cluster policies state them.
POLICY_MESSAGES = {
    "block-latest-tag": "Image tags must not use ':latest'. Pin a version tag.",
    "require-requests-limits": "All containers must set cpu/memory requests and limits.",
    "disallow-privileged": "Privileged containers are not allowed (securityContext.privileged=true).",
}
# Namespaces the policies exclude.
POLICY_EXCLUDED_NAMESPACES = ("kube-system", "kyverno")


def _arr(col: str) -> Column:
    """A possibly absent container array as an empty one."""
    return F.coalesce(F.col(col), F.array())


def latest_tag(c: Column) -> Column:
    """A container's image tag is ``latest``."""
    return F.coalesce(image_tag(c["image"]) == "latest", F.lit(False))


def missing_resources(c: Column) -> Column:
    """A container lacks a non-empty cpu or memory in requests or limits
    (``?*`` = at least one character: NULL and '' both count)."""
    out = F.lit(False)
    for f in (c["requests"]["cpu"], c["requests"]["memory"], c["limits"]["cpu"], c["limits"]["memory"]):
        out = out | (F.coalesce(F.length(f), F.lit(0)) == 0)
    return out


def privileged(c: Column, strict: bool = False) -> Column:
    """A container is privileged; ``strict``: it sets the key at all."""
    return c["privileged"].isNotNull() if strict else F.coalesce(c["privileged"], F.lit(False))


def latest_tag_violation(containers: str = "containers") -> Column:
    """G1: some container runs an image whose tag is ``latest`` (a missing tag
    counts as latest; a digest reference is pinned; a registry port is no tag).
    Only ``containers`` are inspected, as the policy does."""
    return F.exists(_arr(containers), latest_tag)


def missing_resources_violation(containers: str = "containers") -> Column:
    """Some container lacks a cpu or memory request or limit."""
    return F.exists(_arr(containers), missing_resources)


def privileged_violation(containers: str = "containers", init: str = "initContainers",
                         strict: bool = False) -> Column:
    """Some container or init container is privileged.  Default: only
    ``privileged = true`` violates (what the policy message says); ``strict``:
    the key may not be set at all, so even ``false`` violates (literal anchor
    reading)."""
    return F.exists(_arr(containers), lambda c: privileged(c, strict)) | F.exists(_arr(init), lambda c: privileged(c, strict))


POLICIES = {
    "block-latest-tag": latest_tag_violation,
    "require-requests-limits": missing_resources_violation,
    "disallow-privileged": privileged_violation,
}


def with_verdicts(pods: DataFrame, containers: DataFrame | None = None, policies: Sequence[str] = tuple(POLICIES),
                  strict: bool = False) -> DataFrame:
    """(namespace, pod, one flag a policy) in either form of input.

    ``pods`` alone: nested pods with their container arrays.  With ``containers``
    (pod, init, image, privileged, requests, limits; one row a container) pods are
    (pod, namespace) rows; containers are reduced to one row of flags a pod
    map-side, however many a pod has, before they meet the pods."""
    def nested(p):
        return privileged_violation(strict=strict) if p == "disallow-privileged" else POLICIES[p]()

    if containers is None:
        return pods.select("namespace", "pod", *[nested(p).alias(p) for p in policies])
    c = F.struct("image", "privileged", "requests", "limits")
    main = ~F.coalesce(F.col("init"), F.lit(False))
    rules = {"block-latest-tag": main & latest_tag(c), "require-requests-limits": main & missing_resources(c),
             "disallow-privileged": privileged(c, strict)}
    flags = containers.groupBy("pod").agg(*[F.bool_or(rules[p]).alias(p) for p in policies])
    return (pods.select("namespace", "pod").join(flags, "pod", "left")
            .select("namespace", F.col("pod").cast("string").alias("pod"), *[F.coalesce(F.col(f"`{p}`"), F.lit(False)).alias(p) for p in policies]))


def check_pods(pods: DataFrame, policy: str, containers: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """One policy as a table: every pod with a ``violates`` flag."""
    return with_verdicts(pods, containers, [policy], strict).withColumnRenamed(policy, "violates")


def deny_latest(pods: DataFrame, containers: DataFrame | None = None) -> DataFrame:
    """G1 on every pod: ``namespace, pod, violates``."""
    return check_pods(pods, "block-latest-tag", containers)


def require_resources(pods: DataFrame, containers: DataFrame | None = None) -> DataFrame:
    """G2 on every pod: ``namespace, pod, violates``."""
    return check_pods(pods, "require-requests-limits", containers)


def disallow_privileged(pods: DataFrame, containers: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """G3 on every pod: ``namespace, pod, violates`` (``strict``: literal reading)."""
    return check_pods(pods, "disallow-privileged", containers, strict)


def _in_scope(exclude: Sequence[str]) -> Column:
    return ~F.col("namespace").isin(*exclude) if exclude else F.lit(True)


def policy_violations(pods: DataFrame, policies: Sequence[str] = tuple(POLICIES),
                      exclude: Sequence[str] = POLICY_EXCLUDED_NAMESPACES, strict: bool = False,
                      containers: DataFrame | None = None) -> DataFrame:
    """G4 long form: one row per (pod, violated policy) outside excluded namespaces."""
    verdicts = with_verdicts(pods.where(_in_scope(exclude)), containers, policies, strict)
    checks = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(POLICY_MESSAGES[p]).alias("message"),
                                F.col(f"`{p}`").alias("violates")) for p in policies])
    hits = F.filter(checks, lambda x: x["violates"])
    return verdicts.select("namespace", "pod", F.inline(F.transform(hits, lambda x: F.struct(x["policy"], x["message"]))))


def policy_report(pods: DataFrame, policies: Sequence[str] = tuple(POLICIES),
                  exclude: Sequence[str] = POLICY_EXCLUDED_NAMESPACES, strict: bool = False,
                  containers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(long rows, counts per policy and namespace) from one pass."""
    long = policy_violations(pods, policies, exclude, strict, containers)
    return long, policy_counts(long)


def policy_counts(violations: DataFrame) -> DataFrame:
    """G4 summary: violating pods per policy and namespace (the long form has
    one row per pod and violated policy, so a row count is a pod count)."""
    return violations.groupBy("policy", "namespace").agg(F.count(F.lit(1)).alias("violations"))


# The label set and defaults of the namespace labelling step.
PSS_PREFIX = "pod-security.kubernetes.io/"
PSS_DEFAULT_EXPLICIT = ("default",)
PSS_DEFAULT_PREFIXES = ("demo-",)
PSS_DEFAULT_EXCLUDE = ("kube-system", "kube-public", "kube-node-lease", "kyverno", "cert-manager",
                       "external-dns", "logging", "observability")


def pss_labels(enforce: str = "baseline", warn: str = "restricted", audit: str = "restricted",
               version: str = "latest") -> dict[str, str]:
    return {f"{PSS_PREFIX}enforce": enforce, f"{PSS_PREFIX}enforce-version": version,
            f"{PSS_PREFIX}warn": warn, f"{PSS_PREFIX}warn-version": version,
            f"{PSS_PREFIX}audit": audit, f"{PSS_PREFIX}audit-version": version}


def label_targets(namespaces: DataFrame, explicit: Sequence[str] = PSS_DEFAULT_EXPLICIT,
                  prefixes: Sequence[str] = PSS_DEFAULT_PREFIXES, exclude: Sequence[str] = PSS_DEFAULT_EXCLUDE,
                  labels: Mapping[str, str] | None = None, name: str = "namespace",
                  old: str = "labels") -> DataFrame:
    """Exclusion wins, then explicit names, then prefixes; chosen namespaces
    get the labels merged over their own (new values overwrite).  Returns each
    namespace with its ``action``, the resulting labels as sorted JSON and
    whether it now carries any enforce/warn/audit label."""
    labels = pss_labels() if labels is None else dict(labels)
    new = F.create_map(*[x for k, v in sorted(labels.items()) for x in (F.lit(k), F.lit(v))])
    n = F.col(name)
    by_prefix = F.lit(False)
    for p in prefixes:
        by_prefix = by_prefix | n.startswith(p)
    # first matching rule wins: exclusion, then explicit names, then prefixes
    rules = ([(n.isin(*exclude), "excluded")] if exclude else []) \
        + ([(n.isin(*explicit), "labelled_explicit")] if explicit else []) + [(by_prefix, "labelled_prefix")]
    action = F.when(*rules[0])
    for cond, value in rules[1:]:
        action = action.when(cond, value)
    action = action.otherwise("no_match")
    old_map = F.coalesce(F.col(old), F.create_map().cast("map<string,string>"))
    merged = F.when(action.startswith("labelled"), merge_labels(old_map, new)).otherwise(old_map)
    carries = F.exists(F.map_keys(merged),
                       lambda k: k.rlike(r"^pod-security\.kubernetes\.io/(enforce|warn|audit)$"))
    return namespaces.select(name, action.alias("action"), sorted_map_json(merged).alias("labels_json"),
                             carries.alias("carries_pss"))
