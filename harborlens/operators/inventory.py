"""Inventory, audit and reconciliation.

Scale notes.  A1 flattens API pages with generators (``inline``), which are
narrow: no shuffle.  A2 is a projection.  A3 and A6 join on the resource key
(shuffle on the key, or broadcast behind a row-count check when one side is a
rule list).  A4 pre-aggregates nothing it does not need: one join on the item
key, then one aggregation on the same key, so both share one partitioning.
A7 is an aggregate (``min_by``) with map-side combine; no window over raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.functions.scalars import missing_to_null, tag_value
from harborlens.operators.joins import bounded_broadcast

INVENTORY_COLUMNS = ("kind", "id", "state", "type", "size_gb", "az", "name", "tags", "subnet", "vpc", "public_ip", "scheme", "dns_name")
TAGS_TYPE = "array<struct<Key:string,Value:string>>"

# States in which a resource of a kind still exists and costs.
LIVE_STATES = {
    "ec2": ("pending", "running", "stopping", "stopped"),
    "nat": ("available", "pending"),
    "ebs": ("creating", "available", "in-use"),
    "elb": ("active", "provisioning", "active_impaired"),
    "eks": ("CREATING", "ACTIVE", "UPDATING"),
    "rds": ("creating", "available", "backing-up", "modifying", "stopping", "stopped", "starting"),
}


def _shape(df: DataFrame, kind: str, **cols: Column) -> DataFrame:
    out = [F.lit(kind).alias("kind")]
    for c in INVENTORY_COLUMNS[1:]:
        v = cols.get(c)
        if v is None:
            v = F.lit(None).cast(TAGS_TYPE if c == "tags" else ("bigint" if c == "size_gb" else "string"))
        elif c == "size_gb":
            v = v.cast("bigint")
        elif c != "tags":
            v = missing_to_null(v)   # empty, None and null texts are no value
        out.append(v.alias(c))
    return df.select(*out)


def flatten_ec2(pages: DataFrame) -> DataFrame:
    r = pages.select(F.inline("Reservations")).select(F.inline("Instances"))
    return _shape(r, "ec2", id=F.col("InstanceId"), state=F.col("State.Name"), type=F.col("InstanceType"),
                  az=F.col("Placement.AvailabilityZone"), name=tag_value("Tags", "Name"), tags=F.col("Tags"))


def flatten_ebs(pages: DataFrame) -> DataFrame:
    v = pages.select(F.inline("Volumes"))
    return _shape(v, "ebs", id=F.col("VolumeId"), state=F.col("State"), type=F.col("VolumeType"),
                  size_gb=F.col("Size"), az=F.col("AvailabilityZone"), name=tag_value("Tags", "Name"),
                  tags=F.col("Tags"))


def flatten_nat(pages: DataFrame) -> DataFrame:
    n = pages.select(F.inline("NatGateways"))
    return _shape(n, "nat", id=F.col("NatGatewayId"), state=F.col("State"), name=tag_value("Tags", "Name"), tags=F.col("Tags"),
                  subnet=F.col("SubnetId"), vpc=F.col("VpcId"), public_ip=F.get(F.col("NatGatewayAddresses.PublicIp"), 0))


def flatten_elb(pages: DataFrame) -> DataFrame:
    lb = pages.select(F.inline("LoadBalancers"))
    return _shape(lb, "elb", id=F.col("LoadBalancerName"), state=F.col("State.Code"), type=F.col("Type"),
                  name=F.col("LoadBalancerName"), tags=F.col("Tags"), vpc=F.col("VpcId"), scheme=F.col("Scheme"),
                  dns_name=F.col("DNSName"))


def flatten_eks(pages: DataFrame) -> DataFrame:
    c = pages.select(F.explode("clusters").alias("cluster"))
    return _shape(c, "eks", id=F.col("cluster"), state=F.lit("ACTIVE"), name=F.col("cluster"))


def flatten_rds(pages: DataFrame) -> DataFrame:
    d = pages.select(F.inline("DBInstances"))
    return _shape(d, "rds", id=F.col("DBInstanceIdentifier"), state=F.col("DBInstanceStatus"), type=F.col("DBInstanceClass"),
                  size_gb=F.col("AllocatedStorage"), az=F.col("AvailabilityZone"), name=F.col("DBInstanceIdentifier"),
                  tags=F.col("TagList"))


def flatten_endpoints(pages: DataFrame) -> DataFrame:
    """Network endpoints as A4 compares them: (service, id, type, state, private_dns)."""
    e = pages.select(F.inline("VpcEndpoints"))
    return e.select(F.col("ServiceName").alias("service"), F.col("VpcEndpointId").alias("id"), F.col("VpcEndpointType").alias("type"),
                    F.lower("State").alias("state"), F.col("PrivateDnsEnabled").alias("private_dns"))


FLATTENERS = {"ec2": flatten_ec2, "ebs": flatten_ebs, "nat": flatten_nat, "elb": flatten_elb,
              "eks": flatten_eks, "rds": flatten_rds}


def resource_inventory(sources: Mapping[str, DataFrame]) -> DataFrame:
    """A1: API responses of up to six kinds -> one table
    of ``INVENTORY_COLUMNS``; what a kind does not have is NULL.  ``sources`` maps a
    kind (ec2, ebs, nat, elb, eks, rds) to its pages in the API's nested shape."""
    parts = [FLATTENERS[k](df) for k, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def tag_scope(inventory: DataFrame, tags: Mapping[str, str], live_states: Mapping[str, Sequence[str]] | None = None
              ) -> DataFrame:
    """A2: in scope = every wanted tag present with the wanted value and a live
    state.  Out of scope rows keep an ``exclusion_reason``: ``missing_tag``,
    ``tag_mismatch`` or ``state`` (checked in that order), so a resource left
    out for lack of a tag key is reported, not silently skipped."""
    live_states = LIVE_STATES if live_states is None else live_states
    vals = {k: tag_value(F.coalesce(F.col("tags"), F.array().cast(TAGS_TYPE)), k) for k in tags}
    missing = F.lit(False)
    mismatch = F.lit(False)
    for k, want in tags.items():
        missing = missing | vals[k].isNull()
        mismatch = mismatch | (vals[k] != F.lit(want))
    live = F.lit(True)   # kinds without a list of states
    for kind, states in live_states.items():
        live = F.when(F.col("kind") == kind, F.coalesce(F.col("state").isin(*states), F.lit(False))).otherwise(live)
    reason = (F.when(missing, "missing_tag").when(mismatch, "tag_mismatch")
              .when(~live, "state"))
    return inventory.select("*", reason.alias("exclusion_reason")).withColumn(
        "in_scope", F.col("exclusion_reason").isNull())


def leak_report(inventory: DataFrame, expected: DataFrame, keys: Sequence[str] = ("kind", "id")) -> DataFrame:
    """A3: live in-scope resources that are not expected, counted by kind.
    ``left_anti`` (not ``NOT IN``): NULL-safe and a hash/sort-merge join."""
    live = inventory.where("in_scope") if "in_scope" in inventory.columns else inventory
    leaks = live.join(expected.select(*keys).distinct(), list(keys), "left_anti")
    return leaks.groupBy("kind").agg(F.count(F.lit(1)).alias("leaked"))


def expected_vs_actual(expected: DataFrame, actual: DataFrame, key: str, rules: Mapping[str, str],
                       broadcast_rows: int = 0) -> DataFrame:
    """A4: per expected item: ``missing`` (no actual row), ``wrong_attr`` (some
    actual row fails a rule) or ``ok``.  ``rules`` maps a wanted column of
    ``expected`` to the actual column it must equal (NULL want = any value).
    Every actual row counts, so two endpoints for one service where one is
    wrong fail the item (worst status wins); ``n_actual`` shows how many.

    Actual rows are first counted per (item, attribute values) with map-side
    partial aggregation, so an item with a huge number of actual rows arrives
    at the join as a few rows.  That side is computed, so its size is checked
    at run time: AQE turns the join into a broadcast when the measured shuffle
    output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps
    the sort-merge join otherwise.  ``broadcast_rows`` > 0 instead forces an
    up-front row-count check (worth it only for small fetched snapshots)."""
    attrs = list(dict.fromkeys(rules.values()))
    per_attr = actual.groupBy(key, *attrs).agg(F.count(F.lit(1)).alias("_n"))
    act = bounded_broadcast(per_attr, broadcast_rows)[0] if broadcast_rows > 0 else per_attr
    j = expected.join(act, key, "left")
    ok = F.lit(True)
    for want, attr in rules.items():
        ok = ok & (F.col(want).isNull() | F.col(attr).eqNullSafe(F.col(want)))
    n = F.coalesce(F.col("_n"), F.lit(0))
    g = j.groupBy(key, *rules.keys()).agg(F.sum(n).cast("bigint").alias("n_actual"),
                                          F.sum(F.when(~ok, n).otherwise(0)).cast("bigint").alias("n_bad"))
    reason = F.when(F.col("n_actual") == 0, "missing").when(F.col("n_bad") > 0, "wrong_attr").otherwise("ok")
    return g.select(key, *rules.keys(), "n_actual",
                    F.when(reason == "ok", "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"))


def readiness_rollup(checks: DataFrame, by: str = "group", status: str = "status") -> DataFrame:
    """A5: PASS/FAIL/INFO counts per group; the worst status wins
    (FAIL > PASS > INFO)."""
    rank = F.when(F.col(status) == "FAIL", 3).when(F.col(status) == "PASS", 2).when(F.col(status) == "INFO", 1)
    g = checks.groupBy(by).agg(
        F.count(F.when(F.col(status) == "PASS", 1)).alias("n_pass"),
        F.count(F.when(F.col(status) == "FAIL", 1)).alias("n_fail"),
        F.count(F.when(F.col(status) == "INFO", 1)).alias("n_info"),
        F.max(rank).alias("worst"))
    return g.select(by, "n_pass", "n_fail", "n_info",
                    F.when(F.col("worst") == 3, "FAIL").when(F.col("worst") == 2, "PASS")
                    .when(F.col("worst") == 1, "INFO").alias("status"))


def upsert_only_merge(desired: DataFrame, actual: DataFrame, key: str = "k", value: str = "v",
                      owner_col: str = "owner", owner: str = "me", domain: Column | None = None) -> DataFrame:
    """What an upsert-only sync does: ``create`` (wanted, absent), ``update``
    (ours, value differs), ``noop`` (ours, equal), ``not_owned`` (exists under
    another owner: untouched), ``retained`` (exists, not wanted: never deleted).
    A record without an owner is not ours; a NULL key is one key.  ``domain`` (a
    condition on the key) restricts both sides to the managed domain first."""
    d = desired.select(key, F.col(value).alias("desired_v"), F.lit(True).alias("_wanted"))
    a = actual.select(key, F.col(value).alias("actual_v"), F.col(owner_col).alias("owner"), F.lit(True).alias("_exists"))
    if domain is not None:
        d, a = d.where(domain), a.where(domain)
    a = a.withColumnRenamed(key, "_key")
    j = d.join(a, F.col(key).eqNullSafe(F.col("_key")), "full_outer").withColumn("_k", F.coalesce(key, "_key"))
    # presence is a flag of its own: values and owners may be NULL on either side
    action = (F.when(F.col("_exists").isNull(), "create")
              .when(F.col("_wanted").isNull(), "retained")
              .when(~F.col("owner").eqNullSafe(F.lit(owner)), "not_owned")
              .when(F.col("desired_v").eqNullSafe(F.col("actual_v")), "noop")
              .otherwise("update"))
    return j.select(F.col("_k").alias(key), "desired_v", "actual_v", "owner", action.alias("action"))


def first_match(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """First row per key in source order (``head -n1`` per key), by an
    explicit ordinal column: ``min_by`` with map-side combine."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_f"))
            .select(*keys, "_f.*"))
