"""Bindings: the driver tables reshaped into operator inputs.

They stand in for platform data (deliveries, queue jobs, requests, pods, ...);
the values mean nothing.  Each binding has an SQL twin in
``harborlens.plans.binding_sql`` that the DuckDB oracle uses.

No binding uses a cross join or a rule table that grows with the square of its
source: fixed fan-outs go through ``explode`` (a generator, narrow).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.sources.tables import Tables


def _dec2(c) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def _plus_seconds(ts: str | Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, F.col(ts) if isinstance(ts, str) else ts)


def deliveries(t: Tables) -> DataFrame:
    """At-least-once redelivery: every event once, every 7th twice, every 35th three times."""
    e = t.events
    tries = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)),
                     lambda a: (a == 1) | ((a == 2) & (F.col("event_id") % 7 == 0))
                     | ((a == 3) & (F.col("event_id") % 35 == 0)))
    fan = e.select("event_id", "user_id", "event_type", _dec2("value").alias("value"), "ts",
                   F.explode(tries).alias("attempt"))
    return fan.select("event_id", "user_id", "event_type", "value", "attempt",
                      F.timestamp_add("MINUTE", (F.col("attempt") - 1) * 5, F.col("ts")).alias("delivered_ts"))


def attempts(t: Tables) -> DataFrame:
    d = deliveries(t)
    return d.select("event_id", "attempt", "delivered_ts",
                    F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("outcome"))


def jobs(t: Tables) -> DataFrame:
    e = t.events
    return e.select("event_id", F.concat(F.lit("q"), (F.col("user_id") % 4).cast("string")).alias("queue"),
                    F.col("ts").alias("arrived_ts"),
                    _plus_seconds("ts", F.floor(_dec2("value") * 60).cast("bigint")).alias("done_ts"))


def requests(t: Tables) -> DataFrame:
    e = t.events
    return e.select("event_id", F.concat(F.lit("svc"), (F.col("user_id") % 4).cast("string")).alias("service"),
                    "ts", F.col("value").alias("latency_ms"),
                    F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))


def samples(t: Tables) -> DataFrame:
    e = t.events
    return e.select("ts", F.concat(F.lit("node"), (F.col("user_id") % 8).cast("string")).alias("node"),
                    F.floor(_dec2("value") * 10).cast("bigint").alias("cpu_m"))


def instances_flat(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    state = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "running")
             .when(F.col("c_mktsegment") == "BUILDING", "pending")
             .when(F.col("c_mktsegment") == "FURNITURE", "stopping")
             .when(F.col("c_mktsegment") == "HOUSEHOLD", "stopped").otherwise("terminated"))
    return c.select(k.alias("id"), F.col("c_nationkey").alias("reservation"), state.alias("state"),
                    F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("p1")).alias("tag_project"),
                    F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("main"))
                    .otherwise(F.lit("dev")).alias("tag_environment"),
                    F.when(k % 2 == 0, F.col("c_name")).alias("tag_name"))


# API pages hold at most this many instances, like a paginated describe call.
INSTANCE_PAGE_SIZE = 1000


def instances_api(t: Tables) -> DataFrame:
    """Instances nested as the cloud API returns them: one row per response page,
    ``Reservations[].Instances[]`` with a ``Tags`` key/value list.  Pages bound
    every array, so no group grows with the data."""
    f = instances_flat(t)
    tags = F.filter(F.array(
        F.struct(F.lit("Project").alias("Key"), F.col("tag_project").alias("Value")),
        F.struct(F.lit("Environment").alias("Key"), F.col("tag_environment").alias("Value")),
        F.struct(F.lit("Name").alias("Key"), F.col("tag_name").alias("Value"))),
        lambda x: x["Value"].isNotNull())
    inst = f.select(
        F.floor(F.col("id") / INSTANCE_PAGE_SIZE).alias("page"), "reservation",
        F.struct(F.concat(F.lit("i-"), F.col("id").cast("string")).alias("InstanceId"),
                 F.struct(F.col("state").alias("Name")).alias("State"),
                 F.lit("t3.medium").alias("InstanceType"),
                 F.struct(F.concat(F.lit("zone-"), (F.col("reservation") % 3).cast("string"))
                          .alias("AvailabilityZone")).alias("Placement"),
                 tags.alias("Tags")).alias("inst"))
    res = (inst.groupBy("page", "reservation")
           .agg(F.sort_array(F.collect_list("inst")).alias("Instances"))
           .select("page", F.struct(F.concat(F.lit("r-"), F.col("reservation").cast("string"))
                                    .alias("ReservationId"), "Instances").alias("r")))
    return res.groupBy("page").agg(F.sort_array(F.collect_list("r")).alias("Reservations"))


def volumes(t: Tables) -> DataFrame:
    p = t.part
    return p.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("type"),
                    F.col("p_size").alias("size_gb"),
                    F.when(F.col("p_partkey") % 4 == 0, "available").otherwise("in-use").alias("state"))


def nat(t: Tables) -> DataFrame:
    s = t.supplier
    m = F.col("s_suppkey") % 4
    return s.select(F.col("s_suppkey").alias("id"),
                    F.when(m == 0, "available").when(m == 1, "pending").when(m == 2, "deleting")
                    .otherwise("deleted").alias("state"))


def pod_heads(t: Tables) -> DataFrame:
    """(pod, namespace), one row a pod (an order)."""
    m = F.col("o_custkey") % 10
    ns = (F.when(m == 0, "kube-system").when(m == 1, "kyverno").when(m == 2, "default")
          .otherwise(F.concat(F.lit("demo-"), m.cast("string"))))
    return t.orders.select(F.col("o_orderkey").alias("pod"), ns.alias("namespace"))


def container_rows(t: Tables) -> DataFrame:
    """(pod, init, name, image, privileged, requests, limits), one row a container (a line item).

    Fields a container does not set stay NULL, as in a manifest.  The flat
    ``req_cpu``/``lim_mem`` fill the cpu/memory of both requests and limits; line
    number 7 is an init container."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    ln = F.col("l_linenumber")
    image = (F.when((ln == 1) & (F.col("l_returnflag") == "R"), "reg:5000/app:latest")
             .when((ln == 2) & (F.col("l_returnflag") == "A"), "reg:5000/app")
             .when(ln == 3, "reg:5000/app@sha256:ab")
             .otherwise(F.concat(F.lit("reg:5000/app:v"), ln.cast("string"))))
    priv = F.when((ln == 2) & (F.col("l_linestatus") == "F"), F.lit(True)).when(ln == 3, F.lit(False)) \
        .when((ln == 7) & (F.col("l_returnflag") == "A"), F.lit(True))
    req_cpu = F.when(ln != 4, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("m")))
    lim_mem = F.when(ln == 5, F.lit("")).otherwise(F.lit("128Mi"))
    res = F.struct(req_cpu.alias("cpu"), lim_mem.alias("memory"))
    return li.select(F.col("l_orderkey").alias("pod"), (ln == 7).alias("init"), F.concat(F.lit("c"), ln.cast("string")).alias("name"),
                     image.alias("image"), priv.alias("privileged"), res.alias("requests"), res.alias("limits"))


CONTAINER_DDL = ("struct<name:string,image:string,privileged:boolean,"
                 "requests:struct<cpu:string,memory:string>,limits:struct<cpu:string,memory:string>>")


def pods(t: Tables) -> DataFrame:
    """Pods in their native nested shape, with each distinct container of a pod once.

    Containers are made of 7 line numbers, 3 return flags, 2 line statuses and 50
    quantities, so a pod has at most 2,100 distinct ones however many line items
    its order has; the sets are combined map-side before the join.  Equal
    containers do not change what a policy says about a pod."""
    one = F.struct("name", "image", "privileged", "requests", "limits")
    sets = container_rows(t).groupBy("pod").agg(
        F.sort_array(F.collect_set(F.when(~F.col("init"), one))).alias("containers"),
        F.sort_array(F.collect_set(F.when(F.col("init"), one))).alias("initContainers"))
    none = F.array().cast(f"array<{CONTAINER_DDL}>")
    return (pod_heads(t).join(sets, "pod", "left")
            .select("namespace", F.col("pod").cast("string").alias("pod"), F.coalesce("containers", none).alias("containers"), "initContainers"))


def endpoints_expected(t: Tables) -> DataFrame:
    """What each endpoint should be; NULL = any."""
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("item"), F.col("o_orderstatus").alias("want"),
                           F.when(k % 2 == 0, "Interface").alias("want_type"), F.when(k % 5 == 0, F.lit(True)).alias("want_dns"))


def endpoints_actual(t: Tables) -> DataFrame:
    """Endpoints as they are, one row each."""
    ln = F.col("l_linenumber")
    return t.lineitem.select(F.col("l_orderkey").alias("item"), F.col("l_linestatus").alias("attr"),
                             F.when(ln < 7, "Interface").otherwise("Gateway").alias("type"),
                             F.when(ln != 6, F.col("l_returnflag") != "R").alias("private_dns"))


def desired(t: Tables) -> DataFrame:
    o = t.orders
    return o.where(F.col("o_orderkey") % 13 != 0).select(F.col("o_orderkey").alias("k"),
                                                          F.col("o_orderstatus").alias("v"))


def actual(t: Tables) -> DataFrame:
    """The records that exist: a third of all is absent (to be created)."""
    return records(t).where(F.col("k") % 3 != 0)


def records(t: Tables) -> DataFrame:
    """Every record with its value and owner; some belong to another owner, some to nobody."""
    o = t.orders
    k = F.col("o_orderkey")
    return o.select(
        k.alias("k"), F.when(k % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("v"),
        F.when(k % 11 == 0, "other").when(k % 23 != 0, "me").alias("owner"))


def objects_before(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("namespace"),
                           F.col("o_totalprice").alias("v"))


def objects_after(t: Tables) -> DataFrame:
    o = t.orders
    k = F.col("o_orderkey")
    kept = o.where(k % 19 != 0).select(
        k.alias("k"), F.col("o_orderpriority").alias("namespace"),
        F.when(k % 17 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("v"))
    extra = o.where(k % 1000 == 7).select((-k).alias("k"), F.col("o_orderpriority").alias("namespace"),
                                          F.col("o_totalprice").alias("v"))
    return kept.unionByName(extra)


def phases(t: Tables) -> DataFrame:
    """Job status rows.  An order's line items are reduced to one flag (map-side)
    before they meet the order; every third job is a restore, the others backups."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "restore").otherwise("backup")
    started = o.select(F.col("o_orderkey").alias("job"), kind.alias("kind"), F.col("o_orderdate").alias("ts"),
                       F.lit("InProgress").alias("phase"))
    flag = t.lineitem.groupBy("l_orderkey").agg(F.max("l_returnflag").alias("flag"))
    ended = (o.where(F.col("o_orderkey") % 4 != 0).join(flag, F.col("l_orderkey") == F.col("o_orderkey"))
             .select(F.col("o_orderkey").alias("job"), kind.alias("kind"),
                     _plus_seconds("o_orderdate", F.col("o_orderkey") % 1200).alias("ts"),
                     F.when(F.col("flag") == "R", "Completed").when(F.col("flag") == "N", "PartiallyFailed")
                     .otherwise("Failed").alias("phase")))
    return started.unionByName(ended)


def _events_of(t: Tables, kind: str, name: str) -> DataFrame:
    return (t.events.where(F.col("event_type") == kind)
            .select(F.col("event_id").alias(name), F.col("user_id").alias("system"), "ts"))


def incidents(t: Tables) -> DataFrame:
    return _events_of(t, "error", "incident")


def backups(t: Tables) -> DataFrame:
    return _events_of(t, "purchase", "backup")


def backups_with_expiry(t: Tables) -> DataFrame:
    """Backups with their own time to live, 300 to 1,199 hours; every eleventh never expires."""
    ttl = F.when(F.col("backup") % 11 != 0, 300 + F.col("backup") % 900)
    return backups(t).withColumn("expires_ts", F.timestamp_add("HOUR", ttl, F.col("ts")))


def restores(t: Tables) -> DataFrame:
    return _events_of(t, "signup", "restore")


def flows(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    return j.select(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst"),
                    F.when(F.col("l_partkey") % 2 == 0, 443).otherwise(5432).alias("port"),
                    F.when(F.col("l_suppkey") % 5 == 0, "udp").otherwise("tcp").alias("protocol"),
                    F.col("l_quantity").cast("bigint").alias("bytes"),
                    F.concat(F.lit("10.0."), (F.col("l_partkey") % 104).cast("string"), F.lit("."),
                             (F.col("l_suppkey") % 256).cast("string")).alias("src_ip"))


def allow(t: Tables) -> DataFrame:
    """Allowed edges, linear in the nodes: within a region every node may talk to
    the region's hub (its node of least key), and the hub to it, on 443."""
    n = t.nation.select("n_nationkey", "n_regionkey")
    hub = n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("hub"))
    edges = n.join(hub, "n_regionkey").select(F.inline(F.array(
        F.struct(F.col("n_nationkey").alias("src"), F.col("hub").alias("dst")),
        F.struct(F.col("hub").alias("src"), F.col("n_nationkey").alias("dst")))))
    return edges.distinct().select("src", "dst", F.lit(443).alias("port"))


def log_records(t: Tables) -> DataFrame:
    """Log lines with a namespace; whole document texts, never prefixes."""
    return t.documents.select(F.col("doc_id").alias("seq"), F.col("source").alias("namespace_name"),
                              F.col("text").alias("log"))


def namespaces(t: Tables) -> DataFrame:
    p = t.part
    m = F.col("p_partkey") % 3
    name = F.concat(F.when(m == 0, "demo-").when(m == 1, "logging").otherwise("team-"),
                    F.when(m == 1, F.lit("")).otherwise(F.col("p_partkey").cast("string")))
    return p.select(name.alias("namespace"), F.col("p_brand").alias("old_enforce"))


def _paged(df: DataFrame, item: Column, field: str, page_key: Column) -> DataFrame:
    """One API response page per ``page_key`` value: ``field`` = array of items."""
    return (df.select(page_key.alias("page"), item.alias("item"))
            .groupBy("page").agg(F.sort_array(F.collect_list("item")).alias(field)))


def _id_page(c: str) -> Column:
    return F.floor(F.col(c) / INSTANCE_PAGE_SIZE)


def _api_tags(id_: Column, name: Column | None = None) -> Column:
    """A ``Tags`` list like the instances': a third without Project, a fifth without Environment."""
    pairs = [("Project", F.when(id_ % 3 != 0, F.lit("p1"))),
             ("Environment", F.when(id_ % 5 == 0, F.lit(None).cast("string")).when(id_ % 7 == 0, "main").otherwise("dev"))]
    if name is not None:
        pairs.append(("Name", F.when(id_ % 2 == 0, name)))
    return F.filter(F.array(*[F.struct(F.lit(k).alias("Key"), v.alias("Value")) for k, v in pairs]), lambda x: x["Value"].isNotNull())


def volumes_api(t: Tables) -> DataFrame:
    v = volumes(t)
    vol = F.concat(F.lit("vol-"), F.col("id").cast("string"))
    item = F.struct(vol.alias("VolumeId"),
                    F.col("state").alias("State"), F.col("type").alias("VolumeType"),
                    F.col("size_gb").alias("Size"),
                    F.concat(F.lit("zone-"), (F.col("id") % 3).cast("string")).alias("AvailabilityZone"),
                    _api_tags(F.col("id"), F.concat(F.lit("data-"), F.col("id").cast("string"))).alias("Tags"))
    return _paged(v, item, "Volumes", _id_page("id"))


def nat_api(t: Tables) -> DataFrame:
    n = nat(t)
    item = F.struct(F.concat(F.lit("nat-"), F.col("id").cast("string")).alias("NatGatewayId"),
                    F.col("state").alias("State"),
                    F.concat(F.lit("subnet-"), (F.col("id") % 4).cast("string")).alias("SubnetId"),
                    F.lit("vpc-1").alias("VpcId"),
                    F.array(F.struct(F.concat(F.lit("203.0.113."), (F.col("id") % 256).cast("string"))
                                     .alias("PublicIp"))).alias("NatGatewayAddresses"),
                    _api_tags(F.col("id"), F.concat(F.lit("gw-"), F.col("id").cast("string"))).alias("Tags"))
    return _paged(n, item, "NatGateways", _id_page("id"))


def load_balancers_api(t: Tables) -> DataFrame:
    n = t.nation
    name = F.concat(F.lit("lb-"), F.col("n_name"))
    item = F.struct(name.alias("LoadBalancerName"),
                    F.when(F.col("n_regionkey") % 2 == 0, "application").otherwise("network").alias("Type"),
                    F.struct(F.when(F.col("n_nationkey") % 5 == 0, "failed").otherwise("active").alias("Code"))
                    .alias("State"),
                    F.when(F.col("n_nationkey") % 2 == 0, "internal").otherwise("internet-facing").alias("Scheme"),
                    F.concat(name, F.lit(".elb")).alias("DNSName"), F.lit("vpc-1").alias("VpcId"),
                    _api_tags(F.col("n_nationkey")).alias("Tags"))
    return _paged(n, item, "LoadBalancers", _id_page("n_nationkey"))


def clusters_api(t: Tables) -> DataFrame:
    r = t.region
    return _paged(r, F.concat(F.lit("cluster-"), F.lower("r_name")), "clusters", _id_page("r_regionkey"))


def db_instances_api(t: Tables) -> DataFrame:
    s = t.supplier
    item = F.struct(F.concat(F.lit("db-"), F.col("s_suppkey").cast("string")).alias("DBInstanceIdentifier"),
                    F.when(F.col("s_acctbal") < 0, "stopped").otherwise("available").alias("DBInstanceStatus"),
                    F.lit("db.t3.micro").alias("DBInstanceClass"), (F.col("s_nationkey") + 20).alias("AllocatedStorage"),
                    F.concat(F.lit("zone-"), (F.col("s_suppkey") % 3).cast("string")).alias("AvailabilityZone"),
                    _api_tags(F.col("s_suppkey")).alias("TagList"))
    return _paged(s, item, "DBInstances", _id_page("s_suppkey"))


def cloud_sources(t: Tables) -> dict[str, DataFrame]:
    """The six API responses the audit reads, in their nested shapes."""
    return {"ec2": instances_api(t), "ebs": volumes_api(t), "nat": nat_api(t),
            "elb": load_balancers_api(t), "eks": clusters_api(t), "rds": db_instances_api(t)}


def expected_resources(t: Tables) -> DataFrame:
    """What the infrastructure code declares: instances of customers in credit
    and volumes up to 25 GB."""
    c = t.customer.where(F.col("c_acctbal") >= 0).select(
        F.lit("ec2").alias("kind"), F.concat(F.lit("i-"), F.col("c_custkey").cast("string")).alias("id"))
    p = t.part.where(F.col("p_size") <= 25).select(
        F.lit("ebs").alias("kind"), F.concat(F.lit("vol-"), F.col("p_partkey").cast("string")).alias("id"))
    return c.unionByName(p)
