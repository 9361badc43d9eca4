"""A1-A7 bound to the cloud API pages, endpoints and DNS-like records."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborlens.operators import inventory as inv
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import with_bindings
from harborlens.plans.catalog import register

SCOPE_TAGS = {"Project": "p1", "Environment": "dev"}
_INV_OUT = "kind, id, state, type, size_gb, az, name, subnet, vpc, public_ip, scheme, dns_name"
# size_gb is NULL for kinds without a size: DOUBLE keeps NULL and value alike in every client.
_INV_SQL = "kind, id, state, type, CAST(size_gb AS DOUBLE) AS size_gb, az, name, subnet, vpc, public_ip, scheme, dns_name"


def _live_sql() -> str:
    arms = " ".join(f"WHEN '{k}' THEN coalesce(state IN ({', '.join(repr(s) for s in v)}), FALSE)"
                    for k, v in inv.LIVE_STATES.items())
    return f"coalesce(CASE kind {arms} END, TRUE)"


_SCOPE = f"""
, scoped AS (SELECT *, CASE WHEN tag_project IS NULL OR tag_environment IS NULL THEN 'missing_tag'
    WHEN tag_project <> '{SCOPE_TAGS["Project"]}' OR tag_environment <> '{SCOPE_TAGS["Environment"]}' THEN 'tag_mismatch'
    WHEN NOT {_live_sql()} THEN 'state' END AS exclusion_reason FROM inventory)"""


def _inventory(t):
    return inv.resource_inventory(b.cloud_sources(t))


def _scoped(t):
    return inv.tag_scope(_inventory(t), SCOPE_TAGS)


@register("resource_inventory", with_bindings(f"SELECT {_INV_SQL} FROM inventory", "inventory"))
def q_resource_inventory(t):
    """A1: six resource kinds flattened into one table."""
    return (_inventory(t).select(*_INV_OUT.split(", "))
            .withColumn("size_gb", F.col("size_gb").cast("double")))


@register("tag_scope", with_bindings(_SCOPE + """
SELECT kind, id, exclusion_reason IS NULL AS in_scope, exclusion_reason FROM scoped""", "inventory"))
def q_tag_scope(t):
    """A2: Project=p1 and Environment=dev, live states only."""
    return _scoped(t).select("kind", "id", "in_scope", "exclusion_reason")


@register("leak_report", with_bindings(_SCOPE + """
SELECT kind, count(*) AS leaked FROM scoped s
WHERE exclusion_reason IS NULL AND NOT EXISTS (SELECT 1 FROM expected_resources e WHERE e.kind = s.kind AND e.id = s.id)
GROUP BY kind""", "inventory", "expected_resources"))
def q_leak_report(t):
    """A3: live in-scope resources not declared, per kind."""
    return inv.leak_report(_scoped(t), b.expected_resources(t))


_A4 = """
, j AS (SELECT e.*, a.attr, a.type, a.private_dns, a.item IS NOT NULL AS seen
        FROM endpoints_expected e LEFT JOIN endpoints_actual a ON a.item = e.item)
, g AS (SELECT item, want, want_type, want_dns, count(*) FILTER (WHERE seen) AS n_actual,
        count(*) FILTER (WHERE seen AND NOT ((want IS NULL OR attr IS NOT DISTINCT FROM want)
          AND (want_type IS NULL OR type IS NOT DISTINCT FROM want_type)
          AND (want_dns IS NULL OR private_dns IS NOT DISTINCT FROM want_dns))) AS n_bad
        FROM j GROUP BY item, want, want_type, want_dns)
, a4 AS (SELECT item, want, want_type, want_dns, n_actual,
  CASE WHEN n_actual = 0 OR n_bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN n_actual = 0 THEN 'missing' WHEN n_bad > 0 THEN 'wrong_attr' ELSE 'ok' END AS reason FROM g)"""


def _a4(t):
    return inv.expected_vs_actual(b.endpoints_expected(t), b.endpoints_actual(t), key="item",
                                  rules={"want": "attr", "want_type": "type", "want_dns": "private_dns"})


@register("expected_vs_actual", with_bindings(_A4 + "\nSELECT * FROM a4", "endpoints_expected", "endpoints_actual"))
def q_expected_vs_actual(t):
    """A4: every actual row of an item must carry the wanted attribute."""
    return _a4(t)


@register("readiness_rollup", with_bindings(_A4 + """
, checks AS (SELECT want AS "group", status FROM a4
             UNION ALL SELECT want, 'INFO' FROM a4 WHERE n_actual > 1)
SELECT "group", count(*) FILTER (WHERE status = 'PASS') AS n_pass, count(*) FILTER (WHERE status = 'FAIL') AS n_fail,
  count(*) FILTER (WHERE status = 'INFO') AS n_info,
  CASE max(CASE status WHEN 'FAIL' THEN 3 WHEN 'PASS' THEN 2 WHEN 'INFO' THEN 1 END)
    WHEN 3 THEN 'FAIL' WHEN 2 THEN 'PASS' WHEN 1 THEN 'INFO' END AS status
FROM checks GROUP BY "group\"""", "endpoints_expected", "endpoints_actual"))
def q_readiness_rollup(t):
    """A5: A4 verdicts (plus INFO for items seen more than once) by wanted value."""
    a4 = _a4(t)
    # one pass over A4: each verdict, plus an INFO row where an item has several actual rows
    statuses = F.when(F.col("n_actual") > 1, F.array("status", F.lit("INFO"))).otherwise(F.array("status"))
    checks = a4.select(F.col("want").alias("group"), F.explode(statuses).alias("status"))
    return inv.readiness_rollup(checks, by="group")


@register("upsert_only_merge", with_bindings("""
SELECT coalesce(d.k, a.k) AS k, d.v AS desired_v, a.v AS actual_v, a.owner,
  CASE WHEN a.k IS NULL THEN 'create' WHEN d.k IS NULL THEN 'retained'
    WHEN a.owner IS DISTINCT FROM 'me' THEN 'not_owned' WHEN d.v IS NOT DISTINCT FROM a.v THEN 'noop' ELSE 'update' END AS action
FROM (SELECT * FROM desired WHERE k % 29 <> 0) d FULL OUTER JOIN (SELECT * FROM actual WHERE k % 29 <> 0) a ON d.k = a.k""",
                                           "desired", "actual"))
def q_upsert_only_merge(t):
    """Upsert-only sync of the managed domain's records against actual ones, some owned by others or nobody."""
    return inv.upsert_only_merge(b.desired(t), b.actual(t), key="k", value="v", owner="me", domain=F.col("k") % 29 != 0)


@register("first_match", with_bindings("""
SELECT owner, k, v FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY k) AS rn FROM records) WHERE rn = 1""",
                                       "records"))
def q_first_match(t):
    """First record per owner in key order."""
    return inv.first_match(b.records(t), key="owner", order="k").select("owner", "k", "v")
