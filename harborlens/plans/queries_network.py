"""N1-N3 bound to flows (line items between supplier and customer nations) and
the allowlist (edges between nations and their region's hub)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlens.operators import network as net
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import with_bindings
from harborlens.plans.catalog import register

# The VPC range (HTTPS to the endpoints, tcp 443) and its four
# subnets (private 10.0.1.0/24, 10.0.2.0/24; public 10.0.101.0/24, 10.0.102.0/24).
NETWORK_RULES = [
    ("vpc-https", "10.0.0.0/16", 443, "tcp"),
    ("private-a", "10.0.1.0/24", None, "-1"),
    ("private-b", "10.0.2.0/24", None, "-1"),
    ("public-a", "10.0.101.0/24", None, "-1"),
    ("public-b", "10.0.102.0/24", None, "-1"),
]
RULE_SCHEMA = T.StructType([T.StructField("rule", T.StringType()), T.StructField("cidr", T.StringType()),
                            T.StructField("port", T.IntegerType()), T.StructField("protocol", T.StringType())])


def rules_df(spark):
    return spark.createDataFrame(NETWORK_RULES, RULE_SCHEMA)


def _rules_sql() -> str:
    rows = ", ".join(f"('{r}', '{c}', {p if p is not None else 'CAST(NULL AS INTEGER)'}, '{pr}')"
                     for r, c, p, pr in NETWORK_RULES)
    return f"SELECT * FROM (VALUES {rows}) v(rule, cidr, port, protocol)"


_IP = ("(CAST(split_part({c}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({c}, '.', 2) AS BIGINT) * 65536"
       " + CAST(split_part({c}, '.', 3) AS BIGINT) * 256 + CAST(split_part({c}, '.', 4) AS BIGINT))")

_MATRIX = """
, matrix AS (SELECT src, dst, port, count(*) AS flows, CAST(sum(bytes) AS BIGINT) AS bytes FROM flows
             GROUP BY src, dst, port)"""


@register("traffic_matrix", with_bindings(_MATRIX + "\nSELECT * FROM matrix", "flows"))
def q_traffic_matrix(t):
    """Flows and bytes per (src, dst, port)."""
    return net.traffic_matrix(b.flows(t))


@register("allowlist_check", with_bindings(_MATRIX + """
SELECT 'denied_edge' AS finding, src, dst, port, CAST(flows AS DOUBLE) AS flows FROM matrix m
WHERE NOT EXISTS (SELECT 1 FROM allow a WHERE a.src = m.src AND a.dst = m.dst AND a.port = m.port)
UNION ALL
SELECT 'unused_allow', src, dst, port, CAST(NULL AS DOUBLE) FROM allow a
WHERE NOT EXISTS (SELECT 1 FROM matrix m WHERE a.src = m.src AND a.dst = m.dst AND a.port = m.port)""",
                                           "flows", "allow"))
def q_allowlist_check(t):
    """Default-deny findings both ways."""
    out = net.allowlist_check(net.traffic_matrix(b.flows(t)), b.allow(t))
    return out.withColumn("flows", F.col("flows").cast("double"))  # NULL and values alike in every client


@register("cidr_match", with_bindings(f"""
, rules AS ({_rules_sql()})
, rr AS (SELECT *, CAST(split_part(cidr, '/', 2) AS INTEGER) AS prefix,
         {_IP.format(c="split_part(cidr, '/', 1)")} AS lo FROM rules)
, r2 AS (SELECT *, lo + (CAST(1 AS BIGINT) << (32 - prefix)) - 1 AS hi FROM rr)
, f AS (SELECT *, row_number() OVER () AS fid, {_IP.format(c="src_ip")} AS ipn FROM flows)
, m AS (SELECT f.fid, r.rule, r.cidr, row_number() OVER (PARTITION BY f.fid
          ORDER BY r.prefix DESC, r.port IS NULL, r.rule) AS rn
        FROM f JOIN r2 r ON f.ipn BETWEEN r.lo AND r.hi AND (r.port IS NULL OR r.port = f.port)
          AND r.protocol IN ('-1', f.protocol))
SELECT f.src, f.dst, f.port, f.protocol, f.bytes, f.src_ip, m.rule, m.cidr
FROM f LEFT JOIN m ON m.fid = f.fid AND m.rn = 1""", "flows"))
def q_cidr_match(t):
    """The VPC range and its four subnets, longest prefix wins."""
    return net.cidr_match(b.flows(t), rules_df(t.spark), protocol="protocol")


@register("smallest_allowlist", with_bindings(f"""
, a AS (SELECT DISTINCT port, protocol, {_IP.format(c="src_ip")} AS n FROM flows)
, r AS (SELECT port, protocol, n, n - row_number() OVER (PARTITION BY port, protocol ORDER BY n) AS run FROM a)
, runs AS (SELECT port, protocol, min(n) AS lo, max(n) AS hi FROM r GROUP BY port, protocol, run)
, k AS (SELECT *, CAST(1 AS BIGINT) << k AS size FROM (SELECT *, unnest(range(0, 33)) AS k FROM runs))
, c AS (SELECT DISTINCT port, protocol, lo, hi, k, size, unnest([(lo + size - 1) // size * size, (hi + 1) // size * size - size]) AS s FROM k)
SELECT port, protocol, concat(s >> 24, '.', (s >> 16) % 256, '.', (s >> 8) % 256, '.', s % 256, '/', 32 - k) AS cidr FROM c
WHERE s >= lo AND s + size - 1 <= hi AND (k = 32 OR s // (2 * size) * (2 * size) < lo OR s // (2 * size) * (2 * size) + 2 * size - 1 > hi)""", "flows"))
def q_smallest_allowlist(t):
    """The fewest source CIDRs that hold exactly the addresses seen per port and protocol."""
    return net.smallest_allowlist(b.flows(t), by=("port", "protocol"))
