"""N3 by flattened ranges: every nesting of prefixes, any block size, one join."""

import random
import re

import pytest
from pyspark.sql import functions as F

from harborlens.operators import network as net
from tests.test_plans import explained

RULES = "rule string, cidr string, port int, protocol string"


def address(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def number(ip):
    a, b, c, d = map(int, ip.split("."))
    return a << 24 | b << 16 | c << 8 | d


def brute(rules, ip, port, proto):
    """The rule of longest prefix that covers the flow; of one prefix a port's own before any port, then by name."""
    hits = []
    for name, cidr, rport, rproto in rules:
        net_, _, length = cidr.partition("/")
        length = int(length or 32)
        if number(ip) >> (32 - length) == number(net_) >> (32 - length) and rport in (None, port) and rproto in ("-1", None, proto):
            hits.append((-length, rport is None, name))
    return min(hits)[2] if hits else None


def nested_rules(g, n=60):
    base = [number("10.20.0.0"), number("0.0.0.0"), number("255.255.255.0"), g.getrandbits(32)]
    out = [("world", "0.0.0.0/0", 443, "tcp")]
    for i in range(n):
        length = g.choice([0, 1, 4, 8, 12, 15, 16, 17, 20, 24, 28, 30, 31, 32])
        at = (g.choice(base) + g.getrandbits(g.choice([4, 12, 17]))) % (1 << 32)
        out.append((f"r{i}", f"{address(at)}/{length}" if length < 32 or g.random() < .5 else address(at), g.choice([None, 443, 80]), g.choice(["-1", "tcp", "udp", None])))
    return out


@pytest.mark.parametrize("seed,bits", [(1, 16), (2, 24), (3, 20)])
def test_longest_prefix_of_any_nesting(spark, seed, bits):
    g = random.Random(seed)
    rules = nested_rules(g)
    edges = [number(r[1].split("/")[0]) for r in rules]
    flows = [(i, address((g.choice(edges) + g.randint(-3, 300)) % (1 << 32)), g.choice([443, 80, 22]), g.choice(["tcp", "udp"])) for i in range(400)]
    flows += [(900, "0.0.0.0", 443, "tcp"), (901, "255.255.255.255", 443, "tcp"), (902, None, 443, "tcp"), (903, "not an address", 443, "tcp")]
    df = spark.createDataFrame(flows, "id int, src_ip string, port int, proto string")
    got = {r.id: r.rule for r in net.cidr_match(df, spark.createDataFrame(rules, RULES), protocol="proto", block_bits=bits).collect()}
    want = {i: None if i in (902, 903) else brute(rules, ip, port, proto) for i, ip, port, proto in flows}
    assert got == want and len({*want.values()}) > 10


def test_ranges_are_disjoint_and_few(spark):
    rules = spark.createDataFrame(nested_rules(random.Random(4)), RULES)
    rows = net.flattened_rules(rules, 24).collect()
    assert len(rows) <= 1 << 8
    starts = [s.start for r in sorted(rows, key=lambda r: r.block) for s in r.segments]
    assert starts == sorted(set(starts)) and all(s.start >> 24 == r.block for r in rows for s in r.segments)
    assert net.flattened_rules(spark.createDataFrame([], RULES)).count() == 0


def test_one_join_whatever_the_prefixes(spark):
    flows = spark.createDataFrame([("10.0.0.1", 443)], "src_ip string, port int")
    many = spark.createDataFrame([(f"r{p}", f"10.0.0.0/{p}", None, "-1") for p in range(33)], RULES)
    text = explained(net.cidr_match(flows, many))
    assert len(re.findall(r"(?:Join|CartesianProduct)", text)) == 1
    assert [r.rule for r in net.cidr_match(flows, many).collect()] == ["r31"]
    none = net.cidr_match(flows, spark.createDataFrame([], RULES)).collect()
    assert [(r.rule, r.cidr) for r in none] == [(None, None)]


def fewest(addresses):
    """Bottom-up merge of full siblings, all 32 rounds."""
    level, out = set(addresses), set()
    for length in range(32, 0, -1):
        up = {n >> 1 for n in level if n ^ 1 in level}
        out |= {(n, length) for n in level if n ^ 1 not in level}
        level = up
    out |= {(n, 0) for n in level}
    return {f"{address(n << 32 - length)}/{length}" for n, length in out}


@pytest.mark.parametrize("seed,bits", [(1, 16), (2, 4), (3, 8)])
def test_smallest_allowlist(spark, seed, bits):
    g = random.Random(seed)
    seen = {}
    for port in (22, 443):
        some = set()
        for _ in range(12):
            lo = (g.choice([0, 10 << 24, (1 << 32) - 300]) + g.getrandbits(9)) % (1 << 32)
            some |= {n for n in range(lo, lo + g.choice([1, 2, 7, 16, 130])) if n < 1 << 32}
        seen[port] = some
    rows = [(address(n), p) for p, ns in seen.items() for n in ns] * 2 + [(None, 443), ("no address", 22)]
    got = net.smallest_allowlist(spark.createDataFrame(rows, "src_ip string, port int").repartition(4), block_bits=bits).collect()
    for port, ns in seen.items():
        mine = [r.cidr for r in got if r.port == port]
        assert sorted(mine) == sorted(fewest(ns))
    assert net.smallest_allowlist(spark.createDataFrame([], "src_ip string, port int")).count() == 0


def test_full_blocks_merge_beyond_the_block(spark):
    rows = spark.range(3 << 16).select(F.concat_ws(".", F.lit("10"), *[F.pmod(F.shiftright(F.col("id") + (4 << 16), s), F.lit(256)).cast("string") for s in (16, 8, 0)]).alias("src_ip"), F.lit(1).alias("port"))
    assert sorted(r.cidr for r in net.smallest_allowlist(rows).collect()) == ["10.4.0.0/15", "10.6.0.0/16"]
