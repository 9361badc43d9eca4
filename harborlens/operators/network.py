"""Network: traffic matrix, allowlist check and CIDR rule matching.

Scale notes.  N1 is one aggregation (partial, shuffle on the edge).  N2 is one full
outer join (never ``NOT IN``).  N3 matches flows to CIDR rules without a range or
nested-loop join and in one equi-join: the nested CIDRs are flattened into disjoint
ranges grouped by address block, and each flow probes its block once.  While the
flattened rules are below Spark's broadcast threshold in bytes, flows stay in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlens.functions.scalars import cidr_low, cidr_prefix, ipv4_to_long
from harborlens.session import materialised


def traffic_matrix(flows: DataFrame, keys: Sequence[str] = ("src", "dst", "port"), bytes_col: str = "bytes",
                   pivot_ports: Sequence[int] | None = None) -> DataFrame:
    """Flows and bytes per (src, dst, port); with ``pivot_ports`` one
    bytes column per port instead (values listed, so no extra distinct job)."""
    if pivot_ports is not None:
        ks = [k for k in keys if k != "port"]
        return flows.groupBy(*ks).pivot("port", list(pivot_ports)).agg(F.sum(bytes_col))
    return flows.groupBy(*keys).agg(F.count(F.lit(1)).alias("flows"), F.sum(bytes_col).alias("bytes"))


def allowlist_check(matrix: DataFrame, allow: DataFrame, keys: Sequence[str] = ("src", "dst", "port")) -> DataFrame:
    """N2 default deny: ``denied_edge`` = observed edges with no allow row;
    ``unused_allow`` = allow rows no traffic used.

    One full outer join classifies both ways, so the traffic matrix (an
    aggregation over all flows) is computed once, not once per direction."""
    keys = list(keys)
    a = allow.select(*keys).distinct().withColumn("_allowed", F.lit(True))
    m = matrix.select(*keys, "flows").withColumn("_seen", F.lit(True))
    j = m.join(a, keys, "full_outer")
    finding = F.when(F.col("_allowed").isNull(), "denied_edge").when(F.col("_seen").isNull(), "unused_allow")
    return (j.select(finding.alias("finding"), *keys, "flows")
            .where(F.col("finding").isNotNull()))


BLOCK_BITS = 16          # address block by which flows meet rules: a /16


def _rule_lookup(rules: DataFrame) -> DataFrame:
    """(prefix, network) -> candidate rules sorted so the first match wins:
    a rule naming the port before an any-port rule, then by rule name."""
    r = rules.select("rule", "cidr", F.col("port").cast("int").alias("port"),
                     F.coalesce(F.col("protocol"), F.lit("-1")).alias("protocol"),
                     cidr_prefix(F.col("cidr")).alias("prefix"), cidr_low(F.col("cidr")).alias("network"))
    cand = F.struct((F.col("port").isNull()).alias("any_port"), F.col("rule"), F.col("cidr"), F.col("port"),
                    F.col("protocol"))
    return r.groupBy("prefix", "network").agg(F.sort_array(F.collect_list(cand)).alias("cands"))


def flattened_rules(rules: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(block, segments): the nested CIDRs of ``rules`` as disjoint ranges of addresses, by address block.

    Every CIDR's first address, the one after its last, and each block's first address
    inside it begin a range; between two such starts the same CIDRs cover every
    address.  A start finds them by an equi-join of its 33 possible networks.
    ``segments`` are the block's ranges in order: the start, and the rules that cover
    the range, longest prefix first.  There are at most 2 ** (32 - block_bits) blocks
    and one row for each."""
    size = F.expr("shiftleft(1L, 32 - prefix)")
    lookup = materialised(_rule_lookup(rules).where(F.col("network").isNotNull()), "rules")
    width = 1 << block_bits
    spans = lookup.select("network", (F.col("network") + size).alias("after"))
    inside = spans.select("network", F.explode(F.sequence(F.expr(f"network div {width}"), F.expr(f"(after - 1) div {width}"))).alias("block"))
    starts = inside.select(F.greatest(F.col("network"), F.col("block") * width).alias("start"))
    starts = starts.unionAll(spans.where(F.col("after") < F.lit(1 << 32)).select("after")).distinct()
    networks = starts.select("start", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("prefix"))
    networks = networks.withColumn("network", F.col("start") - F.pmod(F.col("start"), size))
    cover = networks.join(lookup, ["prefix", "network"]).groupBy("start").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("prefix")).alias("order"), "cands"))).alias("nested"))
    ranges = starts.join(cover, "start", "left").select(
        "start", F.flatten(F.transform("nested", lambda n: n["cands"])).alias("cands"))
    segments = F.sort_array(F.collect_list(F.struct("start", "cands")))
    return ranges.groupBy(F.expr(f"start div {width}").alias("block")).agg(segments.alias("segments"))


def cidr_match(flows: DataFrame, rules: DataFrame, ip: str = "src_ip", port: str = "port",
               protocol: str | None = None, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Attach to each flow the rule whose CIDR (both bounds inclusive),
    port (NULL = any) and protocol (``-1`` = any) cover it; the longest prefix
    wins.  Adds ``rule``, ``cidr``; NULL when nothing matches.  ``protocol`` names
    the flows' protocol column; without one, only rules for any protocol match.
    A CIDR without ``/nn`` is one address; one that is no address matches nothing.

    ``rules``: ``rule, cidr, port, protocol``.  Flows meet them in one equi-join on
    the address block, whatever prefix lengths there are; the range is picked among
    those of its block.  The flattened rules are stored, so Spark knows their size: it
    broadcasts them below its byte threshold and joins by shuffle above it."""
    blocks = materialised(flattened_rules(rules, block_bits), "rule-ranges").withColumnsRenamed({"block": "_block", "segments": "_segments"})
    out = flows.withColumn("_ip", ipv4_to_long(F.col(ip)))
    out = out.join(blocks, F.expr(f"_ip div {1 << block_bits}") == F.col("_block"), "left")
    proto = F.col(protocol) if protocol else F.lit(None).cast("string")
    before = F.filter("_segments", lambda s: s["start"] <= F.col("_ip"))
    cands = F.get(before, F.size(before) - 1)["cands"]
    hit = F.filter(cands, lambda c: (c["port"].isNull() | (c["port"] == F.col(port)))
                   & ((c["protocol"] == "-1") | F.coalesce(c["protocol"] == proto, F.lit(False))))
    return out.withColumn("_best", F.get(hit, 0)).select(*flows.columns, F.col("_best.rule").alias("rule"), F.col("_best.cidr").alias("cidr"))


def _islands(df: DataFrame, by: Sequence[str], n: str) -> DataFrame:
    """(by, lo, hi): runs of consecutive numbers ``n``, distinct within ``by``."""
    w = Window.partitionBy(*by).orderBy(n)
    run = df.withColumn("_run", F.col(n) - F.row_number().over(w))
    return run.groupBy(*by, "_run").agg(F.min(n).alias("lo"), F.max(n).alias("hi")).drop("_run")


def _aligned(runs: DataFrame, by: Sequence[str], bits: int) -> DataFrame:
    """(by, start, k): the fewest aligned blocks of 2 ** k numbers below 2 ** bits that make up each run lo..hi.

    A block belongs to it if the block of twice its size around it leaves the run; of
    each size only a run's first and last aligned block can."""
    size = F.expr("shiftleft(1L, k)")
    each = runs.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("k"))
    first = F.ceil(F.col("lo") / size).cast("bigint") * size
    last = F.floor((F.col("hi") + 1) / size).cast("bigint") * size - size
    each = each.select("*", F.explode(F.array_distinct(F.array(first, last))).alias("start"))
    inside = lambda start, n: (start >= F.col("lo")) & (start + n - 1 <= F.col("hi"))
    parent = F.col("start") - F.pmod(F.col("start"), size * 2)
    return each.where(inside(F.col("start"), size) & ((F.col("k") == bits) | ~inside(parent, size * 2))).select(*by, "start", "k")


def smallest_allowlist(flows: DataFrame, ip: str = "src_ip", by: Sequence[str] = ("port",), block_bits: int = BLOCK_BITS) -> DataFrame:
    """(by, cidr): the fewest CIDRs that hold exactly the addresses seen, for each group.

    Sibling prefixes that are both full become their parent: within an address block
    (distinct addresses, a window of at most 2 ** block_bits of them), and then among
    a group's full blocks (at most 2 ** (32 - block_bits)).  So no window spans a
    group's addresses, however many it has.  What is no address is left out."""
    by = list(by)
    width = 1 << block_bits
    seen = flows.select(*by, ipv4_to_long(F.col(ip)).alias("_n")).where(F.col("_n").isNotNull()).distinct()
    seen = seen.withColumn("_block", F.expr(f"_n div {width}"))
    runs = materialised(_islands(seen, [*by, "_block"], "_n"), "address-runs")
    full = F.col("hi") - F.col("lo") == width - 1
    small = _aligned(runs.where(~full), by, block_bits)
    whole = _aligned(_islands(runs.where(full).select(*by, "_block"), by, "_block"), by, 32 - block_bits)
    whole = whole.select(*by, (F.col("start") * width).alias("start"), (F.col("k") + block_bits).alias("k"))
    octets = [F.pmod(F.shiftright("start", s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    cidr = F.concat(F.concat_ws(".", *octets), F.lit("/"), (32 - F.col("k")).cast("string"))
    return small.unionByName(whole).select(*by, cidr.alias("cidr"))
