"""Scalar Column expressions.  All built-in Spark functions run in the JVM with
no Python at run time; most compile in whole-stage codegen, the few built on
higher-order functions (tag lookup, label merge) run interpreted in the stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix multipliers of Kubernetes resource quantities.
BINARY_SUFFIXES = {"Ki": 1024, "Mi": 1024 ** 2, "Gi": 1024 ** 3, "Ti": 1024 ** 4, "Pi": 1024 ** 5, "Ei": 1024 ** 6}
DECIMAL_SUFFIXES = {"k": 10 ** 3, "M": 10 ** 6, "G": 10 ** 9, "T": 10 ** 12, "P": 10 ** 15, "E": 10 ** 18}
# Unit lengths in seconds of Go-style and shorthand durations.
DURATION_UNITS = {"d": 86400, "h": 3600, "m": 60, "s": 1}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def missing_to_null(col) -> Column:
    """Empty string and the literal texts None/null become NULL (ingest rule)."""
    c = _c(col)
    return F.when(c.isin("", "None", "null"), F.lit(None)).otherwise(c)


def default_if_empty(col, default) -> Column:
    """Shell ``${X:-d}``: the default applies when unset *or* empty."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default) if not isinstance(default, Column) else default)


def strip_trailing_dot(col) -> Column:
    return F.regexp_replace(_c(col), r"\.$", "")


def strip_hosted_zone(col) -> Column:
    return F.regexp_replace(_c(col), r"^/hostedzone/", "")


def cpu_millis(col) -> Column:
    """CPU quantity to milli-CPU: ``900m`` -> 900, ``2`` -> 2000, ``0.5`` -> 500."""
    c = F.trim(_c(col))
    milli = c.endswith("m")
    body = F.when(milli, F.left(c, F.length(c) - 1)).otherwise(c)
    num = body.try_cast("double")
    return F.ceil(F.when(num >= 0, F.when(milli, num).otherwise(num * 1000))).cast("bigint")


def memory_bytes(col) -> Column:
    """Memory quantity to bytes: ``128Mi``, ``1Gi``, ``500M``, ``1024``."""
    c = F.trim(_c(col))
    num = F.regexp_extract(c, r"^([0-9.]+)", 1).try_cast("double")
    unit = F.regexp_extract(c, r"^[0-9.]+([A-Za-z]*)$", 1)
    mult = F.when(unit == "", F.lit(1))
    for suffix, m in {**BINARY_SUFFIXES, **DECIMAL_SUFFIXES}.items():
        mult = mult.when(unit == suffix, F.lit(m))
    return F.when(c.rlike(r"^[0-9.]+[A-Za-z]*$"), F.ceil(num * mult).cast("bigint"))


def duration_seconds(col) -> Column:
    """``720h0m0s``, ``7d``, ``1m``, ``15s`` to seconds (BIGINT); NULL if malformed."""
    c = F.trim(_c(col))
    total = F.lit(0).cast("bigint")
    for unit, secs in DURATION_UNITS.items():
        part = F.regexp_extract(c, rf"([0-9]+){unit}", 1)
        total = total + F.coalesce(F.nullif(part, F.lit("")).cast("bigint"), F.lit(0)) * secs
    return F.when(c.rlike(r"^([0-9]+[dhms])+$"), total)


def ipv4_to_long(col) -> Column:
    """Dotted quad to BIGINT; NULL if not an IPv4 address.

    ``substring_index`` and ``try_cast`` instead of regular expressions: no
    regex per row, and whole-stage codegen throughout."""
    c = _c(col)
    octets = [F.substring_index(c, ".", 1),
              F.substring_index(F.substring_index(c, ".", 2), ".", -1),
              F.substring_index(F.substring_index(c, ".", 3), ".", -1),
              F.substring_index(c, ".", -1)]
    nums = [o.try_cast("int") for o in octets]
    value = F.lit(0).cast("bigint")
    valid = (F.length(c) - F.length(F.replace(c, F.lit("."), F.lit("")))) == 3
    for o, n in zip(octets, nums):
        value = value * 256 + n.cast("bigint")
        valid = valid & n.between(0, 255) & (F.length(o) > 0) & (F.length(o) <= 3)
    return F.when(valid, value)


def cidr_prefix(col) -> Column:
    return F.coalesce(F.regexp_extract(_c(col), r"/(\d+)$", 1).try_cast("int"), F.lit(32))


def cidr_low(col) -> Column:
    """First address of a CIDR block (inclusive)."""
    base = ipv4_to_long(F.regexp_extract(_c(col), r"^([0-9.]+)", 1))
    size = F.pow(F.lit(2), 32 - cidr_prefix(col)).cast("bigint")
    return base - F.pmod(base, size)


def cidr_high(col) -> Column:
    """Last address of a CIDR block (inclusive)."""
    size = F.pow(F.lit(2), 32 - cidr_prefix(col)).cast("bigint")
    return cidr_low(col) + size - 1


def image_tag(col) -> Column:
    """Tag of a container image reference.

    ``repo@sha256:..`` (digest) -> NULL (pinned, no tag); ``reg:5000/app`` -> ``latest``
    (a registry port is not a tag); ``reg:5000/app:v1`` -> ``v1``.
    """
    c = _c(col)
    last = F.substring_index(c, "/", -1)  # the registry host (and its port) is never in the last segment
    tag = F.when(last.contains(":"), F.substring_index(last, ":", -1)).otherwise(F.lit(""))
    return F.when(c.isNull(), F.lit(None)).when(c.contains("@"), F.lit(None)) \
        .when(tag == "", F.lit("latest")).otherwise(tag)


def tag_value(tags, key: str) -> Column:
    """``Tags[?Key=='k'] | [0].Value``: NULL when the key is absent."""
    return F.get(F.filter(_c(tags), lambda t: t["Key"] == key), 0)["Value"]


def tags_to_map(tags) -> Column:
    """Key/value list to MAP; a repeated key keeps its last value."""
    t = _c(tags)
    # keep an entry only if no later entry repeats its key (map_from_entries rejects duplicates)
    last = F.filter(t, lambda e, i: ~F.exists(F.slice(t, i + 2, F.greatest(F.size(t), F.lit(1))),
                                              lambda x: x["Key"] == e["Key"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["Key"].alias("key"),
                                                                   e["Value"].alias("value"))))


def merge_labels(old, new) -> Column:
    """Overwrite-merge of two label maps (new wins); no duplicate-key error."""
    o, n = _c(old), _c(new)
    return F.map_concat(F.map_filter(F.coalesce(o, F.create_map().cast("map<string,string>")),
                                     lambda k, v: ~F.map_contains_key(n, k)), n)


def sorted_map_json(col) -> Column:
    """Deterministic JSON text of a string map (entries sorted by key)."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_c(col)))))


def ratio(num, den, scale: int = 6) -> Column:
    """num/den rounded to ``scale`` places as DOUBLE; NULL when den is 0."""
    return F.round(_c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double"), scale)


def template(text: str, **values) -> Column:
    """``${NAME}`` substitution: each placeholder replaced by a Column or literal
    (one ``concat``; unknown placeholders stay as written)."""
    import re as _re
    parts, pos = [], 0
    for m in _re.finditer(r"\$\{(\w+)\}", text):
        parts.append(F.lit(text[pos:m.start()]))
        v = values.get(m.group(1))
        parts.append(F.lit(m.group(0)) if v is None else (v if isinstance(v, Column) else F.lit(str(v))))
        pos = m.end()
    parts.append(F.lit(text[pos:]))
    return F.concat(*parts)


def slice0(arr, start: int, end: int) -> Column:
    """0-based, end-exclusive ``slice(list, start, end)`` on a Spark array."""
    return F.slice(_c(arr), start + 1, max(end - start, 0))


def compact_stamp(ts) -> Column:
    """``date +%Y%m%d%H%M%S`` of a timestamp."""
    return F.date_format(_c(ts), "yyyyMMddHHmmss")


def epoch_seconds(ts) -> Column:
    """``date +%s`` of a timestamp (UTC session)."""
    return F.unix_timestamp(_c(ts).cast("timestamp"))


def ts_literal(value) -> Column:
    """A naive ``datetime`` as a TIMESTAMP_NTZ literal, independent of the Python
    process's and the session's time zones (``F.lit(datetime)`` is not)."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_micros(col, dtype=None) -> Column:
    """Microseconds since 1970-01-01 00:00:00.

    TIMESTAMP_NTZ (the default): wall-clock arithmetic from the date and the
    time-of-day fields, all zone-free, so no session time zone (and no DST
    gap) can shift or merge values.  TIMESTAMP: the physical ``unix_micros``."""
    from pyspark.sql import types as T
    c = _c(col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint")
    frac = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return days * 86_400_000_000 + secs * 1_000_000 + frac


def micros_between(later, earlier, dtype=None) -> Column:
    """Microseconds from ``earlier`` to ``later`` (see ``epoch_micros``)."""
    return epoch_micros(later, dtype) - epoch_micros(earlier, dtype)
