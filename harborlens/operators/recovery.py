"""Backup and restore: snapshot, selective restore, verification, expiry, job
outcomes and recovery gaps.

Scale notes.  R1/R2 use the partition layout (``backup_name=`` directories) so a
restore reads only its backup.  R3 is one full outer join on the object key.
R5 is one aggregation per job (``min``/``max_by``: partial aggregation).  R6 is
an as-of lookup in both directions without a non-equi join: events of all kinds
are unioned and scanned with windows partitioned by (system, time bucket), so a
system holding a third of all rows still spreads over its buckets; what a bucket
needs from earlier/later buckets comes from a per-bucket series (one row per
bucket) joined back on (system, bucket).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlens.functions.scalars import duration_seconds, micros_between, ts_literal


def _secs_between(later: Column, earlier: Column, dtype=None) -> Column:
    """Exact seconds between two timestamps, as DOUBLE (microsecond precision)."""
    return micros_between(later, earlier, dtype) / 1_000_000


def backup_snapshot(objects: DataFrame, namespaces: Sequence[str], name: str, at: dt.datetime,
                    path: str, ttl: str = "720h0m0s", ns_col: str = "namespace") -> DataFrame:
    """Write the rows of the named namespaces under ``backup_name=<name>``
    with creation and expiry times.  Dynamic partition overwrite replaces only
    this backup, so a retried job is idempotent.  Returns the written rows as
    read back from storage."""
    ttl_s = F.lit(None) if ttl is None else duration_seconds(F.lit(ttl))
    snap = (objects.where(F.col(ns_col).isin(*namespaces))
            .withColumn("created_ts", ts_literal(at))
            .withColumn("expires_ts", F.timestamp_add("SECOND", ttl_s, F.col("created_ts")))
            .withColumn("backup_name", F.lit(name)))
    # rebalance: AQE sizes the files (one backup is one partition value, so a
    # plain repartition on it would funnel everything through one task)
    (snap.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("backup_name").parquet(path))
    return read_backups(objects.sparkSession, path).where(F.col("backup_name") == name)


def read_backups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def restore_select(backups: DataFrame, name: str, namespaces: Sequence[str] | None = None,
                   include_volumes: bool = False, ns_col: str = "namespace", kind_col: str = "kind") -> DataFrame:
    """R2: rows of one backup (partition filter, pruned at the scan), limited to
    some namespaces; volume rows are left out unless asked for."""
    out = backups.where(F.col("backup_name") == name)
    if namespaces is not None:
        out = out.where(F.col(ns_col).isin(*namespaces))
    if not include_volumes and kind_col in backups.columns:
        out = out.where(F.col(kind_col).isNull() | (F.col(kind_col) != "volume"))
    return out


def comparable(c: str, dtype: T.DataType) -> Column:
    """A column as an array of hashable values: whether it is NULL, then the value.

    A row hash skips NULLs, so without the flag ('x', NULL) and (NULL, 'x') would
    hash alike.  MAP values, which have no hash, become their sorted entries, at
    any depth; the flags go down into structs, arrays and maps as well."""
    return _with_flags(F.col(f"`{c}`"), dtype)


def _with_flags(v: Column, dtype: T.DataType) -> Column:
    null = v.isNull()
    if isinstance(dtype, T.MapType):
        v = F.array_sort(F.transform(F.map_entries(v), lambda e: F.struct(
            _with_flags(e["key"], dtype.keyType).alias("k"), _with_flags(e["value"], dtype.valueType).alias("v"))))
    elif isinstance(dtype, T.ArrayType):
        v = F.transform(v, lambda e: _with_flags(e, dtype.elementType))
    elif isinstance(dtype, T.StructType):
        v = F.struct(*[_with_flags(v[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)])
    return F.struct(null.alias("null"), v.alias("value"))


def restore_verify(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Per key ``same``, ``missing`` (only before), ``extra`` (only after) or
    ``changed``.

    Each side is reduced to one row per key first: the row count and the sums of
    two 64-bit hashes of all non-key columns, NULLs told apart from values (an
    order-free multiset digest, partial aggregation map-side).  The full outer
    join is then 1:1 per key, however many copies of a key either side holds, and
    null-safe: a NULL key is one key.  The sides must have the same columns with
    the same types; a key cannot be ``same`` when a column was added, dropped or
    retyped, so every key on both sides is then ``changed``."""
    keys = [key] if isinstance(key, str) else list(key)
    types = [{f.name: f.dataType for f in df.schema if f.name not in keys} for df in (before, after)]

    def digest(df: DataFrame, name: str, of: dict) -> DataFrame:
        values = [comparable(c, of[c]) for c in sorted(of)]
        h = [F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)") for seed in (1, 2)]
        return df.groupBy(*[F.col(k).alias(f"{name}_k{i}") for i, k in enumerate(keys)]).agg(
            F.count(F.lit(1)).alias(name + "_n"), F.sum(h[0]).alias(name + "_1"), F.sum(h[1]).alias(name + "_2"))

    on = F.lit(True)
    for i in range(len(keys)):
        on = on & F.col(f"b_k{i}").eqNullSafe(F.col(f"a_k{i}"))
    j = digest(before, "b", types[0]).join(digest(after, "a", types[1]), on, "full_outer")
    equal = (F.col("a_n") == F.col("b_n")) & (F.col("a_1") == F.col("b_1")) & (F.col("a_2") == F.col("b_2"))
    status = (F.when(F.col("a_n").isNull(), "missing").when(F.col("b_n").isNull(), "extra")
              .when(equal & F.lit(types[0] == types[1]), "same").otherwise("changed"))
    return j.select(*[F.coalesce(f"b_k{i}", f"a_k{i}").alias(k) for i, k in enumerate(keys)], status.alias("status"))


def expire_backups(backups: DataFrame, as_of: dt.datetime, ts: str = "ts", ttl: str = "720h0m0s",
                   expires: str = "expires_ts") -> DataFrame:
    """Backups whose expiry is at or before ``as_of``.

    A backup's own expiry (column ``expires``, as R1 writes it) counts; NULL there
    means that it never expires.  Only a table without that column is given one
    ``ttl`` for all, from column ``ts``.  Either way the filter compares a stored
    column with a literal, so it reaches the scan."""
    if expires in backups.columns:
        return backups.where(F.col(expires) <= ts_literal(as_of))
    secs = ttl_seconds(ttl)
    out = backups.where(F.col(ts) <= ts_literal(as_of - dt.timedelta(seconds=secs)))
    return out.withColumn(expires, F.timestamp_add("SECOND", F.lit(secs), F.col(ts)))


def ttl_seconds(ttl: str) -> int:
    """Seconds of a fixed duration such as ``720h0m0s`` (a parameter, not a column)."""
    parts = re.findall(r"(\d+)([dhms])", ttl)
    if not parts or "".join(n + u for n, u in parts) != ttl:
        raise ValueError(f"not a duration: {ttl!r}")
    return sum(int(n) * {"d": 86400, "h": 3600, "m": 60, "s": 1}[u] for n, u in parts)


TERMINAL_OK = ("Completed",)
TERMINAL_FAILED = ("Failed", "PartiallyFailed")


def job_outcome(status_rows: DataFrame, as_of: dt.datetime, timeout_s: int = 600, job: str = "job",
                ts: str = "ts", phase: str = "phase", carry: Sequence[str] = ()) -> DataFrame:
    """Per job: start, first terminal phase, exact duration and outcome.

    ``completed``/``failed`` when a terminal phase arrives within ``timeout_s``
    (strictly greater is a timeout); ``timed_out`` when it arrives later or,
    with none yet, when more than ``timeout_s`` have passed at ``as_of``;
    otherwise ``running``.  ``carry`` names columns that are a job's own, such as
    its kind, and come along."""
    terminal = F.col(phase).isin(*TERMINAL_OK, *TERMINAL_FAILED)
    g = status_rows.groupBy(job).agg(
        *[F.max(c).alias(c) for c in carry],
        F.min(ts).alias("start_ts"),
        F.min(F.when(terminal, F.col(ts))).alias("end_ts"),
        F.min_by(F.when(terminal, F.col(phase)), F.when(terminal, F.col(ts))).alias("end_phase"),
        # ties on ts: a terminal phase is later than the InProgress beside it
        F.max_by(phase, F.struct(F.col(ts), terminal)).alias("last_phase"))
    now = ts_literal(as_of)
    tt = status_rows.schema[ts].dataType
    dur = F.when(F.col("end_ts").isNotNull(), _secs_between(F.col("end_ts"), F.col("start_ts"), tt)) \
        .otherwise(_secs_between(now.cast(tt), F.col("start_ts"), tt))
    outcome = (F.when(dur > timeout_s, "timed_out")
               .when(F.col("end_phase").isin(*TERMINAL_OK), "completed")
               .when(F.col("end_phase").isin(*TERMINAL_FAILED), "failed")
               .otherwise("running"))
    return g.select(job, *carry, "start_ts", "end_ts", "end_phase", "last_phase", dur.alias("duration_s"),
                    outcome.alias("outcome"))


def rpo_rto(incidents: DataFrame, backups: DataFrame, restores: DataFrame, by: str = "system", ts: str = "ts",
            incident: str = "incident", bucket: str = "1 hour") -> DataFrame:
    """Per incident, the last completed backup at or before it and the first
    completed restore strictly after it (same system); RPO/RTO in seconds, NULL
    when there is none.  ``bucket`` is the time slice a window partition holds
    for one system; finer slices spread a hot system over more tasks, while the
    carry series grows only by one row per slice."""
    # Ties: backup < restore < incident, so a backup at the incident time counts
    # and a restore at the incident time does not.
    u = (backups.select(by, ts, F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("iid"))
         .unionByName(restores.select(by, ts, F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("iid")))
         .unionByName(incidents.select(by, ts, F.lit(2).alias("kind"), F.col(incident).cast("bigint").alias("iid")))
         .withColumn("bucket", F.window(ts, bucket)["start"]))
    w = Window.partitionBy(by, "bucket").orderBy(ts, "kind")
    bts = F.when(F.col("kind") == 0, F.col(ts))
    rts = F.when(F.col("kind") == 1, F.col(ts))
    inner = u.select(by, "bucket", ts, "kind", "iid",
                     F.last(bts, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("b_in"),
                     F.first(rts, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("r_in"))
    per_bucket = u.groupBy(by, "bucket").agg(F.max(bts).alias("b_max"), F.min(rts).alias("r_min"))
    wb = Window.partitionBy(by).orderBy("bucket")
    carry = per_bucket.select(
        by, "bucket",
        F.max("b_max").over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("b_carry"),
        F.min("r_min").over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("r_carry"))
    tt = incidents.schema[ts].dataType
    inc = inner.where(F.col("kind") == 2).join(carry, [by, "bucket"], "left")
    last_b = F.coalesce(F.col("b_in"), F.col("b_carry"))
    next_r = F.coalesce(F.col("r_in"), F.col("r_carry"))
    return inc.select(F.col("iid").alias(incident), by, ts, last_b.alias("last_backup_ts"),
                      next_r.alias("first_restore_ts"),
                      _secs_between(F.col(ts), last_b, tt).alias("rpo_s"),
                      _secs_between(next_r, F.col(ts), tt).alias("rto_s"))
