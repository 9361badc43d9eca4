"""Event correctness: replica assignment, duplicates, dedup, consistency, retries.

Scale notes.  Every per-event operator groups by the event key, which has high
cardinality; the per-group outputs (report by type, consistency by replica
count) are tiny.  "First/latest per key" is an aggregate (``min_by``/``max_by``)
rather than a ``row_number`` window: the aggregate runs a map-side partial step,
so a key holding a third of all rows is reduced inside each map task instead of
landing whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.functions.scalars import ratio


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def replica_expr(key: Column, attempt: Column, n, method: str = "xxhash64") -> Column:
    """Worker index in [0, n): a redelivery moves on to the next worker."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    base = F.xxhash64(key) if method == "xxhash64" else key.cast("bigint")
    return F.pmod(base + attempt.cast("bigint") - 1, n_col.cast("bigint")).cast("int")


def assign_replica(df: DataFrame, key: str, attempt: str = "attempt", n: int = 5,
                   method: str = "xxhash64", out: str = "replica") -> DataFrame:
    """Spread keys over ``n`` workers of one consumer group (narrow, no shuffle).

    ``method="plain"`` uses the key value itself (needed where an SQL oracle
    has no xxhash64)."""
    return df.withColumn(out, replica_expr(F.col(key), F.col(attempt), n, method))


def duplicate_report(deliveries: DataFrame, by: str | Sequence[str] = "event_type",
                     key: str = "event_id") -> DataFrame:
    """Deliveries, distinct events, duplicates and duplicate ratio per group.

    Two aggregations: deliveries per event (shuffle on the event key with
    partial aggregation), then a sum per group (a handful of groups).  No
    ``countDistinct`` expand."""
    by = _cols(by)
    per_event = deliveries.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    return (per_event.groupBy(*by)
            .agg(F.sum("n").alias("deliveries"),
                 F.count(F.lit(1)).alias("distinct_events"),
                 F.sum(F.col("n") - 1).alias("duplicates"))
            .withColumn("dup_ratio", ratio("duplicates", "deliveries")))


def dedup(deliveries: DataFrame, key: str | Sequence[str] = "event_id",
          order: Sequence[str] = ("delivered_ts", "attempt")) -> DataFrame:
    """Keep the first delivery per event (earliest by ``order``).

    ``min_by`` over a struct of the row is an aggregate, so it combines map-side.
    Idempotent: ``dedup(dedup(x)) == dedup(x)``.  Rows without a key cannot be told
    to be the same event, so all of them are kept."""
    keys = _cols(key)
    rest = [c for c in deliveries.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_first")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    kept = deliveries.where(known).groupBy(*keys).agg(first).select(*keys, "_first.*")
    return kept.unionByName(deliveries.where(~known).select(*keys, *rest))


def replica_consistency(deliveries: DataFrame, truth: DataFrame, key: str = "user_id",
                        value: str = "value", event: str = "event_id",
                        attempt: str = "attempt", replicas: Sequence[int] = (1, 2, 5),
                        method: str = "plain", order: Sequence[str] = ("delivered_ts", "attempt")) -> DataFrame:
    """Final per-key totals at several replica counts, naive vs idempotent,
    compared with the truth.

    An event's value is that of its first delivery.  idempotent: every event once
    (what E3/E5 guarantee).  naive: each replica only remembers the events it saw
    itself, so an event counts once for every replica that saw it.  Output: one row
    per (replicas, mode) with the number of keys and the number whose total differs
    from the truth.

    One shuffle on the event (first value, and the set of replicas that saw it at
    each replica count, at most n values) and one on the key, for computed and true
    rows together; the results at all replica counts lie side by side in one row
    until the end."""
    counts = [int(n) for n in replicas]

    def seen_by(n: int) -> Column:
        r = replica_expr(F.col(key), F.col(attempt), n, method)
        if n <= 63:
            return F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), r)))
        return F.size(F.collect_set(r))

    per_event = deliveries.groupBy(event, key).agg(
        F.min_by(value, F.struct(*[F.col(c) for c in order])).alias("_v"), *[seen_by(n).alias(f"_r{n}") for n in counts])
    # Computed and true rows meet in one aggregation by key, NULL keys included, and not in a join.
    each = per_event.select(key, F.col("_v").alias("_idem"), *[(F.col("_v") * F.col(f"_r{n}")).alias(f"_n{n}") for n in counts])
    both = each.unionByName(truth.select(key, F.col(value).alias("_truth")), allowMissingColumns=True)
    joined = both.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("_idem", *(f"_n{n}" for n in counts), "_truth")])
    rows = F.array(*[F.struct(F.lit(n).alias("replicas"), F.lit(m).alias("mode"),
                              (~F.col(c).cast("decimal(38,6)").eqNullSafe(F.col("_truth").cast("decimal(38,6)"))).alias("differs"))
                     for n in counts for m, c in (("naive", f"_n{n}"), ("idempotent", "_idem"))])
    return (joined.select(F.inline(rows)).groupBy("replicas", "mode")
            .agg(F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("differs"), 1)).alias("keys_differ")))


def retry_schedule(attempts: DataFrame, key: str = "event_id", attempt: str = "attempt",
                   ts: str = "delivered_ts", outcome: str = "outcome", base_s: int = 30,
                   max_attempts: int = 3) -> DataFrame:
    """Latest attempt per event and what happens next.

    ``status``: ``done`` (latest attempt ok), ``retry`` (failed, attempts left;
    ``next_retry_ts`` = last try + base * 2^(attempt-1) seconds) or
    ``exhausted`` (failed at the attempt limit)."""
    latest = (attempts.groupBy(key)
              .agg(F.max_by(F.struct(F.col(attempt).alias("attempt"), F.col(ts).alias("last_ts"),
                                     F.col(outcome).alias("outcome")),
                            F.struct(F.col(attempt), F.col(ts))).alias("_l"))
              .select(key, "_l.*"))
    failed = F.col("outcome") == "failed"
    can_retry = failed & (F.col("attempt") < max_attempts)
    backoff = (F.lit(base_s) * F.pow(F.lit(2), F.col("attempt") - 1)).cast("bigint")
    return latest.select(
        key, "attempt", "outcome", "last_ts",
        F.when(can_retry, F.timestamp_add("SECOND", backoff, F.col("last_ts"))).alias("next_retry_ts"),
        F.when(~failed, "done").when(can_retry, "retry").otherwise("exhausted").alias("status"))
