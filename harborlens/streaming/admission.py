"""Admission control on a stream of pods (enforce mode).

One ``foreachBatch``: the batch is cached once, every policy is evaluated once
into an array of violations, and two filters route admitted and denied pods
to their sinks.  The same function run on a batch DataFrame is the
``background`` audit of existing pods.  Outputs are written under
``batch_id=B`` so a replayed batch overwrites instead of duplicating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.operators.policy import POLICIES, POLICY_EXCLUDED_NAMESPACES, POLICY_MESSAGES, privileged_violation


def with_violations(pods: DataFrame, exclude=POLICY_EXCLUDED_NAMESPACES, policies=tuple(POLICIES), strict: bool = False) -> DataFrame:
    """Adds ``violations``: array of (policy, message) the pod breaks; excluded
    namespaces are never checked.  ``strict``: the literal reading of the privileged rule."""
    def hit(p):
        return privileged_violation(strict=strict) if p == "disallow-privileged" else POLICIES[p]()
    checks = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(POLICY_MESSAGES[p]).alias("message"),
                                hit(p).alias("hit")) for p in policies])
    hits = F.transform(F.filter(checks, lambda x: x["hit"]), lambda x: F.struct(x["policy"], x["message"]))
    excluded = F.col("namespace").isin(*exclude)
    empty = F.array().cast("array<struct<policy:string,message:string>>")
    return pods.withColumn("violations", F.when(excluded, empty).otherwise(hits))


def split(pods: DataFrame, policies=tuple(POLICIES), checked: DataFrame | None = None, strict: bool = False
          ) -> tuple[DataFrame, DataFrame]:
    """(admitted, denied) of a batch: the enforce split, or the background audit
    of existing pods when applied to a table.  ``checked`` = pods already
    carrying ``violations`` (e.g. cached), so the policies run once."""
    v = checked if checked is not None else with_violations(pods, policies=policies, strict=strict)
    admitted = v.where(F.size("violations") == 0).drop("violations")
    denied = v.where(F.size("violations") > 0).select("namespace", "pod", "violations")
    return admitted, denied


def admission_writer(admitted_sink: str, denied_sink: str, policies=tuple(POLICIES), strict: bool = False):
    """``foreachBatch`` function for the enforce-mode split."""

    def write(batch: DataFrame, batch_id: int) -> None:
        b = with_violations(batch, policies=policies, strict=strict).persist()  # policies evaluated once per batch
        try:
            admitted, denied = split(batch, policies, checked=b)
            admitted.write.mode("overwrite").parquet(f"{admitted_sink}/batch_id={batch_id}")
            denied.write.mode("overwrite").parquet(f"{denied_sink}/batch_id={batch_id}")
        finally:
            b.unpersist()

    return write


def admission_split(stream: DataFrame, admitted_sink: str, denied_sink: str, checkpoint: str,
                    policies=tuple(POLICIES), trigger: dict | None = None):
    """Start the enforce-mode split of a pod stream into two sinks."""
    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(admission_writer(admitted_sink, denied_sink, policies)).start())
