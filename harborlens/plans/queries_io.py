"""Sources, sinks and streams: S2-S5, E4, E5, M6, G5.

Each entry writes its input to a scratch folder under the shared checkpoint
directory, runs the operator (streams: ``availableNow`` to completion) and
returns what landed in the sink, read back from storage.  The oracle is the
batch twin's SQL.  Streams with state are fed their input in slices, one micro-batch
each, so state and watermark carry across micro-batches while the result stays
exact (no slice holds rows older than the previous watermark).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from harborlens.operators import capacity as cap
from harborlens.operators import inventory as inv
from harborlens.operators.policy import POLICY_MESSAGES
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import bucket_start_sql, with_bindings
from harborlens.plans.catalog import register
from harborlens.plans.queries_capacity import COOLDOWN_S, DEMAND_SQL, STEP_S
from harborlens.plans.queries_recovery import JOB_TIMEOUT_S
from harborlens.session import scratch_path
from harborlens.sources import inventory_json as ij
from harborlens.sources import logs
from harborlens.streaming import admission, backlog_live, due, first_delivery, history, queue, sli_stream

CLUSTER = "dev-cluster"
TAIL_N = 20
BATCH_FILES = 4                        # receive batch of the queue entries, in files
SLICE = dt.timedelta(days=10)          # event time fed to the SLI stream at once
SLI_WIDTH = "1 hour"
SLI_DELAY_MIN = 10


def _scratch(t, name: str) -> str:
    return scratch_path(t.spark, f"{name}-{uuid.uuid4().hex}")


@register("queue_ingest", with_bindings("SELECT event_id, attempt FROM deliveries", "deliveries"))
def q_queue_ingest(t):
    """Every delivery consumed from the queue directory, one file per micro-batch."""
    base = _scratch(t, "queue")
    d = b.deliveries(t)
    queue.stage_files(d, f"{base}/in", order="delivered_ts")
    s = queue.queue_ingest(t.spark, f"{base}/in", d.schema, max_files=BATCH_FILES)
    queue.run_available(s.select("event_id", "attempt"), f"{base}/out", f"{base}/ckpt")
    return t.spark.read.parquet(f"{base}/out")


_ROUTED_SQL = f"""
SELECT seq, namespace_name, '/aws/eks/{CLUSTER}/' || namespace_name AS log_group, 'fb-' || namespace_name AS log_stream,
  CAST(length(log) AS BIGINT) AS log_chars, md5(log) AS log_md5 FROM log_records"""


def _text_digest(df):
    return df.select("seq", "namespace_name", *[c for c in ("log_group", "log_stream") if c in df.columns],
                     F.length("log").cast("bigint").alias("log_chars"), F.md5("log").alias("log_md5"))


@register("log_route", with_bindings(_ROUTED_SQL, "log_records"))
def q_log_route(t):
    """S3: whole log records routed to /aws/eks/<cluster>/<namespace>, written and read back."""
    path = _scratch(t, "logs")
    logs.write_routed(b.log_records(t), path, CLUSTER)
    return _text_digest(logs.read_group(t.spark, path))


@register("read_inventory", with_bindings("""
SELECT 'ec2' AS kind, concat('i-', CAST(id AS VARCHAR)) AS id, state, 't3.medium' AS type,
  concat('zone-', CAST(reservation % 3 AS VARCHAR)) AS az, tag_name AS name FROM instances""", "instances"))
def q_read_inventory(t):
    """Instance API pages stored as JSON, read back with the fixed schema and flattened."""
    path = _scratch(t, "ec2-json")
    ij.write_inventory(b.instances_api(t), path)
    ec2 = inv.flatten_ec2(ij.read_inventory(t.spark, path, "ec2", multiline=False))
    return ec2.select("kind", "id", "state", "type", "az", "name")


@register("append_and_tail", with_bindings(f"""
SELECT seq, namespace_name, CAST(length(log) AS BIGINT) AS log_chars, md5(log) AS log_md5
FROM log_records ORDER BY seq DESC LIMIT {TAIL_N}""", "log_records"))
def q_append_and_tail(t):
    """Append the log records durably, then the last 20 by sequence (a top-k report)."""
    path = _scratch(t, "append")
    return _text_digest(logs.append_and_tail(b.log_records(t), path, TAIL_N, order="seq"))


_FIRST_DELIVERY = """
SELECT event_id, user_id, event_type, CAST(value AS DOUBLE) AS value, attempt FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY delivered_ts, attempt) AS rn FROM deliveries) WHERE rn = 1"""


def _event_cols(df):
    return df.select("event_id", "user_id", "event_type", F.col("value").cast("double").alias("value"), "attempt")


ARRIVAL = dt.timedelta(days=3)         # event time of one micro-batch of the redelivery streams


@register("dedup_stream", with_bindings(_FIRST_DELIVERY, "deliveries"))
def q_dedup_stream(t):
    """The first delivery of each event, found by the stream although every redelivery overtakes it.

    An attempt arrives a slice of ``ARRIVAL`` before the attempt ahead of it, so no two
    deliveries of an event share a micro-batch and the first one comes last.  A
    heartbeat row without a key closes the stream."""
    base = _scratch(t, "dedup")
    d = b.deliveries(t)
    late = ARRIVAL * 2
    arrives = F.timestamp_add("SECOND", (3 - F.col("attempt")) * int(ARRIVAL.total_seconds()), F.col("delivered_ts"))
    beat = d.agg(F.max("delivered_ts").alias("last")).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in d.schema if f.name != "delivered_ts"],
        F.timestamp_add("SECOND", F.lit(int(late.total_seconds()) + 3600), F.col("last")).alias("delivered_ts"))
    beat = beat.withColumn("arrival_ts", F.timestamp_add("SECOND", F.lit(int((ARRIVAL * 3).total_seconds())), F.col("delivered_ts")))
    fed = d.withColumn("arrival_ts", arrives).unionByName(beat)

    def start(s):
        firsts = first_delivery.first_deliveries(s, "event_id", "delivered_ts", ("attempt",), within="15m", delay=f"{late.days} days")
        out = _event_cols(firsts.where("event_id IS NOT NULL"))
        with queue.state_partitions(t.spark):
            return out.writeStream.option("checkpointLocation", f"{base}/ckpt").format("parquet").option("path", f"{base}/out").start()

    queue.run_slices(fed, base, "arrival_ts", ARRIVAL, start)
    return t.spark.read.parquet(f"{base}/out")


@register("idempotent_write", with_bindings(_FIRST_DELIVERY, "deliveries"))
def q_idempotent_write(t):
    """E5: deliveries consumed slice by slice in delivery order into a sink with a manifest, merged every four batches."""
    base = _scratch(t, "idem")
    sink = f"{base}/sink"

    def start(s):
        return (s.writeStream.option("checkpointLocation", f"{base}/ckpt")
                .foreachBatch(history.history_writer(sink, key="event_id", buckets=4, every=4)).start())

    queue.run_slices(b.deliveries(t), base, "delivered_ts", ARRIVAL, start)
    return _event_cols(history.History(t.spark, sink, buckets=4, every=4).read())


@register("sli_stream", with_bindings(f"""
, w AS (SELECT service, {bucket_start_sql('ts', 3600)} AS window_start, count(*) AS requests,
        count(*) FILTER (WHERE status >= 500) AS errors, quantile_disc(latency_ms, 0.95) AS p95 FROM requests GROUP BY 1, 2)
SELECT service, window_start, window_start + INTERVAL '1 hour' AS window_end, requests, errors,
  round(CAST(errors AS DOUBLE) / requests, 6) AS error_ratio, round(p95, 6) AS p95_ms FROM w
WHERE window_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM requests) - INTERVAL '{SLI_DELAY_MIN} minutes'""",
                                       "requests"))
def q_sli_stream(t):
    """M6: hourly request SLIs per service, windows closed by a 10-minute watermark."""
    base = _scratch(t, "sli")
    r = b.requests(t)

    def start(s):
        out = sli_stream.sli_stream(s, width=SLI_WIDTH, delay=f"{SLI_DELAY_MIN} minutes")
        return out.writeStream.option("checkpointLocation", f"{base}/ckpt").format("parquet").option("path", f"{base}/out").start()

    queue.run_slices(r, base, "ts", SLICE, start)
    res = t.spark.read.parquet(f"{base}/out")
    return res.select("service", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "requests", "errors", "error_ratio", "p95_ms")


def _said(policy: str) -> str:
    return f"{policy}: {POLICY_MESSAGES[policy]}".replace("'", "''")


@register("admission_split", with_bindings("""
, tagged AS (SELECT *, CASE WHEN image IS NULL OR image LIKE '%@%' THEN NULL
    WHEN regexp_extract(regexp_extract(image, '[^/]*$'), ':([^:@]+)$', 1) = '' THEN 'latest'
    ELSE regexp_extract(regexp_extract(image, '[^/]*$'), ':([^:@]+)$', 1) END AS tag FROM containers)
, per_pod AS (SELECT namespace, CAST(pod AS VARCHAR) AS pod,
    concat_ws('; ', CASE WHEN bool_or(tag = 'latest' AND NOT init) THEN '""" + _said("block-latest-tag") + """' END,
      CASE WHEN bool_or(image IS NOT NULL AND NOT init AND (coalesce(length(req_cpu), 0) = 0 OR coalesce(length(lim_mem), 0) = 0))
        THEN '""" + _said("require-requests-limits") + """' END,
      CASE WHEN bool_or(privileged) THEN '""" + _said("disallow-privileged") + """' END) AS said
  FROM tagged GROUP BY namespace, pod)
SELECT namespace, pod, namespace IN ('kube-system', 'kyverno') OR said = '' AS admitted,
  CASE WHEN namespace IN ('kube-system', 'kyverno') THEN '' ELSE said END AS violations
FROM per_pod""", "containers"))
def q_admission_split(t):
    """Pods admitted or denied per micro-batch, both sinks read back."""
    base = _scratch(t, "admission")
    p = b.pods(t)
    queue.stage_files(p, f"{base}/in")
    s = queue.queue_ingest(t.spark, f"{base}/in", p.schema, max_files=BATCH_FILES)
    queue.run_available(s, f"{base}/admitted", f"{base}/ckpt",
                        foreach_batch=admission.admission_writer(f"{base}/admitted", f"{base}/denied"))
    adm = t.spark.read.parquet(f"{base}/admitted").select(
        "namespace", "pod", F.lit(True).alias("admitted"), F.lit("").alias("violations"))
    said = F.array_join(F.transform("violations", lambda v: F.concat(v["policy"], F.lit(": "), v["message"])), "; ")
    den = t.spark.read.parquet(f"{base}/denied").select("namespace", "pod", F.lit(False).alias("admitted"), said.alias("violations"))
    return adm.unionByName(den)


@register("backlog_live", with_bindings(DEMAND_SQL + """
SELECT b.queue, b.poll_ts, b.arrived, b.done, b.backlog, d.replicas FROM backlog b JOIN demand d ON d.queue = b.queue AND d.poll_ts = b.poll_ts""", "jobs"))
def q_backlog_live(t):
    """B1 and B2 live: arrivals joined with completions up to a day later as both stream in; heartbeats close the last polls."""
    base = _scratch(t, "backlog")
    j = b.jobs(t)
    end = j.agg(F.max(F.greatest("arrived_ts", "done_ts")).alias("last")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(backlog_live.HEARTBEAT).alias("queue"), F.timestamp_add("DAY", F.lit(3), F.col("last")).alias("ts"))
    fed = (j.select("event_id", "queue", F.col("arrived_ts").alias("ts"), F.lit("arrival").alias("kind"))
           .unionByName(j.select("event_id", "queue", F.col("done_ts").alias("ts"), F.lit("completion").alias("kind")))
           .unionByName(end.withColumn("kind", F.lit("arrival"))).unionByName(end.withColumn("kind", F.lit("completion"))))

    def start(s):
        again = queue.queue_ingest(t.spark, f"{base}/in", fed.schema, options={"recursiveFileLookup": "true"})
        arrivals = s.where("kind = 'arrival'").withColumnRenamed("ts", "arrived_ts")
        completions = again.where("kind = 'completion'").withColumnRenamed("ts", "done_ts")
        return backlog_live.follow_backlog(arrivals, completions, f"{base}/changes", f"{base}/ckpt", step_s=STEP_S, max_service="24h")

    queue.run_slices(fed, base, "ts", SLICE, start)
    series = backlog_live.closed_backlog(t.spark, f"{base}/changes", step_s=STEP_S).withColumn("poll_ts", F.col("poll_ts").cast("timestamp_ntz"))
    demand = cap.replica_demand(series, per=5, lo=0, hi=5, cooldown_s=COOLDOWN_S)
    return series.join(demand.select("queue", "poll_ts", "replicas"), ["queue", "poll_ts"])


def _beat(df, key: str, ts: str, **values):
    """A row of a key of its own, long after all others: what a platform that has gone quiet sends, so that all timers are passed."""
    cols = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in df.schema if f.name not in (ts,)]
    return df.unionByName(df.agg(F.max(ts).alias(ts)).select(*cols, F.timestamp_add("DAY", F.lit(30), F.col(ts)).alias(ts)))


@register("outcomes_due", with_bindings(f"""
, g AS (SELECT job, min(ts) AS start_ts, min(ts) FILTER (WHERE phase IN ('Completed', 'Failed', 'PartiallyFailed')) AS end_ts,
    arg_min(phase, ts) FILTER (WHERE phase IN ('Completed', 'Failed', 'PartiallyFailed')) AS end_phase FROM phases GROUP BY job)
, o AS (SELECT *, coalesce(end_ts <= start_ts + INTERVAL '{JOB_TIMEOUT_S} seconds', FALSE) AS in_time FROM g)
SELECT job, start_ts, CASE WHEN in_time THEN end_ts ELSE start_ts + INTERVAL '{JOB_TIMEOUT_S} seconds' END AS decided_ts,
  CASE WHEN NOT in_time THEN 'timed_out' WHEN end_phase = 'Completed' THEN 'completed' ELSE 'failed' END AS outcome FROM o""", "phases"))
def q_outcomes_due(t):
    """R5 live: every job's verdict at the time it is due, from the stream of phases in slices of a year."""
    base = _scratch(t, "outcomes")
    p = b.phases(t).select("job", F.col("ts").cast("timestamp_ntz").alias("ts"), "phase")

    def start(s):
        out = due.outcomes_due(s, timeout_s=JOB_TIMEOUT_S).where("job <> -1")
        with queue.state_partitions(t.spark):
            return out.writeStream.option("checkpointLocation", f"{base}/ckpt").format("parquet").option("path", f"{base}/out").start()

    queue.run_slices(_beat(p, "job", "ts", job=-1, phase="InProgress"), base, "ts", dt.timedelta(days=365), start)
    out = t.spark.read.parquet(f"{base}/out")
    return out.select("job", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"), F.col("decided_ts").cast("timestamp_ntz").alias("decided_ts"), "outcome")


@register("retries_due", with_bindings("""
, f AS (SELECT event_id, attempt, outcome, delivered_ts, delivered_ts + INTERVAL '1' SECOND * CAST(30 * pow(2, attempt - 1) AS BIGINT) AS due_ts FROM attempts)
SELECT event_id, attempt, CASE WHEN attempt < 3 THEN due_ts ELSE delivered_ts END AS due_ts, CASE WHEN attempt < 3 THEN 'retry' ELSE 'exhausted' END AS status
FROM f WHERE outcome = 'failed' AND (attempt >= 3 OR NOT EXISTS (
  SELECT 1 FROM attempts a WHERE a.event_id = f.event_id AND a.attempt > f.attempt AND a.delivered_ts <= f.due_ts))""", "attempts"))
def q_retries_due(t):
    """E7 live: retries when their backoff is over, and events whose attempts are used up."""
    base = _scratch(t, "retries")
    a = b.attempts(t)

    def start(s):
        out = due.retries_due(s).where("event_id <> -1")
        with queue.state_partitions(t.spark):
            return out.writeStream.option("checkpointLocation", f"{base}/ckpt").format("parquet").option("path", f"{base}/out").start()

    queue.run_slices(_beat(a, "event_id", "delivered_ts", event_id=-1, attempt=1, outcome="ok"), base, "delivered_ts", SLICE, start)
    return t.spark.read.parquet(f"{base}/out").select("event_id", "attempt", F.col("due_ts").cast("timestamp_ntz").alias("due_ts"), "status")
