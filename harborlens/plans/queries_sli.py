"""M1-M5 bound to requests: daily p95, hourly error ratio, alert episodes over
the hourly series, SLO attainment of the daily p95, retention as of a date."""

from __future__ import annotations

import datetime as dt
import uuid

from harborlens.operators import sketches, sli
from harborlens.plans import bindings as b
from harborlens.plans.binding_sql import bucket_start_sql, with_bindings
from harborlens.plans.catalog import register
from harborlens.session import scratch_path

ALERT_THRESHOLD = 0.25
ALERT_FOR_N = 2
P95_OBJECTIVE_MS = 150.0
SLO_TARGET = 0.5
RETAIN_AS_OF = dt.datetime(2024, 1, 30)

_HOURLY = f"""
, hourly AS (SELECT service, {bucket_start_sql('ts', 3600)} AS window_start, count(*) AS requests,
  count(*) FILTER (WHERE status >= 500) AS errors FROM requests GROUP BY 1, 2)"""

_DAILY_P95 = f"""
, daily AS (SELECT service, {bucket_start_sql('ts', 86400)} AS window_start, count(*) AS requests,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms FROM requests GROUP BY 1, 2)"""


@register("latency_p95", with_bindings(_DAILY_P95 + """
SELECT service, window_start, window_start + INTERVAL '1 day' AS window_end, requests, p95_ms FROM daily""",
                                       "requests"))
def q_latency_p95(t):
    """M1: exact p95 per service and day."""
    return sli.latency_p95(b.requests(t), width="1 day")


@register("error_ratio", with_bindings(_HOURLY + """
SELECT service, window_start, window_start + INTERVAL '1 hour' AS window_end, requests, errors,
  round(CAST(errors AS DOUBLE) / requests, 6) AS error_ratio FROM hourly""", "requests"))
def q_error_ratio(t):
    """M2: 5xx share per service and hour."""
    return sli.error_ratio(b.requests(t), width="1 hour")


@register("alert_episodes", with_bindings(_HOURLY + f"""
, series AS (SELECT service, window_start, round(CAST(errors AS DOUBLE) / requests, 6) AS error_ratio FROM hourly)
, breach AS (SELECT *, CAST(floor(epoch_us(window_start) / 3600000000) AS BIGINT) AS idx FROM series
             WHERE error_ratio > {ALERT_THRESHOLD})
, isl AS (SELECT *, idx - row_number() OVER (PARTITION BY service ORDER BY idx) AS grp FROM breach)
, ep AS (SELECT service, min(window_start) AS start_ts, max(window_start) AS last_ts, count(*) AS windows,
         max(error_ratio) AS peak FROM isl GROUP BY service, grp)
SELECT service, start_ts, last_ts + INTERVAL '1 hour' AS end_ts, windows, round(peak, 6) AS peak
FROM ep WHERE windows >= {ALERT_FOR_N}""", "requests"))
def q_alert_episodes(t):
    """M3: error ratio above 0.25 for at least 2 consecutive hours."""
    series = sli.error_ratio(b.requests(t), width="1 hour")
    return sli.alert_episodes(series, threshold=ALERT_THRESHOLD, for_n=ALERT_FOR_N, width_s=3600)


@register("slo_attainment", with_bindings(_DAILY_P95 + f"""
SELECT service, count(*) AS windows, count(*) FILTER (WHERE p95_ms <= {P95_OBJECTIVE_MS}) AS good_windows,
  round(CAST(count(*) FILTER (WHERE p95_ms <= {P95_OBJECTIVE_MS}) AS DOUBLE) / count(*), 6) AS attainment,
  count(*) FILTER (WHERE p95_ms <= {P95_OBJECTIVE_MS}) >= {SLO_TARGET} * count(*) AS met
FROM daily GROUP BY service""", "requests"))
def q_slo_attainment(t):
    """M4: daily p95 within 150 ms on at least half of the days."""
    series = sli.latency_p95(b.requests(t), width="1 day")
    return sli.slo_attainment(series, objective=P95_OBJECTIVE_MS, target=SLO_TARGET)


@register("sli_rollup", with_bindings(f"""
SELECT service, {bucket_start_sql('ts', 86400)} AS window_start, {bucket_start_sql('ts', 86400)} + INTERVAL '1 day' AS window_end,
  count(*) AS requests, count(*) FILTER (WHERE status >= 500) AS errors,
  round(CAST(count(*) FILTER (WHERE status >= 500) AS DOUBLE) / count(*), 6) AS error_ratio,
  round(quantile_disc(latency_ms, 0.95), 6) AS p95_ms FROM requests GROUP BY 1, 2, 3""", "requests"))
def q_sli_rollup(t):
    """M1 and M2 per day from stored sketches of minutes, merged to hours and then to days (exact: a day here has fewer rows than a sketch)."""
    path = scratch_path(t.spark, f"sketches-{uuid.uuid4().hex}")
    sketches.latency_sketches(b.requests(t), "1 minute").write.parquet(path)
    hours = sketches.rolled_up(t.spark.read.parquet(path), "1 hour")
    return sketches.slis(sketches.rolled_up(hours, "1 day"), "1 day")


@register("retain", with_bindings(f"""
SELECT event_id, service, ts, latency_ms, status FROM requests
WHERE ts >= TIMESTAMP '{RETAIN_AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL '7 days'""", "requests"))
def q_retain(t):
    """M5: 7-day retention as of 2024-01-30."""
    return sli.retain(b.requests(t), ts="ts", keep="7 days", as_of=RETAIN_AS_OF).select(
        "event_id", "service", "ts", "latency_ms", "status")



