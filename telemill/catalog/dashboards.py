"""Dashboard queries Q1-Q11, the views, the joins and the measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.catalog.base import (
    AS_OF, NOW, WITH_BOTH, WITH_PRED, WITH_RAW, WITH_VIEW, Query, now, predictions, r6, raw, tidy,
)
from telemill.operators import alerts
from telemill.operators.clean import STATS, beside
from telemill.operators.features import calendar_parts, zscores
from telemill.plans import dashboard as d
from telemill.sources.schema import SENSORS

_A = "SUM(CASE WHEN is_anomaly THEN 1 ELSE 0 END)"
_SEVERITY = "CASE WHEN anomaly_score >= 0.8 THEN 'CRITICAL' WHEN anomaly_score >= 0.5 THEN 'WARNING' ELSE 'LOW' END"


def _rate(digits: int) -> str:
    return f"ROUND(100.0 * {_A} / NULLIF(CAST(COUNT(*) AS DOUBLE), 0), {digits})"


def _on_predictions(plan, **options):
    return lambda s, p: tidy(plan(predictions(s, p), now(), **options))


def _on_both(plan, **options):
    return lambda s, p: tidy(plan(predictions(s, p), raw(s, p), now(), **options))


def _view(s, p):
    return d.prediction_view(predictions(s, p), raw(s, p))


def _events_24h(s, p):
    return tidy(d.events_24h(calendar_parts(zscores(raw(s, p), ["temperature", "vibration", "pressure"])), now()))


def _nearest(s, p):
    return tidy(d.prediction_view(predictions(s, p), raw(s, p), how_many="nearest"))


_SENSOR_LIST = ", ".join(SENSORS)
_Z = ", ".join(
    r6(f"(r.{c} - s.{c}_m) / s.{c}_s", f"{c}_zscore") for c in ("temperature", "vibration", "pressure")
)
_Z_STATS = ", ".join(
    f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in ("temperature", "vibration", "pressure")
)
_MEASURES = f"""count(*) AS total_events, count(*) FILTER (is_anomaly) AS anomaly_count,
  {r6("coalesce(count(*) FILTER (is_anomaly) / nullif(CAST(count(*) AS DOUBLE), 0), 0) * 100", "anomaly_rate_pct")},
  {r6("coalesce(sum(h * CAST(is_anomaly AS INT)) / nullif(CAST(sum(h) AS DOUBLE), 0), 0) * 100", "anomaly_rate_last_hour_pct")},
  {r6("avg(CASE WHEN is_anomaly THEN anomaly_score END)", "avg_anomaly_score")},
  CASE WHEN coalesce(sum(h * CAST(is_anomaly AS INT)) / nullif(CAST(sum(h) AS DOUBLE), 0), 0) * 100 >= 10 THEN 'CRITICAL'
       WHEN coalesce(sum(h * CAST(is_anomaly AS INT)) / nullif(CAST(sum(h) AS DOUBLE), 0), 0) * 100 >= 5 THEN 'WARNING'
       ELSE 'NORMAL' END AS alert_status
FROM (SELECT *, CAST(timestamp >= {NOW} - INTERVAL 1 HOUR AND timestamp <= {NOW} AS INT) AS h FROM pred)"""

QUERIES = [
    Query("q1_hourly_by_machine", _on_predictions(d.hourly_by_machine), WITH_PRED + f"""
SELECT date_trunc('hour', timestamp) AS hour_bucket, machine_id, COUNT(*) AS total_events,
       CAST({_A} AS BIGINT) AS anomaly_count, {_rate(2)} AS anomaly_rate_pct
FROM pred WHERE timestamp >= {NOW} - INTERVAL 7 DAY GROUP BY 1, 2 ORDER BY 1 DESC, 2"""),
    Query("q2_last_hour_kpi", _on_predictions(d.last_hour_kpi), WITH_PRED + f"""
SELECT COUNT(*) AS events_last_hour, CAST({_A} AS BIGINT) AS anomalies_last_hour, {_rate(2)} AS anomaly_rate_pct,
       {NOW} AS as_of_utc
FROM pred WHERE timestamp >= {NOW} - INTERVAL 1 HOUR"""),
    Query("q3_daily_trend", _on_predictions(d.daily_trend), WITH_PRED + f"""
SELECT CAST(timestamp AS DATE) AS event_date, COUNT(*) AS total_events, CAST({_A} AS BIGINT) AS anomaly_count,
       {_rate(2)} AS anomaly_rate_pct
FROM pred WHERE timestamp >= {NOW} - INTERVAL 30 DAY GROUP BY 1 ORDER BY 1"""),
    Query("q4_temperature_histogram", _on_both(d.temperature_histogram), WITH_VIEW + f"""
SELECT floor(temperature / 5.0) * 5 AS temp_bin_start, floor(temperature / 5.0) * 5 + 5 AS temp_bin_end,
       COUNT(*) AS reading_count, CAST({_A} AS BIGINT) AS anomaly_in_bin
FROM v WHERE prediction_date >= CAST({NOW} AS DATE) - INTERVAL 7 DAY GROUP BY 1, 2 ORDER BY 1"""),
    Query("q5_scatter", lambda s, p: tidy(d.scatter(predictions(s, p), raw(s, p))), WITH_VIEW + f"""
SELECT machine_id, {r6('temperature', 'temperature')}, {r6('vibration', 'vibration')}, {r6('pressure', 'pressure')},
       is_anomaly, {r6('anomaly_score', 'anomaly_score')}, prediction_time
FROM (SELECT * FROM v ORDER BY prediction_time DESC, machine_id, v.anomaly_score, confidence, is_anomaly,
      {_SENSOR_LIST} LIMIT 1000)"""),
    Query("q6_machine_statistics", _on_both(d.machine_statistics), WITH_VIEW + f"""
SELECT machine_id, COUNT(*) AS total_readings, ROUND(AVG(temperature), 2) AS avg_temperature,
       ROUND(STDDEV_SAMP(temperature), 2) AS std_temperature, ROUND(MIN(temperature), 2) AS min_temperature,
       ROUND(MAX(temperature), 2) AS max_temperature, ROUND(AVG(vibration), 3) AS avg_vibration,
       ROUND(MAX(vibration), 3) AS max_vibration, ROUND(AVG(pressure), 2) AS avg_pressure,
       ROUND(AVG(current), 2) AS avg_current, CAST({_A} AS BIGINT) AS total_anomalies
FROM v WHERE prediction_date >= CAST({NOW} AS DATE) - INTERVAL 7 DAY
GROUP BY machine_id ORDER BY total_anomalies DESC, machine_id"""),
    Query("q7_alert_feed", lambda s, p: tidy(d.alert_feed(predictions(s, p), raw(s, p), now())), WITH_VIEW + f"""
SELECT machine_id, prediction_time, {r6('anomaly_score', 'anomaly_score')}, {r6('confidence', 'confidence')},
       {', '.join(r6(c, c) for c in SENSORS)}, {_SEVERITY} AS alert_severity,
       date_diff('minute', prediction_time, {NOW}) AS minutes_ago
FROM (SELECT * FROM v WHERE is_anomaly ORDER BY prediction_time DESC, machine_id, anomaly_score, confidence,
      {_SENSOR_LIST} LIMIT 100)"""),
    Query("q8_severity_counts", _on_both(d.severity_counts), WITH_VIEW + f"""
SELECT {_SEVERITY} AS severity, COUNT(*) AS alert_count FROM v
WHERE is_anomaly AND prediction_date >= CAST({NOW} AS DATE) GROUP BY 1 ORDER BY 2 DESC, 1"""),
    Query("q9_model_quality", _on_both(d.model_quality), WITH_VIEW + f"""
SELECT CAST(timestamp AS DATE) AS eval_date, COUNT(*) AS total_predictions,
       COUNT(*) FILTER (is_anomaly AND is_simulated_anomaly) AS true_positives,
       COUNT(*) FILTER (NOT is_anomaly AND NOT is_simulated_anomaly) AS true_negatives,
       COUNT(*) FILTER (is_anomaly AND NOT is_simulated_anomaly) AS false_positives,
       COUNT(*) FILTER (NOT is_anomaly AND is_simulated_anomaly) AS false_negatives,
       ROUND(COUNT(*) FILTER (is_anomaly AND is_simulated_anomaly)
             / NULLIF(CAST(COUNT(*) FILTER (is_anomaly) AS DOUBLE), 0), 4) AS precision_score,
       ROUND(COUNT(*) FILTER (is_anomaly AND is_simulated_anomaly)
             / NULLIF(CAST(COUNT(*) FILTER (is_simulated_anomaly) AS DOUBLE), 0), 4) AS recall_score
FROM v WHERE timestamp >= {NOW} - INTERVAL 30 DAY GROUP BY 1 ORDER BY 1 DESC"""),
    Query("q10_events_per_minute", _on_predictions(d.events_per_minute), WITH_PRED + f"""
SELECT date_trunc('minute', timestamp) AS minute_bucket, COUNT(*) AS events_per_minute
FROM pred WHERE timestamp >= {NOW} - INTERVAL 1 HOUR GROUP BY 1 ORDER BY 1 DESC"""),
    Query("q11_top_machines", _on_predictions(d.top_machines), WITH_PRED + f"""
SELECT machine_id, COUNT(*) AS total_readings, CAST({_A} AS BIGINT) AS anomaly_count, {_rate(1)} AS anomaly_rate_pct,
       ROUND(MAX(anomaly_score), 4) AS max_anomaly_score, ROUND(AVG(anomaly_score), 4) AS avg_anomaly_score
FROM pred WHERE timestamp >= {NOW} - INTERVAL 24 HOUR GROUP BY machine_id ORDER BY anomaly_count DESC, machine_id LIMIT 10"""),
    Query("j1_interval_join", lambda s, p: tidy(_view(s, p)), WITH_VIEW + f"""
SELECT machine_id, prediction_time, is_anomaly, {r6('anomaly_score', 'anomaly_score')}, {r6('confidence', 'confidence')},
       {', '.join(r6(c, c) for c in SENSORS)}, prediction_date, prediction_hour FROM v"""),
    Query("j1_nearest", _nearest, WITH_BOTH + f"""
SELECT machine_id, prediction_time, is_anomaly, {r6('anomaly_score', 'anomaly_score')}, {r6('confidence', 'confidence')},
       {', '.join(r6(c, c) for c in SENSORS)}, prediction_date, prediction_hour
FROM (
  SELECT p.machine_id, p.timestamp AS prediction_time, p.is_anomaly, p.anomaly_score, p.confidence, {', '.join('e.' + c for c in SENSORS)},
         CAST(p.timestamp AS DATE) AS prediction_date, CAST(hour(p.timestamp) AS INT) AS prediction_hour,
         row_number() OVER (PARTITION BY p.rid ORDER BY abs(epoch_us(p.timestamp) - epoch_us(e.timestamp)), e.event_id) AS k
  FROM (SELECT *, row_number() OVER () AS rid FROM pred) p LEFT JOIN raw e ON p.machine_id = e.machine_id
   AND p.timestamp BETWEEN e.timestamp - INTERVAL 5 SECOND AND e.timestamp + INTERVAL 5 SECOND) WHERE k = 1"""),
    Query("j2_labelled_pairs", lambda s, p: tidy(
        d.interval_join(predictions(s, p), raw(s, p), ["is_simulated_anomaly"])
        .select("machine_id", F.col("timestamp").alias("prediction_time"), "is_anomaly", "is_simulated_anomaly")
    ), WITH_VIEW + "SELECT machine_id, prediction_time, is_anomaly, is_simulated_anomaly FROM v"),
    Query("j3_one_row_stats", lambda s, p: tidy(_centred(raw(s, p))), WITH_RAW + f"""
SELECT event_id, {r6('temperature - (SELECT avg(temperature) FROM raw)', 'off_mean')},
       {r6('(temperature - (SELECT min(temperature) FROM raw)) / (SELECT max(temperature) - min(temperature) FROM raw)', 'min_max')}
FROM raw"""),
    Query("p11_events_24h", _events_24h, WITH_RAW + f""", s AS (SELECT {_Z_STATS} FROM raw)
SELECT event_id, machine_id, timestamp AS event_time, {', '.join(r6(c, c) for c in SENSORS)}, {_Z}, event_date,
       CAST(hour(timestamp) AS INT) AS hour_of_day, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week
FROM raw r, s WHERE event_date >= CAST({NOW} - INTERVAL 24 HOUR AS DATE)"""),
    Query("s12_dashboard_table", lambda s, p: tidy(d.dashboard_table(_view(s, p))), WITH_VIEW + f"""
SELECT machine_id, prediction_time, is_anomaly, {r6('anomaly_score', 'anomaly_score')}, {r6('confidence', 'confidence')},
       {', '.join(r6(c, c) for c in SENSORS)} FROM v"""),
    Query("d1_d7_measures", _on_predictions(d.measures), WITH_PRED + "SELECT " + _MEASURES),
    Query("d1_d7_measures_by_machine", _on_predictions(d.measures, by=["machine_id"]),
          WITH_PRED + "SELECT machine_id, " + _MEASURES + " GROUP BY machine_id"),
    Query("d6_highest_risk_machine", _on_predictions(d.highest_risk_machines), WITH_PRED + f"""
SELECT machine_id, anomaly_count FROM (
  SELECT machine_id, COUNT(*) FILTER (is_anomaly) AS anomaly_count, rank() OVER (ORDER BY COUNT(*) FILTER (is_anomaly) DESC) AS k
  FROM pred WHERE timestamp >= {NOW} - INTERVAL 24 HOUR AND timestamp <= {NOW} GROUP BY machine_id) WHERE k = 1"""),
    Query("d8_temperature_state", lambda s, p: tidy(d.temperature_state(raw(s, p), ["machine_id"])), WITH_RAW + """
SELECT machine_id, max(temperature) AS max_temperature,
       CASE WHEN max(temperature) > 100 THEN 'HIGH' WHEN max(temperature) > 85 THEN 'ELEVATED' ELSE 'NORMAL' END AS temperature_status
FROM raw GROUP BY machine_id"""),
]


def _centred(df):
    ends = df.agg(F.avg("temperature").alias("m"), F.min("temperature").alias("lo"), F.max("temperature").alias("hi"))
    t, stats = F.col("temperature"), F.col(STATS)
    return beside(df, ends).select(
        "event_id", (t - stats["m"]).alias("off_mean"), ((t - stats["lo"]) / (stats["hi"] - stats["lo"])).alias("min_max")
    )
