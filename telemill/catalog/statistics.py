"""Statistics A1-A21 and evaluation M6."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.catalog.base import (
    WITH_JUDGED, WITH_PRED, WITH_RAW, WITH_VIEW, Query, judged, predictions, r6, raw, table, tidy,
)
from telemill.functions import numbers
from telemill.ml import evaluate as ev
from telemill.operators import alerts, stats
from telemill.plans import dashboard
from telemill.sources.schema import SENSORS

_WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _describe(source: str, cols, digits: int = 3) -> str:
    return _union(
        f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), {digits}) AS mean, round(stddev_samp({c}), {digits}) AS std, "
        f"round(min({c}), {digits}) AS min, round(quantile_cont({c}, 0.25), {digits}) AS q25, round(quantile_cont({c}, 0.5), {digits}) AS q50, "
        f"round(quantile_cont({c}, 0.75), {digits}) AS q75, round(max({c}), {digits}) AS max FROM {source}"
        for c in cols
    )


def _long(cols, keep: str = "") -> str:
    return _union(f"SELECT {keep}'{c}' AS feature, {c} AS value FROM raw WHERE {c} IS NOT NULL" for c in cols)


def _hist(cte: str, cols, keep: str, bins: int, source: str = "") -> str:
    by = f"{keep}, " if keep else ""
    return cte + f""", l AS ({source or _long(cols, by)}), e AS (SELECT {by}feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY ALL),
b AS (SELECT {by}feature, lo, hi, CAST(least(floor((value - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS INT) AS bin, count(*) AS n
      FROM l JOIN e USING ({by}feature) GROUP BY ALL)
SELECT {by}feature, bin, {r6(f'lo + (bin - 1) * ((hi - lo) / {bins})', 'bin_start')}, {r6(f'lo + bin * ((hi - lo) / {bins})', 'bin_end')}, n FROM b"""


_PAIRS = [(b, a) for i, a in enumerate(SENSORS) for b in SENSORS[i + 1:]]
_PRF = """tp / greatest(tp + fp, 1) AS precision, tp / greatest(tp + fn, 1) AS recall, 2.0 * tp / greatest(2 * tp + fp + fn, 1) AS f1"""
_CELLS = """count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
 count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp"""
_AUC = """SELECT (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
 / (CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0)) AS auc
 FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM judged)"""


def _scoring_log(s, p):
    """Every event as a request; odd-typed payloads count as errors."""
    events = table(s, p, "events")
    return events.select(
        (F.col("value") >= 150).alias("is_anomaly"), F.get_json_object("props", "$.k").cast("int").isNull().alias("is_error")
    )


def _by_day(s, p):
    return predictions(s, p).withColumn("batch_id", F.date_format("timestamp", "yyyyMMddHH"))


def _metric_series(s, p):
    df = raw(s, p).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    series = alerts.metric_series(df, ["temperature", "vibration"])
    return tidy(series.select("name", "namespace", "time", "min", "max", "sum", "count"))


SUMMARIES = WITH_PRED + f"""
SELECT period_start, period_start + INTERVAL 1 HOUR AS period_end, total, anomalies, {r6('rate', 'rate')},
       CASE WHEN rate >= 0.2 THEN 'critical' WHEN rate >= 0.1 THEN 'warning' ELSE 'info' END AS severity,
       CASE WHEN rate >= 0.1 THEN 'Elevated' ELSE 'Normal' END AS status
FROM (SELECT date_trunc('hour', timestamp) AS period_start, count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies,
             count(*) FILTER (is_anomaly) / CAST(count(*) AS DOUBLE) AS rate FROM pred GROUP BY 1)"""
# Spells of anomalies: a new one starts after more than ten minutes without any.
EPISODES = WITH_PRED + f""", a AS (SELECT machine_id, timestamp AS t, anomaly_score FROM pred WHERE is_anomaly AND timestamp IS NOT NULL),
g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY machine_id ORDER BY t) <= INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS fresh FROM a),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY machine_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS spell FROM g)
SELECT machine_id, min(t) AS opened, max(t) AS last_anomaly, count(*) AS anomalies, {r6('max(anomaly_score)', 'worst_score')},
       CASE WHEN max(anomaly_score) >= 0.8 THEN 'CRITICAL' WHEN max(anomaly_score) >= 0.5 THEN 'WARNING' ELSE 'LOW' END AS severity
FROM n GROUP BY machine_id, spell"""

QUERIES = [
    Query("a1_report_stats", lambda s, p: tidy(stats.report_stats(table(s, p, "lineitem"), _WIDE)),
          "WITH g AS (SELECT (" + " + ".join(f"sum({c})" for c in _WIDE) + ") / (" + " + ".join(f"count({c})" for c in _WIDE)
          + ") AS m FROM lineitem) "
          + _union(f"SELECT '{c}' AS feature, {r6('(SELECT m FROM g)', 'grand_mean')}, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_pop({c})', 'std')} FROM lineitem" for c in _WIDE)),
    Query("a2_null_counts", lambda s, p: stats.null_counts(raw(s, p)), WITH_RAW + _union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM raw"
        for c in ("event_id", "machine_id", "timestamp", *SENSORS, "is_simulated_anomaly", "event_date")
    )),
    Query("a3_shape", lambda s, p: stats.shape(raw(s, p)), WITH_RAW + _union(
        f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, count(*) AS row_count FROM raw"
        for i, (c, t) in enumerate([
            ("event_id", "string"), ("machine_id", "string"), ("timestamp", "timestamp_ntz"), *[(c, "double") for c in SENSORS],
            ("is_simulated_anomaly", "boolean"), ("event_date", "date"),
        ])
    )),
    Query("a4_describe", lambda s, p: tidy(stats.describe(raw(s, p))), WITH_RAW + _describe("raw", SENSORS)),
    Query("a4_describe_lineitem", lambda s, p: tidy(stats.describe(table(s, p, "lineitem"), _WIDE)), _describe("lineitem", _WIDE)),
    Query("a5_histogram", lambda s, p: tidy(stats.histogram(raw(s, p))), _hist(WITH_RAW, SENSORS, "", 40)),
    Query("a6_histogram_by_label", lambda s, p: tidy(stats.histogram_by(raw(s, p))),
          _hist(WITH_RAW, SENSORS, "is_simulated_anomaly", 40)),
    Query("a7_score_histogram", lambda s, p: tidy(stats.histogram_by(judged(s, p), ["score"], "label", 50)),
          _hist(WITH_JUDGED, [], "label", 50, "SELECT label, 'score' AS feature, score AS value FROM judged")),
    Query("a8_correlations", lambda s, p: tidy(stats.correlations(raw(s, p))), WITH_RAW + _union(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(f'corr({a}, {b})', 'correlation')} FROM raw" for a, b in _PAIRS
    )),
    Query("a9_class_balance", lambda s, p: tidy(stats.class_balance(raw(s, p))), WITH_RAW + f"""
SELECT count(*) AS total, count(*) FILTER (NOT is_simulated_anomaly) AS normal, count(*) FILTER (is_simulated_anomaly) AS anomalous,
       {r6('count(*) FILTER (is_simulated_anomaly) / CAST(count(*) AS DOUBLE)', 'rate')} FROM raw"""),
    Query("a10_score_summary", lambda s, p: tidy(stats.score_summary(predictions(s, p))),
          WITH_PRED + f"SELECT {r6('avg(anomaly_score)', 'mean')}, {r6('stddev_pop(anomaly_score)', 'std')} FROM pred"),
    Query("a11_trend", lambda s, p: tidy(stats.trend(raw(s, p))),
          WITH_RAW + f"SELECT timestamp, {r6('temperature', 'temperature')}, is_simulated_anomaly FROM raw ORDER BY timestamp"),
    Query("a11_trend_buckets", lambda s, p: tidy(stats.trend_buckets(raw(s, p))), WITH_RAW + f"""
SELECT date_trunc('hour', timestamp) AS bucket, {r6('avg(temperature)', 'mean')}, {r6('min(temperature)', 'min')},
       {r6('max(temperature)', 'max')}, count(*) FILTER (is_simulated_anomaly) AS anomalies FROM raw GROUP BY 1"""),
    Query("a12_confusion_matrix", lambda s, p: ev.confusion_matrix(judged(s, p)), WITH_JUDGED + """
SELECT label, prediction, count(*) AS n FROM judged GROUP BY ALL"""),
    Query("a13_classification_report", lambda s, p: tidy(ev.classification_report(judged(s, p))), WITH_JUDGED + f""",
c AS (SELECT {_CELLS} FROM judged),
k AS (SELECT 'Normal' AS class_name, tn / greatest(tn + fn, 1) AS p, tn / greatest(tn + fp, 1) AS r, 2.0 * tn / greatest(2 * tn + fn + fp, 1) AS f, tn + fp AS s FROM c
      UNION ALL SELECT 'Anomaly', tp / greatest(tp + fp, 1), tp / greatest(tp + fn, 1), 2.0 * tp / greatest(2 * tp + fp + fn, 1), tp + fn FROM c)
SELECT class_name, {r6('p', 'precision')}, {r6('r', 'recall')}, {r6('f', 'f1')}, CAST(s AS BIGINT) AS support FROM k
UNION ALL SELECT 'accuracy', NULL, NULL, {r6('(tn + tp) / CAST(tn + fp + fn + tp AS DOUBLE)', 'x')}, CAST(tn + fp + fn + tp AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', {r6('avg(p)', 'p')}, {r6('avg(r)', 'r')}, {r6('avg(f)', 'f')}, CAST(sum(s) AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', {r6('sum(p * s) / sum(s)', 'p')}, {r6('sum(r * s) / sum(s)', 'r')}, {r6('sum(f * s) / sum(s)', 'f')}, CAST(sum(s) AS BIGINT) FROM k"""),
    Query("a14_binary_scores", lambda s, p: tidy(ev.binary_scores(judged(s, p))), WITH_JUDGED + f""",
c AS (SELECT {_CELLS} FROM judged) SELECT {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')} FROM (SELECT {_PRF} FROM c)"""),
    Query("a15_roc_auc", lambda s, p: tidy(ev.roc_auc(judged(s, p), rows_per_bucket=1000)),
          WITH_JUDGED + f"SELECT {r6('auc', 'roc_auc')} FROM ({_AUC})"),
    Query("a16_roc_curve", lambda s, p: tidy(ev.roc_curve(judged(s, p), rows_per_bucket=1000)), WITH_JUDGED + f""",
g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM judged GROUP BY score)
SELECT {r6('score', 'threshold')}, {r6('sum(n) OVER (ORDER BY score DESC) / CAST((SELECT sum(n) FROM g) AS DOUBLE)', 'fpr')},
       {r6('sum(p) OVER (ORDER BY score DESC) / CAST((SELECT sum(p) FROM g) AS DOUBLE)', 'tpr')} FROM g"""),
    Query("a17_scaler_report", lambda s, p: tidy(stats.scaler_report(raw(s, p))), WITH_RAW + _union(
        f"SELECT '{c}' AS feature, round(avg({c}), 3) AS mean, round(stddev_pop({c}), 3) AS std FROM raw" for c in SENSORS
    )),
    Query("a18_batch_totals", lambda s, p: alerts.batch_totals(_by_day(s, p)), WITH_PRED + """
SELECT strftime(timestamp, '%Y%m%d%H') AS batch_id, count(*) AS total, count(*) FILTER (is_anomaly) AS anomaly_count FROM pred GROUP BY 1"""),
    Query("a19_counters", lambda s, p: alerts.counters(_scoring_log(s, p)), """
SELECT count(*) AS requests_total, count(*) FILTER (value >= 150) AS anomalies_detected,
       count(*) FILTER (TRY_CAST(json_extract_string(props, '$.k') AS INT) IS NULL) AS errors_total FROM events"""),
    Query("a20_anomaly_rate_check", lambda s, p: tidy(alerts.anomaly_rate_check(predictions(s, p), 0.05)), WITH_PRED + f"""
SELECT total, anomalies, {r6('rate', 'rate')}, CASE WHEN rate >= 0.10 THEN 'critical' WHEN rate >= 0.05 THEN 'warning' ELSE 'info' END AS severity,
       CASE WHEN rate >= 0.05 THEN 'Elevated' ELSE 'Normal' END AS status
FROM (SELECT count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies, count(*) FILTER (is_anomaly) / CAST(count(*) AS DOUBLE) AS rate FROM pred)
WHERE rate >= 0.05"""),
    Query("a21_metric_series", _metric_series, WITH_RAW + ", l AS (" + _union(
        f"SELECT '{c}' AS name, date_trunc('hour', timestamp) AS time, {c} AS value FROM raw" for c in ("temperature", "vibration")
    ) + f""") SELECT name, 'SensorAnomalyDetection' AS namespace, time, {r6('min(value)', 'min')}, {r6('max(value)', 'max')},
  {r6('sum(value)', 'sum')}, count(value) AS count FROM l GROUP BY name, time"""),
    Query("m6_evaluate", lambda s, p: tidy(ev.evaluate(judged(s, p))), WITH_JUDGED + f""", c AS (SELECT {_CELLS} FROM judged)
SELECT {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')}, {r6(f'({_AUC})', 'roc_auc')} FROM (SELECT {_PRF} FROM c)"""),
    Query("x5_metric_alerts", lambda s, p: tidy(
        alerts.metric_alerts(raw(s, p), "temperature", 100.0, "high-temperature").drop("description")
    ), WITH_RAW + f""", m AS (SELECT date_trunc('minute', timestamp) AS t, sum(temperature) AS s, count(temperature) AS n FROM raw GROUP BY 1),
w AS (SELECT t - INTERVAL 1 MINUTE * k AS window_start, sum(s) / sum(n) AS value FROM m, range(0, 5) AS r(k) GROUP BY 1)
SELECT 'high-temperature' AS alert_name, 2 AS severity, window_start, window_start + INTERVAL 5 MINUTE AS window_end, {r6('value', 'value')}
FROM w WHERE value > 100"""),
    Query("x6_period_summaries", lambda s, p: tidy(alerts.period_summaries(predictions(s, p)).drop("payload")), SUMMARIES),
    Query("x7_anomaly_alerts", lambda s, p: tidy(
        alerts.anomaly_alerts(dashboard.prediction_view(predictions(s, p), raw(s, p))).drop("payload", "html")
    ), WITH_VIEW + f"""
SELECT machine_id, prediction_time, {r6('anomaly_score', 'anomaly_score')}, {', '.join(r6(c, c) for c in SENSORS)},
       CASE WHEN anomaly_score >= 0.8 THEN 'CRITICAL' WHEN anomaly_score >= 0.5 THEN 'WARNING' ELSE 'LOW' END AS severity,
       '[ALERT] Anomaly detected on ' || machine_id AS subject FROM v WHERE is_anomaly"""),
    Query("x7_alert_episodes", lambda s, p: tidy(alerts.alert_episodes(predictions(s, p)).drop("payload")), EPISODES),
    Query("x7_alert_payloads", lambda s, p: alerts.anomaly_alerts(dashboard.prediction_view(predictions(s, p), raw(s, p))).select(
        "machine_id", "prediction_time", "payload", "html"
    )),
]
