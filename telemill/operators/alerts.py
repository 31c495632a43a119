"""Counters, metric series, threshold rules and alert rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.functions.levels import rate_severity, rate_status, score_severity
from telemill.functions.numbers import ratio
from telemill.functions.text import ANOMALY_TITLE, SUMMARY_TITLE, alert_html, card, fact, fixed, percent_text, sensor_facts
from telemill.operators.stats import long_form
from telemill.sources.schema import SENSORS

# Rule vocabulary.
AGGREGATIONS = ("Average", "Minimum", "Maximum", "Total", "Count")
OPERATORS = ("GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual", "Equals")


def batch_totals(scored: DataFrame, batch: str = "batch_id") -> DataFrame:
    return scored.groupBy(batch).agg(
        F.count("*").alias("total"), F.count_if(F.col("is_anomaly")).alias("anomaly_count")
    )


def counters(log: DataFrame) -> DataFrame:
    """Requests, anomalies and errors over a scoring log (is_anomaly, is_error)."""
    return log.agg(
        F.count("*").alias("requests_total"),
        F.count_if(F.col("is_anomaly")).alias("anomalies_detected"),
        F.count_if(F.col("is_error")).alias("errors_total"),
    )


def _summary(totals: DataFrame, threshold: float) -> DataFrame:
    rate = ratio(F.col("anomalies"), F.col("total"))
    return totals.withColumn("rate", rate).withColumns({
        "severity": rate_severity(F.col("rate"), threshold), "status": rate_status(F.col("rate"), threshold)
    })


def anomaly_rate_check(log: DataFrame, threshold: float = 0.10) -> DataFrame:
    """One row when the cumulative anomaly rate reaches the threshold, else none."""
    totals = log.agg(F.count("*").alias("total"), F.count_if(F.col("is_anomaly")).alias("anomalies"))
    return _summary(totals, threshold).filter(F.col("rate") >= threshold)


def metric_series(
    df: DataFrame, metrics: Sequence[str], ts: str = "timestamp", namespace: str = "SensorAnomalyDetection",
    dimension: str = "Environment", dimension_value: str = "production",
) -> DataFrame:
    """Per metric and minute: min, max, sum and count, with namespace and dimensions."""
    minute = df.withColumn("time", F.date_trunc("minute", ts))
    return (
        long_form(minute, metrics, ["time"], "name").groupBy("name", "time")
        .agg(F.min("value").alias("min"), F.max("value").alias("max"), F.sum("value").alias("sum"),
             F.count("value").alias("count"))
        .withColumns({"namespace": F.lit(namespace), "dims": F.create_map(F.lit(dimension), F.lit(dimension_value))})
    )


def compare(value: Column, operator: str, threshold: float) -> Column:
    if operator not in OPERATORS:
        raise ValueError(f"operator must be one of {OPERATORS}")
    return {
        "GreaterThan": value > threshold, "GreaterThanOrEqual": value >= threshold, "LessThan": value < threshold,
        "LessThanOrEqual": value <= threshold, "Equals": value == threshold,
    }[operator]


def minute_parts(df: DataFrame, metric: str, ts: str = "timestamp") -> DataFrame:
    """Per-minute partial aggregates, which longer windows are put together from."""
    value = F.col(metric).cast("double")
    return df.groupBy(F.window(ts, "1 minute").alias("minute")).agg(
        F.sum(value).alias("s"), F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
    )


def window_value(aggregation: str) -> Column:
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"aggregation must be one of {AGGREGATIONS}")
    return {
        "Average": F.try_divide(F.sum("s"), F.sum("n")), "Minimum": F.min("lo"), "Maximum": F.max("hi"),
        "Total": F.sum("s"), "Count": F.sum("n").cast("double"),
    }[aggregation]


def rule_windows(
    df: DataFrame, metric: str, aggregation: str = "Average", window_minutes: int = 5, ts: str = "timestamp"
) -> DataFrame:
    """The metric over every window of the given length, evaluated each minute.

    Rows are first reduced to minutes; only those few rows are repeated over the
    overlapping windows. Works on tables and on watermarked streams.
    """
    parts = minute_parts(df, metric, ts)
    return (
        parts.groupBy(F.window(F.window_time("minute"), f"{window_minutes} minutes", "1 minute").alias("w"))
        .agg(window_value(aggregation).alias("value"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "value")
    )


def metric_alerts(
    df: DataFrame, metric: str, threshold: float, name: str = "metric-alert", operator: str = "GreaterThan",
    aggregation: str = "Average", window_minutes: int = 5, severity: int = 2, ts: str = "timestamp",
) -> DataFrame:
    """Windows in which the rule fires."""
    if not 0 <= severity <= 4:
        raise ValueError("severity must be between 0 and 4")
    return (
        rule_windows(df, metric, aggregation, window_minutes, ts)
        .filter(compare(F.col("value"), operator, threshold))
        .select(F.lit(name).alias("alert_name"), F.lit(severity).alias("severity"), "window_start", "window_end", "value",
                F.lit(f"Alert: {metric} {operator} {threshold}").alias("description"))
    )


def period_summaries(
    predictions: DataFrame, minutes: int = 60, threshold: float = 0.10, ts: str = "timestamp"
) -> DataFrame:
    """Per period: events, anomalies, rate, severity, status and the card to post."""
    totals = predictions.groupBy(F.window(ts, f"{minutes} minutes").alias("w")).agg(
        F.count("*").alias("total"), F.count_if(F.col("is_anomaly")).alias("anomalies")
    )
    rows = _summary(totals, threshold)
    facts = [
        fact("Period", F.lit(f"Last {minutes} minutes")), fact("Total Events", F.col("total")),
        fact("Anomalies", F.col("anomalies")), fact("Anomaly Rate", percent_text(F.col("rate"))),
        fact("Status", F.col("status")),
    ]
    payload = card(
        SUMMARY_TITLE, F.concat(F.lit("Anomaly rate: "), percent_text(F.col("rate"))), facts,
        F.col("severity"), F.col("w.end"),
    )
    return rows.select(
        F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "total", "anomalies", "rate",
        "severity", "status", payload.alias("payload"),
    )


def anomaly_alerts(joined: DataFrame, sensors: Sequence[str] = SENSORS, ts: str = "prediction_time") -> DataFrame:
    """One row per anomaly: severity, message card and mail body."""
    rows = joined.filter(F.col("is_anomaly")).withColumn("severity", score_severity(F.col("anomaly_score")))
    facts = [
        fact("Machine ID", F.col("machine_id")), fact("Anomaly Score", fixed(F.col("anomaly_score"), 4)),
        fact("Time", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")), *sensor_facts(sensors),
    ]
    level = F.when(F.col("severity") == "CRITICAL", "critical").when(F.col("severity") == "WARNING", "warning").otherwise("info")
    payload = card(
        ANOMALY_TITLE, F.concat(F.lit("Anomaly detected on "), F.col("machine_id")), facts, level, F.col(ts)
    )
    return rows.select(
        "machine_id", ts, "anomaly_score", *sensors, "severity", payload.alias("payload"),
        F.concat(F.lit("[ALERT] Anomaly detected on "), F.col("machine_id")).alias("subject"),
        alert_html(F.col("machine_id"), F.col("anomaly_score"), F.col(ts), sensors).alias("html"),
    )


def alert_episodes(predictions: DataFrame, cool_down_minutes: int = 10, ts: str = "timestamp") -> DataFrame:
    """One alert per machine and spell of anomalies: open until ``cool_down_minutes`` pass without another.

    Works on tables and on watermarked streams; a stream keeps one open spell a machine as its
    state and emits it when the watermark has passed its cool-down. Anomalies without a machine
    share the NULL machine's alerts; those without a time belong to none.
    """
    # One condition on both columns stays above a watermark on the time, which quiet rows must move as well.
    anomalies = predictions.filter(F.when(F.col("is_anomaly"), F.col(ts)).isNotNull())
    spells = anomalies.groupBy(F.session_window(ts, f"{cool_down_minutes} minutes").alias("w"), "machine_id").agg(
        F.count("*").alias("anomalies"), F.max("anomaly_score").alias("worst_score")
    )
    last = F.col("w.end") - F.make_dt_interval(mins=F.lit(cool_down_minutes))
    rows = spells.select(
        "machine_id", F.col("w.start").alias("opened"), last.alias("last_anomaly"), "anomalies", "worst_score",
        score_severity(F.col("worst_score")).alias("severity"),
    )
    facts = [
        fact("Machine ID", F.col("machine_id")), fact("Anomaly Score", fixed(F.col("worst_score"), 4)), fact("Anomalies", F.col("anomalies")),
        fact("Time", F.date_format("opened", "yyyy-MM-dd'T'HH:mm:ss")),
    ]
    level = F.when(F.col("severity") == "CRITICAL", "critical").when(F.col("severity") == "WARNING", "warning").otherwise("info")
    payload = card(ANOMALY_TITLE, F.concat(F.lit("Anomaly detected on "), F.col("machine_id")), facts, level, F.col("opened"))
    return rows.withColumn("payload", payload)
