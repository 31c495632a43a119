"""Cleaning, scalar functions, statistics, evaluation and alerts on small tables."""

import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from telemill.functions import clock, levels, numbers, text
from telemill.ml import evaluate as ev
from telemill.operators import alerts, clean, stats
from telemill.sources.schema import SENSORS, align, available_features, nan_to_null, numeric_columns
from telemill.sources.schema import DASHBOARD_COLUMNS, PROCESSED_TABLE_SCHEMA


def one(spark, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,)], "a double")
    assert clean.drop_incomplete(df).count() == 3


def test_nan_counts_as_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int"))
    assert [r["a"] for r in df.orderBy("b").collect()] == [None, 2.0]
    assert stats.null_counts(df).filter("column_name = 'a'").first()["nulls"] == 1


def test_imputation(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "a double")
    assert sorted(r["a"] for r in clean.impute_mean(df, ["a"]).collect()) == [1.0, 2.0, 3.0]
    filled = clean.impute_constant(df, ["a", "gone"])
    assert sorted(r["a"] for r in filled.collect()) == [0.0, 1.0, 3.0]
    assert {r["gone"] for r in filled.collect()} == {0.0}


def test_feature_selection(spark):
    df = one(spark, voltage=1.0, temperature=2.0, flag=True, name="x")
    assert available_features(df) == ["temperature", "voltage"]
    assert numeric_columns(df) == ["voltage", "temperature"]
    with pytest.raises(ValueError):
        available_features(df.select("name"))


def test_align(spark):
    out = align(one(spark, machine_id="M", event_id=7), PROCESSED_TABLE_SCHEMA)
    assert out.schema.simpleString() == PROCESSED_TABLE_SCHEMA.simpleString()
    assert out.first()["event_id"] == "7" and out.first()["voltage"] is None
    assert len(DASHBOARD_COLUMNS) == 11


def test_clamp_keeps_null(spark):
    row = clean.clamp(one(spark, temperature=150.0, vibration=None, pressure=100.0).withColumn(
        "vibration", F.lit(None).cast("double")
    )).first()
    assert (row["temperature"], row["vibration"], row["pressure"], row["range_violation"]) == (120.0, None, 100.0, True)


def test_injected_faults(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("event_id"), *[F.lit(m).alias(c) for c, m in zip(
        SENSORS, (75.0, 0.5, 101.3, 50.0, 12.0, 220.0)
    )])
    out = clean.inject_faults(ids, 0.05)
    share = out.filter("is_simulated_anomaly").count() / 20_000
    assert abs(share - 0.05) < 0.01
    faults = out.filter("is_simulated_anomaly").agg(F.min(F.abs(F.col("temperature") - 75)), F.max(F.abs(F.col("temperature") - 75))).first()
    assert 15 <= faults[0] and faults[1] <= 30
    same = clean.inject_faults(ids.repartition(7), 0.05)
    assert same.exceptAll(out).count() == 0


def test_standardise_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert {r["a"] for r in clean.standardise(df).collect()} == {None}


def test_minutes_are_boundaries_crossed(spark):
    def minutes(a, b):
        return value(spark, clock.minutes_between(F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp")))

    assert minutes("2024-01-01 00:00:59", "2024-01-01 00:01:01") == 1
    assert minutes("2024-01-01 00:00:01", "2024-01-01 00:00:59") == 0


def test_division(spark):
    assert value(spark, numbers.divide(F.lit(1.0), F.lit(4.0))) == 0.25
    assert value(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, numbers.ratio_or_zero(F.lit(1), F.lit(0))) == 0.0
    with pytest.raises(PySparkException, match="Cannot divide by zero"):
        value(spark, numbers.divide(F.lit(1.0), F.lit(0.0)))


@pytest.mark.parametrize("number", [100.55, 0.125, 2.5, 1.005, -3.14159, 0.0, 1234567.891])
@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_fixed_decimals_match_c(spark, number, digits):
    got = value(spark, text.fixed(F.lit(number), digits))
    assert got == f"{number:.{digits}f}"


def test_ladders(spark):
    def ladder(make, inputs):
        return [value(spark, make(F.lit(x))) for x in inputs]

    assert ladder(levels.score_severity, [0.8, 0.79, 0.5, 0.49]) == ["CRITICAL", "WARNING", "WARNING", "LOW"]
    assert ladder(levels.rate_severity, [0.2, 0.1, 0.09]) == ["critical", "warning", "info"]
    assert ladder(levels.rate_status, [0.1, 0.09]) == ["Elevated", "Normal"]
    assert ladder(levels.alert_status, [10.0, 5.0, 4.9]) == ["CRITICAL", "WARNING", "NORMAL"]
    assert ladder(levels.temperature_status, [100.1, 100.0, 85.0]) == ["HIGH", "ELEVATED", "NORMAL"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 5.0, True), (10.0, 5.0, True), (5.0, 5.0, False), (None, None, None)], "a double, b double, y boolean")
    bins = {(r["feature"], r["bin"]): r["n"] for r in stats.histogram(df, ["a", "b"], 4).collect()}
    assert bins == {("a", 1): 1, ("a", 3): 1, ("a", 4): 1, ("b", 3): 3}
    for limit in (0, 1000):  # both ways to meet the ranges
        grouped = stats.histogram_by(df, ["a"], "y", 4, limit)
        assert {(r["y"], r["bin"], r["n"]) for r in grouped.collect()} == {(True, 1, 1), (True, 4, 1), (False, 3, 1)}


def test_describe_both_ways(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"a": rng.normal(size=500), "b": rng.random(500)})
    df = spark.createDataFrame(frame)
    want = frame.describe().T
    for limit in (10, 10_000):
        for r in stats.describe(df, ["a", "b"], 9, limit).collect():
            w = want.loc[r["feature"]]
            assert r["n"] == 500
            for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
                assert math.isclose(r[ours], w[theirs], rel_tol=1e-7, abs_tol=1e-8)


def test_correlation_skips_missing_pairs(spark):
    frame = pd.DataFrame({"a": [1.0, 2, 3, None, 5], "b": [2.0, 1, None, 4, 6]})
    got = stats.correlations(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "a double, b double"), ["a", "b"]).first()
    assert math.isclose(got["correlation"], frame.corr().loc["a", "b"])


def test_report_means_all_cells(spark):
    rows = {r["feature"]: r for r in stats.report_stats(spark.createDataFrame([(1.0, 10.0), (3.0, 20.0)], "a double, b double"), ["a", "b"]).collect()}
    assert rows["a"]["grand_mean"] == 8.5 and rows["a"]["std"] == 1.0 and rows["b"]["std"] == 5.0


def judged_rows(spark, n=400, seed=0):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(int(rng.random() < 0.3), int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(n)], "label int, prediction int, score double"
    )


@pytest.mark.parametrize("per_bucket", [7, 10_000])
def test_auc_counts_ties_half(spark, per_bucket):
    df = judged_rows(spark)
    rows = df.toPandas()
    pos, neg = rows[rows.label == 1].score.to_numpy(), rows[rows.label == 0].score.to_numpy()
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert math.isclose(ev.roc_auc(df, rows_per_bucket=per_bucket).first()["roc_auc"], want)
    curve = ev.roc_curve(df, rows_per_bucket=per_bucket).orderBy(F.desc("threshold")).toPandas()
    assert math.isclose(np.trapezoid(np.r_[0, curve.tpr], np.r_[0, curve.fpr]), want)


def test_auc_of_one_class_is_zero(spark):
    assert ev.roc_auc(judged_rows(spark).filter("label = 1")).first()["roc_auc"] == 0.0


def test_report_on_empty_denominators(spark):
    df = spark.createDataFrame([(1, 0), (1, 0)], "label int, prediction int")
    assert ev.binary_scores(df).first().asDict() == {"precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert ev.confusion_matrix(df).count() == 4
    report = {r["class_name"]: r for r in ev.classification_report(df).collect()}
    assert report["Normal"]["f1"] == 0.0 and report["accuracy"]["f1"] == 0.0 and report["Anomaly"]["support"] == 2


def test_rate_check_needs_events(spark):
    log = spark.createDataFrame([(True, False), (False, False), (False, True)], "is_anomaly boolean, is_error boolean")
    assert alerts.anomaly_rate_check(log, 0.3).count() == 1
    assert alerts.anomaly_rate_check(log, 0.34).count() == 0
    assert alerts.anomaly_rate_check(log.limit(0)).count() == 0
    assert alerts.counters(log).first().asDict() == {"requests_total": 3, "anomalies_detected": 1, "errors_total": 1}


def test_payloads(spark):
    df = spark.sql(
        "SELECT 'M1' machine_id, TIMESTAMP '2024-01-01 10:00:00' prediction_time, true is_anomaly, 0.91D anomaly_score, 120D temperature, 4.5D vibration"
    )
    row = alerts.anomaly_alerts(df, ["temperature", "vibration"]).first()
    message = json.loads(row["payload"])
    facts = {f["name"]: f["value"] for f in message["sections"][0]["facts"]}
    assert row["severity"] == "CRITICAL" and message["themeColor"] == "D40000" and message["@type"] == "MessageCard"
    assert message["summary"] == "Anomaly detected on M1"
    assert facts["Anomaly Score"] == "0.9100" and facts["Temperature"] == "120.00" and facts["Vibration"] == "4.50"
    assert "<tr><td>Vibration</td><td>4.50</td></tr>" in row["html"] and row["subject"] == "[ALERT] Anomaly detected on M1"


def test_rule_vocabulary(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:30' timestamp, 7D m UNION ALL SELECT TIMESTAMP '2024-01-01 10:01:30', 1D")
    for how, best in (("Average", 7.0), ("Maximum", 7.0), ("Minimum", 7.0), ("Total", 8.0), ("Count", 2.0)):
        assert alerts.rule_windows(df, "m", how, 5).agg(F.max("value")).first()[0] == best
    assert alerts.metric_alerts(df, "m", 4.0, operator="LessThan").count() == 1
    with pytest.raises(ValueError):
        alerts.metric_alerts(df, "m", 4.0, operator="Near")
    with pytest.raises(ValueError):
        alerts.metric_alerts(df, "m", 4.0, severity=9)


def test_metric_series_dimensions(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:30' timestamp, 7D m UNION ALL SELECT TIMESTAMP '2024-01-01 10:00:40', 1D")
    row = alerts.metric_series(df, ["m"]).first()
    assert row["dims"] == {"Environment": "production"} and (row["min"], row["max"], row["sum"], row["count"]) == (1.0, 7.0, 8.0, 2)
