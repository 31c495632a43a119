"""A prediction or reading without a machine meets nothing in the dashboard's aggregates."""

from datetime import datetime

from pyspark.sql import functions as F

from telemill.plans import dashboard as d

AT = datetime(2024, 1, 30, 12)


def sides(spark):
    p = spark.createDataFrame(
        [(None, AT, True, 0.9, 1.0), ("M1", AT, True, 0.9, 1.0)], "machine_id string, timestamp timestamp, is_anomaly boolean, anomaly_score double, confidence double"
    ).withColumn("event_date", F.to_date("timestamp"))
    e = spark.createDataFrame(
        [(None, AT, 52.0, True), (None, AT, 53.0, True), ("M1", AT, 61.0, True)], "machine_id string, timestamp timestamp, temperature double, is_simulated_anomaly boolean"
    ).withColumns({c: F.lit(1.0) for c in ("vibration", "pressure", "humidity", "current", "voltage")}).withColumn("event_date", F.to_date("timestamp"))
    return p, e


def test_null_machines(spark):
    p, e = sides(spark)
    as_of = F.lit("2024-01-30 23:59:00").cast("timestamp")
    assert {r.temp_bin_start: r.reading_count for r in d.temperature_histogram(p, e, as_of).collect()} == {None: 1, 60.0: 1}
    assert {r.machine_id: (r.total_readings, r.avg_temperature) for r in d.machine_statistics(p, e, as_of).collect()} == {None: (1, None), "M1": (1, 61.0)}
    assert [r.alert_count for r in d.severity_counts(p, e, as_of).collect()] == [2]
    assert [(r.total_predictions, r.true_positives) for r in d.model_quality(p, e, as_of).collect()] == [(2, 1)]
