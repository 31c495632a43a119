"""Streaming forms X1-X4, X8 (and S8, J4), run to completion over the event files."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.catalog.base import WITH_PRED, WITH_RAW, WITH_VIEW, Query, predictions, r6, raw, repeated, tidy
from telemill.catalog.statistics import EPISODES, SUMMARIES
from telemill.ml.forest import ForestParams, fit
from telemill.ml.scoring import prepare
from telemill.operators.alerts import alert_episodes, metric_alerts, period_summaries
from telemill.plans import ingest
from telemill.session import scratch
from telemill.sources.schema import EVENT_SCHEMA, SENSORS, align
from telemill.sources.tables import encode_events
from telemill.streaming import streams as st

_COLUMNS = ["event_id", "machine_id", "timestamp", *SENSORS, "is_simulated_anomaly"]
_PREDICTION = T.StructType([
    T.StructField("machine_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
])


def _files(spark, df, name: str, flush: bool = True) -> str:
    """The rows as JSON files; a last row far ahead in time closes all windows."""
    path = scratch(spark, name)
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    encode_events(df).select("value").write.text(path)
    if flush:
        last = df.agg(F.max("timestamp").alias("t")).first()["t"] + timedelta(days=7)
        closing = spark.createDataFrame([("closing", last)], "machine_id string, timestamp timestamp")
        encode_events(align(closing, df.select("machine_id", "timestamp").schema)).select("value").write.mode("append").text(path)
    return path


def _predictions(spark, sf_dir):
    files = _files(spark, predictions(spark, sf_dir).drop("event_date"), "predictions")
    return st.event_stream(st.line_stream(spark, files), _PREDICTION)


def _readings(spark, sf_dir):
    files = _files(spark, raw(spark, sf_dir).select(*_COLUMNS), "readings")
    return st.event_stream(st.line_stream(spark, files))


def _finish(spark, stream, name):
    out = scratch(spark, name)
    parts = spark.sparkContext.defaultParallelism
    st.to_table(stream, out, scratch(spark, "progress"), state_partitions=parts).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _ingest(s, p):
    root = scratch(s, "stream-ingest")
    lines = st.line_stream(s, _files(s, repeated(s, p).select(*_COLUMNS), "lines", flush=False))
    st.ingest(lines, root, scratch(s, "progress")).awaitTermination()
    return tidy(s.read.parquet(f"{root}/{ingest.RAW}").select(*_COLUMNS, "event_date"))


def _tumbling(s, p):
    return tidy(_finish(s, st.tumbling_counts(_predictions(s, p)), "tumbling"))


def _per_minute(s, p):
    return tidy(_finish(s, st.tumbling_counts(_predictions(s, p), "1 minute", by_machine=False), "minutes").drop("anomaly_count"))


def _rolling(s, p):
    return tidy(_finish(s, st.rolling_rate(_predictions(s, p)), "rolling"))


def _alerts(s, p):
    return tidy(_finish(s, metric_alerts(_readings(s, p), "temperature", 100.0, "high-temperature"), "alerts").drop("description"))


def _summaries(s, p):
    return tidy(_finish(s, period_summaries(_predictions(s, p)), "summaries").drop("payload"))


def _episodes(s, p):
    return tidy(_finish(s, alert_episodes(_predictions(s, p)), "episodes").drop("payload"))


def _joined(s, p):
    met = _finish(s, st.interval_join_stream(_predictions(s, p), _readings(s, p), folded=True), "joined")
    # Rounded in the lists, once a row of either side: pairs are many more.
    met = met.withColumns({name: F.transform(name, _rounding(met.schema[name].dataType.elementType)) for name in ("predictions", "readings")})
    rows = st.unfolded(met.filter("machine_id <> 'closing'"))
    return rows.withColumn("prediction_time", F.col("prediction_time").cast("timestamp_ntz"))


def _rounding(row: T.StructType):
    """Gives a list's rows the doubles that ``tidy`` gives a table's."""

    def field(x, f):
        return (F.round(x[f.name], 6) + F.lit(0.0) if isinstance(f.dataType, T.DoubleType) else x[f.name]).alias(f.name)

    return lambda x: F.struct(*[field(x, f) for f in row.fields])


def _scored(s, p):
    ready, features, numbers = prepare(raw(s, p))
    forest = fit(ready, features, ForestParams(contamination=0.05))
    forest.extra["scaler"] = numbers
    out = scratch(s, "scored")
    lines = st.line_stream(s, _files(s, raw(s, p).select(*_COLUMNS), "lines", flush=False))
    st.score_stream(st.event_stream(lines), forest, out, scratch(s, "progress")).awaitTermination()
    return s.read.parquet(out).select("event_id", "is_anomaly", "anomaly_score", "confidence")


_ROUNDED = ", ".join(r6(c, c) for c in SENSORS)

QUERIES = [
    Query("x1_stream_ingest", _ingest, WITH_RAW + f"SELECT event_id, machine_id, timestamp, {_ROUNDED}, is_simulated_anomaly, event_date FROM raw"),
    Query("x2_stream_hourly", _tumbling, WITH_PRED + """
SELECT date_trunc('hour', timestamp) AS window_start, machine_id, count(*) AS total_events, count(*) FILTER (is_anomaly) AS anomaly_count
FROM pred GROUP BY 1, 2"""),
    Query("x2_stream_per_minute", _per_minute, WITH_PRED + "SELECT date_trunc('minute', timestamp) AS window_start, count(*) AS total_events FROM pred GROUP BY 1"),
    Query("x3_stream_rolling_rate", _rolling, WITH_PRED + f""", m AS (
SELECT date_trunc('minute', timestamp) AS t, count(*) AS n, count(*) FILTER (is_anomaly) AS a FROM pred GROUP BY 1)
SELECT t - INTERVAL 1 MINUTE * k AS window_start, t - INTERVAL 1 MINUTE * k + INTERVAL 1 HOUR AS window_end,
       CAST(sum(n) AS BIGINT) AS total_events, CAST(sum(a) AS BIGINT) AS anomaly_count, {r6('sum(a) * 100 / sum(n)', 'anomaly_rate_pct')}
FROM m, range(0, 60) AS r(k) GROUP BY ALL"""),
    Query("x4_stream_scoring", _scored),
    Query("x5_stream_alerts", _alerts, WITH_RAW + f""", m AS (
SELECT date_trunc('minute', timestamp) AS t, sum(temperature) AS s, count(temperature) AS n FROM raw GROUP BY 1),
w AS (SELECT t - INTERVAL 1 MINUTE * k AS window_start, sum(s) / sum(n) AS value FROM m, range(0, 5) AS r(k) GROUP BY 1)
SELECT 'high-temperature' AS alert_name, 2 AS severity, window_start, window_start + INTERVAL 5 MINUTE AS window_end, {r6('value', 'value')}
FROM w WHERE value > 100"""),
    Query("x6_stream_summaries", _summaries, SUMMARIES),
    Query("x7_stream_episodes", _episodes, EPISODES),
    Query("x8_stream_interval_join", _joined, WITH_VIEW + f"""
SELECT machine_id, prediction_time, is_anomaly, {r6('anomaly_score', 'anomaly_score')}, {r6('confidence', 'confidence')}, {_ROUNDED} FROM v"""),
]
