"""Sources and sinks S1-S13. Working tables go to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.catalog.base import NOW, RAW_SQL, WITH_PRED, WITH_RAW, Query, now, predictions, r6, raw, table, tidy
from telemill.plans import ingest
from telemill.plans.dashboard import hourly_by_machine
from telemill.session import scratch
from telemill.sources import tables as io
from telemill.sources.schema import EVENT_SCHEMA, PREDICTION_TABLE_SCHEMA, SENSORS, align

_COLUMNS = ["event_id", "machine_id", "timestamp", *SENSORS, "is_simulated_anomaly"]
_ROUNDED = ", ".join(r6(c, c) for c in SENSORS)
_EVENTS = f"SELECT event_id, machine_id, timestamp, {_ROUNDED}, is_simulated_anomaly FROM raw"
_DATED = f"SELECT event_id, machine_id, timestamp, {_ROUNDED}, is_simulated_anomaly, event_date FROM raw"


def _utc(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _csv(s, p):
    path = scratch(s, "csv")
    raw(s, p).select(*_COLUMNS).withColumn("timestamp", F.col("timestamp").cast("string")).write.option("header", True).csv(path)
    return tidy(io.read_csv(s, path, EVENT_SCHEMA))


def _decode(s, p):
    events = table(s, p, "events").select("event_id", F.col("props").alias("value"))
    schema = T.StructType([T.StructField("k", T.LongType(), True)])
    good, _ = io.split_corrupt(io.decode_events(events, schema))
    return good


def _append_then_overwrite(s, p):
    path = scratch(s, "sink")
    io.write_table(raw(s, p), path)
    io.write_table(raw(s, p), path, mode="overwrite")
    return tidy(io.read_table(s, path).select(*_COLUMNS, "event_date"))


def _dated_folders(s, p):
    path = scratch(s, "dated")
    io.write_dated_folders(raw(s, p), path)
    back = io.read_table(s, path)
    parts = [F.col(c).cast("int").alias(c) for c in ("year", "month", "day")]
    return tidy(back.select(*_COLUMNS, *parts))


def _json_round_trip(s, p):
    path = scratch(s, "json")
    io.write_events_json(raw(s, p).select(*_COLUMNS), path, batch_size=1000)
    good, _ = io.split_corrupt(io.decode_events(s.read.text(path)))
    return tidy(good)


def _compacted(s, p):
    path = scratch(s, "compact")
    io.compact(raw(s, p), path, rows_per_file=2500)
    return tidy(io.read_table(s, path).select(*_COLUMNS, "event_date"))


def _compacted_in_place(s, p):
    path = scratch(s, "worn")
    rows = raw(s, p)
    io.write_table(rows.filter("day(timestamp) > 10"), path)
    rows.filter("day(timestamp) <= 10").repartition(6, "event_id").write.mode("append").partitionBy("event_date").parquet(path)
    io.compact_in_place(s, path, rows_per_file=2500)
    return tidy(io.read_table(s, path).select(*_COLUMNS, "event_date"))


def _ingested(s, p):
    root = scratch(s, "ingest")
    lines = io.encode_events(raw(s, p).select(*_COLUMNS)).select("value")
    broken = table(s, p, "events").filter("event_type = 'error'").select(F.concat(F.lit("{broken "), "event_type").alias("value"))
    loaded = ingest.run(lines.unionByName(lines).unionByName(broken), root, at_least=1)
    return tidy(loaded.select("event_id", "machine_id", "timestamp", "temperature", "temperature_zscore", "hour_of_day", "event_date"), 5)


def _landed(s, p):
    """Scored rows landed twice, a later part once more, then the hourly rates from the landed table."""
    root = scratch(s, "landed")
    scored = predictions(s, p).withColumn("timestamp", F.col("timestamp").cast("timestamp")).drop("event_date")
    ingest.land_predictions(scored.filter("NOT is_anomaly"), root)
    ingest.land_predictions(scored, root)
    landed = _local(io.read_table(s, f"{root}/{ingest.PREDICTIONS}"))
    return tidy(hourly_by_machine(landed, now()), 2)


def _local(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


QUERIES = [
    Query("s1_csv_scan", _csv, WITH_RAW + _EVENTS),
    Query("s2_table_scan", lambda s, p: tidy(io.read_table(s, f"{p}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")),
          f"SELECT l_orderkey, l_linenumber, {r6('l_quantity', 'l_quantity')} FROM lineitem"),
    Query("s3_decode_json", _decode, "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"),
    Query("s4_partitioned_sink", _append_then_overwrite, WITH_RAW + _DATED),
    Query("s5_event_date", lambda s, p: io.with_event_date(raw(s, p).drop("event_date")).select("event_id", "event_date"),
          WITH_RAW + "SELECT event_id, event_date FROM raw"),
    Query("s6_dated_folders", _dated_folders, WITH_RAW + f"""
SELECT event_id, machine_id, timestamp, {_ROUNDED}, is_simulated_anomaly, CAST(year(timestamp) AS INT) AS year,
       CAST(month(timestamp) AS INT) AS month, CAST(day(timestamp) AS INT) AS day FROM raw"""),
    Query("s7_json_sink", _json_round_trip, WITH_RAW + _EVENTS),
    Query("s9_compact", _compacted, WITH_RAW + _DATED),
    Query("s9_compact_in_place", _compacted_in_place, WITH_RAW + _DATED),
    Query("s10_require_rows", lambda s, p: tidy(io.require_rows(raw(s, p), 100).agg(F.count("*").alias("n"))),
          WITH_RAW + "SELECT count(*) AS n FROM raw"),
    Query("s11_align", lambda s, p: tidy(align(predictions(s, p), PREDICTION_TABLE_SCHEMA)), WITH_PRED + f"""
SELECT machine_id, timestamp, is_anomaly, {r6('anomaly_score', 'anomaly_score')}, {r6('confidence', 'confidence')},
       CAST(NULL AS VARCHAR) AS features_used, event_date FROM pred"""),
    Query("s13_landed_rates", _landed, WITH_PRED + f"""
SELECT date_trunc('hour', timestamp) AS hour_bucket, machine_id, COUNT(*) AS total_events,
       CAST(SUM(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
       ROUND(SUM(CASE WHEN is_anomaly THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) + 0.0 AS anomaly_rate_pct
FROM pred WHERE timestamp >= {NOW} - INTERVAL 7 DAY GROUP BY 1, 2"""),
    Query("s13_ingest", _ingested, WITH_RAW + f"""
SELECT event_id, machine_id, timestamp, {r6('temperature', 'temperature', 5)},
       {r6('(temperature - (SELECT avg(temperature) FROM raw)) / (SELECT stddev_samp(temperature) FROM raw)', 'temperature_zscore', 5)},
       CAST(hour(timestamp) AS INT) AS hour_of_day, event_date FROM raw"""),
]
