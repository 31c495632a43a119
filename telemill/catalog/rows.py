"""Row operators P1-P16, sorting T1-T6, scalar functions E1-E16."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.catalog.base import (
    AS_OF, NOW, WITH_PRED, WITH_RAW, WITH_REPEATED, Query, now, predictions, r6, raw, repeated, table, tidy,
)
from telemill.functions import clock, levels, numbers, text
from telemill.operators import clean
from telemill.sources.schema import SENSOR_RANGES, SENSORS, available_features, numeric_columns

_ROUNDED = ", ".join(r6(c, c) for c in SENSORS)
_IDS = "event_id, machine_id, timestamp"
_FLAGS = "is_simulated_anomaly, event_date"


def _missing_voltage(s, p):
    return raw(s, p).drop("voltage")


def _severities(s, p):
    return predictions(s, p).select("machine_id", "timestamp", levels.score_severity(F.col("anomaly_score")).alias("severity"))


def _rate_levels(s, p):
    hourly = predictions(s, p).groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket")).agg(
        numbers.ratio(F.count_if("is_anomaly"), F.count("*")).alias("rate")
    )
    return hourly.select(
        "hour_bucket", "rate", levels.rate_severity(F.col("rate")).alias("severity"), levels.rate_status(F.col("rate")).alias("status")
    )


def _windows(s, p):
    df = predictions(s, p)
    spans = [("h1", 1, "HOUR"), ("h24", 24, "HOUR"), ("d7", 7, "DAY"), ("d30", 30, "DAY")]
    today = F.col("timestamp") >= F.to_date(now()).cast("timestamp_ntz")
    return df.agg(
        *[F.count_if(clock.recent("timestamp", now(), n, unit)).alias(name) for name, n, unit in spans],
        F.count_if(today).alias("today"),
    )


def _datetime(s, p):
    ts = F.col("timestamp")
    return raw(s, p).select(
        "event_id", clock.shift(ts, -5, "SECOND").alias("minus_5s"), clock.shift(ts, 1, "HOUR").alias("plus_1h"),
        clock.shift(ts, -7, "DAY").alias("minus_7d"), clock.minutes_between(ts, now()).alias("minutes_ago"),
        F.hour(ts).alias("hour"), F.date_trunc("hour", ts).alias("hour_start"), F.date_trunc("minute", ts).alias("minute_start"),
        F.to_date(ts).alias("day"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("clock_text"),
        F.date_format(ts, "yyyy/MM/dd").alias("folder"), F.date_format(ts, "yyyyMMdd'T'HHmmss").alias("compact"),
        F.try_to_timestamp(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("parsed"),
        clock.event_key(F.col("machine_id"), ts).alias("event_key"),
    )


def _format(s, p):
    df = raw(s, p)
    return df.select(
        "event_id", F.initcap(F.lower("machine_id")).alias("machine_title"), text.fixed(F.col("pressure"), 1).alias("pressure_text"),
        text.percent_text(F.col("humidity") / 100, 0).alias("humidity_text"),
        text.sensor_rows_html(["pressure"]).alias("html_row"),
        F.to_json(F.array(text.fact("Machine ID", F.col("machine_id")))).alias("facts"),
    )


def _arith(s, p):
    t, h = F.col("temperature"), F.col("humidity")
    return raw(s, p).select(
        "event_id", numbers.add(t, h).alias("added"), numbers.subtract(t, h).alias("subtracted"),
        numbers.multiply(t, h).alias("multiplied"), numbers.divide(t, h).alias("divided"),
        numbers.ratio(h, F.nullif(F.floor(F.col("vibration") * 10), F.lit(0))).alias("safe_divided"),
        (F.floor(t / 5) * 5).cast("double").alias("floored"), F.round(-numbers.divide(t, t + 50), 6).alias("negated"),
    )


def _json_fields(s, p):
    events = table(s, p, "events")
    parsed = F.from_json("props", "k BIGINT")
    return events.select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), parsed["k"].alias("k_typed"),
        F.to_json(F.struct("event_type", "user_id")).alias("encoded"),
    )


_CLAMPED = ", ".join(
    r6(f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, {hi}), {lo}) END", c)
    for c, (_, _, lo, hi) in SENSOR_RANGES.items()
)
_VIOLATED = " OR ".join(f"coalesce({c} < {lo} OR {c} > {hi}, false)" for c, (_, _, lo, hi) in SENSOR_RANGES.items())

QUERIES = [
    Query("p1_drop_incomplete", lambda s, p: tidy(clean.drop_incomplete(raw(s, p))),
          WITH_RAW + f"SELECT {_IDS}, {_ROUNDED}, {_FLAGS} FROM raw WHERE vibration IS NOT NULL"),
    Query("p2_drop_copies", lambda s, p: tidy(clean.drop_copies(repeated(s, p))),
          WITH_REPEATED + f"SELECT DISTINCT {_IDS}, {_ROUNDED}, {_FLAGS} FROM rep"),
    Query("p3_forward_fill", lambda s, p: tidy(
        clean.forward_fill(raw(s, p), ["vibration"], rows_per_bucket=2000).select("event_id", "vibration")
    ), WITH_RAW + f"""SELECT event_id, {r6('last_value(vibration IGNORE NULLS) OVER (ORDER BY timestamp, event_id)', 'vibration')} FROM raw"""),
    Query("p3_forward_fill_by_machine", lambda s, p: tidy(
        clean.forward_fill(raw(s, p), ["vibration"], keys=["machine_id"], rows_per_bucket=2000).select("event_id", "vibration")
    ), WITH_RAW + f"""SELECT event_id,
  {r6('last_value(vibration IGNORE NULLS) OVER (PARTITION BY machine_id ORDER BY timestamp, event_id)', 'vibration')} FROM raw"""),
    Query("p2_p3_clean", lambda s, p: tidy(clean.clean(repeated(s, p)).select(*_IDS.split(", "), *SENSORS)),
          WITH_REPEATED + f""", once AS (SELECT DISTINCT * FROM rep)
SELECT {_IDS}, {', '.join(r6(c, c) for c in SENSORS if c != 'vibration')},
       {r6('last_value(vibration IGNORE NULLS) OVER (ORDER BY timestamp, event_id)', 'vibration')} FROM once"""),
    Query("p4_impute_mean", lambda s, p: tidy(clean.impute_mean(raw(s, p), ["vibration"]).select("event_id", "vibration")),
          WITH_RAW + f"SELECT event_id, {r6('coalesce(vibration, (SELECT avg(vibration) FROM raw))', 'vibration')} FROM raw"),
    Query("p5_impute_constant", lambda s, p: tidy(
        clean.impute_constant(_missing_voltage(s, p)).select("event_id", "vibration", "voltage")
    ), WITH_RAW + f"SELECT event_id, {r6('coalesce(vibration, 0.0)', 'vibration')}, CAST(0 AS DOUBLE) AS voltage FROM raw"),
    Query("p6_available_features", lambda s, p: tidy(
        _missing_voltage(s, p).transform(lambda df: df.select("event_id", *available_features(df)))
    ), WITH_RAW + f"SELECT event_id, {', '.join(r6(c, c) for c in SENSORS[:5])} FROM raw"),
    Query("p7_numeric_columns", lambda s, p: tidy(
        raw(s, p).transform(lambda df: df.select(*numeric_columns(df, ["current"])))
    ), WITH_RAW + f"SELECT {', '.join(r6(c, c) for c in SENSORS if c != 'current')} FROM raw"),
    Query("p8_drop_first_column", lambda s, p: tidy(clean.drop_first_column(raw(s, p))),
          WITH_RAW + f"SELECT machine_id, timestamp, {_ROUNDED}, {_FLAGS} FROM raw"),
    Query("p9_label_as_int", lambda s, p: clean.label_as_int(raw(s, p)).select("event_id", "is_simulated_anomaly"),
          WITH_RAW + "SELECT event_id, CAST(is_simulated_anomaly AS INT) AS is_simulated_anomaly FROM raw"),
    Query("p10_recent_windows", _windows, WITH_PRED + f"""
SELECT count(*) FILTER (timestamp >= {NOW} - INTERVAL 1 HOUR) AS h1, count(*) FILTER (timestamp >= {NOW} - INTERVAL 24 HOUR) AS h24,
       count(*) FILTER (timestamp >= {NOW} - INTERVAL 7 DAY) AS d7, count(*) FILTER (timestamp >= {NOW} - INTERVAL 30 DAY) AS d30,
       count(*) FILTER (timestamp >= CAST({NOW} AS DATE)) AS today FROM pred"""),
    Query("p12_anomalies", lambda s, p: tidy(clean.anomalies(predictions(s, p)).select("machine_id", "timestamp", "anomaly_score")),
          WITH_PRED + f"SELECT machine_id, timestamp, {r6('anomaly_score', 'anomaly_score')} FROM pred WHERE is_anomaly"),
    Query("p13_score_severity", _severities, WITH_PRED + """
SELECT machine_id, timestamp, CASE WHEN anomaly_score >= 0.8 THEN 'CRITICAL' WHEN anomaly_score >= 0.5 THEN 'WARNING' ELSE 'LOW' END AS severity
FROM pred"""),
    Query("p14_rate_severity", lambda s, p: tidy(_rate_levels(s, p)), WITH_PRED + f"""
SELECT hour_bucket, {r6('rate', 'rate')}, CASE WHEN rate >= 0.2 THEN 'critical' WHEN rate >= 0.1 THEN 'warning' ELSE 'info' END AS severity,
       CASE WHEN rate >= 0.1 THEN 'Elevated' ELSE 'Normal' END AS status
FROM (SELECT date_trunc('hour', timestamp) AS hour_bucket, count(*) FILTER (is_anomaly) / CAST(count(*) AS DOUBLE) AS rate FROM pred GROUP BY 1)"""),
    Query("p15_clamp", lambda s, p: tidy(clean.clamp(raw(s, p)).select("event_id", *SENSORS, "range_violation")),
          WITH_RAW + f"SELECT event_id, {_CLAMPED}, ({_VIOLATED}) AS range_violation FROM raw"),
    Query("p16_inject_faults", lambda s, p: clean.inject_faults(raw(s, p))),
    Query("t1_sort_by_time", lambda s, p: raw(s, p).select("event_id", "timestamp").orderBy("timestamp"),
          WITH_RAW + "SELECT event_id, timestamp FROM raw ORDER BY timestamp"),
    Query("t2_newest", lambda s, p: tidy(
        predictions(s, p).orderBy(F.desc("timestamp"), "machine_id", "anomaly_score").limit(100)
        .select("machine_id", "timestamp", "anomaly_score")
    ), WITH_PRED + f"""SELECT machine_id, timestamp, {r6('anomaly_score', 'anomaly_score')}
FROM (SELECT * FROM pred ORDER BY timestamp DESC, machine_id, anomaly_score LIMIT 100)"""),
    Query("t3_top_by_aggregate", lambda s, p: (
        table(s, p, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(10)
    ), "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10"),
    Query("t4_top_with_ties", lambda s, p: _top_with_ties(table(s, p, "events")), """
SELECT user_id, n FROM (SELECT user_id, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS k FROM events GROUP BY user_id) WHERE k = 1"""),
    Query("t5_mixed_sort", lambda s, p: raw(s, p).select("event_date", "machine_id", "event_id").orderBy(
        F.desc("event_date"), "machine_id", "event_id"
    ), WITH_RAW + "SELECT event_date, machine_id, event_id FROM raw ORDER BY event_date DESC, machine_id, event_id"),
    Query("t6_first_rows", lambda s, p: raw(s, p).select("event_id", "timestamp").orderBy("timestamp", "event_id").limit(3),
          WITH_RAW + "SELECT event_id, timestamp FROM raw ORDER BY timestamp, event_id LIMIT 3"),
    Query("e_datetime", lambda s, p: tidy(_datetime(s, p)), WITH_RAW + f"""
SELECT event_id, timestamp - INTERVAL 5 SECOND AS minus_5s, timestamp + INTERVAL 1 HOUR AS plus_1h, timestamp - INTERVAL 7 DAY AS minus_7d,
       date_diff('minute', timestamp, {NOW}) AS minutes_ago, CAST(hour(timestamp) AS INT) AS hour,
       date_trunc('hour', timestamp) AS hour_start, date_trunc('minute', timestamp) AS minute_start, CAST(timestamp AS DATE) AS day,
       strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS clock_text, strftime(timestamp, '%Y/%m/%d') AS folder,
       strftime(timestamp, '%Y%m%dT%H%M%S') AS compact, date_trunc('second', timestamp) AS parsed,
       machine_id || '_' || CAST(epoch_us(timestamp) // 1000 AS VARCHAR) AS event_key FROM raw"""),
    Query("e_format", _format, WITH_RAW + """
SELECT event_id, 'Machine' || substr(machine_id, 8) AS machine_title, printf('%.1f', pressure) AS pressure_text,
       printf('%.0f', humidity / 100 * 100) || '%' AS humidity_text,
       '<tr><td>Pressure</td><td>' || printf('%.2f', pressure) || '</td></tr>' AS html_row,
       '[{"name":"Machine ID","value":"' || machine_id || '"}]' AS facts FROM raw"""),
    Query("e_arith", lambda s, p: tidy(_arith(s, p)), WITH_RAW + f"""
SELECT event_id, {r6('temperature + humidity', 'added')}, {r6('temperature - humidity', 'subtracted')},
       {r6('temperature * humidity', 'multiplied')}, {r6('temperature / humidity', 'divided')},
       {r6('humidity / nullif(floor(vibration * 10), 0)', 'safe_divided')}, floor(temperature / 5) * 5 AS floored,
       {r6('-(temperature / (temperature + 50))', 'negated')} FROM raw"""),
    Query("e_json", _json_fields, """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) AS k_typed,
       '{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR) || '}' AS encoded FROM events"""),
]


def _top_with_ties(events):
    counted = events.groupBy("user_id").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") == counted.agg(F.max("n")).scalar())
