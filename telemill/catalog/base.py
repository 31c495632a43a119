"""Telemetry tables derived from ``events``, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.session import configure

AS_OF = "2024-01-30 23:59:00"
NOW = f"TIMESTAMP '{AS_OF}'"


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def now():
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_MACHINE = "concat('MACHINE_', lpad(CAST(user_id % 5 + 1 AS {text}), 3, '0'))"
_RAW = """
SELECT CAST(event_id AS {text}) AS event_id, {machine} AS machine_id, ts AS timestamp,
       value AS temperature,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id * 37 % 100 AS DOUBLE) / 100 END AS vibration,
       100 + CAST(event_id * 53 % 400 AS DOUBLE) / 100 AS pressure,
       10 + CAST(event_id * 17 % 8500 AS DOUBLE) / 100 AS humidity,
       CAST(event_id * 29 % 3000 AS DOUBLE) / 100 AS current,
       180 + CAST(event_id * 71 % 8000 AS DOUBLE) / 100 AS voltage,
       event_type = 'error' AS is_simulated_anomaly,
       CAST(ts AS DATE) AS event_date
FROM {events}
"""
_PRED = """
SELECT {machine} AS machine_id, {moved} AS timestamp,
       (value >= 150 OR event_id % 50 = 0) AS is_anomaly,
       value / (value + 50) AS anomaly_score, least(value / 500, 1.0) AS confidence,
       CAST({moved} AS DATE) AS event_date
FROM {events}
"""
_JUDGED = """
SELECT CAST(event_type = 'error' AS INT) AS label, CAST(value >= 150 OR event_id % 50 = 0 AS INT) AS prediction,
       value / (value + 50) AS score
FROM {events}
"""
_SPARK = {"text": "STRING", "machine": _MACHINE.format(text="STRING"), "events": "{events}",
          "moved": "timestampadd(SECOND, CAST(event_id % 13 - 6 AS INT), ts)"}
_DUCK = {"text": "VARCHAR", "machine": _MACHINE.format(text="VARCHAR"), "events": "events",
         "moved": "(ts + to_seconds(event_id % 13 - 6))"}

RAW_SQL, PRED_SQL, JUDGED_SQL = (t.format(**_DUCK) for t in (_RAW, _PRED, _JUDGED))
VIEW_SQL = """
SELECT p.machine_id, p.timestamp AS prediction_time, p.is_anomaly, p.anomaly_score, p.confidence,
       e.temperature, e.vibration, e.pressure, e.humidity, e.current, e.voltage,
       CAST(p.timestamp AS DATE) AS prediction_date, CAST(hour(p.timestamp) AS INT) AS prediction_hour,
       e.is_simulated_anomaly, p.timestamp
FROM pred p LEFT JOIN raw e ON p.machine_id = e.machine_id
 AND p.timestamp BETWEEN e.timestamp - INTERVAL 5 SECOND AND e.timestamp + INTERVAL 5 SECOND
"""
WITH_RAW = f"WITH raw AS ({RAW_SQL})\n"
WITH_PRED = f"WITH pred AS ({PRED_SQL})\n"
WITH_BOTH = f"WITH raw AS ({RAW_SQL}), pred AS ({PRED_SQL})\n"
WITH_VIEW = f"WITH raw AS ({RAW_SQL}), pred AS ({PRED_SQL}), v AS ({VIEW_SQL})\n"
WITH_JUDGED = f"WITH judged AS ({JUDGED_SQL})\n"


def _derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text.format(**_SPARK), events=table(spark, sf_dir, "events"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _RAW)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _PRED)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _JUDGED)


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings with the faulty ones delivered twice."""
    events = raw(spark, sf_dir)
    return events.unionByName(events.filter("is_simulated_anomaly"))


WITH_REPEATED = f"WITH raw AS ({RAW_SQL}), rep AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE is_simulated_anomaly)\n"


def tidy(df: DataFrame, digits: int = 6, exact: Sequence[str] = ()) -> DataFrame:
    """Comparable output: doubles rounded (and without -0.0), timestamps without a zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType) and f.name not in exact:
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def r6(expression: str, name: str, digits: int = 6) -> str:
    """The SQL twin of ``tidy`` for one column."""
    return f"round({expression}, {digits}) + 0.0 AS {name}"
