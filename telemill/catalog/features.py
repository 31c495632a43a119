"""Feature engineering F1-F9."""

from __future__ import annotations

from telemill.catalog.base import WITH_RAW, Query, r6, raw, tidy
from telemill.operators import clean
from telemill.operators import features as f
from telemill.sources.schema import SENSORS

_W = "OVER (ORDER BY timestamp, event_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
_KW = "OVER (PARTITION BY machine_id ORDER BY timestamp, event_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _mean(c: str, w: str) -> str:
    return r6(f"avg({c}) {w}", f"{c}_rolling_mean")


def _std(c: str, w: str) -> str:
    return r6(f"coalesce(stddev_samp({c}) {w}, 0)", f"{c}_rolling_std", 5)


def _z(c: str) -> str:
    return r6(f"({c} - (SELECT avg({c}) FROM raw)) / (SELECT stddev_samp({c}) FROM raw)", f"{c}_zscore")


def _rolled(s, p, stats, window=10, keys=(), rows_per_bucket=2000):
    df = f.rolling(raw(s, p), ["temperature", "vibration"], window, keys=keys, rows_per_bucket=rows_per_bucket, stats=stats)
    return tidy(df.select("event_id", *[f"{c}_rolling_{k}" for c in ("temperature", "vibration") for k in stats]), 5 if "std" in stats else 6)


def _pair(make, w):
    return f"{make('temperature', w)}, {make('vibration', w)}"


_W10, _W4, _K10 = _W.format(n=9), _W.format(n=3), _KW.format(n=9)


def _mean5(c: str, w: str) -> str:
    return r6(f"avg({c}) {w}", f"{c}_rolling_mean", 5)


def _enriched(s, p):
    return tidy(f.enrich(raw(s, p)).drop("ingestion_timestamp", "is_simulated_anomaly"), 5)


_FULL = ", ".join(
    f"{_mean5(c, _W10)}, {_std(c, _W10)}, {_z(c).replace(', 6)', ', 5)')}, abs(({c} - (SELECT avg({c}) FROM raw)) / (SELECT stddev_samp({c}) FROM raw)) > 3.0 AS {c}_outlier"
    for c in SENSORS
)

QUERIES = [
    Query("f1_calendar_parts", lambda s, p: f.calendar_parts(raw(s, p)).select("event_id", "hour_of_day", "day_of_week"),
          WITH_RAW + "SELECT event_id, CAST(hour(timestamp) AS INT) AS hour_of_day, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week FROM raw"),
    Query("f2_rolling_mean", lambda s, p: _rolled(s, p, ["mean"]), WITH_RAW + f"SELECT event_id, {_pair(_mean, _W10)} FROM raw"),
    Query("f3_rolling_std", lambda s, p: _rolled(s, p, ["std"]), WITH_RAW + f"SELECT event_id, {_pair(_std, _W10)} FROM raw"),
    Query("f2_f3_by_machine", lambda s, p: _rolled(s, p, ["mean", "std"], keys=["machine_id"]),
          WITH_RAW + f"SELECT event_id, {_pair(_mean5, _K10)}, {_pair(_std, _K10)} FROM raw"),
    Query("f4_zscore", lambda s, p: tidy(f.zscores(raw(s, p), SENSORS).select("event_id", *[f"{c}_zscore" for c in SENSORS])),
          WITH_RAW + f"SELECT event_id, {', '.join(_z(c) for c in SENSORS)} FROM raw"),
    Query("f5_outlier_flags", lambda s, p: f.outlier_flags(f.zscores(raw(s, p), ["temperature"]), ["temperature"]).select(
        "event_id", "temperature_outlier"
    ), WITH_RAW + """SELECT event_id, abs((temperature - (SELECT avg(temperature) FROM raw)) / (SELECT stddev_samp(temperature) FROM raw)) > 3.0
 AS temperature_outlier FROM raw"""),
    Query("f6_ingestion_stamp", lambda s, p: f.stamp_ingestion(raw(s, p)).select("event_id", "ingestion_timestamp")),
    Query("f7_standardise", lambda s, p: tidy(clean.standardise(raw(s, p)).select("event_id", *SENSORS)),
          WITH_RAW + "SELECT event_id, " + ", ".join(_z(c).replace(f"{c}_zscore", c) for c in SENSORS) + " FROM raw"),
    Query("f8_enrich", _enriched, WITH_RAW + f"""
SELECT event_id, machine_id, timestamp, event_date, {', '.join(r6(c, c, 5) for c in SENSORS)},
       CAST(hour(timestamp) AS INT) AS hour_of_day, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, {_FULL} FROM raw"""),
    Query("f9_window_size", lambda s, p: _rolled(s, p, ["mean"], window=4), WITH_RAW + f"SELECT event_id, {_pair(_mean, _W4)} FROM raw"),
]
