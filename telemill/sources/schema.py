"""Table definitions, the sensor catalogue and column selection helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sensor -> (mean, std, min, max), in feature order.
SENSOR_RANGES = {
    "temperature": (75.0, 5.0, 40.0, 120.0),
    "vibration": (0.5, 0.1, 0.0, 5.0),
    "pressure": (101.3, 2.0, 80.0, 130.0),
    "humidity": (50.0, 8.0, 10.0, 95.0),
    "current": (12.0, 1.5, 0.0, 30.0),
    "voltage": (220.0, 5.0, 180.0, 260.0),
}
SENSORS = tuple(SENSOR_RANGES)
LABEL = "is_simulated_anomaly"
PARTITION = "event_date"
# Columns that enrichment never treats as measurements.
NOT_MEASURED = ("hour_of_day", "day_of_week", LABEL)


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_D, _S, _TS = T.DoubleType(), T.StringType(), T.TimestampType()
_SENSOR_FIELDS = [(name, _D) for name in SENSORS]

EVENT_SCHEMA = _fields(
    ("event_id", _S), ("machine_id", _S), ("timestamp", _TS), *_SENSOR_FIELDS, (LABEL, T.BooleanType())
)
RAW_TABLE_SCHEMA = _fields(
    ("event_id", _S), ("machine_id", _S), ("timestamp", _TS), *_SENSOR_FIELDS,
    (LABEL, T.BooleanType()), (PARTITION, T.DateType()),
)
PROCESSED_TABLE_SCHEMA = _fields(
    ("event_id", _S), ("machine_id", _S), ("timestamp", _TS), *_SENSOR_FIELDS,
    ("temperature_zscore", _D), ("vibration_zscore", _D), ("pressure_zscore", _D),
    ("temperature_rolling_mean", _D), ("vibration_rolling_mean", _D),
    ("hour_of_day", T.IntegerType()), ("day_of_week", T.IntegerType()),
    ("ingestion_timestamp", _TS), (PARTITION, T.DateType()),
)
PREDICTION_TABLE_SCHEMA = _fields(
    ("machine_id", _S), ("timestamp", _TS), ("is_anomaly", T.BooleanType()),
    ("anomaly_score", _D), ("confidence", _D), ("features_used", _S), (PARTITION, T.DateType()),
)
DASHBOARD_COLUMNS = ("machine_id", "prediction_time", "is_anomaly", "anomaly_score", "confidence", *SENSORS)
SAMPLE_CSV_SCHEMA = _fields(
    ("timestamp", _TS), ("temperature", _D), ("humidity", _D), ("pressure", _D), ("vibration", _D)
)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and reorder to ``schema``; columns the input lacks become NULL."""
    return df.select([
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns; booleans do not count as numbers."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def available_features(df: DataFrame, wanted: Sequence[str] = SENSORS) -> list[str]:
    """The wanted features that exist, in the wanted order; none at all is an error."""
    found = [name for name in wanted if name in df.columns]
    if not found:
        raise ValueError(f"none of the expected features {list(wanted)} in {df.columns}")
    return found


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL everywhere downstream, so NaN becomes NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select([
        F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in floats else F.col(c)
        for c in df.columns
    ])
