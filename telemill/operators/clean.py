"""Cleaning, imputation, column selection and range checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.operators.ordered import forward_fill
from telemill.session import checkpointed
from telemill.sources.schema import LABEL, SENSOR_RANGES, SENSORS, numeric_columns


STATS = "_stats"


def beside(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Every row with a one-row aggregate as the struct column ``_stats``.

    Spark runs the aggregate once, as a scalar subquery, and hands the values to
    the rows' own stage: no join, no shuffle and no driver round trip. Callers
    select their output columns, which drops the struct.
    """
    return df.withColumn(STATS, stats.select(F.struct("*").alias("s")).scalar())


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_copies(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact copies collapse on the map side, before the shuffle."""
    return df.dropDuplicates(list(subset) if subset else None)


def clean(df: DataFrame, order: Sequence[str] = ("timestamp", "event_id"), **options) -> DataFrame:
    """Drop copies, then carry the last known values forward.

    The fill reads its input several times, so the distinct rows are kept.
    """
    return forward_fill(checkpointed(drop_copies(df)), order=order, **options)


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    means = F.col(STATS)
    return beside(df, df.agg(*[F.avg(c).alias(c) for c in cols])).select(
        [F.coalesce(F.col(c), means[c]).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def impute_constant(df: DataFrame, cols: Sequence[str] = SENSORS, value: float = 0.0) -> DataFrame:
    """Missing values, and wholly missing columns, become ``value``."""
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(value)) if c in df.columns else F.lit(value))
    return df


def drop_first_column(df: DataFrame) -> DataFrame:
    return df.select(df.columns[1:])


def label_as_int(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("int"))


def anomalies(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_anomaly"))


def mean_and_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``<col>_mean`` and the sample deviation ``<col>_std``."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols], *[F.stddev_samp(c).alias(f"{c}_std") for c in cols]
    )


def standardise(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(x - mean) / sample std for every numeric column; NULL where the std is 0."""
    cols = list(cols or numeric_columns(df))
    stats = F.col(STATS)
    return beside(df, mean_and_std(df, cols)).select([
        F.try_divide(F.col(c) - stats[f"{c}_mean"], stats[f"{c}_std"]).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def _bounded(value: Column, low: float, high: float) -> Column:
    # greatest and least skip NULLs, so a NULL must be kept by hand.
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def clamp(df: DataFrame, ranges: dict = SENSOR_RANGES) -> DataFrame:
    """Clamp every sensor to its range and flag the rows that had left it."""
    present = [c for c in ranges if c in df.columns]
    outside = F.lit(False)
    for c in present:
        low, high = ranges[c][2:]
        outside = outside | F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))
    df = df.withColumn("range_violation", outside)
    return df.withColumns({c: _bounded(F.col(c), *ranges[c][2:]) for c in present})


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its arguments, wherever the row is computed."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


def inject_faults(
    df: DataFrame, rate: float = 0.05, seed: int = 42, ranges: dict = SENSOR_RANGES,
    row_id: str = "event_id", label: str = LABEL,
) -> DataFrame:
    """Turn a share of the rows into faults and label every row.

    A faulty reading lies 3 to 6 standard deviations off the sensor's mean, on
    either side, within [0.8 min, 1.2 max], rounded to 4 digits.
    """
    rid, faulty = F.col(row_id), "_faulty"
    df = df.withColumn(faulty, uniform(rid, F.lit("fault"), F.lit(seed)) < rate)
    changed = {}
    for c, (mean, std, low, high) in ranges.items():
        if c not in df.columns:
            continue
        side = F.when(uniform(rid, F.lit(c), F.lit("side"), F.lit(seed)) < 0.5, -1.0).otherwise(1.0)
        distance = 3 * std + 3 * std * uniform(rid, F.lit(c), F.lit("size"), F.lit(seed))
        value = F.round(_bounded(mean + side * distance, 0.8 * low, 1.2 * high), 4)
        changed[c] = F.when(F.col(faulty), value).otherwise(F.col(c))
    return df.withColumns(changed).withColumn(label, F.col(faulty)).drop(faulty)
