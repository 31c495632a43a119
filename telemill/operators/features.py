"""Enrichment: calendar parts, rolling statistics, z-scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.operators.clean import STATS, beside, mean_and_std
from telemill.operators.ordered import ROWS_PER_BUCKET, over_preceding
from telemill.sources.schema import NOT_MEASURED, numeric_columns

ORDER = ("timestamp", "event_id")


def calendar_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour of day, and day of week counted from Monday = 0."""
    return df.withColumns({"hour_of_day": F.hour(ts), "day_of_week": F.weekday(ts)})


def _mean_over(col: str):
    return lambda spec: F.avg(col).over(spec)


def _std_over(col: str):
    return lambda spec: F.coalesce(F.stddev_samp(col).over(spec), F.lit(0.0))


def rolling(
    df: DataFrame, cols: Sequence[str], window: int = 10, order: Sequence[str] = ORDER,
    keys: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET, stats: Sequence[str] = ("mean", "std"),
) -> DataFrame:
    """Rolling mean and sample std of the last ``window`` rows (0 for one row)."""
    make = {"mean": _mean_over, "std": _std_over}
    outputs = {f"{c}_rolling_{s}": make[s](c) for c in cols for s in stats}
    return over_preceding(df, outputs, cols, window, order, keys, rows_per_bucket)


def zscores(df: DataFrame, cols: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Distance from the column's mean in sample standard deviations.

    A zero deviation counts as 1e-9; an undefined one gives NULL. ``known`` is one row of
    ``<col>_mean`` and ``<col>_std``; without it they are taken from the rows.
    """
    stats = F.col(STATS)
    known = mean_and_std(df, cols) if known is None else known

    def z(c: str) -> Column:
        std = stats[f"{c}_std"]
        return (F.col(c) - stats[f"{c}_mean"]) / F.when(std == 0, F.lit(1e-9)).otherwise(std)

    return beside(df, known).withColumns({f"{c}_zscore": z(c) for c in cols}).drop(STATS)


def outlier_flags(df: DataFrame, cols: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Per column: is the z-score beyond the threshold?"""
    return df.withColumns({f"{c}_outlier": F.abs(f"{c}_zscore") > threshold for c in cols})


def stamp_ingestion(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    return df.withColumn("ingestion_timestamp", F.current_timestamp() if as_of is None else as_of)


def enrich(
    df: DataFrame, window: int = 10, threshold: float = 3.0, keys: Sequence[str] = (),
    order: Sequence[str] = ORDER, rows_per_bucket: int = ROWS_PER_BUCKET, as_of: Column | None = None,
) -> DataFrame:
    """Calendar parts, rolling statistics, z-scores, outlier flags and ingestion time.

    The z-scores read the input (one aggregate over it), the rolling statistics
    one pass in row order; all numeric columns share both.
    """
    cols = numeric_columns(df, NOT_MEASURED)
    df = zscores(df, cols)
    df = rolling(df, cols, window, order, keys, rows_per_bucket)
    return stamp_ingestion(outlier_flags(calendar_parts(df), cols, threshold), as_of)
