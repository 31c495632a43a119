"""Enrichment of what a load changed, equal to enriching the whole table.

A row's rolling statistics depend on the rows just before it, so a new row changes its own date
and the next ``window - 1`` rows, wherever they lie. Row counts per date (and key) tell which
dates those are, and which dates before them hold the rows they look back on; only these dates
are read, and only the changed ones rewritten. Z-scores depend on all rows through two numbers
a column: every date keeps its count, mean and sum of squared deviations, which merge exactly. The
stored scores are those at the time their date was written; ``processed`` gives all by the merged
numbers of now. So a load rewrites no old date for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemill.operators.features import ORDER, calendar_parts, outlier_flags, rolling, stamp_ingestion, zscores
from telemill.operators.ordered import ROWS_PER_BUCKET
from telemill.session import delete, working, written
from telemill.sources.schema import NOT_MEASURED, PARTITION, numeric_columns
from telemill.sources.seen import table_or_none
from telemill.sources.tables import read_table, write_table

PENDING, MOMENTS = "pending_dates", "date_moments"


def note_dates(dates: DataFrame, root: str, load: str) -> None:
    """Note the dates that a load is about to add rows to; before it does, so that none is missed."""
    dates.select(PARTITION).distinct().withColumn("load", F.lit(load)).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("load").parquet(f"{root}/{PENDING}")


def on_dates(dates: Sequence) -> Column:
    """Rows of these dates; None stands for rows without one."""
    own = F.col(PARTITION).isin([d for d in dates if d is not None])
    return own | F.col(PARTITION).isNull() if None in dates else own


def date_moments(rows: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per date (and key): rows, and of each column count, mean and sum of squared deviations."""
    parts = [
        p for c in cols
        for p in (F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_mean"), (F.var_pop(c) * F.count(c)).alias(f"{c}_m2"))
    ]
    return rows.groupBy(PARTITION, *keys).agg(F.count("*").alias("rows"), *parts)


def merged(moments: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of ``<col>_mean`` and ``<col>_std`` over all dates."""
    totals = moments.agg(*[
        p for c in cols
        for p in (F.sum(f"{c}_n").alias(f"{c}_n"), F.try_divide(F.sum(F.col(f"{c}_n") * F.col(f"{c}_mean")), F.sum(f"{c}_n")).alias(f"{c}_mean"))
    ])
    around = F.col("_totals")
    spread = [F.sum(F.col(f"{c}_m2") + F.col(f"{c}_n") * F.pow(F.col(f"{c}_mean") - around[f"{c}_mean"], 2)).alias(f"{c}_m2") for c in cols]
    beside = moments.withColumn("_totals", totals.select(F.struct("*").alias("s")).scalar())
    both = beside.agg(F.any_value("_totals").alias("_totals"), *spread)
    std = lambda c: F.when(around[f"{c}_n"] > 1, F.sqrt(F.col(f"{c}_m2") / (around[f"{c}_n"] - 1)))
    return both.select(*[p for c in cols for p in (around[f"{c}_mean"].alias(f"{c}_mean"), std(c).alias(f"{c}_std"))])


def dates_to_do(counts: DataFrame, changed: Sequence, window: int, keys: Sequence[str] = ()) -> tuple[list, list]:
    """(dates to rewrite, dates to read) when the ``changed`` dates got rows; ``counts`` has rows per date and key.

    Dates stand in the order of the rows, those without one last.
    """
    spec = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(PARTITION))
    upto = F.sum("rows").over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("rows")).withColumn("new", on_dates(changed))
    last = F.max(F.when(F.col("new"), F.col("upto"))).over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    touched = placed.withColumn("touched", F.col("new") | F.coalesce(F.col("before") < last + (window - 1), F.lit(False)))
    # A date to rewrite may lie in one key's rows only; the others' rows of that date need what precedes them too.
    if keys:
        touched = touched.withColumn("touched", F.max("touched").over(Window.partitionBy(PARTITION)))
    following = F.min(F.when(F.col("touched"), F.col("before"))).over(spec.rowsBetween(1, Window.unboundedFollowing))
    read = touched.withColumn("read", F.col("touched") | F.coalesce(F.col("upto") > following - (window - 1), F.lit(False)))
    found = read.filter("read").groupBy(PARTITION).agg(F.max("touched").alias("touched")).collect()  # one row a date
    return [r[0] for r in found if r["touched"]], [r[0] for r in found]


def _moments_path(root: str, window: int, keys: Sequence[str]) -> str:
    """Moments are kept with the settings their table was enriched by; other settings start anew."""
    return f"{root}/{MOMENTS}/{'-'.join([str(window), *keys])}"


def refresh(
    spark: SparkSession, raw_path: str, processed_path: str, root: str, window: int = 10, keys: Sequence[str] = (),
    order: Sequence[str] = ORDER, rows_per_bucket: int = ROWS_PER_BUCKET, as_of: Column | None = None, threshold: float = 3.0,
) -> list:
    """Enrich the dates that loads have changed since the last refresh; returns the dates rewritten.

    A refresh that breaks off is repeated: dates stay noted until it has ended.
    """
    if order[0] != "timestamp":
        raise ValueError("dates follow the timestamp, so it must come first in the order")
    raw = read_table(spark, raw_path)
    cols, path = numeric_columns(raw, NOT_MEASURED), _moments_path(root, window, keys)
    noted, known = table_or_none(spark, f"{root}/{PENDING}"), table_or_none(spark, path)
    pending = noted.select(PARTITION, "load").collect() if noted is not None else []  # one row a date and load
    with working(spark, "refresh") as work:
        if known is None:
            changed = None
            fresh = written(date_moments(raw, cols, keys), f"{work}/moments")
        else:
            changed = list({r[PARTITION] for r in pending})
            if not changed:
                return []
            fresh = written(date_moments(raw.filter(on_dates(changed)), cols, keys), f"{work}/moments")
        write_table(fresh, path, mode="overwrite")
        rows, dates = raw, None
        if changed is not None:
            dates, reach = dates_to_do(read_table(spark, path).select(PARTITION, *keys, "rows"), changed, window, keys)
            rows = raw.filter(on_dates(reach))
        done = calendar_parts(rolling(rows, cols, window, order, keys, rows_per_bucket))
        done = done if dates is None else done.filter(on_dates(dates))
        done = zscores(done, cols, merged(read_table(spark, path), cols))
        done = stamp_ingestion(outlier_flags(done, cols, threshold), as_of)
        write_table(done, processed_path, mode="overwrite")
        dates = [r[0] for r in fresh.select(PARTITION).distinct().collect()] if dates is None else dates
    for load in {r["load"] for r in pending}:
        delete(spark, f"{root}/{PENDING}/load={load}")
    return dates


def processed(spark: SparkSession, processed_path: str, root: str, window: int = 10, threshold: float = 3.0, keys: Sequence[str] = ()) -> DataFrame:
    """The enriched table with z-scores and outlier flags from the moments of all dates."""
    rows, moments = read_table(spark, processed_path), read_table(spark, _moments_path(root, window, keys))
    cols = [c.removesuffix("_m2") for c in moments.columns if c.endswith("_m2")]
    rows = rows.drop(*[f"{c}_{made}" for c in cols for made in ("zscore", "outlier")])
    return outlier_flags(zscores(rows, cols, merged(moments, cols)), cols, threshold)
