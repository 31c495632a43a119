"""Descriptive statistics, histograms, correlation and class balance.

Each operator is one pass of partial aggregation; results are small tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.operators.clean import STATS, beside
from telemill.operators.ordered import micros, quantiles_of
from telemill.sources.schema import LABEL, SENSORS


def _rows(per_column: dict[str, dict[str, Column]], name: str) -> Column:
    """An array of structs, one per column, ready to be exploded into rows."""
    return F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), *[v.alias(k) for k, v in fields.items()]) for c, fields in per_column.items()
    ])).alias("r")


def long_form(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "feature") -> DataFrame:
    """One (name, value) row per listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.*")


def report_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean over all cells, and population std and mean of each column."""
    sums = [F.sum(c).alias(f"s_{c}") for c in cols] + [F.count(c).alias(f"n_{c}") for c in cols]
    wide = df.agg(*sums, *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"d_{c}") for c in cols])
    total = sum((F.coalesce(F.col(f"s_{c}"), F.lit(0.0)) for c in cols), F.lit(0.0))
    count = sum((F.col(f"n_{c}") for c in cols), F.lit(0))
    return wide.select(_rows(
        {c: {"grand_mean": F.try_divide(total, count), "mean": F.col(f"m_{c}"), "std": F.col(f"d_{c}")} for c in cols},
        "feature",
    )).select("r.*")


def null_counts(df: DataFrame) -> DataFrame:
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    return wide.select(_rows(
        {c: {"nulls": F.coalesce(F.col(c), F.lit(0)).cast("long")} for c in df.columns}, "column_name"
    )).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the table's row count."""
    return df.agg(F.count("*").alias("n")).select(_rows(
        {c: {"position": F.lit(i), "data_type": F.lit(t), "row_count": F.col("n")} for i, (c, t) in enumerate(df.dtypes)},
        "column_name",
    )).select("r.*")


def describe(
    df: DataFrame, cols: Sequence[str] = SENSORS, digits: int = 3, exact_rows: int = 10_000_000
) -> DataFrame:
    """count, mean, std, min, quartiles and max per column.

    The quartiles are exact. Up to ``exact_rows`` they ride in the same pass;
    beyond that those of all columns are narrowed down together, because
    the one-pass form would hold all distinct values in memory.
    """
    probs = [0.25, 0.5, 0.75]
    small = df.count() <= exact_rows
    narrowed = {} if small else quantiles_of(df, cols, probs)
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"d_{c}"),
            F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
        ]
        if small:
            aggs.append(F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(f"q_{c}"))
    quartiles = {
        c: [F.col(f"q_{c}")[i] for i in range(3)] if small
        else [F.lit(v).cast("double") for v in narrowed[c]]
        for c in cols
    }

    def fields(c: str) -> dict[str, Column]:
        q = quartiles[c]
        values = {
            "mean": F.col(f"m_{c}"), "std": F.col(f"d_{c}"), "min": F.col(f"lo_{c}"),
            "q25": q[0], "q50": q[1], "q75": q[2], "max": F.col(f"hi_{c}"),
        }
        return {"n": F.col(f"n_{c}"), **{k: F.round(v, digits) for k, v in values.items()}}

    return df.agg(*aggs).select(_rows({c: fields(c) for c in cols}, "feature")).select("r.*")


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin number from 1; the top edge belongs to the last bin.

    A single-valued column gets a unit range around the value, as plots do.
    """
    lo = F.when(low == high, low - 0.5).otherwise(low)
    hi = F.when(low == high, high + 0.5).otherwise(high)
    number = F.least(F.floor((value - lo) / ((hi - lo) / bins)) + 1, F.lit(bins)).cast("int")
    return F.when(value.isNotNull(), number)  # least() alone would drop the NULL


def histogram(df: DataFrame, cols: Sequence[str] = SENSORS, bins: int = 40) -> DataFrame:
    """Non-empty bins of each column: bin number, edges and count."""
    ranges = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols])
    ends = F.col(STATS)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("feature"), ends[f"lo_{c}"].cast("double").alias("lo"), ends[f"hi_{c}"].cast("double").alias("hi"),
            _bin(F.col(c), ends[f"lo_{c}"], ends[f"hi_{c}"], bins).alias("bin"),
        ) for c in cols
    ])
    counted = (
        beside(df, ranges).select(F.explode(cells).alias("c")).select("c.*").filter("bin IS NOT NULL")
        .groupBy("feature", "lo", "hi", "bin").agg(F.count("*").alias("n"))
    )
    return _edges(counted, ["feature"], bins)


def _edges(counted: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    flat = F.col("lo") == F.col("hi")
    lo = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    step = F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / bins
    return counted.select(
        *keys, "bin", (lo + (F.col("bin") - 1) * step).alias("bin_start"), (lo + F.col("bin") * step).alias("bin_end"), "n"
    )


def histogram_by(
    df: DataFrame, cols: Sequence[str] = SENSORS, by: str = LABEL, bins: int = 40, max_broadcast_groups: int = 1000
) -> DataFrame:
    """Histogram within each group of ``by``; every group has its own range.

    The ranges are one row per group and column. While the groups are few (a
    class label has two) they are broadcast and the values never move. With many
    groups the values are first combined to counts per distinct value, so a group
    that holds most rows reaches the join as its distinct values only.
    """
    wide = df.groupBy(by).agg(
        *[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]
    )
    ranges = wide.select(F.col(by).alias("_by"), _rows(
        {c: {"lo": F.col(f"lo_{c}").cast("double"), "hi": F.col(f"hi_{c}").cast("double")} for c in cols}, "_feature"
    )).select("_by", "r.*")
    values = long_form(df, cols, [by]).filter("value IS NOT NULL").withColumn("n", F.lit(1).cast("long"))
    if wide.limit(max_broadcast_groups + 1).count() <= max_broadcast_groups:
        ranges = F.broadcast(ranges)
    else:
        values = values.groupBy(by, "feature", "value").agg(F.sum("n").alias("n"))
    counted = (
        values.join(ranges, F.col(by).eqNullSafe(F.col("_by")) & (F.col("feature") == F.col("_feature")))
        .withColumn("bin", _bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
        .groupBy(by, "feature", "lo", "hi", "bin").agg(F.sum("n").alias("n"))
    )
    return _edges(counted, [by, "feature"], bins)


def correlations(df: DataFrame, cols: Sequence[str] = SENSORS) -> DataFrame:
    """Lower triangle of the Pearson matrix, pairwise complete, in one pass."""
    pairs = [(b, a) for a, b in combinations(cols, 2)]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}|{b}`").alias("correlation"))
        for a, b in pairs
    ])
    return wide.select(F.explode(cells).alias("r")).select("r.*")


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    positive = F.count_if(F.col(label).cast("int") == 1)
    return df.agg(
        F.count("*").alias("total"), F.count_if(F.col(label).cast("int") == 0).alias("normal"),
        positive.alias("anomalous"), F.try_divide(positive, F.count("*")).alias("rate"),
    )


def score_summary(df: DataFrame, score: str = "anomaly_score") -> DataFrame:
    return df.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))


def scaler_report(df: DataFrame, cols: Sequence[str] = SENSORS, digits: int = 3) -> DataFrame:
    wide = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"d_{c}") for c in cols])
    return wide.select(_rows(
        {c: {"mean": F.round(f"m_{c}", digits), "std": F.round(f"d_{c}", digits)} for c in cols}, "feature"
    )).select("r.*")


def trend(df: DataFrame, col: str = "temperature", label: str = LABEL, ts: str = "timestamp") -> DataFrame:
    """The raw series in time order."""
    return df.select(ts, col, label).orderBy(ts)


def trend_buckets(df: DataFrame, minutes: int = 60, col: str = "temperature", label: str = LABEL) -> DataFrame:
    """The series condensed for plotting: mean, min, max and anomalies per time bucket."""
    width = minutes * 60 * 1_000_000
    start = F.timestamp_micros(F.floor(micros(df, "timestamp") / width) * width)
    return df.groupBy(start.alias("bucket")).agg(
        F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"), F.count_if(F.col(label)).alias("anomalies")
    ).orderBy("bucket")
