"""The bucketed order operators equal their naive, single-window forms."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemill.operators.features import enrich, rolling, zscores
from telemill.operators.ordered import bucketed, exact_quantiles, forward_fill, over_preceding, quantiles_of, running_totals
from telemill.operators import ordered


def series(spark, n=3000, seed=1, hot=0.0, hot_null=0.0, machines=3):
    """Rows in random order; shares of them have one same timestamp, or none."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        u = rng.random()
        t = 1_700_000_000 + (500_000 if u < hot else rng.randrange(1_000_000))
        ts = None if hot <= u < hot + hot_null else t
        x = None if rng.random() < 0.3 else rng.gauss(10, 3)
        rows.append((i, f"M{rng.randrange(machines)}", ts, x))
    df = spark.createDataFrame(rows, "event_id long, machine_id string, sec long, x double")
    return df.withColumn("timestamp", F.timestamp_seconds("sec")).drop("sec")


def naive_rolling(df, window, keys=()):
    spec = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("timestamp"), "event_id").rowsBetween(-(window - 1), 0)
    return df.withColumns({
        "x_rolling_mean": F.avg("x").over(spec), "x_rolling_std": F.coalesce(F.stddev_samp("x").over(spec), F.lit(0.0))
    })


def by_id(df, *cols):
    return {r["event_id"]: tuple(r[c] for c in cols) for r in df.select("event_id", *cols).collect()}


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


CASES = [{}, {"hot": 0.4}, {"hot": 0.3, "hot_null": 0.3}, {"hot_null": 0.5}, {"n": 7}, {"n": 1}]


@pytest.mark.parametrize("case", CASES, ids=str)
@pytest.mark.parametrize("keys", [(), ("machine_id",)], ids=str)
@pytest.mark.parametrize("per_bucket", [5, 200])
def test_rolling(spark, case, keys, per_bucket):
    df = series(spark, **case)
    ours = by_id(rolling(df, ["x"], 10, keys=keys, rows_per_bucket=per_bucket), "x_rolling_mean", "x_rolling_std")
    theirs = by_id(naive_rolling(df, 10, keys), "x_rolling_mean", "x_rolling_std")
    assert ours.keys() == theirs.keys()
    assert all(close(a, b) for i in ours for a, b in zip(ours[i], theirs[i]))


@pytest.mark.parametrize("case", CASES, ids=str)
@pytest.mark.parametrize("keys", [(), ("machine_id",)], ids=str)
def test_forward_fill(spark, case, keys):
    df = series(spark, **case)
    spec = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("timestamp"), "event_id").rowsBetween(Window.unboundedPreceding, 0)
    theirs = by_id(df.withColumn("x", F.last("x", ignorenulls=True).over(spec)), "x")
    assert by_id(forward_fill(df, ["x"], keys=keys, rows_per_bucket=100), "x") == theirs


def test_fill_of_an_all_null_column(spark):
    df = series(spark, 500).withColumn("x", F.lit(None).cast("double"))
    assert forward_fill(df, ["x"], rows_per_bucket=50).filter("x IS NOT NULL").count() == 0


def test_hot_timestamp_is_cut_into_many_buckets(spark):
    df, _, buckets = bucketed(series(spark, 4000, hot=0.5), ["timestamp", "event_id"], 200)
    sizes = [r["n"] for r in df.groupBy("_bucket").agg(F.count("*").alias("n")).collect()]
    assert buckets > 10 and sum(sizes) == 4000
    assert max(sizes) < 4 * 200


def test_buckets_follow_the_order(spark):
    df, order, _ = bucketed(series(spark, 3000, hot=0.4, hot_null=0.2), ["timestamp", "event_id"], 100)
    rows = df.orderBy(F.asc_nulls_last("timestamp"), "event_id").select("_bucket").collect()
    assert all(a["_bucket"] <= b["_bucket"] for a, b in zip(rows, rows[1:]))


def test_copies_of_one_row_are_cut_too(spark):
    copies = spark.range(0, 2000).select(
        F.lit(1).cast("long").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("timestamp"), F.lit(2.0).alias("x")
    )
    df, order, _ = bucketed(copies, ["timestamp", "event_id"], 100)
    sizes = [r["n"] for r in df.groupBy("_bucket").agg(F.count("*").alias("n")).collect()]
    assert order[-1] == "_seq" and max(sizes) < 500
    rolled = rolling(copies, ["x"], 10, rows_per_bucket=100)
    assert rolled.columns == [*copies.columns, "x_rolling_mean", "x_rolling_std"]
    assert rolled.filter("x_rolling_mean <> 2 OR x_rolling_std <> 0").count() == 0 and rolled.count() == 2000


@pytest.mark.parametrize("per_bucket", [3, 50, 10_000])
def test_running_totals(spark, per_bucket):
    df = spark.createDataFrame([(float(i % 400), i) for i in range(2000)], "v double, n long").groupBy("v").agg(F.sum("n").alias("n"))
    got = {r["v"]: r["n_before"] for r in running_totals(df, ["n"], ["v"], per_bucket).collect()}
    total = 0
    for r in sorted(df.collect(), key=lambda r: r["v"]):
        assert got[r["v"]] == total
        total += r["n"]


@pytest.mark.parametrize("direct", [50, 500, 100_000])
def test_exact_quantiles(spark, direct):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.exponential(size=500)])
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    probs = [0.0, 0.03, 0.25, 0.5, 0.731, 0.95, 1.0]
    assert np.allclose(exact_quantiles(df, "v", probs, direct), np.quantile(values, probs), atol=1e-12)


def test_quantile_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


@pytest.mark.parametrize("reach", [3e-4, 2e-2])
def test_many_columns_take_few_passes(spark, monkeypatch, reach):
    """Eighteen columns and four shares, ties and nulls among them, against numpy; passes are counted."""
    monkeypatch.setattr(ordered, "REACH", reach)
    monkeypatch.setattr(ordered, "ACCURACY", 2000)
    n = 60_000
    kinds = [F.rand(k) if k % 3 else F.floor(F.rand(k) * 5) if k % 2 else F.when(F.rand(k) < 0.9, F.randn(k)) for k in range(17)]
    df = spark.range(n).select(*[x.cast("double").alias(f"c{k}") for k, x in enumerate(kinds)], F.lit(None).cast("double").alias("none"))
    df = spark.createDataFrame(df.toPandas().astype(object).where(lambda x: x.notna(), None), df.schema).repartition(4).cache()
    local, probs, passes = df.toPandas(), [0.0, 0.25, 0.333, 1.0], []
    first = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: passes.append(1) or first(self))
    got = quantiles_of(df, df.columns, probs, direct_rows=3000)
    assert got["none"] == [None] * 4
    for c in df.columns[:-1]:
        values = local[c].dropna().astype(float)
        assert np.allclose(got[c], np.quantile(values, probs), atol=1e-12), c
    assert len(passes) <= 3 + 4  # counts, brackets twice at most; single tied brackets read once more


def test_enrichment_edges(spark):
    one = series(spark, 1)
    row = enrich(one.withColumn("x", F.lit(3.0))).first()
    assert row["x_rolling_mean"] == 3.0 and row["x_rolling_std"] == 0.0 and row["x_zscore"] is None
    flat = zscores(series(spark, 20).withColumn("x", F.lit(5.0)), ["x"])
    assert {r["x_zscore"] for r in flat.collect()} == {0.0}
    assert enrich(series(spark, 5).limit(0)).count() == 0


def tied(spark, n=4000):
    """String ids, a third of the rows at one time, ids that share a long beginning and big numbers."""
    rng = random.Random(4)
    rows = [(f"MACHINE_{rng.randrange(3):03d}_{i % 1777}_{i}", 500 if rng.random() < 0.33 else rng.randrange(1000), (1 << 60) + i // 3, None if rng.random() < 0.3 else rng.gauss(5, 2)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "event_id string, sec long, big long, x double")
    return df.withColumn("timestamp", F.timestamp_seconds("sec"))


@pytest.mark.parametrize("order", [("timestamp", "event_id"), ("event_id",), ("big", "event_id")], ids=str)
@pytest.mark.parametrize("per_bucket", [100, 1000])
def test_string_ids_and_tied_times(spark, order, per_bucket):
    df = tied(spark)
    by = [F.asc_nulls_last(c) for c in order]
    mean = F.avg("x").over(Window.orderBy(*by).rowsBetween(-9, 0))
    last = F.last("x", ignorenulls=True).over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    theirs = by_id(df.select("event_id", mean.alias("m"), last.alias("f")), "m", "f")
    rolled = by_id(over_preceding(df, {"m": lambda w: F.avg("x").over(w)}, ["x"], 10, order, rows_per_bucket=per_bucket), "m")
    filled = by_id(forward_fill(df, ["x"], order=order, rows_per_bucket=per_bucket), "x")
    assert all(close(rolled[i][0], theirs[i][0]) and filled[i][0] == theirs[i][1] for i in theirs)
