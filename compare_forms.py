"""Time the scalable operators against naive Spark forms and one-process pandas.

Prints one JSON line per comparison. BENCH_SF_DIR (default sf0.01: the naive join is
quadratic per machine) and BENCH_CPUS choose the tables and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemill.catalog.base import now, predictions, raw
from telemill.operators import stats
from telemill.operators.features import enrich, rolling
from telemill.operators.intervaljoin import interval_join
from telemill.operators.ordered import forward_fill
from telemill.plans import dashboard as d
from telemill.session import local_session
from telemill.sources.schema import SENSORS


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(work, runs: int = 2) -> float:
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def naive_join(p, e):
    e = e.select(F.col("machine_id").alias("m"), F.col("timestamp").alias("t"), *SENSORS)
    gap = F.expr("INTERVAL 5 SECONDS")
    return p.join(e, (p.machine_id == e.m) & p.timestamp.between(e.t - gap, e.t + gap), "left")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores))
    p, e = predictions(spark, sf_dir), raw(spark, sf_dir)
    table = e.toPandas()
    scored = p.toPandas()
    numeric = list(SENSORS)
    by_time = Window.orderBy("timestamp", "event_id")

    def pandas_enrich():
        df = table.sort_values("timestamp")
        for c in numeric:
            df[f"{c}_rolling_mean"] = df[c].rolling(10, min_periods=1).mean()
            df[f"{c}_rolling_std"] = df[c].rolling(10, min_periods=1).std().fillna(0)
            df[f"{c}_zscore"] = (df[c] - df[c].mean()) / df[c].std()

    def pandas_hourly():
        df = scored[scored["timestamp"] >= np.datetime64("2024-01-23T23:59")]
        df.groupby([df["timestamp"].dt.floor("h"), "machine_id"])["is_anomaly"].agg(["size", "sum"])

    def naive_statistics():
        week = p.filter(F.col("timestamp") >= F.date_trunc("day", now()) - F.expr("INTERVAL 7 DAYS"))
        sink(naive_join(week, e).groupBy("machine_id").agg(F.avg("temperature"), F.stddev_samp("temperature"), F.count("*")))

    spec = by_time.rowsBetween(-9, 0)
    comparisons = {
        "interval join": (lambda: sink(naive_join(p, e)), lambda: sink(interval_join(p, e, numeric))),
        "machine statistics over the join": (naive_statistics, lambda: sink(d.machine_statistics(p, e, now()))),
        "rolling mean and std, 6 columns": (
            lambda: sink(e.select("*", *[f(c).over(spec).alias(f"{c}{f.__name__}") for c in numeric for f in (F.avg, F.stddev_samp)])),
            lambda: sink(rolling(e, numeric, rows_per_bucket=10_000)),
        ),
        "forward fill": (
            lambda: sink(e.withColumn("vibration", F.last("vibration", True).over(by_time.rowsBetween(Window.unboundedPreceding, 0)))),
            lambda: sink(forward_fill(e, ["vibration"], rows_per_bucket=10_000)),
        ),
    }
    for name, (naive, ours) in comparisons.items():
        print(json.dumps({"operator": name, "naive_spark_sec": best(naive), "scalable_sec": best(ours)}), flush=True)
    for name, one_process, ours in (
        ("enrich", pandas_enrich, lambda: sink(enrich(e))),
        ("hourly counts", pandas_hourly, lambda: sink(d.hourly_by_machine(p, now()))),
        ("describe", lambda: table[numeric].describe(), lambda: sink(stats.describe(e))),
    ):
        print(json.dumps({"operator": name, "pandas_sec": best(one_process), "spark_sec": best(ours)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
