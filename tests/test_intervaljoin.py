"""Interval join and its pair-free aggregates against brute force."""

import random
from datetime import date, datetime, timedelta

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telemill.catalog import ALL
from telemill.operators import intervaljoin
from telemill.operators.intervaljoin import interval_join, nearest_join
from telemill.operators.ordered import micros
from telemill.plans import dashboard as d
from telemill.sources.schema import SENSORS

T0 = datetime(2024, 1, 30, 12)


def frames(spark, seed=0, predictions=400, readings=400, hot=0.0, machines=4, span=2000.0):
    """Readings and predictions; a share of both falls into one second of one machine."""
    rng = random.Random(seed)

    def when():
        if rng.random() < hot:
            return "M0", T0 + timedelta(seconds=500, microseconds=rng.choice([0, 0, 0, 500_000, 999_999]))
        return f"M{rng.randrange(machines)}", T0 + timedelta(microseconds=rng.randrange(int(span * 1e6)))

    left, right = [], []
    for _ in range(predictions):
        m, t = when()
        left.append((m, t, rng.random() < 0.3, round(rng.random(), 3), round(rng.random(), 3), t.date()))
    for i in range(readings):
        m, t = when()
        x = [None if rng.random() < 0.1 else round(rng.uniform(0, 120), 2) for _ in SENSORS]
        right.append((str(i), m, t, *x, rng.random() < 0.2, t.date()))
    p = spark.createDataFrame(
        left, "machine_id string, timestamp timestamp, is_anomaly boolean, anomaly_score double, confidence double, event_date date"
    )
    e = spark.createDataFrame(
        right, "event_id string, machine_id string, timestamp timestamp, " + ", ".join(f"{c} double" for c in SENSORS)
        + ", is_simulated_anomaly boolean, event_date date",
    )
    return p, e


def brute(p, e):
    a, b = p.toPandas().reset_index(names="lid"), e.toPandas()
    both = a.merge(b, on="machine_id", suffixes=("", "_e"))
    both = both[(both["timestamp"] - both["timestamp_e"]).abs() <= pd.Timedelta(seconds=5)]
    return a, both


@pytest.mark.parametrize("hot", [0.0, 0.35])
@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 10, "rows_per_salt": 7}], ids=["plain", "salted"])
def test_pairs(spark, hot, tuning):
    p, e = frames(spark, hot=hot)
    a, both = brute(p, e)
    want = sorted(zip(both["lid"], both["event_id"]))
    lonely = len(a) - both["lid"].nunique()
    keyed = p.withColumn("lid", F.monotonically_increasing_id())
    got = interval_join(keyed, e, ["event_id"], **tuning).collect()
    order = {r["lid"]: i for i, r in enumerate(keyed.collect())}
    assert sorted((order[r["lid"]], r["event_id"]) for r in got if r["event_id"]) == want
    assert sum(r["event_id"] is None for r in got) == lonely


@pytest.mark.parametrize("left_hot,right_hot", [(600, 40), (40, 600)])
def test_one_sided_heat(spark, left_hot, right_hot):
    p, _ = frames(spark, 1, predictions=left_hot, hot=0.9)
    _, e = frames(spark, 2, readings=right_hot, hot=0.5)
    a, both = brute(p, e)
    got = interval_join(p, e, ["event_id"], hot_rows=50, rows_per_salt=20)
    assert got.filter("event_id IS NOT NULL").count() == len(both)
    assert got.filter("event_id IS NULL").count() == len(a) - both["lid"].nunique()


def buckets(df, key, bucket):
    return df.withColumn(bucket, F.floor(micros(df, "timestamp") / 10_000_000)).withColumnRenamed("machine_id", key)


def test_hot_buckets_and_their_salts(spark):
    p, e = frames(spark, hot=0.4, readings=100)
    (row,) = intervaljoin._hot_buckets(buckets(p, "machine_id", "_bk"), buckets(e, "_rk", "_rbk"), "machine_id", 50, 30).collect()
    assert row["_hk"] == "M0" and 4 < row["_a"] <= 8 and row["_b"] == 1


@pytest.mark.parametrize("most", [100_000, 0], ids=["broadcast", "dealt"])
def test_many_hot_buckets_reach_no_driver(spark, monkeypatch, most):
    """100,000 hot buckets, half of the left rows without a match, and no row collected."""
    monkeypatch.setattr(intervaljoin, "MAX_BROADCAST_BUCKETS", most)
    start = F.lit(T0).cast("timestamp")
    at = lambda df, s: df.select(F.concat(F.lit("M"), F.col("id") % 5).alias("machine_id"), (start + F.make_dt_interval(secs=s)).alias("timestamp"), "id")
    p = at(spark.range(100_000), F.col("id") * 10)
    e = at(spark.range(0, 100_000, 2), F.col("id") * 10 + 1)
    with monkeypatch.context() as m:
        m.setattr(type(p), "collect", lambda self: pytest.fail("rows were collected"))
        joined = interval_join(p.withColumnRenamed("id", "lid"), e, ["id"], hot_rows=1, rows_per_salt=1)
        assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString() or most
    found = joined.agg(F.count("*"), F.count("id"), F.sum((F.col("id") == F.col("lid")).cast("int"))).first()
    assert tuple(found) == (100_000, 50_000, 50_000)


@pytest.mark.parametrize("hot", [0.35, 0.9])
def test_dealt_lookup_gives_the_same_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(intervaljoin, "MAX_BROADCAST_BUCKETS", 0)
    p, e = frames(spark, hot=hot)
    a, both = brute(p, e)
    got = interval_join(p, e, ["event_id"], hot_rows=5, rows_per_salt=7)
    assert got.filter("event_id IS NOT NULL").count() == len(both)
    assert got.filter("event_id IS NULL").count() == len(a) - both["lid"].nunique()


def test_both_ends_are_inclusive(spark):
    p = spark.createDataFrame([("M", T0)], "machine_id string, timestamp timestamp")
    offsets = [-5_000_001, -5_000_000, -1, 0, 4_999_999, 5_000_000, 5_000_001]
    e = spark.createDataFrame([("M", T0 + timedelta(microseconds=o), o) for o in offsets], "machine_id string, timestamp timestamp, o long")
    assert sorted(r["o"] for r in interval_join(p, e, ["o"]).collect()) == offsets[1:-1]


def test_null_keys_match_nothing_and_stay(spark):
    p = spark.createDataFrame([(None, T0), ("M", None), ("M", T0)], "machine_id string, timestamp timestamp")
    e = spark.createDataFrame([(None, T0, 1), ("M", None, 2), ("M", T0, 3)], "machine_id string, timestamp timestamp, o long")
    for joined in (interval_join(p, e, ["o"]), nearest_join(p, e, ["o"], "o")):
        rows = joined.collect()
        assert len(rows) == 3 and [r["o"] for r in rows if r["o"]] == [3]


def test_nearest(spark):
    p, e = frames(spark, 5, hot=0.2)
    a, both = brute(p, e)
    both["gap"] = (both["timestamp"] - both["timestamp_e"]).abs()
    best = both.sort_values(["gap", "event_id"]).groupby("lid").first()["event_id"]
    for block in (10, 60):
        got = nearest_join(p, e, ["event_id"], "event_id", block_s=block).collect()
        assert len(got) == len(a)
        assert sorted(r["event_id"] for r in got if r["event_id"]) == sorted(best)


@pytest.mark.parametrize("hot", [0.0, 0.35])
@pytest.mark.parametrize("name", ["q4", "q6", "q8", "q9", "q5", "q7"])
def test_dashboard_over_hot_buckets(spark, hot, name):
    """The pair-free aggregates equal the SQL over the joined pairs."""
    p, e = frames(spark, 7, hot=hot, span=90_000.0)
    now = F.lit("2024-01-30 23:59:00").cast("timestamp")
    plan = {
        "q4": lambda: d.temperature_histogram(p, e, now), "q6": lambda: d.machine_statistics(p, e, now),
        "q8": lambda: d.severity_counts(p, e, now), "q9": lambda: d.model_quality(p, e, now),
        "q5": lambda: d.scatter(p, e, 200), "q7": lambda: d.alert_feed(p, e, now, 100),
    }[name]
    query = next(q for q in ALL if q.name.startswith(name + "_"))
    body = query.sql[query.sql.index(", v AS"):].replace("LIMIT 1000", "LIMIT 200")
    con = duckdb.connect()
    pred, raw = p.toPandas(), e.toPandas()
    con.register("pred_rows", pred), con.register("raw_rows", raw)
    from compare import differences
    from telemill.catalog.base import tidy

    sql = "WITH raw AS (SELECT * FROM raw_rows), pred AS (SELECT * FROM pred_rows)" + body
    assert differences(tidy(plan()), con, sql) == []


def test_empty_sides(spark):
    p, e = frames(spark)
    assert interval_join(p.limit(0), e, ["event_id"]).count() == 0
    assert interval_join(p, e.limit(0), ["event_id"]).filter("event_id IS NULL").count() == 400
    now = F.lit("2024-01-30 23:59:00").cast("timestamp")
    rows = d.temperature_histogram(p, e.limit(0), now).collect()
    assert [(r["temp_bin_start"], r["reading_count"]) for r in rows] == [(None, 400)]
    kpi = d.last_hour_kpi(p.limit(0), now).first()
    assert kpi["events_last_hour"] == 0 and kpi["anomalies_last_hour"] is None and kpi["anomaly_rate_pct"] is None


def test_newest_rows_read_only_their_dates(spark, tmp_path):
    """On tables partitioned by date, the readings' scan is pruned by the newest predictions' dates."""
    p, e = frames(spark, 9, span=3 * 86_400.0)
    e.write.partitionBy("event_date").parquet(str(tmp_path / "readings"))
    stored = spark.read.parquet(str(tmp_path / "readings"))
    now = F.lit("2024-01-30 23:59:00").cast("timestamp")
    for plan, plain in ((d.scatter(p, stored, 50), d.scatter(p, e.drop("event_date"), 50)),
                        (d.alert_feed(p, stored, now, 20), d.alert_feed(p, e.drop("event_date"), now, 20))):
        assert "dynamicpruning" in plan._jdf.queryExecution().toString().lower()
        assert sorted(map(str, plan.collect())) == sorted(map(str, plain.collect()))
