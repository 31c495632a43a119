"""Sinks, ingestion and the streaming forms against their batch forms."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telemill.catalog.base import predictions, raw
from telemill.functions import clock
from telemill.ml.forest import ForestParams, fit
from telemill.operators.intervaljoin import interval_join
from telemill.plans import ingest
from telemill.session import scratch
from telemill.sources import tables as io
from telemill.sources.schema import EVENT_SCHEMA, SAMPLE_CSV_SCHEMA, SENSORS
from telemill.streaming import streams as st


def events(spark, n=100, day=1):
    base = datetime(2024, 1, day)
    rows = [(f"d{day}-{i}", f"M{i % 3}", base + timedelta(minutes=i), *[float(i % 7)] * 6, i % 10 == 0) for i in range(n)]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def lines(df):
    return io.encode_events(df).select("value")


def test_csv_without_some_features(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("timestamp,temperature,humidity,pressure,vibration\n2026-04-01 07:00:00,24.1,52.1,1012.9,0.45\n2026-04-01 08:00:00,,53.0,NaN,0.16\n")
    df = io.read_csv(spark, str(path), EVENT_SCHEMA)
    assert df.columns == [f.name for f in SAMPLE_CSV_SCHEMA.fields]
    rows = df.orderBy("timestamp").collect()
    assert rows[0]["vibration"] == 0.45 and rows[1]["temperature"] is None and rows[1]["pressure"] is None


def test_bad_lines_are_quarantined(spark):
    df = spark.createDataFrame([('{"event_id":"1","temperature":7,"is_simulated_anomaly":true}',), ("{oops",), ('{"temperature":"hot"}',)], "value string")
    good, bad = io.split_corrupt(io.decode_events(df))
    assert good.count() == 1 and good.first()["temperature"] == 7.0
    assert {r["line"] for r in bad.collect()} == {"{oops", '{"temperature":"hot"}'}


def test_overwrite_replaces_only_its_dates(spark):
    path = scratch(spark, "t")
    io.write_table(events(spark, day=1), path)
    io.write_table(events(spark, day=2), path)
    io.write_table(events(spark, 10, day=2), path, mode="overwrite")
    by_day = {str(r["event_date"]): r["count"] for r in io.read_table(spark, path).groupBy("event_date").count().collect()}
    assert by_day == {"2024-01-01": 100, "2024-01-02": 10}


def test_dates_without_timestamps(spark):
    df = io.with_event_date(spark.range(1), F.lit("2024-05-06 01:00:00").cast("timestamp"))
    assert str(df.first()["event_date"]) == "2024-05-06"
    assert dict(io.with_event_date(spark.range(1)).dtypes)["event_date"] == "date"


def test_json_batches(spark):
    path = scratch(spark, "j")
    io.write_events_json(events(spark, 250).coalesce(1), path, 100)
    assert len(spark.read.text(path).inputFiles()) == 3


def test_validation(spark):
    assert io.require_rows(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError):
        io.require_rows(spark.range(5), 6)


def test_compaction_narrows_files(spark, sf_dir):
    path = scratch(spark, "c")
    df = raw(spark, sf_dir)
    io.compact(df, path, rows_per_file=1000)
    back = io.read_table(spark, path)
    assert back.select(df.columns).exceptAll(df).count() == 0 and back.count() == df.count()


def test_only_fragmented_dates_are_rewritten_in_place(spark):
    from pathlib import Path

    path = scratch(spark, "worn")
    for day in (1, 2):
        io.write_table(events(spark, 40, day=day).coalesce(1), path)
    events(spark, 60, day=3).repartition(7).transform(io.with_event_date).write.mode("append").partitionBy("event_date").parquet(path)
    io.write_table(spark.createDataFrame([("x", "M1", None)], "event_id string, machine_id string, timestamp timestamp"), path)
    folder = Path(path.removeprefix("file:"))
    files = lambda: {str(f.relative_to(folder)) for f in folder.glob("event_date=*/*.parquet")}
    before, rows = files(), sorted(map(str, io.read_table(spark, path).collect()))
    assert [d.day for d in io.compact_in_place(spark, path)] == [3]
    kept, added = before & files(), files() - before
    assert {f.split("/")[0][-2:] for f in before - kept} == {"03"} and len(added) == 1
    assert sorted(map(str, io.read_table(spark, path).collect())) == rows
    assert io.compact_in_place(spark, path) == []


def test_load_twice_is_the_same_as_once(spark):
    root = scratch(spark, "load")
    ingest.run(lines(events(spark)).union(spark.createDataFrame([("{bad",)], "value string")), root)
    ingest.run(lines(events(spark)).union(lines(events(spark, 50, day=2))), root)
    assert io.read_table(spark, f"{root}/{ingest.RAW}").count() == 150
    done = io.read_table(spark, f"{root}/{ingest.PROCESSED}")
    assert done.count() == 150 and {"temperature_zscore", "voltage_rolling_std", "day_of_week", "temperature_outlier"} <= set(done.columns)
    with pytest.raises(ValueError):
        ingest.refresh_processed(spark, root, at_least=151)


def test_events_without_an_id_are_all_kept(spark):
    root = scratch(spark, "load")
    bare = ['{"machine_id":"M1","timestamp":"2024-01-01T00:00:01Z"}', '{"machine_id":"M1","timestamp":"2024-01-01T00:00:02Z"}',
            '{"temperature":1.5}', '{"temperature":2.5}']
    df = spark.createDataFrame([(v,) for v in [*bare, bare[0], bare[2], "{bad", "{bad"]], "value string")
    for _ in range(2):
        ingest.load_lines(df, root)
    ids = sorted(r["event_id"] for r in io.read_table(spark, f"{root}/{ingest.RAW}").collect())
    assert len(ids) == 4 and "M1_1704067201000" in ids
    assert io.read_table(spark, f"{root}/{ingest.QUARANTINE}").count() == 1


def test_an_event_sent_again_with_another_time_is_stored_once(spark):
    root = scratch(spark, "load")

    def send(*rows):
        ingest.load_lines(spark.createDataFrame([(f'{{"event_id":"{i}","machine_id":"M1"{t}}}',) for i, t in rows], "value string"), root)

    def at(day):
        return f',"timestamp":"2024-01-{day:02d}T00:00:01Z"'

    send(("a", at(1)), ("b", at(1)), ("c", ""))
    send(("a", at(9)), ("b", ""), ("c", at(9)), ("d", at(9)), ("e", ""))
    send(("e", at(20)), ("d", at(1)))
    stored = io.read_table(spark, f"{root}/{ingest.RAW}").collect()
    assert sorted(r["event_id"] for r in stored) == ["a", "b", "c", "d", "e"]
    assert next(r for r in stored if r["event_id"] == "a")["timestamp"].day == 1


def test_recent_skips_whole_dates(spark):
    path = scratch(spark, "t")
    for day in (1, 2, 3):
        io.write_table(events(spark, 20, day=day), path)
    now = F.lit("2024-01-03 00:10:00").cast("timestamp")
    recent = io.read_table(spark, path).filter(clock.recent("timestamp", now, 1, "HOUR"))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-02" in plan
    assert recent.count() == 20


def arrive(df, path, parts):
    """Write the rows in time order, a file group at a time."""
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    first, last = df.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (last - first) / parts
    for i in range(parts):
        lo, hi = first + i * step, first + (i + 1) * step
        part = df.filter((F.col("timestamp") >= lo) & ((F.col("timestamp") < hi) | F.lit(i == parts - 1)))
        lines(part.coalesce(1)).write.mode("append").text(path)
        time.sleep(0.05)
    end = df.select(*[F.lit(None).cast(t).alias(c) for c, t in df.dtypes]).limit(1)
    end = end.withColumns({"machine_id": F.lit("closing"), "timestamp": F.lit(last + timedelta(days=3))})
    lines(end.coalesce(1)).write.mode("append").text(path)


@pytest.fixture(scope="module")
def scored_lines(spark, sf_dir):
    path = scratch(spark, "predictions")
    arrive(predictions(spark, sf_dir).drop("event_date"), path, 3)
    return path


def run(spark, stream):
    out = scratch(spark, "out")
    st.to_table(stream, out, scratch(spark, "cp")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


PREDICTION = "machine_id string, timestamp timestamp, is_anomaly boolean, anomaly_score double, confidence double"


def prediction_stream(spark, path, files=1):
    from pyspark.sql.types import StructType

    return st.event_stream(st.line_stream(spark, path, files), StructType.fromDDL(PREDICTION))


@pytest.mark.parametrize("make", [st.tumbling_counts, st.rolling_rate], ids=["tumbling", "rolling"])
def test_windows_over_several_batches(spark, sf_dir, scored_lines, make):
    batch = make(predictions(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    assert same(run(spark, make(prediction_stream(spark, scored_lines))), batch)


def test_stream_join_equals_batch_join(spark, sf_dir, scored_lines):
    readings = raw(spark, sf_dir).drop("event_date")
    path = scratch(spark, "readings")
    arrive(readings, path, 2)
    stream = st.interval_join_stream(prediction_stream(spark, scored_lines, None), st.event_stream(st.line_stream(spark, path)))
    got = run(spark, stream).filter("machine_id <> 'closing'")
    p = predictions(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    e = readings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    want = interval_join(p, e, list(SENSORS)).withColumnRenamed("timestamp", "prediction_time").drop("event_date")
    assert same(got, want)


def test_folded_stream_join_equals_batch_join(spark, sf_dir, scored_lines):
    readings = raw(spark, sf_dir).drop("event_date")
    path = scratch(spark, "readings")
    arrive(readings, path, 2)
    buckets = st.interval_join_stream(prediction_stream(spark, scored_lines, None), st.event_stream(st.line_stream(spark, path, 1)), folded=True)
    got = st.unfolded(run(spark, buckets)).filter("machine_id <> 'closing'")
    p = predictions(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    e = readings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    want = interval_join(p, e, list(SENSORS)).withColumnRenamed("timestamp", "prediction_time").drop("event_date")
    assert same(got, want)


@pytest.mark.parametrize("tolerance", [5, 3])
def test_folded_join_lands_buckets_and_not_pairs(spark, tolerance):
    base, copies = datetime(2024, 1, 1), 40
    edges = [0, 4.999999, 5, 5.000001, 9.999999, 10, 14.999999, 15, 15.000001, 20, 30, 36, 70, -5, -5.000001]
    p = [(m, base + timedelta(seconds=t), k % 2 == 0, float(k), None) for k, t in enumerate(edges) for m in ("M1", "M2", None)]
    e = [(str(k), m, base + timedelta(seconds=t), *[float(k)] * 6, False) for k, t in enumerate(edges[:-4]) for m in ("M1", None)]
    p, e = spark.createDataFrame(p, PREDICTION), spark.createDataFrame(e, EVENT_SCHEMA)
    p, e = (t.crossJoin(spark.range(copies)).drop("id") for t in (p, e))
    paths = scratch(spark, "predictions"), scratch(spark, "readings")
    arrive(p, paths[0], 3)
    arrive(e, paths[1], 2)
    buckets = st.interval_join_stream(
        prediction_stream(spark, paths[0], 1), st.event_stream(st.line_stream(spark, paths[1], 1)), tolerance, folded=True
    )
    landed = run(spark, buckets).filter("machine_id IS NULL OR machine_id <> 'closing'")
    want = interval_join(p, e, list(SENSORS), tolerance_s=tolerance).withColumnRenamed("timestamp", "prediction_time")
    assert same(st.unfolded(landed, tolerance), want)
    assert landed.count() <= 3 * len(edges) < want.count() / 100


def test_restarted_ingest_takes_each_event_once(spark):
    source, root, checkpoint = scratch(spark, "in"), scratch(spark, "root"), scratch(spark, "cp")
    lines(events(spark)).write.mode("append").text(source)
    st.ingest(st.line_stream(spark, source), root, checkpoint).awaitTermination()
    lines(events(spark).union(events(spark, 20, day=2))).write.mode("append").text(source)
    st.ingest(st.line_stream(spark, source), root, checkpoint).awaitTermination()
    st.ingest(st.line_stream(spark, source), root, scratch(spark, "cp")).awaitTermination()  # progress lost: all again
    assert io.read_table(spark, f"{root}/{ingest.RAW}").count() == 120


def test_scoring_stream_repeats_without_copies(spark):
    df = events(spark, 200)
    forest = fit(df, SENSORS, ForestParams(n_estimators=5, contamination=0.1))
    source, out = scratch(spark, "in"), scratch(spark, "out")
    lines(df).write.text(source)
    for _ in range(2):
        st.score_stream(st.event_stream(st.line_stream(spark, source)), forest, out, scratch(spark, "cp")).awaitTermination()
    done = spark.read.parquet(out)
    assert done.count() == 200 and done.select("event_id").distinct().count() == 200
    assert done.filter("confidence < 0 OR confidence > 1").count() == 0


EPISODE_ROWS = [
    ("M1", 0, True, 0.4), ("M1", 300, True, 0.9), ("M1", 900, True, 0.2), ("M1", 1501, True, 0.6), ("M1", 1600, False, 1.0),
    ("M2", 100, False, 0.9), ("M2", 5000, True, 0.3), ("M1", 1501, True, 0.1), (None, 50, True, 0.5), ("M3", None, True, 0.9),
]


def test_alert_episodes_follow_the_cool_down(spark):
    from telemill.operators.alerts import alert_episodes

    start = datetime(2024, 1, 1)
    rows = [(m, None if s is None else start + timedelta(seconds=s), a, x, 0.0) for m, s, a, x in EPISODE_ROWS]
    found = alert_episodes(spark.createDataFrame(rows, PREDICTION)).collect()
    at = lambda t: int((t - start).total_seconds())
    assert sorted((r.machine_id or "", at(r.opened), at(r.last_anomaly), r.anomalies, r.worst_score, r.severity) for r in found) == [
        ("", 50, 50, 1, 0.5, "WARNING"), ("M1", 0, 900, 3, 0.9, "CRITICAL"), ("M1", 1501, 1501, 2, 0.6, "WARNING"), ("M2", 5000, 5000, 1, 0.3, "LOW"),
    ]
    assert all("Anomaly detected on" in r.payload for r in found if r.machine_id)


def test_episodes_and_summaries_over_several_batches_and_a_restart(spark, sf_dir, scored_lines):
    from telemill.operators.alerts import alert_episodes, period_summaries

    batch = predictions(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for make in (alert_episodes, period_summaries):
        out, progress = scratch(spark, "out"), scratch(spark, "cp")
        for _ in range(2):  # the second start finds all done
            stream = make(prediction_stream(spark, scored_lines))
            st.to_table(stream, out, progress).awaitTermination()
        assert same(spark.read.schema(stream.schema).parquet(out), make(batch))
