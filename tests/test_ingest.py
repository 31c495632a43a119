"""Known ids without the history, incremental enrichment, landing of scored rows."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telemill.ml.forest import ForestParams, fit
from telemill.operators.features import enrich
from telemill.plans import incremental, ingest
from telemill.session import remove, scratch, shared_dir, working, written
from telemill.sources import seen as seen_module
from telemill.sources.schema import EVENT_SCHEMA, SENSORS
from telemill.sources.seen import SeenKeys
from telemill.sources.tables import encode_events, read_table


def local(path: str) -> Path:
    return Path(path.removeprefix("file:"))


def make(spark, rows):
    """Events of (id, machine, seconds or None, temperature)."""
    start = datetime(2024, 1, 1)
    full = [(i, m, None if s is None else start + timedelta(seconds=s), t, *[None] * 5, False) for i, m, s, t in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)


def send(spark, root, rows):
    ingest.load_lines(encode_events(make(spark, rows)).select("value"), root)


DAY = 86_400


def test_only_files_an_id_may_be_in_are_opened(spark):
    root = scratch(spark, "seen")
    send(spark, root, [(f"id{i}", "M1", (i % 20) * DAY, 1.0) for i in range(4000)])
    index = SeenKeys(spark, f"{root}/{ingest.RAW}", "event_id", f"{root}/{ingest.RAW}_seen")
    new = spark.createDataFrame([(f"new{i}",) for i in range(2000)], "event_id string")
    assert index.named(index.maybe(new, 2000)) is None  # nothing is opened for new ids
    # Of two known ids' parts only theirs are opened, of the table only their dates: all other files are unreadable here.
    known = spark.createDataFrame([("id21",), ("id41",), ("new1",)], "event_id string")
    parts = {r.part for r in index._hashed(known).collect()}
    assert len(parts) < index.parts
    for name in ("keys", "filters"):
        for f in local(f"{root}/{ingest.RAW}_seen/{name}").glob("part=*/*.parquet"):
            if f.parent.name not in {f"part={p}" for p in parts}:
                f.write_bytes(b"broken")
                f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    for f in local(f"{root}/{ingest.RAW}").glob("event_date=*/*.parquet"):
        if f.parent.name > "event_date=2024-01-02":  # the schema is read from the first
            f.write_bytes(b"broken")
            f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    with working(spark, "batch") as path:
        batch = written(make(spark, [("id21", "M1", 9 * DAY, 2.0), ("id41", "M1", 0, 2.0), ("new1", "M1", 0, 1.0)]).withColumn("event_date", F.to_date("timestamp")), f"{path}/b")
        assert [r.event_id for r in index.unseen(batch, path).collect()] == ["new1"]


def test_filters_miss_no_key_and_seldom_lie(spark, monkeypatch):
    monkeypatch.setattr(seen_module, "KEYS_PER_FILTER", 500)
    monkeypatch.setattr(seen_module, "KEYS_PER_GROUP", 100)
    table, folder = scratch(spark, "t"), scratch(spark, "f")
    rows = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("k"), F.current_date().alias("event_date"))
    index = SeenKeys(spark, table, "k", folder, parts=8)
    index.add(rows)
    assert index.filters().groupBy("part").count().agg(F.min("count")).first()[0] > 1
    assert index.maybe(rows.select("k"), 30_000).distinct().count() == 30_000
    assert index.maybe(spark.range(30_000).select(F.concat(F.lit("x"), "id").alias("k")), 30_000).count() < 10
    assert SeenKeys(spark, table, "k", folder, parts=99).parts == 8


def test_keys_without_rows_count_as_new_and_merging_keeps_all(spark):
    root = scratch(spark, "seen")
    send(spark, root, [("a", "M1", 0, 1.0)])
    index = SeenKeys(spark, f"{root}/{ingest.RAW}", "event_id", f"{root}/{ingest.RAW}_seen")
    index.add(make(spark, [("b", "M1", 0, 1.0)]).withColumn("event_date", F.to_date("timestamp")))  # a load that broke off
    send(spark, root, [("b", "M1", 5, 2.0), ("a", "M1", 9, 2.0)])
    assert sorted(r.event_id for r in read_table(spark, f"{root}/{ingest.RAW}").collect()) == ["a", "b"]
    for k in range(3):
        send(spark, root, [(f"c{k}", "M1", None, 1.0)])
    merged = index.merge(at_least=1)
    assert merged and index.filters().groupBy("part").count().agg(F.max("count")).first()[0] == 1
    send(spark, root, [("a", "M2", 1, 1.0), ("c1", "M2", 1, 1.0), ("d", "M2", 1, 1.0)])
    assert sorted(r.event_id for r in read_table(spark, f"{root}/{ingest.RAW}").collect()) == ["a", "b", "c0", "c1", "c2", "d"]


def test_parts_multiply_with_the_keys(spark, monkeypatch):
    monkeypatch.setattr(seen_module, "KEYS_PER_PART", 100)
    rows = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.current_date().alias("event_date"))
    index = SeenKeys(spark, scratch(spark, "t"), "k", scratch(spark, "f"))
    index.add(rows)
    assert index.merge() == list(range(index.parts)) and index.parts >= 32 and index.merge() == []
    again = SeenKeys(spark, index.table, "k", index.folder)
    assert again.parts == index.parts and again.maybe(rows.select("k"), 3000).distinct().count() == 3000


def test_a_table_without_an_index_gets_one(spark):
    root = scratch(spark, "old")
    rows = make(spark, [("a", "M1", 0, 1.0), ("b", "M1", DAY, 1.0)])
    ingest.write_table(rows, f"{root}/{ingest.RAW}")
    send(spark, root, [("b", "M1", 5 * DAY, 1.0), ("c", "M1", 0, 1.0)])
    assert sorted(r.event_id for r in read_table(spark, f"{root}/{ingest.RAW}").collect()) == ["a", "b", "c"]


def test_of_two_forms_in_a_batch_the_earliest_stays(spark):
    root = scratch(spark, "forms")
    send(spark, root, [("a", "M1", None, 1.0), ("a", "M1", 50, 2.0), ("a", "M1", 20, 3.0), ("a", "M0", 20, 4.0)])
    (row,) = read_table(spark, f"{root}/{ingest.RAW}").collect()
    assert (row.timestamp.second, row.machine_id) == (20, "M0")


def same(a, b):
    keep = [c for c in a.columns if c != "ingestion_timestamp"]
    left, right = ({r.event_id: r for r in df.select(keep).collect()} for df in (a, b.select(a.columns)))
    assert left.keys() == right.keys()
    for i, r in left.items():
        for c in keep:
            x, y = r[c], right[i][c]
            assert x == y or (isinstance(x, float) and y == pytest.approx(x, rel=1e-9, abs=1e-9)), (i, c, x, y)


@pytest.mark.parametrize("keys", [(), ("machine_id",)])
def test_incremental_equals_the_whole_table(spark, keys):
    root, draw = scratch(spark, "inc"), random.Random(5)

    def some(prefix, days, n):
        return [
            (f"{prefix}{i}", f"M{draw.randrange(3)}", None if draw.random() < 0.05 else draw.choice(days) * DAY + draw.randrange(40), draw.gauss(70, 9))
            for i in range(n)
        ]

    loads = [some("a", [0, 1, 2, 5, 9], 60), some("b", [9, 10], 20), some("c", [1], 3), [("a3", "M1", 11 * DAY, 1.0), *some("d", [20], 2)], some("e", [5], 1)]
    for k, rows in enumerate(loads):
        send(spark, root, rows)
        got = ingest.refresh_processed(spark, root, window=6, keys=keys)
        whole = enrich(read_table(spark, f"{root}/{ingest.RAW}"), window=6, keys=keys)
        assert set(got.columns) == set(whole.columns)
        same(got, whole)
    assert incremental.refresh(spark, f"{root}/{ingest.RAW}", f"{root}/{ingest.PROCESSED}", root, window=6, keys=keys) == []


def test_a_late_row_rewrites_only_the_dates_it_reaches(spark):
    root = scratch(spark, "late")
    send(spark, root, [(f"a{d}_{i}", "M1", d * DAY + i, float(i)) for d in range(12) for i in range(4)])
    raw, done = f"{root}/{ingest.RAW}", f"{root}/{ingest.PROCESSED}"
    assert len(incremental.refresh(spark, raw, done, root, window=6)) == 12
    send(spark, root, [("late", "M1", 3 * DAY + 2, 99.0)])
    dates = incremental.refresh(spark, raw, done, root, window=6)
    assert sorted(d.day for d in dates) == [4, 5, 6]  # its own date and the next five rows
    counts = read_table(spark, raw).groupBy("event_date").agg(F.count("*").alias("rows"))
    _, read = incremental.dates_to_do(counts, [datetime(2024, 1, 4).date()], 6)
    assert sorted(d.day for d in read) == [2, 3, 4, 5, 6]


def test_a_refresh_that_broke_off_is_made_up_for(spark, monkeypatch):
    root = scratch(spark, "broken")
    send(spark, root, [(f"a{i}", "M1", i * DAY, float(i)) for i in range(5)])
    ingest.refresh_processed(spark, root)
    send(spark, root, [("b", "M1", 2 * DAY, 50.0)])
    with monkeypatch.context() as m:
        m.setattr(incremental, "rolling", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.refresh_processed(spark, root)
    same(ingest.refresh_processed(spark, root), enrich(read_table(spark, f"{root}/{ingest.RAW}")))


def test_scored_rows_land_once(spark):
    root = scratch(spark, "landed")
    send(spark, root, [(f"a{i}", f"M{i % 2}", i * 600, 70.0 + i % 7) for i in range(80)])
    raw = read_table(spark, f"{root}/{ingest.RAW}")
    forest = fit(raw.fillna(0.0, list(SENSORS)), SENSORS, ForestParams(n_estimators=5, contamination=0.1))
    for _ in range(2):
        table = ingest.score_and_land(spark, root, forest)
    assert table.count() == 80 and table.filter("features_used LIKE 'temperature,%'").count() == 80
    send(spark, root, [("z", "M1", 100 * DAY, 500.0)])
    assert ingest.score_and_land(spark, root, forest).select("machine_id", "timestamp").distinct().count() == 81


def test_working_tables_go_when_a_load_ends(spark):
    root, folder = scratch(spark, "cycle"), local(f"{shared_dir(spark)}/telemill")
    send(spark, root, [("a", "M1", 0, 1.0)])
    before = {p.name for p in folder.iterdir()}
    for k in range(3):
        send(spark, root, [(f"b{k}", "M1", k, 1.0)])
        ingest.refresh_processed(spark, root)
    assert {p.name for p in folder.iterdir()} == before
    with pytest.raises(ValueError, match="working table"):
        remove(spark, "/tmp/elsewhere")
