"""Batch load: decode, quarantine, store raw, enrich, store processed, validate; landing of scored rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.functions.clock import event_key
from telemill.ml.forest import Forest
from telemill.ml.scoring import score_readings
from telemill.operators.clean import drop_copies
from telemill.plans import incremental
from telemill.session import working, written
from telemill.sources.schema import EVENT_SCHEMA, PARTITION, PREDICTION_TABLE_SCHEMA, align, nan_to_null
from telemill.sources.seen import SeenKeys, table_or_none
from telemill.sources.tables import decode_events, read_csv, read_table, require_rows, split_corrupt, with_event_date, write_table

# Table folders below the root.
RAW, PROCESSED, PREDICTIONS, QUARANTINE = "raw_sensor_events", "processed_sensor_events", "anomaly_predictions", "quarantine"


def with_event_id(events: DataFrame) -> DataFrame:
    """Events without an id get the usual one, machine and epoch milliseconds;
    those without a machine or time get a hash of their content."""
    usual = F.when(
        F.col("machine_id").isNotNull() & F.col("timestamp").isNotNull(), event_key(F.col("machine_id"), F.col("timestamp"))
    )
    content = F.sha2(F.to_json(F.struct(*events.columns)), 256)
    return events.withColumn("event_id", F.coalesce(F.col("event_id"), usual, content))


def first_forms(events: DataFrame) -> DataFrame:
    """One form of each event id: the earliest, dated before undated ones, then the first by content."""
    form = F.struct(*events.columns)
    rank = F.struct(F.col("timestamp").isNull(), F.col("timestamp"), F.to_json(form))
    return events.groupBy("event_id").agg(F.min_by(form, rank).alias("form")).select("form.*")


def quarantine(lines: DataFrame, root: str, path: str) -> None:
    """Keep each distinct bad line once, also when a batch is repeated."""
    lines = written(with_event_date(drop_copies(lines)), f"{path}/bad")
    if lines.isEmpty():
        return
    seen = SeenKeys(lines.sparkSession, f"{root}/{QUARANTINE}", "line", f"{root}/{QUARANTINE}_seen")
    new = written(seen.unseen(lines, f"{path}/bad-seen"), f"{path}/bad-new")
    seen.add(new)
    write_table(new, f"{root}/{QUARANTINE}")
    seen.merge()


def store(events: DataFrame, root: str, path: str) -> None:
    """Add the events whose id the raw table doesn't hold on any date; working tables go below ``path``."""
    batch = written(first_forms(with_event_date(with_event_id(events))), f"{path}/batch")
    seen = SeenKeys(events.sparkSession, f"{root}/{RAW}", "event_id", f"{root}/{RAW}_seen")
    new = written(seen.unseen(batch, f"{path}/seen"), f"{path}/new")
    if new.isEmpty():
        return
    incremental.note_dates(new, root, uuid.uuid4().hex)
    seen.add(new)
    write_table(new, f"{root}/{RAW}")
    seen.merge()


def load_lines(lines: DataFrame, root: str, schema: T.StructType = EVENT_SCHEMA) -> None:
    """Land JSON lines in the raw table, each event once; bad lines are kept apart.

    The batch is decoded once, into a working table that goes when the load has ended.
    """
    with working(lines.sparkSession, "load") as path:
        good, bad = split_corrupt(written(decode_events(lines, schema), f"{path}/decoded"))
        quarantine(bad, root, path)
        store(nan_to_null(good), root, path)


def load_csv(spark: SparkSession, path: str, root: str, schema: T.StructType = EVENT_SCHEMA) -> None:
    with working(spark, "load") as work:
        store(align(read_csv(spark, path, schema), schema), root, work)


def refresh_processed(spark: SparkSession, root: str, at_least: int = 1, threshold: float = 3.0, **options) -> DataFrame:
    """Enrich what loads have added to the raw table and check the outcome.

    Overwriting by date makes a repeated run harmless. The result reads the processed table with
    z-scores over all dates of now.
    """
    incremental.refresh(spark, f"{root}/{RAW}", f"{root}/{PROCESSED}", root, threshold=threshold, **options)
    setting = {k: v for k, v in options.items() if k in ("window", "keys")}
    return require_rows(incremental.processed(spark, f"{root}/{PROCESSED}", root, threshold=threshold, **setting), at_least)


def run(lines: DataFrame, root: str, at_least: int = 1, **options) -> DataFrame:
    """Ingest, enrich, validate."""
    load_lines(lines, root)
    return refresh_processed(lines.sparkSession, root, at_least, **options)


def land_predictions(scored: DataFrame, root: str) -> None:
    """Add scored rows to the predictions table; rows landed before, by machine, time and score, stay single.

    Only the dates of the rows that come in are compared.
    """
    if "features_used" in scored.columns and isinstance(scored.schema["features_used"].dataType, T.ArrayType):
        scored = scored.withColumn("features_used", F.array_join("features_used", ","))
    spark, path = scored.sparkSession, f"{root}/{PREDICTIONS}"
    with working(spark, "predictions") as work:
        rows = written(drop_copies(align(with_event_date(scored), PREDICTION_TABLE_SCHEMA)), f"{work}/rows")
        stored = table_or_none(spark, path)
        if stored is not None:
            dates = [r[0] for r in rows.select(PARTITION).distinct().collect()]  # one row a date
            there = stored.filter(incremental.on_dates(dates)).select(*[F.col(c).alias(f"_{c}") for c in ("machine_id", "timestamp", "anomaly_score")])
            same = [rows[c].eqNullSafe(there[f"_{c}"]) for c in ("machine_id", "timestamp", "anomaly_score")]
            rows = written(rows.join(there, same[0] & same[1] & same[2], "left_anti"), f"{work}/new")
        write_table(rows, path)


def score_and_land(spark: SparkSession, root: str, forest: Forest, missing: str = "zero") -> DataFrame:
    """Score the stored readings, land them as predictions and give the predictions table."""
    land_predictions(score_readings(read_table(spark, f"{root}/{RAW}"), forest, missing), root)
    return read_table(spark, f"{root}/{PREDICTIONS}")
