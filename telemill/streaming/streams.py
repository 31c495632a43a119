"""Event streams: ingestion, windowed rates, scoring, alerts and the interval join.

Every stream runs from a checkpoint folder and can be restarted; the functions
that write in ``foreachBatch`` leave the same rows when a batch is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from telemill.functions.numbers import ratio
from telemill.ml.forest import Forest
from telemill.ml.scoring import score_readings
from telemill.operators.intervaljoin import SECOND, TOLERANCE_S
from telemill.operators.ordered import micros
from telemill.plans.ingest import load_lines
from telemill.sources.schema import EVENT_SCHEMA, SENSORS
from telemill.sources.tables import decode_events, split_corrupt, with_event_date

LATENESS = "10 minutes"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- sources ------------------------------------------------------------------

def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines from a folder that files keep arriving in."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The same lines from a Kafka topic, where the connector is installed."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def event_stream(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA, lateness: str = LATENESS) -> DataFrame:
    """Decoded good events with a watermark on their timestamp."""
    good, _ = split_corrupt(decode_events(lines, schema))
    return good.withWatermark("timestamp", lateness)


# --- sinks --------------------------------------------------------------------

def _start(writer, available_now: bool, interval: str) -> StreamingQuery:
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def to_table(
    df: DataFrame, path: str, checkpoint: str, partition: str | None = None, available_now: bool = True,
    interval: str = "1 minute", state_partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream's finished rows to a Parquet table, exactly once.

    ``state_partitions`` is fixed with the first start; the session's shuffle
    partitions apply when it is not given.
    """
    conf = df.sparkSession.conf
    if not df.sparkSession.sparkContext.master.startswith("local"):
        conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)  # state beyond the heap
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    # A started query keeps its own copy of the settings.
    usual = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions or usual))
    try:
        return _start(writer.partitionBy(partition) if partition else writer, available_now, interval)
    finally:
        conf.set("spark.sql.shuffle.partitions", usual)


def each_batch(df: DataFrame, work, checkpoint: str, available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    return _start(df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint), available_now, interval)


def ingest(lines: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Land a stream of JSON lines in the raw table, each event id once.

    Copies inside a batch collapse on the map side; ids stored earlier are found
    by the index beside the table. That also covers a repeated batch.
    """
    return each_batch(lines, lambda batch, _: load_lines(batch, root), checkpoint, **trigger)


def score_stream(
    events: DataFrame, forest: Forest, path: str, checkpoint: str, missing: str = "zero", **trigger
) -> StreamingQuery:
    """Score each micro-batch; confidence is relative to the micro-batch.

    Rows are filed under the batch number, so a repeated batch replaces itself.
    """
    def work(batch: DataFrame, number: int) -> None:
        scored = with_event_date(score_readings(batch, forest, missing)).withColumn("stream_batch", F.lit(number))
        scored.hint("rebalance", "event_date").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("stream_batch", "event_date").parquet(path)

    return each_batch(events, work, checkpoint, **trigger)


# --- windowed operators ---------------------------------------------------------
# They take watermarked streams, or tables, of predictions.

def _anomalies() -> Column:
    return F.count_if(F.col("is_anomaly"))


def tumbling_counts(predictions: DataFrame, width: str = "1 hour", by_machine: bool = True) -> DataFrame:
    keys = [F.window("timestamp", width).alias("w"), *([F.col("machine_id")] if by_machine else [])]
    counted = predictions.groupBy(*keys).agg(F.count("*").alias("total_events"), _anomalies().alias("anomaly_count"))
    return counted.select(
        F.col("w.start").alias("window_start"), *(["machine_id"] if by_machine else []), "total_events", "anomaly_count"
    )


def rolling_rate(predictions: DataFrame, width: str = "1 hour", step: str = "1 minute") -> DataFrame:
    """Anomaly rate over overlapping windows, put together from counts per step.

    Only the few per-step rows are repeated over the windows, not the events.
    """
    steps = predictions.groupBy(F.window("timestamp", step).alias("m")).agg(F.count("*").alias("n"), _anomalies().alias("a"))
    return (
        steps.groupBy(F.window(F.window_time("m"), width, step).alias("w"))
        .agg(F.sum("n").alias("total_events"), F.sum("a").alias("anomaly_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_events", "anomaly_count",
                (ratio(F.col("anomaly_count"), F.col("total_events")) * 100).alias("anomaly_rate_pct"))
    )


def interval_join_stream(predictions: DataFrame, readings: DataFrame, tolerance_s: int = TOLERANCE_S, folded: bool = False) -> DataFrame:
    """Predictions with the readings near them, unmatched ones included.

    Both streams need watermarks. The time bucket in the key spreads one busy
    machine over all state partitions; a pair meets in the prediction's bucket.
    ``folded`` leaves the rows of a bucket together as lists, which ``unfolded``
    turns into the same rows: state and what is landed then grow with the
    streams, not with the pairs, but a bucket waits until the watermark has passed it.
    """
    if folded:
        return _met_buckets(predictions, readings, tolerance_s)
    tol, width = tolerance_s * SECOND, 2 * tolerance_s * SECOND
    left = predictions.withColumn("_bk", F.floor(micros(predictions, "timestamp") / width))
    us = micros(readings, "timestamp")
    reach = F.array_distinct(F.array(F.floor((us - tol) / width), F.floor((us + tol) / width)))
    right = readings.select(
        F.col("machine_id").alias("_rk"), F.col("timestamp").alias("reading_time"), *SENSORS, F.explode(reach).alias("_rbk")
    )
    gap = F.expr(f"INTERVAL {tolerance_s} SECONDS")
    near = (F.col("timestamp") >= F.col("reading_time") - gap) & (F.col("timestamp") <= F.col("reading_time") + gap)
    same = (F.col("machine_id") == F.col("_rk")) & (F.col("_bk") == F.col("_rbk"))
    joined = left.join(right, same & near, "leftOuter")
    return joined.select(
        "machine_id", F.col("timestamp").alias("prediction_time"), "is_anomaly", "anomaly_score", "confidence", *SENSORS
    )


def _met_buckets(predictions: DataFrame, readings: DataFrame, tolerance_s: int) -> DataFrame:
    """(machine_id, predictions, readings): the lists of a bucket; those of all readings within reach of it, if any."""
    gap, width = F.expr(f"INTERVAL {tolerance_s} SECONDS"), f"{2 * tolerance_s} seconds"
    # A reading reaches the two buckets whose ends lie a tolerance before those of its windows.
    around = F.window("timestamp", f"{4 * tolerance_s} seconds", width, f"{tolerance_s} seconds")
    left = (
        predictions.groupBy("machine_id", F.window("timestamp", width).alias("_w"))
        .agg(F.collect_list(F.struct("timestamp", "is_anomaly", "anomaly_score", "confidence")).alias("predictions"))
        .select("machine_id", "predictions", F.window_time("_w").alias("_end"), F.col("_w.end").alias("_bk"))
    )
    right = (
        readings.groupBy(F.col("machine_id").alias("_rk"), around.alias("_rw"))
        .agg(F.collect_list(F.struct("timestamp", *SENSORS)).alias("readings"))
        .select("_rk", "readings", F.window_time("_rw").alias("_rend"), (F.col("_rw.end") - gap).alias("_rbk"))
    )
    # The last two say the same as the one before, in the columns that carry the watermarks.
    same = (
        (F.col("machine_id") == F.col("_rk")) & (F.col("_bk") == F.col("_rbk"))
        & (F.col("_end") >= F.col("_rend") - gap) & (F.col("_end") <= F.col("_rend") - gap)
    )
    return left.join(right, same, "leftOuter").select("machine_id", "predictions", "readings")


def unfolded(buckets: DataFrame, tolerance_s: int = TOLERANCE_S) -> DataFrame:
    """The rows of the join from a table of its landed buckets."""
    def near(reading: Column) -> Column:  # by numbers: interval arithmetic on each candidate is slow
        return F.abs(F.unix_micros("_p.timestamp") - F.unix_micros(reading["timestamp"])) <= tolerance_s * SECOND

    each = buckets.select("machine_id", F.explode("predictions").alias("_p"), "readings")
    matched = each.select("machine_id", "_p", F.explode("readings").alias("_r")).filter(near(F.col("_r")))
    alone = each.filter(F.col("readings").isNull() | ~F.exists("readings", near))
    columns = ["machine_id", F.col("_p.timestamp").alias("prediction_time"), "_p.is_anomaly", "_p.anomaly_score", "_p.confidence"]
    return matched.select(*columns, *[f"_r.{c}" for c in SENSORS]).unionByName(
        alone.select(*columns, *[F.lit(None).cast("double").alias(c) for c in SENSORS])
    )
