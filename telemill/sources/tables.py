"""Reading, writing, decoding and compacting event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.session import working, written
from telemill.sources.schema import EVENT_SCHEMA, PARTITION, nan_to_null


# --- scans ------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line. The header decides which of the schema's columns
    the file has, so a file that lacks some features is read without them. Files of one folder must
    share their header: reading fails where one differs, rather than taking columns by position."""
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema.fields}
    present = T.StructType([known.get(c, T.StructField(c, T.StringType(), True)) for c in header])
    return nan_to_null(spark.read.schema(present).option("header", True).option("enforceSchema", False).csv(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def decode_events(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """Decode JSON text into event columns plus ``_corrupt``.

    ``_corrupt`` holds the original text of lines that are not such an event.
    """
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType(), True)])
    decoded = F.from_json(F.col(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.select(decoded.alias("event")).select("event.*")


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, quarantined lines); the decoded input is read once per side."""
    good = decoded.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    bad = decoded.filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("line"))
    return good, bad


# Microseconds survive the round trip only with an explicit pattern.
_JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode_events(df: DataFrame, key: str = "machine_id") -> DataFrame:
    """Key/value rows for a message sink: the machine is the partitioning key."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns), _JSON_OPTIONS).alias("value"))


# --- sinks ------------------------------------------------------------------

def with_event_date(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Partition date: that of the timestamp, or today's when there is none."""
    if "timestamp" in df.columns:
        date = F.to_date("timestamp")
    else:
        date = F.current_date() if as_of is None else F.to_date(as_of)
    return df.withColumn(PARTITION, date)


def write_table(df: DataFrame, path: str, mode: str = "append", partition: str = PARTITION) -> None:
    """Write a date-partitioned table; ``overwrite`` replaces only the dates written.

    The rebalance hint gathers each date's rows into few files, and lets
    adaptive execution split a date that is too big for one task.
    """
    if partition not in df.columns:
        df = with_event_date(df)
    (
        df.hint("rebalance", partition)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_dated_folders(df: DataFrame, path: str, mode: str = "append", ts: str = "timestamp") -> None:
    """Snappy Parquet below year/month/day folders."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    for name, pattern in parts.items():
        df = df.withColumn(name, F.date_format(ts, pattern))
    (
        df.hint("rebalance", *parts)
        .write.mode(mode)
        .option("compression", "snappy")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_events_json(df: DataFrame, path: str, batch_size: int = 100, mode: str = "append") -> None:
    """JSON lines, at most ``batch_size`` events per file."""
    encode_events(df).select("value").write.mode(mode).option("maxRecordsPerFile", batch_size).text(path)


def write_events_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """The same events to a Kafka topic, where the connector is installed."""
    encode_events(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def require_rows(df: DataFrame, at_least: int = 1) -> DataFrame:
    """Fail unless the input has enough rows; reads no more than it must."""
    found = df.limit(at_least).count()
    if found < at_least:
        raise ValueError(f"expected at least {at_least} rows, found {found}")
    return df


# --- compaction -------------------------------------------------------------

def _string_rank(df: DataFrame, col: str, bits: int, total: int, sample_rows: int) -> Column:
    """Order-preserving bucket of a string column: how many sampled cut values are <= it."""
    fraction = min(1.0, sample_rows / max(total, 1))
    names = sorted(r[0] for r in df.select(col).sample(fraction, seed=7).dropna().collect())
    cuts = sorted({names[len(names) * i // (1 << bits)] for i in range(1, 1 << bits)}) if names else []
    rank = F.lit(0)
    for cut in cuts:
        rank = rank + F.when(F.col(col) >= cut, 1).otherwise(0)
    return rank


def _interleave(high: Column, low: Column, bits: int) -> Column:
    """Z-order key: the bits of both ranks, taken in turn."""
    key = F.lit(0)
    for i in range(bits):
        for source, shift in ((low, 0), (high, 1)):
            bit = F.shiftright(source, i).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, 2 * i + shift))
    return key


def compact(
    df: DataFrame, path: str, rows_per_file: int = 5_000_000, bits: int = 4,
    machine: str = "machine_id", ts: str = "timestamp", tie: str = "event_id", sample_rows: int = 20_000,
) -> None:
    """Rewrite a table clustered on (machine, time) within each date.

    Range partitioning on (date, z-key, time, id) is a total order, so a date or
    machine that holds most rows is cut over many files like any other.
    """
    from telemill.operators.ordered import micros

    day_us = 86_400_000_000
    if PARTITION not in df.columns:
        df = with_event_date(df)
    total = df.count()
    files = max(1, -(-total // rows_per_file))
    slot = F.floor((micros(df, ts) % day_us) * (1 << bits) / day_us).cast("int")
    z = _interleave(_string_rank(df, machine, bits, total, sample_rows), slot, bits)
    (
        df.withColumn("_z", z)
        .repartitionByRange(files, PARTITION, "_z", ts, tie)
        .sortWithinPartitions(PARTITION, "_z", machine, ts)
        .drop("_z")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def fragmented_dates(spark: SparkSession, path: str, rows_per_file: int = 5_000_000, slack: float = 2.0) -> list:
    """Dates with more than ``slack`` times the files that their rows need; read from the files' footers."""
    files = read_table(spark, path).groupBy(PARTITION, F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    dates = files.groupBy(PARTITION).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
    worn = dates.filter(F.col("files") > slack * F.ceil(F.col("rows") / rows_per_file))
    return [r[0] for r in worn.select(PARTITION).collect()]  # one value a date


def compact_in_place(
    spark: SparkSession, path: str, rows_per_file: int = 5_000_000, slack: float = 2.0,
    machine: str = "machine_id", ts: str = "timestamp", tie: str = "event_id",
) -> list:
    """Rewrite only the fragmented dates of a table, clustered on (machine, time); returns these dates.

    Their rows are copied to a working table first, so that the table is never read while it is
    overwritten; other dates keep their files.
    """
    dates = fragmented_dates(spark, path, rows_per_file, slack)
    if not dates:
        return []
    rows = read_table(spark, path)
    dated = [d for d in dates if d is not None]
    worn = F.col(PARTITION).isin(dated) | F.col(PARTITION).isNull() if None in dates else F.col(PARTITION).isin(dated)
    with working(spark, "compacted") as staged:
        again = written(rows.filter(worn), staged)
        files = max(1, -(-again.count() // rows_per_file))
        again = again.repartitionByRange(files, PARTITION, machine, ts, tie).sortWithinPartitions(PARTITION, machine, ts)
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)
    return dates
