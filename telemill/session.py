"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

# Runtime settings every job of this library relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("telemill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may run without that setting; it then gets a
    temporary folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="telemill-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for a working table inside the shared folder."""
    return f"{shared_dir(spark)}/telemill/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a working table; only paths that ``scratch`` gave are taken."""
    if not path.startswith(f"{shared_dir(spark)}/telemill/"):
        raise ValueError(f"{path} is no working table")
    delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def working(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for working tables that are needed no longer than the block runs."""
    path = scratch(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


def written(df, path: str):
    """The rows, written to a working table and read back: later plans start from the files."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df, rows_per_part: int = 20_000, most_rows: int = 250_000):
    """A checkpointed copy for data that several jobs read.

    Data in fewer partitions than cores (one small file, say) is dealt out, as
    far as each partition still gets a fair number of rows. Partitions of more
    than ``most_rows`` are dealt out on any number of cores, so what one task
    reads or caches does not grow with the table.
    """
    df = checkpointed(df)
    parts = df.rdd.getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    rows, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    wanted = max(min(cores, rows // rows_per_part), -(-rows // most_rows))
    return checkpointed(df.repartition(wanted)) if (wanted > parts and parts < cores) or most > most_rows else df


def numbered(df):
    """Rows with ``_n`` from 0 without gaps, in stored order; ``df`` must be checkpointed."""
    placed = df.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    parts = placed.groupBy("_part").agg(F.count("*").alias("rows"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = checkpointed(parts.select("_part", (before - F.col("_first")).alias("_shift")))  # one row a partition
    return placed.join(F.broadcast(starts), "_part").withColumn("_n", F.col("_id") + F.col("_shift")).drop("_part", "_id", "_shift")
