"""The corpus pipeline: toxic texts go, one text of each near-duplicate group stays, texts with
benchmark passages go, personal data is replaced, and what is left is packed into sequences.

Each stage gets the rows its predecessor kept and returns the columns of documents, the last one
the packed pieces. Rows with null or empty texts pass all stages (they are neither toxic nor
copies of one another). Decisions are tied to a row by its id and its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.llm import decontam, jaccard, packing, pii, toxicity
from telemill.llm.common import packed, remainder, table
from telemill.session import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts at or above the threshold go; labels of three of four ids teach the model."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda doc_id: remainder(doc_id, 4) != 2)
    return docs.filter(toxicity.probability(docs, model)("text") < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).filter(F.size("spans") > 0)
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("fp").alias("bad_text")).distinct()
    own = packed(docs)
    same = own["id"].eqNullSafe(bad["bad_id"]) & (own["text"] == bad["bad_text"])
    return own.join(bad, same, "left_anti").select("document.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = docs.withColumn("text", pii.redact(pii.fit(docs))("text"))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]
# The learned stages have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
