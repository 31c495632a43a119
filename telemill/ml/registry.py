"""Model artifacts as tables: nodes per run, and one metadata row per run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.ml.evaluate import run_versions
from telemill.ml.forest import Forest, ForestParams

RUN_SCHEMA = (
    "model_name string, trained_at string, feature_columns array<string>, params map<string,string>, "
    "metrics map<string,double>, scaler map<string,double>, offset double, sample_size long"
)


def stamp(at: datetime | None = None) -> str:
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S")


def save(
    forest: Forest, path: str, metrics: dict | None = None, scaler: dict | None = None,
    model_name: str = "isolation_forest", trained_at: str | None = None,
) -> str:
    """Write nodes and metadata under ``trained_at``; saving the same run again replaces it.

    The metadata row goes last, so a run is only visible once its nodes are complete.
    """
    trained_at = trained_at or stamp()
    spark = forest.nodes.sparkSession
    p = forest.params
    params = {k: str(getattr(p, k)) for k in ("n_estimators", "max_samples", "max_features", "contamination", "seed")}
    row = (
        model_name, trained_at, list(forest.features), params, {k: float(v) for k, v in (metrics or {}).items()},
        {k: float(v) for k, v in (scaler or {}).items()}, float(forest.offset), int(forest.sample_size),
    )
    forest.nodes.withColumns({"model_name": F.lit(model_name), "trained_at": F.lit(trained_at)}).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("model_name", "trained_at").parquet(f"{path}/nodes")
    spark.createDataFrame([row], RUN_SCHEMA).withColumns({"name": F.col("model_name"), "run": F.col("trained_at")}).coalesce(
        1
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("name", "run").json(f"{path}/runs")
    return trained_at


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log with a version number per model."""
    return run_versions(spark.read.schema(RUN_SCHEMA).json(f"{path}/runs"))


def _setting(text: str):
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def load(spark: SparkSession, path: str, trained_at: str | None = None, model_name: str = "isolation_forest") -> Forest:
    """A stored model; the latest run when none is named."""
    log = spark.read.schema(RUN_SCHEMA).json(f"{path}/runs").filter(F.col("model_name") == model_name)
    if trained_at:
        log = log.filter(F.col("trained_at") == trained_at)
    row = log.orderBy(F.desc("trained_at")).first()
    if row is None:
        raise FileNotFoundError(f"no stored run of {model_name} in {path}")
    p = row["params"]
    params = ForestParams(
        int(p["n_estimators"]), _setting(p["max_samples"]), float(p["max_features"]), _setting(p["contamination"]), int(p["seed"])
    )
    nodes = (
        spark.read.option("basePath", f"{path}/nodes")
        .schema("tree_id int, node_id long, feature int, threshold double, size long, depth int, model_name string, trained_at string")
        .parquet(f"{path}/nodes")
        .filter((F.col("model_name") == model_name) & (F.col("trained_at") == row["trained_at"]))
        .drop("model_name", "trained_at")
    )
    forest = Forest(nodes, list(row["feature_columns"]), params, row["sample_size"], row["offset"])
    forest.extra = {"scaler": dict(row["scaler"] or {}), "metrics": dict(row["metrics"] or {}), "trained_at": row["trained_at"]}
    return forest
