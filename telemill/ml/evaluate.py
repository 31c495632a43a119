"""Model evaluation from (label, prediction, score) rows.

Labels and predictions are 0/1 with 1 = anomaly; a higher score is more anomalous.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.functions.numbers import ratio_or_zero
from telemill.operators.clean import STATS, beside
from telemill.operators.ordered import ROWS_PER_BUCKET, running_totals
from telemill.session import checkpointed


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    def cell(y: int, p: int):
        return F.count_if((F.col(label) == y) & (F.col(prediction) == p))

    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells, also the empty ones."""
    cells = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(name).alias("n"))
        for y, p, name in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    return confusion_counts(df, label, prediction).select(F.explode(cells).alias("c")).select("c.*")


def _prf(tp, fp, fn):
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return precision, recall, ratio_or_zero(2 * tp, 2 * tp + fp + fn)


def binary_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of the anomaly class, 0 on empty denominators."""
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return confusion_counts(df, label, prediction).select(
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1")
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class, accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    normal, anomaly = _prf(tn, fn, fp), _prf(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class_name"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.alias("support"),
        )

    accuracy = ratio_or_zero(tn + tp, total)
    missing = F.lit(None).cast("double")
    rows = F.array(
        row("Normal", *normal, n0),
        row("Anomaly", *anomaly, n1),
        row("accuracy", missing, missing, accuracy, total),
        row("macro avg", *[(a + b) / 2 for a, b in zip(normal, anomaly)], total),
        row("weighted avg", *[ratio_or_zero(a * n0 + b * n1, total) for a, b in zip(normal, anomaly)], total),
    )
    return confusion_counts(df, label, prediction).select(F.explode(rows).alias("r")).select("r.*")


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Counts per distinct score, ordered by ``_neg`` = -score.

    Kept in the shared folder, because the running totals read them several times.
    """
    counts = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy((-F.col(score)).alias("_neg"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return checkpointed(counts)


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Exact area under the ROC curve; 0.0 when only one class is present.

    Each negative counts the positives with a higher score, ties half.
    """
    ranked = running_totals(_by_score(df, label, score), ["pos"], ["_neg"], rows_per_bucket)
    won = F.sum(F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") / 2.0))
    area = F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg"))
    return ranked.agg(F.coalesce(area, F.lit(0.0)).alias("roc_auc"))


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, from the strictest down."""
    counts = _by_score(df, label, score)
    totals = F.col(STATS)
    ranked = running_totals(counts, ["pos", "neg"], ["_neg"], rows_per_bucket)
    return beside(ranked, counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).select(
        (-F.col("_neg")).alias("threshold"),
        ratio_or_zero(F.col("neg_before") + F.col("neg"), totals["n"]).alias("fpr"),
        ratio_or_zero(F.col("pos_before") + F.col("pos"), totals["p"]).alias("tpr"),
    )


def evaluate(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """One row: precision, recall, f1 and roc_auc."""
    auc = roc_auc(df, label, score).scalar()
    return binary_scores(df, label, prediction).select("*", auc.alias("roc_auc"))


def run_versions(runs: DataFrame) -> DataFrame:
    """Number the runs of each model by training time.

    A registry has one row per training run, so a model's runs fit one window.
    """
    order = Window.partitionBy("model_name").orderBy("trained_at")
    return runs.withColumn("version", F.row_number().over(order))
