"""Scores of a scorer: ranking metrics, curves and counts.

Ranking metrics first fold equal scores into one row with its positives and
negatives, then accumulate along the score in ranges, so the scored table is
never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.operators.running import RANGE_ROWS, running


def score_table(df: DataFrame, score: str, label: str, *, stage=None,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per distinct score: positives, negatives and both counts at this score or above (tp, fp)."""
    positive = F.col(label).cast("int")
    folded = df.select((-F.col(score)).alias("_down"), positive.alias("_y")).groupBy("_down").agg(
        F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg")
    )
    totals = {"tp": ("sum", "pos"), "fp": ("sum", "neg")}
    table = running(folded, [], "_down", totals, stage=stage, range_rows=range_rows)
    return table.select((-F.col("_down")).alias("threshold"), "pos", "neg", "tp", "fp")


def _ratio(a: Column, b: Column, empty: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(empty)


def ranking_metrics(scores: DataFrame) -> DataFrame:
    """Average precision (step sum) and area under the ROC curve, 0 when a class is missing."""
    p, n = F.sum("pos"), F.sum("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    below = F.col("fp") - F.col("neg")
    # A pair counts fully when the positive scores higher and half when both score the same.
    lost = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    zero = F.lit(0.0)
    return scores.agg(
        _ratio(F.sum(F.col("pos") * precision), p, zero).alias("average_precision"),
        F.when((p > 0) & (n > 0), 1 - _ratio(lost, p * n, zero)).otherwise(zero).alias("roc_auc"),
    )


def curve_points(scores: DataFrame) -> DataFrame:
    """Precision, recall, false and true positive rate at each distinct score."""
    sums = scores.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    p, n = sums.select("p").scalar(), sums.select("n").scalar()
    zero = F.lit(0.0)
    return scores.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _ratio(F.col("tp"), p, zero).alias("recall"),
        _ratio(F.col("fp"), n, zero).alias("fpr"),
        _ratio(F.col("tp"), p, zero).alias("tpr"),
    )


def threshold_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall and F1 at a threshold; 0 where a denominator is 0."""
    said, true = F.col(score) >= threshold, F.col(label).cast("int") == 1
    tp = F.count_if(said & true)
    fp, fn = F.count_if(said & ~true), F.count_if(~said & true)
    zero = F.lit(0.0)
    return df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn")).select(
        _ratio(F.col("tp"), F.col("tp") + F.col("fp"), zero).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn"), zero).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"), zero).alias("f1"),
    )


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Weight of a positive row: negatives per positive, at least 1."""
    pos = F.sum(F.col(label).cast("int"))
    return df.agg(
        F.greatest(F.lit(1.0), (F.count(label) - pos) / F.greatest(F.lit(1), pos)).alias("pos_weight")
    )


def scoring_summary(df: DataFrame, prediction: str = "prediction", actual: str | None = "actual") -> DataFrame:
    """Rows, positive and negative decisions and, where labels exist, the share that is right."""
    said = F.col(prediction)
    parts = [F.count("*").alias("total"), F.sum(said).alias("positives"),
             F.count_if(said == 0).alias("negatives")]
    if actual and actual in df.columns:
        parts.append(F.avg((said == F.col(actual)).cast("int")).alias("accuracy"))
    return df.agg(*parts)
