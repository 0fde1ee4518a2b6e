"""Ranking figures from counted scores: histograms that tasks count where the scores are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bins of a score between 0 and 1; scores in one bin count as equal.
BINS = 1 << 14
COUNTS = "round int, bin int, pos long, neg long"


def counted(scores: np.ndarray, labels: np.ndarray, bins: int = BINS) -> pa.RecordBatch:
    """(round, bin, pos, neg) of a matrix of scores, a row per example and a column per round."""
    rows, rounds = scores.shape
    place = np.minimum((np.nan_to_num(scores) * bins).astype(np.int64), bins - 1)
    keys, inverse = np.unique(place + np.arange(rounds) * bins, return_inverse=True)
    held = np.bincount(inverse.ravel(), minlength=len(keys)).astype(np.int64)
    pos = np.bincount(inverse.ravel(), np.repeat(labels, rounds), len(keys)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array((keys // bins).astype(np.int32)), pa.array((keys % bins).astype(np.int32)), pa.array(pos), pa.array(held - pos)], ["round", "bin", "pos", "neg"])


def ranking_by_round(counts: DataFrame) -> DataFrame:
    """(round, pos, neg, average_precision, roc_auc) from rows of ``COUNTS``; figures are 0 where a class is missing.

    A round is at most one row per bin, whatever the number of scores.
    """
    summed = counts.groupBy("round", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    down = W.partitionBy("round").orderBy(F.desc("bin"))
    told = summed.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down)})
    precision = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    lost = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2))
    p, n = F.sum("pos"), F.sum("neg")
    return told.groupBy("round").agg(
        p.alias("pos"), n.alias("neg"), F.when(p > 0, precision / p).otherwise(0.0).alias("average_precision"),
        F.when((p > 0) & (n > 0), 1 - lost / (p * n)).otherwise(0.0).alias("roc_auc"))
