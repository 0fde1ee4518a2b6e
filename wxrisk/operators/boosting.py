"""Boosted trees that stop when more of them no longer help on held-out rows.

The first trees of a longer boosting run are those of a shorter one, so one fitted ensemble holds all shorter
ones. Every prefix is scored in a single pass: each row's leaf in every tree is looked up and summed along the trees,
and the scores are counted in histograms per prefix, from which the average precision follows. The budget grows
until the best prefix has been followed by ``patience`` trees that are not better; that prefix is then cut out of the
ensemble and not fitted again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxrisk.operators import models
from wxrisk.operators.histograms import COUNTS, counted, ranking_by_round

ROUNDS = 1000
PATIENCE = 50
#: Rounds beyond the patience where no held-out positive can rank them.
FIRST = 14
#: The first ranked fit has so many times these rounds; each further one ``GROWTH`` times the last.
AHEAD, GROWTH = 2, 3


def leaf_values(model: GBTClassificationModel) -> np.ndarray:
    """The weighted value of each leaf, a row per tree, leaves from left to right as ``leafCol`` numbers them."""
    values = [[float(v) * weight for v in re.findall(r"Predict: (\S+)", tree.toDebugString)] for tree, weight in zip(model.trees, model.treeWeights, strict=True)]
    table = np.zeros((len(values), max(map(len, values), default=1)))
    for row, own in zip(table, values, strict=True):
        row[:len(own)] = own
    return table


def prefix_scores(leaves: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Probabilities of class 1 by the first 1, 2, ... trees: a row per example, a column per prefix."""
    margins = np.cumsum(values[np.arange(len(values)), leaves], axis=1)
    return 1 / (1 + np.exp(-2 * margins))


def prefix_ranking(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(round, pos, neg, average_precision, roc_auc) of each prefix on ``rows``, rounds from 1; one pass over the rows."""
    trees = model.stages[-1]
    shared = rows.sparkSession.sparkContext.broadcast(leaf_values(trees))
    before = PipelineModel(model.stages[:-1])
    leaves = trees.copy().setLeafCol("_leaf").transform(before.transform(rows)).select(vector_to_array("_leaf").alias("leaf"), F.col("label").cast("int").alias("label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                taken = batch.column(0).flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
                yield counted(prefix_scores(taken, shared.value), batch.column(1).to_numpy())

    return ranking_by_round(leaves.mapInArrow(count, COUNTS)).withColumn("round", F.col("round") + 1)


def first_trees(model: PipelineModel, count: int) -> PipelineModel:
    """The pipeline with the first ``count`` trees of its ensemble, as a fit of ``count`` rounds gives it."""
    whole = model.stages[-1]
    ml, java_array = SparkContext.getOrCreate()._jvm.org.apache.spark.ml, GBTClassificationModel._new_java_array
    trees = java_array([tree._java_obj for tree in whole.trees[:count]], ml.regression.DecisionTreeRegressionModel)
    weights = java_array([float(w) for w in whole.treeWeights[:count]], SparkContext.getOrCreate()._gateway.jvm.double)
    cut = whole._copyValues(GBTClassificationModel(ml.classification.GBTClassificationModel(whole.uid, trees, weights)))
    return PipelineModel([*model.stages[:-1], cut._set(maxIter=count)])


def stopping_round(precision: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(best round from 1, whether ``patience`` rounds after it brought nothing better)."""
    best = 0
    for k, value in enumerate(precision):
        if value > precision[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def train_until_no_better(train: DataFrame, valid: DataFrame, inputs: list[str], *, rounds: int = ROUNDS, patience: int = PATIENCE,
                          target: str = "heatwave", seed: int = 7) -> tuple[PipelineModel, models.ModelCard]:
    """Boosted trees on a 0/1 ``label``, as many as give the best average precision on ``valid``.

    At most ``rounds`` trees are tried. Without valid rows or positives among them the budget of the first fit stands.
    Each fit is of the same rows, so these should be a stored table. The card tells what was tried and kept.
    """
    rankable = bool(valid.agg(F.max("label")).first()[0])
    budget = min(rounds, (patience + FIRST) * (AHEAD if rankable else 1))
    while True:
        model, card = models.train_trees(train, inputs, rounds=budget, target=target, seed=seed)
        if not rankable:
            best = budget
            break
        ranked = prefix_ranking(model, valid).select("round", "average_precision").orderBy("round").collect()  # a row per round
        best, stopped = stopping_round([r["average_precision"] for r in ranked], patience)
        if stopped or budget == rounds:
            break
        budget = min(rounds, GROWTH * budget)
    if best < budget:
        model = first_trees(model, best)
        card.parameters["maxIter"] = best
    card.parameters |= {"tried": budget, "kept": best, "budget": rounds, "patience": patience, "rankable": rankable}
    return model, card
