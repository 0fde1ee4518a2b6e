"""The offline pipeline: daily history to labels, features, a trained model and its scores.

Each stage writes its table and the next one reads it, as one would run them as
separate jobs. Nothing is collected but a model's own parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.operators import boosting, features, labels, metrics, models, recurrent, sequences
from wxrisk.session import TableStages, scratch_block, unstaged
from wxrisk.sources.files import read_daily_csv


def ingest(spark: SparkSession, csv: str, out: str) -> DataFrame:
    """History CSV to the canonical parquet table."""
    read_daily_csv(spark, csv).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def label_and_build(df: DataFrame, *, fit_on: DataFrame | None = None, stage=unstaged,
                    block_rows: int = labels.BLOCK_ROWS) -> DataFrame:
    """Daily history to the feature table with labels, over one partitioning of the history.

    The rain sums of the labels count missing days as dry, those of the features
    skip them; only the latter are kept.
    """
    blocks = labels.flood_blocks(
        df, overlap=features.LOOK_BACK, block_rows=block_rows, stage=stage,
        more=lambda b: features.look_back(b, block_rows, rain="_rain"),
    )
    blocks = features.wetness_across(blocks, block_rows)
    labelled = labels.both_flags(blocks, fit_on=fit_on, stage=stage).drop("precip_3d", "precip_7d")
    labelled = labelled.withColumnsRenamed({"_rain_3d": "precip_3d", "_rain_7d": "precip_7d"})
    return features.keep_features(features.add_anomalies(features.add_season(labelled)))


def before_last_days(df: DataFrame, days: int = K.TEST_DAYS) -> DataFrame:
    return models.time_split(df, days)[0]


def train_trees(spark: SparkSession, table: DataFrame, out: str, *, target: str = "heatwave", rounds: int = boosting.ROUNDS,
                patience: int = boosting.PATIENCE, days: int = K.TEST_DAYS) -> DataFrame:
    """Trains on all but the last ``days`` days, stores the model, gives the metrics on those days.

    Up to ``rounds`` trees are tried until ``patience`` more of them bring no better average precision on those days.
    """
    stage = TableStages(spark, "trees")
    rows, inputs = models.model_matrix(table, target)
    train, test = models.time_split(stage(rows, "matrix"), days)
    model, card = boosting.train_until_no_better(train, test, inputs, rounds=rounds, patience=patience, target=target)
    models.save(spark, model, card, out)
    return evaluate(models.score(model, test), "label")


def sequence_rows(spark: SparkSession, table: DataFrame, target: str, steps: int, inputs: list[str]) -> tuple[DataFrame, DataFrame, list]:
    """(train, test, scaling): standardised sequences of a reproducible 80/20 split; scaling is fitted on the 80 only."""
    rows = sequences.training_sequences(table, target, steps, inputs=inputs)
    train, test = models.hash_split(rows, "District", "Date")
    # One row per input column: a model parameter, stored with the model.
    scaling = [(int(r["input"]), float(r["mean"]), float(r["std"])) for r in models.step_statistics(train).orderBy("input").collect()]
    fixed = spark.createDataFrame(scaling, "input int, mean double, std double")
    return models.standardise(train, fixed), models.standardise(test, fixed), scaling


def train_epochs(spark: SparkSession, table: DataFrame, out: str, *, target: str = "heatwave", steps: int = K.TIMESTEPS,
                 epochs: int = recurrent.EPOCHS, inputs: list[str] | None = None) -> DataFrame:
    """Trains the recurrent classifier, stores it, gives the table of its epochs."""
    inputs = inputs or sequences.sequence_inputs(table)
    train, test, scaling = sequence_rows(spark, table, target, steps, inputs)
    weights, card, told = recurrent.train_epochs(train, test, inputs, steps=steps, epochs=epochs, stage=TableStages(spark, "epochs"), target=target)
    card.parameters["scaling"] = scaling
    recurrent.save(spark, weights, card, out)
    told.coalesce(1).write.mode("overwrite").parquet(f"{out}/epochs")
    return spark.read.parquet(f"{out}/epochs")


def train_sequences(spark: SparkSession, table: DataFrame, out: str, *, target: str = "heatwave",
                    steps: int = K.TIMESTEPS, epochs: int = 20, inputs: list[str] | None = None) -> DataFrame:
    """Trains the sequence classifier on a reproducible 80/20 split; scaling is fitted on the 80 only."""
    inputs = inputs or sequences.sequence_inputs(table)
    train, test, scaling = sequence_rows(spark, table, target, steps, inputs)
    model, card = models.train_sequences(train, inputs, steps=steps, epochs=epochs, target=target)
    card.parameters["scaling"] = scaling
    models.save(spark, model, card, out)
    return evaluate(models.score(model, models.flatten(test)), "label")


def evaluate(scored: DataFrame, label_column: str, prob: str = "prediction_prob", *, stage=unstaged) -> DataFrame:
    """One row: average precision, ROC area, precision, recall, F1 at one half."""
    ranking = metrics.ranking_metrics(metrics.score_table(scored, prob, label_column, stage=stage))
    at_half = metrics.threshold_metrics(scored, prob, label_column)
    return ranking.select(
        "*", *[at_half.select(c).scalar().alias(c) for c in ("precision", "recall", "f1")]
    )


def score_stored(spark: SparkSession, model: str, table: DataFrame) -> DataFrame:
    """Scores a feature table with a stored model of any kind."""
    card = models.read_card(spark, model)
    if card.kind != "recurrent":
        return models.score_stored(spark, model, table)
    weights, card = recurrent.load(spark, model)
    rows = sequences.scoring_sequences(table, card.timesteps, inputs=card.inputs)
    fixed = spark.createDataFrame([tuple(x) for x in card.parameters["scaling"]], "input int, mean double, std double")
    return recurrent.scored(models.standardise(rows, fixed), weights, card)


def predict(spark: SparkSession, model: str, table: DataFrame, *, target: str = "heatwave",
            threshold: float = 0.5) -> DataFrame:
    """Scores with a stored model of either kind; the known label is joined on (District, Date)."""
    scored = models.decided(score_stored(spark, model, table), threshold)
    if target not in table.columns:
        return scored
    known = table.select("District", "Date", F.col(target).cast("int").alias("actual"))
    return scored.join(known, ["District", "Date"], "left")


def run(spark: SparkSession, csv: str, root: str, *, target: str = "heatwave", rounds: int = boosting.ROUNDS) -> DataFrame:
    """All stages from the CSV to the metrics, with their tables below ``root``."""
    history = ingest(spark, csv, f"{root}/weather")
    with scratch_block():
        labels.label_both(history, stage=TableStages(spark, "offline")).write.mode("overwrite").parquet(f"{root}/weather_labeled")
    features.build_features(spark.read.parquet(f"{root}/weather_labeled")).write.mode("overwrite").parquet(
        f"{root}/features"
    )
    return train_trees(spark, spark.read.parquet(f"{root}/features"), f"{root}/models/{target}",
                       target=target, rounds=rounds)
