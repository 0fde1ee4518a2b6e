"""Spark ML models: splits, boosted trees, sequence classifier, storage and choice of scorer."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.risk import decide
from wxrisk.operators.metrics import class_weight
from wxrisk.operators.sequences import scoring_sequences


def time_split(df: DataFrame, days: int = K.TEST_DAYS, date: str = "Date") -> tuple[DataFrame, DataFrame]:
    """(rows before, rows from) the day ``days`` before the last one."""
    cutoff = F.date_sub(df.agg(F.max(date)).scalar(), days)
    return df.filter(F.col(date) < cutoff), df.filter(F.col(date) >= cutoff)


def hash_bucket(*key: str) -> Column:
    """A number 0 to 99 from the row's key: the same row always falls on the same side."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def hash_split(df: DataFrame, *key: str, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """A reproducible split in place of a shuffled one."""
    bucket = hash_bucket(*key)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


def model_inputs(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in K.NOT_INPUTS]


def model_matrix(df: DataFrame, target: str, keep=("District", "Date")) -> tuple[DataFrame, list[str]]:
    """Rows with a known target, inputs as doubles with missing values marked, label as 0/1."""
    names = model_inputs(df)
    inputs = [F.coalesce(F.col(n).cast("double"), F.lit(K.MISSING_MARK)).alias(n) for n in names]
    rows = df.filter(F.col(target).isNotNull())
    kept = [c for c in keep if c in df.columns]
    return rows.select(*kept, *inputs, F.col(target).cast("int").alias("label")), names


@dataclass
class ModelCard:
    """What a stored model needs to be used again."""

    kind: str
    target: str
    inputs: list[str]
    timesteps: int | None = None
    parameters: dict = field(default_factory=dict)


def train_trees(train: DataFrame, inputs: list[str], *, valid: DataFrame | None = None, rounds: int = 100,
                weight: float | None = None, target: str = "heatwave", seed: int = 7) -> tuple[PipelineModel, ModelCard]:
    """Boosted trees on a 0/1 ``label`` column.

    With ``valid`` the training stops once more trees stop helping on those
    rows. Positive rows weigh ``weight``, by default the negatives per positive.
    """
    parameters = {"stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "maxIter": rounds, "seed": seed}
    rows = train.withColumn("_valid", F.lit(False))
    if valid is not None:
        rows = rows.unionByName(valid.withColumn("_valid", F.lit(True)))
        parameters |= {"validationIndicatorCol": "_valid", "validationTol": 0.0}
    if weight is None:
        weight = class_weight(train, "label").first()["pos_weight"]
    rows = rows.withColumn("_weight", F.when(F.col("label") == 1, float(weight)).otherwise(1.0))
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="_weight", **parameters)
    model = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), trees]).fit(rows)
    return model, ModelCard("trees", target, inputs, parameters=parameters | {"weight": weight})


def score(model: PipelineModel, df: DataFrame, name: str = "prediction_prob") -> DataFrame:
    """Adds the probability of class 1; the other model columns are dropped. Works on streams."""
    scored = model.transform(df)
    extra = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(*[c for c in extra if c != name])


def decided(scored: DataFrame, threshold: float = 0.5, prob: str = "prediction_prob") -> DataFrame:
    return scored.withColumn("prediction", decide(F.col(prob), threshold))


def evaluation_table(scored: DataFrame, prob: str = "prediction_prob") -> DataFrame:
    return scored.select("Date", "District", F.col("label").alias("y_true"), F.col(prob).alias("y_pred"))


def step_statistics(sequences: DataFrame, column: str = "sequence") -> DataFrame:
    """Mean and population deviation per input over all rows and steps, one row per input."""
    steps = sequences.select(F.explode(column).alias("_s")).select(F.posexplode("_s").alias("input", "v"))
    return steps.groupBy("input").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def standardise(sequences: DataFrame, statistics: DataFrame, column: str = "sequence") -> DataFrame:
    """Scales each input of each step. ``statistics`` has one row per input, so it is one small array."""
    packed = statistics.agg(F.sort_array(F.collect_list(F.struct("input", "mean", "std")))).scalar()
    rows = sequences.withColumn("_stats", packed)

    def scaled(step: Column) -> Column:
        return F.transform(F.arrays_zip(step.alias("v"), F.col("_stats").alias("s")), lambda z: (
            (z["v"] - z["s"]["mean"]) / F.when(z["s"]["std"] == 0, 1.0).otherwise(z["s"]["std"])
        ))

    return rows.withColumn(column, F.transform(column, scaled)).drop("_stats")


def flatten(sequences: DataFrame, column: str = "sequence") -> DataFrame:
    return sequences.withColumn("features", array_to_vector(F.flatten(column)))


def train_sequences(train: DataFrame, inputs: list[str], *, steps: int = K.TIMESTEPS, hidden: int = 64,
                    dense: int = 32, epochs: int = 20, target: str = "heatwave",
                    seed: int = 7) -> tuple[PipelineModel, ModelCard]:
    """A feed-forward classifier on flattened sequences with a 0/1 ``label`` column."""
    layers = [steps * len(inputs), hidden, dense, 2]
    network = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=layers, maxIter=epochs, blockSize=128, seed=seed
    )
    model = Pipeline(stages=[network]).fit(flatten(train))
    return model, ModelCard("sequence", target, inputs, steps, {"layers": layers, "epochs": epochs})


def save(spark: SparkSession, model: PipelineModel, card: ModelCard, path: str) -> None:
    """The model and its card below one folder."""
    model.write().overwrite().save(f"{path}/model")
    row = spark.createDataFrame([(json.dumps(asdict(card)),)], "card string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/card")


def read_card(spark: SparkSession, path: str) -> ModelCard:
    return ModelCard(**json.loads(spark.read.text(f"{path}/card").first()[0]))


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, ModelCard]:
    return PipelineModel.load(f"{path}/model"), read_card(spark, path)


def score_stored(spark: SparkSession, path: str, features: DataFrame) -> DataFrame:
    """Scores a feature table with a stored model of either kind, by what its card says."""
    model, card = load(spark, path)
    if card.kind == "sequence":
        rows = scoring_sequences(features, card.timesteps, inputs=card.inputs)
        if card.parameters.get("scaling"):
            statistics = spark.createDataFrame(card.parameters["scaling"], "input int, mean double, std double")
            rows = standardise(rows, statistics)
        return score(model, flatten(rows)).drop("features", "sequence")
    rows = features.select("Date", "District", *[
        F.coalesce(F.col(n).cast("double"), F.lit(K.MISSING_MARK)).alias(n) for n in card.inputs
    ])
    return score(model, rows).select("Date", "District", "prediction_prob")
