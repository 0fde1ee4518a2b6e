"""Model training and scoring over the feature table.

Scores have no SQL form. Their rows have: keys, labels, the side of the split and the range of each score are checked
against SQL over the whole table. A model is trained once per session and table, and loaded by the other queries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.constants import STATION_INPUTS
from wxrisk.operators import models as MO
from wxrisk.operators import recurrent as RE
from wxrisk.operators import scoring, views
from wxrisk.plans import daily_queries as D
from wxrisk.plans import offline
from wxrisk.plans import sql_inputs as Q
from wxrisk.plans.registry import query
from wxrisk.session import file_system, shared_root

EPOCHS = RE.EPOCHS


def trained_once(spark: SparkSession, sf_dir: str, name: str, train: Callable[[str], DataFrame]) -> str:
    """The folder of a model; ``train`` fills it, with its figures as ``figures``, unless this session has done so."""
    root = f"{shared_root(spark)}/wxrisk-models/{spark.sparkContext.applicationId}/{hashlib.md5(sf_dir.encode()).hexdigest()}/{name}"
    files, done = file_system(spark, f"{root}/figures/_SUCCESS")
    if not files.exists(done):
        train(root).coalesce(1).write.mode("overwrite").parquet(f"{root}/figures")
    return root


def trees(spark: SparkSession, sf_dir: str) -> str:
    return trained_once(spark, sf_dir, "trees", lambda path: offline.train_trees(spark, D.feature_rows(spark, sf_dir)[0], path))


def network(spark: SparkSession, sf_dir: str) -> str:
    return trained_once(spark, sf_dir, "network", lambda path: offline.train_sequences(spark, D.feature_rows(spark, sf_dir)[0], path, epochs=EPOCHS))


def memory(spark: SparkSession, sf_dir: str) -> str:
    return trained_once(spark, sf_dir, "memory", lambda path: offline.train_epochs(spark, D.feature_rows(spark, sf_dir)[0], path))


@query()
def gbt_metrics(spark, sf_dir):
    """Trees trained on all but the last 365 days, up to 1,000 with a patience of 50; metrics on those days."""
    return spark.read.parquet(f"{trees(spark, sf_dir)}/figures")


@query()
def gbt_scores(spark, sf_dir):
    """Stored trees loaded and applied to the whole feature table, next to the known label."""
    return offline.predict(spark, trees(spark, sf_dir), D.feature_rows(spark, sf_dir)[0])


@query()
def gbt_evaluation(spark, sf_dir):
    """Date, district, true and predicted value of the held-out days."""
    model, _ = MO.load(spark, trees(spark, sf_dir))
    rows, _ = MO.model_matrix(D.feature_rows(spark, sf_dir)[0], "heatwave")
    return MO.evaluation_table(MO.score(model, MO.time_split(rows)[1]))


@query()
def mlp_sequence_metrics(spark, sf_dir):
    return spark.read.parquet(f"{network(spark, sf_dir)}/figures")


@query()
def mlp_sequence_scores(spark, sf_dir):
    return offline.predict(spark, network(spark, sf_dir), D.feature_rows(spark, sf_dir)[0])


@query()
def lstm_scores(spark, sf_dir):
    """The recurrent classifier's probability for each day from the fourteenth on, next to the known label."""
    return offline.predict(spark, memory(spark, sf_dir), D.feature_rows(spark, sf_dir)[0])


# --- what SQL can say about them --------------------------------------------------------------

_DD = '"District", "Date"'
_LABELLED = Q.LABELS + f""", l as (select {_DD}, cast(heatwave as int) as actual, row_number() over (partition by "District" order by "Date") as rn,
  cast(('0x' || substr(md5("District" || '|' || cast("Date" as varchar)), 1, 8))::bigint % 100 as int) < 80 as train,
  "Date" >= (select max("Date") from labelled) - 365 as held from labelled)"""


def _checked(scored: DataFrame) -> DataFrame:
    prob = F.col("prediction_prob")
    return scored.select(
        "District", "Date", "actual", prob.between(0, 1).alias("in_range"), (F.col("prediction") == (prob >= 0.5).cast("int")).alias("decided"))


@query(f"with {_LABELLED} select {_DD}, actual, true as in_range, true as decided from l", days="Date")
def gbt_scores_checked(spark, sf_dir):
    """Every day of the feature table is scored once, next to its own label."""
    return _checked(gbt_scores(spark, sf_dir))


@query(f"with {_LABELLED} select {_DD}, actual as y_true, true as in_range from l where held", days="Date")
def gbt_evaluation_checked(spark, sf_dir):
    """The evaluation holds exactly the last 365 days."""
    return gbt_evaluation(spark, sf_dir).select("District", "Date", "y_true", F.col("y_pred").between(0, 1).alias("in_range"))


@query(f"""with {_LABELLED} select 1000 as budget, 50 as patience, true as kept_in_budget, true as waited, count(*) > 0 as any_rows from l where held""")
def gbt_rounds(spark, sf_dir):
    """What early stopping tried and kept: the best prefix was followed by the whole patience, or the budget ended, or no held-out row is positive."""
    told = MO.read_card(spark, trees(spark, sf_dir)).parameters
    tried, kept, budget, patience = (told[k] for k in ("tried", "kept", "budget", "patience"))
    rows = gbt_evaluation(spark, sf_dir).agg((F.count("*") > 0).alias("any_rows"))
    return rows.select(F.lit(budget).alias("budget"), F.lit(patience).alias("patience"), F.lit(1 <= kept <= tried <= budget).alias("kept_in_budget"),
                       F.lit(not told["rankable"] or tried == budget or kept + patience <= tried).alias("waited"), "any_rows")


@query(f"with {_LABELLED} select {_DD}, actual, true as in_range, true as decided from l where rn >= 14", days="Date")
def mlp_sequence_scores_checked(spark, sf_dir):
    return _checked(mlp_sequence_scores(spark, sf_dir))


@query(f"with {_LABELLED} select {_DD}, actual, true as in_range, true as decided from l where rn >= 14", days="Date")
def lstm_scores_checked(spark, sf_dir):
    return _checked(lstm_scores(spark, sf_dir))


@query(f"""with {_LABELLED} select cast(e.range as int) as epoch, count(*) filter (where train) as train_rows, count(*) filter (where not train) as valid_rows,
  true as loss_known, true as auc_in_range from l, range(1, {EPOCHS + 1}) e where rn > 14 group by 1""")
def lstm_epochs(spark, sf_dir):
    """Rows and figures of every epoch: losses are finite and positive, the ranking lies between 0 and 1."""
    told = spark.read.parquet(f"{memory(spark, sf_dir)}/epochs")
    known = (F.col("train_loss") > 0) & (F.col("valid_loss") > 0) & (F.col("valid_loss") < 100)
    return told.select("epoch", "train_rows", "valid_rows", known.alias("loss_known"), F.col("valid_auc").between(0, 1).alias("auc_in_range"))


@query()
def station_scores(spark, sf_dir):
    """Seven raw-weather inputs: trees trained on the hot-day flag of the observations."""
    rows = D.daily(spark, sf_dir).select(
        "District", "Date", F.col("MaxTemp_2m").alias("max_temp"), F.col("MinTemp_2m").alias("min_temp"),
        F.col("Precip").alias("precipitation"), F.col("RH_2m").alias("humidity"),
        F.col("WindSpeed_10m").alias("wind_speed"), (F.col("MaxTemp_2m") > 40).cast("int").alias("label"),
    )
    inputs = scoring.station_inputs(rows)
    model, _ = MO.train_trees(inputs, list(STATION_INPUTS), rounds=5)
    return MO.score(model, inputs).select("District", "Date", "prediction_prob")


@query()
def replay_scores(spark, sf_dir):
    """Six replay inputs scored per batch, with the number of high-risk rows."""
    rows, inputs = scoring.replay_inputs(D.daily(spark, sf_dir))
    labelled = rows.withColumn("label", (F.col("Precip") > 100).cast("int"))
    model, _ = MO.train_trees(labelled, inputs, rounds=5, target="flood_proxy")
    return views.high_risk_counts(MO.score(model, labelled), ["District"], "prediction_prob")


@query()
def model_or_rule_scores(spark, sf_dir):
    """The model's probability where it gives one, the rule's elsewhere."""
    rows, inputs = scoring.replay_inputs(D.daily(spark, sf_dir))
    labelled = rows.withColumn("label", (F.col("Precip") > 100).cast("int"))
    model, _ = MO.train_trees(labelled, inputs, rounds=5, target="flood_proxy")
    both = scoring.add_rule_scores(MO.score(model, labelled), "linear")
    known = F.when(F.col("RH_2m") > 0, F.col("prediction_prob"))
    return both.select("District", "Date", scoring.fallback_score(known, F.col("flood_probability")).alias("prob"))


