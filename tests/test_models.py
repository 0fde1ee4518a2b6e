"""Models: splits, training, storage, scoring, and the pipeline from CSV to metrics."""

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wxrisk.operators import models, scoring, sequences
from wxrisk.plans import daily_queries, offline
from wxrisk.session import TableStages, scratch_path
from wxrisk.sinks.files import write_files
from wxrisk.sources import fixtures


@pytest.fixture(scope="module")
def table(spark, folder):
    return daily_queries.feature_rows(spark, folder)[0]


def test_time_split_is_by_the_last_day(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i),) for i in range(500)]
    train, test = models.time_split(spark.createDataFrame(days, "Date date"), 365)
    cutoff = days[-1][0] - dt.timedelta(days=365)
    assert train.agg(F.max("Date")).first()[0] < cutoff == test.agg(F.min("Date")).first()[0]
    assert train.count() + test.count() == 500


def test_hash_split_is_whole_and_repeats(spark, table):
    first, second = models.hash_split(table, "District", "Date")
    assert first.count() + second.count() == table.count()
    again = models.hash_split(table.repartition(3), "District", "Date")[0]
    assert first.select("District", "Date").exceptAll(again.select("District", "Date")).count() == 0
    assert 0.7 < first.count() / table.count() < 0.9


def test_trees_are_stored_and_chosen_by_their_card(spark, table):
    path = scratch_path(spark, "trees")
    result = offline.train_trees(spark, table, path, rounds=3).first()
    assert 0 <= result["average_precision"] <= 1 and 0 <= result["roc_auc"] <= 1
    scored = offline.predict(spark, path, table)
    assert scored.count() == table.count()
    row = scored.agg(F.min("prediction_prob"), F.max("prediction_prob"), F.count("actual")).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] == table.count()
    _, card = models.load(spark, path)
    assert card.kind == "trees" and card.inputs == models.model_inputs(table)


def test_sequence_model_scores_every_day_from_the_fourteenth(spark, table):
    path = scratch_path(spark, "sequence")
    inputs = ["Precip", "MaxTemp_2m", "TempRange_2m"]
    offline.train_sequences(spark, table, path, epochs=3, inputs=inputs)
    scored = offline.predict(spark, path, table)
    per_district = table.groupBy("District").count().collect()
    assert scored.count() == sum(max(0, r["count"] - 13) for r in per_district)


def test_scaling_is_by_population_deviation(spark):
    rows = [([[1.0, 5.0], [3.0, 5.0]],), ([[5.0, 5.0], [7.0, 5.0]],)]
    df = spark.createDataFrame(rows, "sequence array<array<double>>")
    statistics = models.step_statistics(df)
    got = sorted((r["input"], r["mean"], r["std"]) for r in statistics.collect())
    assert got == [(0, 4.0, pytest.approx(5 ** 0.5)), (1, 5.0, 0.0)]
    scaled = sorted(r["sequence"] for r in models.standardise(df, statistics).collect())
    assert scaled[0][0] == [pytest.approx(-3 / 5 ** 0.5), 0.0]
    flat = models.flatten(models.standardise(df, statistics)).select(vector_to_array("features")).first()[0]
    assert len(flat) == 4


def test_infinite_and_missing_inputs_become_zero(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(sequences.finite(F.col("x"))).collect()] == [0.0, 0.0, 0.0, 0.0, 2.0]


def test_rule_takes_over_where_the_model_is_silent(spark):
    df = spark.createDataFrame([(0.7, 0.1), (None, 0.2), (float("nan"), 0.3)], "m double, r double")
    assert [r[0] for r in df.select(scoring.fallback_score(F.col("m"), F.col("r"))).collect()] == [0.7, 0.2, 0.3]
    assert [r[0] for r in df.select(scoring.fallback_score(None, F.col("r"))).collect()] == [0.1, 0.2, 0.3]


def test_too_few_replay_inputs(spark):
    assert scoring.replay_inputs(spark.createDataFrame([(1.0, 2.0)], "Precip double, RH_2m double"))[1] == []


def test_whole_pipeline_from_csv(spark, folder):
    root = scratch_path(spark, "pipeline")
    write_files(fixtures.daily(spark, folder).toDF(*[f" {c}" for c in fixtures.daily(spark, folder).columns]), f"{root}/csv", "csv")
    metrics = offline.run(spark, f"{root}/csv", f"{root}/out", rounds=2).first()
    assert 0 <= metrics["f1"] <= 1
    features = spark.read.parquet(f"{root}/out/features")
    assert features.count() == fixtures.daily(spark, folder).count()
    assert features.filter("heatwave").count() == 12 and features.filter("flood_proxy").count() == 20


def test_block_length_does_not_change_the_features(spark, folder):
    rows = TableStages(spark)(fixtures.daily(spark, folder), "rows")
    stage = TableStages(spark)
    long, short = (offline.label_and_build(rows, stage=stage, block_rows=n) for n in (2048, 100))

    def rounded(df):
        return df.select(*[F.round(c, 8).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

    assert rounded(long).exceptAll(rounded(short)).count() == 0
