"""Scoring a stream with the newest stored model, and with the rules where there is none or it fails."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.operators import models, scoring
from wxrisk.session import file_system
from wxrisk.streaming.pipeline import POSITION_KEY, BatchWriter


class ModelVersions:
    """Models below one folder as ``v=1``, ``v=2`` ...; a version counts from when its card, written last, is complete."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def newest(self) -> int | None:
        files, pattern = file_system(self.spark, f"{self.root}/v=*/card/_SUCCESS")
        found = [int(re.search(r"/v=(\d+)/card", str(entry.getPath()))[1]) for entry in files.globStatus(pattern) or []]
        return max(found, default=None)

    def publish(self, model: PipelineModel, card: models.ModelCard) -> int:
        version = (self.newest() or 0) + 1
        models.save(self.spark, model, card, self.path(version))
        return version

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"


def with_model(ruled: DataFrame, model: PipelineModel, card: models.ModelCard, version: int) -> DataFrame:
    """Rule-scored records with the model's probability of its target in place of the rule's, where it gives one."""
    kept = [*POSITION_KEY, *[c for c in ("District", "kafka_timestamp", "heatwave_probability", "flood_probability") if c in ruled.columns]]
    features = scoring.record_features(ruled, F.col("kafka_timestamp"), keep=kept)
    missing = F.lit(K.MISSING_MARK)
    inputs = {n: F.coalesce(F.col(n).cast("double"), missing) if n in features.columns else missing for n in card.inputs}
    scored = models.score(model, features.withColumns(inputs)).select(*kept, "prediction_prob")
    name = "flood_probability" if card.target == "flood_proxy" else "heatwave_probability"
    given = F.col("prediction_prob").isNotNull() & ~F.isnan("prediction_prob")
    return scored.withColumns({
        "source": F.when(given, F.lit("model")).otherwise("rule"), "model_version": F.when(given, F.lit(version)),
        name: scoring.fallback_score(F.col("prediction_prob"), F.col(name))}).drop("prediction_prob")


def by_rules(ruled: DataFrame) -> DataFrame:
    """Rule-scored records in the layout of ``with_model``."""
    kept = [*POSITION_KEY, *[c for c in ("District", "kafka_timestamp", "heatwave_probability", "flood_probability") if c in ruled.columns]]
    return ruled.select(*kept, F.lit("rule").alias("source"), F.lit(None).cast("int").alias("model_version"))


class ScoreByNewestModel:
    """A batch writer over rule-scored records: ``sink`` gets them scored by the newest model that can be read and run.

    Versions are looked up at each batch, so a model that appears while the stream runs is used from the next batch on.
    A model that cannot be read, or that fails on a batch, is left out from then on (``broken``) and the next older one that
    was read before, or the rules, score the batch. The sink must replace what the same batch wrote before.
    """

    def __init__(self, versions: ModelVersions, sink: BatchWriter):
        self.versions, self.sink = versions, sink
        self.known: tuple[int, PipelineModel, models.ModelCard] | None = None
        self.broken: dict[int, str] = {}

    def _look_up(self) -> None:
        newest = self.versions.newest()
        if newest is None or newest in self.broken or (self.known and self.known[0] >= newest):
            return
        try:
            self.known = (newest, *models.load(self.versions.spark, self.versions.path(newest)))
        except Exception as error:  # whatever is wrong with the stored model, the stream goes on
            self.broken[newest] = str(error)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._look_up()
        if self.known:
            version, model, card = self.known
            try:
                self.sink(with_model(batch, model, card, version), batch_id)
                return
            except Exception as error:  # the model or the sink; the rules tell which
                self.sink(by_rules(batch), batch_id)
                self.broken[version], self.known = str(error), None
                return
        self.sink(by_rules(batch), batch_id)
