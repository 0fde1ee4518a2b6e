"""Streaming queries: the given tables as file streams, worked off and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.operators import cleaning as C
from wxrisk.operators import scoring, views
from wxrisk.operators import models as MO
from wxrisk.plans import daily_queries as D
from wxrisk.plans import model_queries as MQ
from wxrisk.plans import observation_queries as O
from wxrisk.plans import sql_inputs as Q
from wxrisk.plans.registry import query
from wxrisk.session import scratch_path
from wxrisk.sinks.tables import KeyedTable
from wxrisk.sources import fixtures as X
from wxrisk.sources import payloads as P
from wxrisk.streaming import model_scoring as MS
from wxrisk.streaming import pipeline as S


#: The events are dropped in so many parts by event_id, in this order.
DROPS = (2, 0, 1)


def message_rows(observations: DataFrame) -> DataFrame:
    return X.message_values(observations)


def work_off(spark: SparkSession, sf_dir: str, root: str, build, write, mode: str = "append") -> None:
    """The events as a stream of observations in several micro-batches, out of order.

    Each part of the events is dropped into the feed and the query is started again from its checkpoint, so state,
    tables and ids have to carry over from batch to batch.
    """
    events = X.read(spark, sf_dir, "events")
    feed = f"{root}/feed"
    for part in DROPS:
        events.where(F.coalesce(F.col("event_id") % len(DROPS), F.lit(0)) == part).write.mode("append").parquet(feed)
        rows = X.project(spark.readStream.schema(events.schema).parquet(feed), X.obs_columns())
        S.start(build(rows), write, f"{root}/checkpoint", seconds=None, mode=mode).awaitTermination()


@query(f"""with {Q.M}, b as (select *, coalesce("Precip", 0e0) as p from m), s as (select *,
    {Q.heat_score_linear('"MaxTemp_2m"')} as heatwave_probability, {Q.flood_score_linear('p', '"RH_2m"')} as flood_probability from b)
  select kafka_partition, kafka_offset, "District" as district, "MaxTemp_2m" as max_temp, heatwave_probability,
  flood_probability, {Q.label_above('heatwave_probability')} as heatwave_risk,
  {Q.label_above('flood_probability')} as flood_risk from s""",
       doubles="max_temp heatwave_probability flood_probability")
def stream_scored(spark, sf_dir):
    """Messages scored on arrival; observations and predictions go to two stores."""
    root = scratch_path(spark, "scored")
    stored = lambda name, part: (lambda batch, i: S.lake_sink(f"{root}/{name}")(part(batch), i))
    sinks = S.BatchWriters({"observations": stored("observations", S.observation_rows),
                            "predictions": stored("predictions", S.prediction_rows)})
    work_off(spark, sf_dir, root, lambda rows: S.scored_stream(message_rows(rows)), sinks)
    seen = spark.read.parquet(f"{root}/observations").select("id", "kafka_partition", "kafka_offset")
    scored = spark.read.parquet(f"{root}/predictions")
    return scored.join(seen, "id").select(
        "kafka_partition", "kafka_offset", "district", "max_temp", "heatwave_probability", "flood_probability",
        "heatwave_risk", "flood_risk",
    )


@query(f"with {Q.S} select {Q.SERVING}, 'kafka-spark-hdfs-1.0' as etl_version from s",
       doubles=Q.SERVING_DOUBLES + " heatwave_indicator flood_indicator", times="fetch_time")
def stream_dual_sink(spark, sf_dir):
    """Serving rows to the lake and to the keyed serving table; the answer is the serving table."""
    root = scratch_path(spark, "dual")
    table = KeyedTable(spark, f"{root}/serving", ["district", "fetch_time"], ["district"], ["fetch_time"], derived={"part_day": F.to_date("fetch_time")})
    sinks = S.BatchWriters({"lake": S.lake_sink(f"{root}/lake"), "serving": S.table_sink(table, ["etl_timestamp"])})
    work_off(spark, sf_dir, root, lambda rows: S.serving_stream(message_rows(rows)), sinks)
    return C.serving_view(table.read()).drop("etl_timestamp")


@query(O._COUNTER)
def stream_counter(spark, sf_dir):
    """Running count per day, district and hour, kept in a keyed table."""
    root = scratch_path(spark, "counter")
    table = KeyedTable(spark, f"{root}/counter", ["stat_date", "district", "hour"], ["stat_date"])
    work_off(spark, sf_dir, root, S.counter_stream, S.table_sink(table, ["record_count"]), "update")
    return table.read().select("stat_date", "district", "hour", "record_count")


@query(O._HOUR_STATS, doubles="avg_temp max_temp total_precip", times="hour_bucket")
def stream_hour_stats(spark, sf_dir):
    """Hourly statistics over event-time windows, kept in a keyed table."""
    root = scratch_path(spark, "hours")
    def build(rows: DataFrame) -> DataFrame:
        plain = rows.select(
            "district", "fetch_time", F.col("temp_max").alias("max_temp"),
            F.coalesce("rain_1h", F.lit(0.0)).alias("precipitation"), F.col("humidity").cast("double").alias("humidity"),
        )
        return S.hour_stats_stream(scoring.add_rule_scores(plain, "steps"), "fetch_time")

    table = KeyedTable(spark, f"{root}/hours", ["district", "hour_bucket"], ["district"], derived={"part_day": F.to_date("hour_bucket")})
    work_off(spark, sf_dir, root, build, S.table_sink(table, ["record_count"]), "update")
    return table.read()


@query(f"""with {Q.DAILY} select "District", count(*) as records, avg("MaxTemp_2m") as avg_temp, sum("Precip") as total_precip
  from daily group by 1""", doubles="avg_temp total_precip")
def stream_replay(spark, sf_dir):
    """History replayed as micro-batches; per-batch district sums, put together at the end."""
    root = scratch_path(spark, "replay")
    D.daily(spark, sf_dir).write.parquet(f"{root}/history")
    schema = spark.read.parquet(f"{root}/history").schema

    def summarise(batch: DataFrame, batch_id: int) -> None:
        S.lake_sink(f"{root}/summary")(views.batch_by_district(batch), batch_id)

    S.start(S.replay_stream(spark, f"{root}/history", schema, 2), S.BatchWriters({"summary": summarise}), f"{root}/checkpoint", seconds=None).awaitTermination()
    parts = spark.read.parquet(f"{root}/summary")
    return parts.groupBy("District").agg(
        F.sum("records").alias("records"),
        (F.sum(F.col("avg_temp") * F.col("records")) / F.sum("records")).alias("avg_temp"),
        F.sum("total_precip").alias("total_precip"),
    )


@query(f"""with {Q.OBS} select event_id, district, fetch_time, temp from obs order by fetch_time desc, event_id desc limit 50""",
       doubles="temp", times="fetch_time")
def stream_recent_buffer(spark, sf_dir):
    """Newest 50 rows over all micro-batches."""
    root = scratch_path(spark, "buffer")
    buffer = S.RecentBuffer(spark, f"{root}/buffer", 50, "fetch_time", "event_id")
    work_off(spark, sf_dir, root, lambda rows: rows.select("event_id", "district", "fetch_time", "temp"), buffer)
    return buffer.read(len(DROPS) - 1)


@query(f"""with {Q.OBS} select district as source_station, cast(count(*) as int) as records_count, 'ok' as status
  from obs group by 1, event_id % {len(DROPS)}""")
def stream_audit(spark, sf_dir):
    """One audit row per micro-batch and station, next to the lake write."""
    root = scratch_path(spark, "audit")
    sinks = S.BatchWriters({"lake": S.lake_sink(f"{root}/lake")}, audit=f"{root}/audit")
    work_off(spark, sf_dir, root, lambda rows: rows, sinks)
    return spark.read.parquet(f"{root}/audit").select("source_station", "records_count", "status")


@query(f"""with {Q.OBS}, p as (select event_id, district, date, temp,
    case when event_id % 5 <> 0 then temp_max end as high, humidity,
    coalesce(case when event_id % 4 <> 0 then rain_1h end, 0e0) as rain from obs)
  select event_id, district, date, case when temp between -50 and 60 then temp end as temp,
  case when humidity between 0 and 100 then humidity end as humidity, rain as rain_1h,
  case when high >= 40 then 3 when high >= 35 then 2 when high >= 32 then 1 else 0 end as heatwave_indicator,
  case when rain >= 50 then 3 when rain >= 20 then 2 when rain >= 5 then 1 else 0 end as flood_indicator from p""",
       doubles="temp rain_1h")
def stream_payload_drops(spark, sf_dir):
    """Payload files dropped into a folder: parsed, transformed and written batch by batch."""
    root = scratch_path(spark, "drops")
    payloads = X.payloads(X.obs(spark, sf_dir)).withColumns({"latitude": F.lit(26.5), "longitude": F.lit(85.5)})
    for part in DROPS:
        payloads.where(F.coalesce(F.col("event_id") % len(DROPS), F.lit(0)) == part).write.mode("append").json(f"{root}/drops")

    def rows(drops: DataFrame) -> DataFrame:
        raw = P.to_raw(drops, "city", "latitude", "longitude", "fetch_time", keep=("event_id",))
        return C.transform_batch(raw)

    stream = S.payload_stream(spark, f"{root}/drops", payloads.schema, rows, files_per_batch=2)
    S.start(stream, S.BatchWriters({"files": S.lake_sink(f"{root}/out")}), f"{root}/checkpoint", seconds=None).awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "event_id", "district", "date", "temp", "humidity", "rain_1h", "heatwave_indicator", "flood_indicator"
    )


@query(f"""with {Q.M}, b as (select *, coalesce("Precip", 0e0) as p from m)
  select event_id, "District" as district, case when event_id % {len(DROPS)} = {DROPS[0]} then 'rule' else 'model' end as source,
  case when event_id % {len(DROPS)} <> {DROPS[0]} then 1 end as model_version,
  case when event_id % {len(DROPS)} = {DROPS[0]} then {Q.heat_score_linear('"MaxTemp_2m"')} end as rule_probability,
  {Q.flood_score_linear('p', '"RH_2m"')} as flood_probability, true as in_range from b""", doubles="rule_probability flood_probability")
def stream_model_scored(spark, sf_dir):
    """Messages scored by rules until a trained model is stored below the watched folder, and by the model from the next batch on."""
    root = scratch_path(spark, "model-scored")
    versions = MS.ModelVersions(spark, f"{root}/models")
    scorer = MS.ScoreByNewestModel(versions, S.lake_sink(f"{root}/scored"))
    trained = MO.load(spark, MQ.trees(spark, sf_dir))

    def write(batch: DataFrame, batch_id: int) -> None:
        scorer(batch, batch_id)
        if batch_id == 0 and versions.newest() is None:
            versions.publish(*trained)

    work_off(spark, sf_dir, root, lambda rows: S.scored_stream(message_rows(rows)), write)
    scored = spark.read.parquet(f"{root}/scored")
    heat = F.col("heatwave_probability")
    return scored.select(
        (F.col("kafka_offset") * 4 + F.col("kafka_partition")).alias("event_id"), F.col("District").alias("district"), "source", "model_version",
        F.when(F.col("source") == "rule", heat).alias("rule_probability"), "flood_probability", heat.between(0, 1).alias("in_range"))
