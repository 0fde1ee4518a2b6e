"""The batch load, the rebuild of the daily view from the lake, and the streaming loads."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wxrisk.operators import alerts, cleaning, views
from wxrisk.schemas import ALERTS, DAILY_SERVING, KEYS, SERVING_BATCH, SERVING_STREAM
from wxrisk.sinks.files import write_files
from wxrisk.sinks.tables import KeyedTable
from wxrisk.sources import files, messages
from wxrisk.streaming import pipeline


def serving_tables(spark: SparkSession, root: str, profile: str = "batch") -> dict[str, KeyedTable]:
    """The three serving tables of a profile below ``root``; partitioned by district and day (summaries: month)."""
    rows = SERVING_BATCH if profile == "batch" else SERVING_STREAM
    layout = {
        "weather_transformed": (rows, ["district"], ["fetch_time"], {"part_day": F.to_date("fetch_time")}),
        "weather_daily_summary": (DAILY_SERVING, ["district"], ["date"], {"part_month": F.substring("date", 1, 7)}),
        "weather_alerts": (ALERTS, ["district", "date"], ["fetch_time"], None),
    }
    return {
        name: KeyedTable(spark, f"{root}/{name}", KEYS[name], partition, order, schema, derived)
        for name, (schema, partition, order, derived) in layout.items()
    }


def to_schema(df: DataFrame, table: KeyedTable) -> DataFrame:
    """The table's columns in its order and types; a column the rows lack is NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields
    ])


@dataclass(frozen=True)
class LoadReport:
    extracted: int
    transformed: int
    daily_summaries: int
    alerts: int


def load(spark: SparkSession, raw: DataFrame, out: str, tables: dict[str, KeyedTable], token: str) -> LoadReport:
    """RAW observations to files and serving tables.

    The transformed rows are written once; the views are made from that table.
    The counts are observed while writing, no extra pass is made for them.
    """
    counts = {name: Observation(name) for name in ("extracted", "transformed", "daily", "alerts")}

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.observe(counts[name], F.count(F.lit(1)).alias("rows"))

    write_files(counted(raw, "extracted"), f"{out}/raw")
    extracted = spark.read.schema(raw.schema).parquet(f"{out}/raw")
    write_files(counted(cleaning.transform_batch(extracted), "transformed"), f"{out}/transformed")
    rows = spark.read.parquet(f"{out}/transformed")
    daily = views.daily_view(rows).withColumn("etl_timestamp", F.current_timestamp())
    write_files(counted(daily, "daily"), f"{out}/daily_summary")
    write_files(counted(alerts.risk_alerts(rows), "alerts"), f"{out}/alerts")
    parts = {
        "weather_transformed": (cleaning.serving_view(rows), ["etl_timestamp"]),
        "weather_daily_summary": (spark.read.parquet(f"{out}/daily_summary"), ["etl_timestamp"]),
        "weather_alerts": (spark.read.parquet(f"{out}/alerts"), ["fetch_time"]),
    }
    for name, (df, version) in parts.items():
        tables[name].upsert(to_schema(df, tables[name]), version, token)
    seen = {name: observation.get["rows"] for name, observation in counts.items()}
    return LoadReport(seen["extracted"], seen["transformed"], seen["daily"], seen["alerts"])


def rebuild_daily(spark: SparkSession, lake: str, out: str, table: KeyedTable | None = None,
                  token: str | None = None) -> DataFrame:
    """The daily view recomputed from all lake batches; overwrites ``out`` and updates the serving table."""
    daily = views.daily_recompute(files.read_lake(spark, lake))
    write_files(daily.withColumn("etl_timestamp", F.current_timestamp()), out)
    stored = spark.read.parquet(out)
    if table is not None:
        serving = views.daily_serving(stored).withColumn("etl_timestamp", F.current_timestamp())
        table.upsert(to_schema(serving, table), ["etl_timestamp"], token or f"rebuild-{uuid.uuid4().hex}")
    return stored


def start_message_load(spark: SparkSession, servers: str, topic: str, root: str, *, seconds: int = 10,
                       checkpoint: str | None = None) -> StreamingQuery:
    """Messages to the lake and the serving table (needs the Kafka connector's jar)."""
    return start_load(spark, messages.kafka_stream(spark, servers, topic), root, seconds=seconds, checkpoint=checkpoint)


def start_load(spark: SparkSession, source: DataFrame, root: str, *, seconds: int | None = 10,
               checkpoint: str | None = None) -> StreamingQuery:
    """Message rows from any source to the lake (all batches) and the serving table (newest per key)."""
    table = serving_tables(spark, f"{root}/serving", "stream")["weather_transformed"]
    writers = pipeline.BatchWriters(
        {"lake": pipeline.lake_sink(f"{root}/lake"), "serving": pipeline.table_sink(table, ["etl_timestamp"])},
        audit=f"{root}/ingest_log",
    )
    where = pipeline.checkpoint_location(spark, checkpoint, f"{root}/checkpoint")
    return pipeline.start(pipeline.serving_stream(source), writers, where, seconds=seconds)


def start_payload_load(spark: SparkSession, drops: str, root: str, to_raw, *, seconds: int | None = 60) -> StreamingQuery:
    """Payload files dropped into a folder to the serving table and one folder of rows per batch."""
    table = serving_tables(spark, f"{root}/serving")["weather_transformed"]
    writers = pipeline.BatchWriters({
        "files": pipeline.lake_sink(f"{root}/batches"),
        "serving": pipeline.table_sink(table, ["etl_timestamp"], lambda df: to_schema(df, table)),
    })
    schema = "city string, fetch_time timestamp, latitude double, longitude double, payload string"
    stream = pipeline.payload_stream(spark, drops, schema, lambda df: cleaning.transform_batch(to_raw(df)))
    return pipeline.start(stream, writers, f"{root}/checkpoint", seconds=seconds)
