"""Micro-batch queries: decode, transform or score, and write replay-safe sinks."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wxrisk.functions.scalar import stable_id
from wxrisk.operators import scoring, views
from wxrisk.operators.cleaning import transform_stream
from wxrisk.session import file_system
from wxrisk.sinks.files import write_lake_batch
from wxrisk.sinks.tables import KeyedTable, committed, write_with_fallback
from wxrisk.sources import messages as M

BatchWriter = Callable[[DataFrame, int], None]


def start(stream: DataFrame, write: BatchWriter, checkpoint: str, *, seconds: int | None = 10,
          mode: str = "append", name: str | None = None) -> StreamingQuery:
    """Runs ``write`` per micro-batch; ``seconds=None`` works off what is there and stops."""
    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def checkpoint_location(spark: SparkSession, preferred: str | None, fallback: str) -> str:
    """``preferred`` if its file system answers, else ``fallback``."""
    if preferred:
        try:
            files, path = file_system(spark, preferred)
            if files.exists(path) or files.mkdirs(path):
                return preferred
        except Exception:  # file system unknown or unreachable
            pass
    return fallback


class BatchWriters:
    """Several sinks for one micro-batch.

    The batch is computed once and kept while the sinks read it; an empty batch
    is skipped. A failing sink does not keep the others from writing. It is
    tried in its fallback folder and, failing that too, the batch fails after
    the other sinks are done, so that the query repeats it.
    """

    def __init__(self, sinks: dict[str, BatchWriter], fallback: str | None = None,
                 audit: str | None = None, station: str = "district"):
        self.sinks, self.fallback, self.audit, self.station = sinks, fallback, audit, station

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            failures, begin = [], time.monotonic()
            for name, sink in self.sinks.items():
                try:
                    if self.fallback:
                        where = f"{self.fallback}/{name}/batch_id={batch_id}"
                        write_with_fallback(batch, lambda df, s=sink: s(df, batch_id), where)
                    else:
                        sink(batch, batch_id)
                except Exception as error:  # reported once the other sinks are done
                    failures.append((name, error))
            if self.audit:
                spent = int((time.monotonic() - begin) * 1000)
                self._log(batch, batch_id, "error" if failures else "ok", spent)
            if failures:
                raise RuntimeError(f"sinks failed: {[n for n, _ in failures]}") from failures[0][1]
        finally:
            batch.unpersist()

    def _log(self, batch: DataFrame, batch_id: int, status: str, spent: int) -> None:
        rows = views.ingest_log(batch, F.lit(batch_id), F.current_timestamp(), self.station)
        rows = rows.withColumnsRenamed({"batch_id": "batch"}).withColumns({
            "status": F.lit(status), "duration_ms": F.lit(spent),
        })
        write_lake_batch(rows, self.audit, batch_id)


def lake_sink(root: str) -> BatchWriter:
    return lambda batch, batch_id: write_lake_batch(batch, root, batch_id) and None


def table_sink(table: KeyedTable, version: list[str],
               prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    return lambda batch, batch_id: table.upsert(prepare(batch), version, f"batch-{batch_id}")


def serving_stream(messages: DataFrame, *, both_spellings: bool = True) -> DataFrame:
    """Messages to the serving rows of the stream profile."""
    decoded = M.decode_any(messages) if both_spellings else M.decode(messages)
    return transform_stream(decoded)


def scored_stream(messages: DataFrame, rules: str = "linear", keep=()) -> DataFrame:
    """Messages with their position, scores and labels; no shuffle."""
    placed = messages.withColumns({
        "kafka_partition": F.col("partition").cast("int"), "kafka_offset": F.col("offset").cast("long"),
    })
    decoded = M.decode_any(placed, ("kafka_partition", "kafka_offset", *keep))
    return scoring.add_rule_scores(decoded, rules)


POSITION_KEY = ("kafka_partition", "kafka_offset")


def observation_rows(scored: DataFrame) -> DataFrame:
    """The stored observation part of a scored record; its id is its place in the topic."""
    return scored.select(
        stable_id(*(F.col(c).cast("string") for c in POSITION_KEY)).alias("id"),
        F.col("District").alias("district"), F.col("Date").alias("date"),
        F.col("kafka_timestamp").alias("ingestion_time"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"),
        F.col("MaxTemp_2m").alias("max_temp"), F.col("MinTemp_2m").alias("min_temp"),
        F.col("TempRange_2m").alias("temp_range"), F.col("Precip").alias("precipitation"),
        F.col("RH_2m").alias("humidity"), F.col("WindSpeed_10m").alias("wind_speed_10m"),
        F.col("WindSpeed_50m").alias("wind_speed_50m"), *POSITION_KEY,
    )


def prediction_rows(scored: DataFrame) -> DataFrame:
    return scoring.prediction_rows(scored, F.col("kafka_timestamp"), *POSITION_KEY)


def counter_stream(rows: DataFrame, time: str = "fetch_time") -> DataFrame:
    """Running record count per (day, district, hour), for update mode.

    There is no watermark: every record counts, however late. The state has one
    row per district and hour, as many as the table it keeps.
    """
    hour = F.window(time, "1 hour")
    counted = rows.groupBy(hour.alias("w"), "district").agg(
        F.count("*").alias("record_count")
    )
    start_time = F.col("w.start")
    return counted.select(
        F.date_format(start_time, "yyyy-MM-dd").alias("stat_date"), "district",
        F.hour(start_time).alias("hour"), "record_count",
    )


def hour_stats_stream(scored: DataFrame, time: str) -> DataFrame:
    """Hourly statistics with alert counts per event-time hour; late records count as well."""
    stats = views.hour_stats(scored, F.window(time, "1 hour"))
    return stats.withColumn("hour_bucket", F.col("hour_bucket.start"))


class RecentBuffer:
    """Keeps the newest ``size`` rows over all batches as a small table of its own.

    Each batch contributes at most its own newest ``size`` rows. Two folders take turns: a batch reads what
    the one before it left and writes the other, so a repeated batch gives the same buffer, and nothing is searched for or
    piles up. Every batch of a query must pass through, empty ones too.
    """

    def __init__(self, spark: SparkSession, root: str, size: int, *order: str):
        self.spark, self.root, self.size, self.order = spark, root.rstrip("/"), size, order

    def _top(self, df: DataFrame) -> DataFrame:
        return df.orderBy(*[F.desc(c) for c in self.order]).limit(self.size)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fresh, earlier = self._top(batch), self._folder(batch_id - 1)
        if committed(self.spark, earlier):
            fresh = self._top(fresh.unionByName(self.spark.read.schema(batch.schema).parquet(earlier)))
        fresh.write.mode("overwrite").parquet(self._folder(batch_id))

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/turn={batch_id % 2}"

    def read(self, batch_id: int) -> DataFrame:
        """The buffer after the newest batch."""
        return self.spark.read.parquet(self._folder(batch_id))


def replay_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1,
                  kind: str = "parquet") -> DataFrame:
    """A stored history as a stream: so many files per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(folder)


def payload_stream(spark: SparkSession, folder: str, schema, to_rows: Callable[[DataFrame], DataFrame],
                   files_per_batch: int = 100) -> DataFrame:
    """Payload files dropped into a folder, as transformed observation rows."""
    return to_rows(replay_stream(spark, folder, schema, files_per_batch, "json"))
