"""Message decoding and the Kafka reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wxrisk.functions.scalar import parsed_once
from wxrisk.schemas import MESSAGE, MESSAGE_EXTRA

# snake-case field -> training vocabulary
SNAKE_TO_TRAINING = {
    "district": "District", "date": "Date", "max_temp": "MaxTemp_2m", "min_temp": "MinTemp_2m",
    "temp_range": "TempRange_2m", "precipitation": "Precip", "humidity": "RH_2m",
    "wind_speed": "WindSpeed_10m", "pressure": "Pressure", "cloudiness": "Cloudiness",
    "visibility": "Visibility", "weather_desc": "WeatherDesc", "sunrise": "Sunrise", "sunset": "Sunset",
}


def kafka_stream(spark: SparkSession, servers: str, topic: str, *, starting: str = "latest",
                 **options: str) -> DataFrame:
    """Streaming source; offsets lost on the broker side do not stop the query."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false")
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def decode(messages: DataFrame, schema: T.StructType = MESSAGE, keep=()) -> DataFrame:
    """Message value to flat columns plus the broker time as ``kafka_timestamp``.

    A field with the wrong type is NULL; text that is not JSON gives a row of NULLs.
    """
    body = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(parsed_once(body, "_d"), F.col("timestamp").alias("kafka_timestamp"), *keep).select(
        "_d.*", "kafka_timestamp", *keep
    )


def decode_positions(messages: DataFrame, schema: T.StructType = MESSAGE, keep=()) -> DataFrame:
    """``decode`` with each record's partition and offset."""
    placed = messages.withColumns({
        "kafka_partition": F.col("partition").cast("int"), "kafka_offset": F.col("offset").cast("long"),
    })
    return decode(placed, schema, ("kafka_partition", "kafka_offset", *keep))


def decode_fields(messages: DataFrame, keep=()) -> DataFrame:
    """Message value as ``fields``, a map of text: a missing field and a null one stay apart."""
    body = F.from_json(F.col("value").cast("string"), T.MapType(T.StringType(), T.StringType()))
    return messages.select(parsed_once(body, "fields"), F.col("timestamp").alias("kafka_timestamp"), *keep)


def decode_any(messages: DataFrame, keep=()) -> DataFrame:
    """Accepts both spellings on one topic and gives the training vocabulary.

    The value is parsed once, into a map; each field is taken under either name
    and cast, a text that does not fit its type gives NULL.
    """
    fields = {f.name: f.dataType for f in MESSAGE.fields + MESSAGE_EXTRA.fields}
    snake_of = {training: snake for snake, training in SNAKE_TO_TRAINING.items()}

    def field(name: str):
        found = [F.col("fields")[n] for n in (name, snake_of.get(name)) if n]
        return F.coalesce(*found).try_cast(fields[name]).alias(name)

    return decode_fields(messages, keep).select(*[field(n) for n in fields], "kafka_timestamp", *keep)
