"""Adapters that derive the library's input shapes from the given parquet tables.

Each adapter is a projection or one map-side-combined aggregate, so the work of
every query built on it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.constants import DISTRICTS
from wxrisk.session import file_system


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def district_of(key: str) -> Column:
    names = F.array(*[F.lit(n) for n in DISTRICTS])
    return F.get(names, (F.col(key) % len(DISTRICTS)).cast("int"))


def obs_columns() -> dict[str, Column]:
    """RAW-shaped columns over the ``events`` table."""
    e = F.col("event_id")
    celsius = F.col("value") / 4
    return {
        "event_id": e,
        "district": district_of("user_id"),
        "fetch_time": F.col("ts").cast("timestamp"),
        "date": F.date_format("ts", "yyyy-MM-dd"),
        "temp": celsius,
        "temp_min": celsius - 6,
        "temp_max": celsius + 2,
        "pressure": (e % 340 + 780).cast("int"),
        "humidity": (e % 120).cast("int"),
        "wind_speed": (e % 15 - 1).cast("double"),
        "clouds": (e % 101).cast("int"),
        "visibility": F.when(e % 7 != 0, 1000 * (e % 11)).cast("int"),
        "rain_1h": F.when(e % 10 != 0, (e * 7919 % 600) / F.lit(10.0)),
        "snow_1h": F.when(e % 3 == 0, F.lit(0.5)),
        "weather_main": F.col("event_type"),
    }


def project(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select([c.alias(n) for n, c in columns.items()])


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "events"), obs_columns())


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily history: one row per (District, Date), aggregated from ``lineitem``."""
    items = read(spark, sf_dir, "lineitem").select(
        district_of("l_suppkey").alias("District"),
        F.to_date("l_shipdate").alias("Date"),
        "l_quantity", "l_returnflag", "l_linenumber", "l_discount",
    )
    lines = F.count("*")
    season = F.abs(F.dayofyear("Date") - 182) / F.lit(12.0)
    return (
        items.groupBy("District", "Date")
        .agg(
            lines.alias("_lines"),
            F.avg("l_quantity").alias("_quantity"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("Precip"),
            F.sum("l_linenumber").alias("_numbers"),
            F.round(F.max("l_discount") * 100, 2).alias("WindSpeed_10m"),
        )
        .select(
            "District",
            "Date",
            F.round(F.lit(30.0) - season + F.col("_quantity") / 2, 4).alias("MaxTemp_2m"),
            (F.col("_lines") + 5).cast("double").alias("TempRange_2m"),
            "Precip",
            F.round(
                100 - 70 / F.when(F.col("_lines") > 1, F.col("_numbers") + 1).cast("double"), 4
            ).alias("RH_2m"),
            "WindSpeed_10m",
        )
        .withColumns({
            "MinTemp_2m": F.col("MaxTemp_2m") - F.col("TempRange_2m"),
            "WindSpeed_50m": F.col("WindSpeed_10m") * 1.5,
        })
    )


def message_values(obs_df: DataFrame, *, snake: bool = False) -> DataFrame:
    """Kafka-shaped rows (key, value, topic, partition, offset, timestamp) over ``obs``.

    Every fifth record lacks its optional fields, as producers may leave them out.
    """
    full = F.col("event_id") % 5 != 0
    names = (
        ("district", "date", "max_temp", "min_temp", "temp_range", "precipitation", "humidity",
         "wind_speed", "pressure", "cloudiness", "visibility", "weather_desc")
        if snake else
        ("District", "Date", "MaxTemp_2m", "MinTemp_2m", "TempRange_2m", "Precip", "RH_2m",
         "WindSpeed_10m", "Pressure", "Cloudiness", "Visibility", "WeatherDesc")
    )
    values = (
        F.col("district"), F.col("date"), F.col("temp_max"), F.col("temp_min"),
        F.col("temp_max") - F.col("temp_min"), F.col("rain_1h"), F.col("humidity").cast("double"),
        F.when(full, F.col("wind_speed")), F.when(full, F.col("pressure").cast("double")),
        F.when(full, F.col("clouds")), F.when(full, F.col("visibility").cast("double")),
        F.col("weather_main"),
    )
    body = F.struct(*[v.alias(n) for n, v in zip(names, values)])
    return obs_df.select(
        F.col("district").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.lit("weather-data").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("long").alias("offset"),
        F.col("fetch_time").alias("timestamp"),
        F.col("event_id"),
    )


def payloads(obs_df: DataFrame, *, kelvin: bool = False) -> DataFrame:
    """Current-weather REST payloads as JSON text over ``obs``.

    Covers the awkward cases: no rain object, rain with only "3h", an empty
    weather array, and no sys object.
    """
    e = F.col("event_id")
    shift = 273.15 if kelvin else 0.0
    rain = F.when(
        e % 10 != 0,
        F.struct(
            F.when(e % 4 != 0, F.col("rain_1h")).alias("1h"),
            F.col("rain_1h").alias("3h"),
        ),
    )
    sky = F.struct(F.col("weather_main").alias("main"), F.lower("weather_main").alias("description"))
    weather = F.when(e % 6 != 0, F.array(sky)).otherwise(F.filter(F.array(sky), lambda _: F.lit(False)))
    body = F.struct(
        F.concat(F.col("district"), F.lit(" station")).alias("name"),
        F.when(e % 9 != 0, F.struct(F.lit(26.5).alias("lat"), F.lit(85.5).alias("lon"))).alias("coord"),
        F.struct(
            (F.col("temp") + shift).alias("temp"),
            F.when(e % 5 != 0, F.col("temp_min") + shift).alias("temp_min"),
            F.when(e % 5 != 0, F.col("temp_max") + shift).alias("temp_max"),
            (F.col("temp") + shift).alias("feels_like"),
            F.when(e % 8 != 0, F.col("pressure")).alias("pressure"),
            F.col("humidity").alias("humidity"),
        ).alias("main"),
        F.struct(F.col("wind_speed").alias("speed"), (e % 360).cast("int").alias("deg")).alias("wind"),
        F.struct(F.col("clouds").alias("all")).alias("clouds"),
        F.col("visibility").alias("visibility"),
        rain.alias("rain"),
        weather.alias("weather"),
        F.when(
            e % 11 != 0,
            F.struct(
                (F.lit(1704067200) + e * 60).alias("sunrise"),
                (F.lit(1704100000) + e * 60).alias("sunset"),
            ),
        ).alias("sys"),
    )
    return obs_df.select(
        "event_id", F.col("district").alias("city"), "fetch_time", F.to_json(body).alias("payload")
    )


def station_folder(daily_df: DataFrame, root: str, key: str = "District") -> None:
    """CSV files named by the district, as station archives come; one file per task that wrote it."""
    parts = f"{root}.parts"
    daily_df.write.partitionBy(key).option("header", True).csv(parts)
    spark = daily_df.sparkSession
    files, target = file_system(spark, root)
    files.mkdirs(target)
    for i, entry in enumerate(files.globStatus(file_system(spark, f"{parts}/{key}=*/part-*")[1])):
        name = entry.getPath().getParent().getName().split("=", 1)[1]
        files.rename(entry.getPath(), file_system(spark, f"{root}/{name}.part{i}.csv")[1])
