"""Current-weather REST payloads (JSON text) to observations.

Three shapes are needed: the raw observation (metric units), the feed record
(Kelvin in, daily rain estimated) and the snake-case station record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.functions.scalar import or_else, parsed_once, short_time
from wxrisk.schemas import PAYLOAD

ZERO_CELSIUS_IN_KELVIN = 273.15


def parse(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds the payload as the struct column ``p``; each text is parsed once."""
    return df.select("*", parsed_once(F.from_json(payload, PAYLOAD), "p"))


def _or(value: str | Column, fallback) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value, fallback if isinstance(fallback, Column) else F.lit(fallback))


def _sky(field: str) -> Column:
    return F.get(F.col("p.weather"), F.lit(0))[field]


def to_raw(df: DataFrame, district: str, latitude: str, longitude: str, time: str,
           payload: str = "payload", keep=()) -> DataFrame:
    """Payloads fetched in metric units to RAW observations."""
    epoch = {n: F.timestamp_seconds(F.col(f"p.sys.{n}")) for n in ("sunrise", "sunset")}
    return parse(df, payload).select(
        *keep,
        F.col(district).alias("district"),
        F.col(latitude).cast("double").alias("latitude"),
        F.col(longitude).cast("double").alias("longitude"),
        F.col(time).alias("fetch_time"),
        F.date_format(time, "yyyy-MM-dd").alias("date"),
        "p.main.temp", "p.main.temp_min", "p.main.temp_max", "p.main.feels_like", "p.main.pressure", "p.main.humidity",
        F.col("p.wind.speed").alias("wind_speed"),
        F.col("p.wind.deg").alias("wind_deg"),
        F.col("p.clouds.all").alias("clouds"),
        F.col("p.visibility").alias("visibility"),
        _or("p.rain.1h", 0.0).alias("rain_1h"),
        _or("p.rain.3h", 0.0).alias("rain_3h"),
        _or("p.snow.1h", 0.0).alias("snow_1h"),
        _sky("main").alias("weather_main"),
        _sky("description").alias("weather_description"),
        *[F.when(F.col(f"p.sys.{n}") != 0, t).alias(n) for n, t in epoch.items()],
        F.lit("openweathermap").alias("source"),
    )


def to_feed(df: DataFrame, city: str, time: str, payload: str = "payload", keep=()) -> DataFrame:
    """Payloads in Kelvin to feed records.

    Daily rain is 24 times the last hour, else 8 times the last three hours,
    else 0; a rain amount of 0 counts as not given. Absent fields get stand-ins.
    """
    kelvin = _or("p.main.temp", ZERO_CELSIUS_IN_KELVIN)

    def celsius(path: str) -> Column:
        return _or(path, kelvin) - ZERO_CELSIUS_IN_KELVIN

    high, low = celsius("p.main.temp_max"), celsius("p.main.temp_min")
    hour, three = _or("p.rain.1h", 0.0), _or("p.rain.3h", 0.0)
    rain = or_else(hour * 24, or_else(three * 8, 0.0))
    sight = _or("p.visibility", 10000)
    return parse(df, payload).select(
        *keep,
        _or("p.name", F.col(city)).alias("city_name"),
        F.col(city).alias("district"),
        F.date_format(time, "yyyy-MM-dd").alias("date"),
        F.date_format(time, "dd MMM yyyy | hh:mm:ss a").alias("datetime"),
        _or("p.coord.lat", 27.0).alias("latitude"),
        _or("p.coord.lon", 85.0).alias("longitude"),
        F.round(kelvin - ZERO_CELSIUS_IN_KELVIN, 1).alias("temperature"),
        F.round(high, 1).alias("temp_max"),
        F.round(low, 1).alias("temp_min"),
        F.round(celsius("p.main.feels_like"), 1).alias("feels_like"),
        F.round(high - low, 1).alias("temp_range"),
        _or("p.main.humidity", 50).alias("humidity"),
        _or("p.main.pressure", 1013).alias("pressure"),
        F.round(rain, 1).alias("precipitation"),
        F.round(_or("p.wind.speed", 0.0), 1).alias("wind_speed"),
        _or("p.wind.deg", 0).alias("wind_direction"),
        _or("p.clouds.all", 0).alias("cloudiness"),
        sight.alias("visibility"),
        F.round(sight / 1000, 1).alias("visibility_km"),
        _or(_sky("main"), "N/A").alias("weather_main"),
        _or(_sky("description"), "N/A").alias("weather_description"),
        short_time(F.col("p.sys.sunrise"), "N/A").alias("sunrise"),
        short_time(F.col("p.sys.sunset"), "N/A").alias("sunset"),
        F.lit("openweathermap").alias("source"),
    )


def to_station(df: DataFrame, district: str, time: str, payload: str = "payload", keep=()) -> DataFrame:
    """Payloads fetched in metric units to snake-case station records (visibility in km)."""
    temp = F.col("p.main.temp")
    spread = _or("p.main.temp_max", 0.0) - _or("p.main.temp_min", 0.0)
    return parse(df, payload).select(
        *keep,
        F.col(district).alias("district"),
        F.date_format(time, "yyyy-MM-dd").alias("date"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
        _or("p.main.temp_max", temp).alias("max_temp"),
        _or("p.main.temp_min", temp).alias("min_temp"),
        spread.alias("temp_range"),
        _or("p.rain.1h", 0.0).alias("precipitation"),
        _or("p.main.humidity", 0).cast("double").alias("humidity"),
        _or("p.wind.speed", 0.0).alias("wind_speed"),
        _or("p.main.pressure", 1013).cast("double").alias("pressure"),
        _or("p.clouds.all", 0).alias("cloudiness"),
        (_or("p.visibility", 10000) / 1000).alias("visibility"),
        _or(_sky("description"), "").alias("weather_desc"),
        short_time(F.col("p.sys.sunrise"), "").alias("sunrise"),
        short_time(F.col("p.sys.sunset"), "").alias("sunset"),
        F.lit("openweathermap").alias("source"),
    )


def feed_to_record(feed: DataFrame, keep=()) -> DataFrame:
    """Feed records to the observation model of the producer; wind at 50 m is estimated."""
    return feed.select(
        *keep, "district", "date", "latitude", "longitude",
        F.col("temp_max").alias("max_temp"), F.col("temp_min").alias("min_temp"), "temp_range",
        "precipitation", F.col("humidity").cast("double").alias("humidity"),
        F.col("wind_speed").alias("wind_speed_10m"),
        (F.col("wind_speed") * 1.5).alias("wind_speed_50m"),
    )
