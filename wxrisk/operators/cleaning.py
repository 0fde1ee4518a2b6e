"""Observation cleaning and enrichment, in a batch and a stream profile.

All of it is projection work: one stage, no shuffle, whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.scalar import holds, ladder, or_else, parsed_once, pick, wave
from wxrisk.schemas import SERVING_COLUMNS


def clean(df: DataFrame) -> DataFrame:
    """Out-of-range readings become NULL, negative or missing wind becomes 0, gaps get fill-ins.

    Only the columns that ``df`` has are touched.
    """
    have = set(df.columns)
    changes: dict[str, Column] = {}
    for name, (low, high) in K.VALID_RANGE.items():
        if name in have:
            changes[name] = F.when(F.col(name).between(low, high), F.col(name))
    if "wind_speed" in have:
        changes["wind_speed"] = F.greatest("wind_speed", F.lit(0.0))  # skips NULL
    for name, fill in K.FILL_WHEN_NULL.items():
        if name in have:
            changes[name] = F.coalesce(name, F.lit(fill))
    return df.withColumns(changes)


def calendar(time: str = "fetch_time") -> dict[str, Column]:
    return {
        "year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time),
        "hour": F.hour(time), "day_of_year": F.dayofyear(time),
    }


def _short_wave(fn, index: Column, period: float) -> Column:
    return wave(fn, index, period, F.lit(K.SHORT_PI))


def add_calendar(df: DataFrame, time: str = "fetch_time") -> DataFrame:
    """Date parts of the observation time and the cyclic day and hour columns."""
    day, hour = F.dayofyear(time), F.hour(time)
    return df.withColumns({
        **calendar(time),
        "doy_sin": _short_wave(F.sin, day, K.DAYS_COMMON_YEAR),
        "doy_cos": _short_wave(F.cos, day, K.DAYS_COMMON_YEAR),
        "hour_sin": _short_wave(F.sin, hour, K.HOURS_PER_DAY),
        "hour_cos": _short_wave(F.cos, hour, K.HOURS_PER_DAY),
    })


def _flag(condition: Column) -> Column:
    return holds(condition).cast("int")


def add_derived(df: DataFrame) -> DataFrame:
    """Temperature range, visibility in km, total precipitation and the 0/1 day flags."""
    return df.withColumns({
        "temp_range": F.col("temp_max") - F.col("temp_min"),
        "visibility_km": F.col("visibility") / 1000,
        "total_precip": F.col("rain_1h") + F.col("snow_1h"),
        "is_rainy": _flag(F.col("rain_1h") > 0),
        "is_cloudy": _flag(F.col("clouds") > K.CLOUDY_PERCENT),
        "is_windy": _flag(F.col("wind_speed") > K.WINDY_SPEED),
    })


def heat_index_batch(temp: str = "temp", humidity: str = "humidity") -> Column:
    t, h, w = F.col(temp), F.col(humidity), K.HEAT_INDEX_TERMS
    felt = F.lit(w["base"]) + w["temp"] * t + w["humidity"] * h + w["both"] * t * h
    return F.when(t >= K.HEAT_INDEX_FROM, felt).otherwise(t)


def heat_index_stream(temp: str = "temp", humidity: str = "humidity") -> Column:
    t = F.col(temp)
    return F.when(t > K.HEAT_INDEX_FROM, t + (F.col(humidity) - 10) / 2).otherwise(t)


def add_risk_batch(df: DataFrame) -> DataFrame:
    """Heat index and whole-number risk levels 0 to 3."""
    return df.withColumns({
        "heat_index": heat_index_batch(),
        "heatwave_indicator": ladder(F.col("temp_max"), K.BATCH_HEAT_LEVELS, 0),
        "flood_indicator": ladder(F.col("rain_1h"), K.BATCH_FLOOD_LEVELS, 0),
        "humidity_risk": ladder(F.col("humidity"), K.BATCH_HUMIDITY_LEVELS, 0),
    })


def add_risk_stream(df: DataFrame) -> DataFrame:
    """Heat index and fractional risk levels; the flood level also looks at humidity."""
    humid_bound, humid_level = K.STREAM_FLOOD_HUMID
    dry = ladder(F.col("humidity"), ((humid_bound, humid_level),), K.STREAM_FLOOD_FLOOR, strict=True)
    return df.withColumns({
        "heat_index": heat_index_stream(),
        "heatwave_indicator": ladder(F.col("temp"), K.STREAM_HEAT_LEVELS, 0.0, strict=True),
        "flood_indicator": ladder(F.col("rain_1h"), K.STREAM_FLOOD_RAIN_LEVELS, dry, strict=True),
        "humidity_risk": ladder(F.col("humidity"), K.STREAM_HUMIDITY_LEVELS, "LOW", strict=True),
    })


def add_lineage(df: DataFrame, version: str) -> DataFrame:
    return df.withColumns({"etl_timestamp": F.current_timestamp(), "etl_version": F.lit(version)})


def transform_batch(df: DataFrame) -> DataFrame:
    """RAW observations to the full batch-profile table."""
    steps = (clean, add_calendar, add_derived, add_risk_batch)
    for step in steps:
        df = df.transform(step)
    return add_lineage(df, K.BATCH_VERSION)


def transform_stream(messages: DataFrame) -> DataFrame:
    """Decoded messages (training vocabulary + ``kafka_timestamp``) to the serving columns."""
    peak, rain = F.col("MaxTemp_2m"), F.col("Precip")
    renamed = messages.select(
        F.col("District").alias("district"),
        F.col("Date").alias("date"),
        F.col("kafka_timestamp").alias("fetch_time"),
        peak.alias("temp"),
        F.col("MinTemp_2m").alias("temp_min"),
        peak.alias("temp_max"),
        F.col("TempRange_2m").alias("temp_range"),
        F.col("RH_2m").try_cast("int").alias("humidity"),
        F.col("Pressure").try_cast("int").alias("pressure"),
        F.col("WindSpeed_10m").alias("wind_speed"),
        F.col("Cloudiness").alias("clouds"),
        rain.alias("rain_1h"),
        rain.alias("total_precip"),
        (F.col("Visibility") / 1000).alias("visibility_km"),
    )
    full = add_lineage(add_risk_stream(add_calendar(renamed)), K.STREAM_VERSION)
    return serving_view(full)


def serving_view(df: DataFrame) -> DataFrame:
    """The 26 serving columns, in table order."""
    return df.select(*SERVING_COLUMNS)


def standardise_producer(df: DataFrame) -> DataFrame:
    """Observation records to the message vocabulary.

    Absent coordinates, winds and radiation get stand-ins; an absent or zero
    minimum is taken 10 degrees below the maximum and an absent or zero range is 10.
    """
    return df.select(
        F.col("district").alias("District"),
        F.col("date").alias("Date"),
        pick(df, "latitude", default=27.0).alias("Latitude"),
        pick(df, "longitude", default=85.0).alias("Longitude"),
        F.col("max_temp").alias("MaxTemp_2m"),
        or_else(F.col("min_temp"), F.col("max_temp") - 10).alias("MinTemp_2m"),
        or_else(F.col("temp_range"), 10.0).alias("TempRange_2m"),
        F.col("precipitation").alias("Precip"),
        F.col("humidity").alias("RH_2m"),
        pick(df, "wind_speed_10m", default=0.0).alias("WindSpeed_10m"),
        pick(df, "wind_speed_50m", default=0.0).alias("WindSpeed_50m"),
        pick(df, "solar_radiation", default=0.0).alias("SolarRad"),
        F.lit("api").alias("source"),
    )


REQUIRED_BY_PRODUCER = ("district", "date", "max_temp", "precipitation", "humidity")


def split_required(df: DataFrame, required=REQUIRED_BY_PRODUCER) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rejected rows) by presence of the required fields."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return df.filter(complete), df.filter(~complete)


def wind_at_50m(wind_10m: Column) -> Column:
    return wind_10m * 1.5


def serving_to_training(df: DataFrame) -> DataFrame:
    """Serving rows to the training vocabulary; zero readings fall back as if they were missing."""
    heat = F.coalesce("heatwave_indicator", F.lit(0))
    flood = F.coalesce("flood_indicator", F.lit(0))
    return df.select(
        F.col("district").alias("District"),
        F.coalesce(F.date_format("fetch_time", "yyyy-MM-dd"), F.lit("")).alias("Date"),
        or_else(F.col("temp_max"), F.col("temp")).alias("MaxTemp_2m"),
        F.col("temp_min").alias("MinTemp_2m"),
        (F.coalesce("temp_max", F.lit(0.0)) - F.coalesce("temp_min", F.lit(0.0))).alias("TempRange_2m"),
        F.coalesce("rain_1h", F.lit(0.0)).alias("Precip"),
        F.col("humidity").alias("RH_2m"),
        F.col("wind_speed").alias("WindSpeed_10m"),
        F.col("pressure").alias("Pressure"),
        F.col("clouds").alias("Cloudiness"),
        F.col("visibility_km").alias("Visibility"),
        F.col("heat_index").alias("HeatIndex"),
        heat.alias("heatwave_probability"),
        flood.alias("flood_probability"),
        ladder(heat, K.RISK_ABOVE, "LOW", strict=True).alias("heatwave_risk"),
        ladder(flood, K.RISK_ABOVE, "LOW", strict=True).alias("flood_risk"),
        F.lit("spark_etl").alias("source"),
        F.lit("From Spark ETL").alias("WeatherDesc"),
    )


def api_to_training(df: DataFrame, today: Column | None = None) -> DataFrame:
    """Parsed payload rows to the training vocabulary; the maximum falls back to the reading."""
    zero = F.lit(0)
    return df.select(
        F.col("district").alias("District"),
        pick(df, "date", default=F.date_format(today or F.current_date(), "yyyy-MM-dd")).alias("Date"),
        F.coalesce("temp_max", "temperature", zero).alias("MaxTemp_2m"),
        F.coalesce("temp_min", zero).alias("MinTemp_2m"),
        F.coalesce("temp_range", zero).alias("TempRange_2m"),
        F.coalesce("precipitation", zero).alias("Precip"),
        F.coalesce("humidity", zero).alias("RH_2m"),
        F.coalesce("wind_speed", zero).alias("WindSpeed_10m"),
        F.coalesce("pressure", zero).alias("Pressure"),
        F.coalesce("cloudiness", zero).alias("Cloudiness"),
        F.coalesce("visibility_km", zero).alias("Visibility"),
        F.coalesce("weather_description", F.lit("")).alias("WeatherDesc"),
        F.coalesce("sunrise", F.lit("")).alias("Sunrise"),
        F.coalesce("sunset", F.lit("")).alias("Sunset"),
        F.lit("openweathermap").alias("source"),
    )


# Storage defaults: (output column, accepted source names, stand-in when absent, type).
OBSERVATION_STORAGE = (
    ("district", ("District", "district"), "Unknown", "string"),
    ("date", ("Date", "date"), "", "string"),
    ("max_temp", ("MaxTemp_2m", "max_temp"), "0", "double"),
    ("min_temp", ("MinTemp_2m", "min_temp"), "0", "double"),
    ("temp_range", ("TempRange_2m", "temp_range"), "0", "double"),
    ("precipitation", ("Precip", "precipitation"), "0", "double"),
    ("humidity", ("RH_2m", "humidity"), "0", "double"),
    ("wind_speed", ("WindSpeed_10m", "wind_speed"), "0", "double"),
    ("pressure", ("Pressure", "pressure"), "0", "double"),
    ("cloudiness", ("Cloudiness", "cloudiness"), "0", "int"),
    ("visibility", ("Visibility", "visibility"), "0", "double"),
    ("weather_desc", ("WeatherDesc", "weather_desc"), "", "string"),
    ("sunrise", ("Sunrise", "sunrise"), "", "string"),
    ("sunset", ("Sunset", "sunset"), "", "string"),
    ("source", ("source",), "openweathermap", "string"),
)


def storage_record(df: DataFrame, fields: str, rules=OBSERVATION_STORAGE, keep=()) -> tuple[DataFrame, DataFrame]:
    """(storable rows, rejected rows) from a ``map<string,string>`` column of message fields.

    A field the message lacks gets its stand-in. A field that is there but null,
    or text that is not a number, cannot be stored: the row is rejected.
    """
    values, checked, names = [], [], []
    for target, spellings, stand_in, kind in rules:
        text = F.coalesce(*[F.col(fields)[name] for name in spellings], F.lit(stand_in))
        values.append((text if kind == "string" else text.try_cast(kind)).alias(target))
        if kind != "string":
            checked.append(F.col(f"_r.{target}"))
            names.extend(spellings)
        elif target == "district":
            names.extend(spellings)
    null_field = F.exists(F.map_entries(fields), lambda e: e["value"].isNull() & e["key"].isin(names))
    read = df.select("*", parsed_once(F.struct(*values, null_field.alias("_null")), "_r"))
    ok = ~F.col("_r._null")
    for column in checked:
        ok = ok & column.isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    good = read.filter(ok).select(*keep, *[f"_r.{target}" for target, *_ in rules])
    return good, read.filter(~ok).drop("_r")


def limit_to(df: DataFrame, names: str, known, column: str = "district") -> DataFrame:
    """Rows of a comma-separated district list; names that are not known are dropped."""
    wanted = [n.strip() for n in names.split(",") if n.strip() in known]
    return df.filter(F.col(column).isin(wanted))


def display_bands(df: DataFrame, temp: str = "MaxTemp_2m", precip: str = "Precip") -> DataFrame:
    return df.withColumns({
        "temp_band": ladder(F.col(temp), K.TEMP_BANDS, "green", strict=True),
        "precip_band": ladder(F.col(precip), K.PRECIP_BANDS, "white", strict=True),
    })
