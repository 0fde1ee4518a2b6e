"""Table schemas as Spark types (one namespace, UTC everywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

# Names, types and order of the tables' columns.

#: Observations as fetched.
RAW = StructType([
    StructField("district", StringType(), nullable=False),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("fetch_time", TimestampType(), nullable=False),
    StructField("date", StringType()),
    StructField("temp", DoubleType()),
    StructField("temp_min", DoubleType()),
    StructField("temp_max", DoubleType()),
    StructField("feels_like", DoubleType()),
    StructField("pressure", IntegerType()),
    StructField("humidity", IntegerType()),
    StructField("wind_speed", DoubleType()),
    StructField("wind_deg", IntegerType()),
    StructField("clouds", IntegerType()),
    StructField("visibility", IntegerType()),
    StructField("rain_1h", DoubleType()),
    StructField("rain_3h", DoubleType()),
    StructField("snow_1h", DoubleType()),
    StructField("weather_main", StringType()),
    StructField("weather_description", StringType()),
    StructField("sunrise", TimestampType()),
    StructField("sunset", TimestampType()),
    StructField("source", StringType()),
])

#: Messages of the feed.
MESSAGE = StructType([
    StructField("District", StringType()),
    StructField("Date", StringType()),
    StructField("MaxTemp_2m", DoubleType()),
    StructField("MinTemp_2m", DoubleType()),
    StructField("TempRange_2m", DoubleType()),
    StructField("Precip", DoubleType()),
    StructField("RH_2m", DoubleType()),
    StructField("WindSpeed_10m", DoubleType()),
    StructField("Pressure", DoubleType()),
    StructField("Cloudiness", IntegerType()),
    StructField("Visibility", DoubleType()),
    StructField("WeatherDesc", StringType()),
    StructField("Sunrise", StringType()),
    StructField("Sunset", StringType()),
    StructField("fetched_at", StringType()),
    StructField("source", StringType()),
])

#: What the producers add to the message.
MESSAGE_EXTRA = StructType([
    StructField("Latitude", DoubleType()),
    StructField("Longitude", DoubleType()),
    StructField("WindSpeed_50m", DoubleType()),
    StructField("SolarRad", DoubleType()),
    StructField("timestamp", StringType()),
])

#: The daily history.
DAILY = StructType([
    StructField("Date", DateType()),
    StructField("District", StringType()),
    StructField("Latitude", DoubleType()),
    StructField("Longitude", DoubleType()),
    StructField("MaxTemp_2m", DoubleType()),
    StructField("MinTemp_2m", DoubleType()),
    StructField("TempRange_2m", DoubleType()),
    StructField("Precip", DoubleType()),
    StructField("RH_2m", DoubleType()),
    StructField("WindSpeed_10m", DoubleType()),
    StructField("WindSpeed_50m", DoubleType()),
    StructField("SolarRad", DoubleType()),
])

#: Weather service payloads.
PAYLOAD = StructType([
    StructField("name", StringType()),
    StructField("coord", StructType([
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
    ])),
    StructField("main", StructType([
        StructField("temp", DoubleType()),
        StructField("temp_min", DoubleType()),
        StructField("temp_max", DoubleType()),
        StructField("feels_like", DoubleType()),
        StructField("pressure", IntegerType()),
        StructField("humidity", IntegerType()),
    ])),
    StructField("wind", StructType([
        StructField("speed", DoubleType()),
        StructField("deg", IntegerType()),
    ])),
    StructField("clouds", StructType([
        StructField("all", IntegerType()),
    ])),
    StructField("visibility", IntegerType()),
    StructField("rain", StructType([
        StructField("1h", DoubleType()),
        StructField("3h", DoubleType()),
    ])),
    StructField("snow", StructType([
        StructField("1h", DoubleType()),
        StructField("3h", DoubleType()),
    ])),
    StructField("weather", ArrayType(StructType([
        StructField("main", StringType()),
        StructField("description", StringType()),
    ]))),
    StructField("sys", StructType([
        StructField("sunrise", LongType()),
        StructField("sunset", LongType()),
    ])),
])

#: Transformed rows of the batch profile.
SERVING_BATCH = StructType([
    StructField("district", StringType()),
    StructField("fetch_time", TimestampType()),
    StructField("date", StringType()),
    StructField("temp", DoubleType()),
    StructField("temp_min", DoubleType()),
    StructField("temp_max", DoubleType()),
    StructField("temp_range", DoubleType()),
    StructField("humidity", IntegerType()),
    StructField("pressure", IntegerType()),
    StructField("wind_speed", DoubleType()),
    StructField("clouds", IntegerType()),
    StructField("rain_1h", DoubleType()),
    StructField("total_precip", DoubleType()),
    StructField("visibility_km", DoubleType()),
    StructField("heat_index", DoubleType()),
    StructField("heatwave_indicator", IntegerType()),
    StructField("flood_indicator", IntegerType()),
    StructField("humidity_risk", IntegerType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("hour", IntegerType()),
    StructField("doy_sin", DoubleType()),
    StructField("doy_cos", DoubleType()),
    StructField("etl_timestamp", TimestampType()),
    StructField("etl_version", StringType()),
])
SERVING_COLUMNS = SERVING_BATCH.names

#: Transformed rows of the stream profile.
SERVING_STREAM = StructType([
    StructField("district", StringType()),
    StructField("fetch_time", TimestampType()),
    StructField("date", StringType()),
    StructField("temp", DoubleType()),
    StructField("temp_min", DoubleType()),
    StructField("temp_max", DoubleType()),
    StructField("temp_range", DoubleType()),
    StructField("humidity", IntegerType()),
    StructField("pressure", IntegerType()),
    StructField("wind_speed", DoubleType()),
    StructField("clouds", IntegerType()),
    StructField("rain_1h", DoubleType()),
    StructField("total_precip", DoubleType()),
    StructField("visibility_km", DoubleType()),
    StructField("heat_index", DoubleType()),
    StructField("heatwave_indicator", DoubleType()),
    StructField("flood_indicator", DoubleType()),
    StructField("humidity_risk", StringType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("hour", IntegerType()),
    StructField("doy_sin", DoubleType()),
    StructField("doy_cos", DoubleType()),
    StructField("etl_timestamp", TimestampType()),
    StructField("etl_version", StringType()),
])

#: Daily summaries.
DAILY_SERVING = StructType([
    StructField("district", StringType()),
    StructField("date", StringType()),
    StructField("avg_temp", DoubleType()),
    StructField("max_temp", DoubleType()),
    StructField("min_temp", DoubleType()),
    StructField("avg_humidity", DoubleType()),
    StructField("total_precip", DoubleType()),
    StructField("avg_wind", DoubleType()),
    StructField("rainy_hours", IntegerType()),
    StructField("heatwave_risk_level", IntegerType()),
    StructField("flood_risk_level", IntegerType()),
    StructField("observation_count", IntegerType()),
    StructField("etl_timestamp", TimestampType()),
])

#: Alert rows.
ALERTS = StructType([
    StructField("district", StringType()),
    StructField("fetch_time", TimestampType()),
    StructField("date", StringType()),
    StructField("alert_type", StringType()),
    StructField("temp_max", DoubleType()),
    StructField("rain_1h", DoubleType()),
    StructField("humidity", IntegerType()),
    StructField("heatwave_indicator", IntegerType()),
    StructField("flood_indicator", IntegerType()),
])

#: History rows by district and year.
HISTORY = StructType([
    StructField("district", StringType()),
    StructField("year", IntegerType()),
    StructField("date", DateType()),
    StructField("timestamp", TimestampType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("max_temp", DoubleType()),
    StructField("min_temp", DoubleType()),
    StructField("temp_range", DoubleType()),
    StructField("precipitation", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("wind_speed_10m", DoubleType()),
    StructField("wind_speed_50m", DoubleType()),
    StructField("solar_radiation", DoubleType()),
])

# Primary keys: a later write with the same key replaces the row.
KEYS = {
    "weather_transformed": ["district", "fetch_time"],
    "weather_daily_summary": ["district", "date"],
    "weather_alerts": ["district", "date", "fetch_time"],
    "weather_observations": ["district", "fetch_time", "id"],
    "weather_history": ["district", "year", "date"],
    "weather_predictions": ["district", "prediction_time", "id"],
}
