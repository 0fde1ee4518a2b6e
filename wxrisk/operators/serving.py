"""Serving queries: newest rows, look-backs, district lists, display projections.

``orderBy(...).limit(n)`` runs as a per-task top-n and one merge of n rows per
task; ``row_number() <= n`` per district is cut to n rows per task before the
shuffle (window group limit), so a hot district never travels whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk.constants import CITIES, DISTRICTS
from wxrisk.functions.scalar import zero_as_null


def dimension(spark: SparkSession, places: dict = DISTRICTS, name: str = "district") -> DataFrame:
    """The coordinate table: a handful of fixed rows, so broadcasting it is always safe."""
    rows = [(place, lat, lon) for place, (lat, lon) in places.items()]
    return spark.createDataFrame(rows, f"{name} string, latitude double, longitude double")


def cities(spark: SparkSession) -> DataFrame:
    return dimension(spark, CITIES, "city")


def with_coordinates(df: DataFrame, places: DataFrame, key: str = "district") -> DataFrame:
    """Inner join to the coordinate table; rows of unknown places are dropped."""
    return df.join(places, key)


def newest(df: DataFrame, time: str, n: int, *tie: str) -> DataFrame:
    return df.orderBy(F.desc(time), *[F.desc(t) for t in tie]).limit(n)


def since(df: DataFrame, hours: float, as_of: dt.datetime | Column | None = None,
          time: str = "fetch_time") -> DataFrame:
    """Rows of the last ``hours`` hours before ``as_of`` (default: now).

    With a given time the bound is a constant, so the filter reaches the scan.
    """
    back = dt.timedelta(hours=hours)
    if isinstance(as_of, dt.datetime):
        return df.filter(F.col(time) >= F.lit(as_of - back))
    now = F.current_timestamp() if as_of is None else as_of
    return df.filter(F.col(time) >= now - F.lit(back))


def since_day(df: DataFrame, days: int, today: dt.date, date: str = "date") -> DataFrame:
    """Rows of the last ``days`` days by ISO date text."""
    return df.filter(F.col(date) >= (today - dt.timedelta(days=days)).isoformat())


def observations(df: DataFrame, district: str, n: int = 20, *, hours: float | None = None,
                 as_of=None, tie: tuple[str, ...] = ()) -> DataFrame:
    """Newest ``n`` observations of a district, newest first, optionally of the last hours only."""
    rows = df.filter(F.col("district") == district)
    if hours:
        rows = since(rows, hours, as_of)
    return newest(rows, "fetch_time", n, *tie)


def predictions(df: DataFrame, district: str, n: int = 20, *, tie: tuple[str, ...] = ()) -> DataFrame:
    return newest(df.filter(F.col("district") == district), "prediction_time", n, *tie)


def recent(df: DataFrame, time: str, n: int = 20, district: str | None = None, tie=()) -> DataFrame:
    """Newest rows of one district or of all."""
    return newest(df if district is None else df.filter(F.col("district") == district), time, n, *tie)


def newest_per_district(df: DataFrame, time: str, n: int, *tie: str, key: str = "district") -> DataFrame:
    order = W.partitionBy(key).orderBy(F.desc(time), *[F.desc(t) for t in tie])
    return df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def all_districts(df: DataFrame, time: str, limit: int, *tie: str, known=tuple(DISTRICTS)) -> DataFrame:
    """An equal share of ``limit`` for each known district, newest first over all."""
    wanted = df.filter(F.col("district").isin(list(known)))
    share = newest_per_district(wanted, time, limit // len(known), *tie)
    return share.orderBy(F.desc(time), *[F.desc(t) for t in tie])


def latest(df: DataFrame, time: str = "fetch_time", *tie: str, key: str = "district") -> DataFrame:
    return newest_per_district(df, time, 1, *tie, key=key)


def district_year(df: DataFrame, district: str, year: int, n: int = 100) -> DataFrame:
    """A district's year, newest day first; both filters prune partitions of the stored table."""
    rows = df.filter((F.col("district") == district) & (F.col("year") == year))
    return rows.orderBy(F.desc("date")).select("date", "max_temp", "precipitation", "humidity").limit(n)


def hot_days(df: DataFrame, district: str, year: int, above: float = 40) -> DataFrame:
    keyed = df.filter((F.col("district") == district) & (F.col("year") == year))
    return keyed.filter(F.col("max_temp") > above).select("date", "max_temp", "district")


def speed_over_batch(speed: DataFrame, batch: DataFrame, key: str = "district") -> DataFrame:
    """Latest row per district from the speed view; the batch view only where speed has none.

    Both inputs hold one row per district.
    """
    rest = batch.join(speed.select(key), key, "left_anti")
    return speed.withColumn("layer", F.lit("speed")).unionByName(rest.withColumn("layer", F.lit("batch")))


def as_text(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def show_predictions(df: DataFrame, percent: bool = True) -> DataFrame:
    """Times as text; probabilities in percent (0 if absent) or as a fraction (zero counts as absent)."""
    def prob(name: str) -> Column:
        if percent:
            return F.round(F.coalesce(F.col(name), F.lit(0.0)) * 100, 2)
        return F.round(zero_as_null(F.col(name)), 4)

    return df.select(
        "district", as_text("prediction_time").alias("prediction_time"), "max_temp", "precipitation",
        "humidity", prob("heatwave_probability").alias("heatwave_prob"),
        prob("flood_probability").alias("flood_prob"), "heatwave_risk", "flood_risk",
    )


def show_daily(df: DataFrame) -> DataFrame:
    """Daily summary for display: rounded, and a zero reads as "no value"."""
    digits = {"avg_temp": 1, "max_temp": 1, "min_temp": 1, "total_precip": 2, "avg_humidity": 1}
    rounded = [F.round(zero_as_null(F.col(c)), d).alias(c) for c, d in digits.items()]
    return df.select("district", "date", "record_count", *rounded, "heatwave_alerts", "flood_alerts")


def history_table(df: DataFrame, n: int = 15, *tie: str) -> DataFrame:
    """Newest records as shown in the history panel."""
    return newest(df, "fetched_at", n, *tie).select(
        F.replace(F.substring("fetched_at", 1, 19), F.lit("T"), F.lit(" ")).alias("Time"),
        "District",
        F.round("MaxTemp_2m", 1).alias("Temp"),
        F.round("RH_2m", 0).alias("Humidity"),
        F.round("Precip", 1).alias("Precip"),
        F.round(F.col("heatwave_probability") * 100, 1).alias("Heatwave %"),
        F.round(F.col("flood_probability") * 100, 1).alias("Flood %"),
    )


def recent_table(df: DataFrame, order: str, n: int = 20, *tie: str) -> DataFrame:
    """Newest stream rows with the display columns that exist, rounded and renamed."""
    shown = {
        "Date": (F.date_format("Date", "yyyy-MM-dd") if "Date" in df.columns else None, "Date"),
        "District": (F.col("District") if "District" in df.columns else None, "District"),
        "MaxTemp_2m": (F.round("MaxTemp_2m", 1) if "MaxTemp_2m" in df.columns else None, "Temp (°C)"),
        "Precip": (F.round("Precip", 2) if "Precip" in df.columns else None, "Precip (mm)"),
        "RH_2m": (F.round("RH_2m", 1) if "RH_2m" in df.columns else None, "Humidity (%)"),
    }
    return newest(df, order, n, *tie).select(
        *[c.alias(title) for c, title in shown.values() if c is not None]
    )


def first_rows(df: DataFrame, k: int, *order: str) -> DataFrame:
    """The first ``k`` rows in a stated order."""
    return df.orderBy(*order).limit(k)
