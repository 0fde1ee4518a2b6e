"""File, lake, message and export writers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk.schemas import HISTORY


def write_files(df: DataFrame, path: str, kind: str = "parquet", *, single: bool = False) -> None:
    """Overwrites ``path``. ``single`` asks for one file, which one task must write: small results only."""
    writer = (df.coalesce(1) if single else df).write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown file kind {kind!r}")


def write_lake_batch(df: DataFrame, root: str, batch_id: int) -> str:
    """One folder per batch, named by the batch alone: a replayed batch replaces itself."""
    path = f"{root.rstrip('/')}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_stations(df: DataFrame, root: str, key: str = "District") -> None:
    """CSV per district below ``root`` (one folder per district)."""
    df.write.mode("overwrite").option("header", True).partitionBy(key).csv(root)


def as_messages(df: DataFrame, key: str = "District") -> DataFrame:
    """Rows as (key, value) with the whole row as JSON text, NULL fields left out."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish(df: DataFrame, servers: str, topic: str, key: str = "District") -> None:
    """Writes the rows to a topic, acknowledged by all replicas (needs the Kafka connector's jar)."""
    (
        as_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all").option("kafka.retries", "3").option("topic", topic).save()
    )


HISTORY_FIELDS = {
    "latitude": "Latitude", "longitude": "Longitude", "max_temp": "MaxTemp_2m", "min_temp": "MinTemp_2m",
    "temp_range": "TempRange_2m", "precipitation": "Precip", "humidity": "RH_2m",
    "wind_speed_10m": "WindSpeed_10m", "wind_speed_50m": "WindSpeed_50m", "solar_radiation": "SolarRad",
}


def history_records(df: DataFrame, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows for the (district, year) history table, rejected rows).

    Absent columns count as 0. A row with an unreadable date, no district or a
    measure that is not a number is rejected; so is a NULL date, the table's key.
    """
    day = F.to_date(F.substring(F.col("Date").cast("string"), 1, 10)) if dict(df.dtypes)["Date"] == "date" \
        else F.try_to_date(F.substring("Date", 1, 10), "yyyy-MM-dd")
    out = {"district": F.col("District"), "year": F.year(day), "date": day,
           "timestamp": F.current_timestamp() if now is None else now}
    ok = day.isNotNull() & F.col("District").isNotNull()
    for name, source in HISTORY_FIELDS.items():
        if source in df.columns:
            out[name] = F.col(source).try_cast("double")
            ok = ok & (F.col(source).isNull() | out[name].isNotNull())
        else:
            out[name] = F.lit(0.0)
    good = df.filter(ok).select(*[out[f.name].cast(f.dataType).alias(f.name) for f in HISTORY.fields])
    return good, df.filter(~F.coalesce(ok, F.lit(False)))


def write_history(df: DataFrame, path: str) -> None:
    """History partitioned by district and year, newest day first inside a file."""
    (
        df.hint("rebalance", "district", "year").sortWithinPartitions("district", "year", F.desc("date"))
        .write.mode("overwrite").partitionBy("district", "year").parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Exports a limited result (a top-n) as one CSV file with a header."""
    write_files(df, path, "csv", single=True)


def as_json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("json"))


def _files(spark: SparkSession, areas: dict[str, str]) -> DataFrame:
    def one(area: str, path: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        name = F.element_at(F.split("path", "/"), -1)
        return found.select(F.lit(area).alias("area"), name.alias("name"), "length")

    return reduce(DataFrame.unionByName, [one(a, p) for a, p in areas.items()])


def lake_inventory(spark: SparkSession, areas: dict[str, str]) -> DataFrame:
    """Files and total size in MB per area; file contents are not read."""
    megabytes = F.sum("length") / (1024 * 1024)
    return _files(spark, areas).groupBy("area").agg(
        F.count("*").alias("items"), F.round(megabytes, 4).alias("size_mb")
    )


def lake_listing(spark: SparkSession, areas: dict[str, str], shown: int = 5) -> DataFrame:
    """The first few file names of each area with their size."""
    order = W.partitionBy("area").orderBy("name")
    ranked = _files(spark, areas).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= shown).select(
        "area", "name", F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb")
    )
