"""File readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wxrisk.schemas import DAILY, RAW


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def with_date(df: DataFrame, column: str = "Date") -> DataFrame:
    """Fails at once when there is no date column; text that is not a date fails the job."""
    if column not in df.columns:
        raise ValueError(f"{column} column missing")
    return df.withColumn(column, F.col(column).cast("date"))


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast by name; columns the schema does not know stay text."""
    named = trim_headers(text)
    known = {f.name: f.dataType for f in schema.fields}

    def read(name: str) -> Column:
        column = F.col(f"`{name}`")
        return column.cast(known[name]).alias(name) if name in known else column

    return named.select(*[read(c) for c in named.columns])


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; with ``schema`` the columns are matched by name.

    All files must have the header of the first one: a file with other columns
    fails the job rather than being read into the wrong columns.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return typed(reader.csv(path), schema)


def read_daily_csv(spark: SparkSession, path) -> DataFrame:
    """One daily history file (or several): header names trimmed, date checked, extra columns kept."""
    return with_date(read_csv(spark, path, DAILY))


def station_name(suffix: str = "csv") -> Column:
    """The file's name without its suffix and part number; file names arrive in URL form."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*?)(\.part\d+)?\.{suffix}$", 1)
    return F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))


def read_stations(spark: SparkSession, folder: str, schema: T.StructType = DAILY) -> DataFrame:
    """A folder with a CSV per district, read in one scan; the file name is the district.

    A large district may come in several files, ``name.part0.csv`` and so on.
    """
    text = spark.read.option("header", True).option("enforceSchema", False).csv(f"{folder.rstrip('/')}/*.csv")
    rows = typed(text.withColumn("_station", station_name()), schema)
    measures = [c for c in rows.columns if c not in ("District", "_station")]
    return rows.select(F.col("_station").alias("District"), *measures)


def read_many_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_csv(spark, paths)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """RAW observations: JSON by extension with the fixed schema, anything else as parquet."""
    if path.rstrip("/").endswith(".json"):
        return spark.read.schema(RAW).json(path)
    return spark.read.parquet(path)


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """All batches of the lake; ``batch_id`` comes from the folder names."""
    return spark.read.parquet(root)


def from_records(spark: SparkSession, records: list, schema: T.StructType = RAW) -> DataFrame:
    """Records a caller holds, under a fixed schema; none gives an empty table of that schema."""
    return spark.createDataFrame(records, schema)
