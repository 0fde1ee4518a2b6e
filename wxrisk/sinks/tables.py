"""Keyed tables as partitioned parquet: a later row with the same key replaces the earlier one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wxrisk.session import file_system, remove_folder


def last_per_key(df: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """The row with the highest ``version`` of each key.

    Ranking with a limit of 1 is applied per task before the shuffle, so a key
    with very many copies is thinned where the copies lie. Rows equal in
    ``version`` are told apart by a hash of the row.
    """
    newest = W.partitionBy(*key).orderBy(*[F.desc(v) for v in version], F.xxhash64(*df.columns))
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was completed."""
    files, marker = file_system(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything but hidden files."""
    files, pattern = file_system(spark, f"{path}/[^_.]*")
    return len(files.globStatus(pattern)) > 0


def _same_rows(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join in which two nulls are equal."""
    other = right.select(*[F.col(c).alias(f"_{c}") for c in columns]).distinct()
    return left.join(other, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]), how)


class KeyedTable:
    """A parquet table partitioned by ``partition`` columns, unique by ``key``.

    ``upsert`` rewrites only the partitions that the new rows touch. The merged
    rows are completed in a staging folder first and then put in place. If the
    last step is cut short, the same upsert (same token) finishes it from the
    staging folder, so no stored row is lost and none is doubled. A token names
    one batch of rows, and only the newest batch may be repeated. ``derived`` partition
    columns are made from the key (a day of its time, say), so that a batch rewrites the days
    it touches and not the whole history of a district; readers do not see them.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], partition: list[str],
                 order: list[str] | None = None, schema: StructType | None = None, derived: dict[str, Column] | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.partition, self.order, self.derived = key, [*partition, *(derived or {})], order or [], derived or {}

    def read(self) -> DataFrame:
        """The stored rows. The schema matters: folder names alone would turn a text date into a date."""
        return self._stored().drop(*self.derived)

    def _stored(self) -> DataFrame:
        if self.schema is None:
            return self.spark.read.parquet(self.path)
        schema = self.schema
        if self.derived:
            schema = self.spark.createDataFrame([], self.schema).withColumns(self.derived).schema
        return self.spark.read.schema(schema).parquet(self.path)

    def _arrange(self, df: DataFrame) -> DataFrame:
        """Rows of a partition side by side; adaptive execution splits a hot partition over several tasks."""
        return df.hint("rebalance", *self.partition).sortWithinPartitions(*self.partition, *self.order)

    def _write(self, df: DataFrame, path: str, mode: str) -> None:
        (
            self._arrange(df).write.mode(mode).option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partition).parquet(path)
        )

    def _touched(self, fresh: DataFrame) -> DataFrame:
        """Stored rows of the partitions that ``fresh`` touches.

        Partitions with a value are found by a plain join, which prunes the scan at run time;
        those without one by a null filter, which prunes it beforehand, and a null-safe join.
        """
        touched, stored = fresh.select(*self.partition).distinct(), self._stored()
        blank = reduce(or_, [F.col(name).isNull() for name in self.partition])
        named = stored.join(touched, self.partition, "left_semi")
        return named.unionByName(_same_rows(stored.where(blank), touched.where(blank), self.partition, "left_semi"))

    def upsert(self, rows: DataFrame, version: list[str], token: str) -> None:
        """Merge ``rows``; ``token`` names the batch (same token, same staging folder)."""
        self.schema = self.schema or rows.schema
        rows = rows.withColumns(self.derived)
        fresh = last_per_key(rows, self.key, version)
        if not _exists(self.spark, self.path):
            self._write(fresh, self.path, "overwrite")
            return
        staging = f"{self.path}.staging/{token}"
        new, merged = f"{staging}/new", f"{staging}/merged"
        if not committed(self.spark, merged):
            fresh.write.mode("overwrite").parquet(new)
            fresh = self.spark.read.schema(rows.schema).parquet(new)
            old = _same_rows(self._touched(fresh).select(*rows.columns), fresh, self.key, "left_anti")
            old.unionByName(fresh).write.mode("overwrite").parquet(merged)
        self._write(self.spark.read.schema(rows.schema).parquet(merged), self.path, "overwrite")
        remove_folder(self.spark, staging)


def write_with_fallback(df: DataFrame, primary: Callable[[DataFrame], None], fallback: str) -> str:
    """Writes through ``primary``; if that fails the rows go to the ``fallback`` folder as parquet."""
    try:
        primary(df)
    except Exception:  # any connector error: the data must not be lost
        df.write.mode("overwrite").parquet(fallback)
        return "fallback"
    return "primary"


def wide_column_writer(table: str, keyspace: str) -> Callable[[DataFrame], None]:
    """Writer for a wide-column store through its Spark connector (needs the connector's jar)."""
    def write(df: DataFrame) -> None:
        (
            df.write.format("org.apache.spark.sql.cassandra").options(table=table, keyspace=keyspace)
            .mode("append").save()
        )
    return write
