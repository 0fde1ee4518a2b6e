"""Cutting a stored history into the batches a live feed would have delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk.operators.running import running
from wxrisk.operators.series import POSITION, in_blocks, with_position


def block_batches(df: DataFrame, size: int = 10, *, key: str = "District", order: str = "Date") -> DataFrame:
    """Adds ``batch`` (from 1): the k-th ``size`` rows of every district form batch k."""
    placed = with_position(df, key, order)
    return placed.withColumn("batch", F.floor(F.col(POSITION) / size) + 1).drop(POSITION)


def step_batches(df: DataFrame, *, key: str = "District", order: str = "Date") -> DataFrame:
    """Adds ``batch`` (from 1): one row per district and step."""
    return block_batches(df, 1, key=key, order=order)


def round_robin_batches(df: DataFrame, size: int = 10, *, key: str = "District", order: str = "Date",
                        name: str = "batch") -> DataFrame:
    """Adds ``sequence`` (from 0) and ``batch`` (from 1) of a round-robin feed over the districts.

    A row's place is the number of rows in earlier rounds plus its rank in its
    own round. The rounds are counted first, so no task sorts the whole table.
    """
    placed = with_position(df, key, order)
    rounds = placed.groupBy(POSITION).agg(F.count("*").alias("_in_round"))
    piece = F.floor(F.col(POSITION) / 65536)
    before = running(rounds, [], POSITION, {"_before": ("sum", "_in_round")}, before=True, piece=piece)
    rank = F.row_number().over(W.partitionBy(POSITION).orderBy(key))
    return (
        placed.withColumn("_rank", rank).join(before.select(POSITION, "_before"), POSITION)
        .withColumn("sequence", F.col("_before") + F.col("_rank") - 1)
        .withColumn(name, F.floor(F.col("sequence") / size) + 1)
        .drop(POSITION, "_rank", "_before")
    )


def row_range(df: DataFrame, start: int, end: int, *, key: str, order: str) -> DataFrame:
    """Rows ``start`` to ``end`` (not included) of the table sorted by (key, order).

    Stands for "the first ``end`` rows without the first ``start``" in one pass.
    """
    blocks = in_blocks(df, key, order, 0)
    sizes = df.groupBy(key).agg(F.count("*").alias("_size"))
    offsets = running(sizes, [], key, {"_offset": ("sum", "_size")}, before=True).select(key, "_offset")
    place = F.col("_offset") + F.col(POSITION)
    placed = blocks.attach(offsets)
    return placed.over(placed.df.filter((place >= start) & (place < end)).drop("_offset")).plain()


def prefix_difference(df: DataFrame, start: int, end: int, *order: str, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of the first ``end`` rows minus those of the first ``start`` as a set: duplicates vanish."""
    ordered, names = df.orderBy(*order), columns or df.columns
    return ordered.limit(end).select(*names).subtract(ordered.limit(start).select(*names))
