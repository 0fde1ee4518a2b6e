"""Row windows over a time series whose key may hold a large part of all rows.

A window partitioned by district alone puts a whole district into one task.
Here each row first gets its position in the series, the series is cut into
blocks of ``block_rows`` rows, and the last ``overlap`` rows of a block are
copied in front of the next one. Frames that look back at most ``overlap`` rows
then give the same result inside a block as over the whole series, and a hot
district is spread over many tasks. Rows without a district belong to no series:
they are kept, each as a group of its own, and look back at nothing but themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk.session import unstaged

BLOCK_ROWS = 2048
POSITION = "_position"
BLOCK = "_block"
COPY = "_copy"
_SLOT = "_slot"
# Beyond every calendar number. Rows without a date are dealt to this many slots by hash.
UNDATED = 1 << 40
UNDATED_SLOTS = 1 << 16


def _slot_sizes(df: DataFrame, key: str, slot: Column) -> DataFrame:
    return df.groupBy(key, slot.alias(_SLOT)).agg(F.count("*").alias("_rows"))


def _slot(df: DataFrame, order: str, slot: Column | None) -> Column:
    undated = F.lit(UNDATED) + F.pmod(F.xxhash64(*df.columns), F.lit(UNDATED_SLOTS))
    return F.coalesce((F.year(order) if slot is None else slot).cast("long"), undated)


def with_position(
    df: DataFrame, key: str, order: str, *, slot: Column | None = None, name: str = POSITION
) -> DataFrame:
    """Adds the 0-based position of each row in its series.

    ``slot`` is a coarse calendar number that rises with ``order`` (default: its
    year). Rows are numbered inside a slot and shifted by the number of rows in
    earlier slots, so no task sorts more than one slot of one series. A daily
    history has one row per district and day, at most 366 in a year; a denser
    series needs a finer slot. Rows with equal ``order`` are told apart by a
    hash of the whole row, rows without a date come last, in slots drawn by hash.
    Rows without a key get no position; they never meet in a task.
    """
    keyed = df.where(F.col(key).isNotNull())
    placed = _placed(keyed, key, order, _slot(df, order, slot), name)
    return placed.unionByName(df.where(F.col(key).isNull()).withColumn(name, F.lit(None).cast("long")))


def _placed(keyed: DataFrame, key: str, order: str, slot: Column, name: str) -> DataFrame:
    inside = W.partitionBy(key, _SLOT).orderBy(F.asc_nulls_last(order), F.xxhash64(*keyed.columns))
    earlier = W.partitionBy(key).orderBy(_SLOT).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    starts = _slot_sizes(keyed, key, slot).select(key, _SLOT, start)
    numbered = keyed.withColumn(_SLOT, slot).withColumn("_place", F.row_number().over(inside))
    return (
        numbered.join(starts, [key, _SLOT], "left")
        .withColumn(name, (F.col("_start") + F.col("_place") - 1).cast("long"))
        .drop(_SLOT, "_place", "_start")
    )


@dataclass(frozen=True)
class Blocks:
    """A series cut into overlapping blocks; ``df`` has ``_position``, ``_block`` and ``_copy``.

    ``layout`` lists every (series, block), made from row counts alone.
    """

    df: DataFrame
    key: str
    layout: DataFrame

    @property
    def keys(self) -> list[str]:
        return [self.key, BLOCK]

    def frame(self, start: int, end: int = 0):
        """A row frame; it may look back at most the overlap."""
        return self.ordered().rowsBetween(start, end)

    def ordered(self):
        return W.partitionBy(*self.keys).orderBy(POSITION)

    def so_far(self):
        return self.ordered().rowsBetween(W.unboundedPreceding, 0)

    def with_columns(self, columns: dict[str, Column]) -> "Blocks":
        return self.over(self.df.withColumns(columns))

    def own_rows(self) -> "Blocks":
        """Without the overlap copies: every input row exactly once."""
        return self.over(self.df.filter(~F.col(COPY)))

    def over(self, df: DataFrame) -> "Blocks":
        """The same blocks over other rows or columns."""
        return replace(self, df=df)

    def attach(self, per_series: DataFrame, stage=unstaged) -> "Blocks":
        """Joins one-row-per-series values on (series, block), the rows' own partitioning.

        The per-series table is first spread over that series' blocks, so a hot
        series is never gathered for the join.
        """
        spread = stage(self.layout.join(per_series, self.key, "left"), "per-block")
        return self.over(self.own_rows().df.join(spread, self.keys, "left"))

    def plain(self) -> DataFrame:
        return self.own_rows().df.drop(POSITION, BLOCK, COPY)


def in_blocks(
    df: DataFrame, key: str, order: str, overlap: int, *, block_rows: int = BLOCK_ROWS,
    slot: Column | None = None,
) -> Blocks:
    keyed, number = df.where(F.col(key).isNotNull()), _slot(df, order, slot)
    positioned = _placed(keyed, key, order, number, POSITION)
    home = F.floor(F.col(POSITION) / block_rows)
    last = F.floor((F.col(POSITION) + overlap) / block_rows)
    spread = (
        positioned.withColumn("_home", home)
        .select("*", F.explode(F.sequence(home, last)).alias(BLOCK))
        .withColumn(COPY, F.col(BLOCK) != F.col("_home"))
        .drop("_home")
    )
    # A keyless row is a block of its own, named by its hash.
    alone = df.where(F.col(key).isNull()).withColumns({
        POSITION: F.lit(None).cast("long"), BLOCK: -1 - F.abs(F.shiftright(F.xxhash64(*df.columns), 1)), COPY: F.lit(False)})
    # The sizes are those that the positions are made of: one count serves both.
    rows = F.sum("_rows")
    layout = _slot_sizes(keyed, key, number).groupBy(key).agg(F.floor((rows - 1) / block_rows).alias("_end")).select(
        key, F.explode(F.sequence(F.lit(0).cast("long"), "_end")).alias(BLOCK)
    )
    return Blocks(spread.unionByName(alone), key, layout)
