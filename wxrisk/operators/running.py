"""Running totals over one long ordered series, without sorting it in one task.

A plain window with no (or a hot) partition key sorts the whole group in a single task. Here rows are dealt by
range of (group, order), so a task holds neighbours and a hot group is many tasks; the number of ranges grows with
the rows. The dealt table is stored with its range number: each range is summed where it lies, the totals, a row
per group and range, are accumulated in two levels, and every row adds its range's start value to its place inside
the range. Where the order is a number with a natural width (a position, a block number) the caller gives the range itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk.session import TableStages, unstaged

#: Rows of a range, on average, and ranges whose totals one task accumulates.
RANGE_ROWS = 1 << 18
LEVEL = 1 << 10


def _combine(kind: str, start: Column, inside: Column) -> Column:
    if kind == "sum":
        return F.coalesce(start, F.lit(0)) + F.coalesce(inside, F.lit(0))
    return F.greatest(start, inside) if kind == "max" else F.least(start, inside)


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def in_ranges(df: DataFrame, group: list[str], order: str, *, stage=None, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, int]:
    """(``df`` stored with ``_piece``, which rises along (group, order); number of ranges).

    The table is dealt by range, so equal (group, order) lie in one range and a range has about ``range_rows`` rows.
    It is always stored, by ``stage`` or below the shared folder, so later steps and repeated tasks see the same ranges.
    """
    if stage in (None, unstaged):
        stage = TableStages(df.sparkSession, "running")
    stored = stage(df, "to-range")
    ranges = max(1, -(-stored.count() // range_rows))
    if ranges == 1:
        return stored.withColumn("_piece", F.lit(0)), 1
    dealt = stored.repartitionByRange(ranges, *group, order)
    return stage(dealt.withColumn("_piece", F.spark_partition_id()), "in-ranges"), ranges


def running(
    df: DataFrame,
    group: list[str],
    order: str,
    totals: dict[str, tuple[str, str]],
    *,
    before: bool = False,
    piece: Column | None = None,
    range_rows: int = RANGE_ROWS,
    stage=None,
) -> DataFrame:
    """Adds, per entry ``name: (kind, column)``, the running value up to and with each row.

    With ``before`` the row itself is left out. ``kind`` is "sum", "max" or "min". ``piece`` may give a number
    that rises with ``order``; otherwise rows are stored by range below the shared folder (or by ``stage``). Rows must be
    unique per (group, order): aggregate equal order values first, which also folds a value that a third of all
    rows share into one row.
    """
    if piece is None:
        cut, ranges = in_ranges(df, group, order, stage=stage, range_rows=range_rows)
    else:
        cut, ranges = df.withColumn("_piece", piece), None
    keys = [*group, "_piece"]
    if ranges == 1:
        upto = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
        alone = {n: _combine(k, F.lit(None), _AGG[k](c).over(upto)) for n, (k, c) in totals.items()}
        return cut.withColumns(alone).drop("_piece")
    whole = cut.groupBy(*keys).agg(*[_AGG[k](c).alias(f"_all_{n}") for n, (k, c) in totals.items()])
    starts = _starts(whole, group, totals)
    upto = W.partitionBy(*keys).orderBy(order).rowsBetween(
        W.unboundedPreceding, -1 if before else 0
    )
    inside = {f"_in_{n}": _AGG[k](c).over(upto) for n, (k, c) in totals.items()}
    joined = cut.withColumns(inside).join(starts, keys, "left")
    added = {n: _combine(k, F.col(f"_from_{n}"), F.col(f"_in_{n}")) for n, (k, _) in totals.items()}
    spare = ["_piece", *inside, *[f"_from_{n}" for n in totals]]
    return joined.withColumns(added).drop(*spare)


def _starts(whole: DataFrame, group: list[str], totals: dict[str, tuple[str, str]]) -> DataFrame:
    """Per group and range what all earlier ranges hold, added up by LEVEL ranges first and then over these."""
    levelled = whole.withColumn("_level", F.floor(F.col("_piece") / LEVEL))
    upper = levelled.groupBy(*group, "_level").agg(*[_AGG[k](f"_all_{n}").alias(f"_all_{n}") for n, (k, _) in totals.items()])
    above = W.partitionBy(*group).orderBy("_level").rowsBetween(W.unboundedPreceding, -1)
    upper = upper.select(*group, "_level", *[_AGG[k](f"_all_{n}").over(above).alias(f"_up_{n}") for n, (k, _) in totals.items()])
    earlier = W.partitionBy(*group, "_level").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    lower = levelled.select(*group, "_level", "_piece", *[_AGG[k](f"_all_{n}").over(earlier).alias(f"_low_{n}") for n, (k, _) in totals.items()])

    def joined(kind: str, name: str) -> Column:
        up, low = F.col(f"_up_{name}"), F.col(f"_low_{name}")
        return F.when(up.isNull(), low).when(low.isNull(), up).otherwise(_combine(kind, up, low)).alias(f"_from_{name}")

    return lower.join(upper, [*group, "_level"]).select(*group, "_piece", *[joined(k, n) for n, (k, _) in totals.items()])
