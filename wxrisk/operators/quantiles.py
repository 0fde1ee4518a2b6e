"""Exact quantiles with linear interpolation, spread over the cluster.

The built-in exact percentile keeps every distinct value of a group in one task's memory. Here values are counted
first (equal values fold into one row), then dealt by range of (group, value); the totals of the ranges tell which
range holds each wanted rank, and only those ranges are sorted. The number of ranges grows with the distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk.operators.running import RANGE_ROWS, _starts, in_ranges


def group_quantiles(
    df: DataFrame,
    group: list[str],
    wanted: dict[str, tuple[str, float]],
    *,
    stage=None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per group with a column per entry ``name: (column, quantile)``; NULLs are skipped."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.lit(float(q)).alias("q"), F.col(column).cast("double").alias("v"))
        for name, (column, q) in wanted.items()
    ])
    keys = [*group, "metric"]
    counted = (
        df.select(*group, F.explode(pairs).alias("_p"))
        .select(*group, "_p.metric", "_p.q", "_p.v")
        .filter(F.col("v").isNotNull())
        .groupBy(*keys, "q", "v").agg(F.count("*").alias("n"))
    )
    cut, ranges = in_ranges(counted, keys, "v", stage=stage, range_rows=range_rows)
    pieces = [*keys, "_piece"]
    sums = {"n": ("sum", "n")}
    totals = cut.groupBy(*pieces, "q").agg(F.sum("n").alias("_all_n"))
    if ranges == 1:
        whole = totals.withColumns({"size": F.col("_all_n"), "_from_n": F.lit(0)})
    else:
        sizes = totals.groupBy(*keys).agg(F.sum("_all_n").alias("size"))
        whole = totals.join(_starts(totals.select(*pieces, "_all_n"), keys, sums), pieces).join(sizes, keys)
    placed = whole.select(
        *pieces, F.col("_all_n").alias("total"), F.coalesce("_from_n", F.lit(0)).alias("start"), ((F.col("size") - 1) * F.col("q")).alias("place"))
    holding = placed.filter(
        (F.col("start") <= F.ceil("place")) & (F.col("start") + F.col("total") - 1 >= F.floor("place"))
    ).select(*pieces, "start", "place")
    inside = W.partitionBy(*pieces).orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    around = cut.drop("q").join(holding, pieces).withColumn("upto", F.col("start") + F.sum("n").over(inside))
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    low, high = F.floor("place"), F.ceil("place")

    def value(name: str):
        def held(rank):
            return F.max(F.when((F.col("metric") == name) & (first <= rank) & (last >= rank), F.col("v")))

        part = F.max(F.when(F.col("metric") == name, F.col("place") - low))
        return (held(low) + (held(high) - held(low)) * part).alias(name)

    return around.groupBy(*group).agg(*[value(name) for name in wanted])
