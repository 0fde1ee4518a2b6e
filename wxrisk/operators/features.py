"""Rolling, lag, wetness-index, seasonal and anomaly features of a daily history."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.scalar import wave
from wxrisk.operators.series import BLOCK, BLOCK_ROWS, COPY, POSITION, Blocks, in_blocks
from wxrisk.session import unstaged

# How many rows the lags and rolling frames look back.
LOOK_BACK = max(*K.LAG_DAYS, 6)
# exp(-750) is zero in a double, exp(600) does not overflow it.
ZERO_AT, LARGEST = 750, 600
BLOCKS_PER_PIECE = 4096
_UNIT, _ENDS, _CARRIED = "_unit", "_unit_end", "_unit_carried"


def add_season(df: DataFrame, date: str = "Date") -> DataFrame:
    """Day of year, its sine and cosine over a Julian year, year and month."""
    day = F.dayofyear(date)
    return df.withColumns({
        "doy": day,
        "doy_sin": wave(F.sin, day, K.DAYS_JULIAN_YEAR, F.pi()),
        "doy_cos": wave(F.cos, day, K.DAYS_JULIAN_YEAR, F.pi()),
        "year": F.year(date),
        "month": F.month(date),
    })


def rolling(blocks: Blocks, rain: str = "precip") -> Blocks:
    """3- and 7-day rain (missing days skipped), 3-day mean temperature, 3-day peak range."""
    return blocks.with_columns({
        f"{rain}_3d": F.sum("Precip").over(blocks.frame(-2)),
        f"{rain}_7d": F.sum("Precip").over(blocks.frame(-6)),
        "maxT_3d_mean": F.avg("MaxTemp_2m").over(blocks.frame(-2)),
        "temp_range_3d_max": F.max("TempRange_2m").over(blocks.frame(-2)),
    })


def lags(blocks: Blocks, days=K.LAG_DAYS) -> Blocks:
    window = blocks.ordered()
    columns = {}
    for k in days:
        columns[f"precip_lag_{k}"] = F.lag("Precip", k).over(window)
        columns[f"maxT_lag_{k}"] = F.lag("MaxTemp_2m", k).over(window)
    return blocks.with_columns(columns)


def _unit_rows(block_rows: int, decay: float) -> int:
    """Rows of a stretch of a block over which the inverse powers of ``decay`` stay finite; divides the block."""
    most = max(1, min(block_rows, int(LARGEST / -math.log(decay))))
    return next(n for n in range(most, 0, -1) if block_rows % n == 0)


def wetness_in_units(blocks: Blocks, block_rows: int = BLOCK_ROWS, decay: float = K.WETNESS_DECAY,
                     name: str = "API") -> Blocks:
    """The wetness index as if the series began with each unit (a block, or an even part of one).

    Unrolled, the index is a sum of past rain times powers of ``decay``. Scaling
    each day by the inverse power turns it into one running sum per unit, which
    costs the same per row however long the memory is.
    """
    rows = _unit_rows(block_rows, decay)
    unit = F.floor(F.col(POSITION) / rows)
    scale = F.pow(F.lit(1.0 / decay), F.col(POSITION) - unit * rows)
    day = F.when(~F.col(COPY), F.coalesce(F.col("Precip"), F.lit(0.0)) * scale)
    groups = blocks.keys if rows == block_rows else [*blocks.keys, unit]
    so_far = W.partitionBy(*groups).orderBy(POSITION).rowsBetween(W.unboundedPreceding, 0)
    return blocks.with_columns({name: F.sum(day).over(so_far) / scale})


def wetness_across(blocks: Blocks, block_rows: int = BLOCK_ROWS, decay: float = K.WETNESS_DECAY,
                   name: str = "API", stage=unstaged) -> Blocks:
    """Adds to :func:`wetness_in_units` what earlier units leave behind. Overlap copies go.

    The value at the end of each unit goes through a table with one row per unit. A unit
    reads as many earlier ones as it takes until their weight is zero in a double. The rows are
    read twice, for the ends and for the result; ``stage`` has them computed once.
    """
    rows, key = _unit_rows(block_rows, decay), blocks.key
    reach = math.ceil(ZERO_AT / (rows * -math.log(decay))) + 1
    piece = max(BLOCKS_PER_PIECE, reach)
    own = stage(blocks.own_rows().df.withColumn(_UNIT, F.floor(F.col(POSITION) / rows)), "in-units")
    ends = own.where(F.col(key).isNotNull()).groupBy(key, BLOCK, _UNIT).agg(F.max_by(name, POSITION).alias(_ENDS))
    home = F.floor(F.col(_UNIT) / piece)
    spread = ends.select("*", F.explode(F.sequence(home, F.floor((F.col(_UNIT) + reach) / piece))).alias("_piece"))
    earlier = F.collect_list(_ENDS).over(W.partitionBy(key, "_piece").orderBy(_UNIT).rowsBetween(-reach, -1))
    carried = F.aggregate(earlier, F.lit(0.0), lambda total, end: total * decay**rows + end)
    starts = spread.withColumn(_CARRIED, carried).where(F.col("_piece") == home).drop("_piece", _ENDS)
    weight = F.pow(F.lit(decay), F.col(POSITION) - F.col(_UNIT) * rows + 1)
    joined = own.join(starts, [key, BLOCK, _UNIT], "left").withColumn(
        name, F.col(name) + weight * F.coalesce(_CARRIED, F.lit(0.0)))
    return blocks.over(joined.drop(_UNIT, _CARRIED))


def wetness_index(blocks: Blocks, block_rows: int = BLOCK_ROWS, decay: float = K.WETNESS_DECAY,
                  name: str = "API", stage=unstaged) -> Blocks:
    """Antecedent precipitation: today's rain plus ``decay`` (between 0 and 1) times yesterday's index."""
    return wetness_across(wetness_in_units(blocks, block_rows, decay, name), block_rows, decay, name, stage)


def look_back(blocks: Blocks, block_rows: int = BLOCK_ROWS, rain: str = "precip") -> Blocks:
    """All look-back features on blocks with an overlap of ``LOOK_BACK``; the index still lacks earlier units."""
    return wetness_in_units(lags(rolling(blocks, rain)), block_rows)


def rolling_features(df: DataFrame, *, key: str = "District", date: str = "Date",
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All look-back features from one partitioning of the history."""
    blocks = in_blocks(df, key, date, LOOK_BACK, block_rows=block_rows)
    return wetness_across(look_back(blocks, block_rows), block_rows).plain()


def climatology(df: DataFrame, key: str = "District", date: str = "Date") -> DataFrame:
    """Median maximum temperature and rain per district and day of year.

    Equal values are counted first, map-side, and the median is taken of the counted values: a day of year
    with very many rows is as long as its distinct values.
    """
    both = F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(column).cast("double").alias("v"))
        for name, column in (("t", "MaxTemp_2m"), ("p", "Precip"))])).alias("_m")
    counted = df.select(key, F.dayofyear(date).alias("doy"), both).groupBy(key, "doy", "_m.metric", "_m.v").agg(F.count("*").alias("n"))

    def median(metric: str):
        held = F.col("metric") == metric
        return F.percentile(F.when(held, F.col("v")), F.lit(0.5), F.when(held, F.col("n")).otherwise(0))

    return counted.groupBy(key, "doy").agg(median("t").alias("clim_maxT"), median("p").alias("clim_precip"))


def add_anomalies(df: DataFrame, normal: DataFrame | None = None, key: str = "District",
                  date: str = "Date") -> DataFrame:
    """Departure of temperature and rain from the day-of-year median.

    ``normal`` has the medians; without one they are those of the rows themselves. They are a row per district and
    day of year, so the join is a small one. Rows without a district or date have no median.
    """
    normal = climatology(df, key, date) if normal is None else normal
    joined = df.withColumn("doy", F.dayofyear(date)).join(normal, [key, "doy"], "left")
    return joined.withColumns({
        "anom_maxT": F.col("MaxTemp_2m") - F.col("clim_maxT"),
        "anom_precip": F.col("Precip") - F.col("clim_precip"),
    })


def keep_features(df: DataFrame, names=K.FEATURE_COLUMNS) -> DataFrame:
    """The feature columns that ``df`` has, in table order."""
    return df.select(*[n for n in names if n in df.columns])


def build_features(df: DataFrame, *, normal: DataFrame | None = None,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Labelled daily history to the feature table."""
    # The labels' own 3- and 7-day sums are replaced by the feature definition.
    df = df.drop("precip_3d", "precip_7d")
    looked_back = rolling_features(df, block_rows=block_rows)
    return keep_features(add_anomalies(add_season(looked_back), normal))
