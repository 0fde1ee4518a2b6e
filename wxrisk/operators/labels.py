"""Heat-spell and flood-proxy labels over long daily histories.

Order of work: per-row windows inside blocks, thresholds per district, then the
comparisons. What must travel from block to block (the last known humidity, the
last day a spell was broken) goes through a table with one row per block, which
is joined back on the key the rows are already partitioned by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.scalar import holds
from wxrisk.operators.quantiles import group_quantiles
from wxrisk.operators.running import running
from wxrisk.operators.series import BLOCK, BLOCK_ROWS, POSITION, Blocks, in_blocks
from wxrisk.session import unstaged

RAIN_OVERLAP = 6
BLOCKS_PER_PIECE = 4096

HEAT_LIMITS = {"heat_limit": ("MaxTemp_2m", K.HEAT_QUANTILE)}
FLOOD_LIMITS = {
    "precip_p99": ("precip_1d", K.RAIN_1D_QUANTILE),
    "precip3_p98": ("precip_3d", K.RAIN_3D_QUANTILE),
    "wet_limit": ("RH_2m_filled", K.WET_QUANTILE),
}


def _known_at(column: str, place: str) -> Column:
    """``place`` of the rows where ``column`` has a value; others are left out of min_by and max_by."""
    return F.when(F.col(column).isNotNull(), F.col(place))


def _carry(summary: DataFrame, key: str, column: str) -> DataFrame:
    """Per block: the newest non-NULL ``column`` of earlier blocks of the same series."""
    stamped = summary.where(F.col(key).isNotNull()).withColumn("_mark", F.when(F.col(column).isNotNull(), F.struct(BLOCK, column)))
    piece = F.floor(F.col(BLOCK) / BLOCKS_PER_PIECE)
    carried = running(stamped, [key], BLOCK, {"_seen": ("max", "_mark")}, before=True, piece=piece)
    return carried.select(key, BLOCK, F.col("_seen")[column].alias("_carried"))


def rain_windows(blocks: Blocks, precip: str = "Precip") -> Blocks:
    """Daily, 3-day and 7-day rain with missing days counted as dry."""
    day = F.coalesce(F.col(precip), F.lit(0.0))
    blocks = blocks.with_columns({"precip_1d": day})
    return blocks.with_columns({
        "precip_3d": F.sum("precip_1d").over(blocks.frame(-2)),
        "precip_7d": F.sum("precip_1d").over(blocks.frame(-6)),
    })


def known_humidity(blocks: Blocks, column: str = "RH_2m") -> Blocks:
    """Adds ``_known``: the last value up to and with each day, as far as its block reaches back."""
    return blocks.with_columns({"_known": F.last(column, ignorenulls=True).over(blocks.so_far())})


def fill_humidity(blocks: Blocks, column: str = "RH_2m", name: str = "RH_2m_filled",
                  scope: str = "table", stage=unstaged) -> Blocks:
    """Forward fill, then backward fill; needs ``_known``.

    With ``scope="table"`` the fill runs over the table sorted by district and
    date, so the first gap of a district takes the last value of the district
    before it. With ``scope="district"`` it stays inside each district.
    """
    key, rows = blocks.key, blocks.own_rows().df
    summary = rows.groupBy(*blocks.keys).agg(
        F.max_by(column, _known_at(column, POSITION)).alias("_tail"),
        F.min_by(column, _known_at(column, POSITION)).alias("_head"),
    )
    per_series = summary.groupBy(key).agg(
        F.max_by("_tail", _known_at("_tail", BLOCK)).alias("_tail"),
        F.min_by("_head", _known_at("_head", BLOCK)).alias("_head"),
    )
    if scope == "district":
        edges = per_series.select(key, F.col("_head").alias("_edge"))
    else:
        first = F.min(F.when(F.col("_head").isNotNull(), F.struct(key, "_head")))["_head"]
        mark = F.when(F.col("_tail").isNotNull(), F.struct(key, "_tail"))
        marked = per_series.select(key, mark.alias("_mark"))
        edges = running(marked, [], key, {"_seen": ("max", "_mark")}, before=True).select(
            key, F.coalesce(F.col("_seen")["_tail"], per_series.agg(first).scalar()).alias("_edge")
        )
    starts = _carry(summary, key, "_tail").join(edges, key, "left").select(
        *blocks.keys, F.coalesce("_carried", "_edge").alias("_start")
    )
    starts = stage(starts, "humidity-starts")
    filled = rows.join(starts, blocks.keys, "left").withColumn(name, F.coalesce("_known", "_start"))
    return blocks.over(filled.drop("_known", "_start"))


def heat_thresholds(df: DataFrame, key: str = "District", **how) -> DataFrame:
    return group_quantiles(df, [key], HEAT_LIMITS, **how)


def flood_thresholds(inputs: DataFrame, key: str = "District", **how) -> DataFrame:
    """Per district: limits of daily and 3-day rain and of filled humidity."""
    return group_quantiles(inputs, [key], FLOOD_LIMITS, **how)


def run_length(blocks: Blocks, condition: Column, name: str, stage=unstaged) -> Blocks:
    """Days in a row up to and with each day on which ``condition`` holds, 0 where it does not.

    A run is the distance to the last day that broke it; for a run that began in
    an earlier block that day comes from the block table.
    """
    broken = F.when(~holds(condition), F.col(POSITION))
    rows = blocks.own_rows().with_columns({"_broken": broken})
    summary = rows.df.groupBy(*blocks.keys).agg(F.max("_broken").alias("_broken_at"))
    starts = stage(_carry(summary, blocks.key, "_broken_at"), "run-starts")
    rows = rows.with_columns({"_last": F.max("_broken").over(rows.so_far())})
    joined = rows.df.join(starts, blocks.keys, "left")
    since = F.coalesce("_last", "_carried", F.lit(-1))
    counted = joined.withColumn(name, (F.col(POSITION) - since).cast("long"))
    return blocks.over(counted.drop("_broken", "_last", "_carried"))


def heat_flags(blocks: Blocks, min_run: int = K.HEAT_MIN_RUN, stage=unstaged) -> Blocks:
    """``heat_exceed``, ``heat_run`` and ``heatwave`` (a run of ``min_run`` days or more); needs the limit."""
    over = holds(F.col("MaxTemp_2m") > F.col("heat_limit"))
    blocks = run_length(blocks.with_columns({"heat_exceed": over}), F.col("heat_exceed"), "heat_run", stage)
    return blocks.with_columns({"heatwave": F.col("heat_run") >= min_run})


def flood_flags(df: DataFrame) -> DataFrame:
    """``wetness_flag`` and ``flood_proxy``: heavy rain on an unusually humid day; needs the limits."""
    heavy = holds(F.col("precip_1d") > F.col("precip_p99")) | holds(F.col("precip_3d") > F.col("precip3_p98"))
    wet = holds(F.col("RH_2m_filled") > F.col("wet_limit"))
    return df.withColumns({"wetness_flag": wet, "flood_proxy": heavy & wet})


def label_heat(df: DataFrame, thresholds: DataFrame | None = None, *, key: str = "District", date: str = "Date",
               min_run: int = K.HEAT_MIN_RUN, block_rows: int = BLOCK_ROWS, stage=unstaged) -> DataFrame:
    limits = heat_thresholds(df, key, stage=stage) if thresholds is None else thresholds
    blocks = in_blocks(df, key, date, 0, block_rows=block_rows).attach(limits, stage)
    return heat_flags(blocks, min_run, stage).plain().drop("heat_limit")


def flood_blocks(df: DataFrame, *, key: str = "District", date: str = "Date", scope: str = "table",
                 overlap: int = RAIN_OVERLAP, more=lambda blocks: blocks, block_rows: int = BLOCK_ROWS,
                 stage=unstaged) -> Blocks:
    """1-, 3- and 7-day rain and filled humidity: all that the flood label needs.

    ``more`` may add further look-back columns to the same blocks, up to ``overlap`` rows.
    """
    blocks = in_blocks(df, key, date, overlap, block_rows=block_rows)
    blocks = known_humidity(rain_windows(more(blocks))).own_rows()
    return fill_humidity(blocks.over(stage(blocks.df, "windows")), scope=scope, stage=stage)


def label_flood(df: DataFrame, thresholds: DataFrame | None = None, *, key: str = "District",
                date: str = "Date", scope: str = "table", block_rows: int = BLOCK_ROWS,
                stage=unstaged) -> DataFrame:
    blocks = flood_blocks(df, key=key, date=date, scope=scope, block_rows=block_rows, stage=stage)
    limits = flood_thresholds(blocks.df, key, stage=stage) if thresholds is None else thresholds
    return flood_flags(blocks.attach(limits, stage).plain()).drop("wet_limit")


def both_flags(blocks: Blocks, *, fit_on: DataFrame | None = None, date: str = "Date",
               min_run: int = K.HEAT_MIN_RUN, stage=unstaged) -> DataFrame:
    """Both labels on blocks that have the flood inputs.

    Limits come from the whole history, or only from the (district, day) pairs
    of ``fit_on``, so that a later test period is not looked into.
    """
    seen = blocks.df
    if fit_on is not None:
        seen = seen.join(fit_on.select(blocks.key, date), [blocks.key, date], "left_semi")
    limits = group_quantiles(seen, [blocks.key], HEAT_LIMITS | FLOOD_LIMITS, stage=stage)
    flagged = blocks.attach(limits, stage)
    flagged = heat_flags(flagged.over(flood_flags(flagged.df)), min_run, stage)
    return flagged.plain().drop("heat_limit", "wet_limit")


def label_both(df: DataFrame, *, fit_on: DataFrame | None = None, key: str = "District", date: str = "Date",
               scope: str = "table", block_rows: int = BLOCK_ROWS, stage=unstaged) -> DataFrame:
    """Both labels over one partitioning of the history."""
    blocks = flood_blocks(df, key=key, date=date, scope=scope, block_rows=block_rows, stage=stage)
    return both_flags(blocks, fit_on=fit_on, date=date, stage=stage)
