"""Fixed-length look-back sequences for the sequence classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.scalar import holds
from wxrisk.operators.series import BLOCK_ROWS, POSITION, in_blocks


def sequence_inputs(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in K.SEQUENCE_NOT_INPUTS]


def finite(value: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    number = value.cast("double")
    bad = number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(bad, F.lit(0.0)).otherwise(number)


def finite_inputs(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: finite(F.col(n)) for n in names})


def _sequences(df: DataFrame, inputs: list[str], steps: int, end: int, keep: list[str],
               key: str, date: str, block_rows: int) -> DataFrame:
    rows = df.select(key, date, *keep, F.array(*[finite(F.col(c)) for c in inputs]).alias("_step"))
    blocks = in_blocks(rows, key, date, steps, block_rows=block_rows)
    frame = blocks.frame(end - steps + 1, end)
    taken = blocks.with_columns({"sequence": F.collect_list("_step").over(frame)}).own_rows().df
    whole = taken.filter(F.col(POSITION) >= steps - 1 - end)
    return whole.select(key, date, *keep, "sequence")


def training_sequences(df: DataFrame, target: str = "heatwave", steps: int = K.TIMESTEPS, *,
                       inputs: list[str] | None = None, key: str = "District", date: str = "Date",
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``steps`` days before each day, with that day's label; the day itself is not in it."""
    inputs = inputs or sequence_inputs(df)
    label = holds(F.col(target)).cast("int").alias("label")
    named = df.select("*", label)
    return _sequences(named, inputs, steps, -1, ["label"], key, date, block_rows)


def scoring_sequences(df: DataFrame, steps: int = K.TIMESTEPS, *, inputs: list[str] | None = None,
                      key: str = "District", date: str = "Date", keep=(),
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``steps`` days that end with each day: the scored day is the last one."""
    return _sequences(df, inputs or sequence_inputs(df), steps, 0, list(keep), key, date, block_rows)
