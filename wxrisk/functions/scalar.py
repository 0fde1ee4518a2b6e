"""Small column builders: ladders, fall-backs, stable rounding, replay-safe ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ladder(value: Column, steps: Iterable[tuple], rest, *, strict: bool = False) -> Column:
    """First step whose bound is reached (``>=``) or passed (``>`` when strict), else ``rest``.

    ``steps`` lists (bound, result), highest bound first; a NULL value gives ``rest``.
    """
    chain = None
    for bound, result in steps:
        hit = value > F.lit(bound) if strict else value >= F.lit(bound)
        result = result if isinstance(result, Column) else F.lit(result)
        chain = F.when(hit, result) if chain is None else chain.when(hit, result)
    return chain.otherwise(rest if isinstance(rest, Column) else F.lit(rest))


def or_else(value: Column, fallback) -> Column:
    """``value`` unless it is NULL or zero: zero counts as missing here."""
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(value.isNull() | (value == 0), fallback).otherwise(value)


def zero_as_null(value: Column) -> Column:
    return F.when(value != 0, value)


def holds(condition: Column) -> Column:
    """A comparison where a missing operand means "no" rather than NULL."""
    return F.coalesce(condition, F.lit(False))


def clamp01(value: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def steady(value: Column, digits: int, guard: int = 6) -> Column:
    """Round twice, so that the order of a floating-point sum cannot tip the last digit."""
    return F.round(F.round(value, digits + guard), digits)


def pick(df: DataFrame, *names: str, default=None) -> Column:
    """The first of ``names`` that ``df`` has and that is not NULL, else ``default``."""
    found = [F.col(n) for n in names if n in df.columns]
    if default is not None:
        found.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*found) if found else F.lit(None)


def stable_id(*parts) -> Column:
    """An id derived from the row's key: the same row gets the same id when it is replayed."""
    return F.sha2(F.concat_ws("\u001f", *[F.col(p) if isinstance(p, str) else p for p in parts]), 256)


def wave(angle_fn, index: Column, period: float, pi: Column) -> Column:
    return angle_fn(F.lit(2.0) * pi * index / F.lit(float(period)))


def short_time(epoch_seconds: Column, missing: str) -> Column:
    """HH:mm of an epoch value; zero or NULL gives ``missing``."""
    shown = F.date_format(F.timestamp_seconds(epoch_seconds), "HH:mm")
    return F.when(holds(epoch_seconds != 0), shown).otherwise(F.lit(missing))


def parsed_once(value: Column, name: str) -> Column:
    """A select item that is computed once per row, however its parts are used later.

    The optimizer copies an ordinary expression into every filter that uses it;
    for a JSON parse that means one more parse per use. It does not copy a
    generator's output.
    """
    return F.explode(F.array(value)).alias(name)
