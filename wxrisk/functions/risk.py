"""Rule scores and risk labels as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions.scalar import clamp01, ladder


def heat_score_linear(temp: Column) -> Column:
    """0 at 35 degrees, 1 at 50."""
    return clamp01((temp - 35) / 15)


def flood_score_linear(precip: Column, humidity: Column | None = None) -> Column:
    """0 at 50 mm, 1 at 150; humidity above 80 adds to it where it is given."""
    score = (precip - 50) / 100
    return clamp01(score if humidity is None else score + (humidity - 80) / 100)


def heat_score_steps(temp: Column) -> Column:
    """Three joined slopes with steps at 35 and 40 degrees."""
    mild = F.greatest(F.lit(0.0), (temp - 30) / 20)
    warm = F.least(F.lit(1.0), F.lit(0.3) + (temp - 35) / 10)
    hot = F.least(F.lit(1.0), F.lit(0.7) + (temp - 40) / 20)
    return ladder(temp, ((40, hot), (35, warm)), mild, strict=True)


def flood_score_steps(precip: Column, humidity: Column) -> Column:
    """A level by rain plus a supplement by humidity, at most 1."""
    level = ladder(precip, ((100, 0.8), (50, 0.5), (20, 0.3)), 0.0, strict=True)
    supplement = ladder(humidity, ((90, 0.2), (80, 0.1)), 0.0, strict=True)
    return F.least(F.lit(1.0), level + supplement)


def label_above(prob: Column) -> Column:
    """HIGH above 0.5, MEDIUM above 0.3, else LOW."""
    return ladder(prob, K.RISK_ABOVE, "LOW", strict=True)


def label_from(prob: Column) -> Column:
    """HIGH from 0.7, MEDIUM from 0.4, else LOW."""
    return ladder(prob, K.RISK_FROM, "LOW")


def label_five(prob: Column) -> Column:
    """Five levels as a struct (level, advice)."""
    def entry(pair):
        return F.struct(F.lit(pair[0]).alias("level"), F.lit(pair[1]).alias("advice"))

    return ladder(prob, [(b, entry(p)) for b, p in K.RISK_FIVE], entry(K.RISK_FIVE_REST))


def decide(prob: Column, threshold: float = 0.5) -> Column:
    return (prob >= F.lit(threshold)).cast("int")


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))
