"""Scores of single records and of small feature sets, as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions import risk
from wxrisk.functions.scalar import pick, stable_id, wave

RULES = {
    # name: (heat score, flood score) over temperature, rain, humidity
    "linear": (lambda t, p, h: risk.heat_score_linear(t), lambda t, p, h: risk.flood_score_linear(p, h)),
    "linear_dry": (lambda t, p, h: risk.heat_score_linear(t), lambda t, p, h: risk.flood_score_linear(p)),
    "steps": (lambda t, p, h: risk.heat_score_steps(t), lambda t, p, h: risk.flood_score_steps(p, h)),
}


def readings(df: DataFrame) -> tuple[Column, Column, Column]:
    """Temperature, rain and humidity under either spelling, with their stand-ins."""
    return (
        pick(df, "MaxTemp_2m", "temp_max", "max_temp", default=30.0),
        pick(df, "Precip", "precipitation", default=0.0),
        pick(df, "RH_2m", "humidity", default=50.0),
    )


def add_rule_scores(df: DataFrame, rules: str = "linear", label=risk.label_above) -> DataFrame:
    """Adds both probabilities and both risk labels. A projection: valid on a stream as well."""
    heat, flood = RULES[rules]
    values = readings(df)
    return df.withColumns({
        "heatwave_probability": heat(*values), "flood_probability": flood(*values),
    }).withColumns({
        "heatwave_risk": label(F.col("heatwave_probability")),
        "flood_risk": label(F.col("flood_probability")),
    })


def _no_history(temp: Column, precip: Column, humidity: Column) -> dict[str, Column]:
    """Feature values when only one day is known: sums are multiples, lags repeat the day."""
    same_rain = {f"precip_lag_{k}": precip for k in (1, 3, 7)}
    same_temp = {f"maxT_lag_{k}": temp for k in (1, 3)}
    return {
        "Precip": precip, "precip_3d": precip * 3, "precip_7d": precip * 7, **same_rain,
        "MaxTemp_2m": temp, "maxT_3d_mean": temp, **same_temp, "anom_maxT": temp - 30,
        "RH_2m": humidity, "wetness_flag": F.coalesce((humidity > 80).cast("int"), F.lit(0)),
    }


def _rest(df: DataFrame) -> dict[str, Column]:
    return {
        "TempRange_2m": pick(df, "TempRange_2m", "temp_range", default=10.0),
        "WindSpeed_10m": pick(df, "WindSpeed_10m", "wind_speed", default=5.0),
        "WindSpeed_50m": pick(df, "WindSpeed_50m", default=10.0),
    }


def _with(df: DataFrame, features: dict[str, Column], keep) -> DataFrame:
    return df.select(*keep, *[c.alias(n) for n, c in features.items() if n not in keep])


def record_features(df: DataFrame, clock: Column, *, season: bool = False, keep=()) -> DataFrame:
    """Model inputs of a record without history.

    ``clock`` gives month and year. The season columns are fixed at one half, or
    with ``season`` the day of year of ``clock`` over a 365-day year.
    """
    values = readings(df)
    temp, precip, _ = values
    day = F.dayofyear(clock)
    half = F.lit(0.5)
    features = {
        **_no_history(*values), "API": precip * 0.9, **_rest(df),
        "doy_sin": wave(F.sin, day, K.DAYS_COMMON_YEAR, F.pi()) if season else half,
        "doy_cos": wave(F.cos, day, K.DAYS_COMMON_YEAR, F.pi()) if season else half,
        "month": F.month(clock), "year": F.year(clock),
    }
    return _with(df, features, keep)


def form_features(df: DataFrame, *, month: Column, day_of_year: Column, rain_history: str | None = None,
                  temp_history: str | None = None, keep=()) -> DataFrame:
    """Model inputs of an entered record with optional history arrays, oldest first.

    Rain history counts from 7 values, temperature history from 3; otherwise the
    day itself stands for its past.
    """
    temp, precip, humidity = (F.col(c) for c in ("MaxTemp_2m", "Precip", "RH_2m"))
    alone = _no_history(temp, precip, humidity)
    features = dict(alone)

    def total(history: str, n: int) -> Column:
        return F.aggregate(F.slice(history, -n, n), F.lit(0.0), lambda s, v: s + v)

    def with_history(history: str, least: int, values: dict[str, Column]) -> None:
        enough = F.coalesce(F.size(history) >= least, F.lit(False))
        for name, value in values.items():
            features[name] = F.when(enough, value).otherwise(alone[name])

    if rain_history:
        with_history(rain_history, 7, {
            "precip_3d": total(rain_history, 3), "precip_7d": total(rain_history, 7),
            **{f"precip_lag_{k}": F.try_element_at(rain_history, F.lit(-k)) for k in (1, 3, 7)},
        })
    if temp_history:
        with_history(temp_history, 3, {
            "maxT_3d_mean": total(temp_history, 3) / 3,
            **{f"maxT_lag_{k}": F.try_element_at(temp_history, F.lit(-k)) for k in (1, 3)},
        })
    features.update({
        "API": precip * 1.5,
        **{c: F.col(c) for c in ("TempRange_2m", "WindSpeed_10m", "WindSpeed_50m")},
        "doy_sin": wave(F.sin, day_of_year, K.DAYS_JULIAN_YEAR, F.pi()),
        "doy_cos": wave(F.cos, day_of_year, K.DAYS_JULIAN_YEAR, F.pi()),
        "month": month, "year": F.lit(2025),
    })
    return _with(df, features, keep)


def prediction_rows(scored: DataFrame, time: Column, *key: str) -> DataFrame:
    """Scored observations to the stored prediction layout."""
    temp, precip, humidity = readings(scored)
    district = pick(scored, "District", "district", default="Unknown")
    return scored.select(
        stable_id(*(F.col(k).cast("string") for k in key)).alias("id"), district.alias("district"),
        time.alias("prediction_time"), temp.alias("max_temp"), precip.alias("precipitation"),
        humidity.alias("humidity"), "heatwave_probability", "flood_probability",
        "heatwave_risk", "flood_risk",
    )


def fallback_score(model_score: Column | None, rule_score: Column) -> Column:
    """The model's probability, or the rule's where there is no model or it gave none."""
    if model_score is None:
        return rule_score
    usable = F.when(~F.isnan(model_score), model_score)
    return F.coalesce(usable, rule_score)


def station_inputs(df: DataFrame) -> DataFrame:
    """The seven raw-weather inputs with their stand-ins."""
    return df.withColumns({
        name: pick(df, name, default=float(stand_in)).cast("double")
        for name, stand_in in K.STATION_INPUTS.items()
    })


def replay_inputs(df: DataFrame, least: int = 3) -> tuple[DataFrame, list[str]]:
    """The six replay inputs that exist, missing values as 0; with fewer than ``least`` none."""
    have = [c for c in K.REPLAY_INPUTS if c in df.columns]
    if len(have) < least:
        return df, []
    return df.fillna(0, have), have
