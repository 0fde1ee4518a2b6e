"""Ladders and rules just below, at and just above each bound, and for NULL."""

import pytest
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.functions import risk
from wxrisk.functions.scalar import ladder, or_else, stable_id, steady
from wxrisk.operators import alerts, cleaning


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def run(df, expression):
    rows = df.select("i", expression.alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


LADDERS = [
    (K.BATCH_HEAT_LEVELS, 0, False), (K.BATCH_FLOOD_LEVELS, 0, False), (K.BATCH_HUMIDITY_LEVELS, 0, False),
    (K.STREAM_HEAT_LEVELS, 0.0, True), (K.STREAM_HUMIDITY_LEVELS, "LOW", True),
    (K.RISK_ABOVE, "LOW", True), (K.RISK_FROM, "LOW", False),
    (K.TEMP_BANDS, "green", True), (K.PRECIP_BANDS, "white", True), (K.PROGRESS_BANDS, "green", True),
]


@pytest.mark.parametrize("steps,rest,strict", LADDERS)
def test_ladder_bounds(spark, steps, rest, strict):
    results = [r for _, r in steps] + [rest]
    values, expected = [None], [rest]
    for i, (bound, _) in enumerate(steps):
        values += [bound - 0.01, float(bound), bound + 0.01]
        expected += [results[i + 1], results[i + 1] if strict else results[i], results[i]]
    assert run(column(spark, values), ladder(F.col("x"), steps, rest, strict=strict)) == expected


def test_five_levels(spark):
    levels = run(column(spark, [0.8, 0.79, 0.6, 0.4, 0.2, 0.19]), risk.label_five(F.col("x"))["level"])
    assert levels == ["EXTREME RISK", "HIGH RISK", "HIGH RISK", "MODERATE RISK", "LOW RISK", "MINIMAL RISK"]


def test_rule_scores(spark):
    df = column(spark, [20.0, 30.0, 35.0, 36.0, 40.0, 41.0, 50.0, 70.0])
    assert run(df, F.round(risk.heat_score_linear(F.col("x")), 6)) == [
        0.0, 0.0, 0.0, 0.066667, 0.333333, 0.4, 1.0, 1.0]
    assert run(df, F.round(risk.heat_score_steps(F.col("x")), 6)) == [
        0.0, 0.0, 0.25, 0.4, 0.8, 0.75, 1.0, 1.0]
    rain = column(spark, [20.0, 21.0, 50.0, 51.0, 100.0, 101.0])
    assert run(rain, F.round(risk.flood_score_steps(F.col("x"), F.lit(85.0)), 6)) == [0.1, 0.4, 0.4, 0.6, 0.6, 0.9]
    assert run(rain, F.round(risk.flood_score_steps(F.col("x"), F.lit(95.0)), 6))[-1] == 1.0


@pytest.mark.parametrize("precip,temp,humidity,heat,flood", [
    (0.0, 45.0, 30.0, 10 / 15, 0.0), (150.0, 32.0, 90.0, 0.0, 1.0),
    (5.0, 40.0, 70.0, 5 / 15, 0.0), (200.0, 34.0, 95.0, 0.0, 1.0),
])
def test_worked_inputs(spark, precip, temp, humidity, heat, flood):
    df = spark.createDataFrame([(temp, precip, humidity)], "t double, p double, h double")
    row = df.select(risk.heat_score_linear(F.col("t")), risk.flood_score_linear(F.col("p"), F.col("h"))).first()
    assert row[0] == pytest.approx(heat) and row[1] == pytest.approx(flood)


def test_zero_counts_as_missing(spark):
    assert run(column(spark, [0.0, None, 3.0]), or_else(F.col("x"), 7.0)) == [7.0, 7.0, 3.0]


def test_steady_rounding_ignores_noise(spark):
    assert run(column(spark, [2.3449999999999998, 2.345, -2.345]), steady(F.col("x"), 2)) == [2.35, 2.35, -2.35]


def test_stable_id_repeats(spark):
    ids = run(column(spark, [1.0, 1.0, 2.0]), stable_id(F.col("x").cast("string")))
    assert ids[0] == ids[1] != ids[2]


def test_clean_every_branch(spark):
    rows = [(-50.0, 0, 800, -1.0, None, None), (60.1, 101, 1101, None, 2.0, 500), (None, None, None, 3.0, 0.0, None)]
    df = spark.createDataFrame(rows, "temp double, humidity int, pressure int, wind_speed double, rain_1h double, visibility int")
    assert [tuple(r) for r in cleaning.clean(df).collect()] == [
        (-50.0, 0, 800, 0.0, 0.0, 10000), (None, None, None, 0.0, 2.0, 500), (None, None, None, 3.0, 0.0, 10000)]


def test_heat_index_keeps_missing_humidity_when_hot(spark):
    df = spark.createDataFrame([(27.0, None), (26.9, None), (27.0, 50)], "temp double, humidity int")
    hot, cool, known = [r[0] for r in df.select(cleaning.heat_index_batch()).collect()]
    assert hot is None and cool == 26.9 and known == pytest.approx(-8.785 + 43.497 + 116.95 - 197.1)


def test_one_day_can_raise_two_alerts(spark):
    df = spark.createDataFrame([("A", "d", 45.1, 150.0), ("B", "d", 40.0, 100.0), ("C", "d", None, 150.1)],
                               "District string, Date string, MaxTemp_2m double, Precip double")
    got = sorted((r["district"], r["alert_type"], r["severity"], r["message"])
                 for r in alerts.fan_out_alerts(df).collect())
    assert got == [("A", "FLOOD_RISK", "MEDIUM", "Heavy precipitation: 150.0mm"),
                   ("A", "HEATWAVE", "HIGH", "Extreme temperature: 45.1°C"),
                   ("C", "FLOOD_RISK", "HIGH", "Heavy precipitation: 150.1mm")]
    totals = alerts.alert_totals(df).first()
    assert (totals["heatwave_alerts"], totals["flood_alerts"]) == (1, 2)
    assert alerts.alert_totals(df, exclusive=True).first()["flood_alerts"] == 1


def test_unknown_districts_are_dropped(spark):
    df = spark.createDataFrame([("Bara",), ("Parsa",), ("Elsewhere",)], "district string")
    got = cleaning.limit_to(df, "Bara , Elsewhere", K.DISTRICTS).collect()
    assert [r[0] for r in got] == ["Bara"]
