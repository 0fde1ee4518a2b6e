"""Block windows, running totals, quantiles and labels against brute force, with one hot district."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wxrisk.operators import features, labels, metrics, replay, sequences
from wxrisk.operators.quantiles import group_quantiles
from wxrisk.operators.running import running
from wxrisk.operators.series import in_blocks, with_position
from wxrisk.session import TableStages

SCHEMA = "District string, Date date, MaxTemp_2m double, Precip double, RH_2m double, TempRange_2m double"


def made(seed, sizes, gap=0.0):
    """Daily rows for districts of the given sizes; some values are missing and some days are left out."""
    rng, rows = random.Random(seed), []
    for name, size in sizes.items():
        day = dt.date(2019, 11, 20)
        for _ in range(size):
            day += dt.timedelta(days=1 + (rng.randrange(1, 500) if rng.random() < gap else 0))
            rows.append((
                name, day, None if rng.random() < 0.1 else round(rng.uniform(20, 45), 1),
                None if rng.random() < 0.3 else float(rng.choice([0, 0, 0, 1, 5, 40, 120])),
                None if rng.random() < 0.5 else float(rng.randrange(30, 100)), float(rng.randrange(5, 15)),
            ))
    return rows


SIZES = {"hot": 700, "b": 40, "c": 15, "d": 14, "e": 13, "f": 2, "g": 1}


@pytest.fixture(scope="module")
def rows():
    return made(3, SIZES, gap=0.02)


@pytest.fixture(scope="module")
def frame(rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    pdf = pd.DataFrame(rows, columns=names).sort_values(["District", "Date"]).reset_index(drop=True)
    return pdf.astype({c: "float64" for c in names[2:]})


@pytest.fixture(scope="module")
def df(spark, rows):
    shuffled = list(rows)
    random.Random(1).shuffle(shuffled)
    return TableStages(spark, "test")(spark.createDataFrame(shuffled, SCHEMA), "rows")


def ordered(df, *columns):
    pdf = df.select("District", "Date", *columns).toPandas()
    return pdf.sort_values(["District", "Date"]).reset_index(drop=True)


def same(left, right):
    left = pd.Series(left).astype("float64").round(9).fillna(-777)
    right = pd.Series(right).astype("float64").round(9).fillna(-777)
    return list(left) == list(right)


def test_positions(df, frame):
    got = ordered(with_position(df, "District", "Date"), "_position")
    assert list(got["_position"]) == list(frame.groupby("District").cumcount())


def test_positions_of_equal_days_are_a_permutation(spark):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("a", day, float(i % 3)) for i in range(30)], "District string, Date date, v double")
    got = sorted(r["_position"] for r in with_position(df, "District", "Date").collect())
    assert got == list(range(30))


@pytest.mark.parametrize("block_rows", [7, 64, 2048])
def test_rolling_features(df, frame, block_rows):
    got = ordered(features.rolling_features(df, block_rows=block_rows), "precip_3d", "precip_7d", "maxT_3d_mean",
                  "temp_range_3d_max", "precip_lag_1", "precip_lag_14", "maxT_lag_7", "API")
    by = frame.groupby("District")
    assert len(got) == len(frame)
    for name, column, size, how in [("precip_3d", "Precip", 3, "sum"), ("precip_7d", "Precip", 7, "sum"),
                                    ("maxT_3d_mean", "MaxTemp_2m", 3, "mean"), ("temp_range_3d_max", "TempRange_2m", 3, "max")]:
        expected = getattr(by[column].rolling(size, min_periods=1), how)().reset_index(0, drop=True).sort_index()
        assert same(got[name], expected), name
    for name, column, k in [("precip_lag_1", "Precip", 1), ("precip_lag_14", "Precip", 14), ("maxT_lag_7", "MaxTemp_2m", 7)]:
        assert same(got[name], by[column].shift(k)), name
    index, last, expected = 0.0, None, []
    for district, rain in zip(frame["District"], frame["Precip"].fillna(0)):
        index = rain + (0.8 * index if district == last else 0.0)
        last = district
        expected.append(index)
    assert same(got["API"], expected)


def test_rows_without_a_key_are_kept(spark):
    day = dt.date(2020, 1, 1)
    data = [("a", day, 1.0), ("a", None, 2.0), (None, day, 4.0), (None, None, 8.0)]
    df = spark.createDataFrame(data, "District string, Date date, Precip double").withColumns(
        {"MaxTemp_2m": F.lit(1.0), "TempRange_2m": F.lit(1.0), "RH_2m": F.lit(1.0)})
    got = features.rolling_features(df).collect()
    assert sorted(r["Precip"] for r in got) == [1.0, 2.0, 4.0, 8.0]
    assert {r["Precip"]: r["precip_3d"] for r in got if r["District"]} == {1.0: 1.0, 2.0: 3.0}
    assert labels.label_both(df).count() == 4


def test_all_missing_window_stays_missing(spark):
    days = [(("a"), dt.date(2020, 1, i + 1), None, 1.0) for i in range(5)]
    df = spark.createDataFrame(days, "District string, Date date, Precip double, MaxTemp_2m double").withColumn(
        "TempRange_2m", F.lit(1.0))
    assert [r["precip_3d"] for r in features.rolling_features(df).collect()] == [None] * 5


@pytest.mark.parametrize("block_rows", [7, 300, 4096])
@pytest.mark.parametrize("decay", [0.01, 0.5, 0.8, 0.99, 0.9999])
def test_wetness_index_for_any_decay_and_block(df, frame, decay, block_rows):
    blocks = in_blocks(df, "District", "Date", 3, block_rows=block_rows)
    got = ordered(features.wetness_index(blocks, block_rows, decay).plain(), "API")
    index, last, expected = 0.0, None, []
    for district, rain in zip(frame["District"], frame["Precip"].fillna(0)):
        index = rain + (decay * index if district == last else 0.0)
        last = district
        expected.append(index)
    assert len(got) == len(expected)
    assert all(abs(a - b) <= 1e-9 * max(1.0, b) for a, b in zip(got["API"], expected))


def test_keyless_rows_are_not_gathered(spark):
    """A third of the rows without a district, some without a date: all kept, none in a common group."""
    day = dt.date(2020, 1, 1)
    data = [(None if i % 3 == 0 else "a", None if i % 5 == 0 else day + dt.timedelta(days=i), float(i)) for i in range(900)]
    df = spark.createDataFrame(data, "District string, Date date, Precip double").withColumns(
        {"MaxTemp_2m": F.lit(1.0), "TempRange_2m": F.lit(1.0), "RH_2m": F.lit(1.0)})
    spread = in_blocks(df, "District", "Date", 14, block_rows=64).df
    keyless = spread.where("District is null").groupBy("_block").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(keyless) == (1, 300)
    got = features.rolling_features(df, block_rows=64).collect()
    assert sorted(r["Precip"] for r in got) == [float(i) for i in range(900)]
    assert all(r["precip_3d"] == r["Precip"] for r in got if r["District"] is None)
    assert labels.label_both(df, block_rows=64).count() == 900


@pytest.mark.parametrize("range_rows", [5, 1 << 16])
def test_running_totals(spark, range_rows):
    rng = random.Random(5)
    values = sorted({round(rng.uniform(-5, 5), 2) for _ in range(400)})
    data = [(g, v, i % 4) for g in ("hot", "cold") for i, v in enumerate(values if g == "hot" else values[:7])]
    df = spark.createDataFrame(data, "g string, v double, n int")
    totals = {"s": ("sum", "n"), "m": ("max", "n")}
    for before in (False, True):
        got = {(r["g"], r["v"]): (r["s"], r["m"]) for r in
               running(df, ["g"], "v", totals, before=before, range_rows=range_rows).collect()}
        assert len(got) == len(data)
        for g in ("hot", "cold"):
            seen = []
            for _, v, n in sorted(r for r in data if r[0] == g):
                if before:
                    assert got[g, v] == (sum(seen), max(seen, default=None))
                seen.append(n)
                if not before:
                    assert got[g, v] == (sum(seen), max(seen))
    alone = df.filter("g = 'hot'").select("v", "n")
    got = sorted((r["v"], r["s"]) for r in running(alone, [], "v", {"s": ("sum", "n")}, range_rows=range_rows).collect())
    assert [s for _, s in got] == list(pd.Series([n for g, _, n in data if g == "hot"]).cumsum())


@pytest.mark.parametrize("range_rows", [3, 1 << 16])
def test_quantiles(df, frame, range_rows):
    wanted = {"a": ("MaxTemp_2m", 0.95), "b": ("Precip", 0.99), "c": ("RH_2m", 0.5), "d": ("Precip", 0.0)}
    got = {r["District"]: r for r in group_quantiles(df, ["District"], wanted, range_rows=range_rows).collect()}
    for district, part in frame.groupby("District"):
        for name, (column, q) in wanted.items():
            expected = part[column].quantile(q)
            if pd.isna(expected):
                assert district not in got or got[district][name] is None
            else:
                assert got[district][name] == pytest.approx(expected, abs=1e-12)


def spells(frame, exceed):
    count, last, out = 0, None, []
    for district, over in zip(frame["District"], exceed):
        count = (count if district == last else 0) + 1 if over else 0
        last = district
        out.append(count)
    return out


@pytest.mark.parametrize("block_rows", [4, 2048])
def test_labels(df, frame, block_rows):
    by = frame.groupby("District")
    exceed = frame["MaxTemp_2m"] > by["MaxTemp_2m"].transform(lambda s: s.quantile(0.95))
    got = ordered(labels.label_both(df, block_rows=block_rows, stage=TableStages(df.sparkSession)), "heat_exceed", "heat_run",
                  "heatwave", "RH_2m_filled", "precip_3d", "wetness_flag", "flood_proxy")
    assert list(got["heat_exceed"]) == list(exceed)
    assert list(got["heat_run"]) == spells(frame, exceed)
    assert list(got["heatwave"]) == [n >= 3 for n in spells(frame, exceed)]
    filled = frame["RH_2m"].ffill().bfill()
    assert same(got["RH_2m_filled"], filled)
    day = frame["Precip"].fillna(0)
    three = day.groupby(frame["District"]).rolling(3, min_periods=1).sum().reset_index(0, drop=True).sort_index()
    assert same(got["precip_3d"], three)

    def limit(series, q):
        return series.groupby(frame["District"]).transform(lambda s: s.quantile(q))

    wet = filled > limit(filled, 0.9)
    flood = ((day > limit(day, 0.99)) | (three > limit(three, 0.98))) & wet
    assert list(got["wetness_flag"]) == list(wet) and list(got["flood_proxy"]) == list(flood)


@pytest.mark.parametrize("block_rows", [3, 2048])
def test_long_spell_over_many_blocks_and_a_missing_day(spark, block_rows):
    temps = [50.0] * 11 + [None] + [50.0] * 5 + [10.0]
    data = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), t) for i, t in enumerate(temps)]
    df = spark.createDataFrame(data, "District string, Date date, MaxTemp_2m double")
    limits = spark.createDataFrame([("a", 40.0)], "District string, heat_limit double")
    got = ordered(labels.label_heat(df, limits, block_rows=block_rows), "heat_run")
    assert list(got["heat_run"]) == [*range(1, 12), 0, *range(1, 6), 0]


@pytest.mark.parametrize("values,expected,inside", [
    ({"a": [None, None], "b": [None, 5.0]}, [5.0, 5.0, 5.0, 5.0], [None, None, 5.0, 5.0]),
    ({"a": [None, 3.0], "b": [None, None], "c": [None, 7.0, None]}, [3.0, 3.0, 3.0, 3.0, 3.0, 7.0, 7.0],
     [3.0, 3.0, None, None, 7.0, 7.0, 7.0]),
    ({"a": [None]}, [None], [None]),
])
def test_humidity_fill_crosses_districts(spark, values, expected, inside):
    data = [(d, dt.date(2020, 1, 1) + dt.timedelta(days=i), v) for d, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "District string, Date date, RH_2m double")
    for scope, want in (("table", expected), ("district", inside)):
        blocks = labels.known_humidity(in_blocks(df, "District", "Date", 0, block_rows=1)).own_rows()
        filled = labels.fill_humidity(blocks, scope=scope).plain().collect()
        assert [r["RH_2m_filled"] for r in sorted(filled)] == want


@pytest.mark.parametrize("block_rows", [5, 2048])
def test_sequences_by_length_of_history(df, frame, block_rows):
    labelled = df.withColumn("heatwave", F.col("MaxTemp_2m") > 40)
    inputs = ["MaxTemp_2m", "Precip"]
    train = sequences.training_sequences(labelled, inputs=inputs, block_rows=block_rows).collect()
    score = sequences.scoring_sequences(df, inputs=inputs, block_rows=block_rows).collect()
    train = {(r["District"], r["Date"]): r for r in train}
    score = {(r["District"], r["Date"]): r["sequence"] for r in score}
    expected_train, expected_score = {}, {}
    for district, part in frame.groupby("District"):
        steps = part[inputs].fillna(0.0).values.tolist()
        days, hot = list(part["Date"]), list(part["MaxTemp_2m"] > 40)
        for i in range(14, len(steps)):
            expected_train[district, days[i]] = (steps[i - 14:i], int(hot[i]))
        for i in range(14, len(steps) + 1):
            expected_score[district, days[i - 1]] = steps[i - 14:i]
    assert {k: (r["sequence"], r["label"]) for k, r in train.items()} == expected_train
    assert score == expected_score
    assert {d for d, _ in expected_score} == {"hot", "b", "c", "d"} and {d for d, _ in expected_train} == {"hot", "b", "c"}


def test_replay_orders(df, frame):
    fed = frame.assign(rn=frame.groupby("District").cumcount()).sort_values(["rn", "District"]).reset_index(drop=True)
    expected = {(r.District, r.Date): i for i, r in enumerate(fed.itertuples())}
    got = replay.round_robin_batches(df, 10).collect()
    assert {(r["District"], r["Date"]): r["sequence"] for r in got} == expected
    assert all(r["batch"] == r["sequence"] // 10 + 1 for r in got)
    window = replay.row_range(df, 30, 95, key="District", order="Date").collect()
    assert {(r["District"], r["Date"]) for r in window} == {
        (r.District, r.Date) for r in frame.iloc[30:95].itertuples()}


def test_prefix_difference_drops_duplicates(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(12)], "i int, v int")
    got = replay.prefix_difference(df.select("i", "v"), 4, 8, "i").collect()
    assert sorted(r["i"] for r in got) == [4, 5, 6, 7]
    spread = spark.createDataFrame([(v,) for v in (1, 1, 2, 2, 3)], "v int")
    assert sorted(r["v"] for r in replay.prefix_difference(spread, 1, 5, "v").collect()) == [2, 3]


def brute_metrics(pairs):
    p, n = sum(y for _, y in pairs), sum(1 - y for _, y in pairs)
    ap = tp = fp = 0.0
    for score in sorted({s for s, _ in pairs}, reverse=True):
        here = [y for s, y in pairs if s == score]
        tp, fp = tp + sum(here), fp + len(here) - sum(here)
        ap += sum(here) / p * tp / (tp + fp) if p else 0.0
    wins = sum((a > b) + (a == b) / 2 for a, y in pairs if y for b, z in pairs if not z)
    return ap, wins / (p * n) if p and n else 0.0


@pytest.mark.parametrize("pairs", [
    [(0.9, 1), (0.8, 0), (0.8, 1), (0.8, 1), (0.3, 0), (0.1, 1)], [(0.5, 1), (0.5, 0)], [(0.1, 1), (0.7, 1)], [(0.2, 0)],
])
@pytest.mark.parametrize("range_rows", [2, 1 << 16])
def test_ranking_metrics(spark, pairs, range_rows):
    df = spark.createDataFrame(pairs, "prob double, label int")
    row = metrics.ranking_metrics(metrics.score_table(df, "prob", "label", range_rows=range_rows)).first()
    ap, auc = brute_metrics(pairs)
    assert row["average_precision"] == pytest.approx(ap) and row["roc_auc"] == pytest.approx(auc)


def test_threshold_metrics_without_positives(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "prob double, label int")
    assert tuple(metrics.threshold_metrics(df, "prob", "label").first()) == (0.0, 0.0, 0.0)
    assert metrics.class_weight(df, "label").first()[0] == 2.0
