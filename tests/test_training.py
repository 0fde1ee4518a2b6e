"""Early stopping over prefixes of an ensemble, the recurrent classifier, and ranking from histograms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxrisk.operators import boosting, models, recurrent
from wxrisk.operators.histograms import COUNTS, counted, ranking_by_round
from wxrisk.session import TableStages, scratch_path


def plain_ranking(scores, labels):
    """(average precision, area) over distinct scores."""
    order = np.unique(scores)[::-1]
    tp = np.array([labels[scores >= s].sum() for s in order])
    all_ = np.array([(scores >= s).sum() for s in order])
    p, n = labels.sum(), len(labels) - labels.sum()
    precision = (np.diff(tp, prepend=0) * tp / all_).sum() / p
    wins = sum((scores[labels == 1][:, None] > scores[labels == 0]).sum(axis=1)) + 0.5 * sum((scores[labels == 1][:, None] == scores[labels == 0]).sum(axis=1))
    return precision, wins / (p * n)


def test_histograms_rank_like_plain_counts(spark):
    draw = np.random.default_rng(1)
    scores, labels = draw.integers(0, 40, (500, 3)) / 40, (draw.random(500) < 0.3).astype(int)
    parts = [counted(scores[a:a + 100], labels[a:a + 100]) for a in range(0, 500, 100)]
    rows = [tuple(r.values()) for p in parts for r in p.to_pylist()]
    found = {r["round"]: r for r in ranking_by_round(spark.createDataFrame(rows, COUNTS)).collect()}
    for k in range(3):
        precision, area = plain_ranking(scores[:, k], labels)
        assert abs(found[k].average_precision - precision) < 1e-12 and abs(found[k].roc_auc - area) < 1e-12
        assert found[k].pos == labels.sum() and found[k].pos + found[k].neg == 500
    alone = ranking_by_round(spark.createDataFrame([(0, 5, 0, 7)], COUNTS)).first()
    assert (alone.average_precision, alone.roc_auc) == (0.0, 0.0)


@pytest.fixture(scope="module")
def noisy(spark):
    draw = np.random.default_rng(4)
    x = draw.random((600, 3))
    y = ((x[:, 0] + x[:, 1] + draw.normal(0, 0.35, 600)) > 1.3).astype(int)
    rows = [(*map(float, a), int(b), k) for k, (a, b) in enumerate(zip(x, y, strict=True))]
    return TableStages(spark, "noisy")(spark.createDataFrame(rows, "a double, b double, c double, label int, k int").repartition(2, "k"), "rows")


def test_every_prefix_scores_like_the_shorter_model(noisy):
    train, valid = noisy.where("k < 400"), noisy.where("k >= 400")
    long, _ = models.train_trees(train, ["a", "b", "c"], rounds=6)
    ranked = {r["round"]: r for r in boosting.prefix_ranking(long, valid).collect()}
    assert sorted(ranked) == [1, 2, 3, 4, 5, 6]
    for rounds in (1, 4, 6):
        short, _ = models.train_trees(train, ["a", "b", "c"], rounds=rounds)
        rows = models.score(short, valid).select("prediction_prob", "label").collect()
        scores = np.floor(np.array([r.prediction_prob for r in rows]) * (1 << 14))
        precision, area = plain_ranking(scores, np.array([r.label for r in rows]))
        assert abs(ranked[rounds].average_precision - precision) < 1e-9 and abs(ranked[rounds].roc_auc - area) < 1e-9


def test_stopping_round():
    assert boosting.stopping_round([0.1, 0.5, 0.4, 0.5, 0.3], 3) == (2, True)
    assert boosting.stopping_round([0.1, 0.5, 0.4, 0.6, 0.3], 3) == (4, False)
    assert boosting.stopping_round([0.2], 1) == (1, False)


def test_training_stops_and_keeps_the_best(noisy):
    train, valid = noisy.where("k < 400"), noisy.where("k >= 400")
    model, card = boosting.train_until_no_better(train, valid, ["a", "b", "c"], rounds=20, patience=2)
    tried, kept = card.parameters["tried"], card.parameters["kept"]
    assert len(model.stages[-1].trees) == kept and kept <= tried <= 20 and (tried == 20 or kept + 2 <= tried)
    ranked = [r.average_precision for r in boosting.prefix_ranking(model, valid).orderBy("round").collect()]
    assert max(ranked) == ranked[-1]
    model, card = boosting.train_until_no_better(train, valid.where("false"), ["a", "b", "c"], rounds=3, patience=2)
    assert len(model.stages[-1].trees) == 3


def test_the_best_prefix_is_cut_out_and_not_fitted_again(spark, noisy, monkeypatch):
    train, valid, inputs = noisy.where("k < 400"), noisy.where("k >= 400"), ["a", "b", "c"]
    fits, plain = [], models.train_trees
    monkeypatch.setattr(models, "train_trees", lambda *a, **more: fits.append(more["rounds"]) or plain(*a, **more))
    monkeypatch.setattr(boosting, "FIRST", 0)
    model, card = boosting.train_until_no_better(train, valid, inputs, rounds=16, patience=1)
    kept = card.parameters["kept"]
    assert fits == [2, 6, 16][:len(fits)] and kept < fits[-1] == card.parameters["tried"] and card.parameters["maxIter"] == kept
    path = scratch_path(spark, "cut")
    models.save(spark, model, card, path)
    stored, known = models.load(spark, path)
    short, _ = plain(train, inputs, rounds=kept)
    assert known == card and len(stored.stages[-1].trees) == kept == stored.stages[-1].getMaxIter()
    told = [[(r.k, r.prediction_prob) for r in models.score(m, valid).orderBy("k").collect()] for m in (short, model, stored)]
    assert told[0] == told[1] == told[2]


def test_what_an_epoch_sends_to_the_driver(spark):
    parts = spark.createDataFrame([(-1, 0.0, 2), (-1, 0.0, 6), (0, 4.0, 2), (0, 12.0, 6), (1, float("nan"), 2)], "place int, part double, rows long")
    mean = recurrent.averaged(parts)
    assert mean.columns == ["place", "mean"] and "rangepartitioning" not in mean._jdf.queryExecution().toString()
    found = {r.place: r["mean"] for r in mean.collect()}
    assert (found[-1], found[0]) == (8.0, 2.0) and np.isnan(found[1])


def test_network_slopes():
    draw = np.random.default_rng(2)
    net = recurrent.Network(3, hidden=4, dense=5)
    x, y = draw.normal(size=(7, 6, 3)), (draw.random(7) < 0.5).astype(float)
    _, slope = net.slopes(x, y)
    for k in draw.choice(len(net.flat), 40, replace=False):
        net.flat[k] += 1e-5
        up = recurrent.cross_entropy(net.logits(x)[0], y).mean()
        net.flat[k] -= 2e-5
        down = recurrent.cross_entropy(net.logits(x)[0], y).mean()
        net.flat[k] += 1e-5
        assert abs((up - down) / 2e-5 - slope[k]) < 1e-6


def test_epochs_learn_and_are_stored(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = []
    for k in range(900):
        steps = draw.normal(size=(5, 2))
        rows.append((f"d{k % 3}", k, steps.tolist(), int(steps[-2:, 0].sum() > 0.5)))
    made = spark.createDataFrame(rows, "District string, k int, sequence array<array<double>>, label int").withColumn("Date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("k")))
    made = TableStages(spark, "sequences")(made, "rows")
    train, valid = models.hash_split(made, "District", "Date")
    for per_task in (10_000, 200):
        monkeypatch.setattr(recurrent, "ROWS_PER_TASK", per_task)
        weights, card, told = recurrent.train_epochs(train, valid, ["a", "b"], steps=5, epochs=6, stage=TableStages(spark, "epochs"), hidden=8, dense=8)
        told = told.orderBy("epoch").collect()
        assert [r.epoch for r in told] == [1, 2, 3, 4, 5, 6]
        assert all(r.train_rows == train.count() and r.valid_rows == valid.count() for r in told)
        assert told[-1].valid_loss < told[0].valid_loss and told[-1].valid_auc > 0.7
    path = scratch_path(spark, "memory")
    recurrent.save(spark, weights, card, path)
    again, known = recurrent.load(spark, path)
    assert known == card and np.array_equal(again, weights)
    scores = recurrent.scored(valid, again, known).toPandas()
    assert len(scores) == valid.count() and scores.prediction_prob.between(0, 1).all()
