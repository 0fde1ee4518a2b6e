"""The sequence classifier: a long short-term memory network trained by epochs over distributed mini-batches.

In an epoch every task goes through its rows in mini-batches, starting from the same weights, and gives its weights
back; their means by rows, taken in Spark, start the next epoch. A table of up to ``ROWS_PER_TASK`` rows is one
task, which is plain mini-batch training. Loss and ranking on held-out rows are measured after each epoch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk import constants as K
from wxrisk.operators import models
from wxrisk.operators.histograms import COUNTS, counted

# Sizes of the state and of the dense layer, rows of a mini-batch, epochs.
HIDDEN = 64
DENSE = 32
BATCH = 128
EPOCHS = 20
ROWS_PER_TASK = 8192
RATE, DECAY_1, DECAY_2, TINY = 1e-3, 0.9, 0.999, 1e-8


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Network:
    """One recurrent layer, one dense layer with a ramp, one logit; weights lie in one flat array."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, dense: int = DENSE, flat: np.ndarray | None = None, seed: int = 7):
        self.shapes = {"x": (inputs, 4 * hidden), "h": (hidden, 4 * hidden), "g": (4 * hidden,), "d": (hidden, dense), "e": (dense,), "o": (dense, 1), "p": (1,)}
        self.hidden = hidden
        sizes = [int(np.prod(s)) for s in self.shapes.values()]
        if flat is None:
            draw = np.random.default_rng(seed)
            reach = {"d": hidden, "e": hidden, "o": dense, "p": dense}
            flat = np.concatenate([draw.uniform(-1, 1, size) / np.sqrt(reach.get(name, hidden)) for name, size in zip(self.shapes, sizes, strict=True)])
        self.flat = np.array(flat, np.float64)
        ends = np.cumsum(sizes)
        self.parts = {name: self.flat[end - size:end].reshape(shape) for (name, shape), size, end in zip(self.shapes.items(), sizes, ends, strict=True)}

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """One logit per sequence (row, step, input), and what the slopes need."""
        w, n = self.parts, self.hidden
        h = c = np.zeros((len(x), n))
        steps = []
        for t in range(x.shape[1]):
            gates = x[:, t] @ w["x"] + h @ w["h"] + w["g"]
            i, f, o = (_sigmoid(gates[:, k * n:(k + 1) * n]) for k in (0, 1, 3))
            g = np.tanh(gates[:, 2 * n:3 * n])
            kept, before = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            steps.append((i, f, g, o, kept, c, before))
        ramp = np.maximum(0, h @ w["d"] + w["e"])
        return (ramp @ w["o"] + w["p"])[:, 0], (steps, h, ramp)

    def slopes(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """(mean cross-entropy, its slope along the flat weights)."""
        w, n = self.parts, self.hidden
        logit, (steps, last, ramp) = self.logits(x)
        made = Network(w["x"].shape[0], n, w["d"].shape[1], np.zeros_like(self.flat))
        s = made.parts
        out = ((_sigmoid(logit) - y) / len(y))[:, None]
        s["o"][:], s["p"][:] = ramp.T @ out, out.sum(axis=0)
        back = (out @ w["o"].T) * (ramp > 0)
        s["d"][:], s["e"][:] = last.T @ back, back.sum(axis=0)
        dh, dc = back @ w["d"].T, np.zeros((len(x), n))
        for t in range(x.shape[1] - 1, -1, -1):
            i, f, g, o, kept, c, before = steps[t]
            bent = np.tanh(c)
            dc = dc + dh * o * (1 - bent * bent)
            gates = np.concatenate([dc * g * i * (1 - i), dc * kept * f * (1 - f), dc * i * (1 - g * g), dh * bent * o * (1 - o)], axis=1)
            s["x"] += x[:, t].T @ gates
            s["h"] += before.T @ gates
            s["g"] += gates.sum(axis=0)
            dh, dc = gates @ w["h"].T, dc * f
        return float(cross_entropy(logit, y).mean()), made.flat


def cross_entropy(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(logit, 0) - logit * y + np.log1p(np.exp(-np.abs(logit)))


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    flat = batch.column(0).flatten().to_numpy().astype(np.float64)
    return flat.reshape(batch.num_rows, -1, width), batch.column(1).to_numpy().astype(np.float64)


def one_epoch(rows: DataFrame, width: int, state: np.ndarray, epoch: int, hidden: int = HIDDEN, dense: int = DENSE, seed: int = 7) -> tuple[np.ndarray, int, float]:
    """(state, rows, loss) after all tasks went through their rows. The state is weights, two moments and the step count."""
    shared = rows.sparkSession.sparkContext.broadcast(state)
    size = (len(state) - 1) // 3

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, one, two, done = (np.array(x) for x in np.split(shared.value, (size, 2 * size, 3 * size)))
        net, draw, n, lost = Network(width, hidden, dense, weights), np.random.default_rng((seed, epoch)), 0, 0.0
        for batch in batches:
            x, y = _arrays(batch, width)
            order = draw.permutation(len(y))
            for begin in range(0, len(y), BATCH):
                own = order[begin:begin + BATCH]
                loss, slope = net.slopes(x[own], y[own])
                done += 1
                one += (1 - DECAY_1) * (slope - one)
                two += (1 - DECAY_2) * (slope * slope - two)
                net.flat -= RATE * (one / (1 - DECAY_1 ** done)) / (np.sqrt(two / (1 - DECAY_2 ** done)) + TINY)
                n, lost = n + len(own), lost + loss * len(own)
        if n:
            made = np.concatenate([net.flat, one, two, done, [lost / n]])
            part = np.append(0.0, made * n)  # place -1 only counts
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(made)), pa.int32()), pa.array(part), pa.array(np.full(len(part), n))], ["place", "part", "rows"])

    mean = averaged(rows.mapInArrow(learn, "place int, part double, rows long")).toArrow()  # three times as long as the network
    values = mean.column("mean").to_numpy()[np.argsort(mean.column("place").to_numpy())]
    return values[1:-1], int(values[0]), float(values[-1])


def averaged(parts: DataFrame) -> DataFrame:
    """(place, mean) of what the tasks gave back, weighed by rows, in no order; place -1 has the number of rows.

    This goes to the driver in each epoch, so it has no other column and is not sorted in Spark.
    """
    total = F.sum("rows")
    return parts.groupBy("place").agg(F.when(F.col("place") < 0, total.cast("double")).otherwise(F.sum("part") / total).alias("mean"))


def measured(rows: DataFrame, width: int, weights: np.ndarray, hidden: int = HIDDEN, dense: int = DENSE) -> tuple[int, float, float]:
    """(rows, mean loss, area under the ROC curve) of the weights on held-out rows; 0 where a class is missing."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(width, hidden, dense, shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _arrays(batch, width)
            logit, _ = net.logits(x)
            made = counted(_sigmoid(logit)[:, None], y)
            lost = np.zeros(made.num_rows)
            lost[0] = cross_entropy(logit, y).sum()
            yield pa.RecordBatch.from_arrays([*made.columns, pa.array(lost)], [*made.schema.names, "lost"])

    counts = rows.mapInArrow(count, COUNTS + ", lost double").groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "lost")])
    bins = counts.orderBy(F.desc("bin")).toArrow()  # a row per bin at most
    pos, neg, lost = (bins.column(c).to_numpy() for c in ("pos", "neg", "lost"))
    n, p = int((pos + neg).sum()), int(pos.sum())
    wrong = (pos * (np.cumsum(neg) - neg / 2)).sum()
    return n, float(lost.sum() / n) if n else 0.0, float(1 - wrong / (p * (n - p))) if 0 < p < n else 0.0


def train_epochs(train: DataFrame, valid: DataFrame, inputs: list[str], *, steps: int = K.TIMESTEPS, epochs: int = EPOCHS, stage,
                 hidden: int = HIDDEN, dense: int = DENSE, target: str = "heatwave", seed: int = 7) -> tuple[np.ndarray, models.ModelCard, DataFrame]:
    """(weights, card, epoch table) from standardised ``sequence`` rows with a 0/1 ``label``.

    The epoch table has epoch, train_rows, train_loss, valid_rows, valid_loss and valid_auc. The rows are stored once,
    dealt over tasks by hash, so each epoch and each repeated task sees them in the same order.
    """
    def flat(rows: DataFrame, name: str) -> DataFrame:
        made = rows.select("District", "Date", F.flatten("sequence").alias("x"), "label")
        tasks = max(1, -(-made.count() // ROWS_PER_TASK))
        dealt = made.repartition(tasks, F.xxhash64("District", "Date")).sortWithinPartitions(F.xxhash64(F.lit(seed), "Date", "District"))
        return stage(dealt.select("x", "label"), name)

    held, left = flat(train, "train"), flat(valid, "valid")
    weights = Network(len(inputs), hidden, dense, seed=seed).flat
    state = np.concatenate([weights, np.zeros(2 * len(weights) + 1)])
    told = []
    for epoch in range(1, epochs + 1):
        state, rows, loss = one_epoch(held, len(inputs), state, epoch, hidden, dense, seed)
        told.append((epoch, rows, loss, *measured(left, len(inputs), state[:len(weights)], hidden, dense)))
    told = train.sparkSession.createDataFrame(told, "epoch int, train_rows long, train_loss double, valid_rows long, valid_loss double, valid_auc double")
    card = models.ModelCard("recurrent", target, list(inputs), steps, {"hidden": hidden, "dense": dense, "epochs": epochs})
    return state[:len(weights)], card, told


def save(spark: SparkSession, weights: np.ndarray, card: models.ModelCard, path: str) -> None:
    """The weights as a table of (place, value), and the card, below one folder."""
    spark.createDataFrame(list(enumerate(weights.tolist())), "place int, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
    spark.createDataFrame([(json.dumps(asdict(card)),)], "card string").coalesce(1).write.mode("overwrite").text(f"{path}/card")


def load(spark: SparkSession, path: str) -> tuple[np.ndarray, models.ModelCard]:
    weights = spark.read.parquet(f"{path}/weights").orderBy("place").toArrow().column("value")
    return weights.to_numpy(), models.read_card(spark, path)


def scored(rows: DataFrame, weights: np.ndarray, card: models.ModelCard, name: str = "prediction_prob") -> DataFrame:
    """District, Date and probability of standardised sequences; works on streams."""
    width, sizes = len(card.inputs), (card.parameters["hidden"], card.parameters["dense"])
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(width, *sizes, shared.value)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1, width)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_sigmoid(net.logits(x)[0]))], ["District", "Date", name])

    plain = rows.select(F.col("District").cast("string"), F.col("Date").cast("date"), F.flatten("sequence").alias("x"))
    return plain.mapInArrow(score, f"District string, Date date, {name} double")
