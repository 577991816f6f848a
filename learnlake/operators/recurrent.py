"""Recurrent sequence classifier: an LSTM over the steps, a dense layer and a logistic output.

Few sequences are trained on by one task. Otherwise they stay spread over cached partitions: per step a small job adds up
the gradients of the partitions' parts of the batch, by back-propagation through time, and the driver takes the Adam
step. What travels has the size of the weights, whatever the data. Steps whose inputs are all zero are masked: the state
passes them unchanged, so only the others are computed. Training stops when the validation AUC has not risen for some
epochs and keeps the best weights.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.operators.boosting import TRAIN, VALIDATE

# Sequences a task of its own is started for, and those of a task from which on tasks may outnumber slots.
ROWS_PER_TASK = 16_384
MOST_ROWS_PER_TASK = 1_048_576
# Partitions whose gradients meet in the driver; those of more are added up in tasks first.
SUMMED_AT_ONCE = 32
# Bins of the score histograms that the AUC for early stopping comes from.
AUC_BINS = 4_096


@dataclass(frozen=True)
class Recurrent:
    """``batch`` grows beyond its value where an epoch would take more than ``most_steps`` steps."""

    length: int = 30
    hidden: int = 64
    dense: int = 32
    dropout: float = 0.3
    recurrent_dropout: float = 0.1
    batch: int = 128
    epochs: int = 25
    step: float = 0.001
    patience: int = 5
    most_steps: int = 50
    seed: int = 42


Weights = dict[str, np.ndarray]


def initial_weights(features: int, s: Recurrent) -> Weights:
    """Uniform input and dense weights scaled by fan-in and fan-out, orthogonal recurrent ones, forget gates open."""
    rnd = np.random.default_rng(s.seed)

    def uniform(a: int, b: int) -> np.ndarray:
        edge = np.sqrt(6 / (a + b))
        return rnd.uniform(-edge, edge, (a, b))

    h = s.hidden
    turned = np.concatenate([np.linalg.qr(rnd.normal(size=(h, h)))[0] for _ in range(4)], axis=1)
    bias = np.zeros(4 * h)
    bias[h:2 * h] = 1.0
    return {"wx": uniform(features, 4 * h), "wh": turned, "b": bias, "w1": uniform(h, s.dense), "b1": np.zeros(s.dense),
            "w2": uniform(s.dense, 1), "b2": np.zeros(1)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _active_first(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by falling number of active steps, their active steps one after the other, and rows per step."""
    active = (x != 0).any(axis=2)
    n = active.sum(axis=1)
    order, most = np.argsort(-n, kind="stable"), n.max(initial=0)
    steps = np.argsort(~active[order], axis=1, kind="stable")[:, :most]
    return order, np.take_along_axis(x[order], steps[:, :, None], axis=1), (n[:, None] > np.arange(most)).sum(axis=0)


def forward(w: Weights, x: np.ndarray, masks: dict[str, np.ndarray] | None = None, keep: list | None = None) -> np.ndarray:
    """Log-odds of sequences (row, step, feature); ``masks`` are the dropout factors, ``keep`` collects what the way back needs."""
    n, size = len(x), w["wh"].shape[0]
    order, x, rows = _active_first(x)
    m = {name: mask[order] for name, mask in (masks or {}).items()}
    h, c = np.zeros((n, size), x.dtype), np.zeros((n, size), x.dtype)
    inputs = x * m["x"][:, None, :] if "x" in m else x
    for t, k in enumerate(rows):
        # The rows that have a step left come first; the others keep their state.
        dropped = h[:k] * m["h"][:k] if "h" in m else h[:k].copy()
        z = inputs[:k, t] @ w["wx"] + dropped @ w["wh"] + w["b"]
        i, f, o = (_sigmoid(z[:, j * size:(j + 1) * size]) for j in (0, 1, 3))
        g = np.tanh(z[:, 2 * size:3 * size])
        c_old, c_new = c[:k].copy(), f * c[:k] + i * g
        squashed = np.tanh(c_new)
        if keep is not None:
            keep.append((k, dropped, c_old, i, f, g, o, squashed))
        h[:k], c[:k] = o * squashed, c_new
    a = np.maximum(h @ w["w1"] + w["b1"], 0.0)
    dropped_a = a * m["a"] if "a" in m else a
    if keep is not None:
        keep.append((order, m, inputs, h, a, dropped_a))
    logit = np.empty(n, np.result_type(dropped_a, w["w2"]))
    logit[order] = (dropped_a @ w["w2"] + w["b2"])[:, 0]
    return logit


def gradient(w: Weights, x: np.ndarray, y: np.ndarray, masks: dict[str, np.ndarray] | None = None) -> tuple[float, Weights]:
    """Sum of the logistic losses and its gradient, by back-propagation through time."""
    kept: list = []
    logit = forward(w, x, masks, kept)
    order, m, inputs, h_last, a, dropped_a = kept.pop()
    logit, y = logit[order], y[order]
    sign = np.where(y > 0, 1.0, -1.0)
    loss = float(np.logaddexp(0.0, -sign * logit).sum())
    d_logit = (_sigmoid(logit) - y)[:, None].astype(x.dtype)
    g: Weights = {"w2": dropped_a.T @ d_logit, "b2": d_logit.sum(axis=0)}
    d_a = d_logit @ w["w2"].T
    d_a = (d_a * m["a"] if "a" in m else d_a) * (a > 0)
    g["w1"], g["b1"] = h_last.T @ d_a, d_a.sum(axis=0)
    d_h, d_c = d_a @ w["w1"].T, np.zeros_like(h_last)
    g["wx"], g["wh"], g["b"] = np.zeros_like(w["wx"]), np.zeros_like(w["wh"]), np.zeros_like(w["b"])
    for t in reversed(range(len(kept))):
        k, dropped, c, i, f, cand, o, squashed = kept[t]
        own_h = d_h[:k]
        own_c = d_c[:k] + own_h * o * (1 - squashed ** 2)
        d_z = np.concatenate([
            own_c * cand * i * (1 - i), own_c * c * f * (1 - f), own_c * i * (1 - cand ** 2), own_h * squashed * o * (1 - o)], axis=1)
        g["wx"] += inputs[:k, t].T @ d_z
        g["wh"] += dropped.T @ d_z
        g["b"] += d_z.sum(axis=0)
        back = d_z @ w["wh"].T
        d_h[:k] = back * m["h"][:k] if "h" in m else back
        d_c[:k] = own_c * f
    return loss, g


def _masks(rnd: np.random.Generator, n: int, features: int, s: Recurrent) -> dict[str, np.ndarray]:
    def drop(rate: float, width: int) -> np.ndarray:
        return ((rnd.random((n, width)) >= rate) / (1 - rate)).astype(np.float32)

    out = {}
    if s.dropout:
        out |= {"x": drop(s.dropout, features), "a": drop(s.dropout, s.dense)}
    if s.recurrent_dropout:
        out["h"] = drop(s.recurrent_dropout, s.hidden)
    return out


def binned_auc(positive: np.ndarray, negative: np.ndarray) -> float:
    """AUC from counts per score bin, ties counted half; 0.5 where a class is missing."""
    p, n = positive.sum(), negative.sum()
    if not p or not n:
        return 0.5
    below = np.cumsum(negative) - negative
    return float((positive * (below + negative / 2)).sum() / (p * n))


def _histograms(w: Weights, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros((2, AUC_BINS))
    for at in range(0, len(y), 4_096):
        p = _sigmoid(forward(w, x[at:at + 4_096]))
        bins = np.minimum((p * AUC_BINS).astype(int), AUC_BINS - 1)
        for k in (0, 1):
            out[k] += np.bincount(bins[y[at:at + 4_096] == k], minlength=AUC_BINS)
    return out


# Sequences of a partition: inputs, labels, roles, and the partition's number.
Part = tuple[np.ndarray, np.ndarray, np.ndarray, int]
# (epoch, step, weights) -> number of rows and the gradients' sums; weights -> score histograms of the rows that decide.
Sums = Callable[[int, int, Weights], tuple[float, Weights]]
Scores = Callable[[Weights], np.ndarray]


def train(w: Weights, steps: int, s: Recurrent, sums: Sums, scores: Scores) -> tuple[Weights, list[float]]:
    """Best weights and the AUC after every epoch."""
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    best, history, updates = (-1.0, w), [], 0
    for epoch in range(s.epochs):
        for step in range(steps):
            rows, g = sums(epoch, step, w)
            n, updates = max(1.0, float(rows)), updates + 1
            rate = s.step * np.sqrt(1 - 0.999 ** updates) / (1 - 0.9 ** updates)
            # The published defaults of Adam.
            for k, part in g.items():
                first[k] = 0.9 * first[k] + 0.1 * part / n
                second[k] = 0.999 * second[k] + 0.001 * (part / n) ** 2
            w = {k: (v - rate * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(np.float32) for k, v in w.items()}
        counts = scores(w)
        history.append(binned_auc(counts[1], counts[0]))
        if history[-1] > best[0]:
            best = history[-1], w
        if len(history) - 1 - int(np.argmax(history)) >= s.patience:
            break
    return best[1], history


def _drawn(part: Part, epoch: int, step: int, steps: int, s: Recurrent) -> np.ndarray:
    """The rows of a step: every partition spreads its own evenly over the steps, anew in each epoch."""
    order = np.random.default_rng([s.seed, epoch, part[3]]).permutation(np.flatnonzero(part[2] == TRAIN))
    return order[len(order) * step // steps:len(order) * (step + 1) // steps]


def _gradient_sums(part: Part, w: Weights, epoch: int, step: int, steps: int, s: Recurrent) -> np.ndarray:
    """Number of rows and gradients, one after the other."""
    x, y, _, own = part
    rows, rnd = _drawn(part, epoch, step, steps, s), np.random.default_rng([s.seed, epoch, own, step])
    _, g = gradient(w, x[rows], y[rows], _masks(rnd, len(rows), x.shape[2], s))
    return np.concatenate([[float(len(rows))], *[g[k].ravel() for k in w]]).astype(np.float64)


def train_held(part: Part, role: int, w: Weights, steps: int, s: Recurrent) -> tuple[Weights, list[float]]:
    """``train`` on sequences in memory; rows of ``role`` decide when to stop."""
    x, y, held = part[0], part[1], part[2] == role
    drawn: dict[int, tuple[np.ndarray, np.random.Generator]] = {}

    def sums(epoch: int, step: int, w: Weights) -> tuple[float, Weights]:
        if epoch not in drawn:
            drawn.clear()
            rnd = np.random.default_rng([s.seed, epoch, 0])
            drawn[epoch] = rnd.permutation(np.flatnonzero(part[2] == TRAIN)), rnd
        order, rnd = drawn[epoch]
        rows = order[len(order) * step // steps:len(order) * (step + 1) // steps]
        return len(rows), gradient(w, x[rows], y[rows], _masks(rnd, len(rows), x.shape[2], s))[1]

    return train(w, steps, s, sums, lambda w: _histograms(w, x[held], y[held]))


def train_spread(parts: RDD, role: int, w: Weights, steps: int, s: Recurrent) -> tuple[Weights, list[float]]:
    """``train`` on sequences in the partitions of ``parts``, by one small job per step."""
    def added(sums: Callable[[Part], np.ndarray]) -> np.ndarray:
        each = parts.map(sums)
        return each.treeReduce(np.add) if each.getNumPartitions() > SUMMED_AT_ONCE else sum(each.collect())

    def sums(epoch: int, step: int, w: Weights) -> tuple[float, Weights]:
        flat = added(lambda part: _gradient_sums(part, w, epoch, step, steps, s))
        ends = 1 + np.cumsum([v.size for v in w.values()])
        return flat[0], {k: flat[e - v.size:e].reshape(v.shape) for e, (k, v) in zip(ends, w.items(), strict=True)}

    def scores(w: Weights) -> np.ndarray:
        return added(lambda part: _histograms(w, part[0][part[2] == role], part[1][part[2] == role]))

    return train(w, steps, s, sums, scores)


def _packed(w: Weights) -> str:
    """Weights as text: names and shapes, then all numbers."""
    shapes = {k: list(v.shape) for k, v in w.items()}
    numbers = base64.b64encode(np.concatenate([v.ravel() for v in w.values()]).astype("<f8").tobytes()).decode()
    return json.dumps({"shapes": shapes, "numbers": numbers})


def _unpacked(text: str) -> Weights:
    parsed = json.loads(text)
    numbers, out, at = np.frombuffer(base64.b64decode(parsed["numbers"]), "<f8"), {}, 0
    for k, shape in parsed["shapes"].items():
        size = int(np.prod(shape))
        out[k], at = numbers[at:at + size].reshape(shape), at + size
    return out


class RecurrentModel(Transformer, HasFeaturesCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the probability vector of each sequence; saved and loaded like any stage of a pipeline."""

    weights = Param(Params._dummy(), "weights", "weights as text", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, weights: str = "", settings: str = "") -> None:
        super().__init__()
        self._setDefault(weights="", settings="", featuresCol="features", probabilityCol="probability")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w, length = _unpacked(self.getOrDefault(self.weights)), json.loads(self.getOrDefault(self.settings))["length"]

        def probabilities(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            p = _sigmoid(forward(w, np.stack(rows.to_numpy()).reshape(len(rows), length, -1)))
            return pd.Series(list(np.stack([1 - p, p], axis=1)))

        values = F.pandas_udf(probabilities, "array<double>")(vector_to_array(self.getFeaturesCol()))
        return dataset.withColumn(self.getProbabilityCol(), array_to_vector(values))


def fit(rows: DataFrame, features: str, label: str, role: str, s: Recurrent) -> tuple[RecurrentModel, list[float]]:
    """Train on rows whose ``role`` is 1, with those of 2 deciding when to stop; also the AUC after every epoch.

    ``features`` is an array column, step after step; ``rows`` should be a written table, as it is counted first.
    """
    size = rows.agg(
        F.count_if(F.col(role) == TRAIN).alias("train"), F.count_if(F.col(role) == VALIDATE).alias("held"),
        F.max(F.size(features)).alias("inputs"), F.count("*").alias("n")).first()
    if not size["n"]:
        raise ValueError("no sequences to train on")
    slots = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size["n"] // MOST_ROWS_PER_TASK))
    tasks = max(1, min(slots, -(-size["n"] // ROWS_PER_TASK)))
    decides = VALIDATE if size["held"] else TRAIN
    batch = max(s.batch, -(-size["train"] // s.most_steps))
    steps = max(1, -(-size["train"] // batch))
    w = {k: v.astype(np.float32) for k, v in initial_weights(size["inputs"] // s.length, s).items()}
    source = rows.select(
        F.col(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(role).cast("byte").alias("role"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict({
                    "x": [b.column("x").flatten().to_numpy().astype(np.float32).tobytes()],
                    "y": [b.column("y").to_numpy().tobytes()], "role": [b.column("role").to_numpy().tobytes()]})

    def put_together(own: int, blocks: Iterable) -> list[Part]:
        held = [(
            np.frombuffer(b["x"], np.float32), np.frombuffer(b["y"]), np.frombuffer(b["role"], np.int8)) for b in blocks]
        if not held:
            return []
        x, y, role_ = (np.concatenate(part) for part in zip(*held, strict=True))
        return [(x.reshape(len(y), s.length, -1), y, role_, own)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in put_together(0, (row for b in pack(batches) for row in b.to_pylist())):
            best, history = train_held(part, decides, w, steps, s)
            yield pa.RecordBatch.from_pydict({"weights": [_packed(best)], "auc": pa.array([history], pa.list_(pa.float64()))})

    # Dealt anew, so that parts are alike.
    dealt = source.repartition(tasks)
    if tasks == 1:
        answer = dealt.mapInArrow(run, "weights string, auc array<double>").collect()[0]
        packed, history = answer["weights"], list(answer["auc"])
    else:
        parts = dealt.mapInArrow(pack, "x binary, y binary, role binary").rdd.mapPartitionsWithIndex(put_together)
        parts = parts.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        best, history = train_spread(parts, decides, w, steps, s)
        packed = _packed(best)
        parts.unpersist()
    return RecurrentModel(weights=packed, settings=json.dumps(asdict(s))), history
