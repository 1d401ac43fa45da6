"""MLP: one hidden layer of rectified units, dropout and Adam on mini-batches.

The rows are dealt by hash to replicas of about ``TASK_ROWS`` training rows, kept as
NumPy arrays in one task each (a persisted RDD, read again from the written rows when an
executor is lost). An epoch is one job: every replica starts from the common weights and
moments and makes the Adam steps of its own mini-batches; their weights and moments are
then averaged by the replicas' rows (local SGD). Every row is in one mini-batch of every
epoch. A table of one replica is trained by plain mini-batches. Which replica and mini-batch
a row belongs to, and which hidden units it drops, follow from the seed, the epoch and the
row's hash by a counter-based mixer: the same for any partitioning, and when a task runs again.

Validation accuracy after an epoch is counted at the start of the next one (same
weights, same job); after the last epoch by a pass of its own.
"""

from __future__ import annotations

import base64
import math
import sys
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Training rows of a replica, which one task holds; sums of states that one task adds up.
TASK_ROWS, ADD_STATES = 16_384, 16
# Fixed values of the optimiser (its published defaults).
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


class Layers(NamedTuple):
    inputs: int
    hidden: int
    classes: int

    def split(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Views of the two weight matrices and the two biases."""
        d, h, k = self
        a, b, c = d * h, d * h + h, d * h + h + h * k
        return flat[:a].reshape(d, h), flat[a:b], flat[b:c].reshape(h, k), flat[c:]

    @property
    def size(self) -> int:
        return self.inputs * self.hidden + self.hidden + self.hidden * self.classes + self.classes


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salted(seed: int, epoch: int, what: int) -> np.uint64:
    return mix(np.array([(seed * 0x9E3779B97F4A7C15 + epoch * 0xD1342543DE82EF95 + what + 1) & ((1 << 64) - 1)], dtype=np.uint64))[0]


def initial_weights(layers: Layers, seed: int) -> np.ndarray:
    """Weights and biases uniform in +-1 / sqrt(inputs of the layer)."""
    u = (mix(np.arange(1, layers.size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _salted(seed, 0, 7)) >> np.uint64(11)) / float(1 << 53)
    flat = 2 * u - 1
    w1, b1, w2, b2 = layers.split(flat)
    for part, fan_in in ((w1, layers.inputs), (b1, layers.inputs), (w2, layers.hidden), (b2, layers.hidden)):
        part /= math.sqrt(max(fan_in, 1))
    return flat


def batch_of(rows: np.ndarray, seed: int, epoch: int, batches: int) -> np.ndarray:
    """Mini-batch of each row in an epoch (``rows``: row hashes)."""
    return mix(rows ^ _salted(seed, epoch, 1)) % np.uint64(batches)


def dropout_mask(rows: np.ndarray, hidden: int, rate: float, seed: int, epoch: int) -> np.ndarray:
    """Factor of each hidden unit for each row: 0 with probability ``rate``, else 1 / (1 - rate)."""
    unit = mix(np.arange(1, hidden + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    u = (mix((rows ^ _salted(seed, epoch, 2))[:, None] ^ unit[None, :]) >> np.uint64(11)) / float(1 << 53)
    return (u >= rate) / (1.0 - rate)


def scores(layers: Layers, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Class scores (before softmax), nothing dropped."""
    w1, b1, w2, b2 = layers.split(flat)
    return np.maximum(x @ w1 + b1, 0.0) @ w2 + b2


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_and_gradient(layers: Layers, flat: np.ndarray, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the rows and its gradient, flat like the weights."""
    w1, b1, w2, b2 = layers.split(flat)
    raw = x @ w1 + b1
    hidden = np.maximum(raw, 0.0) * mask
    p = softmax(hidden @ w2 + b2)
    at = np.arange(len(y))
    loss = -np.log(np.maximum(p[at, y], 1e-300)).sum()
    p[at, y] -= 1.0
    back = (p @ w2.T) * mask * (raw > 0)
    return float(loss), np.concatenate([(x.T @ back).ravel(), back.sum(0), (hidden.T @ p).ravel(), p.sum(0)])


def adam_step(flat: np.ndarray, gradient: np.ndarray, first: np.ndarray, second: np.ndarray, step: int, rate: float) -> None:
    """One Adam update, in place; ``step`` counts from 1."""
    first += (1 - BETA1) * (gradient - first)
    second += (1 - BETA2) * (gradient * gradient - second)
    flat -= rate * (first / (1 - BETA1 ** step)) / (np.sqrt(second / (1 - BETA2 ** step)) + EPSILON)


class Fitted(NamedTuple):
    layers: Layers
    weights: np.ndarray                             # of the best epoch
    best_epoch: int
    history: list[tuple[int, float, float | None]]  # epoch, mean loss of its batches, validation accuracy after it


def replica_of(rows: np.ndarray, seed: int, replicas: int) -> np.ndarray:
    """Replica of each row, for all epochs (``rows``: row hashes)."""
    return (mix(rows ^ _salted(seed, 0, 3)) % np.uint64(replicas)).astype(np.int64)


def _replicas(rows: DataFrame, dims: int, seed: int, replicas: int):
    """RDD with one (hash, label, is_val, matrix) a partition: the rows of a replica, by hash."""
    import pyarrow as pa

    def to_bytes(batches):
        for b in batches:
            x = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
            h, y, v = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cols = [h.astype(np.int64), y.astype(np.int64), v.astype(np.bool_), x]
            to = replica_of(cols[0].view(np.uint64), seed, replicas)
            own = [np.flatnonzero(to == r) for r in np.unique(to)]
            yield pa.RecordBatch.from_arrays([pa.array([int(to[i[0]]) for i in own], pa.int64()),
                                              *[pa.array([c[i].tobytes() for i in own], pa.binary()) for c in cols]], names=["r", "h", "y", "v", "x"])

    def to_arrays(parts):
        parts = [p for _, p in parts]
        h, y, v, x = (np.frombuffer(b"".join(p[i] for p in parts), dtype=kind) for i, kind in enumerate((np.int64, np.int64, np.bool_, np.float64)))
        x = x.reshape(len(h), dims)
        order = np.lexsort((*x.T[:1], y, h))
        yield h[order].view(np.uint64), y[order], v[order], x[order]

    keyed = rows.mapInArrow(to_bytes, "r long, h binary, y binary, v binary, x binary").rdd.map(lambda r: (r["r"], (r["h"], r["y"], r["v"], r["x"])))
    return keyed.partitionBy(replicas, lambda r: r).mapPartitions(to_arrays)


class State:
    """Weights and the optimiser's moments."""

    def __init__(self, flat: np.ndarray):
        self.flat, self.first, self.second, self.step = flat, np.zeros_like(flat), np.zeros_like(flat), 0

    def epoch(self, replica, layers: Layers, batch_rows: int, dropout: float, rate: float, seed: int, epoch: int) -> list[float]:
        """The steps of a replica's mini-batches, in place; returns the mean loss of each."""
        rows, y, is_val, x = replica
        train = np.flatnonzero(~is_val)
        batches = max(1, -(-len(train) // batch_rows))
        batch = batch_of(rows[train], seed, epoch, batches)
        order = np.argsort(batch, kind="stable")
        ends = np.searchsorted(batch[order], np.arange(batches + 1, dtype=np.uint64))
        losses = []
        for lo, hi in zip(ends[:-1], ends[1:]):
            own = train[order[lo:hi]]
            if len(own):
                loss, gradient = loss_and_gradient(layers, self.flat, x[own], y[own], dropout_mask(rows[own], layers.hidden, dropout, seed, epoch))
                self.step += 1
                adam_step(self.flat, gradient / len(own), self.first, self.second, self.step, rate)
                losses.append(loss / len(own))
        return losses


def right_rows(replica, layers: Layers, flat: np.ndarray) -> int:
    """Validation rows that the weights predict rightly."""
    _, y, is_val, x = replica
    return int((scores(layers, flat, x[is_val]).argmax(axis=1) == y[is_val]).sum()) if is_val.any() else 0


def add_up(sums, parts: int):
    """Sum of an RDD of arrays, added up in tasks; one of them reaches the driver."""
    while parts > 1:
        parts = -(-parts // ADD_STATES)
        sums = sums.mapPartitionsWithIndex(lambda i, part, n=parts: [(i % n, s) for s in part]).reduceByKey(np.add, parts, lambda r: r).values()
    return sums.first()


def fit_network(rows: DataFrame, dims: int, classes: int, hidden: int = 256, dropout: float = 0.5, rate: float = 1e-3,
                batch_rows: int = 256, epochs: int = 100, seed: int = 0) -> Fitted:
    """Train on ``rows`` (``hash long, label long, is_val boolean, features array<double>``).

    The best epoch is the first with the highest validation accuracy (without
    validation rows: the last epoch). An epoch is a job of one task a replica.
    """
    layers = Layers(dims, hidden, classes)
    n_train, n_val = rows.agg(F.count_if(~F.col("is_val")), F.count_if("is_val")).first()
    replicas = max(1, round(n_train / TASK_ROWS))
    data = _replicas(rows, dims, seed, replicas).persist(StorageLevel.MEMORY_AND_DISK)
    state = State(initial_weights(layers, seed))

    def run_epoch(epoch: int) -> tuple[State, float, float]:
        """State after the epoch, mean loss of its batches, right validation rows before it."""
        before = state  # travels with the function (Spark broadcasts it beyond a megabyte)

        def in_task(replica):
            own = State(before.flat.copy())
            own.first, own.second, own.step = before.first.copy(), before.second.copy(), before.step
            right = right_rows(replica, layers, own.flat)
            losses = own.epoch(replica, layers, batch_rows, dropout, rate, seed, epoch)
            n = float((~replica[2]).sum())
            return np.concatenate([n * own.flat, n * own.first, n * own.second, [n * own.step, n, sum(losses), len(losses), right]])

        total = add_up(data.map(in_task), replicas)
        steps, n, loss, batches, right = total[-5:]
        if not n:
            return before, 0.0, float(right)
        after = State(total[:layers.size] / n)
        after.first, after.second, after.step = total[layers.size:2 * layers.size] / n, total[2 * layers.size:3 * layers.size] / n, round(steps / n)
        return after, float(loss / batches), float(right)

    history: list[tuple[int, float, float | None]] = []
    best, best_epoch, best_accuracy = state.flat.copy(), 0, -1.0

    def settle(flat: np.ndarray, right: float) -> None:
        """Note the validation accuracy of the epoch just ended, and keep its weights if it is the best."""
        nonlocal best, best_epoch, best_accuracy
        epoch, loss, _ = history[-1]
        accuracy = float(right / n_val) if n_val else None
        history[-1] = (epoch, loss, accuracy)
        if accuracy is None or accuracy > best_accuracy:
            best, best_epoch, best_accuracy = flat, epoch, -1.0 if accuracy is None else accuracy

    for epoch in range(1, epochs + 1):
        before = state.flat.copy()
        state, loss, right = run_epoch(epoch)
        if history:
            settle(before, right)
        history.append((epoch, loss, None))
    if history:
        flat = state.flat
        settle(flat.copy(), data.map(lambda r: float(right_rows(r, layers, flat))).sum())
    data.unpersist()
    return Fitted(layers, best, best_epoch, history)


class NetworkModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """PREDICT of the network: adds ``probability`` (vector) and ``prediction``, the most likely class.

    Weights are a parameter (base64 of doubles), so the model is saved and loaded
    like any pipeline stage."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of inputs", typeConverter=TypeConverters.toString)
    layers = Param(Params._dummy(), "layers", "inputs, hidden units, classes", typeConverter=TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "weights and biases", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", layers=None, weights=None):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, fitted: Fitted) -> NetworkModel:
        return cls(layers=list(fitted.layers), weights=base64.b64encode(fitted.weights.astype("<f8").tobytes()).decode())

    def _transform(self, df: DataFrame) -> DataFrame:
        layers = Layers(*self.getOrDefault(self.layers))
        flat = np.frombuffer(base64.b64decode(self.getOrDefault(self.weights)), dtype="<f8")

        @F.pandas_udf("array<double>")
        def probabilities(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(softmax(scores(layers, flat, np.stack(x.to_numpy()).astype(np.float64)))))

        p = F.col("_probability")
        return df.withColumn("_probability", probabilities(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))).withColumns({
            "probability": array_to_vector(p), "prediction": (F.array_position(p, F.array_max(p)) - 1).cast("double")}).drop("_probability")
