"""Linear support vector machines of a whole grid, fitted side by side.

All machines of a feature map (settings, folds and classes) minimise mean hinge loss +
regularisation / 2 * |w|^2 (no penalty on the intercept) by L-BFGS with a line search. Every
evaluation is one job for all of them: a task multiplies its blocks of rows by the weights of
all machines at once, sums of losses and subgradients are added in Spark, and one vector a
machine reaches the driver, however many rows or tasks there are.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs of steps and gradient changes that L-BFGS keeps, and tried steps of a line search.
MEMORY, TRIES = 10, 20
#: Steps over which the loss must have fallen, relative to the tolerance.
HISTORY = 20


class Machine(NamedTuple):
    """One machine: class against the rest, on the rows outside ``fold`` (-1: all rows)."""
    setting: int
    fold: int
    label: int
    reg: float


def pack_rows(z: DataFrame) -> DataFrame:
    """Blocks of rows (``labels``, ``folds``: 4-byte integers, ``x``: doubles) from ``label_index, fold, features``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                label, fold = (np.asarray(b.column(i)).astype(np.int32).tobytes() for i in (0, 1))
                x = np.asarray(b.column(2).flatten()).astype(np.float64).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (label, fold, x)], names=["labels", "folds", "x"])
    return z.select("label_index", "fold", vector_to_array("features")).mapInArrow(run, "labels binary, folds binary, x binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        for label, fold, x in zip(*(b.column(i) for i in range(3))):
            label = np.frombuffer(label.as_buffer(), dtype=np.int32)
            yield label, np.frombuffer(fold.as_buffer(), dtype=np.int32), np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(len(label), -1)


def _sums(task):
    """One row a result of ``task`` (id -> vector), from all blocks of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            part = task(*block)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([v.tobytes() for v in total], pa.binary())], names=["id", "v"])
    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(v, dtype=np.float64) for v in pdf["v"]], axis=0)
    return pd.DataFrame({"id": pdf["id"].iloc[:1], "v": [total.tobytes()]})


def _over_blocks(blocks: DataFrame, task) -> np.ndarray:
    """The sum over all blocks of the matrix that ``task`` makes of one; a row a group."""
    parts = blocks.mapInArrow(_sums(task), "id int, v binary").groupBy("id").applyInPandas(_added, "id int, v binary").collect()
    return np.stack([np.frombuffer(r["v"], dtype=np.float64) for r in sorted(parts, key=lambda r: r["id"])])


def _evaluate(blocks: DataFrame, machines: list[Machine], w: np.ndarray) -> np.ndarray:
    """Per machine: sum of hinge losses, then its subgradient by weight and intercept."""
    label = np.array([m.label for m in machines])
    fold = np.array([m.fold for m in machines])

    def task(labels: np.ndarray, folds: np.ndarray, x: np.ndarray) -> np.ndarray:
        sign = np.where(labels[:, None] == label, 1.0, -1.0)
        short = 1.0 - sign * (x @ w[:, :-1].T + w[:, -1])
        hit = (short > 0) & (folds[:, None] != fold)
        pull = np.where(hit, -sign, 0.0)
        return np.column_stack([np.where(hit, short, 0.0).sum(axis=0), pull.T @ x, pull.sum(axis=0)])

    return _over_blocks(blocks, task)


class _Descent:
    """L-BFGS of one machine, one evaluation at a time (weak Wolfe conditions by bisection)."""

    def __init__(self, dim: int, scale: np.ndarray):
        self.w, self.scale, self.pairs, self.values, self.done, self.steps = np.zeros(dim), scale, [], [], False, 0
        self.value = self.grad = self.way = None
        self.ask = self.w

    def _direction(self) -> np.ndarray:
        q, used = self.grad.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        size = 1.0
        if self.pairs:
            s, y = self.pairs[-1]
            size = (s @ y) / (y @ (self.scale * y))
        q *= self.scale * size
        for (s, y), a in zip(self.pairs, reversed(used)):
            q += (a - (y @ q) / (s @ y)) * s
        return -q

    def _next(self, tol: float, most: int) -> None:
        self.values.append(self.value)
        past = self.values[-HISTORY - 1] if len(self.values) > HISTORY else np.inf
        if self.steps >= most or np.linalg.norm(self.grad) <= max(tol * abs(self.value), 1e-8) or past - self.value <= tol * abs(self.value):
            self.done = True
            return
        self.way = self._direction()
        self.slope = self.grad @ self.way
        if self.slope >= 0:
            self.pairs, self.way = [], -self.scale * self.grad
            self.slope = self.grad @ self.way
        self.low, self.high, self.tries = 0.0, np.inf, 0
        self.step = 1.0 if self.pairs else 1.0 / max(1.0, np.linalg.norm(self.way))
        self.ask = self.w + self.step * self.way

    def tell(self, value: float, grad: np.ndarray, tol: float, most: int) -> None:
        if self.value is None:
            self.value, self.grad = value, grad
            self._next(tol, most)
            return
        fine = value <= self.value + 1e-4 * self.step * self.slope
        self.tries += 1
        if fine and (grad @ self.way >= 0.9 * self.slope or self.tries >= TRIES):
            s, y = self.ask - self.w, grad - self.grad
            if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs, (s, y)][-MEMORY:]
            self.w, self.value, self.grad, self.steps = self.ask, value, grad, self.steps + 1
            self._next(tol, most)
            return
        if self.tries >= TRIES:
            self.done = True
            return
        self.low, self.high = (self.step, self.high) if fine else (self.low, self.step)
        self.step = (self.low + self.high) / 2 if np.isfinite(self.high) else 2 * self.step
        self.ask = self.w + self.step * self.way


def fit_machines(blocks: DataFrame, machines: list[Machine], most: int = 100, tol: float = 1e-3) -> np.ndarray:
    """Weights of the machines, intercept last; every evaluation is one job for all of them."""
    folds = sorted({m.fold for m in machines})

    def moments(labels: np.ndarray, kept: np.ndarray, x: np.ndarray) -> np.ndarray:
        counts = np.zeros(x.shape[1])
        counts[0] = len(labels)
        rest = np.zeros((len(folds), x.shape[1]))
        rest[:, 0] = [(kept != f).sum() for f in folds]
        return np.concatenate([[counts, x.sum(axis=0), (x * x).sum(axis=0)], rest])

    seen = _over_blocks(blocks, moments)
    n = seen[0, 0]
    rows = dict(zip(folds, seen[3:, 0]))
    var = np.maximum(seen[2] / n - (seen[1] / n) ** 2, 0.0)
    # first guess of the curvature; axes that hardly vary are not stretched further
    scale = np.append(1.0 / (var + (0.1 * var.max() or 1.0)), 1.0)
    runs = [_Descent(len(scale), scale) for _ in machines]
    while True:
        todo = [i for i, r in enumerate(runs) if not r.done and rows[machines[i].fold]]
        if not todo:
            break
        got = _evaluate(blocks, [machines[i] for i in todo], np.stack([runs[i].ask for i in todo]))
        for i, (loss, *grad) in zip(todo, got):
            r, m = runs[i], machines[i]
            free = np.append(r.ask[:-1], 0.0)
            r.tell(loss / rows[m.fold] + m.reg / 2 * (free @ free), np.array(grad) / rows[m.fold] + m.reg * free, tol, most)
    return np.stack([r.w for r in runs])


def held_out_accuracies(blocks: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Mean accuracy over the folds by setting; ``weights``: setting, fold, class, weight."""
    settings, folds = weights.shape[:2]

    def task(labels: np.ndarray, fold: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros((settings + 1, folds))
        for f in range(folds):
            at = fold == f
            out[settings, f] = at.sum()
            for s in range(settings):
                out[s, f] = ((x[at] @ weights[s, f, :, :-1].T + weights[s, f, :, -1]).argmax(axis=1) == labels[at]).sum()
        return out

    seen = _over_blocks(blocks, task)
    return np.array([np.mean([r / n for r, n in zip(row, seen[-1]) if n]) for row in seen[:-1]])


def held_out_margins(blocks: DataFrame, weights: np.ndarray) -> DataFrame:
    """``margin, hit`` of every row and class by the machines of its fold; ``weights``: fold, class, weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, fold, x in _blocks(batches):
            for f in range(len(weights)):
                at = fold == f
                m = x[at] @ weights[f, :, :-1].T + weights[f, :, -1]
                hit = labels[at][:, None] == np.arange(m.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(m.ravel()), pa.array(hit.ravel())], names=["margin", "hit"])
    return blocks.mapInArrow(run, "margin double, hit boolean")


class OneVsRestMachines(Transformer, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction`` (a margin a class) and ``prediction`` (the class of the largest)."""

    weights = Param(Params._dummy(), "weights", "weights and intercept of each class (base64 of doubles)", typeConverter=TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", weights=None, classes=None):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, w: np.ndarray) -> OneVsRestMachines:
        return cls(weights=base64.b64encode(np.ascontiguousarray(w, dtype="<f8").tobytes()).decode(), classes=len(w))

    def _transform(self, df: DataFrame) -> DataFrame:
        w = np.frombuffer(base64.b64decode(self.getOrDefault(self.weights)), dtype="<f8").reshape(self.getOrDefault(self.classes), -1)

        @F.pandas_udf("array<double>")
        def margins(x: pd.Series) -> pd.Series:
            return pd.Series(list(np.stack(x.to_numpy()) @ w[:, :-1].T + w[:, -1]) if len(x) else [], dtype=object)

        d = df.withColumn("_raw", margins(vector_to_array(self.getFeaturesCol())))
        return d.withColumns({"rawPrediction": array_to_vector("_raw"),
                              "prediction": (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double")}).drop("_raw")
