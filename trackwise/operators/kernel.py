"""SVM_RBF parts: Nystroem features of the kernel, and Platt's probabilities.

The kernel exp(-gamma |x - y|^2) is replaced by an inner product of features. Random
Fourier features (``train``) approximate it everywhere; Nystroem features are exact between
the landmarks, rows of the training table: K(x, landmarks) K(landmarks, landmarks)^(-1/2).
With no more rows than landmarks the kernel machine is the exact one.
"""

from __future__ import annotations

import base64
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Landmarks of the Nystroem features: the bound of their dimension.
LANDMARKS = 256


def _packed(x: np.ndarray) -> str:
    return base64.b64encode(np.ascontiguousarray(x, dtype="<f8").tobytes()).decode()


def choose_landmarks(train: DataFrame, cols: list[str], key: str, seed: int, most: int = LANDMARKS) -> np.ndarray:
    """Distinct training rows with the smallest seeded hashes, at most ``most`` (they reach the driver)."""
    x = train.select(F.xxhash64(F.lit(seed), key).alias("_h"), *[F.col(c).cast("double") for c in cols]).orderBy("_h", *cols).limit(2 * most)
    rows = np.array([r[1:] for r in x.collect()], dtype=float).reshape(-1, len(cols))
    _, first = np.unique(rows, axis=0, return_index=True)
    return rows[np.sort(first)][:most]


class NystroemFeatures(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose inner products approximate the RBF kernel of width ``gamma``."""

    gamma = Param(Params._dummy(), "gamma", "RBF kernel width", typeConverter=TypeConverters.toFloat)
    landmarks = Param(Params._dummy(), "landmarks", "landmark rows (base64 of doubles)", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outputCol="features", gamma=1.0, landmarks=None):
        super().__init__()
        self._setDefault(gamma=1.0, outputCol="features")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, cols: list[str], gamma: float, landmarks: np.ndarray, output: str = "features") -> NystroemFeatures:
        return cls(inputCols=cols, outputCol=output, gamma=gamma, landmarks=_packed(landmarks))

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, g = self.getInputCols(), self.getOrDefault(self.gamma)
        marks = np.frombuffer(base64.b64decode(self.getOrDefault(self.landmarks)), dtype="<f8").reshape(-1, len(cols))
        size = (marks * marks).sum(axis=1)
        kernel = np.exp(-g * np.maximum(size[:, None] + size[None, :] - 2 * marks @ marks.T, 0.0))
        values, axes = np.linalg.eigh(kernel)
        keep = values > 1e-10 * values.max()
        root = axes[:, keep] / np.sqrt(values[keep])

        @F.pandas_udf("array<double>")
        def features(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            rows = np.stack(x.to_numpy()).astype(np.float64)
            square = (rows * rows).sum(axis=1)[:, None] + size[None, :] - 2 * rows @ marks.T
            return pd.Series(list(np.exp(-g * np.maximum(square, 0.0)) @ root))

        z = features(F.array(*[F.col(c).cast("double") for c in cols]))
        return df.withColumn(self.getOutputCol(), array_to_vector(z))


def fit_platt(margins: DataFrame, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of P(hit) = 1 / (1 + exp(-(a * margin + b))) by Newton's method.

    ``margins``: ``margin double, hit boolean``. Targets are smoothed by the class
    counts as Platt proposes. Every round is one aggregation: six numbers reach the driver.
    """
    n1, n0 = margins.agg(F.count_if(F.col("hit")), F.count_if(~F.col("hit"))).first()
    t = F.when(F.col("hit"), (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
    m = F.col("margin")

    def at(a: float, b: float):
        z = m * a + b
        p = 1 / (1 + F.exp(-z))
        # log(1 + exp(z)) - t z, without overflow
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - t * z
        w = p * (1 - p)
        return [v or 0.0 for v in margins.agg(F.sum(loss), F.sum((p - t) * m), F.sum(p - t), F.sum(w * m * m), F.sum(w * m), F.sum(w)).first()]

    a, b = 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    loss, *rest = at(a, b)
    for _ in range(rounds):
        ga, gb, haa, hab, hbb = rest
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab
        if abs(ga) + abs(gb) < 1e-6 * max(1, n0 + n1) ** 0.5 or det <= 0:
            break
        da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
        step = 1.0
        while step > 1e-6:
            tried, *new = at(a + step * da, b + step * db)
            if tried < loss + 1e-4 * step * (ga * da + gb * db):
                break
            step /= 2
        else:
            break
        a, b, loss, rest = a + step * da, b + step * db, tried, new
    return a, b


class PlattScaling(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability``: the sigmoid of each class's margin, scaled to sum 1.

    One sigmoid serves all classes and grows with the margin, so the most likely class is
    the one with the largest margin, the predicted one."""

    slope = Param(Params._dummy(), "slope", "a of the sigmoid", typeConverter=TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "b of the sigmoid", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, slope=1.0, offset=0.0):
        super().__init__()
        self._setDefault(slope=1.0, offset=0.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        a, b = self.getOrDefault(self.slope), self.getOrDefault(self.offset)
        p = F.transform(vector_to_array(F.col("rawPrediction")), lambda m: 1 / (1 + F.exp(-(m * a + b))))
        total = F.aggregate(p, F.lit(0.0), lambda x, y: x + y)
        return df.withColumn("probability", array_to_vector(F.transform(p, lambda v: F.when(total > 0, v / total).otherwise(1.0 / F.size(p)))))
