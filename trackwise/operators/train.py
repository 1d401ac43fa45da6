"""Transport-mode classifiers on MLlib (TRAIN_CLASSICAL, TRAIN_EMBEDDING and parts).

Parity with the reference is by model family, not by number:
- random forest: same grid (trees 100/200, depth 10/20/unbounded -> 30, min
  split 2/5), 3 stratified folds, accuracy; one forest a fold answers all settings
  (``grow``), the minimum of rows of a split node is applied after the refit;
- RBF SVM: MLlib has no kernel SVM, so Nystroem features (``kernel``) or random Fourier
  features (Rahimi & Recht, 2007) stand for the RBF kernel, followed by one-vs-rest
  linear SVMs (``hinge``) with regularisation ``1 / (C * n)``; gamma 'scale' = 1 / (d * var(X)),
  'auto' = 1 / d; probabilities by Platt scaling of out-of-fold margins;
- MLP: one hidden layer of 256 rectified units, dropout 0.5, Adam on synchronous
  mini-batches (``network``); the first epoch with the highest validation accuracy
  is kept, then scored on the test split.
All other fitting is distributed by MLlib. A saved model scores raw features: the
standardiser is its first stage, the class vocabulary lies beside it.
"""

from __future__ import annotations

import math
import os
import time
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import grow as GR
from . import hinge as HI
from . import kernel as KE
from . import metrics as M
from . import network as NN
from . import splits as SP

# The reference's search grids and split settings.
RF_GRID = {"numTrees": [100, 200], "maxDepth": [10, 20, None], "min_samples_split": [2, 5]}
SVM_GRID = {"C": [0.1, 1, 10], "gamma": ["scale", "auto"]}
CLASSICAL_SEED = 42
CLASSICAL_TEST = 0.2
CV_FOLDS = 3
MLP_HIDDEN = 256
MLP_DROPOUT = 0.5
MLP_RATE = 0.001
MLP_BATCH = 256
MLP_EPOCHS = 100
EMBED_SEED = 3407
EMBED_TEST, EMBED_VAL = 0.15, 0.176
UNBOUNDED_DEPTH = 30  # MLlib's deepest tree
RFF_DIM = 256
SVM_MAX_ITER = 100
#: Rows that are worth a task of their own in every iteration of a fit.
TASK_ROWS = 4096


def seeded_uniforms(n: int, seed: int) -> np.ndarray:
    """``n`` numbers in (0, 1) from a counter-based 64-bit mixer (splitmix64): the
    same for every library version, so saved models load with equal weights."""
    mask = (1 << 64) - 1
    z = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64((seed * 0xD1342543DE82EF95) & mask)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


class RandomFourierFeatures(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``sqrt(2/D) * cos(W x + b)`` with ``W ~ N(0, 2 gamma)``, ``b ~ U(0, 2 pi)``.

    W and b follow from the seed (``seeded_uniforms``). One matrix product per
    Arrow batch in a Pandas UDF.
    """

    gamma = Param(Params._dummy(), "gamma", "RBF kernel width", typeConverter=TypeConverters.toFloat)
    numFeatures = Param(Params._dummy(), "numFeatures", "output dimension", typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, outputCol="features", gamma=1.0, numFeatures=RFF_DIM, seed=42):
        super().__init__()
        self._setDefault(gamma=1.0, numFeatures=RFF_DIM, seed=42, outputCol="features")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        d, g, s = self.getOrDefault(self.numFeatures), self.getOrDefault(self.gamma), self.getOrDefault(self.seed)
        u = seeded_uniforms(2 * d * len(cols) + d, s)
        n = d * len(cols)
        normal = np.sqrt(-2 * np.log(u[:n])) * np.cos(2 * math.pi * u[n:2 * n])  # Box-Muller
        w = (normal * math.sqrt(2.0 * g)).reshape(d, len(cols))
        b, scale = u[2 * n:] * 2 * math.pi, math.sqrt(2.0 / d)

        @F.pandas_udf("array<double>")
        def features(x: pd.Series) -> pd.Series:
            z = np.cos(np.stack(x.to_numpy()).astype(np.float64) @ w.T + b) * scale if len(x) else np.zeros((0, d))
            return pd.Series(list(z))

        z = features(F.array(*[F.col(c).cast("double") for c in cols]))
        return df.withColumn(self.getOutputCol(), array_to_vector(z))


def prepare_classical(features: DataFrame, feature_cols: list[str], label: str = "label",
                      key: str = "unique_id", seed: int = CLASSICAL_SEED):
    """LABEL_ENCODE + STRAT_SPLIT + STANDARDISE + KFOLD.

    Returns ``(train, test, vocab, stats)``; ``train`` has a ``fold`` column.
    """
    vocab = M.class_vocab(features, label)
    enc = M.encode_labels(features, vocab, label, "label_index").withColumn(
        "label_index", F.col("label_index").cast("double"))
    split = SP.stratified_split(enc, label, key, CLASSICAL_TEST, seed)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    stats = SP.fit_standardiser(train, feature_cols)
    train = SP.kfold(SP.apply_standardiser(train, stats), label, key, CV_FOLDS, seed)
    test = SP.apply_standardiser(test, stats)
    return train, test, vocab, stats


def standardiser_stage(stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    """STANDARDISE as a pipeline stage that is saved with the model."""
    exprs = [f"CAST({0.0 if not s else f'(`{c}` - {m!r}D) / {s!r}D'} AS DOUBLE) AS `{c}`" for c, (m, s) in stats.items()]
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in stats)}), {', '.join(exprs)} FROM __THIS__")


class Search(NamedTuple):
    model: PipelineModel             # refitted on all training rows with the best setting
    settings: list[dict[str, object]]
    accuracies: list[float]          # mean over the folds, in grid order


def random_forest_search(train: DataFrame, feature_cols: list[str], parallelism: int = 8, key: str = "unique_id") -> Search:
    """GRID_SEARCH + RANDOM_FOREST: cross-validated grid, refit on the best (ties: the earlier setting).

    One forest a fold, of the most trees and the greatest depth, answers all settings (``grow``);
    ``min_samples_split`` prunes the refitted forest, whose nodes stay a table (``forest``).
    """
    depths = [UNBOUNDED_DEPTH if d is None else d for d in RF_GRID["maxDepth"]]
    settings = [{"numTrees": t, "maxDepth": d, "min_samples_split": m}
                for t in RF_GRID["numTrees"] for d in depths for m in RF_GRID["min_samples_split"]]
    stops = [(d, m) for d in depths for m in RF_GRID["min_samples_split"]]
    with ThreadPool(min(parallelism, CV_FOLDS)) as pool:
        per_fold = pool.map(lambda f: GR.held_out_accuracies(train, feature_cols, key, f, RF_GRID["numTrees"], stops, CLASSICAL_SEED), range(CV_FOLDS), chunksize=1)
    accuracies = [float(np.mean(a)) for a in zip(*per_fold)]
    best = settings[int(np.argmax(accuracies))]
    model = GR.grow_forest(train, feature_cols, key, best["numTrees"], best["maxDepth"], best["min_samples_split"], CLASSICAL_SEED)
    return Search(PipelineModel(stages=[VectorAssembler(inputCols=feature_cols, outputCol="features"), model]), settings, accuracies)


def svm_search(train: DataFrame, feature_cols: list[str], parallelism: int = 8, kernel: str = "nystroem", key: str = "unique_id") -> Search:
    """GRID_SEARCH + SVM_RBF: kernel features, one-vs-rest linear SVMs, Platt's probabilities.

    The feature map (``kernel``: "nystroem" or "fourier") depends only on gamma, so it is
    computed once per gamma and persisted as blocks of rows; the machines of all settings, folds
    and classes, and those refitted on all rows, are fitted side by side, one job an evaluation
    (``hinge``). The sigmoid of the probabilities is fitted on the margins of held-out folds.
    """
    n = train.count()
    d = len(feature_cols)
    var_row = (train.select(F.explode(F.array(*[F.col(c) for c in feature_cols])).alias("_x"))
                    .agg(F.var_pop("_x")).first())
    x_var = var_row[0] or 0.0
    gammas = {"scale": 1.0 / (d * x_var) if x_var > 0 else 1.0, "auto": 1.0 / d}
    marks = KE.choose_landmarks(train, feature_cols, key, CLASSICAL_SEED) if kernel == "nystroem" else None

    labels = int(train.agg(F.max("label_index")).first()[0] or 0) + 1
    # regularisation as the reference SVM's C, tolerance too (1e-3); inputs are already standardised
    machines = [HI.Machine(i, fold, label, 1.0 / (c * n)) for i, c in enumerate(SVM_GRID["C"])
                for fold in (*range(CV_FOLDS), -1) for label in range(labels)]

    def search(name: str):
        """Accuracies by C, the feature map, the refitted machines of the best C and its held-out margins."""
        stage = KE.NystroemFeatures.of(feature_cols, gammas[name], marks) if marks is not None else RandomFourierFeatures(
            inputCols=feature_cols, outputCol="features", seed=CLASSICAL_SEED, gamma=gammas[name])
        z = stage.transform(train).select("label_index", "fold", "features").coalesce(max(1, n // TASK_ROWS))
        blocks = HI.pack_rows(z).persist()
        weights = HI.fit_machines(blocks, machines, SVM_MAX_ITER).reshape(len(SVM_GRID["C"]), CV_FOLDS + 1, labels, -1)
        scores = HI.held_out_accuracies(blocks, weights[:, :-1])
        top = int(np.argmax(scores))
        margins = materialize(HI.held_out_margins(blocks, weights[top, :-1]), "margins")
        blocks.unpersist()
        return [float(a) for a in scores], stage, weights[top, -1], margins

    with ThreadPool(min(parallelism, len(SVM_GRID["gamma"]))) as pool:
        found = pool.map(search, SVM_GRID["gamma"], chunksize=1)
    settings = [{"C": c, "gamma": name} for name in SVM_GRID["gamma"] for c in SVM_GRID["C"]]
    accuracies = [a for scores, *_ in found for a in scores]
    _, stage, weights, held_out = max(found, key=lambda f: max(f[0]))
    slope, offset = KE.fit_platt(held_out)
    return Search(PipelineModel(stages=[stage, HI.OneVsRestMachines.of(weights), KE.PlattScaling(slope=slope, offset=offset)]), settings, accuracies)


def grid_table(spark, search: Search) -> DataFrame:
    """The grid search as a table: one row per parameter set with its mean accuracy."""
    rows = [(i, ", ".join(f"{k}={v}" for k, v in sorted(s.items())), a) for i, (s, a) in enumerate(zip(search.settings, search.accuracies))]
    return spark.createDataFrame(rows, "setting int, params string, accuracy double")


def predict(model, df: DataFrame, vocab: DataFrame, key: str = "unique_id", label: str = "label") -> DataFrame:
    """PREDICT: ``key, actual, predicted`` class names."""
    return class_names(model.transform(df), vocab, key, label)


def class_names(scored: DataFrame, vocab: DataFrame, key: str = "unique_id", label: str = "label") -> DataFrame:
    """``key, actual, predicted`` of scored rows."""
    v = vocab.select(F.col("index").cast("double").alias("prediction"), F.col("label").alias("predicted"))
    return scored.join(v, "prediction", "left").select(key, F.col(label).alias("actual"), "predicted")


def train_classical(features: DataFrame, feature_cols: list[str], model_type: str = "random_forest",
                    out_dir: str | None = None, parallelism: int = 8) -> dict:
    """TRAIN_CLASSICAL end to end. Returns report, predictions, grid table, the training and
    test rows, and, when ``out_dir`` is given, the saved model folder (MODEL_SINK + RUN_DIR)."""
    train, test, vocab, stats = prepare_classical(features, feature_cols)
    # cut the lineage once: every fold and every tree level re-reads these files
    train = materialize(train, "classical_train").persist()
    test = materialize(test, "classical_test")
    vocab = materialize(vocab, "classical_vocab")
    search = (random_forest_search if model_type == "random_forest" else svm_search)(train, feature_cols, parallelism)
    scored = materialize(search.model.transform(test).select("unique_id", "label", "label_index", "prediction", "probability"), "classical_scored")
    preds = materialize(class_names(scored, vocab, "unique_id", "label"), "classical_predictions")
    report = M.class_report(preds, vocab=vocab)
    out = {"report": report, "predictions": preds, "scored": scored, "grid": grid_table(features.sparkSession, search),
           "vocab": vocab, "stats": stats, "train": train, "test": test, "search": search,
           "model": PipelineModel(stages=[standardiser_stage(stats), *search.model.stages])}
    if out_dir:
        out["saved"] = save_run(out["model"], vocab, report, out_dir, model_type)
    train.unpersist()
    return out


def save_run(model: PipelineModel, vocab: DataFrame, report: DataFrame, out_dir: str, name: str) -> str:
    """MODEL_SINK + RUN_DIR: ``out_dir/<name>-<yyyyMMdd-HHmmss>/{model,vocab,report}``."""
    run = os.path.join(out_dir, f"{name}-{time.strftime('%Y%m%d-%H%M%S')}") if "://" not in out_dir \
        else f"{out_dir.rstrip('/')}/{name}-{time.strftime('%Y%m%d-%H%M%S')}"
    model.write().overwrite().save(run + "/model")
    vocab.write.mode("overwrite").parquet(run + "/vocab")
    report.write.mode("overwrite").parquet(run + "/report")
    return run


def train_embedding(vectors: DataFrame, key: str = "trajectory_id", label: str = "true_label",
                    vec: str = "embedding", epochs: int = MLP_EPOCHS, batch_rows: int = MLP_BATCH,
                    hidden: int = MLP_HIDDEN, dropout: float = MLP_DROPOUT, rate: float = MLP_RATE,
                    out_dir: str | None = None) -> dict:
    """TRAIN_EMBEDDING: 3-way split, MLP with Adam on mini-batches, BEST_MODEL on
    validation accuracy (first maximum wins), test report, and per epoch MEAN_LOSS and
    validation accuracy (``history``); with ``out_dir`` the best model, the vocabulary
    and the report are saved (MODEL_SINK + RUN_DIR)."""
    spark = vectors.sparkSession
    vocab = materialize(M.class_vocab(vectors, label), "embedding_vocab")
    enc = M.encode_labels(vectors, vocab, label, "label_index").withColumn(
        "label_index", F.col("label_index").cast("double"))
    enc = enc.withColumn("features", array_to_vector(F.col(vec).cast("array<double>")))
    split = materialize(SP.three_way_split(enc, label, key, EMBED_TEST, EMBED_VAL, EMBED_SEED), "embedding_split")
    dim = split.select(F.max(F.size(vec))).first()[0] or 0
    rows = split.where(F.col("split").isin("train", "val")).select(
        F.xxhash64(key).alias("hash"), F.col("label_index").cast("long").alias("label"), (F.col("split") == "val").alias("is_val"),
        F.col(vec).cast("array<double>").alias("features"))
    fitted = NN.fit_network(rows, dim, vocab.count(), hidden, dropout, rate, batch_rows, epochs, EMBED_SEED)
    model = NN.NetworkModel.of(fitted)
    preds = materialize(predict(model, split.where(F.col("split") == "test"), vocab, key, label), "embedding_predictions")
    report = M.class_report(preds, vocab=vocab)
    history = spark.createDataFrame([(e, l, a, e == fitted.best_epoch) for e, l, a in fitted.history],
                                    "epoch int, loss double, val_accuracy double, best boolean")
    out = {"report": report, "predictions": preds, "history": history, "model": model, "vocab": vocab, "split": split}
    if out_dir:
        out["saved"] = save_run(PipelineModel(stages=[model]), vocab, report, out_dir, "mlp")
    return out
