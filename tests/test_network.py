"""The network: gradients, seeded batches and masks, training, saving."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from trackwise.operators import network as NN
from trackwise.operators import train as TR


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(1)
    layers = NN.Layers(5, 7, 3)
    flat = NN.initial_weights(layers, 3) * 2
    x, y = rng.normal(size=(9, 5)), rng.integers(0, 3, 9)
    mask = NN.dropout_mask(np.arange(9, dtype=np.uint64), 7, 0.5, 3, 1)
    assert 0 < (mask == 0).sum() < mask.size and set(np.unique(mask)) == {0.0, 2.0}
    _, gradient = NN.loss_and_gradient(layers, flat, x, y, mask)
    for i in range(layers.size):
        step = np.zeros(layers.size)
        step[i] = 1e-6
        slope = (NN.loss_and_gradient(layers, flat + step, x, y, mask)[0] - NN.loss_and_gradient(layers, flat - step, x, y, mask)[0]) / 2e-6
        assert abs(slope - gradient[i]) < 1e-5 * max(1, abs(slope))


def test_adam_is_the_published_update():
    rng = np.random.default_rng(2)
    flat, m, v = rng.normal(size=6), np.zeros(6), np.zeros(6)
    want, m2, v2 = flat.copy(), np.zeros(6), np.zeros(6)
    for t in range(1, 6):
        g = rng.normal(size=6)
        NN.adam_step(flat, g, m, v, t, 0.01)
        m2, v2 = 0.9 * m2 + 0.1 * g, 0.999 * v2 + 0.001 * g * g
        want -= 0.01 * (m2 / (1 - 0.9 ** t)) / (np.sqrt(v2 / (1 - 0.999 ** t)) + 1e-8)
    assert np.allclose(flat, want, rtol=0, atol=1e-12)


def test_batches_and_masks_are_seeded():
    rows = NN.mix(np.arange(20_000, dtype=np.uint64))
    a, b = NN.batch_of(rows, 1, 1, 10), NN.batch_of(rows, 1, 2, 10)
    assert (a == NN.batch_of(rows, 1, 1, 10)).all() and abs((a == b).mean() - 0.1) < 0.02
    assert np.bincount(a.astype(int)).min() > 1800
    mask = NN.dropout_mask(rows[:500], 64, 0.3, 1, 1)
    assert abs((mask == 0).mean() - 0.3) < 0.02 and (mask[3] == NN.dropout_mask(rows[3:4], 64, 0.3, 1, 1)[0]).all()


def rings(spark, n=900):
    """Two classes that no line divides, and one far away."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        c = i % 3
        r, t = ((0.5, 1.6)[c], rng.uniform(0, 2 * np.pi)) if c < 2 else (0.3, rng.uniform(0, 6.28))
        rows.append((f"k{i}", [float(r * np.cos(t) + (4 if c == 2 else 0) + rng.normal() * 0.1), float(r * np.sin(t) + rng.normal() * 0.1)], f"c{c}"))
    return spark.createDataFrame(rows, "trajectory_id string, embedding array<double>, true_label string")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    return TR.train_embedding(rings(spark), epochs=25, batch_rows=64, hidden=32, dropout=0.2, rate=0.02, out_dir=str(tmp_path_factory.mktemp("mlp")))


def test_training_learns_and_keeps_the_first_best_epoch(trained):
    history = trained["history"].orderBy("epoch").collect()
    assert [r.epoch for r in history] == list(range(1, 26))
    assert history[-1].loss < 0.4 * history[0].loss
    top = max(r.val_accuracy for r in history)
    assert [r.epoch for r in history if r.best] == [next(r.epoch for r in history if r.val_accuracy == top)]
    share = trained["predictions"].groupBy("actual").count().agg(F.max("count") / F.sum("count")).first()[0]
    accuracy = trained["predictions"].agg(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).first()[0]
    assert accuracy > 0.9 > share + 0.4


def test_validation_accuracy_is_that_of_the_kept_model(trained):
    best = trained["history"].where("best").first()
    val = trained["model"].transform(trained["split"].where("split = 'val'"))
    assert abs(val.agg(F.avg((F.col("prediction") == F.col("label_index")).cast("double"))).first()[0] - best.val_accuracy) < 1e-12


def test_probabilities_and_saved_model(spark, trained):
    df = trained["split"].where("split = 'test'")
    p = trained["model"].transform(df).select("trajectory_id", "prediction", vector_to_array("probability").alias("p")).collect()
    assert all(abs(sum(r.p) - 1) < 1e-12 and r.p[int(r.prediction)] == max(r.p) for r in p)
    again = PipelineModel.load(trained["saved"] + "/model").transform(df).select("trajectory_id", "prediction").collect()
    assert {r.trajectory_id: r.prediction for r in again} == {r.trajectory_id: r.prediction for r in p}


def test_same_for_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(NN, "TASK_ROWS", 40)
    df = rings(spark, 300)
    rows = df.select(F.xxhash64("trajectory_id").alias("hash"), F.substring("true_label", 2, 1).cast("long").alias("label"),
                     (F.crc32("trajectory_id") % 5 == 0).alias("is_val"), F.col("embedding").alias("features"))
    a, b = (NN.fit_network(rows.repartition(n), 2, 3, 8, 0.5, 0.01, 50, 3, 1) for n in (1, 6))
    assert np.allclose(a.weights, b.weights, atol=1e-9) and [h[2] for h in a.history] == [h[2] for h in b.history]


def test_no_validation_rows_and_one_batch(spark):
    rows = rings(spark, 30).select(F.xxhash64("trajectory_id").alias("hash"), F.lit(0).cast("long").alias("label"), F.lit(False).alias("is_val"),
                                   F.col("embedding").alias("features"))
    got = NN.fit_network(rows, 2, 1, 4, 0.5, 0.01, 256, 2, 1)
    assert got.best_epoch == 2 and [h[2] for h in got.history] == [None, None]
    assert NN.NetworkModel.of(got).transform(rows.withColumn("features", array_to_vector("features"))).where("prediction = 0").count() == 30


def test_an_epoch_is_one_job_however_many_rows(spark, monkeypatch):
    """Jobs grew with the mini-batches, and every mini-batch read all rows."""
    monkeypatch.setattr(NN, "TASK_ROWS", 40)
    monkeypatch.setattr(NN, "ADD_STATES", 2)
    rows = rings(spark, 400).select(F.xxhash64("trajectory_id").alias("hash"), F.substring("true_label", 2, 1).cast("long").alias("label"),
                                    (F.crc32("trajectory_id") % 5 == 0).alias("is_val"), F.col("embedding").alias("features")).persist()
    rows.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("network", "epochs")
    got = NN.fit_network(rows, 2, 3, 16, 0.2, 0.02, 5, 12, 1)
    seen = tracker.getJobIdsForGroup("network")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(seen) < 12 + 8  # some 64 mini-batches an epoch
    assert [h[0] for h in got.history] == list(range(1, 13)) and got.history[-1][1] < 0.5 * got.history[0][1]
    assert max(h[2] for h in got.history) > 0.85


def test_every_row_is_in_one_mini_batch_of_an_epoch(monkeypatch):
    rows = NN.mix(np.arange(1000, dtype=np.uint64))
    layers = NN.Layers(2, 4, 3)
    seen = []
    monkeypatch.setattr(NN, "loss_and_gradient", lambda l, w, x, y, m: (seen.extend(x[:, 0].tolist()), (float(len(y)), np.zeros(l.size)))[1])
    replica = (rows, np.zeros(1000, dtype=np.int64), np.arange(1000) % 7 == 0, np.arange(2000.0).reshape(-1, 2))
    state = NN.State(NN.initial_weights(layers, 1))
    losses = state.epoch(replica, layers, 64, 0.5, 0.01, 1, 1)
    assert sorted(seen) == [2.0 * i for i in range(1000) if i % 7] and losses == [1.0] * state.step and state.step == 14
