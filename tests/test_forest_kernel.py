"""Pruned forests, kernel features and probabilities."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trackwise.operators import forest as FO
from trackwise.operators import grow as GR
from trackwise.operators import kernel as KE
from trackwise.operators import train as TR


def table(spark, n=360, seed=1):
    """Three classes on rings and a noise column."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        c, t = i % 3, rng.uniform(0, 2 * np.pi)
        r = (0.5, 1.5, 2.5)[c] + rng.normal() * 0.25
        rows.append((f"k{i}", "abc"[c], float(r * np.cos(t)), float(r * np.sin(t)), float(rng.normal())))
    return spark.createDataFrame(rows, "unique_id string, label string, x double, y double, z double")


def test_small_split_nodes_become_leaves(spark, tmpdir_path):
    df = VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(table(spark)).withColumn(
        "label_index", (F.ascii("label") - 97).cast("double"))
    model = RandomForestClassifier(labelCol="label_index", numTrees=7, maxDepth=30, seed=3).fit(df)
    pruned = FO.with_min_split(spark, model, 9)
    model.write().save(tmpdir_path + "/a")
    pruned.write().save(tmpdir_path + "/b")
    a, b = (FO.forest_nodes(spark, tmpdir_path + p).toPandas() for p in ("/a", "/b"))
    split = b[b.leftChild >= 0]
    assert (a[a.leftChild >= 0].rawCount < 9).any() and len(b) < len(a) and len(split) and (split.rawCount >= 9).all()
    assert pruned.getNumTrees == 7 and pruned.numClasses == 3
    # every kept split is one of the whole forest, and every row ends where the walk down stops early
    trees = {t: g.set_index("id") for t, g in a.groupby("treeID")}

    def walk(x, t):
        g, i = trees[t], 0
        while g.leftChild[i] >= 0 and g.rawCount[i] >= 9:
            i = g.leftChild[i] if x[g.featureIndex[i]] <= g.leftCategoriesOrThreshold[i][0] else g.rightChild[i]
        stats = np.array(g.impurityStats[i])
        return stats / stats.sum()

    for r in pruned.transform(df).limit(40).collect():
        votes = np.mean([walk(r.features.toArray(), t) for t in trees], axis=0)
        assert np.allclose(r.probability.toArray(), votes, atol=1e-9)
    assert FO.with_min_split(spark, model, 2) is model


def test_prune_keeps_a_tree_without_small_nodes():
    nodes = pd.DataFrame({"treeID": 0, "id": [0, 1, 2], "prediction": 0.0, "impurity": 0.1, "impurityStats": [[1.0]] * 3, "rawCount": [9, 4, 5], "gain": [0.2, -1.0, -1.0],
                          "leftChild": [1, -1, -1], "rightChild": [2, -1, -1], "featureIndex": [0, -1, -1], "leftCategoriesOrThreshold": [[0.5], [], []], "numCategories": -1})
    assert FO.prune_tree(nodes, 9).id.tolist() == [0, 1, 2]
    leaf = FO.prune_tree(nodes, 10)
    assert leaf.id.tolist() == [0] and leaf.leftChild.tolist() == [-1] and leaf.gain.tolist() == [-1.0]


def test_landmark_features_give_the_kernel(spark):
    df = table(spark, 120)
    marks = KE.choose_landmarks(df, ["x", "y", "z"], "unique_id", 42)
    assert marks.shape == (120, 3)  # no more rows than landmarks: the exact kernel
    z = np.array([r.features.toArray() for r in KE.NystroemFeatures.of(["x", "y", "z"], 0.7, marks).transform(df).collect()])
    x = np.array([[r.x, r.y, r.z] for r in df.collect()])
    assert np.allclose(z @ z.T, np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(-1)), atol=1e-6)
    few = KE.choose_landmarks(df, ["x", "y", "z"], "unique_id", 42, most=60)
    z = np.array([r.features.toArray() for r in KE.NystroemFeatures.of(["x", "y", "z"], 0.1, few).transform(df).collect()])
    assert z.shape[1] <= 60 and np.abs(z @ z.T - np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(-1))).max() < 0.1
    same = spark.createDataFrame([(str(i), "a", 1.0, 2.0, 3.0) for i in range(9)], df.schema)
    assert KE.choose_landmarks(same, ["x", "y", "z"], "unique_id", 1).shape == (1, 3)


def test_platt_is_the_likelihood_maximum(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=4000) * 2
    hit = rng.random(4000) < 1 / (1 + np.exp(-(1.7 * m - 0.6)))
    a, b = KE.fit_platt(spark.createDataFrame([(float(x), bool(h)) for x, h in zip(m, hit)], "margin double, hit boolean"))
    assert abs(a - 1.7) < 0.2 and abs(b + 0.6) < 0.15
    t = np.where(hit, (hit.sum() + 1) / (hit.sum() + 2), 1 / ((~hit).sum() + 2))
    loss = lambda a, b: (np.logaddexp(0, a * m + b) - t * (a * m + b)).sum()
    assert all(loss(a, b) <= loss(a + da, b + db) + 1e-6 for da in (-0.01, 0, 0.01) for db in (-0.01, 0, 0.01))
    a, b = KE.fit_platt(spark.createDataFrame([(1.0, True), (2.0, True)], "margin double, hit boolean"))  # one class only
    assert np.isfinite([a, b]).all()


@pytest.mark.parametrize("kernel", ["nystroem", "fourier"])
def test_svm_probabilities(spark, monkeypatch, kernel, tmpdir_path):
    monkeypatch.setattr(TR, "SVM_GRID", {"C": [10], "gamma": ["auto"]})
    monkeypatch.setattr(TR, "SVM_MAX_ITER", 15)
    train, test, vocab, stats = TR.prepare_classical(table(spark, 240), ["x", "y", "z"])
    search = TR.svm_search(train.cache(), ["x", "y", "z"], parallelism=3, kernel=kernel)
    rows = search.model.transform(test).select("label_index", "prediction", vector_to_array("probability").alias("p")).collect()
    assert all(abs(sum(r.p) - 1) < 1e-9 and r.p[int(r.prediction)] >= max(r.p) - 1e-12 for r in rows)
    log_loss = -np.mean([np.log(max(r.p[int(r.label_index)], 1e-12)) for r in rows])
    share = train.groupBy("label_index").count().toPandas().set_index("label_index")["count"]
    guess = -np.mean([np.log(share[r.label_index] / share.sum()) for r in rows])
    assert log_loss < 0.8 * guess and np.mean([r.prediction == r.label_index for r in rows]) > 0.7
    PipelineModel(stages=[TR.standardiser_stage(stats), *search.model.stages]).write().overwrite().save(tmpdir_path + "/svm")
    again = PipelineModel.load(tmpdir_path + "/svm")
    assert [type(s).__name__ for s in again.stages][-1] == "PlattScaling"


def test_forest_grid_has_twelve_settings(spark, monkeypatch):
    monkeypatch.setattr(TR, "RF_GRID", {"numTrees": [3, 5], "maxDepth": [2, 4, None], "min_samples_split": [2, 40]})
    train, test, vocab, _ = TR.prepare_classical(table(spark), ["x", "y", "z"])
    search = TR.random_forest_search(train.cache(), ["x", "y", "z"])
    assert len({tuple(s.items()) for s in search.settings}) == 12 == len(search.accuracies) and max(search.accuracies) > 0.7
    deep = {s["min_samples_split"]: a for s, a in zip(search.settings, search.accuracies) if s["maxDepth"] == 30 and s["numTrees"] == 5}
    assert deep[2] != deep[40]


@pytest.mark.parametrize("local", [50_000, 60])
def test_one_forest_answers_the_grid(spark, monkeypatch, local, tmpdir_path):
    """Every setting was a fit of its own. Votes of the grid equal those of the saved
    model walked by hand, with and without nodes that all tasks split."""
    monkeypatch.setattr(GR, "LOCAL_ROWS", local)
    cols = ["x", "y", "z"]
    train = TR.prepare_classical(table(spark, 400), cols)[0].cache()
    stops, counts = [(2, 2), (30, 2), (30, 25)], [3, 7]
    scores = GR.held_out_accuracies(train, cols, "unique_id", 0, counts, stops, 5)
    rest, test = train.where("fold <> 0"), train.where("fold = 0").toPandas()
    model = GR.grow_forest(rest, cols, "unique_id", 7, 30, 2, 5)
    model.write().save(tmpdir_path + "/m")
    nodes = FO.forest_nodes(spark, tmpdir_path + "/m").toPandas()
    trees = {t: g.set_index("id") for t, g in nodes.groupby("treeID")}
    assert sorted(trees) == list(range(7)) and all(sorted(g.index) == list(range(len(g))) for g in trees.values())
    for g in trees.values():  # counts of children add up, and splits gain
        inner = g[g.leftChild >= 0]
        assert (inner.rawCount.to_numpy() == g.rawCount[inner.leftChild].to_numpy() + g.rawCount[inner.rightChild].to_numpy()).all() and (inner.gain > 0).all()

    def share(x, t, deepest, least):
        g, i, depth = trees[t], 0, 0
        while g.leftChild[i] >= 0 and depth < deepest and g.rawCount[i] >= least:
            i = g.leftChild[i] if x[g.featureIndex[i]] <= g.leftCategoriesOrThreshold[i][0] else g.rightChild[i]
            depth += 1
        return np.array(g.impurityStats[i]) / sum(g.impurityStats[i])

    want = [np.mean([np.sum([share(r[cols].to_numpy(), t, *s) for t in range(n)], axis=0).round(9).argmax() == r.label_index for _, r in test.iterrows()])
            for n in counts for s in stops]
    assert np.allclose(scores, want) and max(scores) > 0.7
    # the loaded model says what its trees say
    features = VectorAssembler(inputCols=cols, outputCol="features").transform(train.where("fold = 0"))
    again = {r.unique_id: r for r in FO.ForestModel.load(tmpdir_path + "/m").transform(features).collect()}
    for _, r in test.iterrows():
        p = np.mean([share(r[cols].to_numpy(), t, 30, 2) for t in range(7)], axis=0)
        assert np.allclose(again[r.unique_id].probability.toArray(), p, atol=1e-8) and again[r.unique_id].prediction == p.round(9).argmax()
    assert len(again) == len(test)
    pruned = GR.grow_forest(rest, cols, "unique_id", 7, 30, 25, 5).nodes.toPandas()
    assert (pruned[pruned.leftChild >= 0].rawCount >= 25).all() and len(pruned) < len(nodes)


def test_machines_reach_the_least_loss_in_few_jobs(spark, monkeypatch):
    """a job was run for each machine and step. All machines share a job now; their
    losses are those of MLlib's machines or less, folds left out, and figures do not depend on the blocks."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from trackwise.operators import hinge as HI

    train = TR.prepare_classical(table(spark, 400), ["x", "y", "z"])[0]
    z = KE.NystroemFeatures.of(["x", "y", "z"], 0.5, KE.choose_landmarks(train, ["x", "y", "z"], "unique_id", 1, 40)).transform(train).cache()
    n = z.count()
    jobs, evaluate = [], HI._evaluate
    monkeypatch.setattr(HI, "_evaluate", lambda *a: jobs.append(1) or evaluate(*a))
    machines = [HI.Machine(s, f, c, 1 / (s * n)) for s in (1, 10) for f in (0, 1, -1) for c in (0, 1)]
    got = HI.fit_machines(HI.pack_rows(z.repartition(3)).cache(), machines, 60)
    assert len(jobs) < 4 * 60 and got.shape[0] == len(machines)
    rows = z.select("label_index", "fold", vector_to_array("features").alias("x")).toPandas()
    x, label, fold = np.stack(rows["x"]), rows["label_index"].to_numpy(), rows["fold"].to_numpy()

    def loss(m, w, b):
        at = fold != m.fold
        y = np.where(label[at] == m.label, 1, -1)
        return np.maximum(0, 1 - y * (x[at] @ w + b)).mean() + m.reg / 2 * (w @ w)

    for m, w in list(zip(machines, got))[::3]:
        svc = LinearSVC(maxIter=60, tol=1e-3, standardization=False, regParam=m.reg).fit(z.where(F.col("fold") != m.fold).select(
            (F.col("label_index") == m.label).cast("double").alias("label"), array_to_vector(vector_to_array("features")).alias("features")))
        assert loss(m, w[:-1], w[-1]) <= 1.02 * loss(m, svc.coefficients.toArray(), svc.intercept)
