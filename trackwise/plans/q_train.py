"""Training queries. With SQL: what SQL can know of a trained model (which rows are
tested and with what label, class supports, the settings tried, majority shares
counted from the tables), beside flags that compare the model's accuracy with those
shares and its parts with each other. Without SQL: the figures themselves (``grid_scores``,
``forest_scores``, ``svm_scores``, ``network_scores``, ``epoch_losses``)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import embed as E
from ..operators import forest as FO
from ..operators import metrics as M
from ..operators import splits as SP
from ..operators import train as TR
from ..operators.kinematics import FEATURE_COLUMNS
from ..session import scratch_path
from ..sources import derived as D
from .catalog import big, inputs, register
from .q_learning import classical_test_sql, embedding_test_sql

_RESULTS: dict[tuple, dict] = {}


def _classical(spark, sf, model_type: str) -> dict:
    k = (spark.sparkContext.applicationId, sf, model_type)
    if k not in _RESULTS:
        _RESULTS[k] = TR.train_classical(inputs(spark, sf).features, FEATURE_COLUMNS, model_type,
                                         out_dir=scratch_path(spark, "models"))
    return _RESULTS[k]


def _vectors(spark, sf):
    img, txt = D.derive_vector_tables(inputs(spark, sf).table("embeddings"))
    fused = E.fuse([(img, "image"), (txt, "text")])
    return E.attach_labels(fused, D.derive_vector_labels(inputs(spark, sf).table("embeddings")))[0]


def _embedding(spark, sf) -> dict:
    k = (spark.sparkContext.applicationId, sf, "mlp")
    if k not in _RESULTS:
        _RESULTS[k] = TR.train_embedding(_vectors(spark, sf), out_dir=scratch_path(spark, "models"))
    return _RESULTS[k]


def _report(res):
    """Support per class, and whether the report follows from the predictions."""
    seen = M.class_report(res["predictions"], vocab=res["vocab"])
    names = ["precision", "recall", "f1_score", "support"]
    both = res["report"].join(seen.select("name", *[F.col(c).alias(f"_{c}") for c in names]), "name")
    same = F.lit(True)
    for c in names:
        same = same & (F.abs(F.col(c) - F.col(f"_{c}")) < 1e-9) & (F.col(c) >= 0)
    n = res["predictions"].agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("acc"))
    right = F.when(F.col("name") == "accuracy", F.abs(F.col("precision") - F.col("acc")) < 1e-9).otherwise(F.lit(True))
    return both.join(F.broadcast(n)).select("name", F.when(F.col("name") != "accuracy", F.col("support")).cast("bigint").alias("support"),
                                            (same & right).alias("consistent"))


def _report_sql(test_sql):
    return test_sql("""
SELECT c AS name, CAST(count(t.label) AS BIGINT) AS support, true AS consistent
FROM classes LEFT JOIN tested t ON t.label = c GROUP BY c
UNION ALL SELECT 'accuracy', NULL, true
UNION ALL SELECT 'macro avg', count(*), true FROM tested
UNION ALL SELECT 'weighted avg', count(*), true FROM tested""")


def _known(res, key):
    """Tested rows with their label; whether the prediction is a class."""
    classes = res["vocab"].select(F.col("label").alias("predicted"), F.lit(True).alias("_class"))
    return res["predictions"].join(F.broadcast(classes), "predicted", "left").select(
        key, "actual", F.coalesce("_class", F.lit(False)).alias("known_class"))


@register("train_classical", _report_sql(classical_test_sql))
def q_train_classical(spark, sf):
    return _report(_classical(spark, sf, "random_forest"))


@register("train_svm", _report_sql(classical_test_sql))
def q_train_svm(spark, sf):
    return _report(_classical(spark, sf, "svm"))


def _share(rows, label: str):
    """Share of the most common class, as a one-row frame."""
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg((F.max("_n") / F.sum("_n")).alias("majority_share"))


#: The share of the most common class among the rows of one part of a split.
_SHARE_SQL = "SELECT max(n)::DOUBLE / sum(n) AS s, sum(n) AS n FROM (SELECT count(*) AS n FROM {table} GROUP BY label)"


def _grid_sql() -> str:
    rows = [f"maxDepth={TR.UNBOUNDED_DEPTH if d is None else d}, min_samples_split={m}, numTrees={t}"
            for t in TR.RF_GRID["numTrees"] for d in TR.RF_GRID["maxDepth"] for m in TR.RF_GRID["min_samples_split"]]
    return _ratio_sql(rows)


def _ratio_sql(rows: list[str]) -> str:
    return classical_test_sql(f"""
SELECT p AS params, round(s, 4) AS majority_share, true AS not_below_chance
FROM (VALUES {", ".join(f"('{r}')" for r in rows)}) t(p), ({_SHARE_SQL.format(table="learned")})""")


def _grid(res):
    """Settings tried, the majority share of the training rows, and whether the accuracy over the
    folds lies no more than three standard errors below that share (a model that learned nothing
    reaches it; a broken one does not)."""
    s, n = F.col("majority_share"), res["train"].count()
    return res["grid"].join(F.broadcast(_share(res["train"], "label"))).select(
        "params", F.round(s, 4).alias("majority_share"),
        ((F.col("accuracy") >= s - 3 * F.sqrt(s * (1 - s) / n)) & (F.col("accuracy") <= 1)).alias("not_below_chance"))


@register("grid_search", _grid_sql())
def q_grid_search(spark, sf):
    return _grid(_classical(spark, sf, "random_forest"))


@register("svm_grid", _ratio_sql([f"C={c}, gamma={g}" for g in TR.SVM_GRID["gamma"] for c in TR.SVM_GRID["C"]]))
def q_svm_grid(spark, sf):
    return _grid(_classical(spark, sf, "svm"))


@register("grid_scores")
def q_grid_scores(spark, sf):
    """The figures of the search: mean accuracy of every setting over the folds."""
    return _classical(spark, sf, "random_forest")["grid"].select(big("setting").alias("setting"), "params", F.round("accuracy", 4).alias("accuracy"))


def _scores(res):
    """ACCURACY and the per-class scores of a run."""
    return res["report"].select("name", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1_score")], F.col("support").cast("double").alias("support"))


@register("forest_scores")
def q_forest_scores(spark, sf):
    return _scores(_classical(spark, sf, "random_forest"))


@register("svm_scores")
def q_svm_scores(spark, sf):
    return _scores(_classical(spark, sf, "svm"))


@register("network_scores")
def q_network_scores(spark, sf):
    return _scores(_embedding(spark, sf))


def _fits(rows, model, label: str, of=None):
    """Majority share of the training rows (or of the rows ``of``), and whether the fitted model beats it on them."""
    right = model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label_index")).cast("double")).alias("_a"))
    return F.broadcast(_share(rows if of is None else of, label)).join(F.broadcast(right)).select(
        F.round("majority_share", 4).alias("majority_share"), (F.col("_a") > F.col("majority_share")).alias("beats_majority"))


_FITS_SQL = f"SELECT round(s, 4) AS majority_share, true AS beats_majority FROM ({_SHARE_SQL})"


@register("forest_fit", classical_test_sql(_FITS_SQL.format(table="learned")))
def q_forest_fit(spark, sf):
    res = _classical(spark, sf, "random_forest")
    return _fits(res["train"], res["search"].model, "label")


@register("svm_fit", classical_test_sql(_FITS_SQL.format(table="learned")))
def q_svm_fit(spark, sf):
    res = _classical(spark, sf, "svm")
    return _fits(res["train"], res["search"].model, "label")


@register("forest_splits", classical_test_sql("SELECT true AS has_splits, 0::BIGINT AS small_splits, count(*) AS classes FROM classes"))
def q_forest_splits(spark, sf):
    """RANDOM_FOREST's rule: split nodes with fewer rows than the kept setting allows (none), and the classes it knows."""
    res = _classical(spark, sf, "random_forest")
    search, path = res["search"], res["saved"] + "/model/stages"
    least = search.settings[int(np.argmax(search.accuracies))]["min_samples_split"]
    stage = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .where(F.col("path").contains("/treesMetadata/")).select("path").limit(1).collect()][0]
    nodes = FO.forest_nodes(spark, stage.split("/treesMetadata/")[0])
    split = F.col("leftChild") >= 0
    return nodes.agg((F.count_if(split) > 0).alias("has_splits"), F.count_if(split & (F.col("rawCount") < least)).alias("small_splits"),
                     F.max(F.size("impurityStats")).cast("bigint").alias("classes"))


@register("svm_probability", classical_test_sql("SELECT unique_id, true AS sums_to_one, true AS agrees FROM tested"))
def q_svm_probability(spark, sf):
    """Class probabilities of the tested rows: whether they sum to 1 and whether the predicted class has the largest."""
    p = F.col("p")
    return _classical(spark, sf, "svm")["scored"].withColumn("p", vector_to_array("probability")).select(
        "unique_id", (F.abs(F.aggregate(p, F.lit(0.0), lambda a, b: a + b) - 1) < 1e-9).alias("sums_to_one"),
        (F.element_at(p, F.col("prediction").cast("int") + 1) >= F.array_max(p) - 1e-12).alias("agrees"))


@register("predict", classical_test_sql("SELECT unique_id, label AS actual, true AS known_class FROM tested"))
def q_predict(spark, sf):
    return _known(_classical(spark, sf, "random_forest"), "unique_id")


def _saved_agrees(again, res, key):
    """Rows scored by the loaded model; whether it says what the trained one said."""
    first = res["predictions"].select(key, F.col("predicted").alias("_first"))
    return again.join(first, key).select(key, "actual", F.col("predicted").eqNullSafe(F.col("_first")).alias("same_prediction"))


@register("model_sink", classical_test_sql("SELECT unique_id, label AS actual, true AS same_prediction FROM tested"))
def q_model_sink(spark, sf):
    """The saved model scores raw features: its first stage standardises them."""
    res = _classical(spark, sf, "random_forest")
    raw = SP.stratified_split(inputs(spark, sf).features, "label", "unique_id", TR.CLASSICAL_TEST, TR.CLASSICAL_SEED)
    again = TR.predict(PipelineModel.load(res["saved"] + "/model"), raw.where(F.col("split") == "test"),
                       spark.read.parquet(res["saved"] + "/vocab"))
    return _saved_agrees(again, res, "unique_id")


@register("embedding_sink", embedding_test_sql("SELECT trajectory_id, label AS actual, true AS same_prediction FROM tested"))
def q_embedding_sink(spark, sf):
    res = _embedding(spark, sf)
    v = _vectors(spark, sf).withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    v = SP.three_way_split(v, "true_label", "trajectory_id", TR.EMBED_TEST, TR.EMBED_VAL, TR.EMBED_SEED)
    again = TR.predict(PipelineModel.load(res["saved"] + "/model"), v.where(F.col("split") == "test"),
                       spark.read.parquet(res["saved"] + "/vocab"), "trajectory_id", "true_label")
    return _saved_agrees(again, res, "trajectory_id")


@register("run_dir", classical_test_sql("""
SELECT * FROM (VALUES ('random_forest', 'model'), ('random_forest', 'report'), ('random_forest', 'vocab')) t(model, part)
WHERE (SELECT count(*) FROM tested) > 0"""))
def q_run_dir(spark, sf):
    run = _classical(spark, sf, "random_forest")["saved"]
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(run).select("path")
    pattern = r"/([^/]+)-\d{8}-\d{6}/(model|vocab|report)/"
    return listing.select(F.regexp_extract("path", pattern, 1).alias("model"), F.regexp_extract("path", pattern, 2).alias("part")).distinct()


@register("train_embedding", _report_sql(embedding_test_sql))
def q_train_embedding(spark, sf):
    return _report(_embedding(spark, sf))


@register("best_model", f"""SELECT CAST(e AS BIGINT) AS epoch, true AS recorded, true AS follows_rule
FROM (SELECT unnest(range(1, {TR.MLP_EPOCHS + 1})) AS e) WHERE (SELECT count(*) FROM embeddings) > 0""")
def q_best_model(spark, sf):
    """BEST_MODEL, epoch by epoch: validation accuracy recorded, and the kept epoch is the first with the highest."""
    h = _embedding(spark, sf)["history"]
    top = h.agg(F.max("val_accuracy").alias("_top"), F.min_by("epoch", F.struct(-F.col("val_accuracy"), "epoch")).alias("_first"))
    return h.join(F.broadcast(top)).select(big("epoch").alias("epoch"), F.col("val_accuracy").between(0, 1).alias("recorded"),
                                           (F.col("best") == (F.col("epoch") == F.col("_first"))).alias("follows_rule"))


@register("epoch_losses")
def q_epoch_losses(spark, sf):
    """MEAN_LOSS and validation accuracy of every epoch: the figures."""
    return _embedding(spark, sf)["history"].select(big("epoch").alias("epoch"), F.round("loss", 4).alias("loss"), F.round("val_accuracy", 4).alias("val_accuracy"))


@register("mean_loss", embedding_test_sql(f"""
SELECT round(s, 4) AS majority_share, {TR.MLP_EPOCHS}::BIGINT AS epochs, true AS starts_at_chance, true AS falls, true AS beats_majority
FROM ({_SHARE_SQL.format(table="fl")})"""))
def q_mean_loss(spark, sf):
    """Epochs with a loss; whether the first is near the loss of guessing (log of the classes, within a
    tenth) and the last below it; whether the kept network beats the majority share on its training rows."""
    res = _embedding(spark, sf)
    chance = math.log(max(res["vocab"].count(), 2))
    seen = res["history"].agg(F.count("loss").alias("epochs"), (F.abs(F.min_by("loss", "epoch") - chance) < 0.1 * chance).alias("starts_at_chance"),
                              (F.max_by("loss", "epoch") < F.min_by("loss", "epoch")).alias("falls"))
    return _fits(res["split"].where("split = 'train'"), res["model"], "true_label", res["split"]).join(F.broadcast(seen)).select(
        "majority_share", "epochs", "starts_at_chance", "falls", "beats_majority")


@register("mlp", embedding_test_sql("SELECT trajectory_id, label AS actual, true AS known_class FROM tested"))
def q_mlp(spark, sf):
    return _known(_embedding(spark, sf), "trajectory_id")
