"""Class statistics and evaluation tables (LABEL_DIST, CLASS_VOCAB, CONFUSION,
CLASS_REPORT, ACCURACY, EMB_DIM).

All are aggregations with partial (map-side) combine. The class vocabulary is
one row per distinct class; its global ordering runs on that small table only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """LABEL_DIST: rows per class (sort by ``n`` descending when presenting)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_vocab(df: DataFrame, label: str = "label", *more: DataFrame) -> DataFrame:
    """CLASS_VOCAB / LABEL_ENCODE: sorted distinct classes and their 0-based index.

    Extra frames (e.g. predictions) may add classes; nulls are not classes.
    """
    classes = df.select(F.col(label).alias("label"))
    for m in more:
        classes = classes.unionByName(m.select(F.col(label).alias("label")))
    d = classes.where(F.col("label").isNotNull()).distinct()
    return d.withColumn("index", (F.row_number().over(Window.orderBy("label")) - 1).cast("int"))


def encode_labels(df: DataFrame, vocab: DataFrame, label: str = "label",
                  out: str = "label_index") -> DataFrame:
    """Map labels to their vocabulary index (the vocabulary is one row per class)."""
    v = vocab.select(F.col("label").alias("_lbl"), F.col("index").alias(out))
    return df.join(v, df[label] == v["_lbl"], "left").drop("_lbl")


def confusion(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """CONFUSION: counts of (actual, predicted)."""
    return pred.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def accuracy(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """ACCURACY: share of rows with ``actual == predicted``."""
    return pred.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def class_report(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
                 vocab: DataFrame | None = None) -> DataFrame:
    """CLASS_REPORT: ``name, precision, recall, f1_score, support`` per class of
    the vocabulary (absent classes get zeros), then ``accuracy`` (its value in
    every column), ``macro avg`` and ``weighted avg``. Undefined ratios are 0.
    """
    # one pass over the predictions: each confusion count adds to its actual and its predicted class
    conf = confusion(pred, actual, predicted)
    zero = F.lit(0).cast("long")
    hit = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(zero)
    sums = conf.select(F.inline(F.array(
        F.struct(F.col(actual).alias("label"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("npred")),
        F.struct(F.col(predicted).alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("npred"))))
        ).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "npred")])
    if vocab is None:
        per = sums.where(F.col("label").isNotNull())
    else:
        per = vocab.select("label").join(sums, "label", "left").na.fill(0, ["tp", "support", "npred"])
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.withColumns({"precision": p, "recall": r})
    per = per.withColumn("f1_score", F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        F.lit(0.0)))
    per = per.withColumn("support", F.col("support").cast("double"))
    rows = per.select(F.col("label").cast("string").alias("name"), "precision", "recall", "f1_score",
                      "support", "tp")
    tot = rows.agg(
        F.sum("tp").alias("_tp"), F.sum("support").alias("_n"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1_score").alias("_mf"),
        F.sum(F.col("precision") * F.col("support")).alias("_wp"),
        F.sum(F.col("recall") * F.col("support")).alias("_wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("_wf"))
    acc = F.coalesce(F.try_divide(F.col("_tp").cast("double"), F.col("_n")), F.lit(0.0))
    extra = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("name"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1_score"), acc.alias("support")),
        F.struct(F.lit("macro avg").alias("name"), F.col("_mp").alias("precision"),
                 F.col("_mr").alias("recall"), F.col("_mf").alias("f1_score"),
                 F.col("_n").alias("support")),
        F.struct(F.lit("weighted avg").alias("name"),
                 F.coalesce(F.try_divide(F.col("_wp"), F.col("_n")), F.lit(0.0)).alias("precision"),
                 F.coalesce(F.try_divide(F.col("_wr"), F.col("_n")), F.lit(0.0)).alias("recall"),
                 F.coalesce(F.try_divide(F.col("_wf"), F.col("_n")), F.lit(0.0)).alias("f1_score"),
                 F.col("_n").alias("support")))))
    return rows.drop("tp").unionByName(extra)


def embedding_dim(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """EMB_DIM: vector length over all rows (min must equal max)."""
    return df.agg(F.min(F.size(vec)).alias("min_dim"), F.max(F.size(vec)).alias("max_dim"),
                  F.count(F.lit(1)).alias("n_rows"))
