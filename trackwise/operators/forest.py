"""RANDOM_FOREST by the rule "split only nodes with at least so many rows".

MLlib has no such rule (its minimum is that of a child). Trees grow from the root and a
split does not look below itself, so the rule can be applied after the fit: every split
node with fewer rows becomes a leaf, its subtree goes. Row counts (of the tree's
bootstrap sample) are read from the saved model's node table.
"""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NODE = "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, " \
        "leftChild int, rightChild int, featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int"


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a saved forest: one row per node, children by id within the tree (-1: none)."""
    n = spark.read.parquet(path + "/data").select("treeID", "nodeData.*")
    return n.select("*", "split.*").drop("split")


def prune_tree(nodes: pd.DataFrame, min_split: int) -> pd.DataFrame:
    """One tree's nodes with small split nodes made leaves, numbered anew in pre-order."""
    nodes = nodes.set_index("id", drop=False)
    left, right = nodes["leftChild"].to_dict(), nodes["rightChild"].to_dict()
    rows = nodes["rawCount"].to_dict()
    kept, number, children, todo = [], {}, {}, [0]
    while todo:
        i = todo.pop()
        number[i] = len(kept)
        kept.append(i)
        if left[i] >= 0 and rows[i] >= min_split:
            children[i] = (left[i], right[i])
            todo += [right[i], left[i]]
    out = nodes.loc[kept].copy()
    out["id"] = range(len(kept))
    out["leftChild"] = [number[children[i][0]] if i in children else -1 for i in kept]
    out["rightChild"] = [number[children[i][1]] if i in children else -1 for i in kept]
    leaf = [i not in children for i in kept]
    out.loc[leaf, "gain"] = -1.0
    out.loc[leaf, ["featureIndex", "numCategories"]] = -1
    out["leftCategoriesOrThreshold"] = [[] if is_leaf else list(v) for is_leaf, v in zip(leaf, out["leftCategoriesOrThreshold"])]
    return out


def prune_nodes(nodes: DataFrame, min_split: int) -> DataFrame:
    """The trees' nodes when only nodes of at least ``min_split`` rows are split."""
    return nodes.groupBy("treeID").applyInPandas(lambda pdf: prune_tree(pdf, min_split), _NODE)


def node_data(nodes: DataFrame) -> DataFrame:
    """Nodes in the columns of MLlib's saved forests."""
    node = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild"]
    return nodes.select("treeID", F.struct(*node, F.struct("featureIndex", "leftCategoriesOrThreshold", "numCategories").alias("split")).alias("nodeData"))


def with_min_split(spark: SparkSession, model: RandomForestClassificationModel, min_split: int) -> RandomForestClassificationModel:
    """The forest in which only nodes of at least ``min_split`` rows are split."""
    if min_split <= 2:
        return model  # no node of one row is ever split
    old, new = (scratch_path(spark, f"forest-{uuid.uuid4().hex[:12]}") for _ in range(2))
    model.write().save(old)
    node_data(prune_nodes(forest_nodes(spark, old), min_split)).write.parquet(new + "/data")
    spark.read.parquet(old + "/treesMetadata").write.parquet(new + "/treesMetadata")
    spark.read.text(old + "/metadata").coalesce(1).write.text(new + "/metadata")
    return RandomForestClassificationModel.load(new)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        node_data(self.instance.nodes).write.parquet(path + "/data")
        self.instance.nodes.select("treeID").distinct().withColumn("weights", F.lit(1.0)).write.parquet(path + "/treesMetadata")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> ForestModel:
        model = super().load(path)
        model.nodes = forest_nodes(self.sparkSession, path)
        return model


class ForestModel(Transformer, MLWritable, MLReadable):
    """PREDICT of a forest whose nodes stay a table (saved like MLlib's): adds ``probability``
    (vector, the mean of the trees' class shares) and ``prediction``. Rows meet the trees in
    tasks, a tree each, so no task and not the driver holds the forest. The input is written once."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of inputs", typeConverter=TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", typeConverter=TypeConverters.toInt)
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", classes=None, numTrees=None):
        super().__init__()
        self.nodes = None
        self._setDefault(featuresCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, nodes: DataFrame, classes: int, trees: int) -> ForestModel:
        model = cls(classes=classes, numTrees=trees)
        model.nodes = nodes
        return model

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        import pyarrow as pa
        k, trees = self.getOrDefault(self.classes), self.getOrDefault(self.numTrees)
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "forest_input")
        tasks = min(trees, 4 * df.sparkSession.sparkContext.defaultParallelism)

        def deal(batches):
            for b in batches:
                block = [b.column(0).to_numpy(zero_copy_only=False).tobytes(), b.column(1).flatten().to_numpy(zero_copy_only=False).tobytes()]
                for lo in range(0, trees, 25):
                    own = range(lo, min(lo + 25, trees))
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *[pa.array([v] * len(own), pa.binary()) for v in block]], names=["treeID", "r", "x"])

        def walk(nodes: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
            r, x = (np.frombuffer(b"".join(blocks[c]), dtype=kind) for c, kind in (("r", np.int64), ("x", np.float64)))
            x = x.reshape(len(r), -1)
            nodes = nodes.sort_values("id")
            left, right, feature = (nodes[c].to_numpy() for c in ("leftChild", "rightChild", "featureIndex"))
            limit = np.array([v[0] if len(v) else 0.0 for v in nodes["leftCategoriesOrThreshold"]])
            at, going = np.zeros(len(r), dtype=np.int64), np.arange(len(r))
            while len(nodes) and len(going):
                going = going[left[at[going]] >= 0]
                n = at[going]
                at[going] = np.where(x[going, feature[n]] <= limit[n], left[n], right[n])
            stats = np.stack(nodes["impurityStats"].to_numpy()) if len(nodes) else np.zeros((1, k))
            share = stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300)
            out = pd.DataFrame(share[at], columns=[f"v{c}" for c in range(k)])
            out.insert(0, "_row", r)
            return out

        dealt = rows.select("_row", vector_to_array(F.col(self.getOrDefault(self.featuresCol)))).mapInArrow(deal, "treeID int, r binary, x binary")
        votes = self.nodes.repartition(tasks, "treeID").groupBy("treeID").cogroup(dealt.repartition(tasks, "treeID").groupBy("treeID")).applyInPandas(
            walk, "_row long, " + ", ".join(f"v{c} double" for c in range(k)))
        total = votes.groupBy("_row").agg(*[F.round(F.sum(f"v{c}"), 9).alias(f"v{c}") for c in range(k)])
        v = F.array(*[F.col(f"v{c}") for c in range(k)])
        total = total.withColumn("_all", F.aggregate(v, F.lit(0.0), lambda a, b: a + b)).select(
            "_row", array_to_vector(F.transform(v, lambda n: F.when(F.col("_all") > 0, n / F.col("_all")).otherwise(1.0 / k))).alias("probability"),
            (F.array_position(v, F.array_max(v)) - 1).cast("double").alias("prediction"))
        return rows.join(total, "_row").drop("_row")
