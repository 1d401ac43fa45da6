"""RANDOM_FOREST grown for a whole grid at once.

A forest of fewer trees is the first trees of a larger one, a shallower tree is the top of
a deeper one, and a tree that splits only large nodes stops earlier: one forest a fold, of
the most trees and the greatest depth, answers every setting of the grid. Held-out rows go
down with the training rows and note where each setting would stop.

Trees: Poisson(1) bags, sqrt(features) features a node, gini, thresholds at 32 quantiles
(MLlib's rules). While a node holds more than ``LOCAL_ROWS`` rows, its split is found from
histograms added up over all tasks; smaller nodes go to one task each, which grows the rest
level by level. The driver sees the splits of the large nodes only. Bags and features follow
from hashes, so a task that runs again grows the same tree.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .forest import _NODE, ForestModel, prune_nodes
from .network import mix

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a node that one task grows on; levels that are split by all tasks, at most;
#: histogram entries that a task holds at once.
LOCAL_ROWS, TOP_LEVELS, HIST_ENTRIES = 50_000, 20, 1 << 21
BINS = 32
LEAST_GAIN = 1e-12
#: Cumulative Poisson(1) probabilities.
_POISSON = np.exp(-1.0) * np.cumsum([1.0, 1.0, 1 / 2, 1 / 6, 1 / 24, 1 / 120, 1 / 720, 1 / 5040])


def _salt(seed: int, tree: int, what: int) -> np.uint64:
    return mix(np.array([(seed * 0x9E3779B97F4A7C15 + int(tree) * 0xD1342543DE82EF95 + what) & ((1 << 64) - 1)], dtype=np.uint64))[0]


def bag(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row (by its hash) is in the tree's bootstrap sample."""
    return np.searchsorted(_POISSON, (mix(mix(rows) ^ _salt(seed, tree, 1)) >> np.uint64(11)) / float(1 << 53), side="right")


def feature_subsets(paths: np.ndarray, d: int, m: int, tree: int, seed: int) -> np.ndarray:
    """``m`` of ``d`` features for each node (by its path: root 1, children 2p and 2p + 1)."""
    u = mix(mix(paths ^ _salt(seed, tree, 2))[:, None] ^ mix(np.arange(1, d + 1, dtype=np.uint64))[None, :])
    return np.argsort(u, axis=1)[:, :m]


def best_splits(hist: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature slot, last bin of the left child and gini gain of each node's best split.

    ``hist``: nodes x slots x bins x classes; ``total``: nodes x classes."""
    left = hist.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None, :] - left
    n_left, n_right, n = left.sum(axis=3), right.sum(axis=3), total.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((n_left > 0) & (n_right > 0), (left * left).sum(axis=3) / n_left + (right * right).sum(axis=3) / n_right, -np.inf)
    flat = score.reshape(len(hist), -1)
    at = flat.argmax(axis=1)
    return at // (hist.shape[2] - 1), at % (hist.shape[2] - 1), flat[np.arange(len(hist)), at] / n - (total * total).sum(axis=1) / n ** 2


def grow_tree(bins: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, tree: int, seed: int, path: int, max_depth: int, stops: list[tuple[int, int]]):
    """Grow below the node ``path``. Rows of weight 0 are held out: they go down and vote.

    Returns the nodes (columns by name, numbered from 0 by level) and the votes of the
    held-out rows: rows x stops x classes, the class shares of the node where a tree with
    that (depth limit, rows of a split node) ends."""
    d = bins.shape[1]
    m = int(np.ceil(np.sqrt(d)))
    held = np.flatnonzero(w == 0)
    votes = np.zeros((len(held), len(stops), classes))
    place = np.full(len(w), -1)
    place[held] = np.arange(len(held))
    waiting = np.ones((len(held), len(stops)), dtype=bool)
    rows, node, paths = np.arange(len(w)), np.zeros(len(w), dtype=np.int64), np.array([int(path)], dtype=np.uint64)
    out, first, depth = [], 0, int(path).bit_length() - 1
    while len(paths):
        a = len(paths)
        total = np.bincount(node * classes + y[rows], w[rows], a * classes).reshape(a, classes)
        n = total.sum(axis=1)
        share = total / np.maximum(n, 1.0)[:, None]
        gini = np.where(n > 0, 1.0 - (share * share).sum(axis=1), 0.0)
        feature, cut, gain = np.full(a, -1), np.full(a, -1), np.full(a, -1.0)
        open_ = np.flatnonzero((gini > LEAST_GAIN) & (depth < max_depth))
        if len(open_):
            rank = np.full(a, -1)
            rank[open_] = np.arange(len(open_))
            mine = (rank[node] >= 0) & (w[rows] > 0)
            own, at = rows[mine], rank[node[mine]]
            subset = feature_subsets(paths[open_], d, m, tree, seed)
            step = max(1, HIST_ENTRIES // (m * BINS * classes))
            for lo in range(0, len(open_), step):
                hi = min(lo + step, len(open_))
                part = slice(*np.searchsorted(at, [lo, hi]))
                i, k = own[part], at[part] - lo
                hist = np.stack([np.bincount((k * BINS + bins[i, subset[lo + k, j]]) * classes + y[i], w[i], (hi - lo) * BINS * classes)
                                .reshape(hi - lo, BINS, classes) for j in range(m)], axis=1)
                slot, c, g = best_splits(hist, total[open_[lo:hi]])
                feature[open_[lo:hi]], cut[open_[lo:hi]], gain[open_[lo:hi]] = subset[np.arange(lo, hi), slot], c, g
        split = gain > LEAST_GAIN
        feature[~split], cut[~split], gain[~split] = -1, -1, -1.0
        number = np.cumsum(split) - 1
        child = np.where(split, first + a + 2 * number, -1)
        out.append(dict(id=first + np.arange(a), prediction=total.argmax(axis=1).astype(float), impurity=gini, impurityStats=list(total), rawCount=n.astype(np.int64),
                        gain=gain, leftChild=child, rightChild=np.where(split, child + 1, -1), featureIndex=feature, cut=cut))
        here = place[rows]
        for s, (deepest, least) in enumerate(stops):
            ends = (here >= 0) & (~split | (depth >= deepest) | (n < least))[node]
            r = here[ends]
            new = waiting[r, s]
            votes[r[new], s], waiting[r[new], s] = share[node[ends][new]], False
        on = split[node]
        rows, node = rows[on], node[on]
        below = 2 * number[node] + (bins[rows, feature[node]] > cut[node])
        order = np.argsort(below, kind="stable")
        rows, node = rows[order], below[order]
        paths = (2 * paths[split][:, None] + np.arange(2, dtype=np.uint64)[None, :]).ravel()
        first, depth = first + a, depth + 1
    return {c: np.concatenate([o[c] for o in out]) if c != "impurityStats" else [v for o in out for v in o[c]] for c in out[0]}, votes


def row_paths(bins: np.ndarray, top: dict[int, tuple]) -> np.ndarray:
    """Where the rows are below the splits ``top``: path -> (feature, last bin of the left child, ...)."""
    at = np.ones(len(bins), dtype=np.int64)
    for path in sorted(top):
        mine = np.flatnonzero(at == path)
        at[mine] = 2 * path + (bins[mine, top[path][0]] > top[path][1])
    return at


def _edges(train: DataFrame, cols: list[str]) -> list[np.ndarray]:
    """Thresholds of each feature (31 quantiles at most)."""
    at = [i / BINS for i in range(1, BINS)]
    row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 10_000) for c in cols]).first()
    return [np.unique(np.array(v or [], dtype=float)) for v in row]


def _blocks(rows: DataFrame, cols: list[str], edges: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: hashes, classes, held-out marks and bins as bytes."""
    import pyarrow as pa

    def pack(batches):
        for b in batches:
            h, y, held = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cols))
            bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (
                h.astype(np.int64), y.astype(np.int32), held.astype(np.bool_), bins)], names=["h", "y", "held", "b"])

    return rows.select("_h", "_y", "_held", F.array(*[F.col(c).cast("double") for c in cols]).alias("_x")).mapInArrow(pack, "h binary, y binary, held binary, b binary")


def _unpack(h, y, held, b, d: int):
    return (np.frombuffer(h, dtype=np.int64).view(np.uint64), np.frombuffer(y, dtype=np.int32), np.frombuffer(held, dtype=np.bool_),
            np.frombuffer(b, dtype=np.uint8).reshape(-1, d))


def _top_splits(blocks: DataFrame, d: int, classes: int, trees: int, seed: int, max_depth: int) -> list[dict[int, tuple]]:
    """The splits of nodes with more than ``LOCAL_ROWS`` rows, a level a job: path -> (feature,
    last bin of the left child, gain, class counts) for each tree."""
    top: list[dict[int, tuple]] = [{} for _ in range(trees)]
    active = {t: {1} for t in range(trees)}
    m = int(np.ceil(np.sqrt(d)))
    for _ in range(min(TOP_LEVELS, max_depth)):
        def count(r):
            h, y, held, bins = _unpack(r["h"], r["y"], r["held"], r["b"], d)
            for t, nodes in active.items():
                w, at = np.where(held, 0, bag(h, t, seed)), row_paths(bins, top[t])
                for path in nodes:
                    i = np.flatnonzero((at == path) & (w > 0))
                    subset = feature_subsets(np.array([path], dtype=np.uint64), d, m, t, seed)[0]
                    yield (t, path), np.stack([np.bincount(bins[i, f].astype(np.int64) * classes + y[i], w[i], BINS * classes).reshape(BINS, classes) for f in subset])

        def choose(item):
            (t, path), hist = item
            total = hist[0].sum(axis=0)
            slot, cut, gain = (v[0] for v in best_splits(hist[None], total[None]))
            f = feature_subsets(np.array([path], dtype=np.uint64), d, m, t, seed)[0][slot]
            n_left = hist[slot, :cut + 1].sum()
            return t, path, int(f), int(cut), float(gain), total.tolist(), float(n_left)

        found = blocks.rdd.flatMap(count).reduceByKey(np.add).map(choose).collect()
        active = {}
        for t, path, f, cut, gain, total, n_left in found:
            if gain > LEAST_GAIN and sum(total) > LOCAL_ROWS:
                top[t][path] = (f, cut, gain, total)
                large = {c for c, n in ((2 * path, n_left), (2 * path + 1, sum(total) - n_left)) if n > LOCAL_ROWS}
                if large:
                    active.setdefault(t, set()).update(large)
        if not active:
            break
    return top


def _groups(blocks: DataFrame, d: int, trees: int, seed: int, top: list[dict[int, tuple]]):
    """The rows of every tree, grouped by the node below the top splits that they reach."""
    import pyarrow as pa
    parallel = blocks.sparkSession.sparkContext.defaultParallelism

    def deal(batches):
        for batch in batches:
            for r in batch.to_pylist():
                h, y, held, bins = _unpack(r["h"], r["y"], r["held"], r["b"], d)
                for t in range(trees):
                    w = np.where(held, 0, bag(h, t, seed)).astype(np.uint8)
                    at = row_paths(bins, top[t])
                    used = held | (w > 0)
                    paths = np.unique(at[used])
                    own = [np.flatnonzero(used & (at == p)) for p in paths]
                    yield pa.RecordBatch.from_arrays([pa.array([t] * len(own), pa.int32()), pa.array(paths, pa.int64()),
                                                      *[pa.array([v[i].tobytes() for i in own], pa.binary()) for v in (h, y, w, bins)]],
                                                     names=["treeID", "path", "h", "y", "w", "b"])

    dealt = blocks.repartition(max(2, 2 * parallel)).mapInArrow(deal, "treeID int, path long, h binary, y binary, w binary, b binary")
    n = sum(len(t) + 1 for t in top)
    return dealt.repartition(min(n, max(4 * parallel, n // 16)), "treeID", "path").groupBy("treeID", "path")


def _joined(pdf: pd.DataFrame, d: int):
    """The arrays of a group's blocks, rows by hash (blocks arrive in any order)."""
    h, y, w, b = (np.frombuffer(b"".join(pdf[c]), dtype=kind) for c, kind in (("h", np.int64), ("y", np.int32), ("w", np.uint8), ("b", np.uint8)))
    order = np.argsort(h, kind="stable")
    return h[order], y[order].astype(np.int64), w[order].astype(np.float64), b.reshape(-1, d)[order]


def _prepared(train: DataFrame, cols: list[str], key: str, held, trees: int, seed: int, classes: int, max_depth: int):
    """Blocks of the rows (``held``: the held-out ones), thresholds, and the top splits."""
    rows = train.withColumns({"_h": F.xxhash64(key), "_y": F.col("label_index").cast("int"), "_held": held})
    learned = rows.where(~F.col("_held"))
    edges = _edges(learned, cols)
    blocks = materialize(_blocks(rows, cols, edges), "forest_rows")
    top = _top_splits(blocks, len(cols), classes, trees, seed, max_depth) if learned.count() > LOCAL_ROWS else [{} for _ in range(trees)]
    return blocks, edges, top


def held_out_accuracies(train: DataFrame, cols: list[str], key: str, fold: int, tree_counts: list[int], stops: list[tuple[int, int]], seed: int) -> list[float]:
    """Accuracy on a fold of every setting: for each number of trees, each (depth limit, rows of a split node)."""
    d, trees, classes = len(cols), max(tree_counts), int(train.agg(F.max("label_index")).first()[0]) + 1
    deepest, parts, size = max(s[0] for s in stops), sorted(set(tree_counts)), len(stops) * classes
    blocks, _, top = _prepared(train, cols, key, F.col("fold") == fold, trees, seed, classes, min(s[0] for s in stops))

    def vote(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h, y, w, bins = _joined(pdf, d)
        votes = grow_tree(bins, y, w, classes, k[0], seed, k[1], deepest, stops)[1].reshape(-1, size)
        held = w == 0
        out = pd.DataFrame(votes, columns=[f"v{i}" for i in range(size)])
        out.insert(0, "part", np.int32(np.searchsorted(parts, k[0], side="right")))
        out.insert(0, "y", y[held])
        out.insert(0, "h", h[held])
        return out

    votes = _groups(blocks, d, trees, seed, top).applyInPandas(vote, "h long, y long, part int, " + ", ".join(f"v{i} double" for i in range(size)))
    by_row = votes.groupBy("h", "y").agg(*[F.sum(F.when(F.col("part") <= p, F.col(f"v{i}")).otherwise(0.0)).alias(f"s{p}_{i}")
                                           for p in range(len(parts)) for i in range(size)])

    def right(t: int, s: int):
        v = F.array(*[F.round(f"s{parts.index(t)}_{s * classes + c}", 9) for c in range(classes)])
        return F.avg((F.array_position(v, F.array_max(v)) - 1 == F.col("y")).cast("double"))

    return list(by_row.agg(*[right(t, s).alias(f"a{t}_{s}") for t in tree_counts for s in range(len(stops))]).first())


def grow_forest(train: DataFrame, cols: list[str], key: str, trees: int, max_depth: int, min_split: int, seed: int) -> ForestModel:
    """A forest over ``features``, the assembled ``cols``."""
    spark, d, classes = train.sparkSession, len(cols), int(train.agg(F.max("label_index")).first()[0]) + 1
    blocks, edges, top = _prepared(train, cols, key, F.lit(False), trees, seed, classes, max_depth)

    def nodes(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, y, w, bins = _joined(pdf, d)
        found = pd.DataFrame(grow_tree(bins, y, w, classes, k[0], seed, k[1], max_depth, [])[0])
        found["leftCategoriesOrThreshold"] = [[float(edges[f][c])] if f >= 0 else [] for f, c in zip(found["featureIndex"], found["cut"])]
        found["numCategories"], found["treeID"], found["path"] = -1, k[0], k[1]
        return found.drop(columns="cut")

    below = materialize(_groups(blocks, d, trees, seed, top).applyInPandas(nodes, _NODE + ", path long"), "forest_nodes")
    # numbers within the tree: first its top splits, then the nodes below, group by group
    sizes = sorted(tuple(r) for r in below.groupBy("treeID", "path").count().collect())
    first: dict[int, dict[int, int]] = {t: {p: i for i, p in enumerate(sorted(top[t]))} for t in range(trees)}
    used = [len(t) for t in top]
    for t, path, n in sizes:
        first[t][path] = used[t]
        used[t] += n
    offsets = spark.createDataFrame([(t, p, first[t][p]) for t, p, _ in sizes], "treeID int, path long, _first int")
    shift = lambda c: F.when(F.col(c) >= 0, F.col(c) + F.col("_first")).otherwise(-1).alias(c)
    names = [c.split()[0] for c in _NODE.split(", ")]
    rows = below.join(F.broadcast(offsets), ["treeID", "path"]).select(*[shift(c) if c in ("id", "leftChild", "rightChild") else c for c in names])
    # a sample that leaves a tree or a child empty: a leaf without rows
    lone = [(t, i, 0.0, 0.0, [0.0] * classes, 0, -1.0, -1, -1, -1, [], -1) for t in range(trees) for i in ([] if used[t] else [0])]
    upper = [(t, first[t][p], float(np.argmax(total)), 1.0 - sum((v / sum(total)) ** 2 for v in total), [float(v) for v in total], int(sum(total)), gain,
              first[t][2 * p], first[t][2 * p + 1], f, [float(edges[f][cut])], -1) for t in range(trees) for p, (f, cut, gain, total) in top[t].items()]
    if upper or lone:
        rows = rows.unionByName(spark.createDataFrame(upper + lone, _NODE))
    rows = materialize(rows if min_split <= 2 else prune_nodes(rows, min_split), "forest")
    return ForestModel.of(rows, classes, trees)
