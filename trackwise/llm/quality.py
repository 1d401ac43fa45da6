"""Quality classifier: sparse ensemble of rules over text statistics.

1. Statistics of every text (NumPy over Arrow batches), written once.
2. Random-forest trees (MLlib) fitted on labelled rows; every path from a root
   is a conjunctive rule over statistics.
3. Rule columns and the scaled statistics are weighed by a logistic regression
   with lasso penalty (MLlib); most weights become zero.
4. The remaining rules are compiled into one Spark column expression that scores
   the statistics of all texts.

The classifier is fitted on at most ``max_rows`` labelled rows (smallest hashes
of their ids), a documented bound; everything else covers all rows.

Defined results: null text counts as empty, all statistics 0, and is scored like
any other. With no labelled row the score is 0.5; with one class only it is that
class's smoothed share. Repeated labels of an id are all learned from. Rows are
independent; extra columns are kept by ``drop_low_quality`` and ignored
elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches
from .wordhash import Words, row_chunks, runs

MAX_ROWS = 20_000
TREES, DEPTH = 20, 3
LASSO = 0.002
SEED = 11

STATS = ("n_words", "word_length", "upper", "digit", "symbol", "stop", "exclaim", "pipe", "space", "wide",
         "lines", "line_words", "repeated_lines", "distinct_words", "top_pairs", "same_next", "long_words", "short_words", "capital_words")

_CLASS = {name: np.zeros(256, dtype=bool) for name in ("upper", "digit", "symbol", "stop", "exclaim", "pipe", "space", "wide", "line")}
_CLASS["upper"][65:91] = True
_CLASS["digit"][48:58] = True
_CLASS["symbol"][[ord(c) for c in "#$%&*+<=>@[\\]^_`{}~/"]] = True
_CLASS["stop"][[ord(c) for c in ".,;:?\"'()-"]] = True
_CLASS["exclaim"][33] = True
_CLASS["pipe"][124] = True
_CLASS["space"][[9, 10, 11, 12, 13, 32]] = True
_CLASS["wide"][128:] = True
_CLASS["line"][10] = True


def _sums(mask: np.ndarray, edge: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[edge[1:]] - total[edge[:-1]]).astype(np.float64)


def _distinct(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(h[a:z])) for a, z in zip(edge[:-1].tolist(), edge[1:].tolist())], dtype=np.float64)


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATS a text."""
    words = Words(data, offs, True)
    first, n_bytes = words.first, np.maximum(np.diff(offs), 1)
    n = np.diff(first).astype(np.float64)
    some = np.maximum(n, 1)
    share = {c: _sums(m[data], offs) / n_bytes for c, m in _CLASS.items()}
    length = words.end - words.start
    upper = _CLASS["upper"][data]
    # lines as runs of words between line ends
    breaks = np.cumsum(_CLASS["line"][data])
    line_of = breaks[words.start] if len(words.start) else np.zeros(0, dtype=np.int64)
    doc_of = np.repeat(np.arange(len(n)), n.astype(np.int64))
    new = np.ones(len(line_of), dtype=bool)
    new[1:] = (line_of[1:] != line_of[:-1]) | (doc_of[1:] != doc_of[:-1])
    at = np.flatnonzero(new)
    line_hash = np.add.reduceat(words.hash, at) if len(at) else words.hash[:0]
    line_edge = np.searchsorted(at, first)
    lines = np.diff(line_edge).astype(np.float64)
    inside = np.ones(len(words.hash), dtype=bool)
    inside[first[:-1][n > 0]] = False
    same = np.zeros(len(words.hash), dtype=bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    pairs = np.concatenate([runs(words.hash, 2), np.zeros(1, dtype=words.hash.dtype)])[:len(words.hash)]
    out = {
        "n_words": n, "word_length": _sums(length, first) / some, "lines": lines, "line_words": n / np.maximum(lines, 1),
        "repeated_lines": 1 - np.where(lines > 0, _distinct(line_hash, line_edge) / np.maximum(lines, 1), 1),
        "distinct_words": np.where(n > 0, _distinct(words.hash, first) / some, 0),
        "top_pairs": np.where(n > 1, 1 - _distinct(pairs, first) / some, 0),
        "same_next": _sums(same & inside, first) / some,
        "long_words": _sums(length > 15, first) / some, "short_words": _sums(length <= 2, first) / some,
        "capital_words": _sums(upper[words.start], first) / some if len(words.start) else 0 * n,
    } | {c: share[c] for c in share if c in STATS}
    return np.stack([out[s] for s in STATS], axis=1)


def _stat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in row_chunks(b.column(1)):
            x = np.round(statistics(data, offs), 6)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo)] + [pa.array(x[:, i]) for i in range(len(STATS))],
                                             names=["doc_id", *STATS])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        _stat_rows, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


def tree_rules(description: str, names: tuple[str, ...] = STATS) -> list[tuple[str, ...]]:
    """Conditions of every path from a root in MLlib's description of its trees,
    as tuples of SQL comparisons (paths that repeat are given once)."""
    rules: dict[tuple[str, ...], None] = {}
    path: list[str] = []
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        m = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-+.eE0-9]+)\)", line)
        if line.lstrip().startswith("Tree"):
            base, path = depth, []
        elif m:
            path = path[:depth - base - 2] if depth - base - 1 > 0 else []
            path = path[:max(0, depth - base - 2)]
            path.append(f"{names[int(m[1])]} {m[2]} {float(m[3])!r}D")
            rules[tuple(path)] = None
    return list(rules)


def fit(rows: DataFrame, max_rows: int = MAX_ROWS) -> Column:
    """Score expression over STATS, from rows with STATS, doc_id and label (0/1)."""
    rows = materialize(rows.where("label IN (0, 1)").orderBy(F.xxhash64("doc_id", *STATS), "label").limit(max_rows), "labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        good, all_ = counts.get(1, 0), sum(counts.values())
        return F.lit((good + 1) / (all_ + 2) if all_ else 0.5)
    rows = rows.withColumn("label", F.col("label").cast("double"))
    features = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5, subsamplingRate=0.8).fit(features)
    rules = tree_rules(forest.toDebugString)
    spread = rows.agg(*(F.mean(s).alias(f"m_{s}") for s in STATS), *(F.stddev_pop(s).alias(f"d_{s}") for s in STATS)).first()
    linear = {s: (spread[f"m_{s}"], spread[f"d_{s}"]) for s in STATS if spread[f"d_{s}"]}
    terms = [F.expr(f"CASE WHEN {' AND '.join(r)} THEN 1D ELSE 0D END") for r in rules]
    # scaled statistics are clipped, so that no extreme text leaves the fitted range
    terms += [F.greatest(F.least((F.col(s) - m) / (2.5 * d), F.lit(1.0)), F.lit(-1.0)) for s, (m, d) in linear.items()]
    made = rows.select("label", F.array(*terms).alias("terms"))
    from pyspark.ml.functions import array_to_vector
    made = made.select("label", array_to_vector("terms").alias("features")).persist()
    model = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(made)
    made.unpersist()
    margin = F.lit(float(model.intercept))
    for weight, term in zip(model.coefficients.toArray().tolist(), terms):
        if weight:
            margin = margin + F.lit(weight) * term
    return 1 / (1 + F.exp(-margin))


def quality_scores(docs: DataFrame, labels: DataFrame, learned: Column | None = None, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, score of every row of ``docs``; ``learned``: condition on doc_id of
    the rows whose label may be learned from."""
    with text_batches(docs.sparkSession):
        stats = materialize(text_statistics(docs, id_col, text_col), "statistics")
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    if learned is not None:
        known = known.where(learned)
    score = fit(stats.join(known, "doc_id"), max_rows)
    return stats.select("doc_id", F.round(score, 6).alias("score"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score at least ``least`` (all columns kept; a null id is kept)."""
    poor = quality_scores(docs, labels, None, id_col, text_col).where(F.col("score") < least).select(F.col("doc_id").alias("__poor")).distinct()
    return docs.join(poor, F.col(id_col).cast("long") == F.col("__poor"), "left_anti")
