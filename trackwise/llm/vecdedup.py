"""Near-duplicate vectors: cosine links within a label by binary codes.

Vectors are rotated at random (padded with zeros to the code length); a code
keeps the signs, and the correction factor <code, rotated> is stored beside it.
<code, query> / factor is an unbiased estimate of a cosine, with error about
sqrt(1 - factor^2) / factor / sqrt(bits - 1); pairs whose estimate plus
``CONFIDENCE`` such errors reaches the threshold are recomputed in double
precision, all others are not linked.

Candidates: the code is cut into ``tables`` keys; vectors of one label that
agree in a key meet. A pair is looked at in the first table where it meets, so
it counts once. The key width follows the largest label (about
``BUCKET_ROWS`` vectors a bucket), the number of tables the width, so that a pair
at the threshold is missed with probability at most ``MISS``. Large buckets are
cut into pairs of blocks. Inside a task links become link counts and a spanning
forest: no pair lists leave it. Equal vectors of a label are one class.

Defined results: a vector or label that is null, or a vector that is empty, zero
or holds null or non-finite components: linked with nothing, its own component,
kept. Vectors of different lengths do not link. Rows that repeat a vec_id are
copies of it (each counts as a link of the other only if the row differs in
vec_id; link counts are of rows with another vec_id). Null vec_id: no links,
null component, not kept. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize
from .wordhash import U, mix

THRESHOLD = 0.93
CONFIDENCE = 4.0
BUCKET_ROWS = 128
MISS = 1e-3
#: Vectors of a block; larger buckets are compared block by block.
BLOCK = 2048


def plan(largest_label: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(key bits, tables) for a label of that many vectors."""
    width = max(6, math.ceil(math.log2(max(largest_label, 1) / BUCKET_ROWS))) if largest_label > BUCKET_ROWS else 6
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, math.ceil(math.log(MISS) / math.log(1 - agree))


def rotation(size: int, dims: int, seed: int = 7) -> np.ndarray:
    """``dims`` columns of a random orthogonal matrix of ``size`` rows."""
    u = mix(np.arange(size * dims * 2, dtype=U) + U((seed * 0x9E3779B97F4A7C15 + 1) % (1 << 64)))
    u = (u >> U(11)).astype(np.float64) / float(1 << 53)
    a, b = u[0::2], u[1::2]
    normal = np.sqrt(-2 * np.log(1 - a)) * np.cos(2 * np.pi * b)
    q, r = np.linalg.qr(normal.reshape(size, dims))
    return q * np.sign(np.diag(r))


def _encode(width: int, tables: int):
    bits = -(-max(width * tables, 64) // 64) * 64

    def run(batches):
        turns: dict[int, np.ndarray] = {}
        for pdf in batches:
            out = []
            for dims, g in pdf.groupby(pdf["embedding"].str.len()):
                size = max(bits, -(-dims // 64) * 64)
                if dims not in turns:
                    turns[dims] = rotation(size, dims)
                x = np.stack(g["embedding"].to_numpy()).astype(np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                y = x @ turns[dims].T
                sign = y > 0
                factor = np.abs(y).sum(axis=1) / math.sqrt(size)
                keys = sign[:, :width * tables].reshape(len(x), tables, width) @ (1 << np.arange(width))
                out.append(pd.DataFrame({"rep": g["rep"].to_numpy(), "label": g["label"].to_numpy(), "weight": g["weight"].to_numpy(),
                                         "embedding": g["embedding"].to_numpy(), "code": [r.tobytes() for r in np.packbits(sign, axis=1)],
                                         "factor": factor, "keys": list(keys.astype(np.int64)), "dims": int(dims)}))
            if out:
                yield pd.concat(out)
    return run


def _link_block(threshold: float):
    turns: dict[tuple[int, int], np.ndarray] = {}  # of the task

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dims, table = int(pdf["dims"].iloc[0]), int(pdf["slot"].iloc[0])
        left, right = int(pdf["left"].iloc[0]), int(pdf["right"].iloc[0])
        pdf = pdf.sort_values("rep")
        x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sign = np.unpackbits(np.frombuffer(b"".join(pdf["code"]), dtype=np.uint8).reshape(len(pdf), -1), axis=1).astype(np.float32) * 2 - 1
        size = sign.shape[1]
        factor = pdf["factor"].to_numpy()
        if (size, dims) not in turns:
            turns[size, dims] = rotation(size, dims)
        y = (x @ turns[size, dims].T).astype(np.float32)
        error = CONFIDENCE * np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / math.sqrt(max(size - 1, 1))
        keys = np.stack(pdf["keys"].to_numpy())[:, :table]
        block, weight, rep = pdf["block"].to_numpy(), pdf["weight"].to_numpy(), pdf["rep"].to_numpy()
        links = np.zeros(len(pdf), dtype=np.int64)
        parent = np.arange(len(pdf))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        mine, theirs = np.flatnonzero(block == left), np.flatnonzero(block == right)
        edges = []
        for a in range(0, len(mine), 512):
            i = mine[a:a + 512]
            estimate = (sign[i] @ y[theirs].T) / math.sqrt(size) / factor[i, None]
            p, q = np.nonzero(estimate + error[i, None] >= threshold)
            p, q = i[p], theirs[q]
            keep = p < q if left == right else np.ones(len(p), dtype=bool)
            p, q = p[keep], q[keep]
            for z in range(0, len(p), 100_000):
                u, v = p[z:z + 100_000], q[z:z + 100_000]
                ok = (keys[u] != keys[v]).all(axis=1) & (np.einsum("ij,ij->i", x[u], x[v]) >= threshold)
                u, v = u[ok], v[ok]
                np.add.at(links, u, weight[v])
                np.add.at(links, v, weight[u])
                for s, d in zip(u.tolist(), v.tolist()):
                    s, d = root(s), root(d)
                    if s != d:
                        parent[max(s, d)] = min(s, d)
                        edges.append((rep[min(s, d)], rep[max(s, d)]))
        some = np.flatnonzero(links)
        return pd.DataFrame({
            "rep": np.concatenate([rep[some], np.array([e[0] for e in edges], dtype=np.int64)]),
            "links": np.concatenate([links[some], np.zeros(len(edges), dtype=np.int64)]),
            "other": pd.array([None] * len(some) + [e[1] for e in edges], "Int64")})
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"),
                       F.col(label_col).cast("string").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    v = v.withColumn("valid", valid)
    h1, h2 = F.xxhash64("label", "embedding").alias("h1"), F.xxhash64("embedding", F.lit(1), "label").alias("h2")
    rows = v.where("valid").select("vec_id", "label", "embedding", h1, h2)
    classes = rows.dropDuplicates(["vec_id", "h1", "h2"]).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = materialize(classes, "vector_classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width, tables = plan(largest, threshold)
    codes = materialize(classes.select("rep", "label", "weight", "embedding").mapInPandas(
        _encode(width, tables), "rep long, label string, weight long, embedding array<double>, code binary, factor double, keys array<long>, dims int"),
        "codes")
    met = codes.select("*", F.posexplode("keys").alias("slot", "key"))
    where = ["label", "dims", "slot", "key"]
    blocks = met.groupBy(*where).agg(F.count("*").alias("n")).where("n > 1").select(*where, F.ceil(F.col("n") / BLOCK).alias("blocks"))
    met = met.join(blocks, where).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    # a row joins every pair of blocks that has its own
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn(
        "left", F.least("block", "with")).withColumn("right", F.greatest("block", "with"))
    found = materialize(met.groupBy(*where, "left", "right").applyInPandas(_link_block(threshold), "rep long, links long, other long"), "vector_links")
    counts = found.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("other IS NOT NULL").select(F.col("rep").alias("src"), F.col("other").alias("dst")))
    named = classes.select("h1", "h2", "rep", "weight").join(counts, "rep", "left").join(
        comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    keyed = v.select("vec_id", F.when(F.col("valid"), F.xxhash64("label", "embedding")).alias("h1"),
                     F.when(F.col("valid"), F.xxhash64("embedding", F.lit(1), "label")).alias("h2"))
    out = keyed.join(named, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
