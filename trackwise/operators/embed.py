"""Vectors: JSON edges, key normalisation, fusion, and the default providers.

The reference calls remote models row by row. Here a provider is a function
``DataFrame -> DataFrame`` applied to whole partitions; the built-in ones are
deterministic native-column stand-ins (hashed bags of tokens and raster cells)
so that table shapes, joins and resume behaviour can be exercised without a
network. A user plugs in a remote model with ``mapInPandas`` (batched).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_from_name, key_from_regex

# Fixed value: token pattern of the hashed text provider (runs of letters/digits).
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
DEFAULT_DIM = 64


def vector_to_json(col: str | Column) -> Column:
    """JSON_VEC (write): array -> JSON list text."""
    return F.to_json(F.col(col) if isinstance(col, str) else col)


def vector_from_json(col: str | Column) -> Column:
    """JSON_VEC (read): JSON list text -> ``array<double>``."""
    return F.from_json(F.col(col) if isinstance(col, str) else col, "array<double>")


def to_float32(col: str | Column) -> Column:
    """TO_FLOAT32: ``array<float>``."""
    return (F.col(col) if isinstance(col, str) else col).cast("array<float>")


def normalise_key(df: DataFrame, kind: str, key: str = "trajectory_id") -> DataFrame:
    """KEY_REGEX: image and multimodal tables carry ``trajectory_<key>_<mode>``;
    their key becomes group 1 of the pattern (null when it does not match)."""
    if kind in ("image", "multimodal"):
        return df.withColumn(key, key_from_regex(key))
    return df


def fuse(tables: Sequence[tuple[DataFrame, str]], key: str = "trajectory_id",
         vec: str = "embedding") -> DataFrame:
    """FUSION_JOIN + VEC_CONCAT (LATE_FUSION): inner-join N vector tables on the
    key (duplicates multiply), then concatenate the vectors in input order.

    Each table is ``(key, vec)`` with ``vec`` an array; ``kind`` is 'text',
    'image' or 'multimodal'. Joins are equi-joins Catalyst plans by size.
    """
    out = None
    for i, (df, kind) in enumerate(tables):
        t = normalise_key(df.select(key, vec), kind, key).withColumnRenamed(vec, f"{vec}_{i}")
        out = t if out is None else out.join(t, key, "inner")
    cols = [F.col(f"{vec}_{i}").cast("array<double>") for i in range(len(tables))]
    return out.select(key, F.concat(*cols).alias(vec))


def attach_labels(vectors: DataFrame, labels: DataFrame, key: str = "trajectory_id",
                  label: str = "label") -> tuple[DataFrame, DataFrame]:
    """LABEL_JOIN + KEY_TO_TEXT: left join on the key as text, drop unlabelled rows.

    Returns ``(labelled, unlabelled_count)``; the count replaces a warning.
    """
    v = vectors.withColumn(key, F.col(key).cast("string"))
    lab = labels.select(F.col(key).cast("string").alias(key), F.col(label).alias("true_label"))
    j = v.join(lab, key, "left")
    missing = j.agg(F.sum(F.col("true_label").isNull().cast("int")).alias("unlabelled"))
    return j.where(F.col("true_label").isNotNull()), missing


def text_lookup(images: DataFrame, texts: DataFrame, name: str = "trajectory_id",
                key: str = "unique_id", text: str = "text_information") -> tuple[DataFrame, DataFrame]:
    """TEXT_LOOKUP: image stem -> core key (parts 2-4 of the name) -> text.

    Returns ``(joined, skipped)``: rows without text are skipped, not errors.
    """
    im = images.withColumn("_core", key_from_name(name))
    tx = texts.select(F.col(key).alias("_core"), F.col(text).alias(text))
    joined = im.join(tx, "_core", "inner").drop("_core")
    skipped = im.join(tx, "_core", "left_anti").select(name, F.lit("no_text").alias("reason"))
    return joined, skipped


def _bucket(token: Column, dim: int) -> Column:
    """First 8 hex digits of md5(token) as an integer, mod ``dim``."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def hashed_counts(df: DataFrame, key: str, tokens: Column, dim: int) -> DataFrame:
    """Sparse ``(key, bucket, cnt)`` of hashed tokens; partial aggregation."""
    t = df.select(key, F.explode(tokens).alias("_tok")).where(F.length("_tok") > 0)
    return t.groupBy(key, _bucket(F.col("_tok"), dim).alias("bucket")).agg(
        F.count(F.lit(1)).alias("cnt"))


def dense_normalised(sparse: DataFrame, key: str, dim: int, weight: str = "cnt",
                     out: str = "embedding") -> DataFrame:
    """L2-normalised dense ``array<double>`` of length ``dim`` per key.

    The collected list per key has at most ``dim`` entries (one per bucket).
    """
    g = sparse.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", F.col(weight).cast("double")))).alias("_m"),
        F.sqrt(F.sum(F.col(weight).cast("double") * F.col(weight).cast("double"))).alias("_norm"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                      lambda i: F.coalesce(F.element_at(F.col("_m"), i), F.lit(0.0))
                      / F.when(F.col("_norm") > 0, F.col("_norm")).otherwise(F.lit(1.0)))
    return g.select(key, vec.alias(out))


def text_tokens(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(c), TOKEN_SPLIT)


def embed_text(df: DataFrame, key: str, text: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """EMBED_TEXT default provider: hashed bag of tokens, L2-normalised."""
    return dense_normalised(hashed_counts(df, key, text_tokens(text), dim), key, dim)


def embed_cells(raster: DataFrame, key: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """EMBED_IMAGE default provider: the scene raster's ``(layer, cx, cy) -> count``
    cells hashed into ``dim`` buckets, weighted by count, L2-normalised."""
    tok = F.concat_ws(":", F.col("layer"), F.col("cx").cast("string"), F.col("cy").cast("string"))
    s = raster.groupBy(key, _bucket(tok, dim).alias("bucket")).agg(F.sum("n").alias("cnt"))
    return dense_normalised(s, key, dim)


def embed_multimodal(raster: DataFrame, texts: DataFrame, key: str, text: str,
                     dim: int = DEFAULT_DIM) -> DataFrame:
    """EMBED_MULTIMODAL default provider (early fusion): raster cells and text
    tokens hashed into one space, one vector per key from both inputs.

    Keys without text get no vector, as in the image lookup. Work is linear in
    cells + tokens: the two bags are added, no (cell, token) pairs are formed.
    """
    raster = raster.join(texts.where(F.col(text).isNotNull()).select(key).distinct(), key, "left_semi")
    tok = F.concat_ws(":", F.col("layer"), F.col("cx").cast("string"), F.col("cy").cast("string"))
    cells = raster.groupBy(key, _bucket(tok, dim).alias("bucket")).agg(F.sum("n").alias("cnt"))
    words = hashed_counts(texts, key, text_tokens(text), dim)
    both = cells.unionByName(words).groupBy(key, "bucket").agg(F.sum("cnt").alias("cnt"))
    return dense_normalised(both, key, dim)


def batched_provider(fn: Callable[[list[str]], list[list[float]]], key: str, text: str,
                     out_schema: str = "trajectory_id string, embedding array<float>"
                     ) -> Callable[[DataFrame], DataFrame]:
    """Wrap a user's batch function (e.g. a remote model client) as a partition
    operator: Arrow batches in, one vector per row out. A batch that fails is
    tried row by row; a row that fails has a null vector and, with a third column
    in ``out_schema`` (a string), the reason, so the job goes on and a later run
    can take it up again (``rejected`` and ``accepted`` split the result). Rate
    limits are bounded by the number of partitions the caller gives this stage."""
    names = [c.split()[0] for c in out_schema.split(", ")]

    def run(it: Iterator):
        import pandas as pd
        for pdf in it:
            reasons = [None] * len(pdf)
            try:
                vecs = fn(pdf[text].tolist())
            except Exception:  # noqa: BLE001 -- the provider's own errors, kept per row below
                vecs = []
                for i, t in enumerate(pdf[text].tolist()):
                    try:
                        vecs += fn([t])
                    except Exception as e:  # noqa: BLE001
                        vecs.append(None)
                        reasons[i] = f"{type(e).__name__}: {e}"[:500]
            cols = [pdf[key], pd.Series(vecs, index=pdf.index, dtype=object), pd.Series(reasons, index=pdf.index, dtype=object)]
            yield pd.DataFrame(dict(zip(names, cols)))

    def apply(df: DataFrame) -> DataFrame:
        return df.select(key, text).mapInPandas(run, out_schema)
    return apply


def accepted(out: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows of a provider's result that have a vector: the ones to append."""
    return out.where(F.col(vec).isNotNull())


def rejected(out: DataFrame, key: str = "trajectory_id", vec: str = "embedding", reason: str = "reason") -> DataFrame:
    """``key, reason`` of the rows that failed; not being in the output, they are
    pending again on the next run."""
    return out.where(F.col(vec).isNull()).select(key, reason)
