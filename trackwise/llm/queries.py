"""Registered queries of the corpus operators: each applies its operator to the
whole table and derives the digest columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses, periodic, pii, secret_scan
from .common import read_table
from .decontam import contained_items
from .jaccard import near_duplicates
from .langid import identify
from .oracle import ORACLE
from .packing import pack
from .quality import quality_scores
from .repeats import cut_repeats
from .sharding import shard_by_bytes
from .spans import span_text
from .vecdedup import near_vectors
from .whitening import whiten

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _of_kind(spans: str, *kinds: str) -> Column:
    return F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds))


@register
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans of every document."""
    found = pii.find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "found")
    return found.select(
        "doc_id", *(F.size(_of_kind("found", k)).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS),
        F.sha2(span_text(_of_kind("found", *pii.BASE_KINDS)), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"),
        F.round(F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)), 4).alias("top_score"))


@register
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def _id_part(n: int) -> Column:
    """Remainder by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    found = identify(read_table(spark, sf_dir, "documents"), _id_part(4) != 2)
    return found.select("doc_id", F.coalesce(_id_part(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@register
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


@register
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.train(docs), "text", "found")
    return found.select(
        "doc_id", *(F.size(_of_kind("found", k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
        F.sha2(span_text(_of_kind("found", *secret_scan.BASE_KINDS)), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


@register
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels of those that are not held out."""
    scores = quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), _id_part(3) != 1)
    return scores.select("doc_id", F.coalesce(_id_part(3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


@register
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return cut_repeats(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, base places, labels and score of every document."""
    found = licenses.find_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, marks = F.col("base"), F.col("marks")
    starts = F.transform(base, lambda b: b["start"])
    names = F.transform(base, lambda b: b["label"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(names, F.transform(marks, lambda m: m["label"])))), ",").alias("labels"),
        licenses.license_score(base, marks).alias("score"))


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and digests of every document, with repeating words planted in one of ten."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", periodic.planted_runs(F.col("text"), F.crc32(F.col("doc_id").cast("string"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic.periodic_runs(docs).withColumn("best", periodic.strongest_run(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


@register
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, equal texts together, shards balanced by bytes."""
    placed = shard_by_bytes(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every finite vector."""
    return whiten(read_table(spark, sf_dir, "embeddings"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
