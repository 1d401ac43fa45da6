"""Benchmark decontamination: short test items inside long documents.

Items and documents are sets of k-word shingles (64-bit hashes). An item is in a
document when at least ``num/den`` of its shingles are in the document's set.

Search: items are partitioned by size. An item of q shingles, of which a containing
document shares at least ``least`` = ceil(q * num/den), has the MinHash sketch of its
q - least + 1 smallest hashes. Such a document lacks at most q - least of them, so it
holds at least one of the sketch: probing the documents' shingles with the sketches
alone misses none. Documents with fewer shingles than an item's least overlap are not
candidates for it.
Verification: the shingles of candidate documents only meet all shingles of their
candidate items, and containment is counted exactly.

Sketches, items and candidates are each broadcast when their counted rows are at most
``BROADCAST_ROWS``; beyond that they are joined by shuffle. Native columns only.

Defined results: null or empty texts have no shingles and are neither found nor
searched. Texts of fewer than k words are one shingle, the whole sequence. Rows
that repeat a doc_id (or item_id) count together as one set (the size test then
holds for each row). Null ids are
not reported. Extra columns are ignored by ``contained_items`` and kept by
``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SHINGLE_WORDS = 5
THRESHOLD = (75, 100)
BROADCAST_ROWS = 500_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs outside space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def shingle_hashes(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """Hashes of the k-word shingles of a text (A-Z lower-cased), in text order."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))
    # the words are computed once, as the only element of an outer array
    return F.flatten(F.transform(F.array(words), lambda w: F.when(
        F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, k)))
    ).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))))


def item_index(items: DataFrame, id_col: str, text_col: str, k: int, t: tuple[int, int]) -> DataFrame:
    """One row per item and distinct shingle: item_id, hash, n_item, least
    (shingles that a containing document shares), in_sketch."""
    sets = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("item_id"), F.explode(shingle_hashes(F.col(text_col).cast("string"), k)).alias("hash"))
    sets = sets.groupBy("item_id").agg(F.array_sort(F.collect_set("hash")).alias("hashes"))  # one item: a short text
    n = F.size("hashes")
    least = F.ceil(n * t[0] / t[1]).cast("int")
    return sets.select("item_id", n.alias("n_item"), least.alias("least"),
                       (n - least + 1).alias("sketch"), F.posexplode("hashes").alias("place", "hash")).select(
        "item_id", "n_item", "least", "hash", (F.col("place") < F.col("sketch")).alias("in_sketch"))


def small(rows: DataFrame) -> DataFrame:
    """A written table, marked for broadcast when its counted rows allow it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def document_shingles(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """doc_id, n_doc (shingles of the row), hash: one row per shingle of a document; one of a
    null hash if there is none. (The outer form keeps the optimizer from testing the lists'
    sizes in the scan, which would compute them twice and before the candidates are chosen.)"""
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), shingle_hashes(F.col(text_col).cast("string"), k).alias("hashes"))
    return rows.select("doc_id", F.size("hashes").alias("n_doc"), F.explode_outer("hashes").alias("hash"))


def candidate_pairs(docs: DataFrame, index: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Distinct doc_id, item_id where the document holds a hash of the item's sketch."""
    sketch = small(index.where("in_sketch").select("item_id", "least", "hash"))
    return document_shingles(docs, id_col, text_col, k).join(sketch, "hash").where("n_doc >= least").select("doc_id", "item_id").distinct()


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", k: int = SHINGLE_WORDS,
                    t: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment of every contained item."""
    index = materialize(item_index(items, item_id, item_text, k, t), "item_index")
    pairs = materialize(candidate_pairs(docs, index, id_col, text_col, k), "candidates")
    ids = small(pairs.select(F.col("doc_id").alias("__candidate")).distinct())
    chosen = docs.join(ids, F.col(id_col) == F.col("__candidate"), "left_semi")
    rows = document_shingles(chosen, id_col, text_col, k)
    hits = rows.join(small(index), "hash").where("n_doc >= least").join(small(pairs), ["doc_id", "item_id"], "left_semi")
    shared = hits.select("doc_id", "item_id", "hash", "n_item", "least").distinct()
    found = shared.groupBy("doc_id", "item_id", "n_item", "least").agg(F.count("*").alias("n_shared"))
    return found.where("n_shared >= least").select(
        "doc_id", "item_id", F.col("n_item").cast("long").alias("n_item"), "n_shared",
        F.round(F.col("n_shared") / F.col("n_item"), 4).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that contain no item (all columns kept)."""
    found = contained_items(docs, items, id_col, text_col).select(F.col("doc_id").alias("__found")).distinct()
    return docs.join(found, F.col(id_col) == F.col("__found"), "left_anti")
