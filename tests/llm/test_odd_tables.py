"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from trackwise.llm import decontam, jaccard, langid, licenses, packing, pii, quality, queries, repeats, secret_scan, vecdedup

RATIOS = [0.0] * secret_scan._STATES ** 2
CLASHES = ("word", "hub", "key", "bucket", "rank", "salt", "length", "score", "spans", "n", "label", "value", "hash", "item_id", "component", "id")
OPERATORS = {
    "pii": lambda d: pii.find_pii(d),
    "redact": lambda d: pii.redact_pii(d),
    "near": lambda d: jaccard.near_duplicates(d),
    "drop_near": lambda d: jaccard.drop_near_duplicates(d),
    "language": lambda d: langid.identify(d, F.lit(True)),
    "secrets": lambda d: secret_scan.find_secrets(d, RATIOS),
    "secret_training": lambda d: d.sparkSession.createDataFrame([(x,) for x in secret_scan.train(d)], "x double"),
    "quality": lambda d: quality.quality_scores(d, d.select("doc_id", F.lit(1).alias("quality"))),
    "drop_low": lambda d: quality.drop_low_quality(d, d.select("doc_id", (F.col("doc_id") % 2).alias("quality"))),
    "packing": lambda d: packing.pack(d, queries.tokenizer_path()),
    "repeats": lambda d: repeats.cut_repeats(d),
    "contained": lambda d: decontam.contained_items(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "drop_contaminated": lambda d: decontam.drop_contaminated(d, d.where("doc_id = 2").select(F.col("doc_id").alias("item_id"), "text")),
    "licenses": lambda d: licenses.find_licenses(d),
}


def odd(spark):
    long = "lorem ipsum dolor sit amet " * 8000
    rows = [(1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "one two", None), (5, long, "en"), (5, long, "en"), (6, long + "x", "fr"), (None, "null id here now", "en"),
            (None, None, None), (7, "é\U0001F600 中文", "zh"), (8, "cc by token=abcdefghijklmnop a@b.co", "en"), (8, "another text of eight", "en"), (9, "!!! ### 123", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for i, c in enumerate(CLASHES):
        df = df.withColumn(c, F.lit(f"x{i}"))
    return df


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_columns(spark, name):
    df = odd(spark)
    rows = OPERATORS[name](df).collect()
    per_row = {"pii", "redact", "near", "language", "secrets", "quality", "repeats", "licenses"}
    assert len(rows) == df.count() if name in per_row else True


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    rows = OPERATORS[name](df).collect()
    assert rows == [] or name == "secret_training"


def test_defined_results_of_odd_rows(spark):
    df = odd(spark)
    near = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (None, 0, None)} <= near
    # a cycle of five words has five shingles; the word behind it adds one: 5 of 6 are common
    assert {(d, n, c) for d, n, c in near if d in (5, 6)} == {(5, 5, 5), (6, 6, 5)}
    lang = {(r.doc_id, r.lang_pred) for r in langid.identify(df, F.lit(True)).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "und")} <= lang
    cut = {(r.doc_id, r.n_words, r.n_removed) for r in repeats.cut_repeats(df).collect()}
    assert (5, 40000, 0) in cut and (6, 40001, 40000) in cut
    pieces = packing.pack(df, queries.tokenizer_path()).where("doc_id IN (1, 2, 3)").collect()
    assert [(p.piece, p.start, p.length) for p in pieces] == [(0, 0, 1)] * 3
    kept = quality.drop_low_quality(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert kept.count() == df.count() and kept.columns == df.columns
    assert decontam.contained_items(df, spark.createDataFrame([(1, None), (2, ""), (3, "one two")], "item_id long, text string")).select(
        "doc_id", "item_id").collect() == [(4, 3)]


def test_empty_vectors_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vecdedup.near_vectors(empty).count() == 0
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (None, [1.0, 0.0], 1)]
    got = vecdedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(0)).withColumn("keys", F.lit(1)))
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got.collect()) == [
        (0, 0, 0, False), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
