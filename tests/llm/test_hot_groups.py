"""Large families of copies and passages that many documents share."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trackwise.llm import decontam, jaccard, repeats


def family(seed, base_words, members, edits):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(base_words)]
    passage = [word() for _ in range(60)]
    rows = []
    for d in range(members):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(len(text))] = word()
        rows.append((d * 3, " ".join(text)))
    rows += [(10_000 + d, rows[0][1]) for d in range(30)]                                            # exact copies
    for d in range(120):                                                                              # a shared passage
        own = [word() for _ in range(rng.randrange(5, 120))]
        at = rng.randrange(len(own))
        rows.append((20_000 + d, " ".join(own[:at] + passage + own[at:])))
    rng.shuffle(rows)
    return rows, " ".join(passage)


@pytest.mark.parametrize("seed, words, edits", [(1, 40, 4), (2, 150, 12), (3, 9, 2)])
def test_near_duplicates_of_a_large_family(spark, seed, words, edits):
    rows, _ = family(seed, words, 160, edits)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(13)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows)


def test_repeats_of_a_large_family(spark):
    rows, _ = family(4, 150, 100, 6)
    got = repeats.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(13)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.cut_repeats(rows)


@pytest.mark.parametrize("bound", [500_000, 0])
def test_item_in_many_documents(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", bound)
    rows, passage = family(5, 60, 50, 3)
    items = [(1, passage), (2, " ".join(passage.split()[:20])), (3, "five words that are nowhere")]
    got = decontam.contained_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got.collect()} == brute.contained(rows, items)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_search_probes_sketches_only_and_misses_none(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijkl") * 3
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 9, 30, 80])))) for i in range(60)]
    rows = []
    for d in range(300):
        text = [word() for _ in range(rng.randrange(40))]
        item = rng.choice(items)[1].split()
        for _ in range(rng.randrange(3)):
            item[rng.randrange(len(item))] = word()
        rows.append((d, " ".join(text + item + text[::-1])))
    docs, tests = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontam.contained_items(docs, tests).collect()}
    assert got == brute.contained(rows, items) and got
    index = decontam.item_index(tests, "item_id", "text", 5, decontam.THRESHOLD)
    sizes = {(r.n_item, r.least): r.n for r in index.where("in_sketch").groupBy("item_id", "n_item", "least").agg(F.count("*").alias("n")).collect()}
    assert all(n == q - least + 1 for (q, least), n in sizes.items())
    pairs = {tuple(r) for r in decontam.candidate_pairs(docs, index, "doc_id", "text", 5).collect()}
    assert {g[:2] for g in got} <= pairs
    assert len(pairs) < docs.count() * tests.count() / 4


def test_only_copied_documents_send_the_key_of_their_set(spark, monkeypatch):
    """8 bytes a document and bucket are shuffled for documents that have copies, not for all."""
    seen, words = [], jaccard._word_rows

    def watched(k, t, buckets, copied):
        seen.append((words(k, t, buckets, copied), copied))
        return seen[-1][0]

    monkeypatch.setattr(jaccard, "_word_rows", watched)
    rows, _ = family(6, 60, 40, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates(rows)
    texts = [t for _, t in rows]
    sent = docs.select("doc_id", "text", jaccard._bit_of("doc_id").alias("bit")).mapInArrow(
        seen[0][0], "bucket int, words binary, who binary, docs binary, sets binary").selectExpr(
        "sum(length(sets)) / 8 AS keys", "sum(length(docs) - 8) / 4 AS docs").first()
    several = {t for t in texts if texts.count(t) > 1}
    assert 0 < sent["keys"] < sent["docs"] * 0.4 and sum(t in several for t in texts) < 0.4 * len(texts)
