"""Rows and links that shortcuts would lose."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import brute
from trackwise.llm import jaccard, langid, packing, queries, secret_scan
from trackwise.llm.wordhash import U, Words, row_chunks, shingle_sets


def test_sets_with_equal_half_sums_stay_apart(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"{base} x189448"), (2, f"{base} x203877")]
    sums = [jaccard.set_sums(*shingle_sets(Words(d, o, True), 5)) for _, _, d, o in row_chunks(pa.array([t for _, t in rows]))]
    f = np.concatenate(sums, axis=1)
    assert f[0, 0] >> U(32) == f[0, 1] >> U(32) and f[0, 0] != f[0, 1]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows) == {1: (37, 1), 2: (37, 1)}


def test_large_words_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 20)
    rng = random.Random(7)
    # one family of 300 rows, 90 rows in small components, a stray: all hold word 1; word 2 is small
    docs = [(d, 0 if d < 300 else 1000 + d % 40 if d < 390 else d) for d in range(391)]
    named = spark.createDataFrame([(1, d, 0, c) for d, c in docs] + [(2, d, 0, c) for d, c in docs[295:305]],
                                  "word long, doc long, hub long, component long")
    dealt, pairs = jaccard.deal_blocks(named, spark.createDataFrame([(1, 391)], "word long, size long"))
    held = {b: set() for b in {r.block for r in dealt.collect()}}
    for r in dealt.collect():
        held[r.block].add((r.doc, r.component))
    assert sum(map(len, held.values())) == 391 and max(map(len, held.values())) < 100
    met = set()
    for r in pairs.collect():
        assert not (r.low.alone and r.high.alone and r.low.owner == r.high.owner)  # no two blocks of one component
        met |= {(min(x, y), max(x, y)) for x, c in held[r.low] for y, e in held[r.high] if c != e}
    assert met == {(x, y) for x, c in docs for y, e in docs if x < y and c != e}
    # equal sketches: every pair across components that shares a word is a candidate
    sets = spark.createDataFrame([(d, bytearray(8 * rng.choice([10, 11])), bytearray(8 * 16)) for d, _ in docs], "doc long, hashes binary, sketch binary")
    got = {(r.hub, r.doc) for r in jaccard._far_pairs(named, sets, jaccard.THRESHOLD).distinct().collect()}
    assert got == met


def test_large_family_with_strays_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 10)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(60)]
    rows = []
    for d in range(240):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):  # near the threshold: several components share words
            text[rng.randrange(60)] = word()
        rows.append((d, " ".join(text)))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows)


def test_rows_without_id_are_kept(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, text), (2, "another text of the repeated id"), (3, "alone"), (None, text), (None, None), (None, "no id here")]
    got = jaccard.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
        (d or 0, t or "") for d, t in rows if d != 2)


def test_all_texts_of_a_repeated_id_are_compared():
    bits = lambda x: np.full(16, x, dtype=U).tobytes()
    far, near = bits(0xFFFFFFFFFFFFFFFF), bits(0)
    sketches = [(1, 1, near), (2, 2, far), (2, 2, near), (2, 2, far)]
    rows = [{"word": 5.0, "doc": d, "component": c, "n": None, "sketch": None} for d, c in ((1, 1), (2, 2), (2, 2))]
    rows += [{"word": None, "doc": d, "component": c, "n": 100, "sketch": s} for d, c, s in sketches]
    got = jaccard._sketch_pairs(jaccard.THRESHOLD)(pd.DataFrame(rows))
    assert got.values.tolist() == [[1, 2]]


def test_language_models_in_slices_equal_the_whole(spark):
    rows = [(d, f"{a} the quick brown fox jumps over {d}", "en") for d, a in enumerate("alpha beta gamma delta".split() * 5)]
    rows += [(100 + d, f"{a} der schnelle braune fuchs", "de") for d, a in enumerate("eins zwei drei".split() * 5)]
    rows += [(200, "qo zu rare", "xx"), (None, None, "en"), (201, "", None), (202, "unseen żółw text", None), (100, "brown fox", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    whole, parts = (sorted((r.doc_id or -1, r.lang_pred, round(r.score, 5), round(r.cross_entropy or 0, 5), r.rejected)
                           for r in langid.identify(df, F.lit(True), max_ngrams=m).collect()) for m in (langid.MAX_NGRAMS, 60))
    assert whole == parts and (200, "xx") in {r[:2] for r in parts}


def test_ordinary_words_of_all_documents_are_learned(spark):
    state = lambda c: secret_scan.ALPHABET.index(c) + 1
    hit = "token=" + "x7" * 10
    ratio = lambda texts: secret_scan.train(spark.createDataFrame([(t,) for t in texts], "text string"))[state("q") * secret_scan._STATES + state("u")]
    one, more = ratio([hit, "quick"]), ratio([hit, "quick quick quick"])
    assert ratio([hit]) > one > more  # words of texts without a match count, and each time they occur


def test_separator_controls_are_tokens():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(queries.tokenizer_path())
    texts = ["ab\x1ccd \x1d x\x1e\x1fy", "a\x1c\x85b\xa0c\u1680d\u2003e\u2028f\u202fg\u205fh\u3000i\tj\x0bk\x0cl", "plain words"]
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in packing.WordTokens(queries.tokenizer_path()).encode(texts)]
    assert got == [model.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] != [i for w in texts[0].split() for i in model.encode(w, add_special_tokens=False).ids]
