"""Corpus operators against plain Python on whole small tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trackwise.llm import licenses, packing, pii, queries, secret_scan
from trackwise.llm.common import connected_components
from trackwise.llm.jaccard import bit_sketch, part_words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_components_of_chains_stars_and_hubs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500 + rng.randrange(80), 500 + rng.randrange(80)) for _ in range(60)]
    groups = brute.Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.union(a, b)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: groups.find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_write_no_round_that_changes_nothing(spark, monkeypatch):
    """Every round costs the driver shuffles and tasks: stars need none, stars and a new link one."""
    from trackwise.llm import common

    written, write = [], common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, name: written.append(df) or write(df, name))

    def components(rows):
        written.clear()
        return {r.id: r.component for r in common.connected_components(spark.createDataFrame(rows, "src long, dst long")).collect()}

    stars = [(i, i % 3) for i in range(3, 60)] + [(2, 5), (7, 7)]  # with a repeat the other way round
    assert components(stars[:-2]) == {i: i % 3 for i in range(60)} and len(written) == 1
    assert components(stars) == {i: i % 3 for i in range(60)} and len(written) <= 2
    assert components(stars + [(1, 2)]) == {i: min(i % 3, 1) for i in range(60)} and len(written) <= 2
    round_ = written[-1]._jdf.queryExecution().executedPlan().toString()
    assert round_.count("Exchange hashpartitioning") <= 5


def test_near_duplicates_equal_brute_force(spark, documents):
    got = by_id(queries.op2_ngram_jaccard(spark, SF))
    want = brute.near_duplicates(documents)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert any(d != c for d, (_, c) in want.items())


def test_part_words_meet_for_every_similar_pair():
    """The pigeonhole: sets at the threshold share a part word, whatever their sizes."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**63, rng.integers(3, 200), dtype=np.int64).astype(np.uint64))
        add = rng.integers(0, 2**63, rng.integers(0, len(a) // 3 + 1), dtype=np.int64).astype(np.uint64)
        b = np.unique(np.concatenate([rng.permutation(a)[:len(a) - rng.integers(0, len(a) // 4 + 1)], add]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 75 * (len(a) + len(b) - common):
            continue
        words, who, space, least = part_words(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        shared = set(words[who == 0].tolist()) & set(words[who == 1].tolist())
        assert shared
        for i in (0, 1):  # and in a space where they meet, enough of them
            counts = [len(shared & set(words[(who == i) & (space == s)].tolist())) for s in range(3)]
            assert any(c >= least[i, s] for s, c in enumerate(counts))
        x, y = (np.frombuffer(bit_sketch(v), dtype=np.uint8) for v in (a, b))
        if len(x) == len(y):
            assert int(np.bitwise_count(x ^ y).sum()) <= len(a) + len(b) - 2 * common


def test_contained_items_equal_brute_force(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in queries.op9_decontamination(spark, SF).collect()}
    assert got == brute.contained(documents, items) and got


def test_repeats_equal_brute_force(spark, documents):
    got = by_id(queries.op8_substring_dedup(spark, SF))
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in got.items()} == brute.cut_repeats(documents)


def test_repeats_in_chains_of_shifted_passages(spark):
    """Passages that overlap several sources at different places."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(0, 340)
            text += words[a:a + rng.randrange(30, 140)] + [f"x{rng.random()}"] * rng.randrange(0, 3)
        rows.append((d, " ".join(text)))
    rows += [(100, rows[3][1]), (101, "a " * 200), (102, "a " * 120), (103, None), (104, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from trackwise.llm.repeats import cut_repeats
    got = by_id(cut_repeats(df))
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in got.items()} == brute.cut_repeats(rows)


def pii_rows():
    rng = random.Random(5)
    al = "0123456789  --..+@+()abAZ_%é\U0001F600\n"
    rows = [(i, "".join(rng.choice(al) for _ in range(rng.randrange(300)))) for i in range(300)]
    return rows + [(5000, None), (5001, ""), (5002, "1" * 30000), (5003, "a" * 20000 + "@" + "b." * 9000),
                   (5004, "4111 1111 1111 1111 " * 600), (5005, "x@y.z_q@r.s 1.2.3.4.5.6.7.8 +1 (234) 567-8901"),
                   (5006, "1-" * 20000), (5007, "+1" + "(" * 20000), (5008, "4111111111111111, " * 400)]


def test_pii_equals_plain_patterns(spark, documents):
    for rows in (pii_rows(), documents):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = pii.find_pii(df).collect()
        texts = dict(rows)
        for r in got:
            base = [(p.start, p.rank, p.kind, p.end) for p in r.pii if p.kind in pii.BASE_KINDS]
            assert base == brute.pii_spans(texts[r.doc_id]), r.doc_id
            assert all((texts[r.doc_id] or "")[p.start:p.end] == p.value for p in r.pii)


def test_pii_query_digest(spark, documents):
    got = by_id(queries.op1_pii(spark, SF))
    for d, t in documents:
        spans = brute.pii_spans(t)
        assert got[d]["base_sha256"] == brute.digest(spans)
        assert got[d]["n_email"] == sum(s[2] == "email" for s in spans)


def test_checksums_and_context(spark):
    rows = [(1, "pay to IBAN DE89 3704 0044 0532 0130 00 now"), (2, "DE88370400440532013000"), (3, "SSN 123-45-6789"), (4, "part 123-45-6789"),
            (5, "write to a.b@c.org or +44 20 7946 0958")]
    got = {r.doc_id: r for r in pii.redact_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].text for i in range(1, 6)] == ["pay to IBAN <IBAN> now", rows[1][1], "SSN <SSN>", rows[3][1], "write to <EMAIL> or <PHONE>"]


def test_ibans_end_at_their_countrys_length(spark):
    rows = [(1, "GB82 WEST 1234 5698 7654 32 REF 77"), (2, "DE89 3704 0044 0532 0130 00 BIC COBADEFF"), (3, "NO9386011117947,"),
            (4, "GB82 WEST 1234 5698 7654 3"), (5, "ZZ82 WEST 1234 5698 7654 32"), (6, "xGB82WEST12345698765432"), (7, "GB82WEST12345698765432X"),
            (8, "MT84MALT011000012345MTLCAST001S FR14 2004 1010 0505 0001 3M02 606")]
    got = {r.doc_id: [p.value for p in r.pii if p.kind == "iban"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [rows[0][1][:27]], 2: [rows[1][1][:27]], 3: ["NO9386011117947"], 4: [], 5: [], 6: [], 7: [], 8: [rows[7][1][:31], rows[7][1][32:]]}


def test_ibans_of_long_texts(spark):
    rows = [(1, "GB82 " * 20000), (2, "GB82" * 20000), (3, "FR14 2004 1010 0505 0001 3M02 606 " * 500)]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: len([p for p in r.pii if p.kind == "iban"]) for r in got} == {1: 0, 2: 0, 3: 500}


def test_secrets_equal_plain_patterns(spark, documents):
    rng = random.Random(3)
    bits = ["token", "=", ":", '"', "secret", "API_KEY", "apikey", "PassWord", " ", "AKIA", "ABCD1234", "deadbeef", "0123", "é", "xyz-_/", "\n",
            "K", "passwd", "'", "Qz9+/", "\U0001F600"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(5000, None), (5001, ""), (5002, "a" * 30000), (5003, "AKIA" * 9000), (5004, "token" + " " * 30000), (5005, "token=aB3xK9qLmN2pR8vT secret: x")]
    ratios = secret_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for rows in (rows, documents):
        texts = dict(rows)
        for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), ratios).collect():
            base = [(p.start, p.rank, p.kind, p.end) for p in r.secrets if p.kind in secret_scan.BASE_KINDS]
            assert base == brute.secret_spans(texts[r.doc_id]), r.doc_id
            assert all((texts[r.doc_id] or "")[p.start:p.end].endswith(p.value) for p in r.secrets)
    tokens = [("wJalrXUtnFEMI7K3MDENGbPxRfiCY",), ("the_ordinary_identifier_of2words",)]
    got = spark.createDataFrame(tokens, "t string").select(secret_scan.mean_ratio(F.col("t"), ratios)).collect()
    assert got[0][0] > got[1][0]


def test_license_places_equal_brute_force(spark, documents):
    rows = [*documents, (9001, "cc by cc by, ALL RIGHTS\nRESERVED general-public_license"), (9002, None), (9003, ""), (9004, "cc" * 9000), (9005, "écc by cc byé cc  by")]
    for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        n, places = brute.license_places(r.text, licenses.BASE)
        assert (r.n_words, sorted((b.start, b.label) for b in r.base)) == (n, places), r.doc_id


def test_license_rules_and_suppression(spark):
    rows = [(1, "under the GNU General Public License, version 2 or later."), (2, "Licensed under the Apache License, Version 2.0"), (3, "SPDX-License-Identifier: MIT"),
            (4, "CC BY-SA 4.0"), (5, "BSD 3-clause"), (6, "nothing here")]
    got = {r.doc_id: [m.label for m in r.marks] for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["gpl-2"], 2: ["apache", "apache-2.0"], 3: ["mit"], 4: ["cc-by-sa-4.0"], 5: ["bsd-3-clause"], 6: []}
    assert len(licenses.rules()) > 200


def test_suppression_equals_brute_force(spark):
    rng = random.Random(11)
    cases = [[(0, 10, 3), (2, 12, 4), (3, 9, 3)], [(0, 10, 3), (2, 8, 1), (3, 7, 2)], []]
    cases += [[(a, a + rng.randrange(1, 9), rng.randrange(5)) for a in (rng.randrange(12) for _ in range(rng.randrange(9)))] for _ in range(400)]
    marks = [(i, sorted((a, -b, rank, "x") for a, b, rank in case)) for i, case in enumerate(cases)]
    df = spark.createDataFrame(marks, "i long, m array<struct<start:bigint,minus_end:bigint,rank:int,label:string>>")
    got = {r.i: [(m.start, m.minus_end, m.rank) for m in r.kept] for r in df.select("i", licenses._uncovered(F.col("m")).alias("kept")).collect()}
    for i, case in marks:
        kept = []
        for a, b, rank, _ in case:
            if not any(c <= a and d <= b and q <= rank for c, d, q in kept):
                kept.append((a, b, rank))
        assert got[i] == kept, cases[i]


def test_plan_is_best_fit_decreasing():
    import bisect
    rng = random.Random(1)
    for _ in range(200):
        cap = rng.choice([10, 16, 64])
        h = {rng.randint(1, cap): rng.randint(1, 50) for _ in range(rng.randint(1, 12))}
        bins, count = {}, {}
        for length, lo, hi, first, offset in packing.plan_slots(h, cap):
            for i in range(lo, hi):
                bins.setdefault(first + i - lo, []).append((offset, length))
                count.setdefault(length, set()).add(i)
        assert count == {k: set(range(n)) for k, n in h.items()}
        for v in bins.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length
            assert at <= cap
        plain = []
        for length in sorted((k for k, n in h.items() for _ in range(n)), reverse=True):
            i = bisect.bisect_left(plain, length)
            room = plain.pop(i) if i < len(plain) else cap
            bisect.insort(plain, room - length)
        assert len(plain) == len(bins)


def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(queries.tokenizer_path())
    rows = [*documents, (9001, None), (9002, ""), (9003, "don't ÉtÉ <|endoftext|>x<|endoftext|> é́ İΣ a b 42 ###!! " * 700), (9003, "again"),
            (9004, "word's" * 30)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), queries.tokenizer_path()).toPandas()
    pieces = {}
    for d, t in rows:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for i, a in enumerate(range(0, len(ids), 4096)):
            pieces[d, i, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())] = 1
    assert set(zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)) == set(pieces) and len(got) == len(pieces)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 4096
    least = -(-got.length.sum() // 4096)
    assert got.sequence_id.nunique() <= 1.02 * least + 1


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 64))
    x = centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, 64)) * rng.choice([0.05, 0.2, 0.3, 0.4], size=(900, 1))
    x[100:130] = x[0]
    rows = [(i, [float(v) for v in np.float32(r)], int(rng.integers(0, 3))) for i, r in enumerate(x)]
    rows += [(2000, None, 1), (2001, [0.0] * 64, 1), (2002, [float("nan")] * 64, 1), (2003, [1.0, None], 1), (2004, rows[0][1], None), (2005, [], 1), (2006, [1.0, 2.0], 1), (2007, [1.0, 2.0], 1)]
    from trackwise.llm.vecdedup import near_vectors
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).toPandas().set_index("vec_id")
    unit = x.astype(np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[:900]])
    link = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    groups = brute.Groups(range(900))
    for a, b in zip(*np.nonzero(link)):
        groups.union(int(a), int(b))
    links = got.n_links.reindex(range(900)).to_numpy()
    assert (links <= link.sum(axis=1)).all() and links.sum() >= 0.99 * link.sum()
    assert (got.component_id.reindex(range(900)).to_numpy() == [groups.find(i) for i in range(900)]).mean() > 0.99
    assert got.loc[[2000, 2001, 2002, 2003, 2004, 2005]].n_links.sum() == 0 and got.loc[2007].component_id == 2006


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_language_id(spark, sf).toPandas().merge(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda d: brute.crc_part(d, 4) == 2)).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()


def test_language_probabilities_sum_to_one():
    """Kneser-Ney: after any history the model's probabilities of all characters sum to 1."""
    from trackwise.llm.langid import Letters, Model, _char_table
    text = "abracadabra cada brad".encode()
    grams, _ = Letters(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), _char_table()).grams()
    keys, counts = np.unique(grams, return_counts=True)
    model = Model(["x"], np.zeros(len(keys), dtype=int), keys, counts)
    chars = [ord(c) for c in " abcdr"]
    for history in ("bra", "   ", "zzz", "cad"):
        h = sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(history))
        p = np.exp(model.log_probabilities(np.array([h | c for c in chars], dtype=np.uint64)))
        unseen = np.exp(model.log_probabilities(np.array([h | ord("q")], dtype=np.uint64)))
        assert abs(p.sum() + unseen[0, 0] - 1) < 1e-4


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_quality(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda d: brute.crc_part(d, 3) == 1)).all()
    held = got[got.held_out]
    assert (held.quality == held.predicted).mean() > 0.95 and got.score.between(0, 1).all()


def test_tree_rules_are_the_paths():
    from trackwise.llm.quality import tree_rules
    text = """RandomForestClassificationModel: uid=x
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 > 2.0E-4)
      Predict: 0.0
     Else (feature 1 <= 2.0E-4)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
"""
    assert tree_rules(text, ("a", "b")) == [("a <= 1.5D",), ("a <= 1.5D", "b > 0.0002D"), ("a <= 1.5D", "b <= 0.0002D"), ("a > 1.5D",)]


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline as pipeline
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    good = pipeline.keep_good(spark, docs, sf)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert good.columns == columns and 0 < len(rows) < docs.count()
    unique = pipeline.one_of_each_group(spark, good, sf)
    want = {d for d, (_, c) in brute.near_duplicates(rows).items() if d == c}
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == want
    rows = [r for r in rows if r[0] in want]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {d for d, *_ in brute.contained(rows, items)}
    clean = pipeline.without_benchmarks(spark, unique, sf)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want - bad and bad
    texts = dict(rows)
    safe = pipeline.without_personal_data(spark, clean, sf)
    assert safe.columns == columns
    for r in safe.collect():
        assert not brute.pii_spans(r.text) or brute.pii_spans(texts[r.doc_id]) == []
        assert brute.pii_spans(texts[r.doc_id]) or r.text == texts[r.doc_id] or "<" in r.text
    assert {r.doc_id for r in pipeline.run(spark, sf).select("doc_id").distinct().collect()} == want - bad
