"""Periodic runs against a scan of every lag."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trackwise.llm import periodic, queries
from trackwise.llm.wordhash import Words

SF = "/root/testdata/sf0.001"


def found(texts):
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(r) for r in raw])
    doc, *cols = periodic.runs_of(Words(np.frombuffer(b"".join(raw), dtype=np.uint8), offs, False))
    out = [[] for _ in texts]
    for d, run in zip(doc.tolist(), zip(*(c.tolist() for c in cols))):
        out[d].append(run)
    return out


def random_texts(seed, n):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words, alphabet = [], "abcdefghijklmnop"[:rng.randrange(1, 16)]
        for _ in range(rng.randrange(1, 6)):
            cycle = [rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 12, 16, 17, 40]))]
            words += cycle * rng.randrange(1, 9) + cycle[:rng.randrange(len(cycle) + 1)]
            words += [rng.choice(alphabet) for _ in range(rng.randrange(0, 10))] + [f"x{rng.random()}"] * rng.randrange(0, 2)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_every_lag(seed):
    texts = random_texts(seed, 80)
    want = [brute.periodic_runs(t.split()) for t in texts]
    assert found(texts) == want and sum(map(len, want)) > 40


def test_runs_inside_runs():
    inner = ["a"] * 24 + ["b"]
    texts = [" ".join(inner * 3), " ".join(inner * 5 + ["c"]), " ".join((["a", "b"] * 12 + ["c"]) * 4), "a " * 23, "a " * 24, "a b c d e f g h " * 3, "a b c d e f g h i " * 3,
             ("a b c d e f g h i " * 3)[:-3], "", "x"]
    assert found(texts) == [brute.periodic_runs(t.split()) for t in texts]


def test_splitting_is_the_same_from_the_ends():
    """Rounds of all segments at once, and the search from both ends, settle alike."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        key = rng.integers(0, rng.integers(5, 60), 600).astype(np.uint64)
        lo, hi = np.array([0]), np.array([600])
        a, b = periodic.frequency_segments(key, lo, hi), periodic.frequency_segments(key, lo, hi, rounds=0)
        assert [x.tolist() for x in a] == [x.tolist() for x in b]
        for x, z in zip(*a):
            assert (np.unique(key[x:z], return_counts=True)[1] >= 3).all() and z - x >= 24
    chain = [w for i in range(400) for w in (f"w{i}", f"w{i}", f"w{i + 1}")]  # each split makes the next word rare
    assert found([" ".join(chain)]) == [brute.periodic_runs(chain)]


def test_long_texts_take_little_time():
    import time
    began = time.time()
    rng = random.Random(3)
    few = " ".join(rng.choice("abcdefgh") for _ in range(300_000))
    runs = found(["lorem ipsum dolor sit amet " * 100_000, few, "a " * 400_000])
    assert runs[0] == [(0, 500_000, 5)] and runs[2] == [(0, 400_000, 1)]
    assert time.time() - began < 60


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs)
    planted = 0
    for d, text in docs.items():
        w = brute.planted_words(d, text)
        runs = brute.periodic_runs(w)
        planted += bool(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        r = got[d]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best), d
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute.collapsed(w, runs).encode()).hexdigest()
    assert planted


def test_ties_take_the_first_run(spark):
    text = "x " * 30 + "y " + "z " * 30
    r = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(
        periodic.strongest_run(F.col("runs")).alias("b"), "runs", "collapsed_text").first()
    assert (r.b.start, r.b.length, r.b.period) == (0, 30, 1) and len(r.runs) == 2 and r.collapsed_text == "x y z"


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a " * 30), (4, "a " * 30), (4, "a " * 30), (5, "é " * 24 + "\x1c b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "start": F.lit("s"), "n_words": F.lit(2)})
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in periodic.periodic_runs(df).collect())
    assert got == [(0, 30, [(0, 30, 1)], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 30, [(0, 30, 1)], "a"), (4, 30, [(0, 30, 1)], "a"),
                   (5, 26, [(0, 24, 1)], "é \x1c b")]
    assert periodic.periodic_runs(df.limit(0)).count() == 0
