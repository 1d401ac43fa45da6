"""Differencing and byte-balanced shards against plain Python."""

import random
import zlib
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from trackwise.llm import queries
from trackwise.llm.sharding import differencing, shard_by_bytes

SF = "/root/testdata/sf0.001"


def plain_differencing(sizes, parts):
    """Sorted part sizes: the two tuples of largest spread are combined in opposite order."""
    have = [(i, sorted([s] + [0] * (parts - 1))) for i, s in enumerate(sizes)]
    number = len(sizes)
    while len(have) > 1:
        have.sort(key=lambda h: (h[1][0] - h[1][-1], h[0]))
        (_, a), (_, b) = have[:2]
        have = have[2:] + [(number, sorted(x + y for x, y in zip(a, reversed(b))))]
        number += 1
    return have[0][1] if have else []


def loads(sizes, parts, n):
    out = [0] * n
    for s, p in zip(sizes, parts):
        out[p] += s
    return out


@pytest.mark.parametrize("parts", [1, 2, 3, 16])
def test_differencing_equals_plain_tuples(parts):
    rng = random.Random(parts)
    for _ in range(40):
        sizes = [rng.choice([1, 5, rng.randrange(1, 1000)]) for _ in range(rng.randrange(1, 60))]
        got = loads(sizes, differencing(sizes, parts), parts)
        assert sorted(got) == plain_differencing(sizes, parts)
        assert got == sorted(got, reverse=True)


def test_known_partitions():
    assert sorted(loads([8, 7, 6, 5, 4], differencing([8, 7, 6, 5, 4], 2), 2)) == [14, 16]  # the textbook case: a difference of 2
    assert differencing([], 16) == [] and differencing([9], 16) == [0]


def test_near_the_optimum_and_tighter_than_largest_first():
    rng = random.Random(2)
    wins = 0
    for _ in range(60):
        sizes = [rng.randrange(1, 500) for _ in range(9)]
        best = min(max(loads(sizes, p, 3)) for p in product(range(3), repeat=8) for p in [(0, *p)])
        got = max(loads(sizes, differencing(sizes, 3), 3))
        assert got <= best * (4 / 3)
        greedy = [0] * 3
        for s in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += s
        wins += (got <= max(greedy))
    assert wins > 45
    sizes = [rng.randrange(1, 100_000) for _ in range(5000)]
    got = loads(sizes, differencing(sizes, 16), 16)
    assert max(got) - min(got) <= 20


def check(rows, got, shards=16):
    """Whole groups, gapless slots, right sizes; returns the shards' sizes."""
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    slots, homes, sums = defaultdict(list), defaultdict(set), [0] * shards
    texts = defaultdict(set)
    for d, t in rows:
        texts[d, zlib.crc32((t or "").encode())].add(t or "")
    for r in got:
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
        homes[min(texts[r.doc_id, r.text_crc32])].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in homes.values())
    return sums


def test_query_keeps_groups_and_balances(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_sharding(spark, SF).collect()
    sums = check(rows, got)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    weight = defaultdict(int)
    for _, t in rows:
        weight[t or ""] += len((t or "").encode()) + 1
    least = max(max(weight.values()), sum(sums) / 16)
    assert max(sums) <= 1.02 * least


def test_hot_group_and_bundles(spark):
    """A group with a third of all rows, few bundles, large groups beside them."""
    rng = random.Random(4)
    rows = [(i, "hot text " * 4) for i in range(700)] + [(1000 + i, "x" * rng.randrange(1, 90)) for i in range(1400)]
    rows += [(5000 + i, f"{i}" * 1200) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for bundles, share in ((1 << 14, 1 << 12), (64, 100)):
        got = shard_by_bytes(df, bundles=bundles, large_share=share).collect()
        sums = sorted(check(rows, got))
        hot = 700 * 37
        assert sums[-1] < 1.05 * max(hot, sum(sums) / 16)
        assert sums[-2] - sums[0] < 0.1 * sums[0] + 1300


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a"), (3, "a"), (3, "a"), (3, "b"), (4, "é\U0001F600"), (5, "lorem " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(c) for c in ("size", "group", "bundle", "shard", "slot", "salt", "own", "shared", "n", "before")})
    check(rows, shard_by_bytes(df).collect())
    assert shard_by_bytes(df.limit(0)).count() == 0
