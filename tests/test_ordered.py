"""The bucketed ordered helpers equal plain per-key windows, including a hot key."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trackwise.operators.ordered import running_sum, with_previous


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}"
        rows.append((k, t0 + timedelta(seconds=rnd.randint(0, 5 * 86400)), i, rnd.randint(-100, 100)))
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v long")


@pytest.mark.parametrize("bucket_s", [60, 3600, 86400, 10 ** 7])
def test_with_previous_matches_lag(data, bucket_s):
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = data.select("id", F.lag("v").over(w).alias("pv"), F.lag("ts").over(w).alias("pt"))
    got = with_previous(data, ["k"], ["ts", "id"], ["v", "ts"], prefix="p", bucket_s=bucket_s) \
        .select("id", F.col("pv"), F.col("pts").alias("pt"))
    assert sorted(ref.collect()) == sorted(got.collect())


@pytest.mark.parametrize("bucket_s", [60, 86400])
def test_running_sum_matches_window(data, bucket_s):
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = data.select("id", F.sum("v").over(w).alias("s"))
    got = running_sum(data, ["k"], ["ts", "id"], {"s": "v"}, bucket_s=bucket_s).select("id", "s")
    assert sorted(ref.collect()) == sorted(got.collect())


def test_same_for_any_partition_count(spark, data):
    outs = []
    for n in (1, 4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        outs.append(sorted(with_previous(data, ["k"], ["ts", "id"], ["v"]).select("id", "prev_v").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert outs[0] == outs[1] == outs[2]


def test_two_previous_rows_equal_plain_lags(spark):
    """Both previous rows, for any bucket width: buckets of one row, of many, and gaps."""
    import random
    from datetime import datetime, timedelta

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from trackwise.operators.ordered import with_previous
    rng = random.Random(4)
    rows = []
    for key in "abc":
        t = datetime(2024, 1, 1)
        for i in range(200 if key == "a" else 7):
            t += timedelta(seconds=rng.choice([1, 30, 4000, 90_000]))
            rows.append((key, t, i))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int")
    w = Window.partitionBy("k").orderBy("ts")
    want = {tuple(r) for r in df.select("k", "v", F.lag("v").over(w), F.lag("v", 2).over(w)).collect()}
    for width in (1, 3600, 86400, 10**9):
        got = with_previous(df, ["k"], ["ts"], ["v"], prefix="p_", prefix2="q_", bucket_s=width)
        assert {tuple(r) for r in got.select("k", "v", "p_v", "q_v").collect()} == want


def hot_and_sparse(spark, n=30_000):
    """One key with a point a day (a third of all rows), one with many in one hour, and short keys."""
    rnd = random.Random(11)
    t0 = datetime(1985, 1, 1)
    rows = [("sparse", t0 + timedelta(days=i, seconds=rnd.randrange(80_000)), i, i) for i in range(n // 3)]
    rows += [("dense", t0 + timedelta(microseconds=360_000 * i), n + i, i) for i in range(n // 3)]
    rows += [(f"k{i % 500}", t0 + timedelta(seconds=rnd.randrange(10**9)), 2 * n + i, i) for i in range(n // 3)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v long")


def plain_lags(df):
    w = Window.partitionBy("k").orderBy("ts", "id")
    return df.select("id", F.lag("v").over(w).alias("a"), F.lag("v", 2).over(w).alias("b"), F.sum("v").over(w).alias("s"))


def test_counted_buckets_of_sparse_and_dense_keys(spark):
    """However sparse or dense a key is: bounded buckets, and few of them."""
    from trackwise.operators.ordered import FAN_OUT, counted_buckets
    df = hot_and_sparse(spark)
    n, limit = df.count(), 2000
    sizes = counted_buckets(df, ["k"], "ts", limit).groupBy("k", "_bkt", "_cut").agg(
        F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("z")).collect()
    assert max(r.n for r in sizes) <= limit
    cut = [r for r in sizes if r._cut]
    assert {r.k for r in cut} == {"sparse", "dense"} and len(cut) < 0.01 * n
    for k in ("sparse", "dense"):  # buckets follow one another in time
        own = sorted((r._bkt, r.a, r.z) for r in cut if r.k == k)
        assert 4 < len(own) <= FAN_OUT * (n // 3) // limit * 4
        assert all(x[2] <= y[1] for x, y in zip(own, own[1:]))
    assert len([r for r in sizes if not r._cut]) == 500  # a short key is one bucket


@pytest.mark.parametrize("limit", [7, 300, 2000, 10**6])
def test_counted_buckets_equal_plain_windows(spark, monkeypatch, limit):
    from trackwise.operators import ordered
    monkeypatch.setattr(ordered, "BUCKET_ROWS", limit)
    df = hot_and_sparse(spark, 3000 if limit < 300 else 30_000)
    got = with_previous(df, ["k"], ["ts", "id"], ["v"], prefix="p_", prefix2="q_")
    assert got.columns == [*df.columns, "p_v", "q_v"]
    sums = running_sum(df, ["k"], ["ts", "id"], {"s": "v"})
    have = got.select("id", F.col("p_v").alias("a"), F.col("q_v").alias("b")).join(sums.select("id", "s"), "id")
    assert sorted(have.collect(), key=lambda r: r.id) == sorted(plain_lags(df).collect(), key=lambda r: r.id)


def test_buckets_grow_rather_than_their_table(spark, monkeypatch):
    """With more long spans than may be broadcast, buckets hold more rows."""
    from trackwise.operators import ordered
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 5)
    monkeypatch.setattr(ordered, "MOST_SPANS", 10)
    df = hot_and_sparse(spark, 3000)
    sizes = [r["count"] for r in ordered.counted_buckets(df, ["k"], "ts").groupBy("k", "_bkt").count().collect()]
    assert 5 < max(sizes) <= 300


def test_missing_times_and_no_rows(spark):
    df = spark.createDataFrame([("a", None, 1, 1), ("a", datetime(2024, 1, 1), 2, 2), ("b", None, 3, 3)], "k string, ts timestamp_ntz, id long, v long")
    got = {r.id: r.prev_v for r in with_previous(df, ["k"], ["ts", "id"], ["v"]).collect()}
    assert got == {1: None, 2: 1, 3: None}
    assert {r.id: r.s for r in running_sum(df, [], ["ts", "id"], {"s": "v"}).collect()} == {1: 1, 3: 4, 2: 6}
    assert with_previous(df.where("false"), ["k"], ["ts"], ["v"]).count() == 0
