"""Interval join by dyadic nodes against every pair."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackwise.operators import match as MT

POINTS = "user_id int, plt_idx int, line_no long, ts timestamp_ntz, lat double, lon double, altitude double"
LABELS = "user_id int, label_idx int, start_ts timestamp_ntz, end_ts timestamp_ntz, transport_mode string"
T0 = datetime(1969, 12, 20)


def test_nodes_cover_every_bin_once(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.choice([-3, -1, 0, 1, 2, 7, 31, 32, 33, 500, 3652])) for a in (rng.randrange(-900, 20_000) for _ in range(200))]
    got = {}
    for r in MT.dyadic_nodes(spark.createDataFrame(spans, "a long, z long").distinct(), "a", "z").collect():
        got.setdefault((r.a, r.z), []).append((r._level, r._node))
    for a, z in set(spans):
        nodes = got.get((a, z), [])
        bins = sorted(b for level, k in nodes for b in range(k << level, (k + 1) << level))
        assert bins == list(range(a, z + 1))
        assert len(nodes) < 30 and max((sum(lv == level for lv, _ in nodes) for level, _ in nodes), default=0) <= 2


def rows(seed, bin_s=86400):
    rng = random.Random(seed)
    points = [(1 if i % 3 == 0 else rng.randrange(2, 9), i % 2, i, T0 + timedelta(seconds=rng.randrange(4000 * 86400)), 39.9, 116.3, 0.0) for i in range(600)]
    labels = []
    for i in range(60):
        start = T0 + timedelta(seconds=rng.randrange(3900 * 86400))
        labels.append((rng.randrange(1, 9), i, start, start + timedelta(seconds=rng.choice([0, 60, 86400, 30 * 86400, 3650 * 86400, -5])), "bus"))
    points += [(u, 0, 10_000 + i, t, 39.9, 116.3, 0.0) for i, (u, _, s, e, _) in enumerate(labels) for t in (s, e, e + timedelta(microseconds=1))]
    return points, labels


@pytest.mark.parametrize("bin_s, limit", [(86400, 1_000_000), (3600, 1_000_000), (86400, 5)])
def test_every_pair(spark, monkeypatch, bin_s, limit):
    """Both ways: label rows broadcast, and both sides shuffled."""
    points, labels = rows(bin_s)
    monkeypatch.setattr(MT, "BROADCAST_ROWS", limit)
    got = MT.match_points(spark.createDataFrame(points, POINTS), spark.createDataFrame(labels, LABELS), bin_s)
    want = sorted((p[2], lab[1]) for p in points for lab in labels if p[0] == lab[0] and lab[2] <= p[3] <= lab[3])
    assert sorted((r.line_no, r.label_idx) for r in got.select("line_no", "label_idx").collect()) == want and len(want) > 200


def test_long_label_costs_few_rows(spark):
    lab = spark.createDataFrame([(1, 0, datetime(2010, 3, 2), datetime(2020, 4, 19), "bus")], LABELS).select(
        MT.time_bucket("start_ts").alias("a"), MT.time_bucket("end_ts").alias("z"))
    assert MT.dyadic_nodes(lab, "a", "z").count() < 30


def test_no_labels_and_empty_labels(spark):
    points, _ = rows(2)
    df = spark.createDataFrame(points, POINTS)
    assert MT.match_points(df, spark.createDataFrame([], LABELS)).count() == 0
    odd = [(1, 0, None, datetime(2000, 1, 1), "bus"), (1, 1, datetime(1960, 1, 1), None, "bus"), (1, 2, datetime(2000, 1, 1), datetime(1999, 1, 1), "bus"), (None, 3, T0, T0, "bus")]
    assert MT.match_points(df, spark.createDataFrame(odd, LABELS)).count() == 0
    assert MT.match_points(df.where("false"), spark.createDataFrame(odd, LABELS)).where(F.lit(True)).count() == 0
