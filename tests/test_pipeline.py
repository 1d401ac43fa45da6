"""Match and clean reproduce the fixture counts; cleaning properties; entry()."""
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from trackwise.operators.clean import clean_points, quality_report
from trackwise.operators.match import match_points
from trackwise.operators.sequence import downsample
from trackwise.sources import derived as D

from conftest import SF_SMALL


def test_counts_sf0001(spark):
    ev = D.read_table(spark, SF_SMALL, "events")
    pts, lab = D.derive_points(ev), D.derive_labels(ev)
    m = match_points(pts, lab)
    c = clean_points(m)
    assert pts.count() == 1020
    assert lab.count() == 39
    assert m.count() == 917
    assert m.select("unique_id").distinct().count() == 52
    assert c.count() == 771
    assert c.select("unique_id").distinct().count() == 46


def test_quality_report_never_adds_rows(spark):
    ev = D.read_table(spark, SF_SMALL, "events")
    q = quality_report(match_points(D.derive_points(ev), D.derive_labels(ev))).orderBy("stage_no").collect()
    rows = [r["n_rows"] for r in q]
    assert rows == sorted(rows, reverse=True)


def test_report_and_points_are_of_one_run(spark):
    """The report equals plain counts, and neither points nor report replays the chain."""
    from trackwise.operators import clean as C
    ev = D.read_table(spark, SF_SMALL, "events")
    m = match_points(D.derive_points(ev), D.derive_labels(ev)).cache()
    run = C.clean_run(m)
    ranged = C.lat_in_range(m)
    steps = [m, ranged, C.lon_finite(ranged), C.dedup_first(C.lon_finite(ranged)), C.speed_checked(m),
             C.speed_checked(m).where(f"speed_kmh <= {C.SPEED_LIMIT_KMH}"), run.points]
    want = [(i, n, d.count(), d.select("unique_id").distinct().count()) for i, (n, d) in enumerate(zip(C.STAGES, steps), 1)]
    assert [tuple(r) for r in run.report.orderBy("stage_no").collect()] == want
    for df in run:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and plan.count("Relation") == 2
    assert quality_report(m.where("false")).where("n_rows + n_trajectories > 0").count() == 0
    m.unpersist()


def _pts(spark, rows):
    return spark.createDataFrame(rows, "user_id int, plt_idx int, line_no long, ts timestamp_ntz, lat double, "
                                       "lon double, altitude double")


def test_interval_edges_and_overlap(spark):
    t = datetime(2024, 1, 5)
    pts = _pts(spark, [(1, 0, 0, t, 39.9, 116.3, 0.0), (1, 0, 1, t + timedelta(days=1), 39.9, 116.3, 0.0),
                       (1000, 0, 0, t, 39.9, 116.3, 0.0)])
    lab = spark.createDataFrame(
        [(1, 0, t, t + timedelta(days=1), "bus"), (1, 1, t + timedelta(days=1), t + timedelta(days=3), "car"),
         (1000, 0, t - timedelta(days=30), t + timedelta(days=30), "walk")],
        "user_id int, label_idx int, start_ts timestamp_ntz, end_ts timestamp_ntz, transport_mode string")
    m = match_points(pts, lab).select("unique_id", "line_no").collect()
    keys = sorted((r[0], r[1]) for r in m)
    # both interval ends are inclusive; the overlapping point appears twice; ids >= 1000 are not cut
    assert keys == [("001_0000_0000", 0), ("001_0000_0000", 1), ("001_0001_0000", 1), ("1000_0000_0000", 0)]


def test_speed_limit_inclusive_and_min_points(spark):
    t = datetime(2024, 1, 5)
    # 10 survivors exactly (11 points, the first is dropped) -> kept; 9 survivors -> dropped
    rows = []
    for k, n in (("a", 11), ("b", 10)):
        for i in range(n):
            rows.append((k, 1, i, t + timedelta(seconds=60 * i), 39.9 + 0.0001 * i, 116.3, 0.0, "bus"))
    m = spark.createDataFrame(rows, "unique_id string, user_id int, line_no long, ts timestamp_ntz, lat double, "
                                    "lon double, altitude double, transport_mode string")
    c = clean_points(m)
    assert c.select("unique_id").distinct().collect() == [("a",)]
    assert c.count() == 10


def test_downsample_keeps_ends(spark):
    t = datetime(2024, 1, 5)
    rows = [("x", 1, t + timedelta(seconds=i), 39.9, 116.3, 0.0, "bus") for i in range(50)]
    df = spark.createDataFrame(rows, "unique_id string, user_id int, ts timestamp_ntz, lat double, lon double, "
                                     "altitude double, transport_mode string")
    d = downsample(df, max_points=10).collect()
    ts = sorted(r["ts"] for r in d)
    assert len(d) == 10 and ts[0] == t and ts[-1] == t + timedelta(seconds=49)
    assert sorted(r["ts"] for r in downsample(df, max_points=10).collect()) == ts


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "feature_11" in df.columns


def test_clean_same_for_any_partition_count(spark):
    ev = D.read_table(spark, SF_SMALL, "events")
    outs = []
    for n in (1, 4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        m = match_points(D.derive_points(ev), D.derive_labels(ev))
        outs.append(sorted(clean_points(m).select("unique_id", "ts", "lat").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert outs[0] == outs[1] == outs[2]


def test_first_label_skips_null_mode(spark):
    from trackwise.operators.sequence import first_label
    t = datetime(2024, 1, 5)
    df = spark.createDataFrame([("x", t, None), ("x", t + timedelta(seconds=1), "bus"),
                                ("x", t + timedelta(seconds=2), "car")],
                               "unique_id string, ts timestamp_ntz, transport_mode string")
    assert first_label(df).first().label == "bus"
