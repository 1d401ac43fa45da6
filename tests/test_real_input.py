"""Input that synthetic tables do not have: odd paths, missing values, holes,
multi-part shapes, long trips, rare classes, failing providers."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from trackwise.operators import clean as C
from trackwise.operators import context as X
from trackwise.operators import describe as DS
from trackwise.operators import embed as E
from trackwise.operators import sequence as S
from trackwise.operators import splits as SP
from trackwise.sources import files as FS
from trackwise.streaming import resume as R

HEADER = "\r\n".join(["h"] * 6) + "\r\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


@pytest.mark.parametrize("folder", ["plain", "Raw Logs 1.3", "a%20b", "c+d e", "é ü"])
def test_point_and_label_files_under_any_folder(spark, tmpdir_path, folder):
    root = f"{tmpdir_path}/{folder}/Data"
    write(f"{root}/007/Trajectory/a.plt", HEADER + "39.9,116.3,0,10,0,2008-10-23,02:53:04\r\n39.8,116.4,0,10,0,2008-10-23,02:53:10\r\n")
    write(f"{root}/007/Trajectory/b.plt", HEADER + "39.7,116.3,0,10,0,2008-10-24,02:53:04\r\n")
    write(f"{root}/007/labels.txt", "Start Time\tEnd Time\tTransportation Mode\n2008/10/23 02:00:00\t2008/10/23 03:00:00\tbus\n2008/10/24 02:00:00\t2008/10/24 03:00:00\t\n")
    got = FS.read_plt(spark, f"{root}/*/Trajectory/*.plt").collect()
    assert sorted((r.user_id, r.plt_idx, r.lat) for r in got) == [(7, 0, 39.8), (7, 0, 39.9), (7, 1, 39.7)]
    labels = FS.read_labels(spark, f"{root}/*/labels.txt").orderBy("label_idx").collect()
    assert [r.transport_mode for r in labels] == ["bus", None]


def matched(spark, rows):
    df = spark.createDataFrame(rows, "unique_id string, user_id int, line_no long, s long, lat double, lon double")
    return df.select("unique_id", "user_id", "line_no", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "lat", "lon",
                     F.lit(0.0).alias("altitude"), F.lit("walk").alias("transport_mode"))


@pytest.mark.parametrize("bad", [None, math.nan, math.inf])
def test_points_without_longitude_are_dropped_and_counted(spark, bad):
    rows = [("a", 1, i, 1_700_000_000 + 5 * i, 39.9 + i * 1e-5, bad if i == 15 else 116.3) for i in range(30)]
    m = matched(spark, rows)
    assert C.clean_points(m).count() == 28  # the first point has no previous one
    assert [(r.stage, r.n_rows) for r in C.quality_report(m).orderBy("stage_no").collect()] == [
        ("matched", 30), ("lat_in_range", 30), ("lon_finite", 29), ("deduplicated", 29), ("with_previous", 28), ("speed_ok", 28), ("clean", 28)]


def shape(spark, geom_type, parts):
    pts = [[{"lon": float(x), "lat": float(y)} for x, y in p] for p in parts]
    df = spark.createDataFrame([("f", "l", geom_type, {}, pts)], "feature_id string, layer string, geom_type string, tags map<string,string>, "
                               "parts array<array<struct<lon:double,lat:double>>>").withColumn("coords", F.flatten("parts"))
    x, y = F.transform("coords", lambda p: p["lon"]), F.transform("coords", lambda p: p["lat"])
    return df.withColumns({"minx": F.array_min(x), "miny": F.array_min(y), "maxx": F.array_max(x), "maxy": F.array_max(y)})


def square(a, z):
    return [(a, a), (z, a), (z, z), (a, z), (a, a)]


@pytest.mark.parametrize("geom_type, parts, box, meets", [
    ("Polygon", [square(0, 10), square(3, 7)], (4, 4, 6, 6), False),          # inside the hole
    ("Polygon", [square(0, 10), square(3, 7)], (1, 1, 2, 2), True),
    ("Polygon", [square(0, 10), square(3, 7)], (2, 2, 4, 4), True),           # across the hole's edge
    ("MultiPolygon", [square(0, 2), square(5, 9), square(6, 8)], (6.5, 6.5, 7.5, 7.5), False),
    ("MultiPolygon", [square(0, 2), square(5, 9), square(6, 8)], (5.2, 5.2, 5.8, 5.8), True),
    ("MultiLineString", [[(0, 0), (1, 0)], [(9, 0), (10, 0)]], (4, -1, 6, 1), False),   # in the gap
    ("MultiLineString", [[(0, 0), (1, 0)], [(9, 0), (10, 0)]], (9.5, -1, 9.6, 1), True),
])
def test_holes_and_parts(spark, geom_type, parts, box, meets):
    f = shape(spark, geom_type, parts)
    assert X.box_filter(f, *map(float, box)).count() == meets
    bounds = spark.createDataFrame([("t", *map(float, box))], "unique_id string, bx0 double, by0 double, bx1 double, by1 double")
    assert X.spatial_join(bounds, f).count() == meets
    place = spark.createDataFrame([(box[0] * 1.0, box[1] * 1.0, box[0] + 0.01, box[1] + 0.01), (box[2] - 0.01, box[3] - 0.01, box[2] * 1.0, box[3] * 1.0)],
                                  "minx double, miny double, maxx double, maxy double")
    assert X.place_or_box(f, place).count() == meets  # several boundary rows: their common extent


def test_distinct_geometry_looks_at_parts(spark):
    a = shape(spark, "MultiLineString", [[(0, 0), (1, 0)], [(9, 0), (10, 0)]])
    b = shape(spark, "MultiLineString", [[(0, 0), (1, 0), (9, 0), (10, 0)]])
    assert X.distinct_geometries(a.unionByName(b).unionByName(a), order=("feature_id",)).count() == 2


def long_trip(spark, n):
    rows = [("long", 1, i, 1_700_000_000 + 5 * i, 39.9 + i * 1e-5, 116.3) for i in range(n)] + [
        ("short", 2, i, 1_700_000_000 + 5 * i, 39.9 + i * 1e-5, 116.3) for i in range(20)]
    return matched(spark, rows)


def test_long_trips_are_described(spark):
    texts, rejects = DS.describe(long_trip(spark, 5000))
    assert {r.unique_id for r in texts.collect()} == {"long", "short"} and rejects.count() == 0
    _, rejects = DS.describe(long_trip(spark, 5000), provider=lambda p: p, max_chars=60_000)
    assert [r.unique_id for r in rejects.collect()] == ["long"]


@pytest.mark.parametrize("k", [12, 2000, 4999])
def test_downsample_ranks_no_whole_trip(spark, k):
    df = long_trip(spark, 5000)
    got = S.downsample(df, max_points=k)
    assert {r.unique_id: r.n for r in got.groupBy("unique_id").agg(F.count("*").alias("n")).collect()} == {"long": k, "short": min(20, k) if k < 20 else 20}
    h = F.md5(F.concat_ws("|", "unique_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("3407")))
    rows = df.where("unique_id = 'long'").select("ts", h.alias("h")).orderBy("ts").collect()
    want = {rows[0].ts, rows[-1].ts} | {r.ts for r in sorted(rows[1:-1], key=lambda r: (r.h, r.ts))[:k - 2]}
    assert {r.ts for r in got.where("unique_id = 'long'").collect()} == want


def labelled(spark, sizes):
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "key string, label string")


def test_three_way_sizes_and_rare_classes(spark):
    got = SP.three_way_split(labelled(spark, {f"c{i}": 50 for i in range(10)}), "label", "key").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"test": 75, "val": 75, "train": 350}
    rows = SP.three_way_split(labelled(spark, {"a": 60, "rare": 2, "b": 38}), "label", "key").collect()
    assert sum(r.label == "rare" and r.split == "train" for r in rows) >= 1 and len(rows) == 100
    assert sum(r.split == "test" for r in rows) == 15
    alone = SP.three_way_split(labelled(spark, {"a": 60, "one": 1}), "label", "key").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in alone} == {"test": 10, "val": 9, "train": 42}


@pytest.mark.parametrize("digits", [1, 3, 5])
def test_split_does_not_depend_on_the_slices(spark, digits):
    df = labelled(spark, {"a": 300, "b": 5})
    want = {(r.key, r._rank, r._n) for r in SP.ranked(df, "key", 7, ["label"]).collect()}
    assert {(r.key, r._rank, r._n) for r in SP.ranked(df, "key", 7, ["label"], prefix_digits=digits).collect()} == want
    assert sorted(r for _, r, n in want if n == 5) == list(range(5))


def test_stratified_sizes_deal_the_whole_number(spark):
    rows = SP.stratified_split(labelled(spark, {"a": 11, "b": 12, "c": 13, "d": 1}), "label", "key").collect()
    assert sum(r.split == "test" for r in rows) == 8 and all(r.split == "train" for r in rows if r.label == "d")


GRAPH = """<graphml><key id="{x}" for="node" attr.name="x"/><key id="{y}" for="node" attr.name="y"/><key id="{h}" for="edge" attr.name="highway"/>
<graph>
<node id="1"><data key="{x}">{a}</data><data key="{y}">1</data></node><node id="2"><data key="{x}">{b}</data><data key="{y}">2</data></node>
<edge source="1" target="2" id="0"><data key="{h}">{tag}</data></edge><edge source="1" target="2" id="0"><data key="{h}">{tag}</data></edge>
</graph></graphml>"""


def test_graphs_keep_their_own_keys_and_stable_ids(spark, tmpdir_path):
    write(f"{tmpdir_path}/g 1/one.graphml", GRAPH.format(x="d0", y="d1", h="d2", a=10, b=11, tag="service"))
    write(f"{tmpdir_path}/g 1/two.graphml", GRAPH.format(x="d1", y="d0", h="d7", a=20, b=21, tag="primary"))
    read = lambda: FS.read_graphml_edges(spark, f"{tmpdir_path}/g 1/*.graphml").collect()
    got = read()
    assert sorted((r.minx, r.maxx, r.tags["highway"]) for r in got) == [(10, 11, "service")] * 2 + [(20, 21, "primary")] * 2
    ids = {r.feature_id for r in got}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert len(ids) == 4 and {r.feature_id for r in read()} == ids
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_only_a_missing_layer_or_output_is_empty(spark, tmpdir_path):
    assert FS.read_geojson(spark, f"{tmpdir_path}/none.json", "l").count() == 0
    out = f"{tmpdir_path}/out"
    assert R.existing_keys(spark, out, "id") is None
    spark.range(3).write.parquet(out)
    assert R.existing_keys(spark, out, "id").count() == 3
    with pytest.raises(Exception):
        R.existing_keys(spark, out, "wrong")


def test_joint_vectors_need_text(spark):
    raster = spark.createDataFrame([("a", "l", 1, 1, 2), ("b", "l", 1, 1, 2)], "k string, layer string, cx int, cy int, n long")
    texts = spark.createDataFrame([("a", "by bus")], "k string, t string")
    assert [r.k for r in E.embed_multimodal(raster, texts, "k", "t", 8).collect()] == ["a"]


def test_failing_rows_become_rejects(spark):
    def model(texts):
        if any("bad" in t for t in texts):
            raise ValueError("refused")
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([("a", "good"), ("b", "bad one"), ("c", "fine")], "trajectory_id string, text string").coalesce(1)
    out = E.batched_provider(model, "trajectory_id", "text", "trajectory_id string, embedding array<float>, reason string")(df)
    assert {r.trajectory_id for r in E.accepted(out).collect()} == {"a", "c"}
    assert [(r.trajectory_id, r.reason) for r in E.rejected(out).collect()] == [("b", "ValueError: refused")]
    pending = R.pending(df, E.accepted(out).select("trajectory_id"), "trajectory_id")
    assert [r.trajectory_id for r in pending.collect()] == ["b"]
