"""Resume, splits, spatial join vs brute force, metrics."""
import os
import uuid

from pyspark.sql import functions as F

from trackwise.operators import context as X
from trackwise.operators import metrics as M
from trackwise.operators import splits as SP
from trackwise.streaming import resume as R


def test_append_resume_twice_adds_nothing(spark, tmpdir_path):
    todo = spark.range(100).withColumnRenamed("id", "k")
    out = os.path.join(tmpdir_path, "out")
    R.append_new(todo.where("k < 30"), "k", out, lambda d: d.withColumn("v", F.lit(1)))
    a = R.append_new(todo, "k", out, lambda d: d.withColumn("v", F.lit(2))).count()
    b = R.append_new(todo, "k", out, lambda d: d.withColumn("v", F.lit(3))).count()
    assert a == b == 100


def test_splits_disjoint_cover_repeatable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("key"),
                                  F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, "b")
                                  .otherwise("c").alias("label"))
    s1 = SP.three_way_split(df, "label", "key").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    s2 = SP.three_way_split(df, "label", "key").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(s1) == sorted(s2) and len(s1) == 1000 and len({r.key for r in s1}) == 1000
    # a class with a single member falls back to one unstratified split
    one = df.unionByName(spark.createDataFrame([("x", "solo")], "key string, label string"))
    assert SP.three_way_split(one, "label", "key").count() == 1001


def test_spatial_join_equals_brute_force(spark):
    import random
    rnd = random.Random(3)
    feats, raw = [], []
    for i in range(300):
        x, y = rnd.uniform(116, 117), rnd.uniform(39, 40)
        if i % 2:
            coords = [(x, y)]
            gt = "Point"
        else:
            coords = [(x, y), (x + rnd.uniform(-0.2, 0.2), y + rnd.uniform(-0.2, 0.2))]
            gt = "LineString"
        feats.append((f"f{i}", "l", gt, {}, [{"lon": a, "lat": b} for a, b in coords]))
        raw.append((f"f{i}", gt, coords))
    f = spark.createDataFrame(feats, "feature_id string, layer string, geom_type string, tags map<string,string>, "
                                     "coords array<struct<lon:double,lat:double>>")
    f = f.withColumns({"minx": F.array_min(F.transform("coords", lambda p: p["lon"])),
                       "miny": F.array_min(F.transform("coords", lambda p: p["lat"])),
                       "maxx": F.array_max(F.transform("coords", lambda p: p["lon"])),
                       "maxy": F.array_max(F.transform("coords", lambda p: p["lat"]))})
    boxes = []
    for j in range(40):
        x, y, s = rnd.uniform(116, 117), rnd.uniform(39, 40), rnd.choice([0.001, 0.05, 0.3, 2.0])
        boxes.append((f"t{j}", x, y, x + s, y + s * 0.7))
    b = spark.createDataFrame(boxes, "unique_id string, bx0 double, by0 double, bx1 double, by1 double")
    got = {(r.unique_id, r.feature_id) for r in X.spatial_join(b, f).collect()}

    def seg_hits(a, c, box):
        x0, y0, x1, y1 = box
        if max(a[0], c[0]) < x0 or min(a[0], c[0]) > x1 or max(a[1], c[1]) < y0 or min(a[1], c[1]) > y1:
            return False
        s = [(c[0] - a[0]) * (py - a[1]) - (c[1] - a[1]) * (px - a[0])
             for px, py in ((x0, y0), (x1, y0), (x0, y1), (x1, y1))]
        return not (all(v > 0 for v in s) or all(v < 0 for v in s))

    want = set()
    for uid, x0, y0, x1, y1 in boxes:
        for fid, gt, coords in raw:
            if gt == "Point":
                hit = x0 <= coords[0][0] <= x1 and y0 <= coords[0][1] <= y1
            else:
                hit = seg_hits(coords[0], coords[1], (x0, y0, x1, y1))
            if hit:
                want.add((uid, fid))
    assert got == want


def test_class_report_handles_absent_class(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "actual string, predicted string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "label string, index int")
    r = {x.name: x for x in M.class_report(pred, vocab=vocab).collect()}
    assert r["c"].precision == 0 and r["c"].support == 0
    assert abs(r["accuracy"].precision - 2 / 3) < 1e-12
    assert abs(r["a"].recall - 0.5) < 1e-12 and r["a"].precision == 1.0
