"""File sources on fixtures written into a fresh temporary folder."""
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trackwise.sources import files as FS

HEADER = "h1\nh2\nh3\nh4\nh5\nh6\n"


def _write(path, text, mode="w", newline=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline=newline) as f:
        f.write(text)


def test_plt_and_labels(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "Data")
    tr = os.path.join(root, "010", "Trajectory")
    _write(os.path.join(tr, "a.plt"), HEADER + "39.9,116.3,0,10,0,2024-01-05,10:00:00\n"
                                              "39.91,116.3,0,10,0,2024-01-05,10:00:10\n")
    _write(os.path.join(tr, "b.plt"), HEADER + "39.9,116.3,0,10,0,2024-01-05,11:00:00\n"
                                              "garbage line\n"
                                              "39.9,116.3,0,10,0,not-a-date,11:00:10\n")
    _write(os.path.join(tr, "c.plt"), "")  # empty file still takes an ordinal
    _write(os.path.join(tr, "d.plt"), (HEADER + "39.9,116.3,0,10,0,2024-01-06,09:00:00\n").replace("\n", "\r\n"),
           newline="")
    _write(os.path.join(root, "011", "Trajectory", "a.plt"), HEADER + "39.9,116.3,0,1,0,2024-01-05,10:00:00\n")
    _write(os.path.join(root, "999", "Trajectory", "a.plt"), HEADER + "39.9,116.3,0,1,0,2024-01-05,10:00:00\n")
    _write(os.path.join(root, "010", "labels.txt"),
           "Start Time\tEnd Time\tTransportation Mode\n"
           "2024/01/05 09:00:00\t2024/01/05 12:00:00\tbus\n"
           "bad\t2024/01/05 12:00:00\twalk\n"
           "2024/01/06 08:00:00\t2024/01/06 10:00:00\tcar\n")
    pts = FS.read_plt(spark, os.path.join(root, "*", "Trajectory", "*.plt"), 10, 11)
    got = sorted((r.user_id, r.plt_idx) for r in pts.collect())
    assert got == [(10, 0), (10, 0), (10, 1), (10, 3), (11, 0)]
    lab = FS.read_labels(spark, os.path.join(root, "*", "labels.txt"), 10, 11)
    assert sorted((r.label_idx, r.transport_mode) for r in lab.collect()) == [(0, "bus"), (2, "car")]
    # the user without labels drops out at the interval join
    from trackwise.operators.match import match_points
    m = match_points(pts, lab).collect()
    assert {r.unique_id for r in m} == {"010_0000_0000", "010_0000_0001", "010_0002_0003"}


def test_geojson_collection(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "stops.geojson")
    _write(p, '{"type":"FeatureCollection","features":['
              '{"type":"Feature","properties":{"highway":"bus_stop"},"geometry":{"type":"Point","coordinates":[116.3,39.9]}},'
              '{"type":"Feature","properties":{"railway":"subway","ref":5},"geometry":{"type":"LineString",'
              '"coordinates":[[116.3,39.9],[116.4,39.95]]}},'
              '{"type":"Feature","properties":{},"geometry":{"type":"Polygon",'
              '"coordinates":[[[116.0,39.0],[117.0,39.0],[117.0,40.0],[116.0,39.0]]]}},'
              '{"type":"Feature","properties":{},"geometry":{"type":"MultiLineString",'
              '"coordinates":[[[116.1,39.1],[116.2,39.2]],[[116.5,39.5],[116.6,39.7]]]}},'
              '{"type":"Feature","properties":{},"geometry":{"type":"MultiPolygon",'
              '"coordinates":[[[[1,1],[2,1],[2,2],[1,1]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}]}')
    g = FS.read_geojson(spark, p, "mixed").orderBy("geom_type").collect()
    assert [r.geom_type for r in g] == ["LineString", "MultiLineString", "MultiPolygon", "Point", "Polygon"]
    assert len(g[1].parts) == 2 and g[1].maxy == 39.7
    assert len(g[2].parts) == 2 and len(g[2].coords) == 8 and g[2].maxx == 6.0
    # a box inside the first ring of the multipolygon meets it; one between the rings does not
    from pyspark.sql import functions as F
    from trackwise.operators.context import intersects_box
    mp = FS.read_geojson(spark, p, "mixed").where("geom_type = 'MultiPolygon'")
    hit = mp.select(intersects_box(F.lit(1.4), F.lit(1.1), F.lit(1.5), F.lit(1.2), parts="parts")).first()[0]
    miss = mp.select(intersects_box(F.lit(3.0), F.lit(3.0), F.lit(4.0), F.lit(4.0), parts="parts")).first()[0]
    assert hit and not miss
    assert g[0].tags["ref"] == "5" and g[0].maxx == 116.4
    missing = FS.read_geojson(spark, os.path.join(tmpdir_path, "nope.geojson"), "x")
    assert missing.count() == 0


def test_graphml_edges(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "roads.graphml")
    _write(p, '<?xml version="1.0"?><graphml><key id="d0" for="node" attr.name="x"/>'
              '<key id="d1" for="node" attr.name="y"/><key id="d2" for="edge" attr.name="geometry"/>'
              '<key id="d3" for="edge" attr.name="length"/><graph>'
              '<node id="1"><data key="d0">116.3</data><data key="d1">39.9</data></node>'
              '<node id="2"><data key="d0">116.4</data><data key="d1">39.95</data></node>'
              '<edge source="1" target="2"><data key="d3">12.5</data></edge>'
              '<edge source="2" target="1"><data key="d2">LINESTRING (116.4 39.95, 116.35 39.99, 116.3 39.9)</data>'
              '</edge></graph></graphml>')
    e = FS.read_graphml_edges(spark, p).collect()
    by = {r.feature_id.split("-")[0]: r for r in e}
    assert len(by["1"].coords) == 2 and by["1"].tags["length"] == "12.5"
    assert len(by["2"].coords) == 3 and by["2"].maxy == 39.99


def test_images_base64(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "img", "trajectory_010_0000_0000_bus.png"), bytes(range(256)) * 2, mode="wb")
    r = FS.read_images(spark, os.path.join(tmpdir_path, "img")).first()
    import base64
    assert r.trajectory_id == "trajectory_010_0000_0000_bus"
    assert r.image_url == "data:image/png;base64," + base64.b64encode(bytes(range(256)) * 2).decode()


def test_a_large_file_is_read_by_many_tasks(spark, tmpdir_path):
    """Splits at any byte: line numbers, ordinals and values as if each file were read whole."""
    import os
    for user, name, n, end in (("001", "a.plt", 3000, "\r\n"), ("001", "b.plt", 0, ""), ("001", "c.plt", 1, "\n"), ("002", "a.plt", 700, "\n")):
        os.makedirs(f"{tmpdir_path}/Data/{user}/Trajectory", exist_ok=True)
        rows = ["h"] * 6 + [f"{39 + i * 1e-5:.5f},116.3,0,{i},0,2008-10-23,{i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}" if i % 10 else ("" if i % 20 else "broken") for i in range(n)]
        with open(f"{tmpdir_path}/Data/{user}/Trajectory/{name}", "w", newline="") as f:
            f.write(end.join(rows) if n else "")
    with open(f"{tmpdir_path}/Data/001/labels.txt", "w") as f:
        f.write("Start\tEnd\tMode\n" + "".join(f"2008/10/23 02:{i // 60:02d}:{i % 60:02d}\t2008/10/23 03:00:00\tbus\n" + ("\n" if i % 7 == 0 else "") for i in range(600)))
    glob = f"{tmpdir_path}/Data/*/Trajectory/*.plt"
    confs = {"spark.sql.files.maxPartitionBytes": "4099", "spark.sql.files.openCostInBytes": "100"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        lines = FS.numbered_lines(spark, glob)
        assert lines.select("npath", "split").distinct().count() > 30 and spark.read.text(glob).rdd.getNumPartitions() > 30
        got = {(r.user_id, r.plt_idx, r.line_no): (r.altitude, r.lat) for r in FS.read_plt(spark, glob).collect()}
        labels = FS.read_labels(spark, f"{tmpdir_path}/Data/*/labels.txt").orderBy("label_idx").collect()
    finally:
        for k in confs:
            spark.conf.unset(k)
    want = {(u, p, 6 + i): (float(i), round(39 + i * 1e-5, 5)) for u, p, n in ((1, 0, 3000), (2, 0, 700)) for i in range(n) if i % 10}
    assert got == want
    assert [(r.label_idx, r.start_ts.minute * 60 + r.start_ts.second) for r in labels] == [(i, i) for i in range(600)]


def test_folders_are_listed_by_few_tasks(spark, tmpdir_path):
    """Every folder was a task of its own."""
    n = 200
    root = Path(tmpdir_path)
    for i in range(n):
        (root / f"u={i:03d}").mkdir()
        (root / f"u={i:03d}" / "a b.txt").write_text("x\n" * (i % 3))
    spark.sparkContext.setJobGroup("listing", "folders")
    lines = FS.numbered_lines(spark, f"{root}/u=*/*.txt")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism < n
    assert lines.count() == sum(i % 3 for i in range(n))
    files = FS.list_files(spark, f"{root}/u=*/*.txt").collect()
    assert len(files) == n and sorted(r.length for r in files) == sorted(2 * (i % 3) for i in range(n)) and all(r.path.endswith("/a b.txt") for r in files)


def test_odd_files_read_by_tasks_equal_sparks_reader(spark, tmpdir_path):
    """Tasks list and read small files; lines, numbers and files are those of Spark's text source."""
    import gzip
    from trackwise.sources import local
    root = Path(tmpdir_path) / "a b+c%20"
    texts = {"u=1/x.txt": b"a\r\nb\rc\n\nd", "u=1/y.txt": b"", "u=1/_z.txt": b"hidden\n", "u=1/.h.txt": b"hidden\n", "u=1/.x.txt.crc": b"no",
             "u=2/bom.txt": b"\xef\xbb\xbfhead\n\xef\xbb\xbfnot head\n", "u=2/bytes.txt": b"caf\xe9\x85\xe2\x80\xa8\x0b\x1c1\n2", "u=2/z.txt.gz": gzip.compress(b"1\n2\n"),
             "u=3/long.txt": b"x" * 4_200_000 + b"\r\n" + b"y\r" * 50_000 + b"z" * 4_100_000, "u=3/deep.txt/in.txt": b"in a folder\n", "v=1/x.txt": b"other\n"}
    for name, body in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(body)
    for glob in (f"{root}/u=*/*.txt", f"{root}/u=[12]/*.txt*", f"{root}/u=[^1]/{{bom,bytes}}.txt", f"{root}/u=?/*", f"file:{root}/u=1/x.txt", f"{root}/u=2"):
        cols = ["npath", "line_no", F.length("line"), F.xxhash64("line")]
        got = sorted(map(tuple, FS.numbered_lines(spark, glob).select(*cols).collect()))
        want = sorted(map(tuple, FS._split_lines(spark, glob).select(*cols).collect()))
        assert got and got == want, glob
    names = lambda d: sorted(os.path.basename(r.path) for r in d.collect())
    assert names(FS.list_files(spark, f"{root}/u=*/*.txt")) == [".h.txt", "_z.txt", "bom.txt", "bytes.txt", "long.txt", "x.txt", "y.txt"]
    assert names(local.find(spark, str(root), folders=True, name="b*.txt")) == ["bom.txt", "bytes.txt"]
    with pytest.raises(AnalysisException):
        FS.numbered_lines(spark, f"{root}/w=*/*.txt")
    assert local.find(spark, "hdfs://host/a/*.txt") is None and local.find(spark, f"{root}/{{u=1/x,u=2/bom}}.txt") is None


def test_neither_files_nor_listings_pass_the_driver(spark, tmpdir_path, monkeypatch):
    """The driver listed every file, and Spark's sink started a process for each."""
    rows = spark.createDataFrame([(u, o, f"{u}-{o}") for u in range(300) for o in (2, 0, 1)], "user long, o long, value string")
    sinks = []
    monkeypatch.setattr(FS, "_statuses", None)
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **k: sinks.append(a))
    monkeypatch.setattr(type(rows.write), "text", lambda *a, **k: sinks.append(a))
    FS.write_lines(rows, ["user"], ["o"], ["h"], tmpdir_path + "/out")
    lines = FS.numbered_lines(spark, tmpdir_path + "/out/user=*/*.txt").collect()
    assert not sinks and sorted((int(r.npath.split("user=")[1].split("/")[0]), r.line_no, r.line) for r in lines) == [
        (u, i, f"{u}-{i - 1}" if i else "h") for u in range(300) for i in range(4)]
    whole = FS.read_images(spark, tmpdir_path + "/out", glob="*.txt", name_pattern=r"user=(\d+)/").collect()
    assert len(whole) == 300 and all(r.length == len(f"h\n{r.trajectory_id}-0\n") * 3 - 4 for r in whole)
    with pytest.raises(FileExistsError):
        FS.write_lines(rows, ["user"], ["o"], [], tmpdir_path + "/out")


def test_written_folders_are_named_as_sparks(spark, tmpdir_path, monkeypatch):
    from trackwise.sources import local
    rows = spark.createDataFrame([("a/b:c", 1, "x"), (None, 2, "y"), ("", 3, None), ("a b+ä", 4, "z"), ("[x]{%}#'\"\\=", 5, "w\nv")], "k string, o long, value string")
    FS.write_lines(rows, ["k"], ["o"], ["h"], tmpdir_path + "/mine")
    monkeypatch.setattr(local, "local_path", lambda *a: None)
    FS.write_lines(rows, ["k"], ["o"], ["h"], tmpdir_path + "/sparks")
    read = lambda d: {p.parent.name: p.read_text() for p in Path(tmpdir_path, d).glob("k=*/*.txt")}
    assert read("mine") == read("sparks") and len(read("mine")) == 4
