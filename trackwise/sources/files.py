"""File sources and sinks: GPS point files, label files, GeoJSON, GraphML,
binary (images), CSV and Parquet.

Every reader takes a path or glob and returns a DataFrame with an explicit
schema; nothing is inferred. Point and label files are read in splits: small files
share a task (``local``), a large file is cut at line ends, and lines get their numbers from
counts per split (``numbered_lines``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.text import base64_url
from ..session import materialize, packed_listing
from . import local
from .collection import collection_features

# Fixed values of the GPS point file format: 6 header lines, 7 columns.
PLT_HEADER_LINES = 6
PLT_SCHEMA = "lat double, lon double, unused string, altitude double, days double, date string, time string"
PLT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Fixed values of the label file format: 1 header line, tab separated.
LABEL_HEADER_LINES = 1
LABEL_TS_FORMAT = "yyyy/MM/dd HH:mm:ss"
# Folder layout: Data/<user, 3 digits>/Trajectory/*.plt and Data/<user>/labels.txt
PLT_USER_PATTERN = r"/(\d+)/Trajectory/[^/]+\.plt$"
LABEL_USER_PATTERN = r"/(\d+)/labels\.txt$"


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """``path, length`` of every file matching ``glob``, empty files included.

    File scans skip zero-length files, but ordinals must count them, so the
    listing comes from the file system (metadata only, like any file index): from
    tasks where they reach it (``local``), else through the driver.
    """
    found = local.find(spark, glob)
    if found is not None:
        return found.select(F.concat(F.lit("file:"), "path").alias("path"), "length")
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(glob)
    fs = p.getFileSystem(conf)
    st = fs.globStatus(p)
    rows = _statuses(jvm, st) if st else []
    return spark.createDataFrame(rows, "path string, length long")


def _statuses(jvm, st) -> list[tuple[str, int]]:
    """Path and length of the files among file statuses, read as one text: a call for
    each field of each file would take the driver longer than the listing."""
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(st)
    found = re.findall(r"\w+\{path=(.*?); isDirectory=(true|false)(?:; length=(\d+);)?", text, re.S)
    if len(found) == len(st) and all(is_dir == "true" or length for _, is_dir, length in found):
        return [(path, int(length)) for path, is_dir, length in found if is_dir == "false"]
    return [(s.getPath().toString(), int(s.getLen())) for s in st if s.isFile()]


def _norm_path(c: Column) -> Column:
    """Paths from listings look like ``file:/x``: drop the scheme."""
    return F.regexp_replace(c, r"^[a-z0-9]+:(//)?", "")


def _scan_path(c: Column) -> Column:
    """Paths from scans are URI-encoded as well (a blank is %20; a plus stays)."""
    return _norm_path(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))))


def numbered_lines(spark: SparkSession, glob: str, files: DataFrame | None = None) -> DataFrame:
    """``npath, split, line_no, line`` of every line of the text files, numbered from 0 in each file.

    Small files are read whole by tasks that share them out (``local``). Large and compressed ones,
    and all of other stores, go through Spark's text source, which cuts large ones at line ends. Their lines are
    written once with their split's first byte and an id that counts up within the task;
    a line's number is its distance from the first id of its split plus the lines of the
    file's splits before, so no file is one task. Lines end with LF, CR LF or CR.

    ``files`` (``npath, length``, written before, and what else goes along with their lines) are
    those of the glob to read; by default all.
    """
    own = [c for c in files.columns if c not in ("npath", "length")] if files is not None else []
    if files is None:
        found = local.find(spark, glob, folders=True)
        files = None if found is None else materialize(found.select(F.col("path").alias("npath"), "length"), "files")
    if files is None or local.local_path(spark, glob) is None:
        lines = _split_lines(spark, glob)
        return lines if files is None else lines.join(files.drop("length"), "npath")
    name = F.element_at(F.split("npath", "/"), -1)
    files = files.where((F.col("length") > 0) & ~name.startswith(".") & ~name.endswith("._COPYING_") & (~name.startswith("_") | name.contains("=")))
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    small = (F.col("length") <= most) & ~F.lower(name).rlike("(" + "|".join(re.escape(c) for c in local.COMPRESSED) + ")$")
    large = [r.npath for r in files.where(~small).select("npath").collect()]  # a path for each of them
    out = local.read_lines(files.where(small)).withColumn("split", F.lit(0).cast("long"))
    cols = ["npath", "split", "line_no", "line", *own]
    if large:
        more = _split_lines(spark, [re.sub(r"([*?\[\]{}\\])", r"\\\1", p) for p in large])
        out = out.select(*cols).unionByName(more.join(files.drop("length"), "npath").select(*cols))
    return out.select(*cols)


def _split_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``npath, split, line_no, line`` by Spark's text source (``numbered_lines``)."""
    with packed_listing(spark):
        raw = spark.read.text(paths)
    lines = materialize(raw.select(
        _scan_path(F.col("_metadata.file_path")).alias("npath"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line")), "lines")
    before = Window.partitionBy("npath").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("npath", "split").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")).select(
        "npath", "split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(splits, ["npath", "split"]).select(
        "npath", "split", (F.col("_before") + F.col("_at") - F.col("_first")).alias("line_no"), "line")


def read_plt(spark: SparkSession, glob: str, user_min: int | None = None, user_max: int | None = None,
             user_pattern: str = PLT_USER_PATTERN) -> DataFrame:
    """PLT_SCAN + USER_SCAN + PLT_ORDINAL + TS_PARSE + DROP_NULL.

    Output ``user_id, plt_idx, line_no, ts, lat, lon, altitude``. ``plt_idx`` is
    the file's rank among its user's files sorted by path, counting empty or
    unreadable files; users are kept in ``[user_min, user_max]`` (inclusive). Only
    their files are read, and their numbers go along with the lines.
    """
    files = list_files(spark, glob).select(_norm_path(F.col("path")).alias("npath"), "length")
    files = files.withColumn("user_id", F.regexp_extract("npath", user_pattern, 1).cast("int"))
    if user_min is not None:
        files = files.where(F.col("user_id") >= user_min)
    if user_max is not None:
        files = files.where(F.col("user_id") <= user_max)
    files = materialize(files.withColumn(
        "plt_idx", F.row_number().over(Window.partitionBy("user_id").orderBy("npath")) - 1), "point_files")

    lines = numbered_lines(spark, glob, files).where((F.col("line_no") >= PLT_HEADER_LINES) & (F.trim("line") != ""))
    rec = lines.select("user_id", "plt_idx", "line_no", F.from_csv("line", PLT_SCHEMA).alias("r"))
    ts = F.try_to_timestamp(F.concat_ws(" ", F.trim("r.date"), F.trim("r.time")),
                            F.lit(PLT_TS_FORMAT)).cast("timestamp_ntz")
    pts = rec.select("user_id", "plt_idx", "line_no", ts.alias("ts"), F.col("r.lat").alias("lat"),
                     F.col("r.lon").alias("lon"), F.col("r.altitude").alias("altitude"))
    pts = pts.dropna(subset=["ts"])
    return pts.select("user_id", F.col("plt_idx").cast("int").alias("plt_idx"),
                      F.col("line_no").cast("bigint").alias("line_no"), "ts", "lat", "lon", "altitude")


def read_labels(spark: SparkSession, glob: str, user_min: int | None = None, user_max: int | None = None,
                user_pattern: str = LABEL_USER_PATTERN) -> DataFrame:
    """LABEL_SCAN: ``user_id, label_idx, start_ts, end_ts, transport_mode``.

    ``label_idx`` is the row's position among the file's data lines, counted
    before unparsable rows are dropped (so drops leave gaps).
    """
    lines = numbered_lines(spark, glob).withColumn("user_id", F.regexp_extract("npath", user_pattern, 1).cast("int"))
    if user_min is not None:
        lines = lines.where(F.col("user_id") >= user_min)
    if user_max is not None:
        lines = lines.where(F.col("user_id") <= user_max)
    lines = materialize(lines.where((F.col("line_no") >= LABEL_HEADER_LINES) & (F.trim("line") != "")), "label_lines")
    # position among the data lines: within the split, plus the data lines of the splits before
    before = Window.partitionBy("npath").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("npath", "split").agg(F.count(F.lit(1)).alias("_n")).select(
        "npath", "split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    lines = lines.withColumn("_in", F.row_number().over(Window.partitionBy("npath", "split").orderBy("line_no")) - 1)
    lines = lines.join(splits, ["npath", "split"]).withColumn("label_idx", F.col("_before") + F.col("_in"))
    parts = F.split("line", "\t")
    lab = lines.select(
        "user_id", F.col("label_idx").cast("int").alias("label_idx"),
        F.try_to_timestamp(F.trim(F.get(parts, 0)), F.lit(LABEL_TS_FORMAT)).cast("timestamp_ntz").alias("start_ts"),
        F.try_to_timestamp(F.trim(F.get(parts, 1)), F.lit(LABEL_TS_FORMAT)).cast("timestamp_ntz").alias("end_ts"),
        F.nullif(F.trim(F.get(parts, 2)), F.lit("")).alias("transport_mode"))
    return lab.dropna(subset=["start_ts", "end_ts"])


# ---- writers of the same formats (used to build fixtures from tables) ------------------

def write_lines(body: DataFrame, keys: list[str], order: list[str], header: list[str], root: str) -> None:
    """A text file for each value of the keys, in folders ``key=value``: the header, then ``value`` of its
    rows in order (``order``: long columns). Tasks write them where they reach the store by its path (``local``),
    else Spark's text sink does."""
    body = body.withColumns({k: F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys})  # one folder for both
    path = local.local_path(body.sparkSession, root)
    if path is not None:
        local.write_lines(body, keys, order, header, path)
        return
    rows = body.withColumn("_h", F.lit(0))
    if header:
        head = body.select(*keys).distinct().select(*keys, F.posexplode(F.array(*[F.lit(h) for h in header])).alias("_h", "value")).withColumn(
            "_h", F.col("_h") - len(header))
        rows = rows.unionByName(head, allowMissingColumns=True)
    (rows.repartition(*keys).sortWithinPartitions(*keys, "_h", *order).select(*keys, "value")
         .write.partitionBy(*keys).text(root))


def write_plt(points: DataFrame, root: str) -> None:
    """Write points as one text file per (user, file index) under
    ``root/<user>/Trajectory/<idx>.plt`` style partition folders."""
    hdr = ["GPS trajectory", "WGS 84", "Altitude is in Feet", "Reserved 3", "0,2,255,My Track,0,0,2,8421376", "0"]
    body = points.select(
        F.format_string("%03d", "user_id").alias("u"), F.format_string("%04d", "plt_idx").alias("f"),
        F.col("line_no").cast("bigint").alias("_o"),
        F.concat_ws(",", F.format_string("%.6f", "lat"), F.format_string("%.6f", "lon"), F.lit("0"),
                    F.format_string("%.1f", "altitude"), F.lit("0"),
                    F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")).alias("value"))
    write_lines(body, ["u", "f"], ["_o"], hdr, root)


def write_labels(labels: DataFrame, root: str) -> None:
    """Write label intervals as one tab-separated file per user with a header."""
    body = labels.select(
        F.format_string("%03d", "user_id").alias("u"), F.col("label_idx").cast("bigint").alias("_o"),
        F.concat_ws("\t", F.date_format("start_ts", LABEL_TS_FORMAT), F.date_format("end_ts", LABEL_TS_FORMAT),
                    "transport_mode").alias("value"))
    write_lines(body, ["u"], ["_o"], ["Start Time\tEnd Time\tTransportation Mode"], root)


# ---- GeoJSON -----------------------------------------------------------------------------

_GEOM = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
_FEATURE = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", _GEOM)])


def _pt(a: Column) -> Column:
    return F.struct(F.get(a, 0).alias("lon"), F.get(a, 1).alias("lat"))


def _parts(gtype: Column, coords: Column) -> Column:
    """Vertex lists of any GeoJSON geometry as ``array<array<struct<lon,lat>>>``."""
    d1 = F.from_json(coords, "array<double>")
    d2 = F.from_json(coords, "array<array<double>>")
    d3 = F.from_json(coords, "array<array<array<double>>>")
    d4 = F.from_json(coords, "array<array<array<array<double>>>>")
    return (F.when(gtype == "Point", F.array(F.array(_pt(d1))))
             .when(gtype.isin("LineString", "MultiPoint"), F.array(F.transform(d2, _pt)))
             .when(gtype.isin("Polygon", "MultiLineString"),
                   F.transform(d3, lambda r: F.transform(r, _pt)))
             .when(gtype == "MultiPolygon",
                   F.flatten(F.transform(d4, lambda poly: F.transform(poly, lambda r: F.transform(r, _pt))))))


def _features_to_rows(f: DataFrame, layer: str | Column, id_col: Column) -> DataFrame:
    g = f.select(id_col.alias("feature_id"), (F.lit(layer) if isinstance(layer, str) else layer).alias("layer"),
                 F.col("feature.geometry.type").alias("geom_type"),
                 F.coalesce(F.col("feature.properties"), F.create_map().cast("map<string,string>")).alias("tags"),
                 _parts(F.col("feature.geometry.type"), F.col("feature.geometry.coordinates")).alias("parts"))
    g = g.where(F.col("parts").isNotNull()).withColumn("coords", F.flatten("parts"))
    return g.withColumns({
        "minx": F.array_min(F.transform("coords", lambda p: p["lon"])),
        "miny": F.array_min(F.transform("coords", lambda p: p["lat"])),
        "maxx": F.array_max(F.transform("coords", lambda p: p["lon"])),
        "maxy": F.array_max(F.transform("coords", lambda p: p["lat"]))})


def read_geojson(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """GEOJSON_IO (read) of FeatureCollection files: one row per feature.

    Large files are read in splits (``collection.collection_features``); a
    missing file means the layer is absent (empty result), not an error.
    """
    try:
        f = collection_features(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _layer_schema())
    f = f.select("file", "i", F.from_json("text", _FEATURE).alias("feature"))
    return _features_to_rows(f, layer, F.coalesce(F.col("feature.id"), F.concat_ws("#", "file", F.col("i").cast("string"))))


def read_geojson_seq(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """GEOJSON_IO (read) of line-delimited Features (one per line; splittable)."""
    raw = spark.read.schema(_FEATURE.add("layer", T.StringType())).json(path)
    f = raw.select(F.struct(*[F.col(c) for c in ("type", "id", "properties", "geometry")]).alias("feature"),
                   F.col("layer").alias("_layer"), F.col("id").alias("_id"))
    lay = F.lit(layer) if layer else F.col("_layer")
    return _features_to_rows(f, lay, F.col("_id"))


def _layer_schema() -> str:
    return ("feature_id string, layer string, geom_type string, tags map<string,string>, "
            "parts array<array<struct<lon:double,lat:double>>>, coords array<struct<lon:double,lat:double>>, "
            "minx double, miny double, maxx double, maxy double")


def _feature_json(features: DataFrame) -> Column:
    parts = F.col("parts") if "parts" in features.columns else F.array(F.col("coords"))
    xy = lambda r: F.transform(r, lambda p: F.array(p["lon"], p["lat"]))
    gt = F.col("geom_type")
    coords = (F.when(gt == "Point", F.to_json(F.array(F.get(parts, 0)[0]["lon"], F.get(parts, 0)[0]["lat"])))
               .when(gt.isin("LineString", "MultiPoint"), F.to_json(xy(F.get(parts, 0))))
               .otherwise(F.to_json(F.transform(parts, xy))))
    feat = F.struct(F.lit("Feature").alias("type"), F.col("feature_id").alias("id"), F.col("layer").alias("layer"),
                    F.col("tags").alias("properties"),
                    F.struct(gt.alias("type"), F.parse_json(coords).alias("coordinates")).alias("geometry"))
    return F.to_json(feat)


def write_geojson_seq(features: DataFrame, path: str) -> None:
    """GEOJSON_IO (write): one GeoJSON Feature per line (RFC 8142 style)."""
    features.select(_feature_json(features).alias("value")).write.mode("overwrite").text(path)


def write_geojson(features: DataFrame, path: str, n_files: int = 8) -> None:
    """GEOJSON_IO (write): FeatureCollections, one complete document per file
    (``n_files`` hash buckets; folders ``b=<bucket>``)."""
    b = F.abs(F.hash("feature_id")) % n_files
    rows = features.select(b.alias("b"), F.lit(1).alias("sec"), "feature_id", F.concat(
        _feature_json(features), F.lit(",")).alias("value"))
    buckets = rows.select("b").distinct()
    # the list ends with a null entry, so that every feature is followed by a comma
    for sec, text in ((0, '{"type":"FeatureCollection","features":['), (2, "null]}")):
        rows = rows.unionByName(buckets.select("b", F.lit(sec).alias("sec"), F.lit("").alias("feature_id"), F.lit(text).alias("value")))
    rows.repartition("b").sortWithinPartitions("b", "sec", "feature_id").drop("sec", "feature_id").write.mode(
        "overwrite").partitionBy("b").text(path)


# ---- GraphML (road network edges) ---------------------------------------------------------

def _wkt_line(c: Column) -> Column:
    inner = F.regexp_extract(c, r"LINESTRING\s*\((.*)\)", 1)
    pts = F.split(inner, r"\s*,\s*")
    return F.transform(pts, lambda s: F.struct(
        F.get(F.split(F.trim(s), r"\s+"), 0).cast("double").alias("lon"),
        F.get(F.split(F.trim(s), r"\s+"), 1).cast("double").alias("lat")))


_DATA = T.ArrayType(T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_key", T.StringType())]))
_KEY_SCHEMA = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_for", T.StringType()),
                            T.StructField("_attr.name", T.StringType())])
_NODE_SCHEMA = T.StructType([T.StructField("_id", T.StringType()), T.StructField("data", _DATA)])
_EDGE_SCHEMA = T.StructType([T.StructField("_id", T.StringType()), T.StructField("_source", T.StringType()), T.StructField("_target", T.StringType()),
                             T.StructField("data", _DATA)])


def read_graphml_edges(spark: SparkSession, path: str, layer: str = "roads") -> DataFrame:
    """GRAPHML_SCAN: road edges as map-feature rows.

    ``<data key=…>`` entries are resolved through the ``<key>`` elements; an
    edge's ``geometry`` is a WKT LINESTRING, and an edge without one gets the
    straight line between its two nodes' ``x``/``y``.
    """
    def rows(tag, schema):
        # ids and keys hold within their file
        return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path).withColumn(
            "file", F.col("_metadata.file_path"))

    keys = rows("key", _KEY_SCHEMA).select(
        "file", F.col("_id").cast("string").alias("k"), F.col("`_attr.name`").alias("name"),
        F.col("_for").alias("for")).distinct()
    nodes = rows("node", _NODE_SCHEMA)
    nd = nodes.select("file", F.col("_id").cast("string").alias("node"), F.explode("data").alias("d"))
    nd = nd.select("file", "node", F.col("d._key").cast("string").alias("k"), F.col("d._VALUE").cast("string").alias("v"))
    nk = keys.where(F.col("for") == "node")
    nxy = nd.join(nk, ["file", "k"]).groupBy("file", "node").agg(
        F.max(F.when(F.col("name") == "x", F.col("v").cast("double"))).alias("x"),
        F.max(F.when(F.col("name") == "y", F.col("v").cast("double"))).alias("y"))
    # an edge is known by its file, ends, id and content; equal edges are numbered
    content = F.xxhash64("_source", "_target", "_id", F.to_json("data"))
    edges = rows("edge", _EDGE_SCHEMA).withColumn("_eid", F.concat_ws(
        "-", F.col("_id"), F.hex(F.xxhash64("file", content))))
    e = edges.groupBy("file", F.col("_source").cast("string").alias("src"), F.col("_target").cast("string").alias("dst"),
                      "_eid", "data").agg(F.count(F.lit(1)).alias("_copies"))
    ed = e.select("file", "src", "dst", "_eid", "_copies", F.explode_outer("data").alias("d")).select(
        "file", "src", "dst", "_eid", "_copies", F.col("d._key").cast("string").alias("k"), F.col("d._VALUE").cast("string").alias("v"))
    ek = keys.where(F.col("for") == "edge")
    props = ed.join(ek, ["file", "k"], "left").groupBy("file", "src", "dst", "_eid", "_copies").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("name").isNotNull(),
                                                 F.struct("name", "v")))).alias("tags"))
    a = nxy.select("file", F.col("node").alias("src"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = nxy.select("file", F.col("node").alias("dst"), F.col("x").alias("bx"), F.col("y").alias("by"))
    j = props.join(a, ["file", "src"], "left").join(b, ["file", "dst"], "left")
    j = j.withColumn("_no", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    geom = F.element_at("tags", F.lit("geometry"))
    coords = F.when(geom.isNotNull(), _wkt_line(geom)).otherwise(
        F.array(F.struct(F.col("ax").alias("lon"), F.col("ay").alias("lat")),
                F.struct(F.col("bx").alias("lon"), F.col("by").alias("lat"))))
    out = j.select(F.concat_ws("-", "src", "dst", "_eid", F.when(F.col("_no") > 1, F.col("_no").cast("string"))).alias("feature_id"),
                   F.lit(layer).alias("layer"), F.lit("LineString").alias("geom_type"), "tags",
                   coords.alias("coords"))
    return out.withColumns({
        "minx": F.array_min(F.transform("coords", lambda p: p["lon"])),
        "miny": F.array_min(F.transform("coords", lambda p: p["lat"])),
        "maxx": F.array_max(F.transform("coords", lambda p: p["lon"])),
        "maxy": F.array_max(F.transform("coords", lambda p: p["lat"]))})


def write_graphml(lines: DataFrame, path: str, n_files: int = 8, drop_geometry_every: int = 3) -> None:
    """Write line features as GraphML road graphs, one complete document per
    file (``n_files`` hash buckets); every ``drop_geometry_every``-th edge is
    written without its geometry, as graph tools do for straight edges."""
    b = (F.abs(F.hash("feature_id")) % n_files).alias("b")
    first, last = F.get("coords", 0), F.element_at("coords", -1)
    wkt = F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(
        "coords", lambda p: F.format_string("%.7f %.7f", p["lon"], p["lat"])), ", "), F.lit(")"))
    e = lines.select(b, "feature_id", first.alias("p0"), last.alias("p1"), wkt.alias("wkt"),
                     (F.conv(F.substring(F.md5(F.concat("feature_id", F.lit("g"))), 1, 6), 16, 10).cast("int")
                      % drop_geometry_every == 0).alias("nogeom"))
    node = lambda nid, p: F.format_string(
        '<node id="%s"><data key="x">%.7f</data><data key="y">%.7f</data></node>', nid, p["lon"], p["lat"])
    rows = e.select("b", F.lit(1).alias("sec"), "feature_id", F.posexplode(F.array(
        node(F.concat("feature_id", F.lit("a")), F.col("p0")),
        node(F.concat("feature_id", F.lit("b")), F.col("p1")))).alias("_i", "value"))
    edge = F.concat(F.format_string('<edge source="%sa" target="%sb">', "feature_id", "feature_id"),
                    F.when(F.col("nogeom"), F.lit("")).otherwise(
                        F.concat(F.lit('<data key="geometry">'), F.col("wkt"), F.lit("</data>"))),
                    F.lit('<data key="highway">primary</data></edge>'))
    rows = rows.unionByName(e.select("b", F.lit(2).alias("sec"), "feature_id", F.lit(0).alias("_i"),
                                     edge.alias("value")))
    head = ('<?xml version="1.0" encoding="utf-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns">'
            '<key id="x" for="node" attr.name="x" attr.type="string"/>'
            '<key id="y" for="node" attr.name="y" attr.type="string"/>'
            '<key id="geometry" for="edge" attr.name="geometry" attr.type="string"/>'
            '<key id="highway" for="edge" attr.name="highway" attr.type="string"/>'
            '<graph edgedefault="directed">')
    buckets = e.select("b").distinct()
    rows = rows.unionByName(buckets.select("b", F.lit(0).alias("sec"), F.lit("").alias("feature_id"),
                                           F.lit(0).alias("_i"), F.lit(head).alias("value")))
    rows = rows.unionByName(buckets.select("b", F.lit(3).alias("sec"), F.lit("").alias("feature_id"),
                                           F.lit(0).alias("_i"), F.lit("</graph></graphml>").alias("value")))
    (rows.repartition("b").sortWithinPartitions("b", "sec", "feature_id", "_i")
         .drop("sec", "feature_id", "_i").write.mode("overwrite").partitionBy("b").text(path))


# ---- binary, CSV, Parquet ----------------------------------------------------------------------

def read_images(spark: SparkSession, path: str, glob: str = "*.png",
                name_pattern: str = r"([^/]+?)(\.[^./]*)?$") -> DataFrame:
    """BINARY_SCAN + BASE64_URL: ``trajectory_id`` (file stem, or group 1 of
    ``name_pattern`` on the path) and its data URL."""
    found = local.find(spark, path, folders=True, name=glob)
    if found is None:
        b = _binary_files(spark, path, glob)
    else:
        files = materialize(found, "files")
        # the content of a file is a value of a row, whoever reads it
        b = local.read_whole(files).withColumn("path", F.concat(F.lit("file:"), "path"))
    stem = F.regexp_extract("path", name_pattern, 1)
    return b.select(stem.alias("trajectory_id"), base64_url("content").alias("image_url"), "length")


def _binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``path, length, content`` by Spark's binary source."""
    with packed_listing(spark):
        return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV_IO (write): arrays become JSON text; text with newlines is quoted."""
    cols = [F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
            else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV_IO (read) with an explicit schema (multi-line quoted fields allowed)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """PARQUET_IO / SEQ_SINK (write)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """PARQUET_IO (read), with an explicit schema when given."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.parquet(path)
