"""Round trips through the file sources and sinks.

Each query writes data Spark derives from the given tables into a fresh
folder under the shared checkpoint folder, reads it back with the reader under
test, and reports what the reader saw.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import sequence as S
from ..session import scratch_path
from ..sources import files as FS
from .catalog import big, inputs, r4, register, ts_sql, tstr
from .q_context import msql
from .sqlparts import with_base


def _dir(spark, name: str) -> str:
    # a blank and a plus, as in the paths that users have
    return scratch_path(spark, f"{name} files+{uuid.uuid4().hex[:12]}")


@register("plt_scan", with_base("""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(plt_idx AS BIGINT) AS plt_idx, CAST(count(*) AS BIGINT) AS n_points,
       CAST(sum(CAST(round(lat * 1e6) AS BIGINT)) AS BIGINT) AS sum_lat_micro,
       strftime(min(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS first_ts
FROM points GROUP BY user_id, plt_idx"""))
def q_plt_scan(spark, sf):
    root = _dir(spark, "plt")
    FS.write_plt(inputs(spark, sf).points, root)
    p = FS.read_plt(spark, f"{root}/u=*/f=*/*.txt", user_pattern=r"/u=(\d+)/f=")
    return p.groupBy("user_id", "plt_idx").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_points"),
        F.sum(F.round(F.col("lat") * 1e6).cast("bigint")).alias("sum_lat_micro"),
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts")) \
        .select(big("user_id").alias("user_id"), big("plt_idx").alias("plt_idx"), "n_points", "sum_lat_micro",
                "first_ts")


@register("user_scan", with_base("""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(count(*) AS BIGINT) AS n_points, CAST(count(DISTINCT plt_idx) AS BIGINT) AS n_files
FROM points WHERE user_id BETWEEN 3 AND 60 GROUP BY user_id"""))
def q_user_scan(spark, sf):
    """Users in an inclusive range."""
    root = _dir(spark, "users")
    FS.write_plt(inputs(spark, sf).points, root)
    p = FS.read_plt(spark, f"{root}/u=*/f=*/*.txt", user_min=3, user_max=60, user_pattern=r"/u=(\d+)/f=")
    return p.groupBy(big("user_id").alias("user_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_points"), F.countDistinct("plt_idx").cast("bigint").alias("n_files"))


@register("drop_null", with_base("""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(count(*) AS BIGINT) AS n_points
FROM points WHERE line_no % 13 <> 0 GROUP BY user_id"""))
def q_drop_null(spark, sf):
    """Point lines without a time are dropped."""
    root = _dir(spark, "untimed")
    p = inputs(spark, sf).points
    FS.write_plt(p.withColumn("ts", F.when(F.col("line_no") % 13 != 0, F.col("ts"))), root)
    r = FS.read_plt(spark, f"{root}/u=*/f=*/*.txt", user_pattern=r"/u=(\d+)/f=")
    return r.groupBy(big("user_id").alias("user_id")).agg(F.count(F.lit(1)).cast("bigint").alias("n_points"))


@register("ts_parse", with_base(f"""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(label_idx AS BIGINT) AS label_idx, {ts_sql('start_ts')} AS start_ts
FROM lab WHERE (user_id + label_idx) % 4 <> 0"""))
def q_ts_parse(spark, sf):
    """Label lines whose time does not parse are dropped; the others keep their numbers."""
    root = _dir(spark, "times")
    lab = inputs(spark, sf).labels
    when = F.date_format("start_ts", FS.LABEL_TS_FORMAT)
    start = F.when((F.col("user_id") + F.col("label_idx")) % 4 == 0, F.concat(F.lit("on "), when)).otherwise(when)
    body = lab.select(F.format_string("%03d", "user_id").alias("u"), F.col("label_idx").cast("long").alias("o"), F.concat_ws(
        "\t", start, F.date_format("end_ts", FS.LABEL_TS_FORMAT), "transport_mode").alias("value"))
    FS.write_lines(body, ["u"], ["o"], ["header"], root)
    r = FS.read_labels(spark, f"{root}/u=*/*.txt", user_pattern=r"/u=(\d+)/")
    return r.select(big("user_id").alias("user_id"), big("label_idx").alias("label_idx"), tstr("start_ts").alias("start_ts"))


@register("label_scan", with_base(f"""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(label_idx AS BIGINT) AS label_idx, {ts_sql('start_ts')} AS start_ts,
       {ts_sql('end_ts')} AS end_ts, transport_mode FROM lab"""))
def q_label_scan(spark, sf):
    root = _dir(spark, "labels")
    FS.write_labels(inputs(spark, sf).labels, root)
    lab = FS.read_labels(spark, f"{root}/u=*/*.txt", user_pattern=r"/u=(\d+)/")
    return lab.select(big("user_id").alias("user_id"), big("label_idx").alias("label_idx"),
                      tstr("start_ts").alias("start_ts"), tstr("end_ts").alias("end_ts"), "transport_mode")


@register("geojson_io", msql("""
SELECT feature_id, layer, geom_type, CAST(len(coords) AS BIGINT) AS n_vertices, round(minx, 6) AS minx,
       round(miny, 6) AS miny, round(maxx, 6) AS maxx, round(maxy, 6) AS maxy,
       CAST(cardinality(tags) AS BIGINT) AS n_tags FROM mf"""))
def q_geojson_io(spark, sf):
    root = _dir(spark, "geojson")
    FS.write_geojson_seq(inputs(spark, sf).map_features, root)
    g = FS.read_geojson_seq(spark, root)
    return g.select("feature_id", "layer", "geom_type", F.size("coords").cast("bigint").alias("n_vertices"),
                    *[F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")],
                    F.size("tags").cast("bigint").alias("n_tags"))


@register("geojson_collection", msql("""
SELECT feature_id, 'map' AS layer, geom_type, CAST(len(coords) AS BIGINT) AS n_vertices, round(minx, 6) AS minx,
       round(miny, 6) AS miny, round(maxx, 6) AS maxx, round(maxy, 6) AS maxy,
       CAST(cardinality(tags) AS BIGINT) AS n_tags FROM mf"""))
def q_geojson_collection(spark, sf):
    root = _dir(spark, "collections")
    FS.write_geojson(inputs(spark, sf).map_features, root)
    g = FS.read_geojson(spark, f"{root}/b=*/*.txt", "map")
    return g.select("feature_id", "layer", "geom_type", F.size("coords").cast("bigint").alias("n_vertices"),
                    *[F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")],
                    F.size("tags").cast("bigint").alias("n_tags"))


@register("graphml_scan", msql("""
SELECT feature_id AS edge, round(minx, 6) AS minx, round(miny, 6) AS miny, round(maxx, 6) AS maxx,
       round(maxy, 6) AS maxy, CASE WHEN straight THEN 2 ELSE len(coords) END::BIGINT AS n_vertices,
       CASE WHEN straight THEN 'highway' ELSE 'geometry,highway' END AS tag_names, 'primary' AS highway
FROM (SELECT *, CAST('0x' || substr(md5(feature_id || 'g'), 1, 6) AS BIGINT) % 3 = 0 AS straight FROM mf
      WHERE geom_type = 'LineString')"""))
def q_graphml_scan(spark, sf):
    root = _dir(spark, "graphml")
    lines = inputs(spark, sf).map_features.where(F.col("geom_type") == "LineString")
    FS.write_graphml(lines, root)
    e = FS.read_graphml_edges(spark, f"{root}/b=*/*.txt")
    return e.select(F.regexp_extract("feature_id", r"^(.*)a-", 1).alias("edge"),
                    *[F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")],
                    F.size("coords").cast("bigint").alias("n_vertices"),
                    F.array_join(F.array_sort(F.map_keys("tags")), ",").alias("tag_names"),
                    F.element_at("tags", F.lit("highway")).alias("highway"))


@register("binary_scan", """
SELECT CAST(page_id AS BIGINT) AS page_id,
       CAST(22 + 4 * ceil((octet_length(encode(html)) + 1) / 3) AS BIGINT) AS url_chars FROM pages""")
def q_binary_scan(spark, sf):
    root = _dir(spark, "binary")
    FS.write_lines(inputs(spark, sf).table("pages").select("page_id", F.col("html").alias("value")), ["page_id"], [], [], root)
    im = FS.read_images(spark, root, glob="*.txt", name_pattern=r"page_id=(\d+)/")
    return im.select(F.col("trajectory_id").cast("bigint").alias("page_id"),
                     F.length("image_url").cast("bigint").alias("url_chars"))


@register("csv_io", """
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5,
       lang FROM documents""")
def q_csv_io(spark, sf):
    root = _dir(spark, "csv")
    FS.write_csv(inputs(spark, sf).table("documents").select("doc_id", "text", "lang"), root)
    d = FS.read_csv(spark, root, "doc_id bigint, text string, lang string")
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"),
                    "lang")


@register("parquet_io", with_base(f"""
SELECT unique_id, CAST(user_id AS BIGINT) AS user_id, {ts_sql('ts')} AS ts, round(lat, 6) AS lat,
       round(lon, 6) AS lon, transport_mode FROM clean"""))
def q_parquet_io(spark, sf):
    root = _dir(spark, "parquet")
    FS.write_parquet(inputs(spark, sf).clean, root)
    c = FS.read_parquet(spark, root, "unique_id string, user_id int, ts timestamp_ntz, lat double, lon double, "
                                     "altitude double, transport_mode string")
    return c.select("unique_id", big("user_id").alias("user_id"), tstr("ts").alias("ts"),
                    F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "transport_mode")


@register("seq_sink", with_base(f"""
SELECT unique_id, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS part, CAST(count(*) AS BIGINT) AS n_points,
       {ts_sql('min(ts)')} AS first_ts, CAST(sum(CAST(round(lat * 1e6) AS BIGINT)) AS BIGINT) AS sum_lat_micro
FROM clean GROUP BY 1, 2"""))
def q_seq_sink(spark, sf):
    root = _dir(spark, "sequences")
    FS.write_parquet(S.sequence_parts(inputs(spark, sf).clean), root)
    p = FS.read_parquet(spark, root)
    return p.select("unique_id", big("part").alias("part"), F.size("time_sequence").cast("bigint").alias("n_points"),
                    tstr(F.col("time_sequence")[0]["ts"]).alias("first_ts"),
                    F.aggregate("time_sequence", F.lit(0).cast("bigint"),
                                lambda a, x: a + F.round(x["lat"] * 1e6).cast("bigint")).alias("sum_lat_micro"))
