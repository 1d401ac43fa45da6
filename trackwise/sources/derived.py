"""GPS points, labels, map features and vector tables derived from the given tables.

The test tables hold no GPS data, so trajectories are derived from ``events``
with integer arithmetic up to the final division, so that any engine computes
the same numbers. The rules are the fixture rules of the repository.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import DEFAULT_BUCKET_S, running_sum

# Fixed values of the point derivation (micro-degrees).
LAT0_MICRO = 39_900_000
LON0_MICRO = 116_400_000
STEP_MOD = 1_000_001
STEP_HALF = 500_000
LAT_MULT = 7919
LON_MULT = 104729
BAD_LAT_EVERY = 97
DUP_EVERY = 50
DUP_LAT_SHIFT = 10
BAD_LAT = 400.0
NULL_LON_EVERY = 211
NAN_LON_EVERY = 223
FILE_SPLIT_TS = "2024-01-16 00:00:00"

# Fixed values of the label derivation: (label_idx, start, end), and the modes.
LABEL_WINDOWS = [
    (0, "2024-01-01 00:00:00", "2024-01-11 00:00:00"),
    (1, "2024-01-09 00:00:00", "2024-01-20 00:00:00"),
    (2, "2024-01-22 00:00:00", "2024-01-31 00:00:00"),
]
MODES = ["walk", "bike", "bus", "car", "taxi"]
NO_LABEL_USER_MOD = (10, 3)

# Fixed values of the map features: the box N 40.2 S 39.6 E 116.8 W 116.0.
BOX_SOUTH_MICRO, BOX_NORTH_MICRO = 39_600_000, 40_200_000
BOX_WEST_MICRO, BOX_EAST_MICRO = 116_000_000, 116_800_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_points(events: DataFrame) -> DataFrame:
    """Raw GPS points ``(user_id, plt_idx, line_no, ts, lat, lon, altitude)``.

    The random walk is a running sum per user in ``(ts, event_id)`` order,
    computed as a two-level prefix sum so a hot user is split by day.
    """
    e = events.select("event_id", "ts", "user_id").withColumns({
        "dlat": (F.col("event_id") * LAT_MULT) % STEP_MOD - STEP_HALF,
        "dlon": (F.col("event_id") * LON_MULT) % STEP_MOD - STEP_HALF,
    })
    walk = running_sum(e, ["user_id"], ["ts", "event_id"], {"slat": "dlat", "slon": "dlon"}, bucket_s=DEFAULT_BUCKET_S)
    base = walk.select(
        "user_id", "event_id", "ts",
        F.col("slat").cast("bigint").alias("slat"),
        F.col("slon").cast("bigint").alias("slon"))
    lon = (F.lit(LON0_MICRO) + F.col("slon")) / F.lit(1e6)
    main = base.select(
        "user_id", "ts",
        (F.col("event_id") * 2).alias("line_no"),
        F.when(F.col("event_id") % BAD_LAT_EVERY == 0, F.lit(BAD_LAT))
         .otherwise((F.lit(LAT0_MICRO) + F.col("slat")) / F.lit(1e6)).alias("lat"),
        F.when(F.col("event_id") % NULL_LON_EVERY == 0, F.lit(None).cast("double"))
         .when(F.col("event_id") % NAN_LON_EVERY == 0, F.lit(float("nan"))).otherwise(lon).alias("lon"))
    dup = base.where(F.col("event_id") % DUP_EVERY == 0).select(
        "user_id", "ts",
        (F.col("event_id") * 2 + 1).alias("line_no"),
        ((F.lit(LAT0_MICRO) + F.col("slat") + DUP_LAT_SHIFT) / F.lit(1e6)).alias("lat"),
        lon.alias("lon"))
    pts = main.unionByName(dup)
    return pts.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.when(F.col("ts") < F.lit(FILE_SPLIT_TS).cast("timestamp_ntz"), F.lit(0))
         .otherwise(F.lit(1)).alias("plt_idx"),
        "line_no", "ts", "lat", "lon",
        F.lit(0.0).alias("altitude"))


def derive_labels(events: DataFrame) -> DataFrame:
    """Label intervals ``(user_id, label_idx, start_ts, end_ts, transport_mode)``."""
    m, skip = NO_LABEL_USER_MOD
    users = events.select(F.col("user_id").cast("int").alias("user_id")).distinct() \
                  .where(F.col("user_id") % m != skip)
    windows = F.array(*[F.struct(F.lit(i).alias("label_idx"),
                                 F.lit(s).cast("timestamp_ntz").alias("start_ts"),
                                 F.lit(t).cast("timestamp_ntz").alias("end_ts"))
                        for i, s, t in LABEL_WINDOWS])
    modes = F.array(*[F.lit(x) for x in MODES])
    lab = users.select("user_id", F.inline(windows))
    return lab.select(
        "user_id", "label_idx", "start_ts", "end_ts",
        F.element_at(modes, ((F.col("user_id") + F.col("label_idx")) % len(MODES) + 1).cast("int"))
         .alias("transport_mode"))


def _box_lat(k: F.Column, mult: int) -> F.Column:
    span = BOX_NORTH_MICRO - BOX_SOUTH_MICRO + 1
    return (F.lit(BOX_SOUTH_MICRO) + (k * mult) % span) / F.lit(1e6)


def _box_lon(k: F.Column, mult: int) -> F.Column:
    span = BOX_EAST_MICRO - BOX_WEST_MICRO + 1
    return (F.lit(BOX_WEST_MICRO) + (k * mult) % span) / F.lit(1e6)


# Map-feature tag sets chosen by key mod 4, and the layer they feed.
POINT_TAGS = [
    ("subway_stations", {"railway": "station", "subway": "yes"}),
    ("bus_stops", {"highway": "bus_stop"}),
    ("bus_stops", {"public_transport": "platform", "bus": "yes"}),
    ("bus_stops", {"public_transport": "stop_position", "bus": "yes"}),
]
LINE_TAGS = [
    ("subway_lines", {"railway": "subway"}),
    ("subway_lines", {"railway": "light_rail"}),
    ("roads", {"highway": "primary"}),
    ("bus_routes", {"route": "bus"}),
]
REPEAT_GEOM_EVERY = 25
LINE_STEP_MICRO = 20_000


def _tag_map(options: list[tuple[str, dict]], k: F.Column) -> tuple[F.Column, F.Column]:
    idx = (k % len(options)).cast("int")
    layer = F.element_at(F.array(*[F.lit(l) for l, _ in options]), idx + 1)
    tags = F.element_at(F.array(*[F.create_map(*[F.lit(x) for kv in t.items() for x in kv])
                                  for _, t in options]), idx + 1)
    return layer, tags


def derive_map_features(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Map features ``(feature_id, layer, geom_type, tags, coords, minx, miny, maxx, maxy)``.

    Customers become points, suppliers short two-segment lines. Every 25th key
    reuses the geometry of the key before it (repeated geometries).
    """
    ck = F.col("c_custkey")
    cg = F.when(ck % REPEAT_GEOM_EVERY == 0, ck - 1).otherwise(ck)
    c_layer, c_tags = _tag_map(POINT_TAGS, ck)
    pts = customer.select(
        F.concat(F.lit("c"), ck.cast("string")).alias("feature_id"),
        c_layer.alias("layer"), F.lit("Point").alias("geom_type"), c_tags.alias("tags"),
        F.array(F.struct(_box_lon(cg, 104729).alias("lon"), _box_lat(cg, 7919).alias("lat")))
         .alias("coords"))
    sk = F.col("s_suppkey")
    sg = F.when(sk % REPEAT_GEOM_EVERY == 0, sk - 1).otherwise(sk)
    s_layer, s_tags = _tag_map(LINE_TAGS, sk)
    x0, y0 = _box_lon(sg, 15485863), _box_lat(sg, 32452843)
    step = F.lit(LINE_STEP_MICRO / 1e6)
    lines = supplier.select(
        F.concat(F.lit("s"), sk.cast("string")).alias("feature_id"),
        s_layer.alias("layer"), F.lit("LineString").alias("geom_type"), s_tags.alias("tags"),
        F.array(F.struct(x0.alias("lon"), y0.alias("lat")),
                F.struct((x0 + step).alias("lon"), y0.alias("lat")),
                F.struct((x0 + step).alias("lon"), (y0 + step).alias("lat"))).alias("coords"))
    feats = pts.unionByName(lines)
    return feats.withColumns({
        "minx": F.array_min(F.transform("coords", lambda p: p["lon"])),
        "miny": F.array_min(F.transform("coords", lambda p: p["lat"])),
        "maxx": F.array_max(F.transform("coords", lambda p: p["lon"])),
        "maxy": F.array_max(F.transform("coords", lambda p: p["lat"])),
    })


# Fixed values of the vector split: which vec_ids each side drops.
IMAGE_DROP_MOD = (7, 0)
TEXT_DROP_MOD = (11, 0)
# Fixed value: every 97th vector (vec_id mod 97 = 1) gets an upper-case mode,
# so its image key does not match the key pattern.
UPPER_MODE_EVERY = 97


def derive_vector_tables(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two vector tables ``(trajectory_id, embedding array<float>)`` to fuse.

    Dimensions 1-32 are the "image" side (keys in image style
    ``trajectory_<key>_<mode>``), 33-64 the "text" side (bare keys).
    """
    key = F.format_string("v%06d", F.col("vec_id"))
    mode = F.element_at(F.array(*[F.lit(x) for x in MODES]),
                        (F.col("label") % len(MODES) + 1).cast("int"))
    mode = F.when(F.col("vec_id") % UPPER_MODE_EVERY == 1, F.upper(mode)).otherwise(mode)
    img = embeddings.where(F.col("vec_id") % IMAGE_DROP_MOD[0] != IMAGE_DROP_MOD[1]).select(
        F.concat(F.lit("trajectory_"), key, F.lit("_"), mode).alias("trajectory_id"),
        F.slice("embedding", 1, 32).alias("embedding"))
    txt = embeddings.where(F.col("vec_id") % TEXT_DROP_MOD[0] != TEXT_DROP_MOD[1]).select(
        key.alias("trajectory_id"), F.slice("embedding", 33, 32).alias("embedding"))
    return img, txt


def derive_vector_labels(embeddings: DataFrame) -> DataFrame:
    """``(trajectory_id, label)``: the class of every vector, as text."""
    return embeddings.select(F.format_string("v%06d", F.col("vec_id")).alias("trajectory_id"),
                             F.format_string("c%d", F.col("label")).alias("label"))
