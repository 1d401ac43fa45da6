"""Queries over trajectories: match, clean, order, sequence, kinematics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import duration_s, geodesic_m, haversine_m, speed_kmh
from ..functions.text import image_name, traj_key, zfill3
from ..operators import clean as C
from ..operators import kinematics as K
from ..operators import sequence as S
from ..operators.ordered import running_sum, with_previous
from .catalog import big, inputs, r4, register, ts_sql, tstr
from .sqlparts import dur_sql, geodesic_sql, haversine_sql, speed_sql, with_base


# ---- joins and keys ---------------------------------------------------------

@register("interval_join", with_base(f"""
SELECT unique_id, CAST(user_id AS BIGINT) AS user_id, CAST(line_no AS BIGINT) AS line_no,
       {ts_sql('ts')} AS ts, transport_mode FROM matched"""))
def q_interval_join(spark, sf):
    m = inputs(spark, sf).matched
    return m.select("unique_id", big("user_id").alias("user_id"), big("line_no").alias("line_no"),
                    tstr("ts").alias("ts"), "transport_mode")


@register("traj_key", with_base("""
SELECT DISTINCT unique_id, CAST(user_id AS BIGINT) AS user_id, CAST(label_idx AS BIGINT) AS label_idx,
       CAST(plt_idx AS BIGINT) AS plt_idx,
       printf('%03d_%04d_%04d', user_id * 7, label_idx * 3, plt_idx + 9999) AS wide_key
FROM matched"""))
def q_traj_key(spark, sf):
    m = inputs(spark, sf).matched
    return m.select("unique_id", big("user_id").alias("user_id"), big("label_idx").alias("label_idx"),
                    big("plt_idx").alias("plt_idx"),
                    traj_key(F.col("user_id") * 7, F.col("label_idx") * 3, F.col("plt_idx") + 9999)
                    .alias("wide_key")).distinct()


@register("zfill", with_base("""
SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id, printf('%03d', user_id) AS folder,
       printf('%03d', user_id * 11) AS folder_wide FROM points"""))
def q_zfill(spark, sf):
    p = inputs(spark, sf).points
    return p.select(big("user_id").alias("user_id"), zfill3("user_id").alias("folder"),
                    zfill3(F.col("user_id") * 11).alias("folder_wide")).distinct()


@register("semi_valid", with_base("""
SELECT unique_id, CAST(count(*) AS BIGINT) AS n_points FROM fast_ok
WHERE unique_id IN (SELECT unique_id FROM valid_ids) GROUP BY unique_id"""))
def q_semi_valid(spark, sf):
    s = C.speed_checked(inputs(spark, sf).matched).where(F.col("speed_kmh") <= C.SPEED_LIMIT_KMH)
    return C.trajectory_counts(C.keep_long(s)).select("unique_id", big("n_points").alias("n_points"))


# ---- cleaning -----------------------------------------------------------------

@register("lat_range", with_base(f"""
SELECT unique_id, CAST(line_no AS BIGINT) AS line_no, round(lat, 6) AS lat FROM ranged"""))
def q_lat_range(spark, sf):
    r = C.lat_in_range(inputs(spark, sf).matched)
    return r.select("unique_id", big("line_no").alias("line_no"), F.round("lat", 6).alias("lat"))


@register("dedup", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, CAST(line_no AS BIGINT) AS line_no, round(lat, 6) AS lat
FROM dedup"""))
def q_dedup(spark, sf):
    d = C.dedup_first(C.lon_finite(C.lat_in_range(inputs(spark, sf).matched)))
    return d.select("unique_id", tstr("ts").alias("ts"), big("line_no").alias("line_no"),
                    F.round("lat", 6).alias("lat"))


@register("lag_point", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, {ts_sql('prev_ts')} AS prev_ts,
       round(prev_lat, 6) AS prev_lat, round(prev_lon, 6) AS prev_lon
FROM lagged WHERE prev_lat IS NOT NULL"""))
def q_lag_point(spark, sf):
    d = C.speed_checked(inputs(spark, sf).matched)
    return d.select("unique_id", tstr("ts").alias("ts"), tstr("prev_ts").alias("prev_ts"),
                    F.round("prev_lat", 6).alias("prev_lat"), F.round("prev_lon", 6).alias("prev_lon"))


@register("geodesic_m", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, round(distance_m, 4) AS distance_m FROM speeds"""))
def q_geodesic(spark, sf):
    d = C.speed_checked(inputs(spark, sf).matched)
    return d.select("unique_id", tstr("ts").alias("ts"), r4("distance_m").alias("distance_m"))


@register("duration_s", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, round(time_s, 6) AS time_s FROM speeds"""))
def q_duration(spark, sf):
    d = C.speed_checked(inputs(spark, sf).matched)
    return d.select("unique_id", tstr("ts").alias("ts"), F.round("time_s", 6).alias("time_s"))


@register("speed_kmh", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, round(speed_kmh, 4) AS speed_kmh FROM speeds"""))
def q_speed(spark, sf):
    d = C.speed_checked(inputs(spark, sf).matched)
    return d.select("unique_id", tstr("ts").alias("ts"), r4("speed_kmh").alias("speed_kmh"))


@register("speed_filter", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts FROM fast_ok"""))
def q_speed_filter(spark, sf):
    d = C.speed_checked(inputs(spark, sf).matched).where(F.col("speed_kmh") <= C.SPEED_LIMIT_KMH)
    return d.select("unique_id", tstr("ts").alias("ts"))


@register("min_points", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, transport_mode FROM clean"""))
def q_min_points(spark, sf):
    c = inputs(spark, sf).clean
    return c.select("unique_id", tstr("ts").alias("ts"), "transport_mode")


@register("traj_count", with_base("""
SELECT unique_id, CAST(count(*) AS BIGINT) AS n_points FROM clean GROUP BY unique_id"""))
def q_traj_count(spark, sf):
    return C.trajectory_counts(inputs(spark, sf).clean).select(
        "unique_id", big("n_points").alias("n_points"))


@register("distinct_count", with_base("""
SELECT (SELECT CAST(count(DISTINCT unique_id) AS BIGINT) FROM matched) AS matched_trajectories,
       (SELECT CAST(count(*) AS BIGINT) FROM located) - (SELECT CAST(count(*) AS BIGINT) FROM dedup)
         AS duplicates_removed,
       (SELECT CAST(count(DISTINCT unique_id) AS BIGINT) FROM clean) AS clean_trajectories"""))
def q_distinct_count(spark, sf):
    report = inputs(spark, sf).clean_run.report
    at = lambda stage, c: F.max(F.when(F.col("stage") == stage, F.col(c)))
    return report.agg(at("matched", "n_trajectories").alias("matched_trajectories"),
                      (at("lon_finite", "n_rows") - at("deduplicated", "n_rows")).alias("duplicates_removed"),
                      at("clean", "n_trajectories").alias("clean_trajectories"))


@register("quality_report", with_base("""
SELECT 1::BIGINT AS stage_no, 'matched' AS stage, count(*)::BIGINT AS n_rows,
       count(DISTINCT unique_id)::BIGINT AS n_trajectories FROM matched
UNION ALL SELECT 2, 'lat_in_range', count(*), count(DISTINCT unique_id) FROM ranged
UNION ALL SELECT 3, 'lon_finite', count(*), count(DISTINCT unique_id) FROM located
UNION ALL SELECT 4, 'deduplicated', count(*), count(DISTINCT unique_id) FROM dedup
UNION ALL SELECT 5, 'with_previous', count(*), count(DISTINCT unique_id) FROM speeds
UNION ALL SELECT 6, 'speed_ok', count(*), count(DISTINCT unique_id) FROM fast_ok
UNION ALL SELECT 7, 'clean', count(*), count(DISTINCT unique_id) FROM clean"""))
def q_quality_report(spark, sf):
    return inputs(spark, sf).clean_run.report


@register("select_drop_rename", with_base(f"""
SELECT unique_id AS "Unique_ID", CAST(user_id AS BIGINT) AS "User_ID", {ts_sql('ts')} AS "Timestamp",
       round(lat, 6) AS "Latitude", round(lon, 6) AS "Longitude", round(altitude, 4) AS "Altitude",
       transport_mode AS "Transport Mode" FROM clean"""))
def q_select_drop_rename(spark, sf):
    c = inputs(spark, sf).clean
    return c.select(F.col("unique_id").alias("Unique_ID"), big("user_id").alias("User_ID"),
                    tstr("ts").alias("Timestamp"), F.round("lat", 6).alias("Latitude"),
                    F.round("lon", 6).alias("Longitude"), r4("altitude").alias("Altitude"),
                    F.col("transport_mode").alias("Transport Mode"))


@register("ordinals", with_base("""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(label_idx AS BIGINT) AS label_idx,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY start_ts, end_ts) - 1 AS BIGINT) AS ordinal
FROM lab"""))
def q_ordinals(spark, sf):
    lab = inputs(spark, sf).labels.withColumn("_one", F.lit(1))
    o = running_sum(lab, ["user_id"], ["start_ts", "end_ts"], {"_pos": "_one"})
    return o.select(big("user_id").alias("user_id"), big("label_idx").alias("label_idx"),
                    (F.col("_pos") - 1).cast("bigint").alias("ordinal"))


@register("sort_points", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts,
       CAST(row_number() OVER (PARTITION BY unique_id ORDER BY ts) - 1 AS BIGINT) AS pos FROM clean"""))
def q_sort_points(spark, sf):
    c = inputs(spark, sf).clean.withColumn("_one", F.lit(1))
    o = running_sum(c, ["unique_id"], ["ts"], {"_pos": "_one"}, bucket_s=3600)
    return o.select("unique_id", tstr("ts").alias("ts"), (F.col("_pos") - 1).cast("bigint").alias("pos"))


# ---- sequences -----------------------------------------------------------------

_PART_SQL = "CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT)"


@register("seq_build", with_base(f"""
SELECT unique_id, {_PART_SQL} AS part, CAST(count(*) AS BIGINT) AS n_points,
       {ts_sql('min(ts)')} AS first_ts, {ts_sql('max(ts)')} AS last_ts,
       string_agg(printf('(%.6f, %.6f, %s)', lat, lon, strftime(ts, '%Y-%m-%d %H:%M:%S')), chr(10) ORDER BY ts)
         AS text
FROM clean GROUP BY unique_id, {_PART_SQL}"""))
def q_seq_build(spark, sf):
    parts = S.sequence_parts(inputs(spark, sf).clean)
    t = S.part_text(parts)
    return (parts.select("unique_id", "part",
                         tstr(F.col("time_sequence")[0]["ts"]).alias("first_ts"),
                         tstr(F.element_at("time_sequence", -1)["ts"]).alias("last_ts"))
                 .join(t, ["unique_id", "part"])
                 .select("unique_id", big("part").alias("part"), big("n_points").alias("n_points"),
                         "first_ts", "last_ts", "text"))


@register("point_text", with_base(f"""
SELECT unique_id, {_PART_SQL} AS part,
       string_agg(printf('(%.6f, %.6f, %s)', lat, lon, strftime(ts, '%Y-%m-%d %H:%M:%S')), chr(10) ORDER BY ts)
         AS text
FROM clean GROUP BY unique_id, {_PART_SQL}"""))
def q_point_text(spark, sf):
    t = S.part_text(S.sequence_parts(inputs(spark, sf).clean))
    return t.select("unique_id", big("part").alias("part"), "text")


@register("seq_build_labelled", with_base(f"""
SELECT c.unique_id, {_PART_SQL} AS part, CAST(count(*) AS BIGINT) AS n_points,
       string_agg(printf('%.6f,%.6f', lat, lon), ';' ORDER BY ts) AS latlon, f.label
FROM clean c JOIN (SELECT unique_id, arg_min(transport_mode, ts) AS label FROM clean
                   WHERE transport_mode IS NOT NULL GROUP BY unique_id) f USING (unique_id)
GROUP BY c.unique_id, {_PART_SQL}, f.label"""))
def q_seq_build_labelled(spark, sf):
    p = S.labelled_sequence_parts(inputs(spark, sf).clean)
    return p.select("unique_id", big("part").alias("part"),
                    F.size("time_sequence").cast("bigint").alias("n_points"),
                    F.array_join(F.transform("time_sequence",
                                             lambda x: F.format_string("%.6f,%.6f", x["lat"], x["lon"])),
                                 ";").alias("latlon"),
                    "label")


@register("first_label", with_base("""
SELECT unique_id, arg_min(transport_mode, ts) AS label FROM clean
WHERE transport_mode IS NOT NULL GROUP BY unique_id"""))
def q_first_label(spark, sf):
    return S.first_label(inputs(spark, sf).clean)


@register("downsample", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts FROM ranked_ds WHERE n <= 12 OR NOT mid OR r <= 10""", f"""
ds AS (SELECT *, count(*) OVER w AS n, (ts <> min(ts) OVER w AND ts <> max(ts) OVER w) AS mid
       FROM clean WINDOW w AS (PARTITION BY unique_id)),
ranked_ds AS (
  SELECT *, row_number() OVER (PARTITION BY unique_id, mid
         ORDER BY md5(concat_ws('|', unique_id, {ts_sql('ts')}, '3407')), ts) AS r FROM ds)"""))
def q_downsample(spark, sf):
    d = S.downsample(inputs(spark, sf).clean, max_points=12, seed=3407)
    return d.select("unique_id", tstr("ts").alias("ts"))


# ---- kinematics -----------------------------------------------------------------

@register("haversine_m", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, round(step_m, 4) AS step_m FROM ksteps1"""))
def q_haversine(spark, sf):
    s = K.step_kinematics(inputs(spark, sf).clean)
    return s.select("unique_id", tstr("ts").alias("ts"), r4("step_m").alias("step_m"))


@register("step_kinematics", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, round(step_m, 4) AS step_m, round(dt_s, 6) AS dt_s,
       round(v, 4) AS v FROM ksteps2"""))
def q_step_kinematics(spark, sf):
    s = K.step_kinematics(inputs(spark, sf).clean)
    return s.select("unique_id", tstr("ts").alias("ts"), r4("step_m").alias("step_m"),
                    F.round("dt_s", 6).alias("dt_s"), r4("v").alias("v"))


@register("step_accel", with_base(f"""
SELECT unique_id, {ts_sql('ts')} AS ts, round(acc, 4) AS acc FROM ksteps"""))
def q_step_accel(spark, sf):
    s = K.step_kinematics(inputs(spark, sf).clean)
    return s.select("unique_id", tstr("ts").alias("ts"), r4("acc").alias("acc"))


_FEAT_CTES = """
kagg AS (
  SELECT unique_id, sum(step_m) AS length_m, avg(v) AS v_mean, var_pop(v) AS v_var,
         avg(abs(acc)) AS a_mean FROM ksteps GROUP BY unique_id),
vtop AS (
  SELECT unique_id, max(v) FILTER (WHERE r = 1) AS v1, max(v) FILTER (WHERE r = 2) AS v2,
         max(v) FILTER (WHERE r = 3) AS v3
  FROM (SELECT unique_id, v, row_number() OVER (PARTITION BY unique_id ORDER BY v DESC) AS r FROM ksteps)
  WHERE r <= 3 GROUP BY unique_id),
atop AS (
  SELECT unique_id, max(a) FILTER (WHERE r = 1) AS a1, max(a) FILTER (WHERE r = 2) AS a2,
         max(a) FILTER (WHERE r = 3) AS a3
  FROM (SELECT unique_id, abs(acc) AS a, row_number() OVER (PARTITION BY unique_id ORDER BY abs(acc) DESC) AS r
        FROM ksteps)
  WHERE r <= 3 GROUP BY unique_id),
kpts AS (
  SELECT unique_id, count(*) AS n_points, arg_min(transport_mode, ts) AS label,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_s
  FROM clean WHERE transport_mode IS NOT NULL GROUP BY unique_id),
feat AS (
  SELECT p.unique_id, p.label, p.duration_s <= 1e-6 AS z, length_m,
         v1, coalesce(v2, v1) AS v2, coalesce(v3, v1) AS v3, v_mean, v_var,
         a1, coalesce(a2, a1) AS a2, coalesce(a3, a1) AS a3, a_mean
  FROM kpts p LEFT JOIN kagg USING (unique_id) LEFT JOIN vtop USING (unique_id)
       LEFT JOIN atop USING (unique_id)
  WHERE p.n_points >= 3)
"""


def _fsql(cols: list[tuple[str, str]]) -> str:
    sel = ", ".join(f"round(CASE WHEN z THEN CAST(0.0 AS DOUBLE) ELSE coalesce({e}, CAST(0.0 AS DOUBLE)) END, 4)"
                    f" AS {n}" for e, n in cols)
    return with_base(f"SELECT unique_id, label, {sel} FROM feat", _FEAT_CTES)


_FEATURE_EXPR = ["length_m", "v1", "v2", "v3", "v_mean", "v_var", "a1", "a2", "a3",
                 "CAST(0.0 AS DOUBLE)", "CAST(0.0 AS DOUBLE)", "a_mean"]


def _fspark(spark, sf, idx: list[int]):
    f = inputs(spark, sf).features
    return f.select("unique_id", "label", *[r4(f"feature_{i}").alias(f"feature_{i}") for i in idx])


def _feature_query(name: str, idx: list[int]):
    sql = _fsql([(_FEATURE_EXPR[i], f"feature_{i}") for i in idx])

    @register(name, sql)
    def q(spark, sf):
        return _fspark(spark, sf, idx)
    q.__name__ = "q_" + name
    return q


_feature_query("kinematic_12", list(range(12)))
_feature_query("length", [0])
_feature_query("top3_speed", [1, 2, 3])
_feature_query("speed_stats", [4, 5])
_feature_query("top3_accel", [6, 7, 8])
_feature_query("mean_abs_accel", [11])


@register("duration", with_base("""
SELECT unique_id, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration_s
FROM clean GROUP BY unique_id"""))
def q_duration_traj(spark, sf):
    c = inputs(spark, sf).clean
    return c.groupBy("unique_id").agg(F.round(duration_s(F.min("ts"), F.max("ts")), 6).alias("duration_s"))


@register("clean_nonfinite", with_base("""
SELECT unique_id, round(coalesce(avg(CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END), 0.0), 4) AS mean_finite,
       CAST(count(CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END) AS BIGINT) AS n_finite
FROM (SELECT unique_id, CASE WHEN time_s = 0 THEN
        (CASE WHEN distance_m = 0 THEN 'NaN'::DOUBLE ELSE 'Infinity'::DOUBLE END)
      ELSE distance_m / time_s END AS x FROM speeds)
GROUP BY unique_id"""))
def q_clean_nonfinite(spark, sf):
    from ..functions.geo import finite_or_null
    s = C.speed_checked(inputs(spark, sf).matched)
    raw = (F.when(F.col("time_s") == 0,
                  F.when(F.col("distance_m") == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))))
            .otherwise(F.col("distance_m") / F.col("time_s")))
    x = s.select("unique_id", finite_or_null(raw).alias("x"))
    return x.groupBy("unique_id").agg(r4(F.coalesce(F.avg("x"), F.lit(0.0))).alias("mean_finite"),
                                      F.count("x").cast("bigint").alias("n_finite"))


@register("image_name", with_base("""
SELECT unique_id, 'trajectory_' || unique_id || '_' || label || '.png' AS image_name,
       'trajectory_' || unique_id || '_unknown.png' AS image_name_nomode
FROM (SELECT unique_id, arg_min(transport_mode, ts) AS label FROM clean GROUP BY unique_id)"""))
def q_image_name(spark, sf):
    c = inputs(spark, sf).clean
    f = c.groupBy("unique_id").agg(F.min_by("transport_mode", "ts").alias("label"))
    return f.select("unique_id", image_name("unique_id", "label").alias("image_name"),
                    image_name("unique_id").alias("image_name_nomode"))
