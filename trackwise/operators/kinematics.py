"""The 12 kinematic features per trajectory (KINEMATIC_12 and its parts).

Order of the vector: length, top 1-3 speed, mean speed, population variance
of speed, top 1-3 |acceleration|, 0, 0, mean |acceleration|. Speeds are
spherical (haversine) m/s with time steps floored at 1e-6 s; acceleration
``a[0] = 0``, ``a[i] = (v[i] - v[i-1]) / ((dt[i] + dt[i-1]) / 2)`` when that
mean step is > 1e-6, else 0. With fewer than three speeds the missing top
values fall back to the first (largest). Trajectories with < 3 points are left
out; a duration <= 1e-6 s gives all zeros.

Plan: one bucketed pass on ``(unique_id, bucket)`` (counted buckets, see ``ordered``)
brings the previous point and the one before it, so a step's speed and that of the
step before are known in one row; top-3 candidates per bucket by windows on that
partitioning; one partial aggregation per trajectory for everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import MIN_STEP_S, duration_s, finite_or_null, haversine_m
from .ordered import in_buckets, with_previous

FEATURE_COLUMNS = [f"feature_{i}" for i in range(12)]
MIN_FEATURE_POINTS = 3


def step_kinematics(points: DataFrame, bucket_s: int | None = None, keep_bucket: bool = False,
                    carry: tuple[str, ...] = (), acceleration: bool = True) -> DataFrame:
    """STEP_KINEMATICS + STEP_ACCEL: one row per point after the first
    (``acceleration=False``: without ``acc``).

    Columns added: ``step_m, dt_s, v, acc`` (acc of the first step is 0) and
    ``p_<c>`` for every column in ``carry`` (value at the previous point).
    """
    d = in_buckets(points, ["unique_id"], "ts", bucket_s).repartition("unique_id", "_bkt")
    d = with_previous(d, ["unique_id"], ["ts"], ["lat", "lon", "ts", *carry], prefix="p_",
                      prefix2="pp_" if acceleration else None).drop("_cut")
    steps = (d.where(F.col("p_ts").isNotNull())
              .withColumn("step_m", haversine_m("p_lat", "p_lon", "lat", "lon"))
              .withColumn("dt_s", F.greatest(duration_s("p_ts", "ts"), F.lit(MIN_STEP_S)))
              .withColumn("v", F.col("step_m") / F.col("dt_s")))
    if acceleration:
        q_dt = F.greatest(duration_s("pp_ts", "p_ts"), F.lit(MIN_STEP_S))
        q_v = haversine_m("pp_lat", "pp_lon", "p_lat", "p_lon") / q_dt
        mean_dt = (F.col("dt_s") + q_dt) / 2.0
        steps = steps.withColumn("acc", F.when(F.col("pp_ts").isNull(), F.lit(0.0))
                                 .when(mean_dt > MIN_STEP_S, (F.col("v") - q_v) / mean_dt).otherwise(F.lit(0.0)))
    out = steps.drop("p_lat", "p_lon", *(f"pp_{c}" for c in ("lat", "lon", "ts", *carry)))
    return out if keep_bucket else out.drop("_bkt")


def _top3_parts(col: str, prefix: str) -> list:
    """Top-3 of per-bucket candidates, first value as fallback (TOP3_*)."""
    top = F.slice(F.sort_array(F.collect_list(F.when(F.col(f"_r_{prefix}") <= 3, F.col(col))), False), 1, 3)
    return [F.get(top, 0).alias(f"{prefix}1"),
            F.coalesce(F.get(top, 1), F.get(top, 0)).alias(f"{prefix}2"),
            F.coalesce(F.get(top, 2), F.get(top, 0)).alias(f"{prefix}3")]


def kinematic_features(clean: DataFrame, bucket_s: int | None = None) -> DataFrame:
    """KINEMATIC_12 from clean points: ``unique_id, label, feature_0..feature_11``.

    Rows with no transport mode are dropped first; ``label`` is the mode of the
    earliest point (FIRST_LABEL).

    One shuffle of the points on ``(unique_id, bucket)`` feeds the previous-rows pass
    and the top-3 candidates of a bucket (windows on the same partitioning), a narrow
    one the carried rows; then a single ``groupBy(unique_id)`` computes everything
    with partial aggregation. The top-3 lists gather at most 3 values per bucket of a
    trajectory.
    """
    pts = clean.where(F.col("transport_mode").isNotNull())
    steps = step_kinematics(pts, bucket_s, keep_bucket=True, carry=("transport_mode",)).withColumns({
        "v_ok": finite_or_null("v"), "a_ok": F.abs(finite_or_null("acc"))})
    wb = Window.partitionBy("unique_id", "_bkt")
    steps = (steps.withColumn("_r_v", F.row_number().over(wb.orderBy(F.col("v_ok").desc_nulls_last())))
                  .withColumn("_r_a", F.row_number().over(wb.orderBy(F.col("a_ok").desc_nulls_last()))))
    g = steps.groupBy("unique_id").agg(
        (F.count(F.lit(1)) + 1).alias("n_points"),
        F.min_by("p_transport_mode", "p_ts").alias("label"),
        duration_s(F.min("p_ts"), F.max("ts")).alias("duration_s"),
        F.sum("step_m").alias("length_m"),
        F.avg("v_ok").alias("v_mean"),
        F.var_pop("v_ok").alias("v_var"),
        F.avg("a_ok").alias("a_mean"),
        *_top3_parts("v_ok", "v"), *_top3_parts("a_ok", "a"))
    j = g.where(F.col("n_points") >= MIN_FEATURE_POINTS)
    zero = F.col("duration_s") <= MIN_STEP_S
    vals = [F.col("length_m"), F.coalesce("v1", F.lit(0.0)), F.coalesce("v2", F.lit(0.0)),
            F.coalesce("v3", F.lit(0.0)), F.coalesce("v_mean", F.lit(0.0)),
            F.coalesce("v_var", F.lit(0.0)), F.coalesce("a1", F.lit(0.0)),
            F.coalesce("a2", F.lit(0.0)), F.coalesce("a3", F.lit(0.0)),
            F.lit(0.0), F.lit(0.0), F.coalesce("a_mean", F.lit(0.0))]
    return j.select("unique_id", "label",
                    *[F.when(zero, F.lit(0.0)).otherwise(v).cast("double").alias(n)
                      for v, n in zip(vals, FEATURE_COLUMNS)])
