"""Cleaning: latitude range, duplicate timestamps, speed limit, minimum length.

Order matters and follows the reference: range (and finite longitude) -> dedup (first in file order)
-> previous point (the first point of each trajectory is dropped for good) ->
ellipsoidal speed <= limit, one pass -> count survivors >= minimum.

The wide rows are shuffled on ``(unique_id, bucket)``; the dedup window
(partitioned by ``unique_id, bucket, ts``) and the previous-point window both run
on that partitioning. Buckets are counted (``ordered``): a trajectory is one bucket
unless it is long, then it is cut by time. Counting and the rows carried between
buckets read the input again with fewer columns.

``clean_run`` writes the chain once, with the stage that each row reached; survivors
are counted on that table, and the quality report adds up the per-trajectory counts
that the run needs anyway, so no step runs twice.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import duration_s, geodesic_m, speed_kmh
from ..session import materialize
from .ordered import in_buckets, with_previous

# The reference's cleaning defaults.
SPEED_LIMIT_KMH = 200.0
MIN_POINTS = 10

CLEAN_COLUMNS = ["unique_id", "user_id", "ts", "lat", "lon", "altitude", "transport_mode"]


def lat_in_range(df: DataFrame) -> DataFrame:
    """LAT_RANGE: keep ``-90 <= lat <= 90``; NaN and null fail. Longitude is not checked."""
    return df.where(F.col("lat").between(-90.0, 90.0) & ~F.isnan("lat"))


def lon_finite(df: DataFrame) -> DataFrame:
    """Keep rows whose longitude is a finite number: another has no distance to
    its neighbours, so it would pass the speed test and hide the real steps."""
    return df.where(_finite("lon"))


def _finite(c: str):
    return F.coalesce(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.lit(False))


def dedup_first(df: DataFrame, bucket_s: int | None = None) -> DataFrame:
    """DEDUP: one row per ``(unique_id, ts)``, the first in file order (``line_no``).

    A frame in buckets (``in_buckets``) stays so; else the buckets are dropped again."""
    had = "_bkt" in df.columns
    d = df if had else in_buckets(df, ["unique_id"], "ts", bucket_s)
    d = d.repartition("unique_id", "_bkt")
    w = Window.partitionBy("unique_id", "_bkt", "ts").orderBy("line_no")
    d = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return d if had else d.drop("_bkt", "_cut")


def with_prev_point(df: DataFrame, bucket_s: int | None = None) -> DataFrame:
    """LAG_POINT: previous lat, lon, ts in the trajectory; first points dropped."""
    d = with_previous(df, ["unique_id"], ["ts"], ["lat", "lon", "ts"], prefix="prev_",
                      bucket_s=bucket_s)
    return d.where(F.col("prev_lat").isNotNull())


def with_speed(df: DataFrame) -> DataFrame:
    """GEODESIC_M, DURATION_S, SPEED_KMH from the previous point."""
    return df.withColumns({
        "distance_m": geodesic_m("lat", "lon", "prev_lat", "prev_lon"),
        "time_s": duration_s("prev_ts", "ts"),
    }).withColumn("speed_kmh", speed_kmh("distance_m", "time_s"))


def trajectory_counts(df: DataFrame) -> DataFrame:
    """TRAJ_COUNT: points per trajectory (partial aggregation, skew-safe)."""
    return df.groupBy("unique_id").agg(F.count(F.lit(1)).alias("n_points"))


def keep_long(df: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """MIN_POINTS + SEMI_VALID: keep trajectories with ``>= min_points`` rows."""
    valid = trajectory_counts(df).where(F.col("n_points") >= min_points).select("unique_id")
    return df.join(valid, on="unique_id", how="left_semi")


def speed_checked(matched: DataFrame, speed_limit: float = SPEED_LIMIT_KMH,
                  bucket_s: int | None = None) -> DataFrame:
    """Matched points through range, dedup, previous point and speed columns."""
    d = dedup_first(in_buckets(lon_finite(lat_in_range(matched)), ["unique_id"], "ts", bucket_s))
    d = with_prev_point(d).drop("_bkt", "_cut")
    return with_speed(d)


#: Stages of cleaning, in order; a row's stage is the last one that it reached.
STAGES = ["matched", "lat_in_range", "lon_finite", "deduplicated", "with_previous", "speed_ok", "clean"]


class CleanRun(NamedTuple):
    points: DataFrame   # the clean points
    report: DataFrame   # QUALITY_REPORT of the same run


def clean_run(matched: DataFrame, speed_limit: float = SPEED_LIMIT_KMH,
              min_points: int = MIN_POINTS, bucket_s: int | None = None) -> CleanRun:
    """The whole cleaning chain, run once, and its report.

    Written: rows per trajectory before the chain (they also size the buckets), the
    deduplicated points with the stage each reached (4: no previous point, 5: too
    fast, 6: within the limit), and rows per trajectory and stage. Reading ``points`` or
    ``report`` scans those tables only.
    """
    in_range = F.coalesce(F.col("lat").between(-90.0, 90.0) & ~F.isnan("lat"), F.lit(False))
    located = in_range & _finite("lon")
    before = materialize(matched.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("n1"), F.count_if(in_range).alias("n2"), F.count_if(located).alias("n3")), "rows_before")
    d = in_buckets(lon_finite(lat_in_range(matched)), ["unique_id"], "ts", bucket_s,
                   sizes=before.select("unique_id", F.col("n3").alias("_n")))
    d = with_speed(with_previous(dedup_first(d), ["unique_id"], ["ts"], ["lat", "lon", "ts"], prefix="prev_"))
    stage = F.when(F.col("prev_lat").isNull(), 4).when(F.col("speed_kmh") <= speed_limit, 6).otherwise(5)
    chain = materialize(d.select(*CLEAN_COLUMNS, stage.alias("stage")), "cleaning_chain")
    after = materialize(chain.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("n4"), F.count_if(F.col("stage") >= 5).alias("n5"), F.count_if(F.col("stage") == 6).alias("n6")), "rows_after")
    valid = after.where(F.col("n6") >= min_points).select("unique_id")
    points = chain.where(F.col("stage") == 6).join(valid, "unique_id", "left_semi").select(*CLEAN_COLUMNS)
    return CleanRun(points, _report(before, after, min_points))


def clean_points(matched: DataFrame, speed_limit: float = SPEED_LIMIT_KMH,
                 min_points: int = MIN_POINTS, bucket_s: int | None = None) -> DataFrame:
    """The whole cleaning chain; returns the seven clean columns."""
    return clean_run(matched, speed_limit, min_points, bucket_s).points


def quality_report(matched: DataFrame, speed_limit: float = SPEED_LIMIT_KMH,
                   min_points: int = MIN_POINTS, bucket_s: int | None = None) -> DataFrame:
    """QUALITY_REPORT / DISTINCT_COUNT: rows and trajectories after each stage, as
    ``stage_no, stage, n_rows, n_trajectories`` (``clean_run`` gives the points of the same run)."""
    return clean_run(matched, speed_limit, min_points, bucket_s).report


def _report(before: DataFrame, after: DataFrame, min_points: int) -> DataFrame:
    """Sums of the per-trajectory counts; a trajectory is in a stage when its count is positive."""
    per = before.join(after, "unique_id", "left").withColumn("n7", F.when(F.col("n6") >= min_points, F.col("n6")))
    total = per.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(1, 8)],
                    *[F.count_if(F.col(f"n{i}") > 0).alias(f"t{i}") for i in range(1, 8)])
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("stage_no"), F.lit(n).alias("stage"),
                 F.col(f"n{i}").cast("bigint").alias("n_rows"), F.col(f"t{i}").cast("bigint").alias("n_trajectories"))
        for i, n in enumerate(STAGES, 1)])))
