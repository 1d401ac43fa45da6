"""Ordered point sequences per trajectory (SEQ_BUILD, SEQ_BUILD_LABELLED, DOWNSAMPLE).

A sequence is stored in parts: one row per ``(unique_id, part)`` where the
part is an hour bucket of event time, holding that hour's points in time
order. Concatenating the parts in ``part`` order gives the whole sequence, so
no single row or task ever has to hold a whole long trajectory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import point_line
from .ordered import time_bucket

#: Width of a sequence part: one hour of event time.
PART_S = 3600


def sequence_parts(clean: DataFrame, bucket_s: int = PART_S) -> DataFrame:
    """SEQ_BUILD: ``unique_id, part, time_sequence array<struct<ts,lat,lon>>``."""
    return (clean.withColumn("part", time_bucket("ts", bucket_s))
                 .groupBy("unique_id", "part")
                 .agg(F.sort_array(F.collect_list(F.struct("ts", "lat", "lon"))).alias("time_sequence")))


def first_label(clean: DataFrame) -> DataFrame:
    """FIRST_LABEL: mode of the earliest point with a mode, per trajectory."""
    return (clean.where(F.col("transport_mode").isNotNull())
                 .groupBy("unique_id")
                 .agg(F.min_by("transport_mode", "ts").alias("label")))


def labelled_sequence_parts(clean: DataFrame, bucket_s: int = PART_S) -> DataFrame:
    """SEQ_BUILD_LABELLED: ``unique_id, part, time_sequence array<struct<lat,lon>>, label``.

    The label is the first non-null mode of the whole trajectory.
    """
    parts = sequence_parts(clean, bucket_s).select(
        "unique_id", "part",
        F.transform("time_sequence", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
         .alias("time_sequence"))
    return parts.join(first_label(clean), "unique_id", "left")


def part_text(parts: DataFrame) -> DataFrame:
    """POINT_TEXT per part: newline-joined ``(lat, lon, time)`` lines, in order."""
    return parts.select(
        "unique_id", "part",
        F.size("time_sequence").alias("n_points"),
        F.array_join(F.transform("time_sequence", lambda p: point_line(p["lat"], p["lon"], p["ts"])),
                     "\n").alias("text"))


def downsample(clean: DataFrame, max_points: int = 2000, seed: int = 3407) -> DataFrame:
    """DOWNSAMPLE: trajectories over ``max_points`` keep first, last and
    ``max_points - 2`` middle points chosen by a seeded hash; time order kept.

    Deterministic, unlike a random sample. The middle points are ranked by
    ``md5(unique_id|ts|seed)``. The first ``k`` of a trajectory lie in the lowest
    hashes, so points are counted per slice of the hash space (slices grow with
    the trajectory, about ``k`` points each); whole slices below the k-th point
    are kept and only the slice that holds it is ranked. No window spans a
    trajectory, whatever its length.
    """
    ends = clean.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))
    d = clean.join(ends, "unique_id")
    small = d.where(F.col("_n") <= max_points)
    big = d.where(F.col("_n") > max_points)
    is_end = (F.col("ts") == F.col("_t0")) | (F.col("ts") == F.col("_t1"))
    h = F.md5(F.concat_ws("|", F.col("unique_id"),
                          F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(str(seed))))
    k = max_points - 2
    mid = big.where(~is_end).withColumn("_h", h)
    # slice number: the first 52 bits of the hash scaled to about n / k slices, in hash order
    part = F.conv(F.substring("_h", 1, 13), 16, 10).cast("double") / float(1 << 52)
    mid = mid.withColumn("_s", F.floor(part * F.ceil(F.col("_n") / max(k, 1))))
    per = mid.groupBy("unique_id", "_s").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("unique_id").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).where(F.col("_before") < k)
    mid = mid.join(per, ["unique_id", "_s"])
    w = Window.partitionBy("unique_id", "_s").orderBy("_h", "ts")
    middle = (mid.withColumn("_r", F.col("_before") + F.row_number().over(w)).where(F.col("_r") <= k)
                 .drop("_r", "_h", "_s", "_c", "_before"))
    out = small.unionByName(big.where(is_end)).unionByName(middle)
    return out.drop("_n", "_t0", "_t1")
