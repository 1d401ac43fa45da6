"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["materialize", "read_table", "shuffle_partitions", "text_batches", "component_stars", "connected_components"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch where rows hold whole texts or sets.
TEXT_BATCH_ROWS = 1000


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> Iterator[None]:
    """Smaller Arrow batches for plans made and run inside the block, so that a
    batch of long texts stays small in the executor and in its Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def component_stars(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(src, dst) of every vertex of ``edges`` (src, dst: bigint) that reaches a
    smaller id: itself once and the smallest id it reaches, which is no src.

    Alternating large-star and small-star steps: every step replaces each edge by
    an edge to the smallest neighbour, so hubs shrink to stars and the edge count
    never grows. Minima combine map-side; the join back on a hub is one that AQE
    can split. Each round is written to the shared checkpoint folder; only a count
    reaches the driver. Edges that form stars end it, without a round that repeats
    them: a round costs the driver five shuffles, the look at the ends one.
    """
    def star(near: DataFrame) -> DataFrame:
        return near.join(near.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low")), "src")

    def large_star(e: DataFrame) -> DataFrame:
        near = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        return star(near).where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))

    def small_star(e: DataFrame) -> DataFrame:
        return star(e).select(F.inline(F.array(*[F.struct(F.col(c).alias("src"), F.col("low").alias("dst")) for c in ("src", "dst")]))).where(
            "src <> dst").distinct()

    def are_stars(e: DataFrame) -> bool:
        ends = e.select(F.inline(F.array(*[F.struct(F.col(c).alias("id"), F.lit(up).alias("up")) for c, up in (("src", 1), ("dst", 0))])))
        seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
        return not seen.where("up > 1 OR (up = 1 AND n > 1)").agg(F.count("*")).first()[0]

    a, b = F.col("src").cast("long"), F.col("dst").cast("long")
    e = materialize(edges.where(a != b).select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")), "cc")
    for _ in range(max_rounds):
        if are_stars(e):
            return e
        e = materialize(small_star(large_star(e)), "cc")
    raise RuntimeError("connected_components did not converge")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id per vertex of ``edges`` (src, dst: bigint).

    Returns (id, component), one row per vertex that has an edge to another
    vertex (see ``component_stars``).
    """
    stars = component_stars(edges.select("src", "dst").distinct(), max_rounds).select(F.col("src").alias("id"), F.col("dst").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
