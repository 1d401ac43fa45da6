"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A row weighs the UTF-8 bytes of its text plus 1 (null text: 0 bytes plus 1); rows
with equal texts are one group and share a shard. Law: ``bytes`` - the shards'
sizes are as near as the groups allow.

1. Every row becomes (id, size, checksum, 64-bit hash of its text), written once; the
   texts are read no more.
2. Sizes are summed per group (partial sums first, so a group that holds a third of
   all rows is no hot key). Groups of over 1 / ``LARGE_SHARE`` of all bytes are items of
   their own: fewer than ``LARGE_SHARE`` exist. The others are gathered into
   ``BUNDLES`` bundles by hash; a bundle is an item. So the plan has at most
   ``BUNDLES + LARGE_SHARE`` items for any input, and small inputs have about one
   group a bundle.
3. Differencing: an item starts as a partial partition (its size in one part, 0 in
   the others). The two partial partitions with the largest spread (largest part
   less smallest) are combined, the largest part of one with the smallest of the
   other, until one is left.
4. Rows look up the shard of their large group or bundle (broadcast plan) and are
   numbered within their shard: local ranks per salt plus the sizes of the salts
   before, so no shard is one task.

Defined results: null and empty texts are one group of size 1 a row. Repeated rows
are rows of one group; each has a slot. A null id is placed like any other.
Extra columns are ignored. An empty table gives no row. Two texts with equal
64-bit hashes would share a shard, no more.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions

SHARDS = 16
BUNDLES = 1 << 14
LARGE_SHARE = 1 << 12


def differencing(sizes: list[int], parts: int) -> list[int]:
    """Part of each item: the two partial partitions with the largest spread are
    combined in opposite order until one is left. Parts are numbered by falling size."""
    if not sizes:
        return []
    # an entry: (-spread, number, parts as (size above the smallest, members)), largest part first;
    # members: an item, a pair of members or None
    heap = [(-size if parts > 1 else 0, i, [(size if parts > 1 else 0, i), *[(0, None)] * (parts - 1)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        both = [(x + y, n if m is None else m if n is None else (m, n)) for (x, m), (y, n) in zip(a, reversed(b))]
        both.sort(key=lambda part: -part[0])
        least = both[-1][0]
        heapq.heappush(heap, (least - both[0][0], number, [(x - least, m) for x, m in both]))
        number += 1
    out = [0] * len(sizes)
    for part, (_, members) in enumerate(heap[0][2]):
        todo = [members]
        while todo:
            m = todo.pop()
            if isinstance(m, tuple):
                todo += m
            elif m is not None:
                out[m] = part
    return out


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   bundles: int = BUNDLES, large_share: int = LARGE_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot (from 0 in each shard)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group")), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0

    large = F.col("bytes") > F.lit(total / large_share)
    bundle = F.pmod(F.col("group"), F.lit(bundles).cast("long"))
    items = rows.groupBy("group").agg(F.sum("size").alias("bytes")).select(
        large.alias("large"), F.when(large, F.col("group")).otherwise(bundle).alias("item"), "bytes").groupBy("large", "item").agg(
        F.sum("bytes").alias("bytes"))
    # at most bundles + large_share rows reach the driver
    items = sorted((-r["bytes"], r["large"], r["item"]) for r in items.collect())
    parts = differencing([-b for b, _, _ in items], shards)

    def plan(of_large: bool, key: str, out: str) -> DataFrame:
        found = [(i, p) for (_, is_large, i), p in zip(items, parts) if is_large == of_large]
        return F.broadcast(spark.createDataFrame(found, f"{key} long, {out} int"))

    placed = rows.withColumn("bundle", bundle).join(plan(True, "group", "own"), "group", "left").join(
        plan(False, "bundle", "shared"), "bundle", "left").withColumn("shard", F.coalesce("own", "shared"))
    salts = 4 * shuffle_partitions(spark)
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "group", F.pmod(F.xxhash64("doc_id", "group"), F.lit(salts)).alias("salt"))
    before = placed.groupBy("shard", "salt").agg(F.count("*").alias("n")).select("shard", "salt", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("salt")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "group")) - 1
    return placed.withColumn("local", local).join(before, ["shard", "salt"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("local") + F.col("before")).alias("slot"))
