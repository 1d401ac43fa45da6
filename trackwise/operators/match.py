"""INTERVAL_JOIN: GPS points x label intervals of the same user.

Each point meets every label of its user with ``start <= ts <= end`` (both
ends inclusive); overlapping labels duplicate the point, a label spanning two
files gives two trajectories.

Plan: time is cut into bins (a day by default). A label's bins are covered by dyadic
nodes: node (level, k) holds the bins k * 2^level to (k + 1) * 2^level - 1, and at
most two nodes of a level are needed, so a label of n bins costs at most 2 log2(n)
rows (ten years of days: under 30). A point looks up the node of its bin at each level
that some label uses. The join is an equi-join on ``(user_id, level, node)`` with the
exact range as residual; the nodes of a label are disjoint, so no pair is produced
twice. The label rows are written and counted: up to ``BROADCAST_ROWS`` they are
broadcast and the points are not shuffled, beyond that both sides are (a user's
points are spread over the nodes; AQE splits a node that stands out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import traj_key
from ..session import materialize
from .ordered import time_bucket

# Default bin width of the interval join: one day.
JOIN_BIN_S = 86400
#: Largest number of label rows that is broadcast (about 60 bytes each).
BROADCAST_ROWS = 1_000_000


def dyadic_nodes(df: DataFrame, first: str, last: str) -> DataFrame:
    """Explode the bins ``first..last`` (bigint, inclusive) into disjoint dyadic nodes
    ``_level, _node``; no row when ``last < first``.

    At a level, the whole nodes inside are ``[lo, hi)`` with lo = ceil(first / 2^level)
    and hi = floor((last + 1) / 2^level). The level keeps lo if it is odd, and hi - 1 if
    hi is odd: the others join their neighbour one level up.
    """
    nodes = F.expr(f"""
        flatten(transform(sequence(0, CAST(ceil(log2(greatest({last} - {first} + 1, 1))) AS INT)), l ->
          transform(filter(
            array(struct(-shiftright(-{first}, l) AS lo, shiftright({last} + 1, l) AS hi, true AS low),
                  struct(-shiftright(-{first}, l) AS lo, shiftright({last} + 1, l) AS hi, false AS low)),
            e -> e.lo < e.hi AND IF(e.low, e.lo, e.hi) % 2 <> 0),
            e -> struct(l AS _level, IF(e.low, e.lo, e.hi - 1) AS _node))))""")
    return df.select("*", F.inline(nodes))


def match_points(points: DataFrame, labels: DataFrame, bin_s: int = JOIN_BIN_S) -> DataFrame:
    """Matched points with ``unique_id`` and ``transport_mode``.

    ``points``: ``user_id, plt_idx, line_no, ts, lat, lon, altitude``.
    ``labels``: ``user_id, label_idx, start_ts, end_ts, transport_mode``.
    """
    lab = labels.select("user_id", "label_idx", "start_ts", "end_ts", "transport_mode",
                        time_bucket("start_ts", bin_s).alias("_first"), time_bucket("end_ts", bin_s).alias("_last"))
    lab = materialize(dyadic_nodes(lab, "_first", "_last").drop("_first", "_last"), "label_nodes")
    n, used = lab.agg(F.count(F.lit(1)), F.bit_or(F.expr("shiftleft(1L, _level)"))).first()  # a bit for each level
    lab = F.broadcast(lab) if n <= BROADCAST_ROWS else lab.hint("merge")
    here = F.array(*[F.struct(F.lit(l).alias("_level"), F.shiftright("_bin", l).alias("_node")) for l in range(63) if (used or 1) >> l & 1])
    pts = points.withColumn("_bin", time_bucket("ts", bin_s)).select("*", F.inline(here))
    j = pts.join(lab, on=[pts.user_id == lab.user_id, pts._level == lab._level, pts._node == lab._node,
                          pts.ts >= lab.start_ts, pts.ts <= lab.end_ts], how="inner")
    return j.select(
        traj_key(pts.user_id, lab.label_idx, pts.plt_idx).alias("unique_id"),
        pts.user_id, pts.plt_idx, lab.label_idx, pts.line_no, pts.ts,
        pts.lat, pts.lon, pts.altitude, lab.transport_mode)
