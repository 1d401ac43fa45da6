"""Ordered per-key work that never puts one whole long key into one task.

A window ``partitionBy(key).orderBy(ts)`` sends every row of a key to one
task; with a hot key holding a third of all rows that task never ends. Both
helpers here cut long keys into time buckets:

1. the ordered window runs per ``(key, bucket)``: bounded groups;
2. one row per ``(key, bucket)`` carries what crosses the bucket edge (the
   bucket's last rows, or its total), read off a window on the same
   partitioning;
3. a window per key over that small bucket table passes the carry forward;
4. an equi-join on ``(key, bucket)`` fixes up the first rows of each bucket.

Buckets are counted (``counted_buckets``): a key of at most ``BUCKET_ROWS`` rows is
one bucket and needs no carry at all; a longer key is cut into the widest time
spans (powers of ``FAN_OUT`` seconds) that hold no more, however dense or sparse
it is. Every bucket's parent span holds over ``BUCKET_ROWS`` rows, so the carry table
has at most ``FAN_OUT * SPANS / BUCKET_ROWS`` rows per input row. Fixed widths can be
asked for with ``bucket_s``. The results equal the plain per-key window exactly, for
any buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Width of a fixed bucket, where one is asked for by name only: one day of event time.
DEFAULT_BUCKET_S = 86400
#: Rows of a key that one bucket may hold.
BUCKET_ROWS = 50_000
#: Spans over ``BUCKET_ROWS`` that a table may have before buckets grow: keeps the
#: tables of such spans small enough to be broadcast (about 40 bytes a row).
MOST_SPANS = 200_000
#: Children of a span (a power of two), and span widths: one second to 136 years.
FAN_OUT, SPANS = 16, 9
#: The span that is counted first: about 18 hours.
COUNTED_SPAN = 4


def time_bucket(ts: str | Column, bucket_s: int = DEFAULT_BUCKET_S) -> Column:
    """Integer bucket of a timestamp: floor(epoch micros / width)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(bucket_s * 1_000_000)).cast("bigint")


def counted_buckets(df: DataFrame, keys: Sequence[str], ts: str, rows: int | None = None,
                    bucket_col: str = "_bkt", cut_col: str = "_cut", sizes: DataFrame | None = None) -> DataFrame:
    """Add ``bucket_col`` (first second of the row's span; 0 for a key in one bucket) and
    ``cut_col`` (whether the key has several buckets).

    Rows per key are counted first (a partial aggregation over narrow rows, unless
    ``sizes`` has them as ``_n``; two numbers reach the driver). Only if a key is long, rows per key and
    ``COUNTED_SPAN`` are counted and written; wider spans add those counts up, shorter
    spans are counted only inside spans that hold too many rows. Each level's spans over
    the limit are few (at most one per ``rows`` rows; the limit grows where there would be
    more than ``MOST_SPANS``) and are broadcast.
    """
    keys = list(keys)
    if not keys:
        return counted_buckets(df.withColumn("_all", F.lit(0)), ["_all"], ts, rows, bucket_col, cut_col).drop("_all")
    step = FAN_OUT.bit_length() - 1
    second = time_bucket(ts, 1)

    def node(level: int, of: Column) -> Column:
        return F.shiftright(of, step * level)

    sizes = sizes or df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(rows or BUCKET_ROWS, (total or 0) // MOST_SPANS)
    if (largest or 0) <= limit:
        return df.withColumns({bucket_col: F.lit(0).cast("bigint"), cut_col: F.lit(False)})

    counts = materialize(df.select(*keys, node(COUNTED_SPAN, second).alias("_at")).groupBy(*keys, "_at").agg(
        F.count(F.lit(1)).alias("_n")), "bucket_counts")
    long_keys = materialize(counts.groupBy(*keys).agg(F.sum("_n").alias("_n")).where(F.col("_n") > limit).select(*keys), "long_keys")
    same = lambda a, b, more=(): [a[k].eqNullSafe(b[k]) for k in (*keys, *more)]
    counts = counts.join(F.broadcast(long_keys), same(counts, long_keys), "left_semi")
    full: dict[int, DataFrame] = {}   # level -> spans over the limit
    for level in range(SPANS - 1, 0, -1):
        if level >= COUNTED_SPAN:
            n = counts.select(*keys, F.shiftright("_at", step * (level - COUNTED_SPAN)).alias("_node"), "_n")
        else:
            above = full[level + 1]
            own = df.select(*keys, node(level, second).alias("_node"), node(level + 1, second).alias("_up"))
            n = own.join(F.broadcast(above), [*same(own, above), own["_up"] == above["_node"]], "left_semi").select(
                *keys, "_node", F.lit(1).alias("_n"))
        over = n.groupBy(*keys, "_node").agg(F.sum("_n").alias("_n")).where(F.col("_n") > limit).select(*keys, "_node")
        over = materialize(over, "full_spans")
        if not over.limit(1).count():
            break
        full[level] = over

    def flagged(d: DataFrame, table: DataFrame, name: str, at: Column | None = None) -> DataFrame:
        t = table.withColumn(name, F.lit(True)).withColumnsRenamed({k: f"{name}_{k}" for k in table.columns})
        on = [d[k].eqNullSafe(t[f"{name}_{k}"]) for k in keys]
        if at is not None:
            on.append(at == t[f"{name}__node"])
        return d.join(F.broadcast(t), on, "left").drop(*(c for c in t.columns if c != name))

    out = flagged(df, long_keys, "_f_key")
    for level, table in full.items():
        out = flagged(out, table, f"_f_{level}", node(level, second))
    # the span below the narrowest full one; the widest span where none is full
    start = lambda level: F.shiftleft(node(level, second), step * level)
    bucket = F.when(F.col("_f_key").isNull(), F.lit(0).cast("bigint"))
    for level in sorted(full):
        bucket = bucket.when(F.col(f"_f_{level}").isNotNull(), start(level - 1))
    return out.withColumns({bucket_col: bucket.otherwise(start(SPANS - 1)), cut_col: F.col("_f_key").isNotNull()}).drop(
        "_f_key", *(f"_f_{level}" for level in full))


def in_buckets(df: DataFrame, keys: Sequence[str], ts: str, bucket_s: int | None = None,
               bucket_col: str = "_bkt", cut_col: str = "_cut", sizes: DataFrame | None = None) -> DataFrame:
    """``counted_buckets``, or buckets of a fixed width with ``bucket_s``."""
    if bucket_s is None:
        return counted_buckets(df, keys, ts, bucket_col=bucket_col, cut_col=cut_col, sizes=sizes)
    return df.withColumns({bucket_col: time_bucket(ts, bucket_s), cut_col: F.lit(True)})


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                  prefix: str = "prev_", bucket_s: int | None = None,
                  bucket_col: str = "_bkt", prefix2: str | None = None, cut_col: str = "_cut") -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` in the previous row of the same key and,
    with ``prefix2``, ``prefix2 + c`` = its value in the row before that.

    ``order[0]`` must be a timestamp; the rest are tie-breakers making the
    order total. The first rows of each key get nulls, as ``lag`` would. A frame that
    has ``bucket_col`` and ``cut_col`` already (``in_buckets``) keeps them; else
    counted buckets are made, or those of width ``bucket_s``, and dropped again.
    """
    keys = list(keys)
    order = list(order)
    cols = list(cols)
    has_bucket = bucket_col in df.columns
    d = df if has_bucket else in_buckets(df, keys, order[0], bucket_s, bucket_col, cut_col)
    w_in = Window.partitionBy(*keys, bucket_col).orderBy(*order)
    w_all = w_in.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumn("_rn_in", F.row_number().over(w_in)).withColumn("_row", F.struct(*cols))
    d = d.withColumn("_p1", F.lag("_row").over(w_in)).withColumn("_last", F.last("_row").over(w_all))
    if prefix2:
        d = d.withColumn("_p2", F.lag("_row", 2).over(w_in)).withColumn("_last2", F.last("_p1").over(w_all))

    # one row per bucket: its last rows, passed on to the next bucket of the key
    w_b = Window.partitionBy(*keys).orderBy(bucket_col)
    carry = d.where((F.col("_rn_in") == 1) & F.col(cut_col)).select(*keys, bucket_col, "_last", *(["_last2"] if prefix2 else []))
    carry = carry.withColumn("_carry", F.lag("_last").over(w_b))
    if prefix2:
        carry = carry.withColumn("_carry2", F.coalesce(F.lag("_last2").over(w_b), F.lag("_last", 2).over(w_b)))
    carry = carry.where(F.col("_carry").isNotNull()).drop("_last", "_last2")

    out = d.join(carry, on=[*keys, bucket_col], how="left")
    first, second = F.col("_rn_in") == 1, F.col("_rn_in") == 2
    out = out.withColumn("_p1", F.when(first, F.col("_carry")).otherwise(F.col("_p1")))
    if prefix2:
        out = out.withColumn("_p2", F.when(first, F.col("_carry2")).when(second, F.col("_carry")).otherwise(F.col("_p2")))
    for c in cols:
        out = out.withColumn(prefix + c, F.col("_p1." + c))
        if prefix2:
            out = out.withColumn(prefix2 + c, F.col("_p2." + c))
    out = out.drop("_carry", "_carry2", "_rn_in", "_row", "_p1", "_p2", "_last", "_last2")
    return out if has_bucket else out.drop(bucket_col, cut_col)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: dict[str, str], bucket_s: int | None = None,
                bucket_col: str = "_bkt", bucket: Column | None = None) -> DataFrame:
    """Add inclusive running sums ``values = {out_col: in_col}`` per key in order.

    Two-level prefix sum: running sum inside each ``(key, bucket)`` plus the
    total of all earlier buckets of that key. ``bucket`` may be any column that
    is monotone in ``order`` (default: counted buckets of ``order[0]``, or of width
    ``bucket_s``); ``keys`` may be empty for one global order.
    """
    keys = list(keys)
    order = list(order)
    d = df.withColumns({bucket_col: bucket, "_cut": F.lit(True)}) if bucket is not None else in_buckets(
        df, keys, order[0], bucket_s, bucket_col)
    w_ord = Window.partitionBy(*keys, bucket_col).orderBy(*order)
    w_in = w_ord.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = w_ord.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumn("_rn_in", F.row_number().over(w_ord))
    for out_c, in_c in values.items():
        d = d.withColumn("_in_" + out_c, F.sum(in_c).over(w_in))
        d = d.withColumn("_tot_" + out_c, F.sum(in_c).over(w_all))
    tots = d.where((F.col("_rn_in") == 1) & F.col("_cut")).select(
        *keys, bucket_col, *["_tot_" + o for o in values])
    w_b = (Window.partitionBy(*keys).orderBy(bucket_col)
           .rowsBetween(Window.unboundedPreceding, -1))
    offs = tots.select(*keys, bucket_col, *[F.sum("_tot_" + o).over(w_b).alias("_off_" + o) for o in values])
    out = d.join(offs, on=[*keys, bucket_col], how="left")
    for o in values:
        out = (out.withColumn(o, F.col("_in_" + o) + F.coalesce("_off_" + o, F.lit(0)))
                  .drop("_in_" + o, "_off_" + o, "_tot_" + o))
    return out.drop(bucket_col, "_rn_in", "_cut")
