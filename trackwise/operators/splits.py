"""Seeded, exact, stratified splits and folds; standardisation.

Rows are ordered inside their class by ``md5(key|seed)``; a row's rank in that
order decides its split, so results repeat for the same seed whatever the
partitioning. Ranks are counted in two levels: rows per slice of the hash space
(``prefix_digits`` hex digits, so a class is ranked by up to 16^digits tasks), and
ranks inside a slice; slice counts also give the class sizes.

Sizes: ``ceil(fraction * rows)`` over all rows, dealt to the classes by largest
remainder (ties by class name); a class always keeps one row for training.
Membership differs from scikit-learn's shuffles by design; sizes follow the same
rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 3


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def ranked(df: DataFrame, key: str, seed: int, strata: list[str], prefix_digits: int = PREFIX_DIGITS) -> DataFrame:
    """Add ``_rank`` (0-based, by seeded hash, per stratum) and ``_n`` (stratum size)."""
    d = df.withColumn("_h", hash_order(key, seed)).withColumn("_slice", F.substring("_h", 1, prefix_digits))
    # nulls are a stratum of their own, so join on a text that is never null
    name = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in strata]) if strata else F.lit("")
    d = d.withColumn("_stratum", name)
    slices = d.groupBy("_stratum", "_slice").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_stratum")
    slices = slices.select("_stratum", "_slice",
                           (F.sum("_c").over(w.orderBy("_slice")) - F.col("_c")).alias("_before"), F.sum("_c").over(w).alias("_n"))
    d = d.join(slices, ["_stratum", "_slice"])
    inside = F.row_number().over(Window.partitionBy("_stratum", "_slice").orderBy("_h", key)) - 1
    return d.withColumn("_rank", F.col("_before") + inside).drop("_before", "_h", "_slice", "_stratum")


def _allocate(classes: DataFrame, label: str, size: str, fraction: float, out: str) -> DataFrame:
    """Deals ``ceil(fraction * total of size)`` to the classes by largest remainder;
    no class gives its last row. One row per class, so the windows are small."""
    everything = Window.partitionBy()
    c = classes.withColumn("_total", F.sum(size).over(everything))
    c = c.withColumn("_goal", F.ceil(F.col("_total") * F.lit(float(fraction))))
    c = c.withColumn("_cap", F.greatest(F.col(size) - 1, F.lit(0)))
    c = c.withColumn("_base", F.least(F.floor(F.expr(f"(_goal * {size}) div _total")), F.col("_cap")))
    c = c.withColumn("_left", F.col("_goal") - F.sum("_base").over(everything))
    turn = F.row_number().over(Window.partitionBy((F.col("_base") < F.col("_cap")).alias("_open")).orderBy(
        F.expr(f"(_goal * {size}) % _total").desc(), F.col(label)))
    more = (F.col("_base") < F.col("_cap")) & (turn <= F.col("_left"))
    return c.withColumn(out, F.col("_base") + more.cast("int")).drop("_total", "_goal", "_cap", "_base", "_left")


def _class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_size"))


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """STRAT_SPLIT: adds ``split`` in {'train', 'test'}."""
    d = ranked(df, key, seed, [label])
    sizes = _allocate(_class_sizes(df, label), "_class", "_size", test, "_test")
    d = d.join(sizes, d[label].eqNullSafe(sizes["_class"]))
    return d.withColumn("split", F.when(F.col("_rank") < F.col("_test"), "test").otherwise("train")) \
            .drop("_rank", "_n", "_class", "_size", "_test")


def three_way_split(df: DataFrame, label: str, key: str, test: float = 0.15, val: float = 0.176,
                    seed: int = 3407) -> DataFrame:
    """SPLIT_3WAY: adds ``split`` in {'train','val','test'}; stratified unless a
    class has fewer than 2 rows before either stage, then one random (seeded)
    split over all rows."""
    sizes = _allocate(_class_sizes(df, label), "_class", "_size", test, "_test")
    sizes = sizes.withColumn("_rest", F.col("_size") - F.col("_test"))
    # one row: the smallest class before each stage
    least = sizes.agg(F.min("_size").alias("a"), F.min("_rest").alias("b"), F.sum("_size").alias("n")).first()
    if least["a"] is not None and least["a"] >= 2 and least["b"] >= 2:
        sizes = _allocate(sizes, "_class", "_rest", val, "_val")
        d = ranked(df, key, seed, [label])
        d = d.join(sizes, d[label].eqNullSafe(sizes["_class"]))
        n_test, n_val = F.col("_test"), F.col("_val")
    else:
        d = ranked(df, key, seed, [])
        n_test = F.ceil(F.col("_n") * F.lit(test))
        n_val = F.ceil((F.col("_n") - n_test) * F.lit(val))
    return d.withColumn("split", F.when(F.col("_rank") < n_test, "test").when(F.col("_rank") < n_test + n_val, "val")
                        .otherwise("train")).drop("_rank", "_n", "_class", "_size", "_test", "_val", "_rest")


def kfold(df: DataFrame, label: str, key: str, k: int = 3, seed: int = 42) -> DataFrame:
    """KFOLD: adds ``fold`` = rank in class mod k (stratified, balanced folds)."""
    d = ranked(df, key, seed, [label])
    return d.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank", "_n")


def fit_standardiser(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """STANDARDISE (fit): ``{col: (mean, population std)}`` from one aggregate row."""
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def apply_standardiser(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """STANDARDISE (apply): ``(x - mean) / std``; a constant column gives 0."""
    out = {}
    for c, (m, s) in stats.items():
        out[c] = (F.lit(0.0) if not s else (F.col(c) - F.lit(m)) / F.lit(s)).cast("double")
    return df.withColumns(out)
