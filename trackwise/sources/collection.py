"""Features of GeoJSON FeatureCollections, read in splits.

A collection is one JSON document, often one line. The files are cut at closing braces
(Spark's text source with that separator), so a large file is read by many tasks. What
a piece means depends on the text before it: whether it starts inside a string, and how
deep in objects. Both are sums over the pieces before, taken within each split under
either assumption about the split's start; one row a split then carries them along the
file. A piece that opens an object below the root starts a feature if the last root
member named before it is ``features``; pieces up to the closing brace are joined.

Files are UTF-8. A file without a ``features`` array has none; null entries of the
array are counted and give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Rest of a string after its first quote, the closing quote excluded.
_REST = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
#: Text up to a brace that is outside strings.
_UP_TO_BRACE = rf'[^"{{]*+(?:"{_REST}"[^"{{]*+)*+'


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _opened(text: Column) -> Column:
    """Opening braces outside strings; the text starts outside a string."""
    return _count(F.regexp_replace(text, rf'(?s)"{_REST}(?:"|\z)', ""), "{")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece: file, split, at (order within the split), text, quote (1 if the piece
    enters or leaves a string), open0 and open1 (objects it opens if it starts outside or
    inside a string), inside (whether it starts inside a string if its split starts outside);
    if the split starts outside (0) or inside (1) a string: step0, step1, the piece's change
    of depth, and depth0, depth1, that of the split's pieces before."""
    text = F.col("text")
    before = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    p = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    p = p.withColumns({"quote": _count(F.regexp_replace(text, r"(?s)\\.", ""), '"') % 2,
                       "open0": _opened(text), "open1": _opened(F.concat(F.lit('"'), text))})
    p = p.withColumn("inside", F.coalesce(F.sum("quote").over(before), F.lit(0)) % 2)

    def step(start: int) -> Column:
        within = (F.col("inside") + start) % 2
        closes = (within + F.col("quote")) % 2 == 0  # the brace that ends the piece is outside strings
        return F.when(within == 1, F.col("open1")).otherwise(F.col("open0")) - closes.cast("int")

    p = p.withColumns({f"step{i}": step(i) for i in (0, 1)})
    p = p.withColumns({f"depth{i}": F.coalesce(F.sum(f"step{i}").over(before), F.lit(0)) for i in (0, 1)})
    return materialize(p, "pieces")


def _object_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces of objects below the root, cut at the object's opening brace: file, split,
    at, text, opens, nulls (entries skipped before the object), and within the split: place
    (entries up to the object) and named (whether the last root member named is ``features``)."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy("file", "split").agg(
        *(F.sum(c).alias(c) for c in ("quote", "step0", "step1")))
    splits = splits.withColumn("starts_in", F.coalesce(F.sum("quote").over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("base", F.coalesce(F.sum(F.when(F.col("starts_in") == 1, F.col("step1")).otherwise(
        F.col("step0"))).over(earlier), F.lit(0))).select("file", "split", "starts_in", "base")
    text, prefix = F.col("text"), F.col("prefix")
    p = pieces.join(splits, ["file", "split"]).select(
        "file", "split", "at", "text", ((F.col("inside") + F.col("starts_in")) % 2 == 1).alias("in_string"), "open0", "open1",
        (F.col("base") + F.when(F.col("starts_in") == 1, F.col("depth1")).otherwise(F.col("depth0"))).alias("depth"))
    p = p.withColumn("opens", (F.col("depth") <= 1) & (
        F.col("depth") + F.when(F.col("in_string"), F.col("open1")).otherwise(F.col("open0")) >= 2))
    p = p.where("opens OR depth >= 2").withColumn("prefix", F.when(F.col("opens"), F.when(
        F.col("depth") <= 0, F.regexp_extract("text", rf"(?s)^({_UP_TO_BRACE}\{{{_UP_TO_BRACE})\{{", 1)).when(
        F.col("in_string"), F.regexp_extract("text", rf'(?s)^({_REST}"{_UP_TO_BRACE})\{{', 1)).otherwise(
        F.regexp_extract("text", rf"(?s)^({_UP_TO_BRACE})\{{", 1))))
    up_to = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = F.when(prefix.contains('"'), prefix.rlike(r'(?<!\\)"features"\s*:\s*\[[^"\]]*\z'))
    nulls = F.coalesce(F.regexp_count(F.regexp_extract(prefix, r'[^"\[]*\z', 0), F.lit("null")), F.lit(0))
    p = p.select("file", "split", "at", "opens", names.alias("names"), F.when(F.col("opens"), nulls).alias("nulls"),
                 F.when(F.col("opens"), F.substr(text, F.length(prefix) + 1)).otherwise(text).alias("text"))
    return materialize(p.withColumns({
        "place": F.coalesce(F.sum(F.col("nulls") + 1).over(up_to), F.lit(0)),
        "named": F.last("names", ignorenulls=True).over(up_to)}), "object_pieces")


def collection_features(spark: SparkSession, path: str) -> DataFrame:
    """file, i (place in its collection, from 0), text: the JSON of every feature."""
    p = _object_pieces(_pieces(spark, path))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = p.groupBy("file", "split").agg(F.sum(F.col("nulls") + 1).alias("entries"), F.max_by("named", "at").alias("last_named"))
    splits = splits.select("file", "split", F.coalesce(F.sum("entries").over(earlier), F.lit(0)).alias("base"),
                           F.last("last_named", ignorenulls=True).over(earlier).alias("named_before"))
    p = p.join(splits, ["file", "split"]).where(F.coalesce("named", "named_before", F.lit(False))).select(
        "file", "split", "at", "text", "opens", "nulls", (F.col("base") + F.col("place")).alias("place"))
    first = p.where("opens").groupBy("file").agg(F.min(F.struct("place", "nulls")).alias("first"))
    whole = p.groupBy("file", "place").agg(F.array_sort(F.collect_list(F.struct("split", "at", "text"))).alias("parts"))
    return whole.join(first, "file").select(
        "file", (F.col("place") - F.col("first.place") + F.col("first.nulls")).alias("i"),
        F.concat(F.array_join(F.transform("parts", lambda x: x["text"]), "}"), F.lit("}")).alias("text"))
