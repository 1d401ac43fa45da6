"""Places of regular-expression matches as native columns.

Spark's regular-expression functions return matches without their places. The
text split at the matches gives the stretches between them, so running totals
of lengths give the places, in code points. Everything here is a column
expression; patterns use Java syntax.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points on either side of a match that are kept as its context.
CONTEXT = 40
_BLOCK = 256


def _scan(values: Column, total=lambda x: x) -> Column:
    """struct(total, out): sum of an array and its exclusive running totals."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.expr("CAST(array() AS array<bigint>)").alias("out"))
    return F.aggregate(values, start, lambda acc, x: F.struct(
        (acc["total"] + total(x)).cast("long").alias("total"),
        F.concat(acc["out"], F.array(acc["total"])).alias("out")))


def running_totals(values: Column) -> Column:
    """Exclusive running totals of an array of numbers, in blocks, so that long
    arrays do not cost the square of their length."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_BLOCK))
    inner = F.transform(starts, lambda s: _scan(F.slice(values, s, _BLOCK)))
    return F.aggregate(F.array(inner), F.expr("CAST(array() AS array<bigint>)"), lambda _, blocks: F.flatten(F.zip_with(
        blocks, _scan(blocks, lambda b: b["total"])["out"],
        lambda b, offset: F.transform(b["out"], lambda x: x + offset))))


def with_matches(df: DataFrame, text: str, out: str, pattern: str, gate: Column | None = None,
                 group: int | None = None, context: int = CONTEXT, measure=F.length) -> DataFrame:
    """Adds ``out``: array of struct(start, end, value, part, before, after) of the
    leftmost non-overlapping matches; ``part`` is the given group (or the whole
    match), ``before``/``after`` the neighbouring text as far as the next match.
    ``gate``: rows to search (a cheap necessary condition); others get no match.
    ``measure``: what places count, by default code points."""
    found, gaps, parts, at = (f"__{out}_{c}" for c in ("found", "gaps", "parts", "at"))
    gate = F.lit(True) if gate is None else gate
    t = F.col(text)
    df = df.withColumn(found, F.when(gate, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))))
    some = F.size(found) > 0
    df = df.withColumn(gaps, F.when(some, F.split(t, pattern, -1)))
    if group is not None:
        df = df.withColumn(parts, F.when(some, F.regexp_extract_all(t, F.lit(pattern), F.lit(group))))
    df = df.withColumn(at, F.when(some, running_totals(F.zip_with(
        found, F.slice(gaps, 1, F.size(found)), lambda m, g: measure(m) + measure(g)))))
    piece = (lambda i, m: F.get(parts, i)) if group is not None else (lambda i, m: m)

    def place(m: Column, i: Column) -> Column:
        start = F.get(at, i) + measure(F.get(gaps, i))
        return F.struct(start.alias("start"), (start + measure(m)).alias("end"), m.alias("value"), piece(i, m).alias("part"),
                        F.right(F.get(gaps, i), F.lit(context)).alias("before"),
                        F.left(F.get(gaps, i + 1), F.lit(context)).alias("after"))

    empty = "CAST(array() AS array<struct<start:bigint,end:bigint,value:string,part:string,before:string,after:string>>)"
    df = df.withColumn(out, F.when(some, F.transform(F.col(found), place)).otherwise(F.expr(empty)))
    return df.drop(found, gaps, parts, at)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (sorted by start) replaced by its kind in angle
    brackets; overlapping spans become the first one's mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        free = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(free, F.concat(acc["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
