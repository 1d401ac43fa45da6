"""Secrets in texts: fixed patterns, and strings that look random.

Base kinds (always reported): assign (a value given to a password-like name, 12
characters or more), access (key ids), hex (16 or more). The method adds kind
``random``: long tokens whose characters follow a Markov model of random strings
better than one of ordinary identifiers.

Both models are first-order over 64 characters, trained by counting: random
strings are the values of the base matches, ordinary ones the words of all
texts outside the matches (labelled by the base rules), each as often as it occurs. Counts are add-one
smoothed; the table of log-likelihood ratios has a fixed size (characters
squared) and enters the plan as one constant array. A token's score is its mean
ratio a character, put on 0 to 1.

Defined results: null text is empty and has no spans. Places are code points,
end exclusive; for assign the whole match. ``random`` spans do not overlap base
spans. With nothing to train on, both models are uniform and no random span is
found. Rows are independent, extra columns are kept; columns named as the
outputs are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import with_matches

# Fixed patterns: name, pattern, necessary pattern, group that holds the secret, least length of it.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     r"(?i:password|passwd|secret|token|api_?key)", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}+", r"AKIA[A-Z0-9]{14}", None, 18),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}+", r"[0-9a-f]{16}", None, 16),
)
BASE_KINDS = tuple(b[0] for b in BASE)
#: Candidate tokens of the method: 20 or more characters, a digit and a letter among them.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20})(?=[+/_-]*+[A-Za-z]*+[+/_A-Za-z-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+"
TOKEN_GATE = r"[A-Za-z0-9+/_-]{20}"
#: Mean log-likelihood ratio a character from which a token is reported.
MIN_RATIO = 0.5
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
_STATES = len(ALPHABET) + 1  # 0 stands for the start and for other characters


def _states(token: Column) -> Column:
    """Alphabet positions of a token's characters, a start state first."""
    return F.concat(F.array(F.lit(0)), F.transform(
        F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)))


def _pairs(token: Column) -> Column:
    """Codes of consecutive state pairs."""
    s = _states(token)
    return F.zip_with(F.slice(s, 1, F.length(token)), F.slice(s, 2, F.length(token)), lambda a, b: a * _STATES + b)


#: Words that ordinary text is learned from: whole runs of four characters or more.
ORDINARY = r"[A-Za-z0-9_]{4,}+"


def _base_spans(df: DataFrame, text: str, prefix: str) -> tuple[DataFrame, list[str]]:
    columns = []
    for rank, (kind, pattern, gate, group, least) in enumerate(BASE):
        name = f"{prefix}{kind}"
        df = with_matches(df, text, name, pattern, F.col(text).rlike(gate), group)
        df = df.withColumn(name, F.transform(F.filter(F.col(name), _long_enough(least)), _as_span(rank, kind)))
        columns.append(name)
    return df, columns


def _long_enough(least: int):
    return lambda m: F.length(m["part"]) >= least


def _as_span(rank: int, kind: str):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                              m["end"].alias("end"), m["part"].alias("value"), F.lit(1.0).alias("score"))


def train(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratios (random over ordinary) of each pair of states, from
    every text. The result has ``_STATES`` squared entries."""
    df = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    df, columns = _base_spans(df, "t", "b_")
    df = df.select("t", F.transform(F.concat(*columns), lambda s: s["value"]).alias("hits"))
    def marked(tokens: Column, random: int) -> Column:
        return F.transform(tokens, lambda v: F.struct(v.alias("token"), F.lit(random).alias("random")))

    words = F.regexp_extract_all("t", F.lit(ORDINARY), F.lit(0))
    apart = F.when(F.size("hits") == 0, words).otherwise(
        F.filter(words, lambda w: ~F.exists("hits", lambda h: F.contains(h, w))))
    tokens = df.select(F.explode(F.concat(marked(F.col("hits"), 1), marked(apart, 0))).alias("x")).select("x.*").groupBy(
        "random", "token").agg(F.count("*").alias("n"))
    counts = tokens.select("random", "n", F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("random", "pair").agg(
        F.sum("n").alias("n")).collect()  # at most 2 * _STATES squared rows
    table = [[1.0] * _STATES ** 2 for _ in range(2)]
    for r in counts:
        table[r["random"]][r["pair"]] += r["n"]
    out = []
    for a in range(_STATES):
        rows = [t[a * _STATES:(a + 1) * _STATES] for t in table]
        sums = [sum(r) for r in rows]
        out += [round(math.log(rows[1][b] / sums[1]) - math.log(rows[0][b] / sums[0]), 5) for b in range(_STATES)]
    return out


def mean_ratio(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's characters."""
    table = F.split(F.lit(" ".join(map(str, ratios))), " ").cast("array<double>")
    total = F.aggregate(_pairs(token), F.lit(0.0), lambda acc, p: acc + F.get(table, p))
    return total / F.greatest(F.length(token), F.lit(1))


def find_secrets(docs: DataFrame, ratios: list[float], text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with ``out``: array of struct(start, rank, kind, end, value, score)
    sorted by start, then kind; ``ratios`` from ``train``."""
    text, raw = "__sec_text", "__sec_token"
    df = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df, columns = _base_spans(df, text, "__sec_")
    df = with_matches(df, text, raw, TOKEN, F.col(text).rlike("[0-9]") & F.col(text).rlike(TOKEN_GATE))
    base = F.concat(*columns)

    def span(m: Column) -> Column:
        ratio = mean_ratio(m["value"], ratios)
        return F.struct(m["start"].alias("start"), F.lit(len(BASE)).alias("rank"), F.lit("random").alias("kind"),
                        m["end"].alias("end"), m["value"].alias("value"), F.round(1 / (1 + F.exp(-4 * ratio)), 4).alias("score"))

    least = round(1 / (1 + math.exp(-4 * MIN_RATIO)), 4)
    df = df.withColumn("__sec_base", base)
    df = df.withColumn(raw, F.filter(F.transform(F.filter(F.col(raw), lambda m: ~F.exists(
        F.col("__sec_base"), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))), span), lambda s: s["score"] >= least))
    return df.withColumn(out, F.array_sort(F.concat(F.col("__sec_base"), F.col(raw)))).drop(text, raw, "__sec_base", *columns)
