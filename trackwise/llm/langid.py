"""Language identification: interpolated Kneser-Ney character models.

Texts become lower-case letters with one space between words. Counts of 4-grams
are taken over all training texts in Arrow batches and summed by Spark; lower
orders follow from them (continuation counts). The models of all languages are
stored together: for each order a sorted array of 64-bit n-gram codes (16 bits a
character, so a code is the n-gram itself) and the interpolated log-probabilities
of each language beside it; unseen n-grams fall back through history weights.
A text gets the language of the lowest cross-entropy a character.

The arrays are broadcast in slices of about ``max_ngrams`` 4-grams at most; a
4-gram's slice follows from its two middle characters, so a slice has all that
its 4-grams need of the orders 3 and 4 (keys and histories). The orders 1 and 2
and the discounts come from Spark and are part of every slice. With several
slices the texts are read once a slice and the sums of each text are added. The rejection limit of a language is a
high quantile of the cross-entropy of its own training texts.

Defined results: null text or text without a letter: und, score 0. Training
texts without letters or language are not learned from; with no training text
everything is und. Ties go to the first language in sorted order. Rows are
independent; a null doc_id counts as not held out and is not learned from. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches
from .wordhash import U, row_chunks

ORDER = 4
#: 4-grams of a slice of the models.
MAX_NGRAMS = 4_000_000
#: Cross-entropy quantile of a language's training texts beyond which a text is rejected.
REJECT_QUANTILE = 0.999
#: Characters that the score takes as independent.
SCORE_CHARS = 20
#: 4-grams a task holds before it condenses its counts.
HELD = 3_000_000


def _char_table() -> np.ndarray:
    """Lower-case code of each 16-bit code point, space for what is no letter."""
    out = np.full(65536, 32, dtype=np.uint16)
    for i in range(65536):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


class Letters:
    """Texts as letter codes, each led by ORDER - 1 spaces and ended by one;
    ``first``: borders of the texts, ``letters``: number of letters in each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        wide = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype=np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        edge = lead[offsets]
        high = wide > 65535
        code = table[np.where(high, 32, wide)]
        if high.any():  # letters beyond 16 bits share the private codes
            astral = {c: 0xE000 + (c & 0x1FFF) if chr(c).isalpha() else 32 for c in np.unique(wide[high]).tolist()}
            code[high] = [astral[c] for c in wide[high].tolist()]
        letter = code != 32
        keep = letter.copy()
        keep[:-1] |= letter[1:]            # the last of the spaces before a letter
        kept = np.concatenate([[0], np.cumsum(keep)])
        count = np.concatenate([[0], np.cumsum(letter)])
        self.letters = count[edge[1:]] - count[edge[:-1]]
        body, cut = code[keep], kept[edge]
        n = np.diff(cut)
        self.first = np.concatenate([[0], np.cumsum(n + ORDER)])
        self.code = np.full(int(self.first[-1]), 32, dtype=np.uint64)
        at = np.arange(len(body)) + np.repeat(self.first[:-1] + ORDER - 1 - cut[:-1], n)
        self.code[at] = body

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all 4-grams, text after text, and their borders."""
        c = self.code
        if len(c) < ORDER:
            return np.zeros(0, dtype=U), np.zeros(len(self.first), dtype=np.int64)
        g = (c[:-3] << U(48)) | (c[1:-2] << U(32)) | (c[2:-1] << U(16)) | c[3:]
        n = np.diff(self.first) - ORDER + 1
        edge = np.concatenate([[0], np.cumsum(n)])
        pos = np.arange(int(edge[-1])) + np.repeat(self.first[:-1] - edge[:-1], n)
        return g[pos], edge


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _char_table()
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def condense() -> None:
        nonlocal size
        size = 0
        for lang, parts in held.items():
            key, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
            held[lang] = [(key, n)]
            size += len(key)

    limit = HELD
    for b in batches:
        langs = b.column(1).to_pylist()
        for lo, hi, data, offs in row_chunks(b.column(0)):
            texts = Letters(data, offs, table)
            g, edge = texts.grams()
            mine = np.array([l or "" for l in langs[lo:hi]])
            mine[texts.letters == 0] = ""
            for lang in np.unique(mine[mine != ""]).tolist():
                part = np.repeat(mine == lang, np.diff(edge))
                key, n = np.unique(g[part], return_counts=True)
                held.setdefault(lang, []).append((key, n))
                size += len(key)
            if size > limit:
                condense()
                limit = max(HELD, 2 * size)
    condense()
    for lang, [(key, n)] in held.items():
        for a in range(0, len(key), 100_000):
            k = key[a:a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)),
                                              pa.array(n[a:a + 100_000])], names=["lang", "gram", "n"])


def slice_of(gram: np.ndarray, slices: int) -> np.ndarray:
    """Slice of each 4-gram, from its middle characters."""
    return (((((gram >> U(16)) & U(0xFFFFFFFF)) * U(40503)) & U(0xFFFFFFFF)) >> U(16)) % U(slices)


def _slice_column(gram: Column, slices: int) -> Column:
    """``slice_of`` as a column."""
    middle = F.shiftrightunsigned(gram, 16).bitwiseAND(0xFFFFFFFF)
    return F.shiftright((middle * 40503).bitwiseAND(0xFFFFFFFF), 16) % slices


class Model:
    """Sorted n-gram arrays of the orders 1 to 4 with one column a language.
    ``shared``: what all slices of a model have in common (vocabulary, types of the
    orders 1 and 2, discounts); without it the arrays hold all 4-grams."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray, shared: dict | None = None):
        self.langs = langs
        width = len(langs)
        vocabulary = shared["vocabulary"] if shared else max(len(np.unique(gram & U(0xFFFF))), 1) + 1
        self.floor = -np.log(vocabulary)
        # per order: types of each language with their (continuation) counts
        per_order: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {ORDER: [(gram[lang == i], count[lang == i]) for i in range(width)]}
        for order in range(ORDER - 1, 0, -1):
            mask = U((1 << (16 * order)) - 1)
            per_order[order] = shared["types"][order] if shared and order < ORDER - 1 else [np.unique(k & mask, return_counts=True) for k, _ in per_order[order + 1]]
        self.keys, self.logp, self.histories, self.weights = {}, {}, {}, {}
        lower = np.full((1, width), 1.0 / vocabulary)
        for order in range(1, ORDER + 1):
            types = per_order[order]
            keys = np.unique(np.concatenate([k for k, _ in types]))
            history = np.unique(keys >> U(16))
            if order == 1:
                below = np.repeat(lower, len(keys), axis=0)
            else:
                below = np.exp(self.logp[order - 1][np.searchsorted(self.keys[order - 1], keys & U((1 << (16 * order - 16)) - 1))])
            first, weight = np.zeros((len(keys), width)), np.ones((len(history), width))
            for i, (k, n) in enumerate(types):
                if not len(k):
                    continue
                n = n.astype(np.float64)
                ones, twos = (n == 1).sum(), (n == 2).sum()
                if shared:
                    ones, twos = shared["low_counts"].get((order, i), (0, 0))
                discount = ones / (ones + 2 * twos) if ones and twos else 0.5
                h = np.searchsorted(history, k >> U(16))
                total = np.bincount(h, weights=n, minlength=len(history))
                cut = np.bincount(h, weights=np.minimum(n, discount), minlength=len(history))
                seen = total > 0
                weight[seen, i] = cut[seen] / total[seen]
                first[np.searchsorted(keys, k), i] = np.maximum(n - discount, 0) / total[h]
            p = first + weight[np.searchsorted(history, keys >> U(16))] * below
            self.keys[order], self.logp[order] = keys, np.log(p).astype(np.float32)
            self.histories[order], self.weights[order] = history, np.log(np.maximum(weight, 1e-30)).astype(np.float32)

    def log_probabilities(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """One row a 4-gram, one column a language."""
        if order == 0:
            return np.full((len(grams), len(self.langs)), self.floor, dtype=np.float32)
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        out = self.logp[order][at]
        absent = np.flatnonzero(keys[at] != grams)
        if len(absent):
            g = grams[absent]
            low = self.log_probabilities(g & U((1 << (16 * order - 16)) - 1), order - 1)
            h = np.minimum(np.searchsorted(self.histories[order], g >> U(16)), len(self.histories[order]) - 1)
            known = self.histories[order][h] == g >> U(16)
            out[absent] = low + np.where(known[:, None], self.weights[order][h], 0)
        return out


def train(texts: DataFrame, text_col: str, lang_col: str, max_ngrams: int = MAX_NGRAMS) -> list[Callable[[], Model]]:
    """One function a slice of the models of all languages, from every text with a
    language; each builds its slice. Empty without a training text."""
    counts = texts.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).mapInArrow(
        _count_rows, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    with text_batches(texts.sparkSession):
        counts = materialize(counts, "grams")
    size = counts.count()
    if not size:
        return []
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    number = {l: i for i, l in enumerate(langs)}

    def arrays(types: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = types.orderBy("lang", "gram").toPandas()
        return table["lang"].map(number).to_numpy(), table["gram"].to_numpy(dtype=np.int64).view(U), table["n"].to_numpy()

    if size <= max_ngrams:
        return [lambda: Model(langs, *arrays(counts))]
    slices = -(-2 * size // max_ngrams)
    types = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        types[order] = materialize(types[order + 1].groupBy(
            "lang", F.col("gram").bitwiseAND((1 << (16 * order)) - 1).alias("gram")).agg(F.count("*").alias("n")), f"grams_{order}")
    shared: dict = {"types": {}, "low_counts": {}, "vocabulary": types[1].select("gram").distinct().count() + 1}
    for order in types:
        for r in types[order].groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect():
            shared["low_counts"][order, number[r["lang"]]] = (r["ones"], r["twos"])
    for order in range(1, ORDER - 1):
        lang, gram, n = arrays(types[order])
        shared["types"][order] = [(gram[lang == i], n[lang == i]) for i in range(len(langs))]

    def build(i: int) -> Callable[[], Model]:
        return lambda: Model(langs, *arrays(counts.where(_slice_column(F.col("gram"), slices) == i)), shared)
    return [build(i) for i in range(slices)]


def _sum_rows(shared, part: int, slices: int):
    """Per row: letters, 4-grams, and the log-probabilities of the slice's 4-grams summed a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = _char_table()
        width = len(model.langs)
        for b in batches:
            for lo, hi, data, offs in row_chunks(b.column(0)):
                texts = Letters(data, offs, table)
                g, edge = texts.grams()
                sums = np.zeros((hi - lo, width))
                for a in range(0, hi - lo, 64):
                    z = min(a + 64, hi - lo)
                    own = g[edge[a]:edge[z]]
                    if slices == 1:
                        p = model.log_probabilities(own).astype(np.float64)
                    else:
                        at = np.flatnonzero(slice_of(own, slices) == part)
                        p = np.zeros((len(own), width))
                        if len(at) and len(model.keys[ORDER]):
                            p[at] = model.log_probabilities(own[at])
                        elif len(at):
                            p[at] = model.log_probabilities(own[at] & U(0xFFFFFFFF), 2)
                    sums[a:z] = np.add.reduceat(p, edge[a:z] - edge[a], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts.letters.astype(np.int64)), pa.array(np.diff(edge).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, width), pa.int32()), pa.array(sums.ravel())),
                     *(b.column(i).slice(lo, hi - lo) for i in range(1, b.num_columns))],
                    names=["letters", "grams", "sums", *b.schema.names[1:]])
    return run


def _predict_rows(langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            letters, n = (b.column(i).to_numpy() for i in (0, 1))
            bits = -b.column(2).flatten().to_numpy().reshape(-1, len(langs)) / n[:, None]
            best = bits.argmin(axis=1)
            own = bits[np.arange(len(n)), best]
            score = 1 / np.exp(-np.minimum(n, SCORE_CHARS)[:, None] * (bits - own[:, None])).sum(axis=1)
            some = letters > 0
            yield pa.RecordBatch.from_arrays(
                [b.column(3), pa.array(np.where(some, np.array(langs)[best], "und")),
                 pa.array(np.where(some, np.clip(score, 0, 1), 0.0)), pa.array(own, mask=~some), b.column(4)],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "learned"])
    return run


_SUMS = "letters long, grams long, sums array<double>, "


def _scored(base: DataFrame, models: list[Callable[[], Model]]) -> DataFrame:
    """Scores of the rows of ``base`` (text, doc_id, learned)."""
    spark = base.sparkSession
    if len(models) > 1:
        base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "texts")
    parts = []
    for i, build in enumerate(models):
        model = build()
        langs = model.langs
        shared = spark.sparkContext.broadcast(model)
        if len(models) == 1:
            sums = base.mapInArrow(_sum_rows(shared, 0, 1), _SUMS + "doc_id long, learned string")
        else:
            parts.append(materialize(base.select("text", "row").mapInArrow(
                _sum_rows(shared, i, len(models)), _SUMS + "row long"), "slice_sums"))
            shared.destroy()
    if parts:
        added = parts[0].select("row", "letters", "grams")
        cells = reduce(DataFrame.unionByName, parts).select("row", F.posexplode("sums").alias("place", "sum")).groupBy(
            "row", "place").agg(F.sum("sum").alias("sum")).groupBy("row").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "sum"))), lambda c: c["sum"]).alias("sums"))
        sums = added.join(cells, "row").join(base.select("row", "doc_id", "learned"), "row").select(
            "letters", "grams", "sums", "doc_id", "learned")
    return materialize(sums.mapInArrow(
        _predict_rows(langs), "doc_id long, lang_pred string, score double, cross_entropy double, learned string"), "languages")


def identify(docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_ngrams: int = MAX_NGRAMS) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy (nats a character), rejected of every row;
    ``learned``: condition of the rows whose language may be learned from."""
    learned = F.coalesce(learned, F.lit(False))
    models = train(docs.where(learned).select(text_col, lang_col), text_col, lang_col, max_ngrams)
    base = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"), F.when(
        learned, F.col(lang_col).cast("string")).alias("learned"))
    if not models:
        return base.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("rejected"))
    with text_batches(docs.sparkSession):
        scored = _scored(base, models)
    limits = scored.where("learned = lang_pred").groupBy("lang_pred").agg(
        F.percentile_approx("cross_entropy", REJECT_QUANTILE, 10_000).alias("limit"))
    return scored.join(F.broadcast(limits), "lang_pred", "left").select(  # limits: one row a language
        "doc_id", "lang_pred", F.round("score", 6).alias("score"), "cross_entropy",
        F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(False)).alias("rejected"))
