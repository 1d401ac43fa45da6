"""Repeated passages: words covered by a window that a smaller doc_id also has.

Words are runs outside space and 0x09-0x0D, unchanged; a window is ``window``
consecutive words of one document.

1. Documents with the same words are one class (digest of the words); a copy of
   a smaller doc_id is all repeat, and only the smallest goes on.
2. Every window names an anchor, the smallest hash of its 8-word runs. Equal
   windows have equal anchors, so a window whose anchor occurs in one class only
   is unique. About one anchor per 20 words is shuffled, not every window.
3. Windows with a recurring anchor are compared by 64-bit hash: those in several
   documents are confirmed; the smallest doc_id is their origin. Consecutive
   confirmed windows of an origin form a passage.
4. Passages are dealt to shards by origin. For each shard an Aho-Corasick
   automaton holds aligned blocks of half a window of its passages, as
   sequences of word hashes (any full window of a passage contains a whole block);
   every document with a confirmed window of one of its origins streams through
   it. A found block is extended along the passage; runs of at least a window
   are removed. Shards that many documents need are split by document.

Defined results: null or empty text: no words, nothing removed. Fewer words than
a window: nothing removed. Rows that repeat a doc_id do not repeat each other,
only smaller ids. A null doc_id is neither source nor cut. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, text_batches
from .wordhash import U, Words, row_chunks, run_starts, runs

WINDOW = 50
ANCHOR_WORDS = 8
#: Passage words in one automaton, and bytes of documents streamed through one copy of it.
SHARD_WORDS = 400_000
SPLIT_BYTES = 4 << 20


def _joined(text: bytes) -> bytes:
    return b" ".join(text.split())


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in row_chunks(b.column(1)):
            raw, cut = data.tobytes(), offs.tolist()
            words = [raw[a:z].split() for a, z in zip(cut[:-1], cut[1:])]
            sha = [hashlib.sha256(b" ".join(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array([_key(s.digest()) for s in sha], pa.int64()),
                 pa.array([len(w) for w in words], pa.int64()), pa.array([s.hexdigest() for s in sha])],
                names=["doc_id", "key", "n_words", "sha"])


def _window_anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word position, document index, anchor) of every window."""
    pos, n = run_starts(words.first, window)
    low = runs(words.hash, ANCHOR_WORDS)
    width, span = 1, window - ANCHOR_WORDS + 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span and len(low) > span - width:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    return pos, np.repeat(np.arange(len(n)), n), low[pos] if len(pos) else np.zeros(0, dtype=U)


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in row_chunks(b.column(1)):
                words = Words(data, offs, False)
                _, doc, anchor = _window_anchors(words, window)
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
                doc, anchor = doc[new], anchor[new]
                ids = b.column(0).slice(lo, hi - lo).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), ids], names=["anchor", "doc_id"])
    return run


def _window_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column(2)
            for lo, hi, data, offs in row_chunks(b.column(1)):
                words = Words(data, offs, False)
                pos, doc, anchor = _window_anchors(words, window)
                keep = np.zeros(len(pos), dtype=bool)
                edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                for d in range(hi - lo):
                    a, z = int(edge[d]), int(edge[d + 1])
                    if z > a:
                        keep[a:z] = np.isin(anchor[a:z], np.array(known[lo + d].as_py(), dtype=np.int64).view(U))
                pos, doc = pos[keep], doc[keep]
                h = runs(words.hash, window)[pos] if len(pos) else np.zeros(0, dtype=U)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), b.column(0).slice(lo, hi - lo).take(pa.array(doc)),
                     pa.array((pos - words.first[doc]).astype(np.int32))], names=["window", "doc_id", "pos"])
    return run


def _passage_rows(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text, pos in zip(pdf["doc_id"], pdf["text"], pdf["starts"]):
                words = (text or "").encode().split()
                pos = np.unique(pos)
                pos = pos[pos + window <= len(words)]
                for part in np.split(pos, np.flatnonzero(np.diff(pos) > 1) + 1):
                    if len(part):
                        out.append((doc, b" ".join(words[part[0]:part[-1] + window]).decode()))
            yield pd.DataFrame(out, columns=["origin", "passage"]).astype({"origin": "int64"})
    return run


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(r) for r in raw])
    words = Words(np.frombuffer(b"".join(raw), dtype=np.uint8), offs, False)
    return words.hash, words.first


class PassageFinder:
    """Aho-Corasick automaton over blocks of half a window of the passages."""

    def __init__(self, origins: list[int], passages: list[str], window: int):
        import ahocorasick
        self.window, self.block = window, window // 2
        self.origin = origins
        self.hash, self.first = _word_hashes(passages)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        low = (self.hash & U(0xFFFFFFFF)).tolist()
        for q, (a, z) in enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist())):
            for at in range(a, z - self.block + 1, self.block):
                key = tuple(low[at:at + self.block])
                places = self.automaton.get(key, None)
                if places is None:
                    self.automaton.add_word(key, [(q, at)])
                else:
                    places.append((q, at))
        if len(self.automaton):
            self.automaton.make_automaton()

    def runs_in(self, doc_id: int, h: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges of a document that repeat a passage of a smaller doc_id."""
        if not len(self.automaton):
            return []
        found: list[tuple[int, int]] = []
        done: dict[int, int] = {}  # diagonal of a passage -> word up to which it is settled
        for end, places in self.automaton.iter(tuple((h & U(0xFFFFFFFF)).tolist())):
            start = end - self.block + 1
            for q, at in places:
                diagonal = at - start
                if self.origin[q] >= doc_id or done.get(diagonal, -1) > start:
                    continue
                a, z = int(self.first[q]), int(self.first[q + 1])
                left, right = max(0, a - diagonal), min(len(h), z - diagonal)
                same = h[left:right] == self.hash[left + diagonal:right + diagonal]
                here = start - left
                if not same[here]:
                    continue
                before = np.flatnonzero(~same[:here])
                after = np.flatnonzero(~same[here:])
                lo = left + (int(before[-1]) + 1 if len(before) else 0)
                hi = left + here + int(after[0]) if len(after) else right
                done[diagonal] = hi
                if hi - lo >= self.window:
                    found.append((lo, hi))
        return found


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, z) for a, z in out]


def _find(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["is_passage"]
        finder = PassageFinder(pdf.loc[own, "id"].tolist(), pdf.loc[own, "text"].tolist(), window)
        out = []
        ids, texts = pdf.loc[~own, "id"].tolist(), pdf.loc[~own, "text"].tolist()
        for i in range(0, len(ids), 64):
            h, first = _word_hashes(texts[i:i + 64])
            for j, doc in enumerate(ids[i:i + 64]):
                spans = _merge(finder.runs_in(doc, h[first[j]:first[j + 1]]))
                if spans:
                    key = _key(hashlib.sha256(_joined(texts[i + j].encode())).digest())
                    out += [(doc, key, a, z) for a, z in spans]
        return pd.DataFrame(out, columns=["doc_id", "key", "lo", "hi"]).astype("int64")
    return run


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for doc, text, key, spans in zip(pdf["doc_id"], pdf["text"], pdf["key"], pdf["spans"]):
            words = (text or "").encode().split()
            if _key(hashlib.sha256(b" ".join(words)).digest()) != key:
                continue  # another row of the same doc_id
            kept, at = [], 0
            merged = _merge([(s["lo"], s["hi"]) for s in spans])
            for a, z in merged:
                kept += words[at:a]
                at = z
            kept += words[at:]
            text = b" ".join(kept)
            out.append((doc, key, len(words) - len(kept), hashlib.sha256(text).hexdigest(), text.decode(),
                        [{"lo": a, "hi": z} for a, z in merged]))
        yield pd.DataFrame(out, columns=["doc_id", "key", "n_removed", "kept_sha256", "kept_text", "spans"]).astype(
            {"doc_id": "int64", "key": "int64", "n_removed": "int64"})


SPANS = "array<struct<lo:bigint,hi:bigint>>"


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256,
    spans (removed word ranges, end exclusive) and, where words were removed,
    kept_text (kept words joined by one space)."""
    with text_batches(docs.sparkSession):
        return _cut_repeats(docs, id_col, text_col, window)


def _cut_repeats(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = docs.where("doc_id IS NOT NULL")
    table = materialize(docs.mapInArrow(_digest_rows, "doc_id long, key long, n_words long, sha string"), "digests")
    classes = materialize(table.where("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()

    anchors = materialize(known.mapInArrow(_anchor_rows(window), "anchor long, doc_id long"), "anchors")
    anchors = anchors.join(reps, "doc_id", "left_semi")
    recurring = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a <> z").select("anchor")
    flagged = materialize(anchors.join(recurring, "anchor", "left_semi").groupBy("doc_id").agg(
        F.collect_set("anchor").alias("anchors")), "flagged")
    texts = materialize(known.join(flagged, "doc_id"), "flagged_texts")

    windows = materialize(texts.select("doc_id", "text", "anchors").mapInArrow(
        _window_rows(window), "window long, doc_id long, pos int"), "windows")
    origins = windows.groupBy("window").agg(F.min("doc_id").alias("origin"), F.max("doc_id").alias("last")).where(
        "origin <> last").select("window", "origin")
    placed = materialize(windows.join(origins, "window").groupBy("doc_id", "origin").agg(
        F.collect_set(F.when(F.col("doc_id") == F.col("origin"), F.col("pos"))).alias("starts")), "placed")
    starts = placed.where("doc_id = origin").select("doc_id", "starts")
    passages = materialize(texts.select("doc_id", "text").join(starts, "doc_id").select("doc_id", "text", "starts").mapInPandas(
        _passage_rows(window), "origin long, passage string"), "passages")

    # one number reaches the driver: the passage words
    total = passages.agg(F.sum(F.size(F.split("passage", " ")))).first()[0] or 0
    shards = max(2 * parts, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("origin"), F.lit(shards)).alias("shard")
    routed = materialize(placed.where("doc_id <> origin").select("doc_id", shard).distinct(), "routed")
    lengths = texts.select("doc_id", F.length("text").alias("chars"))
    splits = routed.join(lengths, "doc_id").groupBy("shard").agg(F.ceil(F.sum("chars") / SPLIT_BYTES).cast("long").alias("splits"))
    streams = texts.select("doc_id", "text").join(routed, "doc_id").join(splits, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id"), F.col("splits")).alias("split"), F.col("doc_id").alias("id"), "text",
        F.lit(False).alias("is_passage"))
    dictionary = passages.select(shard, F.col("origin").alias("id"), F.col("passage").alias("text")).join(splits, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("splits", F.lit(1)) - 1)).alias("split"), "id", "text",
        F.lit(True).alias("is_passage"))
    found = materialize(streams.unionByName(dictionary).groupBy("shard", "split").applyInPandas(
        _find(window), "doc_id long, key long, lo long, hi long"), "found")

    spans = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    cut = materialize(texts.select("doc_id", "text").join(spans, "doc_id").mapInPandas(
        _cut, f"doc_id long, key long, n_removed long, kept_sha256 string, kept_text string, spans {SPANS}").dropDuplicates(
        ["doc_id", "key"]), "cut")

    empty = hashlib.sha256(b"").hexdigest()
    copy = F.coalesce((F.col("rep") < F.col("doc_id")) & (F.col("n_words") >= window), F.lit(False))
    return table.join(classes, "sha", "left").join(cut, ["doc_id", "key"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.expr(f"CAST(array(named_struct('lo', 0, 'hi', n_words)) AS {SPANS})")).otherwise(
            F.coalesce("spans", F.expr(f"CAST(array() AS {SPANS})"))).alias("spans"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
