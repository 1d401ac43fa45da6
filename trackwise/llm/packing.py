"""Best-fit packing of tokenised documents into fixed-length sequences.

1. Documents are tokenised in Arrow batches; only documents longer than a
   sequence are cut. The pieces (ids left out) are written once.
2. The plan needs only the histogram of piece lengths (at most ``max_tokens``
   rows): best-fit decreasing places *counts* of a length into groups of equally
   filled sequences, so its cost does not depend on the number of documents. It
   yields slots: (length, first rank, end rank, first sequence, offset).
3. Pieces get their rank within their length (salted: local ranks per salt plus
   the sizes of the salts before) and take the slot that holds the rank.

Defined results: null or empty text: one piece with the end token alone.
Repeated rows are packed each on their own. Extra columns are ignored by
``pack`` and kept by no output; a null doc_id is packed as null.
"""

from __future__ import annotations

import bisect
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, text_batches

MAX_TOKENS = 4096
END_ID = 1
#: Words whose ids a task remembers, in each of two generations.
CACHE_WORDS = 400_000


class WordTokens(dict):
    """Ids of white-space separated words as little-endian uint32 bytes.

    For byte-level BPE tokenizers that lower-case, drop white space and split
    letters from punctuation. A word of Latin letters goes straight to the BPE
    model (normalising and splitting would leave its lower-case letters as they
    are); with capitals or ASCII punctuation behind it, its ids are those of the
    lower-case letters and of the punctuation. Other words go through the whole
    tokenizer. Two generations of remembered words bound the memory.
    """

    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")

    NOT_WHITE = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.tokenize = self.model.model.tokenize
        # printable bytes stand for themselves, the others for code points from 256 on
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.byte_chars = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.old: dict[str, bytes] = {}

    def _model_ids(self, word: str) -> bytes:
        """Ids of lower-case letters or of punctuation, as the BPE model gives them."""
        if not word.isascii():
            word = "".join(map(self.byte_chars.__getitem__, word.encode()))
        ids = [x.id for x in self.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            m = self.PLAIN.fullmatch(word)
            if not m:
                if word and not word.isalnum() and all("!" <= c <= "~" and not c.isalnum() for c in word):
                    ids = self._model_ids(word)  # punctuation alone
                else:
                    ids = np.array(self.model.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
            elif (letters := m[1].lower()) == word:
                ids = self._model_ids(word)
            else:
                ids = self[letters] + self[m[2]] if m[2] else self[letters]
        self[word] = ids
        return ids

    def _words(self, text: str) -> list[str]:
        """Split at the tokenizer's white space, which does not hold U+001C to U+001F as ``str.split`` does."""
        return self.NOT_WHITE.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b"".join(map(self.__getitem__, self._words(t))) for t in texts]
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        return out


def _piece_rows(path: str, max_tokens: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # kept by the worker process, so later tasks find the words of earlier ones
        memo = sys.modules.setdefault("_worker_memo", types.ModuleType("_worker_memo")).__dict__
        tokens = memo.setdefault(("words", path), None) or WordTokens(path)
        memo[("words", path)] = tokens
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows: list[tuple] = []
                for doc, raw in zip(part.column(0).to_pylist(),
                                    tokens.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids = raw + end
                    for i, a in enumerate(range(0, len(ids), 4 * max_tokens)):
                        piece = ids[a:a + 4 * max_tokens]
                        rows.append((doc, i, a // 4, len(piece) // 4, zlib.crc32(piece)))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns (length, first_rank, end_rank, first_sequence, offset): piece number
    ``first_rank + i`` of that length goes to sequence ``first_sequence + i``.
    Its size depends on the number of lengths, not of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = {}   # room left -> ranges of sequences (first, count)
    rooms: list[int] = []                         # the keys of free, ascending
    slots: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in free:
                free[room] = []
                bisect.insort(rooms, room)
            free[room].append((first, count))

    def fill(length: int, rank: int, room: int, first: int, count: int, left: int) -> int:
        """Fill ``count`` sequences with as many pieces as fit, at most ``left``."""
        each = room // length
        whole = min(count, left // each)
        for j in range(each if whole else 0):
            slots.append((length, rank + j * whole, rank + (j + 1) * whole, first, capacity - room + j * length))
        used = whole * each
        rest = min(each, left - used) if whole < count else 0
        for j in range(rest):
            slots.append((length, rank + used + j, rank + used + j + 1, first + whole, capacity - room + j * length))
        put(room - each * length, first, whole)
        if rest:
            put(room - rest * length, first + whole, 1)
        put(room, first + whole + (rest > 0), count - whole - (rest > 0))
        return used + rest

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = free[room].pop()
                if not free[room]:
                    del free[room], rooms[at]
            else:
                room, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            done = fill(length, rank, room, first, count, left)
            rank, left = rank + done, left - done
    return slots


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    with text_batches(spark):
        pieces = materialize(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
            _piece_rows(tokenizer_path, max_tokens, end_id),
            "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    salts = 4 * shuffle_partitions(spark)
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts))
    # at most max_tokens rows reach the driver
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(plan_slots(histogram, max_tokens) or [(0, 0, 0, 0, 0)],
                                 "length long, lo long, hi long, first long, offset long")
    pieces = pieces.withColumn("salt", salt)
    sizes = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = pieces.withColumn("local", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("local") + F.col("before"))
    # the plan's size is bounded by max_tokens
    slot = F.broadcast(plan)
    return ranked.join(slot, (ranked["length"] == slot["length"]) & (ranked["rank"] >= slot["lo"]) & (
        ranked["rank"] < slot["hi"])).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")
