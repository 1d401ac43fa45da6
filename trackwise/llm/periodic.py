"""Periodic runs of words: found by recursive frequency splitting and a lag scan.

Words are runs outside space and 0x09-0x0D, unchanged. A run is a stretch of
consecutive words of one document with smallest period q (words q apart are
equal) and at least max(``MIN_LENGTH``, ``MIN_REPEATS`` * q) words that no
neighbouring word extends keeping the period.

1. A run holds each of its words ``MIN_REPEATS`` times at least. A word that
   occurs less often in the current segment (at first the document) joins no run:
   it splits the segment. The parts are judged again by the occurrences inside
   them, until nothing splits; parts shorter than ``MIN_LENGTH`` go. Occurrences
   are looked up in tables of the next and previous places of the same word, so a
   round never counts anew. All documents of a chunk are split together; a segment
   that is not settled after ``ROUNDS`` is searched from both ends, which costs the
   shorter part of every split.
2. Surviving segments are scanned by lags, in scales: for periods in (k/2, k], a
   block of k words recurs inside its run first after exactly one period, so the
   distance to its next occurrence names the lag, and consecutive places with
   the same lag are the run. Blocks are numbered exactly by doubling. A segment of
   m words costs O(m log^2 m), whatever its periods.

Words are told apart by 64-bit hashes. Every document is searched whole, by one
task; documents do not meet, so there is no shuffle and no hot key.

Defined results: null or empty text: no words, no run, empty ``collapsed_text``.
Rows that repeat an id, or have none, are each judged alone. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .wordhash import U, Words, mix, row_chunks

MIN_LENGTH = 24
MIN_REPEATS = 3
#: Rounds in which all segments are split together.
ROUNDS = 12

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _grouped(key: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Values that are equal where key and group are."""
    return mix(key ^ mix(group.astype(U) + U(1)))


def _places(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All positions of the ranges [lo, lo + n)."""
    return np.arange(int(n.sum()), dtype=np.int64) + np.repeat(lo - (np.cumsum(n) - n), n)


class Frequent:
    """Which words occur ``MIN_REPEATS`` times between two borders.

    ``first[t], last[t]`` are, for every place, the ends of the t-th group of
    ``MIN_REPEATS`` successive occurrences of its word that holds the place.
    """

    def __init__(self, key: np.ndarray):
        size = len(key)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        self.first = np.full((MIN_REPEATS, size), -1, dtype=np.int64)
        self.last = np.full((MIN_REPEATS, size), size, dtype=np.int64)
        if size < MIN_REPEATS:
            return
        begin = np.flatnonzero(sorted_key[MIN_REPEATS - 1:] == sorted_key[:size - MIN_REPEATS + 1])
        for t in range(MIN_REPEATS):
            at = order[begin + t]
            self.first[t, at] = order[begin]
            self.last[t, at] = order[begin + MIN_REPEATS - 1]

    def holds(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        ok = np.zeros(len(at), dtype=bool)
        for t in range(MIN_REPEATS):
            ok |= (self.first[t, at] >= lo) & (self.last[t, at] < hi)
        return ok


def _split_from_ends(frequent: Frequent, lo: int, hi: int) -> list[tuple[int, int]]:
    """Settled parts of one segment; each split costs its shorter part."""
    first, last = frequent.first[:, lo:hi].T.tolist(), frequent.last[:, lo:hi].T.tolist()

    def rare(i: int, a: int, z: int) -> bool:
        return not any(f >= a and g < z for f, g in zip(first[i - lo], last[i - lo]))

    todo, settled = [(lo, hi)], []
    while todo:
        a, z = todo.pop()
        if z - a < MIN_LENGTH:
            continue
        i, j, cut = a, z - 1, -1
        while i <= j:
            if rare(i, a, z):
                cut = i
                break
            if rare(j, a, z):
                cut = j
                break
            i, j = i + 1, j - 1
        if cut < 0:
            settled.append((a, z))
        else:
            todo += [(a, cut), (cut + 1, z)]
    return settled


def frequency_segments(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Maximal parts of the ranges [lo, hi) of ``key`` in which every word occurs
    ``MIN_REPEATS`` times, of at least ``MIN_LENGTH`` words, in order. Words of
    different ranges must have different keys."""
    frequent = Frequent(key)
    settled: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        long = hi - lo >= MIN_LENGTH
        lo, hi = lo[long], hi[long]
        if not len(lo):
            break
        n = hi - lo
        at = _places(lo, n)
        ok = frequent.holds(at, np.repeat(lo, n), np.repeat(hi, n))
        begin = np.cumsum(n) - n
        whole = np.logical_and.reduceat(ok, begin)
        settled.append((lo[whole], hi[whole]))
        ok[np.repeat(whole, n)] = False
        edge = np.zeros(len(ok), dtype=bool)
        edge[begin] = True
        starts = ok.copy()
        starts[1:] &= ~ok[:-1] | edge[1:]
        ends = ok.copy()
        ends[:-1] &= ~ok[1:] | edge[1:]
        lo, hi = at[starts], at[ends] + 1
    else:
        rest = [s for a, z in zip(lo.tolist(), hi.tolist()) for s in _split_from_ends(frequent, a, z)]
        settled.append((np.array([a for a, _ in rest], dtype=np.int64), np.array([z for _, z in rest], dtype=np.int64)))
    if not settled:
        return lo, hi
    lo, hi = (np.concatenate(x) for x in zip(*settled))
    order = np.argsort(lo)
    return lo[order], hi[order]


def lag_scan(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs inside the segments [lo, hi), by start and period."""
    n = hi - lo
    place = _places(lo, n)                       # of each word of a segment, in the chunk
    segment = np.repeat(np.arange(len(n)), n)
    end = np.repeat(np.cumsum(n), n)
    size = len(place)
    number = np.unique(_grouped(key[place], segment), return_inverse=True)[1].astype(np.int64)
    at = np.arange(size, dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    base, width = MIN_LENGTH // MIN_REPEATS, 1
    while size:
        half, width = width, 2 * width
        least = MIN_LENGTH if width <= base else MIN_REPEATS * (half + 1)
        at = at[(at + width <= end[at]) & (n[segment[at]] >= least)]
        if not len(at):
            break
        pair = number[at] * size + number[at + half]
        order = np.argsort(pair, kind="stable")
        pair, by = pair[order], at[order]
        new = np.ones(len(by), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        number = np.zeros(size, dtype=np.int64)
        number[by] = np.cumsum(new)
        if width < base:
            continue
        again = ~new[1:]
        here, lag = by[:-1][again], (by[1:] - by[:-1])[again]
        near = (lag <= width) & (lag > (0 if width == base else half))
        here, lag = here[near], lag[near]
        order = np.argsort(here)
        here, lag = here[order], lag[order]
        if not len(here):
            continue
        head = np.ones(len(here), dtype=bool)
        head[1:] = (here[1:] != here[:-1] + 1) | (lag[1:] != lag[:-1])
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(here)) - 1
        length = here[last] - here[first] + width + lag[first]
        keep = length >= np.maximum(MIN_LENGTH, MIN_REPEATS * lag[first])
        found.append((place[here[first]][keep], length[keep], lag[first][keep]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document index, start in the document, length, period) of all runs of a chunk."""
    counts = words.counts()
    key = _grouped(words.hash, np.repeat(np.arange(len(counts)), counts))
    first = np.asarray(words.first, dtype=np.int64)
    start, length, period = lag_scan(words.hash, *frequency_segments(key, first[:-1], first[1:]))
    doc = np.searchsorted(first, start, side="right") - 1
    return doc, start - first[doc], length, period


def _collapsed(words: list[bytes], start: list[int], length: list[int], period: list[int]) -> bytes:
    """Words that no run holds behind its first period, joined by one space."""
    kept, at = [], 0
    for lo, hi in sorted((s + p, s + n) for s, n, p in zip(start, length, period)):
        if hi > at:
            kept += words[at:max(lo, at)]
            at = hi
    return b" ".join(kept + words[at:])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in row_chunks(b.column(1)):
            words = Words(data, offs, False)
            doc, start, length, period = runs_of(words)
            raw, cut = data.tobytes(), offs.tolist()
            edge = np.searchsorted(doc, np.arange(hi - lo + 1))
            texts = []
            for d, (a, z) in enumerate(zip(cut[:-1], cut[1:])):
                own = slice(int(edge[d]), int(edge[d + 1]))
                texts.append(_collapsed(raw[a:z].split(), start[own].tolist(), length[own].tolist(), period[own].tolist()))
            runs = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(words.counts(), pa.int64()), runs,
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed_text"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (by start and period; words
    counted from 0) and collapsed_text (words without those that a run holds
    behind its first period, joined by one space)."""
    with text_batches(docs.sparkSession):
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
            _run_rows, f"doc_id long, n_words long, runs array<{RUN}>, collapsed_text string")


def strongest_run(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equals, null without runs."""
    return F.reduce(runs, F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def planted_runs(text: Column, seed: Column) -> Column:
    """Text in which, for one seed in ten, the words from a place on repeat with a period.

    With g = seed div 10 and n words: for seed mod 10 = 0 and n > 0, word i >= a
    becomes word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n, g = F.size(words).cast("long"), F.floor(seed / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    times = F.ceil((n - a) / p).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), times))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(cycle, F.lit(1), (n - a).cast("int"))), " ")
    return F.when((seed % 10 == 0) & text.isNotNull() & (F.size(words) > 0), planted).otherwise(text)
