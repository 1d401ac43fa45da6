"""Vectorised hashing of words, shingles and word windows over Arrow strings.

A column of texts is seen as one byte buffer; NumPy finds the word borders and
hashes every word of every document at once. Words are runs of bytes outside
space and 0x09-0x0D, so they never cut a UTF-8 character. Hashes are 64 bits:
a polynomial over random byte codes, then an avalanche step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_PRIME = 0xD1342543DE82EF95
_INVERSE = pow(_PRIME, -1, 1 << 64)
CHUNK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche 64-bit values (splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_CODES = mix((np.arange(256, dtype=U) + U(1)) * U(0x9E3779B97F4A7C15))
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[65:91] = _CODES[97:123]
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_powers = {"up": np.ones(1, dtype=U), "down": np.ones(1, dtype=U)}


def _power(n: int, kind: str) -> np.ndarray:
    """The first n powers of the prime ("up") or of its inverse ("down")."""
    if len(_powers[kind]) < n:
        a = np.full(max(n, 1 << 16), _PRIME if kind == "up" else _INVERSE, dtype=U)
        a[0] = 1
        _powers[kind] = np.cumprod(a, dtype=U)
    return _powers[kind][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its row offsets; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    o = o.astype(np.int64)
    if not len(o):
        o = np.zeros(1, dtype=np.int64)
    d = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def row_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) pieces of about ``max_bytes``; a
    longer text is one piece, never cut."""
    data, offs = text_buffer(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


class Words:
    """Word borders (``start``, ``end``: byte offsets), 64-bit ``hash`` of each
    word, and ``first``: index of each document's first word (one more entry
    than documents)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        sep = _SEPARATOR[data]
        begin = ~sep
        stop = begin.copy()
        begin[1:] &= sep[:-1]
        stop[:-1] &= sep[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        begin[inner] = ~sep[inner]
        stop[inner - 1] = ~sep[inner - 1]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        total = np.zeros(len(data) + 1, dtype=U)
        np.cumsum((_LOWER_CODES if lower else _CODES)[data] * _power(len(data), "up"), out=total[1:])
        down = _power(len(data) + 1, "down")
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])
        self.first = np.searchsorted(self.start, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries (documents are not told apart)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    total = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum(hashes * _power(len(hashes), "up"), out=total[1:])
    return mix((total[k:] - total[:n]) * _power(n, "down"))


def run_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which k words of one document start, and the number
    of such positions per document."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    base = np.cumsum(n) - n
    pos = np.arange(int(n.sum()), dtype=np.int64) + np.repeat(first[:-1] - base, n)
    return pos, n


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingles, document after document, and the border
    indices. A document of fewer words has its whole sequence as one shingle; an
    empty one has none."""
    pos, n = run_starts(words.first, k)
    h = runs(words.hash, k)[pos]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array([int(runs(words.hash[words.first[d]:words.first[d + 1]], int(counts[d]))[0]) for d in short], dtype=U)
        h = np.insert(h, (np.cumsum(n) - n)[short], mix(extra + counts[short].astype(U)))
        n = n.copy()
        n[short] = 1
    edge = np.concatenate([[0], np.cumsum(n)])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a > 1:
            h[a:b].sort()
    keep = np.ones(len(h), dtype=bool)
    if len(h):
        keep[1:] = h[1:] != h[:-1]
        keep[edge[:-1][n > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], kept[edge]
