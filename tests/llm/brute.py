"""Plain Python twins of the corpus operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    w = SPACE_WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def union(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def near_duplicates(docs):
    """doc_id -> (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in docs}
    groups, by, common = Groups(sets), defaultdict(list), Counter()
    for d, s in sets.items():
        for g in s:
            by[g].append(d)
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            groups.union(a, b)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def contained(docs, items):
    """{(doc_id, item_id, n_item, n_shared)}."""
    out, sets = set(), {i: shingles(t) for i, t in items}
    for d, t in docs:
        own = shingles(t)
        for i, s in sets.items():
            n = len(s & own)
            if s and 100 * n >= 75 * len(s):
                out.add((d, i, len(s), n))
    return out


def cut_repeats(docs, window=50):
    """doc_id -> (n_words, n_removed, kept_sha256)."""
    first, words = {}, {}
    for d, t in sorted(docs):
        words[d] = w = SPACE_WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pii_spans(text):
    """Base spans (start, rank, kind, end)."""
    x, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def secret_spans(text):
    """Base spans (start, rank, kind, end)."""
    x, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", x):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", x):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", x):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, "hex", m.end()))
    return sorted(out)


def license_places(text, phrases):
    """(n_words, sorted (word, label))."""
    w, out = LICENSE_WORD.findall(lower(text)), []
    for phrase, label in phrases:
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, _, k, z in spans).encode()).hexdigest()


def crc_part(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def planted_words(doc_id, text):
    """Words of a document with the repeating words that the contract plants."""
    w = SPACE_WORD.findall(text or "")
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def periodic_runs(w):
    """Sorted (start, length, period), by every lag over all words."""
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                out.setdefault((i, j - i + q), q)  # the smallest period of a stretch comes first
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)
