"""Near-duplicate documents: exact Jaccard join on word shingles by parity sketches.

A document's set is its distinct k-word shingles. Documents with equal sets form
one class (only they send the key of their set with their words). Every size band has a space of parts: hash ranges of the shingles.
A part's word is the XOR (parity) of its shingle hashes, so each shingle in only
one of two sets changes the word of one part: the number of differing parts is
at most the symmetric difference, which for similarity t and sizes a, b is at
most (1-t)/(1+t) * (a+b). With more filled parts than that bound, two similar
sets agree in at least one filled part (pigeonhole); sets with too few filled
parts also emit each shingle alone. So no similar pair is missed. The same count bounds the
words that a set shares with any set it resembles: sets that share fewer go
before anything else is read about them. Documents emit
words in the space of their own band and of the band above; bands are so wide
that two similar sets are at most one band apart.

Part words travel as packed arrays, one row per chunk of documents and bucket of
words. Documents that share a word are candidates; no pairs are listed within a
group: first every document is checked against the best hub it meets (the
document that shares most words), then against the hubs of the words that still
join several components, and last across components only, where parity bit sketches (Hamming distance is at
most the symmetric difference) discard pairs before the exact check. The exact
check compares shingle hashes (64 bits).

Defined results: null or empty text, or text without words: empty set, linked
with nothing. Fewer than k words: the whole sequence is the one shingle. Rows
that repeat a doc_id count as copies of that id. A null doc_id is linked with
nothing and is its own component (null). Extra columns are ignored by
``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import component_stars, materialize, shuffle_partitions, text_batches
from .wordhash import U, Words, mix, row_chunks, shingle_sets

SHINGLE_WORDS = 5
#: Similarity threshold as a fraction num / den.
THRESHOLD = (75, 100)
#: Part words that a task holds before it writes them out, and about those of a bucket.
FLUSH_WORDS = 1_000_000
BUCKET_WORDS = 1_000_000
#: Documents checked against one hub in one task.
HUB_BLOCK = 256
#: Bits of the map of the documents whose sets are read (a fixed megabyte).
FILTER_BITS = 1 << 23
#: Rows (word, document) of a group whose sketches are compared.
GROUP_ROWS = 20_000
#: Documents of a word beyond which they are dealt to blocks, and about those of a block.
BLOCK_ROWS = 5_000
#: 64-bit sketch words compared at a time.
SKETCH_CELLS = 2_000_000
_ALONE = U(0x5851F42D4C957F2D)


def _diff_bound(total: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """Largest symmetric difference of two similar sets whose sizes sum to ``total``."""
    return (t[1] - t[0]) * total // (t[1] + t[0])


def _bands(largest: int, t: tuple[int, int]) -> np.ndarray:
    """Lower size limits of the bands; a partner of a set in band i is in i-1, i or i+1."""
    lows = [1]
    while lows[-1] <= largest:
        lows.append(t[1] * lows[-1] // t[0] + 1)
    lows.append(t[1] * lows[-1] // t[0] + 1)
    lows.append(t[1] * lows[-1] // t[0] + 1)
    return np.array(lows, dtype=np.int64)


def part_words(sets: np.ndarray, edge: np.ndarray,
               t: tuple[int, int] = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, set index, space, least) emitted by each of the sets
    ``sets[edge[i]:edge[i+1]]`` (sorted 64-bit hashes). Space 0: own band, 1: the
    band above, 2: single shingles. ``least[i, space]``: how many of its words of
    that space a set shares at least with any set that it resembles and meets
    there (its filled parts less the largest possible difference)."""
    size = np.diff(edge)
    least = np.ones((len(size), 3), dtype=np.int64)
    if not len(sets):
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), least
    lows = _bands(int(size.max()), t)
    owner = np.repeat(np.arange(len(size)), size)
    body = mix(sets + U(0x9E3779B97F4A7C15))
    words, owners, spaces, thin = [], [], [], np.zeros(len(size), dtype=bool)
    for up in (0, 1):
        band = np.searchsorted(lows, size, side="right") - 1 + up
        band = np.maximum(band, 0)
        top = lows[band + 1] - 1
        bound = _diff_bound(2 * top, t)
        parts = np.ceil(1.15 * bound + 2 * np.sqrt(bound)).astype(np.int64) + 2
        part = ((sets >> U(32)) * parts[owner].astype(U)) >> U(32)
        new = np.ones(len(sets), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        who = owner[at]
        place = mix(band[who].astype(U) * U(0xA0761D6478BD642F) + part[at] + U(1))
        words.append(mix(np.bitwise_xor.reduceat(body, at) ^ place))
        owners.append(who)
        filled = np.bincount(who, minlength=len(size))
        partner = np.minimum(top, t[1] * size // t[0])
        spaces.append(np.full(len(at), up))
        least[:, up] = np.maximum(filled - _diff_bound(size + partner, t), 1)
        thin |= filled < _diff_bound(size + partner, t) + 1
    alone = thin[owner]
    words.append(mix(sets[alone] ^ _ALONE))
    owners.append(owner[alone])
    spaces.append(np.full(int(alone.sum()), 2))
    return np.concatenate(words), np.concatenate(owners), np.concatenate(spaces), least


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Parity bits: each shingle flips one; 8 to 16 bits per shingle, a power of two."""
    bits = 1 << max(6, int(8 * len(hashes) - 1).bit_length())
    flips = np.bincount((mix(hashes ^ U(0x2545F4914F6CDD1D)) & U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def _pack_ids(ids: np.ndarray) -> bytes:
    """The smallest id, then the distances from it in 4 bytes each, or 8 if they need it."""
    low = int(ids.min())
    far = (ids.astype(U) - U(low % (1 << 64)))
    return np.int64(low).tobytes() + far.astype(np.uint32 if int(far.max()) < 1 << 32 else U).tobytes()


def _unpack_ids(raw: bytes, n: int) -> np.ndarray:
    far = np.frombuffer(raw, dtype=np.uint32 if len(raw) == 8 + 4 * n else U, offset=8)
    return (far.astype(U) + np.frombuffer(raw, dtype=U, count=1)).view(np.int64)


def set_key(sums: np.ndarray) -> np.ndarray:
    """The two sums of each set as one 64-bit number."""
    return mix(sums[0] ^ mix(sums[1])).view(np.int64)


def set_sums(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Two 64-bit sums that identify each set, as two rows."""
    f = np.zeros((2, len(h) + 1), dtype=U)
    np.cumsum(mix(h), out=f[0, 1:])
    np.cumsum(mix(h ^ _ALONE), out=f[1, 1:])
    return f[:, edge[1:]] - f[:, edge[:-1]]


def _set_rows(k: int, t: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in row_chunks(b.column(1)):
                h, edge = shingle_sets(Words(data, offs, True), k)
                n = np.diff(edge)
                f = set_sums(h, edge).view(np.int64)
                least = part_words(h, edge, t)[3]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(f[0]), pa.array(f[1]),
                     pa.array(least[:, 0]), pa.array(least[:, 1])], names=["doc_id", "n_shingles", "f1", "f2", "least0", "least1"])
    return run


def _word_rows(k: int, t: tuple[int, int], buckets: int, copied: np.ndarray):
    """Part words by bucket, from rows (id, text, bit). Only documents whose bit is set in
    ``copied`` (they may have copies) send the key of their set along; they come first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        ids: list[np.ndarray] = []
        docs = count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal docs, count
            if not held:
                return
            w = np.concatenate([x for x, _ in held])
            who = np.concatenate([x for _, x in held])
            doc = np.concatenate(ids)
            held.clear()
            ids.clear()
            docs = count = 0
            bucket = ((w >> U(32)) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            low = (w & U(0xFFFFFFFF)).astype(np.uint32)[order]
            who = who[order]
            rows: dict[str, list] = {"bucket": [], "words": [], "who": [], "docs": [], "sets": []}
            for i in np.flatnonzero(np.diff(cut)).tolist():
                a, z = int(cut[i]), int(cut[i + 1])
                own, local = np.unique(who[a:z] >> 2, return_inverse=True)
                single = doc[own, 2] == 0
                first = np.argsort(single, kind="stable")
                local, own = np.argsort(first)[local], own[first]
                rows["bucket"].append(i)
                rows["words"].append(low[a:z].tobytes())
                rows["who"].append((local * 4 + (who[a:z] & 3)).astype(np.uint32 if len(own) > 16383 else np.uint16).tobytes())
                rows["docs"].append(_pack_ids(doc[own, 0]))
                rows["sets"].append(doc[own[:len(own) - int(single.sum())], 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["bucket"], pa.int32())] + [pa.array(rows[c], pa.binary()) for c in ("words", "who", "docs", "sets")],
                names=list(rows))

        for b in batches:
            for lo, hi, data, offs in row_chunks(b.column(1)):
                h, edge = shingle_sets(Words(data, offs, True), k)
                w, who, space, _ = part_words(h, edge, t)
                id_ = b.column(0).slice(lo, hi - lo)
                known = ~np.asarray(id_.is_null())[who]
                held.append((w[known], ((who + docs) * 4 + space)[known]))
                maybe = passes(copied, b.column(2).slice(lo, hi - lo).fill_null(0).to_numpy(zero_copy_only=False))
                ids.append(np.column_stack([id_.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), set_key(set_sums(h, edge)), maybe]))
                docs += hi - lo
                count += len(w)
                if count >= FLUSH_WORDS:
                    yield from flush()
        yield from flush()
    return run


def _shared_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: words held by several sets, one row per set (the smallest
    doc_id of its copies), with the space."""
    words, tags, places = [], [], []
    for w, who in zip(pdf["words"], pdf["who"]):
        words.append(np.frombuffer(w, dtype=np.uint32))
        who = np.frombuffer(who, dtype=np.uint16 if len(who) == 2 * len(words[-1]) else np.uint32)
        tags.append((who & 3).astype(np.uint8))
        places.append(who >> 2)
    sizes = [int(p.max()) + 1 for p in places]
    docs = np.concatenate([_unpack_ids(d, n) for d, n in zip(pdf["docs"], sizes)])
    # a document without copies is told apart by its id, the others by the key of their set
    keyed = np.concatenate([np.arange(n) < len(s) // 8 for s, n in zip(pdf["sets"], sizes)])
    keys = docs.copy()
    keys[keyed] = np.frombuffer(b"".join(pdf["sets"]), dtype=np.int64)
    # number the sets; each has the smallest doc_id of its copies, which hold the same words
    order = np.lexsort((docs, keys, keyed))
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]) | (keyed[order[1:]] != keyed[order[:-1]])
    number = np.zeros(len(docs), dtype=U)
    number[order] = np.cumsum(new) - 1
    docs = docs[order[new]]
    place = np.concatenate([p.astype(np.int64) + base for p, base in zip(places, np.cumsum([0] + sizes))])
    w, tag = np.concatenate(words), np.concatenate(tags)
    key = (w.astype(U) << U(32)) | number[place]
    order = np.argsort(key, kind="stable")
    key, tag = key[order], tag[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    w, tag, doc = (key[first] >> U(32)), tag[first], docs[(key[first] & U(0xFFFFFFFF)).astype(np.int64)]
    at = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])[:len(w)])
    size = np.diff(np.append(at, len(w)))
    many = np.repeat(size > 1, size)
    bucket = np.int64(pdf["bucket"].iloc[0]) << np.int64(32)
    return pd.DataFrame({"word": w[many].astype(np.int64) | bucket, "doc": doc[many], "space": tag[many].astype(np.int32)})


def _bit_of(id_: str):
    return F.pmod(F.xxhash64(id_), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, id_col: str) -> np.ndarray:
    """Bit map of the hashed ids: FILTER_BITS bits whatever their number. A row
    whose bit is unset has none of the ids."""
    slots = ids.select(_bit_of(id_col).alias("b")).groupBy((F.col("b") / 32768).cast("int").alias("slot")).agg(
        F.bitmap_construct_agg((F.col("b") % 32768).cast("long")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in slots:
        out[r["slot"] * 4096:(r["slot"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def passes(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    return (bits[numbers >> 3] >> (numbers & 7).astype(np.uint8)) & 1 == 1


def _full_sets(k: int, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(passes(bits, b.column(2).to_numpy(zero_copy_only=False))))
            for lo, hi, data, offs in row_chunks(b.column(1)):
                h, edge = shingle_sets(Words(data, offs, True), k)
                cut = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([h[a:z].tobytes() for a, z in cut], pa.binary()),
                     pa.array([bit_sketch(h[a:z]) for a, z in cut], pa.binary())], names=["doc", "hashes", "sketch"])
    return run


def _check_block(t: tuple[int, int]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["doc"].isna()
        hubs = [np.frombuffer(raw, dtype=U) for raw in pdf.loc[own, "hashes"]]
        out: set[tuple[int, int]] = set()
        for doc, raw in zip(pdf.loc[~own, "doc"], pdf.loc[~own, "hashes"]):
            b = np.frombuffer(raw, dtype=U)
            for a in hubs:
                common = len(np.intersect1d(a, b, assume_unique=True))
                if t[1] * common >= t[0] * (len(a) + len(b) - common):
                    out.add((int(pdf["hub"].iloc[0]), int(doc)))
        return pd.DataFrame(sorted(out), columns=["src", "dst"]).astype("int64")
    return run


def verified(pairs: DataFrame, sets: DataFrame, t: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The (hub, doc) pairs whose sets reach the similarity, as (src, dst).
    The members of a hub are dealt to blocks of about HUB_BLOCK, each with one
    copy of the hub's set."""
    blocks = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_BLOCK).alias("blocks"))
    dealt = pairs.join(blocks, "hub").select("hub", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block"))
    members = dealt.join(sets.select("doc", "hashes").hint("merge"), "doc").select("hub", "block", F.col("doc").cast("string").alias("doc"), "hashes")
    hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).join(
        sets.select(F.col("doc").alias("hub"), "hashes").hint("merge"), "hub").select("hub", "block", F.lit(None).cast("string").alias("doc"), "hashes")
    return members.unionByName(hubs).groupBy("hub", "block").applyInPandas(_check_block(t), "src long, dst long")


def _fold(sk: np.ndarray, width: int) -> np.ndarray:
    while sk.shape[1] > width:
        half = sk.shape[1] // 2
        sk = sk[:, :half] ^ sk[:, half:]
    return sk


def _by_width(doc: np.ndarray, comp: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> list[tuple]:
    """The documents of each sketch width, those of a component side by side."""
    width = np.array([len(x) // 8 for x in sketch])
    out = []
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        at = at[np.argsort(comp[at], kind="stable")]
        out.append((w, doc[at], comp[at], n[at], np.frombuffer(b"".join(sketch[at]), dtype=U).reshape(len(at), w)))
    return out


def _compare(left: list[tuple], right: list[tuple] | None, t: tuple[int, int]) -> list[np.ndarray]:
    """Pairs of ``left`` and ``right`` (None: within ``left``) of different components
    whose sketches allow a link. Tiles of one component are skipped."""
    step = 512
    found = []
    for i, (w1, d1, c1, n1, s1) in enumerate(left):
        for j, (w2, d2, c2, n2, s2) in enumerate(left if right is None else right):
            if right is None and j < i:
                continue
            w = min(w1, w2)
            f1, f2 = _fold(s1, w), _fold(s2, w)
            for a in range(0, len(d1), step):
                for b in range(a if right is None and i == j else 0, len(d2), step):
                    x, y = slice(a, a + step), slice(b, b + step)
                    if c1[x][0] == c1[x][-1] == c2[y][0] == c2[y][-1]:
                        continue
                    low, high = np.minimum(n1[x, None], n2[None, y]), np.maximum(n1[x, None], n2[None, y])
                    p, q = np.nonzero((c1[x, None] != c2[None, y]) & (t[1] * low >= t[0] * high))
                    p, q = p + a, q + b
                    ok = np.zeros(len(p), dtype=bool)
                    cells = max(1, SKETCH_CELLS // w)
                    for z in range(0, len(p), cells):
                        far = np.bitwise_count(f1[p[z:z + cells]] ^ f2[q[z:z + cells]]).sum(axis=1, dtype=np.int64)
                        ok[z:z + cells] = far <= _diff_bound(n1[p[z:z + cells]] + n2[q[z:z + cells]], t)
                    p, q = d1[p[ok]], d2[q[ok]]
                    found.append(np.stack([np.minimum(p, q), np.maximum(p, q)], axis=1))
    return found


def _pair_rows(found: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(np.unique(np.concatenate([np.zeros((0, 2), dtype=np.int64), *found]), axis=0), columns=["hub", "doc"]).astype("int64")


def _sketch_pairs(t: tuple[int, int]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["sketch"].notna().to_numpy()
        docs = pdf[own].drop_duplicates(["doc", "n", "sketch"]).sort_values("doc")  # a repeated id may have several sets
        ids = docs["doc"].to_numpy()
        comp, n, sketch = (docs[c].to_numpy() for c in ("component", "n", "sketch"))
        rows = pdf[~own].drop_duplicates(["word", "doc"]).sort_values("word")
        low, high = (np.searchsorted(ids, rows["doc"].to_numpy(), side) for side in ("left", "right"))
        word = np.repeat(rows["word"].to_numpy(), high - low)
        at = np.repeat(high - np.cumsum(high - low), high - low) + np.arange(len(word))
        cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1], [True]])) if len(word) else np.zeros(0, dtype=int)
        found = []
        if len(ids) ** 2 < int((np.diff(cut) ** 2).sum()):
            found += _compare(_by_width(ids, comp, n, sketch), None, t)  # each pair once is less work than once a word
        else:
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
                found += _compare(_by_width(*(c[at[a:z]] for c in (ids, comp, n, sketch))), None, t)
        return _pair_rows(found)
    return run


def _block_pairs(t: tuple[int, int]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["side", "doc", "n", "sketch"])
        sides = [_by_width(*(part[c].to_numpy() for c in ("doc", "component", "n", "sketch")))
                 for _, part in pdf.groupby("side")]
        return _pair_rows(_compare(sides[0], sides[1] if len(sides) > 1 else None, t))
    return run


def deal_blocks(rows: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``words`` (word, size) dealt to blocks of about BLOCK_ROWS (column
    ``block``), and the pairs of blocks to compare (word, low, high). A component of
    more rows has blocks of its own, smaller ones share blocks; blocks that hold one
    component only are not compared within or with each other."""
    rows = rows.join(words, "word")
    # at most rows / BLOCK_ROWS rows
    large = materialize(rows.groupBy("word", "component").agg(F.count("*").alias("members")).where(
        F.col("members") > BLOCK_ROWS), "large_components")
    alone = F.col("members").isNotNull()
    dealt = rows.join(large, ["word", "component"], "left").select("word", "doc", "component", F.struct(
        F.when(alone, F.col("component")).alias("owner"),
        F.when(alone, F.pmod(F.xxhash64("doc"), F.ceil(F.col("members") / BLOCK_ROWS))).otherwise(
            F.pmod(F.xxhash64("component"), F.ceil(F.col("size") / BLOCK_ROWS))).alias("number"),
        alone.alias("alone")).alias("block"))
    blocks = materialize(dealt.select("word", "block").distinct(), "blocks")
    pairs = blocks.withColumnRenamed("block", "low").join(blocks.withColumnRenamed("block", "high"), "word").where(
        "low <= high AND NOT (low.alone AND high.alone AND low.owner = high.owner)")
    return dealt, pairs


def _far_pairs(named: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Pairs of different components that share a word and whose sketches allow a
    link. Words go where other words of their hub go, about GROUP_ROWS rows
    together, so a document's sketch is sent once a group, not once a word. The
    documents of a word of more than BLOCK_ROWS are dealt to blocks, and each pair
    of blocks that holds several components is a group."""
    sketched = sets.select("doc", "sketch", (F.length("hashes") / 8).cast("long").alias("n")).hint("merge")
    # at most rows / BLOCK_ROWS words
    large = materialize(named.groupBy("word").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK_ROWS), "large_words")
    dealt, pairs = deal_blocks(named, large)
    sides = pairs.withColumn("side", F.explode(F.expr("CASE WHEN low = high THEN array(0) ELSE array(0, 1) END"))).withColumn(
        "block", F.when(F.col("side") == 0, F.col("low")).otherwise(F.col("high")))
    apart = dealt.join(sides, ["word", "block"]).select("word", "low", "high", "side", "doc", "component").join(
        sketched, "doc").groupBy("word", "low", "high").applyInPandas(_block_pairs(t), "hub long, doc long")
    named = named.join(large, "word", "left_anti")
    # only hubs of several groups need their number: a short table, whatever the hub's size
    groups = materialize(named.groupBy("hub").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("groups")).where("groups > 1"), "large_hubs")
    part = F.pmod(F.xxhash64("word"), F.coalesce("groups", F.lit(1))).alias("part")
    rows = named.join(groups, "hub", "left").select("hub", part, "word", "doc", "component")
    sketches = rows.select("hub", "part", "doc", "component").distinct().join(sketched, "doc").select(
        "hub", "part", F.lit(None).cast("long").alias("word"), "doc", "component", "n", "sketch")
    rows = rows.withColumn("n", F.lit(None).cast("long")).withColumn("sketch", F.lit(None).cast("binary"))
    return rows.unionByName(sketches).groupBy("hub", "part").applyInPandas(_sketch_pairs(t), "hub long, doc long").unionByName(apart)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    t: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    doc_id reachable over links, itself included)."""
    with text_batches(docs.sparkSession):
        return _near_duplicates(docs, id_col, text_col, k, t)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, k: int, t: tuple[int, int]) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sized = materialize(docs.mapInArrow(
        _set_rows(k, t), "doc_id long, n_shingles long, f1 long, f2 long, least0 long, least1 long"), "sets")
    # one number reaches the driver: the shingles of all sets
    total = sized.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(2 * shuffle_partitions(spark), total // BUCKET_WORDS)
    # sets that several rows have: only their documents must send a key with their words
    named_sets = sized.where("n_shingles > 0 AND doc_id IS NOT NULL")
    several = named_sets.groupBy("n_shingles", "f1", "f2").agg(F.count("*").alias("rows")).where("rows > 1")
    copied = id_filter(named_sets.join(several, ["n_shingles", "f1", "f2"], "left_semi"), "doc_id")
    words = docs.select("doc_id", "text", _bit_of("doc_id").alias("bit")).mapInArrow(_word_rows(k, t, buckets, copied), "bucket int, words binary, who binary, docs binary, sets binary")
    shared = materialize(words.groupBy("bucket").applyInPandas(_shared_words, "word long, doc long, space int"), "shared")
    # a set that shares too few words of a space resembles none that it meets there
    least = sized.groupBy("doc_id").agg(F.min("least0").alias("least0"), F.min("least1").alias("least1"))
    # (a window over one document's words: as long as the document at most)
    counted = shared.repartition("doc").join(least.withColumnRenamed("doc_id", "doc").hint("merge"), "doc").withColumn(
        "n", F.count("*").over(Window.partitionBy("doc", "space")))
    shared = counted.where("n >= CASE space WHEN 0 THEN least0 WHEN 1 THEN least1 ELSE 1 END").select("word", "doc", "n")
    # the hub of a word: the document that shares most words, then the smallest id
    hubs = shared.groupBy("word").agg(F.max(F.struct("n", (-F.col("doc")).alias("minus"))).alias("hub"), F.min("doc").alias("a"),
                                      F.max("doc").alias("z")).where("a <> z").select("word", "hub")
    shared = materialize(shared.select("word", "doc").join(hubs, "word"), "shared")
    wanted = id_filter(shared.select("doc").distinct(), "doc")
    sets = materialize(docs.where("doc_id IS NOT NULL").select("doc_id", "text", _bit_of("doc_id").alias("bit")).mapInArrow(
        _full_sets(k, wanted), "doc long, hashes binary, sketch binary"), "full_sets")

    # copies: equal sets, and rows that repeat a doc_id
    full = sized.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    copies = full.join(reps, ["n_shingles", "f1", "f2"]).select(
        F.col("rep").alias("src"), F.col("doc_id").alias("dst")).where("src <> dst")

    # 1: each document against the best hub it meets
    first = shared.groupBy("doc").agg((-F.max("hub")["minus"]).alias("hub")).where("hub <> doc")
    tested = materialize(first.select("hub", "doc"), "tested")
    links = verified(tested, sets, t)
    # 2: in words that still hold several components, against the word's hub
    named = shared.select("word", "doc", (-F.col("hub.minus")).alias("hub"))
    for stars in (True, False):
        # stars stand for the links that they came from: later ones need new links only
        links = component_stars(links)
        named = named.select("word", "doc", "hub").join(links.select(F.col("src").alias("doc"), "dst"), "doc", "left").select(
            "word", "doc", "hub", F.coalesce("dst", "doc").alias("component"))
        # words met by the same documents are one group
        mixed = named.groupBy("word").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"),
            # sums of the halves: with bit_xor, rows that repeat an id would cancel out
            F.struct(F.sum(F.shiftright(F.xxhash64("doc"), 32)), F.sum(F.xxhash64("doc").bitwiseAND(0xFFFFFFFF))).alias("members")).where("lo <> hi")
        mixed = mixed.groupBy("members", "size").agg(F.min("word").alias("word")).select("word")
        named = materialize(named.join(mixed, "word"), "mixed")
        if stars:
            hubs = named.where("doc = hub").select("word", F.col("component").alias("hub_component"))
            pairs = named.join(hubs, "word").where("component <> hub_component").select("hub", "doc")
        else:
            # 3: across components only, sketches first
            pairs = _far_pairs(named, sets, t)
        pairs = pairs.distinct().join(tested, ["hub", "doc"], "left_anti")
        pairs = materialize(pairs, "pairs")
        links = links.unionByName(verified(pairs, sets, t))
        tested = tested.unionByName(pairs)
    comp = component_stars(links.unionByName(copies))
    return sized.join(comp.select(F.col("src").alias("doc_id"), "dst"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("dst", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are the smallest doc_id of their group, and those with a
    null doc_id (all columns kept)."""
    dropped = near_duplicates(docs, id_col, text_col).where("doc_id <> component_id").select(
        F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped, F.col(id_col).cast("long") == F.col("__dropped"), "left_anti")
