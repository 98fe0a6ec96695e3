"""Near-duplicate documents by 64-bit SimHash and Golay-code fuzzy hashing.

A fingerprint is cut into segments of 23, 23 and 18 bits (the last one padded with zeros).  The binary Golay code of length 23 is
perfect: every word is within three bits of exactly one codeword.  D(s) is the 12-bit index of that codeword, K(s) the
indices that s and the words one bit away decode to (one or six).  If two segments differ in one bit at most, the
index D of each is among the indices K of the other.

Two fingerprints with at most three differing bits split them over the segments in one of two ways, and keys are made for both:

* no segment has more than one: one side gives (D, D, K), the other (K, K, D), so each shares a key with the other;
* one segment has two or three: of the other two one is equal and one differs in a bit at most, so they share (segment, D) and
  (segment, K), for each ordered pair of segments.

Every key has 35 bits or more, so few strangers meet.  Only distinct fingerprints get keys.  Keys held by more than
``block`` fingerprints are dealt as pairs of blocks, so no group of near copies lands in one task; inside a group
links are verified by their Hamming distance and a spanning forest of them is kept, which leaves the components as they are and never
writes all pairs of a group.

Defined results: null or empty text has fingerprint zero; texts of fewer words than a shingle are one shingle; equal
fingerprints are linked; repeated rows stay repeated; a null doc_id keeps its row (component: the smallest known doc_id, or null); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow_text import slices
from lodestone.llm.components import connected_components
from lodestone.llm.shared import cut, join_hot, small_batches, trimmed

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SEGMENTS = ((0, 23), (23, 23), (46, 18))
GENERATOR = 0b101011100011  # of the cyclic Golay code [23, 12, 7]


def word_table(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased text with one space between words, starts and ends of all words in it, and the words before each document."""
    if not len(data):
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~WHITE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    stops = word.copy()
    stops[:-1] &= ~word[1:] | first[1:-1]
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sizes = to - at
    ends = np.cumsum(sizes + 1) - 1
    joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    letters = np.flatnonzero(word)
    joined[letters - np.repeat(at - (ends - sizes), sizes)] = LOWER[data[letters]]
    return joined.tobytes(), ends - sizes, ends, np.searchsorted(at, offsets)


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int, seed: int = 42) -> np.ndarray:
    """SimHash of each document: bit set if it is set in over half of the XXH64 of its word shingles, repeats included."""
    import xxhash

    text, starts, ends, before = word_table(data, offsets)
    n_words = np.diff(before)
    n = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    base = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    first = np.arange(int(n.sum())) - base[row] + before[:-1][row]
    last = np.minimum(first + shingle, before[1:][row]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[s:e], seed) for s, e in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, count=len(first))
    return majority(hashes, n)


def majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """SimHash of each run of ``n`` hashes: a bit is set if it is set in over half of them."""
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    base = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    cuts = np.concatenate([np.arange(base[d], base[d] + n[d], 65_535) for d in full]) if n.max() > 65_535 else base[full]
    doc_of = row[cuts]
    lanes, low16 = np.uint64(0x0001000100010001), np.uint64(0xFFFF)
    for k in range(16):  # four 16-bit counters at a time
        part = np.add.reduceat((hashes >> np.uint64(k)) & lanes, cuts)
        for lane in range(4):
            counter = np.bincount(doc_of, weights=((part >> np.uint64(16 * lane)) & low16).astype(np.float64), minlength=len(n))
            out |= (2 * counter > n).astype(np.uint64) << np.uint64(k + 16 * lane)
    return out


def fingerprint_docs(docs: DataFrame, shingle: int = 3, slice_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, fp) of every document, one narrow pass."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints(data, offsets, shingle) for _, _, data, offsets, _ in slices(batch.column("text"), slice_bytes)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(found).view(np.int64))], names=["doc_id", "fp"])

    return small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest codeword for each 23-bit word, by syndrome and data bits): syndrome of each byte position, correction of each syndrome's data bits."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    unit = np.array([remainder(1 << b) for b in range(23)])
    byte = np.zeros((3, 256), np.uint16)
    for p in range(3):
        for b in range(min(8, 23 - 8 * p)):
            byte[p] ^= np.where(np.arange(256) >> b & 1, unit[8 * p + b], 0).astype(np.uint16)
    flips = np.zeros(2048, np.uint16)
    bits = [1 << b for b in range(23)]
    for i in range(23):
        flips[unit[i]] = bits[i] >> 11
        for j in range(i):
            flips[unit[i] ^ unit[j]] = (bits[i] | bits[j]) >> 11
            for k in range(j):
                flips[unit[i] ^ unit[j] ^ unit[k]] = (bits[i] | bits[j] | bits[k]) >> 11
    return byte, flips


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    byte, flips = golay_tables()
    syndrome = byte[0][words & 255] ^ byte[1][words >> 8 & 255] ^ byte[2][words >> 16]
    return (words >> 11).astype(np.uint16) ^ flips[syndrome]


def nearby(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of all distinct codeword indices that each word and its one-bit neighbours decode to."""
    around = np.stack([words, *[words ^ (1 << b) for b in range(size)]], axis=1)
    index = np.sort(decode(around.ravel()).reshape(around.shape), axis=1)
    new = np.ones(index.shape, bool)
    new[:, 1:] = index[:, 1:] != index[:, :-1]
    return np.nonzero(new)[0], index[new].astype(np.int64)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): all keys of each fingerprint, such that any two within three bits share one."""
    seg = [(fps.view(np.uint64) >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    d = [decode(s).astype(np.int64) for s in seg]
    k = [nearby(s, size) for s, (_, size) in zip(seg, SEGMENTS, strict=True)]
    kind = lambda i: np.int64(i) << 40
    rows, keys = [], []
    r, k3 = k[2]
    rows.append(r)
    keys.append(kind(0) | d[0][r] << 24 | d[1][r] << 12 | k3)
    (r1, k1), (r2, k2) = k[0], k[1]
    n2 = np.bincount(r2, minlength=len(fps))
    at2 = np.cumsum(n2) - n2
    left = np.repeat(np.arange(len(r1)), n2[r1])
    step = np.arange(len(left)) - np.repeat(np.cumsum(n2[r1]) - n2[r1], n2[r1])
    r = r1[left]
    rows.append(r)
    keys.append(kind(0) | k1[left] << 24 | k2[at2[r] + step] << 12 | d[2][r])
    each, number = np.arange(len(fps)), 1
    for i in range(3):
        for j in range(3):
            if i != j:
                rows += [each, k[j][0]]
                keys += [kind(number) | seg[i] << 12 | d[j], kind(number) | seg[i][k[j][0]] << 12 | k[j][1]]
                number += 1
    return np.concatenate(rows), np.concatenate(keys)


def key_rows(distinct: DataFrame, rows_at_once: int = 4096) -> DataFrame:
    """(key, fp) of all distinct fingerprints, each pair once."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for lo in range(0, len(fps), rows_at_once):
                part = np.ascontiguousarray(fps[lo : lo + rows_at_once])
                row, key = golay_keys(part)
                both = np.unique(np.stack([key, row], axis=1).view([("key", np.int64), ("row", np.int64)]).ravel())
                yield pa.RecordBatch.from_arrays([pa.array(both["key"]), pa.array(part[both["row"]])], names=["key", "fp"])

    return distinct.mapInArrow(run, "key long, fp long")


def forest(fps: np.ndarray, radius: int, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``radius`` bits: breadth-first, distances in bounded pieces."""
    words = fps.view(np.uint64)
    left, a, b = np.arange(len(fps)), [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            size = max(1, at_once // max(1, len(left)))
            part, front = front[:size], front[size:]
            near = np.bitwise_count(words[part][:, None] ^ words[left][None, :]) <= radius
            hit = near.any(axis=0)
            if hit.any():
                a.append(part[near[:, hit].argmax(axis=0)])
                b.append(left[hit])
                front, left = np.concatenate([front, left[hit]]), left[~hit]
    none = np.zeros(0, np.int64)
    return fps[np.concatenate(a) if a else none], fps[np.concatenate(b) if b else none]


def group_links(groups: np.ndarray, fps: np.ndarray, radius: int, small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal group number: every pair for runs of up to ``small``, else a spanning forest."""
    edge = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(edge, len(groups)))
    run = np.repeat(np.arange(len(edge)), sizes)
    a, b = [], []
    little = sizes[run] <= small
    for step in range(1, min(small, len(fps))):
        i = np.flatnonzero(little[:-step] & (run[:-step] == run[step:]))
        near = i[np.bitwise_count((fps[i] ^ fps[i + step]).view(np.uint64)) <= radius]
        a.append(fps[near])
        b.append(fps[near + step])
    for r in np.flatnonzero(sizes > small):
        x, y = forest(np.unique(fps[edge[r] : edge[r] + sizes[r]]), radius)
        a.append(x)
        b.append(y)
    none = np.zeros(0, np.int64)
    return np.concatenate(a) if a else none, np.concatenate(b) if b else none


def link_rows(dealt: DataFrame, radius: int) -> DataFrame:
    """Links of all groups (key, x, y) from rows sorted by group; a group that spans batches is carried over."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: np.ndarray | None = None

        def links(rows: np.ndarray) -> pa.RecordBatch:
            change = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
            a, b = group_links(np.concatenate([[0], np.cumsum(change)]), np.ascontiguousarray(rows[:, 3]), radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "x", "y", "fp")], axis=1)
            rows = rows if kept is None else np.concatenate([kept, rows])
            same = np.all(rows[:, :3] == rows[-1, :3], axis=1)
            last = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            kept = rows[last:]
            if last:
                yield links(rows[:last])
        if kept is not None and len(kept):
            yield links(kept)

    return dealt.mapInArrow(run, "a long, b long")


def hamming_links(distinct: DataFrame, radius: int = 3, block: int = 2048, tasks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints within ``radius`` (3 at most) bits: a set with the same components as all of them."""
    if radius > 3:
        raise ValueError("the keys guarantee links of up to three differing bits")
    keys = key_rows(distinct.repartition(tasks, "fp") if tasks else distinct)
    hot = cut(keys.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    n_hot = hot.count()
    if n_hot == 0:
        dealt = keys.select("key", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "fp")
    else:  # the size of ``hot`` is known here: it is broadcast only while small
        side = F.broadcast(hot) if n_hot <= 100_000 else hot
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")
        spread = keys.join(side, "key", "left").withColumn("own", F.coalesce(own, F.lit(0).cast("long")))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("blocks"), F.lit(1)).cast("long") - 1)).alias("other")
        dealt = spread.select("key", "own", "fp", other).select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")
    dealt = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return link_rows(dealt, radius)


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, rows_a_task: int = 20_000) -> DataFrame:
    """doc_id, fp (as a signed number) and component_id, the smallest doc_id reachable over links, of every document."""
    prints = cut(fingerprint_docs(docs, shingle))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    total, distinct = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    linked = connected_components(hamming_links(classes.select("fp"), radius, tasks=-(-distinct // rows_a_task)))
    labels = classes.join(linked, classes["fp"] == linked["node"], "left").select("fp", "rep", "n", F.coalesce("component", "fp").alias("component"))
    labels = cut(labels)
    smallest = labels.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("members"))
    final = join_hot(labels, smallest, "component", "members", distinct).select("fp", "n", "component_id")
    return join_hot(prints, final, "fp", "n", total).select("doc_id", "fp", "component_id")
