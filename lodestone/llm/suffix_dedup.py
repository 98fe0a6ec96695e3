"""Removal of repeated passages: depth-limited radix sort of suffixes.

A window is a string of ``threshold`` bytes.  Each byte covered by a window that also starts in a document with a smaller
doc_id is removed.  Repeated windows are the groups of suffixes that are equal through ``threshold`` bytes, so suffixes are ordered only
that deep, by most-significant-digit passes, and a suffix leaves as soon as its group has one document.

First digit.  A window's anchor is the ``k`` bytes in it with the smallest hash (a minimiser).  It depends on the window's bytes alone, so
equal windows have equal anchors at equal offsets: suffixes are dealt by the hash of their anchor, and only about one
position in fifteen is an anchor of any window.  Anchors that only one document has are dropped; most are.
Second digits.  For the anchors left, the text around them is dealt by the same hash.  Windows that start less than half of
``threshold - k`` before the anchor share the bytes after it, the others share those before it; eight-byte digits of these split the
groups, then the survivors' windows are listed and split on by the digits of all ``threshold`` bytes, which is exact.

Copies of a whole text are settled first, by digest, and have no anchors.

Volume: an anchor costs about nine bytes in the first exchange.  Before either exchange each task settles what it can alone: anchors
that it sees in two documents are known to be repeated (only a mark goes on), and among equal surroundings only the smallest doc_id goes
on, the others being repeats already.  So a passage that a third of all documents share sends a row a task, not a row a document.

Defined results: null text is empty; texts shorter than ``threshold`` bytes stay whole; repeated rows (equal doc_id) do not remove each
other's windows, and each loses the ranges found for that doc_id, so rows that share one should share the text; a document with null doc_id stays whole and removes nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow_text import mix64, utf8_view
from lodestone.llm.shared import cut, plan_bytes, small_batches, trimmed

BLOCK = 1 << 18
PACKER = pa.Codec("zstd", compression_level=4)
LOW40 = np.uint64((1 << 40) - 1)
MARK = np.iinfo(np.int64).min
NO_ID = MARK + 1  # stands for a null doc_id, so that both joins read one exchange of the texts
BYTE_VALUE = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1000))
BASE = 0x9E3779B97F4A7C15


def powers(n: int) -> np.ndarray:
    out, value = [], 1
    for _ in range(n):
        out.append(value)
        value = value * BASE % 2**64
    return np.array(out, np.uint64)


def rolling_hash(data: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of the k bytes at each position, by doubling; the last k - 1 positions are not meaningful."""
    with np.errstate(over="ignore"):
        size, part = 1, BYTE_VALUE[data]
        done, out = 0, np.zeros(len(data), np.uint64)
        factor = powers(k + 1)
        while True:
            if k & size:
                shifted = np.zeros_like(part)
                shifted[: len(part) - done] = part[done:]
                out = out * factor[size] + shifted
                done += size
            if done == k:
                return mix64(out)
            nxt = part * factor[size]
            nxt[:-size] += part[size:]
            part, size = nxt, 2 * size


def slide(values: np.ndarray, width: int, pick, forward: bool) -> np.ndarray:
    """pick (minimum or maximum) of ``width`` neighbours, the ones after each position or before it."""
    out, done = values.copy(), 1
    while done < width:
        step = min(done, width - done)
        if forward:
            out[:-step] = pick(out[:-step], out[step:])
        else:
            out[step:] = pick(out[step:], out[:-step].copy())
        done += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, threshold: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, position in the row) of every anchor: all windows' minimisers, and some more near text borders."""
    reach = threshold - k
    sizes = np.diff(offsets)
    found_h, found_at = [], []
    for lo in range(0, len(data), BLOCK):
        hi = min(len(data), lo + BLOCK)
        a, b = max(0, lo - reach), min(len(data), hi + threshold)
        if b - a < threshold:
            continue
        h = rolling_hash(data[a:b], k)
        h[len(h) - k + 1 :] = np.uint64(2**64 - 1)
        low = slide(h, reach + 1, np.minimum, True)
        low[max(0, len(low) - threshold + 1) :] = 0  # no whole window starts here
        chosen = np.flatnonzero(slide(low, reach + 1, np.maximum, False) == h) + a
        chosen = chosen[(chosen >= lo) & (chosen < hi)]
        found_at.append(chosen)
        found_h.append(h[chosen - a])
    if not found_at:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, h = np.concatenate(found_at), np.concatenate(found_h)
    row = np.searchsorted(offsets, at, side="right") - 1
    pos = at - offsets[row]
    ok = (pos + k <= sizes[row]) & (sizes[row] >= threshold)
    return h[ok], row[ok], pos[ok]


def pack(*columns: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return struct.pack("<II", len(columns[0]), len(raw)) + PACKER.compress(raw, asbytes=True)


def unpack(blob: bytes, kinds: tuple) -> list[np.ndarray]:
    n, size = struct.unpack_from("<II", blob)
    raw = pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True)
    out, at = [], 0
    for dtype, width in kinds:
        step = np.dtype(dtype).itemsize * width * n
        column = np.frombuffer(raw, dtype, count=n * width, offset=at)
        out.append(column.reshape(n, width) if width > 1 else column)
        at += step
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def split_by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    first = runs(bucket[order])
    for i, j in zip(first, np.append(first[1:], len(order)), strict=True):
        yield int(bucket[order[i]]), order[i:j]


ANCHOR_COLUMNS = (("<u4", 1), ("u1", 1), ("<i8", 1), ("<u4", 1))
DEALT = "bucket int, kind int, blob binary"


def deal_anchors(docs: DataFrame, threshold: int, k: int, buckets: int) -> DataFrame:
    """Packed anchors by bucket, without those of copies (``is_copy``): kind 0 to be compared, kind 1 already known to be repeated."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8_view(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            h, row, pos = anchors(data, offsets, threshold, k)
            used = (ids != NO_ID) & batch.column("is_copy").is_null().to_numpy(zero_copy_only=False)
            h, row, pos = h[used[row]], row[used[row]], pos[used[row]]
            if not len(h):
                continue
            doc = ids[row].astype(np.int64)
            order = np.argsort(h, kind="stable")
            h, doc, pos = h[order], doc[order], pos[order].astype(np.uint32)
            first = runs(h)
            sizes = np.diff(np.append(first, len(h)))
            many = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
            known = np.repeat(many, sizes)
            out: list[tuple[int, int, bytes]] = []
            if known.any():
                out.append((int(mix64(doc[:1].view(np.uint64))[0] % np.uint64(buckets)), 1, pack(doc[known], pos[known])))
            send_h = np.concatenate([h[~known], h[first[many]]])
            send_doc = np.concatenate([doc[~known], np.full(int(many.sum()), MARK)])
            send_pos = np.concatenate([pos[~known], np.zeros(int(many.sum()), np.uint32)])
            low = send_h & LOW40
            order = np.lexsort((send_pos, send_doc))
            low, send_h, send_doc, send_pos = low[order], send_h[order], send_doc[order], send_pos[order]
            for b, i in split_by_bucket((send_h >> np.uint64(40)) % np.uint64(buckets)):
                steps = np.diff(send_doc[i], prepend=0)
                out.append((b, 0, pack(low[i].astype(np.uint32), (low[i] >> np.uint64(32)).astype(np.uint8), steps, send_pos[i])))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["bucket", "kind", "blob"])

    return small_batches(docs.select("doc_id", "text", "is_copy")).mapInArrow(run, DEALT)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """(kind, blob) of each bucket, from rows sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if bucket != now and held:
                yield held
                held = []
            now = bucket
            held.append((kind, blob))
    if held:
        yield held


def repeated_anchors(dealt: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, pos) of the anchors that more than one document has."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in by_bucket(batches):
            known = [unpack(blob, (("<i8", 1), ("<u4", 1))) for kind, blob in held if kind == 1]
            docs, spots = [x[0] for x in known], [x[1] for x in known]
            parts = [unpack(blob, ANCHOR_COLUMNS) for kind, blob in held if kind == 0]
            if parts:
                h = np.concatenate([p[0].astype(np.uint64) | p[1].astype(np.uint64) << np.uint64(32) for p in parts])
                doc = np.concatenate([np.cumsum(p[2]) for p in parts])
                pos = np.concatenate([p[3] for p in parts])
                order = np.argsort(h, kind="stable")
                h, doc, pos = h[order], doc[order], pos[order]
                first = runs(h)
                low, high = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
                keep = np.repeat((low != high) | (low == MARK), np.diff(np.append(first, len(h)))) & (doc != MARK)
                docs.append(doc[keep])
                spots.append(pos[keep])
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(spots).astype(np.int32))], names=["doc_id", "pos"])

    return dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc_id long, pos int")


def same_rows(keys: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A group number for each row: equal for rows of equal key and bytes.  Rows are matched by a hash and then compared byte by byte."""
    m, width = context.shape
    padded = np.zeros((m, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = context
    words = padded.view(np.uint64)
    mixed = keys.copy()
    for j in range(words.shape[1]):
        mixed = mix64(mixed ^ words[:, j])
    order = np.argsort(mixed, kind="stable")
    first = runs(mixed[order])
    sizes = np.diff(np.append(first, m))
    leader = np.repeat(order[first], sizes)
    equal = keys[order] == keys[leader]
    for j in range(words.shape[1]):
        equal &= words[order, j] == words[leader, j]
    number = np.repeat(np.arange(len(first)), sizes)
    number[~equal] = len(first) + np.arange(int((~equal).sum()))
    out = np.empty(m, np.int64)
    out[order] = number
    return out


def surroundings(data: np.ndarray, start: np.ndarray, size: np.ndarray, pos: np.ndarray, threshold: int, k: int, at_once: int = 1 << 13) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes around each anchor, bytes there are before it, bytes from it on); zeros beyond the document."""
    reach = threshold - k
    left, right = np.minimum(pos, reach), np.minimum(size - pos, threshold)
    span = np.arange(-reach, threshold)
    context = np.zeros((len(pos), len(span)), np.uint8)
    for lo in range(0, len(pos), at_once):  # places are eight times as wide as the bytes
        part = slice(lo, lo + at_once)
        inside = (span >= -left[part, None]) & (span < right[part, None])
        at = np.where(inside, (start[part] + pos[part])[:, None] + span, 0)
        context[part] = np.where(inside, data[at], 0)
    return context, left.astype(np.uint8), right.astype(np.uint8)


def context_columns(threshold: int, k: int) -> tuple:
    return (("<u4", 1), ("u1", 1), ("<i8", 1), ("<u4", 1), ("u1", 1), ("u1", 1), ("u1", 2 * threshold - k))


def deal_surroundings(found: DataFrame, threshold: int, k: int, buckets: int, at_once: int = 1 << 17) -> DataFrame:
    """From (doc_id, text, spots): packed surroundings of repeated anchors (kind 0) and removals already settled here (kind 1)."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8_view(batch.column("text"))
            spots = batch.column("spots")
            row_all = np.repeat(np.arange(batch.num_rows), np.diff(spots.offsets.to_numpy()))
            pos_all = spots.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            for lo in range(0, len(row_all), at_once):
                row, pos = row_all[lo : lo + at_once], pos_all[lo : lo + at_once]
                context, left, right = surroundings(data, offsets[:-1][row], sizes[row], pos, threshold, k)
                reach = threshold - k
                h = hash_columns(context[:, reach : reach + k])
                doc = ids[row].astype(np.int64)
                group = same_rows(h ^ (left.astype(np.uint64) << np.uint64(8) | right.astype(np.uint64)), context)
                order = np.lexsort((doc, group))
                first = runs(group[order])
                least = np.empty(len(order), np.int64)
                least[order] = np.repeat(doc[order][first], np.diff(np.append(first, len(order))))
                later = doc > least
                out = []
                settled = later & (left.astype(np.int64) + right >= threshold)
                if settled.any():
                    out.append((int(h[0] % np.uint64(buckets)), 1, pack(doc[settled], (pos - left)[settled].astype(np.uint32), (pos + right)[settled].astype(np.uint32))))
                go = np.flatnonzero(~later)
                for b, i in split_by_bucket((h[go] >> np.uint64(40)) % np.uint64(buckets)):
                    i = go[i]
                    low = h[i] & LOW40
                    out.append((b, 0, pack(low.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint8), np.diff(doc[i], prepend=0), pos[i].astype(np.uint32), left[i], right[i], context[i])))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["bucket", "kind", "blob"])

    return found.select("doc_id", "text", "spots").mapInArrow(run, DEALT)


def hash_columns(rows: np.ndarray) -> np.ndarray:
    """The rolling hash of each row's bytes."""
    k = rows.shape[1]
    factor = powers(k)
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out += BYTE_VALUE[rows[:, j]] * factor[k - 1 - j]
    return mix64(out)


def radix_pass(group: np.ndarray, digit: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One most-significant-digit pass: (rows still in groups of two documents or more, their new group numbers)."""
    order = np.lexsort((digit, group))
    first = runs(group[order], digit[order])
    if not len(first):
        return order, order
    sizes = np.diff(np.append(first, len(order)))
    d = doc[order]
    stay = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
    kept = np.repeat(stay, sizes)
    return order[kept], np.repeat(np.arange(len(first)), sizes)[kept]


def digits(context: np.ndarray, row: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Up to eight bytes of each row from ``start`` as one number."""
    out = np.zeros(len(row), np.uint64)
    for j in range(size):
        out = out << np.uint64(8) | context[row, start + j]
    return out


def repeated_windows(h: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, context: np.ndarray, threshold: int, k: int, at_once: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(row, distance of the window's start before the anchor) of all windows that a smaller doc_id has too.

    Windows of different distances are never compared, so only as many distances as keep to ``at_once`` windows are taken together.
    """
    reach, half = threshold - k, (threshold - k) // 2
    keep, group0 = radix_pass(np.zeros(len(h), np.int64), h, doc)
    rows_out, back_out = [], []
    for backs in (range(half), range(half, reach + 1)):
        row, group = keep, group0
        if backs[0] == 0:  # these windows share the bytes up to threshold - half + 1 after the anchor
            shared = range(reach + k, reach + threshold - half + 1)
            ok = right[row] >= threshold - half + 1
        else:  # these share the ``half`` bytes before it
            shared = range(reach - half, reach)
            ok = left[row] >= half
        row, group = row[ok], group[ok]
        for at in range(shared.start, shared.stop, 8):
            kept, group = radix_pass(group, digits(context, row, np.full(len(row), at), min(8, shared.stop - at)), doc[row])
            row = row[kept]
        row0, group_of = row, group
        n = max(1, at_once // max(1, len(row0)))
        for low in range(backs.start, backs.stop, n):
            some = np.arange(low, min(low + n, backs.stop))
            back = np.tile(some, len(row0))
            row, group = np.repeat(row0, len(some)), np.repeat(group_of, len(some)) * len(some) + np.tile(np.arange(len(some)), len(row0))
            ok = (left[row] >= back) & (right[row] >= threshold - back)
            row, group, back = row[ok], group[ok], back[ok]
            for at in range(0, threshold, 8):
                kept, group = radix_pass(group, digits(context, row, reach - back + at, min(8, threshold - at)), doc[row])
                row, back = row[kept], back[kept]
            if len(row):
                first = runs(group)
                least = np.repeat(np.minimum.reduceat(doc[row], first), np.diff(np.append(first, len(row))))
                again = doc[row] > least
                rows_out.append(row[again])
                back_out.append(back[again])
    none = np.zeros(0, np.int64)
    return np.concatenate(rows_out) if rows_out else none, np.concatenate(back_out) if back_out else none


def removals(dealt: DataFrame, threshold: int, k: int, buckets: int, at_once: int = 1 << 16) -> DataFrame:
    """(doc_id, lo, hi): byte ranges covered by windows that a smaller doc_id has too."""
    kinds = context_columns(threshold, k)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(doc, lo, hi):
            return pa.RecordBatch.from_arrays([pa.array(doc.astype(np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["doc_id", "lo", "hi"])

        for held in by_bucket(batches):
            for kind, blob in held:
                if kind == 1:
                    yield result(*unpack(blob, (("<i8", 1), ("<u4", 1), ("<u4", 1))))
            parts = [unpack(blob, kinds) for kind, blob in held if kind == 0]
            if not parts:
                continue
            h = np.concatenate([p[0].astype(np.uint64) | p[1].astype(np.uint64) << np.uint64(32) for p in parts])
            doc = np.concatenate([np.cumsum(p[2]) for p in parts])
            pos, left, right, context = (np.concatenate([p[i] for p in parts]) for i in range(3, 7))
            del parts
            same = same_rows(h ^ (left.astype(np.uint64) << np.uint64(8) | right.astype(np.uint64)), context)
            order = np.lexsort((doc, same))
            first = runs(same[order])
            least = np.empty(len(order), np.int64)
            least[order] = np.repeat(doc[order][first], np.diff(np.append(first, len(order))))
            later = doc > least
            settled = later & (left.astype(np.int64) + right >= threshold)
            if settled.any():
                p = pos[settled].astype(np.int64)
                yield result(doc[settled], p - left[settled], p + right[settled])
            go = np.flatnonzero(~later)
            go = go[np.argsort(h[go], kind="stable")]
            cuts = runs(h[go])
            lo = 0
            while lo < len(go):  # whole groups, up to ``at_once`` rows together
                i = int(np.searchsorted(cuts, lo + at_once, side="right")) - 1
                hi = len(go) if lo + at_once >= len(go) else max(int(cuts[i]), lo + 1)
                if hi <= lo + 1 or cuts[i] <= lo:
                    j = int(np.searchsorted(cuts, lo, side="right"))
                    hi = int(cuts[j]) if j < len(cuts) else len(go)
                some = go[lo:hi]
                row, back = repeated_windows(h[some], doc[some], left[some], right[some], context[some], threshold, k)
                if len(row):
                    order = np.lexsort((back, row))
                    row, back = row[order], back[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (back[1:] != back[:-1] + 1)
                    f = np.flatnonzero(new)
                    last = np.append(f[1:], len(row)) - 1
                    p = pos[some][row[f]].astype(np.int64)
                    yield result(doc[some][row[f]], p - back[last], p - back[f] + threshold)
                lo = hi

    return dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc_id long, lo int, hi int")


FINAL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def keep_rest(joined: DataFrame, with_text: bool) -> DataFrame:
    """Cut the ranges out of each text; counts and checksum, and what is left of the text if asked for."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8_view(batch.column("text"))
            raw = data.tobytes()
            spans = batch.column("spans").to_pylist()
            out: list[list] = [[], [], [], [], []]
            for i in range(batch.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                rest, at, n_spans = [], 0, 0
                end = -1
                for lo, hi in sorted((s["lo"], s["hi"]) for s in spans[i] or ()):
                    if lo > end:
                        rest.append(text[at:lo])
                        n_spans += 1
                        at = end = hi
                    elif hi > end:
                        at = end = hi
                rest.append(text[at:])
                left = b"".join(rest)
                for column, value in zip(out, (len(text), len(text) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left), strict=True):
                    column.append(value)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            arrays = [pa.array(ids, pa.int64(), mask=ids == NO_ID), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(out[4], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.select("doc_id", "text", "spans").mapInArrow(run, FINAL + (", kept binary" if with_text else ""))


def remove_repeats(docs: DataFrame, threshold: int = 50, with_text: bool = False) -> DataFrame:
    """Counts and checksum (and bytes, if asked for) of what each text keeps.  The texts are exchanged once."""
    k = max(1, 2 * threshold // 5)
    spark = docs.sparkSession
    table = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(1 << 24, math.ceil(plan_bytes(docs) / (4 << 20))))
    dealt = table.repartition("doc_id")
    copies = exact_copies(table, threshold)
    marked = dealt.join(copies.select("doc_id", F.lit(True).alias("is_copy")), "doc_id", "left")  # a filter here would be pushed under the exchange
    candidates = repeated_anchors(deal_anchors(marked, threshold, k, buckets), buckets)
    spots = candidates.groupBy("doc_id").agg(F.collect_list("pos").alias("spots"))
    ranges = removals(deal_surroundings(dealt.join(spots, "doc_id"), threshold, k, buckets), threshold, k, buckets)
    ranges = ranges.unionByName(copies.select("doc_id", F.lit(0).alias("lo"), F.col("n_bytes").cast("int").alias("hi")))
    spans = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return keep_rest(dealt.join(spans, "doc_id", "left"), with_text)


def exact_copies(table: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, n_bytes) of the documents whose whole text a smaller doc_id has; all their bytes are repeats."""
    size = F.octet_length("text").cast("long")
    digests = cut(table.where(F.col("doc_id") != NO_ID).select("doc_id", F.sha2("text", 256).alias("digest"), size.alias("n_bytes")).where(F.col("n_bytes") >= threshold))
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first").drop("last")
    return cut(digests.join(first, "digest").where("doc_id > first").select("doc_id", "n_bytes").distinct())
