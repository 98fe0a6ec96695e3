from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lodestone.llm import suffix_dedup as sx
from lodestone.llm.queries import op9_suffix_dedup


def slow(rows, w):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - w + 1) if d is not None else ():
            first[b[i : i + w]] = min(first.get(b[i : i + w], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - w + 1) if d is not None else ():
            if first[b[i : i + w]] < d:
                gone[i + 1 : i + 1 + w] = True
        kept = bytes(x for x, g in zip(b, gone[1:], strict=False) if not g)
        out.append((d, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def found(spark, rows, w=50, parts=5):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted(str(tuple(r)) for r in sx.remove_repeats(df, w).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize(("seed", "w"), [(1, 50), (2, 20), (3, 11)])
def test_equals_brute_force(spark, seed, w):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcde é") for _ in range(rng.randint(w // 2, 3 * w))) for _ in range(10)]
    rows = []
    for i in range(90):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(0, 8))]
        rows.append((i, "".join(parts)))
    rows += [(200, "a" * 300), (201, "a" * 120), (202, "a" * (w - 1)), (203, None), (None, rows[5][1]), (9, rows[9][1]), (204, "ab" * 100), (205, "ba" * 100), (206, "a" * w), (207, rows[3][1])]
    rng.shuffle(rows)
    assert found(spark, rows, w) == slow(rows, w)


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    offsets = np.array([0, 100, 149, 2000, 2000, 5000])
    whole = [x.tolist() for x in sx.anchors(data, offsets, 50, 20)]
    monkeypatch.setattr(sx, "BLOCK", 333)
    parts = sx.anchors(data, offsets, 50, 20)
    keep = set(zip(*whole, strict=True)) ^ set(zip(*[x.tolist() for x in parts], strict=True))
    borders = {int(o) for o in offsets}
    assert all(min(abs(offsets[r] + p - b) for b in borders) < 50 for _, r, p in keep)  # only extra ones near borders of texts may differ


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    shared = rng.randbytes(50)
    for _ in range(50):
        a, b = rng.randbytes(80) + shared + rng.randbytes(60), rng.randbytes(33) + shared + rng.randbytes(90)
        data, offsets = np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a) + len(b)])
        h, row, pos = sx.anchors(data, offsets, 50, 20)
        one = {(int(x), int(p) - 80) for x, r, p in zip(h, row, pos, strict=True) if r == 0 and 80 <= p <= 110}
        two = {(int(x), int(p) - 33) for x, r, p in zip(h, row, pos, strict=True) if r == 1 and 33 <= p <= 63}
        assert one & two


def test_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in small("documents").select("doc_id", "text").collect()]
    assert sorted(str(tuple(r)) for r in op9_suffix_dedup(spark, "/root/testdata/sf0.001").collect()) == slow(rows, 50)


def test_odd_rows(spark, odd, clashing, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(spark, rows) == slow(rows, 50)
    assert sorted(map(str, sx.remove_repeats(clashing).collect())) == sorted(map(str, sx.remove_repeats(odd).collect()))
    assert sx.remove_repeats(empty).count() == 0
    kept = {r.doc_id: bytes(r.kept) for r in sx.remove_repeats(spark.createDataFrame([(1, "x" * 10 + "shared " * 10), (2, "shared " * 10 + "y")], "doc_id long, text string"), 50, with_text=True).collect()}
    assert kept == {1: ("x" * 10 + "shared " * 10).encode(), 2: b"y"}


def test_working_memory_of_one_step(spark):
    import tracemalloc

    rng = np.random.default_rng(5)
    data = np.frombuffer(rng.bytes(1 << 20), np.uint8)
    n = 1 << 17
    pos = np.sort(rng.integers(0, len(data), n))

    def peak(run):
        tracemalloc.start()
        try:
            return run(), tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    (context, left, right), mb = peak(lambda: sx.surroundings(data, np.zeros(n, np.int64), np.full(n, len(data)), pos, 50, 20))
    assert mb < 60
    for i in (0, n // 2, n - 1):
        around = data[pos[i] - left[i] : pos[i] + right[i]]
        assert context[i, 30 - left[i] : 30 + right[i]].tobytes() == around.tobytes()
    m = 60_000  # one anchor in many documents, with differing text around it
    some = np.repeat(rng.integers(97, 123, (m // 3, 80)).astype(np.uint8), 3, axis=0)
    some[:, 30:50], some[::3, 0:5] = some[0, 30:50], 65
    args = (np.zeros(m, np.uint64), np.arange(m), np.full(m, 30, np.uint8), np.full(m, 50, np.uint8), some, 50, 20)
    (row, back), mb = peak(lambda: sx.repeated_windows(*args))
    assert mb < 100
    rows, backs = sx.repeated_windows(*args, at_once=1 << 30)
    assert len(row) and sorted(zip(row.tolist(), back.tolist(), strict=True)) == sorted(zip(rows.tolist(), backs.tolist(), strict=True))
