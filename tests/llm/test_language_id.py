from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa

from lodestone.llm import language_id as li
from lodestone.llm.queries import op7_language_id

SAMPLES = {"a": [b"abracadabra abra", b"cad"], "b": [b"xyz xyzzy", b""]}


def slow_bits(samples, text, order=3, least=1):
    """Code length by the definition: longest context first, escape to the next shorter one, uniform bytes at last."""
    counts = {}
    for t in samples:
        if not t:
            continue
        for i in range(len(t)):
            for k in range(order + 1):
                ctx = tuple([None] * max(0, k - i)) + tuple(t[max(0, i - k) : i])
                counts.setdefault((k, ctx), {}).setdefault(t[i], 0)
                counts[(k, ctx)][t[i]] += 1
    total = 0.0
    for i, b in enumerate(text):
        for k in range(order, -2, -1):
            if k < 0:
                total += 8.0
                break
            node = counts.get((k, tuple([None] * max(0, k - i)) + tuple(text[max(0, i - k) : i])))
            if not node or (k >= 2 and sum(node.values()) < least):
                continue
            n, u = sum(node.values()), len(node)
            if b in node:
                total += math.log2((n + u) / node[b])
                break
            total += math.log2((n + u) / u)
    return total


def test_code_lengths_follow_the_definition(monkeypatch):
    model = li.fit_ppm(SAMPLES, min_count=1)
    texts = [b"abra xyz", b"a", b"", b"cadz\xff\xfe q", b"xyzzyxyzzy", b"ab"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    for block in (1 << 19, 3, 1):  # blocks of any size give the same sums
        monkeypatch.setattr(li, "BLOCK", block)
        found = li.code_lengths(model, data, offsets) / li.SCALE
        for i, t in enumerate(texts):
            for g, lang in enumerate(model.languages):
                assert abs(found[i, g] - slow_bits(SAMPLES[lang], t)) < 0.01 * max(1, len(t))


def test_held_out_accuracy(spark, medium):
    rows = op7_language_id(spark, "/root/testdata/sf0.01").join(medium("documents").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, clashing, empty):
    model = li.fit_ppm({"de": [b"ein text und noch ein text"], "en": [b"the quick brown fox and the dog"]}, 1)
    rows = [(r.doc_id, r.lang_pred, r.score) for r in li.identify_languages(odd, model).collect()]
    assert len(rows) == odd.count()
    for doc_id, lang, score in rows:
        assert (lang == "und") == (doc_id in (3, 4, 5, 6)) and (score == 0.0) == (lang == "und")
    assert dict((r[0], r[1]) for r in rows)[None] == "de"
    assert sorted(map(str, li.identify_languages(clashing, model).select("doc_id", "lang_pred", "score").collect())) == sorted(map(str, li.identify_languages(odd, model).collect()))
    assert li.identify_languages(empty, model).count() == 0
    nothing = li.fit_language_model(empty)
    assert {r.lang_pred for r in li.identify_languages(odd, nothing).collect()} == {"und"}


def test_ties_go_to_the_first_language():
    model = li.fit_ppm({"b": [b"same"], "a": [b"same"]}, 1)
    assert li.predict_batch(model, pa.array(["same text"]), 48)[0] == ["a"]
