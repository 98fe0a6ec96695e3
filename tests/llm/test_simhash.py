from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lodestone.llm import components
from lodestone.llm import simhash_dedup as sd
from lodestone.llm.arrow_text import slices
from lodestone.llm.components import connected_components
from lodestone.llm.queries import op5_simhash_dedup


def slow_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def slow_components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(medium):
    texts = ["", None, "a", "A b", " \n", "x\x0by Z", "É é É", "a b c a b c a b c"] + [r.text for r in medium("documents").limit(120).collect()]
    found = np.concatenate([sd.fingerprints(data, offsets, 3) for _, _, data, offsets, _ in slices(pa.array(texts), 1 << 16)])
    assert [int(x) for x in found] == [slow_print(t) for t in texts]


def test_long_texts_count_past_sixteen_bits():
    text = "a b c d e " * 30_000
    data = np.frombuffer(text.encode(), np.uint8)
    assert int(sd.fingerprints(data, np.array([0, len(data)]), 3)[0]) == slow_print(text)


def test_every_word_is_near_one_codeword():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 500)
    near = sd.decode(words)
    for w, index in zip(words.tolist(), near.tolist(), strict=True):
        code = index << 11
        rest = code
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= sd.GENERATOR << (bit - 11)
        assert bin(w ^ (code | rest)).count("1") <= 3


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
def test_keys_meet_within_three_bits(errors):
    rng = np.random.default_rng(errors)
    x = rng.integers(-(2**63), 2**63 - 1, 600, dtype=np.int64)
    y = x.copy().view(np.uint64)
    for i in range(len(y)):
        for b in rng.choice(64, errors, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    sides = []
    for side in (x, y.view(np.int64)):
        keys = [set() for _ in side]
        for r, k in zip(*sd.golay_keys(side), strict=True):
            keys[r].add(int(k))
        sides.append(keys)
    assert all(a & b for a, b in zip(*sides, strict=True))


@pytest.mark.parametrize("block", [2048, 8])
def test_links_have_the_components_of_all_links(spark, block):
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            x = center
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(r.a, r.b) for r in sd.hamming_links(df, 3, block).collect()]
    every = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 3 for a, b in links)
    assert slow_components(links, prints) == slow_components(every, prints)


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    some = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    links = chain + star + some + [(7, 7), (1, 0)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == slow_components([x for x in links if x[0] != x[1]], nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark, small):
    rows = op5_simhash_dedup(spark, "/root/testdata/sf0.001").collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert prints == {r.doc_id: slow_print(r.text) for r in small("documents").collect()}
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if bin(prints[a] ^ prints[b]).count("1") <= 3]
    assert {r.doc_id: r.component_id for r in rows} == slow_components(links, ids)


def test_odd_rows(odd, clashing, empty):
    rows = [(r.doc_id, r.fp, r.component_id) for r in sd.simhash_components(odd).collect()]
    assert len(rows) == odd.count()
    by = {r[0]: r for r in rows}
    assert by[2][2] == 1 and by[4][2] == by[5][2] == by[3][2] == 3 and by[3][1] == 0 and by[None][2] is None
    assert sorted(map(str, rows)) == sorted(str((r.doc_id, r.fp, r.component_id)) for r in sd.simhash_components(clashing).collect())
    assert sd.simhash_components(empty).count() == 0


def test_more_than_three_bits_are_refused(spark):
    with pytest.raises(ValueError, match="three"):
        sd.hamming_links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_a_round_of_components_has_a_small_plan(spark, monkeypatch):
    plans, cut = [], components.cut
    monkeypatch.setattr(components, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    links = [(i, i // 2) for i in range(2, 40)] + [(100, 101), (102, 101), (50, 50)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == slow_components(links[:-1], {x for link in links[:-1] for x in link})
    print([len(re.findall(r"\b(?:Aggregate|Join|Union)\b", p)) for p in plans])
    assert len(plans) > 2 and all(len(re.findall(r"\b(?:Aggregate|Join|Union)\b", p)) <= 9 for p in plans[1:])
