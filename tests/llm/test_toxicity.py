from __future__ import annotations

import zlib
from pathlib import Path
from itertools import product

import numpy as np
import pytest

from lodestone.llm import toxicity as tx
from lodestone.llm.queries import op1_toxicity
from lodestone.llm.shared import whole_texts


def slow_marginals(e, w):
    total, out = 0.0, np.zeros(len(e))
    for y in product((0, 1), repeat=len(e)):
        p = np.exp(sum(a * b for a, b in zip(e, y, strict=True)) + w[0] * y[0] + sum(w[1 + 2 * a + b] for a, b in zip(y, y[1:], strict=False)))
        total += p
        out += p * np.array(y)
    return out / total


@pytest.mark.parametrize("sizes", [[1], [4, 7], [1, 1, 9, 2]])
def test_marginals_are_exact(sizes):
    rng = np.random.default_rng(sum(sizes))
    e, w = rng.normal(0, 2, sum(sizes)), rng.normal(0, 1, 5)
    ends = np.cumsum(sizes)
    first, last = np.zeros(len(e), bool), np.zeros(len(e), bool)
    first[ends - sizes] = last[ends - 1] = True
    found = tx.forward_backward(e, first, last, w)[0]
    assert np.allclose(found, np.concatenate([slow_marginals(p, w) for p in np.split(e, ends[:-1])]))


def test_blocks_of_the_scan_chain():
    rng = np.random.default_rng(3)
    n = 2000
    a, b, c, d = rng.random((4, n)) + 0.1
    b[0] = d[0] = 0.0
    r, expected = 1.0, []
    for i in range(n):
        r = (a[i] + b[i] * r) / (c[i] + d[i] * r)
        expected.append(r)
    assert np.allclose(tx.scan(a, b, c, d, width=64), expected)


def corpus(n=300):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(300)]
    texts, labels = [], []
    for i in range(n):
        words = [vocabulary[j] for j in rng.integers(0, 300, 60)]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(0, 60)), str(rng.choice(["grumpo", "grumpish!", "blarg"])))
        texts.append(" ".join(words))
        labels.append(toxic)
    return texts, labels


def test_learns_spans_and_scores(spark):
    texts, labels = corpus()
    model = tx.fit_toxicity(texts[:200], labels[:200])
    df = spark.createDataFrame(list(enumerate(texts[200:])), "doc_id long, text string")
    rows = {r.doc_id: r for r in tx.score_documents(df, model).collect()}
    assert all((rows[i].score >= 0.5) == bool(y) for i, y in enumerate(labels[200:]))
    for i, t in enumerate(texts[200:]):
        raw = t.encode()
        for s in rows[i].spans:
            assert any(bad in raw[s.lo : s.hi].decode() for bad in ("grump", "blarg"))


def test_copies_do_not_make_a_lexicon():
    texts, labels = corpus()
    copied = "unique words of one text that is copied often " * 2
    texts, labels = texts + [copied] * 30, labels + [1] * 30
    lexicon = tx.induce_lexicon([[tx.normal(w) for w in t.split()] for t in texts], labels)
    assert "=copied" not in lexicon and "=blarg" in lexicon


def test_query(spark, medium):
    rows = op1_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    labels = {r.doc_id: r.toxic for r in medium("labels").collect()}
    clean = [r for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean([r.predicted for r in clean]) < 0.03
    toxic = [r for r in rows if labels.get(r.doc_id) == 1]
    assert np.mean([r.predicted for r in toxic]) > 0.6


def test_held_out_recall(spark):
    folder = "/root/testdata/sf0.1"
    if not Path(folder).exists():
        pytest.skip("no test tables")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    rows = op1_toxicity(spark, folder).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    print(f"held out: {np.mean(toxic):.3f} of {len(toxic)} toxic found, {np.mean(clean):.4f} of {len(clean)} others")
    assert np.mean(toxic) >= 0.9 and np.mean(clean) < 0.02


def test_training_takes_whole_texts(spark):
    docs = spark.createDataFrame([(i, "a" * (10 * i)) for i in range(1, 9)], "doc_id long, text string")
    found = whole_texts(docs, ["doc_id"], {1: [(8,), (2,), (7,), (1,)], 0: [(5,), (99,)]}, 120)
    assert {d: len(t) for (d,), t in found.items()} == {8: 80, 2: 20, 1: 10, 5: 50}


def test_odd_rows(spark, odd, clashing, empty):
    texts, labels = corpus(120)
    model = tx.fit_toxicity(texts, labels)
    rows = tx.score_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score < 0.5 for r in rows)
    assert sorted(map(str, tx.score_documents(clashing, model).collect())) == sorted(map(str, rows))
    assert tx.score_documents(empty, model).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    blank = tx.fit_model(odd, no_labels)
    assert {r.score for r in tx.score_documents(odd, blank).collect()} == {0.0}
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    assert tx.fit_model(odd, nulls).calibration is None


def test_slices_do_not_change_scores(spark):
    texts, labels = corpus(120)
    model = tx.fit_toxicity(texts, labels)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    one = [r.score for r in tx.score_documents(df, model).orderBy("doc_id").collect()]
    assert np.allclose(one, [r.score for r in tx.score_documents(df, model, slice_bytes=700).orderBy("doc_id").collect()])
