"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Words are tagged toxic or not.  A word's emission is the sum of the weights of its features (the word itself and its prefixes of three
to six characters, lower-cased, outer punctuation stripped); tag pairs of neighbouring words have weights too.  Forward-backward
gives each word's exact marginal probability.  With two tags the messages are ratios that each word maps by a
fractional-linear function, so a slice of many documents is scanned in blocks side by side: the blocks' maps are composed,
chained, and then run again from the right start.

Training.  Labels mark documents, so the labelled words are induced: a word of a toxic document is tagged if one of its features is
common in toxic and all but absent in other training documents.  The field is fitted to these tags by gradient ascent on a bounded sample
(``n_toxic`` and ``n_clean`` documents by hash order, whole texts, ``chars_per_class`` characters at most in each class; a text that does not fit is passed over).  A document's score is a logistic function
of its largest marginal and the sum of its squared marginals, fitted to the document labels of the same sample.

Defined results: null and empty texts have no words and get the score of a document without toxic words; without labelled rows of both
classes every score is 0; null labels and repeated rows are harmless; an empty table gives no rows.  Span offsets are bytes of
the UTF-8 text.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow_text import slices
from lodestone.llm.shared import release_memory, small_batches, trimmed, whole_texts
from lodestone.llm.simhash_dedup import WHITE

PREFIXES = (3, 4, 5, 6)
CLIP = 25.0


def features(word: str) -> list[str]:
    """Features of a normalised word."""
    return ["=" + word, *["^" + word[:n] for n in PREFIXES if len(word) > n]] if word else []


def normal(piece: str) -> str:
    word = piece.strip().lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def scan(num0, num1, den0, den1, width: int = 256) -> np.ndarray:
    """r[t] = (num0 + num1 r[t-1]) / (den0 + den1 r[t-1]) for all t; the first map must be constant."""
    n = len(num0)
    rows = -(-n // width)
    grid = []
    for column, neutral in ((num0, 1.0), (num1, 0.0), (den0, 1.0), (den1, 0.0)):
        full = np.full(rows * width, neutral)
        full[:n] = column
        grid.append(np.ascontiguousarray(full.reshape(rows, width).T))
    p, q, s, t = grid
    a, b, c, d = p[0].copy(), q[0].copy(), s[0].copy(), t[0].copy()
    for i in range(1, width):
        a, b, c, d = p[i] * c + q[i] * a, p[i] * d + q[i] * b, s[i] * c + t[i] * a, s[i] * d + t[i] * b
        if i % 8 == 0:
            top = np.maximum(np.maximum(a, b), np.maximum(c, d))
            a, b, c, d = a / top, b / top, c / top, d / top
    start, r = np.empty(rows), 1.0
    for i, (a1, b1, c1, d1) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        start[i] = r
        r = (a1 + b1 * r) / (c1 + d1 * r)
    out, r = np.empty((width, rows)), start
    for i in range(width):
        r = (p[i] + q[i] * r) / (s[i] + t[i] * r)
        out[i] = r
    return out.T.ravel()[:n]


def forward_backward(emission: np.ndarray, first: np.ndarray, last: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(marginal of tag 1, forward ratios, backward ratios, exp emissions) of concatenated sequences; weights: start, 00, 01, 10, 11."""
    e = np.exp(np.clip(emission, -CLIP, CLIP))
    start, a00, a01, a10, a11 = np.exp(weights)
    f = scan(np.where(first, e * start, e * a01), np.where(first, 0.0, e * a11), np.where(first, 1.0, a00), np.where(first, 0.0, a10))
    nxt = np.append(e[1:], 1.0)
    stop = last[::-1]
    nxt = nxt[::-1]
    b = scan(np.where(stop, 1.0, a10), np.where(stop, 0.0, a11 * nxt), np.where(stop, 1.0, a00), np.where(stop, 0.0, a01 * nxt))[::-1]
    odds = f * b
    return odds / (1 + odds), f, b, e


@dataclass
class ToxicityModel:
    """Feature weights, bias, tag weights and the document calibration (bias, largest marginal, log expected count)."""

    weights: dict[str, float]
    bias: float
    chain: np.ndarray
    calibration: np.ndarray | None

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(word))


def induce_lexicon(docs: list[list[str]], toxic: list[int], least_evidence: float = 11.0, odds: float = 2.5) -> set[str]:
    """Features of a word, or prefixes of four characters or more, that are common in toxic documents and all but absent in others.

    Support is counted in distinct preceding words, not in documents: a word that copies of one text share has one context only.
    ``least_evidence`` bounds the log-likelihood ratio of the feature's split between the classes from below.
    """
    n1 = max(1, sum(toxic))
    n0 = max(1, len(toxic) - n1)
    long = lambda w: [f for f in features(w) if len(f) > 4 or f[0] == "="]
    often: Counter = Counter()
    for words, label in zip(docs, toxic, strict=True):
        if label:
            for word, n in Counter(words).items():
                for f in long(word):
                    often[f] += n
    contexts: dict[str, set[str]] = {f: set() for f, n in often.items() if n >= 3}
    del often
    seen: Counter = Counter()
    for words, label in zip(docs, toxic, strict=True):
        if label:
            for before, word in zip(["", *words], words):
                for f in long(word):
                    if f in contexts:
                        contexts[f].add(before)
        else:
            seen.update({f for w in set(words) for f in long(w) if f in contexts})
    share = n1 / (n1 + n0)
    found = set()
    for f, before in contexts.items():
        c, s = len(before), seen[f]
        if c < 3 or s > 0.05 * c or math.log((c + 0.5) / (n1 + 1) / ((s + 0.5) / (n0 + 1))) < odds:
            continue
        evidence = c * math.log(c / ((c + s) * share)) + (s * math.log(s / ((c + s) * (1 - share))) if s else 0.0)
        if evidence >= least_evidence:
            found.add(f)
    return found


def fit_toxicity(texts: list[str], toxic: list[int], rounds: int = 60, least_df: int = 4) -> ToxicityModel:
    if not texts or len(set(toxic)) < 2:
        return ToxicityModel({}, 0.0, np.zeros(5), None)
    known: dict[str, str] = {}  # one string a word, however often it occurs
    docs = [[known[w] if w in known else known.setdefault(w, sys.intern(normal(w))) for w in t.split()] for t in texts]
    del known
    lexicon = induce_lexicon(docs, toxic)
    types: dict[str, int] = {}
    token_type = np.array([types.setdefault(w, len(types)) for d in docs for w in d], np.int64)
    sizes = np.array([len(d) for d in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    feats = [features(w) for w in types]
    tagged = np.array([any(f in lexicon for f in fs) for fs in feats], bool)
    df = Counter(f for fs in feats for f in fs)
    uses = np.bincount(token_type, minlength=len(types))
    common = Counter()
    for fs, n in zip(feats, uses.tolist(), strict=True):
        for f in fs:
            common[f] += n
    number = {f: i for i, f in enumerate(sorted(f for f in df if f in lexicon or common[f] >= least_df * 5))}
    used = [[number[f] for f in fs if f in number] for fs in feats]
    at = np.repeat(np.arange(len(used)), [len(u) for u in used])
    feat = np.fromiter((i for u in used for i in u), np.int64, count=len(at))
    del used, df, common
    y = (tagged[token_type] & (np.array(toxic)[doc] == 1)).astype(float)
    first, last = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    if len(doc):
        first[0] = last[-1] = True
        first[1:] = last[:-1] = doc[1:] != doc[:-1]
    theta = np.zeros(len(number) + 1 + 5)  # features, bias, chain
    theta[len(number)] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = ~last[:-1]
    for step in range(1, rounds + 1):
        w, bias, chain = theta[: len(number)], theta[len(number)], theta[len(number) + 1 :]
        kind = np.bincount(at, weights=w[feat], minlength=len(types)) + bias
        p, f, b, e = forward_backward(kind[token_type], first, last, chain)
        by_type = np.bincount(token_type, weights=p - y, minlength=len(types))
        g = np.zeros_like(theta)
        g[: len(number)] = np.bincount(feat, weights=by_type[at], minlength=len(number))
        g[len(number)] = (p - y).sum()
        a = np.exp(chain[1:])
        left, right = f[:-1][inner], (e[1:] * b[1:])[inner]
        joint = np.stack([np.full_like(left, a[0]), a[1] * right, a[2] * left, a[3] * left * right])
        joint /= joint.sum(axis=0)
        y0, y1 = y[:-1][inner], y[1:][inner]
        seen = np.array([((1 - y0) * (1 - y1)).sum(), ((1 - y0) * y1).sum(), (y0 * (1 - y1)).sum(), (y0 * y1).sum()])
        g[len(number) + 2 :] = joint.sum(axis=1) - seen
        g[len(number) + 1] = (p - y)[first].sum()
        g += 0.05 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w, bias, chain = theta[: len(number)], float(theta[len(number)]), theta[len(number) + 1 :]
    kind = np.bincount(at, weights=w[feat], minlength=len(types)) + bias
    p = forward_backward(kind[token_type], first, last, chain)[0]
    x = document_features(p, doc, len(docs))
    model = ToxicityModel({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-4}, bias, chain, None)
    model.calibration = fit_logistic(x, np.array(toxic, float))
    return model


def document_features(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    top = np.zeros(n)
    np.maximum.at(top, doc, p)
    return np.stack([np.ones(n), top, np.log1p(np.bincount(doc, weights=p * p, minlength=n))], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, ridge: float = 0.5) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -CLIP, CLIP)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def training_sample(docs: DataFrame, labels: DataFrame, n_toxic: int, n_clean: int, chars_per_class: int) -> tuple[list[str], list[int]]:
    """Bounded sample of labelled documents outside the held-out fifth, by hash order, of whole texts."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    rows = rows.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = {
        label: [(r["doc_id"],) for r in rows.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()] for label, n in ((1, n_toxic), (0, n_clean))
    }
    texts = whole_texts(docs, ["doc_id"], picked, chars_per_class)
    toxic = set(picked[1])
    return [texts[d] for d in sorted(texts)], [int(d in toxic) for d in sorted(texts)]


def fit_model(docs: DataFrame, labels: DataFrame, n_toxic: int = 1200, n_clean: int = 2000, chars_per_class: int = 3_000_000) -> ToxicityModel:
    model = fit_toxicity(*training_sample(docs, labels, n_toxic, n_clean, chars_per_class))
    release_memory()
    return model


class WordScores:
    """Emissions of words, remembered up to ``capacity`` words; then the memory starts anew."""

    def __init__(self, model: ToxicityModel, capacity: int = 500_000):
        self.model, self.capacity, self.known = model, capacity, {}

    def of(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > self.capacity:
            self.known = {}
        known, emission = self.known, self.model.emission
        for piece in pieces:
            if piece not in known:
                known[piece] = emission(normal(piece))
        return np.fromiter(map(known.__getitem__, pieces), np.float64, count=len(pieces))


def score_slice(scores: WordScores, data: np.ndarray, offsets: np.ndarray, span_at: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document scores, documents of the spans, their starts, ends and largest marginals)."""
    n = len(offsets) - 1
    model = scores.model
    none = np.zeros(0, np.int64)
    if model.calibration is None:
        return np.zeros(n), none, none, none, np.zeros(0)
    if not len(data) or WHITE[data].all():
        base = 1 / (1 + math.exp(-model.calibration[0]))
        return np.full(n, base), none, none, none, np.zeros(0)
    word = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    stops[:-1] &= ~word[1:] | edge[1:-1]
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    doc = np.searchsorted(offsets, at, side="right") - 1
    cuts = np.append(at, len(data)).astype(np.int32)
    coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(cuts.tobytes()), pa.py_buffer(data.tobytes())).dictionary_encode()
    emission = scores.of(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    first, last = np.ones(len(at), bool), np.ones(len(at), bool)
    first[1:] = last[:-1] = doc[1:] != doc[:-1]
    p = forward_backward(emission, first, last, model.chain)[0]
    x = document_features(p, doc, n)
    score = 1 / (1 + np.exp(-np.clip(x @ model.calibration, -CLIP, CLIP)))
    hot = p >= span_at
    new = hot.copy()
    new[1:] &= ~hot[:-1] | first[1:]
    begin = np.flatnonzero(new)
    end = hot.copy()
    end[:-1] &= ~hot[1:] | last[:-1]
    top = np.maximum.reduceat(np.where(hot, p, 0.0), begin) if len(begin) else np.zeros(0)
    return score, doc[begin], at[begin] - offsets[doc[begin]], to[end] - offsets[doc[begin]], top


def score_documents(docs: DataFrame, model: ToxicityModel, span_at: float = 0.5, slice_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, score, and the offending spans (byte offsets and largest marginal) of every whole text.  One narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, score double, spans array<struct<lo: int, hi: int, p: double>>"
    kind = pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("p", pa.float64())])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(shared.value)
        for batch in batches:
            for lo, hi, data, offsets, _ in slices(batch.column("text"), slice_bytes):
                score, doc, start, stop, top = score_slice(scores, data, offsets, span_at)
                at = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(top)], fields=list(kind))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(score), pa.ListArray.from_arrays(pa.array(at), spans)], names=["doc_id", "score", "spans"])

    return small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, schema)
