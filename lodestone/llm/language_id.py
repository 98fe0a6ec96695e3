"""Language identification by prediction by partial matching (PPM).

For each language a variable-order byte context tree (orders 0 to 3) is counted over a bounded labelled sample.  A
byte that its context has seen costs log2((n + u) / c) bits (n bytes seen there, u of them different, c of this one);
an unseen one costs an escape, log2((n + u) / u), and is tried in the next shorter context, down to uniform bytes.  The
statistics are frozen: scoring only adds up code lengths.  A document gets the language that codes it
in the fewest bits; ``score`` is that language's posterior under equal priors, with the code lengths tempered as
if the document had at most ``temper_bytes`` bytes.

The tree is flattened into one table: every context that any language keeps has a row, every seen byte a column, every
entry the fixed-point code length for each language.  Bytes never seen in training share one column and one
context symbol, which is exact, since all of them escape through the same contexts.

Defined results: null text or text without a letter -> ``und``, score 0.  Nulls in lang or source, repeated rows and extra
columns change nothing; an empty table gives no rows; with no labelled row every document is ``und``.
Ties go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestone.llm.arrow_text import slices
from lodestone.llm.shared import release_memory, small_batches, trimmed, whole_texts

LETTER = re.compile(r"[^\W\d_]")
SCALE = 1024
ORDER = 3
BOS, OTHER = 0, 1
BLOCK = 1 << 19


@dataclass
class PpmModel:
    """Frozen statistics: class of each byte, row of each 3-symbol context, code lengths [row * symbols + symbol, language]."""

    languages: list[str]
    classes: np.ndarray
    n_classes: int
    row_of: np.ndarray
    costs: np.ndarray


def fit_ppm(samples: dict[str, list[bytes]], min_count: int = 4) -> PpmModel:
    """Count the context trees of each language and flatten them.  Contexts of orders 2 and 3 seen fewer than ``min_count`` times in a language are cut."""
    languages = sorted(samples)
    seen = np.zeros(256, bool)
    for texts in samples.values():
        for text in texts:
            seen[np.frombuffer(text, np.uint8)] = True
    classes = np.full(256, OTHER, np.int64)
    classes[seen] = 2 + np.arange(int(seen.sum()))
    a = 2 + int(seen.sum())
    counts: list[list[dict[str, np.ndarray]]] = []
    for lang in languages:
        parts = [np.concatenate([np.full(ORDER, BOS), classes[np.frombuffer(t, np.uint8)]]) for t in samples[lang] if t]
        stream = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        at = np.flatnonzero(stream != BOS)
        levels = []
        for k in range(ORDER + 1):
            key = np.zeros(len(at), np.int64)
            for j in range(k, 0, -1):
                key = key * a + stream[at - j]
            pair, c = np.unique(key * a + stream[at], return_counts=True)
            ctx, sym = pair // a, pair % a
            n = np.bincount(np.searchsorted(u := np.unique(ctx), ctx), weights=c) if len(ctx) else np.zeros(0)
            kept = u[n >= min_count] if k >= 2 and len(ctx) else (u if len(ctx) else np.zeros(0, np.int64))
            ok = np.isin(ctx, kept)
            levels.append({"contexts": kept, "ctx": ctx[ok], "sym": sym[ok], "c": c[ok].astype(float)})
        counts.append(levels)
    contexts = [np.unique(np.concatenate([lv[k]["contexts"] for lv in counts])) if counts else np.zeros(0, np.int64) for k in range(ORDER + 1)]
    contexts[0] = np.zeros(1, np.int64)
    first = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    table = np.zeros((first[-1], a, max(1, len(languages))), np.float64)
    for g, levels in enumerate(counts):
        for k in range(ORDER + 1):
            rows, lv = contexts[k], levels[k]
            if k == 0:
                below = np.full((1, a), 8.0)
            else:  # the row of the context without its oldest symbol, or of a still shorter one
                below = np.empty((len(rows), a))
                todo, suffix = np.arange(len(rows)), rows
                for j in range(k - 1, -1, -1):
                    suffix = suffix % (a**j)
                    pos = np.minimum(np.searchsorted(contexts[j], suffix), len(contexts[j]) - 1)
                    hit = contexts[j][pos] == suffix
                    below[todo[hit]] = table[first[j] + pos[hit], :, g]
                    todo, suffix = todo[~hit], suffix[~hit]
            block = below.copy()
            if len(lv["ctx"]):
                r = np.searchsorted(rows, lv["ctx"])
                n = np.bincount(r, weights=lv["c"], minlength=len(rows))
                u = np.bincount(r, minlength=len(rows))
                has = u > 0
                block[has] += np.log2((n + u)[has] / u[has])[:, None]
                block[r, lv["sym"]] = np.log2((n + u)[r] / lv["c"])
            table[first[k] : first[k + 1], :, g] = block
    every = np.arange(a**ORDER)
    row_of = np.zeros(a**ORDER, np.int32)
    for k in range(1, ORDER + 1):
        suffix = every % (a**k)
        if len(contexts[k]):
            pos = np.minimum(np.searchsorted(contexts[k], suffix), len(contexts[k]) - 1)
            hit = contexts[k][pos] == suffix
            row_of[hit] = (first[k] + pos[hit]).astype(np.int32)
    np.multiply(table, SCALE, out=table)  # in place: the table is the driver's largest array
    np.minimum(np.rint(table, out=table), 65535, out=table)
    costs = table.astype(np.uint16).reshape(-1, max(1, len(languages)))
    return PpmModel(languages, classes.astype(np.uint8), a, row_of, costs)


def code_lengths(model: PpmModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fixed-point code length of every document in every language, in blocks of bounded memory."""
    a = model.n_classes
    total = np.zeros((len(offsets) - 1, model.costs.shape[1]), np.int64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    starts = offsets[full]
    for lo in range(0, len(data), BLOCK):
        hi = min(len(data), lo + BLOCK)
        back = min(ORDER, lo)
        cls = model.classes[data[lo - back : hi]].astype(np.int32)
        cls = np.concatenate([np.full(ORDER - back, BOS, np.int32), cls])
        n = hi - lo
        here, after = np.searchsorted(starts, [lo - ORDER, hi])
        history = []
        for j in range(1, ORDER + 1):
            symbol = cls[ORDER - j : ORDER - j + n].copy()
            for step in range(j):  # the first bytes of a document have no older ones
                at = starts[here:after] + step - lo
                symbol[at[(at >= 0) & (at < n)]] = BOS
            history.append(symbol)
        key = (history[2] * a + history[1]) * a + history[0]
        cost = model.costs[model.row_of[key].astype(np.int64) * a + cls[ORDER:]]
        i0 = int(np.searchsorted(starts, lo, side="right")) - 1
        i1 = int(np.searchsorted(starts, hi, side="left"))
        cuts = np.maximum(starts[i0:i1], lo) - lo
        total[full[i0:i1]] += np.add.reduceat(cost, cuts, axis=0, dtype=np.int64)
    return total


def training_ids(docs: DataFrame, docs_per_language: int) -> dict[str, list[tuple]]:
    """The ``docs_per_language`` labelled rows of each language with the smallest hash, in that order, held-out rows left out.  Reads doc_id and lang only."""
    labelled = docs.select("doc_id", "lang").where(F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    found: dict[str, list[tuple]] = {}
    for r in labelled.withColumn("r", F.row_number().over(order)).where(F.col("r") <= docs_per_language).orderBy("lang", "r").collect():
        found.setdefault(r["lang"], []).append((r["lang"], r["doc_id"]))
    return found


def fit_language_model(docs: DataFrame, docs_per_language: int = 240, chars_per_language: int = 600_000, min_count: int = 4) -> PpmModel:
    """Fit on a bounded sample of whole texts: at most ``docs_per_language`` documents and ``chars_per_language`` characters a language; a text that does not fit is passed over."""
    picked = training_ids(docs, docs_per_language)
    texts = whole_texts(docs, ["lang", "doc_id"], picked, chars_per_language)
    samples: dict[str, list[bytes]] = {}
    for lang, doc in sorted(texts):
        samples.setdefault(lang, []).append(texts[lang, doc].encode())
    model = fit_ppm(samples, min_count)
    del samples
    release_memory()
    return model


def predict_batch(model: PpmModel, column: pa.Array, temper_bytes: int, slice_bytes: int = 4 << 20) -> tuple[list[str], np.ndarray]:
    langs: list[str] = []
    scores: list[np.ndarray] = []
    for _, _, data, offsets, valid in slices(column, slice_bytes):
        if not model.languages:
            langs += ["und"] * (len(offsets) - 1)
            scores.append(np.zeros(len(offsets) - 1))
            continue
        bits = code_lengths(model, data, offsets) / SCALE
        size = np.diff(offsets)
        best = bits.argmin(axis=1)
        gap = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(1.0, temper_bytes / np.maximum(size, 1))[:, None]
        score = 1.0 / np.exp2(-np.minimum(gap, 1000.0)).sum(axis=1)
        raw = data.tobytes()
        for i in range(len(size)):
            if not valid[i] or not has_letter(raw, int(offsets[i]), int(offsets[i + 1])):
                langs.append("und")
                score[i] = 0.0
            else:
                langs.append(model.languages[best[i]])
        scores.append(score)
    return langs, np.concatenate(scores) if scores else np.zeros(0)


_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(raw: bytes, lo: int, hi: int) -> bool:
    return bool(_ASCII_LETTER.search(raw, lo, hi)) or bool(LETTER.search(raw[lo:hi].decode("utf-8", "replace")))


def identify_languages(docs: DataFrame, model: PpmModel, temper_bytes: int = 48, extra: tuple[str, ...] = (), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """doc_id, the predicted language and its score (columns ``names``) of every document, and the columns ``extra`` passed through.  One narrow pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = {f.name: f for f in docs.schema.fields}
    kept = ["doc_id", *extra]
    schema = T.StructType([*[fields[c] for c in kept], T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict_batch(shared.value, batch.column("text"), temper_bytes)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[f.name for f in schema.fields])

    return small_batches(docs.select(*dict.fromkeys([*kept, "text"]))).mapInArrow(run, schema)
