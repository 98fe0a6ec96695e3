from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm import merge_dropout as md
from lodestone.llm import token_output as to
from lodestone.llm.arrow_text import slices
from lodestone.llm.shared import new_folder, plan_bytes
from lodestone.llm.sstable import SSTableReader, SSTableWriter, filesystem, key_of

from .conftest import tokenizer

TRICKY = ["", " ", "  a  b ", "\n\n x", " \n a", "a \n\n b\n", "it's  I'll 'S don't", "é.à,ÿ&×.÷!a", "a.b,c|d|e", "<|endoftext|> a<|endoftext|>", "日本 語　字", "a\x85 b\xa0c", "🎉 🎉x", "\r\n\r\n a", "a " + " " * 50 + "b", "x▁y", "a" * 300 + " " + "the" * 200, "\x00 z", "b. ", " c"]


@pytest.fixture(scope="module")
def texts(medium):
    return [r.text for r in medium("documents").select("text").limit(300).collect()] + TRICKY + [None]


def test_pieces_encode_like_whole_texts(texts):
    enc = to.PieceEncoder(tokenizer("byte_bpe_50k.json"), capacity=5000)
    found = []
    for lo, hi, data, offsets, _ in slices(pa.array(texts), 1 << 18):
        ids, ends = enc.encode(data, offsets)
        found += [ids[ends[i] : ends[i + 1]].tolist() for i in range(hi - lo)]
    assert found == [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


class Counting:
    """A tokenizer that notes the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **how):
        self.given += texts
        return self.tokenizer.encode_batch_fast(texts, **how)


def encoded(enc, texts):
    found = []
    for lo, hi, data, offsets, _ in slices(pa.array(texts), 1 << 18):
        ids, ends = enc.encode(data, offsets)
        found += [ids[ends[i] : ends[i + 1]].tolist() for i in range(hi - lo)]
    return found


def test_new_pieces_are_encoded_in_runs_and_known_ones_kept():
    enc = to.PieceEncoder(tokenizer("byte_bpe_50k.json"), capacity=3000)
    library, enc.tokenizer = enc.tokenizer, Counting(enc.tokenizer)
    common = [f"{a}{b}ing" for a in "bcdfghklmnprst" for b in ("and", "ar", "el", "ound", "y")]
    for k in range(8):  # every slice has the common words and 1000 of its own, so the memory is full twice
        text = " ".join([*common, *(f"w{k}x{i}" for i in range(1000))])
        del enc.tokenizer.given[:]
        assert encoded(enc, [text]) == [library.encode(text, add_special_tokens=False).ids]
        assert len(enc.tokenizer.given) < 1100 / 16
        assert k == 0 or not set(" ".join(enc.tokenizer.given).split()) & set(common)
        assert len(enc.known) <= 3000 + 1100
    del enc.tokenizer.given[:]
    for _ in range(3):  # all pieces come again, more than half the memory: it starts anew, with the same ids
        assert encoded(enc, [text, text[::-1]]) == [library.encode(t, add_special_tokens=False).ids for t in (text, text[::-1])]


def test_random_texts_encode_like_whole_ones():
    draw = np.random.default_rng(5)
    parts = [" ", "  ", "\n", "\t", "\r", "\x00", "\x85", "\xa0", "\u2028", "\u3000", "a", "the", "S", "'s", "'", "'ll", "é", "ß", "×", "÷", "ÿ", ".", "-", "<|endoftext|>", "7", "42", "日本", "🎉", "\u0301", "_"]
    texts = ["".join(draw.choice(parts, draw.integers(0, 30))) for _ in range(4000)]
    enc = to.PieceEncoder(tokenizer("byte_bpe_50k.json"), capacity=2000)
    assert encoded(enc, texts) == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_that_are_not_bytes(tmp_path):
    import json

    plain = tokenizer("byte_bpe_50k.json")
    with open(plain, encoding="utf-8") as file:
        config = json.load(file)
    config["normalizer"] = {"type": "Replace", "pattern": {"String": "a"}, "content": "bb"}
    path = tmp_path / "t.json"
    path.write_text(json.dumps(config), encoding="utf-8")
    texts = ["a banana and", " an apple a day\nand a b", "x"]
    enc = to.PieceEncoder(str(path))
    assert encoded(enc, texts) == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_shards_return_what_was_written(spark, medium, odd, empty):
    path = tokenizer("byte_bpe_50k.json")
    enc = to.PieceEncoder(path)
    for docs in (medium("documents").select("doc_id", "text"), odd.select("doc_id", "text")):
        rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        expected, start = [], 0
        for r in rows:
            ids = np.array([*enc.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
            expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        found = to.token_shards(docs.repartition(5), path).collect()
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert to.token_shards(empty, path).count() == 0


def test_lookup_by_key(spark, tmp_path):
    name = str(tmp_path / "x.sst")
    fs, path = filesystem(name)
    rows = [(None, 3), *[(i, i % 50) for i in range(-300, 3000, 3)], (2998, 7), (2998, 8)]
    with fs.open_output_stream(path) as sink:
        writer = SSTableWriter(sink, 2, block_bytes=512)
        for k, n in rows:
            writer.add(k, np.arange(n))
        with pytest.raises(ValueError, match="ascending"):
            writer.add(5, np.arange(1))
        writer.close()
    with fs.open_input_file(path) as file:
        reader = SSTableReader(file)
        assert len(reader.blocks) > 10 and reader.n_docs == len(rows) and reader.n_ids == sum(n for _, n in rows)
        assert [(k, len(v)) for k, v in reader.scan()] == rows
        assert [len(v) for v in reader.get(0)] == [0] and [len(v) for v in reader.get(2998)] == [7, 8] and [len(v) for v in reader.get(None)] == [3]
        misses = [k for k in range(1, 3000) if k % 3 and k != 2998]
        assert not any(reader.get(k) for k in misses[:200]) and sum(reader.might_contain(k) for k in misses) < 0.05 * len(misses)
    assert key_of(-1) < key_of(0) < key_of(1)


def test_files_are_in_the_shared_folder(spark, odd):
    folder = new_folder(spark, "t")
    shards = to.write_shards(odd, tokenizer("byte_bpe_50k.json"), folder)
    fs, root = filesystem(folder)
    names = sorted(f.base_name for f in fs.get_file_info(__import__("pyarrow.fs").fs.FileSelector(root)))
    assert names == sorted(s["shard"] for s in shards)


def test_shards_follow_the_bytes(spark, medium):
    docs, folder = medium("documents"), new_folder(spark, "t")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = to.write_shards(docs, tokenizer("byte_bpe_50k.json"), folder, shard_bytes=plan_bytes(docs) // (3 * least))
    assert 2 * least < len(shards) <= 3 * least + 1
    rows = sorted(map(tuple, to.read_shards(spark, folder, shards).collect()), key=lambda r: r[1])
    assert len(rows) == docs.count() and [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert [r[1] + r[2] for r in rows[:-1]] == [r[1] for r in rows[1:]]


def encode(enc, texts, ids=None):
    out, same = [], []
    for lo, hi, data, offsets, _ in slices(pa.array(texts), 1 << 18):
        pieces, at, spaced, ends = enc.encode(np.arange(lo, hi) if ids is None else np.array(ids[lo:hi]), data, offsets)
        raw, back = enc.decode(pieces, at)
        out += [pieces[at[i] : at[i + 1]].tolist() for i in range(hi - lo)]
        same += [np.array_equal(raw[back[i] : back[i + 1]], spaced[ends[i] : ends[i + 1]]) for i in range(hi - lo)]
    return out, same


def test_without_dropout_it_is_the_library(texts):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [t or "" for t in texts if "▁" not in (t or "")]
    found, same = encode(md.DropoutEncoder(path, 1, 0.0, 4), plain)
    assert found == sp.encode(plain) and all(same)


def test_dropout_is_seeded_varied_and_lossless(texts):
    path = tokenizer("piece_bpe_32k.model")
    one, same = encode(md.DropoutEncoder(path, 7, 0.1, 4), texts)
    assert all(same) and one == encode(md.DropoutEncoder(path, 7, 0.1, 4, capacity=50), texts)[0]
    other, same = encode(md.DropoutEncoder(path, 8, 0.1, 4), texts)
    assert all(same) and other != one
    none, _ = encode(md.DropoutEncoder(path, 7, 0.0, 4), texts)
    assert sum(map(len, one)) > sum(map(len, none))
    everything, same = encode(md.DropoutEncoder(path, 7, 1.0, 1), ["hello there"])
    assert len(everything[0]) == len(" hello there") and all(same)
    word = encode(md.DropoutEncoder(path, 7, 0.3, 8), ["international " * 40])[0][0]
    assert len({tuple(word[i : i + 2]) for i in range(len(word))}) > 6


def test_side_by_side_and_agenda_agree():
    enc = md.DropoutEncoder(tokenizer("piece_bpe_32k.model"), 3, 0.2, 4)
    words = [" international", " unbelievable", "naïveté", " a", "xyzzy" * 9]
    streams = np.arange(len(words)) % 4
    flat, number = enc.words(words, streams)
    at = np.cumsum(number) - number
    keys = md.mix64(np.array([zlib.crc32(w.encode()) for w in words], np.uint64) << np.uint64(8) ^ streams.astype(np.uint64) ^ md.mix64(np.array([3], np.int64).view(np.uint64)))
    for i, w in enumerate(words):
        symbols = [int(enc.model.of_char[ord(c)]) for c in w]
        assert md.agenda(enc.model, symbols, int(keys[i]), enc.limit) == flat[at[i] : at[i] + number[i]].tolist()


def test_documents_decode(odd, clashing, empty):
    path = tokenizer("piece_bpe_32k.model")
    encoded = md.encode_documents(odd, path, with_ids=True)
    rows = encoded.collect()
    assert len(rows) == odd.count() and all(r.lossless for r in rows)
    texts = sorted((str(r.doc_id), r.text) for r in md.decode_documents(encoded, path).collect())
    assert texts == sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert sorted(map(str, md.encode_documents(clashing, path).collect())) == sorted(map(str, encoded.drop("ids").collect()))
    assert md.encode_documents(empty, path).count() == 0


def test_every_occurrence_is_drawn_on_its_own(spark, texts):
    path = tokenizer("piece_bpe_32k.model")
    docs = spark.createDataFrame([(i, "unbelievable") for i in range(300)], "doc_id long, text string")
    rows = md.encode_documents(docs, path, with_ids=True).collect()
    assert len({tuple(r.ids) for r in rows}) > 8 and all(r.lossless for r in rows)
    enc = md.DropoutEncoder(path, 7, 0.3)
    words = [" international", " unbelievable", "naïveté", " a", "xy▁zzy" * 2, " the", "x" * 16, " Geschwindigkeitsbegrenzung", "w" * 300] * 40
    streams = md.mix64(np.arange(len(words)))
    flat, number = enc.words(words, streams)
    ids = [list(x) for x in np.split(flat, np.cumsum(number)[:-1])]
    assert len({tuple(x) for x, w in zip(ids, words, strict=True) if w == " international"}) > 8
    enc._learn(list(dict.fromkeys(words)))
    for _ in range(2):  # the second time all runs are known
        for i, w in enumerate(words):
            n = enc.known[w]
            if enc.root.data[n] >= 0:
                run = enc._descend(enc.root.data[n : n + 1].copy(), enc.keys(enc.crc.data[n : n + 1], streams[i : i + 1]))[0]
                assert enc.flat.data[enc.start.data[run] : enc.start.data[run] + enc.size.data[run]].tolist() == ids[i], w
    few = md.DropoutEncoder(path, 7, 0.1, most_merges=50)
    assert encode(few, texts)[0] == encode(md.DropoutEncoder(path, 7, 0.1), texts)[0]


def test_working_memory_of_a_slice(medium):
    enc = md.DropoutEncoder(tokenizer("piece_bpe_32k.model"), 7, 0.1)
    text = "\n".join(r.text or "" for r in medium("documents").select("text").limit(700).collect())[: 1 << 20]
    data = np.frombuffer(text.encode(), np.uint8)
    args = np.arange(2), np.tile(data, 2), np.array([0, len(data), 2 * len(data)])
    assert len(data) > 1 << 19
    peaks = []
    for _ in range(2):  # with words to be learned, with known ones
        tracemalloc.start()
        pieces, at, spaced, ends = enc.encode(*args)
        raw, back = enc.decode(pieces, at)
        peaks.append(tracemalloc.get_traced_memory()[1] / len(args[1]))
        tracemalloc.stop()
        assert np.array_equal(raw, spaced) and back.tolist() == ends.tolist()
    print(f"bytes at once for each byte of text: {peaks}")
    assert peaks[0] < 50 and peaks[1] < 40
    enc._learn([str(i) for i in range(1000)])
    assert sum(x.data.itemsize for x in (enc.spot, enc.child)) <= 6
