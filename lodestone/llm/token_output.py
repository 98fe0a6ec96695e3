"""Token ids of whole documents, written as sorted-string-table shards and read back.

Documents are range-partitioned by identifier, encoded where they land, and each partition streams one shard into the
shared folder (temporary name, then rename, so a retried task leaves no partial shard).  The shard list,
one row a shard, goes to the driver, which adds up the id counts so that every document knows how many
ids come before it; the shards are then read back in parallel.

Encoding: the byte-level pre-tokeniser always breaks before the white space that precedes a word, and between a letter and punctuation, so a text is cut there, the
distinct pieces of a slice are encoded once with the tokenizers library, and ids are gathered back by piece.  New pieces go to the library in runs, as one text
each, for its work on a short text is mostly fixed; ids stand for bytes, so the pieces' ids are told apart by counting these.

Defined results: null text encodes as the empty text (only the end id); repeated identifiers keep every row, ordered by text;
null identifiers come first; an empty table gives no rows.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from itertools import accumulate, batched, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow_text import ragged_take, slices, utf8_view
from lodestone.llm.shared import new_folder, plan_bytes, small_batches, trimmed
from lodestone.llm.sstable import SSTableReader, SSTableWriter, filesystem

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x0A]] = True
WORD_START = np.zeros(256, bool)
WORD_START[0x21:0x7F] = True
WORD_START[0xC3] = True  # U+00C0 to U+00FF, none of them white space
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[0x41:0x5B] = ASCII_LETTER[0x61:0x7B] = True
PUNCTUATION = WORD_START & ~ASCII_LETTER
PUNCTUATION[0x30:0x3A] = PUNCTUATION[0xC3] = False
LATIN_TAIL = np.zeros(256, bool)
LATIN_TAIL[0x80:0xC0] = True
LATIN_TAIL[[0x97, 0xB7]] = False  # after 0xC3: the multiplication and division signs, no letters


def piece_offsets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of the pieces: document starts, each space or line feed before a visible character, and each ASCII punctuation mark after a Latin letter."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[: len(data) - 1] = SPACES[data[:-1]] & WORD_START[data[1:]]
        letter = ASCII_LETTER[data]
        letter[1:] |= LATIN_TAIL[data[1:]] & (data[:-1] == 0xC3)
        cut[1 : len(data)] |= letter[:-1] & PUNCTUATION[data[1:]]
        last = offsets[1:-1] - 1
        last = last[(last >= 0) & SPACES[data[last]]]
        cut[last[last + 1 < len(data)]] = False  # what follows belongs to another document
    cut[offsets] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Ids of pieces, remembered up to ``capacity`` pieces; then those met in one slice only are forgotten, or all if the others are over half."""

    def __init__(self, path: str, capacity: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; the library's threads cost more than they share
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.n_bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # byte-level tokens have a character for each byte
        self.capacity = capacity
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)

    def _forget(self) -> None:
        kept = np.flatnonzero(self.again[: len(self.known)])
        if len(kept) > self.capacity // 2:
            return self._reset()
        pieces = list(self.known)
        pieces, sizes = [pieces[i] for i in kept.tolist()], self.length[kept]
        ids = ragged_take(self.flat, self.start[kept], sizes)
        self._reset()
        self._remember(pieces, ids, sizes)

    def _remember(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n0, n1 = len(self.known), len(self.known) + len(pieces)
        while n1 > len(self.start):
            self.start, self.length, self.again = (np.resize(x, 2 * len(x)) for x in (self.start, self.length, self.again))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[n0:n1], self.length[n0:n1], self.again[n0:n1] = self.used + np.cumsum(sizes) - sizes, sizes, False
        self.used += len(ids)
        self.known.update(zip(pieces, range(n0, n1), strict=True))

    def _ids(self, pieces: pa.StringArray, run: int = 32) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids of each): pieces that begin with white space before a visible character follow others in one text, ``run`` at most."""
        data, offsets, _ = utf8_view(pieces)
        longer = np.flatnonzero(np.diff(offsets) > 1)
        follows = np.zeros(len(pieces), bool)
        follows[longer] = SPACES[data[offsets[longer]]] & WORD_START[data[offsets[longer] + 1]]
        first = np.flatnonzero(~follows | (np.arange(len(pieces)) % run == 0))
        texts = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets[np.append(first, len(pieces))].astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_numpy(zero_copy_only=False).tolist(), add_special_tokens=False)]
        number = np.fromiter(map(len, found), np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, count=int(number.sum()))
        if run == 1:
            return ids, number
        ends = np.concatenate([[0], np.cumsum(self.n_bytes[ids])])
        at = np.searchsorted(ends, offsets)
        if ends[-1] != offsets[-1] or not np.array_equal(ends[at], offsets):  # ids that do not stand for the bytes of the text
            return self._ids(pieces, 1)
        return ids, np.diff(at)

    def numbers(self, pieces: pa.StringArray) -> np.ndarray:
        """The place of each of some distinct pieces among the known ones."""
        if len(self.known) > self.capacity:
            self._forget()
        texts = pieces.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, count=len(texts))
        missing = number < 0
        self.again[number[~missing]] = True
        missing = np.flatnonzero(missing)
        for lo in range(0, len(missing), 20_000):
            rows = missing[lo : lo + 20_000]
            n0 = len(self.known)
            self._remember([texts[i] for i in rows.tolist()], *self._ids(pieces.take(pa.array(rows))))
            number[rows] = np.arange(n0, n0 + len(rows))
        return number

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets of the documents in them)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cuts = piece_offsets(data, offsets)
        column = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
        coded = column.dictionary_encode()
        number = self.numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.length[number]
        ids = ragged_take(self.flat, self.start[number], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.searchsorted(cuts, offsets)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


WRITTEN = "shard string, first_id long, n_docs long, n_ids long, part int"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, slice_bytes: int = 6 << 20, shard_bytes: int = 128 << 20) -> list[dict]:
    """Write one shard a range partition; returns the shard list in key order, with the ids before each shard.

    There are as many shards as shuffle partitions are set, or more, so that each holds ``shard_bytes`` of the input on average at most.
    """

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        enc, fs, root = encoder(tokenizer), *filesystem(folder)
        fs.create_dir(root, recursive=True)
        name = f"shard-{part:06d}.sst"
        temporary = f"{root}/.{name}.{TaskContext.get().taskAttemptId()}"
        writer = sink = first = None
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets, _ in slices(batch.column("text"), slice_bytes):
                ids, ends = enc.encode(data, offsets)
                for i, doc_id in enumerate(doc_ids[lo:hi]):
                    if writer is None:
                        sink = fs.open_output_stream(temporary)
                        writer, first = SSTableWriter(sink, enc.width), doc_id
                    writer.add(doc_id, np.append(ids[ends[i] : ends[i + 1]], np.uint32(end_id)))
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(temporary, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([first], pa.int64()), pa.array([writer.n_docs], pa.int64()), pa.array([writer.n_ids], pa.int64()), pa.array([part], pa.int32())], names=["shard", "first_id", "n_docs", "n_ids", "part"])

    # batches of some 30 MB: pieces repeat within a slice, so smaller ones cost time
    wanted = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(plan_bytes(docs) / shard_bytes))
    ordered = docs.select("doc_id", "text").repartitionByRange(wanted, "doc_id").sortWithinPartitions("doc_id", "text")
    shards = sorted((r.asDict() for r in small_batches(ordered, 10_000).mapInArrow(run, WRITTEN).collect()), key=lambda r: r["part"])
    before = 0
    for shard in shards:
        shard["before"] = before
        before += shard["n_ids"]
    return shards


def read_shards(spark, folder: str, shards: list[dict]) -> DataFrame:
    """Read every shard back: identifier, ids before the document, its number of ids and their checksum."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for name, before in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with fs.open_input_file(f"{root}/{name}") as file:
                    measured = ((doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc_id, ids in SSTableReader(file).scan())
                    for rows in batched(measured, 100_000):
                        keys, sizes, sums = zip(*rows, strict=True)
                        starts = list(accumulate(sizes, initial=before))
                        before = starts.pop()
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (keys, starts, sizes, sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame([(s["shard"], s["before"]) for s in shards], "shard string, before long")
    return listed.repartition(max(1, len(shards)), F.col("shard")).mapInArrow(run, READ)


def token_shards(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    folder = new_folder(docs.sparkSession, "token-shards")
    return read_shards(docs.sparkSession, folder, write_shards(docs, tokenizer, folder, end_id))
