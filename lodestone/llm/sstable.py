"""Sorted-string-table shards of token ids.

File layout, little-endian throughout::

    data block *   zstd-compressed run of entries, about ``block_bytes`` before compression
    sparse index   per block: varint key length, last key of the block, u64 file offset, u32 compressed size, u32 plain size
    Bloom filter   u64 words, double hashing of the key
    footer         72 bytes: magic, index offset and size, Bloom offset and size, documents, ids, id width, Bloom hashes

An entry is varint(shared prefix with the previous key of the block), varint(rest of the key), varint(value bytes), the rest of
the key, the value.  The first entry of a block shares nothing, so any block can be read alone.  A key
is 0x01 and the identifier as an order-preserving big-endian 64-bit number; a null identifier is the single byte 0x00.
Values are ids of two bytes each if the vocabulary allows it, else four.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

from lodestone.llm.arrow_text import mix64

MAGIC = b"LSTNSST1"
FOOTER = struct.Struct("<8sQQQQQQII8x")


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & (2**64 - 1))


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def put_varint(out: bytearray, n: int) -> None:
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)


def get_varint(buf: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = buf[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def bloom_bits(doc_ids: np.ndarray, n_bits: int, hashes: int) -> np.ndarray:
    h = mix64(doc_ids.astype(np.int64).view(np.uint64))
    step = mix64(h) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.concatenate([(h + np.uint64(i) * step) % np.uint64(n_bits) for i in range(hashes)])


class SSTableWriter:
    """Streams entries in key order; blocks go out as they fill, so memory stays at one block and the index."""

    def __init__(self, sink, id_width: int, block_bytes: int = 64 << 10, bloom_hashes: int = 7, bits_per_key: int = 10):
        self.sink, self.width, self.block_bytes, self.hashes, self.bits = sink, id_width, block_bytes, bloom_hashes, bits_per_key
        self.block, self.index, self.last, self.offset = bytearray(), bytearray(), b"", 0
        self.ids: list[int] = []
        self.n_docs = self.n_ids = 0
        self.prior: bytes | None = None

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        key = key_of(doc_id)
        if self.prior is not None and key < self.prior:
            raise ValueError("keys must come in ascending order")
        value = ids.astype(f"<u{self.width}").tobytes()
        shared = 0
        if self.block:
            while shared < len(key) and shared < len(self.last) and key[shared] == self.last[shared]:
                shared += 1
        put_varint(self.block, shared)
        put_varint(self.block, len(key) - shared)
        put_varint(self.block, len(value))
        self.block += key[shared:] + value
        self.last = self.prior = key
        self.ids.append(0 if doc_id is None else doc_id)
        self.n_docs += 1
        self.n_ids += len(ids)
        if len(self.block) >= self.block_bytes:
            self._flush()

    def _flush(self) -> None:
        if not self.block:
            return
        packed = pa.compress(bytes(self.block), codec="zstd", asbytes=True)
        put_varint(self.index, len(self.last))
        self.index += self.last + struct.pack("<QII", self.offset, len(packed), len(self.block))
        self.sink.write(packed)
        self.offset += len(packed)
        self.block, self.last = bytearray(), b""

    def close(self) -> None:
        self._flush()
        n_bits = -(-max(64, self.bits * self.n_docs) // 64) * 64
        words = np.zeros(n_bits // 64, np.uint64)
        if self.ids:
            at = bloom_bits(np.array(self.ids, np.int64), n_bits, self.hashes)
            np.bitwise_or.at(words, at // np.uint64(64), np.uint64(1) << (at % np.uint64(64)))
        bloom = words.astype("<u8").tobytes()
        self.sink.write(bytes(self.index))
        self.sink.write(bloom)
        self.sink.write(FOOTER.pack(MAGIC, self.offset, len(self.index), self.offset + len(self.index), len(bloom), self.n_docs, self.n_ids, self.width, self.hashes))


class SSTableReader:
    """Footer, index and Bloom filter in memory; blocks are read when asked for."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        magic, index_at, index_len, bloom_at, bloom_len, self.n_docs, self.n_ids, self.width, self.hashes = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        index, at = file.read_at(index_len, index_at), 0
        self.last_keys: list[bytes] = []
        self.blocks: list[tuple[int, int, int]] = []
        while at < len(index):
            n, at = get_varint(index, at)
            self.last_keys.append(index[at : at + n])
            self.blocks.append(struct.unpack_from("<QII", index, at + n))
            at += n + 16
        self.bloom = np.frombuffer(file.read_at(bloom_len, bloom_at), "<u8")

    def might_contain(self, doc_id: int | None) -> bool:
        at = bloom_bits(np.array([doc_id or 0], np.int64), len(self.bloom) * 64, self.hashes)
        return bool(((self.bloom[at // np.uint64(64)] >> (at % np.uint64(64))) & np.uint64(1)).all())

    def _entries(self, i: int) -> Iterator[tuple[bytes, bytes]]:
        offset, packed, plain = self.blocks[i]
        block = pa.decompress(self.file.read_at(packed, offset), decompressed_size=plain, codec="zstd", asbytes=True)
        at, key = 0, b""
        while at < len(block):
            shared, at = get_varint(block, at)
            rest, at = get_varint(block, at)
            size, at = get_varint(block, at)
            key = key[:shared] + block[at : at + rest]
            yield key, block[at + rest : at + rest + size]
            at += rest + size

    def scan(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(len(self.blocks)):
            for key, value in self._entries(i):
                yield id_of(key), np.frombuffer(value, f"<u{self.width}")

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """All values under the key (repeated identifiers are kept), found by Bloom filter and binary search of the index."""
        if not self.might_contain(doc_id):
            return []
        key, found = key_of(doc_id), []
        for i in range(bisect.bisect_left(self.last_keys, key), len(self.blocks)):
            hits = [np.frombuffer(v, f"<u{self.width}") for k, v in self._entries(i) if k == key]
            found += hits
            if self.last_keys[i] > key:
                break
        return found


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), uri
