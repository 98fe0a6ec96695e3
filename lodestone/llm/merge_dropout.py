"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

Encoding takes the best-scored merge of neighbouring pieces until none is left (ties: leftmost).  With dropout, a candidate merge is skipped for good
when a keyed hash of (seed, stream, word, start, middle, end) falls under the dropout rate, so the segmentation varies with the
seed and stream but never with the order of tasks.  The stream of a word occurrence is a hash of the seed, doc_id and the word's number
in the text, so every occurrence in the corpus is drawn on its own.  Rate 0 gives the library's own encoding.

No piece spans certain neighbouring characters (a letter and the space after it, say).  Texts are cut wherever the bytes on both
sides never meet inside a piece, which changes no result.  A skipped merge matters only where it would have been carried out, so a short word's
encodings form a tree: a run is the merges carried out under a set of skipped ones, and the first merge of it that an occurrence's hash skips
leads on to the run with that one skipped too.  Occurrences go down the tree many at a time in numpy, only runs met for the first time are
merged, and the pieces are gathered back; long words are merged for each occurrence.  Working memory is bounded in every step: of a slice of
texts only narrow arrays are held whole, and what grows with merges or bytes is made for a block of it at a time.  Characters outside the vocabulary become byte pieces,
so decoding returns every text exactly; U+2581 itself is coded by bytes to stay apart from the space it stands for.

Defined results: null and empty texts have no pieces; a null doc_id counts as -1 for the stream; repeated rows are encoded alike;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow_text import mix64, ragged_take, slices
from lodestone.llm.shared import release_memory, small_batches, trimmed

META = "▁"
NONE = np.int64(1 << 40)
WIDTHS = (8, 16, 32, 64, 128, 256)
TREE_WIDTH = 16
BLOCK = 1 << 15  # occurrences, pieces or new words handled at once
CELLS = 1 << 18  # characters handled at once


class PieceModel:
    """Vocabulary tables of a SentencePiece BPE model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        ids = {names[i]: i for i in range(n) if plain[i]}
        self.byte0 = sp.piece_to_id("<0x00>")
        order = sorted(ids.values(), key=lambda i: (-sp.get_score(i), i))
        self.rank = np.full(n, NONE)
        self.rank[order] = np.arange(len(order))
        self.of_rank = np.array(order, np.int64)
        self.of_char = np.full(0x110000, -1, np.int32)
        pairs: dict[int, int] = {}
        met = np.zeros((256, 256), bool)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
                continue
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                met[left[-1].replace(META, " ").encode()[-1], right[0].replace(META, " ").encode()[0]] = True
                if left in ids and right in ids:
                    pairs[ids[left] << 20 | ids[right]] = i
        self.of_char[0x20], self.of_char[ord(META)] = self.of_char[ord(META)], -1
        self.met = met.ravel()
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        self.pair_key, self.pair_rank = keys, self.rank[[pairs[int(k)] for k in keys]]
        raw = [bytes([i - self.byte0]) if sp.is_byte(i) else names[i].replace(META, " ").encode() if plain[i] else b"" for i in range(n)]
        self.piece_size = np.array([len(x) for x in raw], np.int32)
        self.piece_at = (np.cumsum(self.piece_size) - self.piece_size).astype(np.int32)
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair makes, NONE if it makes none."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0), self.pair_rank[at], NONE)


def spot_of(start, middle, end) -> np.ndarray:
    """The merge of [start, middle) and [middle, end) as one number."""
    return np.asarray(start).astype(np.uint64) << np.uint64(42) ^ np.asarray(middle).astype(np.uint64) << np.uint64(21) ^ np.asarray(end).astype(np.uint64)


def code_of(spot: np.ndarray) -> np.ndarray:
    """The spot of a merge within a short word in 15 bits, an index to ``SPOTS`` and ``MIXED``."""
    return ((spot >> np.uint64(32)) | (spot >> np.uint64(16)) & np.uint64(31 << 5) | spot & np.uint64(31)).astype(np.uint16)


SPOTS = spot_of(np.arange(1 << 15) >> 10, np.arange(1 << 15) >> 5 & 31, np.arange(1 << 15) & 31)
MIXED = mix64(SPOTS)


def dropped(key: np.ndarray, spot: np.ndarray, limit: int) -> np.ndarray:
    """Whether the keyed hash skips the merge."""
    if limit == 0:
        return np.zeros(np.broadcast(key, spot).shape, bool)
    return mix64(key ^ mix64(spot)) < np.uint64(limit)


def agenda(model: PieceModel, symbols: list[int], key: int, limit: int) -> list[int]:
    """One long word: candidates wait in a heap by score and place; a stale or skipped one is passed over."""
    n = len(symbols)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []
    word = np.array([key], np.uint64)

    def offer(i: int) -> None:
        j = after[i]
        if j < n and symbols[i] >= 0 and symbols[j] >= 0:
            made = model.pairs.get(symbols[i] << 20 | symbols[j])
            if made is not None and not dropped(word, spot_of([i], [j], [end[j]]), limit)[0]:
                heapq.heappush(heap, (int(model.rank[made]), i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, j, stop = heapq.heappop(heap)
        if not alive[i] or j >= n or not alive[j] or after[i] != j or end[j] != stop:
            continue
        if model.pairs.get(symbols[i] << 20 | symbols[j]) != model.of_rank[rank]:
            continue
        symbols[i], alive[j], end[i], after[i] = int(model.of_rank[rank]), False, end[j], after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s, a in zip(symbols, alive, strict=True) if a]


def merge_words(model: PieceModel, symbols: np.ndarray, sizes: np.ndarray, skip: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge many short words side by side, in place, but for the merges that ``skip(word, spot)`` holds for; symbols [word, place].

    Returns the places still in use, and the merges carried out: their words, ascending, and their spots in order.
    """
    n, width = symbols.shape
    place = np.arange(width)
    alive = place < sizes[:, None]
    after = np.where(place + 1 < sizes[:, None], place + 1, width)
    before = np.tile(place - 1, (n, 1))
    end = np.tile(place + 1, (n, 1))
    rank = np.full((n, width), NONE)
    if width > 1:
        rank[:, :-1] = np.where(alive[:, 1:], model.merged(symbols[:, :-1], symbols[:, 1:]), NONE)
        rank[:, :-1][skip(np.arange(n)[:, None], spot_of(place[None, :-1], place[None, 1:], place[None, 1:] + 1))] = NONE
    todo = np.arange(n)
    done = [(todo[:0], np.zeros(0, np.uint64))]
    while len(todo):
        i = rank[todo].argmin(axis=1)
        best = rank[todo, i]
        go = best < NONE
        todo, i, best = todo[go], i[go], best[go]
        if not len(todo):
            break
        j = after[todo, i]
        done.append((todo, spot_of(i, j, end[todo, j])))
        symbols[todo, i] = model.of_rank[best]
        alive[todo, j] = False
        rank[todo, j] = NONE
        end[todo, i] = end[todo, j]
        nxt = after[todo, j]
        after[todo, i] = nxt
        has = nxt < width
        before[todo[has], nxt[has]] = i[has]
        rank[todo, i] = NONE
        for word, a, b in ((todo[has], i[has], nxt[has]), (todo, before[todo, i], i)):
            ok = a >= 0
            word, a, b = word[ok], a[ok], b[ok]
            new = model.merged(symbols[word, a], symbols[word, b])
            new[skip(word, spot_of(a, b, end[word, b]))] = NONE
            rank[word, a] = new
    word, spot = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return alive, word[order], spot[order]


def runs_of(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(new)


def take_runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``ragged_take`` of many short runs, a block of them at a time."""
    parts = [ragged_take(flat, starts[lo : lo + BLOCK].astype(np.int64), lengths[lo : lo + BLOCK].astype(np.int64)) for lo in range(0, len(starts), BLOCK)]
    return np.concatenate(parts) if parts else flat[:0]


class Pool:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.used = np.zeros(1 << 14, dtype), 0

    def add(self, values: np.ndarray) -> int:
        """Append; where the values begin."""
        at, self.used = self.used, self.used + len(values)
        if self.used > len(self.data):
            grown = np.zeros(max(self.used, 2 * len(self.data)), self.data.dtype)
            grown[:at] = self.data[:at]
            self.data = grown
        self.data[at : self.used] = values
        return at


class DropoutEncoder:
    """Pieces of words by the trees of their runs, remembered up to ``capacity`` words and ``most_merges`` merges; then the memory starts anew.

    With ``streams`` occurrences share so many streams, so a word has at most so many encodings; 0: each has its own.
    """

    def __init__(self, path: str, seed: int, rate: float, streams: int = 0, capacity: int = 150_000, most_merges: int = 4_000_000):
        self.model, self.seed, self.streams, self.capacity, self.most_merges = PieceModel(path), seed, streams, capacity, most_merges
        self.limit = min(2**64 - 1, int(rate * 2.0**64))
        self.salt = mix64(np.array([seed], np.int64).view(np.uint64))
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}  # word -> its number
        self.names: list[str] = []
        self.crc, self.root = Pool(np.uint32), Pool(np.int32)  # of each word: its checksum, its run without skipped merges (-1: a long word)
        self.name, self.parent, self.skipped, self.base = Pool(np.int32), Pool(np.int32), Pool(np.uint16), Pool(np.uint8)  # of each run: word, run it leaves, where (as a code), after how many merges
        self.start, self.size = Pool(np.int32), Pool(np.uint8)  # of each run, in ``flat``
        self.first, self.merges = Pool(np.int32), Pool(np.uint8)  # of each run: its merges from ``base`` on, in the two below
        self.spot, self.child = Pool(np.uint16), Pool(np.int32)  # the spots as codes
        self.flat = Pool(np.uint16 if len(self.model.rank) <= 1 << 16 else np.uint32)

    def keys(self, crc: np.ndarray, streams: np.ndarray) -> np.ndarray:
        return mix64(crc.astype(np.uint64) << np.uint64(8) ^ streams.astype(np.uint64) ^ self.salt)

    def words(self, words: list[str], streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all words, number of pieces of each), merged in groups of similar length."""
        key = self.keys(np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, count=len(words)), streams)
        flat, number, _, _ = self._merge(words, key, lambda mine: lambda word, spot: dropped(key[mine[word]], spot, self.limit))
        return flat, number

    def _merge(self, words: list[str], key: np.ndarray | None, skips: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pieces of all words, number of pieces of each, words of the merges carried out, their spots); ``skips`` makes the test for some of the words."""
        sizes = np.fromiter(map(len, words), np.int64, count=len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols = self.model.of_char[points].astype(np.int64)
        symbols[symbols < 0] = -1 - points[symbols < 0]
        at = np.cumsum(sizes) - sizes
        parts: list[tuple[np.ndarray, ...]] = []  # words, their numbers of pieces, the pieces, words of the merges, their spots
        low = 0
        for width in WIDTHS:
            mine = np.flatnonzero((sizes > low) & (sizes <= width))
            step = CELLS // width
            for lo in range(0, len(mine), step):
                w = mine[lo : lo + step]
                table = symbols[np.minimum(at[w][:, None] + np.arange(width), len(symbols) - 1)]
                alive, word, spot = merge_words(self.model, table, sizes[w], skips(w))
                parts.append((w, alive.sum(axis=1), table[alive], w[word], spot))
            low = width
        for w in np.flatnonzero(sizes > low):
            out = agenda(self.model, symbols[at[w] : at[w] + sizes[w]].tolist(), int(key[w]), self.limit)
            parts.append((np.array([w]), np.array([len(out)]), np.array(out, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)))
        number = np.zeros(len(words), np.int64)
        begin = np.zeros(len(words), np.int64)
        base = 0
        for w, n, out, _, _ in parts:
            number[w], begin[w] = n, base + np.cumsum(n) - n
            base += len(out)
        flat = ragged_take(np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64), begin, number)
        word, spot = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype) for i, dtype in ((3, np.int64), (4, np.uint64)))
        order = np.argsort(word, kind="stable")
        return *self._bytes_of_unknown(flat, number), word[order], spot[order]

    def _new_runs(self, name: np.ndarray, parent: np.ndarray, skipped: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Numbers of new runs of the words ``name``: with ``skipped`` besides all that ``parent`` skips, or with nothing skipped (all parents -1)."""
        bans, up = [], parent
        if (parent >= 0).all():
            bans.append(SPOTS[skipped])
            while (more := self.parent.data[up] >= 0).any():
                bans.append(SPOTS[np.where(more, self.skipped.data[up], skipped)])
                up = np.where(more, self.parent.data[up], up)

        def skips(mine: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
            def skip(word: np.ndarray, spot: np.ndarray) -> np.ndarray:
                hit = np.zeros(np.broadcast(word, spot).shape, bool)
                for ban in bans:
                    hit |= ban[mine[word]] == spot
                return hit

            return skip

        flat, number, word, spot = self._merge([self.names[i] for i in name.tolist()], None, skips)
        made = np.bincount(word, minlength=len(name))
        spot = spot[np.arange(len(word)) - (np.cumsum(made) - made)[word] >= base[word]]
        left = made - base
        self.start.add(self.flat.add(flat) + np.cumsum(number) - number)
        self.size.add(number)
        self.first.add(self.spot.add(code_of(spot)) + np.cumsum(left) - left)
        self.child.add(np.full(len(spot), -1))
        self.merges.add(left)
        self.parent.add(parent)
        self.skipped.add(skipped)
        self.base.add(base)
        return np.arange(len(name)) + self.name.add(name)

    def _learn(self, names: list[str]) -> None:
        """Give each new word its number and its run without skipped merges."""
        new = [name for name in names if name not in self.known]
        for lo in range(0, len(new), BLOCK):
            part = new[lo : lo + BLOCK]
            at = len(self.names)
            self.known.update(zip(part, range(at, at + len(part)), strict=True))
            self.names += part
            self.crc.add(np.fromiter((zlib.crc32(w.encode()) for w in part), np.uint64, count=len(part)))
            root = np.full(len(part), -1)
            short = np.flatnonzero(np.fromiter(map(len, part), np.int64, count=len(part)) <= TREE_WIDTH)
            zero = np.zeros(len(short), np.int64)
            root[short] = self._new_runs(at + short, zero - 1, zero.astype(np.uint16), zero)
            self.root.add(root)

    def _descend(self, run: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The run of each occurrence of short words, from the one in which nothing is skipped."""
        todo = np.arange(len(run), dtype=np.int32) if self.limit else np.zeros(0, np.int32)
        while len(todo):
            who, place = self._first_skipped(run, key, todo)
            todo, now = todo[who], run[todo[who]]
            unmet = np.flatnonzero(self.child.data[place] < 0)
            at, one = np.unique(place[unmet], return_index=True)
            parent = now[unmet[one]]
            for lo in range(0, len(at), BLOCK):
                a, p = at[lo : lo + BLOCK], parent[lo : lo + BLOCK]
                made = self._new_runs(self.name.data[p], p, self.spot.data[a], self.base.data[p] + a - self.first.data[p])
                self.child.data[a] = made
            run[todo] = self.child.data[place]
        return run

    def _first_skipped(self, run: np.ndarray, key: np.ndarray, todo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``todo`` of the occurrences that skip a merge of their run, the first such merge of each)."""
        found = []
        for lo in range(0, len(todo), BLOCK):
            part = todo[lo : lo + BLOCK]
            now = run[part]
            n = self.merges.data[now].astype(np.int64)
            who = np.repeat(np.arange(len(part)), n)
            place = np.arange(len(who)) + (self.first.data[now] - (np.cumsum(n) - n))[who]
            hit = np.flatnonzero(mix64(key[part][who] ^ MIXED[self.spot.data[place]]) < np.uint64(self.limit))
            hit = hit[runs_of(who[hit])]
            found.append(((lo + who[hit]).astype(np.int32), place[hit].astype(np.int32)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _bytes_of_unknown(self, flat: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unknown = np.flatnonzero(flat < 0)
        if not len(unknown):
            return flat, number
        coded = [chr(-1 - int(flat[i])).encode("utf-8", "surrogatepass") for i in unknown]
        width = np.ones(len(flat), np.int64)
        width[unknown] = [len(c) for c in coded]
        out = np.repeat(flat, width)
        out[out < 0] = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64) + self.model.byte0
        word = np.repeat(np.arange(len(number)), number)
        return out, np.bincount(word, weights=width, minlength=len(number)).astype(np.int64)

    def encode(self, doc_ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pieces, offsets of the documents in them, the texts with the space before each, offsets of the documents there)."""
        full = np.diff(offsets) > 0
        ends = offsets + np.concatenate([[0], np.cumsum(full)])
        spaced = np.full(len(data) + int(full.sum()), 0x20, np.uint8)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), spaced, ends
        taken = np.ones(len(spaced), bool)
        taken[ends[:-1][full]] = False
        spaced[taken] = data
        cut = np.zeros(len(spaced) + 1, bool)
        for lo in range(1, len(spaced), CELLS):
            left, right = spaced[lo - 1 : lo - 1 + CELLS], spaced[lo : lo + CELLS]
            cut[lo : lo + len(right)] = ~self.model.met[left[: len(right)].astype(np.int64) << 8 | right] & ((right & 0xC0) != 0x80)
        cut[ends] = True
        cuts = np.flatnonzero(cut).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(spaced)).dictionary_encode()
        names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        first = np.searchsorted(cuts, ends.astype(np.int32))
        if len(self.known) > self.capacity or self.spot.used > self.most_merges:
            self._reset()
        self._learn(names)
        word = np.fromiter(map(self.known.__getitem__, names), np.int32, count=len(names))[code]
        run, key, stream = self.root.data[word], np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
        of_doc = mix64(doc_ids.view(np.uint64) ^ self.salt)
        for lo in range(0, len(word), BLOCK):
            place = np.arange(lo, min(lo + BLOCK, len(word)))
            doc = np.searchsorted(first, place, side="right") - 1
            drawn = mix64(of_doc[doc] ^ (place - first[doc]).astype(np.uint64))
            stream[place] = drawn % np.uint64(self.streams) if self.streams else drawn
            key[place] = self.keys(self.crc.data[word[place]], stream[place])
        short, long = np.flatnonzero(run >= 0), np.flatnonzero(run < 0)
        run[short] = self._descend(run[short], key[short])
        number, spelt = self.size.data[run].astype(np.int32), []
        size = np.cumsum([len(names[i]) for i in code[long].tolist()])
        for mine in np.split(long, np.searchsorted(size, np.arange(CELLS, size[-1], CELLS)) if len(long) else []):
            flat, number[mine] = self.words([names[i] for i in code[mine].tolist()], stream[mine])
            spelt.append(flat.astype(self.flat.data.dtype))
        at = np.concatenate([[0], np.cumsum(number, dtype=np.int64)])
        pieces = take_runs(self.flat.data, self.start.data[run[short]], number[short])
        if len(long):
            whole, mixed = np.zeros(len(word), bool), np.zeros(at[-1], self.flat.data.dtype)
            whole[long] = True
            whole = np.repeat(whole, number)
            mixed[~whole], mixed[whole] = pieces, np.concatenate(spelt)
            pieces = mixed
        return pieces, at[first], spaced, ends

    def decode(self, pieces: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets of the documents), each non-empty document still with the space before it."""
        number = self.model.piece_size[pieces]
        at = np.concatenate([[0], np.cumsum(number, dtype=np.int64)])
        return take_runs(self.model.piece_bytes, self.model.piece_at[pieces], number), at[offsets]


_ENCODERS: dict[tuple, DropoutEncoder] = {}


def encoder(*key) -> DropoutEncoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = DropoutEncoder(*key)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, model: str, seed: int = 20_240_601, rate: float = 0.1, streams: int = 0, with_ids: bool = False, slice_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_pieces, the checksum of the piece ids (little-endian, four bytes each), whether decoding them returns the text, and the ids if asked for."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model, seed, rate, streams)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, offsets, _ in slices(batch.column("text"), slice_bytes):
                pieces, at, spaced, ends = enc.encode(np.ascontiguousarray(ids[lo:hi]), data, offsets)
                raw, back = enc.decode(pieces, at)
                if len(raw) == len(spaced):
                    wrong = np.flatnonzero(raw != spaced)
                    lossless = (np.diff(back) == np.diff(ends)) & (np.diff(np.searchsorted(wrong, ends)) == 0)
                else:
                    lossless = np.array([np.array_equal(raw[a:b], spaced[c:d]) for a, b, c, d in zip(back[:-1], back[1:], ends[:-1], ends[1:], strict=True)], bool)
                wide = memoryview(pieces.astype("<u4")).cast("B")
                crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                arrays = [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(crc, pa.int64()), pa.array(lossless)]
                names = ["doc_id", "n_pieces", "ids_crc32", "lossless"]
                if with_ids:
                    arrays, names = [*arrays, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(pieces.astype(np.int32)))], [*names, "ids"]
                del pieces, at, spaced, ends, raw, back, wide
                release_memory()
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + (", ids array<int>" if with_ids else "")
    return small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of the piece ids ``ids``."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model, 0, 0.0, 1)
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                pieces = np.array(ids or [], np.int64)
                raw, _ = enc.decode(pieces, np.array([0, len(pieces)]))
                texts.append(raw.tobytes()[1:].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
