"""Benchmark decontamination by SimHash of item-sized windows, with built-in functions only.

A window is as long as a benchmark item, in words of the lower-cased text; a shorter text is one window.  Windows are compared with the items of their length by the
similarity of their bags of five-word shingles (sum of smaller counts over sum of larger counts; a text of fewer words is one shingle).

1. Only windows that share shingles with an item can reach the threshold.  A bit table of the items' shingles is looked up in the
   document's own row, at every few words where that loses nothing (``safe_stride``); hits closer than the longest item form a region, and only
   regions, each with its words once, leave the row.
2. Windows are laid in a region at every start from which they cover as many known shingles as the threshold needs (``least_hits``), wherever the item
   has them, so passages in another order are judged too.
3. A window's fingerprint has several blocks: its shingles are dealt to blocks by their hash, and each block is the 64-bit SimHash of the
   shingles dealt to it.  A window and an item that reach the threshold differ in ``radius`` shingles at most, and each of them touches one block; with more
   occupied blocks than that one block at least agrees, so meeting on (length, block, bits) finds all pairs within the radius.
   Items too repetitive to fill the blocks get one block for each shingle.
4. The pairs' similarity is computed exactly from the shingles themselves.

One SimHash for the whole window would need a radius of 20 of its 64 bits to find a similarity of 0.8, that is 21 blocks of three bits, which nearly all
strangers pass; blocks of a few shingles are as safe and pass few (the tests print how many).

Items go to all tasks only while their shingles are counted to be few; otherwise the joins are exchanged.

Defined results: null and empty items match nothing; null and empty texts match nothing; repeated rows give one match each (doc_id, item_id);
repeated items match each; of windows equally similar the first counts; with an empty table there are no matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.quality_rules import let, words_of
from lodestone.llm.shared import cut, fresh

BROADCAST_ROWS = 250_000
LANES = 0x0001000100010001


def shingle_hashes(words: Column, size: int, stride: int = 1) -> Column:
    """Hashes of the runs of ``size`` words at every ``stride``-th word, each word hashed once; an empty array for shorter texts."""

    def runs(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - size, F.lit(stride)), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(F.size(h) >= size, each).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def safe_stride(shingle_counts: list[int], threshold: float, most: int = 4) -> int:
    """Largest stride at which a window that reaches the threshold still has a shared shingle at a looked-up position.

    Of m shingles such a window lacks at most m (1 - t) / (1 + t), so one of its m // stride positions at least is shared if those are more.
    Windows cut by the end of a text have t times the item's shingles at least.
    """
    longest = max(shingle_counts)
    for stride in range(most, 1, -1):
        least = max(1, math.floor(threshold * min(shingle_counts)))
        if all(m // stride > math.floor(m * (1 - threshold) / (1 + threshold) + 1e-9) for m in range(least, max(longest, least) + 1)):
            return stride
    return 1


def least_hits(shingle_count: Column, stride: int, threshold: float) -> Column:
    """Known shingles at looked-up positions that a window of ``shingle_count`` shingles has at least if it reaches the threshold."""
    lacks = F.floor(shingle_count * ((1 - threshold) / (1 + threshold)) + 1e-9)
    return F.greatest(F.floor(shingle_count / stride) - lacks, F.lit(1))


def shingles(words: str, size: int) -> str:
    """SQL for the shingles themselves; the whole text if it is shorter."""
    return f"if(size({words}) >= {size}, transform(sequence(1, size({words}) - {size - 1}), i -> array_join(slice({words}, i, {size}), ' ')), array(array_join({words}, ' ')))"


def bit_table(hashes: DataFrame, size_log: int) -> DataFrame:
    """One row: an array of 2 ** size_log bits, two set for each hash, so that few positions without a known shingle are looked up."""
    at = F.explode(F.array(F.expr(f"h & {(1 << size_log) - 1}L"), F.expr(f"shiftrightunsigned(h, 32) & {(1 << size_log) - 1}L")))
    words = hashes.select(at.alias("at")).groupBy(F.expr("shiftright(at, 6)").alias("i")).agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("w"))
    every = hashes.sparkSession.range(1 << (size_log - 6)).withColumnRenamed("id", "i")
    rows = every.join(words, "i", "left").select(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")).alias("x"))
    return rows.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["w"]).alias("bits"))


TABLE = "known_bits"


def maybe_known(h: Column, size_log: int) -> Column:
    """Whether both bits of the hash are set in the table."""
    mask = F.lit((1 << size_log) - 1).cast("long")

    def is_set(at: Column) -> Column:
        word = F.get(F.col(TABLE), F.call_function("shiftright", at, F.lit(6)).cast("int"))
        return F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63).cast("long")).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1

    return is_set(h.bitwiseAND(mask)) & is_set(F.call_function("shiftrightunsigned", h, F.lit(32)).bitwiseAND(mask))


def fingerprint_blocks(hashes: str, blocks: str) -> str:
    """SQL for (block, bits) of every occupied block: the SimHash of the hashes dealt to it, repeats included.

    A bit is set if it is set in over half of them.  With ``blocks`` 0 every distinct hash is a block of its own.
    """
    counts = f"aggregate(v, array_repeat(0L, 16), (acc, y) -> zip_with(acc, sequence(0, 15), (n, s) -> n + (shiftrightunsigned(y, s) & {LANES}L)))"
    bits = "aggregate(sequence(0, 63), 0L, (f, k) -> f | if(2 * (shiftrightunsigned(c[k % 16], int(16 * (k div 16))) & 65535L) > size(v), shiftleft(1L, k), 0L))"
    simhash = f"if(size(v) = 1, v[0], transform(array({counts}), c -> {bits})[0])"
    block = f"pmod(x, greatest({blocks}, 1L))"
    dealt = f"transform(array_distinct(transform({hashes}, x -> {block})), b -> named_struct('block', b, 'bits', transform(array(filter({hashes}, x -> {block} = b)), v -> {simhash})[0]))"
    return f"if({blocks} = 0, transform(array_distinct({hashes}), x -> named_struct('block', x, 'bits', x)), {dealt})"


def radius(shingle_count: str, threshold: float) -> str:
    """SQL for the most shingles in which a window and an item of ``shingle_count`` shingles differ if they reach the threshold."""
    return f"bigint(floor(2 * {shingle_count} * {(1 - threshold) / (1 + threshold)!r} + 1e-9))"


def block_counts(known: DataFrame, threshold: float) -> DataFrame:
    """(n, blocks): for each item length the fewest of radius + 1, twice and four times as many blocks of which every item occupies more than ``radius``, else 0."""
    least = radius("size(item_hashes)", threshold)
    tried = [f"{k} * ({least} + 1)" for k in (1, 2, 4)]
    enough = [F.expr(f"size(array_distinct(transform(item_hashes, x -> pmod(x, {b})))) > {least}") for b in tried]
    checked = known.groupBy("n").agg(*[F.bool_and(e).alias(f"fits{i}") for i, e in enumerate(enough)], *[F.max(F.expr(b)).alias(f"blocks{i}") for i, b in enumerate(tried)])
    return checked.select("n", F.coalesce(*[F.when(F.col(f"fits{i}"), F.col(f"blocks{i}")) for i in range(len(tried))], F.lit(0).cast("long")).alias("blocks"))


def known_items(items: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(item_id, item_words, n, item_shingles, item_hashes, blocks) of the items that have words."""
    words = items.select("item_id", words_of(F.lower(F.coalesce("text", F.lit("")))).alias("item_words")).where(F.size("item_words") > 0)
    known = words.select("item_id", "item_words", F.size("item_words").alias("n"), F.expr(shingles("item_words", shingle)).alias("item_shingles"))
    known = known.withColumn("item_hashes", F.coalesce(*[F.when(F.least("n", F.lit(shingle)) == s, shingle_hashes(F.col("item_words"), s)) for s in range(1, shingle + 1)]))
    return known.join(block_counts(known, threshold), "n")


def regions_of(docs: DataFrame, table: DataFrame, size_log: int, sizes: list[int], stride: int, longest: int) -> DataFrame:
    """(doc_id, total, first, words): the surroundings of known shingles, once each; a window that holds one lies in one region."""

    def cut_out(words: Column) -> Column:
        known_at = lambda hashes: F.filter(F.transform(hashes, lambda h, i: F.when(maybe_known(h, size_log), i * stride).otherwise(-1)), lambda i: i >= 0)
        parts = [let(shingle_hashes(words, s, stride), known_at) for s in sizes]
        spots = F.sort_array(F.array_union(F.concat(*parts), F.array().cast("array<int>"))) if len(parts) > 1 else parts[0]

        def grouped(at: Column) -> Column:
            heads = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda i: (i == 0) | (F.get(at, i) - F.get(at, i - 1) > longest))

            def region(i: Column, last: Column) -> Column:
                first = F.greatest(F.get(at, i) - longest, F.lit(0))
                return F.struct(F.size(words).alias("total"), first.alias("first"), F.slice(words, first + 1, F.get(at, last) + 2 * longest - first).alias("words"))

            return let(heads, lambda h: F.transform(h, lambda i, k: region(i, F.coalesce(F.get(h, k + 1), F.size(at)) - 1)))

        return let(spots, lambda at: F.when(F.size(at) > 0, grouped(at)))

    text = docs.select("doc_id", words_of(F.lower(F.coalesce("text", F.lit("")))).alias("words"))
    found = text.select("doc_id", table.scalar().alias(TABLE), "words").select("doc_id", let(F.col("words"), cut_out).alias("found"))
    found = found.where(F.size("found") > 0).select("doc_id", F.explode("found").alias("r")).select("doc_id", "r.*")
    return found.withColumn("region", F.xxhash64("doc_id", "total", "first", "words")).dropDuplicates(["doc_id", "region"])


def window_starts(threshold: float) -> Column:
    """Starts of the windows of ``window`` words that cover enough of the known shingles at ``spots``; work in proportion to the spots."""
    count = F.least("window", "total") - F.col("size") + 1
    last_start = F.greatest(F.col("total") - F.col("window"), F.lit(0))

    def around(need: Column) -> Column:
        runs = F.filter(F.sequence(F.lit(0), F.size("spots") - need), lambda i: F.get(F.col("spots"), i + need - 1) - F.get(F.col("spots"), i) < count)
        lowest = lambda i: F.greatest(F.get(F.col("spots"), i + need - 1) - count + 1, F.lit(0))
        highest = lambda i: F.least(F.get(F.col("spots"), i), last_start)
        starts = F.flatten(F.transform(runs, lambda i: F.when(lowest(i) <= highest(i), F.sequence(lowest(i), highest(i))).otherwise(F.array().cast("array<int>"))))
        return F.when(F.size("spots") >= need, F.array_distinct(starts)).otherwise(F.array().cast("array<int>"))

    return let(least_hits(count, 1, threshold).cast("int"), around)


def candidate_windows(docs: DataFrame, known: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(doc_id, region, window, blocks, start, w): item-sized windows with enough known shingles, each once, and their words."""
    lengths = [r[0] for r in known.select("n").distinct().collect()] or [shingle]
    sizes = sorted({min(n, shingle) for n in lengths})
    stride = safe_stride([max(1, n - shingle + 1) for n in lengths], threshold)
    anchors = cut(known.select(F.col("n").alias("window"), "blocks", F.explode("item_hashes").alias("h")).distinct())
    n_anchors = anchors.count()
    small = F.broadcast if n_anchors <= BROADCAST_ROWS else (lambda df: df)
    size_log = min(24, max(12, (64 * n_anchors).bit_length()))
    table = cut(bit_table(anchors.select("h"), size_log))
    regions = cut(regions_of(docs, table, size_log, sizes, stride, max(lengths)))
    at = lambda s: F.transform(shingle_hashes(F.col("words"), s), lambda h, i: F.struct(F.lit(s).alias("size"), (F.col("first") + i).alias("spot"), h.alias("h")))
    spots = regions.select("doc_id", "region", "total", "first", "words", table.scalar().alias(TABLE))
    spots = spots.select("doc_id", "region", "total", F.explode(F.filter(F.concat(*[at(s) for s in sizes]), lambda x: maybe_known(x["h"], size_log))).alias("x"))
    met = spots.select("doc_id", "region", "total", "x.*").join(small(anchors), "h").where(F.col("size") == F.least("window", F.lit(shingle)))
    laid = met.groupBy("doc_id", "region", "total", "size", "window", "blocks").agg(F.sort_array(F.collect_set("spot")).alias("spots"))
    laid = laid.select(F.col("doc_id").alias("laid_doc"), F.col("region").alias("laid_region"), "window", "blocks", window_starts(threshold).alias("starts")).where(F.size("starts") > 0)
    joined = regions.join(laid, (F.col("region") == F.col("laid_region")) & F.col("doc_id").eqNullSafe(F.col("laid_doc")))
    windows = joined.select("doc_id", "region", "first", "words", "window", "blocks", F.explode("starts").alias("start"))
    return windows.select("doc_id", "region", "window", "blocks", "start", F.slice("words", F.col("start") - F.col("first") + 1, F.col("window")).alias("w"))


def candidate_pairs(windows: DataFrame, known: DataFrame, shingle: int) -> DataFrame:
    """Pairs of windows and items that agree in a fingerprint block, each once."""
    sized = lambda s: F.when(F.least("window", F.lit(shingle)) == s, shingle_hashes(F.col("w"), s))
    prints = windows.withColumn("hashes", F.coalesce(*[sized(s) for s in range(1, shingle + 1)]))
    left = prints.select("doc_id", "region", "window", "start", F.explode(F.expr(fingerprint_blocks("hashes", "blocks"))).alias("k")).select("*", "k.block", "k.bits").drop("k")
    right = known.select("item_id", "n", F.explode(F.expr(fingerprint_blocks("item_hashes", "blocks"))).alias("k"))
    right = right.select("item_id", F.col("n").alias("item_n"), F.col("k.block").alias("item_block"), F.col("k.bits").alias("item_bits"))
    agree = (F.col("window") == F.col("item_n")) & (F.col("block") == F.col("item_block")) & (F.col("bits") == F.col("item_bits"))
    return left.join(right, agree).groupBy("doc_id", "region", "window", "start", "item_id").agg(F.count("*").alias("equal_blocks"))


def find_leaks(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row for each document and item it contains: doc_id, item_id, similarity, start_word (from 0), n_words, equal_blocks."""
    known = cut(known_items(items, shingle, threshold))
    windows = cut(candidate_windows(docs, known, shingle, threshold))
    pairs = candidate_pairs(windows, known, shingle)
    mine = pairs.select(*[F.col(c).alias(f"pair_{c}") for c in ("doc_id", "region", "window", "start")], "item_id", "equal_blocks")
    same = F.col("doc_id").eqNullSafe(F.col("pair_doc_id"))
    for c in ("region", "window", "start"):
        same = same & (F.col(c) == F.col(f"pair_{c}"))
    texts = known.select(F.col("item_id").alias("known_id"), F.col("n").alias("known_n"), "item_shingles")
    both = windows.join(mine, same).join(texts, F.col("item_id").eqNullSafe(F.col("known_id")) & (F.col("window") == F.col("known_n")))
    both = both.withColumn("window_shingles", F.expr(shingles("w", shingle)))
    repeated = "aggregate(array_distinct(window_shingles), 0, (s, x) -> s + least(size(filter(window_shingles, y -> y = x)), size(filter(item_shingles, y -> y = x))))"
    once = " AND ".join(f"size(array_distinct({c})) = size({c})" for c in ("window_shingles", "item_shingles"))
    shared = f"if({once}, size(array_intersect(window_shingles, item_shingles)), {repeated})"
    scored = both.withColumn("shared", F.expr(shared))
    scored = scored.withColumn("similarity", F.col("shared") / (F.size("window_shingles") + F.size("item_shingles") - F.col("shared")))
    best = scored.where(F.col("similarity") >= threshold).groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), F.col("window"), F.col("equal_blocks"))).alias("b"))
    return best.select("doc_id", "item_id", F.round("b.similarity", 6).alias("similarity"), (-F.col("b.back")).alias("start_word"), F.col("b.window").alias("n_words"), F.col("b.equal_blocks").alias("equal_blocks"))


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item."""
    key = fresh(docs, "leaked_id")
    leaked = find_leaks(docs, items, **options).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(leaked, F.col("doc_id").eqNullSafe(F.col(key)), "left_anti")
