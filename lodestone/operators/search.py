"""Full-text, trigram and vector search over tables of postings."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestone.operators.relational import with_position


def terms_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, tf)."""
    return docs.select(key, F.explode(terms_of(F.col(text))).alias("term")).groupBy("term", key).agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, key: str, text: str, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) of documents that contain all query terms."""
    query = sorted(set(query))
    sized = docs.select(key, F.size(terms_of(F.col(text))).alias("len"))
    stats = sized.agg(F.count("*").alias("n_docs"), F.avg("len").alias("avg_len"))
    hits = postings(docs, key, text).where(F.col("term").isin(query))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    rows = hits.join(F.broadcast(df), "term").join(sized, key).join(F.broadcast(stats), F.lit(True))
    idf = F.ln(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.sum(part).alias("score")).where(F.col("n") == len(query)).select(key, "score")


def trigrams(s: Column) -> Column:
    low = F.lower(s)
    return F.when(F.length(low) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substring(low, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def trigram_index(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.explode(trigrams(F.col(text))).alias("gram"))


def trigram_matches(queries: DataFrame, index: DataFrame, query: str, key: str, least: int = 1) -> DataFrame:
    """(query, key, overlap) ranked by shared trigrams."""
    asked = queries.select(query, F.explode(trigrams(F.col(query))).alias("gram"))
    return asked.join(index, "gram").groupBy(query, key).agg(F.count("*").alias("overlap")).where(F.col("overlap") >= least)


def trigram_search(queries: DataFrame, query: str, df: DataFrame, key: str, text: str, least: int = 1) -> DataFrame:
    """(query, key, overlap) of the rows of ``df``, one for each key, by the trigrams of their text; equal texts are compared once."""
    texts = df.select(text).distinct()
    asked = queries.select(query).distinct()
    met = trigram_matches(asked, trigram_index(texts, text, text).withColumnRenamed(text, "_text"), query, "_text", least)
    return met.join(df.select(key, F.col(text).alias("_text")), "_text").select(query, key, "overlap")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int = 5, block: int = 2048) -> DataFrame:
    """The ``k`` nearest vectors of each query by cosine, exactly (a top-k report; ties by key).

    Queries are taken in blocks of bounded size; each block goes to all tasks as one matrix, every task keeps its own best ``k`` a query, and
    only those are exchanged.  Null and zero vectors are nobody's neighbour.
    """
    asked = with_position(queries.select(key, vector), key, "_i")
    n = queries.count()
    kind = vectors.schema[key].dataType
    out = []
    for lo in range(0, max(n, 1), block):
        rows = asked.where(F.col("_i").between(lo, lo + block - 1)).select(key, vector).collect()
        out.append(_best_of_block(vectors, key, vector, kind, [r[0] for r in rows], [r[1] for r in rows], k))
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), key)
    return reduce(DataFrame.unionByName, out).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _best_of_block(vectors: DataFrame, key: str, vector: str, kind: T.DataType, ids: list, rows: list, k: int) -> DataFrame:
    ok = [i for i, r in enumerate(rows) if r is not None and any(r)]
    matrix = np.array([rows[i] for i in ok], np.float64) if ok else np.zeros((0, 0))
    if ok:
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    names = np.array([ids[i] for i in ok])
    shared = vectors.sparkSession.sparkContext.broadcast((names, matrix))
    schema = T.StructType([T.StructField("query_id", kind), T.StructField(key, kind), T.StructField("similarity", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, q = shared.value
        for batch in batches:
            table = pa.Table.from_batches([batch]).drop_null()
            if not len(asked) or not table.num_rows:
                continue
            column = table.column(vector).combine_chunks()
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, -1)
            size = np.linalg.norm(flat, axis=1)
            keys = table.column(key).to_numpy()
            order = np.argsort(keys, kind="stable")
            order = order[size[order] > 0]
            flat, keys = flat[order] / size[order][:, None], keys[order]
            for lo in range(0, len(q), 256):
                like = np.round(q[lo : lo + 256] @ flat.T, 12)
                best = np.argsort(-like, axis=1, kind="stable")[:, :k]
                who = np.repeat(asked[lo : lo + 256], best.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(keys[best.ravel()]), pa.array(np.take_along_axis(like, best, axis=1).ravel())], names=["query_id", key, "similarity"])

    return vectors.select(key, vector).mapInArrow(run, schema)


def locate(entries: DataFrame, written: DataFrame, key: str, position: str, size: int = 150) -> DataFrame:
    """Chunk of each entry as written, else the one its position implies."""
    known = written.select(key, F.col("chunk").alias("_chunk"))
    return entries.join(known, key, "left").withColumn("chunk", F.coalesce("_chunk", F.floor(F.col(position) / size).cast("int"))).drop("_chunk")


def density_grid(points: DataFrame, zoom: int, pixels: int = 8) -> DataFrame:
    """Points merged on a grid of ``pixels`` of a 256-pixel tile: place of the cell, its count and mean position."""
    from lodestone.functions.geo import tile_xy

    fine = zoom + int(math.log2(256 // pixels))
    x, y = tile_xy(F.col("lat"), F.col("lon"), fine)
    per = 256 // pixels
    cell = points.select("*", x.alias("gx"), y.alias("gy"))
    grouped = cell.groupBy("gx", "gy").agg(F.count("*").alias("point_count"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    return grouped.select(F.lit(zoom).alias("z"), F.floor(F.col("gx") / per).cast("long").alias("x"), F.floor(F.col("gy") / per).cast("long").alias("y"), "gx", "gy", "point_count", "lat", "lon")


def name_vector(s: Column, dims: int = 128) -> Column:
    """Normalised vector of hashed character trigrams: a stand-in for a phonetic encoder, which is not at hand offline."""
    grams = trigrams(F.concat(F.lit("^"), F.coalesce(s, F.lit("")), F.lit("$")))
    slots = F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(dims)).cast("int"))
    raw = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.size(F.filter(slots, lambda x: x == i)).cast("double"))
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(raw, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))
