"""The folder that the driver and all executors share, and reliable cuts of lineage."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary one of our own only in local mode, where it is unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="lodestone-")
    sc.setCheckpointDir(f"file://{own}")
    return f"file://{own}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, written to the shared folder; survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def clean_up(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and checkpoints that nothing refers to any more, which it does only after the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def join_hot(rows: DataFrame, side: DataFrame, key: str, count: str, total: int, least: int = 500_000, most_keys: int = 4000) -> DataFrame:
    """``rows`` joined with ``side``, which has each key once and the number of its rows in ``count`` (of ``total`` in all); no key fills a task.

    Keys with ``least`` rows or a ``most_keys``-th of all, whichever is more, are ``most_keys`` at most, so they can go to all tasks.
    """
    bound = max(least, total // most_keys + 1)
    if total <= bound:
        return rows.join(side.drop(count), key)
    hot = F.broadcast(side.where(F.col(count) >= bound).drop(count))
    cold = rows.join(hot.select(key), key, "left_anti").join(side.where(F.col(count) < bound).drop(count), key)
    return rows.join(hot, key).unionByName(cold)


def plan_bytes(df: DataFrame) -> int:
    """Bytes that the optimizer expects of ``df``; 0 where it knows no size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_texts(docs: DataFrame, keys: list[str], picked: dict[object, list[tuple]], chars: int) -> dict[tuple, str]:
    """Key -> text of the documents of each group, in the order of ``picked`` as far as ``chars`` characters a group go: a text that no longer fits is passed over, none is cut.

    Keys are values of the columns ``keys``, the last of which is doc_id.  Two scans, whatever the number of groups.
    """
    ids = sorted({key[-1] for group in picked.values() for key in group})
    if not ids:
        return {}
    rows = docs.where(F.col("doc_id").isin(ids) & F.col("text").isNotNull())
    sizes = {tuple(r[k] for k in keys): r["size"] for r in rows.groupBy(*keys).agg(F.max(F.length("text")).alias("size")).collect()}
    fitting: set[tuple] = set()
    for group in picked.values():
        left = chars
        for key in dict.fromkeys(group):
            if sizes.get(key, left + 1) <= left:
                left -= sizes[key]
                fitting.add(key)
    if not fitting:
        return {}
    chosen = rows.where(F.col("doc_id").isin(sorted({key[-1] for key in fitting}))).where(F.length("text") <= chars)
    texts = chosen.groupBy(*keys).agg(F.max(F.struct(F.length("text").alias("size"), "text")).alias("t")).select(*keys, "t.text").collect()
    return {key: r["text"] for r in texts if (key := tuple(r[k] for k in keys)) in fitting}


def small_batches(df: DataFrame, rows: int = 2500) -> DataFrame:
    """``df``, with Arrow batches of at most ``rows`` rows in its session, so that a Python worker's memory follows a few megabytes of text."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def release_memory() -> None:
    """Give freed memory back to the system; a Python worker is reused, and idle ones should not hold what an earlier task needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that gives its memory back when its task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped
