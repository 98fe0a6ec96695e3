"""Extension: streaming ingest of record shards and event-time windows.  The batch pipeline does not need it.

A file source's checkpoint plays the part of resume lists: files that were read are not read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone import schemas


def stream_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.SHARD_LINE).json(path)


def upsert_stream(rows: DataFrame, current: Callable[[], DataFrame | None], save: Callable[[DataFrame, int], None], keys: list[str], checkpoint: str) -> StreamingQuery:
    """Merge each micro-batch into a table: the last row of each key wins.  ``save`` gets the batch number, so that a replayed batch writes the same version."""
    from lodestone.operators.relational import keep_first

    def merge(batch: DataFrame, number: int) -> None:
        newest = keep_first(batch.withColumn("_n", F.monotonically_increasing_id()).withColumn("_late", -F.col("_n")), keys, ["_late"]).drop("_n", "_late")
        table = current()
        save(newest if table is None else table.join(newest.select(*keys), keys, "left_anti").unionByName(newest), number)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, ts: str, kind: str, value: str, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Count and sum by kind in tumbling or sliding windows; rows later than ``late`` are left out of closed windows."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.withWatermark(ts, late).groupBy(w.alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), kind, "n", "total")


def sessions(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
