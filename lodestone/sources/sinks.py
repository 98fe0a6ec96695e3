"""Sinks and idempotent rewrites.  Updates, deletes and replacements become new versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def replace_by_key(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``current`` whose keys the new rows do not have, and the new rows.  Null keys are equal."""
    touched = new.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = c if same is None else same & c
    return current.join(touched, same, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_latest(current: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key, that of the greatest ``order``; at equal order the new row."""
    both = current.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc(order), F.desc("_new"))
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_new")


def insert_or_ignore(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows already there win over new ones of the same keys."""
    return current.unionByName(new.join(current.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def undo(current: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return current.join(keys.select(key).distinct(), key, "left_anti")


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that the rows belong to."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def rebuild(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def place_rows(extracted: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One row a place of each entry's extraction (``places`` array of structs): ordinal from 1, type "other" stored as null."""
    rows = extracted.select("entry_id", F.posexplode("places").alias("i", "p"))
    return rows.select(
        "entry_id",
        (F.col("i") + 1).alias("ordinal"),
        F.col("p.name").alias("name"),
        F.to_json("p").alias("extraction"),
        F.nullif(F.col("p.aat_type_id"), F.lit("other")).alias("aat_type_id"),
        F.lit("extracted").alias("status"),
        (created_at if created_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).alias("created_at"),
    )


def table_rows(tables: DataFrame) -> DataFrame:
    """Digitised tables of each page: numbered from 1, with their sizes."""
    rows = tables.select("volume", "page_start", F.posexplode("tables").alias("i", "t"))
    return rows.select("volume", "page_start", (F.col("i") + 1).alias("table_no"), "t.*").withColumn("n_rows", F.size("rows")).withColumn("n_cols", F.size("columns"))


def point_features(places: DataFrame, keys: list[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """One GeoJSON point feature a row, as text for a line-delimited file."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, 5), F.round(lat, 5)).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*keys).alias("properties"))
    return places.select(F.to_json(feature).alias("value"))


def detail_shards(rows: DataFrame, id_col: str, shards: int = 256) -> DataFrame:
    """(shard, n, body): every shard, also an empty one, as a JSON object from id to record."""
    record = F.struct(F.col(id_col).cast("string").alias("key"), F.struct(*rows.columns).alias("value"))
    filled = rows.groupBy(F.expr(f"pmod({id_col}, {shards})").cast("int").alias("shard")).agg(F.count("*").alias("n"), F.to_json(F.map_from_entries(F.sort_array(F.collect_list(record)))).alias("body"))
    every = rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(filled, "shard", "left").select("shard", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("body", F.lit("{}")).alias("body"))


def manifest(shards: DataFrame) -> DataFrame:
    return shards.agg(F.count("*").alias("shards"), F.sum("n").alias("count"))


def key_to_point(places: DataFrame, key: str, name: str, tie: str) -> DataFrame:
    """(key, lon, lat, place): the last place of each key in order of name, then of ``tie``."""
    value = F.struct(F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"), F.col(tie).alias("place"))
    return places.groupBy(key).agg(F.max_by(value, F.struct(name, tie)).alias("v")).select(key, "v.*")


def reader_chunks(entries: DataFrame, by: str, order: str, size: int = 150) -> DataFrame:
    """Rows with their position (from 0) and fixed-size chunk."""
    i = F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1
    return entries.withColumn("i", i).withColumn("chunk", F.floor(F.col("i") / size).cast("int"))


def chunk_index(chunked: DataFrame, by: str, page: str) -> DataFrame:
    """First chunk of each page."""
    return chunked.where(F.col(page).isNotNull()).groupBy(by, page).agg(F.min_by("chunk", "i").alias("chunk"))


def non_point_features(geometries: DataFrame, kind: str = "kind") -> DataFrame:
    """Lines and areas that are not empty."""
    return geometries.where(F.col(kind).isin("Polygon", "MultiPolygon", "LineString", "MultiLineString") & (F.length("wkb") > 9))


def wkb_kind(wkb: Column) -> Column:
    """Geometry type of a little- or big-endian well-known binary."""
    code = F.when(F.hex(F.substring(wkb, 1, 1)) == "01", F.conv(F.hex(F.substring(wkb, 2, 1)), 16, 10)).otherwise(F.conv(F.hex(F.substring(wkb, 5, 1)), 16, 10)).cast("int")
    names = ["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection"]
    return F.get(F.array(*[F.lit(n) for n in names]), code - 1)


def authority_json(authority: DataFrame) -> DataFrame:
    """One JSON line a key, keys in order."""
    return authority.orderBy("fold").select(F.to_json(F.struct(*authority.columns)).alias("value"))


def require_all(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``wanted`` itself; raises if a key is not known."""
    missing = [r[0] for r in wanted.select(key).distinct().join(known.select(key), key, "left_anti").limit(20).collect()]
    if missing:
        raise ValueError(f"unknown {key}: {missing}")
    return wanted


def with_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Late columns added as null where a table lacks them."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in have})


def report_markdown(title: str, df: DataFrame, rows: int = 100) -> str:
    """A small aggregate as a Markdown table."""
    head = f"| {' | '.join(df.columns)} |\n|{'---|' * len(df.columns)}\n"
    return f"## {title}\n\n{head}" + "".join(f"| {' | '.join('' if v is None else str(v) for v in r)} |\n" for r in df.limit(rows).collect())
