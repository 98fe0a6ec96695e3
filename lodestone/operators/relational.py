"""Joins, sequence operators, ranked choices and aggregates that the record pipeline is built from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def attach_preceding(points: DataFrame, starts: DataFrame, by: str, at: str, start: str, value: str, strict: bool = False, else_first: bool = False) -> DataFrame:
    """As-of join: each point gets ``value`` of the last start at or before it (``strict``: before it).

    With ``else_first`` points before the first start get the first one's value.  Both sides are sorted together once per ``by``; of equal
    starts the greatest value counts.
    """
    rank_start, rank_point = (1, 0) if strict else (0, 1)
    left = starts.where(F.col(start).isNotNull()).select(F.col(by), F.col(start).alias("_at"), F.col(value).alias("_v"), F.lit(rank_start).alias("_rank"), F.lit(None).alias("_row"))
    right = points.select(F.col(by), F.col(at).alias("_at"), F.lit(None).cast(starts.schema[value].dataType).alias("_v"), F.lit(rank_point).alias("_rank"), F.struct(*points.columns).alias("_row"))
    left = left.withColumn("_row", F.lit(None).cast(right.schema["_row"].dataType))
    order = Window.partitionBy(by).orderBy("_at", "_rank", "_v")
    found = F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    if else_first:
        found = F.coalesce(found, F.first("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return left.unionByName(right).withColumn("_found", found).where("_row IS NOT NULL").select("_row.*", F.col("_found").alias(value))


def splice(items: DataFrame, inserts: DataFrame, by: str, page: str, after: str, position: str) -> DataFrame:
    """Insert rows behind the last item whose page is at or before ``after``; without such an item, or without ``after``, at the front (-1)."""
    placed = attach_preceding(inserts.withColumn("_after", F.coalesce(after, F.lit(-1))), items, by, "_after", page, position).drop("_after")
    placed = placed.withColumn(position, F.coalesce(position, F.lit(-1))).withColumn("is_insert", F.lit(1))
    return items.withColumn("is_insert", F.lit(0)).unionByName(placed, allowMissingColumns=True)


def neighbours(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))


def longest_run(df: DataFrame, by: str, order: list[str], flag: Column) -> DataFrame:
    """Longest run of consecutive rows with the flag, 0 if there is none."""
    w = Window.partitionBy(by).orderBy(*order)
    marked = df.select(by, *order, flag.alias("_f")).withColumn("_island", F.row_number().over(w) - F.sum(F.col("_f").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy(by, "_island").agg(F.sum(F.col("_f").cast("long")).alias("n"))
    return runs.groupBy(by).agg(F.max("n").alias("longest"))


def islands(df: DataFrame, by: str, order: str, flag: str) -> DataFrame:
    """(by, first, last, n) of each run of flagged rows."""
    w = Window.partitionBy(by).orderBy(order)
    new = (F.col(flag) & ~F.coalesce(F.lag(flag).over(w), F.lit(False))).cast("int")
    numbered = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.where(flag).groupBy(by, "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("_run")


def flag_windows(df: DataFrame, by: str, order: list[str], test, size: int) -> DataFrame:
    """Rows that lie in some window of ``size`` consecutive rows which ``test`` accepts (a function of the window specification)."""
    w = Window.partitionBy(by).orderBy(*order)
    full = F.count("*").over(w.rowsBetween(-(size - 1), 0)) == size
    hit = df.withColumn("_hit", full & test(w.rowsBetween(-(size - 1), 0)))
    return hit.withColumn("flagged", F.max("_hit").over(w.rowsBetween(0, size - 1))).drop("_hit")


def forward_fill(df: DataFrame, by: str, order: str, value: str, out: str) -> DataFrame:
    """The last known value before each row."""
    return df.withColumn(out, F.last(value, ignorenulls=True).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)))


def next_match(df: DataFrame, by: str, order: str, value: str, keep: Column, out: str) -> DataFrame:
    """The value of the next row that ``keep`` accepts."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(out, F.first(F.when(keep, F.col(value)), ignorenulls=True).over(w))


def previous_match(df: DataFrame, by: str, order: str, value: str, keep: Column, out: str) -> DataFrame:
    """The value of the last earlier row that ``keep`` accepts."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(F.when(keep, F.col(value)), ignorenulls=True).over(w))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def ends_distinct(df: DataFrame, by: str, order: str, value: str, k: int = 3) -> DataFrame:
    """Distinct values among the first ``k`` and among the last ``k`` rows, in order."""
    w = Window.partitionBy(by)
    ranked = df.select(by, order, value, F.row_number().over(w.orderBy(order)).alias("a"), F.row_number().over(w.orderBy(F.desc(order))).alias("z"))
    both = ranked.select("*", F.explode(F.array(F.when(F.col("a") <= k, "first"), F.when(F.col("z") <= k, "last"))).alias("end")).where("end IS NOT NULL")
    return both.groupBy(by, "end", value).agg(F.min(order).alias(order))


def even_sample(df: DataFrame, order: str, n: int) -> DataFrame:
    """``n`` rows at even steps, int(i * total / n) from 0, or all if there are fewer."""
    total = df.count()
    if total <= n:
        return df
    wanted = F.expr(f"transform(sequence(0, {n - 1}), i -> int(floor(i * {total}D / {n})))")
    spots = df.sparkSession.range(1).select(F.explode(wanted).alias("_i"))
    numbered = with_position(df, order)
    return numbered.join(F.broadcast(spots), "_i", "left_semi").drop("_i")


def range_bounds(df: DataFrame, order: str, rows: int = 50_000, most: int = 1024, each: int = 50) -> list:
    """Values of ``order``, ascending, that split the rows into ranges of about ``rows``, or into ``most`` ranges.

    They are found among distinct values drawn by hash, about ``each`` a range, weighted by their numbers of rows.
    """
    n, distinct = df.agg(F.count(order), F.approx_count_distinct(order)).first()
    ranges = min(most, n // rows + 1)
    if ranges == 1:
        return []
    drawn = df.where(F.col(order).isNotNull() & (F.pmod(F.xxhash64(order), F.lit(max(1, distinct // (ranges * each)))) == 0))
    found = drawn.groupBy(order).agg(F.count("*").alias("n")).orderBy(order).collect()
    step, bounds, seen = sum(r["n"] for r in found) / ranges, [], 0
    for r in found:
        if seen >= step * (len(bounds) + 1):
            bounds.append(r[0])
        seen += r["n"]
    return bounds


def range_of(value: Column, bounds: list, kind: T.DataType, group: int = 32) -> Column:
    """Number of the ascending bounds that are not above the value (0 for null), by two short searches."""
    if not bounds:
        return F.lit(0)
    of = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    groups = [bounds[i : i + group] for i in range(0, len(bounds), group)]
    reached = lambda values, v: F.size(F.filter(values, lambda b: b <= v))
    in_group = lambda v, g: F.when(g > 0, (g - 1) * group + reached(F.get(F.array(*[of(x) for x in groups]), g - 1), v)).otherwise(0)
    once = F.transform(F.array(value), lambda v: F.struct(v.alias("v"), reached(of([x[0] for x in groups]), v).alias("g")))  # the value is worked out once
    return F.get(F.transform(once, lambda r: in_group(r["v"], r["g"])), F.lit(0))


def with_position(df: DataFrame, order: str, out: str = "_i") -> DataFrame:
    """Global position from 0 without bringing all rows to one task: ranges of the key, their sizes, and the rank inside each.

    The bounds of the ranges are values fixed beforehand: the ranges of a range exchange can differ each time that Spark plans or merges it,
    and sizes of other ranges lose, repeat and misplace rows.
    """
    ranged = df.withColumn("_p", range_of(F.col(order), range_bounds(df, order), df.schema[order].dataType))
    inside = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(order)))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    return inside.join(F.broadcast(before), "_p").withColumn(out, (F.col("_before") + F.col("_r") - 1).cast("long")).drop("_p", "_r", "_before")


def missing_numbers(df: DataFrame, by: str, number: str, block: int = 4096) -> DataFrame:
    """Numbers between the least and the greatest of each group that do not occur.

    Only the numbers that occur are exchanged, once, in blocks of a group; a gap is spelled out where it is found, ``block`` numbers at a time.
    """
    kind = df.schema[number].dataType
    known = df.where(F.col(number).isNotNull()).select(by, F.col(number).cast("long").alias("_n")).withColumn("_b", F.floor(F.col("_n") / block))
    before = F.lag("_n").over(Window.partitionBy(by, "_b").orderBy("_n"))
    inside = known.select(by, before.alias("_lo"), F.col("_n").alias("_hi"))
    ends = known.groupBy(by, "_b").agg(F.min("_n").alias("_hi"), F.max("_n").alias("_last"))
    between = ends.select(by, F.lag("_last").over(Window.partitionBy(by).orderBy("_b")).alias("_lo"), "_hi")
    gaps = inside.unionByName(between).where("_hi - _lo > 1").select(by, "_hi", F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi") - 1, F.lit(block))).alias("_lo"))
    return gaps.select(by, F.explode(F.sequence("_lo", F.least(F.col("_lo") + (block - 1), F.col("_hi") - 1))).alias(number)).withColumn(number, F.col(number).cast(kind))


def prefix_tiling(df: DataFrame, order: str, first: str, last: str, n: int = 3) -> DataFrame:
    """Gap or overlap between each range and the next, by their leading characters."""
    nxt = F.lead(F.substring(first, 1, n)).over(Window.orderBy(order))
    here = F.substring(last, 1, n)
    return df.withColumn("tiling", F.when(nxt.isNull(), "end").when(nxt < here, "overlap").when(nxt == here, "meet").otherwise("gap"))


def modal(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value of each group, the first seen of equal ones."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(order).alias("first_at"))
    return counts.groupBy(*by).agg(F.max_by(F.col(value), F.struct("n", (-F.col("first_at")).alias("early"))).alias(value), F.max("n").alias("n"))


def top_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group under a total order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def share(condition: Column) -> Column:
    """Percentage of rows with the condition, one decimal, half to even."""
    return F.bround(100 * F.avg(F.when(condition, 1.0).otherwise(0.0)), 1)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; two empty ones are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def natural_key(name: Column) -> Column:
    """Sort key in which digit runs count as numbers."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 12, "0")).otherwise(p)), "")


def bucket_cost(tokens: Column, places: Column, calls: Column, price_in: float, price_cached: float, price_out: float, prefix: int = 3000, out_per_place: int = 250, discount: float = 0.5) -> Column:
    """Cost of a group of requests: input, cached prompt prefix of each call, and output, in units per million tokens."""
    return (tokens / 1e6 * price_in + calls * prefix / 1e6 * price_cached + places * out_per_place / 1e6 * price_out) * discount


def random_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows by the hash of their key and a seed (a sampling operator): the same rows however the table is partitioned."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def top_counts(df: DataFrame, by: list[str], n: int | None = None) -> DataFrame:
    """Group counts, largest first, ties by key; the first ``n`` if asked for (a top-k report)."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)
    return counts.limit(n) if n else counts


def point_in_boxes(points: DataFrame, boxes: DataFrame, by: str) -> DataFrame:
    """Points (x, y) inside some box (x0, y0, x1, y1) of their group."""
    on = (F.col("p." + by) == F.col("b." + by)) & F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    return points.alias("p").join(boxes.alias("b"), on, "left_semi")


def box_union(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
