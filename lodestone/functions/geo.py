"""Geographic column functions: distances, boxes, tiles, degrees, polygons."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_KM = 6371.0
KM_PER_DEGREE = 111.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def circle_box(lat: Column, lon: Column, km: float) -> Column:
    """Struct west, south, east, north around a circle; wider towards the poles, up to a limit."""
    dlat = F.lit(km / KM_PER_DEGREE)
    dlon = F.lit(km) / (KM_PER_DEGREE * F.greatest(F.lit(0.15), F.cos(F.radians(lat))))
    return F.struct((lon - dlon).alias("west"), (lat - dlat).alias("south"), (lon + dlon).alias("east"), (lat + dlat).alias("north"))


def square_box(lat: Column, lon: Column, km: float) -> Column:
    d = km / KM_PER_DEGREE
    return F.struct((lon - d).alias("west"), (lat - d).alias("south"), (lon + d).alias("east"), (lat + d).alias("north"))


def in_box(lat: Column, lon: Column, box: Column) -> Column:
    return lon.between(box["west"], box["east"]) & lat.between(box["south"], box["north"])


def size_norm(count: Column, largest: Column) -> Column:
    return F.round(F.sqrt(count / largest), 3)


def quantise_int8(vector: Column) -> Column:
    """Components times 127, rounded half to even, cut at +-127."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.bround(x.cast("double") * 127).cast("int"))))


def tile_xy(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator tile of a point."""
    n = float(1 << zoom)
    x = F.floor((lon + 180.0) / 360.0 * n)
    y = F.floor((1 - F.ln(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / math.pi) / 2 * n)
    clamp = lambda v: F.greatest(F.lit(0), F.least(v, F.lit((1 << zoom) - 1))).cast("long")
    return clamp(x), clamp(y)


def hilbert_tile_id(zoom: int, x: Column, y: Column) -> Column:
    """Number of a tile: all tiles of lower zooms, then its place on the Hilbert curve of its own."""
    base = (4**zoom - 1) // 3
    state = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(acc: Column, s: Column) -> Column:
        rx, ry = F.when(acc["x"].bitwiseAND(s) > 0, 1).otherwise(0).cast("long"), F.when(acc["y"].bitwiseAND(s) > 0, 1).otherwise(0).cast("long")
        d = acc["d"] + s * s * (F.lit(3) * rx).bitwiseXOR(ry)
        fx = F.when((ry == 0) & (rx == 1), s - 1 - acc["x"].bitwiseAND(s - 1)).otherwise(acc["x"].bitwiseAND(s - 1))
        fy = F.when((ry == 0) & (rx == 1), s - 1 - acc["y"].bitwiseAND(s - 1)).otherwise(acc["y"].bitwiseAND(s - 1))
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    sides = F.array(*[F.lit(1 << b).cast("long") for b in range(zoom - 1, -1, -1)]) if zoom else F.array().cast("array<bigint>")
    return F.lit(base) + F.aggregate(sides, state, step)["d"]


def tile_of_id(tile_id: Column, zoom: int) -> Column:
    """Inverse of ``hilbert_tile_id`` for a known zoom: struct x, y."""
    start = F.struct((tile_id - (4**zoom - 1) // 3).cast("long").alias("t"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))

    def step(acc: Column, s: Column) -> Column:
        rx = F.expr("1L").cast("long").bitwiseAND(F.floor(acc["t"] / 2).cast("long"))
        ry = F.lit(1).cast("long").bitwiseAND(acc["t"].bitwiseXOR(rx))
        fx = F.when((ry == 0) & (rx == 1), s - 1 - acc["x"]).otherwise(acc["x"])
        fy = F.when((ry == 0) & (rx == 1), s - 1 - acc["y"]).otherwise(acc["y"])
        sx, sy = F.when(ry == 0, fy).otherwise(fx), F.when(ry == 0, fx).otherwise(fy)
        return F.struct(F.floor(acc["t"] / 4).cast("long").alias("t"), (sx + s * rx).alias("x"), (sy + s * ry).alias("y"))

    sides = F.array(*[F.lit(1 << b).cast("long") for b in range(zoom)]) if zoom else F.array().cast("array<bigint>")
    done = F.aggregate(sides, start, step)
    return F.struct(done["x"].alias("x"), done["y"].alias("y"))


def degrees_from_text(s: Column) -> Column:
    """Decimal degrees of the first "51° 30' 12" N" in a text; south and west negative; null if there is none."""
    pattern = r"(\d{1,3})°\s*(?:(\d{1,2})['′])?\s*(?:(\d{1,2})[\"″])?\s*([NSEW])"
    part = lambda i: F.coalesce(F.regexp_extract(s, pattern, i).try_cast("double"), F.lit(0.0))
    value = part(1) + part(2) / 60 + part(3) / 3600
    return F.when(s.rlike(pattern), F.when(F.regexp_extract(s, pattern, 4).isin("S", "W"), -value).otherwise(value))


def polygon_box(points: Column) -> Column:
    """Struct x0, y0, x1, y1 of an array of [x, y]."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def distance_outside(x: float, y: float, ring) -> float:
    """0 inside the ring, else the distance to its nearest edge, in the ring's units."""
    p = np.array([list(v) for v in ring], float)
    if len(p) < 3:
        return math.inf
    q = np.roll(p, -1, axis=0)
    crosses = ((p[:, 1] > y) != (q[:, 1] > y)) & (x < (q[:, 0] - p[:, 0]) * (y - p[:, 1]) / np.where(q[:, 1] == p[:, 1], 1e-300, q[:, 1] - p[:, 1]) + p[:, 0])
    if crosses.sum() % 2:
        return 0.0
    d = q - p
    t = np.clip(((x - p[:, 0]) * d[:, 0] + (y - p[:, 1]) * d[:, 1]) / np.maximum((d**2).sum(axis=1), 1e-300), 0, 1)
    return float(np.hypot(p[:, 0] + t * d[:, 0] - x, p[:, 1] + t * d[:, 1] - y).min())


@F.pandas_udf(T.DoubleType())
def outside_distance(x: pd.Series, y: pd.Series, ring: pd.Series) -> pd.Series:
    """Distance of a point to a polygon given as an array of [x, y]; 0 inside, null without point or polygon."""
    return pd.Series([None if a != a or b != b or r is None else distance_outside(a, b, r) for a, b, r in zip(x, y, ring, strict=True)], dtype="float64")


def any_part(flags: list[Column]) -> Column:
    """A geometry of several parts contains what any part contains."""
    return reduce(lambda a, b: a | b, flags)
