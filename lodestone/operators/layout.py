"""Tables, plates and reading order from the geometry of text lines.

All rules work on one page, whose lines are one array, so pages are folded side by side in Arrow groups; page-level tests are columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a window, columns in half a page and in a full page, widest cell, resolution.
RUN, BANDS, BANDS_FULL, NARROW, BINS = 4, 2, 3, 0.45, 60
OCCUPIED = 3  # of RUN rows, six tenths rounded up


def rows_of_lines(boxes: np.ndarray, line_height: float) -> list[np.ndarray]:
    """Line numbers grouped to rows: a row holds lines whose centre is within 0.7 line heights of its first line's; from left to right."""
    centre = (boxes[:, 1] + boxes[:, 3]) / 2
    rows: list[list[int]] = []
    anchor = -np.inf
    for i in np.argsort(centre, kind="stable"):
        if not rows or centre[i] - anchor > 0.7 * line_height:
            rows.append([])
            anchor = centre[i]
        rows[-1].append(int(i))
    return [np.array(sorted(r, key=lambda i: boxes[i, 0])) for r in rows]


def band_count(coverage: np.ndarray, least: int) -> int:
    """Runs of bins that ``least`` rows or more cover."""
    full = coverage >= least
    return int((full & ~np.concatenate([[False], full[:-1]])).sum())


def table_rows(boxes: np.ndarray, rows: list[np.ndarray], x0: float, x1: float, bands: int) -> np.ndarray:
    """Rows that belong to a window of RUN rows with enough populated, narrow columns between x0 and x1."""
    width = x1 - x0
    mid = (boxes[:, 0] + boxes[:, 2]) / 2
    centres = x0 + (np.arange(BINS) + 0.5) * width / BINS
    cells = [r[(mid[r] >= x0) & (mid[r] < x1)] for r in rows]
    cover = np.array([((boxes[c, 0][:, None] <= centres) & (centres <= boxes[c, 2][:, None])).any(axis=0) if len(c) else np.zeros(BINS, bool) for c in cells]).reshape(len(rows), BINS)
    flagged = np.zeros(len(rows), bool)
    for s in range(len(rows) - RUN + 1):
        part = cells[s : s + RUN]
        widths = np.concatenate([(boxes[c, 2] - boxes[c, 0]) / width for c in part])
        enough = sum(len(c) >= bands for c in part) >= OCCUPIED
        if enough and len(widths) and np.median(widths) < NARROW and band_count(cover[s : s + RUN].sum(axis=0), OCCUPIED) >= bands:
            flagged[s : s + RUN] = True
    return flagged


def merge_boxes(boxes: list[list[float]]) -> list[list[int]]:
    """Boxes that overlap by over half of the smaller height become one, from top to bottom."""
    merged: list[list[float]] = []
    for b in sorted(boxes, key=lambda b: (b[1], b[0])):
        home = next((m for m in merged if min(m[3], b[3]) - max(m[1], b[1]) > 0.5 * min(m[3] - m[1], b[3] - b[1])), None)
        if home is None:
            merged.append(list(b))
        else:
            home[:] = [min(home[0], b[0]), min(home[1], b[1]), max(home[2], b[2]), max(home[3], b[3])]
    return [[int(round(v)) for v in b] for b in merged]


def table_regions(boxes: np.ndarray, page_width: float) -> tuple[set[int], list[list[int]]]:
    """(lines that are table cells, table boxes) of one page: in each half, and over the full width."""
    boxes = np.asarray(boxes, float).reshape(-1, 4)
    flat = np.flatnonzero(boxes[:, 2] - boxes[:, 0] >= 0.9 * (boxes[:, 3] - boxes[:, 1]))
    if len(flat) < RUN:
        return set(), []
    own = boxes[flat]
    rows = rows_of_lines(own, float(np.median(own[:, 3] - own[:, 1])))
    narrow = NARROW * page_width / 2
    mid = (own[:, 0] + own[:, 2]) / 2
    cells: set[int] = set()
    found: list[list[float]] = []
    for x0, x1, bands in ((0, page_width / 2, BANDS), (page_width / 2, page_width, BANDS), (0, page_width, BANDS_FULL)):
        flagged = table_rows(own, rows, x0, x1, bands)
        starts = np.flatnonzero(flagged & ~np.concatenate([[False], flagged[:-1]]))
        stops = np.flatnonzero(flagged & ~np.concatenate([flagged[1:], [False]])) + 1
        for a, b in zip(starts, stops, strict=True):
            inside = np.concatenate(rows[a:b])
            inside = inside[(mid[inside] >= x0) & (mid[inside] < x1) & (own[inside, 2] - own[inside, 0] < narrow)]
            if len(inside):
                cells.update(int(flat[i]) for i in inside)
                found.append([own[inside, 0].min(), own[inside, 1].min(), own[inside, 2].max(), own[inside, 3].max()])
    return cells, merge_boxes(found)


def detect_tables(pages: DataFrame) -> DataFrame:
    """From page geometry: (volume, idx, cells: line numbers in tables, regions: table boxes).  Lines in layout boxes of tables and pictures are left out before."""
    schema = "volume string, idx int, cells array<int>, regions array<array<int>>"

    def detect(batches):
        for frame in batches:
            out = []
            for volume, idx, width, lines, skip in zip(frame["volume"], frame["idx"], frame["w"], frame["lines"], frame["skip"], strict=True):
                kept = [i for i, s in enumerate(skip) if not s]
                cells, regions = table_regions(np.array([list(lines[i]["bbox"]) for i in kept], float).reshape(-1, 4), float(width))
                out.append((volume, idx, sorted(kept[c] for c in cells), regions))
            yield pd.DataFrame(out, columns=["volume", "idx", "cells", "regions"])

    return pages.select("volume", "idx", "w", "lines", excluded_lines().alias("skip")).mapInPandas(detect, schema)


def excluded_lines(labels: tuple[str, ...] = ("Table", "Picture", "Figure")) -> Column:
    """For each line whether its centre lies in a layout box of the given labels."""

    def inside(line: Column, region: Column) -> Column:
        x, y = (line["bbox"][0] + line["bbox"][2]) / 2, (line["bbox"][1] + line["bbox"][3]) / 2
        b = region["bbox"]
        return region["label"].isin(*labels) & x.between(b[0], b[2]) & y.between(b[1], b[3])

    layout = F.coalesce("layout", F.array().cast("array<struct<label:string,bbox:array<int>>>"))
    return F.transform("lines", lambda line: F.exists(layout, lambda region: inside(line, region)))


def reading_order(lines: Column, width: Column) -> Column:
    """Texts of the left column from top to bottom, then of the right column."""
    keyed = F.transform(
        lines,
        lambda x, i: F.struct(((x["bbox"][0] + x["bbox"][2]) / 2 >= width / 2).alias("right"), x["bbox"][1].alias("y"), i.alias("i"), x["text"].alias("text")),
    )
    return F.transform(F.array_sort(keyed), lambda x: x["text"])


def printed_page(lines: Column, height: Column) -> Column:
    """Topmost bare number of 1 to 3 digits whose centre is in the top 8 % of the page."""
    top = F.filter(lines, lambda x: ((x["bbox"][1] + x["bbox"][3]) / 2 < 0.08 * height) & F.trim(x["text"]).rlike(r"^\d{1,3}$") & ~F.trim(x["text"]).rlike("^0+$"))
    keyed = F.transform(top, lambda x, i: F.struct(x["bbox"][1].alias("y"), i.alias("i"), F.trim(x["text"]).cast("int").alias("n")))
    return F.array_min(keyed)["n"]


def is_plate(lines: Column, n_cells: Column) -> Column:
    """Fewer than 40 lines of 30 characters or more, and fewer than 60 table cells."""
    return (F.size(F.filter(lines, lambda x: F.length(x["text"]) >= 30)) < 40) & (n_cells < 60)


def assemble_pages(pages: DataFrame) -> DataFrame:
    """(volume, idx, printed_page, is_plate, text): page texts with their markers, table cells routed out."""
    found = detect_tables(pages)
    both = pages.join(found, ["volume", "idx"])
    kept = F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("line"), i.alias("i"))), lambda x: ~F.array_contains("cells", x["i"]) & ~F.get(excluded_lines(), x["i"]))
    kept = F.transform(kept, lambda x: x["line"])
    plate = is_plate(F.col("lines"), F.size("cells"))
    page = printed_page(F.col("lines"), F.col("h"))
    marker = F.concat(F.lit("## p. "), F.coalesce(page.cast("string"), F.lit("?")), F.lit(" (#"), (F.col("idx") + 1).cast("string"), F.lit(") ####"))
    tables = F.transform("regions", lambda r: F.concat(F.lit("<!-- table bbox=["), F.array_join(F.transform(r, lambda v: v.cast("string")), ", "), F.lit("] -->")))
    body = F.when(plate, F.lit("<!-- plate -->")).otherwise(F.array_join(reading_order(kept, F.col("w")), "\n"))
    return both.select("volume", "idx", page.alias("printed_page"), plate.alias("is_plate"), F.concat_ws("\n", marker, F.array_join(tables, "\n"), body).alias("text"))


def digit_density_run(lines: DataFrame, by: str, order: str, line: str) -> DataFrame:
    """Longest run of lines that look like table rows: two tokens or more, two of them with two digits or more."""
    from lodestone.functions.text import digits_in_tokens
    from lodestone.operators.relational import longest_run

    digits = digits_in_tokens(F.col(line))
    return longest_run(lines, by, [order], F.size(F.filter(digits, lambda n: n >= 2)) >= 2)


def candidate_pages(marked: DataFrame, triage: DataFrame, least: int = 1, done: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Pages with enough table boxes or with tables by triage; earlier ones left out; the best ``limit`` (a top-k report), then by page."""
    boxes = marked.where(F.col("n_boxes") >= least).select("volume", "idx", F.col("n_boxes").alias("score"))
    seen = triage.where("n_tables > 0").select("volume", "idx", F.col("n_tables").alias("score"))
    both = boxes.unionByName(seen).groupBy("volume", "idx").agg(F.max("score").alias("score"))
    if done is not None:
        both = both.join(done.select("volume", "idx").distinct(), ["volume", "idx"], "left_anti")
    return (both.orderBy(F.desc("score"), "volume", "idx").limit(limit) if limit else both).orderBy("volume", "idx")


def best_rotation(scores: DataFrame, by: list[str]) -> DataFrame:
    """Rotation with the greatest sum of text length times confidence; of equal ones the smallest."""
    total = scores.groupBy(*by, "rotation").agg(F.sum(F.length("text") * F.col("confidence")).alias("score"))
    return total.groupBy(*by).agg(F.max_by("rotation", F.struct("score", (-F.col("rotation")).alias("r"))).alias("rotation"))


def apply_orientation(auto: DataFrame, overrides: DataFrame, by: list[str]) -> DataFrame:
    """Rotation found plus all overrides of the page, modulo 360."""
    extra = overrides.groupBy(*by).agg(F.sum("degrees").alias("extra"))
    return auto.join(extra, by, "left").withColumn("rotation", F.pmod(F.col("rotation") + F.coalesce("extra", F.lit(0)), F.lit(360))).drop("extra")


def ink_fraction(pixels: DataFrame, by: list[str], dark: int = 110) -> DataFrame:
    """Share of dark pixels, and whether it is that of a drawing."""
    out = pixels.groupBy(*by).agg((F.count_if(F.col("value") < dark) / F.count("*")).alias("ink"))
    return out.withColumn("keep", F.col("ink").between(0.02, 0.55))
