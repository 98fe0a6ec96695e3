"""Quality checks: cross-checks of headwords, verdicts, review lists, coverage."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import text as tx
from lodestone.functions.similarity import could_reach, ratcliff


def greedy_pairs(left: list[str], right: list[str], cutoff: float = 0.82, contain: int = 6) -> list[tuple[str, str, str]]:
    """One-to-one pairs (left, right, how) of one block: each left key in sorted order takes the most similar right key that is free, else the first one that contains it or that it contains."""
    free = sorted(set(right))
    pairs = []
    for name in sorted(set(left)):
        near = difflib.get_close_matches(name, free, 1, cutoff)
        hit = near[0] if near else next((f for f in free if min(len(name), len(f)) >= contain and (name in f or f in name)), None)
        if hit is not None:
            free.remove(hit)
            pairs.append((name, hit, "similar" if near else "contained"))
    return pairs


def containments(left: DataFrame, right: DataFrame, least: int = 7) -> DataFrame:
    """(left, right) where one key contains the other, ``least`` letters at least: the shorter one's first letters are looked up among the longer one's runs of letters."""
    a, b = left.select(F.col("key").alias("left")).where(F.length("key") >= least), right.select(F.col("key").alias("right")).where(F.length("key") >= least)
    runs = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - least + 1), lambda i: F.substr(F.col(c), i, F.lit(least)))))
    inner = a.withColumn("run", F.substring("left", 1, least)).join(b.withColumn("run", runs("right")), "run").where(F.contains("right", "left"))
    outer = a.withColumn("run", runs("left")).join(b.withColumn("run", F.substring("right", 1, least)), "run").where(F.contains("left", "right"))
    return inner.select("left", "right").union(outer.select("left", "right")).distinct()


def fuzzy_pairs(left: DataFrame, right: DataFrame, cutoff: float = 0.82) -> DataFrame:
    """(left, right, how): greedy one-to-one pairs between two sets of keys.

    First inside each first letter, so that any later letter may differ; then, for wrong or lost first letters, by containment among all that are
    left.  The second choice is made in order over the containing pairs alone, which are few, in one task.
    """
    block = lambda df, side: df.select(F.substring("key", 1, 1).alias("block"), F.col("key"), F.lit(side).alias("side"))

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        found = greedy_pairs(frame.loc[frame.side == "l", "key"].tolist(), frame.loc[frame.side == "r", "key"].tolist(), cutoff)
        return pd.DataFrame(found, columns=["left", "right", "how"])

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        taken, chosen = set(), {}
        for a, b in sorted(zip(frame["left"], frame["right"], strict=True)):
            if a not in chosen and b not in taken:
                chosen[a] = b
                taken.add(b)
        return pd.DataFrame([(a, b, "second") for a, b in chosen.items()], columns=["left", "right", "how"])

    schema = "left string, right string, how string"
    first = block(left, "l").unionByName(block(right, "r")).groupBy("block").applyInPandas(pair, schema)
    edges = containments(left.select("key").distinct(), right.select("key").distinct())
    edges = edges.join(first.select("left"), "left", "left_anti").join(first.select("right"), "right", "left_anti").select("left", "right")
    return first.unionByName(edges.groupBy(F.lit(1).alias("all")).applyInPandas(choose, schema))


def close_match(left: DataFrame, right: DataFrame, by: str, key: str, cutoff: float) -> DataFrame:
    """Best similar key of the same group for each key of ``left`` (ties: the greatest), at the cutoff or above."""
    a, b = left.select(by, F.col(key).alias("a")).distinct(), right.select(by, F.col(key).alias("b")).distinct()
    pairs = a.join(b, by).where(could_reach(F.col("a"), F.col("b"), cutoff)).withColumn("ratio", ratcliff(F.col("b"), F.col("a")))
    w = Window.partitionBy(by, "a").orderBy(F.desc("ratio"), F.desc("b"))
    return pairs.where(F.col("ratio") >= cutoff).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def heading_difference(seen: DataFrame, ours: DataFrame, cutoff: float = 0.86) -> DataFrame:
    """(page, name, kind): headings seen on a page that we lack (merge), and ours that were not seen (spurious).

    Names meet on their match keys (variants, word order), else on a similar key of the same page.
    """

    def only(these: DataFrame, those: DataFrame, kind: str) -> DataFrame:
        keyed = these.select("page", "name", F.explode_outer(tx.match_keys(F.col("name"))).alias("key"))
        known = those.select("page", F.explode(tx.match_keys(F.col("name"))).alias("key")).distinct().withColumn("hit", F.lit(1))
        exact = keyed.join(known, ["page", "key"], "left").groupBy("page", "name").agg(F.max("hit").alias("hit")).where("hit IS NULL").drop("hit")
        exact = exact.withColumn("key", tx.alpha_key(F.col("name")))
        near = close_match(exact, those.select("page", tx.alpha_key(F.col("name")).alias("key")), "page", "key", cutoff)
        return exact.join(near.select("page", F.col("a").alias("key")), ["page", "key"], "left_anti").select("page", "name", F.lit(kind).alias("kind"))

    return only(seen, ours, "merge").unionByName(only(ours, seen, "spurious"))


def sequence_window(ours: DataFrame, seen: DataFrame) -> DataFrame:
    """Our names between the first and the last that were seen on each page (pos is their place in the volume)."""
    span = ours.join(seen.select("page", "key").distinct(), "key").groupBy("page").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    return span.join(ours, F.col("pos").between(F.col("lo"), F.col("hi"))).select("page", "pos", "key")


def residual_kind(in_crossrefs: Column, in_text: Column) -> Column:
    """What a reference headword without partner is: a cross-reference, part of our text (merged), or absent."""
    return F.when(in_crossrefs, "crossref").when(in_text, "merged").otherwise("absent")


def crosscheck(ours: DataFrame, reference: DataFrame) -> DataFrame:
    """One row of counts: common keys, fuzzy pairs, keys of both sides, and the match percentage of the reference (0 for an empty one)."""
    a, b = ours.select("key").distinct(), reference.select("key").distinct()
    common = a.join(b, "key", "left_semi")
    fuzzy = fuzzy_pairs(a.join(b, "key", "left_anti"), b.join(a, "key", "left_anti"))
    n = lambda df, name: df.agg(F.count("*").alias(name))
    out = n(common, "common").crossJoin(n(fuzzy, "fuzzy")).crossJoin(n(a, "ours")).crossJoin(n(b, "reference"))  # one row each
    return out.withColumn("match_pct", F.bround(100 * (F.col("common") + F.col("fuzzy")) / F.greatest("reference", F.lit(1)), 1))


def index_verdict(entries: DataFrame, names: DataFrame, likely: float = 0.88) -> DataFrame:
    """(entry_id, verdict, similarity, hit): exact name known, likely variant of one, or to be reviewed.

    ``names`` has key and name; inexact candidates share the first two letters, and all that can reach ``likely`` by their letters are measured
    exactly; without one the similarity is 0.
    """
    asked = entries.select("entry_id", tx.alpha_key(F.col("headword")).alias("key"))
    exact = asked.join(names.groupBy("key").agg(F.min("name").alias("hit")), "key", "left")
    open_ = exact.where("hit IS NULL").withColumn("block", F.substring("key", 1, 2))
    known = names.select(F.col("key").alias("other"), F.col("name").alias("hit2"), F.substring("key", 1, 2).alias("block"))
    near = open_.join(known, "block").where(could_reach(F.col("key"), F.col("other"), likely))
    best = near.withColumn("ratio", ratcliff(F.col("key"), F.col("other"))).groupBy("entry_id").agg(F.max("ratio").alias("ratio"), F.max_by("hit2", F.struct("ratio", "other")).alias("near"))
    joined = exact.join(best, "entry_id", "left")
    similar = F.coalesce(F.bround("ratio", 3), F.lit(0.0))
    return joined.select(
        "entry_id",
        F.when(F.col("hit").isNotNull(), "ok-in-index").when(similar >= likely, "likely-variant").otherwise("review").alias("verdict"),
        F.when(F.col("hit").isNotNull(), 1.0).otherwise(similar).alias("similarity"),
        F.coalesce("hit", "near", F.lit("")).alias("hit"),
    )


def prose_pages(chunks: DataFrame, ours: DataFrame, lines: int = 30, headwords: int = 10) -> DataFrame:
    """Pages with a printed number, no table marker, enough lines and enough of our headwords."""
    body = F.filter(F.split("chunk", "\n"), lambda x: (F.trim(x) != "") & ~x.startswith("##") & ~x.startswith("<!--"))
    pages = chunks.where(F.col("printed_page").isNotNull() & ~F.col("chunk").contains("<!-- table")).where(F.size(body) >= lines)
    counts = ours.groupBy("volume", F.col("page").alias("printed_page")).agg(F.count_distinct("key").alias("n"))
    return pages.join(counts, ["volume", "printed_page"]).where(F.col("n") >= headwords).select("volume", "idx", "printed_page")


def entry_signature(source: Column, headword: Column, page: Column) -> Column:
    """Key of an entry that survives rebuilds."""
    return tx.signature(source, tx.alpha_key(headword), page.cast("string"))


def review_list(entries: DataFrame, decisions: DataFrame, verdict: str | None = None, decided: bool | None = None, limit: int = 2000) -> tuple[int, DataFrame]:
    """(total, the first ``limit`` rows): entries to review, least similar and shortest first; undecided or decided ones if asked for."""
    rows = entries.where(F.col("verdict") == verdict) if verdict else entries
    rows = rows.join(decisions.select("sig", "action", "payload"), "sig", "left")
    if decided is not None:
        rows = rows.where(F.col("action").isNotNull() if decided else F.col("action").isNull())
    return rows.count(), rows.orderBy(F.coalesce("similarity", F.lit(-1.0)), F.length("text"), "sig").limit(limit)


def apply_decisions(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """Extension: recorded decisions take effect (reject drops, headword and text edits replace); other actions are left to their tools."""
    rows = entries.join(decisions.select("sig", "action", "payload"), "sig", "left")
    edit = lambda action, column: F.when(F.col("action") == action, F.col("payload")).otherwise(F.col(column)).alias(column)
    keep = [c for c in entries.columns if c not in ("headword", "text")]
    return rows.where("action IS NULL OR action <> 'reject'").select(*keep, edit("edit_headword", "headword"), edit("edit_text", "text"))


def page_coverage(pages: DataFrame) -> DataFrame:
    """Printed pages by volume: how many, first, last, offset drift."""
    drift = F.col("idx") - F.col("printed_page")
    return pages.where("printed_page IS NOT NULL").groupBy("volume").agg(
        F.count_distinct("printed_page").alias("pages"), F.min("printed_page").alias("first"), F.max("printed_page").alias("last"), F.min(drift).alias("drift_min"), F.max(drift).alias("drift_max")
    )


def volume_heads(heads: DataFrame) -> DataFrame:
    """First and last running head of each volume: of its fifth page and of the second from the end, within its bounds."""
    w = Window.partitionBy("volume")
    ranked = heads.withColumn("n", F.count("*").over(w)).withColumn("i", F.row_number().over(w.orderBy("idx")))
    return ranked.groupBy("volume").agg(
        F.max(F.when(F.col("i") == F.least(F.lit(5), F.col("n")), F.col("head"))).alias("first"),
        F.max(F.when(F.col("i") == F.greatest(F.lit(1), F.col("n") - 1), F.col("head"))).alias("last"),
    )


def parity(a: DataFrame, b: DataFrame, key: str, vector: str) -> DataFrame:
    """Cosine of two encodings of the same rows: lowest and mean."""
    from lodestone.operators.search import cosine

    both = a.select(key, F.col(vector).alias("_a")).join(b.select(key, F.col(vector).alias("_b")), key)
    return both.select(cosine(F.col("_a"), F.col("_b")).alias("c")).agg(F.min("c").alias("lowest"), F.avg("c").alias("mean"))


def review_entry(entries: DataFrame, sig: str) -> DataFrame:
    """One entry with its neighbours in the volume: names and the first 200 characters of their texts."""
    w = Window.partitionBy("volume").orderBy("seq")
    near = lambda f, c: f(c).over(w)
    rows = entries.select(
        "*",
        near(F.lag, "headword").alias("previous_headword"),
        near(F.lead, "headword").alias("next_headword"),
        F.substring(near(F.lag, "text"), 1, 200).alias("previous_text"),
        F.substring(near(F.lead, "text"), 1, 200).alias("next_text"),
    )
    return rows.where(F.col("sig") == sig)


def decide(decisions: DataFrame, new: DataFrame) -> DataFrame:
    """Decisions with the new ones put in by signature; the latest counts."""
    from lodestone.sources.sinks import upsert_latest

    return upsert_latest(decisions, new, ["sig"], "ts")


def review_stats(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """How many entries of each verdict there are and how many are decided, by action."""
    rows = entries.select("sig", "verdict").join(decisions.select("sig", "action"), "sig", "left")
    return rows.groupBy("verdict", "action").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "verdict", "action")


def coverage_gaps(pages: DataFrame) -> DataFrame:
    """Printed pages that are missing between the first and the last of a volume."""
    from lodestone.operators.relational import missing_numbers

    return missing_numbers(pages.where("printed_page IS NOT NULL"), "volume", "printed_page")
