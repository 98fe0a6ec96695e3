"""Corrections of one scan by another, and the authority of name forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import text as tx
from lodestone.functions.similarity import one_to_one_changes, ratcliff, ratcliff_words

FRACTIONS = "[0-9½¼¾⅓⅔⅛⅜⅝⅞]"


def decide_changes(changes: DataFrame, authority: DataFrame, words: DataFrame) -> DataFrame:
    """(…, before, after, reason, applied): a decision for each aligned change (a, b) of single words.

    Guards first (empty, equal, shouting, numbers, unlike words); then a known name with accents wins over one without, a known name over an
    unknown word, a dictionary word over a non-word; the rest is flagged or kept.
    """
    rows = changes.withColumn("ka", tx.word_key(F.col("a"))).withColumn("kb", tx.word_key(F.col("b")))
    rows = rows.withColumn("la", F.lower("ka")).withColumn("lb", F.lower("kb"))
    plausible = (F.col("ka") != "") & (F.col("kb") != "") & (F.col("la") != F.col("lb")) & ~tx.is_shouted(F.col("b")) & ~F.col("a").rlike(FRACTIONS) & ~F.col("b").rlike(FRACTIONS) & (F.abs(F.length("ka") - F.length("kb")) <= 3)
    rows = rows.where(plausible).withColumn("ratio", ratcliff(F.col("la"), F.col("lb"))).where("ratio >= 0.7")
    rows = rows.withColumn("fa", tx.fold(F.col("ka"))).withColumn("fb", tx.fold(F.col("kb")))
    names = authority.select("fold").distinct()
    rows = rows.join(names.select(F.col("fold").alias("fa"), F.lit(True).alias("name_a")), "fa", "left").join(names.select(F.col("fold").alias("fb"), F.lit(True).alias("name_b")), "fb", "left")
    for side in ("a", "b"):
        known = words.select(F.col("word").alias(f"_w{side}"), F.lit(True).alias(f"word_{side}")).distinct()
        plural = words.select(F.col("word").alias(f"_p{side}"), F.lit(True).alias(f"plural_{side}")).distinct()
        rows = rows.join(known, F.col(f"l{side}") == F.col(f"_w{side}"), "left").join(plural, F.col(f"l{side}").endswith("s") & (F.regexp_replace(f"l{side}", "s$", "") == F.col(f"_p{side}")), "left")
    capital = F.col("ka").rlike(r"^\p{Lu}")
    na, nb = capital & F.col("name_a").isNotNull(), capital & F.col("name_b").isNotNull()
    wa, wb = (F.coalesce(f"word_{s}", f"plural_{s}", F.lit(False)) for s in "ab")
    accents = tx.has_diacritic(F.col("kb")) & ~tx.has_diacritic(F.col("ka"))
    reason = (
        F.when((F.col("fa") == F.col("fb")) & (na | nb), F.when(accents, "toponym-diacritic").otherwise("keep"))
        .when(nb & ~na, "toponym")
        .when(na & ~nb, "keep")
        .when(wb & ~wa, "word")
        .when(wa & ~wb, "keep")
        .when(wa | wb, "flag:both-words")
        .otherwise("flag:toponym")
    )
    rows = rows.withColumn("reason", reason)
    after = F.replace(F.col("a"), F.col("ka"), F.col("kb"))
    applied = F.col("reason").isin("toponym-diacritic", "toponym", "word") & (after != F.col("a"))
    return rows.select(*[c for c in changes.columns if c not in ("a", "b")], F.col("a").alias("before"), F.when(applied, after).otherwise(F.col("b")).alias("after"), "reason", applied.alias("applied"))


def align(entries: DataFrame, other: str = "other") -> DataFrame:
    """(entry_id, i, a, b) of the changes between an entry's text and the aligned passage of the other scan."""
    words = lambda c: F.filter(F.split(F.col(c), r"\s+"), lambda w: w != "")
    rows = entries.select("entry_id", F.explode(one_to_one_changes(words("text"), words(other))).alias("c"))
    return rows.select("entry_id", "c.*")


def apply_changes(entries: DataFrame, decided: DataFrame) -> DataFrame:
    """Entries with ``text_corrected``: applied changes put in at their word, words joined by single spaces; entries without changes copy the text."""
    fixes = decided.where("applied").groupBy("entry_id").agg(F.map_from_entries(F.collect_list(F.struct("i", "after"))).alias("fixes"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    fixed = F.array_join(F.transform(words, lambda w, i: F.coalesce(F.try_element_at("fixes", i), w)), " ")
    return entries.join(fixes, "entry_id", "left").withColumn("text_corrected", F.when(F.col("fixes").isNotNull(), fixed).otherwise(F.col("text"))).drop("fixes")


def best_passage(entries: DataFrame, other_words: DataFrame, probe: int = 12, stretch: float = 1.8, slack: int = 10) -> DataFrame:
    """(entry_id, other): the passage of the other scan that starts at the best anchor of each entry.

    ``other_words`` has volume, pos, key, word.  Anchors are the places of the headword's first word; each is probed by the likeness of the next words.
    """
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    asked = entries.select("volume", "entry_id", words.alias("w")).withColumn("key", F.lower(tx.word_key(F.get("w", F.lit(0)))))
    anchors = asked.join(other_words.select("volume", "key", "pos"), ["volume", "key"])
    length = (F.floor(F.size("w") * stretch) + slack).cast("int")
    span = F.explode(F.sequence(F.lit(0), length - 1)).alias("k")
    near = anchors.select("volume", "entry_id", "w", "pos", span).withColumn("at", F.col("pos") + F.col("k"))
    text = near.join(other_words.select("volume", F.col("pos").alias("at"), "word"), ["volume", "at"])
    passages = text.groupBy("volume", "entry_id", "pos").agg(F.first("w").alias("w"), F.transform(F.sort_array(F.collect_list(F.struct("k", "word"))), lambda x: x["word"]).alias("p"))
    scored = passages.withColumn("like", ratcliff_words(F.slice("w", 1, probe), F.slice("p", 1, probe)))
    best = scored.withColumn("_rn", F.row_number().over(Window.partitionBy("entry_id").orderBy(F.desc("like"), "pos"))).where("_rn = 1")
    return best.select("entry_id", F.array_join("p", " ").alias("other"))


def name_forms(variants: DataFrame) -> DataFrame:
    """(printed, era) of a concordance: headwords as they are, equivalents by their capitalised tokens."""
    ancient = F.col("direction") == "ancient_to_modern"
    heads = variants.select(F.col("headword").alias("printed"), F.when(ancient, "ancient").otherwise("modern").alias("era"))
    others = variants.select(F.explode("equivalents").alias("e"), F.when(ancient, "modern").otherwise("ancient").alias("era")).select(F.explode(tx.name_tokens(F.col("e"))).alias("printed"), "era")
    return heads.unionByName(others).withColumn("printed", tx.trim_marks(F.col("printed")))


def name_authority(forms: DataFrame, fold: Column | None = None) -> DataFrame:
    """(fold, canonical, forms, count, eras): printed forms under their folded key; the canonical one has accents, is not all capitals, and is frequent."""
    keyed = forms.where(F.length(F.regexp_replace("printed", "[^A-Za-zÀ-ÿ]", "")) >= 3)
    folded = keyed.select("printed").distinct().withColumn("fold", fold if fold is not None else tx.fold(F.col("printed"))).where("fold <> ''")
    counts = keyed.join(folded, "printed").groupBy("fold", "printed").agg(F.count("*").alias("n"), F.collect_set("era").alias("eras"))
    rank = F.struct(tx.has_diacritic(F.col("printed")), F.col("printed") != F.upper("printed"), F.col("n"), F.col("printed"))
    grouped = counts.groupBy("fold").agg(
        F.max_by("printed", rank).alias("canonical"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("printed", "n")))).alias("forms"),
        F.sum("n").alias("count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("eras")))).alias("eras"),
    )
    return grouped
