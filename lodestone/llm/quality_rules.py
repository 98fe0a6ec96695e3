"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each whole text is measured once, in its own row and with built-in functions only; the measures (no text) are checkpointed.
Every rule compares one integer measure with limits learnt for the document's language and source:

    symbols     n_symbols per 1000 words                upper limit
    dup_lines   repeated lines per 1000 lines           upper limit
    repeats     words in repeated windows per 1000      upper limit
    word_len    tenths of a code point per word         both limits

The sketch of a measure is its histogram over buckets that keep the six leading bits (exact below 64, within 1/32 above), at most a
few hundred rows however many documents there are.  Sketches merge by adding counts, so the order of tasks cannot
change them; those of a language and of the whole corpus are merged from those of its sources.  A group with fewer than ``min_docs``
sketched documents takes the merged sketch of its language, or else of the corpus.  A rule's limits come from the median m and the tail quantile t
of the group's sketch (for word_len also the lower tail b): t + k (t - m) and b - k (m - b).  The tail (the 90th to 99th percentile) and k are the rule's.
Where a tail equals its median, the spread is one step of the measure (1 per cent, or a tenth of a code point); README has how
often that decides.  Only documents that pass the base rules are sketched.

Words in repeated windows: windows of three words are compared by a 64-bit hash of their words within one document.

Defined results: null or empty text has no words and fails the base rules; null language or source is a group of its own; copies are each
judged alone; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import cut

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Rule -> (percentile of the tail, multiple of the spread, one step of the measure, whether it has a lower limit too).
RULES = {"symbols": (90, 3, 10, False), "dup_lines": (99, 1, 10, False), "repeats": (98, 2, 10, False), "word_len": (90, 3, 1, True)}


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas use it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


WHITE = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """Words of a text; trimmed first, so that splitting leaves no empty ones."""
    return let(F.btrim(text, F.lit(WHITE)), lambda bare: F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)))


def repeated_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""

    def covered(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        again = F.filter(
            pairs,
            lambda x, i: ((i > 0) & (F.get(pairs, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(pairs, i + 1)["h"] == x["h"])),
        )
        at = F.sort_array(F.transform(again, lambda x: x["p"]))
        start = F.struct(F.lit(-10).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")))["n"]

    def over(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        found = let(
            hashes,
            lambda h: F.when(
                F.size(F.array_distinct(h)) < F.size(h),
                let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), covered),
            ).otherwise(0),
        )
        return F.when(F.size(w) < 4, 0).otherwise(found)

    return let(words, over)


def text_measures(docs: DataFrame) -> DataFrame:
    """The word, symbol, line and repetition counts of every whole text, one narrow pass."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = (
        docs.select("doc_id", "lang", "source", text.alias("text"))
        .select(
            "doc_id",
            "lang",
            "source",
            let(
                words_of(F.col("text")),
                lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")),
            ).alias("w"),
            F.length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("x"),
        )
        .select("doc_id", "lang", "source", "w.*", "word_chars", "n_symbols", "x.*")
    )
    return counted


def rule_values() -> dict[str, Column]:
    return {
        "symbols": F.expr("1000 * n_symbols div greatest(n_words, 1)"),
        "dup_lines": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
        "repeats": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
        "word_len": F.expr("10 * word_chars div greatest(n_words, 1)"),
    }


def bucket(value: str) -> Column:
    return F.expr(f"shiftleft(shiftright({value}, greatest(length(bin({value})) - 6, 0)), greatest(length(bin({value})) - 6, 0))")


def sketches(measured: DataFrame) -> DataFrame:
    """Mergeable histograms (lang, source, rule, bucket, n) of the documents that pass the base rules."""
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"v_{r}").alias("value")) for r in RULES]))
    rows = measured.where(~F.col("base_failed")).select("lang", "source", values.alias("v")).select("lang", "source", "v.*")
    return rows.groupBy("lang", "source", "rule", bucket("value").alias("bucket")).agg(F.count("*").alias("n"))


def limits(merged: DataFrame, keys: list[str]) -> DataFrame:
    """One row a group: sketched documents ``n`` and the limits of each rule, from the quantiles of its sketches."""
    group = [*keys, "rule"]
    steps = merged.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("hist"),
        F.sum("n").alias("total"),
    )

    def percentile(p: Column) -> Column:
        seen = F.aggregate(
            "hist",
            F.struct(F.lit(0).cast("long").alias("cum"), F.lit(None).cast("long").alias("at")),
            lambda a, x: F.struct(
                (a["cum"] + x["n"]).alias("cum"),
                F.coalesce(a["at"], F.when(100 * (a["cum"] + x["n"]) >= p * F.col("total"), x["bucket"])).alias("at"),
            ),
        )
        return seen["at"]

    of_rule = lambda i: F.create_map(*[F.lit(x) for r, parts in RULES.items() for x in (r, parts[i])])[F.col("rule")].cast("long")
    tails = steps.select(*group, "total", percentile(F.lit(50)).alias("m"), percentile(of_rule(0)).alias("t"), percentile(100 - of_rule(0)).alias("b"))
    high = F.col("t") + of_rule(1) * F.greatest(F.col("t") - F.col("m"), of_rule(2))
    low = F.col("b") - of_rule(1) * F.greatest(F.col("m") - F.col("b"), of_rule(2))
    picks = [F.max(F.when(F.col("rule") == r, high)).alias(f"hi_{r}") for r in RULES]
    picks += [F.max(F.when(F.col("rule") == r, low)).alias(f"lo_{r}") for r, parts in RULES.items() if parts[3]]
    return tails.groupBy(*keys).agg(F.max("total").alias("n"), *picks)


def judge_quality(docs: DataFrame, min_docs: int = 100) -> DataFrame:
    """Counts, base verdict and adaptive verdict of every document."""
    measured = text_measures(docs)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = cut(measured.select("*", failed.alias("base_failed"), *[v.alias(f"v_{r}") for r, v in rule_values().items()]))
    fine = cut(sketches(measured))
    names = [f"hi_{r}" for r in RULES] + [f"lo_{r}" for r, parts in RULES.items() if parts[3]]

    def level(name: str, keys: list[str]) -> DataFrame:
        merged = fine.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
        out = limits(merged, keys)
        return out.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.col("n").alias(f"{name}_n"), *[F.col(c).alias(f"{name}_{c}") for c in names])

    by_source, by_lang = level("s", ["lang", "source"]), level("l", ["lang"])
    overall = level("a", []).first().asDict()  # five numbers
    groups = fine.select("lang", "source").union(measured.select("lang", "source")).distinct()
    groups = (
        groups.join(by_source, groups["lang"].eqNullSafe(F.col("s_lang")) & groups["source"].eqNullSafe(F.col("s_source")), "left")
        .join(by_lang, groups["lang"].eqNullSafe(F.col("l_lang")), "left")
    )
    own, lang = F.coalesce(F.col("s_n") >= min_docs, F.lit(False)), F.coalesce(F.col("l_n") >= min_docs, F.lit(False))
    groups = groups.select(
        groups["lang"].alias("g_lang"),
        groups["source"].alias("g_source"),
        F.when(own, "source").when(lang, "lang").otherwise("all").alias("sketch_level"),
        *[F.when(own, F.col(f"s_{c}")).when(lang, F.col(f"l_{c}")).otherwise(F.lit(overall[f"a_{c}"]).cast("long")).alias(c) for c in names],
    )
    joined = measured.join(groups, measured["lang"].eqNullSafe(F.col("g_lang")) & measured["source"].eqNullSafe(F.col("g_source")), "left")
    checks = [F.col(f"v_{r}") > F.col(f"hi_{r}") for r in RULES] + [F.col(f"v_{r}") < F.col(f"lo_{r}") for r, parts in RULES.items() if parts[3]]
    broken = sum((F.coalesce(c, F.lit(False)).cast("int") for c in checks), F.lit(0))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (broken == 0)).alias("kept"),
        "sketch_level",
    )


ORACLE = r"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT doc_id, lang, source, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM base
), spots AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM spots
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c > 1) GROUP BY doc_id
), m AS (
  SELECT words.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM words LEFT JOIN covered ON covered.doc_id = words.doc_id
), measured AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    (1000 * n_symbols) // greatest(n_words, 1) AS v_symbols, (1000 * n_dup_lines) // greatest(n_lines, 1) AS v_dup_lines,
    (1000 * n_repeat_words) // greatest(n_words, 1) AS v_repeats, (10 * word_chars) // greatest(n_words, 1) AS v_word_len
  FROM m
), vals AS (
  SELECT lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_len']) AS rule, unnest([v_symbols, v_dup_lines, v_repeats, v_word_len]) AS v
  FROM measured WHERE NOT base_failed
), fine AS (
  SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket, count(*) AS n
  FROM vals GROUP BY ALL
), merged AS (
  SELECT 's' AS lv, lang, source, rule, bucket, n FROM fine
  UNION ALL SELECT 'l', lang, NULL, rule, bucket, sum(n) FROM fine GROUP BY ALL
  UNION ALL SELECT 'a', NULL, NULL, rule, bucket, sum(n) FROM fine GROUP BY ALL
), cum AS (
  SELECT *, sum(n) OVER (PARTITION BY lv, lang, source, rule ORDER BY bucket) AS c, sum(n) OVER (PARTITION BY lv, lang, source, rule) AS total FROM merged
), quant AS (
  SELECT lv, lang, source, rule, max(total) AS total,
    CASE rule WHEN 'dup_lines' THEN 99 WHEN 'repeats' THEN 98 ELSE 90 END AS p, CASE rule WHEN 'dup_lines' THEN 1 WHEN 'repeats' THEN 2 ELSE 3 END AS k,
    CASE rule WHEN 'word_len' THEN 1 ELSE 10 END AS step, min(bucket) FILTER (100 * c >= 50 * total) AS m,
    min(bucket) FILTER (100 * c >= CASE rule WHEN 'dup_lines' THEN 99 WHEN 'repeats' THEN 98 ELSE 90 END * total) AS t, min(bucket) FILTER (100 * c >= 10 * total) AS b
  FROM cum GROUP BY ALL
), lim AS (
  SELECT *, t + k * greatest(t - m, step) AS hi, b - k * greatest(m - b, step) AS lo FROM quant
), wide AS (
  SELECT lv, lang, source, max(total) AS n, max(hi) FILTER (rule = 'symbols') AS hi_symbols, max(hi) FILTER (rule = 'dup_lines') AS hi_dup_lines,
    max(hi) FILTER (rule = 'repeats') AS hi_repeats, max(hi) FILTER (rule = 'word_len') AS hi_word_len, max(lo) FILTER (rule = 'word_len') AS lo_word_len
  FROM lim GROUP BY ALL
), picked AS (
  SELECT measured.*, CASE WHEN ws.n >= 100 THEN 'source' WHEN wl.n >= 100 THEN 'lang' ELSE 'all' END AS sketch_level,
    CASE WHEN ws.n >= 100 THEN ws ELSE CASE WHEN wl.n >= 100 THEN wl ELSE wa END END AS k
  FROM measured
  LEFT JOIN wide ws ON ws.lv = 's' AND ws.lang IS NOT DISTINCT FROM measured.lang AND ws.source IS NOT DISTINCT FROM measured.source
  LEFT JOIN wide wl ON wl.lv = 'l' AND wl.lang IS NOT DISTINCT FROM measured.lang
  LEFT JOIN wide wa ON wa.lv = 'a'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (v_symbols > k.hi_symbols OR v_dup_lines > k.hi_dup_lines OR v_repeats > k.hi_repeats OR v_word_len > k.hi_word_len OR v_word_len < k.lo_word_len) AS kept,
  sketch_level
FROM picked
"""
