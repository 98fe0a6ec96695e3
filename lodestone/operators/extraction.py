"""Model calls as data: requests, a content-addressed cache, validation, retries and materialisation.

A backend is a function from a list of texts to a list of (response_json, usage_json) pairs.  The one built in is deterministic and rule-based,
so that everything behind it can be tested offline; it makes no claim to equal a language model.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import schemas
from lodestone.functions import text as tx
from lodestone.functions.nested import strict_json

Backend = Callable[[list[str]], list[tuple[str, str]]]
CLASS_ORDER = "PAHTSX"
LONG_TOKENS = 800


def route(tokens: Column, short: str, long: str, limit: int = LONG_TOKENS) -> Column:
    return F.when(tokens > limit, long).otherwise(short)


def requests(entries: DataFrame, provider: str, short: str, long: str, prompt_signature: str, use_corrected: bool = False) -> DataFrame:
    """(entry_id, provider, model, text, key): routed by length, cut to the request limit, keyed by everything that decides the answer."""
    text = F.coalesce("text_corrected", "text") if use_corrected else F.col("text")
    rows = entries.select("entry_id", F.lit(provider).alias("provider"), route(F.col("tokens"), short, long).alias("model"), tx.truncate_text(text).alias("text"))
    return rows.withColumn("key", tx.content_key(F.col("provider"), F.col("model"), F.lit(prompt_signature), F.col("text")))


def split_by_cache(asked: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with their responses, misses)."""
    known = cache.select("key", "response_json", "usage_json").dropDuplicates(["key"])
    return asked.join(known, "key"), asked.join(known, "key", "left_anti")


ANSWER = "entry_id bigint, key string, provider string, model string, response_json string, usage string, status string"


def call(misses: DataFrame, backend: Backend, valid: Callable[[str], bool] | None = None, tries: int = 4, wait: float = 0.0, batch: int = 25) -> DataFrame:
    """Answers of the backend, in batches; a batch that fails is tried again with growing waits, an invalid answer stays out (status failed)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), batch):
                part = frame.iloc[lo : lo + batch]
                answers: list[tuple[str | None, str | None]] = [(None, None)] * len(part)
                for attempt in range(tries):
                    try:
                        answers = list(backend(part["text"].tolist()))
                        break
                    except Exception:  # noqa: BLE001  the rows stay pending
                        time.sleep(min(wait * 2**attempt, 15.0))
                ok = [r is not None and (valid is None or valid(r)) for r, _ in answers]
                out = part[["entry_id", "key", "provider", "model"]].copy()
                out["response_json"] = [r if good else None for (r, _), good in zip(answers, ok, strict=True)]
                out["usage"] = [u for _, u in answers]
                out["status"] = ["ok" if good else "failed" for good in ok]
                yield out

    return misses.mapInPandas(run, ANSWER)


# Month-free patterns of the rule backend.
POPULATION = re.compile(r"Pop\.?(?: in (\d{4}))?,? ([\d,]+)")
DEGREES = re.compile(r"(N|S|E|W)\.? ?(lat|long)\.? (\d+)°(?: (\d+)['′])?")
ALSO = re.compile(r"—\s*Also\b", re.I)


def rule_backend(vocabulary: dict[str, str]) -> Backend:
    """Headword, type by vocabulary term, population series and printed coordinates of each part of an entry."""

    def one(text: str) -> tuple[str, str]:
        head = re.match(r"^([A-ZÀ-Þ][A-ZÀ-Þ .'’\-]*[A-ZÀ-Þ])", text)
        name = (head.group(1) if head else text.split(",")[0]).title()
        places = []
        for part in ALSO.split(text):
            low = part.lower()
            term = next((t for t in sorted(vocabulary, key=lambda t: (low.find(t) if t in low else 1 << 30, -len(t), t)) if t in low), None)
            point = {"lat": None, "long": None}
            for side, axis, whole, minutes in DEGREES.findall(part):
                value = int(whole) + int(minutes or 0) / 60
                point[axis] = round(-value if side in "SW" else value, 5)
            places.append(
                {
                    "name": name, "variant_names": re.findall(r"\bor ([A-ZÀ-Þ][A-Za-zÀ-ÿ]+)", part), "feature_term": term, "aat_type_id": vocabulary.get(term, "other"), "country": None, "country_code": None,
                    "admin_hierarchy": [], "spatial_relations": [], "latitude": point["lat"], "longitude": point["long"],
                    "population": [{"year": int(y) if y else None, "count": int(n.replace(",", ""))} for y, n in POPULATION.findall(part)], "area": None, "peoples": [], "notes": [],
                }
            )
        return json.dumps({"places": places, "ocr_corrections": []}, ensure_ascii=False), json.dumps({"input_tokens": len(text) // 4, "output_tokens": 60 * len(places)})

    return lambda texts: [one(t) for t in texts]


REQUIRED = ("name", "variant_names", "aat_type_id", "admin_hierarchy", "spatial_relations", "population", "peoples", "notes")


def valid_response(types: set[str]) -> Callable[[str], bool]:
    """Whether an answer is a whole record: all required members, types of the closed vocabulary or "other"."""

    def check(raw: str) -> bool:
        try:
            record = json.loads(raw)
        except ValueError:
            return False
        places = record.get("places") if isinstance(record, dict) else None
        return isinstance(places, list) and isinstance(record.get("ocr_corrections"), list) and all(
            isinstance(p, dict) and all(p.get(k) is not None for k in REQUIRED) and (p["aat_type_id"] == "other" or p["aat_type_id"] in types) for p in places
        )

    return check


def parse_responses(answers: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """(entry_id, places, corrections): answers parsed against the schema, taken whole or not at all, types outside the vocabulary rejected."""
    parsed = answers.withColumn("r", strict_json(F.col("response_json"), schemas.RESPONSE, ["places", "ocr_corrections"])).where("r IS NOT NULL")
    complete = F.forall("r.places", lambda p: F.forall(F.array(*[p[k].isNotNull() for k in REQUIRED]), lambda ok: ok))
    parsed = parsed.where(complete)
    if types is not None:
        used = parsed.select("entry_id", F.explode("r.places").alias("p")).select("entry_id", F.col("p.aat_type_id").alias("type_id")).where("type_id <> 'other'")
        wrong = used.join(types.select("type_id").distinct(), "type_id", "left_anti").select("entry_id").distinct()
        parsed = parsed.join(wrong, "entry_id", "left_anti")
    return parsed.select("entry_id", F.col("r.places").alias("places"), F.col("r.ocr_corrections").alias("corrections"))


def one_job_per_model(misses: DataFrame) -> DataFrame:
    """Batch jobs to submit: one a routed model."""
    return misses.groupBy("model").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def vocabulary_block(vocabulary: DataFrame) -> DataFrame:
    """Vocabulary lines by class, in the fixed class order."""
    line = F.concat(F.lit("    "), F.col("type_id"), F.lit("  "), F.rpad("label", 30, " "), F.lit("  ← "), F.array_join("terms", ", "))
    rank = F.expr(f"instr('{CLASS_ORDER}', fclass)")
    return vocabulary.select(rank.alias("rank"), "fclass", "type_id", line.alias("line")).orderBy("rank", "type_id")


def plan(asked: DataFrame, misses: DataFrame) -> DataFrame:
    """What a run would do: requests, cached, to be asked, by model."""
    all_ = asked.groupBy("model").agg(F.count("*").alias("requests"))
    todo = misses.groupBy("model").agg(F.count("*").alias("to_ask"))
    return all_.join(todo, "model", "left").select("model", "requests", F.coalesce("to_ask", F.lit(0)).alias("to_ask"))


def compare_configs(places: DataFrame, reference: str) -> DataFrame:
    """Agreement of each configuration with the reference, entry by entry: same number of places, and likeness of their names.

    ``places`` has entry_id, config, name.
    """
    key = F.regexp_replace(F.lower("name"), "[^a-z0-9]", "")
    sets = places.groupBy("entry_id", "config").agg(F.count("*").alias("n"), F.collect_set(key).alias("names"))
    ref = sets.where(F.col("config") == reference).select("entry_id", F.col("n").alias("rn"), F.col("names").alias("rnames"))
    both = sets.where(F.col("config") != reference).join(ref, "entry_id")
    union = F.size(F.array_union("names", "rnames"))
    like = F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect("names", "rnames")) / union)
    return both.groupBy("config").agg(F.count("*").alias("entries"), F.avg((F.col("n") == F.col("rn")).cast("double")).alias("same_count"), F.avg(like).alias("name_jaccard"))
