"""Precision-first matching of places to a gazetteer.

The gazetteer is a table (place_id, title, names, country_code, containers, lat, lon, has_geom).  Candidates come from equi-joins on
blocking keys; all passes are scored at once and the first pass that matches wins, so a place is shuffled once, not once a pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import geo
from lodestone.functions import text as tx
from lodestone.functions.nested import add_flag, drop_flag
from lodestone.functions.similarity import edit_score


@dataclass(frozen=True)
class Pass:
    """One step of the cascade: mode exact or phonetic; container narrow, broad or none; relation recorded."""

    label: str
    mode: str
    container: str | None
    relation: str | None


PASSES = (Pass("1-exact-in", "exact", "narrow", "within"), Pass("2-phon-in", "phonetic", "narrow", "intersects"), Pass("3-phon-broad", "phonetic", "broad", "intersects"), Pass("4-phon-cc", "phonetic", None, None))
API_PASSES = (Pass("1-exact-cc", "exact", None, None), Pass("2-phon-cc", "phonetic", None, None))
# Least scores, preference margin, radius, certainty ranks.
THRESHOLD, COORD_THRESHOLD, SURE, MARGIN, RADIUS_KM = 80.0, 70.0, 90.0, 1.0, 50.0
CERTAINTY = {"1-exact-in": 1, "2-phon-in": 2, "3-phon-broad": 3, "4-phon-cc": 4, "coord-match": 1, "coord-only": 5}


def certainty(label: Column, default: int = 5) -> Column:
    return F.coalesce(*[F.when(label == k, F.lit(v)) for k, v in CERTAINTY.items()], F.lit(default))


def gazetteer_names(gazetteer: DataFrame) -> DataFrame:
    """One row a name: its exact key, and a block key of the first letter and length class for inexact search."""
    names = F.explode(F.array_distinct(F.concat(F.array("title"), F.coalesce("names", F.array().cast("array<string>"))))).alias("name")
    rows = gazetteer.select("place_id", "title", "country_code", "containers", "lat", "lon", "has_geom", names)
    return rows.withColumn("key", tx.alpha_key(F.col("name"))).where("key <> ''").withColumn("block", F.substring("key", 1, 1))


def score(query_key: Column, key: Column, mode: Column) -> Column:
    """Exact: 100 for equal keys, else no candidate.  Phonetic: by edit distance."""
    return F.when(mode == "exact", F.when(query_key == key, 100.0)).otherwise(edit_score(query_key, key))


def reachable_lengths(size: Column, mode: Column, threshold: float, margin: float = MARGIN) -> Column:
    """Key lengths at which a candidate can come within ``margin`` of the threshold: each unit of difference costs an edit."""
    share = max(0.01, (threshold - margin) / 100)
    least, most = F.greatest(F.ceil(size * share - 1e-9), F.lit(1)), F.floor(size / share + 1e-9)
    return F.when(mode == "exact", F.array(size)).otherwise(F.transform(F.sequence(least, F.greatest(least, most)), lambda n: n.cast("int")))


def pass_requests(places: DataFrame, passes: tuple[Pass, ...] = PASSES) -> DataFrame:
    """One row for each place and pass that applies: a pass without its container does not."""
    rank = F.explode(F.array(*[F.struct(F.lit(i).alias("pass_rank"), F.lit(p.label).alias("pass"), F.lit(p.mode).alias("mode"), F.lit(p.container).alias("level"), F.lit(p.relation).alias("relation")) for i, p in enumerate(passes)]))
    rows = places.select("*", rank.alias("r")).select(*places.columns, "r.*")
    n = F.size(F.coalesce("parents", F.array().cast("array<string>")))
    container = F.when(F.col("level") == "narrow", F.get("parents", n - 1)).when(F.col("level") == "broad", F.get("parents", n - 2))
    rows = rows.withColumn("container", F.when((F.col("level") != "broad") | (n >= 2), container))
    return rows.where("level IS NULL OR container IS NOT NULL").withColumn("query_key", tx.alpha_key(F.col("name")))


def best_candidate(candidates: DataFrame, by: list[str], threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """The best-scored candidate of each group, if it reaches the threshold; an area within ``margin`` of a best point is preferred to it.

    The threshold is tested on the best score only, so the area chosen may be just below it.  Also the gap between best score and best area.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "hit_rank", "place_id")
    ranked = candidates.withColumn("_rn", F.row_number().over(order))
    w = Window.partitionBy(*by)
    top = F.max("score").over(w)
    area = F.max(F.when(F.col("has_geom"), F.col("score"))).over(w)
    top_is_area = F.max(F.when(F.col("_rn") == 1, F.col("has_geom").cast("int"))).over(w) == 1
    ranked = ranked.withColumn("_top", top).withColumn("_area", area).withColumn("_top_area", top_is_area)
    use_area = ~F.col("_top_area") & F.col("_area").isNotNull() & (F.col("_top") - F.col("_area") <= margin)
    eligible = ranked.where(F.col("_top") >= threshold).where(F.when(use_area, F.col("has_geom")).otherwise(F.lit(True)))
    chosen = eligible.withColumn("_pick", F.row_number().over(order)).where("_pick = 1")
    return chosen.withColumn("gap", F.col("_top") - F.col("_area")).drop("_rn", "_top", "_area", "_top_area", "_pick")


def name_cascade(places: DataFrame, gazetteer: DataFrame, passes: tuple[Pass, ...] = PASSES, threshold: float = THRESHOLD) -> DataFrame:
    """(place columns, pass, place_id, title, score, relation) of the first pass that matches each place.

    ``places`` has key, name, country_code, parents (container ids, broad to narrow).  Exact passes are joined on the whole key; only places
    they leave open are compared by letters, once for all passes, with names of their country, first letter and a length within reach.
    Names more than MARGIN below the threshold are no candidates, so ``gap`` is null where no area comes that close.
    """
    names = gazetteer_names(gazetteer).withColumn("len", F.length("key")).alias("g")
    asked = pass_requests(places, passes)
    by = ["key", "pass_rank", "pass", "relation"]
    hit = ["g.place_id", "g.title", "g.lat", "g.lon", "g.has_geom"]

    def best_of(scored: DataFrame) -> DataFrame:
        once = scored.groupBy(*by, "place_id", "title", "lat", "lon", "has_geom").agg(F.max("score").alias("score")).withColumn("hit_rank", F.lit(0))
        return best_candidate(once, by, threshold)

    inside = F.col("q.container").isNull() | F.array_contains("g.containers", F.col("q.container"))
    country = F.col("q.country_code").isNull() | (F.col("q.country_code") == F.col("g.country_code"))
    equal = asked.where("mode = 'exact'").alias("q").join(names, (F.col("q.query_key") == F.col("g.key")) & country & inside)
    exact = best_of(equal.select(*[f"q.{c}" for c in by], *hit, F.lit(100.0).alias("score")))

    done = exact.select(F.col("key").alias("done"), F.col("pass_rank").alias("done_rank"))
    open_ = asked.where("mode <> 'exact'").join(done, (F.col("key") == F.col("done")) & (F.col("done_rank") < F.col("pass_rank")), "left_anti")
    open_ = open_.groupBy("key", "query_key", "country_code").agg(F.collect_list(F.struct("pass_rank", "pass", "relation", "container")).alias("passes"))
    open_ = open_.withColumn("block", F.substring("query_key", 1, 1)).withColumn("len", F.explode(reachable_lengths(F.length("query_key"), F.lit("phonetic"), threshold))).alias("q")
    alike = (F.col("q.block") == F.col("g.block")) & (F.col("q.len") == F.col("g.len"))
    known = open_.where("country_code IS NOT NULL").alias("q").join(names, alike & (F.col("q.country_code") == F.col("g.country_code")))
    anywhere = open_.where("country_code IS NULL").alias("q").join(names, alike)
    usable = F.filter("q.passes", lambda p: p["container"].isNull() | F.array_contains("g.containers", p["container"]))
    pairs = lambda met: met.select("q.key", usable.alias("usable"), *hit, edit_score(F.col("q.query_key"), F.col("g.key"), threshold - MARGIN).alias("score")).where((F.size("usable") > 0) & F.col("score").isNotNull())
    scored = pairs(known).unionByName(pairs(anywhere)).select("*", F.explode("usable").alias("p"))
    scored = scored.select("key", "p.pass_rank", "p.pass", "p.relation", "place_id", "title", "lat", "lon", "has_geom", "score")
    best = exact.unionByName(best_of(scored))
    first = best.withColumn("_rn", F.row_number().over(Window.partitionBy("key").orderBy("pass_rank"))).where("_rn = 1")
    return first.drop("_rn", "hit_rank")


def coordinate_pass(places: DataFrame, gazetteer: DataFrame, radius_km: float = RADIUS_KM, threshold: float = COORD_THRESHOLD) -> DataFrame:
    """(key, place_id, title, score, dist_km, flags): of the candidates of a place with printed coordinates within the radius, the nearest.

    Candidates meet places on degree cells, each place asking its own and the neighbouring cells of its circle, so no pair outside is made.
    """
    names = gazetteer_names(gazetteer).withColumn("cx", F.floor("lon")).withColumn("cy", F.floor("lat")).alias("g")
    asked = places.where("lat IS NOT NULL AND lon IS NOT NULL").withColumn("query_key", tx.alpha_key(F.col("name"))).withColumn("box", geo.circle_box(F.col("lat"), F.col("lon"), radius_km))
    asked = asked.withColumn("cx", F.explode(F.sequence(F.floor("box.west"), F.floor("box.east")))).withColumn("cy", F.explode(F.sequence(F.floor("box.south"), F.floor("box.north")))).alias("q")
    pairs = asked.join(names, (F.col("q.cx") == F.col("g.cx")) & (F.col("q.cy") == F.col("g.cy")) & (F.substring("q.query_key", 1, 1) == F.col("g.block")))
    dist = geo.haversine_km(F.col("q.lat"), F.col("q.lon"), F.col("g.lat"), F.col("g.lon"))
    points = edit_score(F.col("q.query_key"), F.col("g.key"))
    scored = pairs.select("q.key", "g.place_id", "g.title", points.alias("score"), dist.alias("dist_km")).where((F.col("score") >= threshold) & (F.col("dist_km") <= radius_km))
    order = Window.partitionBy("key").orderBy("dist_km", F.desc("score"), "place_id")
    best = scored.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
    return best.withColumn("flags", F.when(F.col("score") < SURE, F.array(F.lit("low_confidence"))).otherwise(F.array().cast("array<string>")))


def reconcile(places: DataFrame, gazetteer: DataFrame, passes: tuple[Pass, ...] = PASSES) -> DataFrame:
    """Every place with its outcome: matched by name, matched by coordinates, located only, or unmatched."""
    has_point = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    by_point = coordinate_pass(places, gazetteer).select("key", F.col("place_id").alias("c_id"), F.col("title").alias("c_title"), F.col("score").alias("c_score"), F.col("dist_km"), F.col("flags").alias("c_flags"))
    by_name = name_cascade(places.where(~has_point), gazetteer, passes).select("key", F.col("place_id").alias("n_id"), F.col("title").alias("n_title"), F.col("score").alias("n_score"), F.col("pass").alias("n_pass"), "relation")
    both = places.join(by_point, "key", "left").join(by_name, "key", "left")
    none = F.array().cast("array<string>")
    return both.select(
        *places.columns,
        F.when(F.col("n_id").isNotNull() | F.col("c_id").isNotNull() | has_point, "reconciled").otherwise("unmatched").alias("status"),
        F.coalesce("n_id", "c_id").alias("match_id"),
        F.coalesce("n_title", "c_title").alias("match_name"),
        F.coalesce("n_score", "c_score").alias("match_score"),
        F.when(F.col("n_id").isNotNull(), F.col("n_pass")).when(F.col("c_id").isNotNull(), "coord-match").when(has_point, "coord-only").alias("recon_pass"),
        F.when(F.col("c_id").isNotNull(), F.col("c_flags")).when(has_point & F.col("n_id").isNull(), F.array(F.lit("coord_only"))).otherwise(none).alias("flags"),
        "dist_km",
        "relation",
    )


def resolve_hierarchy(chains: DataFrame, gazetteer: DataFrame, levels: int = 8, threshold: float = THRESHOLD) -> DataFrame:
    """(key, parents, relations): administrative chains (key, country_code, admin: broad to narrow) resolved level by level.

    Each level is looked up within the last resolved one; a level without an area that scores enough is skipped.  Equal questions are asked once.
    """
    clean = F.transform("admin", lambda a: tx.drop_trailing_parenthesis(a))
    named = F.filter(clean, lambda a: a != "")
    keys = F.transform(named, tx.loose_key)
    unique = F.filter(named, lambda a, i: F.array_position(keys, tx.loose_key(a)) == i + 1)
    state = chains.select("key", "country_code", unique.alias("admin"), F.array().cast("array<string>").alias("parents"), F.array().cast("array<struct<relationTo:string,label:string>>").alias("relations"))
    names = gazetteer_names(gazetteer).where("has_geom").alias("g")
    for level in range(levels):
        asked = state.where(F.size("admin") > level).select(F.get("admin", F.lit(level)).alias("name"), "country_code", F.get("parents", F.size("parents") - 1).alias("within")).distinct()
        asked = asked.withColumn("query_key", tx.alpha_key(F.col("name"))).alias("q")
        country = F.col("q.country_code").isNull() | (F.col("q.country_code") == F.col("g.country_code"))
        inside = F.col("q.within").isNull() | F.array_contains("g.containers", F.col("q.within"))
        pairs = asked.join(names, (F.substring("q.query_key", 1, 1) == F.col("g.block")) & country & inside)
        scored = pairs.select("q.name", "q.country_code", "q.within", "g.place_id", "g.title", (F.col("q.query_key") != F.col("g.key")).cast("int").alias("inexact"), edit_score(F.col("q.query_key"), F.col("g.key")).alias("score"))
        order = Window.partitionBy("name", "country_code", "within").orderBy("inexact", F.desc("score"), "place_id")
        best = scored.where(F.col("score") >= threshold).withColumn("_rn", F.row_number().over(order)).where("_rn = 1").select(F.col("name").alias("b_name"), F.col("country_code").alias("b_cc"), F.col("within").alias("b_in"), "place_id", "title")
        on = (F.get("admin", F.lit(level)) == F.col("b_name")) & F.col("country_code").eqNullSafe(F.col("b_cc")) & F.get("parents", F.size("parents") - 1).eqNullSafe(F.col("b_in"))
        hit = F.col("place_id").isNotNull()
        state = state.join(best, on, "left").select(
            "key",
            "country_code",
            "admin",
            F.when(hit, F.concat("parents", F.array("place_id"))).otherwise(F.col("parents")).alias("parents"),
            F.when(hit, F.concat("relations", F.array(F.struct(F.col("place_id").alias("relationTo"), F.col("title").alias("label"))))).otherwise(F.col("relations")).alias("relations"),
        )
    return state.select("key", "parents", "relations")


def select_work(places: DataFrame, retry_unmatched: bool = False) -> DataFrame:
    states = ["extracted", "demo", *(["unmatched"] if retry_unmatched else [])]
    return places.where(F.col("match_id").isNull() & F.col("status").isin(states))


def reset(places: DataFrame) -> DataFrame:
    """Matches forgotten, states back to extracted."""
    empty = {c: F.lit(None).cast(places.schema[c].dataType) for c in ("match_id", "match_score", "recon_pass", "reconciliation") if c in places.columns}
    return places.withColumns(empty).withColumn("status", F.when(F.col("status").isin("reconciled", "unmatched"), "extracted").otherwise(F.col("status")))


def containment_check(places: DataFrame, polygons: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Flag ``containment_fail`` set or cleared: whether a located place is in, or within the tolerance of, its narrowest parent that has a polygon.

    ``polygons`` has container and ring (array of [x, y]), several rows for an area of several parts.  Places without such a parent keep their flags.
    """
    parents = places.where("lat IS NOT NULL AND lon IS NOT NULL").select("key", "lat", "lon", F.posexplode(F.reverse("parents")).alias("step", "container"))
    parts = parents.join(polygons, "container").withColumn("outside", geo.outside_distance(F.col("lon"), F.col("lat"), F.col("ring")))
    nearest = parts.groupBy("key", "step").agg(F.min("outside").alias("outside"))
    verdict = nearest.groupBy("key").agg(F.min_by("outside", "step").alias("outside"))
    joined = places.join(verdict, "key", "left")
    flags = F.when(F.col("outside") > tolerance, add_flag(F.col("flags"), "containment_fail")).when(F.col("outside").isNotNull(), drop_flag(F.col("flags"), "containment_fail")).otherwise(F.col("flags"))
    return joined.withColumn("flags", flags).drop("outside")


def ancestors(start: DataFrame, broader: DataFrame, depth: int = 6) -> DataFrame:
    """(concept, path): the chain of first parents, at most ``depth`` long, stopping before a repetition."""
    parent = broader.groupBy("concept").agg(F.min("broader").alias("broader"))
    state = start.select("concept", F.array("concept").alias("path"), F.lit(False).alias("done"))
    for _ in range(depth):
        nxt = parent.select(F.col("concept").alias("_c"), "broader")
        joined = state.join(nxt, F.element_at("path", -1) == F.col("_c"), "left")
        go = ~F.col("done") & F.col("broader").isNotNull() & ~F.array_contains("path", F.col("broader"))
        state = joined.select("concept", F.when(F.coalesce(go, F.lit(False)), F.concat("path", F.array("broader"))).otherwise(F.col("path")).alias("path"), (~F.coalesce(go, F.lit(False))).alias("done"))
    return state.select("concept", F.expr("slice(path, 2, size(path))").alias("path"))


def fuzzy_labels(labels: DataFrame, terms: DataFrame, n: int = 3) -> DataFrame:
    """For each term the first ``n`` labels, in order, that begin with its last word without a plural s."""
    head = F.regexp_replace(F.element_at(F.split(F.lower("term"), r"\s+"), -1), "s$", "")
    asked = terms.select("term", head.alias("head")).withColumn("block", F.substring("head", 1, 2))
    known = labels.select("label").distinct().withColumn("block", F.substring(F.lower("label"), 1, 2))
    hits = asked.join(known, "block").where(F.lower("label").startswith(F.col("head")))
    return hits.withColumn("rank", F.row_number().over(Window.partitionBy("term").orderBy("label"))).where(F.col("rank") <= n).select("term", "label", "rank")


# The demonstration places (name, country, latitude, longitude).
DEMO = (
    ("Lutterworth", "GB", None, None), ("Luristan", "IR", None, None), ("Luton", "GB", None, None), ("Macao", "MO", 22.19, 113.50),
    ("Luroe", "NO", 66.39, 12.92), ("Lutry", "CH", None, None), ("Lusatia", "DE", None, None), ("Lustleigh", "GB", None, None),
)


def demo_places(spark) -> DataFrame:
    """Eight places to try the cascade on."""
    rows = [(f"demo-{i}", *p, [], "demo") for i, p in enumerate(DEMO, 1)]
    return spark.createDataFrame(rows, "key string, name string, country_code string, lat double, lon double, parents array<string>, status string")


def score_gaps(matched: DataFrame) -> DataFrame:
    """How far the best area lay behind the best hit: count, mean and largest gap."""
    return matched.where("gap IS NOT NULL").agg(F.count("*").alias("n"), F.avg("gap").alias("mean_gap"), F.max("gap").alias("max_gap"))
