"""Queries over small in-code inputs, for operators that the star-schema tables have no input for.

Each takes the session and a folder like the other queries and ignores the folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import schemas
from lodestone.functions import text as tx
from lodestone.operators import corrections, extraction, layout, qa, reconcile, segment
from lodestone.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

VOLUME = "\f".join(
    [
        "## p. 60 (#71) ####\nMALABAR, a district of a coast, with a table-\nland behind it. Pop. in 1831, 6,893. Lat. N. lat. 11° 20'.\n61\nLUTTICH. See LIEGE.\nZALAD, or ZALA. See SZALAD.",
        "## p. 61 (#72) ####\nNEW ZEALAND\nTRAZ-OZ-MONTES. TRAS-OS-MONTES.\nVIII KINGDOM OF KASAN, a region of old.\nMILL, a hamlet.\nXAVIER, a town.—Also a parish of the same name; see the following table.",
        "## p. 62 (#73) ####\nZURICH.\nThis canton is large and has many lakes in it.\nZURICH\nIt is near the CACHOE-.\nIRA falls.\nDigitized by Google",
    ]
)


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


def volumes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("v1", VOLUME)], "volume string, text string")


@query("segment_entries")
def segment_entries(spark, _):
    return segment.segment_entries(volumes(spark))


@query("volume_summary")
def volume_summary(spark, _):
    return segment.source_summary(segment.segment_entries(volumes(spark)))


@query("classify_lines")
def classify_lines(spark, _):
    lines = ["MALABAR, a district of", "LUTTICH. See LIEGE.", "ZALAD, or ZALA. See SZALAD.", "TRAZ-OZ-MONTES. TRAS-OS-MONTES.", "A.M., x", "VIII KINGDOM OF KASAN, a", "MILL, a hamlet", "MILL HILL, a hamlet", "VALUE, of goods", "WNW, a wind", "PPPPPPPPP, a"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    return rows.select("line", segment.classify(F.col("line")).alias("c")).select("line", "c.headword", "c.kind")


@query("clean_text")
def clean_text(spark, _):
    rows = spark.createDataFrame([("oil and bone NEW ZEALAND. to chance vessels",), ("PPPPPPPPPP x",), ("a -01-01-01 b  c",), ("Digitized by Google text",)], "text string")
    return rows.select("text", tx.clean_text(F.col("text")).alias("clean"))


@query("display_names")
def display_names(spark, _):
    rows = spark.createDataFrame([("LUS-LA-CROIX-HAUTE",), ("L'AQUILA",), ("GEORGE (LAKE)",), ("ISLE OF MAN",)], "name string")
    return rows.select("name", tx.title_case(F.col("name")).alias("display"), tx.strip_headword(F.col("name")).alias("headword"), F.array_join(tx.match_keys(F.col("name")), ",").alias("keys"))


def page(spark: SparkSession) -> DataFrame:
    lines = []
    for r in range(6):
        for c in range(3):
            lines.append(([40 + 130 * c, 100 + 30 * r, 130 + 130 * c, 120 + 30 * r], f"{r}{c}"))
    for r in range(45):
        lines.append(([520, 60 + 20 * r, 960, 76 + 20 * r], "a long line of running prose that fills its column " + str(r)))
    lines.append(([480, 10, 510, 26], "17"))
    return spark.createDataFrame([("v1", 0, 1000, 1000, [], lines)], schemas.PAGE_GEOMETRY)


@query("layout_tables")
def layout_tables(spark, _):
    return layout.detect_tables(page(spark)).select("volume", "idx", F.size("cells").alias("n_cells"), F.to_json("regions").alias("regions"))


@query("assemble_pages")
def assemble_pages(spark, _):
    return layout.assemble_pages(page(spark))


@query("digit_density")
def digit_density(spark, _):
    rows = spark.createDataFrame([("a", i, x) for i, x in enumerate(["12 34", "1841 77 x", "prose here", "55 66", "77 88", "99 10"])], "entry string, line_no int, line string")
    return layout.digit_density_run(rows, "entry", "line_no", "line")


@query("ratcliff_match")
def ratcliff_match(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet").select("p_type", tx.alpha_key(F.col("p_name")).alias("key"))
    return qa.close_match(part.withColumn("key", F.regexp_replace("key", "E", "A")), part, "p_type", "key", 0.82)


@query("headword_crosscheck")
def headword_crosscheck(spark, d):
    """Part names as printed against a copy with a wrong second letter, a lost first one, or without the name."""
    names = spark.read.parquet(f"{d}/part.parquet").select(tx.alpha_key(F.concat("p_name", "p_type")).alias("key")).distinct()
    kind = F.crc32(F.col("key").cast("binary")) % 4
    wrong = F.concat(F.substring("key", 1, 1), F.lit("Q"), F.expr("substring(key, 3)"))
    copy = F.when(kind == 0, wrong).when(kind == 1, F.expr("substring(key, 2)")).otherwise(F.col("key"))
    return qa.crosscheck(names, names.where(kind != 2).select(copy.alias("key")))


@query("heading_difference")
def heading_difference(spark, _):
    seen = spark.createDataFrame([(1, "Lake George"), (1, "Bastogue"), (1, "Zante")], "page int, name string")
    ours = spark.createDataFrame([(1, "GEORGE (LAKE)"), (1, "BASTOGNE"), (1, "QUITO")], "page int, name string")
    return qa.heading_difference(seen, ours)


@query("index_verdicts")
def index_verdicts(spark, _):
    entries = spark.createDataFrame([(1, "MALABAR"), (2, "BASTOGUES"), (3, "QWXYZ")], "entry_id bigint, headword string")
    names = spark.createDataFrame([("MALABAR", "Malabar"), ("BASTOGNES", "Bastognes")], "key string, name string")
    return qa.index_verdict(entries, names)


@query("correct_scans")
def correct_scans(spark, _):
    entries = spark.createDataFrame([(1, "the town of Isere near Bastogue and tho 1½ miles ocean", "the town of Isère near Bastogne and the 14½ miles occan")], "entry_id bigint, text string, other string")
    authority = spark.createDataFrame([("isere",), ("bastogne",)], "fold string")
    words = spark.createDataFrame([("the",), ("ocean",), ("town",)], "word string")
    return corrections.decide_changes(corrections.align(entries), authority, words)


@query("align_passages")
def align_passages(spark, _):
    entries = spark.createDataFrame([("v1", 1, "MALABAR, a district of the coast")], "volume string, entry_id bigint, text string")
    other = ["Preface", "Malabar", "hill", "MALABAR,", "a", "district", "of", "tho", "coast", "LUTON,"]
    words = spark.createDataFrame([("v1", i, w) for i, w in enumerate(other)], "volume string, pos bigint, word string").withColumn("key", F.lower(tx.word_key(F.col("word"))))
    return corrections.best_passage(entries, words)


@query("concordance_authority")
def concordance_authority(spark, _):
    rows = [("ancient_to_modern", "ISARA", ["Isère, or Oise"]), ("modern_to_ancient", "ISERE", ["Isara"])]
    variants = spark.createDataFrame(rows, "direction string, headword string, equivalents array<string>")
    return corrections.name_authority(corrections.name_forms(variants)).select("fold", "canonical", "count", F.array_join("eras", ",").alias("eras"))


@query("extract_contract")
def extract_contract(spark, _):
    entries = segment.segment_entries(volumes(spark)).where("kind = 'entry'").withColumn("entry_id", F.col("seq").cast("long"))
    asked = extraction.requests(entries, "rules", "short", "long", "v1")
    vocabulary = {"district": "300000705", "town": "300008375", "parish": "300000773", "canton": "300000769"}
    answers = extraction.call(asked, extraction.rule_backend(vocabulary), extraction.valid_response(set(vocabulary.values())))
    places = sinks.place_rows(extraction.parse_responses(answers.where("status = 'ok'")), F.lit("").cast("string"))
    return places.select("entry_id", "ordinal", "name", "aat_type_id", "extraction")


TRIPLES = [
    '<http://v/1> <http://x#prefLabel> <http://t/1-en> .',
    '<http://t/1-en> <http://x#literalForm> "towns"@en .',
    '<http://v/2> <http://x#prefLabel> <http://t/2-en> .',
    '<http://t/2-en> <http://x#literalForm> "settlements" .',
    "<http://v/1> <http://g#broaderPreferred> <http://v/2> .",
    "<http://v/2> <http://g#broaderGeneric> <http://v/3> .",
    "malformed",
]


@query("vocabulary_graph")
def vocabulary_graph(spark, _):
    triples = readers.parse_triples(spark.createDataFrame([(t,) for t in TRIPLES], "line string"))
    labels = readers.preferred_labels(triples)
    paths = reconcile.ancestors(labels.select("concept"), readers.broader_edges(triples))
    return labels.join(paths, "concept").select("concept", "label", F.array_join("path", " > ").alias("path"))


@query("fuzzy_labels")
def fuzzy_labels(spark, _):
    labels = spark.createDataFrame([(x,) for x in ("towns", "township seats", "townlands", "towers", "villages")], "label string")
    return reconcile.fuzzy_labels(labels, spark.createDataFrame([("market town",), ("village",)], "term string"))


def gazetteer(spark: SparkSession) -> DataFrame:
    rows = [
        ("g1", "Lutterworth", ["Lutterworth"], "GB", ["c1"], 52.45, -1.2, True),
        ("g2", "Macao", ["Macau"], "MO", [], 22.2, 113.55, False),
        ("g3", "Luton", ["Luton"], "GB", ["c1"], 51.88, -0.42, False),
        ("c1", "England", ["England"], "GB", [], 52.0, -1.0, True),
    ]
    return spark.createDataFrame(rows, schemas.GAZETTEER_HIT.replace("names array", "names array"))


@query("reconcile_places")
def reconcile_places(spark, _):
    rows = [("a", "Lutterworth", "GB", None, None, ["c1"]), ("b", "Macao", "MO", 22.19, 113.5, []), ("c", "Luroe", "NO", 66.39, 12.92, []), ("d", "Lutry", "CH", None, None, [])]
    places = spark.createDataFrame(rows, "key string, name string, country_code string, lat double, lon double, parents array<string>")
    out = reconcile.reconcile(places, gazetteer(spark))
    return out.select("key", "status", "match_id", "match_score", "recon_pass", F.array_join("flags", ",").alias("flags"), F.round("dist_km", 3).alias("dist_km"))


@query("hierarchy_resolution")
def hierarchy_resolution(spark, _):
    chains = spark.createDataFrame([("a", "GB", ["England (country)", "Nowhere", "Lutterworth"])], "key string, country_code string, admin array<string>")
    out = reconcile.resolve_hierarchy(chains, gazetteer(spark), levels=3)
    return out.select("key", F.array_join("parents", ",").alias("parents"), F.to_json("relations").alias("relations"))


@query("page_markers")
def page_markers(spark, _):
    pages = readers.page_chunks(volumes(spark))
    return pages.select("volume", "page_no", "printed_page", "img_idx", F.size("lines").alias("n_lines"), F.to_json(readers.marker_boxes(F.col("chunk"))).alias("boxes"))


@query("merge_pages")
def merge_pages(spark, _):
    pages = spark.createDataFrame([("v1", "p10", "ten"), ("v1", "p2", "two"), ("v1", "p1", "one <!-- plate -->")], "volume string, stem string, text string")
    return readers.merge_page_files(pages)


@query("transcript_headwords")
def transcript_headwords(spark, _):
    pages = spark.createDataFrame([("<p>ACCRINGTON (NEW), a town</p><p>MALABAR. A coast</p><p>Prose, x</p>",)], "html string")
    return readers.transcript_headwords(pages)
