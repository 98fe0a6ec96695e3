"""Line and entry rules, against the worked examples of the blueprint."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.operators import segment
from lodestone.plans import fixtures
from lodestone.sources import readers

LINES = [
    ("MALABAR, a district of the coast", "entry"),
    ("LUTTICH. See LIEGE.", "crossref"),
    ("ZALAD, or ZALA. See SZALAD.", "crossref"),
    ("TRAZ-OZ-MONTES. TRAS-OS-MONTES.", "crossref"),
    ("A.M., before noon", None),
    ("VIII KINGDOM OF KASAN, a region", None),
    ("MILL, a hamlet", None),
    ("DILI, a town", None),
    ("CIVIL, a town", None),
    ("MILL HILL, a hamlet", "entry"),
    ("VALUE, of goods", None),
    ("IMPORTS, of goods", None),
    ("WNW, a wind", None),
    ("V. PASHALIK OF MARASH, a part", None),
    ("PPPPPPPPP, a run", None),
    ("PARIS, The city", None),
    ("ACCRINGTON (NEW), a township", "entry"),
    ("plain prose, of no entry", None),
]


def test_classify(spark):
    rows = spark.createDataFrame([(x,) for x, _ in LINES], "line string").select("line", segment.classify(F.col("line"))["kind"].alias("kind"))
    assert {r.line: r.kind for r in rows.collect()} == dict(LINES)


def test_strict_roman_option_keeps_words(spark):
    rows = spark.createDataFrame([("MILL",), ("XVI",)], "h string").select("h", segment.is_false_headword(F.col("h"), keep_roman_words=True).alias("f"))
    assert {r.h: r.f for r in rows.collect()} == {"MILL": False, "XVI": True}


@pytest.mark.parametrize(
    ("lines", "healed"),
    [
        (["table-", "land behind"], ["tableland behind"]),
        (["CACHOE-.", "IRA. See X"], ["CACHOEIRA. See X"]),
        (["a well-", "Known man"], ["a well-", "Known man"]),
        ([], []),
    ],
)
def test_heal_wraps(spark, lines, healed):
    row = spark.createDataFrame([(lines,)], "lines array<string>").select(readers.heal_wraps(F.col("lines")).alias("x")).first()
    assert row.x == healed


def test_entries_of_a_volume(spark):
    rows = {r.headword: r for r in fixtures.segment_entries(spark, "").collect()}
    assert rows["MALABAR"].kind == "entry"
    assert "tableland" in rows["MALABAR"].text and " 61 " not in rows["MALABAR"].text
    assert rows["LUTTICH"].see_target == "LIEGE"
    assert rows["XAVIER"].n_also == 1 and rows["XAVIER"].table_missing == 1
    assert "CACHOEIRA" in rows["ZURICH"].text and "Digitized" not in rows["ZURICH"].text
    assert [r.seq for r in sorted(rows.values(), key=lambda r: r.seq)] == list(range(len(rows)))


SCHEMA = (
    "volume string, page_no int, line_no int, printed_page int, line string, opens struct<headword: string, delimiter: string, rest: string, kind: string>, "
    "head string, is_false boolean, is_noise boolean, stands_alone boolean"
)


def entries(spark, rows, appendix_after=200):
    rows = [("v", 0, i, r["printed_page"], r["line"], r["opens"], r["head"], r["is_false"], r["is_noise"], r["stands_alone"]) for i, r in enumerate(rows)]
    return sorted(segment.entries_of_lines(spark.createDataFrame(rows, SCHEMA), appendix_after).collect(), key=lambda r: r.seq)


def line(text, **more):
    return {"line": text, "printed_page": 1, "opens": None, "head": None, "is_false": True, "is_noise": False, "stands_alone": False} | more


def opens(name, rest, **more):
    return line(f"{name}, {rest}", opens=(name, ",", rest, "entry"), **more)


def heading(name, **more):
    return line(f"{name}.", head=name, is_false=False, stands_alone=True, **more)


def test_display_heading_needs_a_finished_entry_and_a_later_name(spark):
    shown, prose = heading("AFGHANISTAN"), line("This country is large.")
    done = entries(spark, [opens("ABBEVILLE", "a town. Pop. 657."), shown, prose])
    assert [e["headword_raw"] for e in done] == ["ABBEVILLE", "AFGHANISTAN"] and done[1].body == "This country is large."
    cut = entries(spark, [opens("ABBEVILLE", "a town in the circle of the"), shown, prose])
    assert [e["headword_raw"] for e in cut] == ["ABBEVILLE"]
    back = entries(spark, [opens("ZARA", "a town. Pop. 657."), shown, prose])
    assert [e["headword_raw"] for e in back] == ["ZARA"]
    list_of_heads = entries(spark, [opens("ABBEVILLE", "a town."), shown, heading("AGRA"), prose])
    assert [e["headword_raw"] for e in list_of_heads] == ["ABBEVILLE", "AGRA"]


def test_repeated_names_noise_and_hyphens(spark):
    rows = [line("before all"), opens("MALTA", "an island of the Mediter-", printed_page=4), heading("MALTA", printed_page=5), line("ranean sea, well-", printed_page=5), line("Known.", printed_page=None), line("17", is_noise=True, printed_page=7), heading("MANILA"), line("A town.", printed_page=6)]
    done = entries(spark, rows)
    assert [(e.seq, e.headword_raw, e.body, e.page_start, e.page_end) for e in done] == [
        (0, "MALTA", "an island of the Mediterranean sea, well- Known. 17", 4, 7),
        (1, "MANILA", "A town.", 1, 6),
    ]


def test_appendix_ends_the_entries_and_is_kept(spark):
    rows = [opens(f"NAME{chr(65 + i // 26)}{chr(65 + i % 26)}", "a town.") for i in range(5)] + [line("APPENDIX."), line("ancient names")]
    out = entries(spark, rows, appendix_after=2)
    assert [e.seq for e in out] == list(range(6)) and out[-1]["kind"] == "back_matter" and out[-1]["body"] == "APPENDIX.\nancient names"
    assert len(entries(spark, rows, appendix_after=4)) == 5


def test_clean_text_and_names(spark):
    assert {r.clean for r in fixtures.clean_text(spark, "").collect()} == {"oil and bone to chance vessels", "P x", "a b c", "text"}
    shown = {r.name: r.display for r in fixtures.display_names(spark, "").collect()}
    assert shown["LUS-LA-CROIX-HAUTE"] == "Lus-la-Croix-Haute" and shown["L'AQUILA"] == "L'Aquila" and shown["ISLE OF MAN"] == "Isle of Man"


def test_match_keys_meet_for_inverted_names(spark):
    rows = spark.createDataFrame([("Lake George",), ("George (Lake)",)], "n string").select(tx.match_keys(F.col("n")).alias("k")).collect()
    assert set(rows[0].k) & set(rows[1].k)


def test_truncate(spark):
    rows = spark.createDataFrame([("x" * 6000,), ("x" * 6001,)], "t string").select(F.length(tx.truncate_text(F.col("t"))).alias("n")).collect()
    assert [r.n for r in rows] == [6000, 6000 + len(" …[truncated]")]


def test_empty_volumes(spark):
    empty = spark.createDataFrame([], "volume string, text string")
    assert segment.segment_entries(empty).count() == 0
    assert segment.segment_entries(spark.createDataFrame([("v", "")], "volume string, text string")).count() == 0
