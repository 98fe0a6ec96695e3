from __future__ import annotations

import corpus_pipeline as cp

from lodestone.llm import decontamination, merge_dropout, near_copies
from lodestone.llm.queries import tokenizer_path


def test_stages_in_order(spark, small):
    docs = small("documents")
    folder = "/root/testdata/sf0.001"
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder).cache()
        assert out.columns == small("documents").columns
        kept[name] = out
        docs = out
    before = small("documents")
    assert 0.9 * before.count() <= kept["language_id"].count() <= before.count()
    groups = near_copies.near_copies(kept["language_id"])
    assert {r.doc_id for r in kept["simhash_dedup"].collect()} == {r.component_id for r in groups.collect()}
    assert decontamination.find_leaks(kept["decontamination"], small("benchmark")).count() == 0
    assert kept["secret_scan"].count() == kept["decontamination"].count()
    texts = {r.doc_id: r.text for r in before.collect()}
    changed = [r for r in kept["secret_scan"].collect() if r.text != texts[r.doc_id]]
    assert all("[SECRET]" in r.text for r in changed)
    rows = cp.run(spark, folder)
    assert rows.count() == kept["secret_scan"].count()
    back = {r.doc_id: r.text for r in merge_dropout.decode_documents(rows, tokenizer_path("piece_bpe_32k.model")).collect()}
    assert back == {r.doc_id: r.text for r in kept["secret_scan"].collect()}


A, B, C, D = ("red apples grow here", "blue birds sing at dawn", "nine ships left the old harbour", "some other text entirely")
LONG = " ".join(f"w{i}" for i in range(200))


def test_survivors_by_row(spark):
    rows = [(5, A, "x"), (5, B, "x"), (3, B, "x"), (7, C, "x"), (7, D, "x"), (None, C, "x"), (None, "no number here at all", "x"), (8, LONG, "b"), (8, LONG, "a"), (9, LONG + " end", "a"), (10, "", "x"), (11, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    expected = [(5, A, "x"), (3, B, "x"), (7, C, "x"), (7, D, "x"), (None, "no number here at all", "x"), (8, LONG, "a"), (10, "", "x")]
    assert sorted(map(str, map(tuple, cp.near_duplicate_stage(spark, docs, "").collect()))) == sorted(map(str, expected))


def test_stages_take_odd_rows_and_empty_tables(spark, odd, empty, clashing):
    left = {"language_id": 6, "simhash_dedup": 6, "decontamination": 10, "secret_scan": 10, "merge_dropout": 10}
    for name, stage in cp.STAGES:
        assert stage(spark, odd, "/root/testdata/sf0.001").count() == left[name], name
        assert stage(spark, clashing, "/root/testdata/sf0.001").count() == left[name], name
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name
