from __future__ import annotations

from pathlib import Path

import pytest

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def small(spark):
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test tables")
    return lambda name: spark.read.parquet(str(DATA / "sf0.001" / f"{name}.parquet"))


@pytest.fixture(scope="session")
def medium(spark):
    if not (DATA / "sf0.01").exists():
        pytest.skip("no test tables")
    return lambda name: spark.read.parquet(str(DATA / "sf0.01" / f"{name}.parquet"))


def tokenizer(name):
    tokens = pytest.importorskip("public_tokenizers")
    return tokens.path(name)


#: doc_id, text, lang, source: nulls everywhere, empty and blank texts, ties, repeated rows, no letters.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog", None, None),
    (3, "", "en", "a"),
    (4, None, None, "b"),
    (5, " \n\t ", "de", None),
    (None, "ein text ohne kennung", "de", "b"),
    (6, "12345 !!! 67890", "en", "b"),
    (7, "word " * 30_000, "en", "b"),
    (8, "日本語 テキスト ▁ 🎉 \x00 end", None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like what the operators compute."""
    from pyspark.sql import functions as F

    names = ("score", "n_words", "fp", "spans", "key", "component_id", "value", "bucket", "words", "window", "name", "found", "n", "h", "lo")
    return odd.withColumns({n: F.lit(1) for n in names})
