"""String similarity that has no built-in: Ratcliff-Obershelp ratios and alignments, over Arrow batches."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def ratcliff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two strings; null if either is null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def ratcliff_words(a: pd.Series, b: pd.Series) -> pd.Series:
    """The same ratio over arrays of words."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, list(x), list(y)).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])))
def one_to_one_changes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Single words replaced by single words when two word arrays are aligned by their lower-cased letters and digits."""

    def key(words):
        return ["".join(c for c in w.lower() if c.isascii() and c.isalnum() or "à" <= c <= "ÿ") for w in words]

    def changes(x, y):
        if x is None or y is None:
            return None
        x, y = list(x), list(y)
        codes = difflib.SequenceMatcher(None, key(x), key(y)).get_opcodes()
        return [{"i": i1, "a": x[i1], "b": y[j1]} for tag, i1, i2, j1, j2 in codes if tag == "replace" and i2 - i1 == 1 and j2 - j1 == 1]

    return pd.Series([changes(x, y) for x, y in zip(a, b, strict=True)])


def could_reach(a: Column, b: Column, cutoff: float) -> Column:
    """A sound and cheap bound: the ratio can only reach the cutoff if the lengths allow it."""
    la, lb = F.length(a), F.length(b)
    return 2 * F.least(la, lb) >= cutoff * (la + lb)


def edit_score(a: Column, b: Column, least: float | None = None) -> Column:
    """100 for equal keys, falling with the edit distance relative to the longer key; null where it is surely below ``least``, which is found out sooner."""
    longest = F.greatest(F.length(a), F.length(b))
    if least is None:
        return F.when(longest == 0, 0.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))
    edits = F.call_function("levenshtein", a, b, F.floor(longest * (1 - least / 100) + 1e-9).cast("int"))
    return F.when(longest == 0, 0.0).when(edits >= 0, 100.0 * (1 - edits / longest))
