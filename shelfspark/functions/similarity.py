"""Name similarity. The character ratio has no builtin: an Arrow UDF over the standard library."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from shelfspark.functions import tables, text


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts, null if either is."""
    ratio = lambda x, y: None if x is None or y is None else SequenceMatcher(None, x, y).ratio()
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def letters_only(name_en: Column, name_ar: Column) -> Column:
    lower = F.lower(text.full_text(name_en, name_ar))
    bare = F.regexp_replace(F.regexp_replace(lower, rf"(?U)\b({tables.NAME_NOISE})\b", " "), r"(?U)\d+(?:\.\d+)?", " ")
    return F.trim(F.regexp_replace(bare, "[^a-zء-ي]+", " "))


def full_name_similarity(a: Column, b: Column, enough: float = 1.0) -> Column:
    """The larger of character ratio and token overlap of letters-only names, 0 without letters.

    Where the overlap alone is ``enough`` the ratio isn't computed: the larger can only be more.
    """
    words = lambda c: F.array_distinct(F.split(c, " "))
    overlap = text.overlap_coefficient(words(a), words(b))
    return F.when((a == "") | (b == ""), 0.0).otherwise(
        F.when(overlap >= enough, overlap).otherwise(F.greatest(overlap, sequence_ratio(a, b)))
    )


def text_similarity(a: Column, b: Column) -> Column:
    """1 if equal, 0.9 if one holds the other, else the larger of character ratio and Jaccard; normalised texts."""
    words = lambda c: F.array_distinct(F.split(c, " "))
    return (
        F.when((a == "") | (b == "") | a.isNull() | b.isNull(), 0.0)
        .when(a == b, 1.0)
        .when(a.contains(b) | b.contains(a), 0.9)
        .otherwise(F.greatest(sequence_ratio(a, b), text.jaccard(words(a), words(b))))
    )


def longest_word(c: Column) -> Column:
    """The longest word of a normalised text, of equal ones the first in the alphabet; empty if none."""
    words = F.filter(F.array_distinct(F.split(c, " ")), lambda w: w != "")
    best = F.array_min(F.transform(words, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    return F.coalesce(best["w"], F.lit(""))
