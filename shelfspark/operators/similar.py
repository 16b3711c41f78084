"""Candidates of a similarity join, by their rarest tokens, and bounds of a similarity that Spark can compute."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import text
from shelfspark.storage import materialize

#: Length of the character runs by which a text is looked for inside others.
_GRAM = 3


def characters(c: Column) -> Column:
    """The characters of a text, each with how often it has come before: common ones of two texts are as many as their multisets share."""
    seen = F.regexp_extract_all(c, F.lit(r"(?s)."), F.lit(0))
    before = lambda x, i: F.size(F.filter(F.slice(seen, 1, i + 1), lambda y: y == x))
    return F.transform(seen, lambda x, i: F.concat(x, before(x, i).cast("string")))


def words(c: Column) -> Column:
    return F.array_distinct(F.split(c, " "))


def _grams(c: Column, size: int) -> Column:
    last = F.length(c) - size + 1
    return F.array_distinct(F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(c, i, F.lit(size)))).otherwise(F.array().cast("array<string>")))


def _rare_first(tokens: DataFrame, keep: Column) -> DataFrame:
    """``id, token`` for the ``keep`` rarest of each id's tokens (``id, n, token``; ties by token)."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("df"))
    ranked = tokens.join(counts, "token").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    return ranked.select("id", F.explode(F.slice("t", F.lit(1), keep)).alias("t")).select("id", F.col("t.token").alias("token"))


def candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """``left_id, right_id`` of all texts (``id, text``) that may be alike by ``threshold`` at least, and others.

    Alike are texts of which one holds the other, whose words have a Jaccard index of the threshold, or whose character
    ratio reaches it. For the last two, texts with so much in common share one of their first tokens
    in any fixed order; rare tokens first makes those few. A ratio is at most the share of common characters.
    An id may have several texts; empty and null texts are like none.
    """
    both = materialize(
        left.select(F.lit(0).alias("side"), "id", "text").unionByName(right.select(F.lit(1).alias("side"), "id", "text")).where("text <> ''").distinct()
        .withColumn("id", F.struct("side", "id", "text"))
    )

    def exploded(tokens: Column) -> DataFrame:
        found = both.select("id", tokens.alias("tokens"))
        return found.select("id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))

    least = lambda share: F.col("n") - F.ceil(F.col("n") * share - 1e-9).cast("int") + 1
    by_chars = _rare_first(exploded(characters(F.col("text"))), least(threshold / (2 - threshold)))
    by_words = _rare_first(exploded(words(F.col("text"))), least(threshold))
    # A text is looked for by its rarest run of three characters, one of fewer characters by itself.
    short = exploded(F.when(F.length("text") < _GRAM, F.array("text")).otherwise(_grams(F.col("text"), _GRAM)))
    inner = _rare_first(short, F.lit(1))
    sizes = sorted(r[0] for r in both.select(F.least(F.length("text"), F.lit(_GRAM))).distinct().collect())  # three at most
    outer = exploded(F.array_distinct(F.concat(*[_grams(F.col("text"), k) for k in sizes]))).select("id", "token") if sizes else inner

    def met(a: DataFrame, b: DataFrame, near: Column) -> DataFrame:
        x = a.where("id.side = 0").select(F.col("id").alias("x"), "token")
        y = b.where("id.side = 1").select(F.col("id").alias("y"), "token")
        return x.join(y, "token").where(near).select(F.col("x.id").alias("left_id"), F.col("y.id").alias("right_id"))

    size = lambda p: F.length(F.col(f"{p}.text"))
    fits = F.least(size("x"), size("y")) >= F.greatest(size("x"), size("y")) * (threshold / (2 - threshold)) - 1e-9
    pairs = met(by_chars, by_chars, fits).unionByName(met(by_words, by_words, F.lit(True)))
    pairs = pairs.unionByName(met(inner, outer, F.col("y.text").contains(F.col("x.text")))).unionByName(met(outer, inner, F.col("x.text").contains(F.col("y.text"))))
    return pairs.distinct()


def most_similar(a: Column, b: Column) -> Column:
    """An upper bound of ``similarity.text_similarity``, without Python."""
    x, y = characters(a), characters(b)
    ratio = 2 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))
    return (
        F.when((a == "") | (b == "") | a.isNull() | b.isNull(), 0.0)
        .when(a == b, 1.0)
        .when(a.contains(b) | b.contains(a), 0.9)
        .otherwise(F.greatest(ratio, text.jaccard(words(a), words(b))))
    )


def needed(weight: float, total: float) -> float:
    """What a measure of ``weight`` must reach, if all others are 1 at most, for a weighted sum of ``total``."""
    return math.floor(max(0.0, (total - (1 - weight)) / weight) * 1e9) / 1e9
