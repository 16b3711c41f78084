"""Benchmark decontamination by template canonicalisation, with Spark expressions only.

Numbers, names and units become typed placeholders that keep their value as a slot. Windows of five
canonical tokens are hash-joined with those of the benchmark; an item is found in a document when at
least ``min_containment`` of its distinct windows occur there and, along a well aligned diagonal,
every slot value of the item stands for one value in the document. Capitals tell names, so each window
has a second form that takes names as words in lower case: a copy in other letter case is found by it.
A window with fewer than two words is no template, since any row of numbers would fill it: it keeps its values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.util import materialize, small

#: Unit words that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb lbs oz ml cl l s sec secs second seconds min mins minute minutes h hr hrs hour hours "
    "day days week weeks month months year years meter meters metre metres kilometer kilometers mile miles gram grams "
    "kilogram kilograms pound pounds litre litres liter liters dollar dollars euro euros cent cents usd eur percent degrees"
)

_NAME, _NUMBER, _UNIT = "\u0001", "\u0002", "\u0003"
_WORD = r"[\p{L}\p{N}\p{M}]"
_NUM = r"\d+(?:[.,:/]\d+)*"


def _marked(text: Column) -> Column:
    """The text in lower case with type marks before names, numbers and units."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "[\u0001-\u0003]", " ")
    # A capital within a sentence opens a name; the first word of a sentence doesn't tell. What is rare is looked for
    # first, before what stands to its left.
    t = F.regexp_replace(t, r"(?=\p{Lu})(?<=[^.!?\s]\s{1,2})\p{Lu}" + _WORD + "*", _NAME + "$0")
    t = F.lower(t)
    units = "|".join(UNITS.split())
    numbered = F.regexp_replace(
        F.regexp_replace(t, rf"(?=\d)(?<!{_WORD})({_NUM})\s?{_NAME}?({units}|[%$€£])(?!{_WORD})", f"{_NUMBER}$1 {_UNIT}$2"),
        rf"(?=\d)(?<![\p{{L}}\p{{N}}\p{{M}}.,:/{_NUMBER}])({_NUM})(?!{_WORD})",
        f"{_NUMBER}$1",
    )
    return F.when(t.rlike(r"\d"), numbered).otherwise(t)


def _split(marked: Column) -> Column:
    return F.regexp_extract_all(marked, F.lit(f"{_NUMBER}{_NUM}|{_UNIT}[^\\s\u0001-\u0003]+|{_NAME}?{_WORD}+"), F.lit(0))


def tokens(text: Column) -> Column:
    """Canonical tokens with their values: words in lower case, or a type mark followed by the value."""
    return _split(_marked(text))


def _canonical(x: Column) -> Column:
    mark = F.left(x, F.lit(1))
    return F.when(mark <= _UNIT, mark).otherwise(x)


def _folded(x: Column) -> Column:
    return F.when(F.left(x, F.lit(1)) == _NAME, _value(x)).otherwise(_canonical(x))


def _value(x: Column) -> Column:
    return F.ltrim(x, F.lit(_NAME + _NUMBER + _UNIT))


def _forms(tokenised: DataFrame, raw: str) -> DataFrame:
    """With ``canonical`` and ``folded``: tokens whose names are placeholders, and those whose names are words."""
    return tokenised.withColumns({"canonical": F.transform(raw, _canonical), "folded": F.transform(raw, _folded)})


def _placed(n: int, raw: str) -> Column:
    """``pos, key, folded`` of all windows of ``n`` tokens: the place and the hashes of both forms."""
    both = F.arrays_zip(_windows("canonical", n, raw).alias("key"), _windows("folded", n, raw).alias("folded"))
    return F.transform(both, lambda w, i: F.struct(i.alias("pos"), w["key"].alias("key"), w["folded"].alias("folded")))


#: Words that make a window a template.
_TEMPLATE_WORDS = 2


def _windows(column: str, n: int, raw: str, wordy: Column | None = None) -> Column:
    """Hashes of all windows of ``n`` tokens, in order; a shorter text is one window, an empty one none.

    A window with too few words for a template is hashed by its tokens' values. Takes columns' names: an
    expression here would be computed again for each window. ``wordy`` tells texts that are known to have words alone.
    """
    form, literal = F.col(column), F.col(raw)
    size = F.size(form)
    part = lambda tokens, i: [F.get(tokens, i + k) for k in range(n)]
    template = lambda i: F.xxhash64(*part(form, i))
    values = lambda i: F.xxhash64(*[_value(x) for x in part(literal, i)])
    worded = lambda i: sum((F.coalesce((x > _UNIT).cast("int"), F.lit(0)) for x in part(form, i)), F.lit(0)) >= _TEMPLATE_WORDS
    at = F.sequence(F.lit(0), F.greatest(size - n, F.lit(0)))
    # Most texts have too few numbers, names and units for such a window anywhere.
    few = F.size(F.filter(form, lambda x: x <= _UNIT)) <= n - _TEMPLATE_WORDS
    rare = (size >= n) & (few if wordy is None else wordy | few)
    return F.when(size == 0, F.array().cast("array<bigint>")).when(rare, F.transform(at, template)).otherwise(
        F.transform(at, lambda i: F.when(worded(i), template(i)).otherwise(values(i)))
    )


def _searched(source: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id, window``: hashes of the windows of these lengths of all documents, in both forms."""
    marked, raw = F.col("marked"), F.col("doc_raw")
    # Most texts have words alone, which are their own canonical form, and without names both forms are the same.
    named = marked.contains(_NAME)
    split = source.select("doc_id", _marked(F.col("text")).alias("marked")).select(
        "doc_id", named.alias("named"), (named | marked.contains(_NUMBER) | marked.contains(_UNIT)).alias("typed"), _split(marked).alias("doc_raw")
    )
    forms = split.withColumns(
        {"canonical": F.when(F.col("typed"), F.transform(raw, _canonical)).otherwise(raw), "folded": F.when(F.col("named"), F.transform(raw, _folded))}
    )
    canonical, folded = ([_windows(c, k, "doc_raw", ~F.col("typed")) for k in lengths] for c in ("canonical", "folded"))
    windows = F.when(F.col("named"), F.concat(*canonical, *folded)).otherwise(F.concat(*canonical))
    return forms.select("doc_id", F.explode(F.array_distinct(windows)).alias("window"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 5, min_containment: float = 0.75, min_words: int = 4
) -> DataFrame:
    """Leaks, a row for each (doc_id, item_id): ``n_windows, n_hit, containment, n_slots, n_changed, kind``.

    A window counts once, whether its canonical or its folded form occurs in the document; one with fewer than two words
    (rows of numbers) only with its own values.
    ``kind`` is ``verbatim`` or, where slots hold other values than the item's, ``reparameterised``. Within a document
    one value stands for one value of the item, and unlike names or units stay unlike; numbers may meet.
    Null texts count as empty. An item of fewer than ``min_words`` tokens is found in a document that holds
    nothing else (inside others one word would condemn any document). Rows of one id count as one document or item; null ids can't be
    reported and are left out. Empty tables give no rows; other columns are ignored.

    Only benchmark windows and tokens are broadcast, after measuring them; more than the bound are joined by shuffle.
    """
    searched = materialize(benchmark.where(F.col("item_id").isNotNull()).select("item_id", tokens(F.col("text")).alias("raw")))
    items = searched.where(F.size("raw") >= min_words)
    b = _forms(items, "raw").select("item_id", F.explode(_placed(n, "raw")).alias("w"))
    # A window's key is its canonical form; either form finds it.
    forms = F.explode(F.array_distinct(F.array("w.key", "w.folded")))
    item_windows = materialize(b.select("item_id", F.col("w.pos").alias("item_pos"), F.col("w.key").alias("key"), forms.alias("window")))
    distinct = item_windows.select("item_id", "key", "window").distinct()
    sizes = distinct.groupBy("item_id").agg(F.count_distinct("key").alias("n_windows"))

    source = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    # An item of fewer than n tokens is one window of its own length.
    length = F.size("raw")
    shorter = sorted(row[0] for row in items.select(length).where((length > 0) & (length < n)).distinct().collect())

    found = _searched(source, [n, *shorter])
    hits = (
        found.join(small(distinct), "window").groupBy("doc_id", "item_id").agg(F.count_distinct("key").alias("n_hit"))
    )
    likely = materialize(
        hits.join(small(sizes), "item_id")
        .withColumn("containment", F.col("n_hit") / F.col("n_windows"))
        .where(F.col("containment") >= min_containment)
    )

    # Second look, at likely documents only: align windows and compare slot values.
    likely_docs = source.join(small(likely.select("doc_id").distinct()), "doc_id", "left_semi")
    again = (
        _forms(likely_docs.select("doc_id", tokens(F.col("text")).alias("doc_raw")), "doc_raw")
        .select("doc_id", "doc_raw", F.explode(F.concat(*[_placed(k, "doc_raw") for k in (n, *shorter)])).alias("w"))
        .select("doc_id", "doc_raw", F.col("w.pos").alias("doc_pos"), F.col("w.key").alias("doc_key"), F.explode(F.array_distinct(F.array("w.key", "w.folded"))).alias("window"))
    )
    part = lambda raw, at: F.slice(raw, F.col(at) + 1, n)
    # The document's values without their type, which may be told by letter case.
    values_of = F.transform(part(F.col("doc_raw"), "doc_pos"), _value)
    pairs = F.filter(
        F.arrays_zip(values_of.alias("d"), part(F.col("raw"), "item_pos").alias("i")),
        lambda p: F.left(p["i"], F.lit(1)) <= _UNIT,
    )
    aligned = again.join(small(item_windows), "window").join(small(items), "item_id").select(
        "doc_id", "item_id", (F.col("doc_pos") - F.col("item_pos")).alias("diagonal"), "item_pos", pairs.alias("slots"),
        F.when(F.col("doc_key") == F.col("key"), F.col("key")).alias("same"),
    )
    # By all windows, and by those alone whose canonical forms are equal.
    slots = lambda x: F.array_distinct(F.flatten(F.collect_set(x)))
    typed = F.col("same").isNotNull()
    per_diagonal = aligned.groupBy("doc_id", "item_id", "diagonal").agg(
        F.count_distinct("item_pos").alias("on"),
        slots("slots").alias("slots"),
        F.count_distinct(F.when(typed, F.col("item_pos"))).alias("typed_on"),
        slots(F.when(typed, F.col("slots"))).alias("typed_slots"),
        F.collect_set("same").alias("keys"),
    )

    def good(on: str, slots: str) -> Column:
        # One value in the document for each value of the item; for names and units the other way round too.
        unlike = lambda pairs, of: F.size(F.array_distinct(F.transform(pairs, of)))
        named = F.filter(slots, lambda p: F.left(p["i"], F.lit(1)) != _NUMBER)
        fits = (unlike(slots, lambda p: p["i"]) == F.size(slots)) & (unlike(named, lambda p: F.struct(F.left(p["i"], F.lit(1)), p["d"])) == F.size(named))
        return F.max(F.when(fits, F.struct(F.col(on).alias("on"), (-F.col("diagonal")).alias("first"), F.col(slots).alias("slots"))))

    best = per_diagonal.groupBy("doc_id", "item_id").agg(
        F.max("on").alias("top"),
        good("on", "slots").alias("all"),
        F.max("typed_on").alias("typed_top"),
        good("typed_on", "typed_slots").alias("typed"),
        F.size(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("typed_hit"),
    )
    # Another copy in the document, consistent or not, takes nothing from a diagonal with enough windows.
    windows = min_containment * F.col("n_windows")
    enough = lambda g, top: F.when(F.col(f"{g}.on") >= F.least(F.col(top), windows), F.col(f"{g}.slots"))
    found_inside = (
        likely.join(best, ["doc_id", "item_id"])
        .withColumn("slots", F.coalesce(F.when(F.col("typed_hit") >= windows, enough("typed", "typed_top")), enough("all", "top")))
        .where("slots IS NOT NULL")
        .select(
            "doc_id",
            "item_id",
            "n_windows",
            "n_hit",
            "containment",
            F.size("slots").alias("n_slots"),
            F.size(F.filter("slots", lambda p: p["d"] != _value(p["i"]))).alias("n_changed"),
        )
        .withColumn("kind", F.when(F.col("n_changed") > 0, "reparameterised").otherwise("verbatim"))
    )

    # Items too short for windows: the document's tokens are theirs, value by value.
    count = lambda raw: F.size(F.filter(raw, lambda x: F.left(x, F.lit(1)) <= _UNIT))
    said = lambda raw: F.transform(raw, _value)
    brief = searched.where((length > 0) & (length < min_words)).select("item_id", said("raw").alias("words"), count("raw").alias("n_slots"))
    if brief.isEmpty():
        return found_inside
    longest = brief.agg(F.max(F.length(F.array_join("words", " ")))).first()[0]
    # A text of that many tokens isn't longer than they are but for what stands between them.
    wordy = F.length(F.regexp_replace("text", r"[^\p{L}\p{N}\p{M}]+", " ")) <= longest + 2
    whole = source.where(wordy).select("doc_id", said(tokens(F.col("text"))).alias("words")).distinct()
    return found_inside.unionByName(
        whole.join(small(brief), "words").select(
            "doc_id", "item_id", F.lit(1).cast("long").alias("n_windows"), F.lit(1).cast("long").alias("n_hit"), F.lit(1.0).alias("containment"),
            "n_slots", F.lit(0).alias("n_changed"), F.lit("verbatim").alias("kind"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null id stay."""
    leaks = materialize(contamination(docs, benchmark, **options).select("doc_id").distinct())
    return docs.join(small(leaks), "doc_id", "left_anti").select(*docs.columns)
