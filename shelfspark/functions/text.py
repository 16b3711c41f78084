"""Text normalisation, tokens and rule tables as column expressions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfspark.functions import tables
from shelfspark.functions.numbers import let


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def or_none(c: Column) -> Column:
    """Null for the empty string: what a falsy text falls through as."""
    return F.nullif(c, F.lit(""))


def full_text(*names: Column) -> Column:
    return F.concat_ws(" ", *[text_or_empty(n) for n in names])


def squeeze(c: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", "")


def western_digits(c: Column) -> Column:
    """Arabic digits in ASCII, and a comma between digits as a decimal point."""
    return F.regexp_replace(F.translate(c, *tables.ARABIC_DIGITS), r"(?U)(\d+)[,،](\d+)", "$1.$2")


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no builtin for it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def compatible(c: Column) -> Column:
    """``nfkc`` where it can matter: ASCII and plain Arabic letters pass through in the JVM."""
    return F.when(c.rlike(r"[^\x00-\x7F،-ٴٹ-ۓ]"), nfkc(c)).otherwise(c)


#: Escapes of page scripts and what they stand for, after html entities.
_SCRIPT_ESCAPES = (('\\"', '"'), ("\\u0026", "&"), ("\\u003c", "<"), ("\\u003e", ">"), ("\\u0027", "'"))


def decode_page(c: Column) -> Column:
    """Html entities, then escaped quotes and the script escapes of ``& < > '``."""
    out = html_unescape(c)
    for escaped, plain in _SCRIPT_ESCAPES:
        out = F.replace(out, F.lit(escaped), F.lit(plain))
    return out


def decoded_page(page: str) -> str:
    """``decode_page`` of one text."""
    out = html.unescape(page)
    for escaped, plain in _SCRIPT_ESCAPES:
        out = out.replace(escaped, plain)
    return out


def dairy_text(c: Column) -> Column:
    lower = F.lower(compatible(text_or_empty(c)))
    folded = F.translate(lower, "٠١٢٣٤٥٦٧٨٩أإآى", "0123456789اااي")
    plain = F.regexp_replace(folded, "[ً-ٟـ]", "")
    return F.translate(plain, "×–ة", "x-ه")


def produce_text(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.lower(text_or_empty(c)), r"(?U)[^\w\s]", " "))


def reference_text(c: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.trim(text_or_empty(c))), "[ً-ٰٟ]", "")
    folded = F.translate(bare, "أإآٱىةؤئ", "اااايهوي")
    return squeeze(F.regexp_replace(compatible(folded), r"(?U)[^\w\s]", " "))


def _lookup(words: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])


def mapped(c: Column, words: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(_lookup(words), c), c)


def beverage_brand(c: Column) -> Column:
    return F.when(text_or_empty(c) == "", "unbranded").otherwise(F.regexp_replace(F.lower(c), "[^a-zA-Z0-9ء-ي]", ""))


def dairy_brand(c: Column) -> Column:
    key = F.regexp_replace(dairy_text(c), "[^a-z0-9ء-ي]", "")
    return F.coalesce(or_none(mapped(key, tables.BRAND_ALIASES)), F.lit("unbranded"))


def first_word(c: Column) -> Column:
    return F.get(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""), F.lit(0))


def core_tokens(c: Column) -> Column:
    """Distinct words of three letters or more, synonyms joined, fluff left out afterwards."""
    words = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(r"(?U)\b[a-zA-Zء-ي]{3,}\b"), F.lit(0))
    joined = F.transform(words, lambda w: mapped(w, tables.BEVERAGE_SYNONYMS))
    return F.array_sort(F.array_except(F.array_distinct(joined), _array(tables.FLUFF_WORDS)))


def measures_removed(c: Column) -> Column:
    measure = rf"(\d+(?:\.\d+)?)\s*({tables.DAIRY_UNIT_WORDS})"
    out = F.regexp_replace(c, rf"(?U)(\d+)(?:\s*\+\s*(\d+)\s*(?:free)?)?\s*[x*]\s*{measure}", " ")
    return F.regexp_replace(out, f"(?U){measure}", " ")


def dairy_tokens(name: Column, brand: Column) -> Column:
    words = F.regexp_extract_all(measures_removed(dairy_text(name)), F.lit("[a-zء-ي]{2,}"), F.lit(0))
    own = F.regexp_extract_all(dairy_text(brand), F.lit("[a-zء-ي]+"), F.lit(0))
    kept = F.array_except(F.array_except(words, _array(tables.DAIRY_STOP)), own)
    return F.array_sort(F.array_distinct(F.transform(kept, lambda w: mapped(w, tables.TOKEN_ALIASES))))


def reference_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(reference_text(c), " "), lambda w: w != ""))


def _array(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def overlap_coefficient(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def dice(a: Column, b: Column) -> Column:
    both = F.size(a) + F.size(b)
    return F.when(both > 0, 2 * F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def first_rule(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The value of the first rule whose pattern is found, else null."""
    out = None
    for value, pattern in rules:
        hit = c.rlike(f"(?U){pattern}")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def all_rules(c: Column, rules: dict[str, str]) -> Column:
    """The sorted values of all rules whose pattern is found."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c.rlike(f"(?U){p}"), F.lit(v)) for v, p in rules.items()])))


def has_any(c: Column, words: Iterable[str]) -> Column:
    """Whether any word is a substring; words aren't bounded."""
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def _roots(words: dict[str, str]) -> list[tuple[str, str]]:
    """Keywords of one root in a row as one bounded pattern."""
    rules: list[tuple[str, list[str]]] = []
    for word, root in words.items():
        if not rules or rules[-1][0] != root:
            rules.append((root, []))
        rules[-1][1].append(word)
    return [(root, rf"(?<!\w)(?:{'|'.join(ws)})(?!\w)") for root, ws in rules]


def commodity_root(c: Column) -> Column:
    rules = _roots(tables.FIRST_ROOTS) + _roots(tables.ROOTS)
    return let(produce_text(c), lambda clean: first_rule(clean, rules))


def url_basename(c: Column) -> Column:
    return F.substring_index(F.substring_index(c, "?", 1), "/", -1)


def _bits() -> dict[str, int]:
    words = [w for group in (*tables.DISCRIMINATORS, tables.FLAVOURS, ("diet_var",)) for w in group]
    return {w: 1 << i for i, w in enumerate(dict.fromkeys(words))}


def _mask(words: Iterable[str]) -> Column:
    bits = _bits()
    return F.lit(sum(bits[w] for w in words)).cast("long")


def variants(tokens: Column) -> Column:
    """The variant words among a beverage's tokens as bits of a long."""
    bits = F.create_map(*[x for w, bit in _bits().items() for x in (F.lit(w), F.lit(bit).cast("long"))])
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda seen, w: seen.bitwiseOR(F.coalesce(F.try_element_at(bits, w), F.lit(0).cast("long"))))


def variant_keys(mask: Column) -> tuple[Column, Column]:
    """Whether a flavour is named, and whether a diet variant is: compatible beverages have both alike."""
    return mask.bitwiseAND(_mask(tables.FLAVOURS)) != 0, mask.bitwiseAND(_mask(("diet_var",))) != 0


def conflicting_variants(a: Column, b: Column) -> Column:
    """Whether two beverages' variant bits tell different variants."""
    out = F.lit(False)
    for group in tables.DISCRIMINATORS:
        x, y = a.bitwiseAND(_mask(group)), b.bitwiseAND(_mask(group))
        out = out | ((x != 0) & (y != 0) & (x != y))
    for x, y in zip(variant_keys(a), variant_keys(b), strict=True):
        out = out | (x != y)
    return out


def conflicting_tokens(a: Column, b: Column) -> Column:
    """Whether two beverages' tokens tell different variants."""
    return conflicting_variants(variants(a), variants(b))
