"""Barcode forms, check digits and evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(c: Column) -> Column:
    return F.transform(F.filter(F.split(c, ""), lambda d: d != ""), lambda d: d.cast("int"))


def _weighted(digits: Column, even: int, odd: int) -> Column:
    return F.aggregate(F.transform(digits, lambda d, i: d * F.when(i % 2 == 0, even).otherwise(odd)), F.lit(0), lambda a, x: a + x)


def check_digit(c: Column) -> Column:
    """The thirteenth digit for twelve, else empty."""
    return F.when(c.rlike(r"^\d{12}$"), F.pmod(-_weighted(_digits(c), 1, 3), F.lit(10)).cast("string")).otherwise("")


def without_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+", "")


def with_short_form(codes: Column) -> Column:
    """Codes and, where seven characters or more are left, their forms without leading zeros; sorted, distinct."""
    trimmed = F.filter(F.transform(codes, lambda c: F.trim(c)), lambda c: c != "")
    short = F.filter(F.transform(trimmed, without_zeros), lambda c: F.length(c) >= 7)
    return F.array_sort(F.array_distinct(F.concat(trimmed, short)))


def normalized(c: Column) -> Column:
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\D", "")
    short = without_zeros(digits)
    return F.when(F.length(short) >= 7, short).otherwise(digits)


def canonical(codes: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(_none(codes), normalized), lambda c: c != "")))


def _none(codes: Column) -> Column:
    return F.coalesce(codes, F.array().cast("array<string>"))


def prefixes(canonical_codes: Column, n: int = 8) -> Column:
    return F.array_distinct(F.transform(F.filter(canonical_codes, lambda c: F.length(c) >= n), lambda c: F.left(c, F.lit(n))))


def families(canonical_codes: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(canonical_codes, lambda c: F.length(c) >= 8), lambda c: F.left(c, F.length(c) - 1)))


def from_image(url: Column) -> Column:
    """Barcodes read off an image's file name: 11 to 14 digits, with padded and completed forms."""
    from shelfspark.functions.text import url_basename

    code = F.regexp_extract(url_basename(F.coalesce(url, F.lit(""))), r"(?<!\d)(\d{11,14})(?:[_\-.A-Za-z]|$)", 1)
    padded = F.concat(F.lit("0"), code)
    forms = (
        F.when(F.length(code) == 11, F.array(code, padded, F.concat(padded, check_digit(padded))))
        .when(F.length(code) == 12, F.array(code, padded, F.concat(code, check_digit(code))))
        .when(F.length(code) > 12, F.array(code))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.array_sort(F.array_distinct(forms))


def gtin_codes(codes: Column) -> Column:
    """Codes of 8, 12, 13 or 14 ASCII digits, blanks and dashes aside."""
    bare = F.transform(_none(codes), lambda c: F.regexp_replace(c, r"(?U)[\s-]", ""))
    return F.array_distinct(F.filter(bare, lambda c: c.rlike(r"^(?:[0-9]{8}|[0-9]{12,14})$")))


def is_gtin(c: Column) -> Column:
    """Length, check digit, and not all digits alike."""
    body = F.reverse(_digits(F.left(c, F.length(c) - 1)))
    total = _weighted(body, 3, 1) + F.right(c, F.lit(1)).cast("int")
    shaped = c.rlike(r"^(?:[0-9]{8}|[0-9]{12,14})$") & ~c.rlike(r"^(.)\1*$")
    return F.coalesce(F.when(shaped, total % 10 == 0).otherwise(False), F.lit(False))


def filled(valid: Column) -> Column:
    return F.array_distinct(F.transform(valid, lambda c: F.lpad(c, 14, "0")))


def evidence(codes_a: Column, valid_a: Column, codes_b: Column, valid_b: Column) -> Column:
    """4: an equal valid code; 3: equal once filled to 14; 2: equal but invalid, or 13-digit bodies equal and one valid; 0."""
    body = lambda codes: F.transform(F.filter(codes, lambda c: F.length(c) == 13), lambda c: F.left(c, F.lit(12)))
    half = F.arrays_overlap(body(valid_a), body(codes_b)) | F.arrays_overlap(body(codes_a), body(valid_b))
    return (
        F.when(F.arrays_overlap(valid_a, valid_b), 4)
        .when(F.arrays_overlap(filled(valid_a), filled(valid_b)), 3)
        .when(F.arrays_overlap(codes_a, codes_b) | half, 2)
        .otherwise(0)
    )
