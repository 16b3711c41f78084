"""Pack and size parsing: ordered rungs, the first that fits decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions import tables
from shelfspark.functions.numbers import let, round2, safe_float, tolerant
from shelfspark.functions.text import western_digits

_NUM = r"(\d+(?:\.\d+)?)"
_TIMES = r"\s*[\*xX×]\s*"


def _result(pack: Column, unit_size: Column, total: Column, unit: Column) -> Column:
    return F.struct(
        pack.cast("int").alias("pack_qty"), unit_size.alias("unit_size_value"), total.alias("total_size_value"), unit.alias("size_unit")
    )


EMPTY = lambda: _result(F.lit(1), F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("string"))


class Rung:
    """A pattern and how its groups make a size."""

    def __init__(self, text: Column, pattern: str):
        self.text, self.pattern = text, f"(?iU){pattern}"
        self.fits = text.rlike(self.pattern)

    def group(self, n: int) -> Column:
        return F.regexp_extract(self.text, self.pattern, n)

    def number(self, n: int) -> Column:
        return F.nullif(self.group(n), F.lit("")).try_cast("double")


def _standard(unit: Column, units: dict[str, tuple[str, float]]) -> tuple[Column, Column]:
    """Unit and factor; an unknown unit stays as it is."""
    names = F.create_map(*[F.lit(x) for u, (s, _) in units.items() for x in (u, s)])
    factors = F.create_map(*[F.lit(x) for u, (_, f) in units.items() for x in (u, float(f))])
    return F.coalesce(F.try_element_at(names, unit), unit), F.coalesce(F.try_element_at(factors, unit), F.lit(1.0))


def _sized(pack: Column, value: Column, unit: Column, units: dict) -> Column:
    name, factor = _standard(F.lower(unit), units)
    each = round2(value * factor)
    return _result(pack, each, round2(each * pack), name)


def _counted(n: Column, unit: str) -> Column:
    return _result(F.lit(1), n, n, F.lit(unit))


def _one(value: Column, unit: str) -> Column:
    return _result(F.lit(1), round2(value), round2(value), F.lit(unit))


def _first(*rungs: tuple[Column, Column]) -> Column:
    return F.coalesce(*[F.when(fits, made) for fits, made in rungs], EMPTY())


def _shared(t: Column, words: str, units: dict, single_end: str, extra_count: str) -> list[tuple[Column, Column]]:
    """Promotion sum, multipack, reversed multipack, single size with a quantity, count alone."""
    plus = Rung(t, rf"(\d+)\s*\+\s*(\d+)\s*(?:{tables.PLUS_WORDS})")
    multi = Rung(t, rf"(\d+){_TIMES}{_NUM}\s*({words})")
    back = Rung(t, rf"{_NUM}\s*({words}){_TIMES}(\d+)")
    single = Rung(t, rf"{_NUM}\s*({words}){single_end}")
    quantity = Rung(t, rf"(\d+)\s*(?:{tables.QUANTITY_WORDS})\b")
    count = Rung(t, rf"(\d+)\s*(?:counts?|{extra_count}{tables.COUNT_WORDS})\b")
    return [
        (plus.fits, _counted(plus.number(1) + plus.number(2), "slices")),
        (multi.fits, _sized(multi.number(1), multi.number(2), multi.group(3), units)),
        (back.fits, _sized(back.number(3), back.number(1), back.group(2), units)),
        (single.fits, _sized(F.coalesce(quantity.number(1), F.lit(1.0)), single.number(1), single.group(2), units)),
        (count.fits, _counted(count.number(1), "pcs")),
    ]


def tamimi_size(text: Column) -> Column:
    t = western_digits(F.coalesce(text, F.lit("")))
    # 100 kg or more on a shelf is a slip for grams.
    t = F.regexp_replace(t, r"(?iU)(?<![\d.])(0*[1-9]\d{2,}(?:\.\d+)?)\s*(?:kg|kilogram|kilo)\b", "$1 G")
    return let(t, _tamimi_size)


def _tamimi_size(t: Column) -> Column:
    words, units = f"(?:{tables.TAMIMI_UNIT_WORDS})", tables.TAMIMI_UNITS
    span = rf"{_NUM}\s*-\s*{_NUM}\s*({words})"
    multi_range, range_ = Rung(t, rf"(\d+){_TIMES}{span}"), Rung(t, span)
    weighed = Rung(t, rf"(\d+)\s*(?:{tables.COUNTED_WORDS})\s*[-–]?\s*{_NUM}\s*({tables.TOTAL_UNIT_WORDS})")
    name, factor = _standard(F.lower(weighed.group(3)), units)
    total = round2(weighed.number(2) * factor)
    kilo, ounce = Rung(t, rf"{_NUM}\s*K\b"), Rung(t, rf"{_NUM}\s*(?:OZ|Z)\b")
    return _first(
        (multi_range.fits, _sized(multi_range.number(1), multi_range.number(3), multi_range.group(4), units)),
        (range_.fits, _sized(F.lit(1.0), range_.number(2), range_.group(3), units)),
        (weighed.fits, _result(weighed.number(1), round2(F.try_divide(total, weighed.number(1))), total, name)),
        (kilo.fits, _one(kilo.number(1) * 1000.0, "g")),
        (ounce.fits, _one(ounce.number(1) * 28.3495, "g")),
        *_shared(t, words, units, r"\b", ""),
    )


def bindawood_size(text: Column, category: Column) -> Column:
    return let(western_digits(F.coalesce(text, F.lit(""))), lambda t: _bindawood_size(t, category))


def _bindawood_size(t: Column, category: Column) -> Column:
    fluid, ounce = Rung(t, rf"{_NUM}\s*fl\.?\s*oz\b"), Rung(t, rf"{_NUM}\s*(?:oz|ounce|ounces)\b")
    liquid = F.coalesce(category == "beverages", F.lit(False))
    return _first(
        (fluid.fits, _one(fluid.number(1) * 29.5735, "ml")),
        (ounce.fits & liquid, _one(ounce.number(1) * 29.5735, "ml")),
        (ounce.fits, _one(ounce.number(1) * 28.3495, "g")),
        *_shared(t, f"(?:{tables.BINDAWOOD_UNIT_WORDS})", tables.BINDAWOOD_UNITS, "", "eggs?|"),
    )


def kilo_option(weighted: Column, options: Column) -> Column:
    """The explicit 1 kg option of a weighed product, else null."""
    ones = F.filter(
        options,
        lambda o: (safe_float(o["quantity_value"]) == 1.0) & F.lower(F.trim(o["quantity_name"])).rlike(r"(?U)\b1(?:\.0+)?\s*kg\b"),
    )
    return F.when(F.coalesce(weighted, F.lit(False)), F.get(ones, F.lit(0)))


def panda_size(name: Column, size: Column, unit: Column, kilo: Column) -> Column:
    return let(F.replace(F.lower(name), F.lit("×"), F.lit("x")), lambda t: _panda_size(t, size, unit, kilo))


def _panda_size(t: Column, size: Column, unit: Column, kilo: Column) -> Column:
    words, units = tables.PANDA_UNIT_WORDS, tables.PANDA_UNITS
    multi, single = Rung(t, rf"(\d+)\s*x\s*{_NUM}\s*({words})\b"), Rung(t, rf"{_NUM}\s*({words})\b")
    own = F.lower(F.trim(unit))
    return _first(
        (kilo.isNotNull(), _one(F.lit(1000.0), "g")),
        (multi.fits, _sized(multi.number(1), multi.number(2), multi.group(3), units)),
        (safe_float(size).isNotNull() & (F.coalesce(own, F.lit("")) != ""), _sized(F.lit(1.0), safe_float(size), own, units)),
        (single.fits, _sized(F.lit(1.0), single.number(1), single.group(2), units)),
    )


_MEASURE = rf"{_NUM}\s*({tables.DAIRY_UNIT_WORDS})"


def dairy_package(text: Column, unit: Column, total: Column, each: Column, pack: Column, is_eggs: Column) -> Column:
    """(unit, total, pack, each, count, issues, explicit_pack) reconciled from a normalised name and silver's fields.

    A multipack in the name overrides silver, else the last measure does; counts decide pieces and eggs.
    """
    from shelfspark.functions.numbers import close, positive

    name, factor = _standard(F.lower(F.trim(unit)), tables.DAIRY_UNITS)
    known = F.lower(F.trim(unit)).isin(*tables.DAIRY_UNITS)
    unit0, factor = F.when(known, name), F.when(known, factor).otherwise(1.0)
    each0, pack0, total0 = positive(each), positive(pack), positive(total)
    total1 = F.coalesce(total0 * factor, each0 * factor * F.coalesce(pack0, F.lit(1.0)))
    each1 = each0 * factor
    multi = Rung(text, rf"(\d+)(?:\s*\+\s*(\d+)\s*(?:free)?)?\s*[x*]\s*{_MEASURE}")
    last = lambda n: F.try_element_at(F.regexp_extract_all(text, F.lit(f"(?U){_MEASURE}"), F.lit(n)), F.lit(-1))
    has_measure = text.rlike(f"(?U){_MEASURE}")
    multi_unit, multi_factor = _standard(multi.group(4), tables.DAIRY_UNITS)
    multi_pack = multi.number(1) + F.coalesce(multi.number(2), F.lit(0.0))
    multi_each = multi.number(3) * multi_factor
    one_unit, one_factor = _standard(last(2), tables.DAIRY_UNITS)
    one_each = last(1).try_cast("double") * one_factor
    one_pack = F.when(unit0.eqNullSafe(F.lit("pcs")), F.lit(1.0)).otherwise(pack0)
    unit2 = F.when(multi.fits, multi_unit).when(has_measure, one_unit).otherwise(unit0)
    pack2 = F.when(multi.fits, multi_pack).when(has_measure, one_pack).otherwise(pack0)
    each2 = F.when(multi.fits, multi_each).when(has_measure, one_each).otherwise(each1)
    total2 = (
        F.when(multi.fits, multi_pack * multi_each).when(has_measure, one_each * F.coalesce(one_pack, F.lit(1.0))).otherwise(total1)
    )
    named = multi.fits | has_measure
    disagrees = named & (total1 > 0) & (~unit0.eqNullSafe(unit2) | ~close(total1, total2))
    counts = F.regexp_extract_all(
        text, F.lit(r"(?U)(\d+)\s*(?:eggs?|count|pcs|portions?|slices?|triangles?|بيضه|بيض|قطع|شرائح|مثلث)(?![a-z])"), F.lit(1)
    )
    short = Rung(text, r"\b(\d+)s\b")
    count0 = F.coalesce(
        F.try_element_at(counts, F.lit(-1)).try_cast("double"), F.when(text.rlike("cheese|جبن"), short.number(1))
    )
    by_count = F.coalesce((count0 != 0) & (unit2.eqNullSafe(F.lit("pcs")) | is_eggs), F.lit(False))
    miscount = by_count & (total2 > 0) & ~close(total2, count0)
    unit3 = F.when(by_count, "pcs").otherwise(unit2)
    total3 = F.when(by_count, count0).otherwise(total2)
    return F.struct(
        unit3.alias("unit"),
        total3.alias("total"),
        F.when(by_count, 1.0).otherwise(pack2).alias("pack"),
        F.when(by_count, count0).otherwise(each2).alias("each"),
        F.when(unit3.eqNullSafe(F.lit("pcs")), F.coalesce(count0, total3)).otherwise(count0).alias("count"),
        F.array_compact(
            F.array(
                F.when(F.coalesce(disagrees, F.lit(False)), F.lit("silver_name_package_disagreement")),
                F.when(F.coalesce(miscount, F.lit(False)), F.lit("silver_name_count_disagreement")),
            )
        ).alias("issues"),
        multi.fits.alias("explicit_pack"),
    )


def weighted_options(weighted: Column, options: Column) -> Column:
    """A weighed product's options with any value, quantities and prices as numbers."""
    clean = F.transform(
        F.coalesce(options, F.array().cast("array<struct<quantity_value:string,quantity_name:string,price:string,undiscounted_price:string>>")),
        lambda o: F.struct(
            safe_float(o["quantity_value"]).alias("quantity_value"),
            F.nullif(F.trim(o["quantity_name"]), F.lit("")).alias("quantity_name"),
            safe_float(o["price"]).alias("price"),
            safe_float(o["undiscounted_price"]).alias("original_price"),
        ),
    )
    kept = F.filter(clean, lambda o: o["quantity_value"].isNotNull() | o["quantity_name"].isNotNull() | o["price"].isNotNull())
    return F.when(F.coalesce(weighted, F.lit(False)), kept).otherwise(F.filter(kept, lambda o: F.lit(False)))


__all__ = ["bindawood_size", "dairy_package", "kilo_option", "panda_size", "tamimi_size", "tolerant", "weighted_options"]
