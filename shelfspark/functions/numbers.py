"""Tolerant numbers, prices and discounts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def round2(c: Column) -> Column:
    """Two decimals as the exact binary value rounds, half to even.

    The product by 100 is rounded itself; where it lands on a half, its error (Dekker's product) tells
    on which side the exact value lies.
    """

    def rounded(x: Column) -> Column:
        scaled, down = x * 100, F.floor(x * 100).cast("double")
        high = x * 134217729.0 - (x * 134217729.0 - x)
        error = (high * 100 - scaled) + (x - high) * 100
        half = (scaled - down) == 0.5
        whole = F.when(half & (error > 0), down + 1).when(half & (error < 0), down).otherwise(F.rint(scaled))
        return whole / 100

    return let(c.cast("double"), rounded)


def tolerant(c: Column) -> Column:
    """A number from any scalar; null for the empty string and what doesn't parse."""
    return F.trim(c.cast("string")).try_cast("double")


def safe_float(c: Column) -> Column:
    return round2(tolerant(c))


def positive(c: Column) -> Column:
    """The number if it is finite and above 0."""
    x = tolerant(c)
    return F.when((x > 0) & (x < float("inf")) & ~F.isnan(x), x)


def truthy(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


def close(a: Column, b: Column, tolerance: float = 0.02) -> Column:
    return F.abs(a - b) / F.greatest(a, b) <= tolerance


def price_ratio_ok(a: Column, b: Column, most: float = 1.55) -> Column:
    """True unless both prices are positive and differ by more than the ratio."""
    both = F.coalesce((a > 0) & (b > 0), F.lit(False))
    return F.when(both, F.greatest(a, b) / F.least(a, b) <= most).otherwise(True)


def packages_match(pack_a: Column, total_a: Column, unit_a: Column, pack_b: Column, total_b: Column, unit_b: Column) -> Column:
    """Equal packs (none or 0 is 1) and, where both sizes are known, equal units and sizes within 5 %."""
    pack = lambda c: F.coalesce(F.nullif(c, F.lit(0)), F.lit(1))
    sized = truthy(total_a) & truthy(total_b)
    return (pack(pack_a) == pack(pack_b)) & F.when(
        sized, unit_a.eqNullSafe(unit_b) & (F.abs(total_a - total_b) / F.greatest(total_a, total_b) <= 0.05)
    ).otherwise(True)


def listed_price(listed: Column, off: Column) -> Column:
    """(price, original_price, discount_amount, discount_percentage) of a listed price above 0 less a discount."""
    full, cut = F.coalesce(tolerant(listed), F.lit(0.0)), F.coalesce(tolerant(off), F.lit(0.0))
    sold, less = full > 0, (full > 0) & (cut > 0)
    return F.struct(
        F.when(sold, round2(full - cut)).alias("price"),
        F.when(less, round2(full)).alias("original_price"),
        F.when(less, round2(cut)).alias("discount_amount"),
        F.when(less, round2(cut / full * 100)).alias("discount_percentage"),
    )


def discount(price: Column, original: Column) -> tuple[Column, Column]:
    """Amount and percentage of a discount, null where the original isn't above the price."""
    on = (original > price) & (original > 0)
    amount = round2(original - price)
    return F.when(on, amount), F.when(on, round2(amount / original * 100))


def price_metrics(prices: Column) -> Column:
    """avg, min, max and diff of an array of prices, nulls skipped; diff is 0 if the least or largest is 0 or none."""
    known = F.array_compact(prices)
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    low, high = F.array_min(known), F.array_max(known)
    return F.struct(
        round2(F.try_divide(total, F.size(known))).alias("avg_price"),
        low.alias("min_price"),
        high.alias("max_price"),
        F.when(truthy(low) & truthy(high), round2(high - low)).otherwise(0.0).alias("price_diff"),
    )


def kg_price(price: Column, total_size: Column, unit_size: Column, unit: Column, options: Column | None = None) -> Column:
    """Price of a kilogram: an offered 1 kg option, the first option, or price by size in g or kg; else the price itself."""
    size = F.coalesce(F.nullif(total_size, F.lit(0.0)), F.nullif(unit_size, F.lit(0.0)))
    name = F.lower(F.coalesce(unit, F.lit("")))
    by_size = (
        F.when((size > 0) & name.isin("g", "جم", "جرام"), round2(price * (1000.0 / size)))
        .when((size > 0) & name.isin("kg", "كجم", "كيلو"), round2(price / size))
        .otherwise(round2(price))
    )
    plain = F.when(price > 0, by_size)
    if options is None:
        return plain
    whole = F.filter(
        options,
        lambda o: (F.coalesce(o["quantity_value"] == 1.0, F.lit(False)) | F.upper(F.coalesce(o["quantity_name"], F.lit(""))).rlike(r"1(\.0)? KG"))
        & (o["price"] > 0),
    )
    first = F.get(options, F.lit(0))
    return F.coalesce(
        round2(F.get(whole, F.lit(0))["price"]),
        F.when((first["quantity_value"] > 0) & (first["price"] > 0), round2(first["price"] / first["quantity_value"])),
        plain,
    )


def best_branch_price(branches: Column, price: Column, original: Column) -> Column:
    """(price, original_price, discount_amount, discount_percentage) over a map of branches.

    The least sale price of any branch goes before the least normal price, that before the product's own;
    branches out of stock or unavailable and prices of 0 or none are left out; ties go to the first branch.
    """
    rows = F.transform(
        F.map_entries(branches),
        lambda e, i: F.struct(
            tolerant(e["value"]["price"]).alias("price"),
            i.alias("at"),
            tolerant(e["value"]["original_price"]).alias("original"),
            (F.coalesce(e["value"]["available"], F.lit(True)) & F.coalesce(e["value"]["in_stock"], F.lit(True))).alias("open"),
        ),
    )
    usable = F.filter(rows, lambda r: r["open"] & (r["price"] > 0))
    sale = F.array_min(F.filter(usable, lambda r: r["original"] > r["price"]))
    normal = F.array_min(usable)
    own, own_original = tolerant(price), tolerant(original)
    on_sale = sale.isNotNull()
    chosen = F.when(on_sale, sale["price"]).when(normal.isNotNull(), normal["price"]).otherwise(own)
    before = F.when(on_sale, sale["original"]).when(normal.isNull() & (own_original > own), own_original)
    amount = round2(round2(before) - round2(chosen))
    return F.struct(
        round2(chosen).alias("price"),
        round2(before).alias("original_price"),
        amount.alias("discount_amount"),
        round2(amount / round2(before) * 100).alias("discount_percentage"),
    )


def reference_price(*columns: Column) -> Column:
    """The first of the columns that parses once thousands commas are gone; 0 and blanks are skipped."""
    parsed = [tolerant(F.replace(c.cast("string"), F.lit(","), F.lit(""))) for c in columns]
    return round2(F.coalesce(*[F.when(F.coalesce(c.cast("string"), F.lit("")) != "", p) for c, p in zip(columns, parsed, strict=True)]))


def integer_id(c: Column) -> Column:
    """1, "1" and 1.0 as 1; texts that aren't whole numbers are null."""
    return F.when(c.cast("string").rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c.cast("string")).try_cast("bigint"))
