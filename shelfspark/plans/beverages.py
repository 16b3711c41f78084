"""Beverages: blocked pair edges, components, one product a store, and supplemental trios."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import barcode, numbers, similarity, text
from shelfspark.operators.assign import greedy_one_to_one
from shelfspark.operators.components import connected_components
from shelfspark.operators.grid import Axis, grid_join
from shelfspark.operators.triangles import by_part
from shelfspark.operators.triangles import triangles as list_triangles
from shelfspark.plans.matching import attach_members, both_sides, gold_columns, truthy_ratio
from shelfspark.schemas import STORES
from shelfspark.storage import materialize

CONFIDENCE = {
    "exact_barcode": 1.0,
    "gs1_prefix_match": 0.94,
    "near_barcode_package_match": 0.92,
    "barcode_family_package_match": 0.96,
    "barcode_connected_package_match": 0.93,
    "brand_package_token": 0.88,
}
_FEATURES = [
    "uid", "store", "price", "pack_qty", "total_size_value", "size_unit", "codes", "prefixes", "families", "tokens", "variants", "norm_brand", "ord",
]


def features(products: DataFrame) -> DataFrame:
    return (
        products.withColumn("codes", barcode.canonical(F.col("barcodes")))
        .withColumns({"prefixes": barcode.prefixes(F.col("codes")), "families": barcode.families(F.col("codes"))})
        .withColumn("tokens", text.core_tokens(text.full_text(F.col("name_en"), F.col("name_ar"))))
        .withColumns({"norm_brand": text.beverage_brand(F.col("brand")), "variants": text.variants(F.col("tokens"))})
    )


def compatible(a: str = "a", b: str = "b") -> Column:
    """No conflicting variants, prices within 1.55, equal packs, sizes within 5 %."""
    c = lambda p, n: F.col(f"{p}_{n}")
    # Cheap tests first: conjuncts are evaluated in order.
    return (
        numbers.price_ratio_ok(c(a, "price"), c(b, "price"))
        & numbers.packages_match(
            c(a, "pack_qty"), c(a, "total_size_value"), c(a, "size_unit"), c(b, "pack_qty"), c(b, "total_size_value"), c(b, "size_unit")
        )
        & ~text.conflicting_variants(c(a, "variants"), c(b, "variants"))
    )


def tier(a: str = "a", b: str = "b") -> Column:
    """How two compatible products are tied, else null."""
    c = lambda p, n: F.col(f"{p}_{n}")
    brand = (c(a, "norm_brand") == c(b, "norm_brand")) & (c(a, "norm_brand") != "unbranded")
    prefix = F.arrays_overlap(c(a, "prefixes"), c(b, "prefixes"))
    overlap = text.overlap_coefficient(c(a, "tokens"), c(b, "tokens"))
    return (
        F.when(F.arrays_overlap(c(a, "codes"), c(b, "codes")), "exact_barcode")
        .when(brand & prefix & (overlap >= 0.40), "gs1_prefix_match")
        .when(brand & prefix & F.arrays_overlap(c(a, "families"), c(b, "families")), "near_barcode_package_match")
        .when(brand & ~prefix & (overlap >= 0.60), "brand_package_token")
    )


#: Compatible products' sizes are within 5 % of the larger, their prices within a ratio.
_SIZE, _PRICE = Axis("total_size_value", 1 / 0.95), Axis("price", 1.55)


def _sides(featured: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join of two stores' products: a is never of the last store, b never of the first."""
    a, b = both_sides(featured, columns)
    return a.where(F.col("a_store") != STORES[-1]), b.where(F.col("b_store") != STORES[0])


def code_edges(featured: DataFrame) -> DataFrame:
    """``a_uid, b_uid, tier`` of compatible products of two stores with a common barcode, by an equi-join on it."""
    a, b = (side.withColumn(f"{p}_code", F.explode(f"{p}_codes")) for p, side in zip("ab", _sides(featured, _FEATURES), strict=True))
    exact = (F.col("a_ord.store") < F.col("b_ord.store")) & compatible()
    return grid_join(a, b, ["code"], [], "uid", exact).select("a_uid", "b_uid", F.lit("exact_barcode").alias("tier")).distinct()


def name_keys(side: str) -> Column:
    """What a product of side a or b shares with each whose words overlap by 0.60: a kind and the values alike.

    ``t``: two words, since an overlap of 0.60 of two words or more takes two. A name of one word meets others by it
    (``=`` if both are, ``<`` if a's is, ``>`` if b's is).
    """
    tokens, n = F.col("tokens"), F.size("tokens")
    key = lambda *parts: F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    two = F.flatten(F.transform(tokens, lambda x, i: F.transform(F.slice(tokens, i + 2, n), lambda y: key("t", x, y))))
    own, other = ("<", ">") if side == "a" else (">", "<")
    marks = F.when(n == 1, F.array(F.lit("="), F.lit(own))).otherwise(F.array(F.lit(other)))
    one = F.flatten(F.transform(tokens, lambda t: F.transform(marks, lambda m: key(m, t))))
    return F.concat(two, one)


def code_keys() -> Column:
    """What a product shares with each that it is tied to by barcode and brand: a prefix and a word (``p``), or a family (``f``)."""
    key = lambda *parts: F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    prefixed = F.flatten(F.transform("prefixes", lambda p: F.transform("tokens", lambda t: key("p", p, t))))
    return F.concat(prefixed, F.transform("families", lambda f: key("f", f)))


def tie_keys(side: str) -> Column:
    """What a product of side a or b shares with each that it may be tied to by its brand: a kind and the values alike."""
    return F.concat(code_keys(), name_keys(side))


def _tie_key() -> Column:
    """Of the keys that a pair with a ``tier`` shares, the one under which it counts."""
    common = lambda c: F.array_sort(F.array_intersect(f"a_{c}", f"b_{c}"))
    least = lambda c, i=0: F.get(common(c), F.lit(i))
    lone = F.when(F.size("a_tokens") == F.size("b_tokens"), "=").when(F.size("a_tokens") == 1, "<").otherwise(">")
    return (
        F.when(F.col("tier") == "gs1_prefix_match", F.concat_ws(" ", F.lit("p"), least("prefixes"), least("tokens")))
        .when(F.col("tier") == "near_barcode_package_match", F.concat_ws(" ", F.lit("f"), least("families")))
        .when(F.least(F.size("a_tokens"), F.size("b_tokens")) == 1, F.concat_ws(" ", lone, least("tokens")))
        .otherwise(F.concat_ws(" ", F.lit("t"), least("tokens"), least("tokens", 1)))
    )


#: What products tied by their brand have alike, the last being one of their keys.
_ALIKE = ["norm_brand", "pack", "flavoured", "diet", "tie"]


def _keyed_sides(rows: DataFrame, columns: list[str], keys: Callable[[str], Column]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join of branded rows: a row for each of its ``keys``, with what else must be alike."""
    flavoured, diet = text.variant_keys(F.col("variants"))
    keyed = rows.where("norm_brand <> 'unbranded'").select(
        *columns, F.coalesce(F.nullif(F.col("pack_qty"), F.lit(0)), F.lit(1)).alias("pack"), flavoured.alias("flavoured"), diet.alias("diet"),
        keys("a").alias("a_keys"), keys("b").alias("b_keys"),
    )
    sides = _sides(keyed, [*columns, *_ALIKE[1:-1], "a_keys", "b_keys"])
    a, b = (side.withColumn(f"{p}_tie", F.explode(f"{p}_{p}_keys")).drop(f"{p}_a_keys", f"{p}_b_keys") for p, side in zip("ab", sides, strict=True))
    return a, b


def brand_edges(featured: DataFrame) -> DataFrame:
    """``a_uid, b_uid, tier`` of compatible products of two stores with one brand and no common barcode.

    What tied products must have alike is the join's key: brand, pack, whether a flavour and a diet variant are named, and
    what ties them (``tie_keys``), so that a brand's products meet only those they are likely tied to. Size and price are the
    axes of a grid, of which a product without the one still has the other.
    """
    a, b = _keyed_sides(featured, _FEATURES, tie_keys)
    apart = ~F.coalesce(F.arrays_overlap("a_codes", "b_codes"), F.lit(False))
    exact = (F.col("a_ord.store") < F.col("b_ord.store")) & compatible() & apart
    tied = grid_join(a, b, _ALIKE, [_SIZE, _PRICE], "uid", exact).withColumn("tier", tier()).where("tier IS NOT NULL")
    return tied.where(F.col("a_tie") == _tie_key()).select("a_uid", "b_uid", "tier")


def pair_edges(featured: DataFrame) -> DataFrame:
    """``a_uid, b_uid, tier`` of tied products of two stores, a before b in store order.

    Every tie shares a barcode or a brand, so pairs come from equi-joins, never from all pairs. A pair
    with a common barcode is taken from the barcode join alone.
    """
    return code_edges(featured).unionByName(brand_edges(featured))


#: What tells whether a product is tied to another by brand and words, but its price.
_ALIKE_CELL = ("store", "norm_brand", "pack_qty", "total_size_value", "size_unit", "variants", "tokens")
#: Two prices of one band of the logarithm, or of two neighbours, are within the ratio of 1.55.
_BAND = math.log(1.55) / 2 * 0.999999


def price_cells(featured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Branded products as ``uid, price, cell``, and their cells: products of a store that differ in name, package and variants in
    nothing and whose prices lie in one ``band``.

    ``anyhow`` are cells of products without a price, which go with any price; a price that isn't finite has no band. ``low`` and
    ``high`` are the least and the largest price, ``low_uid`` and ``high_uid`` their products, ``uid`` any.
    """
    price = F.col("price")
    known = F.coalesce(price > 0, F.lit(False))
    banded = featured.where("norm_brand <> 'unbranded'").select(
        "uid", "price", *_ALIKE_CELL, F.col("ord.store").alias("place"), (~known).alias("anyhow"), F.when(known & (price < float("inf")), F.floor(F.log(price) / _BAND)).alias("band")
    )
    own = [*_ALIKE_CELL, "place", "anyhow", "band"]
    members = materialize(banded.withColumn("cell", F.sha2(F.to_json(F.struct(*own)), 256)))
    at = F.when(F.col("band").isNotNull(), F.struct("price", "uid"))
    cells = members.groupBy("cell", *own).agg(F.min("uid").alias("uid"), F.min(at).alias("least"), F.max(at).alias("most"))
    cells = cells.select(
        "cell", "uid", *own, F.col("least.price").alias("low"), F.col("least.uid").alias("low_uid"), F.col("most.price").alias("high"), F.col("most.uid").alias("high_uid")
    )
    return members.select("uid", "price", "cell"), materialize(cells)


def name_links(featured: DataFrame) -> DataFrame:
    """``a_uid, b_uid``: links that connect the same products as all pairs of one brand whose words overlap by 0.60, and fewer.

    What but the price decides such a pair is alike throughout a cell. If all prices of two cells go together, all their products
    are connected: each is linked to one of its cell, and those two to each other. Of two cells further apart, the products that reach
    the nearest price of the other are linked to it.
    """
    members, cells = price_cells(featured)
    c = lambda p, n: F.col(f"{p}_{n}")
    a, b = _keyed_sides(cells, cells.columns, name_keys)
    all_near = c("a", "anyhow") | c("b", "anyhow") | F.coalesce(F.abs(c("a", "band") - c("b", "band")) <= 1, F.lit(False))
    some_near = F.coalesce(numbers.price_ratio_ok(F.greatest("a_low", "b_low"), F.least("a_high", "b_high")), F.lit(False)) & c("a", "band").isNotNull() & c("b", "band").isNotNull()
    packed = numbers.packages_match(*[c(p, n) for p in "ab" for n in ("pack_qty", "total_size_value", "size_unit")])
    exact = (c("a", "place") < c("b", "place")) & (all_near | some_near) & packed & ~text.conflicting_variants(c("a", "variants"), c("b", "variants"))
    exact = exact & (text.overlap_coefficient(c("a", "tokens"), c("b", "tokens")) >= 0.60)
    met = grid_join(a, b, _ALIKE, [_SIZE, Axis("low", 1.55**1.5)], "cell", exact)
    ends = [f"{p}_{n}" for p in "ab" for n in ("cell", "uid", "low", "low_uid", "high", "high_uid")]
    pairs = materialize(met.select(*ends, all_near.alias("all_near")).distinct())
    whole, part = pairs.where("all_near"), pairs.where("NOT all_near")
    joined = whole.select(F.col("a_cell").alias("cell"), F.col("a_uid").alias("b_uid")).union(whole.select("b_cell", "b_uid")).distinct()
    out = whole.select("a_uid", "b_uid").union(members.join(joined, "cell").select(F.col("uid").alias("a_uid"), "b_uid"))
    upper = F.col("a_low") < F.col("b_low")
    end = lambda below, n: F.when(upper == below, F.col(f"a_{n}")).otherwise(F.col(f"b_{n}"))
    steps = part.select(end(True, "cell").alias("lower"), end(True, "high").alias("high"), end(True, "high_uid").alias("a_uid"), end(False, "cell").alias("higher"), end(False, "low").alias("low"), end(False, "low_uid").alias("b_uid"))
    alone = members.join(joined, "cell", "left_anti")
    up = steps.join(alone, F.col("cell") == F.col("lower")).where(numbers.price_ratio_ok(F.col("price"), F.col("low"))).select(F.col("uid").alias("a_uid"), "b_uid")
    down = steps.join(alone, F.col("cell") == F.col("higher")).where(numbers.price_ratio_ok(F.col("high"), F.col("price"))).select("a_uid", F.col("uid").alias("b_uid"))
    return out.union(steps.select("a_uid", "b_uid")).union(up).union(down)


def code_links(featured: DataFrame) -> DataFrame:
    """``a_uid, b_uid`` of compatible products of one brand that only a barcode prefix or family and fewer words tie."""
    a, b = _keyed_sides(featured, _FEATURES, lambda _: code_keys())
    few = text.overlap_coefficient(F.col("a_tokens"), F.col("b_tokens")) < 0.60
    tied = grid_join(a, b, _ALIKE, [_SIZE, _PRICE], "uid", (F.col("a_ord.store") < F.col("b_ord.store")) & compatible() & few)
    return tied.where(tier().isNotNull()).select("a_uid", "b_uid")


def links(featured: DataFrame) -> DataFrame:
    """``a_uid, b_uid`` with the components of ``pair_edges``, but in proportion to the products where many have one name and brand."""
    return code_edges(featured).select("a_uid", "b_uid").union(code_links(featured)).union(name_links(featured)).where("a_uid <> b_uid")


def triangles(edges: DataFrame, prices: DataFrame) -> DataFrame:
    """Trios (a column for each store) whose three pairs are all edges, with prices ``p0, p1, p2`` (``prices``: uid, price)."""
    trios = by_part(list_triangles(edges, "a_uid", "b_uid"), lambda n: F.substring_index(n, "_", 1), STORES)
    for i, s in enumerate(STORES):
        trios = trios.join(prices.withColumnsRenamed({"uid": s, "price": f"p{i}"}), s)
    return trios.select(*STORES, "p0", "p1", "p2")


def representatives(featured: DataFrame, components: DataFrame) -> DataFrame:
    """One product for each (component, store), with the component's canonical product.

    Canonical is the first product in store order; of several products of another store the first that
    shares a barcode with it, else the one nearest in price (no price is 0), ties in silver order.
    """
    placed = featured.join(components.withColumnRenamed("node", "uid"), "uid")
    first = placed.groupBy("component").agg(F.min_by(F.struct("codes", "price"), "ord").alias("canon"))
    tied = placed.join(first, "component")
    gap = F.abs(F.coalesce("price", F.lit(0.0)) - F.coalesce("canon.price", F.lit(0.0)))
    shares = F.coalesce(F.arrays_overlap("codes", "canon.codes"), F.lit(False))
    rank = F.row_number().over(
        Window.partitionBy("component", "store").orderBy(F.desc(shares), F.when(shares, 0.0).otherwise(gap), "ord")
    )
    return tied.withColumn("rank", rank).where("rank = 1").select("component", "store", "uid")


def _trio_valid() -> Column:
    pairs = [("bindawood", "panda"), ("bindawood", "tamimi"), ("panda", "tamimi")]
    ok = truthy_ratio(F.array(*[F.col(f"{s}_price") for s in STORES]), 1.8)
    for x, y in pairs:
        ok = ok & compatible(x, y)
    return ok


def _with_features(trios: DataFrame, featured: DataFrame) -> DataFrame:
    out = trios
    names = [c for c in _FEATURES if c not in ("uid", "store")] + [c for c in ("letters",) if c in featured.columns]
    for s in STORES:
        own = featured.where(F.col("store") == s).select(F.col("uid").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names])
        out = out.join(own, s)
    return out


def component_trios(featured: DataFrame, edges: DataFrame) -> DataFrame:
    """Valid trios of components that reach all three stores, with the ``tier`` of their pairs; a component that fails is dropped whole."""
    parts = connected_components(edges, "a_uid", "b_uid")
    reps = representatives(featured, parts)
    wide = reps.groupBy("component").pivot("store", list(STORES)).agg(F.first("uid")).dropna(subset=list(STORES))
    tiers = [tier(x, y) for x, y in (("bindawood", "panda"), ("bindawood", "tamimi"), ("panda", "tamimi"))]
    return _with_features(wide, featured).where(_trio_valid()).select(*STORES, cluster_tier(*tiers).alias("tier"))


def cluster_tier(t01: Column, t02: Column, t12: Column) -> Column:
    """Tier of a cluster from its edges: the head is the best of the canonical product's two edges; the third
    overrides it if exact or by prefix, or if near while the head is by brand alone."""
    none = lambda c: F.coalesce(c, F.lit(""))
    a, b, c = none(t01), none(t02), none(t12)
    head = F.lit("brand_package_token")
    for name in ("near_barcode_package_match", "gs1_prefix_match", "exact_barcode"):
        head = F.when((a == name) | (b == name), name).otherwise(head)
    return (
        F.when(c == "exact_barcode", c)
        .when(c == "gs1_prefix_match", c)
        .when((c == "near_barcode_package_match") & (head == "brand_package_token"), c)
        .otherwise(head)
    )


def supplemental_trios(featured: DataFrame, used: DataFrame) -> DataFrame:
    """Further trios of one brand among products not used yet, by barcode families and name similarity.

    Pairs come from equi-joins on barcode families within a brand: both rules need two pairs of members
    with a common family. Names are compared only where barcodes and packages fit.
    """
    free = featured.join(used, "uid", "left_anti").where("norm_brand <> 'unbranded'")
    free = materialize(free.withColumn("letters", similarity.letters_only(F.col("name_en"), F.col("name_ar"))))
    by_family = free.select("uid", "store", "norm_brand", F.explode("families").alias("family"))
    links = {}
    for x, y in (("bindawood", "panda"), ("bindawood", "tamimi"), ("panda", "tamimi")):
        left = by_family.where(F.col("store") == x).select(F.col("uid").alias(x), "norm_brand", "family")
        right = by_family.where(F.col("store") == y).select(F.col("uid").alias(y), "norm_brand", "family")
        links[x, y] = left.join(right, ["norm_brand", "family"]).select(x, y).distinct()
    bp, bt, pt = (links[k] for k in (("bindawood", "panda"), ("bindawood", "tamimi"), ("panda", "tamimi")))
    trios = bp.join(bt, "bindawood").select(*STORES).union(bp.join(pt, "panda").select(*STORES)).union(bt.join(pt, "tamimi").select(*STORES)).distinct()
    full = _with_features(trios, free).where(_trio_valid())
    pairs = [("bindawood", "panda"), ("bindawood", "tamimi"), ("panda", "tamimi")]
    linked = sum((F.arrays_overlap(f"{x}_families", f"{y}_families").cast("int") for x, y in pairs), F.lit(0))
    common = F.size(F.array_intersect(F.array_intersect("bindawood_families", "panda_families"), "tamimi_families")) > 0
    full = full.withColumns({"common": common, "linked": linked}).where("common OR linked >= 2")
    for i, (x, y) in enumerate(pairs):
        full = full.withColumn(f"sim{i}", similarity.full_name_similarity(F.col(f"{x}_letters"), F.col(f"{y}_letters")))
    full = full.withColumn("least", F.least("sim0", "sim1", "sim2"))
    tiers = F.when(F.col("common") & (F.col("least") >= 0.55), "barcode_family_package_match").when(
        (F.col("linked") >= 2) & (F.col("least") >= 0.70), "barcode_connected_package_match"
    )
    ranked = full.withColumn("tier", tiers).where("tier IS NOT NULL").select(
        *STORES, "tier",
        (F.col("tier") != "barcode_family_package_match").cast("int").alias("o1"), (-F.col("least")).alias("o2"),
        F.col("bindawood_ord").alias("o3"), F.col("panda_ord").alias("o4"), F.col("tamimi_ord").alias("o5"),
    )
    return greedy_one_to_one(ranked, list(STORES), ["o1", "o2", "o3", "o4", "o5"]).select(*STORES, "tier")


def match(products: DataFrame) -> DataFrame:
    """Gold rows of three-store beverage clusters (products as ``union_stores`` gives them)."""
    # Dealt out first: a table of few and small files would be read, and its features told, by few tasks.
    featured = materialize(features(products.repartition("uid")))
    first = materialize(component_trios(featured, links(featured)))
    used = first.select(F.explode(F.array(*STORES)).alias("uid")).distinct()
    clusters = first.unionByName(supplemental_trios(featured, used))
    full = attach_members(clusters, products)
    c = F.col("bindawood_product")
    confidence = F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair])
    return full.select(
        *gold_columns("beverages", c["unit_size_value"], c["size_unit"], F.coalesce(c["pack_qty"], F.lit(1)), c["total_size_value"]),
        F.col("tier").alias("match_tier"),
        F.coalesce(F.try_element_at(confidence, F.col("tier")), F.lit(0.85)).alias("confidence_score"),
    )
