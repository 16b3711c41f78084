"""Dairy and eggs: attributes, packages, pair evidence, reciprocal best trios, history and quality gates."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import barcode, size, tables, text
from shelfspark.functions.numbers import close, round2
from shelfspark.operators.dedupe import top_n
from shelfspark.operators.grid import Axis, grid_join
from shelfspark.operators.merge import append_history, within_stores
from shelfspark.operators.triangles import by_part, triangles
from shelfspark.plans.matching import attach_members, both_sides, gold_columns
from shelfspark.schemas import STORES
from shelfspark.storage import materialize

_PAIRS = (("bindawood", "panda"), ("bindawood", "tamimi"), ("panda", "tamimi"))
#: Attributes compared, in order; flavour is a sorted array, ("plain") or null.
_GROUPS = list(tables.ATTRIBUTES)
ATTRIBUTES = ["brand", "family", *_GROUPS, *tables.FEATURES, "flavor", "flavored"]
DEFINING = [*tables.FEATURES, "flavor", "fat", "processing", "cheese_type", "form", "egg_size", "color", "texture", "milk_source", "cream_use", "salt"]
_NOT_SHARED = ("brand", "family", "enriched", "flavored")
#: Values of each attribute but brand and flavour, and where its number starts in the packed attributes (0: unknown).
_VALUES = {k: list(dict.fromkeys(v for v, _ in rules)) for k, rules in (("family", tables.FAMILIES), *tables.ATTRIBUTES.items())} | {
    k: [False, True] for k in (*tables.FEATURES, "flavored")
}
_PLACES = dict(zip(_VALUES, [0, *accumulate(len(v).bit_length() for v in _VALUES.values())], strict=False))
_FLAVOURS = [*tables.DAIRY_FLAVOURS, "plain"]


def _field(key: str) -> int:
    """All bits of an attribute in the packed attributes."""
    return ((1 << len(_VALUES[key]).bit_length()) - 1) << _PLACES[key]


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _packed(attrs: Column) -> list[Column]:
    """``kinds``: the number of each attribute's value; ``known``: all bits of attributes that are known; ``tastes``: a bit a flavour."""
    kinds, known = _long(0), _long(0)
    for key, values in _VALUES.items():
        number = F.create_map(*[x for i, v in enumerate(values, 1) for x in (F.lit(v), _long(i << _PLACES[key]))])
        kinds = kinds + F.coalesce(F.try_element_at(number, attrs[key]), _long(0))
        known = known + F.when(attrs[key].isNotNull(), _long(_field(key))).otherwise(_long(0))
    taste = F.create_map(*[x for i, v in enumerate(_FLAVOURS) for x in (F.lit(v), _long(1 << i))])
    tastes = F.aggregate(F.coalesce(attrs["flavor"], F.array().cast("array<string>")), _long(0), lambda s, v: s + F.element_at(taste, v))
    return [kinds.alias("kinds"), known.alias("known"), tastes.alias("tastes")]


def profiles(products: DataFrame) -> DataFrame:
    """Products with ``attrs``, ``package``, ``tokens``, ``codes`` and ``valid`` codes."""
    name = F.coalesce(text.or_none(F.col("name_en")), F.col("name_ar"))
    df = products.withColumns(
        {"words": text.dairy_text(text.full_text(F.col("name_en"), F.col("name_ar"))), "label": text.dairy_text(name), "dairy_brand": text.dairy_brand(F.col("brand"))}
    )
    # Written after each step: Spark would otherwise make one projection of all rules, too large for generated code.
    df = materialize(df).withColumn("family", text.first_rule(F.col("words"), tables.FAMILIES))
    words, family = F.col("words"), F.col("family")
    fields = [F.col("dairy_brand").alias("brand"), family.alias("family")]
    for key, rules in tables.ATTRIBUTES.items():
        found = text.first_rule(words, rules)
        only = tables.ATTRIBUTE_FAMILY.get(key)
        fields.append((F.when(family == only, found) if only else found).alias(key))
    for key, pattern in tables.FEATURES.items():
        on = F.when(words.rlike(f"(?U){pattern}"), True)
        denied = {"organic": tables.NOT_ORGANIC, "lactose_free": tables.WITH_LACTOSE}.get(key)
        fields.append((F.when(words.rlike(f"(?U){denied}"), False).otherwise(on) if denied else on).alias(key))
    flavours = text.all_rules(words, tables.DAIRY_FLAVOURS)
    some = F.size(flavours) > 0
    fields.append(F.when(some, flavours).when(words.rlike(f"(?U){tables.PLAIN}"), F.array(F.lit("plain"))).alias("flavor"))
    fields.append(F.when(some | words.rlike(f"(?U){tables.FLAVOURED}"), True).alias("flavored"))
    df = materialize(df.withColumn("attrs", F.struct(*fields)))
    return (
        df.withColumn("attrs", F.struct("attrs.*", *_packed(F.col("attrs"))))
        .withColumn(
            "package",
            size.dairy_package(
                F.col("label"), F.col("size_unit"), F.col("total_size_value"), F.col("unit_size_value"), F.col("pack_qty"),
                F.coalesce(family == "eggs", F.lit(False)),
            ),
        )
        .withColumn("tokens", text.dairy_tokens(name, F.col("brand")))
        .withColumn("codes", barcode.gtin_codes(F.col("barcodes")))
        .withColumn("valid", F.filter("codes", barcode.is_gtin))
        .drop("words", "label", "dairy_brand", "family")
    )


def semantic_conflicts(a: Column, b: Column) -> Column:
    """Names of attributes that both know and that differ; an unbranded side agrees with any brand."""
    out = []
    for key in sorted(ATTRIBUTES):
        differ = a[key].isNotNull() & b[key].isNotNull() & (a[key] != b[key])
        if key == "brand":
            differ = differ & (a[key] != "unbranded") & (b[key] != "unbranded")
        out.append(F.when(F.coalesce(differ, F.lit(False)), F.lit(key)))
    return F.array_compact(F.array(*out))


def conflicting(a: Column, b: Column) -> Column:
    """Whether ``semantic_conflicts`` would name any, by the packed attributes."""
    kinds = a["kinds"].bitwiseXOR(b["kinds"]).bitwiseAND(a["known"]).bitwiseAND(b["known"]) != 0
    tastes = (a["tastes"] != 0) & (b["tastes"] != 0) & (a["tastes"] != b["tastes"])
    return kinds | tastes | ((a["brand"] != b["brand"]) & (a["brand"] != "unbranded") & (b["brand"] != "unbranded"))


def _package_rules(a: Column, b: Column) -> dict[str, Column]:
    on = lambda c: F.coalesce(c != 0, F.lit(False))
    same_unit = a["unit"].eqNullSafe(b["unit"])
    near = on(a["total"]) & on(b["total"]) & same_unit & close(a["total"], b["total"])
    loose = lambda p: F.coalesce((p["pack"] == 1) & ~p["explicit_pack"], F.lit(False))
    rules = {
        "size_unit": a["unit"].isNotNull() & b["unit"].isNotNull() & ~same_unit,
        "total_size": on(a["total"]) & on(b["total"]) & same_unit & ~close(a["total"], b["total"]),
        "explicit_count": on(a["count"]) & on(b["count"]) & (a["count"] != b["count"]),
        "pack_qty": on(a["pack"]) & on(b["pack"]) & (a["pack"] != b["pack"]) & ~((loose(a) | loose(b)) & near),
    }
    return {k: F.coalesce(hit, F.lit(False)) for k, hit in rules.items()}


def package_conflicts(a: Column, b: Column) -> Column:
    return F.array_compact(F.array(*[F.when(hit, F.lit(k)) for k, hit in _package_rules(a, b).items()]))


def evidence(df: DataFrame) -> DataFrame:
    """``level, tier, score, confidence`` of pairs (a_*, b_*) that positively match."""
    a, b = F.col("a_attrs"), F.col("b_attrs")
    pa, pb = F.col("a_package"), F.col("b_package")
    clash = conflicting(a, b)
    for hit in _package_rules(pa, pb).values():
        clash = clash | hit
    sized = (pa["unit"] == pb["unit"]) & (pa["total"] != 0) & (pb["total"] != 0) & close(pa["total"], pb["total"])
    df = df.where(sized & ~clash)
    # No attribute that both know differs from here on, so what both know is what they share.
    both = a["known"].bitwiseAND(b["known"])
    shared = sum((F.when(both.bitwiseAND(_long(_field(k))) != 0, 1).otherwise(0) for k in _VALUES if k not in _NOT_SHARED), F.lit(0))
    shared = shared + F.when((a["tastes"] != 0) & (b["tastes"] != 0), 1).otherwise(0)
    defining = sum(_field(k) for k in DEFINING if k != "flavor")
    same_defining = (a["kinds"].bitwiseXOR(b["kinds"]).bitwiseAND(_long(defining)) == 0) & (a["tastes"] == b["tastes"])
    family = (a["brand"] != "unbranded") & (a["brand"] == b["brand"]) & (_known_family(a) & _known_family(b))
    df = df.withColumns(
        {
            "code_level": barcode.evidence(F.col("a_codes"), F.col("a_valid"), F.col("b_codes"), F.col("b_valid")),
            "common": F.size(F.array_intersect("a_tokens", "b_tokens")),
            "shared": shared,
            "family": F.coalesce(family, F.lit(False)),
            "alike": same_defining,
        }
    )
    words = F.size("a_tokens") + F.size("b_tokens")
    df = df.withColumn("similarity", F.when(words > 0, 2 * F.col("common") / words).otherwise(0.0))
    level = (
        F.when(F.col("code_level") >= 3, F.col("code_level"))
        .when(F.expr("family AND code_level = 2 AND (shared >= 1 OR similarity >= 0.65)"), 2)
        .when(F.expr("family AND similarity >= 0.80 AND shared >= 1 AND common > 0 AND alike"), 1)
    )
    names = F.when(F.col("level") == 4, "exact_barcode").when(F.col("level") == 3, "normalized_barcode").when(
        F.col("level") == 2, "barcode_body_multifactor"
    ).otherwise("dairy_brand_token")
    sure = F.when(F.col("level") == 4, 1.0).when(F.col("level") == 3, 0.98).when(F.col("level") == 2, 0.96).otherwise(
        F.rint((0.90 + 0.02 * F.col("similarity")) * 1000) / 1000
    )
    raw = 100 * F.col("level") + F.col("shared") + F.col("similarity")
    return df.withColumn("level", level).where("level IS NOT NULL").select(
        "a_uid", "b_uid", "level", names.alias("tier"), (F.rint(raw * 100000) / 100000).alias("score"), sure.alias("confidence")
    )


def _known_family(attrs: Column) -> Column:
    return attrs["known"].bitwiseAND(_long(_field("family"))) != 0


#: What tells a pair's evidence, and the measure that matching products have alike.
_PAIRED, _TOTAL = ("uid", "store", "attrs", "package", "tokens", "codes", "valid"), Axis("total", 1 / 0.98)


def _sized(profiled: DataFrame) -> DataFrame:
    """Products with a unit and a total, without which none matches."""
    return profiled.where("package.unit IS NOT NULL AND package.total > 0 AND package.total < double('inf')").select(
        *_PAIRED, F.col("attrs.brand").alias("brand"), F.col("package.unit").alias("unit"), F.col("package.total").alias("total")
    )


def pair_edges(profiled: DataFrame) -> DataFrame:
    """Edges between stores. Branded products pair by brand; a pair with an unbranded side can only pass by a valid
    barcode, so it comes from an equi-join on codes filled to 14 digits.

    A match needs equal units and close totals: the unit is part of both joins' key, and the total the axis of their grid.
    """
    sized = _sized(profiled)
    a, b = both_sides(sized, sized.columns)
    code = lambda df, p: df.withColumn(f"{p}_code", F.explode(barcode.filled(F.col(f"{p}_valid"))))
    apart, total = F.col("a_store") < F.col("b_store"), [_TOTAL]
    branded = lambda df, p: df.where(F.col(f"{p}_brand") != "unbranded")
    by_brand = evidence(grid_join(branded(a, "a"), branded(b, "b"), ["brand", "unit"], total, "uid", apart))
    loose = apart & ((F.col("a_brand") == "unbranded") | (F.col("b_brand") == "unbranded"))
    by_code = evidence(grid_join(code(a, "a"), code(b, "b"), ["code", "unit"], total, "uid", loose))
    return by_brand.unionByName(by_code.distinct())


def _store(c: Column) -> Column:
    return F.substring_index(c, "_", 1)


def _linked(edges: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """Edges of each two stores: a column for each store's end and the edge's evidence ``e_x_y``."""
    kind = edges.withColumns({"x": _store(F.col("a_uid")), "y": _store(F.col("b_uid"))})
    return {
        (x, y): kind.where((F.col("x") == x) & (F.col("y") == y)).select(
            F.col("a_uid").alias(x), F.col("b_uid").alias(y), F.struct("score", "level", "tier", "confidence").alias(f"e_{x}_{y}")
        )
        for x, y in _PAIRS
    }


def _strong_wedges(strong: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Trios of two strong edges at least."""
    bp, bt, pt = (strong[k].select(*k) for k in _PAIRS)
    return bp.join(bt, "bindawood").select(*STORES).union(bp.join(pt, "panda").select(*STORES)).union(bt.join(pt, "tamimi").select(*STORES))


def _guarded(trios: DataFrame) -> DataFrame:
    """Trios (with each store's ``_attrs`` and ``_package``) whose pairs don't conflict, and whether they are ``uniform``."""
    clean = F.lit(True)
    for x, y in _PAIRS:
        clean = clean & ~conflicting(F.col(f"{x}_attrs"), F.col(f"{y}_attrs"))
        for hit in _package_rules(F.col(f"{x}_package"), F.col(f"{y}_package")).values():
            clean = clean & ~hit
    uniform = F.col("bindawood_attrs.brand") == F.col("panda_attrs.brand")
    uniform = uniform & (F.col("panda_attrs.brand") == F.col("tamimi_attrs.brand"))
    uniform = uniform & F.col("bindawood_attrs.family").eqNullSafe(F.col("panda_attrs.family"))
    uniform = uniform & F.col("panda_attrs.family").eqNullSafe(F.col("tamimi_attrs.family"))
    return trios.where(clean).withColumn("uniform", uniform)


def _weighed(trios: DataFrame) -> DataFrame:
    """``tier, confidence, score`` of guarded trios with the evidence of their edges (null: none)."""
    df = trios.withColumn("found", F.array_compact(F.array(*[F.col(f"e_{x}_{y}") for x, y in _PAIRS])))
    strong = F.sort_array(F.filter("found", lambda e: e["level"] >= 2), asc=False)
    df = df.withColumn("strong", strong)
    df = df.withColumn(
        "relevant",
        F.when(F.size("strong") >= 2, F.when(F.col("uniform"), F.slice("strong", 1, 2))).when(F.size("found") == 3, F.col("found")),
    ).where("relevant IS NOT NULL")
    sure = F.array_min(F.transform("relevant", lambda e: e["confidence"]))
    weakest = F.array_min("relevant")
    add = lambda f: F.aggregate(F.transform("found", f), F.lit(0.0), lambda x, y: x + y)
    return df.select(
        *STORES,
        weakest["tier"].alias("tier"),
        F.when((F.size("strong") >= 2) & (F.size("found") < 3), F.least(sure, F.lit(0.95))).otherwise(sure).alias("confidence"),
        (weakest["level"] * 1000 + add(lambda e: e["level"] * 100.0) + add(lambda e: e["score"] % 100)).alias("score"),
    )


def candidate_trios(edges: DataFrame, profiled: DataFrame) -> DataFrame:
    """Trios of two edges at least that pass all guards, with ``tier, confidence, score``."""
    link = _linked(edges)
    # All three edges, or two strong ones: a hub's weak edges need not meet one another. Strong edges need a common barcode body.
    full = by_part(triangles(edges, "a_uid", "b_uid"), _store, STORES)
    wedges = full.union(_strong_wedges({k: v.where(F.col(f"e_{k[0]}_{k[1]}.level") >= 2) for k, v in link.items()})).distinct()
    for k, v in link.items():
        wedges = wedges.join(v, list(k), "left")
    for s in STORES:
        own = profiled.where(F.col("store") == s).select(F.col("uid").alias(s), F.col("attrs").alias(f"{s}_attrs"), F.col("package").alias(f"{s}_package"))
        wedges = wedges.join(own, s)
    return _weighed(_guarded(wedges))


def kinds(profiled: DataFrame) -> DataFrame:
    """Products that can match, with ``kind``: one for all products of a store whose attributes, package and tokens are equal.

    Whether two products match without a common barcode, and their score then, is told by their kinds.
    """
    alike = F.sha2(F.to_json(F.struct("attrs", "package", "tokens")), 256)
    return _sized(profiled).withColumn("kind", F.concat_ws("_", "store", alike))


def kind_edges(first: DataFrame) -> DataFrame:
    """Edges of level 1 between kinds (``first``: a product of each kind), of which each two products that share no code have the same.

    A similarity of 0.80 takes two thirds of either's tokens, so one of the first n - ceil(2n / 3) + 1 of n sorted tokens is common.
    """
    none = F.array().cast("array<string>")
    n = F.size("tokens")
    named = first.where("attrs.brand <> 'unbranded'").select(
        F.col("kind").alias("uid"), "store", "attrs", "package", "tokens", none.alias("codes"), none.alias("valid"), "brand", "unit", "total",
        F.explode(F.slice("tokens", F.lit(1), n - F.expr("(2 * size(tokens) + 2) div 3").cast("int") + 1)).alias("token"),
    )
    a, b = both_sides(materialize(named), named.columns)
    apart = F.col("a_store") < F.col("b_store")
    return evidence(grid_join(a, b, ["brand", "unit", "token"], [_TOTAL], "uid", apart)).distinct()


def code_edges(sized: DataFrame) -> DataFrame:
    """Edges of level 2 and more: products that share a code, a valid one filled to 14 digits, or a 13-digit code's body."""
    body = F.transform(F.filter("codes", lambda c: F.length(c) == 13), lambda c: F.concat(F.lit("b"), F.left(c, F.lit(12))))
    keys = F.concat(F.transform(barcode.filled(F.col("valid")), lambda c: F.concat(F.lit("f"), c)), F.transform("codes", lambda c: F.concat(F.lit("c"), c)), body)
    keyed = materialize(sized.select(*_PAIRED, "unit", "total", F.explode(F.array_distinct(keys)).alias("code")))
    a, b = both_sides(keyed, keyed.columns)
    found = materialize(evidence(grid_join(a, b, ["code", "unit"], [_TOTAL], "uid", F.col("a_store") < F.col("b_store"))))
    return found.where("level >= 2").distinct()


def leading_trios(profiled: DataFrame) -> DataFrame:
    """Of ``candidate_trios`` all of two strong edges, and of the others enough for ``reciprocal_best``: each product's two best scores.

    A pair of products has its strong edge, else that of its kinds, so trios without a strong edge score alike throughout three
    kinds, and trios of one strong edge by its level. A product that has a trio that is left out has two with other members of
    the same kinds, listed here, that score no less; the best trio of a product that leads by any margin is never left out. So a
    product is listed with two products of either other kind, a strong edge with two products of a third kind, and the two
    strongest edges between two kinds with all products of the third: a number of trios in proportion to the products.
    """
    members = materialize(kinds(profiled))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("uid"))
    firsts = materialize(members.withColumn("place", place).where("place <= 2"))
    weak = materialize(kind_edges(firsts.where("place = 1")))
    of = members.select("uid", "kind")
    strong = materialize(
        code_edges(members).join(of.withColumnsRenamed({"uid": "a_uid", "kind": "a_kind"}), "a_uid").join(of.withColumnsRenamed({"uid": "b_uid", "kind": "b_kind"}), "b_uid")
    )
    k = {s: f"{s}_kind" for s in STORES}
    own = {s: members.where(F.col("store") == s).select(F.col("uid").alias(s), F.col("kind").alias(k[s])) for s in STORES}
    two = {s: firsts.where(F.col("store") == s).select(F.col("uid").alias(s), F.col("kind").alias(k[s]), F.col("place").alias(f"{s}_place")) for s in STORES}
    link, kind_link = _linked(strong), {p: e.withColumnsRenamed(k) for p, e in _linked(weak).items()}
    tied = {
        (x, y): strong.where((_store(F.col("a_uid")) == x) & (_store(F.col("b_uid")) == y)).select(
            F.col("a_uid").alias(x), F.col("b_uid").alias(y), F.col("a_kind").alias(k[x]), F.col("b_kind").alias(k[y]), "level"
        )
        for x, y in _PAIRS
    }
    columns = [*STORES, *k.values()]
    full = materialize(by_part(triangles(weak, "a_uid", "b_uid"), _store, STORES).withColumnsRenamed(k))
    out = _strong_wedges(link)
    for s in STORES:
        out = out.join(own[s], s)
    out = out.select(*columns)
    for x, y in _PAIRS:
        (z,) = set(STORES) - {x, y}
        # Two kinds tied by a strong edge and both alike to the third need not be alike themselves.
        side = lambda s: kind_link[(z, s) if (z, s) in kind_link else (s, z)].select(k[z], k[s])  # noqa: B023, E731
        mixed = tied[x, y].select(k[x], k[y]).distinct().join(side(x), k[x]).join(side(y), [k[z], k[y]])
        trios = full.union(mixed.select(*full.columns)).distinct()
        best = top_n(tied[x, y], [k[x], k[y]], [F.desc("level"), F.col(x), F.col(y)], 2)
        for edges, third in ((tied[x, y], two[z]), (best, own[z])):
            out = out.union(edges.join(trios, [k[x], k[y]]).join(third, k[z]).select(*columns))
        few = full.join(two[x], k[x]).join(two[y], k[y]).where(F.col(f"{x}_place") + F.col(f"{y}_place") <= 3)
        out = out.union(few.join(own[z], k[z]).select(*columns))
    out = materialize(out.distinct())
    threes = out.select(*k.values()).distinct()
    for s in STORES:
        threes = threes.join(
            firsts.where("place = 1").select(F.col("kind").alias(k[s]), F.col("attrs").alias(f"{s}_attrs"), F.col("package").alias(f"{s}_package")), k[s]
        )
    threes = _guarded(threes).select(*k.values(), "uniform")
    for (x, y), e in kind_link.items():
        threes = threes.join(e.withColumnRenamed(f"e_{x}_{y}", f"w_{x}_{y}"), [k[x], k[y]], "left")
    out = out.join(materialize(threes), list(k.values()))
    for (x, y), e in link.items():
        out = out.join(e, [x, y], "left").withColumn(f"e_{x}_{y}", F.coalesce(f"e_{x}_{y}", f"w_{x}_{y}"))
    return _weighed(out)


def reciprocal_best(trios: DataFrame, margin: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Accepted trios, and products whose two best trios lie within the margin.

    A product prefers its best trio if that leads by the margin; a trio is accepted if all three members
    prefer it. Ties sort by the member ids.
    """
    options = trios.select("*", F.explode(F.array(*STORES)).alias("uid"))
    w = Window.partitionBy("uid").orderBy(F.desc("score"), *STORES)
    ranked = options.withColumns({"rank": F.row_number().over(w), "next": F.lead("score").over(w)}).where("rank = 1")
    unsure = F.coalesce(F.col("score") - F.col("next") < margin, F.lit(False))
    won = ranked.where(~unsure).groupBy(*STORES).agg(F.count("*").alias("votes")).where("votes = 3").select(*STORES)
    return trios.join(won, list(STORES)), ranked.where(unsure).select("uid", "score", "next")


def match(products: DataFrame, run_date: str, previous: DataFrame | None = None) -> DataFrame:
    """Gold rows with price history; raises while read if the quality gate fails."""
    # Dealt out first: a table of few and small files would be read, and its rules tried, by few tasks.
    profiled = materialize(profiles(products.repartition("uid")))
    accepted, _ = reciprocal_best(materialize(leading_trios(profiled)))
    full = attach_members(accepted, profiled, ("package",))
    pack = F.col("bindawood_product.package")
    gold = full.select(
        *gold_columns("dairy_and_eggs", pack["each"], pack["unit"], pack["pack"], pack["total"]),
        F.col("tier").alias("match_tier"),
        F.col("confidence").alias("confidence_score"),
    )
    return with_history(gold, run_date, previous)


def with_history(gold: DataFrame, run_date: str, previous: DataFrame | None) -> DataFrame:
    """Today's prices at the end of each cluster's history; a cluster of other products than before starts anew."""
    ids = F.transform_values("stores_data", lambda _, v: v["raw_product_id"])
    today = F.struct(
        F.lit(run_date).alias("date"),
        ids.alias("stores_product_ids"),
        *[F.col(f"price_metrics.{c}").alias(c) for c in ("avg_price", "min_price", "max_price")],
        F.transform_values("stores_data", lambda _, v: v["price"]).alias("stores_prices"),
    )
    if previous is None:
        return gold.withColumn("price_history", F.array(today))
    key = F.coalesce("barcode", "product_name_en")
    # Of clusters with one key, that of the largest first product's id counts.
    last = F.struct(F.col("stores_data.bindawood.raw_product_id").alias("anchor"), F.size("price_history").alias("days"))
    named = previous.where(key.isNotNull()).groupBy(key.alias("_key")).agg(F.max_by(within_stores("price_history", STORES), last).alias("_old"))
    anchors = previous.select(
        F.col("stores_data.bindawood.raw_product_id").alias("_anchor"), F.map_entries(F.transform_values("stores_data", lambda _, v: v["raw_product_id"])).alias("_ids")
    )
    df = gold.join(named, key == F.col("_key"), "left").join(anchors, F.col("stores_data.bindawood.raw_product_id") == F.col("_anchor"), "left")
    moved = F.coalesce(F.col("_ids") != F.map_entries(ids), F.lit(False))
    df = df.withColumn("_old", F.when(~moved, F.col("_old")))
    return df.withColumn("price_history", append_history("_old", today)).drop("_key", "_old", "_anchor", "_ids")


def audit(products: DataFrame, gold: DataFrame) -> DataFrame:
    """One row a flag of a stored cluster: ``anchor, kind, detail``."""
    profiled = materialize(profiles(products))
    ids = gold.select(F.col("stores_data.bindawood.raw_product_id").alias("anchor"), F.explode("stores_data").alias("store", "data"))
    rows = ids.select("anchor", "store", F.col("data.raw_product_id").alias("id")).join(
        profiled.select("store", "id", F.struct("attrs", "package", "codes", "valid", "barcodes", "price", "discount_amount", "original_price").alias("p")),
        ["store", "id"], "left",
    )
    missing = rows.where("p IS NULL").select("anchor", F.lit("missing_silver_product").alias("kind"), F.array("store", "id").alias("detail"))
    fixed = rows.where(F.size("p.package.issues") > 0).select("anchor", F.lit("silver_package_corrected_from_name"), F.col("p.package.issues"))
    a = rows.where("p IS NOT NULL").select("anchor", F.col("store").alias("sa"), F.col("p").alias("pa"))
    pairs = a.join(a.select("anchor", F.col("sa").alias("sb"), F.col("pa").alias("pb")), "anchor").where("sa < sb")
    pa, pb = F.col("pa"), F.col("pb")
    semantic = semantic_conflicts(pa["attrs"], pb["attrs"])
    package = package_conflicts(pa["package"], pb["package"])
    none = barcode.evidence(pa["codes"], pa["valid"], pb["codes"], pb["valid"]) == 0
    flags = [
        pairs.where(F.size(semantic) > 0).select("anchor", F.lit("semantic_conflict"), semantic),
        pairs.where(F.size(package) > 0).select("anchor", F.lit("package_conflict"), package),
        pairs.where(none & (F.size(pa["barcodes"]) > 0) & (F.size(pb["barcodes"]) > 0)).select("anchor", F.lit("barcode_disagreement"), F.array("sa", "sb")),
    ]
    full_price = (F.col("p.price") > 0) & ~F.coalesce(F.col("p.discount_amount") != 0, F.lit(False)) & ~F.coalesce(
        F.col("p.original_price") > F.col("p.price"), F.lit(False)
    )
    spread = rows.where(full_price).groupBy("anchor").agg(F.count("*").alias("n"), (F.max("p.price") / F.min("p.price")).alias("ratio"))
    flags.append(spread.where("n >= 2 AND ratio > 1.85").select("anchor", F.lit("price_spread_review"), F.array(round2(F.col("ratio")).cast("string"))))
    out = missing.union(fixed)
    for f in flags:
        out = out.union(f)
    return out


def require_clean(products: DataFrame, gold: DataFrame) -> DataFrame:
    """``gold``, unless a conflict or a reused product stands: then an error and nothing to write."""
    bad = audit(products, gold).where(F.col("kind").isin("semantic_conflict", "package_conflict")).limit(1).count()
    uses = gold.select(F.explode("stores_data").alias("store", "data")).groupBy("store", "data.raw_product_id").count().where("count > 1").limit(1).count()
    if bad or uses:
        raise ValueError("the quality gate failed; nothing was written")
    return gold


def diff_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """Clusters added, removed or changed between two gold tables, by their first store's product."""
    ids = lambda p: F.transform_values("stores_data", lambda _, v: v["raw_product_id"]).alias(f"{p}_ids")
    side = lambda df, p: df.select(
        F.col("stores_data.bindawood.raw_product_id").alias("anchor"), ids(p), F.col("match_tier").alias(f"{p}_tier"),
        F.col("confidence_score").alias(f"{p}_confidence"), F.struct("size", "unit", "quantity", "total_size").alias(f"{p}_package"),
    )
    both = side(old, "old").join(side(new, "new"), "anchor", "full_outer")
    entries = lambda c: F.map_entries(c)
    change = (
        F.when(F.col("old_ids").isNull(), "added").when(F.col("new_ids").isNull(), "removed")
        .when(entries("old_ids") != entries("new_ids"), "changed").otherwise("same")
    )
    return both.withColumn("change", change).withColumn(
        "package_changed", F.coalesce(F.col("old_package") != F.col("new_package"), F.lit(False))
    )


def loss_class(removed: DataFrame, products: DataFrame) -> DataFrame:
    """Why clusters (``anchor, old_ids``) were lost: an explicit conflict, a missing product, or too little evidence."""
    profiled = materialize(profiles(products))
    rows = removed.select("anchor", F.explode("old_ids").alias("store", "id")).join(profiled, ["store", "id"])
    found = rows.groupBy("anchor").agg(F.count("*").alias("n"))
    side = rows.select("anchor", "uid", "store", "attrs", "package", "tokens", "codes", "valid")
    a = side.select("anchor", *[F.col(c).alias(f"a_{c}") for c in side.columns if c != "anchor"])
    b = side.select("anchor", *[F.col(c).alias(f"b_{c}") for c in side.columns if c != "anchor"])
    pairs = a.join(b, "anchor").where("a_store < b_store")
    conflict = (F.size(semantic_conflicts(F.col("a_attrs"), F.col("b_attrs"))) > 0) | (F.size(package_conflicts(F.col("a_package"), F.col("b_package"))) > 0)
    conflicts = pairs.groupBy("anchor").agg(F.max(conflict.cast("int")).alias("conflict"))
    tied = pairs.join(evidence(pairs).select("a_uid", "b_uid"), ["a_uid", "b_uid"], "left_semi").groupBy("anchor").agg(F.count("*").alias("edges"))
    kind = (
        F.when(F.coalesce("n", F.lit(0)) != 3, "C_missing_silver_product").when(F.col("conflict") == 1, "A_explicit_conflict")
        .when(F.coalesce("edges", F.lit(0)) < 3, "C_insufficient_identity_evidence").otherwise("C_ambiguous_or_stronger_competitor")
    )
    return removed.join(found, "anchor", "left").join(conflicts, "anchor", "left").join(tied, "anchor", "left").select("anchor", kind.alias("loss_class"))
