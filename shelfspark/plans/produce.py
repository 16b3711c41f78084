"""Produce: official price anchors, guarded scores, top-3 trios and a global one-to-one allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import tables, text
from shelfspark.functions.numbers import kg_price, reference_price, round2, truthy
from shelfspark.operators.assign import greedy_one_to_one
from shelfspark.operators.dedupe import assert_single_use, last_wins, top_n
from shelfspark.operators.merge import append_history
from shelfspark.plans.matching import attach_members, stores_data
from shelfspark.schemas import STORES
from shelfspark.storage import materialize, small


def anchors(records: DataFrame) -> DataFrame:
    """One row a commodity: its latest year, the last record of equal years. ``pos`` is the record's place."""
    en = F.trim(text.text_or_empty(F.col("item_name_en")))
    ar0 = F.trim(text.text_or_empty(F.col("item_name_ar")))
    ar = F.when((ar0 == "س") & F.lower(en).contains("lemon"), "ليمون وسط أفريقي").otherwise(ar0)
    df = records.withColumns({"name_en": en, "name_ar": ar}).where(F.length("name_ar") >= 2)
    df = df.withColumn("root", text.commodity_root(F.concat_ws(" ", "name_ar", "name_en"))).where("root IS NOT NULL")
    df = df.withColumns({"key": F.when(F.col("name_en") != "", F.col("name_en")).otherwise(F.col("name_ar")), "year": F.coalesce("Year", F.lit(0))})
    latest = last_wins(df, ["key"], ["year", "pos"])
    lower = F.lower(F.concat_ws(" ", "name_ar", "name_en"))
    words = [text.has_any(lower, anchor).alias(k) for k, (_, anchor) in tables.PRODUCE_WORDS.items()]
    return latest.select(
        "key", "root", "name_ar", "name_en", "year",
        F.when(text.text_or_empty(F.col("unit_ar")).contains("حزمة"), "bundle").otherwise("kg").alias("unit"),
        reference_price(F.col("Dec"), F.col("Nov"), F.col("Oct"), F.col("Annual average")).alias("benchmark_price"),
        (F.col("name_ar").contains("محلي") | F.lower("name_en").contains("local")).alias("is_local"),
        (F.col("name_ar").contains("مستورد") | F.lower("name_en").contains("imported")).alias("is_imported"),
        F.struct(text.has_any(lower, tables.PREMIUM).alias("premium"), *words).alias("says"),
    )


def produce_features(products: DataFrame) -> DataFrame:
    """Products of a known root with a price, with what their text says."""
    # Dealt out, as a table of few and small files would be read by few tasks, and written, as the filter on it would tell a root anew.
    df = products.repartition("uid").withColumn("words", text.produce_text(text.full_text(F.col("name_en"), F.col("name_ar"))))
    df = materialize(df.withColumn("root", text.commodity_root(F.col("words")))).withColumn(
        "kg_price", kg_price(F.col("price"), F.col("total_size_value"), F.col("unit_size_value"), F.col("size_unit"))
    )
    w = F.col("words")
    says = [text.has_any(w, product).alias(k) for k, (product, _) in tables.PRODUCE_WORDS.items()]
    unit = F.lower(text.text_or_empty(F.col("size_unit")))
    return df.where("root IS NOT NULL AND kg_price > 0").withColumn(
        "tells",
        F.struct(
            text.has_any(w, tables.PREMIUM).alias("premium"),
            *says,
            text.has_any(w, tables.PINK_LADY).alias("pink_lady"),
            text.has_any(w, tables.LOCAL_WORDS).alias("local"),
            text.has_any(w, tables.IMPORTED_WORDS).alias("imported"),
            (text.has_any(unit, tables.BUNDLE_UNITS) | text.has_any(w, tables.BUNDLE_WORDS)).alias("bundle"),
        ),
    )


def score(p: Column, a: Column, root: Column, unit: Column, local: Column, imported: Column, price: Column, benchmark: Column) -> Column:
    """Score of a product of the anchor's root: 0 if a guard rejects, else 1, provenance and nearness in price."""
    apple, pepper, onion = root == "apple", root == "pepper", root == "onion"
    rejected = (
        (p["premium"] & ~a["premium"])
        | (p["sliced"] & ~a["sliced"])
        | (apple & p["pink_lady"] & (a["apple_yellow"] | a["apple_green"]))
        | (apple & a["apple_yellow"] & ~p["apple_yellow"])
        | (apple & a["apple_green"] & ~p["apple_green"])
        | (apple & a["apple_red"] & ~p["apple_red"] & (p["apple_yellow"] | p["apple_green"]))
        | (pepper & a["chili"] & p["sweet"] & ~p["chili"])
        | (pepper & ~a["chili"] & p["chili"])
        | (pepper & a["sweet"] & p["chili"])
        | (onion & p["onion_red"] & ~a["onion_red"] & (a["onion_white"] | a["onion_green"]))
        | (onion & p["onion_white"] & ~a["onion_white"] & (a["onion_red"] | a["onion_green"]))
        | (onion & p["onion_green"] & ~a["onion_green"] & (a["onion_red"] | a["onion_white"]))
        | (local & p["imported"])
        | (imported & p["local"])
        | ((unit == "bundle") & ~p["bundle"] & ~root.isin(*tables.BUNDLE_ROOTS))
        | ((unit == "kg") & p["bundle"])
    )
    provenance = F.when((local & p["local"]) | (~(local & p["local"]) & imported & p["imported"]), 0.8).otherwise(0.0)
    ratio = F.abs(price - benchmark) / benchmark
    near = F.when(~(truthy(price) & F.coalesce(benchmark > 0, F.lit(False))), 0.0).when(
        ratio <= 0.8, F.greatest(F.lit(0.0), 1.0 - ratio)
    ).otherwise(-0.5)
    return F.when(rejected, 0.0).otherwise(F.lit(1.0) + provenance + near)


def scored(products: DataFrame, anchor_rows: DataFrame) -> DataFrame:
    """(key, store, uid, kg_price, score) of at least 1; the join is by root."""
    a = anchor_rows.select(
        "key", "root", F.col("unit").alias("anchor_unit"), "benchmark_price", "is_local", "is_imported", "says"
    )
    joined = produce_features(products).join(small(a, 100_000), "root")
    s = score(
        F.col("tells"), F.col("says"), F.col("root"), F.col("anchor_unit"), F.col("is_local"), F.col("is_imported"), F.col("kg_price"), F.col("benchmark_price")
    )
    return joined.withColumn("score", s).where("score >= 1.0").select("key", "store", "uid", "ord", "kg_price", "score")


def best_trios(scores: DataFrame, most_spread: float = 2.2) -> DataFrame:
    """Each anchor's best trio of its three best products a store: the sum of scores less half the spread."""
    best = top_n(scores, ["key", "store"], [F.desc("score"), F.col("ord")], 3)
    rank = F.row_number().over(Window.partitionBy("key", "store").orderBy(F.desc("score"), "ord"))
    best = best.withColumn("place", rank)
    out = None
    for s in STORES:
        own = best.where(F.col("store") == s).select(
            "key", F.col("uid").alias(s), F.col("kg_price").alias(f"{s}_kg"), F.col("score").alias(f"{s}_score"), F.col("place").alias(f"{s}_place")
        )
        out = own if out is None else out.join(own, "key")
    prices = [F.col(f"{s}_kg") for s in STORES]
    out = out.withColumn("spread", F.greatest(*prices) / F.least(*prices)).where(F.col("spread") <= most_spread)
    metric = sum((F.col(f"{s}_score") for s in STORES[1:]), F.col(f"{STORES[0]}_score")) - F.col("spread") * 0.5
    return top_n(out.withColumn("metric", metric), ["key"], [F.desc("metric"), *[F.col(f"{s}_place") for s in STORES]], 1)


def allocate(trios: DataFrame) -> DataFrame:
    """Trios by falling metric, rising spread and key, each product at most once."""
    ranked = trios.select("key", *STORES, *[f"{s}_kg" for s in STORES], "metric", "spread", (-F.col("metric")).alias("o1"))
    return greedy_one_to_one(ranked, list(STORES), ["o1", "spread", "key"]).drop("o1")


def match(products: DataFrame, records: DataFrame, run_date: str, previous: DataFrame | None = None) -> DataFrame:
    """Gold rows of produce with price history; reading them fails if a product is used twice."""
    anchor_rows = materialize(anchors(records))
    chosen = allocate(best_trios(materialize(scored(products, anchor_rows))))
    for s in STORES:
        chosen = assert_single_use(chosen, [s])
    full = attach_members(chosen, products).join(anchor_rows, "key")
    members = [F.struct(*[F.col(f"{s}_product.{c}").alias(c) for c in ("price", "original_price", "discount_amount", "discount_percentage", "image_url", "id")], F.col(f"{s}_kg").alias("kg")) for s in STORES]
    known = F.array(*[F.col(f"{s}_kg") for s in STORES])
    average = round2(F.aggregate(known, F.lit(0.0), lambda x, y: x + y) / 3)
    low, high = F.array_min(known), F.array_max(known)
    c = F.col("bindawood_product")
    gold = full.select(
        F.col("key").alias("gastat_key"), F.col("root").alias("commodity_root"),
        F.coalesce(text.or_none(c["name_ar"]), F.col("name_ar")).alias("product_name_ar"),
        F.coalesce(text.or_none(c["name_en"]), F.col("name_en")).alias("product_name_en"),
        F.col("name_ar").alias("official_gastat_name_ar"), F.col("name_en").alias("official_gastat_name_en"), c["brand"].alias("brand"),
        F.lit("fruits_and_vegetables").alias("category"), F.col("unit").alias("unit"),
        F.coalesce(F.nullif(c["unit_size_value"], F.lit(0.0)), F.lit(1.0)).alias("size"), F.get(c["barcodes"], F.lit(0)).alias("barcode"),
        c["image_url"].alias("image_url"), c["store"].alias("canonical_source"), F.lit(3).alias("matched_stores_count"),
        F.array(*[F.lit(s) for s in STORES]).alias("matched_stores"),
        F.struct(
            average.alias("avg_price"), low.alias("min_price"), high.alias("max_price"), round2(high - low).alias("price_diff"),
            F.col("benchmark_price").alias("gastat_benchmark_price"),
            F.when(truthy(average) & truthy(F.col("benchmark_price")), round2(average - F.col("benchmark_price"))).alias("variance_from_benchmark"),
        ).alias("current_pricing"),
        stores_data(members, "kg", raw_price=True).alias("stores_data"),
    )
    today = F.struct(
        F.lit(run_date).alias("date"), *[F.col(f"current_pricing.{x}").alias(x) for x in ("avg_price", "min_price", "max_price")],
        F.col("current_pricing.gastat_benchmark_price").alias("gastat_benchmark"),
        F.transform_values("stores_data", lambda _, v: v["price"]).alias("stores_prices"),
    )
    if previous is None:
        return gold.withColumn("price_history", F.array(today))
    old = previous.select("gastat_key", F.col("price_history").alias("_old"))
    return gold.join(old, "gastat_key", "left").withColumn("price_history", append_history("_old", today)).drop("_old")
