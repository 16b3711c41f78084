"""The three matchers on fixtures that each decide one rule."""

import random

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import numbers, text
from shelfspark.plans import beverages, dairy, produce
from shelfspark.plans.matching import union_stores
from shelfspark.schemas import REFERENCE_PRICES, STORES
from shelfspark.storage import materialize

_COLUMNS = (
    "id string, store string, name_en string, name_ar string, brand string, barcodes array<string>, price double, original_price double, "
    "discount_amount double, discount_percentage double, pack_qty int, unit_size_value double, total_size_value double, size_unit string, image_url string, pos int"
)


def shop(spark, rows):
    """Products of (store, id, name, brand, barcodes, price, total, unit)."""
    full = [
        (i, store, name, None, brand, list(codes), float(price), None, None, None, 1, float(total), float(total), unit, None, k)
        for k, (store, i, name, brand, codes, price, total, unit) in enumerate(rows)
    ]
    df = spark.createDataFrame(full, _COLUMNS)
    return union_stores(*[df.where(F.col("store") == s) for s in STORES])


def drinks(spark, *rows):
    return shop(spark, [(s, str(i), name, "Brand", [code], price, 330, "ml") for i, (s, name, code, price) in enumerate(rows)])


CODE, FAR = "6281000000014", "6281000099996"
B, P, T = STORES


def test_third_edge_decides_the_tier(spark):
    (row,) = beverages.match(drinks(spark, (B, "cola classic", CODE, 10), (P, "cola classic", CODE, 10), (T, "cola classic", FAR, 10))).collect()
    assert (row.match_tier, row.confidence_score) == ("gs1_prefix_match", 0.94)


@pytest.mark.parametrize("other", ["cola lemon", "cola zero", "cola lemon zero"])
def test_flavours_and_diet_keep_products_apart(spark, other):
    rows = [(B, "cola", CODE, 10), (P, other, CODE, 10), (T, other, CODE, 10)]
    assert beverages.match(drinks(spark, *rows)).count() == 0
    edges = beverages.pair_edges(beverages.features(drinks(spark, *rows))).collect()
    assert [(e.a_uid, e.b_uid) for e in edges] == [("panda_1", "tamimi_2")]


def test_price_ratio_bound(spark):
    edges = lambda a, b: beverages.pair_edges(beverages.features(drinks(spark, (B, "cola", CODE, a), (P, "cola", CODE, b)))).count()
    assert (edges(10, 15.5), edges(10, 15.6), edges(0, 99)) == (1, 0, 1)


def test_a_component_with_a_bad_pair_is_dropped(spark):
    assert beverages.match(drinks(spark, (B, "cola", CODE, 10), (P, "cola", CODE, 15), (T, "cola", CODE, 20))).count() == 0
    assert beverages.match(drinks(spark, (B, "cola", CODE, 10), (P, "cola", CODE, 12), (T, "cola", CODE, 15))).count() == 1


def test_one_product_a_store_shares_the_barcode_of_the_canonical(spark):
    rows = [(B, "cola", CODE, 10), (P, "cola", FAR, 10), (P, "cola", CODE, 14), (T, "cola", CODE, 10)]
    (row,) = beverages.match(drinks(spark, *rows)).collect()
    assert row.stores_data["panda"].raw_product_id == "2" and row.price_metrics.max_price == 14.0


def test_brand_edges_equal_the_theta_join_whatever_the_sizes(spark):
    rng = random.Random(5)
    words = ["lemon", "zero", "cola", "water", "mango", "classic"]
    rows = [
        (rng.choice(STORES), str(i), " ".join(rng.sample(words, 2)), rng.choice(["A", "A", "B", None]), [f"62810{rng.randint(0, 99999):05d}"], rng.randint(8, 14),
         rng.choice([100.0, 95.0, 94.9, 105.2, 0.0, -5.0, 1e-3, float("nan"), 330.0, 346.0]), rng.choice(["ml", "g", None]))
        for i in range(120)
    ]
    featured = beverages.features(shop(spark, rows))
    a, b = beverages.both_sides(featured, beverages._FEATURES)
    theta = a.crossJoin(b).where("a_ord.store < b_ord.store").where(beverages.compatible()).withColumn("tier", beverages.tier()).where("tier IS NOT NULL")
    got = [tuple(r) for r in beverages.pair_edges(featured).collect()]
    assert len(got) == len(set(got)) and set(got) == {tuple(r) for r in theta.select("a_uid", "b_uid", "tier").collect()} and got


def test_variant_masks_equal_word_sets(spark):
    rng = random.Random(2)
    words = ["lemon_flavor", "diet_var", "regular_var", "sparkling", "still", "mango_flavor", "cola"]
    pairs = [(rng.sample(words, rng.randint(0, 4)), rng.sample(words, rng.randint(0, 4))) for _ in range(200)]
    got = spark.createDataFrame(pairs, "a array<string>, b array<string>").select(text.conflicting_tokens(F.col("a"), F.col("b"))).collect()
    flavours = {"lemon_flavor", "mango_flavor"}
    for (a, b), (hit,) in zip(pairs, got, strict=True):
        a, b = set(a), set(b)
        differ = any(a & g and b & g and a & g != b & g for g in ({"diet_var", "regular_var"}, flavours, {"sparkling", "still"}))
        assert hit == (differ or bool(a & flavours) != bool(b & flavours) or ("diet_var" in a) != ("diet_var" in b))


def milk(spark, *rows):
    return shop(spark, [(s, str(i), name, brand, [code], price, 1000, "ml") for i, (s, name, brand, code, price) in enumerate(rows)])


def test_dairy_pairs_equal_the_theta_join(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(STORES), str(i), f"fresh {rng.choice(['full fat', 'low fat'])} milk {rng.choice(['farm', 'best'])}", rng.choice(["Almarai", "Nadec", None]),
         [rng.choice([CODE, FAR, "6281000000021"])], 6, rng.choice([1000, 985, 979, 500, 2000]), rng.choice(["ml", "g"]))
        for i in range(70)
    ]
    profiled = materialize(dairy.profiles(shop(spark, rows)))
    side = lambda p: profiled.select(*[F.col(c).alias(f"{p}_{c}") for c in ("uid", "store", "attrs", "package", "tokens", "codes", "valid")])
    theta = dairy.evidence(side("a").crossJoin(side("b")).where("a_store < b_store"))
    expected = {tuple(r) for r in theta.collect()}
    got = [tuple(r) for r in dairy.pair_edges(profiled).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected


def test_dairy_leaves_near_ties_to_people(spark):
    trios = spark.createDataFrame([("b1", "p1", "t1", 100.0), ("b1", "p2", "t2", 99.5), ("b3", "p3", "t3", 50.0)], "bindawood string, panda string, tamimi string, score double")
    accepted, unsure = dairy.reciprocal_best(trios)
    assert [r.bindawood for r in accepted.collect()] == ["b3"] and [(r.uid, r.next) for r in unsure.collect()] == [("b1", 99.5)]


def test_salt_is_denied_before_it_is_found(spark):
    rows = dairy.profiles(milk(spark, (B, "unsalted butter", "Lurpak", CODE, 9), (P, "salted butter", "Lurpak", CODE, 9))).orderBy("uid").collect()
    assert [r.attrs.salt for r in rows] == ["unsalted", "salted"]


def test_dairy_gate_and_flags(spark):
    products = milk(spark, (B, "fresh full fat milk", "Almarai", CODE, 6), (P, "fresh full fat milk", "Almarai", CODE, 6), (T, "fresh full fat milk", "Almarai", CODE, 6))
    products = materialize(products)
    gold = materialize(dairy.match(products, "2024-01-01"))
    assert gold.count() == 1 and dairy.require_clean(products, gold).count() == 1 and dairy.audit(products, gold).count() == 0
    spoilt = products.withColumn("name_en", F.when(F.col("store") == P, "fresh skimmed milk").otherwise(F.col("name_en")))
    assert {r.kind for r in dairy.audit(spoilt, gold).collect()} == {"semantic_conflict"}
    with pytest.raises(ValueError, match="quality gate"):
        dairy.require_clean(spoilt, gold)
    with pytest.raises(ValueError, match="quality gate"):
        dairy.require_clean(products, gold.union(gold))
    dear = products.withColumn("price", F.when(F.col("store") == T, 12.0).otherwise(F.col("price"))).where(F.col("store") != P)
    assert {r.kind for r in dairy.audit(dear, gold).collect()} == {"missing_silver_product", "price_spread_review"}
    lost = gold.select(F.col("stores_data.bindawood.raw_product_id").alias("anchor"), F.transform_values("stores_data", lambda _, v: v["raw_product_id"]).alias("old_ids"))
    kind = lambda p: dairy.loss_class(lost, p).collect()[0].loss_class
    assert (kind(spoilt), kind(dear)) == ("A_explicit_conflict", "C_missing_silver_product")


def fruit(spark, *rows):
    return shop(spark, [(s, str(i), name, None, [], price, 1000, "g") for i, (s, name, price) in enumerate(rows)])


def references(spark, *rows):
    return spark.createDataFrame([(str(i), ar, en, 2023, "كجم", str(price), None, None, None, i) for i, (ar, en, price) in enumerate(rows)], f"{REFERENCE_PRICES}, pos int")


def test_produce_goes_to_the_anchor_that_gains_most(spark):
    rows = [(s, "Yellow apple", 10) for s in STORES]
    gold = produce.match(fruit(spark, *rows), references(spark, ("تفاح أصفر", "Yellow apple", 10), ("تفاح", "Apple", 15)), "2024-01-01").collect()
    assert [(g.gastat_key, g.current_pricing.avg_price) for g in gold] == [("Yellow apple", 10.0)]


@pytest.mark.parametrize(("name", "anchor", "price", "found"), [
    ("Yellow apple", ("تفاح أصفر", "Yellow apple"), 10, 1), ("Pink lady apple", ("تفاح أصفر", "Yellow apple"), 10, 0), ("Apple", ("تفاح", "Apple"), 30, 0),
    ("Imported apple", ("تفاح محلي", "Local apple"), 10, 0), ("Chili pepper", ("فلفل حلو", "Sweet pepper"), 10, 0),
])
def test_produce_guards(spark, name, anchor, price, found):
    gold = produce.match(fruit(spark, *[(s, name, price) for s in STORES]), references(spark, (*anchor, 10)), "2024-01-01")
    assert gold.count() == found


def test_a_products_root_is_told_once(spark):
    found = produce.produce_features(fruit(spark, (B, "Yellow apple", 10), (P, "mango", 10), (T, "stone", 10)))
    assert "rlike" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted((r.store, r.root) for r in found.collect()) == [(B, "apple"), (P, "mango")]


def test_kilogram_prices(spark):
    row = spark.range(1).select(numbers.kg_price(F.lit(6.0), F.lit(500.0), F.lit(500.0), F.lit("g")).alias("p")).first()
    assert row.p == 12.0
