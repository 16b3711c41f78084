"""Silver, sources and the warehouse on small fixtures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfspark.plans import benchmark, produce, silver, warehouse
from shelfspark.schemas import BRONZE_BINDAWOOD, BRONZE_PANDA, BRONZE_TAMIMI, REFERENCE_PRICES
from shelfspark.sources.files import json_array
from shelfspark.sources.paged import register


def bronze(spark, tmp_path, items, schema):
    path = tmp_path / "items.json"
    path.write_text(json.dumps(items, ensure_ascii=False), encoding="utf-8")
    return json_array(spark, str(path), schema)


def test_tamimi(spark, tmp_path):
    items = [
        {"id": 1, "name": "Juice", "brand": {"name": "B"}, "variant": {"id": "v1", "fullName": "Juice 6 x 200 ML", "barcodes": ["00628100000001"], "images": ["u"], "storeSpecificData": [{"mrp": 12, "discount": 2.5}]}},
        {"id": 1, "name": "Again", "variant": {"id": "v1"}},
        {"id": 2, "variant": {"id": "v2"}},
    ]
    (row,) = silver.tamimi(bronze(spark, tmp_path, items, BRONZE_TAMIMI), F.lit("beverages")).collect()
    assert (row.id, row.price, row.original_price, row.discount_amount, row.discount_percentage) == ("v1", 9.5, 12.0, 2.5, 20.83)
    assert (row.pack_qty, row.total_size_value, row.barcodes) == (6, 1200.0, ["00628100000001", "628100000001"])


def test_bindawood(spark, tmp_path):
    items = [{"objectID": "o", "master_id": "", "name_en": "Nadec Milk 2L", "image": "https://x/628100000001_1.jpg", "price": "5", "original_price": "6"}, {"objectID": "p"}]
    rows = {r.id: r for r in silver.bindawood(bronze(spark, tmp_path, items, BRONZE_BINDAWOOD), F.lit("dairy_and_eggs")).collect()}
    assert (rows["o"].brand, rows["o"].price, rows["o"].original_price, rows["o"].unit_size_value) == ("Nadec", 5.0, 6.0, 2000.0)
    assert rows["p"].name_en is None


def test_panda(spark, tmp_path):
    variety = {"sku": "s", "barcode": "0012345678", "price": "3", "undiscounted_price": "4", "size": "0.5", "unit": "kg", "wighted": True,
               "weighted_options": [{"quantity_value": 0.5, "quantity_name": "0.5 KG", "price": 3}, {"quantity_value": 1, "quantity_name": "1 KG", "price": 6}]}
    items = [{"id": 9, "name": "تفاح", "_source_locale": "ar", "varieties": [variety, {"price": "1"}]}]
    (row,) = silver.panda(bronze(spark, tmp_path, items, BRONZE_PANDA), F.lit("fruits_and_vegetables")).collect()
    assert (row.name_ar, row.name_en, row.price, row.unit_size_value, len(row.weighted_options)) == ("تفاح", None, 6.0, 1000.0, 2)


def test_missing_file_and_envelopes(spark, tmp_path):
    assert json_array(spark, str(tmp_path / "none.json"), "id string").count() == 0
    for body in ('[{"id": 1}]', '{"records": [{"id": 1}]}', '{"products": [{"id": 1}]}'):
        (tmp_path / "e.json").write_text(body)
        assert [tuple(r) for r in json_array(spark, str(tmp_path / "e.json"), "id string").collect()] == [("1", 0)]
    (tmp_path / "e.json").write_text('{"other": 1}')
    with pytest.raises(Exception, match="no array"):
        json_array(spark, str(tmp_path / "e.json"), "id string").collect()


def test_paged_source(spark, tmp_path):
    for category, pages in {"a": [[{"x": 1}], [{"x": 2}], []], "b": [[{"x": 3}], [{"x": 3}], [{"x": 4}]]}.items():
        (tmp_path / category).mkdir()
        for i, items in enumerate(pages, 1):
            (tmp_path / category / f"{i}.json").write_text(json.dumps(items))
    register(spark)
    got = spark.read.format("paged").load(str(tmp_path)).select("category", "item").collect()
    assert sorted(tuple(r) for r in got) == [("a", '{"x": 1}'), ("a", '{"x": 2}'), ("b", '{"x": 3}')]
    assert spark.read.format("paged").load(str(tmp_path)).where("category = 'b'").count() == 1


def _reference(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{REFERENCE_PRICES}, pos int")


def test_anchors_keep_the_latest_year(spark):
    rows = [("1", "تفاح أحمر", "Red apple", 2022, "كجم", None, None, None, "5"), ("1", "تفاح أحمر", "Red apple", 2023, "كجم", None, "1,006.5", None, "7"), ("2", "x", "zzz", 2023, None, None, None, None, None)]
    (row,) = produce.anchors(_reference(spark, rows)).collect()
    assert (row.key, row.root, row.year, row.benchmark_price, row.unit) == ("Red apple", "apple", 2023, 1006.5, "kg")


def test_ambiguous_names_match_nothing_and_ids_share_results(spark):
    data = F.create_map(F.lit("bindawood"), F.struct(F.lit("1").alias("raw_product_id")))
    gold = spark.createDataFrame([("k1", "a", "same"), ("k2", "b", "same")], "gastat_key string, official_gastat_name_ar string, official_gastat_name_en string")
    gold = gold.withColumns({"stores_data": data, "barcode": F.concat(F.lit("code "), "gastat_key")})
    rows = [("7", "zz", "same", 2022, None, None, None, None, None), ("8", "A!", "q", 2022, None, None, None, None, None), ("8", "other", "q", 2023, None, None, None, None, None)]
    got = benchmark.enrich(_reference(spark, rows), gold).orderBy("pos").collect()
    assert [(r.match_count, r.matched_barcodes) for r in got] == [(0, []), (1, ["code k1"]), (1, ["code k1"])]


def _gold(spark, names):
    df = spark.createDataFrame([(n, b) for n, b in names], "product_name_en string, barcode string")
    entry = F.struct(F.lit(2.0).alias("price"), *[F.lit(None).cast("double").alias(c) for c in ("original_price", "discount_amount", "discount_percentage")], F.lit(False).alias("has_discount"), F.lit("r").alias("raw_product_id"))
    return df.withColumns({
        "product_name_ar": F.lit(None).cast("string"), "brand": F.lit("b"), "category": F.lit("c"), "size": F.lit(1.0), "unit": F.lit("g"), "image_url": F.lit("u"),
        "match_tier": F.lit("t"), "confidence_score": F.lit(0.9), "stores_data": F.create_map(F.lit("bindawood"), entry, F.lit("panda"), entry),
        "price_metrics": F.struct(*[F.lit(2.0).alias(c) for c in ("avg_price", "min_price", "max_price", "price_diff")]),
    })


def test_warehouse_load_is_idempotent(spark):
    warehouse.create_tables(spark, "dwh")
    none = _gold(spark, [("z", "0")]).limit(0).drop("price_metrics", "match_tier", "confidence_score")
    day, later = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    refs = _reference(spark, [("1", "a", "b", 2023, None, None, None, None, "5"), (None, "a", "b", 2023, None, None, None, None, "5")])
    rows = warehouse.reference_rows(refs.withColumn("matched_barcodes", F.array(F.lit("x"))))
    for date in (day, day, later):
        gold = warehouse.union_gold(_gold(spark, [("dairy", "1"), ("only", "2")]), _gold(spark, [("drink", "1")]), none)
        warehouse.load(spark, "dwh", gold, rows, date)
    assert {r.product_id: r.product_name_en for r in spark.table("dwh.dim_matched_products").collect()} == {"1": "drink", "2": "only"}
    assert dict(spark.table("dwh.fct_price_snapshots").groupBy("snapshot_date").count().collect()) == {day: 2, later: 2}
    assert spark.table("dwh.fct_store_item_prices").count() == 8
    # A null reference id never matches, so each load inserts it again.
    assert sorted(str(r.gastat_id) for r in spark.table("dwh.ref_gastat_prices").collect()) == ["1", "None", "None", "None"]


def test_branches(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dwb")
    warehouse.create_tables(spark, "dwb")
    spark.sql("INSERT INTO dwb.dim_branches VALUES ('Big_Shop_1', 'Big Shop', 'c', 'n')")
    row = lambda i, lat: spark.createDataFrame([(i, "Big Shop", lat, 2.0)], "id int, brand string, LATITUDE double, LONGITUDE double")
    assert warehouse.sync_branches(spark, "dwb", row(1, 1.0)) == 1
    assert spark.table("dwb.dim_branches").collect()[0].latitude == 1.0
    with pytest.raises(ValueError, match="exactly one"):
        warehouse.sync_branches(spark, "dwb", row(2, 1.0))
    with pytest.raises(Exception, match="bad coordinates"):
        warehouse.sync_branches(spark, "dwb", row(1, 100.0))


def test_sizes_are_told_once_repeated_rows_are_gone(spark, tmp_path, monkeypatch):
    told = silver.size.tamimi_size
    bad = lambda text: F.when(text.contains("Again"), F.raise_error(F.lit("a repeated row's size was told")).cast("string")).otherwise(text)
    monkeypatch.setattr(silver.size, "tamimi_size", lambda text: told(bad(text)))
    items = [{"id": 1, "name": name, "variant": {"id": "v1", "fullName": name, "storeSpecificData": [{"mrp": 5}]}} for name in ("Juice 250 ML", "Again 1 L", "Again 2 L")]
    (row,) = silver.tamimi(bronze(spark, tmp_path, items, BRONZE_TAMIMI), F.lit("beverages")).collect()
    assert (row.id, row.name_en, row.total_size_value, row.price) == ("v1", "Juice 250 ML", 250.0, 5.0)
