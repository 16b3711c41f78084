"""The batch end to end on three tiny stores, twice; and the optional stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfspark.plans.run import Run


def _bronze(folder):
    milk = "Almarai Fresh Full Fat Milk 1L"
    rows = {
        "tamimi": lambda name, i: {"id": f"t{i}", "name": name, "brand": {"name": "Almarai"}, "variant": {"id": f"t{i}", "fullName": name, "barcodes": ["6281000000014"], "storeSpecificData": [{"mrp": 6.1, "discount": 0}]}},
        "bindawood": lambda name, i: {"objectID": f"b{i}", "full_name_en": name, "brand_en": "Almarai", "barcodes": ["6281000000014"], "price": "6"},
        "panda": lambda name, i: {"id": i, "name": name, "brand": {"name": "Almarai"}, "varieties": [{"sku": f"p{i}", "barcode": "6281000000014", "price": "6.2", "size": "1", "unit": "l"}]},
    }
    names = {"beverages": "Almarai Orange Juice 1L", "dairy_and_eggs": milk, "fruits_and_vegetables": "Fresh Banana 1kg"}
    for store, make in rows.items():
        (folder / "bronze" / store).mkdir(parents=True)
        for i, (category, name) in enumerate(names.items()):
            item = make(name, i)
            if category == "fruits_and_vegetables" and store == "panda":
                item["varieties"][0]["unit"] = "kg"
            (folder / "bronze" / store / f"{category}_raw.json").write_text(json.dumps([item]))
    (folder / "open_data").mkdir()
    record = {"gastat_id": "1", "item_name_ar": "موز", "item_name_en": "Banana", "Year": 2023, "unit_ar": "كجم", "Dec": "6.5", "Annual average": "6.4"}
    (folder / "open_data" / "reference_prices.json").write_text(json.dumps({"records": [record]}, ensure_ascii=False), encoding="utf-8")


def test_two_days(spark, tmp_path):
    _bronze(tmp_path)
    first = Run(spark, str(tmp_path), dt.date(2024, 1, 1), "dw_run")
    assert list(first.all(log=lambda _: None)) == ["silver", "beverages", "dairy", "produce", "enrich", "load"]
    run = Run(spark, str(tmp_path), dt.date(2024, 1, 2), "dw_run")
    for stage in (run.dairy, run.produce, run.load):
        stage()
    gold = lambda n: spark.read.parquet(str(tmp_path / "gold" / n)).collect()
    (drink,), (milk,), (fruit,), (ref,) = (gold(n) for n in ("beverages", "dairy", "produce", "reference"))
    assert (drink.match_tier, drink.price_metrics.avg_price, drink.price_metrics.price_diff) == ("exact_barcode", 6.1, 0.2)
    assert (milk.match_tier, milk.confidence_score, [h.date for h in milk.price_history]) == ("exact_barcode", 1.0, ["2024-01-01", "2024-01-02"])
    assert (fruit.gastat_key, fruit.commodity_root, fruit.current_pricing.gastat_benchmark_price, len(fruit.price_history)) == ("Banana", "banana", 6.5, 2)
    assert (ref.match_count, ref.matched_barcodes) == (1, [fruit.barcode])
    assert run.audit().count() == 0
    assert [r.change for r in run.dairy(dry_run=True).collect()] == ["same"]
    assert spark.table("dw_run.fct_price_snapshots").count() == 2 and spark.table("dw_run.dim_matched_products").count() == 1
    for name, row in (("beverages", drink), ("dairy", milk), ("produce", fruit), ("reference", ref)):
        (part,) = (tmp_path / "export" / name).glob("part-*") if run.export(name) else ()
        (out,) = json.loads(part.read_text())
        assert list(out) == list(row.asDict()) and ("stores_data" not in out or set(out["stores_data"]) == {"bindawood", "panda", "tamimi"})
    assert sorted((r.store, r.category, r.n, r.with_barcodes) for r in first.coverage().collect()) == sorted((r.store, r.category, r.n, r.with_barcodes) for r in run.coverage().collect())
    assert len(first.counted) == 9 and not run.counted


def test_branches_come_with_the_load_and_no_products_end_a_run(spark, tmp_path):
    from shelfspark.plans import warehouse

    _bronze(tmp_path)
    (tmp_path / "reference").mkdir()
    (tmp_path / "reference" / "a_branches.json").write_text(json.dumps([{"id": 1, "brand": "Big Shop", "LATITUDE": 24.5, "LONGITUDE": 46.5}]))
    run = Run(spark, str(tmp_path), dt.date(2024, 1, 1), "dw_branches")
    warehouse.create_tables(spark, "dw_branches")
    spark.sql("INSERT INTO dw_branches.dim_branches VALUES ('Big_Shop_1', 'Big Shop', 'Riyadh', 'One')")
    run.silver_of("panda")
    assert run.counted["panda", "beverages"] == {"n": 1, "with_barcodes": 1, "with_discount": 0, "with_size": 1}
    (tmp_path / "bronze" / "panda" / "dairy_and_eggs_raw.json").write_text("[]")
    (tmp_path / "bronze" / "panda" / "fruits_and_vegetables_raw.json").unlink()
    with pytest.raises(ValueError, match="no products found: panda, dairy_and_eggs"):
        run.silver_of("panda")
    assert spark.read.parquet(str(tmp_path / "silver" / "panda" / "dairy_and_eggs")).count() == 1
    with pytest.raises(Exception, match="gold"):  # noqa: B017 - no gold yet, but branches are done
        run.load()
    (row,) = spark.table("dw_branches.dim_branches").collect()
    assert (row.branch_key, row.latitude, row.longitude) == ("Big_Shop_1", 24.5, 46.5)


def test_stream(spark, tmp_path):
    from shelfspark.streaming.snapshots import stream_snapshots

    spark.sql("CREATE TABLE snap_stream (id string, price double, ts timestamp, snapshot_date date) USING parquet PARTITIONED BY (snapshot_date)")
    rows = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2), ("b", 3.0, 1)], "id string, price double, s int")
    rows.select("id", "price", F.timestamp_seconds("s").alias("ts"), F.lit(dt.date(2024, 1, 1)).alias("snapshot_date")).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("id string, price double, ts timestamp, snapshot_date date").parquet(str(tmp_path / "in"))
    stream_snapshots(source, "snap_stream", str(tmp_path / "check")).awaitTermination()
    assert sorted((r.id, r.price) for r in spark.table("snap_stream").collect()) == [("a", 2.0), ("b", 3.0)]
