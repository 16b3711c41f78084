"""Scans through fetchers that give pages from memory."""

import json

import pytest

from shelfspark.sources import remote
from shelfspark.sources.files import branch_files, write_export


def test_pages_until_the_count_and_partial_data_on_errors(spark):
    def fetch(query, offset, limit):
        if query == "broken" and offset >= 4:
            raise OSError("down")
        n = {"none": 0, "known": 5, "broken": 9, "long": 1000}[query]
        return {"items": [{"id": f"{query}{i}"} for i in range(offset, min(n, offset + limit))], "count": n}

    got = remote.scan_pages(spark, [("a", ["none", "known"]), ("b", ["broken"]), ("c", ["none"]), ("d", ["long"])], fetch, pages=3, size=2).collect()
    by = {c: [json.loads(r.item)["id"] for r in sorted(got, key=lambda r: (r.page, r.pos)) if r.category == c] for c in "abcd"}
    assert by == {"a": [f"known{i}" for i in range(5)], "b": [f"broken{i}" for i in range(4)], "c": [], "d": [f"long{i}" for i in range(6)]}
    assert {r.query for r in got if r.category == "a"} == {"known"}


def test_html_pages_until_nothing_new(spark):
    def page(*ids):
        return "".join(f'<script>{{"id":{i},"name":"P &amp; Q","varieties":[{{"id":1}}]}}</script>' for i in ids)

    def fetch(query, number):
        if query == "bad" and number == 2:
            raise OSError("down")
        pages = {"x": [page(1, 2), page(2, 3), page(3, 1), page(4)], "y": [page(9), "<html></html>", page(8)], "bad": [page(1)]}[query]
        return pages[number - 1]

    got = remote.scan_html(spark, [("a", ["x", "y"])], fetch).collect()
    assert [(r.query, r.page, json.loads(r.product)["id"]) for r in got] == [("x", 1, 1), ("x", 1, 2), ("x", 2, 2), ("x", 2, 3), ("y", 1, 9)]
    assert json.loads(got[0].product)["name"] == "P & Q"
    with pytest.raises(Exception, match="down"):
        remote.scan_html(spark, [("a", ["bad"])], fetch).collect()


def test_no_products_stop_a_run(spark):
    df = spark.createDataFrame([("a", 1)], "category string, x int")
    assert remote.require_products(df, ["a"]).count() == 1
    with pytest.raises(ValueError, match="no products found: b"):
        remote.require_products(df, ["a", "b"])
    with pytest.raises(ValueError, match="no products"):
        remote.require_products(df.limit(0))


def test_export_is_one_array_and_branches_are_read(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", [1.5])], "name string, x array<double>")
    write_export(df, str(tmp_path / "out"), ["name"])
    (part,) = (tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text()) == [{"name": "a", "x": [1.5]}, {"name": "b", "x": None}]
    (tmp_path / "a_branches.json").write_text(json.dumps([{"id": 1, "brand": "Big Shop", "LATITUDE": 1.5, "LONGITUDE": 2.0}]))
    (tmp_path / "b_branches.json").write_text("[]")
    (row,) = branch_files(spark, str(tmp_path / "*_branches.json")).collect()
    assert (row.id, row.brand, row.LATITUDE) == (1, "Big Shop", 1.5)


def test_variants_become_rows_and_are_counted(spark):
    from pyspark.sql import functions as F

    from shelfspark.plans import silver
    from shelfspark.schemas import BRONZE_TAMIMI

    variant = lambda i, mrp: {"id": i, "fullName": f"Juice {i} 200 ML", "barcodes": ["6281000000014"], "storeSpecificData": [{"mrp": mrp, "discount": "1"}]}
    items = [{"id": "1", "name": "Juice", "variants": [variant("a", "5"), variant("b", "6")]}, {"id": "2", "name": "Tea", "variant": variant("c", None)}, {"id": "3", "name": "Plain"}]
    raw = spark.createDataFrame(items, BRONZE_TAMIMI).withColumn("pos", F.col("id").cast("int"))
    rows = silver.tamimi(raw, F.lit("beverages"))
    assert sorted((r.id, r.price, r.discount_amount) for r in rows.collect()) == [("3", None, None), ("a", 4.0, 1.0), ("b", 5.0, 1.0), ("c", None, None)]
    (total,) = silver.counts(rows).collect()
    assert (total.n, total.with_barcodes, total.with_discount, total.with_size) == (4, 3, 2, 3)


def _records(n):
    import random

    rng = random.Random(n)
    odd = ['}', '{"', '\\', '"', "é{", "a]b", "\n", ",", "🙂", "\\\\", '\\"}']
    value = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(6)))
    return [{"id": str(i), "name": value() * (400 if i % 17 == 5 else 1), "x": [{"y": value()}, {"y": None}], "z": {"k": {}}} for i in range(n)]


SCHEMA = "id string, name string, x array<struct<y: string>>"


def _plain(rows):
    return [(r["id"], r["name"], [y["y"] for y in r["x"]], i) for i, r in enumerate(rows)]


@pytest.mark.parametrize("shape", ["bare", "pretty", "records", "trailing"])
def test_one_array_is_read_by_several_tasks(spark, tmp_path, shape):
    from shelfspark.sources.arrays import array_records
    from shelfspark.sources.files import json_array

    rows = _records(200)
    text = {
        "bare": json.dumps(rows, ensure_ascii=False), "pretty": json.dumps(rows, indent=2), "records": json.dumps({"records": rows, "n": 200, "meta": [{"id": "no"}]}),
        "trailing": ' { "products" : ' + json.dumps(rows, ensure_ascii=False, indent=1) + ', "more": [{}, {"a": [{"id": "no"}]}] } \n',
    }[shape]
    path = str(tmp_path / "rows.json")
    (tmp_path / "rows.json").write_text(text, encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("700b", "5000b", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            if size == "700b":
                assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 20
                assert array_records(spark, path) is not None
            got = sorted((r.pos, r.id, r.name, [y.y for y in r.x]) for r in json_array(spark, path, SCHEMA).collect())
            assert got == [(i, a, b, c) for a, b, c, i in _plain(rows)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_arrays_of_other_kinds(spark, tmp_path):
    from shelfspark.sources.files import json_array

    read = lambda text: [(r.id, r.pos) for r in (json_array(spark, str(tmp_path / "a.json"), "id string").orderBy("pos").collect() if (tmp_path / "a.json").write_text(text) else [])]
    assert read("[]") == [] and read('{"records": [ ]}') == []
    assert read('{"n": 1, "records": [{"id": "a"}]}') == [("a", 0)] and read('[{"id": 7}]') == [("7", 0)]
    for bad in ('[{"id": 1}, 5, {"id": 2}]', '[{"id": 1}, {"id": ', '[{"id": 1}, {"id": }]', '{"id": 1}', '[{"id": 1}'):
        with pytest.raises(Exception):  # noqa: B017 - Spark's or Python's own
            read(bad)


def test_export_of_maps_and_of_many_files(spark, tmp_path, monkeypatch):
    from shelfspark.sources import files

    df = spark.range(500).selectExpr("id", "map('a', struct(id AS v, CAST(NULL AS STRING) AS w)) AS stores_data", "array(id) AS l").repartition(7)
    expected = [{"id": i, "stores_data": {"a": {"v": i, "w": None}}, "l": [i]} for i in range(500)]
    for n in (files.EXPORT_ROWS, 100):
        monkeypatch.setattr(files, "EXPORT_ROWS", n)
        files.write_export(df, str(tmp_path / f"out{n}"), ["id"])
        parts = sorted((tmp_path / f"out{n}").glob("part-*"))
        assert json.loads("".join(p.read_text() for p in parts)) == expected and len(parts) == 1 + 500 // n
    files.write_export(df.limit(0), str(tmp_path / "none"), ["id"])
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == []


def test_category_parents_of_any_depth(spark):
    from pyspark.sql import functions as F

    from shelfspark.plans.silver import in_category_of_any_depth

    def chain(*slugs):
        node = None
        for s in reversed(slugs):
            node = {"id": len(s), "slug": s} | ({"parentCategory": node} if node is not None else {})
        return node

    rows = [
        (1, chain("a", "b", "c", "d", "e", " wanted "), []), (2, chain("a", "b"), [{"slug": "wanted"}]), (3, chain("a", "b", "c", "d", "e", "f", "g"), [5, "x"]),
        (4, chain(*"abcdefgh", "x" * 99, "y"), None), (5, None, None), (6, "wanted", {"slug": "wanted"}), (7, {"slug": "a", "parentCategory": "wanted"}, [{"id": "99"}]),
    ]
    df = spark.createDataFrame([(i, json.dumps(p), json.dumps(c)) for i, p, c in rows], "i long, p string, c string")
    raw = df.select("i", F.parse_json("p").alias("primaryCategory"), F.parse_json("c").alias("categories"))
    assert sorted(r.i for r in in_category_of_any_depth(raw, ["99"], ["wanted"]).collect()) == [1, 2, 4, 7]


def test_a_service_is_asked_for_what_is_needed(spark, tmp_path):
    from pyspark.sql import functions as F

    from shelfspark.sources.service import service

    log = str(tmp_path / "requests")
    goods = {"tea": [{"id": i, "brand": "A" if i % 5 == 0 else "B", "price": i} for i in range(23)], "milk": [{"id": 100, "brand": "A", "price": 1}], "none": []}

    def fetch(query, offset, limit, filters, fields):
        with open(log, "a") as f:
            f.write(json.dumps([query, offset, limit, filters, fields]) + "\n")
        if query == "broken" and offset >= 4:
            raise TimeoutError("gone")
        found = [x for x in goods.get(query, goods["tea"]) if all(x[k] in v for k, v in filters.items())]
        return {"items": [{k: x[k] for k in fields or x} for x in found[offset : offset + limit]], "count": len(found)}

    def asked():
        lines = [json.loads(x) for x in (tmp_path / "requests").read_text().splitlines()] if (tmp_path / "requests").exists() else []
        (tmp_path / "requests").unlink(missing_ok=True)
        return lines

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(service("shop", fetch, {"hot": ["none", "tea"], "dairy": ["milk"], "bad": ["broken"]}, size=4, per_task=2))
    read = lambda schema=None: (spark.read.schema(schema) if schema else spark.read).format("shop").load()
    rows = read().where("category IN ('hot', 'dairy')")
    assert rows.rdd.getNumPartitions() == 4
    assert [q[0] for q in asked()] == ["none", "tea", "milk"]
    got = sorted((r.category, r.page, r.pos, json.loads(r.item)["id"]) for r in rows.collect())
    assert got == [("dairy", 1, 0, 100), *[("hot", i // 4 + 1, i % 4, i) for i in range(23)]]
    every = asked()
    assert {q[0] for q in every} == {"tea", "milk"} and all(q[3:] == [{}, None] for q in every)
    few = read("category string, page int, id long, brand string").where("category = 'hot' AND brand = 'A'")
    assert sorted(r.id for r in few.collect()) == [0, 5, 10, 15, 20]
    less = asked()
    pages = lambda qs: [q for q in qs if q[0] == "tea" and q[2] == 4]
    assert len(pages(every)) >= 6 and 2 <= len(pages(less)) < 6 and all(q[3:] == [{"brand": ["A"]}, ["id", "brand"]] for q in less)
    bad = read().where("category = 'bad'").select("page", "error", F.col("item").isNull().alias("empty")).collect()
    assert sorted((r.page, r.error, r.empty) for r in bad if r.error) == [(2, "TimeoutError: gone", True), (3, "TimeoutError: gone", True), (5, "TimeoutError: gone", True)]
    assert sum(r.error is None for r in bad) == 4 and read().where("category = 'nothing'").count() == 0


def test_wide_pages_come_in_bounded_batches(spark):
    """400 pages of 100 kB are no batch of 40 MB; all their products are found."""
    import pandas as pd
    from pyspark.sql import functions as F

    from shelfspark.sources import files

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    product = '{"id":1,"name":"n","varieties":[{"id":2}]}'
    pages = spark.range(0, 400, 1, 1).select("id", F.concat(F.repeat(F.lit("x"), 100_000), F.lit(product)).alias("html"))
    assert files.embedded_products(pages).select("id").distinct().count() == 400
    found = pages.mapInPandas(lambda frames: (pd.DataFrame({"n": [int(f["html"].str.len().sum())]}) for f in frames), "n long")
    assert found.agg(F.max("n")).first()[0] < 8_000_000
