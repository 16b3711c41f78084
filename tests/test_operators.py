"""Operators against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import assign, dedupe, merge
from shelfspark.operators.components import connected_components
from shelfspark.plans import beverages


def test_components_match_a_plain_search(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100, 100), (None, 3)]
    parent = {n: n for e in edges if None not in e for n in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = dict(connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    assert got == {n: root(n) for n in parent}


def test_components_of_all_parts_are_long_paths(spark):
    from shelfspark.plans.catalogue import QUERIES

    sf = "/root/testdata/sf0.001"
    parts = {r[0] for r in spark.read.parquet(f"{sf}/part.parquet").select("p_partkey").collect()}

    def least(n):
        while n - 7 in parts:
            n -= 7
        return n

    expected = {n: least(n) for p in parts for n in (p, p + 7)}
    assert dict(QUERIES["components_all_parts"](spark, sf).select("node", "component").collect()) == expected
    assert max(list(expected.values()).count(c) for c in set(expected.values())) > 3


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_greedy_assignment_is_the_sequential_walk(spark):
    rng = random.Random(9)
    rows = [(i, f"a{rng.randint(0, 8)}", f"b{rng.randint(0, 8)}") for i in range(40)]
    used, expected = set(), []
    for i, a, b in rows:
        if not {a, b} & used:
            used |= {a, b}
            expected.append(i)
    got = assign.greedy_one_to_one(spark.createDataFrame(rows, "o int, a string, b string"), ["a", "b"], ["o"])
    assert sorted(r["o"] for r in got.collect()) == expected


def test_first_and_last_win(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 2, "y"), ("l", 3, "z")], "k string, pos int, v string")
    assert sorted(r["v"] for r in dedupe.first_wins(df, ["k"], ["pos"]).collect()) == ["x", "z"]
    assert sorted(r["v"] for r in dedupe.last_wins(df, ["k"], ["pos"]).collect()) == ["y", "z"]


def test_single_use_raises(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(Exception, match="more than once"):
        dedupe.assert_single_use(df, ["k"]).collect()


def test_null_keys_never_match_in_a_merge(spark):
    t = spark.createDataFrame([(None, "old"), ("1", "old")], "k string, v string")
    s = spark.createDataFrame([(None, "new"), ("1", "new"), ("2", "new")], "k string, v string")
    assert sorted((str(r["k"]), r["v"]) for r in merge.upsert(t, s, ["k"]).collect()) == [("1", "new"), ("2", "new"), ("None", "new"), ("None", "old")]


def test_history_replaces_the_day(spark):
    df = spark.createDataFrame([([("d1", 1.0), ("d2", 2.0)],), (None,)], "h array<struct<date: string, p: double>>")
    new = F.struct(F.lit("d1").alias("date"), F.lit(9.0).alias("p"))
    assert [[tuple(x) for x in r[0]] for r in df.select(merge.append_history("h", new)).collect()] == [[("d2", 2.0), ("d1", 9.0)], [("d1", 9.0)]]


def test_snapshot_day_is_replaced_and_cleared(spark):
    spark.sql("CREATE TABLE snap (v int, snapshot_date date) USING parquet PARTITIONED BY (snapshot_date)")
    one, two = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = lambda n: spark.range(n).select(F.col("id").cast("int").alias("v"))
    merge.replace_snapshot(spark, rows(3), "snap", one)
    merge.replace_snapshot(spark, rows(2), "snap", two)
    merge.replace_snapshot(spark, rows(1), "snap", two)
    assert dict(spark.table("snap").groupBy("snapshot_date").count().collect()) == {one: 3, two: 1}
    merge.replace_snapshot(spark, rows(0), "snap", two)
    assert dict(spark.table("snap").groupBy("snapshot_date").count().collect()) == {one: 3}


def test_cluster_tier_third_edge_overrides(spark):
    rows = [("exact_barcode", None, "gs1_prefix_match"), ("gs1_prefix_match", None, "near_barcode_package_match"), (None, None, None), (None, "near_barcode_package_match", "exact_barcode")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(beverages.cluster_tier(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["gs1_prefix_match", "gs1_prefix_match", "brand_package_token", "exact_barcode"]


def test_pair_edges_equal_the_theta_join(spark):
    rng = random.Random(2)
    words = ["lemon", "zero", "cola", "water", "mango"]
    rows = [
        (str(i), rng.choice(["bindawood", "panda", "tamimi"]), " ".join(rng.sample(words, 2)), rng.choice(["A", "B", None]), [f"6281000{rng.randint(0, 3)}{rng.randint(0, 9)}"], float(rng.randint(8, 14)), rng.choice([100.0, 103.0, 200.0]))
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "id string, store string, name_en string, brand string, barcodes array<string>, price double, total_size_value double")
    products = df.withColumns({"name_ar": F.lit(None).cast("string"), "pack_qty": F.lit(1), "size_unit": F.lit("ml"), "uid": F.concat_ws("_", "store", "id")})
    rank = F.array_position(F.array(F.lit("bindawood"), F.lit("panda"), F.lit("tamimi")), F.col("store"))
    featured = beverages.features(products.withColumn("ord", F.struct(rank.alias("store"), F.col("id").alias("pos"))))
    a, b = beverages.both_sides(featured, beverages._FEATURES)
    theta = a.crossJoin(b).where("a_ord.store < b_ord.store").where(beverages.compatible()).withColumn("tier", beverages.tier()).where("tier IS NOT NULL")
    expected = {tuple(r) for r in theta.select("a_uid", "b_uid", "tier").collect()}
    got = [tuple(r) for r in beverages.pair_edges(featured).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected
