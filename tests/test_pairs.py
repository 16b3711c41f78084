"""Pair joins and triangles against plain loops, with hot cells and hubs."""

import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import grid, triangles
from shelfspark.plans import dairy
from shelfspark.plans.matching import both_sides


def _near(x, y, ratio):
    known = lambda v: v is not None and 0 < v < float("inf")
    return not (known(x) and known(y)) or max(x, y) / min(x, y) <= ratio


@pytest.mark.parametrize("pairs", [20, 10_000_000])
def test_grid_equals_all_pairs(spark, pairs):
    rng = random.Random(7)
    odd = [None, 0.0, -1.0, float("nan"), float("inf")]
    value = lambda: rng.choice([*odd, *[rng.uniform(1, 40) for _ in range(12)]])
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), value(), value()) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, k string, x double, y double")
    a, b = both_sides(df, df.columns)
    axes = [grid.Axis("x", 1.2), grid.Axis("y", 1.5)]
    for n in (2, 1, 0):
        exact = F.col("a_id") < F.col("b_id")
        for axis in axes[:n]:
            x, y = F.col(f"a_{axis.column}"), F.col(f"b_{axis.column}")
            known = lambda c: F.coalesce((c > 0) & (c < float("inf")), F.lit(False))
            exact = exact & (~known(x) | ~known(y) | (F.greatest(x, y) / F.least(x, y) <= axis.ratio))
        got = [tuple(r) for r in grid.grid_join(a, b, ["k"], axes[:n], "id", exact, pairs).select("a_id", "b_id").collect()]
        expected = {
            (i, j) for i, k, *u in rows for j, m, *v in rows if i < j and k is not None and k == m and all(_near(p, q, ax.ratio) for p, q, ax in zip(u, v, axes[:n], strict=False))
        }
        assert len(got) == len(set(got)) and set(got) == expected
    assert grid.grid_join(a, b.limit(0), ["k"], axes, "id", F.lit(True)).count() == 0 == grid.grid_join(a.limit(0), b, ["k"], axes, "id", F.lit(True)).count()


def test_a_hot_cell_is_dealt_out(spark):
    df = spark.createDataFrame([(i, "hot", 5.0) for i in range(400)] + [(400, "cold", 5.0)], "id long, k string, x double")
    a, b = both_sides(df, df.columns)
    found = grid.grid_join(a, b, ["k"], [grid.Axis("x", 1.1)], "id", F.lit(True), pairs=4000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in found) == 160_001 and max(r["count"] for r in found) < 40_000


def test_triangles_of_a_hub_cost_little(spark):
    rng = random.Random(4)
    hub = [(0, i) for i in range(1, 400)]
    web = [(rng.randrange(1, 60), rng.randrange(1, 60)) for _ in range(400)]
    edges = [*hub, *web, (5, 5), (None, 3), (3, None), *[(b, a) for a, b in hub[:20]]]
    df = spark.createDataFrame(edges, "src long, dst long")
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {frozenset((a, b, c)) for a in near for b in near[a] for c in near[a] & near[b]}
    got = [frozenset(r) for r in triangles.triangles(df).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected
    n = sum(map(len, near.values())) // 2
    out = triangles.oriented(df, "src", "dst")
    assert out.count() == n and triangles.wedges(out).count() <= 2**0.5 * n**1.5 < 400 * 399 / 2
    assert triangles.triangles(df.limit(0)).count() == 0


def test_packed_attributes_tell_the_same_conflicts(spark):
    rng = random.Random(8)
    words = ["full fat", "low fat", "salted", "unsalted", "organic", "lactose free", "chocolate", "strawberry", "plain", "milk", "yogurt", "cheddar cheese", "large eggs", "uht", "sliced", "camel", "with lactose"]
    rows = [(str(i), " ".join(rng.sample(words, rng.randrange(1, 5))), rng.choice(["Almarai", "Nadec", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "uid string, name_en string, brand string").selectExpr(
        "uid", "name_en", "CAST(NULL AS STRING) AS name_ar", "brand", "'ml' AS size_unit", "1000.0D AS total_size_value", "1000.0D AS unit_size_value", "1 AS pack_qty", "array('6281000000014') AS barcodes"
    )
    profiled = dairy.profiles(df).select("uid", "attrs", "package")
    a, b = both_sides(profiled, profiled.columns)
    x, y = F.col("a_attrs"), F.col("b_attrs")
    known = sum((F.coalesce(x[k] == y[k], F.lit(False)).cast("int") for k in dairy.ATTRIBUTES if k not in dairy._NOT_SHARED), F.lit(0))
    pairs = a.crossJoin(b).select(
        "a_uid", "b_uid", dairy.conflicting(x, y).alias("clash"), (F.size(dairy.semantic_conflicts(x, y)) > 0).alias("named"), known.alias("shared"), "a_attrs", "b_attrs"
    )
    found = pairs.groupBy("clash", "named").count().collect()
    assert {(r.clash, r.named) for r in found} == {(True, True), (False, False)}


def test_a_brands_products_meet_only_those_they_may_be_tied_to(spark, monkeypatch):
    from shelfspark.plans import beverages
    from shelfspark.schemas import STORES

    rng = random.Random(3)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = []
    for i in range(450):
        name = " ".join(rng.sample(words[:9], rng.randrange(1, 4)) if i < 90 else rng.sample(words, 3))
        code = f"6281000{i % 2}{rng.randrange(200):04d}" if i < 90 else f"6281{rng.randrange(10_000):04d}{i:04d}"
        rows.append((f"{STORES[i % 3]}_{i}", STORES[i % 3], i % 3, i, name, "Brand", [code] if i % 7 else [code, f"9{code}"], 10.0, 1, 500.0, "ml"))
    df = spark.createDataFrame(rows, "uid string, store string, s int, pos int, name_en string, brand string, barcodes array<string>, price double, pack_qty int, total_size_value double, size_unit string")
    featured = beverages.features(df.withColumns({"name_ar": F.lit(None).cast("string"), "ord": F.struct(F.col("s").alias("store"), "pos")})).localCheckpoint()

    a, b = both_sides(featured, beverages._FEATURES)
    apart = ~F.coalesce(F.arrays_overlap("a_codes", "b_codes"), F.lit(False))
    theta = a.crossJoin(b).where((F.col("a_ord.store") < F.col("b_ord.store")) & beverages.compatible() & apart).withColumn("tier", beverages.tier())
    expected = sorted(tuple(r) for r in theta.where("tier IS NOT NULL").select("a_uid", "b_uid", "tier").collect())
    got = sorted(tuple(r) for r in beverages.brand_edges(featured).collect())
    assert got == expected and len({t for *_, t in got}) == 3

    met = []

    def counted(a, b, alike, axes, row, residual):
        met.append(grid.grid_join(a, b, alike, axes, row, F.col("a_store") < F.col("b_store")).count())
        return grid.grid_join(a, b, alike, axes, row, residual)

    monkeypatch.setattr(beverages, "grid_join", counted)
    beverages.brand_edges(featured)
    assert met[0] < 450 * 449 / 3 / 4


def test_leading_trios_decide_as_all_trios_do(spark):
    from shelfspark.schemas import STORES
    from shelfspark.storage import materialize

    rng = random.Random(11)
    # The first code is valid, the second isn't, the third has the first one's body.
    codes = ["6281000000014", "6281000000015", "6281000000028", "6281000000031"]
    rows = []
    for i in range(200):
        words = rng.sample(["alpha", "beta", "gamma", "delta", "omega"], rng.choice([1, 2, 3])) if i < 110 else ["kappa"]
        code = rng.choice(codes) if i < 110 and rng.random() < 0.25 else f"628{i:010d}"
        brand = rng.choice(["Almarai", "Almarai", "Nadec", None]) if i < 110 else f"brand{i % 9}"
        name = f"{rng.choice(['fresh', 'fresh', 'uht'])} full fat milk {' '.join(words)}"
        rows.append((f"{STORES[i % 3]}_{i}", STORES[i % 3], name, brand, [code], rng.choice([1000.0, 1000.0, 1010.0, None])))
    rows += [(f"{s}_x{i}", s, "fresh full fat milk sigma", "Hot", [f"629{i:010d}"], 1000.0) for i in range(120) for s in [STORES[i % 3]]]
    df = spark.createDataFrame(rows, "uid string, store string, name_en string, brand string, barcodes array<string>, total_size_value double").selectExpr(
        "*", "CAST(NULL AS STRING) AS name_ar", "'ml' AS size_unit", "total_size_value AS unit_size_value", "1 AS pack_qty"
    )
    profiled = materialize(dairy.profiles(df))
    every, leading = materialize(dairy.candidate_trios(materialize(dairy.pair_edges(profiled)), profiled)), materialize(dairy.leading_trios(profiled))
    assert leading.join(every, every.columns, "left_anti").count() == 0 and leading.count() == leading.distinct().count()
    assert leading.count() < 12_000 < 40**3 < every.count()
    rows_of = lambda frame: sorted(tuple(r) for r in frame.collect())
    (won, unsure), (won_of, unsure_of) = dairy.reciprocal_best(every), dairy.reciprocal_best(leading)
    assert rows_of(won_of) == rows_of(won) and rows_of(won) and rows_of(unsure_of) == rows_of(unsure) and len({r.tier for r in won.collect()}) > 1


def test_links_connect_what_all_pairs_connect(spark):
    from shelfspark.plans import beverages
    from shelfspark.schemas import STORES

    rng = random.Random(6)
    words = ["lemon", "zero", "cola", "water", "mango", "classic", "light"]
    rows = []
    for i in range(520):
        names = rng.sample(words, rng.randrange(1, 4))
        # Brands of sparse prices hold chains of products that only step by step reach one another.
        price = rng.choice([None, 0.0, float("nan"), float("inf")]) if rng.random() < 0.03 else 10 * 1.55 ** (rng.randrange(0, 64) / 8 + rng.choice([0, 1e-9, 0.06]))
        code = f"62810{rng.randrange(10**6):06d}" if i % 4 else f"628100{i % 7}{rng.randrange(10**4):04d}"
        brand = f"brand {i % 26}"
        rows.append((i, " ".join(names), brand, [code], price, rng.choice([1, 1, None, 6]), rng.choice([500.0, 510.0, 540.0, None, 0.0]), rng.choice(["ml", "ml", "g", None])))
    rows += [(1000 + i, "orange juice", "Hot", [f"9{i:010d}"], 10.0 + i % 3, 1, 500.0, "ml") for i in range(400)]
    df = spark.createDataFrame(rows, "pos long, name_en string, brand string, barcodes array<string>, price double, pack_qty int, total_size_value double, size_unit string").withColumns(
        {"name_ar": F.lit(None).cast("string"), "store": F.element_at(F.array(*[F.lit(s) for s in STORES]), (F.col("pos") % 3 + 1).cast("int"))}
    ).withColumns({"uid": F.concat_ws("_", "store", "pos"), "ord": F.struct((F.col("pos") % 3).alias("store"), "pos")})
    featured = beverages.features(df).localCheckpoint()

    def parts(edges):
        of = {}

        def root(x):
            while of.setdefault(x, x) != x:
                x = of[x]
            return x

        for a, b in edges:
            of[max(root(a), root(b))] = min(root(a), root(b))
        return {x: root(x) for x in of}

    every = [(r.a_uid, r.b_uid) for r in beverages.pair_edges(featured).select("a_uid", "b_uid").collect()]
    linked = [(r.a_uid, r.b_uid) for r in beverages.links(featured).collect()]
    assert parts(linked) == parts(every) and len(set(parts(every).values())) > 30
    hot = {f"{STORES[(1000 + i) % 3]}_{1000 + i}" for i in range(400)}
    assert sum(a in hot for a, _ in linked) < 600 < 50_000 < sum(a in hot for a, _ in every)
