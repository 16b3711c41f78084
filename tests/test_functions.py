"""Scalar vectors: value in, value out."""

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import barcode, numbers, similarity, size, text


def values(spark, rows, expr, ddl="t string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ddl)
    return [tuple(r[0]) if hasattr(r[0], "asDict") else r[0] for r in df.select(expr).collect()]


def T():
    return F.col("t")

BINDAWOOD = {
    "Milk 6 x 200 ml": (6, 200.0, 1200.0, "ml"),
    "500g x 2": (2, 500.0, 1000.0, "g"),
    "Cheese 24+4 Portions": (1, 28.0, 28.0, "slices"),
    "8 oz": (1, 226.8, 226.8, "g"),
    "12 fl oz": (1, 354.88, 354.88, "ml"),
    "10 pcs": (10, 10.0, 100.0, "pcs"),
    "5 layers": (1, 5000.0, 5000.0, "ml"),
    "30 eggs": (1, 30.0, 30.0, "pcs"),
}
TAMIMI = {
    "6 X 250-300 ML": (6, 300.0, 1800.0, "ml"),
    "250-300 ML": (1, 300.0, 300.0, "ml"),
    "24 Portions-336 G": (24, 14.0, 336.0, "g"),
    "1500Kg": (1, 1500.0, 1500.0, "g"),
    "2K": (1, 2000.0, 2000.0, "g"),
    "8Oz": (1, 226.8, 226.8, "g"),
    "30 eggs": (1, None, None, None),
    "500 gm": (1, 500.0, 500.0, "gm"),
}


def test_bindawood_sizes(spark):
    assert values(spark, list(BINDAWOOD), size.bindawood_size(T(), F.lit("dairy_and_eggs"))) == list(BINDAWOOD.values())
    assert values(spark, ["8 oz"], size.bindawood_size(T(), F.lit("beverages"))) == [(1, 236.59, 236.59, "ml")]


def test_tamimi_sizes(spark):
    assert values(spark, list(TAMIMI), size.tamimi_size(T())) == list(TAMIMI.values())


def test_panda_sizes(spark):
    none = F.lit(None).cast("struct<price:string>")
    assert values(spark, ["Cheese"], size.panda_size(T(), F.lit("400"), F.lit("gm"), none)) == [(1, 400.0, 400.0, "g")]
    kilo = F.struct(F.lit("5").alias("price"))
    assert values(spark, ["Apple"], size.panda_size(T(), F.lit("0.5"), F.lit("kg"), kilo)) == [(1, 1000.0, 1000.0, "g")]


@pytest.mark.parametrize("value,expected", [("2.675", 2.67), ("0.125", 0.12), ("10.075", 10.07), ("", None), ("x", None), ("-1.005", -1.0)])
def test_rounding_follows_the_exact_value(spark, value, expected):
    assert values(spark, [value], numbers.safe_float(T())) == [expected]


def test_rounding_agrees_with_python(spark):
    xs = [i / 1000 for i in range(-3000, 9000, 7)]
    assert values(spark, xs, numbers.round2(T()), "t double") == [round(x, 2) for x in xs]


def test_barcodes(spark):
    assert values(spark, ["628100000001", "1"], barcode.check_digit(T())) == ["4", ""]
    assert values(spark, ["https://x/628100000001_1.jpg?v=2", None], barcode.from_image(T())) == [
        ["0628100000001", "628100000001", "6281000000014"],
        [],
    ]
    assert values(spark, ["6281000000014", "6281000000015", "00000000", None], barcode.is_gtin(T())) == [True, False, False, False]
    assert values(spark, ["00628100000001"], barcode.with_short_form(F.array(T()))) == [["00628100000001", "628100000001"]]


def test_barcode_evidence(spark):
    def level(a, b):
        codes = [F.array(*[F.lit(c) for c in x]) for x in (a, b)]
        valid = [F.filter(c, barcode.is_gtin) for c in codes]
        return values(spark, [""], barcode.evidence(codes[0], valid[0], codes[1], valid[1]))[0]

    assert level(["6281000000014"], ["6281000000014"]) == 4
    assert level(["6281000000014"], ["06281000000014"]) == 3
    assert level(["6281000000014"], ["6281000000015"]) == 2
    assert level(["6281000000014"], ["6281000000025"]) == 0


def test_brands_and_roots(spark):
    assert values(spark, ["The Three Cows", "المراعي", None], text.dairy_brand(T())) == ["threecows", "almarai", "unbranded"]
    assert values(spark, ["Fresh Tomato 1kg", "sweet corn", "تفاح أحمر", "shredded"], text.commodity_root(T())) == ["tomatoes", "corn", "apple", None]


def test_tokens_map_before_fluff(spark):
    assert values(spark, ["Zero Lemon Drink can", None], text.core_tokens(T())) == [["diet_var", "lemon_flavor"], []]


def test_salt_rules_are_ordered(spark):
    from shelfspark.functions import tables

    assert values(spark, ["unsalted butter", "salted butter", "butter"], text.first_rule(T(), tables.ATTRIBUTES["salt"])) == ["unsalted", "salted", None]


def test_branch_price_prefers_any_sale(spark):
    rows = [({"1": (True, True, "10", "12"), "2": (True, True, "8", None)}, "1", "2"), ({"1": (False, True, "1", "2")}, "7", None), (None, None, None)]
    df = spark.createDataFrame(rows, "m map<string, struct<available: boolean, in_stock: boolean, price: string, original_price: string>>, p string, o string")
    got = [tuple(r[0]) for r in df.select(numbers.best_branch_price(F.col("m"), F.col("p"), F.col("o"))).collect()]
    assert got == [(10.0, 12.0, 2.0, 16.67), (7.0, None, None, None), (None, None, None, None)]


def test_kg_price(spark):
    assert values(spark, [6.0], numbers.kg_price(T(), F.lit(500.0), F.lit(None).cast("double"), F.lit("g")), "t double") == [12.0]


def test_sequence_ratio_is_the_library_one(spark):
    from difflib import SequenceMatcher

    pairs = [("orange juice", "juice orange"), ("", "a"), ("same", "same")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [r[0] for r in df.select(similarity.sequence_ratio("a", "b")).collect()] == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]
