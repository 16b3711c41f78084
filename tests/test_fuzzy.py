"""The fuzzy reference lookup against all pairs, and barcodes of stores."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from shelfspark.operators.similar import candidates, most_similar
from shelfspark.plans import benchmark


def _similar(a, b):
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    if a in b or b in a:
        return 0.9
    x, y = set(a.split(" ")), set(b.split(" "))
    return max(SequenceMatcher(None, a, b).ratio(), len(x & y) / len(x | y))


def test_fuzzy_lookup_equals_all_pairs(spark):
    rng = random.Random(6)
    words = ["tomato", "tomatos", "green", "red", "apple", "pineapple", "ab", "x", "onion", "onions", "dry", "local", "تفاح", "موز"]

    def name():
        out = " ".join(rng.sample(words, rng.randrange(0, 4)))
        if out and rng.random() < 0.5:
            at = rng.randrange(len(out))
            out = out[:at] + rng.choice("aeo") + out[at + 1 :]
        return " ".join(out.split())

    records = [(str(i), name(), name()) for i in range(40)]
    clusters = [(f"c{i}", name(), name(), name(), name(), rng.choice([None, "tomato", "apple"])) for i in range(40)]
    r = spark.createDataFrame(records, "record_id string, ar string, en string")
    c = spark.createDataFrame(clusters, "cluster_id string, product_name_en string, product_name_ar string, official_gastat_name_en string, official_gastat_name_ar string, commodity_root string")
    got = {(x.record_id, x.cluster_id): x.score for x in benchmark._fuzzy(r, c).collect()}
    longest = lambda t: min(((-len(w), w) for w in t.split()), default=(0, ""))[1]
    expected = {}
    for i, ar, en in records:
        for k, pe, pa, oe, oa, root in clusters:
            near = max(_similar(en, pe), _similar(ar, pa), _similar(en, oe), _similar(ar, oa))
            score = 0.7 * near + 0.3 * _similar(longest(en) or longest(ar), root or longest(pe) or longest(pa))
            if score >= 0.70:
                expected[i, k] = score
    assert set(got) == set(expected) and expected and all(abs(got[k] - v) < 1e-9 for k, v in expected.items())


def test_candidates_miss_nothing(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 9))).strip() for _ in range(70)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for threshold in (0.571, 0.8):
        got = {tuple(x) for x in candidates(df, df, threshold).collect()}
        assert {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if _similar(a, b) >= threshold} <= got
    pairs = df.alias("a").crossJoin(df.alias("b")).select(F.col("a.id"), F.col("b.id"), most_similar(F.col("a.text"), F.col("b.text"))).collect()
    assert all(_similar(texts[i], texts[j]) <= bound + 1e-9 for i, j, bound in pairs)


def test_barcodes_of_stores_go_first(spark):
    rows = [("own", {"a": (" 1 ", ["2", None, "1"]), "b": (None, None)}), ("own", {"a": (None, [])}), (None, {})]
    df = spark.createDataFrame(rows, "barcode string, stores_data map<string, struct<barcode: string, barcodes: array<string>>>")
    got = [r[0] for r in df.select(benchmark.cluster_barcodes(F.col("stores_data"), F.col("barcode"), benchmark._fields(df))).collect()]
    assert got == [["1", "2"], ["own"], []]
