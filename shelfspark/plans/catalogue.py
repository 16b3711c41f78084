"""Queries over the fixed test tables, with the DuckDB statement that must give the same rows.

Pseudo-catalogue: a part is a product of one of three stores, priced by its retail price.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.functions import barcode, numbers, similarity, size, tables, text
from shelfspark.operators import assign, dedupe, merge
from shelfspark.operators.components import connected_components
from shelfspark.plans import benchmark, beverages, dairy, produce
from shelfspark.schemas import STORES
from shelfspark.storage import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_STORE = "CASE p_partkey % 3 WHEN 0 THEN 'bindawood' WHEN 1 THEN 'panda' ELSE 'tamimi' END"


def _products(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as products: each three neighbours share a twelve-digit barcode and a size."""
    return _t(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.expr(_STORE).alias("store"),
        F.concat_ws("_", F.expr(_STORE), F.col("p_partkey").cast("string")).alias("uid"),
        F.struct(F.expr("p_partkey % 3").alias("store"), F.col("p_partkey").alias("pos")).alias("ord"),
        F.col("p_name").alias("name_en"),
        F.lit(None).cast("string").alias("name_ar"),
        F.col("p_brand").alias("brand"),
        F.array(F.concat(F.lit("62810"), F.lpad(F.expr("p_partkey div 3").cast("string"), 7, "0"))).alias("barcodes"),
        F.col("p_retailprice").alias("price"),
        F.lit(None).cast("double").alias("original_price"),
        F.lit(None).cast("double").alias("discount_amount"),
        F.lit(None).cast("double").alias("discount_percentage"),
        F.lit(1).alias("pack_qty"),
        F.expr("CAST((p_partkey div 3) % 50 + 1 AS DOUBLE)").alias("unit_size_value"),
        F.expr("CAST((p_partkey div 3) % 50 + 1 AS DOUBLE)").alias("total_size_value"),
        F.lit("g").alias("size_unit"),
        F.lit(None).cast("string").alias("image_url"),
    )


def _round2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def _exact2(x: str) -> str:
    """Rounding of the exact binary value to two decimals, half to even, as ``numbers.round2``."""
    big = "CAST(134217729 AS DOUBLE)"
    high = f"({x} * {big} - ({x} * {big} - {x}))"
    error = f"(({high} * 100 - {x} * 100) + ({x} - {high}) * 100)"
    half = f"{x} * 100 - floor({x} * 100) = CAST(0.5 AS DOUBLE)"
    return (
        f"(CASE WHEN {half} AND {error} > 0 THEN floor({x} * 100) + 1 WHEN {half} AND {error} < 0 THEN floor({x} * 100) "
        f"ELSE round_even({x} * 100, 0) END / 100)"
    )


# ---------------------------------------------------------------- projections and scalars


@_query(
    f"""
    SELECT CAST(p_partkey AS VARCHAR) AS id, {_STORE} AS store, lower(regexp_replace(p_brand, '[^a-zA-Z0-9]', '', 'g')) AS norm_brand,
      CASE WHEN p_name IS NULL OR p_name = '' THEN p_type ELSE p_name END AS name, split_part(p_name, ' ', 1) AS first_word,
      CAST(p_size AS DOUBLE) AS size, CASE WHEN p_size > 0 THEN p_retailprice END AS price
    FROM part WHERE p_name IS NOT NULL"""
)
def silver_projection(spark, sf):
    return _t(spark, sf, "part").where("p_name IS NOT NULL").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.expr(_STORE).alias("store"),
        text.beverage_brand(F.col("p_brand")).alias("norm_brand"),
        F.coalesce(text.or_none(F.col("p_name")), F.col("p_type")).alias("name"),
        text.first_word(F.col("p_name")).alias("first_word"),
        numbers.tolerant(F.col("p_size")).alias("size"),
        F.when(numbers.positive(F.col("p_size")).isNotNull(), F.col("p_retailprice")).alias("price"),
    )


@_query(
    """
    SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total
    FROM events GROUP BY event_type"""
)
def props_json(spark, sf):
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    return _t(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@_query("SELECT r_regionkey, r_name, CAST(r_regionkey AS VARCHAR) AS item FROM region")
def envelope_unwrap(spark, sf):
    """Records inside an object's ``records`` and plain arrays unwrap alike."""
    from shelfspark.sources.files import unwrap

    packed = _t(spark, sf, "region").select(
        "r_regionkey", "r_name",
        F.when(F.col("r_regionkey") % 2 == 0, F.to_json(F.struct(F.array("r_regionkey").alias("records")))).otherwise(F.to_json(F.array("r_regionkey"))).alias("j"),
    )
    return packed.select("r_regionkey", "r_name", F.variant_get(unwrap(F.parse_json("j")), "$[0]", "string").alias("item"))


@_query(
    """
    SELECT p_partkey, CAST(CASE p_size % 4 WHEN 0 THEN p_size WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 2 END AS INTEGER) AS pack_qty,
      CASE p_size % 4 WHEN 0 THEN 250.0 WHEN 1 THEN p_size * 1000.0 WHEN 2 THEN CAST(p_size AS DOUBLE) ELSE p_size * 1.0 END AS unit_size_value,
      CASE p_size % 4 WHEN 0 THEN 250.0 * p_size WHEN 1 THEN p_size * 1000.0 WHEN 2 THEN CAST(p_size AS DOUBLE) ELSE p_size * 2.0 END
        AS total_size_value,
      CASE p_size % 4 WHEN 0 THEN 'ml' WHEN 1 THEN 'ml' WHEN 2 THEN 'pcs' ELSE 'g' END AS size_unit
    FROM part"""
)
def size_parse(spark, sf):
    n = F.col("p_size").cast("string")
    words = (
        F.when(F.expr("p_size % 4 = 0"), F.concat(F.lit("Juice "), n, F.lit(" x 250 ML")))
        .when(F.expr("p_size % 4 = 1"), F.concat(F.lit("Water "), n, F.lit("L")))
        .when(F.expr("p_size % 4 = 2"), F.concat(F.lit("Farm "), n, F.lit(" eggs")))
        .otherwise(F.concat(F.lit("Tea "), n, F.lit("g x 2")))
    )
    named = _t(spark, sf, "part").select("p_partkey", words.alias("words"))
    return named.select("p_partkey", size.bindawood_size(F.col("words"), F.lit("beverages")).alias("s")).select("p_partkey", "s.*")


@_query(
    """
    SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'ml' WHEN 1 THEN 'g' WHEN 2 THEN 'pcs' WHEN 3 THEN 'gm' ELSE 'slices' END AS unit,
      p_size * CASE p_size % 5 WHEN 0 THEN 1000.0 WHEN 1 THEN 1000.0 ELSE 1.0 END AS value
    FROM part"""
)
def unit_normalise(spark, sf):
    raw = F.expr("CASE p_size % 5 WHEN 0 THEN 'ltr' WHEN 1 THEN 'kg' WHEN 2 THEN 'cans' WHEN 3 THEN 'gm' ELSE 'slice' END")
    unit, factor = size._standard(raw, tables.TAMIMI_UNITS)
    return _t(spark, sf, "part").select("p_partkey", unit.alias("unit"), (F.col("p_size") * factor).alias("value"))


_SIX = "CASE p_size % 6 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} WHEN 4 THEN {} ELSE {} END"


@_query(
    f"""
    SELECT p_partkey, CAST({_SIX.format("p_size", 1, "p_size", 1, 1, 1)} AS INTEGER) AS pack_qty,
      {_SIX.format("300.0", "300.0", _exact2("(CAST(336 AS DOUBLE) / p_size)"), "p_size * 1000.0", _exact2("(p_size * CAST(28.3495 AS DOUBLE))"), "NULL")} AS unit_size_value,
      {_SIX.format("300.0 * p_size", "300.0", "336.0", "p_size * 1000.0", _exact2("(p_size * CAST(28.3495 AS DOUBLE))"), "NULL")} AS total_size_value,
      {_SIX.format("'ml'", "'ml'", "'g'", "'g'", "'g'", "NULL")} AS size_unit
    FROM part"""
)
def tamimi_sizes(spark, sf):
    n = F.col("p_size").cast("string")
    forms = (("Juice ", " X 250-300 ML"), ("Juice 250-300 ML", None), ("Cheese ", " Portions-336 G"), ("Rice ", "K"), ("Cream ", "Oz"))
    words = F.concat(F.lit("Farm "), n, F.lit(" eggs"))
    for i, (before, after) in reversed(list(enumerate(forms))):
        words = F.when(F.col("p_size") % 6 == i, F.lit(before) if after is None else F.concat(F.lit(before), n, F.lit(after))).otherwise(words)
    named = _t(spark, sf, "part").select("p_partkey", words.alias("words"))
    return named.select("p_partkey", size.tamimi_size(F.col("words")).alias("s")).select("p_partkey", "s.*")


@_query(
    """
    SELECT p_partkey, CAST(CASE p_size % 4 WHEN 1 THEN p_size ELSE 1 END AS INTEGER) AS pack_qty,
      CASE p_size % 4 WHEN 0 THEN p_size * 1.0 WHEN 1 THEN 20.0 WHEN 2 THEN 1000.0 ELSE p_size * 1000.0 END AS unit_size_value,
      CASE p_size % 4 WHEN 0 THEN p_size * 1.0 WHEN 1 THEN p_size * 20.0 WHEN 2 THEN 1000.0 ELSE p_size * 1000.0 END AS total_size_value,
      CASE p_size % 4 WHEN 3 THEN 'ml' ELSE 'g' END AS size_unit
    FROM part"""
)
def panda_sizes(spark, sf):
    """Size fields, a multipack in the name, an offered kilogram, a size in the name."""
    k, n = F.col("p_size") % 4, F.col("p_size").cast("string")
    name = F.when(k == 1, F.concat(F.lit("Tea "), n, F.lit(" × 20 G"))).when(k == 3, F.concat(F.lit("Water "), n, F.lit(" Ltr"))).otherwise("Cheese")
    options = F.array(
        F.struct(F.lit("0.5").alias("quantity_value"), F.lit("0.5 KG").alias("quantity_name")), F.struct(F.lit("1").alias("quantity_value"), F.lit("1 KG").alias("quantity_name"))
    )
    raw = _t(spark, sf, "part").select("p_partkey", name.alias("name"), F.when(k == 0, n).alias("size"), F.when(k == 0, "gm").alias("unit"), (k == 2).alias("weighted"), options.alias("options"))
    s = size.panda_size(F.col("name"), F.col("size"), F.col("unit"), size.kilo_option(F.col("weighted"), F.col("options")))
    return raw.select("p_partkey", s.alias("s")).select("p_partkey", "s.*")


@_query(
    """
    SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n, CASE p_size % 3 WHEN 0 THEN p_size * 1.0 WHEN 1 THEN 3.0 END AS price
    FROM part"""
)
def weighted_options(spark, sf):
    """Two options of a weighed product, one beside an empty one, and those of a product that isn't weighed."""
    k = F.col("p_size") % 3
    kind = "struct<quantity_value:string,quantity_name:string,price:string,undiscounted_price:string>"
    option = lambda *v: F.struct(*[x.cast("string").alias(c) for x, c in zip(v, ("quantity_value", "quantity_name", "price", "undiscounted_price"), strict=True)]).cast(kind)
    none = F.lit(None)
    full = F.array(option(F.lit("1"), F.lit("1 KG"), F.col("p_size"), none), option(F.lit("2"), F.lit(" "), none, none))
    one = F.array(option(none, F.lit(" "), F.lit("x"), none), option(F.lit("0.5"), F.lit("half"), F.lit("3"), F.lit("4")))
    raw = _t(spark, sf, "part").select("p_partkey", (k < 2).alias("weighted"), F.when(k == 0, full).otherwise(one).alias("options"))
    clean = raw.select("p_partkey", size.weighted_options(F.col("weighted"), F.col("options")).alias("o"))
    return clean.select("p_partkey", F.size("o").alias("n"), F.get("o", F.lit(0))["price"].alias("price"))


@_query(
    f"""
    WITH l AS (SELECT *, l_extendedprice * l_discount AS off FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_discount,
      {_exact2("(l_extendedprice - off)")} AS price, CASE WHEN off > 0 THEN {_exact2("l_extendedprice")} END AS original_price,
      CASE WHEN off > 0 THEN {_exact2("off")} END AS amount, CASE WHEN off > 0 THEN {_exact2("(off / l_extendedprice * 100)")} END AS percentage
    FROM l"""
)
def retail_prices(spark, sf):
    """A price that is a listed one less a discount."""
    m = numbers.listed_price(F.col("l_extendedprice").cast("string"), (F.col("l_extendedprice") * F.col("l_discount")).cast("string"))
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount"]
    rows = _t(spark, sf, "lineitem").select(*keys, m.alias("m"))
    return rows.select(*keys, "m.price", "m.original_price", F.col("m.discount_amount").alias("amount"), F.col("m.discount_percentage").alias("percentage"))


@_query(
    """
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_partkey WHEN 1 THEN p_partkey ELSE -1 END AS id,
      CASE p_size % 4 WHEN 0 THEN 1234.5 WHEN 1 THEN 7.25 WHEN 2 THEN CAST(p_size AS DOUBLE) END AS price
    FROM part"""
)
def ids_and_reference_prices(spark, sf):
    """Ids as texts and numbers (-1: none); the first price that parses of four columns."""
    k, s = F.col("p_partkey"), F.col("p_size") % 4
    raw = F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.concat(F.lit(" "), k.cast("string"), F.lit(" "))).when(k % 4 == 2, F.concat(k.cast("string"), F.lit(".0"))).otherwise("x1")
    none = F.lit(None).cast("string")
    price = numbers.reference_price(F.when(s == 0, "1,234.50").otherwise(""), F.when(s == 1, "7.25").otherwise("-"), none, F.when(s == 2, F.col("p_size").cast("string")).otherwise(none))
    return _t(spark, sf, "part").select("p_partkey", F.coalesce(numbers.integer_id(raw), F.lit(-1)).alias("id"), price.alias("price"))


_DIGITS = "[CAST(x AS INTEGER) FOR x IN string_split(lpad(CAST(p_partkey AS VARCHAR), 12, '0'), '')]"
_CHECK = f"CAST((10 - (list_sum([{_DIGITS}[i] * CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END FOR i IN range(1, 13)]) % 10)) % 10 AS VARCHAR)"


@_query(f"SELECT p_partkey, {_CHECK} AS check_digit FROM part")
def barcode_checkdigit(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", barcode.check_digit(F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("check_digit"))


@_query(
    f"""
    WITH c AS (SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS code, {_CHECK} AS digit FROM part)
    SELECT p_partkey, array_to_string(list_sort(list_distinct([code, '0' || code, code || digit])), ',') AS codes FROM c"""
)
def image_barcodes(spark, sf):
    """Barcodes off the file name of an image."""
    url = F.concat(F.lit("https://x.example/628999999999/"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"), F.lit("_1.jpg?v=2"))
    return _t(spark, sf, "part").select("p_partkey", F.array_join(barcode.from_image(url), ",").alias("codes"))


@_query(
    f"""
    SELECT p_partkey, {_CHECK} = '7' AND p_partkey > 0 AS as_seven, p_partkey > 0 AS completed FROM part"""
)
def gtin_validity(spark, sf):
    """A code is valid with its own check digit and with no other."""
    body = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    return _t(spark, sf, "part").select(
        "p_partkey",
        barcode.is_gtin(F.concat(body, F.lit("7"))).alias("as_seven"),
        barcode.is_gtin(F.concat(body, barcode.check_digit(body))).alias("completed"),
    )


@_query(
    """
    SELECT left(code, 8) AS prefix, left(code, length(code) - 1) AS family, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT '628' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS code FROM part) GROUP BY ALL"""
)
def barcode_family(spark, sf):
    codes = barcode.canonical(F.array(F.concat(F.lit("00628"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))))
    rows = _t(spark, sf, "part").select(codes.alias("c"))
    return rows.select(F.explode(barcode.prefixes(F.col("c"))).alias("prefix"), "c").select(
        "prefix", F.explode(barcode.families(F.col("c"))).alias("family")
    ).groupBy("prefix", "family").agg(F.count("*").alias("n"))


@_query(
    """
    WITH c AS (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS short FROM part)
    SELECT code, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT lpad(short, 12, '0') AS code FROM c UNION ALL SELECT short FROM c WHERE length(short) >= 7) GROUP BY code"""
)
def explode_barcodes(spark, sf):
    rows = _t(spark, sf, "part").select(F.explode(barcode.with_short_form(F.array(F.lpad(F.col("p_partkey").cast("string"), 12, "0")))).alias("code"))
    return rows.groupBy("code").agg(F.count("*").alias("n"))


@_query(
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
      CASE WHEN l_discount > 0 THEN {_round2("l_extendedprice * l_discount")} END AS amount,
      {_round2("l_extendedprice / l_quantity")} AS unit_price
    FROM lineitem"""
)
def discount_metrics(spark, sf):
    off = F.col("l_extendedprice") * F.col("l_discount")
    r2 = lambda c: F.rint(c * 100) / 100
    return _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        F.when(F.col("l_discount") > 0, r2(off)).alias("amount"),
        r2(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


@_query(
    """
    SELECT l_returnflag AS store, CAST(count(*) AS BIGINT) AS n, CAST(count_if(l_discount > 0) AS BIGINT) AS with_discount,
      CAST(count_if(l_tax > 0) AS BIGINT) AS with_tax, round_even(count_if(l_discount > 0) * 100.0 / count(*) * 100, 0) / 100 AS coverage
    FROM lineitem GROUP BY l_returnflag"""
)
def conditional_counts(spark, sf):
    g = _t(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("store")).agg(
        F.count("*").alias("n"), F.count_if(F.expr("l_discount > 0")).alias("with_discount"), F.count_if(F.expr("l_tax > 0")).alias("with_tax")
    )
    return g.withColumn("coverage", dedupe.coverage(F.col("with_discount"), F.col("n")))


@_query(
    f"""
    WITH b AS (
      SELECT l_partkey, l_suppkey, min(l_extendedprice / l_quantity) AS x, max(l_discount) AS off FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN off >= 0.1 THEN 0 ELSE 1 END, x, l_suppkey) AS i FROM b),
    c AS (SELECT l_partkey, x, CASE WHEN off >= 0.1 THEN x + 1 END AS y FROM r WHERE i = 1)
    SELECT l_partkey, {_exact2("x")} AS price, {_exact2("y")} AS original_price FROM c"""
)
def best_branch_price(spark, sf):
    """Suppliers as branches; a branch with a discount of a tenth sells a unit below its original price."""
    branch = _t(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.max("l_discount").alias("off")
    )
    entry = F.struct(
        F.lit(True).alias("available"), F.lit(None).cast("boolean").alias("in_stock"), F.col("price").cast("string").alias("price"),
        F.when(F.col("off") >= 0.1, (F.col("price") + 1).cast("string")).alias("original_price"),
    )
    per = branch.groupBy("l_partkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("l_suppkey").alias("k"), entry.alias("v"))))).alias("m"))
    none = F.lit(None).cast("string")
    return per.select("l_partkey", numbers.best_branch_price(F.col("m"), none, none).alias("b")).select("l_partkey", "b.price", "b.original_price")


# ---------------------------------------------------------------- tokens and rules

_TOKENS = "list_sort(list_distinct(regexp_extract_all(lower(p_name), '[a-z]{3,}')))"


@_query(
    f"""
    WITH t AS (SELECT p_partkey, {_TOKENS} AS w FROM part), n AS (SELECT p_partkey, w, lead(w) OVER (ORDER BY p_partkey) AS v FROM t)
    SELECT p_partkey, CASE WHEN least(len(w), len(v)) > 0 THEN len(list_intersect(w, v)) / least(len(w), len(v)) ELSE 0.0 END AS overlap,
      2.0 * len(list_intersect(w, v)) / (len(w) + len(v)) AS dice, len(list_intersect(w, v)) / len(list_distinct(list_concat(w, v))) AS jaccard
    FROM n WHERE v IS NOT NULL"""
)
def token_overlap(spark, sf):
    t = _t(spark, sf, "part").select("p_partkey", text.core_tokens(F.col("p_name")).alias("w"))
    nxt = t.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("w").alias("v"))
    w, v = F.col("w"), F.col("v")
    return t.join(nxt, "p_partkey").select(
        "p_partkey", text.overlap_coefficient(w, v).alias("overlap"), text.dice(w, v).alias("dice"), text.jaccard(w, v).alias("jaccard")
    )


_RULES = (("polished", "polish|burnish"), ("metal", r"\b(?:steel|brass|copper|tin|nickel)\b"), ("small", r"\bsmall\b"), ("large", "large|econ"))


@_query(
    """
    SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type || ' ' || p_name), 'polish|burnish') THEN 'polished'
      WHEN regexp_matches(lower(p_type || ' ' || p_name), '\\b(?:steel|brass|copper|tin|nickel)\\b') THEN 'metal'
      WHEN regexp_matches(lower(p_type || ' ' || p_name), '\\bsmall\\b') THEN 'small'
      WHEN regexp_matches(lower(p_type || ' ' || p_name), 'large|econ') THEN 'large' END AS class
    FROM part"""
)
def rule_classify(spark, sf):
    words = F.lower(F.concat_ws(" ", "p_type", "p_name"))
    return _t(spark, sf, "part").select("p_partkey", text.first_rule(words, _RULES).alias("class"))


@_query(
    """
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'tomatoes' WHEN 1 THEN 'pepper' WHEN 2 THEN 'apple' WHEN 3 THEN 'corn'
      WHEN 4 THEN 'green_beans' END AS root FROM part"""
)
def commodity_roots(spark, sf):
    names = ("Cherry TOMATO, red", "sweet chili-pepper", "apple", "SweetCorn can", "green beans", "mangosteen")
    raw = F.try_element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return _t(spark, sf, "part").select("p_partkey", text.commodity_root(raw).alias("root"))


@_query(
    """
    SELECT doc_id, length(regexp_replace(regexp_replace(text, '[\\x20\\t-\\r\\x{A0}\\x{2028}\\x{2029}\\x{85}\\x1C-\\x1F]+', ' ', 'g'), '^ | $', '', 'g'))
      AS n_chars FROM documents WHERE text IS NOT NULL"""
)
def squeeze_text(spark, sf):
    return _t(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.length(text.squeeze(F.col("text"))).cast("long").alias("n_chars"))


@_query()
def nfkc_normalise(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.length(text.dairy_text(F.col("text"))).alias("n_chars"))


@_query()
def name_similarity(spark, sf):
    """Character ratio of neighbouring parts' names, and the larger of it and the overlap."""
    p = _t(spark, sf, "part").select("p_partkey", similarity.letters_only(F.col("p_name"), F.lit(None).cast("string")).alias("a"))
    nxt = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    a, b = F.col("a"), F.col("b")
    return p.join(nxt, "p_partkey").select(
        "p_partkey", similarity.sequence_ratio(a, b).alias("ratio"), similarity.full_name_similarity(a, b).alias("similarity"),
        similarity.text_similarity(a, b).alias("composite"),
    )


@_query()
def html_json_extract(spark, sf):
    """Products embedded in pages; each page gets a script that holds one."""
    from shelfspark.sources.files import embedded_products

    script = F.concat(
        F.lit('<script>{\\"page\\":{\\"id\\":'), F.col("page_id").cast("string"),
        F.lit(',\\"name\\":\\"P &amp; Q\\",\\"varieties\\":[{\\"id\\":1}]}}</script>'),
    )
    pages = _t(spark, sf, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), script).alias("html"))
    found = embedded_products(pages).select("page_id", F.parse_json("product").alias("p"))
    return found.select("page_id", F.variant_get("p", "$.id", "bigint").alias("product_id"), F.variant_get("p", "$.name", "string").alias("name"))


# ---------------------------------------------------------------- raw records to silver


def _percent(amount: str, whole: str) -> str:
    return f"({amount}) / ({whole}) * 100"


@_query(
    f"""
    WITH v AS (
      SELECT p_partkey AS pos, 0 AS i, 'v' || p_partkey AS id, p_name AS title, p_brand AS brand, '0062810' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS code,
        p_partkey % 5 = 0 AS weighed, p_partkey % 3 = 0 AS arabic, p_size AS size,
        CASE WHEN p_partkey % 5 = 0 THEN p_retailprice * 2 ELSE p_retailprice END AS now,
        CASE WHEN p_partkey % 5 = 0 THEN p_retailprice * 2 + 10 WHEN p_partkey % 2 = 0 THEN p_retailprice + 25.5 ELSE p_retailprice END AS then_ FROM part
      UNION ALL
      SELECT p_partkey, 1, 'v' || (p_partkey + 1), p_name, p_brand, '7', false, p_partkey % 3 = 0, p_size, CAST(1.5 AS DOUBLE), CAST(NULL AS DOUBLE) FROM part WHERE p_partkey % 7 = 0),
    w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos, i) AS place FROM v) WHERE place = 1),
    r AS (SELECT *, {_exact2("now")} AS price, {_exact2("then_")} AS original_price FROM w),
    d AS (SELECT *, CASE WHEN original_price > price THEN original_price - price END AS less FROM r),
    a AS (SELECT *, {_exact2("less")} AS discount_amount FROM d),
    q AS (SELECT *, {_percent("discount_amount", "original_price")} AS part FROM a)
    SELECT id, CASE WHEN NOT arabic THEN title END AS name_en, CASE WHEN arabic THEN title END AS name_ar, brand, CASE WHEN code = '7' THEN code ELSE code || ',' || ltrim(code, '0') END AS barcodes,
      price, original_price, discount_amount, {_exact2("part")} AS discount_percentage, CAST(CASE WHEN weighed THEN 1000 ELSE size END AS DOUBLE) AS total_size_value, 'g' AS size_unit, weighed AS is_weighted
    FROM q"""
)
def silver_panda(spark, sf):
    """Parts as one retailer's raw records: varieties, weighed ones with a 1 kg option, repeated ids, two locales."""
    from shelfspark.plans import silver

    s = lambda c: c.cast("string")
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    option = F.struct(
        F.lit("1").alias("quantity_value"), F.lit("1 KG").alias("quantity_name"), s(price * 2).alias("price"), s(price * 2 + 10).alias("undiscounted_price")
    )
    none = F.array().cast("array<struct<quantity_value:string,quantity_name:string,price:string,undiscounted_price:string>>")

    def variety(i, code, now, before, weighed):
        return F.struct(
            F.lit(None).cast("string").alias("id"), F.concat(F.lit("v"), s(i)).alias("sku"), F.lit(None).cast("string").alias("description"), code.alias("barcode"),
            s(now).alias("price"), s(before).alias("undiscounted_price"), s(F.col("p_size")).alias("size"), F.lit("g").alias("unit"), weighed.alias("wighted"),
            F.lit(None).cast("string").alias("weighted_interval"), F.when(weighed, F.array(option)).otherwise(none).alias("weighted_options"),
            F.lit(None).cast("string").alias("imageURL"), F.array().cast("array<string>").alias("images"),
        )

    own = variety(
        key, F.concat(F.lit("0062810"), F.lpad(s(key), 7, "0")), price, F.when(key % 2 == 0, price + 25.5).otherwise(price), key % 5 == 0
    )
    other = variety(key + 1, F.lit("7"), F.lit(1.5), F.lit(None).cast("double"), F.lit(False))
    raw = _t(spark, sf, "part").select(
        s(key).alias("id"), F.col("p_name").alias("name"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.when(key % 3 == 0, "ar").otherwise("en").alias("_source_locale"),
        F.when(key % 7 == 0, F.array(own, other)).otherwise(F.array(own)).alias("varieties"), key.alias("pos"),
    )
    rows = silver.panda(raw, F.lit("beverages"))
    return rows.select(
        "id", "name_en", "name_ar", "brand", F.array_join("barcodes", ",").alias("barcodes"), "price", "original_price", "discount_amount", "discount_percentage", "total_size_value", "size_unit", "is_weighted"
    )


@_query(
    f"""
    WITH v AS (
      SELECT 't' || p_partkey || CASE WHEN p_partkey % 4 = 0 THEN 'a' ELSE '' END AS id, p_partkey, p_name || ' ' || p_size || ' ML' AS name_en, p_brand AS brand, p_retailprice AS mrp,
        CASE WHEN p_partkey % 2 = 0 THEN 10.25::DOUBLE ELSE 0 END AS less, p_size FROM part WHERE p_partkey % 6 <> 1
      UNION ALL SELECT 't' || p_partkey || 'b', p_partkey, p_name || ' ' || p_size || ' ML', p_brand, p_retailprice + 1, 10.25, p_size FROM part WHERE p_partkey % 4 = 0 AND p_partkey % 6 <> 1),
    r AS (SELECT *, mrp - less AS paid, {_percent("less", "mrp")} AS part FROM v)
    SELECT id, name_en, brand, {_exact2("paid")} AS price, CASE WHEN less > 0 THEN {_exact2("mrp")} END AS original_price, CASE WHEN less > 0 THEN less END AS discount_amount,
      CASE WHEN less > 0 THEN {_exact2("part")} END AS discount_percentage, CAST(p_size AS DOUBLE) AS total_size_value, 'ml' AS size_unit FROM r"""
)
def silver_tamimi(spark, sf):
    """Parts as one retailer's raw records: listed prices less discounts, two variants for some, some without a name."""
    from shelfspark.plans import silver

    s = lambda c: c.cast("string")
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    nameless = key % 6 == 1
    sized = F.concat(s(F.col("p_size")), F.lit(" ML"))

    def variant(mark, mrp, less):
        return F.struct(
            F.concat(F.lit("t"), s(key), mark).alias("id"), sized.alias("name"), F.when(~nameless, F.concat_ws(" ", "p_name", sized)).alias("fullName"),
            F.array().cast("array<string>").alias("barcodes"), F.array().cast("array<string>").alias("images"), F.array(F.struct(s(mrp).alias("mrp"), s(less).alias("discount"))).alias("storeSpecificData"),
        )

    less = F.when(key % 2 == 0, 10.25).otherwise(0.0)
    one, two = variant(F.when(key % 4 == 0, "a").otherwise(""), price, less), variant(F.lit("b"), price + 1, F.lit(10.25))
    raw = _t(spark, sf, "part").select(
        s(key).alias("id"), F.lit("").alias("name"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.when(key % 4 != 0, one).alias("variant"),
        F.when(key % 4 == 0, F.array(one, two)).alias("variants"), key.alias("pos"),
    )
    rows = silver.tamimi(raw, F.lit("beverages"))
    return rows.select("id", "name_en", "brand", "price", "original_price", "discount_amount", "discount_percentage", "total_size_value", "size_unit")


@_query(
    f"""
    WITH v AS (
      SELECT 'm' || p_partkey AS id, p_name || ' ' || p_size || ' g' AS name_en, CASE WHEN p_partkey % 5 = 0 THEN string_split(p_name, ' ')[1] ELSE p_brand END AS brand, p_size,
        CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 5 WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE p_retailprice + 5 END AS now,
        CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 9 END AS then_ FROM part),
    r AS (SELECT *, {_exact2("now")} AS price, {_exact2("then_")} AS original_price FROM v), d AS (SELECT *, original_price - price AS less FROM r),
    a AS (SELECT *, {_exact2("less")} AS discount_amount FROM d), q AS (SELECT *, {_percent("discount_amount", "original_price")} AS part FROM a)
    SELECT id, name_en, brand, price, original_price, discount_amount, {_exact2("part")} AS discount_percentage, CAST(p_size AS DOUBLE) AS total_size_value, 'g' AS size_unit FROM q"""
)
def silver_bindawood(spark, sf):
    """Parts as one retailer's raw records: prices by branch, one of them closed for half of the parts, brands told by the name."""
    from shelfspark.plans import silver

    s = lambda c: c.cast("string")
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    branch = lambda open_, now, before: F.struct(open_.alias("available"), F.lit(None).cast("boolean").alias("in_stock"), s(now).alias("price"), s(before).alias("original_price"))
    null = F.lit(None).cast("string")
    raw = _t(spark, sf, "part").select(
        s(key).alias("objectID"), F.concat(F.lit("m"), s(key)).alias("master_id"), F.concat_ws(" ", "p_name", s(F.col("p_size")), F.lit("g")).alias("full_name_en"), null.alias("name_en"),
        null.alias("full_name_ar"), null.alias("name_ar"), F.when(key % 5 != 0, F.col("p_brand")).alias("brand_en"), F.lit("").alias("brand_ar"), null.alias("image"),
        F.array().cast("array<string>").alias("barcodes"), F.lit("1").alias("price"), null.alias("original_price"),
        F.create_map(
            F.lit("a"), branch(F.lit(None).cast("boolean"), price + 5, F.when(key % 3 == 0, price + 9)), F.lit("b"), branch(key % 2 == 0, price, F.lit(None).cast("double"))
        ).alias("inventory_modifiers"), key.alias("pos"),
    )
    rows = silver.bindawood(raw, F.lit("dairy_and_eggs"))
    return rows.select("id", "name_en", "brand", "price", "original_price", "discount_amount", "discount_percentage", "total_size_value", "size_unit")


# ---------------------------------------------------------------- dedupe, windows, aggregates

_LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _dedupe_sql(direction: str) -> str:
    by = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {by}) AS i FROM lineitem) WHERE i = 1"""


@_query(_dedupe_sql("ASC"))
def dedupe_first_wins(spark, sf):
    rows = dedupe.first_wins(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@_query(_dedupe_sql("DESC"))
def dedupe_last_wins(spark, sf):
    rows = dedupe.last_wins(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@_query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS i FROM orders) WHERE i = 1"""
)
def qualify_best(spark, sf):
    return dedupe.qualify_best(_t(spark, sf, "orders"), ["o_custkey"], "o_totalprice", ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@_query(
    """
    SELECT p_brand, p_partkey, CAST(i AS INTEGER) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS i FROM part) WHERE i <= 3"""
)
def top_three(spark, sf):
    order = [F.desc("p_retailprice"), F.col("p_partkey")]
    w = Window.partitionBy("p_brand").orderBy(*order)
    return dedupe.top_n(_t(spark, sf, "part"), ["p_brand"], order, 3).withColumn("place", F.row_number().over(w)).select("p_brand", "p_partkey", "place")


@_query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey LIMIT 20"""
)
def topn_latest(spark, sf):
    return _t(spark, sf, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_custkey", "o_totalprice")


@_query(
    """
    SELECT min(o_orderdate) AS first_day, max(o_orderdate) AS last_day, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers,
      CAST(count(*) AS BIGINT) AS n, (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS lines FROM orders"""
)
def snapshot_summary(spark, sf):
    lines = _t(spark, sf, "lineitem").agg(F.count("*").alias("lines"))
    return _t(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"), F.count_distinct("o_custkey").alias("customers"), F.count("*").alias("n")
    ).join(F.broadcast(lines))  # one row a side


@_query(
    """
    SELECT o_custkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS VARCHAR) AS day, max(o_totalprice) AS price FROM orders
    WHERE strftime(o_orderdate, '%Y-%m-%d') <> '1997-01-01' GROUP BY ALL
    UNION ALL SELECT DISTINCT o_custkey, '1997-01-01', 0.0 FROM orders"""
)
def history_append(spark, sf):
    """Each customer's days as a history; one day is replaced by a new entry at the end."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    days = _t(spark, sf, "orders").groupBy("o_custkey", day.alias("date")).agg(F.max("o_totalprice").alias("price"))
    kept = days.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("date", "price"))).alias("history"))
    new = F.struct(F.lit("1997-01-01").alias("date"), F.lit(0.0).alias("price"))
    return kept.select("o_custkey", F.explode(merge.append_history("history", new)).alias("h")).select("o_custkey", F.col("h.date").alias("day"), "h.price")


# ---------------------------------------------------------------- matching

_PART_SQL = f"""
p AS (
  SELECT {_STORE} || '_' || CAST(p_partkey AS VARCHAR) AS uid, {_STORE} AS store, p_partkey % 3 AS ord, p_partkey, p_brand AS brand, p_retailprice AS price,
    CAST((p_partkey // 3) % 50 + 1 AS DOUBLE) AS size, p_partkey // 3 AS code, left('62810' || lpad(CAST(p_partkey // 3 AS VARCHAR), 7, '0'), 8) AS prefix,
    left('62810' || lpad(CAST(p_partkey // 3 AS VARCHAR), 7, '0'), 11) AS family, {_TOKENS} AS tokens
  FROM part)"""
_PRODUCT_SQL = f"""{_PART_SQL},
e AS (
  SELECT a.uid AS a_uid, b.uid AS b_uid, a.ord AS a_ord, b.ord AS b_ord,
    CASE WHEN a.code = b.code THEN 'exact_barcode'
      WHEN a.brand = b.brand AND a.prefix = b.prefix AND len(list_intersect(a.tokens, b.tokens)) / least(len(a.tokens), len(b.tokens)) >= 0.4
        THEN 'gs1_prefix_match'
      WHEN a.brand = b.brand AND a.prefix = b.prefix AND a.family = b.family THEN 'near_barcode_package_match'
      WHEN a.brand = b.brand AND a.prefix <> b.prefix AND len(list_intersect(a.tokens, b.tokens)) / least(len(a.tokens), len(b.tokens)) >= 0.6
        THEN 'brand_package_token' END AS tier
  FROM p a JOIN p b ON a.ord < b.ord AND greatest(a.price, b.price) / least(a.price, b.price) <= 1.55
    AND abs(a.size - b.size) / greatest(a.size, b.size) <= 0.05)
"""


@_query(f"WITH {_PRODUCT_SQL} SELECT a_uid, b_uid, tier FROM e WHERE tier IS NOT NULL")
def pair_edges(spark, sf):
    return beverages.pair_edges(materialize(beverages.features(_products(spark, sf))))


_PATHS_SQL = "SELECT p_partkey AS src, CASE WHEN p_partkey % 10 = 9 THEN p_partkey ELSE p_partkey + 1 END AS dst FROM part"


@_query(
    f"""
    WITH RECURSIVE e AS ({_PATHS_SQL}), n AS (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e),
    r AS (SELECT DISTINCT src AS node, src AS seen FROM n UNION SELECT r.node, n.dst FROM r JOIN n ON r.seen = n.src)
    SELECT node, min(seen) AS component FROM r GROUP BY node"""
)
def components(spark, sf):
    """Paths of ten over all parts, short enough for recursive SQL; a path's last part has an edge to itself."""
    key = F.col("p_partkey")
    return connected_components(_t(spark, sf, "part").select(key.alias("src"), F.when(key % 10 == 9, key).otherwise(key + 1).alias("dst")))


@_query()
def components_all_parts(spark, sf):
    """Seven long paths over all parts; recursive SQL is quadratic in a path's length."""
    return connected_components(_t(spark, sf, "part").select(F.col("p_partkey").alias("src"), (F.col("p_partkey") + 7).alias("dst")))


_TRIO_SQL = f"""{_PART_SQL},
x AS MATERIALIZED (
  SELECT a.uid AS a_uid, b.uid AS b_uid, a.ord AS a_ord, b.ord AS b_ord
  FROM p a JOIN p b ON a.code = b.code AND a.ord < b.ord AND greatest(a.price, b.price) / least(a.price, b.price) <= 1.55
    AND abs(a.size - b.size) / greatest(a.size, b.size) <= 0.05),
t AS (
  SELECT b.uid AS bindawood, q.uid AS panda, m.uid AS tamimi, b.price AS p0, q.price AS p1, m.price AS p2
  FROM x bp JOIN x bt ON bp.a_uid = bt.a_uid AND bp.b_ord = 1 AND bt.b_ord = 2 AND bp.a_ord = 0
  JOIN x pt ON pt.a_uid = bp.b_uid AND pt.b_uid = bt.b_uid
  JOIN p b ON b.uid = bp.a_uid JOIN p q ON q.uid = bp.b_uid JOIN p m ON m.uid = bt.b_uid)
"""


def _exact_trios(spark, sf) -> DataFrame:
    """Triangles of exact barcode edges."""
    products = _products(spark, sf)
    return beverages.triangles(materialize(beverages.code_edges(beverages.features(products))), products.select("uid", "price"))


@_query(f"WITH {_TRIO_SQL} SELECT * FROM t")
def trio_candidates(spark, sf):
    return _exact_trios(spark, sf)


@_query(
    f"""
    WITH {_TRIO_SQL} SELECT bindawood, panda, tamimi, round_even((p0 + p1 + p2) / 3 * 100, 0) / 100 AS avg_price, least(p0, p1, p2) AS min_price,
      greatest(p0, p1, p2) AS max_price, round_even((greatest(p0, p1, p2) - least(p0, p1, p2)) * 100, 0) / 100 AS price_diff FROM t"""
)
def price_metrics(spark, sf):
    m = numbers.price_metrics(F.array("p0", "p1", "p2"))
    return _exact_trios(spark, sf).select(*STORES, m.alias("m")).select(*STORES, "m.*")


_WINNER_SQL = """
b AS (SELECT p_brand AS brand, p_partkey AS k, p_retailprice AS price, p_partkey % 3 AS s FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY brand, s ORDER BY price DESC, k) AS i FROM b),
c AS (SELECT x.k AS bindawood, y.k AS panda, z.k AS tamimi, x.price + y.price + z.price AS score
  FROM r x JOIN r y ON x.brand = y.brand AND x.s = 0 AND y.s = 1 JOIN r z ON x.brand = z.brand AND z.s = 2 WHERE x.i <= 3 AND y.i <= 3 AND z.i <= 3)
"""


def _brand_trios(spark, sf) -> DataFrame:
    best = dedupe.top_n(_t(spark, sf, "part").withColumn("s", F.expr("p_partkey % 3")), ["p_brand", "s"], [F.desc("p_retailprice"), F.col("p_partkey")], 3)
    out = None
    for i, s in enumerate(STORES):
        own = best.where(F.col("s") == i).select("p_brand", F.col("p_partkey").alias(s), F.col("p_retailprice").alias(f"p{i}"))
        out = own if out is None else out.join(own, "p_brand")
    return out.select("p_brand", *STORES, (F.col("p0") + F.col("p1") + F.col("p2")).alias("score"))


@_query(f"WITH {_WINNER_SQL} SELECT bindawood, panda, tamimi, score FROM c")
def anchor_topk_trios(spark, sf):
    return _brand_trios(spark, sf).select(*STORES, "score")


@_query(
    f"""
    WITH {_WINNER_SQL},
    o AS (SELECT *, unnest([bindawood, panda, tamimi]) AS uid FROM c),
    w AS (SELECT *, row_number() OVER v AS i, lead(score) OVER v AS nxt FROM o WINDOW v AS (PARTITION BY uid ORDER BY score DESC, bindawood, panda, tamimi))
    SELECT bindawood, panda, tamimi, score FROM w WHERE i = 1 AND (nxt IS NULL OR score - nxt >= 1.0) GROUP BY ALL HAVING count(*) = 3"""
)
def trio_reciprocal(spark, sf):
    accepted, _ = dairy.reciprocal_best(_brand_trios(spark, sf).select(*STORES, "score"))
    return accepted.select(*STORES, "score")


@_query(
    f"""
    WITH RECURSIVE {_WINNER_SQL.strip().lstrip()},
    d AS (SELECT *, row_number() OVER (ORDER BY score DESC, bindawood, panda, tamimi) AS i FROM c),
    w(i, used, taken) AS (
      SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), false
      UNION ALL
      SELECT d.i, CASE WHEN list_has_any(w.used, [d.bindawood, d.panda, d.tamimi]) THEN w.used ELSE list_concat(w.used, [d.bindawood, d.panda, d.tamimi]) END,
        NOT list_has_any(w.used, [d.bindawood, d.panda, d.tamimi])
      FROM w JOIN d ON d.i = w.i + 1)
    SELECT bindawood, panda, tamimi, score FROM d JOIN w USING (i) WHERE taken"""
)
def greedy_assignment(spark, sf):
    ranked = _brand_trios(spark, sf).withColumn("o1", -F.col("score"))
    return assign.greedy_one_to_one(ranked, list(STORES), ["o1", *STORES]).select(*STORES, "score")


@_query()
def beverage_match(spark, sf):
    """The whole beverage matcher over the brands as they are: 25, so each holds a large share of the products."""
    return beverages.match(_products(spark, sf)).select("product_name_en", "brand", "match_tier", "confidence_score", "price_metrics.avg_price", F.col("stores_data.bindawood.raw_product_id").alias("anchor"))


# All parts are fresh full fat milk of one size: a pair shares two attributes and no word but those of its part's name.
_DAIRY_SQL = f"""
WITH p AS (
  SELECT {_STORE} || '_' || CAST(p_partkey AS VARCHAR) AS uid, p_partkey AS k, p_partkey % 3 AS s, p_brand AS brand, p_name AS name, p_retailprice AS price,
    string_split(p_name, ' ') AS w, '62810' || lpad(CAST(p_partkey // 3 AS VARCHAR), 7, '0') AS code FROM part),
v AS (SELECT *, list_sum([CAST(code[i] AS INTEGER) * CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END FOR i IN range(1, 13)]) % 10 = 0 AS valid FROM p),
f AS (
  SELECT a.uid AS a, b.uid AS b, a.s AS s, b.s AS r, CAST(len(list_intersect(a.w, b.w)) AS DOUBLE) / 2 AS sim,
    CASE WHEN a.code = b.code AND a.valid THEN 4 WHEN a.code = b.code THEN 2 ELSE 1 END AS level
  FROM v a JOIN v b ON a.brand = b.brand AND a.s < b.s AND (a.code = b.code OR a.name = b.name)),
e AS (SELECT *, round_even((100 * level + 2 + sim) * 100000, 0) / 100000 AS score, CASE level WHEN 4 THEN CAST(1 AS DOUBLE) WHEN 2 THEN 0.96 ELSE 0.92 END AS sure FROM f),
x AS (
  SELECT m.a AS bindawood, m.b AS panda, n.b AS tamimi, m.level * 100.0 + n.level * 100.0 + o.level * 100.0 AS levels,
    m.score % 100 + n.score % 100 + o.score % 100 AS rests, list_sort([m.score, n.score, o.score]) AS scores,
    list_sort([m.level, n.level, o.level]) AS kinds, least(m.sure, n.sure, o.sure) AS least_sure
  FROM e m JOIN e n ON m.a = n.a AND m.s = 0 AND m.r = 1 AND n.r = 2 JOIN e o ON o.a = m.b AND o.b = n.b),
t AS (
  -- Two strong pairs share a barcode, and with it the third.
  SELECT *, CASE WHEN kinds[2] >= 2 THEN kinds[2] ELSE kinds[1] END AS weakest FROM x),
y AS (SELECT *, CAST(weakest * 1000 + levels + rests AS DOUBLE) AS score FROM t),
u AS (SELECT *, unnest([bindawood, panda, tamimi]) AS uid FROM y),
z AS (SELECT *, row_number() OVER g AS i, lead(score) OVER g AS nxt FROM u WINDOW g AS (PARTITION BY uid ORDER BY score DESC, bindawood, panda, tamimi)),
c AS (
  SELECT bindawood, panda, tamimi, weakest, least_sure FROM z WHERE i = 1 AND (nxt IS NULL OR score - nxt >= 1) GROUP BY ALL HAVING count(*) = 3)
SELECT 'fresh full fat milk ' || b.name AS product_name_en,
  CASE weakest WHEN 4 THEN 'exact_barcode' WHEN 2 THEN 'barcode_body_multifactor' ELSE 'dairy_brand_token' END AS match_tier,
  CAST(least_sure AS DOUBLE) AS confidence_score, round_even((b.price + q.price + m.price) / 3 * 100, 0) / 100 AS avg_price, CAST(b.k AS VARCHAR) AS anchor
FROM c JOIN p b ON b.uid = bindawood JOIN p q ON q.uid = panda JOIN p m ON m.uid = tamimi
"""


@_query(_DAIRY_SQL)
def dairy_match(spark, sf):
    """Parts as milk, over the brands as they are: 25, so each holds a large share of the products."""
    p = _products(spark, sf).withColumns(
        {"name_en": F.concat(F.lit("fresh full fat milk "), "name_en"), "total_size_value": F.lit(1000.0), "unit_size_value": F.lit(1000.0)}
    )
    return dairy.match(p, "2024-01-01").select("product_name_en", "match_tier", "confidence_score", "price_metrics.avg_price", F.col("stores_data.bindawood.raw_product_id").alias("anchor"))


_PRODUCE_WORDS = [w for w, r in tables.ROOTS.items() if w.isascii() and " " not in w and r not in ("pepper",)][:25]


def _references(spark, sf) -> DataFrame:
    n = _t(spark, sf, "nation")
    name = F.try_element_at(F.array(*[F.lit(w) for w in _PRODUCE_WORDS]), (F.col("n_nationkey") + 1).cast("int"))
    return n.select(
        F.col("n_nationkey").cast("string").alias("gastat_id"), F.concat(F.lit("صنف "), name).alias("item_name_ar"), name.alias("item_name_en"), F.lit(2024).alias("Year"),
        F.lit("كجم").alias("unit_ar"), F.lit("1,400.5").alias("Dec"), F.lit(None).cast("string").alias("Nov"), F.lit(None).cast("string").alias("Oct"),
        F.lit("1400").alias("Annual average"), F.col("n_nationkey").alias("pos"),
    )


def _produce(spark, sf) -> DataFrame:
    name = F.try_element_at(F.array(*[F.lit(w) for w in _PRODUCE_WORDS]), (F.expr("(p_partkey div 3) % 25") + 1).cast("int"))
    p = _t(spark, sf, "part").select(F.concat_ws("_", F.expr(_STORE), F.col("p_partkey").cast("string")).alias("uid"), name.alias("word"))
    return _products(spark, sf).join(p, "uid").withColumns({"name_en": F.col("word"), "total_size_value": F.lit(1000.0)}).drop("word")


# No guard bears on these words, so a product's score is its nearness in price to 1400.5.
_PRODUCE_SQL = f"""
WITH RECURSIVE v(i, word, root) AS (VALUES {", ".join(f"({i}, '{w}', '{tables.ROOTS[w]}')" for i, w in enumerate(_PRODUCE_WORDS))}),
a AS (SELECT n_nationkey, word AS key, root, CAST(1400.5 AS DOUBLE) AS b FROM nation JOIN v ON v.i = n_nationkey),
q AS (SELECT p_partkey AS k, p_partkey % 3 AS s, root, {_exact2("p_retailprice")} AS kg FROM part JOIN v ON v.i = (p_partkey // 3) % 25),
m AS (SELECT key, a.root, b, k, s, kg, CAST(1 AS DOUBLE) + greatest(CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) - abs(kg - b) / b) AS score
  FROM q JOIN a USING (root) WHERE abs(kg - b) / b <= CAST(0.8 AS DOUBLE)),
r AS (SELECT *, row_number() OVER (PARTITION BY key, s ORDER BY score DESC, k) AS i FROM m),
t AS (SELECT x.key, x.root, x.b, x.k AS k0, y.k AS k1, z.k AS k2, x.kg AS p0, y.kg AS p1, z.kg AS p2, x.i AS i0, y.i AS i1, z.i AS i2,
    greatest(x.kg, y.kg, z.kg) / least(x.kg, y.kg, z.kg) AS spread, x.score + y.score + z.score AS total
  FROM r x JOIN r y ON x.key = y.key AND x.s = 0 AND y.s = 1 JOIN r z ON x.key = z.key AND z.s = 2 WHERE x.i <= 3 AND y.i <= 3 AND z.i <= 3),
u AS (SELECT *, total - spread * CAST(0.5 AS DOUBLE) AS metric FROM t WHERE spread <= CAST(2.2 AS DOUBLE)),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY metric DESC, i0, i1, i2) AS place FROM u) WHERE place = 1),
d AS (SELECT *, row_number() OVER (ORDER BY metric DESC, spread, key) AS i FROM c),
w(i, used, taken) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), false
  UNION ALL
  SELECT d.i, CASE WHEN list_has_any(w.used, [d.k0, d.k1, d.k2]) THEN w.used ELSE list_concat(w.used, [d.k0, d.k1, d.k2]) END, NOT list_has_any(w.used, [d.k0, d.k1, d.k2])
  FROM w JOIN d ON d.i = w.i + 1),
g AS (SELECT *, (p0 + p1 + p2) / 3 AS mean, greatest(p0, p1, p2) AS high, least(p0, p1, p2) AS low FROM d JOIN w USING (i) WHERE taken),
h AS (SELECT *, {_exact2("mean")} AS avg_price, high - low AS diff FROM g), o AS (SELECT *, avg_price - b AS above FROM h)
"""


@_query(
    f"""
    {_PRODUCE_SQL} SELECT key AS gastat_key, root AS commodity_root, avg_price, low AS min_price, high AS max_price, {_exact2("diff")} AS price_diff,
      b AS gastat_benchmark_price, {_exact2("above")} AS variance_from_benchmark, CAST(k0 AS VARCHAR) AS anchor FROM o"""
)
def produce_match(spark, sf):
    gold = produce.match(_produce(spark, sf), _references(spark, sf), "2024-01-01")
    return gold.select("gastat_key", "commodity_root", "current_pricing.*", F.col("stores_data.bindawood.raw_product_id").alias("anchor"))


@_query(
    f"""
    {_PRODUCE_SQL} SELECT CAST(n_nationkey AS VARCHAR) AS gastat_id, a.key AS item_name_en, CAST(CASE WHEN k0 IS NULL THEN 0 ELSE 1 END AS INTEGER) AS match_count,
      CASE WHEN k0 IS NULL THEN '' ELSE '62810' || lpad(CAST(k0 // 3 AS VARCHAR), 7, '0') END AS barcodes FROM a LEFT JOIN o ON a.key = o.key"""
)
def benchmark_enrich(spark, sf):
    gold = produce.match(_produce(spark, sf), _references(spark, sf), "2024-01-01")
    return benchmark.enrich(_references(spark, sf), materialize(gold)).select("gastat_id", "item_name_en", "match_count", F.array_join("matched_barcodes", ",").alias("barcodes"))


@_query(
    """
    WITH u AS (SELECT n_regionkey AS k, min(n_name) AS v FROM nation GROUP BY 1 HAVING count(DISTINCT n_name) = 1),
    w AS (SELECT n_nationkey AS k, min(n_name) AS v FROM nation GROUP BY 1 HAVING count(DISTINCT n_name) = 1),
    r AS (SELECT r_regionkey AS k, min(r_name) AS v FROM region GROUP BY 1)
    SELECT c_custkey, coalesce(u.v, w.v, r.v) AS name FROM customer
    LEFT JOIN u ON c_nationkey = u.k LEFT JOIN w ON c_nationkey + 20 = w.k LEFT JOIN r ON c_nationkey % 5 = r.k"""
)
def lookup_priority_join(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    s = lambda c: F.col(c).cast("string")
    lookups = [
        (F.col("c_nationkey").cast("string"), benchmark.unique_lookup(n, s("n_regionkey"), "n_name")),
        ((F.col("c_nationkey") + 20).cast("string"), benchmark.unique_lookup(n, s("n_nationkey"), "n_name")),
        ((F.col("c_nationkey") % 5).cast("string"), benchmark.unique_lookup(r, s("r_regionkey"), "r_name")),
    ]
    return benchmark.prioritised(_t(spark, sf, "customer"), lookups, "name").select("c_custkey", "name")


# ---------------------------------------------------------------- warehouse


@_query(
    """
    WITH s AS (SELECT p_partkey + 100 AS p_partkey, p_name, p_retailprice + 1 AS p_retailprice FROM part WHERE p_partkey % 2 = 0)
    SELECT coalesce(s.p_partkey, t.p_partkey) AS p_partkey, CASE WHEN s.p_partkey IS NOT NULL THEN s.p_name ELSE t.p_name END AS p_name,
      CASE WHEN s.p_partkey IS NOT NULL THEN s.p_retailprice ELSE t.p_retailprice END AS p_retailprice
    FROM part t FULL JOIN s ON s.p_partkey = t.p_partkey"""
)
def merge_upsert(spark, sf):
    t = _t(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    s = t.where("p_partkey % 2 = 0").select((F.col("p_partkey") + 100).alias("p_partkey"), "p_name", (F.col("p_retailprice") + 1).alias("p_retailprice"))
    return merge.upsert(t, s, ["p_partkey"])


@_query("SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part")
def merge_update_only(spark, sf):
    t = _t(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    s = t.where("p_partkey % 2 = 0").select("p_partkey", (F.col("p_retailprice") + 1).alias("p_retailprice"))
    more = s.select((F.col("p_partkey") + 10_000_000).alias("p_partkey"), "p_retailprice")
    return merge.update_only(t, s.union(more), ["p_partkey"], ["p_retailprice"])


@_query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS snapshot_date, CASE WHEN CAST(o_orderdate AS DATE) = DATE '1996-01-02' THEN 1.0 ELSE o_totalprice END AS price
    FROM orders WHERE CAST(o_orderdate AS DATE) <> DATE '1996-01-02' OR o_orderkey % 2 = 0"""
)
def snapshot_replace(spark, sf):
    """The second load of a day replaces it, with fewer rows; other days stay."""
    rows = _t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("snapshot_date"), F.col("o_totalprice").alias("price"))
    again = rows.where("o_orderkey % 2 = 0").withColumn("price", F.lit(1.0))
    done = merge.snapshot_replaced(rows, again, "1996-01-02")
    return done.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@_query(f"SELECT p_partkey // 3 AS code, {_STORE} AS store_name, p_retailprice AS price FROM part")
def unpivot_stores(spark, sf):
    stores = _t(spark, sf, "part").groupBy(F.expr("p_partkey div 3").alias("code")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.expr(_STORE).alias("k"), F.col("p_retailprice").alias("v")))).alias("m")
    )
    return stores.select("code", F.explode("m").alias("store_name", "price"))


@_query(
    """
    SELECT p_partkey // 3 AS code, max(p_retailprice) FILTER (p_partkey % 3 = 0) AS bindawood_price, max(p_retailprice) FILTER (p_partkey % 3 = 1)
      AS panda_price, max(p_retailprice) FILTER (p_partkey % 3 = 2) AS tamimi_price FROM part GROUP BY 1"""
)
def pivot_stores(spark, sf):
    rows = _t(spark, sf, "part").withColumn("store", F.expr(_STORE))
    wide = rows.groupBy(F.expr("p_partkey div 3").alias("code")).pivot("store", list(STORES)).agg(F.max("p_retailprice"))
    return wide.select("code", *[F.col(s).alias(f"{s}_price") for s in STORES])


@_query("SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def usage_audit(spark, sf):
    return dedupe.excess_usage(_t(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@_query("SELECT p_type AS tier, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1")
def histogram(spark, sf):
    return _t(spark, sf, "part").groupBy(F.col("p_type").alias("tier")).agg(F.count("*").alias("n"))


@_query(
    """
    WITH o AS (SELECT p_partkey AS k, p_brand AS b FROM part WHERE p_partkey % 5 <> 0),
    n AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN 'other' ELSE p_brand END AS b FROM part WHERE p_partkey % 3 <> 0)
    SELECT coalesce(o.k, n.k) AS anchor, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN o.b <> n.b THEN 'changed' ELSE 'same' END
      AS change FROM o FULL JOIN n ON o.k = n.k"""
)
def cluster_diff(spark, sf):
    def gold(condition: str, brand):
        p = _t(spark, sf, "part").where(condition)
        data = F.create_map(F.lit("bindawood"), F.struct(F.col("p_partkey").cast("string").alias("raw_product_id")), F.lit("panda"), F.struct(brand.alias("raw_product_id")))
        return p.select(data.alias("stores_data"), F.col("p_type").alias("match_tier"), F.lit(1.0).alias("confidence_score"), F.col("p_size").alias("size"), F.lit("g").alias("unit"), F.lit(1).alias("quantity"), F.col("p_size").alias("total_size"))

    new = F.when(F.col("p_partkey") % 7 == 0, "other").otherwise(F.col("p_brand"))
    return dairy.diff_report(gold("p_partkey % 5 <> 0", F.col("p_brand")), gold("p_partkey % 3 <> 0", new)).select(F.col("anchor").cast("long").alias("anchor"), "change")


@_query(
    """
    SELECT s.s_nationkey AS key, CAST(count(n.n_nationkey) AS BIGINT) AS matches FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
      AND n.n_nationkey % 2 = 0 GROUP BY 1 HAVING count(n.n_nationkey) <> 1"""
)
def cardinality_check(spark, sf):
    return merge.cardinality(_t(spark, sf, "nation").where("n_nationkey % 2 = 0"), _t(spark, sf, "supplier"), "n_nationkey", "s_nationkey")


@_query(
    """
    SELECT n_name, CAST(count(*) AS BIGINT) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE s_acctbal BETWEEN -90 AND 100000 GROUP BY 1"""
)
def verify_join(spark, sf):
    s, n = _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    return s.where("s_acctbal BETWEEN -90 AND 100000").join(n, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("suppliers"))


@_query("SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' OR p_brand = 'Brand#7' OR p_brand = 'Brand#3'")
def category_filter(spark, sf):
    """Parts whose primary category, its parent or a listed category is wanted."""
    from shelfspark.plans.silver import in_category

    node = lambda c: F.struct(F.lit(None).cast("string").alias("id"), c.alias("slug"))
    p = _t(spark, sf, "part").select(
        "p_partkey", "p_name",
        F.struct(
            F.lit(None).cast("string").alias("id"), F.col("p_type").alias("slug"),
            F.struct(F.lit(None).cast("string").alias("id"), F.col("p_brand").alias("slug"), node(F.lit(None).cast("string")).alias("parentCategory")).alias("parentCategory"),
        ).alias("primaryCategory"),
        F.array(node(F.col("p_brand"))).alias("categories"),
    )
    return in_category(p, ["7"], ["ECONOMY", "Brand#7", "Brand#3"]).select("p_partkey", "p_name")


@_query("SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' OR string_split(p_name, ' ')[2] = 'ring' OR p_size = 7 OR p_brand = 'Brand#17'")
def category_ancestors(spark, sf):
    """Parts whose category, one of its five levels of parents or a listed category is wanted."""
    from shelfspark.plans.silver import in_category_of_any_depth

    word = lambda i: F.coalesce(F.get(F.split("p_name", " "), F.lit(i)), F.lit(""))
    node = F.struct(F.lit(0).alias("id"), F.col("p_type").alias("slug"))
    for slug in (F.lit("goods"), word(1), word(0), F.lit("parts")):
        node = F.struct(F.lit(0).alias("id"), slug.alias("slug"), node.alias("parentCategory"))
    node = F.struct(F.col("p_size").alias("id"), F.lit("size").alias("slug"), node.alias("parentCategory"))
    listed = F.to_json(F.array(F.struct(F.col("p_brand").alias("slug"))))
    p = _t(spark, sf, "part").select("p_partkey", "p_name", F.parse_json(F.to_json(node)).alias("primaryCategory"), F.parse_json(listed).alias("categories"))
    return in_category_of_any_depth(p, ["7"], ["ECONOMY", "ring", "Brand#17"]).select("p_partkey", "p_name")
