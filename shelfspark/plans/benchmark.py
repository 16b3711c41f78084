"""Official price records enriched with matched clusters: prioritised unique-name lookups, optional fuzzy fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import similarity, text
from shelfspark.functions.numbers import integer_id
from shelfspark.operators.dedupe import first_wins
from shelfspark.operators.similar import candidates, most_similar, needed
from shelfspark.storage import materialize, small

NAME_WEIGHT, ROOT_WEIGHT, FUZZY_THRESHOLD = 0.7, 0.3, 0.70


def unique_lookup(clusters: DataFrame, key: Column, value: str) -> DataFrame:
    """``key, value`` for keys that name one cluster; an ambiguous or empty key names none."""
    named = clusters.select(key.alias("key"), F.col(value).alias("value")).where("key <> ''")
    return named.groupBy("key").agg(F.count_distinct("value").alias("n"), F.max("value").alias("value")).where("n = 1").drop("n")


def prioritised(records: DataFrame, lookups: list[tuple[Column, DataFrame]], out: str) -> DataFrame:
    """``records`` with the value of the first lookup that knows its key, else null."""
    df = records
    found = []
    for i, (key, lookup) in enumerate(lookups):
        own = lookup.select(F.col("key").alias(f"_k{i}"), F.col("value").alias(f"_v{i}"))
        df = df.join(small(own), key == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        found.append(F.col(f"_v{i}"))
    return df.withColumn(out, F.coalesce(*found)).drop(*[f"_v{i}" for i in range(len(lookups))])


def cluster_barcodes(stores_data: Column, barcode: Column, fields: tuple[str, ...] = ()) -> Column:
    """Distinct barcodes of a cluster in first-seen order: those of its stores (``barcode``, then ``barcodes``, where ``fields`` says
    that stores have them), else its own."""
    clean = lambda codes: F.array_distinct(F.filter(F.transform(codes, lambda c: F.trim(c)), lambda c: c != ""))
    none = F.array().cast("array<string>")

    def of(v: Column) -> Column:
        one = F.array(v["barcode"].cast("string")) if "barcode" in fields else none
        more = F.coalesce(v["barcodes"], none) if "barcodes" in fields else none
        return F.concat(one, more)

    listed = clean(F.array_compact(F.flatten(F.transform(F.map_values(stores_data), of))))
    return F.when(F.size(listed) > 0, listed).otherwise(clean(F.array_compact(F.array(barcode))))


def _fields(gold: DataFrame) -> tuple[str, ...]:
    """Fields of a store's entry in ``stores_data``."""
    return tuple(gold.schema["stores_data"].dataType.valueType.names)


def store_coverage(count: Column, stores_data: Column) -> Column:
    return F.coalesce(count.cast("string").try_cast("int"), F.size(stores_data))


_PAIRED = (("r_en", "p_en"), ("r_ar", "p_ar"), ("r_en", "o_en"), ("r_ar", "o_ar"))


def _fuzzy(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """(record_id, cluster_id, score) of names that are similar.

    A score needs one pair of names to be alike by 4/7 at least, so pairs come from a join on rare tokens; what Spark can
    tell of their score from above goes before the character ratio.
    """
    r = records.select("record_id", F.col("ar").alias("r_ar"), F.col("en").alias("r_en"))
    r = materialize(r.withColumn("r_root", F.coalesce(text.or_none(similarity.longest_word(F.col("r_en"))), similarity.longest_word(F.col("r_ar")))))
    c = clusters.select(
        "cluster_id",
        *[text.reference_text(F.col(n)).alias(a) for n, a in (("product_name_en", "p_en"), ("product_name_ar", "p_ar"), ("official_gastat_name_en", "o_en"), ("official_gastat_name_ar", "o_ar"), ("commodity_root", "root"))],
    )
    c = materialize(c.withColumn("p_root", F.coalesce(text.or_none(F.col("root")), text.or_none(similarity.longest_word(F.col("p_en"))), similarity.longest_word(F.col("p_ar")))))
    names = lambda df, key, columns: df.select(F.col(key).alias("id"), F.explode(F.array(*columns)).alias("text"))
    threshold = needed(NAME_WEIGHT, FUZZY_THRESHOLD)
    pairs = None
    for language in ("en", "ar"):  # names are compared within a language
        own = candidates(names(r, "record_id", [f"r_{language}"]), names(c, "cluster_id", [f"p_{language}", f"o_{language}"]), threshold)
        pairs = own if pairs is None else pairs.unionByName(own)
    pairs = pairs.distinct().join(r, F.col("left_id") == F.col("record_id")).join(c, F.col("right_id") == F.col("cluster_id"))

    def score(of) -> Column:
        sim = lambda x, y: of(F.col(x), F.col(y))
        return NAME_WEIGHT * F.greatest(*[sim(x, y) for x, y in _PAIRED]) + ROOT_WEIGHT * sim("r_root", "p_root")

    likely = materialize(pairs.where(score(most_similar) >= FUZZY_THRESHOLD - 1e-9).select(*r.columns, *c.columns))
    return likely.select("record_id", "cluster_id", score(similarity.text_similarity).alias("score")).where(F.col("score") >= FUZZY_THRESHOLD)


def enrich(records: DataFrame, gold: DataFrame, fuzzy: bool = False) -> DataFrame:
    """All fields of the records with ``match_count`` and ``matched_barcodes``.

    Lookups go by official Arabic name, official English name, then the cluster's key by Arabic and by
    English name. The first record of an id decides for all records of that id. ``pos`` is the record's place.
    """
    clusters = gold.withColumn("cluster_id", F.col("gastat_key")).withColumn("codes", cluster_barcodes(F.col("stores_data"), F.col("barcode"), _fields(gold)))
    norm = lambda c: text.reference_text(F.col(c))
    keyed = records.withColumn("record_id", F.coalesce(integer_id(F.col("gastat_id")).cast("string"), F.concat(F.lit("row "), F.col("pos").cast("string"))))
    first = first_wins(keyed, ["record_id"], ["pos"]).select("record_id", norm("item_name_ar").alias("ar"), norm("item_name_en").alias("en"))
    by = {c: unique_lookup(clusters, norm(c), "cluster_id") for c in ("official_gastat_name_ar", "official_gastat_name_en", "gastat_key")}
    found = prioritised(
        first,
        [(F.col("ar"), by["official_gastat_name_ar"]), (F.col("en"), by["official_gastat_name_en"]), (F.col("ar"), by["gastat_key"]), (F.col("en"), by["gastat_key"])],
        "cluster_id",
    )
    hits = found.where("cluster_id IS NOT NULL").select("record_id", "cluster_id", F.lit(1.0).alias("score"))
    if fuzzy:
        hits = hits.unionByName(_fuzzy(found.where("cluster_id IS NULL"), clusters))
    w = Window.partitionBy("record_id").orderBy(F.desc("score"), "cluster_id")
    codes = hits.join(clusters.select("cluster_id", "codes"), "cluster_id").withColumn("place", F.row_number().over(w))
    per = codes.groupBy("record_id").agg(
        F.count("*").cast("int").alias("match_count"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "codes"))), lambda x: x["codes"]))).alias("matched_barcodes"),
    )
    return keyed.join(per, "record_id", "left").select(
        *records.columns, F.coalesce("match_count", F.lit(0)).alias("match_count"), F.coalesce("matched_barcodes", F.array().cast("array<string>")).alias("matched_barcodes")
    )
