"""Raw retailer records to one product schema. Ordinals (``pos``) decide which duplicate comes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import barcode, size
from shelfspark.functions.numbers import best_branch_price, discount, listed_price, safe_float
from shelfspark.functions.text import first_word, full_text, or_none, squeeze
from shelfspark.operators.dedupe import first_wins
from shelfspark.storage import materialize, small

_SIZES = ("pack_qty", "unit_size_value", "total_size_value", "size_unit")
_COLUMNS = (
    "id", "store", "category", "name_en", "name_ar", "brand", "barcodes", "price", "original_price", "discount_amount",
    "discount_percentage", *_SIZES, "image_url",
)


def _firsts(df: DataFrame, key: Column) -> DataFrame:
    """The first row of each ``key``. It goes before the columns are made, which are many patterns a row: so none is made for a repeated
    row, and the rows are dealt out over all tasks, whatever files they come from."""
    return first_wins(df.withColumn("_key", key).where("_key IS NOT NULL"), ["_key"], ["pos"])


def _finish(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select("*", *[F.col(f"size.{c}").alias(c) for c in _SIZES]).select(*_COLUMNS, *extra, "pos")


def tamimi(raw: DataFrame, category: Column) -> DataFrame:
    """Rows without a name are dropped; a price is mrp less discount, where mrp is above 0."""
    df = flatten_variants(raw).withColumnRenamed("variant", "v")
    df = df.withColumn("name", F.coalesce(or_none(F.col("v.fullName")), or_none(F.col("name"))))
    df = _firsts(df.where("name IS NOT NULL"), F.coalesce(or_none(F.col("v.id")), or_none(F.col("id"))))
    first = F.get("v.storeSpecificData", F.lit(0))
    paid = listed_price(first["mrp"], first["discount"])
    return _finish(
        df.select(
            F.col("_key").alias("id"),
            F.lit("tamimi").alias("store"),
            category.alias("category"),
            F.trim("name").alias("name_en"),
            F.lit(None).cast("string").alias("name_ar"),
            F.col("brand.name").alias("brand"),
            barcode.with_short_form(F.coalesce("v.barcodes", F.array().cast("array<string>"))).alias("barcodes"),
            *[paid[c].alias(c) for c in ("price", "original_price", "discount_amount", "discount_percentage")],
            size.tamimi_size(full_text(F.col("name"), F.col("v.name"))).alias("size"),
            F.get("v.images", F.lit(0)).alias("image_url"),
            "pos",
        )
    )


def bindawood(raw: DataFrame, category: Column) -> DataFrame:
    """Nameless rows are kept; the brand defaults to the English name's first word."""
    df = _firsts(raw, F.coalesce(or_none(F.col("master_id")), F.col("objectID")))
    df = df.withColumn("name_en", F.coalesce(or_none(F.col("full_name_en")), or_none(F.col("name_en")))).withColumn(
        "name_ar", F.coalesce(or_none(F.col("full_name_ar")), or_none(F.col("name_ar")))
    )
    df = df.withColumn("best", best_branch_price(F.col("inventory_modifiers"), F.col("price"), F.col("original_price")))
    listed = F.filter(F.transform(F.coalesce("barcodes", F.array().cast("array<string>")), lambda c: F.trim(c)), lambda c: c != "")
    return _finish(
        df.select(
            F.col("_key").alias("id"),
            F.lit("bindawood").alias("store"),
            category.alias("category"),
            F.trim("name_en").alias("name_en"),
            F.trim("name_ar").alias("name_ar"),
            F.coalesce(or_none(F.col("brand_en")), or_none(F.col("brand_ar")), first_word(F.col("name_en"))).alias("brand"),
            F.array_sort(F.array_distinct(F.concat(barcode.from_image(F.col("image")), listed))).alias("barcodes"),
            *[F.col(f"best.{c}").alias(c) for c in ("price", "original_price", "discount_amount", "discount_percentage")],
            size.bindawood_size(full_text(F.col("name_en"), F.col("name_ar")), category).alias("size"),
            or_none(F.col("image")).alias("image_url"),
            "pos",
        )
    )


def panda(raw: DataFrame, category: Column) -> DataFrame:
    """One row a variety with a name and an id; an explicit 1 kg option sets price and size of weighed products."""
    df = raw.select("*", F.posexplode("varieties").alias("variety_pos", "v")).withColumn(
        "title", F.coalesce(or_none(F.col("name")), or_none(F.col("v.description")))
    )
    df = df.where("title IS NOT NULL").withColumn("pos", F.struct("pos", "variety_pos"))
    df = _firsts(df, F.coalesce(or_none(F.col("v.sku")), or_none(F.col("v.id"))))
    df = df.withColumn("kilo", size.kilo_option(F.col("v.wighted"), F.col("v.weighted_options")))
    weighed = F.col("kilo").isNotNull()
    price = F.when(weighed, safe_float(F.col("kilo.price"))).otherwise(safe_float(F.col("v.price")))
    before = F.when(weighed, safe_float(F.col("kilo.undiscounted_price"))).otherwise(safe_float(F.col("v.undiscounted_price")))
    df = df.withColumns({"sale": price, "before": before})
    amount, percent = discount(F.col("sale"), F.col("before"))
    arabic = F.coalesce(F.col("_source_locale") == "ar", F.lit(False))
    return _finish(
        df.select(
            F.col("_key").alias("id"),
            F.lit("panda").alias("store"),
            category.alias("category"),
            F.when(~arabic, F.trim("title")).alias("name_en"),
            F.when(arabic, F.trim("title")).alias("name_ar"),
            F.col("brand.name").alias("brand"),
            barcode.with_short_form(F.array_compact(F.array("v.barcode"))).alias("barcodes"),
            F.col("sale").alias("price"),
            F.col("before").alias("original_price"),
            amount.alias("discount_amount"),
            percent.alias("discount_percentage"),
            size.panda_size(F.col("title"), F.col("v.size"), F.col("v.unit"), F.col("kilo")).alias("size"),
            F.coalesce(or_none(F.col("v.imageURL")), F.get("v.images", F.lit(0))).alias("image_url"),
            F.coalesce("v.wighted", F.lit(False)).alias("is_weighted"),
            safe_float(F.col("v.weighted_interval")).alias("weighted_interval"),
            size.weighted_options(F.col("v.wighted"), F.col("v.weighted_options")).alias("weighted_options"),
            "pos",
        ),
        ("is_weighted", "weighted_interval", "weighted_options"),
    )


def in_category(raw: DataFrame, ids: list[str], slugs: list[str]) -> DataFrame:
    """Rows whose primary category, one of its parents, or a listed category has one of the ids or slugs."""
    nodes = F.concat(
        F.array(
            *[F.struct(F.col(f"{p}.id").alias("id"), F.col(f"{p}.slug").alias("slug"))
              for p in ("primaryCategory", "primaryCategory.parentCategory", "primaryCategory.parentCategory.parentCategory")]
        ),
        F.coalesce("categories", F.array().cast("array<struct<id:string,slug:string>>")),
    )
    return raw.where(F.exists(nodes, lambda n: F.coalesce(n["id"].isin(ids), F.lit(False)) | F.coalesce(n["slug"].isin(slugs), F.lit(False))))


def category_nodes(chains: DataFrame) -> DataFrame:
    """``chain, depth, id, slug`` of a category (variant ``chain_node``) and all its parents, whatever their number.

    A recursive query takes one level a step; a chain ends at a parent that is missing or no object. Give it distinct
    chains: Spark ends a recursion after 100 levels, or ``spark.sql.cteRecursionRowLimit`` rows (a million).
    """
    return chains.sparkSession.sql(
        """
        WITH RECURSIVE walk(chain, node, depth) AS (
          SELECT chain, chain_node, 1 FROM {chains} WHERE schema_of_variant(chain_node) LIKE 'OBJECT%'
          UNION ALL
          SELECT chain, try_variant_get(node, '$.parentCategory', 'variant'), depth + 1 FROM walk
          WHERE schema_of_variant(try_variant_get(node, '$.parentCategory', 'variant')) LIKE 'OBJECT%'
        )
        SELECT chain, depth, try_variant_get(node, '$.id', 'string') AS id, try_variant_get(node, '$.slug', 'string') AS slug FROM walk""",
        chains=chains,
    )


def in_category_of_any_depth(raw: DataFrame, ids: list[str], slugs: list[str]) -> DataFrame:
    """``in_category`` for records whose ``primaryCategory`` and ``categories`` are variants, so that parents may nest to any depth.

    Products share few categories: chains are told apart by their JSON, walked once each, and joined back.
    """
    wanted = lambda i, s: F.coalesce(i.isin(ids), F.lit(False)) | F.coalesce(squeeze(s).isin(slugs), F.lit(False))
    keyed = raw.withColumn("_chain", F.to_json("primaryCategory"))
    chains = materialize(keyed.where("_chain IS NOT NULL").select(F.col("_chain").alias("chain")).distinct()).withColumn("chain_node", F.parse_json("chain"))
    hits = category_nodes(chains).where(wanted(F.col("id"), F.col("slug"))).select(F.col("chain").alias("_chain"), F.lit(True).alias("_hit")).distinct()
    listed = F.try_variant_get("categories", "$", "array<variant>")
    of = lambda c, k: F.try_variant_get(c, f"$.{k}", "string")
    own = F.exists(F.coalesce(listed, F.array().cast("array<variant>")), lambda c: wanted(of(c, "id"), of(c, "slug")))
    return keyed.join(small(materialize(hits)), "_chain", "left").where(F.col("_hit") | own).select(*raw.columns)


def flatten_variants(raw: DataFrame) -> DataFrame:
    """One row a variant; a product without variants keeps its row."""
    return raw.withColumn("one", F.explode_outer("variants")).withColumn("variant", F.coalesce("one", "variant")).drop("one", "variants")


def measures() -> list[Column]:
    """Rows of a silver table and how many of them have barcodes, a discount, a size; for an aggregation or an observation."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("barcodes") > 0).alias("with_barcodes"),
        F.count_if(F.coalesce(F.col("discount_amount") != 0, F.lit(False))).alias("with_discount"),
        F.count_if(F.coalesce(F.col("unit_size_value") != 0, F.lit(False))).alias("with_size"),
    ]


def counts(silver: DataFrame) -> DataFrame:
    """Totals of a silver table and how many rows have barcodes, a discount, a size."""
    return silver.groupBy("store").agg(*measures())
