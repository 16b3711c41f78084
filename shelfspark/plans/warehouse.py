"""The star schema: tables, flattening of gold rows, loads, branches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.text import or_none
from shelfspark.operators.dedupe import last_wins, qualify_best
from shelfspark.operators.merge import cardinality, replace_snapshot, update_only, upsert, with_columns_if_absent
from shelfspark.schemas import STORES
from shelfspark.storage import materialize, shared_dir

TABLES = {
    "dim_matched_products": (
        "product_id string, product_name_ar string, product_name_en string, brand string, category string, size double, unit string, "
        "barcode string, image_url string, match_tier string, confidence_score double, created_at timestamp_ntz",
        None,
    ),
    "fct_price_snapshots": (
        "product_id string, avg_price double, min_price double, max_price double, price_diff double, bindawood_price double, "
        "panda_price double, tamimi_price double, created_at timestamp_ntz, snapshot_date date",
        "snapshot_date",
    ),
    "fct_store_item_prices": (
        "product_id string, store_name string, raw_product_id string, price double, original_price double, discount_amount double, "
        "discount_percentage double, has_discount boolean, created_at timestamp_ntz, snapshot_date date",
        "snapshot_date",
    ),
    "ref_gastat_prices": (
        "gastat_id string, item_name_ar string, item_name_en string, year int, barcode string, annual_avg_price double, created_at timestamp_ntz",
        None,
    ),
    "dim_branches": ("branch_key string, brand string, city_en string, name_en string", None),
}


def create_tables(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (ddl, partition) in TABLES.items():
        by = f" PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet{by}")


def product_id() -> Column:
    """Trimmed barcode, else the Arabic, else the English name; null if all are blank."""
    return F.coalesce(*[or_none(F.trim(c)) for c in ("barcode", "product_name_ar", "product_name_en")])


def union_gold(dairy: DataFrame, beverages: DataFrame, produce: DataFrame, current_pricing: bool = False) -> DataFrame:
    """All gold rows with their file's rank; of one product the later file wins.

    Produce rows have no ``price_metrics``: their metrics load as null unless ``current_pricing`` is set.
    """
    null = lambda t: F.lit(None).cast(t)
    metrics = "struct<avg_price:double,min_price:double,max_price:double,price_diff:double>"
    out = None
    for rank, df in enumerate((dairy, beverages, produce)):
        price = F.col("price_metrics") if "price_metrics" in df.columns else (
            F.struct(*[F.col(f"current_pricing.{c}").alias(c) for c in ("avg_price", "min_price", "max_price", "price_diff")]) if current_pricing else null(metrics)
        )
        data = F.transform_values(
            "stores_data",
            lambda _, v: F.struct(*[v[c].alias(c) for c in ("price", "original_price", "discount_amount", "discount_percentage", "has_discount", "raw_product_id")]),
        )
        own = df.select(
            F.lit(rank).alias("file_rank"), product_id().alias("product_id"), "product_name_ar", "product_name_en", "brand", "category",
            F.col("size").cast("double").alias("size"), "unit", "barcode", "image_url",
            (F.col("match_tier") if "match_tier" in df.columns else null("string")).alias("match_tier"),
            (F.col("confidence_score") if "confidence_score" in df.columns else null("double")).alias("confidence_score"),
            price.cast(metrics).alias("metrics"), data.alias("stores"),
        )
        out = own if out is None else out.unionByName(own)
    named = out.where("product_id IS NOT NULL")
    return last_wins(named, ["product_id"], ["file_rank", "confidence_score", "product_name_en", "product_name_ar"])


def dimension(gold: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in TABLES["dim_matched_products"][0].split(", ")]
    return qualify_best(gold, ["product_id"], "confidence_score", ["product_name_en"]).withColumn("created_at", F.current_timestamp().cast("timestamp_ntz")).select(*names)


def snapshots(gold: DataFrame, date: dt.date) -> DataFrame:
    """One row a product: metrics and a price column for each store."""
    return gold.select(
        "product_id", *[F.col(f"metrics.{c}").alias(c) for c in ("avg_price", "min_price", "max_price", "price_diff")],
        *[F.col("stores")[s]["price"].alias(f"{s}_price") for s in STORES],
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"), F.lit(date).alias("snapshot_date"),
    )


def store_prices(gold: DataFrame, date: dt.date) -> DataFrame:
    """One row a product and store."""
    rows = gold.select("product_id", F.explode("stores").alias("store_name", "d"))
    return rows.select(
        "product_id", "store_name", *[F.col(f"d.{c}").alias(c) for c in ("raw_product_id", "price", "original_price", "discount_amount", "discount_percentage", "has_discount")],
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"), F.lit(date).alias("snapshot_date"),
    )


def reference_rows(enriched: DataFrame) -> DataFrame:
    """One row a record and matched barcode (none: one row without); the last of a key wins."""
    price = F.trim(F.col("`Annual average`").cast("string")).cast("double")
    rows = enriched.select(
        "gastat_id", "item_name_ar", "item_name_en", F.col("Year").cast("int").alias("year"), F.explode_outer("matched_barcodes").alias("barcode"),
        price.alias("annual_avg_price"), F.current_timestamp().cast("timestamp_ntz").alias("created_at"), "pos",
    )
    last = last_wins(rows, ["gastat_id", "year", "barcode"], ["pos"])
    return qualify_best(last, ["gastat_id", "year", "barcode"], "annual_avg_price", ["pos"]).drop("pos")


def _rewrite(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Stage the new version in the shared folder, then swap it in."""
    materialize(rows).write.mode("overwrite").insertInto(table, overwrite=True)


def load(spark: SparkSession, database: str, gold: DataFrame, references: DataFrame, date: dt.date) -> None:
    """Merge dimension and reference rows, replace the day's facts; all inputs are staged before the first write."""
    staged = materialize(gold)
    dim, ref = f"{database}.dim_matched_products", f"{database}.ref_gastat_prices"
    new_dim = materialize(upsert(spark.table(dim), dimension(staged).drop("created_at").withColumn("created_at", F.current_timestamp().cast("timestamp_ntz")), ["product_id"]))
    new_ref = materialize(upsert(spark.table(ref), references, ["gastat_id", "year", "barcode"]))
    facts = materialize(snapshots(staged, date)), materialize(store_prices(staged, date))
    _rewrite(spark, dim, new_dim)
    _rewrite(spark, ref, new_ref)
    replace_snapshot(spark, facts[0], f"{database}.fct_price_snapshots", date)
    replace_snapshot(spark, facts[1], f"{database}.fct_store_item_prices", date)


def branch_coordinates(branches: DataFrame) -> DataFrame:
    """``branch_key, latitude, longitude``; reading fails on coordinates off the globe or repeated keys."""
    key = F.concat_ws("_", F.replace("brand", F.lit(" "), F.lit("_")), F.col("id").cast("string"))
    ok = F.col("LATITUDE").between(-90, 90) & F.col("LONGITUDE").between(-180, 180)
    rows = branches.select(key.alias("branch_key"), F.col("LATITUDE").alias("latitude"), F.col("LONGITUDE").alias("longitude"), F.coalesce(ok, F.lit(False)).alias("ok"))
    checked = rows.where(F.when(F.col("ok"), True).otherwise(F.raise_error(F.concat(F.lit("bad coordinates: "), "branch_key")).cast("boolean"))).drop("ok")
    from shelfspark.operators.dedupe import assert_single_use

    return assert_single_use(checked, ["branch_key"])


def sync_branches(spark: SparkSession, database: str, branches: DataFrame) -> int:
    """Set coordinates of known branches; raises unless every key meets exactly one row before and after."""
    table = f"{database}.dim_branches"
    source = materialize(branch_coordinates(branches))
    wrong = cardinality(spark.table(table), source, "branch_key", "branch_key").limit(5).collect()
    if wrong:
        raise ValueError(f"branch keys without exactly one row: {[r['key'] for r in wrong]}")
    for c in ("latitude", "longitude"):
        if c not in spark.table(table).columns:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({c} double)")
    target = with_columns_if_absent(spark.table(table), latitude="double", longitude="double")
    _rewrite(spark, table, update_only(target, source, ["branch_key"], ["latitude", "longitude"]))
    done = spark.table(table).join(source, ["branch_key", "latitude", "longitude"]).count()
    if done != source.count():
        raise ValueError("not every branch has its coordinates")
    return done


__all__ = ["TABLES", "create_tables", "load", "shared_dir", "sync_branches", "union_gold"]
