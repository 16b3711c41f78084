"""What the three matchers share: products with features, trios, metrics, gold rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.numbers import price_metrics, truthy
from shelfspark.schemas import STORES

#: Columns of a product that a gold row shows.
SHOWN = (
    "id", "store", "name_en", "name_ar", "brand", "barcodes", "price", "original_price", "discount_amount", "discount_percentage",
    "pack_qty", "unit_size_value", "total_size_value", "size_unit", "image_url",
)


def union_stores(*silver: DataFrame) -> DataFrame:
    """All stores' products with ``uid`` and the ordinal ``ord`` (store, then place in its file)."""
    rows = None
    for df in silver:
        own = df.select(*SHOWN, *[c for c in ("is_weighted", "weighted_options") if c in df.columns], F.col("pos").cast("string").alias("pos"))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    rank = F.array_position(F.array(*[F.lit(s) for s in STORES]), F.col("store"))
    return rows.withColumn("uid", F.concat_ws("_", "store", "id")).withColumn("ord", F.struct(rank.alias("store"), F.lpad("pos", 24, "0").alias("pos"), "id"))


def both_sides(features: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    side = lambda p: features.select(*[F.col(c).alias(f"{p}_{c}") for c in columns])
    return side("a"), side("b")


def stores_data(members: list[Column], price: str = "price", raw_price: bool = False) -> Column:
    """Map of store to what the gold row keeps of its product."""

    def of(p: Column) -> Column:
        fields = [p[price].alias("price")]
        if raw_price:
            fields.append(p["price"].alias("store_raw_price"))
        return F.struct(
            *fields,
            p["original_price"].alias("original_price"),
            p["discount_amount"].alias("discount_amount"),
            p["discount_percentage"].alias("discount_percentage"),
            F.coalesce(p["discount_amount"] > 0, F.lit(False)).alias("has_discount"),
            p["image_url"].alias("image_url"),
            p["id"].alias("raw_product_id"),
        )

    return F.map_from_arrays(F.array(*[F.lit(s) for s in STORES]), F.array(*[of(m) for m in members]))


def attach_members(trios: DataFrame, products: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Trios (columns bindawood, panda, tamimi hold uids) with each member's product as a struct of the store's name."""
    out = trios
    for s in STORES:
        member = products.where(F.col("store") == s).select(F.col("uid").alias(s), F.struct(*SHOWN, *extra).alias(f"{s}_product"))
        out = out.join(member, s)
    return out


def gold_columns(category: str, size: Column, unit: Column, quantity: Column, total: Column) -> list[Column]:
    """Scalars and price metrics of a cluster; the canonical product is the first store's."""
    c = F.col("bindawood_product")
    members = [F.col(f"{s}_product") for s in STORES]
    return [
        c["name_ar"].alias("product_name_ar"),
        c["name_en"].alias("product_name_en"),
        c["brand"].alias("brand"),
        F.lit(category).alias("category"),
        size.alias("size"),
        unit.alias("unit"),
        quantity.alias("quantity"),
        total.alias("total_size"),
        F.get(c["barcodes"], F.lit(0)).alias("barcode"),
        c["image_url"].alias("image_url"),
        c["store"].alias("canonical_source"),
        F.lit(3).alias("matched_stores_count"),
        F.array(*[F.lit(s) for s in STORES]).alias("matched_stores"),
        price_metrics(F.array(*[m["price"] for m in members])).alias("price_metrics"),
        stores_data(members).alias("stores_data"),
    ]


def truthy_ratio(prices: Column, most: float) -> Column:
    """At least one positive price, and the largest within ``most`` times the least."""
    ok = F.filter(prices, lambda p: p > 0)
    return (F.size(ok) > 0) & F.coalesce(F.array_max(ok) / F.array_min(ok) <= most, F.lit(False))


__all__ = ["SHOWN", "attach_members", "both_sides", "gold_columns", "stores_data", "truthy", "truthy_ratio", "union_stores"]
