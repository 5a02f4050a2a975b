"""Popularity bumps: limited by user and hour, resolved to products, added up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import text

LIMIT = 120


def limited(bumps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The first bumps (bump_id, user_id, ts) of each user and hour; those without a user don't count."""
    order = Window.partitionBy("user_id", F.date_trunc("hour", "ts")).orderBy("ts", "bump_id")
    return bumps.where("user_id is not null").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= limit)


def resolved(bumps: DataFrame, products: DataFrame, listings: DataFrame) -> DataFrame:
    """bumps (bump_id, name, maker) with product_id: by merge identity, else by folded name (and brand, if given), else by
    a shop's name for it. Each distinct name is looked up once."""
    asked = bumps.select("name", "maker").distinct().withColumns({"k1": text.key_fold(F.col("maker")), "k2": text.key_fold(text.strip_quantity(F.col("name"))), "folded": text.fold(F.col("name")), "maker_folded": text.fold(F.col("maker"))})
    goods = products.select("product_id", "popularity", "name_folded", "brand_folded", F.split_part("merge_key", F.lit("|"), F.lit(1)).alias("k1"), F.split_part("merge_key", F.lit("|"), F.lit(2)).alias("k2"))
    best = F.max_by("product_id", F.struct("popularity", "product_id"))
    by_key = goods.groupBy("k1", "k2").agg(best.alias("by_key"))
    by_both = goods.groupBy(F.col("name_folded").alias("folded"), F.col("brand_folded").alias("maker_folded")).agg(best.alias("by_both"))
    by_name = goods.groupBy(F.col("name_folded").alias("folded")).agg(best.alias("by_name"))
    by_shop = listings.groupBy(text.fold(F.col("retailer_name")).alias("folded")).agg(F.max_by("product_id", F.struct("last_seen_at", "product_id")).alias("by_shop"))
    named = asked.join(by_key, ["k1", "k2"], "left").join(by_both, ["folded", "maker_folded"], "left").join(by_name, "folded", "left").join(by_shop, "folded", "left")
    pick = F.coalesce("by_key", F.when(F.col("maker").isNull(), F.col("by_name")).otherwise(F.col("by_both")), "by_shop")
    found = named.select(F.col("name").alias("n"), F.col("maker").alias("m"), pick.alias("product_id"))
    return bumps.join(found, bumps["name"].eqNullSafe(found["n"]) & bumps["maker"].eqNullSafe(found["m"]), "left").drop("n", "m")


def bump(bumps: DataFrame, products: DataFrame, listings: DataFrame, limit: int = LIMIT) -> DataFrame:
    """products with add_count raised."""
    n = resolved(limited(bumps, limit), products, listings).where("product_id is not null").groupBy("product_id").agg(F.count("*").alias("__n"))
    return products.join(n, "product_id", "left").withColumn("add_count", F.col("add_count") + F.coalesce("__n", F.lit(0))).drop("__n")
