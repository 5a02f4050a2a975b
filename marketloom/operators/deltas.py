"""What follows from listings, kept up by signed changes instead of recounts.

A change of a listing is its old facts with -1 and its new ones with +1. Counted tables hold facts and how often they are
so (a multiset), so that a change can be taken back: a name goes when the last listing that shows it does. Only products
that a change touches are computed anew, and only their counted names are read for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import text

_FACTS = ["product_id", "retailer_name", "first_seen_at", "available"]
#: Keys of the counted tables.
NAMES, SHOPS = ["product_id", "name", "first_seen_at"], ["retailer", "available"]


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(retailer, product_id, name, first_seen_at, available, n): n is -1 for what no longer holds and 1 for what now does.

    old, new: listings (retailer, external_id, ...), one row each; what is in one of them alone went or came. Listings
    that show the same facts as before are no change. Names are folded for changed listings only.
    """
    side = lambda df, c: df.select("retailer", "external_id", F.struct(*_FACTS).alias(c))
    both = side(old, "was").join(side(new, "is"), ["retailer", "external_id"], "full_outer").where(~F.col("was").eqNullSafe(F.col("is")))
    signed = both.select("retailer", F.explode(F.array(F.struct(F.col("was").alias("f"), F.lit(-1).alias("n")), F.struct(F.col("is").alias("f"), F.lit(1).alias("n")))).alias("x"))
    facts = signed.where("x.f is not null").select("retailer", "x.f.product_id", text.fold(F.col("x.f.retailer_name")).alias("name"), "x.f.first_seen_at", "x.f.available", F.col("x.n").cast("long").alias("n"))
    return facts.groupBy(*[c for c in facts.columns if c != "n"]).agg(F.sum("n").alias("n")).where("n <> 0")


def merged(counted: DataFrame, signed: DataFrame, keys: list[str]) -> DataFrame:
    """counted (keys, n) after signed changes; what is counted down to nothing goes. Where signed changes a product (or
    another first key), the rows of that key are added up; all others pass as they are."""
    first, change = keys[0], signed.groupBy(*keys).agg(F.sum("n").alias("n"))
    touched = change.select(first).distinct()
    moved = counted.join(touched, first, "left_semi").select(*keys, "n").unionByName(change)
    kept = counted.join(touched, first, "left_anti").select(*keys, "n")
    return kept.unionByName(moved.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0"))


def refreshed(products: DataFrame, names: DataFrame, touched: DataFrame) -> DataFrame:
    """products with listing_count, popularity, first_seen_at and search_blob made anew for the touched ones.

    products: as match.derived gives them; names: counted by NAMES; touched: product_id. A product that lost its last
    listing counts none and keeps the time when it was first seen.
    """
    touched = touched.select("product_id").distinct()
    own = names.join(touched, "product_id", "left_semi").groupBy("product_id").agg(
        F.sum("n").alias("listings"), F.array_join(F.array_sort(F.collect_set("name")), " ").alias("names"), F.min("first_seen_at").alias("seen")
    )
    moved = products.join(touched, "product_id", "left_semi").join(own, "product_id", "left")
    count = F.coalesce("listings", F.lit(0).cast("long"))
    new = {
        "listing_count": count, "popularity": F.col("add_count") + 5 * count, "first_seen_at": F.coalesce("seen", "first_seen_at"),
        "search_blob": F.left(text.squeeze(F.concat_ws(" ", "name_folded", "brand_folded", F.coalesce("names", F.lit("")))), F.lit(1000)),
    }
    return products.join(touched, "product_id", "left_anti").unionByName(moved.withColumns(new).select(products.columns))


def shop_counts(shops: DataFrame) -> DataFrame:
    """retailer, listings, available of the table counted by SHOPS."""
    return shops.groupBy("retailer").agg(F.sum("n").alias("listings"), F.coalesce(F.sum(F.when(F.col("available"), F.col("n"))), F.lit(0)).cast("long").alias("available"))
