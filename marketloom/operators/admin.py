"""Browsing, edits and health reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.schema import CATEGORIES
from marketloom.session import written


def browse(products: DataFrame, identifiers: DataFrame, listings: DataFrame, *, query=None, category=None, has_brand=None, has_quantity=None, has_listing=None, earned=None, added_since=None, retailer=None, has_barcode=None, available=None, limit: int = 25, offset: int = 0) -> DataFrame:
    """A page of products with shops, barcodes and price, and the total. Filters that are None don't apply.

    The page is chosen on the narrow table first; listings are folded for its products alone.
    """
    if category is not None and category not in CATEGORIES:
        raise ValueError(f"unknown category: {category}")
    found = products
    folded = text.fold(F.lit(query)) if query else None
    if folded is not None:
        found = found.where(F.contains("search_blob", folded))
    if category is not None:
        found = found.where(F.col("category") == category)
    for flag, condition in ((has_brand, F.col("brand").isNotNull()), (has_quantity, F.col("quantity").isNotNull()), (has_listing, F.col("listing_count") > 0), (earned, F.col("add_count") > 0)):
        if flag is not None:
            found = found.where(condition == F.lit(flag))
    if added_since is not None:
        found = found.where(F.col("first_seen_at") >= F.lit(added_since).cast("timestamp"))
    for flag, having in ((True if retailer else None, listings.where(F.col("retailer") == retailer)), (has_barcode, identifiers.where("identifier_type = 'gtin'")), (available, listings.where("available"))):
        if flag is not None:
            found = found.join(having.select("product_id").distinct(), "product_id", "left_semi" if flag else "left_anti")
    narrow = found.select("product_id", "popularity", "canonical_name")
    total = narrow.agg(F.count("*").alias("total_count"))
    chosen = narrow.orderBy(F.col("popularity").desc(), "canonical_name", "product_id").offset(max(offset, 0)).limit(min(max(limit, 1), 200)).select("product_id")
    on_page = F.broadcast(chosen)  # at most 200 rows
    shelf = listings.join(on_page, "product_id").groupBy("product_id").agg(F.array_sort(F.collect_set("retailer")).alias("retailers"), F.min(F.when(F.col("available"), F.col("price"))).alias("min_price"), F.min("currency").alias("currency"), F.bool_or("available").alias("available"))
    codes = identifiers.where("identifier_type = 'gtin'").join(on_page, "product_id").groupBy("product_id").agg(F.array_sort(F.collect_list("identifier_value")).alias("barcodes"))
    out = products.join(on_page, "product_id").join(shelf, "product_id", "left").join(codes, "product_id", "left").crossJoin(F.broadcast(total))
    empty = F.array().cast("array<string>")
    return out.select("product_id", "canonical_name", "brand", "category", "quantity", "quantity_unit", "add_count", "listing_count", "popularity", F.coalesce("retailers", empty).alias("retailers"), F.coalesce("barcodes", empty).alias("barcodes"), "min_price", "currency", F.coalesce("available", F.lit(False)).alias("available"), "merge_key", "first_seen_at", "total_count")


def totals(products: DataFrame, identifiers: DataFrame, listings: DataFrame) -> DataFrame:
    """One row: products, listings, unavailable, identifiers, with_barcode, with_price, earned, orphans."""
    p = products.agg(F.count("*").alias("products"), F.count_if(F.col("add_count") > 0).alias("earned"), F.count_if(F.col("listing_count") == 0).alias("orphans"))
    li = listings.agg(F.count("*").alias("listings"), F.count_if(~F.col("available")).alias("unavailable"), F.count_distinct(F.when(F.col("price").isNotNull(), F.col("product_id"))).alias("with_price"))
    i = identifiers.agg(F.count("*").alias("identifiers"), F.count_distinct("product_id").alias("with_barcode"))
    return p.crossJoin(F.broadcast(li)).crossJoin(F.broadcast(i))


def by_retailer(listings: DataFrame, retailers: DataFrame) -> DataFrame:
    counts = listings.groupBy("retailer").agg(F.count("*").alias("listings"), F.count_if("available").alias("available"))
    return retailers.join(counts, "retailer", "left").select("retailer", "market", "enabled", F.coalesce("listings", F.lit(0)).alias("listings"), F.coalesce("available", F.lit(0)).alias("available"))


def by_market(listings: DataFrame, retailers: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Markets that have listings: products, listings, unavailable, with_barcode."""
    barred = identifiers.select("product_id").distinct().withColumn("barred", F.lit(True))
    sold = listings.join(retailers.select("retailer", "market"), "retailer").join(barred, "product_id", "left")
    per_product = sold.groupBy("market", "product_id").agg(F.count("*").alias("n"), F.count_if(~F.col("available")).alias("out"), F.bool_or("barred").alias("barred"))
    return per_product.groupBy("market").agg(F.count("*").alias("products"), F.sum("n").alias("listings"), F.sum("out").alias("unavailable"), F.count_if("barred").alias("with_barcode"))


def retailer_health(listings: DataFrame, retailers: DataFrame, runs: DataFrame) -> DataFrame:
    """by_retailer with the last run, what the second-last completed run found, and the difference."""
    latest = Window.partitionBy("retailer").orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    last = runs.withColumn("n", F.row_number().over(latest)).where("n = 1").select("retailer", F.col("run_id").alias("last_run_id"), F.col("status").alias("last_status"), F.col("started_at").alias("last_started_at"), F.col("products_valid").alias("last_valid"))
    prev = runs.where("status = 'completed'").withColumn("n", F.row_number().over(latest)).where("n = 2").select("retailer", F.col("products_valid").alias("previous_valid"))
    return by_retailer(listings, retailers).join(last, "retailer", "left").join(prev, "retailer", "left").withColumn("delta", F.col("last_valid") - F.col("previous_valid"))


def _checked(edits: DataFrame, products: DataFrame, identifiers: DataFrame) -> DataFrame:
    """edits (edit_id, product_id or null, name, brand, quantity, unit, barcode: as they would be) with error.

    Two edits of a batch that want one merge key, or one barcode for different products, are both refused.
    """
    key = text.merge_key(F.col("brand"), F.col("name"), F.col("quantity"), F.col("unit"))
    out = edits.withColumn("merge_key", key)
    same = products.select("merge_key", F.col("product_id").alias("same_key"))
    code = identifiers.where("identifier_type = 'gtin'").select(F.col("identifier_value").alias("barcode"), F.col("product_id").alias("same_code"))
    out = out.join(same, "merge_key", "left").join(code, "barcode", "left")
    twice = lambda c: F.col(c).isNotNull() & (F.count("*").over(Window.partitionBy(c)) > 1)
    other = lambda c: F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col("product_id"))
    error = (
        F.when(~F.coalesce(F.length(F.trim("name")).between(1, 200), F.lit(False)), "bad_name").when(F.col("barcode").isNotNull() & ~F.col("barcode").rlike("^[0-9]{8,14}$"), "bad_barcode")
        .when(other("same_key") | twice("merge_key"), "duplicate_product").when(other("same_code") | twice("barcode"), "duplicate_barcode")
    )
    return out.withColumn("error", error).drop("same_key", "same_code")


def create(edits: DataFrame, products: DataFrame, identifiers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, identifiers after, rejected) of new products (edit_id, name, brand, quantity, unit, category, barcode)."""
    checked = written(_checked(edits.withColumn("product_id", F.lit(None).cast("string")), products, identifiers))
    accepted = checked.where("error is null").withColumn("product_id", F.concat(F.lit("admin:"), F.sha2("merge_key", 256)))
    return accepted.drop("error"), identifiers.unionByName(_codes(accepted)), checked.where("error is not null")


def _codes(edits: DataFrame) -> DataFrame:
    return edits.where("barcode is not null").select(F.col("product_id").cast("string").alias("product_id"), F.lit("gtin").alias("identifier_type"), F.col("barcode").alias("identifier_value"), F.lit("admin").alias("source"))


def update(edits: DataFrame, products: DataFrame, identifiers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products after, identifiers after, rejected). In edits (edit_id, product_id, name, brand, category, barcode) null
    leaves a field, an empty text clears it, anything else sets it. A barcode replaces the one an editor gave before, and
    an empty one takes it away; codes from shops stay. Of several edits of a product the last by edit_id counts."""
    order = Window.partitionBy("product_id").orderBy(F.col("edit_id").desc())
    edits = edits.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    now = products.select("product_id", "canonical_name", F.col("brand").alias("old_brand"), "quantity", F.col("quantity_unit").alias("unit"), F.col("category").alias("old_category"))
    three = lambda new, old: F.when(F.col(new).isNull(), F.col(old)).when(F.trim(new) == "", None).otherwise(F.trim(new))
    wanted = edits.join(now, "product_id", "left").withColumns({
        "name": F.when(F.col("name").isNull(), F.col("canonical_name")).otherwise(F.trim("name")), "brand": three("brand", "old_brand"), "category": three("category", "old_category"),
        "recoded": F.col("barcode").isNotNull(), "barcode": F.nullif(F.trim("barcode"), F.lit("")),
    })
    checked = written(_checked(wanted, products, identifiers).withColumn("error", F.when(F.col("canonical_name").isNull(), "unknown_product").otherwise(F.col("error"))))
    accepted = checked.where("error is null")
    good = accepted.select("product_id", F.col("name").alias("n"), F.col("brand").alias("b"), F.col("category").alias("c"), F.col("merge_key").alias("k"), F.lit(True).alias("edited"))
    both = products.join(good, "product_id", "left")
    pick = lambda new, old: F.when(F.col("edited"), F.col(new)).otherwise(F.col(old))
    after = both.withColumns({"canonical_name": pick("n", "canonical_name"), "brand": pick("b", "brand"), "category": pick("c", "category"), "merge_key": pick("k", "merge_key")}).select(products.columns)
    replaced = accepted.where("recoded").select("product_id", F.lit("gtin").alias("identifier_type"), F.lit("admin").alias("source"))
    left = identifiers.join(replaced, ["product_id", "identifier_type", "source"], "left_anti").select(identifiers.columns)
    added = _codes(accepted).join(left.select("identifier_type", "identifier_value"), ["identifier_type", "identifier_value"], "left_anti")
    return after, left.unionByName(added.select(identifiers.columns)), checked.where("error is not null").select("edit_id", "product_id", "error")


def snapshot(products: DataFrame, identifiers: DataFrame, listings: DataFrame, retailers: DataFrame, now) -> DataFrame:
    """One row: counted_at, totals, and the counts by retailer and by market as maps. The maps have an entry for each of
    the retailers and markets, which are few."""
    one = lambda df, key, name: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, F.struct(*[c for c in df.columns if c != key]))))).alias(name))
    total = totals(products, identifiers, listings)
    total = total.select(F.lit(now).cast("timestamp").alias("counted_at"), F.struct(*total.columns).alias("totals"))
    shops = one(by_retailer(listings, retailers).select("retailer", "listings", "available"), "retailer", "retailers")
    return total.crossJoin(F.broadcast(shops)).crossJoin(F.broadcast(one(by_market(listings, retailers, identifiers), "market", "markets")))


def delete(keys: DataFrame, *tables: DataFrame) -> tuple[DataFrame, ...]:
    """The tables (products, listings, identifiers) without the products of keys."""
    return tuple(t.join(keys.select("product_id").distinct(), "product_id", "left_anti") for t in tables)
