"""Jobs that add columns to a DataFrame of products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text


def with_keys(products: DataFrame) -> DataFrame:
    """name_folded, brand_folded, merge_key, key_brand, key_name. Takes name, brand, quantity, unit."""
    key = text.merge_key(F.col("brand"), F.col("name"), F.col("quantity"), F.col("unit"))
    out = products.withColumns({"name_folded": text.fold(F.col("name")), "brand_folded": text.fold(F.col("brand")), "merge_key": key})
    return out.withColumns({"key_brand": F.split_part("merge_key", F.lit("|"), F.lit(1)), "key_name": F.split_part("merge_key", F.lit("|"), F.lit(2))})


def with_size(products: DataFrame, measured: str | None = None) -> DataFrame:
    """quantity, unit, canonical_quantity: from the measured struct (quantity, unit) where it has one, else from the name."""
    size = text.parse_quantity(F.col("name"))
    if measured:
        given = F.when(F.lower(f"{measured}.unit").isin("kg", "g", "l", "ml") & (F.col(f"{measured}.quantity") > 0), F.struct(F.col(f"{measured}.quantity").cast("decimal(18,3)").alias("quantity"), F.lower(f"{measured}.unit").alias("unit")))
        size = F.coalesce(given, size)
    out = products.withColumn("__size", size)
    out = out.withColumns({"quantity": F.col("__size.quantity"), "unit": F.col("__size.unit")}).drop("__size")
    return out.withColumn("canonical_quantity", text.canonical_quantity(F.col("quantity"), F.col("unit")))


def with_clean_fields(products: DataFrame, id_pattern: str | None = None, weighed_prefix: str | None = None) -> DataFrame:
    """gtin, brand, name, product_url and price made good; external_id from the URL where a pattern is given.

    weighed_prefix: codes that begin with it are a counter's own and are no gtin; others in the URL are.
    """
    given = F.col("price") if dict(products.dtypes)["price"] != "string" else text.parse_price(F.col("price"))  # numbers are no texts
    new = {
        "gtin": text.valid_gtin(F.col("gtin")), "brand": text.unshout_brand(text.usable_brand(F.col("brand"))), "name": text.unshout(text.squeeze(F.col("name"))),
        "product_url": text.https_url(F.col("product_url")), "price": given.cast("double"),
    }
    if id_pattern:
        own = F.nullif(F.regexp_extract("product_url", id_pattern, 1), F.lit(""))
        new["external_id"] = own
        if weighed_prefix is not None:
            new["gtin"] = F.when(~own.startswith(weighed_prefix), text.valid_gtin(own))
    return products.withColumns(new)


def with_category(products: DataFrame, rules: DataFrame, shelves: DataFrame | None = None, label: str = "shelf") -> DataFrame:
    """category by dictionary (retailer, shelf, category) or else by the first rule (retailer, ord, pattern, category).
    label: the column that says where a product stands, a shelf's name or an address.

    A label's leading shelf (up to a separator) is tried against the rules before the whole label. Rules are a shop's
    few dozen patterns; they join on retailer and label, so that each distinct label is matched once.
    """
    if label != "shelf":
        named = with_category(products.withColumnRenamed("shelf", "__shelf").withColumn("shelf", F.col(label)) if "shelf" in products.columns else products.withColumn("shelf", F.col(label)), rules, shelves)
        return named.drop("shelf").withColumnRenamed("__shelf", "shelf")
    labels = products.select("retailer", "shelf").where("shelf is not null").distinct()
    leading = F.trim(F.element_at(F.split(text.fold(F.col("shelf")), r"[&,/|]"), 1))
    tried = labels.join(rules, "retailer").select("retailer", "shelf", "ord", "category", F.regexp_like(leading, F.col("pattern")).alias("lead"), F.regexp_like(text.fold(F.col("shelf")), F.col("pattern")).alias("whole"))
    by_rule = tried.groupBy("retailer", "shelf").agg(
        F.coalesce(F.min_by("category", F.when(F.col("lead"), F.col("ord"))), F.min_by("category", F.when(F.col("whole"), F.col("ord")))).alias("ruled")
    )
    out = products.drop("category").join(by_rule, ["retailer", "shelf"], "left")
    if shelves is not None:
        out = out.join(shelves.select("retailer", "shelf", F.col("category").alias("known")).dropDuplicates(["retailer", "shelf"]), ["retailer", "shelf"], "left")
        return out.withColumn("category", F.coalesce("known", "ruled")).drop("known", "ruled")
    return out.withColumnRenamed("ruled", "category")


def with_flags(products: DataFrame) -> DataFrame:
    """available (from availability) and is_bundle."""
    return products.withColumns({"available": text.is_available(F.col("availability")), "is_bundle": text.is_bundle(F.col("name"))})


def _lines(column: str) -> F.Column:
    return F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def leaflet_names(offers: DataFrame) -> DataFrame:
    """name and brand of leaflet offers (title, subtitle, detail_title, detail_description).

    The title is the brand where the first line of the description says the same, and the subtitle then is the name;
    else the detail title is. Offers of several variants and plain reductions go.
    """
    title, detail = F.trim(F.coalesce("title", F.lit(""))), _lines("detail_description")
    branded = F.coalesce(text.key_fold(F.try_element_at(detail, F.lit(1))) == text.key_fold(title), F.lit(False)) & (F.size(detail) > 0)
    name = F.when(branded, F.try_element_at(_lines("subtitle"), F.lit(1))).otherwise(F.array_join(_lines("detail_title"), " "))
    several = F.regexp_like(F.concat_ws("\n", "subtitle", "detail_description"), F.lit("(?i)diverse sortimente"))
    reduced = F.regexp_like(F.coalesce("detail_title", F.lit("")), F.lit("(?i)^reducere cu"))
    kept = offers.where((title != "") & ~title.contains("/") & ~several & ~reduced)
    return kept.withColumns({"name": name, "brand": F.when(branded, text.usable_brand(title))}).where("name <> ''")


def promo_names(products: DataFrame) -> DataFrame:
    """Names without a deposit suffix; rows that name several goods, or goods out of a leaflet, go."""
    name = text.squeeze(F.regexp_replace("name", r"(?is)\s*\+?\s*garantie sgr.*$", ""))
    named = products.withColumn("name", name)
    return named.where((F.col("name") != "") & ~F.col("name").contains("/") & ~F.regexp_like("name", F.lit("(?i)diverse sortimente|din pliant")))
