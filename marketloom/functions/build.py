"""One projection from what a page says to a product record, driven by a row of policy for each shop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import text

#: A shop's policy: the id in its URLs, its currency, whether its prices are kept, whether it counts as in stock whatever
#: the page says, the beginning of codes that are its own, and whether codes are taken from the URL's id.
POLICY = "retailer string, id_pattern string, currency string, keeps_price boolean, always_available boolean, weighed_prefix string, gtin_from_id boolean"


def product_records(extracted: DataFrame, policies: DataFrame) -> DataFrame:
    """Product records of extracted pages (retailer, url, name, brand, gtin, price, currency, availability, category).

    A price counts if it is above zero and the shop's prices are kept; without a price there is no currency; the size is
    read from the name. Pages without an id or a name, and pages of shops without a policy, give no record.
    """
    known = extracted.withColumnRenamed("currency", "given").join(policies, "retailer")
    own = F.nullif(F.expr("regexp_extract(url, id_pattern, 1)"), F.lit(""))
    price = F.when(F.col("keeps_price") & (F.col("price") > 0), F.col("price").cast("double"))
    coded = F.when(F.col("gtin_from_id"), own).otherwise(F.col("gtin"))
    ours = F.coalesce(F.startswith(coded, F.col("weighed_prefix")), F.lit(False))
    size = text.parse_quantity(F.col("name"))
    out = known.select(
        "retailer", own.alias("external_id"), text.unshout(text.squeeze(F.col("name"))).alias("name"), text.unshout_brand(text.usable_brand(F.col("brand"))).alias("brand"),
        F.when(~ours, text.valid_gtin(coded)).alias("gtin"), price.alias("price"), F.when(price.isNotNull(), F.coalesce("given", "currency")).alias("currency"),
        size["quantity"].cast("double").alias("quantity"), size["unit"].alias("unit"), "category", text.https_url(F.col("url")).alias("product_url"),
        (F.col("always_available") | text.is_available(F.col("availability"))).alias("available"),
    )
    return out.where("external_id is not null and coalesce(name, '') <> ''")
