"""Validation of product records, exclusions, and constraints as data checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import text
from marketloom.schema import CATEGORIES, CONSTRAINTS, PRICE, SIZE, UNIQUE, UNITS


def validate(products: DataFrame, default_currency: str = "RON") -> DataFrame:
    """The import row of each record, and reject_reason: the first rule it breaks, or null."""
    own_id, name, url = F.trim("external_id"), text.squeeze(F.col("name")), text.https_url(F.col("product_url"))
    price = F.col("price").cast("double")
    reason = (
        F.when(F.coalesce(own_id, F.lit("")) == "", "no-external-id").when(F.length(own_id) > 100, "no-external-id")
        .when(F.coalesce(name, F.lit("")) == "", "no-name").when(F.length(name) > 200, "name-too-long").when(url.isNull(), "no-url")
        .when(price.isNotNull() & (F.isnan(price) | (price < 0) | (price > 1_000_000)), "bad-price")
    )
    size = F.col("quantity").cast("double")
    sized = ~F.isnan(size) & (size > 0) & (size <= 1_000_000) & F.col("unit").isin(UNITS)
    brand = F.trim("brand")
    return products.withColumns({
        "reject_reason": reason, "external_id": own_id, "name": name, "product_url": url, "price": F.when(reason.isNull(), price.cast(PRICE)),
        "brand": F.when((brand != "") & (F.length(brand) <= 80), brand), "gtin": text.valid_gtin(F.col("gtin")),
        "currency": F.when(price.isNotNull(), F.left(F.upper(F.coalesce("currency", F.lit(default_currency))), F.lit(3))),
        "quantity": F.when(sized, F.col("quantity").cast(SIZE)), "unit": F.when(sized, F.col("unit")),
        "category": F.when(F.col("category").isin(CATEGORIES), F.col("category")), "available": F.coalesce("available", F.lit(True)),
    })


def split(products: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, rejected, excluded): bundles are set aside before they count as found."""
    marked = products.withColumn("__bundle", text.is_bundle(F.col("name")))
    checked = validate(marked.where("not __bundle").drop("__bundle"))
    return checked.where("reject_reason is null").drop("reject_reason"), checked.where("reject_reason is not null"), marked.where("__bundle").drop("__bundle")


def reject_histogram(checked: DataFrame) -> DataFrame:
    return checked.where("reject_reason is not null").groupBy("reject_reason").agg(F.count("*").alias("n"))


def violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """(table, key, constraint) for each constraint that a row breaks."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(rule), F.lit(True)), F.lit(name)) for name, rule in CONSTRAINTS[table].items()]))
    return df.select(F.lit(table).alias("table"), F.col(key).cast("string").alias("key"), F.explode(broken).alias("constraint"))


def duplicates(df: DataFrame, table: str) -> DataFrame:
    """(table, columns, key, n) for each combination of unique columns that occurs more than once; nulls are no key."""
    found = [
        df.where(" and ".join(f"{c} is not null" for c in columns)).groupBy(F.concat_ws("|", *columns).alias("key")).agg(F.count("*").alias("n")).where("n > 1")
        .select(F.lit(table).alias("table"), F.lit(",".join(columns)).alias("columns"), "key", "n")
        for columns in UNIQUE[table]
    ]
    return reduce(DataFrame.unionByName, found)


def dangling(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key the parent does not have."""
    return child.join(parent.select(key).distinct(), key, "left_anti")
