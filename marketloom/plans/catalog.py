"""The catalog's tables laid over the star schema of the test data."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.operators.match import derived
from marketloom.schema import CATEGORIES, PRICE, SIZE
from marketloom.session import written


class Catalog:
    """The tables. Each is laid out when a query first asks for it, from the folder's files as they are then; what several
    tables are made from is written once for the query. Nothing outlives the query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def shops(self) -> DataFrame:
        return retailers(self.spark, self.sf_dir)

    @cached_property
    def goods(self) -> DataFrame:
        return products(self.spark, self.sf_dir)

    @cached_property
    def retailer(self) -> DataFrame:
        """retailer (slug), market, enabled."""
        return self.shops.drop("retailer_id")

    @cached_property
    def observation(self) -> DataFrame:
        """product_id, retailer_id, seen_at, price, available, ordinal."""
        return observations(self.spark, self.sf_dir)

    @cached_property
    def listing(self) -> DataFrame:
        """product_id, retailer, external_id, what the shop says of it, price, currency, available, and times."""
        named = self.goods.select("product_id", "canonical_name", "brand", "category")
        # Dealt by product once: the windows and the join with the products need no other shuffle.
        seen = latest(logged(self.spark, self.sf_dir).repartition("product_id"), _LOGGED)
        listing = seen.join(F.broadcast(self.shops.select("retailer_id", "retailer")), "retailer_id").join(named, "product_id")
        own = F.when(F.col("retailer_id") % 2 == 0, F.col("canonical_name")).otherwise(F.concat_ws(" ", "canonical_name", "brand"))
        return written(listing.select(
            "product_id", "retailer", F.col("product_id").cast("string").alias("external_id"), own.alias("retailer_name"), F.col("brand").alias("retailer_brand"), F.col("category").alias("retailer_category"), "price", F.lit("EUR").alias("currency"), "available",
            F.concat(F.lit("https://"), "retailer", F.lit("/p/"), F.col("product_id").cast("string")).alias("product_url"), "previous_price", "last_price_at", "first_seen_at", "last_seen_at",
        ))

    @cached_property
    def product(self) -> DataFrame:
        """product_id, canonical_name, brand, size, category, gtin, add_count and what derived() adds."""
        return written(derived(with_bumps(self.spark, self.sf_dir, self.goods), self.listing))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def retailers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    s = read(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return s.select(F.col("s_suppkey").alias("retailer_id"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("retailer"), F.col("r_name").alias("market"), (F.col("s_acctbal") >= 0).alias("enabled"))


def check_digit(padded: F.Column) -> F.Column:
    total = sum((F.substring(padded, k + 1, 1).cast("int") * (1 if k % 2 == 0 else 3) for k in range(12)), F.lit(0))
    return ((10 - total % 10) % 10).cast("string")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    unit = F.when(F.col("p_type").isin("LARGE", "STANDARD"), "g").when(F.col("p_type").isin("MEDIUM", "SMALL"), "ml")
    code = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    shelf = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.col("p_size") % len(CATEGORIES) + 1).cast("int"))
    return p.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("canonical_name"), F.col("p_brand").alias("brand"),
        F.when(unit.isNotNull(), F.col("p_size").cast(SIZE)).alias("quantity"), unit.alias("quantity_unit"), shelf.alias("category"),
        F.when(F.col("p_partkey") % 3 != 0, F.concat(code, check_digit(code))).alias("gtin"),
    )


#: What orders the observations of one listing.
_LOGGED = ["seen_at", "l_orderkey", "l_linenumber"]


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was seen of each listing and when; _LOGGED orders the observations of one listing."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("retailer_id"), F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("seen_at"), F.col("l_extendedprice").cast(PRICE).alias("price"),
        (F.col("l_returnflag") != "R").alias("available"), "l_orderkey", "l_linenumber",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was seen of each listing and when; ordinal orders the observations of one listing."""
    order = Window.partitionBy("retailer_id", "product_id").orderBy(*_LOGGED)
    return logged(spark, sf_dir).withColumn("ordinal", F.row_number().over(order)).drop("l_orderkey", "l_linenumber")


def latest(observed: DataFrame, by: list[str] = ["ordinal"]) -> DataFrame:  # noqa: B006
    """A row for each listing: the last observation, and when it was first seen, last seen and last repriced. by: columns
    that order the observations of a listing.

    previous_price moves only when the price differs from the one before; first_seen_at and last_price_at start with the
    first observation. All windows share one order, and so one sort.
    """
    order = Window.partitionBy("retailer_id", "product_id").orderBy(*by)
    so_far, before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), F.lag("price").over(order)
    placed = observed.withColumns({"before": before, "seen": F.row_number().over(order), "is_last": F.lead(F.lit(True)).over(order).isNull(), "first_seen_at": F.min("seen_at").over(so_far)})
    moved = (F.col("seen") == 1) | ~F.col("before").eqNullSafe(F.col("price"))
    out = placed.withColumn("change", F.last(F.when(moved, F.struct("seen_at", "before")), ignorenulls=True).over(so_far)).where("is_last")
    return out.select("retailer_id", "product_id", "price", "available", "first_seen_at", F.col("seen_at").alias("last_seen_at"), F.col("change.before").alias("previous_price"), F.col("change.seen_at").alias("last_price_at"), F.col("seen").cast("long").alias("seen"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, sf_dir)


def with_bumps(spark: SparkSession, sf_dir: str, goods: DataFrame) -> DataFrame:
    """add_count from the purchases among events, spread over the products by event id."""
    n = read(spark, sf_dir, "part").count()
    bought = read(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy((F.col("event_id") % n).alias("product_id")).agg(F.count("*").alias("add_count"))
    return goods.join(bought, "product_id", "left").withColumn("add_count", F.coalesce("add_count", F.lit(0)))


_DIGITS = " + ".join(f"CAST(substr(lpad(CAST(p_partkey AS VARCHAR), 12, '0'), {k + 1}, 1) AS INTEGER) * {1 if k % 2 == 0 else 3}" for k in range(12))
_CATEGORY = "CASE CAST(p_size % 17 AS INTEGER) " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(CATEGORIES)) + " END"
#: The same tables as common table expressions.
SQL = f"""
retailer AS (SELECT s_suppkey AS retailer_id, lower(replace(s_name, '#', '-')) AS retailer, r_name AS market, s_acctbal >= 0 AS enabled
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
goods AS (SELECT *, CASE WHEN quantity_unit IS NOT NULL THEN p_size END AS quantity FROM (
  SELECT p_partkey AS product_id, p_name AS canonical_name, p_brand AS brand, p_size, {_CATEGORY} AS category,
    CASE WHEN p_type IN ('LARGE', 'STANDARD') THEN 'g' WHEN p_type IN ('MEDIUM', 'SMALL') THEN 'ml' END AS quantity_unit,
    CASE WHEN p_partkey % 3 <> 0 THEN lpad(CAST(p_partkey AS VARCHAR), 12, '0') || CAST((10 - ({_DIGITS}) % 10) % 10 AS VARCHAR) END AS gtin FROM part)),
observation AS (SELECT l_suppkey AS retailer_id, l_partkey AS product_id, l_shipdate AS seen_at, l_extendedprice AS price, l_returnflag <> 'R' AS available,
  row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS ordinal FROM lineitem),
moved AS (SELECT *, lag(price) OVER (PARTITION BY retailer_id, product_id ORDER BY ordinal) AS before FROM observation),
latest AS (SELECT retailer_id, product_id, arg_max(price, ordinal) AS price, arg_max(available, ordinal) AS available, min(seen_at) AS first_seen_at, max(seen_at) AS last_seen_at,
  arg_max(before, ordinal) FILTER (WHERE ordinal > 1 AND before IS DISTINCT FROM price) AS previous_price, arg_max(seen_at, ordinal) FILTER (WHERE ordinal = 1 OR before IS DISTINCT FROM price) AS last_price_at FROM moved GROUP BY 1, 2),
listing AS (SELECT l.*, r.retailer, r.market, r.enabled, CAST(l.product_id AS VARCHAR) AS external_id, g.canonical_name, g.brand AS retailer_brand, 'EUR' AS currency,
  CASE WHEN l.retailer_id % 2 = 0 THEN g.canonical_name ELSE g.canonical_name || ' ' || g.brand END AS retailer_name FROM latest l JOIN retailer r USING (retailer_id) JOIN goods g USING (product_id)),
bought AS (SELECT event_id % (SELECT count(*) FROM part) AS product_id, count(*) AS add_count FROM events WHERE event_type = 'purchase' GROUP BY 1),
listed AS (SELECT product_id, count(*) AS listing_count, min(first_seen_at) AS first_seen_at, string_agg(DISTINCT lower(retailer_name), ' ' ORDER BY lower(retailer_name)) AS names FROM listing GROUP BY 1),
product AS (SELECT g.*, coalesce(add_count, 0) AS add_count, coalesce(listing_count, 0) AS listing_count, coalesce(add_count, 0) + 5 * coalesce(listing_count, 0) AS popularity, first_seen_at,
  lower(canonical_name) AS name_folded, lower(brand) AS brand_folded, left(trim(lower(canonical_name) || ' ' || lower(brand) || ' ' || coalesce(names, '')), 1000) AS search_blob,
  trim(regexp_replace(lower(brand), '[^a-z0-9%]+', ' ', 'g')) || '|' || trim(regexp_replace(lower(canonical_name), '[^a-z0-9%]+', ' ', 'g')) || '|' || coalesce(quantity_unit || ':' || CAST(quantity AS VARCHAR), '-') AS merge_key
  FROM goods g LEFT JOIN bought USING (product_id) LEFT JOIN listed USING (product_id))
"""
