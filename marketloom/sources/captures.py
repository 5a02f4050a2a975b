"""Sources over captured pages and files, never a live site."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import jsonld, text
from marketloom.schema import PRODUCT_RECORD


def outcomes(pages: DataFrame, product_found: Column, excluded: Column | None = None) -> DataFrame:
    """pages (status) with outcome: parsed, delisted, failed, excluded or noProduct."""
    refused = F.lit(False) if excluded is None else excluded
    return pages.withColumn(
        "outcome",
        F.when(F.col("status").isin(404, 410), "delisted").when(~F.col("status").between(200, 299), "failed").when(refused, "excluded").when(~product_found, "noProduct").otherwise("parsed"),
    )


def crawled(pages: DataFrame, refused: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, counters) of captured pages (url, status, body; status null: not fetched).

    records: what the JSON-LD of each parsed page says, with the page's other columns. counters, one row: urls, fetched,
    skipped, delisted, no_product, excluded, failed. refused: pages that are read and then set aside.
    """
    answered = pages.where(F.col("status").between(200, 299)).select("url", "body")
    said = jsonld.products(answered.withColumnRenamed("url", "page_url"), "page_url", "body").withColumnRenamed("url", "said_url")
    marked = outcomes(pages.join(said.withColumnRenamed("page_url", "url"), "url", "left"), F.col("name").isNotNull(), refused)
    marked = marked.withColumn("outcome", F.when(F.col("status").isNull(), "skipped").otherwise(F.col("outcome")))
    count = lambda o: F.count_if(F.col("outcome") == o)
    counters = marked.agg(F.count("*").alias("urls"), F.count("status").alias("fetched"), *[count(o).alias(n) for o, n in (("skipped", "skipped"), ("delisted", "delisted"), ("noProduct", "no_product"), ("excluded", "excluded"), ("failed", "failed"))])
    return marked.where("outcome = 'parsed'").drop("outcome", "status", "body"), counters


def page_shelf(body: Column, path: str, primary: str) -> Column:
    """struct(path, primary): the shelf that a page's state names. path, primary: patterns with one group; an empty
    answer is none."""
    at = F.nullif(F.regexp_extract(body, path, 1), F.lit(""))
    return F.struct(F.filter(F.split(F.coalesce(at, F.lit("")), "/"), lambda x: x != "").alias("path"), F.nullif(F.regexp_extract(body, primary, 1), F.lit("")).alias("primary"))


def deepest_link(links: Column, pattern: str) -> Column:
    """Of the links that match the one with the most segments, of equal ones the first."""
    fitting = F.filter(links, lambda x: F.regexp_like(x, F.lit(pattern)))
    return F.array_max(F.transform(fitting, lambda x, i: F.struct(F.size(F.split(x, "/+")).alias("n"), (-i).alias("i"), x.alias("link"))))["link"]


def _decoded(value: Column) -> Column:
    value = F.regexp_replace(value, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    for sign, meant in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'")):
        value = F.replace(value, F.lit(sign), F.lit(meant))
    codes = F.array_distinct(F.regexp_extract_all(value, F.lit(r"&#(\d{1,7});"), F.lit(1)))
    there = F.filter(codes, lambda c: (c.cast("int") <= 0x10FFFF) & ~c.cast("int").between(0xD800, 0xDFFF))
    letter = lambda c: F.decode(F.unhex(F.lpad(F.hex(c.cast("int")), 8, "0")), "UTF-32")
    value = F.aggregate(there, value, lambda v, c: F.replace(v, F.concat(F.lit("&#"), c, F.lit(";")), letter(c)))
    return F.trim(F.replace(value, F.lit("&amp;"), F.lit("&")))


def sitemap_index(files: DataFrame, body: str = "body") -> DataFrame:
    """loc: the sitemaps that index files name, each once."""
    locs = F.regexp_extract_all(body, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    named = files.where(F.regexp_like(body, F.lit("(?i)<sitemapindex"))).select(F.explode(locs).alias("loc"))
    return named.select(_decoded(F.col("loc")).alias("loc")).where("loc <> ''").distinct()


def urlset(files: DataFrame, body: str = "body", order: str | None = None) -> DataFrame:
    """loc and lastmod of each url block; an empty loc falls back to the alternate link; a bad date is null; broken XML
    gives fewer rows, never an error. With order, the column that orders the files, that and each block's place in its
    file come along."""
    kept = [] if order is None else [order, "place"]
    block = files.select(*kept[:1], F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<url>(.*?)</url>"), F.lit(1))).alias("place", "b"))
    loc = _decoded(F.regexp_extract("b", r"(?is)<loc>\s*(.*?)\s*</loc>", 1))
    other = _decoded(F.regexp_extract("b", r"""(?is)<xhtml:link\b[^>]*?\bhref=["']([^"']+)["']""", 1))
    stamp = F.regexp_extract("b", r"(?is)<lastmod>\s*(.*?)\s*</lastmod>", 1)
    return block.select(*kept, F.coalesce(F.nullif(loc, F.lit("")), other).alias("loc"), F.try_to_timestamp(F.nullif(stamp, F.lit(""))).alias("lastmod")).where("loc <> ''")


def incremental(entries: DataFrame, since) -> DataFrame:
    return entries if since is None else entries.where(F.col("lastmod").isNull() | (F.col("lastmod") >= F.lit(since).cast("timestamp")))


def shard(entries: DataFrame, i: int, n: int, *order: str) -> DataFrame:
    """Every nth entry by its place in the order (columns: the sitemap's and the place in it, as urlset gives them): rows
    are counted within ranges of it, so that no task holds all of them. To be taken after the incremental filter."""
    from marketloom.session import written

    placed = written(entries.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect()  # a row for each partition
    before, starts = 0, []
    for r in sizes:
        starts += [F.lit(r["__part"]), F.lit(before)]
        before += r["n"]
    if not starts:
        return entries
    place = F.element_at(F.create_map(*starts), F.col("__part")) + F.col("__row")
    return placed.where(place % n == i).drop("__part", "__row")


def ndjson(spark: SparkSession, path: str, retailer: str) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines). Blank lines don't count; a record of another retailer fails the load."""
    schema = f"retailer string, {PRODUCT_RECORD}, _bad string"
    lines = spark.read.text(path).where(F.trim("value") != "")
    read = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    broken = F.col("r").isNull() | F.col("r._bad").isNotNull()
    good = read.where(~broken).select("r.*").drop("_bad")
    if good.where(F.col("retailer").isNotNull() & (F.col("retailer") != retailer)).limit(1).count():
        raise ValueError(f"the file holds records of another retailer than {retailer}")
    return good, read.where(broken).select(F.col("value").alias("_bad"))


def write_ndjson(records: DataFrame, path: str) -> None:
    records.write.json(path)


_VTEX = (
    "array<struct<productId:string,productName:string,productReference:string,brand:string,linkText:string,link:string,categories:array<string>,categoriesIds:array<string>,"
    "items:array<struct<itemId:string,name:string,ean:string,measurementUnit:string,unitMultiplier:double,"
    "sellers:array<struct<sellerId:string,sellerDefault:boolean,commertialOffer:struct<Price:double,ListPrice:double,AvailableQuantity:double,IsAvailable:boolean>>>>>>>"
)


def catalog_api(pages: DataFrame, body: str = "body") -> DataFrame:
    """Products of catalog API pages, each once; the seller is the default one, else number 1, else the first. The size is
    that of the item where it has a multiplier, and is left to the name where it has none."""
    rows = pages.select(F.explode(F.from_json(body, _VTEX)).alias("p")).select("p.*").withColumn("productId", F.trim("productId"))
    one = rows.where("productId <> '' and trim(productName) <> ''").dropDuplicates(["productId"])
    item = F.try_element_at("items", F.lit(1))
    sellers = item["sellers"]
    pick = F.coalesce(
        F.try_element_at(F.filter(sellers, lambda s: s["sellerDefault"]), F.lit(1)), F.try_element_at(F.filter(sellers, lambda s: s["sellerId"] == "1"), F.lit(1)), F.try_element_at(sellers, F.lit(1)),
    )
    offer = pick["commertialOffer"]
    return one.select(
        F.col("productId").alias("external_id"), text.unshout(text.squeeze(F.col("productName"))).alias("name"), text.unshout_brand(text.usable_brand(F.col("brand"))).alias("brand"), F.coalesce(text.valid_gtin(item["ean"]), text.valid_gtin(F.col("productReference"))).alias("gtin"),
        F.when(offer["Price"] > 0, offer["Price"]).alias("price"), F.struct(item["unitMultiplier"].alias("quantity"), item["measurementUnit"].alias("unit")).alias("measured"),
        F.col("link").alias("product_url"), F.coalesce(offer["IsAvailable"], offer["AvailableQuantity"] > 0, F.lit(False)).alias("available"), F.col("categories").alias("category_paths"), F.col("categoriesIds").alias("category_ids"),
    )


def api_total(header: Column) -> Column:
    """Total of a "from-to/total" header."""
    return F.nullif(F.regexp_extract(header, r"/(\d+)\s*$", 1), F.lit("")).cast("long")


def payload(body: Column | str, marker: str) -> Column:
    """What follows marker in a page, from the first brace on; from_json reads the value there and no further."""
    return F.nullif(F.regexp_extract(body, rf"(?s)\Q{marker}\E.*?(\{{.*)", 1), F.lit(""))


def department_pages(pages: DataFrame, body: str = "body", marker: str = "var impressionData") -> DataFrame:
    """pages with products (array) and unreadable: a page whose payload has no array of impressions is not the same as an
    empty one. A price that is no number above zero is null."""
    item = "struct<id:string,name:string,brand:string,price:double,category:string,dimension10:string>"
    listed = F.from_json(payload(body, marker), f"struct<ecommerce:struct<impressions:array<{item}>>>")["ecommerce"]["impressions"]
    price = lambda x: F.when(x["price"] > 0, x["price"])
    products = F.transform(F.coalesce(listed, F.array().cast(f"array<{item}>")), lambda x: x.withField("price", price(x)))
    return pages.withColumns({"unreadable": listed.isNull(), "products": products})


def leaflet_offers(pages: DataFrame, body: str = "body") -> DataFrame:
    """Offers of leaflet pages with the category they stand under, and their place; an offer of several categories is
    several rows (see first_shelf)."""
    offer = "struct<klNr:string,title:string,subtitle:string,unit:string,detailTitle:string,detailDescription:string>"
    shape = f"struct<cycles:array<struct<categories:array<struct<displayName:string,offers:array<{offer}>>>>>>"
    cycles = pages.select(F.posexplode(F.from_json(payload(body, '"offerData":'), shape)["cycles"]).alias("i", "c"))
    shelves = cycles.select("i", F.posexplode("c.categories").alias("j", "s"))
    offers = shelves.select("i", "j", F.col("s.displayName").alias("shelf"), F.posexplode("s.offers").alias("k", "o"))
    return offers.select(F.trim("o.klNr").alias("external_id"), F.array("i", "j", "k").alias("place"), "shelf", "o.title", "o.subtitle", F.col("o.unit").alias("unit_text"), F.col("o.detailTitle").alias("detail_title"), F.col("o.detailDescription").alias("detail_description")).where("external_id <> ''")


def first_shelf(offers: DataFrame, themed: str | None = None) -> DataFrame:
    """Each offer once, from the shelf that comes first on its page, and without its place.

    Offers of which any copy stands under a shelf that matches themed go as a whole, whichever shelf comes first.
    """
    kept = offers
    if themed is not None:
        kept = offers.join(offers.where(F.regexp_like("shelf", F.lit(themed))).select("external_id").distinct(), "external_id", "left_anti")
    first = F.min_by(F.struct(*[c for c in offers.columns if c != "external_id"]), F.struct("place", "shelf", "title"))
    return kept.groupBy("external_id").agg(first.alias("x")).select("external_id", "x.*").drop("place")


def _first(node, test, depth: int = 0):
    """The first object below node, depth first and eight levels down at most, for which test holds."""
    if depth > 8 or not isinstance(node, (dict, list)):
        return None
    if isinstance(node, dict) and test(node):
        return node
    return next((x for v in (node.values() if isinstance(node, dict) else node) if (x := _first(v, test, depth + 1)) is not None), None)


def _state_product(state: str) -> str | None:
    """Product and category levels, as JSON, of a page's state; its API data may be a text of JSON."""
    try:
        data = json.loads(state)
        for step in ("props", "pageProps", "apiData"):
            data = data.get(step) if isinstance(data, dict) else None
        data = json.loads(data) if isinstance(data, str) else data
    except ValueError:
        return None
    product = _first(data, lambda o: "mainCategoryID" in o and "name" in o)
    levels = _first(data, lambda o: isinstance(o.get("parentCategory"), (dict, list)))
    return None if product is None else json.dumps({"product": product, "levels": levels and levels["parentCategory"]})


def page_state_products(pages: DataFrame, key: str, body: str = "body") -> DataFrame:
    """The product in the page state of each page that has one. Only a stated availability counts as one; a price that is
    no number above zero is null; the shelf is the parent category, or else the product's own."""
    raw = pages.select(F.col(key).cast("string").alias(key), F.nullif(F.regexp_extract(body, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), F.lit("")).alias("state")).where("state is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(product=[_state_product(s) for s in b["state"]])[[key, "product"]]

    found = raw.mapInPandas(run, f"{key} string, product string").where("product is not null").withColumn("v", F.try_parse_json("product"))
    at = lambda path: F.try_variant_get("v", path, "string")
    said = lambda path: F.when(F.schema_of_variant(F.try_variant_get("v", path, "variant")) == "STRING", F.nullif(F.trim(at(path)), F.lit("")))
    price = F.when(~F.schema_of_variant(F.try_variant_get("v", "$.product.currentPrice.priceValue", "variant")).isin("STRING", "BOOLEAN"), F.try_variant_get("v", "$.product.currentPrice.priceValue", "double"))
    stock = F.try_variant_get("v", "$.product.isAvailable", "variant")
    return found.select(
        key, said("$.product.objectID").alias("external_id"), said("$.product.name").alias("name"), said("$.product.brandName").alias("brand"), said("$.product.salesUnit").alias("unit_text"),
        F.when(price > 0, price).alias("price"), F.coalesce((F.schema_of_variant(stock) == "BOOLEAN") & (at("$.product.isAvailable") == "true"), F.lit(False)).alias("available"),
        F.coalesce(said("$.levels.data.parent.categoryKey"), said("$.product.mainCategoryID")).alias("shelf"), said("$.levels.data.current.categoryKey").alias("aisle"),
    )


def seen_since(listings: DataFrame, retailer: str, since, least: int = 10_000) -> DataFrame:
    """External ids seen since a time. Fewer than least are refused: they can't stand for a whole shop."""
    found = listings.where((F.col("retailer") == retailer) & (F.col("last_seen_at") >= F.lit(since).cast("timestamp"))).select("external_id").distinct()
    n = found.count()
    if n < least:
        raise ValueError(f"{n} listings seen, at least {least} needed")
    return found


def run_log_lines(messages: DataFrame, runs: DataFrame, now) -> DataFrame:
    """Log rows of JSON arrays (run_id, lines) for runs that exist; levels, scope and message made to fit."""
    line = "array<struct<t:string,level:string,scope:string,message:string,fields:map<string,string>>>"
    rows = messages.select("run_id", F.explode(F.from_json("lines", line)).alias("x")).join(runs.select("run_id").distinct(), "run_id", "left_semi")
    return rows.select(
        "run_id", F.coalesce(F.try_to_timestamp("x.t"), F.lit(now).cast("timestamp")).alias("t"), F.when(F.col("x.level").isin("warn", "error"), F.col("x.level")).otherwise("info").alias("level"),
        F.left(F.coalesce("x.scope", F.lit("")), F.lit(100)).alias("scope"), F.left(F.coalesce("x.message", F.lit("")), F.lit(2000)).alias("message"), F.col("x.fields").alias("fields"),
    )


def upsert_retailers(old: DataFrame, seed: DataFrame) -> DataFrame:
    """Retailers (slug, name, country, domain, enabled): the seed renews all but enabled."""
    new = seed.select("slug", *[F.col(c).alias(f"new_{c}") for c in ("name", "country", "domain", "enabled")])
    both = old.join(new, "slug", "full_outer")
    return both.select("slug", *[F.coalesce(f"new_{c}", c).alias(c) for c in ("name", "country", "domain")], F.coalesce("enabled", "new_enabled", F.lit(True)).alias("enabled"))
