"""Queries over sources and field rules: payloads rendered from the parts, read back, and held against the parts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketloom.functions import jsonld, text
from marketloom.functions import products as jobs
from marketloom.operators import crawl, validate
from marketloom.plans.catalog import catalog, products, read
from marketloom.registry import query
from marketloom.session import shared_folder
from marketloom.sources import captures


def _parts(spark, d):
    p = products(spark, d)
    return p.join(read(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price"), "p_size"), "product_id")


def _pages_of(rows, column, size=20):
    """Rows dealt into pages of about size: an array of column for each page."""
    return rows.groupBy(F.floor(F.col("product_id") / size).alias("page")).agg(F.array_sort(F.collect_list(column)).alias("items"))


@query("""WITH p AS (SELECT *, CASE p_partkey % 7 WHEN 0 THEN 'delisted' WHEN 1 THEN 'failed' WHEN 2 THEN 'no_product' WHEN 3 THEN 'excluded' WHEN 4 THEN 'skipped' END AS o FROM part)
    SELECT count(*) AS urls, count(*) FILTER (WHERE o IS DISTINCT FROM 'skipped') AS fetched, count(*) FILTER (WHERE o = 'skipped') AS skipped, count(*) FILTER (WHERE o = 'delisted') AS delisted, count(*) FILTER (WHERE o = 'no_product') AS no_product, count(*) FILTER (WHERE o = 'excluded') AS excluded, count(*) FILTER (WHERE o = 'failed') AS failed FROM p""")
def crawl_counters(spark, d):
    return captures.crawled(*_captured(spark, d))[1]


@query("SELECT 'https://shop/' || CAST(p_partkey AS VARCHAR) AS url, p_name AS name, CAST(p_retailprice AS DOUBLE) AS price FROM part WHERE p_partkey % 7 >= 5")
def crawl_records(spark, d):
    return captures.crawled(*_captured(spark, d))[0].select("url", "name", "price")


def _captured(spark, d):
    """Parts as captured pages, of which five in seven give no record, each for a reason of its own."""
    p, k = _parts(spark, d), F.col("product_id") % 7
    node = F.to_json(F.struct(F.lit("Product").alias("@type"), F.col("canonical_name").alias("name"), F.struct(F.col("price").alias("price")).alias("offers")))
    body = F.when(k == 2, "<p>no data</p>").otherwise(F.concat(F.lit('<script type="application/ld+json">'), node, F.lit("</script>")))
    status = F.when(k == 0, F.when(F.col("product_id") % 2 == 0, 404).otherwise(410)).when(k == 1, 500).when(k != 4, 200)
    pages = p.select(F.concat(F.lit("https://shop/"), F.col("product_id").cast("string")).alias("url"), status.alias("status"), body.alias("body"), F.when(k == 3, "garden").otherwise("food").alias("shelf"))
    return pages, F.col("shelf") == "garden"


@query("SELECT DISTINCT 'https://shop/' || CAST(p_partkey % 50 AS VARCHAR) || '.xml?a=1&b=2' AS loc FROM part")
def sitemap_index(spark, d):
    p = read(spark, d, "part")
    loc = F.concat(F.lit("<sitemap><loc>\n https://shop/"), (F.col("p_partkey") % 50).cast("string"), F.lit(".xml?a=1&amp;b=2 </loc></sitemap>"))
    files = p.groupBy((F.col("p_partkey") % 13).alias("f")).agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.collect_list(loc), ""), F.lit("</sitemapindex>")).alias("body"))
    return captures.sitemap_index(files.unionByName(files.withColumn("body", F.lit("<urlset><url><loc>https://shop/no</loc></url></urlset>"))))


@query("SELECT CAST(p_partkey AS VARCHAR) AS external_id, p_name AS name, CAST(p_retailprice AS DOUBLE) AS price FROM part WHERE p_partkey % 10 <> 3 AND p_partkey % 10 <> 7")
def ndjson_records(spark, d):
    """Records written as lines and read again; of ten lines one is broken and one is blank."""
    p = _parts(spark, d)
    line = F.to_json(F.struct(F.lit("s").alias("retailer"), F.col("product_id").cast("string").alias("external_id"), F.col("canonical_name").alias("name"), "price"))
    k, out = F.col("product_id") % 10, f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}"
    p.select(F.when(k == 3, F.left(line, F.lit(20))).when(k == 7, "  ").otherwise(line).alias("value")).write.text(out)
    good, _ = captures.ndjson(spark, out, "s")
    again = f"{out}-again"
    captures.write_ndjson(good, again)
    return captures.ndjson(spark, again, "s")[0].select("external_id", "name", "price")


@query("SELECT count(*) AS broken FROM part WHERE p_partkey % 10 = 3")
def ndjson_broken(spark, d):
    p, out = read(spark, d, "part"), f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}"
    p.select(F.when(F.col("p_partkey") % 10 == 3, "{broken").otherwise('{"external_id":"1"}').alias("value")).write.text(out)
    return captures.ndjson(spark, out, "s")[1].agg(F.count("*").alias("broken"))


def _api(spark, d):
    """Products as pages of a catalog API: two sellers each, the default one second in every second product. Every third has
    no multiplier, so that its name says the size, and a reference in place of a code; one row a page has no name."""
    p, even = _parts(spark, d), F.col("product_id") % 2 == 0
    seller = lambda i, default, price: F.struct(F.lit(i).alias("sellerId"), default.alias("sellerDefault"), F.struct(price.alias("Price"), F.lit(3.0).alias("AvailableQuantity")).alias("commertialOffer"))
    third = F.col("product_id") % 3 == 0
    item = F.struct(F.when(~third, F.col("gtin")).alias("ean"), F.lit("kg").alias("measurementUnit"), F.when(~third, F.lit(0.5)).alias("unitMultiplier"), F.array(seller("1", F.lit(False), F.col("price") + 1), seller("2", even, F.col("price"))).alias("sellers"))
    one = F.struct(F.col("product_id").cast("string").alias("productId"), F.upper(F.concat("canonical_name", F.when(third, " 500 g").otherwise(""))).alias("productName"), F.when(third, F.col("gtin")).alias("productReference"), F.col("brand"), F.concat(F.lit("https://x/"), F.col("product_id").cast("string")).alias("link"), F.array(F.lit("/1/"), F.concat(F.lit("/1/"), F.col("p_size").cast("string"), F.lit("/"))).alias("categoriesIds"), F.array(item).alias("items"))
    nameless = F.concat(F.lit('[{"productId":"n'), F.col("page").cast("string"), F.lit('","productName":" "},'))
    return _pages_of(p, one, 50).select(F.concat(nameless, F.substr(F.to_json("items"), F.lit(2))).alias("body"))


@query("""SELECT CAST(product_id AS VARCHAR) AS external_id, upper(left(canonical_name, 1)) || substr(lower(canonical_name), 2) || CASE WHEN product_id % 3 = 0 THEN ' 500 g' ELSE '' END AS name, gtin, CAST(p_retailprice AS DOUBLE) + CASE WHEN product_id % 2 = 0 THEN 0 ELSE 1 END AS price, true AS available,
    CAST(CASE WHEN product_id % 3 = 0 THEN 500 ELSE 0.5 END AS DOUBLE) AS quantity, CASE WHEN product_id % 3 = 0 THEN 'g' ELSE 'kg' END AS unit FROM goods JOIN part ON p_partkey = product_id""", True)  # fmt: skip
def api_products(spark, d):
    got = jobs.with_size(captures.catalog_api(_api(spark, d)), "measured")
    return got.select("external_id", "name", "gtin", "price", "available", F.col("quantity").cast("double").alias("quantity"), "unit")


@query("SELECT '/1/' AS path UNION SELECT DISTINCT '/1/' || CAST(p_size AS VARCHAR) || '/' FROM part")
def api_category_paths(spark, d):
    return crawl.category_paths(captures.catalog_api(_api(spark, d)))


@query("SELECT DISTINCT '/' || CAST(p_size AS VARCHAR) || '/' AS path FROM part UNION SELECT '/' || CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey AS VARCHAR) || '/' FROM part UNION SELECT '/' || CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey AS VARCHAR) || '/1/' FROM part")
def category_tree(spark, d):
    """A tree of three levels for each size; nodes without a number are no categories."""
    leaf = F.array(F.struct(F.lit(1).alias("id")))
    nodes = read(spark, d, "part").select("p_size", F.struct(F.col("p_partkey").alias("id"), leaf.alias("children")).alias("n"))
    trees = nodes.groupBy("p_size").agg(F.collect_list("n").alias("children")).select(F.concat(F.lit("["), F.to_json(F.struct(F.col("p_size").alias("id"), "children")), F.lit(',{"id":"x","children":[{"id":5}]}]')).alias("body"))
    return crawl.tree_paths(trees)


@query("SELECT CAST(floor(p_partkey / 24) AS BIGINT) AS page, CAST(floor(p_partkey / 24) AS BIGINT) % 9 = 0 AS unreadable, CAST(CASE WHEN CAST(floor(p_partkey / 24) AS BIGINT) % 9 = 0 THEN 0 ELSE count(*) END AS INTEGER) AS n, CASE WHEN CAST(floor(p_partkey / 24) AS BIGINT) % 9 = 0 THEN NULL ELSE min(CAST(p_partkey AS VARCHAR)) END AS first_id FROM part GROUP BY 1")
def department_pages(spark, d):
    """24 products to a page; every ninth page has lost its payload, or the array in it, which is not the same as an empty one."""
    p = _parts(spark, d)
    item = F.struct(F.col("product_id").cast("string").alias("id"), F.concat(F.lit("} \""), "canonical_name").alias("name"), F.col("brand"), "price")
    pages = _pages_of(p, item, 24)
    body = F.concat(F.lit("var a = 1; var impressionData = "), F.to_json(F.struct(F.lit("EUR").alias("currency"), F.struct(F.lit("x").alias("list"), F.col("items").alias("impressions")).alias("ecommerce"))), F.lit("; more {}"))
    got = captures.department_pages(pages.select("page", F.when(F.col("page") % 18 == 0, "<p>late</p>").when(F.col("page") % 9 == 0, 'var impressionData = {"ecommerce":{"impressions":{}}};').otherwise(body).alias("body")))
    return got.select("page", "unreadable", F.size("products").alias("n"), F.array_min(F.transform("products", lambda x: x["id"])).alias("first_id"))


def _leaflet(spark, d):
    """Offers under shelves by size, in reverse on every page; every fifth also stands under the plants, last."""
    p = _parts(spark, d)
    offer = F.struct(F.col("product_id").cast("string").alias("klNr"), F.col("brand").alias("title"), F.concat(F.lit("sub "), "canonical_name").alias("subtitle"), F.concat(F.lit("detail "), "canonical_name").alias("detailTitle"), F.when(F.col("product_id") % 2 == 0, F.concat(F.upper("brand"), F.lit("\nmore"))).otherwise("other").alias("detailDescription"))
    shelf = lambda name: F.struct(name.alias("displayName"), F.array(offer).alias("offers"))
    shelves = p.select("product_id", F.array_compact(F.array(shelf(F.concat(F.lit("Shelf "), (F.col("product_id") % 3).cast("string"))), shelf(F.lit("Other")), F.when(F.col("product_id") % 5 == 0, shelf(F.lit("Plante"))))).alias("s"))
    pages = shelves.groupBy(F.floor(F.col("product_id") / 20).alias("page")).agg(F.flatten(F.collect_list("s")).alias("categories"))
    body = F.concat(F.lit('x {"offerData": '), F.to_json(F.struct(F.array(F.struct("categories")).alias("cycles"))), F.lit("}"))
    return captures.leaflet_offers(pages.select(body.alias("body")))


@query("SELECT CAST(p_partkey AS VARCHAR) AS external_id, 'Shelf ' || CAST(p_partkey % 3 AS VARCHAR) AS shelf, CASE WHEN p_partkey % 2 = 0 THEN 'sub ' ELSE 'detail ' END || p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand FROM part WHERE p_partkey % 5 <> 0")
def leaflet_offers(spark, d):
    kept = captures.first_shelf(_leaflet(spark, d), "(?i)^plant")
    return jobs.leaflet_names(kept).select("external_id", "shelf", "name", "brand")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS url, 'o' || CAST(p_partkey AS VARCHAR) AS external_id, p_name AS name, p_brand AS brand, CASE WHEN p_partkey % 5 > 0 THEN CAST(p_retailprice AS DOUBLE) END AS price, p_partkey % 3 = 1 AS available,
    CASE WHEN p_partkey % 7 = 0 THEN 'own' ELSE 'size-' || CAST(p_size AS VARCHAR) END AS shelf, CASE WHEN p_partkey % 7 <> 0 THEN 'aisle' END AS aisle FROM part WHERE p_partkey % 4 <> 0""")
def page_state(spark, d):
    """A page's state holds a text of JSON: a teaser without a category, category levels (not on every seventh page) and the
    product; of three products one is in stock, one is not and one doesn't say. Every fourth page has no state."""
    p, k = _parts(spark, d), F.col("product_id")
    teaser = F.struct(F.lit("t1").alias("objectID"), F.lit("teaser").alias("name"))
    level = lambda key: F.struct(key.alias("categoryKey"))
    levels = F.when(k % 7 != 0, F.struct(F.struct(level(F.concat(F.lit("size-"), F.col("p_size").cast("string"))).alias("parent"), level(F.lit("aisle")).alias("current")).alias("data")))
    product = F.struct(
        F.concat(F.lit("o"), k.cast("string")).alias("objectID"), F.lit("own").alias("mainCategoryID"), F.col("canonical_name").alias("name"), F.col("brand").alias("brandName"),
        F.struct(F.when(k % 5 == 0, 0.0).otherwise(F.col("price")).alias("priceValue")).alias("currentPrice"), F.when(k % 3 == 0, False).when(k % 3 == 1, True).alias("isAvailable"),
    )
    part = lambda i, *fields: F.to_json(F.struct(F.lit(i).alias("id"), F.struct(*fields).alias("res")))
    inner = F.concat(F.lit("["), part("teasers", F.array(teaser).alias("items")), F.lit(","), part("page", levels.alias("parentCategory"), F.array(product).alias("items")), F.lit("]"))
    state = F.to_json(F.struct(F.struct(F.struct(inner.alias("apiData")).alias("pageProps")).alias("props")))
    body = F.when(k % 4 == 0, "<p/>").otherwise(F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), state, F.lit("</script>")))
    return captures.page_state_products(p.select(k.alias("url"), body.alias("body")), "url").drop("unit_text")


@query("SELECT DISTINCT external_id FROM listing WHERE retailer_id = (SELECT min(retailer_id) FROM listing) AND last_seen_at >= TIMESTAMP '1997-01-01'", True)
def seen_since(spark, d):
    c = catalog(spark, d)
    first = c.listing.join(c.retailer.select("retailer"), "retailer").agg(F.min("retailer").alias("r")).first()["r"]
    return captures.seen_since(c.listing, first, "1997-01-01 00:00:00", least=1)


@query("SELECT lower(replace(s_name, '#', '-')) AS slug, CASE WHEN s_suppkey % 3 = 0 THEN 'renewed' ELSE s_name END AS name, CASE WHEN s_suppkey % 2 = 1 THEN false ELSE true END AS enabled FROM supplier")
def retailer_seed(spark, d):
    """Every second shop is known, and switched off; every third is renamed by the seed, which switches nothing."""
    s, k = read(spark, d, "supplier"), F.col("s_suppkey")
    rows = s.select(F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("slug"), F.when(k % 3 == 0, "renewed").otherwise(F.col("s_name")).alias("name"), F.lit("RO").alias("country"), F.lit("x.ro").alias("domain"), F.lit(True).alias("enabled"), k)
    old = rows.where(k % 2 == 1).withColumns({"enabled": F.lit(False), "name": F.lit("old")})
    return captures.upsert_retailers(old.drop("s_suppkey"), rows.drop("s_suppkey")).select("slug", "name", "enabled")


@query("SELECT CAST(user_id AS VARCHAR) AS run_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'warn' ELSE 'info' END AS level, left(repeat(event_type, 20), 100) AS scope, CASE WHEN event_id % 2 = 0 THEN ts ELSE TIMESTAMP '2024-05-05' END AS t, count(*) AS n FROM events WHERE user_id % 3 <> 0 GROUP BY ALL")
def run_log_lines(spark, d):
    """Events as log lines by user; a level that isn't known is info, a time that can't be read is now, users of three are no runs."""
    e = read(spark, d, "events")
    level = F.when(F.col("event_type") == "view", "warn").when(F.col("event_type") == "error", "error").otherwise("shout")
    line = F.struct(F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise("soon").alias("t"), level.alias("level"), F.repeat("event_type", F.lit(20)).alias("scope"), F.col("props").alias("message"))
    messages = e.groupBy(F.col("user_id").cast("string").alias("run_id")).agg(F.to_json(F.collect_list(line)).alias("lines"))
    runs = e.where("user_id % 3 <> 0").select(F.col("user_id").cast("string").alias("run_id"))
    return captures.run_log_lines(messages, runs, "2024-05-05 00:00:00").groupBy("run_id", "level", "scope", "t").agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS part, CASE WHEN p_partkey % 3 <> 0 THEN upper(left(p_brand, 1)) || lower(substr(p_brand, 2)) END AS brand, CASE WHEN p_partkey % 2 = 0 THEN upper(left(p_name, 1)) || substr(p_name, 2) ELSE p_name END AS name FROM part")
def clean_names(spark, d):
    """Brands and names of which some shout and some brands are none."""
    p, k = read(spark, d, "part"), F.col("p_partkey")
    brand = F.when(k % 9 == 0, "N/A").when(k % 9 == 3, "fără marcă").when(k % 9 == 6, " ").otherwise(F.upper("p_brand"))
    return p.select(k.alias("part"), text.unshout_brand(text.usable_brand(brand)).alias("brand"), text.unshout(F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))).alias("name"))


@query("SELECT p_partkey AS part, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE CAST(p_size AS DOUBLE) * 1000 + 0.5 END AS price FROM part")
def price_texts(spark, d):
    p, k, n = read(spark, d, "part"), F.col("p_partkey"), F.col("p_size").cast("string")
    said = F.when(k % 4 == 0, F.concat(n, F.lit(".000,50 lei"))).when(k % 4 == 1, F.concat(F.lit("EUR "), n, F.lit("000.5"))).when(k % 4 == 2, F.concat(n, F.lit("000,5"))).otherwise("on request")
    return p.select(k.alias("part"), text.parse_price(said).alias("price"))


@query("SELECT p_partkey AS part, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size / 1000.0 WHEN 1 THEN p_size * 1e7 WHEN 2 THEN p_size * 1000 ELSE 5 END AS DOUBLE) AS price, p_partkey % 4 < 3 AS image FROM part")
def jsonld_prices(spark, d):
    """Prices as numbers of three decimals, as exponents, as texts with a thousands mark, and behind an offer without one;
    the product lies five graphs deep."""
    p, k, n = read(spark, d, "part"), F.col("p_partkey"), F.col("p_size").cast("string")
    price = F.when(k % 4 == 0, (F.col("p_size") / 1000).cast("decimal(10,3)").cast("string")).when(k % 4 == 1, F.concat(n, F.lit("e7"))).otherwise(F.concat(F.lit('"'), n, F.lit('.000"')))
    offers = F.when(k % 4 == 3, '[{"price":""},{"priceSpecification":[{"price":"?"},{"price":"5"}]}]').otherwise(F.concat(F.lit('{"price":'), price, F.lit("}")))
    node = F.concat(F.lit('{"@type":"Product","name":"x"'), F.when(k % 4 < 3, ',"image":["i.png"]').otherwise(""), F.lit(',"offers":'), offers, F.lit("}"))
    deep = node
    for _ in range(5):
        deep = F.concat(F.lit('{"@graph":['), deep, F.lit("]}"))
    pages = p.select(k.alias("part"), F.concat(F.lit('<script type="application/ld+json">'), deep, F.lit("</script>")).alias("html"))
    return jsonld.products(pages, "part").select("part", "price", F.col("image").isNotNull().alias("image"))


@query("SELECT p_partkey AS part, p_partkey % 4 < 2 AS bundle FROM part")
def bundles(spark, d):
    p, k = read(spark, d, "part"), F.col("p_partkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("Bere 0,5 l + "), F.element_at(F.array(F.lit("pahar"), F.lit("halbă"), F.lit("geantă")), (k % 3 + 1).cast("int")))).when(k % 4 == 1, F.concat(F.lit("Gift set "), "p_name")).when(k % 4 == 2, F.concat("p_name", F.lit(" 2 x 2 l + zero"))).otherwise(F.col("p_name"))
    return p.select(k.alias("part"), text.is_bundle(name).alias("bundle"))


@query("SELECT part, n FROM (SELECT 'valid' AS part, count(*) AS n FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0 UNION ALL SELECT 'rejected', count(*) FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 = 0 UNION ALL SELECT 'excluded', count(*) FROM part WHERE p_partkey % 3 = 0)")
def split_records(spark, d):
    """Bundles are set aside before anything is rejected."""
    p, k, null = _parts(spark, d), F.col("product_id"), lambda kind="string": F.lit(None).cast(kind)
    rows = p.select(k.cast("string").alias("external_id"), F.when(k % 3 == 0, "Gift box").otherwise(F.col("canonical_name")).alias("name"), "brand", "gtin", F.when(k % 5 == 0, -1.0).otherwise(F.col("price")).alias("price"), null().alias("currency"), null("double").alias("quantity"), null().alias("unit"), null().alias("category"), F.lit("//x").alias("product_url"), F.lit(True).alias("available"))
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    valid, rejected, excluded = validate.split(rows)
    return count(valid, "valid").unionByName(count(rejected, "rejected")).unionByName(count(excluded, "excluded"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS external_id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 3 = 1 END AS coded, CAST(p_retailprice AS DOUBLE) AS price FROM part")
def clean_fields(spark, d):
    """Ids and codes out of addresses: a counter's own codes and broken ones are no codes."""
    p, k = _parts(spark, d).withColumn("code", F.coalesce("gtin", F.concat(F.lit("2"), F.lpad(F.col("product_id").cast("string"), 12, "0")))), F.col("product_id")
    p = p.withColumn("code", F.when(k % 3 == 1, F.col("code")).when(k % 3 == 2, F.concat(F.left("code", F.lit(12)), ((F.right("code", F.lit(1)).cast("int") + 1) % 10).cast("string"))).otherwise(F.col("code")))
    rows = p.select(F.lit("s").alias("retailer"), F.col("canonical_name").alias("name"), "brand", F.lit(None).cast("string").alias("gtin"), F.concat(F.lit("//x/p/"), "code").alias("product_url"), "price", "product_id")
    out = jobs.with_clean_fields(rows, r"/p/(\d+)$", "2")
    coded = F.when(F.col("external_id").startswith("2"), None).otherwise(F.col("gtin").isNotNull())
    return out.select(F.col("product_id").cast("string").alias("external_id"), coded.alias("coded"), "price")


@query("SELECT p_partkey AS part, p_name AS name FROM part WHERE p_partkey % 4 <> 1")
def promo_names(spark, d):
    p, k = read(spark, d, "part"), F.col("p_partkey")
    name = F.when(k % 4 == 0, F.concat("p_name", F.lit("  + Garantie SGR 0,50"))).when(k % 8 == 1, F.concat_ws("/", "p_name", F.lit("x"))).when(k % 8 == 5, "Diverse sortimente").otherwise(F.col("p_name"))
    return jobs.promo_names(p.select(k.alias("part"), name.alias("name")))


@query("SELECT p_partkey AS part FROM part WHERE p_size % 10 < 3 AND p_name NOT LIKE '%ring'")
def shelf_allowlist(spark, d):
    p = read(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("part"), F.lit("s").alias("retailer"), F.concat_ws(" ", (F.col("p_size") % 10).cast("string"), "p_name").alias("shelf"))
    allowed = rows.select("retailer", "shelf").distinct().where("shelf rlike '^[0-2] '")
    return crawl.on_shelf(rows, allowed, "ring$").select("part")


@query("""SELECT p_partkey AS part, CASE WHEN p_partkey % 5 = 0 THEN false WHEN p_partkey % 5 = 1 THEN p_size % 2 = 0 ELSE p_size % 20 IN (10, 17) AND p_partkey % 3 <> 0 END AS wanted FROM part""")
def numbered_shelf(spark, d):
    """Shelves out of a page's state: by number, by label where there is none, never under a refused label."""
    p, k = read(spark, d, "part"), F.col("p_partkey")
    path = F.when(k % 5 == 1, "").otherwise(F.concat(F.lit("/root/"), (F.col("p_size") % 20).cast("string"), F.lit("/"), F.when(k % 3 == 0, "1732").otherwise("7"), F.lit("/")))
    label = F.when(k % 5 == 0, "P+F").when(k % 5 == 1, F.when(F.col("p_size") % 2 == 0, "Food").otherwise("Toys")).otherwise("")
    body = F.concat(F.lit('{"wonCategoryPrimaryPath" : "'), path, F.lit('", "categoryPrimary":"'), label, F.lit('"}'))
    shelf = captures.page_shelf(body, r'"wonCategoryPrimaryPath"\s*:\s*"([^"]*)"', r'"categoryPrimary"\s*:\s*"([^"]*)"')
    return p.select(k.alias("part"), crawl.on_numbered_shelf(shelf["path"], shelf["primary"], ["10", "17"], ["1732"], ["Food", "F+V"], ["P+F"]).alias("wanted"))


@query("SELECT p_partkey AS part, '/shop/c/a/b' || CAST(p_size AS VARCHAR) AS link FROM part")
def deepest_shelf(spark, d):
    p = read(spark, d, "part")
    links = F.array(F.lit("/shop/c/a"), F.lit("/other/x/y/z/w"), F.concat(F.lit("/shop/c/a/b"), F.col("p_size").cast("string")), F.lit("/shop/c/z/z"))
    return p.select(F.col("p_partkey").alias("part"), captures.deepest_link(links, "^/shop/c/").alias("link"))


@query("SELECT p_partkey AS part, CASE WHEN p_size < 10 THEN 'dairy' WHEN p_partkey % 2 = 0 THEN 'pet' END AS category FROM part")
def url_rules(spark, d):
    """Categories by rules over addresses."""
    p = read(spark, d, "part")
    rows = p.select("p_partkey", F.lit("s").alias("retailer"), F.concat(F.lit("https://x/"), F.col("p_size").cast("string"), F.lit("/"), F.when(F.col("p_partkey") % 2 == 0, "pets").otherwise("x")).alias("product_url"), F.lit(None).cast("string").alias("category"))
    rules = spark.createDataFrame([("s", 1, r"x/\d/", "dairy"), ("s", 2, "/pets$", "pet")], "retailer string, ord int, pattern string, category string")
    return jobs.with_category(rows, rules, label="product_url").select(F.col("p_partkey").alias("part"), "category")


@query("SELECT page_id FROM pages WHERE page_id % 4 = 0 AND page_id % 8 <> 4")
def department_urls(spark, d):
    """Departments on the list, without those carved out and without parents of these."""
    path = F.when(F.col("page_id") % 8 == 4, "/food/pets/").when(F.col("page_id") % 4 == 0, "/food/milk/").when(F.col("page_id") % 4 == 1, "/food/").otherwise("/toys/")
    urls = read(spark, d, "pages").select("page_id", "url", path.alias("path"))
    return crawl.departments(urls, ["/food/"], ["/food/pets/toys/"] + ["/food/pets/"]).select("page_id")


@query("SELECT page_id, url LIKE '%.html' OR url LIKE '%/en/%' AS denied FROM pages")
def denied_urls(spark, d):
    return crawl.denied(read(spark, d, "pages").select("page_id", "url"), [r"\.html$", "/en/"]).select("page_id", "denied")


@query("SELECT page_id, page_id % 3 = 0 AS grocery FROM pages WHERE page_id % 3 <> 0")
def removal_pass(spark, d):
    urls = read(spark, d, "pages").select("page_id", (F.col("page_id") % 3 == 0).alias("grocery"))
    return crawl.by_mode(urls, "removals")
