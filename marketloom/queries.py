"""The catalog queries over the test data, and the SQL that each is held against."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.functions import jsonld, text
from marketloom.operators import admin, crawl, logs, match, popularity, runs, search, validate
from marketloom.plans.catalog import catalog, observations, products, read, retailers
from marketloom.registry import ORACLES, QUERIES, query  # noqa: F401
from marketloom.session import shared_folder, spread, written
from marketloom.sources import captures
from marketloom.streaming import catalog as streams

_FOLD = "trim(regexp_replace(lower(strip_accents({})), '\\s+', ' ', 'g'))"
_SPELLED = "text"
for _sign, _word in text.EXPANSIONS.items():
    _SPELLED = f"replace({_SPELLED}, '{_sign}', '{_word.replace(chr(39), chr(39) * 2)}')"
_FOLDED = _FOLD.format(_SPELLED)
_KEYED = f"trim(regexp_replace({_FOLDED}, '[^a-z0-9%]+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({_FOLDED}) AS folded, CAST(length({_FOLDED}) AS BIGINT) AS n FROM documents")
def fold_text(spark, d):
    folded = text.fold(F.col("text"))
    return read(spark, d, "documents").select("doc_id", F.md5(folded).alias("folded"), F.length(folded).cast("long").alias("n"))


@query(f"SELECT doc_id, md5({_KEYED}) AS keyed FROM documents")
def key_fold(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(text.key_fold(F.col("text"))).alias("keyed"))


@query("SELECT product_id, merge_key, split_part(merge_key, '|', 1) AS key_brand, split_part(merge_key, '|', 2) AS key_name FROM product", True)
def merge_key(spark, d):
    p = products(spark, d)
    key = text.merge_key(F.col("brand"), F.col("canonical_name"), F.col("quantity"), F.col("quantity_unit"))
    return p.select("product_id", key.alias("merge_key"), F.split_part(key, F.lit("|"), F.lit(1)).alias("key_brand"), F.split_part(key, F.lit("|"), F.lit(2)).alias("key_name"))


@query("""
    SELECT p_partkey AS part, CASE p_partkey % 6 WHEN 0 THEN 'g:' || CAST(p_size * 1000 AS VARCHAR) WHEN 1 THEN 'g:' || CAST(p_size AS VARCHAR) WHEN 2 THEN 'ml:' || CAST(p_size * 1000 AS VARCHAR)
      WHEN 3 THEN 'ml:' || CAST(p_size AS VARCHAR) WHEN 4 THEN 'buc:' || CAST(p_size AS VARCHAR) ELSE '-' END AS canonical,
      CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 2 = 0 THEN '.5' ELSE '' END AS number
    FROM part""")
def canonical_quantity(spark, d):
    p = read(spark, d, "part")
    unit = F.element_at(F.array(*[F.lit(u) for u in ("kg", "g", "l", "ml", "buc", "box")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    number = F.col("p_size") + F.when(F.col("p_partkey") % 2 == 0, 0.5).otherwise(0.0)
    return p.select(F.col("p_partkey").alias("part"), text.canonical_quantity(F.col("p_size"), unit).alias("canonical"), text.number_key(number).alias("number"))


@query("""
    SELECT p_partkey AS part, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size * 1000 WHEN 1 THEN p_size WHEN 2 THEN p_size * 3 * 10 ELSE NULL END AS DOUBLE) AS quantity,
      CASE p_partkey % 4 WHEN 0 THEN 'g' WHEN 1 THEN 'l' WHEN 2 THEN 'ml' END AS unit, lower(p_name) AS stripped
    FROM part""")
def parse_quantity(spark, d):
    p = spread(read(spark, d, "part"))
    n = F.col("p_size").cast("string")
    size = F.when(F.col("p_partkey") % 4 == 0, F.concat(n, F.lit("000 g"))).when(F.col("p_partkey") % 4 == 1, F.concat(n, F.lit(",0 L"))).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("3 x "), n, F.lit(" cl"))).otherwise("3,5%")
    name = F.concat_ws(" ", "p_name", size)
    got = text.parse_quantity(name)
    bare = F.when(F.col("p_partkey") % 4 == 3, F.replace(text.strip_quantity(name), F.lit(" 3,5%"), F.lit(""))).otherwise(text.strip_quantity(name))
    return p.select(F.col("p_partkey").alias("part"), got["quantity"].cast("double").alias("quantity"), got["unit"].alias("unit"), F.lower(bare).alias("stripped"))


@query("SELECT product_id, CASE WHEN product_id % 5 = 0 THEN NULL ELSE gtin END AS gtin FROM goods WHERE gtin IS NOT NULL", True)
def gtin_valid(spark, d):
    # Of every fifth code the last digit is spoiled.
    p = products(spark, d).where("gtin is not null")
    spoiled = F.concat(F.left("gtin", F.lit(12)), ((F.right("gtin", F.lit(1)).cast("int") + 1) % 10).cast("string"))
    return p.select("product_id", text.valid_gtin(F.when(F.col("product_id") % 5 == 0, spoiled).otherwise(F.col("gtin"))).alias("gtin"))


@query("SELECT page_id, CASE WHEN url LIKE 'https://%' THEN url WHEN page_id % 2 = 0 THEN 'https:' || substr(url, 6) END AS url FROM pages")
def url_canonical(spark, d):
    # Every second http address is given without its scheme.
    given = F.when((F.col("page_id") % 2 == 0) & F.col("url").startswith("http://"), F.substring("url", 6, 10_000)).otherwise(F.col("url"))
    return read(spark, d, "pages").select("page_id", text.https_url(given).alias("url"))


def _records(spark, d):
    """Parts as product records, some of them broken."""
    p, k = read(spark, d, "part"), F.col("p_partkey")
    return p.select(
        F.when(k % 11 == 1, " ").otherwise(k.cast("string")).alias("external_id"), F.when(k % 13 == 2, "").when(k % 17 == 3, F.repeat(F.lit("x"), F.lit(201))).otherwise(F.col("p_name")).alias("name"), F.col("p_brand").alias("brand"),
        F.lit(None).cast("string").alias("gtin"), F.when(k % 19 == 4, -1.0).otherwise(F.col("p_retailprice")).alias("price"), F.lit("eur").alias("currency"), F.col("p_size").cast("double").alias("quantity"),
        F.when(k % 2 == 0, "g").otherwise("lb").alias("unit"), F.lit("toys").alias("category"), F.when(k % 23 == 5, "ftp://x").otherwise(F.concat(F.lit("//shop/p/"), k.cast("string"))).alias("product_url"), F.lit(None).cast("boolean").alias("available"), k.alias("part"),
    )


_REASON = "CASE WHEN p_partkey % 11 = 1 THEN 'no-external-id' WHEN p_partkey % 13 = 2 THEN 'no-name' WHEN p_partkey % 17 = 3 THEN 'name-too-long' WHEN p_partkey % 23 = 5 THEN 'no-url' WHEN p_partkey % 19 = 4 THEN 'bad-price' END"


@query(f"""
    SELECT part, reject_reason, CASE WHEN reject_reason IS NULL THEN p_name END AS name, CASE WHEN reject_reason IS NULL THEN CAST(p_retailprice AS DOUBLE) END AS price, 'EUR' AS currency,
      CASE WHEN part % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS quantity, CASE WHEN part % 2 = 0 THEN 'g' END AS unit, CAST(NULL AS VARCHAR) AS category, true AS available
    FROM (SELECT *, p_partkey AS part, {_REASON} AS reject_reason FROM part)""")
def validate_products(spark, d):
    v = validate.validate(_records(spark, d))
    name = F.when(F.col("reject_reason").isNull(), F.col("name"))
    return v.select("part", "reject_reason", name.alias("name"), F.col("price").cast("double").alias("price"), "currency", F.col("quantity").cast("double").alias("quantity"), "unit", "category", "available")


@query(f"SELECT {_REASON} AS reject_reason, count(*) AS n FROM part WHERE {_REASON} IS NOT NULL GROUP BY 1")
def reject_histogram(spark, d):
    return validate.reject_histogram(validate.validate(_records(spark, d)))


@query("SELECT 'listing' AS \"table\", CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key, 'price_range' AS \"constraint\" FROM lineitem WHERE l_extendedprice * 20 > 1000000")
def constraint_violations(spark, d):
    li = read(spark, d, "lineitem")
    rows = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), F.lit("x").alias("retailer_name"), F.lit("x").alias("external_id"), (F.col("l_extendedprice") * 20).alias("price"), F.lit("EUR").alias("currency"), F.lit("https://x").alias("product_url"))
    return validate.violations(rows, "listing", "key")


@query("SELECT 'listing' AS \"table\", 'retailer,external_id' AS columns, CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) AS key, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return validate.duplicates(read(spark, d, "lineitem").select(F.col("l_suppkey").alias("retailer"), F.col("l_partkey").alias("external_id")), "listing")


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def _import_all(spark, d):
    """All parts as one batch into an empty catalog: rows of a name meet in the same component."""
    p = read(spark, d, "part")
    rows = p.select(
        F.col("p_partkey").alias("ordinal"), F.col("p_partkey").cast("string").alias("external_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.lit(None).cast("string").alias("gtin"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"), F.lit("EUR").alias("currency"), F.lit(None).cast("decimal(18,3)").alias("quantity"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("category"),
        F.concat(F.lit("https://shop/"), F.col("p_partkey").cast("string")).alias("product_url"), F.lit(True).alias("available"),
    )
    from marketloom import schema

    empty = _empty(spark, schema.PRODUCT + ", merge_key string"), _empty(spark, schema.IDENTIFIER), _empty(spark, schema.LISTING)
    return match.import_rows(rows, "shop", "2024-01-01 00:00:00", *empty)


@query("SELECT p_partkey AS ordinal, 'shop:' || CAST(min(p_partkey) OVER (PARTITION BY lower(p_brand), lower(p_name)) AS VARCHAR) AS product_id, p_partkey = min(p_partkey) OVER (PARTITION BY lower(p_brand), lower(p_name)) AS created FROM part")
def resolve_products(spark, d):
    return _import_all(spark, d).decision.select("ordinal", "product_id", "created")


@query("SELECT count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged, count(DISTINCT lower(p_brand) || '|' || lower(p_name)) AS products_created, 0::BIGINT AS identifiers_added, 0::BIGINT AS conflicts, 0::BIGINT AS errors FROM part")
def import_counters(spark, d):
    return match.import_counters(_import_all(spark, d))


def _seen(spark, d):
    """The observation log as import rows in order, and their decisions: each row is accepted for the part it shows. The
    ordinals are structs, so that they stay apart however many shops, parts and observations there are."""
    o = observations(spark, d)
    rows = o.select(
        F.struct("retailer_id", "product_id", "ordinal").alias("ordinal"), F.concat_ws("-", "retailer_id", "product_id").alias("external_id"), F.col("product_id").cast("string").alias("name"), F.lit(None).cast("string").alias("brand"),
        F.lit(None).cast("string").alias("gtin"), F.col("price"), F.lit("EUR").alias("currency"), F.lit(None).cast("decimal(18,3)").alias("quantity"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("category"),
        F.lit("https://shop").alias("product_url"), "available", F.col("ordinal").alias("nth"), F.col("product_id").cast("string").alias("product_id"),
    )
    return written(rows), lambda some: some.select("ordinal", "external_id", "product_id", F.lit(None).cast("string").alias("error"))


@query("""SELECT CAST(retailer_id AS VARCHAR) || '-' || CAST(l.product_id AS VARCHAR) AS external_id, CAST(price AS DOUBLE) AS price, available, CAST(previous_price AS DOUBLE) AS previous_price, TIMESTAMP '2024-01-01' AS first_seen_at,
    CASE WHEN seen > 1 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS last_seen_at, CASE WHEN moves > 0 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS last_price_at
    FROM latest l JOIN (SELECT retailer_id, product_id, count(*) AS seen, count(*) FILTER (WHERE ordinal > 1 AND before IS DISTINCT FROM price) AS moves FROM moved GROUP BY 1, 2) n USING (retailer_id, product_id)""", True)  # fmt: skip
def upsert_listings(spark, d):
    """Two runs: one that shows the first observation of each listing, and one that shows the others in order."""
    rows, accepted = _seen(spark, d)
    from marketloom import schema

    first, later = rows.where("nth = 1"), rows.where("nth > 1")
    before = written(match.upsert(match.observed(first.drop("product_id"), accepted(first), empty := _empty(spark, schema.LISTING)), empty, "all", "2024-01-01 00:00:00"))
    after = match.upsert(match.observed(later.drop("product_id"), accepted(later), before), before, "all", "2024-01-02 00:00:00")
    return after.select("external_id", F.col("price").cast("double").alias("price"), "available", F.col("previous_price").cast("double").alias("previous_price"), "first_seen_at", "last_seen_at", "last_price_at")


@query("SELECT CAST(retailer_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR) AS external_id, ordinal AS nth, CAST(before AS DOUBLE) AS previous_price, CAST(price AS DOUBLE) AS price FROM moved WHERE ordinal > 1 AND before IS DISTINCT FROM price", True)
def price_changes(spark, d):
    rows, accepted = _seen(spark, d)
    from marketloom import schema

    seen = match.observed(rows.drop("product_id"), accepted(rows), _empty(spark, schema.LISTING)).where("left is not null")
    return seen.join(rows.select("ordinal", F.col("nth").cast("long").alias("nth")), "ordinal").select("external_id", "nth", F.col("left.price").cast("double").alias("previous_price"), F.col("now.price").cast("double").alias("price"))


_RUNS = """, run AS (SELECT l_suppkey AS retailer_id, year(l_shipdate) AS y, count(*) AS n, min(l_shipdate) AS started_at FROM lineitem WHERE (l_suppkey + year(l_shipdate)) % 9 <> 0 OR l_linenumber = 1 GROUP BY 1, 2)"""


def _runs(spark, d):
    """A run for each retailer and year; every ninth saw only first order lines."""
    li = read(spark, d, "lineitem").withColumn("y", F.year("l_shipdate"))
    kept = li.where(((F.col("l_suppkey") + F.col("y")) % 9 != 0) | (F.col("l_linenumber") == 1))
    return kept.groupBy(F.col("l_suppkey").alias("retailer"), "y").agg(F.count("*").alias("products_valid"), F.min("l_shipdate").alias("started_at")).select(F.concat_ws("-", "retailer", "y").alias("run_id"), "retailer", "y", "products_valid", "started_at", F.lit(False).alias("covered"))


@query("""
    WITH RECURSIVE x AS (SELECT 1) """ + _RUNS + """, ordered AS (SELECT *, row_number() OVER (PARTITION BY retailer_id ORDER BY y) AS k FROM run),
    v AS (SELECT retailer_id, y, k, n, CAST(NULL AS BIGINT) AS previous_valid, CASE WHEN n = 0 THEN 'partial' ELSE 'completed' END AS status, CASE WHEN n > 0 THEN n END AS last FROM ordered WHERE k = 1
      UNION ALL SELECT o.retailer_id, o.y, o.k, o.n, v.last, CASE WHEN o.n = 0 OR o.n < v.last * 0.5 THEN 'partial' ELSE 'completed' END, CASE WHEN o.n = 0 OR o.n < v.last * 0.5 THEN v.last ELSE o.n END FROM v JOIN ordered o ON o.retailer_id = v.retailer_id AND o.k = v.k + 1)
    SELECT CAST(retailer_id AS VARCHAR) || '-' || CAST(y AS VARCHAR) AS run_id, status, previous_valid FROM v""")  # fmt: skip
def run_verdict(spark, d):
    return runs.replay_verdicts(_runs(spark, d)).select("run_id", "status", "previous_valid")


_LAST_RUN = ", last_run AS (SELECT l_suppkey AS retailer_id, max(make_timestamp(year(l_shipdate), 1, 1, 0, 0, 0.0)) AS run_at FROM lineitem GROUP BY 1)"


@query(_LAST_RUN + " SELECT retailer, product_id, available AND NOT (last_seen_at < run_at) AS available, available AND last_seen_at < run_at AS swept FROM listing JOIN last_run USING (retailer_id)", True)
def sweep(spark, d):
    shop = retailers(spark, d).select("retailer_id", "retailer")
    last = read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("retailer_id")).agg(F.max(F.date_trunc("year", "l_shipdate")).alias("started_at"))
    return runs.sweep(catalog(spark, d).listing, last.join(shop, "retailer_id")).select("retailer", "product_id", "available", "swept")


def _yearly(spark, d):
    """Runs by retailer and year, and listings stamped with the run that saw them."""
    obs = observations(spark, d).withColumn("seen_at", F.date_trunc("year", "seen_at")).drop("ordinal")
    order = Window.partitionBy("retailer_id", "product_id", "seen_at").orderBy(F.col("price"), F.col("available"))
    obs = obs.withColumn("n", F.row_number().over(order)).where("n = 1")
    obs = obs.withColumn("ordinal", F.row_number().over(Window.partitionBy("retailer_id", "product_id").orderBy("seen_at")))
    from marketloom.plans.catalog import latest

    listing = latest(obs).withColumnRenamed("retailer_id", "retailer")
    started = obs.select(F.col("retailer_id").alias("retailer"), F.col("seen_at").alias("started_at")).distinct()
    run = started.select(F.concat_ws("-", "retailer", F.year("started_at")).alias("run_id"), "retailer", "started_at", F.lit("completed").alias("status"))
    after = runs.sweep(listing, run).drop("swept")
    return run, after


_YEARLY = """, o1 AS (SELECT l_suppkey AS retailer_id, l_partkey AS product_id, date_trunc('year', l_shipdate) AS seen_at, l_extendedprice AS price, l_returnflag <> 'R' AS available FROM lineitem),
    o2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY retailer_id, product_id, seen_at ORDER BY price, available) AS n FROM o1) WHERE n = 1),
    o3 AS (SELECT *, lag(price) OVER (PARTITION BY retailer_id, product_id ORDER BY seen_at) AS before, row_number() OVER (PARTITION BY retailer_id, product_id ORDER BY seen_at) AS k FROM o2),
    ly AS (SELECT retailer_id AS retailer, product_id, min(seen_at) AS first_seen_at, max(seen_at) AS last_seen_at, arg_max(available, seen_at) AS available, max(seen_at) FILTER (WHERE k = 1 OR before IS DISTINCT FROM price) AS last_price_at FROM o3 GROUP BY 1, 2),
    rn AS (SELECT DISTINCT retailer_id AS retailer, seen_at AS started_at FROM o2), lr AS (SELECT retailer, max(started_at) AS run_at FROM rn GROUP BY 1),
    sw AS (SELECT ly.* REPLACE (ly.available AND NOT last_seen_at < run_at AS available) FROM ly JOIN lr USING (retailer)),
    rb AS (SELECT *, CAST(retailer AS VARCHAR) || '-' || CAST(year(started_at) AS VARCHAR) AS run_id, lag(started_at) OVER (PARTITION BY retailer ORDER BY started_at) AS before_at FROM rn)"""


@query("WITH x AS (SELECT 1)" + _YEARLY + " SELECT run_id, product_id FROM rb JOIN sw USING (retailer) WHERE first_seen_at = started_at")
def run_listings_new(spark, d):
    return runs.run_listings(*_yearly(spark, d), "new").select("run_id", "product_id")


@query("WITH x AS (SELECT 1)" + _YEARLY + " SELECT run_id, product_id FROM rb JOIN sw USING (retailer) WHERE last_price_at = started_at AND first_seen_at <> started_at")
def run_listings_repriced(spark, d):
    return runs.run_listings(*_yearly(spark, d), "repriced").select("run_id", "product_id")


@query("WITH x AS (SELECT 1)" + _YEARLY + " SELECT run_id, product_id FROM rb JOIN sw USING (retailer) WHERE NOT available AND last_seen_at < started_at AND (before_at IS NULL OR last_seen_at >= before_at)")
def run_listings_gone(spark, d):
    return runs.run_listings(*_yearly(spark, d), "gone").select("run_id", "product_id")


@query(""", kept AS (SELECT * FROM listing WHERE product_id % 7 <> 0) SELECT product_id FROM product WHERE product_id IN (SELECT product_id FROM kept) OR product_id NOT IN (SELECT product_id FROM listing)""", True)
def purge(spark, d):
    c = catalog(spark, d)
    evidence = c.listing.where(F.col("product_id") % 7 == 0).select("retailer", "external_id")
    left, _, _, _ = runs.purge(evidence, c.product, _identifiers(c), c.listing, c.retailer)
    return left.select("product_id")


@query(""", gone AS (SELECT * FROM listing WHERE product_id % 7 = 0 AND retailer_id % 2 = 0)
    SELECT (SELECT count(*) FROM gone) AS listings_deleted, (SELECT count(DISTINCT product_id) FROM gone WHERE product_id NOT IN (SELECT product_id FROM listing WHERE NOT (product_id % 7 = 0 AND retailer_id % 2 = 0))) AS products_deleted""", True)  # fmt: skip
def purge_counts(spark, d):
    """What a purge of even shops takes: their listings, and the products that no odd shop sells."""
    c = catalog(spark, d)
    even = F.substring("retailer", -1, 1).cast("int") % 2 == 0
    evidence = c.listing.where((F.col("product_id") % 7 == 0) & even).select("retailer", "external_id")
    return runs.purge(evidence, c.product, _identifiers(c), c.listing, c.retailer)[3]


def _identifiers(c):
    return c.product.where("gtin is not null").select("product_id", F.lit("gtin").alias("identifier_type"), F.col("gtin").alias("identifier_value"), F.lit("test").alias("source"))


@query("""SELECT product_id, string_agg(DISTINCT retailer, ',' ORDER BY retailer) AS shops, CAST(min(price) FILTER (WHERE available) AS DOUBLE) AS min_price, bool_or(available) AS available, count(DISTINCT retailer) AS n_shops
    FROM listing WHERE enabled AND market IN ('EUROPE', 'ASIA') GROUP BY product_id""", True)  # fmt: skip
def shelf(spark, d):
    c = catalog(spark, d)
    pairs = c.product.select(F.lit(1).alias("request_id"), "product_id", F.array(F.lit("EUROPE"), F.lit("ASIA")).alias("markets"), F.lit(None).cast("array<string>").alias("retailers"))
    s = search.shelf(pairs, c.listing, c.retailer)
    return s.select("product_id", F.array_join("shops", ",").alias("shops"), F.col("min_price").cast("double").alias("min_price"), "available", "n_shops")


def _requests(spark, d):
    """Every part name, the last word of each and every brand is asked for."""
    p = read(spark, d, "part")
    asked = p.select(F.col("p_name").alias("query")).union(p.select(F.element_at(F.split("p_name", " "), -1))).union(p.select("p_brand")).distinct()
    return asked.select(F.col("query").alias("request_id"), F.concat(F.lit(" "), F.upper("query")).alias("query"), F.lit(None).cast("array<string>").alias("markets"), F.lit(None).cast("array<string>").alias("retailers"))


_SEARCH = """, asked AS (SELECT p_name AS request_id FROM part UNION SELECT split_part(p_name, ' ', -1) FROM part UNION SELECT p_brand FROM part),
    q AS (SELECT request_id, lower(request_id) AS query FROM asked),
    sh AS (SELECT product_id, string_agg(DISTINCT retailer, ',' ORDER BY retailer) AS shops, min(price) FILTER (WHERE available) AS min_price, bool_or(available) AS in_stock, count(DISTINCT retailer) AS n_shops FROM listing WHERE enabled GROUP BY 1),
    m AS (SELECT request_id, query, p.*, sh.* EXCLUDE (product_id), list_transform(string_split(query, ' '), lambda t: contains(name_folded, t)) AS in_name, list_transform(string_split(query, ' '), lambda t: contains(search_blob, t)) AS in_blob FROM q, product p JOIN sh USING (product_id)),
    k AS (SELECT *, CASE WHEN name_folded = query THEN 'name_exact' WHEN starts_with(name_folded, query) THEN 'name_prefix' WHEN brand_folded = query THEN 'brand_exact' WHEN list_bool_and(in_name) THEN 'name_tokens'
      WHEN starts_with(brand_folded, query) THEN 'brand_prefix' WHEN list_bool_and(in_blob) THEN 'blob_tokens' END AS match_type FROM m WHERE list_bool_and(in_blob)),
    s AS (SELECT *, CASE match_type WHEN 'name_exact' THEN 100 WHEN 'name_prefix' THEN 80 WHEN 'brand_exact' THEN 70 WHEN 'name_tokens' THEN 60 WHEN 'brand_prefix' THEN 50 ELSE 30 END
      + CASE WHEN in_stock THEN 5 ELSE 0 END + CASE WHEN n_shops > 1 THEN 3 ELSE 0 END + CASE WHEN contains(query, CAST(quantity AS VARCHAR)) THEN 1 ELSE 0 END AS score FROM k),
    r AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, popularity DESC, canonical_name, product_id) AS rank FROM s)"""


@query(_SEARCH + " SELECT request_id, CAST(rank AS INTEGER) AS rank, product_id, canonical_name AS name, brand AS maker, popularity, shops, CAST(min_price AS DOUBLE) AS min_price, in_stock AS available, match_type, CAST(score AS INTEGER) AS score FROM r WHERE rank <= 10", True)
def search_topk(spark, d):
    c = catalog(spark, d)
    s = search.search(_requests(spark, d), c.product, c.listing, c.retailer, limit=10)
    return s.select("request_id", "rank", "product_id", "name", "maker", "popularity", F.array_join("shops", ",").alias("shops"), F.col("min_price").cast("double").alias("min_price"), "available", "match_type", "score")


@query(_SEARCH + """, own AS (SELECT DISTINCT product_id FROM listing WHERE enabled AND retailer_id % 4 = 1), t AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, popularity DESC, canonical_name, product_id) AS place FROM s JOIN own USING (product_id))
    SELECT request_id, CAST(place AS INTEGER) AS rank, product_id, shops, match_type, CAST(score AS INTEGER) AS score FROM t WHERE place <= 5""", True)  # fmt: skip
def search_in_shops(spark, d):
    """The same requests, each kept to what one shop in four sells; the other shops still show."""
    c = catalog(spark, d)
    few = retailers(spark, d).where("retailer_id % 4 = 1").agg(F.array_sort(F.collect_list("retailer")).alias("few"))
    asked = _requests(spark, d).drop("retailers").crossJoin(F.broadcast(few.withColumnRenamed("few", "retailers")))
    s = search.search(asked, c.product, c.listing, c.retailer, limit=5)
    return s.select("request_id", "rank", "product_id", F.array_join("shops", ",").alias("shops"), "match_type", "score")


@query(_SEARCH + " SELECT match_type, count(*) AS n FROM s GROUP BY 1", True)
def search_rungs(spark, d):
    c = catalog(spark, d)
    return search.scored(search.tokenised(_requests(spark, d)), c.product, c.listing, c.retailer).groupBy("match_type").agg(F.count("*").alias("n"))


_NAMED = """, nm AS (SELECT product_id, arg_min(market, (CASE WHEN retailer_name = canonical_name THEN '0' ELSE '1' END) || strftime(first_seen_at, '%Y%m%d%H%M%S') || retailer) AS named_in FROM listing GROUP BY 1),
    lo AS (SELECT product_id, retailer_name, row_number() OVER (PARTITION BY product_id ORDER BY available DESC, last_seen_at DESC, retailer, external_id) AS n FROM listing WHERE enabled AND market = 'EUROPE'),
    dn AS (SELECT p.product_id, CASE WHEN named_in IS NULL OR named_in = 'EUROPE' THEN p.canonical_name ELSE coalesce(lo.retailer_name, p.canonical_name) END AS display_name FROM product p LEFT JOIN nm USING (product_id) LEFT JOIN lo ON lo.product_id = p.product_id AND lo.n = 1)"""


@query(_NAMED + " SELECT product_id, display_name FROM dn", True)
def display_name(spark, d):
    c = catalog(spark, d)
    pairs = c.product.select(F.lit(1).alias("request_id"), "product_id", F.array(F.lit("EUROPE")).alias("markets"))
    return search.display_names(pairs, c.product, c.listing, c.retailer).select("product_id", "display_name")


@query(""", hit AS (SELECT DISTINCT lower(canonical_name) AS folded, product_id FROM goods UNION SELECT lower(retailer_name), product_id FROM listing),
    sh AS (SELECT product_id, string_agg(DISTINCT retailer, ',' ORDER BY retailer) AS shops FROM listing WHERE enabled GROUP BY 1),
    r AS (SELECT folded, product_id, canonical_name AS name, brand AS maker, shops, row_number() OVER (PARTITION BY folded ORDER BY popularity DESC, canonical_name, product_id) AS n FROM hit JOIN product USING (product_id) LEFT JOIN sh USING (product_id)
      WHERE folded IN (SELECT lower(p_name) FROM part))
    SELECT folded, product_id, name, maker, shops FROM r WHERE n = 1""", True)  # fmt: skip
def shops_for(spark, d):
    c = catalog(spark, d)
    asked = read(spark, d, "part").select(F.col("p_name").alias("request_id")).distinct().select("request_id", F.array(F.upper("request_id")).alias("names"), F.lit(None).cast("array<string>").alias("markets"))
    s = search.shops_for(asked, c.product, c.listing, c.retailer)
    return s.select("folded", "product_id", "name", "maker", F.array_join("shops", ",").alias("shops"))


@query(_NAMED + """, hit AS (SELECT DISTINCT lower(canonical_name) AS folded, product_id FROM goods UNION SELECT lower(retailer_name), product_id FROM listing),
    sh AS (SELECT product_id, string_agg(DISTINCT retailer, ',' ORDER BY retailer) AS shops FROM listing WHERE enabled AND market = 'EUROPE' GROUP BY 1),
    r AS (SELECT folded, product_id, brand AS maker, shops, row_number() OVER (PARTITION BY folded ORDER BY popularity DESC, canonical_name, product_id) AS n FROM hit JOIN product USING (product_id) JOIN sh USING (product_id) WHERE folded IN (SELECT lower(p_name) FROM part))
    SELECT folded, product_id, display_name AS name, maker, shops FROM r JOIN dn USING (product_id) WHERE n = 1""", True)  # fmt: skip
def shops_in_market(spark, d):
    """Each part name, asked for in one market: products that it doesn't sell go before the choice."""
    c = catalog(spark, d)
    asked = read(spark, d, "part").select(F.col("p_name").alias("request_id")).distinct().select("request_id", F.array("request_id").alias("names"), F.array(F.lit("EUROPE")).alias("markets"))
    s = search.shops_for(asked, c.product, c.listing, c.retailer)
    return s.select("folded", "product_id", "name", "maker", F.array_join("shops", ",").alias("shops"))


@query(_NAMED + """, sold AS (SELECT DISTINCT product_id FROM listing WHERE enabled AND market = 'EUROPE')
    SELECT gtin AS request_id, product_id, display_name AS name, brand AS maker, popularity FROM product JOIN dn USING (product_id) WHERE gtin IS NOT NULL AND product_id IN (SELECT product_id FROM sold)""", True)  # fmt: skip
def barcode_lookup(spark, d):
    c = catalog(spark, d)
    product, listing = c.product, c.listing
    asked = product.where("gtin is not null").select(F.col("gtin").alias("request_id"), F.array("gtin").alias("codes"), F.array(F.lit("EUROPE")).alias("markets"))
    return search.lookup_barcodes(asked, product, _identifiers(c), listing, c.retailer)


_GRAMS = "flatten(list_transform(list_filter(string_split({0}, ' '), lambda w: w <> ''), lambda w: list_transform(range(1, CAST(length(w) AS BIGINT) + 2), lambda i: substr('  ' || w || ' ', i, 3))))"


@query(f""", asked AS (SELECT p_name AS request_id FROM part UNION SELECT split_part(p_name, ' ', -1) FROM part UNION SELECT p_brand FROM part),
    q AS (SELECT request_id, list_distinct({_GRAMS.format("replace(lower(request_id), 'o', '0')")}) AS mine FROM asked),
    t AS (SELECT search_blob, {_GRAMS.format("search_blob")} AS theirs FROM (SELECT DISTINCT search_blob FROM product)),
    near AS (SELECT request_id, search_blob, mine, theirs, list_filter(range(1, CAST(len(theirs) AS BIGINT) + 1), lambda i: list_contains(mine, theirs[i])) AS places FROM q, t WHERE len(list_intersect(mine, theirs)) >= 0.42 * len(mine)),
    run AS (SELECT request_id, search_blob, mine, unnest(flatten(list_transform(places, lambda a: list_transform(list_filter(places, lambda b: b >= a), lambda b: list_distinct(theirs[a:b]))))) AS r FROM near),
    alike AS (SELECT request_id, search_blob, max(len(list_intersect(mine, r)) / (len(mine) + len(r) - len(list_intersect(mine, r)))) AS similarity FROM run GROUP BY 1, 2)
    SELECT request_id, product_id, similarity FROM alike JOIN product USING (search_blob) WHERE similarity >= 0.42""", True)  # fmt: skip
def fuzzy_recall(spark, d):
    c = catalog(spark, d)
    asked = search.tokenised(_requests(spark, d).withColumn("query", F.translate("query", "O", "0")))
    return search.fuzzy_matches(asked, c.product)


@query(""", f AS (SELECT * FROM product WHERE quantity IS NOT NULL AND product_id IN (SELECT product_id FROM listing WHERE available) AND gtin IS NOT NULL),
    pg AS (SELECT product_id FROM f ORDER BY popularity DESC, canonical_name, product_id LIMIT 25 OFFSET 25),
    sh AS (SELECT product_id, string_agg(DISTINCT retailer, ',' ORDER BY retailer) AS retailers, CAST(min(price) FILTER (WHERE available) AS DOUBLE) AS min_price, bool_or(available) AS available FROM listing GROUP BY 1)
    SELECT p.product_id, p.canonical_name, p.brand, p.category, popularity, listing_count, retailers, gtin AS barcodes, min_price, available, merge_key, (SELECT count(*) FROM f) AS total_count FROM pg JOIN product p USING (product_id) LEFT JOIN sh USING (product_id)""", True)  # fmt: skip
def admin_page(spark, d):
    c = catalog(spark, d)
    product = c.product
    page = admin.browse(product, product.where("gtin is not null").select("product_id", F.lit("gtin").alias("identifier_type"), F.col("gtin").alias("identifier_value")), c.listing, has_quantity=True, has_barcode=True, available=True, limit=25, offset=25)
    return page.select("product_id", "canonical_name", "brand", "category", "popularity", "listing_count", F.array_join("retailers", ",").alias("retailers"), F.array_join("barcodes", ",").alias("barcodes"), F.col("min_price").cast("double").alias("min_price"), "available", "merge_key", "total_count")


@query("""SELECT (SELECT count(*) FROM product) AS products, (SELECT count(*) FROM product WHERE add_count > 0) AS earned, (SELECT count(*) FROM product WHERE listing_count = 0) AS orphans, (SELECT count(*) FROM listing) AS listings,
    (SELECT count(*) FROM listing WHERE NOT available) AS unavailable, (SELECT count(DISTINCT product_id) FROM listing WHERE price IS NOT NULL) AS with_price, (SELECT count(gtin) FROM product) AS identifiers, (SELECT count(gtin) FROM product) AS with_barcode""", True)  # fmt: skip
def stats_totals(spark, d):
    c = catalog(spark, d)
    return admin.totals(c.product, _identifiers(c), c.listing)


@query("""SELECT market, count(DISTINCT product_id) AS products, count(*) AS listings, CAST(count(*) FILTER (WHERE NOT available) AS BIGINT) AS unavailable, count(DISTINCT product_id) FILTER (WHERE gtin IS NOT NULL) AS with_barcode
    FROM listing JOIN goods USING (product_id) GROUP BY market""", True)  # fmt: skip
def stats_by_market(spark, d):
    c = catalog(spark, d)
    return admin.by_market(c.listing, c.retailer, _identifiers(c))


@query(""", rn AS (SELECT l_suppkey AS retailer_id, year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY retailer_id ORDER BY y DESC) AS k FROM rn),
    c AS (SELECT retailer_id, count(*) AS listings, count(*) FILTER (WHERE available) AS available FROM listing GROUP BY 1)
    SELECT r.retailer, r.market, r.enabled, coalesce(listings, 0) AS listings, coalesce(c.available, 0) AS available, a.n AS last_valid, b.n AS previous_valid, a.n - b.n AS delta
    FROM retailer r LEFT JOIN c USING (retailer_id) LEFT JOIN k a ON a.retailer_id = r.retailer_id AND a.k = 1 LEFT JOIN k b ON b.retailer_id = r.retailer_id AND b.k = 2""", True)  # fmt: skip
def retailer_health(spark, d):
    c, shop = catalog(spark, d), retailers(spark, d).select("retailer_id", "retailer")
    per_year = read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("retailer_id"), F.year("l_shipdate").alias("y")).agg(F.count("*").alias("products_valid"))
    run = per_year.join(shop, "retailer_id").select("retailer", F.concat_ws("-", "retailer", "y").alias("run_id"), F.lit("completed").alias("status"), F.make_timestamp("y", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("started_at"), "products_valid")
    return admin.retailer_health(c.listing, c.retailer, run).select("retailer", "market", "enabled", "listings", "available", "last_valid", "previous_valid", "delta")


@query("""SELECT event_id AS bump_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'purchase') WHERE n <= 1""")
def rate_limited(spark, d):
    bumps = read(spark, d, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("bump_id"), "user_id", "ts")
    return popularity.limited(bumps, 1).select("bump_id", "user_id")


@query(""", first AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'purchase'),
    named AS (SELECT event_id, canonical_name AS name, brand FROM first JOIN goods ON product_id = event_id % (SELECT count(*) FROM part) WHERE n <= 1),
    best AS (SELECT lower(canonical_name) AS n, lower(brand) AS b, arg_max(product_id, popularity * 100000000 + product_id) AS best FROM product GROUP BY 1, 2)
    SELECT product_id, add_count + coalesce(cnt, 0) AS add_count FROM product LEFT JOIN (SELECT best AS product_id, count(*) AS cnt FROM named JOIN best ON n = lower(name) AND b = lower(brand) GROUP BY 1) USING (product_id)""", True)  # fmt: skip
def bump_popularity(spark, d):
    c = catalog(spark, d)
    product, n = c.product, read(spark, d, "part").count()
    asked = read(spark, d, "events").where("event_type = 'purchase'").join(product.select("product_id", F.col("canonical_name").alias("name"), F.col("brand").alias("maker")), F.col("event_id") % n == F.col("product_id"))
    return popularity.bump(asked.select(F.col("event_id").alias("bump_id"), "user_id", "ts", "name", "maker"), product, c.listing, 1).select("product_id", "add_count")


_LINES = "line AS (SELECT CAST(user_id AS VARCHAR) AS run_id, ts AS t, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'warn' ELSE 'info' END AS level, event_type AS scope, props AS message FROM events)"


def _lines(spark, d):
    level = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "warn").otherwise("info")
    return read(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("ts").alias("t"), level.alias("level"), F.col("event_type").alias("scope"), F.col("props").alias("message"))


_CAPPED = f"""WITH {_LINES}, n AS (SELECT *, row_number() OVER (PARTITION BY run_id, level ORDER BY t, scope, message) AS k FROM line), cap(level, cap) AS (VALUES ('info', 20), ('warn', 5)),
    s AS (SELECT run_id, level, count(*) AS n, max(t) AS t FROM line GROUP BY 1, 2)
    SELECT run_id, t, n.level AS level, scope, message FROM n LEFT JOIN cap ON cap.level = n.level WHERE cap IS NULL OR k <= cap
    UNION ALL SELECT run_id, t, 'warn', 'run-log', CAST(n - cap AS VARCHAR) || ' ' || s.level || ' lines were not kept: a run keeps at most ' || CAST(cap AS VARCHAR) FROM s JOIN cap ON cap.level = s.level WHERE n > cap"""


@query(_CAPPED)
def log_caps(spark, d):
    return logs.capped(_lines(spark, d), {"info": 20, "warn": 5})


@query(_CAPPED)
def stream_log_caps(spark, d):
    """Lines arrive in three parts, each handled by a query of its own that goes on from the checkpoint of the one before;
    runs close with the last part."""
    from marketloom.streaming import logs as log_streams

    path = f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}"
    lines = _lines(spark, d)
    ends = lines.select("run_id").distinct()
    span = lines.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    if span["a"] is None:
        return lines
    third = (span["b"] - span["a"]) / 3
    with log_streams.state_settings(spark):
        for k in range(3):
            part = lines.where((F.col("t") >= span["a"] + k * third) if k else F.lit(True)).where((F.col("t") < span["a"] + (k + 1) * third) if k < 2 else F.lit(True))
            part.write.mode("append").parquet(f"{path}/lines")
            (ends if k == 2 else ends.limit(0)).write.mode("append").parquet(f"{path}/ends")
            said, closed = (spark.readStream.schema(df.schema).parquet(f"{path}/{name}") for df, name in ((lines, "lines"), (ends, "ends")))
            kept = log_streams.capped_stream(said, closed, {"info": 20, "warn": 5})
            kept.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start(f"{path}/kept").awaitTermination()
    return spark.read.parquet(f"{path}/kept")


@query(f"WITH {_LINES} SELECT run_id, t, level FROM line WHERE t >= (TIMESTAMP '2024-02-05 00:00:00' - INTERVAL 30 DAY)")
def log_ttl(spark, d):
    return logs.recent(_lines(spark, d), "2024-02-05 00:00:00").select("run_id", "t", "level")


def _rendered(spark, d):
    """Parts as captured pages: one in four with its data in an attribute, one in five inside a graph."""
    p = products(spark, d).join(read(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_retailprice"), "product_id")
    offer = F.struct(F.col("p_retailprice").alias("price"), F.lit("EUR").alias("priceCurrency"), F.lit("https://schema.org/InStock").alias("availability"))
    node = F.struct(F.lit("Product").alias("@type"), F.col("canonical_name").alias("name"), F.col("product_id").cast("string").alias("sku"), F.array("gtin").alias("gtin13"), F.struct(F.col("brand").alias("name")).alias("brand"), F.array(offer).alias("offers"))
    crumbs = F.struct(F.lit("BreadcrumbList").alias("@type"), F.array(F.struct(F.lit(2).alias("position"), F.concat(F.lit("/c/"), "category").alias("item")), F.struct(F.lit(1).alias("position"), F.lit("/c").alias("item"))).alias("itemListElement"))
    plain = F.to_json(node)
    graph = F.to_json(F.struct(F.array(node).alias("@graph")))
    data = F.when(F.col("product_id") % 5 == 0, graph).otherwise(plain)
    script = F.concat(F.lit('<script type="application/ld+json">'), data, F.lit("</script>"))
    attribute = F.concat(F.lit('<script type="application/ld+json" children="'), F.replace(data, F.lit('"'), F.lit("&quot;")), F.lit('"></script>'))
    trail = F.concat(F.lit("<script type='application/ld+json'>"), F.to_json(crumbs), F.lit("</script><script type='application/ld+json'>{broken</script>"))
    return p.select("product_id", "category", F.concat(F.lit("<html>"), F.when(F.col("product_id") % 4 == 0, attribute).otherwise(script), trail, F.lit("</html>")).alias("html"))


@query("SELECT product_id, canonical_name AS name, CAST(product_id AS VARCHAR) AS sku, gtin, brand, CAST(p_retailprice AS DOUBLE) AS price, 'EUR' AS currency, true AS available FROM goods JOIN part ON p_partkey = product_id", True)
def jsonld_products(spark, d):
    got = jsonld.products(_rendered(spark, d), "product_id")
    return got.select("product_id", "name", "sku", "gtin", "brand", "price", "currency", text.is_available(F.col("availability")).alias("available"))


@query("SELECT product_id, '/c,/c/' || category AS links, category AS shelf FROM goods", True)
def breadcrumb_shelf(spark, d):
    got = jsonld.breadcrumbs(_rendered(spark, d), "product_id")
    return got.select("product_id", F.array_join("links", ",").alias("links"), F.element_at(F.split(F.element_at("links", -1), "/"), -1).alias("shelf"))


def _sitemap(spark, d):
    """Pages as url blocks, ten to a file; every third without an address of its own."""
    p = read(spark, d, "pages")
    escaped = F.replace(F.concat("url", F.lit("?é")), F.lit("&"), F.lit("&amp;"))
    escaped = F.when(F.col("page_id") % 2 == 0, F.replace(escaped, F.lit("é"), F.lit("&#233;"))).otherwise(escaped)
    loc = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<loc></loc><xhtml:link rel="alternate" href="'), escaped, F.lit('"/>'))).otherwise(F.concat(F.lit("<loc>"), escaped, F.lit("</loc>")))
    stamp = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<lastmod>2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit("</lastmod>"))).when(F.col("page_id") % 5 == 0, "<lastmod>soon</lastmod>").otherwise("")
    return p.groupBy(F.floor(F.col("page_id") / 10).alias("file")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", F.concat(F.lit("<url>"), loc, stamp, F.lit("</url>")).alias("b")))), lambda x: x["b"]), ""), F.lit("</urlset>")).alias("body"))


_ENTRIES = "e AS (SELECT page_id, url || '?é' AS loc, CASE WHEN page_id % 2 = 0 THEN make_timestamp(2024, 1, CAST(page_id % 28 + 1 AS BIGINT), 0, 0, 0.0) END AS lastmod FROM pages)"


@query(f"WITH {_ENTRIES} SELECT loc, lastmod FROM e")
def sitemap_urls(spark, d):
    return captures.urlset(_sitemap(spark, d))


@query(f"WITH {_ENTRIES}, k AS (SELECT loc, row_number() OVER (ORDER BY page_id) - 1 AS k FROM e WHERE lastmod IS NULL OR lastmod >= TIMESTAMP '2024-01-15') SELECT loc FROM k WHERE k % 3 = 1")
def incremental_shard(spark, d):
    """A third of what is new, by place in the sitemaps."""
    entries = captures.urlset(_sitemap(spark, d), order="file")
    return captures.shard(captures.incremental(entries, "2024-01-15 00:00:00"), 1, 3, "file", "place").select("loc")


@query("""WITH p AS (SELECT l_suppkey AS department, l_linenumber AS page, list_sort(list(DISTINCT l_partkey % 3)) AS ids FROM lineitem GROUP BY 1, 2),
    e AS (SELECT *, CAST(coalesce(ids = lag(ids) OVER (PARTITION BY department ORDER BY page), false) AS INTEGER) AS ends FROM p)
    SELECT department, page, CAST(len(ids) AS INTEGER) AS n FROM (SELECT *, max(ends) OVER (PARTITION BY department ORDER BY page) AS done FROM e) WHERE done = 0""")
def page_truncation(spark, d):
    li = read(spark, d, "lineitem")
    pages = li.groupBy(F.col("l_suppkey").alias("department"), F.col("l_linenumber").alias("page")).agg(F.array_sort(F.collect_set(F.col("l_partkey") % 3)).alias("ids"))
    return crawl.until_repeat(pages).select("department", "page", F.size("ids").alias("n"))


@query("""SELECT (SELECT count(*) FROM part) AS advertised, count(DISTINCT l_partkey) AS seen, count(DISTINCT l_partkey) / (SELECT count(*) FROM part) AS ratio, count(DISTINCT l_partkey) / (SELECT count(*) FROM part) >= 0.95 AS authoritative FROM lineitem """)
def coverage(spark, d):
    advertised = read(spark, d, "part").select(F.col("p_partkey").alias("external_id"))
    return crawl.coverage(advertised, read(spark, d, "lineitem").select(F.col("l_partkey").alias("external_id")))


@query("""WITH r AS (SELECT l_partkey AS external_id, 'd' || repeat('x', CAST(l_linenumber AS INTEGER)) AS department, l_suppkey AS page, l_orderkey AS pos FROM lineitem)
    SELECT external_id, department, page, pos FROM (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY length(department) DESC, department, page, pos) AS n FROM r) WHERE n = 1""")
def narrowest_department(spark, d):
    rows = read(spark, d, "lineitem").select(F.col("l_partkey").alias("external_id"), F.concat(F.lit("d"), F.repeat(F.lit("x"), F.col("l_linenumber"))).alias("department"), F.col("l_suppkey").alias("page"), F.col("l_orderkey").alias("pos"))
    return crawl.narrowest_department(rows)


@query("""WITH h AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '#.*$', ''), '^https?://[^/]+', '') AS path FROM pages)
    SELECT page_id, NOT (path LIKE '/en/%' AND NOT path LIKE '/en/4%') AND NOT path LIKE '%.html' AS allowed FROM h""")
def robots_admission(spark, d):
    pages = read(spark, d, "pages").select("page_id", "url")
    hosts = pages.select(F.parse_url("url", F.lit("HOST")).alias("host")).distinct()
    files = hosts.select("host", F.lit("User-agent: loom\nCrawl-delay: 5\nUser-agent: other\nno field\nDisallow: /\n\nUser-agent: *\nSitemap: https://x/s.xml\nUser-agent: loom\nDisallow: /en/ # most\nAllow: /en/4\nDisallow: /*.html$").alias("body"))
    return crawl.allowed(pages, crawl.robots_rules(files, ["loom"])).select("page_id", "allowed")


@query("SELECT CAST(user_id AS VARCHAR) AS run_id, date_trunc('minute', ts) AS minute, count(*) AS pages_read, max(ts) AS last_alive_at FROM events WHERE user_id % 10 <> 0 GROUP BY 1, 2")
def liveness(spark, d):
    """Fetches as reports of runs, of which every tenth is closed and no longer heard."""
    fetches = read(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id"), "ts")
    run = fetches.select("run_id").distinct().withColumn("status", F.when(F.col("run_id").cast("long") % 10 == 0, "completed").otherwise("running"))
    return streams.liveness(fetches, runs=run)


@query("""SELECT product_id, 'kept-' || CAST(product_id AS VARCHAR) AS external_id, CAST(CASE WHEN product_id % 2 = 0 THEN p_retailprice END AS DOUBLE) AS price, CASE WHEN product_id % 2 = 0 THEN 'EUR' END AS currency,
    CAST(part.p_size AS DOUBLE) * 2 AS quantity, 'ml' AS unit, product_id % 2 = 0 OR product_id % 3 = 0 AS available FROM goods JOIN part ON p_partkey = product_id""", True)  # fmt: skip
def product_records(spark, d):
    from marketloom.functions import build

    p = products(spark, d).join(read(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_retailprice", "p_size"), "product_id")
    pages = p.select(
        F.when(F.col("product_id") % 2 == 0, "even").otherwise("odd").alias("retailer"), F.concat(F.lit("//shop/p/kept-"), F.col("product_id").cast("string"), F.lit("/x")).alias("url"), F.concat(F.lit("CASE 2 x "), F.col("p_size").cast("string"), F.lit(" ML")).alias("name"), "brand",
        F.lit(None).cast("string").alias("gtin"), F.col("p_retailprice").alias("price"), F.lit(None).cast("string").alias("currency"), F.when(F.col("product_id") % 3 == 0, "https://schema.org/InStock").alias("availability"), "category",
    )
    policies = spark.createDataFrame([("even", "/p/([^/]+)", "EUR", True, True, None, False), ("odd", "/p/([^/]+)", "EUR", False, False, None, False)], build.POLICY)
    out = build.product_records(spread(pages), policies)
    return out.select(F.regexp_extract("external_id", r"(\d+)$", 1).cast("long").alias("product_id"), "external_id", "price", "currency", "quantity", "unit", "available")


@query("""SELECT p_partkey AS part, CASE WHEN p_name LIKE '% ring' THEN 'home' WHEN p_type = 'PROMO' THEN 'snacks' WHEN p_name LIKE '%widget' THEN 'pet' ELSE NULL END AS category FROM part""")
def shelf_rules(spark, d):
    from marketloom.functions import products as jobs

    p = read(spark, d, "part")
    rows = p.select("p_partkey", F.lit("s").alias("retailer"), F.concat_ws(" & ", F.when(F.col("p_type") == "PROMO", "Promo goods"), "p_name").alias("shelf"), F.lit(None).cast("string").alias("category"))
    rules = spark.createDataFrame([("s", 1, "promo", "snacks"), ("s", 2, " widget$", "pet")], "retailer string, ord int, pattern string, category string")
    shelves = rows.select("retailer", "shelf").distinct().where("shelf like '% ring'").withColumn("category", F.lit("home"))
    return jobs.with_category(rows, rules, shelves).select(F.col("p_partkey").alias("part"), "category")


@query("SELECT p_partkey AS part FROM part WHERE p_size % 5 IN (0, 1) AND p_size % 10 <> 1")
def allowlisted(spark, d):
    p = read(spark, d, "part")
    path = lambda c: F.concat(F.lit("/"), (F.col("p_size") % 5).cast("string"), F.lit("/"), c)
    rows = p.select("p_partkey", F.array(path(F.lit("")), path(F.concat((F.col("p_size") % 10).cast("string"), F.lit("/")))).alias("paths"))
    return rows.where(crawl.in_allowlist(F.col("paths"), ["/0/", "/1/"], ["/1/1/"])).select(F.col("p_partkey").alias("part"))


from marketloom import import_queries, source_queries  # noqa: E402,F401  (they register themselves)
