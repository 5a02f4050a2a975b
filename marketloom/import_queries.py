"""Queries over imports in several batches, runs, edits and streams, and the SQL that each is held against."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketloom import schema
from marketloom.operators import admin, crawl, deltas, match, popularity, runs, search, validate
from marketloom.plans.catalog import catalog, products, read, retailers
from marketloom.registry import query
from marketloom.session import shared_folder, written
from marketloom.streaming import catalog as streams

_T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]


def _rows(p, **columns):
    """Import rows of parts p; columns overrides."""
    k, null = F.col("product_id"), lambda kind="string": F.lit(None).cast(kind)
    values = {
        "ordinal": k, "external_id": k.cast("string"), "name": F.concat_ws(" ", "canonical_name", k.cast("string")), "brand": F.col("brand"), "gtin": null(), "price": F.col("price").cast("decimal(12,2)"), "currency": F.lit("EUR"), "quantity": null("decimal(18,3)"),
        "unit": null(), "category": null(), "product_url": F.concat(F.lit("https://shop/"), k.cast("string")), "available": F.lit(True),
    } | columns
    return p.select(*[c.alias(n) for n, c in values.items()])


def _imports(spark, d):
    """Three batches.

    Shop a brings even parts with their codes. Shop b brings all parts: even ones that have a code under another name
    (found by code), other even ones under the same name (found by key, and given a category), odd ones as new. Then shop
    b brings all of them again, renamed (known listings): every fifth at another price, those found by key with a size,
    every seventh with the code of the part after the next one (a conflict).
    """
    p = products(spark, d).join(read(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price")), "product_id")
    p = written(p)
    k, even = F.col("product_id"), F.col("product_id") % 2 == 0
    coded = even & F.col("gtin").isNotNull()
    renamed = F.concat_ws(" ", "canonical_name", F.when(coded, "other"), k.cast("string"))
    by_key = even & F.col("gtin").isNull()
    ahead = p.select((k - 2).alias("product_id"), F.col("gtin").alias("ahead"))
    later = written(p.join(ahead, "product_id", "left"))
    batches = [
        ("a", _rows(p.where(even), gtin=F.col("gtin"))),
        ("b", _rows(p, gtin=F.col("gtin"), name=renamed, category=F.when(by_key, "dairy"))),
        ("b", _rows(later, gtin=F.when(k % 7 == 0, F.col("ahead")), name=F.concat_ws(" ", F.lit("again"), k.cast("string")), quantity=F.when(by_key, F.lit(2)).cast("decimal(18,3)"), unit=F.when(by_key, "kg"), price=(F.col("price") + F.when(k % 5 == 0, 1).otherwise(0)).cast("decimal(12,2)"))),
    ]
    state = _none(spark, schema.PRODUCT + ", merge_key string"), _none(spark, schema.IDENTIFIER), _none(spark, schema.LISTING)
    done = []
    for (shop, rows), at in zip(batches, _T):
        done.append(match.import_rows(rows, shop, at, *state))
        state = written(done[-1].product), written(done[-1].identifier), written(done[-1].listing)
    return done, state


def _none(spark, shape):
    return spark.createDataFrame([], shape)


#: What the batches decide: kept beside the rule above.
_DECIDED = """, n AS (SELECT goods.*, p_retailprice AS price, product_id % 2 = 0 AS even, lead(gtin, 2) OVER (ORDER BY product_id) AS ahead FROM goods JOIN part ON p_partkey = product_id),
    two AS (SELECT *, CASE WHEN even THEN 'a:' ELSE 'b:' END || CAST(product_id AS VARCHAR) AS found FROM n),
    decided AS (
      SELECT 1 AS batch, product_id, 'a:' || CAST(product_id AS VARCHAR) AS found, 'new' AS how, false AS conflict, true AS created, gtin AS add_gtin, 'inserted' AS outcome FROM n WHERE even
      UNION ALL SELECT 2, product_id, found, CASE WHEN even AND gtin IS NOT NULL THEN 'gtin' WHEN even THEN 'key' ELSE 'new' END, false, NOT even, CASE WHEN NOT even THEN gtin END, 'inserted' FROM two
      UNION ALL SELECT 3, product_id, found, 'listing', product_id % 7 = 0 AND ahead IS NOT NULL, false, NULL, 'updated' FROM two)"""


@query(_DECIDED + " SELECT batch, product_id AS part, found AS product_id, how, conflict, created, add_gtin, outcome FROM decided", True)
def import_batches(spark, d):
    """Rows by code, by known listing and new ones, with conflicts."""
    done, _ = _imports(spark, d)
    every = [x.decision.select(F.lit(n + 1).alias("batch"), F.col("external_id").cast("long").alias("part"), "product_id", "how", "conflict", "created", "add_gtin", "outcome") for n, x in enumerate(done)]
    return every[0].unionByName(every[1]).unionByName(every[2])


@query(_DECIDED + """ SELECT batch, count(*) FILTER (WHERE outcome = 'inserted') AS inserted, count(*) FILTER (WHERE outcome = 'updated') AS updated, CAST(0 AS BIGINT) AS unchanged, count(*) FILTER (WHERE created) AS products_created, count(add_gtin) AS identifiers_added,
    count(*) FILTER (WHERE conflict) AS conflicts, CAST(0 AS BIGINT) AS errors FROM decided GROUP BY batch""", True)  # fmt: skip
def import_batch_counters(spark, d):
    done, _ = _imports(spark, d)
    every = [match.import_counters(x).withColumn("batch", F.lit(n + 1)) for n, x in enumerate(done)]
    return every[0].unionByName(every[1]).unionByName(every[2])


@query(_DECIDED + """, li AS (
      SELECT 'a' AS retailer, CAST(product_id AS VARCHAR) AS external_id, 'a:' || CAST(product_id AS VARCHAR) AS product_id, canonical_name || ' ' || CAST(product_id AS VARCHAR) AS retailer_name, round(price, 2) AS price, NULL AS previous_price, 1 AS priced, 1 AS first, 1 AS last FROM n WHERE even
      UNION ALL SELECT 'b', CAST(product_id AS VARCHAR), found, 'again ' || CAST(product_id AS VARCHAR), round(price, 2) + CASE WHEN product_id % 5 = 0 THEN 1 ELSE 0 END, CASE WHEN product_id % 5 = 0 THEN round(price, 2) END, CASE WHEN product_id % 5 = 0 THEN 3 ELSE 2 END, 2, 3 FROM two)
    SELECT retailer, external_id, product_id, retailer_name, CAST(price AS DOUBLE) AS price, CAST(previous_price AS DOUBLE) AS previous_price, make_timestamp(2024, 1, priced, 0, 0, 0.0) AS last_price_at, make_timestamp(2024, 1, first, 0, 0, 0.0) AS first_seen_at, make_timestamp(2024, 1, last, 0, 0, 0.0) AS last_seen_at FROM li""", True)  # fmt: skip
def import_listings(spark, d):
    _, (_, _, listing) = _imports(spark, d)
    return listing.select("retailer", "external_id", "product_id", "retailer_name", F.col("price").cast("double").alias("price"), F.col("previous_price").cast("double").alias("previous_price"), "last_price_at", "first_seen_at", "last_seen_at")


@query(_DECIDED + """, shown AS (SELECT found AS pid, 'again ' || CAST(product_id AS VARCHAR) AS shop_name FROM two UNION ALL SELECT 'a:' || CAST(product_id AS VARCHAR), lower(canonical_name) || ' ' || CAST(product_id AS VARCHAR) FROM n WHERE even),
    names AS (SELECT pid, count(*) AS listing_count, string_agg(DISTINCT shop_name, ' ' ORDER BY shop_name) AS names FROM shown GROUP BY 1)
    SELECT pid AS product_id, listing_count, 5 * listing_count AS popularity, lower(n.canonical_name) || ' ' || CAST(n.product_id AS VARCHAR) || ' ' || lower(brand) || ' ' || names AS search_blob, CASE WHEN even AND gtin IS NULL THEN 'dairy' END AS category, CASE WHEN even AND gtin IS NULL THEN 'kg' END AS quantity_unit
    FROM names JOIN n ON n.product_id = CAST(split_part(pid, ':', 2) AS BIGINT)""", True)  # fmt: skip
def import_searchable(spark, d):
    """After the imports: what search reads follows from the products and their listings."""
    done, _ = _imports(spark, d)
    return match.searchable(done[-1]).select("product_id", "listing_count", "popularity", "search_blob", "category", "quantity_unit")


@query("SELECT CAST(p_partkey AS VARCHAR) AS external_id, left(p_name, 80) AS name, CASE WHEN p_partkey % 3 = 0 THEN 'incomplete_row' WHEN p_partkey % 3 = 1 THEN 'price_range' ELSE 'url_https' END AS error FROM part ORDER BY p_partkey LIMIT 25")
def import_errors(spark, d):
    """Every row is broken in one of three ways; the report shows the first 25."""
    p = products(spark, d).withColumn("price", F.when(F.col("product_id") % 3 == 1, -1.0).otherwise(1.0))
    k = F.col("product_id")
    rows = _rows(p, name=F.col("canonical_name"), product_url=F.when(k % 3 == 0, " ").when(k % 3 == 2, "http://x").otherwise("https://x"))
    done = match.import_rows(rows, "s", _T[0], _none(spark, schema.PRODUCT + ", merge_key string"), _none(spark, schema.IDENTIFIER), _none(spark, schema.LISTING))
    return match.first_errors(done)


def _open_runs(spark, d):
    """A run for each retailer, started on a day of its own; every third is still running."""
    s = read(spark, d, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.cast("string").alias("run_id"), k.cast("string").alias("retailer"), F.when(k % 3 == 0, "running").otherwise("completed").alias("status"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((k % 5).cast("int"), (k % 24).cast("int"))).alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"), F.lit(0).cast("long").alias("products_found"), (k * 2).alias("products_valid"), F.lit(0).cast("long").alias("marked_unavailable"), F.lit(None).cast("string").alias("error"),
    )


_OPEN = "WITH r AS (SELECT CAST(s_suppkey AS VARCHAR) AS run_id, CASE WHEN s_suppkey % 3 = 0 THEN 'running' ELSE 'completed' END AS status, TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 5 AS INTEGER)) + to_hours(s_suppkey % 24) AS started_at FROM supplier)"


@query(_OPEN + """ SELECT run_id, CASE WHEN dead THEN 'failed' ELSE status END AS status, CASE WHEN dead THEN TIMESTAMP '2024-01-04' END AS finished_at, CASE WHEN dead THEN 'reaped' END AS error FROM (SELECT *, status = 'running' AND started_at < TIMESTAMP '2024-01-03 12:00:00' AS dead FROM r)
    UNION ALL SELECT 'new', 'running', NULL, NULL""")
def open_runs(spark, d):
    """Opening a run fails those that have been left running."""
    return runs.open_run(_open_runs(spark, d), "new", "1", "2024-01-04 00:00:00").select("run_id", "status", "finished_at", "error")


@query(_OPEN + " SELECT run_id, CASE WHEN stopped THEN 'partial' ELSE status END AS status, CASE WHEN stopped THEN TIMESTAMP '2024-01-09' END AS finished_at, CASE WHEN stopped THEN 'limit' END AS error FROM (SELECT *, status = 'running' AND CAST(run_id AS BIGINT) % 2 = 0 AS stopped FROM r)")
def stop_runs(spark, d):
    r = _open_runs(spark, d)
    stopped = r.where(F.col("run_id").cast("long") % 2 == 0).select("run_id", F.lit("partial").alias("new_status"), F.lit("limit").alias("reason"))
    return runs.stop(r, stopped, "2024-01-09 00:00:00").select("run_id", "status", "finished_at", "error")


@query(""", before AS (SELECT CAST(retailer_id AS VARCHAR) AS retailer, count(*) AS valid FROM listing GROUP BY 1), gone AS (SELECT CAST(retailer_id AS VARCHAR) AS retailer, count(*) FILTER (WHERE available AND last_seen_at < TIMESTAMP '1998-01-01') AS n FROM listing GROUP BY 1)
    SELECT retailer AS run_id, CASE WHEN CAST(retailer AS BIGINT) % 4 = 0 THEN 'partial' ELSE 'completed' END AS status, CASE WHEN CAST(retailer AS BIGINT) % 4 = 0 THEN 0 ELSE n END AS marked_unavailable FROM before JOIN gone USING (retailer)""", True)  # fmt: skip
def close_runs(spark, d):
    """Verdict and sweep in one: every fourth shop's run found less than half of what the one before it had."""
    c = catalog(spark, d)
    shop = retailers(spark, d).select(F.col("retailer_id").cast("string").alias("id"), "retailer")
    listing = c.listing.join(shop, "retailer").drop("retailer").withColumnRenamed("id", "retailer")
    n = written(listing.groupBy("retailer").agg(F.count("*").alias("n")))
    run = lambda run_id, status, at, found: n.select(run_id.alias("run_id"), "retailer", F.lit(status).alias("status"), F.lit(at).cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"), F.lit(0).cast("long").alias("products_found"), found.cast("long").alias("products_valid"), F.lit(0).cast("long").alias("marked_unavailable"), F.lit(None).cast("string").alias("error"))
    low = F.col("retailer").cast("long") % 4 == 0
    now = run(F.col("retailer"), "running", "1998-01-01", F.when(low, F.floor((F.col("n") - 1) / 2)).otherwise(F.col("n")))
    every = written(now.unionByName(run(F.concat(F.lit("old-"), "retailer"), "completed", "1997-01-01", F.col("n"))))
    closing = every.where("status = 'running'").select("run_id", "retailer", "started_at", "products_valid", F.lit(False).alias("covered"))
    after, _ = runs.close(closing, every, listing, "1998-01-02 00:00:00")
    return after.where("run_id not like 'old-%'").select("run_id", "status", "marked_unavailable")


def _reports(spark, d):
    e = read(spark, d, "events")
    n = read(spark, d, "supplier").count()
    return e.select((F.col("user_id") % n + 1).cast("string").alias("run_id"), F.col("ts").alias("reported_at"), (F.col("event_id") % 7 - 2).alias("pages"), F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("done"), F.lit(None).cast("long").alias("total"), F.lit(" ").alias("unit"))


_SAID = "WITH p AS (SELECT CAST(user_id % (SELECT count(*) FROM supplier) + 1 AS VARCHAR) AS run_id, ts, event_id % 7 - 2 AS pages, CASE WHEN event_id % 2 = 0 THEN event_id END AS done FROM events), s AS (SELECT run_id, sum(greatest(pages, 0)) AS pages, max(ts) AS heard FROM p GROUP BY 1)"


@query(_SAID + " SELECT CAST(s_suppkey AS VARCHAR) AS run_id, CASE WHEN s_suppkey % 3 = 0 THEN CAST(coalesce(pages, 0) AS BIGINT) ELSE 0 END AS pages_read, CASE WHEN s_suppkey % 3 = 0 THEN heard END AS last_alive_at, CAST(50 AS BIGINT) AS progress_total FROM supplier LEFT JOIN s ON run_id = CAST(s_suppkey AS VARCHAR)")
def runs_alive(spark, d):
    """Reports of life; those of closed runs don't count."""
    live = _open_runs(spark, d).withColumns({"pages_read": F.lit(0).cast("long"), "last_alive_at": F.lit(None).cast("timestamp"), "progress_done": F.lit(None).cast("long"), "progress_total": F.lit(50).cast("long"), "progress_unit": F.lit("page")})
    return runs.alive(live, _reports(spark, d)).select("run_id", "pages_read", "last_alive_at", "progress_total")


@query(_SAID + " SELECT CAST(s_suppkey AS VARCHAR) AS run_id, CASE WHEN s_suppkey % 3 = 0 THEN CAST(coalesce(pages, 0) AS BIGINT) ELSE 0 END AS products_found FROM supplier LEFT JOIN s ON run_id = CAST(s_suppkey AS VARCHAR)")
def run_counters(spark, d):
    reports = _reports(spark, d).select("run_id", F.col("pages").alias("products_found"))
    return runs.add_counters(_open_runs(spark, d), reports, ["products_found"]).select("run_id", "products_found")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS run_id FROM supplier LEFT JOIN (SELECT user_id % (SELECT count(*) FROM supplier) + 1 AS id, max(ts) AS heard FROM events GROUP BY 1) ON id = s_suppkey WHERE s_suppkey % 3 = 0 AND coalesce(heard, TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 5 AS INTEGER)) + to_hours(s_suppkey % 24)) < TIMESTAMP '2024-01-30'")
def silent_runs(spark, d):
    heard = streams.liveness(_reports(spark, d).select("run_id", F.col("reported_at").alias("ts")))
    return streams.silent(heard, _open_runs(spark, d), "2024-01-30 00:10:00").select("run_id")


def _arriving(df):
    """df as a stream of files."""
    path = f"{shared_folder(df.sparkSession)}/marketloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


@query("SELECT event_id AS bump_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'purchase') WHERE n <= 1")
def stream_rate_limited(spark, d):
    """The stream's twin of rate_limited, run to the end of what is there and kept as a table."""
    bumps = _arriving(read(spark, d, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("bump_id"), "user_id", F.col("ts").cast("timestamp").alias("ts")))
    out = f"{shared_folder(spark)}/marketloom/{uuid.uuid4().hex}"
    streams.limited_stream(bumps, 1, late="30 days").writeStream.format("parquet").option("checkpointLocation", f"{out}-state").outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).select("bump_id", "user_id")


@query(""", edit AS (SELECT product_id, CASE WHEN product_id % 2 = 0 THEN 'Edited ' || CAST(product_id AS VARCHAR) END AS new_name, CASE WHEN product_id % 3 = 0 THEN '' END AS new_brand FROM product WHERE product_id % 10 < 4)
    SELECT p.product_id, coalesce(new_name, canonical_name) AS canonical_name, CASE WHEN new_brand IS NULL THEN brand END AS brand FROM product p LEFT JOIN edit e USING (product_id)""", True)  # fmt: skip
def admin_update(spark, d):
    """Four in ten parts are edited: names set, brands cleared; of two edits the later counts. All names are made unique first."""
    goods, codes, edits = _edited(spark, d)
    after, _, _ = admin.update(edits, goods, codes)
    return after.select("product_id", F.regexp_replace("canonical_name", " #[0-9]+$", "").alias("canonical_name"), "brand")


def _edited(spark, d):
    from marketloom.functions import text

    c = catalog(spark, d)
    k = F.col("product_id")
    goods = c.product.withColumn("canonical_name", F.concat(F.col("canonical_name"), F.lit(" #"), k.cast("string")))
    goods = written(goods.withColumn("merge_key", text.merge_key(F.col("brand"), F.col("canonical_name"), F.col("quantity"), F.col("quantity_unit"))))
    codes = written(goods.where("gtin is not null").select("product_id", F.lit("gtin").alias("identifier_type"), F.col("gtin").alias("identifier_value"), F.when(k % 2 == 0, "admin").otherwise("shop").alias("source")))
    null = F.lit(None).cast("string")
    edits = goods.where(k % 10 < 4).select((k * 2).alias("edit_id"), "product_id", F.when(k % 2 == 0, F.concat(F.lit("Edited "), k.cast("string"))).alias("name"), F.when(k % 3 == 0, "").alias("brand"), null.alias("category"), F.concat(F.lit("99"), F.lpad(k.cast("string"), 10, "0")).alias("barcode"))
    return goods, codes, edits.unionByName(edits.withColumns({"edit_id": F.col("edit_id") - 1, "name": F.lit("Superseded")}))


@query(""", code AS (SELECT product_id, gtin AS code, CASE WHEN product_id % 2 = 0 THEN 'admin' ELSE 'shop' END AS source FROM product WHERE gtin IS NOT NULL)
    SELECT product_id, code AS identifier_value, source FROM code WHERE NOT (source = 'admin' AND product_id % 10 < 4) UNION ALL SELECT product_id, '99' || lpad(CAST(product_id AS VARCHAR), 10, '0'), 'admin' FROM product WHERE product_id % 10 < 4""", True)  # fmt: skip
def admin_barcodes(spark, d):
    """An editor's code replaces the one an editor gave before; codes from shops stay."""
    goods, codes, edits = _edited(spark, d)
    return admin.update(edits, goods, codes)[1].select(F.col("product_id").cast("long").alias("product_id"), "identifier_value", "source")


@query(""", e AS (SELECT p_partkey AS edit_id, CASE p_partkey % 4 WHEN 0 THEN 'bad_name' WHEN 1 THEN 'duplicate_barcode' WHEN 2 THEN 'bad_barcode' END AS error FROM part WHERE p_partkey % 3 <> 0) SELECT edit_id, error FROM e""", True)
def admin_create(spark, d):
    """New products, of which one in four is good: no name, a code that is taken, a code that is none."""
    c = catalog(spark, d)
    p, k = c.product.where(F.col("product_id") % 3 != 0), F.col("product_id")
    kind = lambda n: k % 4 == n
    edits = p.select(k.alias("edit_id"), F.when(kind(0), " ").otherwise(F.concat(F.lit("Fresh "), k.cast("string"))).alias("name"), F.lit(None).cast("string").alias("brand"), F.lit(None).cast("decimal(18,3)").alias("quantity"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("category"), F.when(kind(1), F.col("gtin")).when(kind(2), "12").otherwise(F.concat(F.lit("88"), F.lpad(k.cast("string"), 10, "0"))).alias("barcode"))
    codes = c.product.where("gtin is not null").select(k.cast("string").alias("product_id"), F.lit("gtin").alias("identifier_type"), F.col("gtin").alias("identifier_value"), F.lit("test").alias("source"))
    accepted, _, rejected = admin.create(edits, c.product.withColumn("product_id", k.cast("string")), codes)
    return accepted.select("edit_id", F.lit(None).cast("string").alias("error")).unionByName(rejected.select("edit_id", "error"))


@query("SELECT retailer, product_id FROM listing WHERE product_id % 4 <> 0", True)
def admin_delete(spark, d):
    c = catalog(spark, d)
    return admin.delete(c.product.where("product_id % 4 = 0"), c.product, c.listing)[1].select("retailer", "product_id")


@query("""SELECT (SELECT count(*) FROM product) AS products, (SELECT count(*) FROM listing) AS listings, (SELECT count(*) FROM retailer) AS retailers, (SELECT count(DISTINCT market) FROM listing) AS markets,
    (SELECT count(*) FROM listing WHERE market = 'ASIA') AS in_asia, (SELECT count(*) FROM listing WHERE available) AS available""", True)  # fmt: skip
def stats_snapshot(spark, d):
    c = catalog(spark, d)
    codes = c.product.where("gtin is not null").select("product_id", F.lit("gtin").alias("identifier_type"), F.col("gtin").alias("identifier_value"))
    s = admin.snapshot(c.product, codes, c.listing, c.retailer, "2024-01-01 00:00:00")
    return s.select("totals.products", "totals.listings", F.size("retailers").cast("long").alias("retailers"), F.size("markets").cast("long").alias("markets"), F.col("markets")["ASIA"]["listings"].alias("in_asia"), F.aggregate(F.map_values("retailers"), F.lit(0).cast("long"), lambda n, x: n + x["available"]).alias("available"))


@query("SELECT CAST(retailer_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR) AS key FROM latest WHERE product_id % 9 = 0", True)
def dangling_listings(spark, d):
    """Listings whose product is not there."""
    c = catalog(spark, d)
    shop = retailers(spark, d).select("retailer_id", "retailer")
    return validate.dangling(c.listing.join(shop, "retailer"), c.product.where("product_id % 9 <> 0"), "product_id").select(F.concat_ws("-", "retailer_id", "product_id").alias("key"))


@query("SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS external_id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 2 = 0)")
def seen_not_kept(spark, d):
    seen = read(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("external_id"))
    return crawl.outside(seen, read(spark, d, "part").where("p_size % 2 = 0").select(F.col("p_partkey").cast("string").alias("external_id")))


@query("SELECT p_name AS request_id, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS query, CAST(len(string_split(lower(p_name), ' ')) AS INTEGER) AS n FROM (SELECT DISTINCT p_name FROM part)")
def search_tokens(spark, d):
    asked = read(spark, d, "part").select(F.col("p_name").alias("request_id"), F.concat(F.lit("  "), F.upper("p_name")).alias("query")).distinct()
    return search.tokenised(asked).select("request_id", "query", F.size("tokens").alias("n"))


@query("SELECT product_id, (SELECT count(*) FROM listing l WHERE l.product_id = p.product_id AND retailer_id = 1) > 0 AS listed, (SELECT count(*) FROM product) AS total FROM product p ORDER BY popularity DESC, canonical_name, product_id LIMIT 20", True)
def popular_page(spark, d):
    c = catalog(spark, d)
    shop = retailers(spark, d).where("retailer_id = 1").first()["retailer"]
    page = admin.browse(c.product, c.product.select("product_id", F.lit("gtin").alias("identifier_type"), F.col("gtin").alias("identifier_value")), c.listing, limit=20)
    return page.select("product_id", F.array_contains("retailers", shop).alias("listed"), F.col("total_count").alias("total"))


@query("""SELECT event_id AS bump_id, best AS product_id FROM events JOIN goods ON product_id = event_id % (SELECT count(*) FROM part) JOIN (SELECT lower(canonical_name) AS n, arg_max(product_id, popularity * 100000000 + product_id) AS best FROM product GROUP BY 1) ON n = lower(canonical_name) WHERE event_type = 'purchase'""", True)
def bumps_by_name(spark, d):
    """Bumps that give no maker: the folded name alone decides."""
    c = catalog(spark, d)
    n = read(spark, d, "part").count()
    asked = read(spark, d, "events").where("event_type = 'purchase'").join(c.product.select("product_id", F.upper("canonical_name").alias("name")), F.col("event_id") % n == F.col("product_id"))
    bumps = asked.select(F.col("event_id").alias("bump_id"), "user_id", "ts", "name", F.lit(None).cast("string").alias("maker"))
    return popularity.resolved(bumps, c.product, c.listing).select("bump_id", "product_id")


#: Listings at last: those that are left of the last state.
_LEFT = ", li AS (SELECT * FROM listing WHERE NOT (retailer_id % 2 = 0 AND product_id % 11 = 0))"


def _in_three_batches(spark, d):
    """Products, counted names and counted shops kept up over three states of the listings.

    First come the listings of the first years, under old names and all in stock; then those seen up to the last years
    under their names; at last all of them, but for even shops without every eleventh product.
    """
    c = catalog(spark, d)
    years = F.year("first_seen_at")
    early = c.listing.where(years <= 1993).withColumns({"retailer_name": F.concat(F.lit("Old "), "retailer_name"), "available": F.lit(True)})
    even = F.substring("retailer", -1, 1).cast("int") % 2 == 0
    states = [early, c.listing.where(years <= 1996), c.listing.where(~(even & (F.col("product_id") % 11 == 0)))]
    goods = match.derived(c.product.select("product_id", "canonical_name", "brand", "quantity", "quantity_unit", "category", "add_count"), c.listing.where("false"))
    names, shops, before = _none(spark, "product_id long, name string, first_seen_at timestamp, n long"), _none(spark, "retailer string, available boolean, n long"), c.listing.where("false")
    for state in states:
        signed = written(deltas.changes(before, state))
        names, shops = written(deltas.merged(names, signed, deltas.NAMES)), written(deltas.merged(shops, signed, deltas.SHOPS))
        goods, before = written(deltas.refreshed(goods, names, signed)), state
    return goods, shops


@query(_LEFT + """, o AS (SELECT product_id, count(*) AS n, min(first_seen_at) AS first, string_agg(DISTINCT lower(retailer_name), ' ' ORDER BY lower(retailer_name)) AS names FROM li GROUP BY 1)
    SELECT product_id, coalesce(n, 0) AS listing_count, add_count + 5 * coalesce(n, 0) AS popularity, first IS NOT NULL AS seen, left(trim(name_folded || ' ' || brand_folded || ' ' || coalesce(names, '')), 1000) AS search_blob FROM product LEFT JOIN o USING (product_id)""", True)  # fmt: skip
def derived_by_deltas(spark, d):
    """What search reads of products after three batches of changes, held against a recount."""
    goods, _ = _in_three_batches(spark, d)
    return goods.select("product_id", "listing_count", "popularity", (F.col("listing_count") > 0).alias("seen"), "search_blob")


@query(_LEFT + " SELECT retailer, count(*) AS listings, count(*) FILTER (WHERE available) AS available FROM li GROUP BY 1", True)
def shops_by_deltas(spark, d):
    _, shops = _in_three_batches(spark, d)
    return deltas.shop_counts(shops)
