"""Sources and extraction from small captured pages, and the streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketloom import schema
from marketloom.functions import jsonld, products
from marketloom.operators import crawl, popularity
from marketloom.sources import captures
from marketloom.streaming import catalog as streams


def test_sitemaps(spark):
    index = spark.createDataFrame([("<sitemapindex><sitemap><loc> https://a/1.xml </loc></sitemap><sitemap><loc>https://a/1.xml</loc></sitemap></sitemapindex>",), ("<urlset><url><loc>https://a/p</loc></url></urlset>",)], "body string")
    assert [r["loc"] for r in captures.sitemap_index(index).collect()] == ["https://a/1.xml"]
    body = '<urlset><url><loc>https://a?x=1&amp;lt;y</loc><lastmod>2024-02-03</lastmod></url><url><loc></loc><xhtml:link rel="alternate" href="https://b"/></url><url><loc>https://c</loc><lastmod>soon</lastmod></url><url></url><url><loc>https://broken'
    got = {r["loc"]: r["lastmod"] for r in captures.urlset(spark.createDataFrame([(body,)], "body string")).collect()}
    assert got == {"https://a?x=1&lt;y": dt.datetime(2024, 2, 3), "https://b": None, "https://c": None}
    coded = "<url><loc>https://d/caf&#233;&#38;lt;&#128512;&#9999999;&#55296;</loc></url>"
    assert captures.urlset(spark.createDataFrame([(coded,)], "body string")).first()["loc"] == "https://d/café&lt;😀&#9999999;&#55296;"


def test_outcomes(spark):
    pages = spark.createDataFrame([(200, True), (404, True), (500, True), (200, False)], "status int, found boolean")
    assert [r["outcome"] for r in captures.outcomes(pages, F.col("found")).collect()] == ["parsed", "delisted", "failed", "noProduct"]


def test_jsonld(spark):
    node = {"@type": ["Thing", "Product"], "name": " Tea ", "productID": 7, "gtin": ["4006381333931"], "brand": [{"name": "A"}], "offers": [{"availability": {"@id": "InStock"}}, {"priceSpecification": [{"price": "1.299,50", "priceCurrency": "EUR"}]}]}
    pages = spark.createDataFrame(
        [
            (1, f'<script type="application/ld+json">{{bad</script><script type="application/ld+json">{json.dumps([{"@graph": [node]}])}</script>'),
            (2, '<script type="application/ld+json" children="{&quot;@type&quot;:&quot;Product&quot;,&quot;name&quot;:&quot;A &amp;amp; B&quot;,&quot;offers&quot;:{&quot;price&quot;:2,&quot;availability&quot;:&quot;OutOfStock&quot;}}"></script>'),
            (3, "<p>nothing</p>"),
        ],
        "id int, html string",
    )
    got = {r["id"]: r for r in jsonld.products(pages, "id").collect()}
    assert set(got) == {1, 2}
    assert (got[1]["name"], got[1]["sku"], got[1]["gtin"], got[1]["brand"], got[1]["price"], got[1]["currency"]) == ("Tea", "7", "4006381333931", "A", 1299.5, "EUR")
    assert (got[2]["name"], got[2]["price"], got[2]["availability"]) == ("A &amp; B", 2.0, "OutOfStock")


@pytest.mark.parametrize(
    ("offers", "price"),
    [
        ({"price": 12.345}, 12.345), ({"price": 1e7}, 1e7), ({"price": "1.299"}, 1299.0), ([{"price": ""}, {"price": "5"}], 5.0), ([{"price": "ask"}, {"priceSpecification": [{"price": "?"}, {"price": "7,5"}]}], 7.5),
        ([{"priceSpecification": {"price": ""}}, {"price": 0}], 0.0), ([{"url": "u"}], None), ({"priceSpecification": {"price": 3}}, 3.0),
    ],
)
def test_prices_of_offers(spark, offers, price):
    node = {"@type": "Product", "name": "x", "image": ["i.png", "j.png"], "description": " d ", "offers": offers}
    deep = node
    for _ in range(6):
        deep = {"@graph": [[deep]]}
    pages = spark.createDataFrame([(1, f'<script type="application/ld+json">{json.dumps(deep)}</script>')], "id int, html string")
    got = jsonld.products(pages, "id").first()
    assert (got["price"], got["image"], got["description"]) == (price, "i.png", "d")


def test_shop_payloads(spark):
    leaflet = {"cycles": [{"categories": [{"displayName": "Milch", "offers": [{"klNr": "1", "title": "Zuzu", "subtitle": "Lapte", "detailTitle": "x", "detailDescription": "ZUZU\nmore"}, {"klNr": "2", "title": "A/B"}]}]}]}
    offers = captures.leaflet_offers(spark.createDataFrame([('a "offerData":' + json.dumps(leaflet) + ",b",)], "body string"))
    again = captures.first_shelf(offers.unionByName(offers.withColumns({"shelf": F.lit("Blumen"), "place": F.array(F.lit(9), F.lit(0), F.lit(0))}).where("external_id = '2'")), "(?i)blumen")
    assert [(r["external_id"], r["shelf"]) for r in again.collect()] == [("1", "Milch")]
    named = products.leaflet_names(captures.first_shelf(offers)).collect()
    assert [(r["external_id"], r["name"], r["brand"]) for r in named] == [("1", "Lapte", "Zuzu")]


def page_of(data):
    state = json.dumps({"props": {"pageProps": {"apiData": json.dumps(data)}}})
    return f'<script id="__NEXT_DATA__" type="x">{state}</script>'


def test_page_state(spark):
    full = {"objectID": " p1 ", "name": "Brot", "mainCategoryID": "own", "isAvailable": True, "currentPrice": {"priceValue": 1.5}}
    levels = {"parentCategory": {"data": {"parent": {"categoryKey": "pantry"}, "current": {"categoryKey": "bread"}}}}
    teaser = {"objectID": "t1", "name": "teaser"}
    pages = {
        "all": [teaser, levels, {"deep": [full]}], "bare": [full | {"isAvailable": "true", "currentPrice": {"priceValue": 0}, "objectID": 7}],
        "text price": [{"name": "x", "mainCategoryID": "own", "currentPrice": {"priceValue": "2"}}], "teaser alone": [teaser],
    }
    rows = [(k, page_of(v)) for k, v in pages.items()] + [("none", "redesigned"), ("broken", '<script id="__NEXT_DATA__">{</script>'), ("null", None)]
    got = captures.page_state_products(spark.createDataFrame(rows, "url string, body string"), "url")
    assert {r["url"]: tuple(r)[1:] for r in got.collect()} == {
        "all": ("p1", "Brot", None, None, 1.5, True, "pantry", "bread"), "bare": (None, "Brot", None, None, None, False, "own", None), "text price": (None, "x", None, None, None, False, "own", None),
    }


def test_department_payload_as_shops_write_it(spark):
    bodies = {
        "full": 'var impressionData = {"ecommerce":{"impressions":[{"id":"7","price":2.5},{"id":"8","price":"x"}]}}; push({});', "empty": 'var impressionData={"ecommerce":{"impressions":[]}}',
        "top": 'var impressionData = {"impressions":[{"id":"7"}]};', "cut": 'var impressionData = {"ecommerce":{"impressions":[{"id":"7"}', "object": 'var impressionData = {"ecommerce":{"impressions":{}}}', "late": "<p/>",
    }
    got = captures.department_pages(spark.createDataFrame([*bodies.items(), ("null", None)], "k string, body string")).collect()
    assert {r["k"]: (r["unreadable"], [(p["id"], p["price"]) for p in r["products"]]) for r in got} == {
        "full": (False, [("7", 2.5), ("8", None)]), "empty": (False, []), "top": (True, []), "cut": (True, []), "object": (True, []), "late": (True, []), "null": (True, []),
    }


def test_a_size_without_multiplier_is_read_from_the_name(spark):
    item = lambda **more: {"ean": "x", "measurementUnit": "kg", "sellers": [], **more}
    made = lambda i, name, **more: {"productId": i, "productName": name, "productReference": "4006381333931", "items": [item(**more)]}
    body = json.dumps([made("1", "Banane 500 g"), made("2", "Banane 500 g", unitMultiplier=2), made("3", "Banane", unitMultiplier=0), made("4", " "), made(" ", "x")])
    got = products.with_size(captures.catalog_api(spark.createDataFrame([(body,)], "body string")), "measured").collect()
    assert {r["external_id"]: (r["quantity"] and float(r["quantity"]), r["unit"], r["gtin"]) for r in got} == {"1": (500, "g", "4006381333931"), "2": (2, "kg", "4006381333931"), "3": (None, None, "4006381333931")}


def test_robots_groups_end_at_other_fields(spark):
    files = {
        "a": "User-agent: loom\nCrawl-delay: 5\nUser-agent: other\nDisallow: /", "b": "User-agent: loom\nSitemap: x\nno field\nUser-agent: other\nDisallow: /",
        "c": "user-agent: LOOM # us\r\n\r\nUser-agent: z\r\nDisallow:\r\nDisallow: /x", "d": "Disallow: /\nUser-agent: *\nHost: d\nDisallow: /y",
    }
    rules = crawl.robots_rules(spark.createDataFrame([*files.items()], "host string, body string"), ["loom"])
    assert sorted((r["host"], r["allow"], r["path"]) for r in rules.collect()) == [("b", False, "/"), ("c", False, "/x"), ("d", False, "/y")]


def test_catalog_api(spark):
    seller = lambda i, d, price: {"sellerId": i, "sellerDefault": d, "commertialOffer": {"Price": price, "AvailableQuantity": 3}}
    product = {"productId": "7", "productName": "LAPTE 1 L", "brand": "ZUZU", "link": "https://x/7", "categoriesIds": ["/1/", "/1/2/"], "items": [{"ean": "4006381333931", "measurementUnit": "kg", "unitMultiplier": 0.5, "sellers": [seller("1", False, 3.0), seller("2", True, 4.0)]}]}
    got = captures.catalog_api(spark.createDataFrame([(json.dumps([product, product]),)], "body string"))
    r = products.with_size(got, "measured").first()
    assert got.count() == 1 and (r["name"], r["brand"], r["price"], r["available"], float(r["quantity"]), r["unit"]) == ("Lapte 1 l", "Zuzu", 4.0, True, 0.5, "kg")
    assert crawl.category_paths(got).count() == 2
    assert spark.createDataFrame([("0-49/2500",)], "h string").select(captures.api_total(F.col("h"))).first()[0] == 2500


def test_ndjson_and_seed(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"retailer":"s","external_id":"1","name":"x"}\n\n{broken\n{"retailer":"s","external_id":"2"}\n')
    good, bad = captures.ndjson(spark, str(tmp_path / "a.json"), "s")
    assert good.count() == 2 and bad.count() == 1
    with pytest.raises(ValueError, match="another retailer"):
        captures.ndjson(spark, str(tmp_path / "a.json"), "t")
    captures.write_ndjson(good, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    shape = "slug string, name string, country string, domain string, enabled boolean"
    old, seed = spark.createDataFrame([("a", "A", "RO", "a.ro", False)], shape), spark.createDataFrame([("a", "A2", "RO", "a.com", True), ("b", "B", "DE", "b.de", True)], shape)
    assert {r["slug"]: (r["name"], r["enabled"]) for r in captures.upsert_retailers(old, seed).collect()} == {"a": ("A2", False), "b": ("B", True)}


def test_seen_since_refuses_few(spark):
    listing = spark.createDataFrame([("s", "1", dt.datetime(2024, 1, 2))], "retailer string, external_id string, last_seen_at timestamp")
    assert captures.seen_since(listing, "s", "2024-01-01", 1).count() == 1
    with pytest.raises(ValueError, match="at least"):
        captures.seen_since(listing, "s", "2024-01-01")


def test_run_log(spark):
    runs = spark.createDataFrame([("r",)], "run_id string")
    lines = json.dumps([{"t": "2024-01-01T00:00:00Z", "level": "fatal", "message": "m" * 3000}, {"level": "warn", "scope": "s" * 200}])
    got = captures.run_log_lines(spark.createDataFrame([("r", lines), ("unknown", lines)], "run_id string, lines string"), runs, "2024-02-02").collect()
    assert [(r["level"], len(r["scope"]), len(r["message"])) for r in got] == [("info", 0, 2000), ("warn", 100, 0)]


def test_streams_equal_their_batch_twins(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "ck"
    rows = [(i, i % 3, dt.datetime(2024, 1, 1, i % 2, i)) for i in range(24)]
    bumps = spark.createDataFrame(rows, "bump_id long, user_id long, ts timestamp")
    bumps.repartition(1).write.parquet(str(source))
    stream = spark.readStream.schema(bumps.schema).parquet(str(source))
    for name, made in (("limited", streams.limited_stream(stream, 2)), ("alive", streams.liveness(stream.withColumn("run_id", F.col("user_id").cast("string"))))):
        q = made.writeStream.format("memory").queryName(name).outputMode("append" if name == "limited" else "update").option("checkpointLocation", str(out / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert {r["bump_id"] for r in spark.table("limited").collect()} == {r["bump_id"] for r in popularity.limited(bumps, 2).collect()}
    assert spark.table("alive").agg(F.sum("pages_read")).first()[0] == 24


def test_import_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps({"retailer": "s", "external_id": str(i), "name": f"tea {i}", "product_url": "https://x", "price": 1.0}) for i in range(3)))
    state = [spark.createDataFrame([], schema.PRODUCT + ", merge_key string"), spark.createDataFrame([], schema.IDENTIFIER), spark.createDataFrame([], schema.LISTING)]

    def store(done, _):
        state[:] = [streams.match.written(x) for x in (done.product, done.identifier, done.listing)]

    records = streams.captures(spark, str(tmp_path / "in"))
    streams.import_stream(records, "s", "2024-01-01", lambda: state, store, str(tmp_path / "ck")).awaitTermination(180)
    assert state[0].count() == 3 and state[2].count() == 3
