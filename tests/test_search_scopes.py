"""Search over many requests at once: what they share is worked out once."""

from pyspark.sql import functions as F

from marketloom.operators import match, search

LISTING = "product_id string, retailer string, external_id string, retailer_name string, price decimal(12,2), currency string, available boolean, first_seen_at timestamp, last_seen_at timestamp"


def shop_data(spark, n=40):
    """n products of four names, each at two of the shops s0 to s3 (market M0 or M1; s3 is closed)."""
    goods = spark.range(n).select(F.col("id").cast("string").alias("product_id"), F.concat(F.lit("plum "), (F.col("id") % 4).cast("string")).alias("canonical_name"), F.lit("Orchard").alias("brand"), F.lit(None).cast("decimal(18,3)").alias("quantity"), F.lit(None).cast("string").alias("quantity_unit"), F.lit(None).cast("string").alias("category"), F.lit(0).cast("long").alias("add_count"))
    rows = [(str(k), f"s{s}", f"{k}-{s}", f"plum {k % 4}", 1, "EUR", s != 1) for k in range(n) for s in (k % 4, (k + 1) % 4)]
    listing = spark.createDataFrame([(*r[:4], None, *r[5:], None, None) for r in rows], LISTING).withColumn("price", F.lit(1).cast("decimal(12,2)"))
    shops = spark.createDataFrame([(f"s{k}", f"M{k % 2}", k != 3) for k in range(4)], "retailer string, market string, enabled boolean")
    return match.derived(goods, listing), listing, shops


def asked(spark, rows):
    return spark.createDataFrame(rows, "request_id string, query string, markets array<string>, retailers array<string>")


def test_a_scope_is_kept_once_however_many_requests_have_it(spark):
    names = [f"s{k}" for k in range(1000)]
    terms, scopes = search._scoped(search.tokenised(asked(spark, [(str(k), f"plum {k}", None, names) for k in range(30)] + [("x", "plum", None, None), ("y", "plum", [], None)])))
    assert scopes.count() == 3 and terms.count() == 32
    assert not {"markets", "retailers"} & set(terms.columns)


def test_scopes_do_not_mix(spark):
    goods, listing, shops = shop_data(spark)
    found = search.search(asked(spark, [("all", "plum", None, None), ("m0", "plum", ["M0"], None), ("s1", "plum", None, ["s1", "s9"]), ("none", "plum", [], None), ("closed", "plum", None, ["s3"])]), goods, listing, shops, limit=200)
    got = {}
    for r in found.collect():
        got.setdefault(r["request_id"], {})[int(r["product_id"])] = r["shops"]
    sold = {k: {s for s in (k % 4, (k + 1) % 4) if s != 3} for k in range(40)}
    shown = lambda keep: {k: sorted(f"s{s}" for s in keep(v)) for k, v in sold.items() if keep(v)}
    assert got["all"] == shown(lambda v: v)
    assert got["m0"] == shown(lambda v: {s for s in v if s % 2 == 0})
    assert got["s1"] == shown(lambda v: v if 1 in v else set())
    assert set(got) == {"all", "m0", "s1"}


def test_products_that_share_a_text_are_joined_by_shuffle(spark):
    goods, _, _ = shop_data(spark)
    terms = search.tokenised(asked(spark, [(str(k), "plun 1", None, None) for k in range(3)]))
    got = search.fuzzy_matches(terms, goods)
    assert got.count() == 3 * got.where("request_id = '0'").count() > 0
    assert "SortMergeJoin" in got._jdf.queryExecution().sparkPlan().toString()
    pairs = search.candidates(search.tokenised(asked(spark, [("a", "plum 1", None, None)])), goods)
    assert pairs.count() == 10 and "SortMergeJoin" in pairs._jdf.queryExecution().sparkPlan().toString()
