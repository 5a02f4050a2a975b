"""Changes of listings against recounts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from marketloom.operators import deltas, match
from marketloom.session import written

LISTING = "retailer string, external_id string, product_id string, retailer_name string, first_seen_at timestamp, available boolean"
GOODS = [(f"p{k}", f"Name {k}", None if k % 2 else "Brand", None, None, None, k) for k in range(6)]


def listings(spark, rng, n):
    keys = rng.sample([(s, str(e)) for s in ("a", "b") for e in range(8)], n)
    rows = [(s, e, f"p{rng.randrange(5)}", rng.choice(["Milch", "MILCH", "Té", "x y"]), dt.datetime(2024, 1, rng.randrange(1, 5)), rng.choice([True, False])) for s, e in keys]
    return written(spark.createDataFrame(rows, LISTING))


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_batches_of_changes_are_the_recount(spark):
    rng = random.Random(3)
    plain = spark.createDataFrame(GOODS, "product_id string, canonical_name string, brand string, quantity decimal(18,3), quantity_unit string, category string, add_count long")
    none = spark.createDataFrame([], LISTING)
    names, shops = spark.createDataFrame([], "product_id string, name string, first_seen_at timestamp, n long"), spark.createDataFrame([], "retailer string, available boolean, n long")
    goods, before = written(match.derived(plain, none)), none
    for n in (10, 14, 3, 0):
        now = listings(spark, rng, n)
        signed = written(deltas.changes(before, now))
        names, shops = written(deltas.merged(names, signed, deltas.NAMES)), written(deltas.merged(shops, signed, deltas.SHOPS))
        goods, before = written(deltas.refreshed(goods, names, signed)), now
        whole = match.derived(plain, now)
        assert rows(goods, "product_id", "listing_count", "popularity", "search_blob") == rows(whole, "product_id", "listing_count", "popularity", "search_blob")
        seen = "product_id", "first_seen_at"
        assert rows(goods.where("listing_count > 0"), *seen) == rows(whole.where("listing_count > 0"), *seen)
        count = "count(1) as listings", "count_if(available) as available"
        assert rows(deltas.shop_counts(shops), "retailer", "listings", "available") == sorted(map(str, now.groupBy("retailer").agg(*[F.expr(c) for c in count]).collect()))
    assert names.isEmpty() and shops.isEmpty()


def test_no_change_touches_nothing(spark):
    some = listings(spark, random.Random(1), 6)
    assert deltas.changes(some, some.repartition(3)).isEmpty()


def test_untouched_products_are_passed_on(spark):
    rng = random.Random(2)
    signed = deltas.changes(listings(spark, rng, 3), listings(spark, rng, 3))
    plan = deltas.merged(spark.createDataFrame([], "product_id string, name string, first_seen_at timestamp, n long"), signed, deltas.NAMES)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan
