"""Queries with much work for each row of a small file."""

import pytest
from oracle import DATA

from marketloom import queries

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the test tables are not here")


@pytest.mark.parametrize("name", ["parse_quantity", "product_records"])
def test_rows_of_a_small_file_are_dealt_over_tasks(spark, name):
    assert queries.QUERIES[name](spark, str(DATA)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_keys_of_an_import_are_made_in_all_tasks(spark, monkeypatch):
    """Rows of one partition, as a file of a million rows may be read."""
    from pyspark.sql import functions as F

    from marketloom import schema
    from marketloom.operators import match

    dealt, plain = [], match._clean
    monkeypatch.setattr(match, "_clean", lambda rows: dealt.append(rows.rdd.getNumPartitions()) or plain(rows))
    text = lambda c: F.concat(F.lit(c), F.col("id").cast("string"))
    rows = spark.range(0, 40, 1, 1).select(F.col("id").alias("ordinal"), text("e").alias("external_id"), text("tea ").alias("name"), F.lit(None).cast("string").alias("brand"), F.lit(None).cast("string").alias("gtin"), F.lit(1).cast("decimal(12,2)").alias("price"), F.lit("EUR").alias("currency"), F.lit(None).cast("decimal(18,3)").alias("quantity"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("category"), F.lit("https://x").alias("product_url"), F.lit(True).alias("available"))
    none = lambda shape: spark.createDataFrame([], shape)
    done = match.resolve(rows, "s", none(schema.PRODUCT + ", merge_key string"), none(schema.IDENTIFIER), none(schema.LISTING))
    assert done.where("created").count() == 40
    assert dealt == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
