"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import discard, written


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, component), the smallest node reachable.

    Alternates large-star and small-star steps; the minimum of a node's neighbours is a grouped aggregate with a
    partial step, so that a node with very many links costs each task one row, and it is written before it is joined, so
    that the join on a hot node has plain exchanges on both sides, which Spark can split. Every round goes to the shared
    folder. Nodes without an edge don't appear; loops and repeated edges don't matter; no edges give no rows.
    """
    pair = lambda a, b: edges_from.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges_from = edges.where("a <> b")
    now = written(pair("a", "b").distinct())
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = written(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = written(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a")
        before, now = now, written(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct()
        )
        # Stars: no node that others hang on hangs on another one itself, and none hangs on two.
        many = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        hanging = now.select(F.col("b").alias("a")).distinct().join(now.select("a"), "a", "left_semi")
        discard(before, low, large, least)
        if many.select("a").unionByName(hanging.select("a")).isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
