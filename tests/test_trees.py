"""Category trees of many nodes."""

from pyspark.sql import functions as F

from marketloom.operators import crawl


def test_a_wide_tree_takes_as_many_steps_as_it_has_levels(spark, monkeypatch):
    """2,000 nodes of one child each, three levels and the empty one below: four tables, whatever the number of brackets."""
    made, plain = [], crawl.written
    monkeypatch.setattr(crawl, "written", lambda df: made.append(plain(df)) or made[-1])
    body = "[" + ",".join('{"id":%d,"name":"[[","children":[{"id":7,"children":[{"id":1},{"id":null,"children":[{"id":9}]},{"id":"x"}]}]}' % k for k in range(2000)) + ',{"id":"x","children":[{"id":5}]}]'
    got = {r["path"] for r in crawl.tree_paths(spark.createDataFrame([(body,), ("no json",), ("{}",), ("[]",)], "body string")).collect()}
    assert got == {f"/{k}/{rest}" for k in range(2000) for rest in ("", "7/", "7/1/")}
    assert len(made) == 4
