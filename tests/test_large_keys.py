"""Queries over keys and counts that are larger than those of the test tables."""

import duckdb
import pytest
from oracle import rows_of

from marketloom import queries


@pytest.fixture(scope="module")
def many_parts(tmp_path_factory):
    """Part 1,000,001 at shop 1 beside part 1 at shop 2, and 1,002 observations of one listing beside the part after it."""
    d = tmp_path_factory.mktemp("keys")
    seen = [(1, 1_000_001, 1, 10.0), (1, 1_000_001, 2, 11.0), (2, 1, 3, 20.0), (2, 1, 4, 21.0), (4, 8, 1, 5.0), (4, 8, 2, 6.0)] + [(4, 7, k, 30.0 + k % 2) for k in range(1002)]
    db = duckdb.connect()
    db.execute("CREATE TABLE lineitem (l_suppkey BIGINT, l_partkey BIGINT, l_orderkey BIGINT, l_extendedprice DOUBLE)")
    db.executemany("INSERT INTO lineitem VALUES (?, ?, ?, ?)", seen)
    db.execute(f"COPY (SELECT *, 1 AS l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 'R' ELSE 'N' END AS l_returnflag, TIMESTAMP '1995-01-01' AS l_shipdate FROM lineitem) TO '{d}/lineitem.parquet' (FORMAT parquet)")
    for name in ("supplier", "nation", "region", "part", "events"):
        db.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.001/{name}.parquet') TO '{d}/{name}.parquet' (FORMAT parquet)")
    return d


@pytest.mark.parametrize("name", ["price_changes", "upsert_listings"])
def test_ordinals_of_a_log_stay_apart(spark, many_parts, name):
    db = duckdb.connect()
    db.sql("SET TimeZone = 'UTC'")
    for f in many_parts.glob("*.parquet"):
        db.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    assert rows_of(queries.QUERIES[name](spark, str(many_parts)).toPandas()) == rows_of(db.sql(queries.ORACLES[name]).df())
