"""Holds a query's rows against those of its SQL, as sorted texts."""

from pathlib import Path

import duckdb

DATA = Path("/root/testdata/sf0.001")


def plain(value) -> str:
    if value is None or value != value:
        return "null"
    if isinstance(value, bool):
        return str(value)
    return f"{float(value):.6f}" if isinstance(value, (int, float)) else str(value)


def rows_of(frame) -> list[tuple]:
    columns = sorted(frame.columns)
    return sorted(tuple(map(plain, row)) for row in frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False))


def agree(spark, query, sql: str) -> None:
    db = duckdb.connect()
    db.sql("SET TimeZone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        db.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    ours, theirs = query(spark, str(DATA)).toPandas(), db.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)
