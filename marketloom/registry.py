"""Where queries are registered, each with the SQL that it is held against."""

from __future__ import annotations

from marketloom.plans.catalog import SQL

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, catalog_tables: bool = False):
    """Registers a query; with catalog_tables the catalog's tables stand before the SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {SQL}{sql}" if catalog_tables else sql
        return f

    return add
