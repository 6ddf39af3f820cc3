"""Named queries and, where it exists, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its oracle if SQL can state it."""

    def register(body: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return body(prepare(spark), sf_dir.rstrip("/"))

        run.__name__ = name
        run.__doc__ = body.__doc__
        if name in QUERIES:
            raise KeyError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return body

    return register
