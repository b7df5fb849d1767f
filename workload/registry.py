"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLE_NAMES = "region nation customer supplier part orders lineitem events pages".split()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when SQL can express it, the SQL that must agree."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def typed(sql: str, kind: str, *columns: str) -> str:
    """The statement with some columns cast, so that types agree as well as values."""
    casts = ", ".join(f'CAST("{c}" AS {kind}) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def raw(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a raw-view statement over the tables in ``sf_dir``."""
    for name in TABLE_NAMES:
        if name in sql:
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql)
