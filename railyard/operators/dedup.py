"""Set operations and keep-one-row-per-key operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks that the copies of one row are dealt to.
_DEALT = 8


def dedup_keep_latest(df: DataFrame, order_column: str = "ingested_at") -> DataFrame:
    """One row per identity, the newest.

    Identity is every column but ``order_column``, so the newest row is the group's
    maximum: an aggregate that combines copies before the shuffle, where a window
    would send every copy of a hot row to one task.  Nulls equal nulls, NaN equals NaN.

    Rows are dealt by their identity first: a task that reads compressed files may hold many
    millions of rows, and its half of the aggregate would keep all their identities in memory.
    Copies go to at most ``_DEALT`` tasks each, where they are combined.
    """
    if order_column not in df.columns:
        return df
    identity = [c for c in df.columns if c != order_column]
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(_DEALT)).alias("_turn")
    dealt = df.select("*", turn).repartition(*identity, "_turn")
    newest = dealt.groupBy(*identity).agg(F.max(order_column).alias(order_column))
    return newest.select(*df.columns)


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns."""
    return df.dropDuplicates()


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Distinct rows of all inputs."""
    return dedup_full_row(union_all(*dfs))
