"""Staged evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df.select(*columns)`` whose results later filters and expressions only read.

    The columns pass through ``inline`` of a one-element array.  The optimiser does not
    move filters below it and does not paste the expressions into later ones, so an
    expensive parse runs once per row.  The price is that no column of the stage can
    be pruned.
    """
    staged = df.select(F.struct(*columns).alias("_row"))
    return staged.select(F.inline(F.array("_row")))


def evaluate_beside(df: DataFrame, *columns: Column, at_a_time: int = 4) -> DataFrame:
    """``df`` with more columns, each evaluated once per row.

    Like :func:`evaluate_once` for the new columns only: those of ``df`` can still be
    pruned, and filters on them still move to the scan.  Each ``at_a_time`` columns are an
    operator of their own, since the code of one operator is one method and the Java machine
    compiles none above 8,000 bytes.
    """
    for i in range(0, len(columns), at_a_time):
        df = df.select("*", F.inline(F.array(F.struct(*columns[i : i + at_a_time]))))
    return df
