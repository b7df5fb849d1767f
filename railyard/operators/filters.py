"""Filters and predicates."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.functions import parse_fra_date, parse_iso_date


def filter_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is selected; an empty selection does not filter."""
    return df.where(F.col(column).isin(list(values))) if values else df


def filter_date_range(
    df: DataFrame, column: str, low: date | None, high: date | None
) -> DataFrame:
    """Rows within both ends, inclusive; filters only when both ends are given.

    When the frame still has its partition columns the same range is put on them, so
    whole folders are skipped before any file is opened.
    """
    if low is None or high is None:
        return df
    keep = F.col(column).between(F.lit(low), F.lit(high))
    if "p_year" in df.columns:
        keep = keep & F.col("p_year").between(low.year, high.year)
    if "p_month" in df.columns:
        month = F.col("p_year") * 100 + F.col("p_month")
        keep = keep & month.between(low.year * 100 + low.month, high.year * 100 + high.month)
    return df.where(keep)


def filter_snapshot(raw: DataFrame, day: date | Column | None, column: str = "date") -> DataFrame:
    """Feed rows of exactly one reporting date; no date, no filter."""
    if day is None:
        return raw
    wanted = day if isinstance(day, Column) else F.lit(day)
    return raw.where(parse_iso_date(F.col(column)) == wanted)


def filter_incident_date(raw: DataFrame, day: date | Column) -> DataFrame:
    """Incidents of one day, also those that only have year, month and day parts."""
    wanted = day if isinstance(day, Column) else F.lit(day)
    parts = [
        F.col(c) if c in raw.columns else F.lit(None).cast("string")
        for c in ("date", "year", "month", "accidentmonth", "day")
    ]
    return raw.where(parse_fra_date(*parts) == wanted)


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows in which every required column is present."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


def filter_table_name(files: DataFrame, text: str | None) -> DataFrame:
    """Files whose path holds the text; no text, no filter."""
    return files.where(F.contains("path", F.lit(text))) if text else files


def filter_option_defaults(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows of the first ``n`` options, in sorted order, of a column.

    The options are at most ``n`` rows (three or five), hence the broadcast.
    """
    options = df.select(column).where(F.col(column).isNotNull()).distinct()
    chosen = options.orderBy(column).limit(n)
    return df.join(F.broadcast(chosen), column, "left_semi")
