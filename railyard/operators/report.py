"""Reporting aggregates and top-k.

Groups with a null key are left out and an all-null sum is zero, as in the reports
these replace.  Every aggregate combines map-side before its single shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _by(df: DataFrame, *keys: str):
    keep = F.lit(True)
    for key in keys:
        keep = keep & F.col(key).isNotNull()
    return df.where(keep).groupBy(*keys)


def run_totals(runs: DataFrame) -> DataFrame:
    """(runs, successful, failed, records) over all runs."""
    successful = F.count_if(F.coalesce("success", F.lit(False)))
    return runs.agg(
        F.count(F.lit(1)).alias("runs"),
        successful.alias("successful"),
        (F.count(F.lit(1)) - successful).alias("failed"),
        _total("total_records_written").alias("records"),
    )


def runs_per_day(runs: DataFrame) -> DataFrame:
    """Runs and records per start date."""
    dated = runs.withColumn("date", F.to_date("started_at"))
    return _by(dated, "date").agg(
        F.count("run_id").alias("runs"), _total("total_records_written").alias("records")
    )


def carloads_by_railroad(carloadings: DataFrame) -> DataFrame:
    return _by(carloadings, "railroad").agg(_total("carloads").alias("carloads"))


def top_commodities(carloadings: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` commodities with most carloads, ties by name."""
    totals = _by(carloadings, "commodity").agg(_total("carloads").alias("carloads"))
    return totals.orderBy(F.desc("carloads"), "commodity").limit(n)


def carloads_trend(carloadings: DataFrame) -> DataFrame:
    return _by(carloadings, "snapshot_date").agg(
        _total("carloads").alias("total_carloads"), F.count("carloads").alias("record_count")
    )


def avg_rate_by_route(rates: DataFrame) -> DataFrame:
    means = _by(rates, "route_code").agg(F.avg("rate_usd").alias("rate_usd"))
    return means.orderBy(F.desc("rate_usd"), "route_code")


def lane_stats(rates: DataFrame) -> DataFrame:
    return _by(rates, "trade_lane").agg(
        F.avg("rate_usd").alias("mean"),
        F.min("rate_usd").alias("min"),
        F.max("rate_usd").alias("max"),
    )


def rate_trend(rates: DataFrame) -> DataFrame:
    return _by(rates, "snapshot_date", "route_code").agg(F.avg("rate_usd").alias("rate_usd"))


def value_by_mode(transborder: DataFrame, view: str = "dot1") -> DataFrame:
    """Trade value per mode within one view; the views overlap and must not be added."""
    one_view = transborder.where(F.col("source_file") == view)
    return _by(one_view, "mode").agg(
        F.count(F.lit(1)).alias("rows"), _total("value_usd").alias("value_usd")
    )


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` latest runs, six columns."""
    return (
        runs.orderBy(F.desc("started_at"), F.desc("run_id"))
        .limit(n)
        .select(
            "run_id",
            "started_at",
            "success",
            "total_records_written",
            "sources_succeeded",
            "sources_failed",
        )
    )


def sample_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def sample_rows_per_file(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of each Parquet file of a file scan.

    Rows are picked by their position in the file, so nothing is shuffled or sorted.
    """
    columns = [F.col(c) for c in df.columns]
    picked = df.select(
        *columns,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    return picked.where(F.col("row_index") < n)


def drop_payload_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are not for display."""
    return df.drop("raw_record", "ingested_at")
