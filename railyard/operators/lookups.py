"""Dimension lookups as joins.

None of these hints a broadcast: the built-in dimensions are literal relations of at
most twelve rows, and for a caller's own dimension Spark compares its real size with
``spark.sql.autoBroadcastJoinThreshold`` and shuffles when it is larger.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import COUNTRY_CODES, INDEX_SERIES, MODE_LABELS, OCEAN_ROUTES
from railyard.functions import strip


def _literal(spark: SparkSession, rows: list[tuple], *columns: str) -> DataFrame:
    """A relation whose rows stand in the plan.

    Rows that Spark gets as an Arrow table have a known size; those of a list are an RDD of
    unknown size, for which a join would shuffle and sort the other side.
    """
    schema = pa.schema([(c, pa.string()) for c in columns])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(columns, r, strict=True)) for r in rows], schema))


def mode_dimension(spark: SparkSession) -> DataFrame:
    return _literal(spark, list(MODE_LABELS.items()), "code", "mode")


def country_dimension(spark: SparkSession) -> DataFrame:
    return _literal(spark, list(COUNTRY_CODES.items()), "code", "country")


def route_dimension(spark: SparkSession) -> DataFrame:
    return _literal(spark, OCEAN_ROUTES, "route_code", "description", "origin", "destination")


def series_dimension(spark: SparkSession) -> DataFrame:
    return _literal(spark, INDEX_SERIES, "series_id", "title", "source", "units")


def lookup_mode(df: DataFrame, modes: DataFrame, code: str = "DISAGMOT") -> DataFrame:
    """Adds ``mode``: the label of the code, "unknown" when there is none."""
    dim = modes.select(F.col("code").alias("_code"), F.col("mode").alias("_mode"))
    on = strip(F.col(code)) == F.col("_code")
    named = df.join(dim, on, "left").withColumn("mode", F.coalesce("_mode", F.lit("unknown")))
    return named.drop("_code", "_mode")


def lookup_country(df: DataFrame, countries: DataFrame, code: str = "COUNTRY") -> DataFrame:
    """Adds ``country``: the mapped code, else the trimmed code itself."""
    dim = countries.select(F.col("code").alias("_code"), F.col("country").alias("_country"))
    on = strip(F.col(code)) == F.col("_code")
    named = df.join(dim, on, "left").withColumn(
        "country", F.coalesce("_country", strip(F.col(code)))
    )
    return named.drop("_code", "_country")


def lookup_geo_label(df: DataFrame, labels: DataFrame, code: str = "country_code") -> DataFrame:
    """Adds ``country_name`` from (code, label); null when the code has no label."""
    dim = labels.select(F.col("code").alias("_code"), F.col("label").alias("country_name"))
    return df.join(dim, F.col(code) == F.col("_code"), "left").drop("_code")


def enrich_routes(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Adds route code and description to rows of a known (origin, destination)."""
    dim = routes.select("route_code", "description", "origin", "destination")
    return df.join(dim, ["origin", "destination"])


def enrich_series(df: DataFrame, series: DataFrame) -> DataFrame:
    """Adds title, units and source of a series; the title defaults to its id."""
    dim = series.select("series_id", "title", "units", "source")
    joined = df.join(dim, "series_id", "left")
    return joined.withColumn("title", F.coalesce("title", "series_id"))
