"""Constraint checks and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from railyard.schemas import violations
from railyard.session import work_dir


def with_reasons(df: DataFrame, name: str) -> DataFrame:
    """Adds ``reject_reasons``: the constraints of the table that a row breaks."""
    reasons = [F.when(bad, F.lit(reason)) for reason, bad in violations(name)]
    kept = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.withColumn("reject_reasons", kept)


def quarantine(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons).

    Both leave one evaluation: a staged write, which they are read from.  It has no folder for
    each, as every task would have to sort its rows into them, on disk where they are many.
    """
    spark = df.sparkSession
    stage = work_dir(spark, f"checked-{name}")
    checked = with_reasons(df, name).withColumn("_rejected", F.size("reject_reasons") > 0)
    checked.write.option("compression", "zstd").parquet(stage)
    rows = spark.read.schema(checked.schema).parquet(stage)
    valid = rows.where("NOT _rejected").drop("_rejected", "reject_reasons")
    return valid, rows.where("_rejected").drop("_rejected")


def ingest_counters(
    df: DataFrame, name: str, dropped: Column | None = None
) -> tuple[DataFrame, Observation]:
    """The same rows plus counters that fill in on the pass that writes them."""
    seen = Observation(name)
    metrics = [F.count(F.lit(1)).alias("records")]
    if dropped is not None:
        metrics.append(F.count_if(dropped).alias("dropped"))
    return df.observe(seen, *metrics), seen
