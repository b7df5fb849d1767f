"""Profiles of stored tables, kept partition by partition.

A partition's facts are kept with a signature of its files. When the store has grown, only
partitions whose files have changed are read; the profile is united from the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators.profile import partition_facts, united_profile
from railyard.schemas import table
from railyard.session import path_exists
from railyard.sources.store_scan import stored_schema, table_path

_FACTS = (
    "partition string, column string, dtype string, rows bigint, non_null bigint, sketch binary, signature bigint"
)


def profiles_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/freight_profiles/{table(name).name}"


def _folder(name: str):
    """The partition folder of a row's or file's path."""
    return F.regexp_extract("_metadata.file_path", f"/freight/{name}/(.*)/[^/]+$", 1)


def partition_signatures(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(partition, signature) of every stored partition, from the file listing alone."""
    path = table_path(root, name)
    if not path_exists(spark, path):
        return spark.createDataFrame([], "partition string, signature bigint")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(_folder(name).alias("partition"), F.xxhash64("path", "length", "modificationTime").alias("file"))
    )
    return files.groupBy("partition").agg(F.bit_xor("file").alias("signature"))


def refresh_facts(spark: SparkSession, root: str, name: str) -> int:
    """Bring the kept facts up to date; returns how many partitions had to be read."""
    current = partition_signatures(spark, root, name)
    known = _kept(spark, root, name).select("partition", "signature").distinct()
    # No more than the calendar has days, times the feeds.
    changed = [r["partition"] for r in current.join(known, ["partition", "signature"], "left_anti").collect()]
    if not changed:
        return 0
    spec, path = table(name), table_path(root, name)
    rows = (
        spark.read.schema(stored_schema(spec))
        .option("basePath", path)
        .option("pathGlobFilter", "*.parquet")
        .parquet(*[f"{path}/{p}" for p in sorted(changed)])
    )
    facts = partition_facts(rows.select(*spec.columns, _folder(name).alias("_at")), F.col("_at"))
    facts = facts.where("column <> '_at'").join(current, "partition").select(*[c.split()[0] for c in _FACTS.split(", ")])
    facts.write.mode("append").parquet(profiles_path(root, name))
    return len(changed)


def _kept(spark: SparkSession, root: str, name: str) -> DataFrame:
    if not path_exists(spark, profiles_path(root, name)):
        return spark.createDataFrame([], _FACTS)
    return spark.read.schema(_FACTS).parquet(profiles_path(root, name))


def profile_stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The profile of a stored table; only partitions that changed since last time are read.

    Facts of partitions that are gone or have been replaced no longer count.
    """
    refresh_facts(spark, root, name)
    current = partition_signatures(spark, root, name)
    facts = _kept(spark, root, name).join(current, ["partition", "signature"], "left_semi")
    return united_profile(facts)
