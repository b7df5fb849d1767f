"""Scans of the store itself: tables, table names and run summaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from railyard.schemas import RUN_SCHEMA, TABLES, Table, table
from railyard.session import path_exists, work_dir
from railyard.sources.ranged import Opener, list_files, open_file


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/freight/{table(name).name}"


def stored_schema(spec: Table) -> StructType:
    """The table's columns plus its partition columns."""
    keys = [
        StructField(k, StringType() if k == "p_source" else IntegerType())
        for k in spec.partition_columns
    ]
    return StructType(spec.schema.fields + keys)


def scan_table(
    spark: SparkSession,
    root: str,
    name: str,
    with_partitions: bool = False,
    skip_corrupt: bool = True,
) -> DataFrame:
    """The Parquet files of a table, at any depth.

    Reports skip corrupt files; whoever rewrites what it reads must not, and sets
    ``skip_corrupt`` to False: a corrupt file then fails the job.
    Partition columns (``p_*``) stay in the plan for pruning and are dropped from
    the result unless asked for.  A table that was never written is empty.
    """
    spec = table(name)
    schema = stored_schema(spec)
    path = table_path(root, name)
    if not path_exists(spark, path):
        df = spark.createDataFrame([], schema)
    else:
        df = (
            spark.read.schema(schema)
            .option("pathGlobFilter", "*.parquet")
            .option("ignoreCorruptFiles", str(skip_corrupt).lower())
            .parquet(path)
        )
    return df if with_partitions else df.select(*spec.columns)


def probe_files(spark: SparkSession, path: str, opener: Opener = open_file) -> DataFrame:
    """(path, length, reason) of every Parquet file below ``path``; reason is null if it opens.

    Tasks read the files' footers, a few kilobytes each, and what they say of every column
    chunk: that it lies within the file. Row data isn't read. Files without a byte hold no
    rows and aren't listed.
    """

    def fault(file: str, length: int) -> str | None:
        with opener(file) as handle:
            try:
                footer = pq.read_metadata(handle)
                body = length - footer.serialized_size - 8
                handle.seek(0)
                if handle.read(4) not in (b"PAR1", b"PARE"):
                    return "no Parquet file from its first byte"
                for g in range(footer.num_row_groups):
                    for c in range(footer.num_columns):
                        chunk = footer.row_group(g).column(c)
                        first = min(x for x in (chunk.dictionary_page_offset, chunk.data_page_offset) if x)
                        if first + chunk.total_compressed_size > body:
                            return "a column reaches into the footer"
            except (pa.ArrowException, ValueError, EOFError) as exc:
                return str(exc).strip().splitlines()[0][:300]
            except OSError as exc:
                # A damaged footer comes as a plain OSError; a store that fails has an errno.
                if exc.errno:
                    raise
                return str(exc).strip().splitlines()[0][:300]
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            reasons = pa.array([fault(p, n) for p, n in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, reasons], ["path", "length", "reason"])

    files = list_files(spark, path, "*.parquet")
    spread = files.repartition(spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(run, "path string, length bigint, reason string")


def scan_with_ledger(
    spark: SparkSession, root: str, name: str, with_partitions: bool = False, opener: Opener = open_file
) -> tuple[DataFrame, DataFrame]:
    """(rows, ledger): a table without its unreadable files, and (table, path, reason) of each.

    Footers are probed first; the files that open are then read strictly, so damage that only
    the row data shows fails the report instead of thinning it out in silence.
    """
    path = table_path(root, name)
    empty = spark.createDataFrame([], "table string, path string, reason string")
    if not path_exists(spark, path):
        return scan_table(spark, root, name, with_partitions), empty
    stage = work_dir(spark, "ledger")
    bad = probe_files(spark, path, opener).where("reason IS NOT NULL")
    bad.select(F.lit(name).alias("table"), "path", "reason").write.parquet(stage)
    ledger = spark.read.parquet(stage)
    # Damaged files are few; their names prune the scan's file listing.
    names = [r["path"].rpartition("/")[2] for r in ledger.select("path").collect()]
    spec = table(name)
    reader = spark.read.schema(stored_schema(spec)).option("pathGlobFilter", "*.parquet")
    rows = reader.option("ignoreCorruptFiles", "false").parquet(path)
    if names:
        rows = rows.where(~F.col("_metadata.file_name").isin(names))
    columns = [*spec.columns, *spec.partition_columns] if with_partitions else spec.columns
    return rows.select(*columns), ledger


def unreadable_files(spark: SparkSession, root: str, opener: Opener = open_file) -> DataFrame:
    """(table, path, reason) of every stored file that a report would have to leave out.

    Tables' files by their footers, run summaries by whether they are run documents.
    """
    ledger = unreadable_summaries(spark, root)
    for name in TABLES:
        path = table_path(root, name)
        if path_exists(spark, path):
            bad = probe_files(spark, path, opener).where("reason IS NOT NULL")
            ledger = ledger.unionByName(bad.select(F.lit(name).alias("table"), "path", "reason"))
    return ledger


def stored_partitions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The partition columns of every partition that has files, from the listing alone."""
    spec = table(name)
    path = table_path(root, name)
    kinds = {k: "string" if k == "p_source" else "int" for k in spec.partition_columns}
    if not path_exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{k} {t}" for k, t in kinds.items()))
    found = [
        F.url_decode(F.regexp_extract("path", f"/{k}=([^/]+)/", 1)).cast(t).alias(k)
        for k, t in kinds.items()
    ]
    return list_files(spark, path, "*.parquet").select(*found).distinct()


def scan_files(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table kept in foreign ``year=/month=/day=`` folders.

    Folder names are ignored: the table's own year and month columns would
    otherwise be overwritten by them.
    """
    return (
        spark.read.schema(table(name).schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "true")
        .parquet(path)
    )


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Sorted distinct names of the tables that have files below ``root/freight``."""
    if not path_exists(spark, f"{root.rstrip('/')}/freight"):
        return spark.createDataFrame([], "table string")
    name = F.regexp_extract("path", r"/freight/([^/]+)/", 1)
    files = list_files(spark, f"{root.rstrip('/')}/freight", "*.parquet")
    return files.select(name.alias("table")).distinct().orderBy("table")


def _run_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every run document with its file, and ``_corrupt`` where it doesn't parse.

    ``pipeline_runs`` holds one document per file, ``pipeline_runs_bulk`` one per line.
    """
    schema = StructType(RUN_SCHEMA.fields + [StructField("_corrupt", StringType())])
    runs = spark.createDataFrame([], StructType(schema.fields + [StructField("_file", StringType())]))
    for folder, multiline in (("pipeline_runs", "true"), ("pipeline_runs_bulk", "false")):
        path = f"{root.rstrip('/')}/{folder}"
        if path_exists(spark, path):
            reader = spark.read.schema(schema).option("multiLine", multiline)
            reader = reader.option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json")
            reader = reader.option("columnNameOfCorruptRecord", "_corrupt")
            runs = runs.unionByName(reader.json(path).withColumn("_file", F.col("_metadata.file_path")))
    return runs


def scan_run_summaries(spark: SparkSession, root: str) -> DataFrame:
    """One row per run summary document; ``unreadable_summaries`` names those left out."""
    readable = F.col("_corrupt").isNull() & F.col("run_id").isNotNull()
    return _run_documents(spark, root).where(readable).drop("_corrupt", "_file")


def unreadable_summaries(spark: SparkSession, root: str) -> DataFrame:
    """(table, path, reason) of each file with documents that are no run summaries."""
    runs = _run_documents(spark, root)
    reason = F.when(F.col("_corrupt").isNotNull(), "not a JSON document").when(F.col("run_id").isNull(), "no run_id")
    found = runs.select(F.lit("pipeline_runs").alias("table"), F.col("_file").alias("path"), reason.alias("reason"))
    return found.where("reason IS NOT NULL").distinct()
