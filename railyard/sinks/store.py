"""The partitioned store.

Partition folders are ``p_year[/p_month/p_day]`` (with ``p_source`` in front where two
feeds share a table), written as plain integers.  The prefix keeps them apart from
tables that have ``year`` and ``month`` columns of their own.

Rows are laid out with a rebalance hint, not a plain ``repartition``: a day that holds
a third of all rows is split into files of advisory size, and thin days share a task.
"""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from railyard.functions import partition_keys
from railyard.operators.dedup import dedup_keep_latest
from railyard.schemas import RUN_SCHEMA, TABLES, Table, table
from railyard.session import (
    leaf_folders,
    path_exists,
    read_note,
    remove_dir,
    replace_folder,
    same_store,
    work_dir,
    write_note,
)
from railyard.sources.store_scan import scan_table, stored_partitions, stored_schema, table_path


def _keyed(df: DataFrame, spec: Table, run_date: date | None) -> DataFrame:
    """The table's columns plus its partition columns."""
    day: Column = F.col(spec.date_column)
    run = F.lit(run_date) if run_date else None
    keys = partition_keys(day, run, spec.grain)
    if spec.by_source:
        keys = [F.col("source").alias("p_source"), *keys]
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    return df.select(*typed, *keys)


def _write(
    df: DataFrame, spec: Table, path: str, fmt: str = "parquet", laid_out: bool = False
) -> int:
    """Replace exactly the partitions that ``df`` has rows for; returns the row count.

    Rows are counted in the writing stage, whose tasks count once even when a lost
    executor makes earlier stages run again.  ``laid_out`` rows are written where they are.
    """
    keys = spec.partition_columns
    seen = Observation(f"write {spec.name}")
    if not laid_out:
        df = df.hint("rebalance", *[F.col(k) for k in keys])
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
    )
    if fmt == "csv":
        # Several times smaller than the text; readers know the packing by the file name.
        writer.option("header", "true").option("compression", "gzip").csv(path)
    else:
        writer.option("compression", "zstd").parquet(path)
    return int(seen.get["rows"])


def write_day_partitions(
    df: DataFrame, root: str, name: str, run_date: date | None = None
) -> int:
    """Replace each day that ``df`` touches; other days stay.  Returns the row count.

    A row is filed under its own date, whatever the run's date is.  No row, no file.
    """
    spec = table(name)
    return _write(_keyed(df, spec, run_date), spec, table_path(root, name))


def merge_partitions(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    run_date: date | None = None,
    dedup_first_write: bool = False,
    laid_out: bool = False,
) -> int:
    """Merge ``df`` into the partitions it touches; returns the number of new rows.

    A partition that exists becomes existing plus new rows, the newest of each
    identity.  One written for the first time keeps copies within the batch unless
    ``dedup_first_write`` is set.  With ``laid_out`` the rows of a partition already lie in
    few tasks, and the batch is written without another shuffle.

    The merge is staged in the work folder (``stage_merge``) and then published by moving
    whole partition folders (``publish_merge``): if that is interrupted, what isn't moved yet
    is still there and the step can be repeated.
    """
    stage = work_dir(spark, f"merge-{name}")
    new_rows = stage_merge(spark, df, root, name, stage, run_date, dedup_first_write, laid_out)
    publish_merge(spark, root, name, stage)
    remove_dir(spark, stage)
    return new_rows


#: In a partition folder: no identity stands in it twice.
_MERGED = "_merged"


def stage_merge(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    stage: str,
    run_date: date | None = None,
    dedup_first_write: bool = False,
    laid_out: bool = False,
) -> int:
    """Write to ``stage`` the complete partitions that a merge will publish; returns new rows.

    The batch is written first, so the input is evaluated once.  Of a stored partition that
    an earlier merge has left without copies, only the rows whose digest may be in the batch,
    by a filter of fixed size, are shuffled by their identity; the others are copied in
    the tasks that read them.  Stored files are read strictly: a corrupt one fails the merge
    and nothing is replaced.

    A note in ``stage`` says that it is complete.  With such a note nothing is computed again.
    """
    done = read_note(spark, f"{stage}/{_STAGED}")
    if done is not None:
        return int(done.split()[0])
    remove_dir(spark, stage)
    spec = table(name)
    new_rows = _write(_keyed(df, spec, run_date), spec, f"{stage}/batch", laid_out=laid_out)
    publish = "nothing"
    if new_rows:
        batch = spark.read.schema(stored_schema(spec)).parquet(f"{stage}/batch")
        touched = _partition_names(batch, spec)
        shared = touched & _partition_names(stored_partitions(spark, root, name), spec)
        dirty = touched if dedup_first_write else shared
        publish = "merged" if dirty else "batch"
        if dirty:
            _write_merged(spark, batch, root, spec, f"{stage}/merged", touched, shared, dirty)
    write_note(spark, f"{stage}/{_STAGED}", f"{new_rows} {publish}")
    return new_rows


_STAGED = "_staged"


def publish_merge(spark: SparkSession, root: str, name: str, stage: str) -> None:
    """Put the staged partitions in place of those they are made from.

    May be called again until it succeeds, and after that does nothing more.
    """
    spec = table(name)
    target = table_path(root, name)
    publish = read_note(spark, f"{stage}/{_STAGED}").split()[1]
    if publish == "nothing":
        return
    source = f"{stage}/{publish}"
    depth = len(spec.partition_columns)
    if not same_store(spark, source, target):
        # A folder can't be moved to another store: the rows are written once more.
        folders = leaf_folders(spark, source, depth)
        _write(spark.read.schema(stored_schema(spec)).parquet(source), spec, target)
        marked = [f for f in folders if path_exists(spark, f"{source}/{f}/{_MERGED}")]
        for folder in marked:
            write_note(spark, f"{target}/{folder}/{_MERGED}", "")
        return
    for folder in leaf_folders(spark, source, depth):
        replace_folder(spark, f"{source}/{folder}", f"{target}/{folder}")


#: Bits of the filter of a batch's digests.
_FILTER_BITS = 1 << 24


def _digest(spec: Table) -> Column:
    """A 64-bit digest of a row's identity; zeros of either sign are one value."""
    parts = []
    for f in spec.schema.fields:
        if f.name != "ingested_at":
            c = F.col(f.name)
            parts.append(F.when(c == 0, F.lit(0.0)).otherwise(c) if f.dataType.typeName() == "double" else c)
    return F.xxhash64(*parts)


def _write_merged(
    spark: SparkSession, batch: DataFrame, root: str, spec: Table, path: str, touched: set[str], shared: set[str], dirty: set[str]
) -> None:
    """The complete partitions ``touched`` by a batch; those in ``dirty`` without copies."""
    partition = _partition_name(spec)
    target = table_path(root, spec.name)
    folders = {f: "/".join(unquote(p.partition("=")[2]) for p in f.split("/")) for f in leaf_folders(spark, target, len(spec.partition_columns))} if shared else {}
    clean = {n for f, n in folders.items() if n in shared and path_exists(spark, f"{target}/{f}/{_MERGED}")}
    stored = scan_table(spark, root, spec.name, with_partitions=True, skip_corrupt=False)
    fresh = batch.where(partition.isin(sorted(dirty)))
    old = stored.where(partition.isin(sorted(shared - clean)))
    kept = None
    if clean:
        # No more rows than the filter has 64-bit words, however large the batch is.
        bit = F.pmod(_digest(spec), F.lit(_FILTER_BITS))
        words = (
            fresh.select(bit.alias("_bit"))
            .groupBy(F.shiftright("_bit", 6).alias("_word"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(_bit % 64 AS INT)))").alias("_mask"))
        )
        known = stored.where(partition.isin(sorted(clean))).withColumn("_bit", bit)
        hit = F.expr("shiftright(_bit, 6) = _word AND (shiftrightunsigned(_mask, CAST(_bit % 64 AS INT)) & 1L) = 1")
        old = old.unionByName(known.join(F.broadcast(words), hit, "left_semi").drop("_bit"))
        kept = known.join(F.broadcast(words), hit, "left_anti").drop("_bit")
    merged = dedup_keep_latest(fresh.unionByName(old))
    if touched - dirty:
        merged = merged.unionByName(batch.where(~partition.isin(sorted(dirty))))
    _write(merged, spec, path)
    if kept is not None:
        # Not laid out anew: each task writes on what it reads.
        kept.write.mode("append").option("compression", "zstd").partitionBy(*spec.partition_columns).parquet(path)
    for folder in leaf_folders(spark, path, len(spec.partition_columns)):
        if "/".join(unquote(p.partition("=")[2]) for p in folder.split("/")) in dirty:
            write_note(spark, f"{path}/{folder}/{_MERGED}", "")


def merge_year_partitions(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    run_date: date | None = None,
    dedup_first_write: bool = False,
    laid_out: bool = False,
) -> int:
    """:func:`merge_partitions` for a table kept by year."""
    if table(name).grain != "year":
        raise ValueError(f"{name} is not kept by year")
    return merge_partitions(spark, df, root, name, run_date, dedup_first_write, laid_out)


def _partition_name(spec: Table) -> Column:
    """The partition as one text; Spark prunes folders by it like by plain keys."""
    return F.concat_ws("/", *[F.col(k).cast("string") for k in spec.partition_columns])


def _partition_names(df: DataFrame, spec: Table) -> set[str]:
    """Distinct partitions; no more than the calendar has days, times the feeds."""
    rows = df.select(_partition_name(spec).alias("name")).distinct().collect()
    return {r["name"] for r in rows}


def write_table(
    spark: SparkSession, df: DataFrame, root: str, name: str, run_date: date | None = None
) -> int:
    """Write by the table's own grain: replace days or merge years."""
    if table(name).grain == "year":
        return merge_year_partitions(spark, df, root, name, run_date)
    return write_day_partitions(df, root, name, run_date)


def csv_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/freight_csv/{table(name).name}"


def write_csv_copy(df: DataFrame, root: str, name: str, run_date: date | None = None) -> bool:
    """The same rows as CSV files packed by gzip, under a root of its own; False where a table has none."""
    spec = table(name)
    if not spec.csv_copy:
        return False
    _write(_keyed(df, spec, run_date), spec, csv_path(root, name), "csv")
    return True


def write_run_summary(spark: SparkSession, summary: dict, root: str) -> None:
    """Append one JSON document for a run."""
    row = spark.createDataFrame([tuple(summary.get(n) for n in RUN_SCHEMA.names)], RUN_SCHEMA)
    row.write.mode("append").option("ignoreNullFields", "false").json(
        f"{root.rstrip('/')}/pipeline_runs"
    )


def append_run_summaries(runs: DataFrame, root: str) -> None:
    """Append many run documents at once, one JSON object per line."""
    runs.write.mode("append").option("ignoreNullFields", "false").json(
        f"{root.rstrip('/')}/pipeline_runs_bulk"
    )


def route_records(df: DataFrame, type_column: str = "record_type") -> dict[str, DataFrame]:
    """One frame per known table, by record type; unknown types are left out.

    The rows are written once, and every frame reads those of its type: the input is evaluated
    a single time, however many tables there are and however often they are read.  They are
    neither shuffled nor sorted by type, which would move several times what is written; row
    groups without a type are passed over by their statistics.
    """
    spark = df.sparkSession
    stage = work_dir(spark, "routed")
    known = df.where(F.col(type_column).isin(list(TABLES)))
    known.write.option("compression", "zstd").parquet(stage)
    rows = spark.read.schema(known.schema).parquet(stage)
    return {name: rows.where(F.col(type_column) == name).drop(type_column) for name in TABLES}


def rejects_path(root: str) -> str:
    return f"{root.rstrip('/')}/freight_rejects"


def write_rejects(rejects: DataFrame, root: str, name: str, run_id: str) -> int:
    """Keep the rows that a run rejected, with their reasons; returns how many there are.

    ``rejects`` has ``reject_reasons`` beside the table's columns. The rows of all tables
    share one layout: run, table, reasons, and the record as JSON text.
    """
    columns = [c for c in rejects.columns if c != "reject_reasons"]
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    seen = Observation(f"rejects {name}")
    rows = rejects.select(
        F.lit(run_id).alias("run_id"), F.lit(name).alias("table"), F.col("reject_reasons").alias("reasons"), record.alias("record")
    )
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").option("compression", "zstd").parquet(rejects_path(root))
    return int(seen.get["rows"])


def scan_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, table, reasons, record) of every row that a run has rejected."""
    schema = "run_id string, table string, reasons array<string>, record string"
    if not path_exists(spark, rejects_path(root)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(rejects_path(root))


def export_compacted(
    spark: SparkSession, root: str, out: str, names: list[str] | None = None
) -> DataFrame:
    """De-duplicate each table into its own compact dataset; returns its statistics.

    Tables without rows are skipped, and what an earlier export left of them is removed.
    Stored files are read strictly.  Rows are written where the aggregate leaves them, dealt
    by their identity: distinct rows give tasks and files of like size.  One file per table
    would pull tens of millions of rows through a single task.  Rows are counted in the
    writing stage.
    """
    written = []
    for name in names or TABLES:
        target = f"{out.rstrip('/')}/{name}"
        rows = 0
        if path_exists(spark, table_path(root, name)):
            kept = dedup_keep_latest(scan_table(spark, root, name, skip_corrupt=False))
            seen = Observation(f"export {name}")
            counted = kept.observe(seen, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("overwrite").option("compression", "zstd").parquet(target)
            rows = seen.get["rows"]
        if rows:
            written.append(name)
        elif path_exists(spark, target):
            remove_dir(spark, target)
    return export_stats(spark, out, written)


def export_stats(spark: SparkSession, out: str, names: list[str]) -> DataFrame:
    """(table, rows, bytes) of each exported dataset.

    One row per file first, so a file's size is added once and not once per row.
    """
    stats = spark.createDataFrame([], "table string, rows bigint, bytes bigint")
    for name in names:
        files = (
            spark.read.parquet(f"{out.rstrip('/')}/{name}")
            .select("_metadata.file_path", "_metadata.file_size")
            .groupBy("file_path", "file_size")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        one = files.agg(
            F.lit(name).alias("table"),
            F.sum("n").alias("rows"),
            F.sum("file_size").alias("bytes"),
        )
        stats = stats.unionByName(one)
    return stats


def store_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(table, rows) of every table of the store; only row counts are read."""
    counts = None
    for name in TABLES:
        one = scan_table(spark, root, name).agg(F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(name).alias("table"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts
