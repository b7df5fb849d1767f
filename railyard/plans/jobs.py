"""Ingest and backfill jobs.  The driver only chains frames and reads counters."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from threading import Lock
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from railyard.constants import BORDER_VIEWS
from railyard.operators import backfill, normalize
from railyard.operators.dedup import union_all
from railyard.operators.quality import quarantine
from railyard.schemas import TABLES, constrained_columns
from railyard.session import path_exists, work_dir
from railyard.sinks.store import merge_year_partitions, write_rejects, write_run_summary, write_table
from railyard.sources import archives as zips
from railyard.sources.border import parse_csv_lines
from railyard.sources.fixed_width import is_short, slice_fixed_width
from railyard.sources.store_scan import stored_partitions, table_path

log = logging.getLogger(__name__)


@dataclass
class Fetched:
    """What a source returns: frames per table, or the reason it has none."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    success: bool = True
    error: str | None = None


Source = Callable[[SparkSession, date | None], Fetched]


def new_run_name(at: datetime) -> str:
    """``run_`` and the start in UTC, with random letters for runs that start together."""
    return f"run_{at:%Y%m%d_%H%M%S}_{uuid4().hex[:6]}"


def choose(registry: dict[str, Source], wanted: Iterable[str] | None = None) -> list[str]:
    """The sources to run in registry order: those in ``wanted``, or all."""
    if wanted is None:
        return list(registry)
    asked = set(wanted)
    if strangers := sorted(asked - registry.keys()):
        raise ValueError(f"not in the registry: {', '.join(strangers)}")
    if not asked:
        raise ValueError("an empty selection runs nothing; pass None for every source")
    return [name for name in registry if name in asked]


def run_ingest(
    spark: SparkSession,
    registry: dict[str, Source],
    root: str,
    names: Iterable[str] | None = None,
    snapshot_date: date | None = None,
    parallel: int = 4,
    run_id: str | None = None,
) -> Row:
    """Fetch, normalise and write each source; returns the run's row of the run table.

    Sources are independent: an exception marks its source as failed and the others go on.
    A source may also report a failure and still hand over frames, which are written.  Rows
    that break a constraint of their table are kept aside with their reasons, under the run's
    name (``scan_rejects``).

    Up to ``parallel`` sources run at once, each in a thread, a job group and, where the
    scheduler is fair, a pool of its own; ``cancel_source`` stops one of them.  Two
    sources of one table write one after the other.
    """
    attempted = choose(registry, names)
    began = datetime.now(UTC)
    run_id = run_id or new_run_name(began)
    locks = defaultdict(Lock, {name: Lock() for name in TABLES})

    def load(name: str) -> tuple[dict[str, int], str | None]:
        context = spark.sparkContext
        context.setJobGroup(f"{run_id}/{name}", f"ingest {name}", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", name)
        written: dict[str, int] = {}
        try:
            fetched = registry[name](spark, snapshot_date)
            for target, frame in fetched.tables.items():
                with locks[target]:
                    written[target] = _load_table(spark, frame, root, target, name, run_id, snapshot_date)
            problem = None if fetched.success else fetched.error or "the source says that it failed"
        except Exception as exc:
            log.exception("source %s failed", name)
            problem = str(exc) or type(exc).__name__
        return written, problem

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        # Each thread starts from the caller's own local properties.
        waiting = [pool.submit(inheritable_thread_target(spark)(load), name) for name in attempted]
        results = dict(zip(attempted, (w.result() for w in waiting), strict=True))
    problems = {name: problem for name, (_, problem) in results.items() if problem is not None}
    written: dict[str, int] = {}
    for counts, _ in results.values():
        for target, count in counts.items():
            written[target] = written.get(target, 0) + count
    run = {
        "run_id": run_id,
        "started_at": began,
        "finished_at": datetime.now(UTC),
        "success": not problems,
        "sources_attempted": attempted,
        "sources_succeeded": [n for n in attempted if n not in problems],
        "sources_failed": list(problems),
        "total_records_written": sum(written.values()),
        "errors": [f"{n}: {why}" for n, why in problems.items()],
        "output_paths": [table_path(root, t) for t, count in written.items() if count],
    }
    write_run_summary(spark, run, root)
    return Row(**run)


def _load_table(
    spark: SparkSession, frame: DataFrame, root: str, target: str, source: str, run_id: str, day: date | None
) -> int:
    """Write one table of one source, and set aside the rows that its constraints reject."""
    if constrained_columns(target):
        frame, rejects = quarantine(frame, target)
        if not rejects.isEmpty():
            count = write_rejects(rejects, root, target, run_id)
            log.warning("source %s: %d rows of %s rejected", source, count, target)
    return write_table(spark, frame, root, target, day)


def cancel_source(spark: SparkSession, run_id: str, name: str) -> None:
    """Stop what a running source is doing; the run notes it as failed and goes on."""
    spark.sparkContext.cancelJobGroup(f"{run_id}/{name}")


def stored_months(spark: SparkSession, root: str, name: str = "transborder_freight") -> DataFrame:
    """(year, month) that the store has, from its partition folders."""
    keys = stored_partitions(spark, root, name)
    return keys.select(F.col("p_year").alias("year"), F.col("p_month").alias("month")).distinct()


def backfill_transborder(
    spark: SparkSession,
    archives: DataFrame,
    root: str,
    tokens: list[str] | None = None,
    force: bool = False,
    ingested_at: Column | None = None,
) -> tuple[int, DataFrame]:
    """Load the missing months found in ``archives`` (archive: the path of a zip).

    Each month and view is read from one member, whatever the number of archives that hold
    it; of an archive only the directory and the members chosen are read.  Returns the rows written and a report (year, month, view, status) of members that
    were recovered from a cumulative view, absent or unrecoverable.
    """
    stage = work_dir(spark, "border")
    zips.list_members(archives).write.parquet(f"{stage}/members")
    members = spark.read.parquet(f"{stage}/members")
    known = backfill.prefer_outer_members(backfill.register_members(members))
    picked = backfill.pick_member(known)
    monthly = picked.where("kind = 'monthly'")
    months = monthly.select("year", "month").distinct()
    if tokens:
        months = backfill.select_targets(months, backfill.parse_targets(spark, tokens))
    months = backfill.missing_partitions(months, stored_months(spark, root), force=force)
    wanted = monthly.join(months, ["year", "month"], "left_semi")
    wanted.write.parquet(f"{stage}/wanted")
    wanted = spark.read.parquet(f"{stage}/wanted")
    zips.scan_chosen_members(wanted).write.parquet(f"{stage}/lines")
    lines = spark.read.parquet(f"{stage}/lines")
    rows = parse_csv_lines(lines, wanted)
    key = ["year", "month", "view"]
    unreadable = lines.where("error IS NOT NULL").select("archive", "member").distinct()
    gaps = wanted.join(unreadable, ["archive", "member"], "left_semi").select(*key)
    ytd = picked.where("kind = 'ytd'")
    plan = backfill.find_recovery(gaps, ytd)
    chosen = plan.select("year", "view", F.col("ytd_month").alias("month")).distinct()
    spares = ytd.join(chosen, key, "left_semi")
    zips.scan_chosen_members(spares).write.parquet(f"{stage}/spare_lines")
    spare_lines = spark.read.parquet(f"{stage}/spare_lines")
    spare_rows = parse_csv_lines(spare_lines, spares)
    recovered, lost = backfill.recover_from_ytd(gaps, spares, spare_rows)
    raw = union_all(rows, recovered).drop("archive", "member")
    written = write_table(
        spark,
        normalize.norm_transborder(raw, ingested_at=ingested_at),
        root,
        "transborder_freight",
    )
    bad_spares = spare_lines.where("error IS NOT NULL").select(F.col("member").alias("ytd_member"))
    lost = lost.unionByName(plan.join(bad_spares.distinct(), "ytd_member", "left_semi").select(*key))
    every_view = (
        wanted.select("year", "month")
        .distinct()
        .select("*", F.explode(F.array(*[F.lit(v) for v in BORDER_VIEWS])).alias("view"))
    )
    absent = every_view.join(wanted, key, "left_anti")
    report = union_all(
        gaps.join(lost, key, "left_anti").withColumn("status", F.lit("recovered")),
        lost.withColumn("status", F.lit("unrecoverable")),
        absent.withColumn("status", F.lit("absent")),
    )
    return written, report


def backfill_waybills(
    spark: SparkSession,
    samples: dict[int, DataFrame],
    root: str,
    force: bool = True,
    ingested_at: Column | None = None,
) -> dict[int, dict[str, int]]:
    """Load one frame of record lines per sample year; returns counters per sample.

    Each sample holds several waybill years and is merged into all of them.  Without
    ``force`` a sample is skipped once its own year exists.  Short lines are counted in the
    pass that deals the others.

    Lines are dealt by the two digits of their year, which fix the year within a sample,
    before they are cut and parsed: that work runs in tasks of even size, however few pieces
    the input has, and a line is shuffled in place of its parsed columns.
    """
    out: dict[int, dict[str, int]] = {}
    for sample, lines in samples.items():
        folder = f"{table_path(root, 'waybill_shipments')}/p_year={sample}"
        if not force and path_exists(spark, folder):
            out[sample] = {"written": 0, "dropped": 0, "skipped": 1}
            continue
        seen = Observation(f"sample {sample}")
        short = F.count_if(is_short(F.col("line"))).alias("dropped")
        digits = F.substring(F.col("line").cast("binary"), 5, 2).alias("_digits")
        dealt = lines.observe(seen, short).select("line", digits).hint("rebalance", "_digits")
        cut = slice_fixed_width(dealt)
        records = normalize.norm_waybills(cut, sample, ingested_at)
        written = merge_year_partitions(
            spark, records, root, "waybill_shipments", laid_out=True
        )
        out[sample] = {"written": written, "dropped": int(seen.get["dropped"]), "skipped": 0}
    return out
