"""Queries for backfill selection and recovery, and for the jobs."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import ExitStack
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import BORDER_VIEWS
from railyard.operators import backfill, filters
from railyard.operators import normalize as N
from railyard.plans import jobs
from railyard.session import work_dir
from railyard.sinks import store
from railyard.sources import archives as zips
from railyard.sources import store_scan
from workload import raw as R
from workload.normalising import (
    AS_OF,
    BORDER_SQL,
    RUN,
    SAMPLE_YEAR,
    TARIFFS_SQL,
    _waybill_sql,
    border,
    number_sql,
)
from workload.registry import query, raw, typed
from workload.scans import landing

# Months in which more lines than average were shipped count as published.
RELEASES = """
SELECT year, month, '/r/' || CAST(year AS STRING) || '-' || CAST(month AS STRING) AS url
FROM (
  SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(*) AS n,
         avg(count(*)) OVER () AS usual
  FROM lineitem GROUP BY 1, 2
) m WHERE n > usual
"""
REQUESTS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 19 <> 0 THEN year(o_orderdate) END AS year,
  CASE WHEN o_orderkey % 19 <> 0 THEN month(o_orderdate) END AS month
FROM orders
"""


_YM = ("year", "month")
_ASOF_INTS = (*_YM, "release_year", "release_month")


def _asof_sql(limit: int | None) -> str:
    inside = "" if limit is None else f"AND (q.year IS NULL OR r.year > q.year - {limit})"
    return f"""
    WITH r AS ({RELEASES}), best AS (
      SELECT o_orderkey, max(r.year * 12 + r.month) AS ym FROM ({REQUESTS}) q JOIN r
        ON (q.year IS NULL OR r.year * 12 + r.month <= q.year * 12 + q.month)
      GROUP BY 1
    )
    SELECT q.o_orderkey, q.year, q.month, r.year AS release_year, r.month AS release_month, r.url
    FROM ({REQUESTS}) q LEFT JOIN best USING (o_orderkey)
    LEFT JOIN r ON r.year * 12 + r.month = best.ym {inside}
    """


@query("asof_release", typed(_asof_sql(None), "INTEGER", *_ASOF_INTS))
def asof_release(spark: SparkSession, d: str) -> DataFrame:
    releases = raw(spark, d, RELEASES)
    return backfill.asof_release(raw(spark, d, REQUESTS), releases)


@query("asof_release_limited", typed(_asof_sql(1), "INTEGER", *_ASOF_INTS))
def asof_release_limited(spark: SparkSession, d: str) -> DataFrame:
    releases = raw(spark, d, RELEASES)
    return backfill.asof_release(raw(spark, d, REQUESTS), releases, max_years=1)


_WANTED = "SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders"


@query(
    "missing_partitions",
    typed(
        f"SELECT * FROM ({_WANTED}) w WHERE NOT EXISTS (SELECT 1 FROM ({RELEASES}) r "
        "WHERE r.year = w.year AND r.month = w.month)",
        "INTEGER",
        *_YM,
    ),
)
def missing_partitions(spark: SparkSession, d: str) -> DataFrame:
    return backfill.missing_partitions(raw(spark, d, _WANTED), raw(spark, d, RELEASES))


@query(
    "except_months",
    typed(
        f"SELECT year, month FROM ({_WANTED}) EXCEPT SELECT year, month FROM ({RELEASES})",
        "INTEGER",
        *_YM,
    ),
)
def except_months(spark: SparkSession, d: str) -> DataFrame:
    wanted = raw(spark, d, _WANTED)
    return backfill.except_months(wanted.unionByName(wanted), raw(spark, d, RELEASES))


_TOKENS = """
SELECT CASE o_orderstatus WHEN 'O' THEN CAST(year(o_orderdate) AS STRING) || '-'
    || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
  WHEN 'F' THEN CAST(year(o_orderdate) + 20 AS STRING)
  ELSE CAST(year(o_orderdate) + 40 AS STRING) || '-' || CAST(year(o_orderdate) + 42 AS STRING)
  END AS token, o_orderstatus, o_orderdate
FROM orders
"""


@query(
    "parse_targets",
    f"""
    SELECT DISTINCT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM (
      SELECT year(o_orderdate) AS y, unnest([month(o_orderdate)]) AS m
      FROM ({_TOKENS}) WHERE o_orderstatus = 'O'
      UNION ALL
      SELECT year(o_orderdate) + 20, unnest(range(1, 13)) FROM ({_TOKENS}) WHERE o_orderstatus = 'F'
      UNION ALL
      SELECT y + k, unnest(range(1, 13)) FROM (
        SELECT year(o_orderdate) + 40 AS y, unnest(range(0, 3)) AS k FROM ({_TOKENS})
        WHERE o_orderstatus NOT IN ('O', 'F'))
    )
    """,
)
def parse_targets(spark: SparkSession, d: str) -> DataFrame:
    return backfill.expand_targets(raw(spark, d, _TOKENS))


@query(
    "select_targets",
    typed(
        f"""SELECT r.* FROM ({RELEASES}) r WHERE EXISTS (SELECT 1 FROM orders
            WHERE o_totalprice > 499000 AND year(o_orderdate) = r.year
              AND month(o_orderdate) = r.month)""",
        "INTEGER",
        *_YM,
    ),
)
def select_targets(spark: SparkSession, d: str) -> DataFrame:
    releases = raw(spark, d, RELEASES)
    dear = raw(
        spark,
        d,
        "SELECT CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS "
        "STRING), 2, '0') AS token FROM orders WHERE o_totalprice > 499000"
    )
    return backfill.select_targets(releases, backfill.expand_targets(dear))


@query(
    "order_releases",
    typed(
        f"""SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month, url
            FROM ({R.LINKS}) WHERE o_orderkey % 7 <> 0""",
        "INTEGER",
        *_YM,
    ),
)
def order_releases(spark: SparkSession, d: str) -> DataFrame:
    releases = backfill.parse_releases(raw(spark, d, R.LINKS))
    return backfill.order_releases(releases)


# --- archive members -------------------------------------------------------------

MEMBERS = """
SELECT 'A' || CAST(year(o_orderdate) AS STRING) || '.zip' AS archive,
  folder || name AS member, c_nationkey % 4 = 0 AND year(o_orderdate) <> 1996 AS inner_zip, view, kind,
  2000 + year(o_orderdate) % 100 AS year, month(o_orderdate) AS month
FROM (
  SELECT *, CASE c_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Data Files/'
      ELSE 'Copy of ' || c_mktsegment || '/' END AS folder,
    CASE WHEN c_custkey % 11 = 0 THEN 'full.csv' WHEN c_custkey % 13 = 0 THEN '._dot1_0101.csv'
      WHEN kind = 'ytd' THEN 'dot' || CAST(view AS STRING) || '_ytd_' || mmyy || '.csv'
      ELSE 'Dot' || CAST(view AS STRING) || '_' || mmyy || '.CSV' END AS name
  FROM (
    SELECT *, 1 + o_orderkey % 3 AS view,
      CASE WHEN o_orderstatus = 'F' THEN 'ytd' ELSE 'monthly' END AS kind,
      lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || right(CAST(year(o_orderdate) AS STRING), 2)
        AS mmyy
    FROM orders JOIN customer ON o_custkey = c_custkey
  ) a
) b
"""
_REGISTERED = f"""
SELECT archive, member, inner_zip, kind, year, month, 'dot' || CAST(view AS VARCHAR) AS view
FROM ({MEMBERS}) WHERE member LIKE '%dot%' AND member NOT LIKE '%.\\_%' ESCAPE '\\'
   OR member LIKE '%Dot%'
"""


def _registered(spark: SparkSession, d: str) -> DataFrame:
    found = raw(spark, d, MEMBERS).select("archive", "member", F.col("inner_zip").alias("inner"))
    return backfill.register_members(found)


@query(
    "filter_members",
    f"""SELECT archive, member, count(*) AS "rows" FROM ({MEMBERS})
        WHERE lower(member) LIKE '%.csv' AND NOT contains(member, '._')
          AND NOT contains(lower(member), '_ytd_') GROUP BY 1, 2""",
)
def filter_members(spark: SparkSession, d: str) -> DataFrame:
    kept = zips.filter_members(raw(spark, d, MEMBERS).select("archive", "member"))
    return kept.groupBy("archive", "member").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "pick_member",
    f"""
    SELECT kind, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, view, member FROM (
      SELECT *, row_number() OVER (PARTITION BY kind, year, month, view ORDER BY
        CASE WHEN kind = 'monthly' THEN length(member) ELSE 0 END,
        CASE WHEN kind = 'monthly' THEN member END, member DESC) AS pick
      FROM (SELECT DISTINCT kind, year, month, view, member FROM ({_REGISTERED})))
    WHERE pick = 1
    """,
)
def pick_member(spark: SparkSession, d: str) -> DataFrame:
    picked = backfill.pick_member(_registered(spark, d))
    return picked.select("kind", "year", "month", "view", "member")


@query(
    "prefer_outer_members",
    f"""
    WITH r AS ({_REGISTERED})
    SELECT archive, inner_zip AS "inner", kind, count(*) AS "rows" FROM r
    WHERE NOT inner_zip OR archive NOT IN
      (SELECT archive FROM r WHERE kind = 'monthly' AND NOT inner_zip)
    GROUP BY 1, 2, 3
    """,
)
def prefer_outer_members(spark: SparkSession, d: str) -> DataFrame:
    kept = backfill.prefer_outer_members(_registered(spark, d))
    return kept.groupBy("archive", "inner", "kind").agg(F.count(F.lit(1)).alias("rows"))


# Gaps: months and views with an order total below the month's average are unreadable;
# cumulative views exist where a month has a large order of that view.
_GAPS = """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
  'dot' || CAST(1 + o_orderkey % 3 AS STRING) AS view
FROM orders GROUP BY 1, 2, 3 HAVING min(o_totalprice) < 2500
"""
_YTD = """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
  'dot' || CAST(1 + o_orderkey % 3 AS STRING) AS view,
  'dot' || CAST(1 + o_orderkey % 3 AS STRING) || '_ytd_' || CAST(year(o_orderdate) AS STRING)
    || '_' || CAST(month(o_orderdate) AS STRING) AS member
FROM orders GROUP BY 1, 2, 3, 4 HAVING max(o_totalprice) > 490000
"""
_YTD_ROWS = """
SELECT m.member, CAST(year(o_orderdate) AS STRING) AS YEAR,
  lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS MONTH, o_orderkey
FROM orders JOIN ({0}) m ON year(o_orderdate) = m.year AND month(o_orderdate) <= m.month
  AND 'dot' || CAST(1 + o_orderkey % 3 AS STRING) = m.view
"""
_PLAN_SQL = f"""
SELECT g.year, g.month, g.view, min(y.month) AS ytd_month,
  arg_min(y.member, y.month) AS ytd_member
FROM ({_GAPS}) g LEFT JOIN ({_YTD}) y
  ON g.year = y.year AND g.view = y.view AND y.month > g.month
GROUP BY 1, 2, 3
"""


@query(
    "recover_from_ytd",
    f"""
    SELECT CAST(p.year AS INTEGER) AS year, CAST(p.month AS INTEGER) AS month, p.view,
      p.ytd_month IS NOT NULL AS recovered,
      count(r.o_orderkey) AS "rows"
    FROM ({_PLAN_SQL}) p LEFT JOIN ({_YTD_ROWS.format(_YTD)}) r
      ON r.member = p.ytd_member AND CAST(r."YEAR" AS INTEGER) = p.year
        AND CAST(r."MONTH" AS INTEGER) = p.month
    GROUP BY ALL
    """,
)
def recover_from_ytd(spark: SparkSession, d: str) -> DataFrame:
    gaps, ytd = raw(spark, d, _GAPS), raw(spark, d, _YTD)
    rows, lost = backfill.recover_from_ytd(gaps, ytd, raw(spark, d, _YTD_ROWS.format(_YTD)))
    found = rows.groupBy(
        F.col("YEAR").cast("int").alias("year"),
        F.col("MONTH").cast("int").alias("month"),
        F.substring_index("member", "_", 1).alias("view"),
    ).agg(F.lit(True).alias("recovered"), F.count(F.lit(1)).alias("rows"))
    missing = lost.select(
        "*", F.lit(False).alias("recovered"), F.lit(0).cast("bigint").alias("rows")
    )
    return found.unionByName(missing)


@query("filter_table_name", "SELECT 'transborder_freight' AS \"table\"")
def filter_table_name(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "explore")
    store.write_day_partitions(border(spark, d), root, "transborder_freight")
    tariffs = raw(spark, d, R.TARIFFS).drop("_cents", "_size")
    store.write_day_partitions(N.norm_tariffs(tariffs, AS_OF, RUN), root, "rail_tariff_rates")
    files = filters.filter_table_name(store_scan.list_files(spark, root, "*.parquet"), "transborder")
    return files.select(F.regexp_extract("path", "/freight/([^/]+)/", 1).alias("table")).distinct()


# --- jobs ------------------------------------------------------------------------


@query(
    "run_ingest",
    f"""
    SELECT 'border' AS source, count(*) AS "rows", false AS failed FROM ({BORDER_SQL})
    UNION ALL SELECT 'tariffs', count(*), false FROM ({TARIFFS_SQL})
    UNION ALL SELECT 'broken', 0, true
    """,
)
def run_ingest(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "ingest")

    def broken(_spark, _day):
        raise RuntimeError("feed is down")

    def tariffs(_spark, _day):
        feed = raw(spark, d, R.TARIFFS).drop("_cents", "_size")
        return jobs.Fetched({"rail_tariff_rates": N.norm_tariffs(feed, AS_OF, RUN)})

    registry = {
        "border": lambda _spark, _day: jobs.Fetched({"transborder_freight": border(spark, d)}),
        "broken": broken,
        "tariffs": tariffs,
    }
    jobs.log.disabled = True
    result = jobs.run_ingest(spark, registry, root)
    runs = store_scan.scan_run_summaries(spark, root)
    stored = {
        name: store_scan.scan_table(spark, root, table).agg(F.count(F.lit(1)).alias("rows"))
        for name, table in (("border", "transborder_freight"), ("tariffs", "rail_tariff_rates"))
    }
    failed = F.array_contains("sources_failed", F.col("source"))
    attempts = runs.select(F.explode("sources_attempted").alias("source"), "sources_failed")
    outcome = attempts.select("source", failed.alias("failed"))
    rows = stored["border"].select(F.lit("border").alias("source"), "rows").unionByName(
        stored["tariffs"].select(F.lit("tariffs").alias("source"), "rows")
    )
    assert not result.success
    return outcome.join(rows, "source", "left").select(
        "source", F.coalesce("rows", F.lit(0)).alias("rows"), "failed"
    )


@query(
    "run_ingest_rejects",
    f"""
    WITH typed AS (
      SELECT {number_sql("VALUE")} AS v, {number_sql("SHIPWT")} AS w, TRY_CAST(MONTH AS BIGINT) AS m FROM ({R.BORDER}))
    SELECT 'stored' AS what, count(*) FILTER (w IS NULL OR w >= 0) AS "rows" FROM typed WHERE v IS NOT NULL AND m <= 12
    UNION ALL
    SELECT 'transborder_freight: ship_weight_kg must be >= 0', count(*) FILTER (w < 0)
    FROM typed WHERE v IS NOT NULL AND m <= 12
    """,
)
def run_ingest_rejects(spark: SparkSession, d: str) -> DataFrame:
    """A run stores the valid rows and keeps the others with their reasons."""
    root = work_dir(spark, "ingest")
    rows = N.norm_transborder(raw(spark, d, R.BORDER), valid_only=False)
    jobs.run_ingest(spark, {"border": lambda _s, _d: jobs.Fetched({"transborder_freight": rows})}, root)
    count = F.count(F.lit(1)).alias("rows")
    stored = store_scan.scan_table(spark, root, "transborder_freight").agg(count)
    why = F.concat_ws(": ", "table", F.array_join("reasons", "; "))
    rejects = store.scan_rejects(spark, root).groupBy(why.alias("what")).agg(count)
    return stored.select(F.lit("stored").alias("what"), "rows").unionByName(rejects)


@query(
    "backfill_waybills",
    f"""SELECT year(snapshot_date) AS "year", count(*) AS "rows",
        CAST(sum(carloads) AS BIGINT) AS carloads FROM ({_waybill_sql()}) GROUP BY 1""",
)
def backfill_waybills(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "sample")
    jobs.backfill_waybills(spark, {SAMPLE_YEAR: raw(spark, d, R.WAYBILLS)}, root)
    rows = store_scan.scan_table(spark, root, "waybill_shipments")
    return rows.groupBy(F.year("snapshot_date").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("carloads").alias("carloads")
    )


def border_archives(spark: SparkSession, d: str, folder: str) -> DataFrame:
    """(archive) of zip archives of monthly CSV members in ``folder``, one per month.

    Spark builds the CSV lines and sorts them into members, and a task writes each archive as
    its lines come: no month and no member is held in memory. The data of May's dot1 member is
    damaged, and June's archive has a cumulative dot1 member that holds May; every March archive
    comes twice.
    """
    rows = raw(spark, d, R.BORDER)
    month = F.when(F.col("MONTH") == "13", "01").otherwise(F.col("MONTH"))
    rows = rows.select("*", F.col("YEAR").alias("y"), month.alias("m"))
    short = F.right("YEAR", F.lit(2))
    frames = []
    for view, header in BORDER_VIEWS.items():
        fields = [F.coalesce(F.col(c), F.lit("")) for c in header.split(",")]
        one = rows.where(F.col("source_file") == view)
        line = F.concat_ws(",", *fields).alias("line")
        name = F.concat(F.lit(f"{view}_"), "m", short, F.lit(".csv")).alias("member")
        frames.append(one.select("y", "m", name, line))
        if view == "dot1":
            ytd = F.concat(F.lit("dot1_ytd_06"), short, F.lit(".csv")).alias("member")
            frames.append(one.where("m IN ('05', '06')").select("y", F.lit("06").alias("m"), ytd, line))
    lines = reduce(lambda a, b: a.unionByName(b), frames)
    dealt = lines.repartition("y", "m").sortWithinPartitions("y", "m", "member")
    return dealt.mapInArrow(lambda batches: pack_months(batches, folder), "archive string")


class _Copies:
    """Files that are written alike; the byte at ``harm`` is damaged on its way."""

    def __init__(self, files: list) -> None:
        self.files, self.at, self.harm = files, 0, None

    def write(self, data: bytes) -> int:
        if self.harm is not None and 0 <= (i := self.harm - self.at) < len(data):
            data = data[:i] + bytes([data[i] ^ 0xFF]) + data[i + 1 :]
        for file in self.files:
            file.write(data)
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        for file in self.files:
            file.flush()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array]]:
    """((y, m, member), lines) of the rows that follow one another in a batch."""
    for batch in batches:
        keys, lines = batch.columns[:3], batch.column(3)
        start = 0
        for end in sorted({e for c in keys for e in pc.run_end_encode(c).run_ends.to_pylist()}):
            yield tuple(c[start].as_py() for c in keys), lines[start:end]
            start = end


def pack_months(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write an archive for each month of (y, m, member, line), sorted by the first three."""
    for (year, month), of_month in groupby(_runs(batches), lambda run: run[0][:2]):
        names = [f"{year}-{month}-{i}.zip" for i in range(2 if month == "03" else 1)]
        with ExitStack() as opened:
            copies = _Copies([opened.enter_context(landing(folder, name)) for name in names])
            z = opened.enter_context(zipfile.ZipFile(copies, "w", zipfile.ZIP_DEFLATED))
            for (_, _, member), of_member in groupby(of_month, itemgetter(0)):
                if member is None:
                    continue
                with z.open(f"{year}/{member}", "w", force_zip64=True) as file:
                    # Two digits of year mean 20yy, so only these can be found in the cumulative one.
                    if member.startswith("dot1_05") and year >= "2000":
                        copies.harm = copies.at + 8
                    file.write(BORDER_VIEWS[member.partition("_")[0]].encode())
                    for _, lines in of_member:
                        file.write(("\n" + "\n".join(lines.to_pylist())).encode())
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in names], pa.string())], ["archive"])


@query(
    "backfill_transborder",
    f"""SELECT snapshot_date, source_file, count(*) AS "rows", sum(value_usd) AS value_usd
        FROM ({BORDER_SQL}) GROUP BY 1, 2""",
)
def backfill_transborder(spark: SparkSession, d: str) -> DataFrame:
    folder, root = work_dir(spark, "zips"), work_dir(spark, "backfill")
    border_archives(spark, d, folder).write.format("noop").mode("overwrite").save()
    jobs.backfill_transborder(spark, zips.find_archives(spark, folder), root)
    rows = store_scan.scan_table(spark, root, "transborder_freight")
    return rows.groupBy("snapshot_date", "source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value_usd").alias("value_usd")
    )
