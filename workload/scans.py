"""Queries for the scans: raw files are first written from the tables, then read back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import BORDER_VIEWS, WAYBILL_WIDTH, waybill_fields
from railyard.operators import lookups
from railyard.operators import normalize as N
from railyard.operators.report import drop_payload_columns
from railyard.session import work_dir
from railyard.sources import archives, border, feeds, fixed_width, releases
from workload import raw as R
from workload.normalising import (
    _ROUTE_VALUES,
    BORDER_SQL,
    number_sql,
)
from workload.registry import query, raw


@query(
    "scan_json_feed",
    f"""SELECT reportkey, incident_type, date, totaldamagecost, statename,
        CASE WHEN reportkey IS NULL THEN 0 ELSE 1 END AS keyed FROM ({R.INCIDENTS})""",
)
def scan_json_feed(spark: SparkSession, d: str) -> DataFrame:
    path = work_dir(spark, "feed")
    columns = ["reportkey", "incident_type", "date", "totaldamagecost", "statename"]
    raw(spark, d, R.INCIDENTS).write.json(path)
    rows = feeds.scan_json_feed(spark, path, columns, multiline=False)
    keyed = F.contains("raw_record", F.lit('"reportkey"')).cast("int")
    return rows.select(*columns, keyed.alias("keyed"))


def write_pages(rows: DataFrame, path: str, count: int = 64) -> None:
    """Write rows as JSON pages, each a file that holds an array over many lines.

    A page is written by a task of its own, object by object: it is neither a group nor a
    value, so its size has no limit.
    """
    page = F.pmod(F.xxhash64(*rows.columns), F.lit(count)).cast("int")
    dealt = rows.repartitionById(count, page)
    objects = dealt.select(F.to_json(F.struct(*rows.columns), {"pretty": "true"}).alias("value"))

    def array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            texts = []
            for text in batch.column(0).to_pylist():
                texts.append(mark + text)
                mark = ","
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
        if mark == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"], pa.string())], ["value"])

    objects.mapInArrow(array, "value string").write.text(path)


@query("scan_json_pages", f"SELECT * FROM ({R.INCIDENTS})")
def scan_json_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every column of a feed whose pages hold arrays over many lines."""
    path = work_dir(spark, "pages")
    rows = raw(spark, d, R.INCIDENTS)
    write_pages(rows, path)
    return feeds.scan_json_feed(spark, path, rows.columns).drop("raw_record")


_CUTS = ", ".join(f"trim(substr(line, {a + 1}, {z - a})) AS {name}" for name, a, z, _ in waybill_fields())
_SLICES_SQL = f"SELECT {_CUTS} FROM ({R.WAYBILLS}) WHERE length(line) >= {WAYBILL_WIDTH}"


@query("scan_fixed_width", _SLICES_SQL)
def scan_fixed_width(spark: SparkSession, d: str) -> DataFrame:
    path = work_dir(spark, "waybills")
    raw(spark, d, R.WAYBILLS).write.text(path)
    return fixed_width.scan_fixed_width(spark, path)


@contextmanager
def landing(folder: str, name: str) -> Iterator[pa.NativeFile]:
    """A file in the shared folder that a task writes as its content comes."""
    store, inner = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")
    store.create_dir(inner)
    with store.open_output_stream(f"{inner}/{name}") as file:
        yield file


def land(folder: str, name: str, content: bytes) -> str:
    """Write a file into the shared folder, as a task does; its path."""
    with landing(folder, name) as file:
        file.write(content)
    return f"{folder}/{name}"


def zip_lines(lines: DataFrame, folder: str) -> DataFrame:
    """Pack text lines into zip archives, one per batch of rows; (archive) of each."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            buffer = io.BytesIO()
            half = len(batch) // 2
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("readme.pdf", "not data")
                z.writestr("a/PU1.DAT", "\r\n".join(batch["line"][:half]))
                z.writestr("a/pu2.txt", "\n".join(batch["line"][half:]))
            yield pd.DataFrame({"archive": [land(folder, f"batch-{part}-{number}.zip", buffer.getvalue())]})

    return lines.select("line").mapInPandas(pack, "archive string")


@query("scan_archive_members", f"SELECT line FROM ({R.WAYBILLS})")
def scan_archive_members(spark: SparkSession, d: str) -> DataFrame:
    folder = work_dir(spark, "zips")
    zip_lines(raw(spark, d, R.WAYBILLS), folder).write.format("noop").mode("overwrite").save()
    packed = archives.find_archives(spark, folder)
    members = archives.scan_archive_members(packed, (".txt", ".dat", ".asc"), require_data=True)
    return members.where("error IS NULL").select(F.col("line").cast("string").alias("line"))


_CSV_SQL = f"""
SELECT * REPLACE (
  CASE WHEN source_file <> 'dot3' THEN us_state END AS us_state,
  CASE WHEN source_file <> 'dot3' THEN mexico_state END AS mexico_state,
  CASE WHEN source_file <> 'dot3' THEN canada_province END AS canada_province)
FROM ({BORDER_SQL})
"""


def _land(df: DataFrame, folder: str, stem: str) -> None:
    """Write ``df`` as CSV files with headers, named as the publisher names them."""
    spark = df.sparkSession
    df.write.option("header", "true").csv(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base = path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName().startswith("part-")]
    for i, part in enumerate(parts):
        fs.rename(part, path(folder, f"{stem}{i:04d}.csv"))


@query("scan_transborder_csv", _CSV_SQL)
def scan_transborder_csv(spark: SparkSession, d: str) -> DataFrame:
    """Monthly files, dot2 with its columns exchanged, beside a cumulative one of dot1."""
    path = work_dir(spark, "border-csv")
    rows = raw(spark, d, R.BORDER)
    for view, header in BORDER_VIEWS.items():
        names = header.split(",")
        names = [*names[1:], names[0]] if view == "dot2" else names
        one = rows.where(F.col("source_file") == view).select(*names)
        _land(one, f"{path}/{view}", f"{view}_")
        if view == "dot1":
            _land(one, f"{path}/{view}-ytd", f"{view}_ytd_")
    return drop_payload_columns(N.norm_transborder(border.scan_transborder_csv(spark, path)))


_HEADERS = """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'TRDTYPE, usastate ,COMMODITY2,DISAGMOT'
  WHEN 1 THEN 'TRDTYPE,DEPE,Commodity2,DISAGMOT' ELSE 'TRDTYPE,USASTATE,DEPE,DISAGMOT' END AS header
FROM orders
"""


@query(
    "classify_view_by_header",
    f"""SELECT o_orderkey, 'dot' || CAST(CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 1 END
        AS VARCHAR) AS view FROM ({_HEADERS})""",
)
def classify_view_by_header(spark: SparkSession, d: str) -> DataFrame:
    headers = raw(spark, d, _HEADERS)
    return headers.select("o_orderkey", archives.classify_view(F.col("header")).alias("view"))


# --- series documents ------------------------------------------------------------

_OBSERVATIONS = f"""
SELECT event_type, {R.ymd("ts")} AS day,
  CASE WHEN count(*) % 5 = 0 THEN '.' WHEN count(*) % 7 = 0 THEN ''
       ELSE CAST(count(*) AS STRING) END AS value
FROM events GROUP BY 1, 2
"""


def series_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One document per event type and month: at most 31 observations each."""
    obs = raw(spark, d, _OBSERVATIONS)
    entry = F.struct(F.col("day").alias("date"), "value")
    docs = obs.groupBy("event_type", F.substring("day", 1, 7).alias("m")).agg(
        F.collect_list(entry).alias("observations")
    )
    return docs.select(
        F.col("event_type").alias("series_id"), F.to_json(F.struct("observations")).alias("payload")
    )


@query(
    "explode_observations",
    f"""SELECT event_type || '_' || day AS id,
        CASE WHEN event_type = 'click' THEN 'Clicks' ELSE event_type END AS indicator, day AS date,
        value AS value1, CASE WHEN event_type = 'click' THEN 'count' END AS units
        FROM ({_OBSERVATIONS}) WHERE value NOT IN ('.', '')""",
)
def explode_observations(spark: SparkSession, d: str) -> DataFrame:
    series = spark.createDataFrame(
        [("click", "Clicks", "web", "count")],
        "series_id string, title string, source string, units string",
    )
    rows = feeds.explode_observations(series_payloads(spark, d), series)
    return rows.select("id", "indicator", "date", "value1", "units")


_RATES = """
SELECT l_orderkey,
  CASE l_suppkey % 3 WHEN 0 THEN 'CNSHA' WHEN 1 THEN 'USLAX' ELSE 'NLRTM' END AS origin,
  CASE l_partkey % 3 WHEN 0 THEN 'USLAX' WHEN 1 THEN 'CNSHA' ELSE 'SGSIN' END AS destination,
  '40GP' AS container, l_linenumber,
  '{"rateUsd":' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING)
    || ',"publishedDate":"2024-01-0' || CAST(l_linenumber AS STRING) || '"}' AS rate
FROM lineitem
"""
_RATE_PAYLOADS = f"""
SELECT l_orderkey, origin, destination, container,
  CASE WHEN l_orderkey % 47 = 0 THEN '<html>blocked</html>'
       WHEN l_linenumber % 4 = 0 THEN '[' || rate || ',' || rate || ']'
       WHEN l_linenumber % 4 = 1 THEN '{{"data":[' || rate || ']}}'
       WHEN l_linenumber % 4 = 2 THEN '{{"results":[' || rate || ',' || rate || ']}}'
       ELSE rate END AS payload,
  CASE l_linenumber % 4 WHEN 0 THEN 2 WHEN 2 THEN 2 ELSE 1 END AS copies, rate, l_linenumber
FROM ({_RATES}) r
"""


@query(
    "unwrap_rate_payload",
    f"""
    SELECT "routeCode", route_description, "originPort", "destinationPort", "containerType",
      "rateUsd", "publishedDate" FROM (
      SELECT r.route_code AS "routeCode", r.description AS route_description,
        p.origin AS "originPort", p.destination AS "destinationPort",
        p.container AS "containerType", regexp_extract(p.rate, ':([0-9]+),', 1) AS "rateUsd",
        '2024-01-0' || CAST(p.l_linenumber AS VARCHAR) AS "publishedDate",
        unnest(range(p.copies)) AS copy
      FROM ({_RATE_PAYLOADS}) p
      JOIN (VALUES {_ROUTE_VALUES}) r(route_code, description, o, d)
        ON p.origin = r.o AND p.destination = r.d
      WHERE p.l_orderkey % 47 <> 0)
    """,
)
def unwrap_rate_payload(spark: SparkSession, d: str) -> DataFrame:
    payloads = raw(spark, d, _RATE_PAYLOADS).select("origin", "destination", "container", "payload")
    rates = feeds.unwrap_rate_payload(payloads, lookups.route_dimension(spark))
    return rates.select(
        "routeCode",
        "route_description",
        "originPort",
        "destinationPort",
        "containerType",
        "rateUsd",
        "publishedDate",
    )


@query(
    "failed_routes",
    f"""SELECT count(*) AS responses, count(*) FILTER (l_orderkey % 47 = 0) AS failed FROM ({_RATE_PAYLOADS})""",
)
def failed_routes(spark: SparkSession, d: str) -> DataFrame:
    payloads = raw(spark, d, _RATE_PAYLOADS)
    failed = feeds.check_routes(payloads)
    return feeds.failed_routes(payloads).where(F.col("failed") == failed)


# --- release pages ---------------------------------------------------------------

_PAGE_ROWS = """
SELECT o_orderdate AS day, r_regionkey AS region, o_orderpriority AS category,
  count(*) AS cars, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS ytd
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3
"""
_PAGE_REGION = (
    "CASE region WHEN 0 THEN 'US' WHEN 1 THEN 'Canada' WHEN 2 THEN 'Mexico' "
    "ELSE 'North America' END"
)
_PAGE_SQL = f"""
SELECT {_PAGE_REGION} AS region, CAST(1 + day(day) AS VARCHAR) AS week_number,
  CAST(year(day) AS VARCHAR) AS year, CAST(CAST(day AS DATE) AS VARCHAR) AS week_end_date,
  category, CAST(cars AS VARCHAR) AS this_week_cars, '-' || CAST(cars AS VARCHAR) || '.5%'
    AS this_week_yoy_pct, CAST(ytd AS VARCHAR) AS ytd_cars, CAST(cars * 1000 AS VARCHAR)
    AS ytd_avg_week_cars, '2.7%' AS ytd_yoy_pct
FROM ({_PAGE_ROWS}) WHERE region < 4
"""


def release_pages(spark: SparkSession, d: str) -> DataFrame:
    """One page per day and region with a record per priority, at most five."""
    rows = raw(spark, d, _PAGE_ROWS)
    title = (
        F.when(F.col("region") == 0, "U.S. Rail Traffic1")
        .when(F.col("region") == 1, "Canadian Rail Traffic")
        .when(F.col("region") == 2, "Mexican Rail Traffic2")
        .when(F.col("region") == 3, "North American Rail Traffic")
        .otherwise("Other Traffic")
    )
    record = F.concat_ws(
        "\n",
        "category",
        F.format_number("cars", 0),
        F.concat(F.lit("-"), F.col("cars").cast("string"), F.lit(".5%")),
        F.format_number("ytd", 0),
        F.format_number(F.col("cars") * 1000, 0),
        F.lit("2.7%"),
    )
    pages = rows.groupBy("day", "region").agg(
        F.array_join(F.array_sort(F.collect_list(record)), "\n").alias("body")
    )
    head = F.concat_ws(
        "\n",
        title,
        F.concat(
            F.lit("Week "),
            (F.dayofmonth("day") + 1).cast("string"),
            F.lit(", "),
            F.year("day").cast("string"),
            F.lit(" – Ended "),
            F.date_format("day", "MMMM d, yyyy"),
        ),
        F.lit("\nThis Week\nYear-To-Date\nCars\nvs 2025\nCumulative\nAvg/wk2\nvs 2025"),
        "body",
        F.lit("1 Excludes some operations.\nTrends, 2026 vs 2025\n"),
    )
    return pages.select(
        F.unix_date(F.col("day").cast("date")).cast("bigint").alias("doc_id"),
        F.least(F.col("region"), F.lit(3)).alias("page_no"),
        head.alias("text"),
    )


@query("parse_release_pages", _PAGE_SQL)
def parse_release_pages(spark: SparkSession, d: str) -> DataFrame:
    return releases.parse_release_pages(release_pages(spark, d)).drop("doc_id", "page_no")


@query(
    "norm_weekly_traffic",
    f"""
    SELECT 'aar_weekly' AS source, CAST(week_end_date AS DATE) AS snapshot_date, region,
      CAST(week_number AS BIGINT) AS week_number, CAST(year AS BIGINT) AS year, category,
      CAST(this_week_cars AS BIGINT) AS this_week_cars,
      {number_sql("rtrim(this_week_yoy_pct, '%')")} AS this_week_yoy_pct,
      CAST(ytd_cars AS BIGINT) AS ytd_cars, CAST(ytd_avg_week_cars AS BIGINT) AS ytd_avg_week_cars,
      2.7::DOUBLE AS ytd_yoy_pct
    FROM ({_PAGE_SQL})
    """,
)
def norm_weekly_traffic(spark: SparkSession, d: str) -> DataFrame:
    rows = releases.parse_release_pages(release_pages(spark, d))
    return drop_payload_columns(N.norm_weekly_traffic(rows))


@query(
    "extract_links",
    """
    WITH found AS (
      SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages
    ), long AS (
      SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) AS pos FROM found
    ), clean AS (
      SELECT page_id, split_part(replace(link, '&amp;', '&'), '?', 1) AS url, min(pos) AS pos
      FROM long GROUP BY 1, 2
    ), ranked AS (
      SELECT page_id, url, pos, row_number() OVER (PARTITION BY page_id ORDER BY
        contains(lower(url), 'the') DESC, pos) AS pick FROM clean
    )
    SELECT page_id, url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY
      CASE WHEN pick = 1 AND contains(lower(url), 'the') THEN 0 ELSE 1 END, pos) - 1 AS INTEGER) AS rank
    FROM ranked
    """,
)
def extract_links(spark: SparkSession, d: str) -> DataFrame:
    pages = raw(spark, d, "SELECT * FROM pages")
    return releases.extract_links(pages, (r'href="([^"]*)"',), prefer="the", suffix=None)


_RSS = """
SELECT o_orderkey AS feed_id,
  '<rss><channel><title>Weekly rail traffic feed</title><item><title>General news</title>'
  || '<link>https://x/general</link></item>'
  || CASE WHEN o_orderkey % 5 = 0 THEN '<item><title>Weekly Rail Traffic, no link</title></item>'
          ELSE '' END
  || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE
       '<item><title>Weekly Rail Traffic &amp; more ' || o_orderpriority || '</title>'
       || '<link>https://x/' || CAST(o_orderkey AS STRING) || '</link></item>' END
  || '<item><title>WEEKLY RAIL TRAFFIC old</title><link>https://x/old</link></item>'
  || '</channel></rss>' AS xml, o_orderpriority
FROM orders
"""


@query(
    "scan_feed_items",
    f"""SELECT feed_id, CASE WHEN feed_id % 3 = 0 THEN 'WEEKLY RAIL TRAFFIC old'
          ELSE 'Weekly Rail Traffic & more ' || o_orderpriority END AS title,
        CASE WHEN feed_id % 3 = 0 THEN 'https://x/old'
          ELSE 'https://x/' || CAST(feed_id AS VARCHAR) END AS link FROM ({_RSS})""",
)
def scan_feed_items(spark: SparkSession, d: str) -> DataFrame:
    return feeds.scan_feed_items(raw(spark, d, _RSS))
