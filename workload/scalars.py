"""Queries for the column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard import functions as X
from workload import raw as R
from workload.normalising import INCIDENT_DATE_SQL, SAMPLE_YEAR, iso_sql, number_sql
from workload.registry import query, raw


def _counts(df: DataFrame, **columns: Column) -> DataFrame:
    """How often each combination of inputs and results occurs."""
    named = [c.alias(name) for name, c in columns.items()]
    return df.groupBy(*named).agg(F.count(F.lit(1)).alias("rows"))


def _sql(source: str, **columns: str) -> str:
    named = ", ".join(f'{sql} AS "{name}"' for name, sql in columns.items())
    return f'SELECT {named}, count(*) AS "rows" FROM ({source}) GROUP BY ALL'


def _register(name: str, source: str, spark_columns, sql_columns: dict[str, str]) -> None:
    @query(name, _sql(source, **sql_columns))
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _counts(raw(spark, d, source), **spark_columns())


c = F.col

_register(
    "parse_iso_date",
    R.CARLOADINGS,
    lambda: {"date": c("date"), "day": X.parse_iso_date(c("date"))},
    {"date": "date", "day": iso_sql("date")},
)
_register(
    "parse_fra_date",
    R.INCIDENTS,
    lambda: {
        "date": c("date"),
        "day": X.parse_fra_date(*[c(n) for n in ("date", "year", "month", "accidentmonth", "day")]),
    },
    {"date": "date", "day": INCIDENT_DATE_SQL},
)
_CENSUS_DAY = """CASE WHEN regexp_matches(mcs150_date, '^[0-9]{2}-[A-Za-z]{3}-[0-9]{2}$') THEN
  TRY_CAST(CAST(CASE WHEN CAST(right(mcs150_date, 2) AS INTEGER) >= 69
    THEN 1900 ELSE 2000 END + CAST(right(mcs150_date, 2) AS INTEGER) AS VARCHAR) || '-' ||
  CASE upper(substr(mcs150_date, 4, 3)) WHEN 'JAN' THEN '01' WHEN 'FEB' THEN '02'
    WHEN 'APR' THEN '04' WHEN 'OCT' THEN '10' WHEN 'DEC' THEN '12' END || '-' ||
  substr(mcs150_date, 1, 2) AS DATE) END"""
_register(
    "parse_dd_mon_yy",
    R.CENSUS,
    lambda: {"text": c("mcs150_date"), "day": X.parse_dd_mon_yy(c("mcs150_date"))},
    {"text": "mcs150_date", "day": _CENSUS_DAY},
)
_MMDDYY = f"SELECT substr(line, 1, 6) AS text FROM ({R.WAYBILLS}) z"
_YY = "CAST(substr(text, 5, 2) AS INTEGER)"
_register(
    "parse_mmddyy",
    _MMDDYY,
    lambda: {"text": c("text"), "day": X.parse_mmddyy(c("text"), SAMPLE_YEAR)},
    {
        "text": "text",
        "day": f"TRY_CAST(CAST({_YY} + CASE WHEN abs(2000 + {_YY} - {SAMPLE_YEAR}) <= "
        f"abs(1900 + {_YY} - {SAMPLE_YEAR}) THEN 2000 ELSE 1900 END AS VARCHAR) || '-' || "
        "substr(text, 1, 2) || '-' || substr(text, 3, 2) AS DATE)",
    },
)
_register(
    "month_end",
    R.BORDER,
    lambda: {
        "YEAR": c("YEAR"),
        "MONTH": c("MONTH"),
        "day": X.month_end(X.safe_int(c("YEAR")), X.safe_int(c("MONTH"))),
    },
    {
        "YEAR": "YEAR",
        "MONTH": "MONTH",
        "day": "CASE WHEN CAST(MONTH AS INTEGER) <= 12 THEN last_day(make_date(CAST(YEAR AS BIGINT), "
        "least(CAST(MONTH AS BIGINT), 12), 1)) END",
    },
)
_register(
    "year_end",
    R.BORDER,
    lambda: {"YEAR": c("YEAR"), "day": X.year_end(X.safe_int(c("YEAR")))},
    {"YEAR": "YEAR", "day": "make_date(CAST(YEAR AS BIGINT), 12, 31)"},
)
_register(
    "safe_int",
    R.INCIDENTS,
    lambda: {
        "text": c("totalinjuredform54"),
        "killed": X.safe_int(c("totalkilledform54")),
        "number": X.safe_int(c("totalinjuredform54")),
        "blank": X.safe_int(c("totalinjuredform57")),
    },
    {
        "text": "totalinjuredform54",
        "killed": "TRY_CAST(totalkilledform54 AS BIGINT)",
        "number": "CAST(trunc(CAST(totalinjuredform54 AS DOUBLE)) AS BIGINT)",
        "blank": "TRY_CAST(totalinjuredform57 AS BIGINT)",
    },
)
_register(
    "safe_float",
    R.METRICS,
    lambda: {"text": c("value"), "number": X.safe_float(c("value"))},
    {"text": "value", "number": number_sql("value")},
)
_register(
    "safe_decimal",
    R.TARIFFS,
    lambda: {"text": c("tariff_car"), "amount": X.safe_decimal(c("tariff_car"), 20, 2)},
    {
        "text": "tariff_car",
        "amount": "CASE WHEN tariff_car = '10000000000' THEN CAST(10000000000 AS DECIMAL(20, 2)) "
        "WHEN tariff_car <> '' THEN CAST((_cents + _cents % 2) / 100 AS DECIMAL(20, 2)) END",
    },
)
_PERCENTS = f"""
SELECT CASE WHEN l_orderkey % 17 = 0 THEN '%' WHEN l_orderkey % 19 = 0 THEN NULL
       WHEN l_linenumber = 1 THEN '-' || CAST({R.cents("l_tax")} AS STRING) || '.5 %'
       ELSE CAST({R.cents("l_discount")} AS STRING) || '%' END AS text FROM lineitem
"""
_register(
    "parse_percent",
    _PERCENTS,
    lambda: {"text": c("text"), "number": X.parse_percent(c("text"))},
    {"text": "text", "number": "TRY_CAST(NULLIF(trim(rtrim(text, '%')), '') AS DOUBLE)"},
)
_register(
    "extract_unit",
    R.METRICS,
    lambda: {
        "label": c("measure"),
        "unit": X.extract_unit(c("measure")),
        "other": X.extract_unit(c("metric_name")),
    },
    {
        "label": "measure",
        "unit": "CASE WHEN measure LIKE '%(%)' THEN lower(trim(regexp_extract(measure, "
        "'\\(([^)]*)\\)$', 1))) ELSE 'unknown' END",
        "other": "CASE WHEN metric_name LIKE '%(%)' THEN lower(trim(regexp_extract(metric_name, "
        "'\\(([^)]*)\\)$', 1))) ELSE 'unknown' END",
    },
)
_register(
    "slug_metric",
    R.METRICS,
    lambda: {
        "label": c("measure"),
        "slug": X.slug_metric(c("measure")),
        "other": X.slug_metric(c("metric_name")),
    },
    {
        "label": "measure",
        "slug": "replace(lower(trim(split_part(measure, '(', 1))), ' ', '_')",
        "other": "replace(lower(trim(split_part(metric_name, '(', 1))), ' ', '_')",
    },
)
_register(
    "first_not_null",
    R.CARLOADINGS,
    lambda: {
        "carloads": c("carloads"),
        "volume": c("volume"),
        "count": c("count"),
        "first": X.first_not_null(c("carloads"), c("volume"), c("count")),
    },
    {
        "carloads": "carloads",
        "volume": "volume",
        "count": '"count"',
        "first": 'CASE WHEN carloads IS NOT NULL THEN carloads WHEN volume IS NOT NULL THEN volume '
        'ELSE "count" END',
    },
)
_register(
    "first_truthy",
    R.METRICS,
    lambda: {
        "variable": c("variable"),
        "segment": c("segment"),
        "first": X.first_truthy(c("variable"), c("segment")),
    },
    {
        "variable": "variable",
        "segment": "segment",
        "first": "CASE WHEN variable <> '' THEN variable ELSE segment END",
    },
)
_register(
    "blank_to_null",
    R.BORDER,
    lambda: {"text": c("USASTATE"), "state": X.blank_to_null(c("USASTATE"))},
    {"text": "USASTATE", "state": "CASE WHEN trim(USASTATE) <> '' THEN trim(USASTATE) END"},
)
_PERIODS = """
SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN '12'
       ELSE lpad(CAST(month(l_shipdate) AS STRING), 2, '0')
         || right(CAST(year(l_shipdate) AS STRING), 2) END AS text FROM lineitem
"""
_register(
    "format_period",
    _PERIODS,
    lambda: {"text": c("text"), "period": X.format_period(c("text"))},
    {
        "text": "text",
        "period": "CASE WHEN length(text) = 4 THEN left(text, 2) || '/' || right(text, 2) "
        "ELSE coalesce(text, '') END",
    },
)
_STATES = f"""
SELECT substr(line, 108, 2) AS a, substr(line, 110, 2) AS b, substr(line, 112, 2) AS c
FROM ({R.WAYBILLS}) z
"""
_register(
    "join_nonblank",
    _STATES,
    lambda: {
        "a": c("a"),
        "b": c("b"),
        "c": c("c"),
        "joined": X.join_nonblank(c("a"), c("b"), c("c")),
    },
    {
        "a": "a",
        "b": "b",
        "c": "c",
        "joined": "NULLIF(concat_ws(',', NULLIF(trim(a), ''), NULLIF(trim(b), ''), "
        "NULLIF(trim(c), '')), '')",
    },
)
_register(
    "place_label",
    R.TARIFFS,
    lambda: {
        "city": c("origin_city"),
        "state": c("origin_state"),
        "label": X.place_label(c("origin_city"), c("origin_state")),
    },
    {
        "city": "origin_city",
        "state": "origin_state",
        "label": "CASE WHEN origin_state <> '' THEN origin_city || ', ' || origin_state "
        "ELSE origin_city END",
    },
)
_THOUSANDS = """
SELECT CASE WHEN length(n) > 6 THEN substr(n, 1, length(n) - 6) || ',' ELSE '' END ||
       substr(right('000000' || n, 6), 1, 3) || ',' || right('000000' || n, 3) AS text,
       right('000000' || n, CASE WHEN length(n) > 6 THEN length(n) ELSE 6 END) AS plain
FROM (SELECT CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) AS n FROM orders) z
"""
_register(
    "strip_thousands",
    _THOUSANDS,
    lambda: {"text": c("text"), "digits": X.strip_thousands(c("text"))},
    {"text": "text", "digits": "plain"},
)
_register(
    "raw_json",
    "SELECT n_name, r_name, CAST(n_nationkey AS STRING) AS code, c_mktsegment FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    lambda: {"record": X.raw_json("code", "n_name", "r_name", "c_mktsegment")},
    {
        "record": """'{"code":"' || code || '","n_name":"' || n_name || '","r_name":"' || r_name
          || '","c_mktsegment":"' || c_mktsegment || '"}'"""
    },
)
_register(
    "release_month",
    R.LINKS,
    lambda: {
        "url": c("url"),
        "year": X.release_month(c("url"))[0].cast("bigint"),
        "month": X.release_month(c("url"))[1].cast("bigint"),
    },
    {
        "url": "url",
        "year": "CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) END",
        "month": "CASE WHEN o_orderkey % 7 <> 0 THEN month(o_orderdate) END",
    },
)
_MEMBERS = """
SELECT CAST(year(o_orderdate) AS STRING) || '/M' || CAST(month(o_orderdate) AS STRING) || '/'
  || CASE o_orderkey % 4 WHEN 0 THEN 'dot1' WHEN 1 THEN 'Dot2' WHEN 2 THEN 'dot3' ELSE 'all' END
  || CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE '_ytd_'
       || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') END || '.csv' AS member,
  o_orderkey
FROM orders
"""
_register(
    "view_tag",
    _MEMBERS,
    lambda: {"member": c("member"), "tag": X.view_tag(c("member"))},
    {
        "member": "member",
        "tag": "CASE o_orderkey % 4 WHEN 0 THEN 'dot1' WHEN 1 THEN 'Dot2' WHEN 2 THEN 'dot3' "
        "ELSE 'all' END",
    },
)
_DATES = """
SELECT CAST(o_orderdate AS DATE) AS day,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS own
FROM orders
"""
_register(
    "partition_keys",
    _DATES,
    lambda: {
        k: v.cast("bigint")
        for k, v in zip(
            ("p_year", "p_month", "p_day"),
            X.partition_keys(c("own"), F.lit("2024-06-01").cast("date")),
            strict=True,
        )
    },
    {
        "p_year": "year(coalesce(own, DATE '2024-06-01'))",
        "p_month": "month(coalesce(own, DATE '2024-06-01'))",
        "p_day": "day(coalesce(own, DATE '2024-06-01'))",
    },
)
