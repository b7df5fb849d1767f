"""Queries for reports, filters, profiles and quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators import filters, profile, quality, report
from railyard.operators import normalize as N
from railyard.plans import profiles
from railyard.session import work_dir
from railyard.sinks import store
from workload import raw as R
from workload.normalising import (
    BORDER_SQL,
    CARS_SQL,
    INCIDENT_DATE_SQL,
    OCEAN_SQL,
    AS_OF,
    RUN,
    border,
    carloadings,
    iso_sql,
    number_sql,
    ocean,
)
from workload.registry import query, raw

runs = lambda spark, d: raw(spark, d, R.RUNS)


@query(
    "run_totals",
    f"""SELECT count(*) AS runs, count(*) FILTER (success) AS successful,
        count(*) FILTER (NOT success) AS failed,
        CAST(sum(total_records_written) AS BIGINT) AS records FROM ({R.RUNS})""",
)
def run_totals(spark: SparkSession, d: str) -> DataFrame:
    return report.run_totals(runs(spark, d))


@query(
    "runs_per_day",
    f"""SELECT CAST(started_at AS DATE) AS date, count(run_id) AS runs,
        CAST(coalesce(sum(total_records_written), 0) AS BIGINT) AS records
        FROM ({R.RUNS}) GROUP BY 1""",
)
def runs_per_day(spark: SparkSession, d: str) -> DataFrame:
    return report.runs_per_day(runs(spark, d))


@query(
    "recent_runs",
    f"""SELECT run_id, started_at, success, total_records_written, 0 AS sources_succeeded,
        0 AS sources_failed FROM ({R.RUNS}) ORDER BY started_at DESC, run_id DESC LIMIT 20""",
)
def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    lists = ["sources_succeeded", "sources_failed"]
    recent = report.recent_runs(runs(spark, d).withColumns({c: none for c in lists}))
    return recent.withColumns({c: F.size(c) for c in lists})


@query("carloads_by_railroad", f"SELECT railroad, sum(carloads) AS carloads FROM ({CARS_SQL}) GROUP BY 1")
def carloads_by_railroad(spark: SparkSession, d: str) -> DataFrame:
    return report.carloads_by_railroad(carloadings(spark, d))


@query(
    "top_commodities",
    f"""SELECT commodity, sum(carloads) AS carloads FROM ({CARS_SQL}) GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 15""",
)
def top_commodities(spark: SparkSession, d: str) -> DataFrame:
    return report.top_commodities(carloadings(spark, d))


@query(
    "carloads_trend",
    f"""SELECT snapshot_date, sum(carloads) AS total_carloads, count(carloads) AS record_count
        FROM ({CARS_SQL}) GROUP BY 1""",
)
def carloads_trend(spark: SparkSession, d: str) -> DataFrame:
    return report.carloads_trend(carloadings(spark, d))


@query("avg_rate_by_route", f"SELECT route_code, avg(rate_usd) AS rate_usd FROM ({OCEAN_SQL}) GROUP BY 1")
def avg_rate_by_route(spark: SparkSession, d: str) -> DataFrame:
    return report.avg_rate_by_route(ocean(spark, d))


@query(
    "lane_stats",
    f"""SELECT trade_lane, avg(rate_usd) AS mean, min(rate_usd) AS min, max(rate_usd) AS max
        FROM ({OCEAN_SQL}) GROUP BY 1""",
)
def lane_stats(spark: SparkSession, d: str) -> DataFrame:
    return report.lane_stats(ocean(spark, d))


@query(
    "rate_trend",
    f"""SELECT snapshot_date, route_code, avg(rate_usd) AS rate_usd FROM ({OCEAN_SQL})
        GROUP BY 1, 2""",
)
def rate_trend(spark: SparkSession, d: str) -> DataFrame:
    return report.rate_trend(ocean(spark, d))


@query(
    "value_by_mode",
    f"""SELECT mode, count(*) AS "rows", sum(value_usd) AS value_usd FROM ({BORDER_SQL})
        WHERE source_file = 'dot1' GROUP BY 1""",
)
def value_by_mode(spark: SparkSession, d: str) -> DataFrame:
    return report.value_by_mode(border(spark, d))


# --- filters ---------------------------------------------------------------------

_CAR_SUM = "count(*) AS \"rows\", sum(carloads) AS carloads"


def _car_sum(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum("carloads").alias("carloads"))


@query(
    "filter_in",
    f"""SELECT {_CAR_SUM} FROM ({CARS_SQL}) WHERE commodity IN ('BUILDING', 'MACHINERY')""",
)
def filter_in(spark: SparkSession, d: str) -> DataFrame:
    cars = filters.filter_in(carloadings(spark, d), "commodity", ["BUILDING", "MACHINERY"])
    return _car_sum(filters.filter_in(cars, "railroad", []))


@query(
    "filter_date_range",
    f"""SELECT {_CAR_SUM} FROM ({CARS_SQL})
        WHERE snapshot_date BETWEEN DATE '1996-03-01' AND DATE '1998-02-15'""",
)
def filter_date_range(spark: SparkSession, d: str) -> DataFrame:
    low, high = date(1996, 3, 1), date(1998, 2, 15)
    return _car_sum(filters.filter_date_range(carloadings(spark, d), "snapshot_date", low, high))


@query(
    "filter_snapshot",
    f"""SELECT count(*) AS "rows", min(railroad) AS first_railroad FROM ({R.CARLOADINGS})
        WHERE {iso_sql("date")} = DATE '1997-05-28'""",
)
def filter_snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.filter_snapshot(raw(spark, d, R.CARLOADINGS), date(1997, 5, 28))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.min("railroad").alias("first_railroad"))


@query(
    "filter_incident_date",
    f"""SELECT reportkey, incident_type FROM ({R.INCIDENTS})
        WHERE {INCIDENT_DATE_SQL} = DATE '1997-05-28'""",
)
def filter_incident_date(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.filter_incident_date(raw(spark, d, R.INCIDENTS), date(1997, 5, 28))
    return rows.select("reportkey", "incident_type")


@query(
    "drop_incomplete",
    f"""SELECT railroad, commodity, count(*) AS "rows" FROM ({R.CARLOADINGS})
        WHERE railroad IS NOT NULL AND commodity IS NOT NULL AND carloads IS NOT NULL
        GROUP BY 1, 2""",
)
def drop_incomplete(spark: SparkSession, d: str) -> DataFrame:
    needed = ["railroad", "commodity", "carloads"]
    rows = filters.drop_incomplete(raw(spark, d, R.CARLOADINGS), needed)
    return rows.groupBy("railroad", "commodity").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "quarantine",
    f"""
    WITH typed AS (
      SELECT {number_sql("VALUE")} AS v, {number_sql("SHIPWT")} AS w,
        TRY_CAST(MONTH AS BIGINT) AS m FROM ({R.BORDER})
    )
    SELECT CASE WHEN w < 0 THEN 'ship_weight_kg must be >= 0' ELSE '' END AS reason,
      count(*) AS "rows"
    FROM typed WHERE v IS NOT NULL AND m <= 12 GROUP BY 1
    """,
)
def quarantine(spark: SparkSession, d: str) -> DataFrame:
    rows = N.norm_transborder(raw(spark, d, R.BORDER), valid_only=False)
    good, bad = quality.quarantine(rows, "transborder_freight")
    both = good.select(F.lit("").alias("reason")).unionByName(
        bad.select(F.array_join("reject_reasons", "; ").alias("reason"))
    )
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "filter_option_defaults",
    f"""
    SELECT railroad, sum(carloads) AS carloads FROM ({CARS_SQL})
    WHERE railroad IN (SELECT DISTINCT railroad FROM ({CARS_SQL}) ORDER BY 1 LIMIT 3)
    GROUP BY 1
    """,
)
def filter_option_defaults(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.filter_option_defaults(carloadings(spark, d), "railroad", 3)
    return report.carloads_by_railroad(rows)


# --- profiles --------------------------------------------------------------------


def _profile_sql(table: str, columns: list[tuple[str, str, bool]]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count({c}) AS non_null,
            round_even((count(*) - count({c})) / count(*) * 100, 1) AS null_pct,
            {f'count(DISTINCT {c})' if counted else 'NULL'} AS "unique" FROM {table}"""
        for c, kind, counted in columns
    ]
    return " UNION ALL ".join(parts)


@query(
    "profile_columns",
    _profile_sql(
        f"({R.CENSUS})",
        [
            ("dot_number", "string", True),
            ("carrier_operation", "string", True),
            ("phy_state", "string", True),
            ("nbr_power_unit", "string", True),
            ("driver_total", "string", True),
            ("recent_mileage", "string", True),
            ("recent_mileage_year", "string", True),
            ("mcs150_date", "string", True),
            ("legal_name", "string", True),
        ],
    )
    + " UNION ALL "
    + _profile_sql(
        "lineitem",
        [
            ("l_orderkey", "bigint", False),
            ("l_partkey", "bigint", False),
            ("l_suppkey", "bigint", False),
            ("l_linenumber", "int", False),
            ("l_quantity", "double", False),
            ("l_extendedprice", "double", False),
            ("l_discount", "double", False),
            ("l_tax", "double", False),
            ("l_returnflag", "string", True),
            ("l_linestatus", "string", True),
            ("l_shipdate", "timestamp_ntz", False),
        ],
    ),
)
def profile_columns(spark: SparkSession, d: str) -> DataFrame:
    census = profile.profile_columns(raw(spark, d, R.CENSUS))
    lines = raw(spark, d, "SELECT * FROM lineitem")
    return census.unionByName(profile.profile_columns(lines))


_FEW = ["trade_type", "country", "mode", "source_file", "us_state", "value_usd"]


@query(
    "profile_stored",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS non_null,
            {f'count(DISTINCT {c})' if c != 'value_usd' else 'NULL'} AS "unique" FROM ({BORDER_SQL})"""
        for c in _FEW
    ),
)
def profile_stored(spark: SparkSession, d: str) -> DataFrame:
    """Kept facts of half the store, then of all of it; few distinct values are exact."""
    root = work_dir(spark, "profiles")
    rows = border(spark, d)
    store.write_day_partitions(rows.where("snapshot_date < DATE '1995-01-01'"), root, "transborder_freight")
    profiles.refresh_facts(spark, root, "transborder_freight")
    store.write_day_partitions(rows.where("snapshot_date >= DATE '1995-01-01'"), root, "transborder_freight")
    found = profiles.profile_stored(spark, root, "transborder_freight")
    return found.where(F.col("column").isin(_FEW)).select("column", "non_null", "unique")


_NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
            round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
            CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _NUMERIC
    ),
)
def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    stats = profile.describe_numeric(raw(spark, d, "SELECT * FROM lineitem"))
    digits = {"mean": 4, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return stats.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("table_shape", 'SELECT count(*) AS "rows", 11 AS columns FROM lineitem')
def table_shape(spark: SparkSession, d: str) -> DataFrame:
    return profile.table_shape(raw(spark, d, "SELECT * FROM lineitem"))


@query(
    "date_bounds",
    f"""SELECT min(snapshot_date) AS min_date, max(snapshot_date) AS max_date FROM ({CARS_SQL})""",
)
def date_bounds(spark: SparkSession, d: str) -> DataFrame:
    return profile.date_bounds(carloadings(spark, d))


@query(
    "ingest_counters",
    f"""SELECT count(*) AS records, count(*) FILTER (v IS NULL) AS dropped
        FROM (SELECT {number_sql("coalesce(carloads, volume, count)")} AS v FROM ({R.CARLOADINGS}))""",
)
def ingest_counters(spark: SparkSession, d: str) -> DataFrame:
    feed = raw(spark, d, R.CARLOADINGS)
    unusable = N.safe_float(F.coalesce("carloads", "volume", "count")).isNull()
    watched, seen = quality.ingest_counters(feed, "carloadings", unusable)
    watched.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(seen.get["records"], seen.get["dropped"])], "records bigint, dropped bigint"
    )


# --- samples and display ---------------------------------------------------------


@query("sample_rows", "SELECT least(count(*), 100) AS \"rows\" FROM lineitem")
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = report.sample_rows(raw(spark, d, "SELECT * FROM lineitem"), 100)
    return rows.agg(F.count(F.lit(1)).alias("rows"))


@query(
    "sample_rows_per_file",
    """SELECT least(count(*), 5) AS "rows", CAST(0 AS BIGINT) AS first_index,
        least(count(*), 5) - 1 AS last_index FROM lineitem""",
)
def sample_rows_per_file(spark: SparkSession, d: str) -> DataFrame:
    files = spark.read.parquet(f"{d}/lineitem.parquet")
    return (
        report.sample_rows_per_file(files, 5)
        .groupBy("file_path")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("row_index").alias("first_index"),
            F.max("row_index").alias("last_index"),
        )
        .drop("file_path")
    )


@query(
    "drop_payload_columns",
    f"SELECT railroad, sum(carloads) AS carloads FROM ({CARS_SQL}) GROUP BY 1",
)
def drop_payload_columns(spark: SparkSession, d: str) -> DataFrame:
    shown = report.drop_payload_columns(N.norm_carloadings(raw(spark, d, R.CARLOADINGS), AS_OF, RUN))
    assert "raw_record" not in shown.columns and "ingested_at" not in shown.columns
    return report.carloads_by_railroad(shown)
