"""Queries for the store: they write derived rows to the work folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators import dedup
from railyard.operators import normalize as N
from railyard.operators.report import run_totals
from railyard.schemas import RUN_SCHEMA
from railyard.session import leaf_folders, work_dir, write_note
from railyard.sinks import store
from railyard.sources import store_scan
from railyard.sources.cube import decode_jsonstat
from railyard.streaming.ingest import incremental_ingest
from workload import raw as R
from workload.normalising import (
    AS_OF,
    BORDER_SQL,
    CARS_SQL,
    CENSUS_SQL,
    CUBE_SQL,
    GRAIN_SQL,
    INDICATORS_SQL,
    OCEAN_SQL,
    RUN,
    border,
    carloadings,
    cube_payloads,
    grain_raw,
    ocean,
)
from workload.registry import query, raw

_DAY_SQL = """
SELECT snapshot_date, count(*) AS "rows", sum(value_usd) AS value_usd, min("year") AS first_year
FROM ({0}) GROUP BY 1
"""


def _per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("value_usd").alias("value_usd"),
        F.min("year").alias("first_year"),
    )


@query(
    "write_day_partitions",
    f"""
    WITH all_rows AS ({BORDER_SQL}), again AS (
      SELECT * FROM all_rows WHERE trade_type = 'import')
    SELECT snapshot_date, count(*) AS "rows", sum(value_usd) AS value_usd,
      min("year") AS first_year
    FROM (SELECT * FROM again UNION ALL SELECT * FROM all_rows
          WHERE snapshot_date NOT IN (SELECT snapshot_date FROM again)) GROUP BY 1
    """,
)
def write_day_partitions(spark: SparkSession, d: str) -> DataFrame:
    """A second write of some rows replaces the days it touches and no others."""
    root = work_dir(spark, "days")
    rows = border(spark, d)
    store.write_day_partitions(rows, root, "transborder_freight")
    again = rows.where("trade_type = 'import'")
    store.write_day_partitions(again, root, "transborder_freight")
    return _per_day(store_scan.scan_table(spark, root, "transborder_freight"))


@query("scan_table", _DAY_SQL.format(BORDER_SQL))
def scan_table(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "scan")
    store.write_day_partitions(border(spark, d), root, "transborder_freight")
    return _per_day(store_scan.scan_table(spark, root, "transborder_freight"))


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


def _census(spark: SparkSession, d: str, stamp: str) -> DataFrame:
    return N.norm_carrier_census(raw(spark, d, R.CENSUS), AS_OF, RUN, _stamp(stamp))


@query(
    "merge_year_partitions",
    f"""
    SELECT year(snapshot_date) AS "year", ingested_at, count(*) AS "rows",
      CAST(sum(mileage) AS BIGINT) AS mileage
    FROM (
      SELECT snapshot_date, mileage,
        CASE WHEN driver_count < 30 THEN TIMESTAMP '2024-05-02' ELSE TIMESTAMP '2024-05-01' END
          AS ingested_at FROM ({CENSUS_SQL})
      UNION ALL SELECT snapshot_date, mileage + 1, TIMESTAMP '2024-05-02'
      FROM ({CENSUS_SQL}) WHERE driver_count < 10
    ) GROUP BY 1, 2
    """,
)
def merge_year_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Half of the rows come again, some changed: copies merge, changed rows are added."""
    root = work_dir(spark, "years")
    store.merge_year_partitions(spark, _census(spark, d, "2024-05-01"), root, "motor_carrier_census")
    later = _census(spark, d, "2024-05-02")
    changed = later.where("driver_count < 10").withColumn("mileage", F.col("mileage") + 1)
    second = later.where("driver_count < 30").unionByName(changed)
    store.merge_year_partitions(spark, second, root, "motor_carrier_census")
    rows = store_scan.scan_table(spark, root, "motor_carrier_census")
    return rows.groupBy(F.year("snapshot_date").cast("bigint").alias("year"), "ingested_at").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("mileage").alias("mileage")
    )


@query(
    "write_csv_copy",
    f"""SELECT trade_type, country, count(*) AS "rows", sum(value_usd) AS value_usd
        FROM ({BORDER_SQL}) GROUP BY 1, 2""",
)
def write_csv_copy(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "csv")
    store.write_csv_copy(border(spark, d), root, "transborder_freight")
    kinds = {"value_usd": "double"}
    columns = store_scan.table("transborder_freight").columns
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)
    copy = spark.read.schema(schema).option("header", "true")
    return copy.csv(store.csv_path(root, "transborder_freight")).groupBy(
        "trade_type", "country"
    ).agg(F.count(F.lit(1)).alias("rows"), F.sum("value_usd").alias("value_usd"))


def _run_documents(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    runs = raw(spark, d, R.RUNS).withColumn("finished_at", F.col("started_at"))
    lists = [c for c in RUN_SCHEMA.names if c not in runs.columns]
    return runs.withColumns({c: none for c in lists}).select(*RUN_SCHEMA.names)


_RUNS_SQL = f"""
SELECT count(*) + {{0}} AS runs, count(*) FILTER (success) + {{0}} AS successful,
  count(*) FILTER (NOT success) AS failed,
  CAST(sum(total_records_written) + {{0}} * 7 AS BIGINT) AS records FROM ({R.RUNS})
"""


@query("scan_run_summaries", _RUNS_SQL.format(0))
def scan_run_summaries(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "runs")
    store.append_run_summaries(_run_documents(spark, d), root)
    return run_totals(store_scan.scan_run_summaries(spark, root))


@query("write_run_summary", _RUNS_SQL.format(1))
def write_run_summary(spark: SparkSession, d: str) -> DataFrame:
    root = work_dir(spark, "runs")
    store.append_run_summaries(_run_documents(spark, d), root)
    one = {"run_id": "run_x", "success": True, "total_records_written": 7, "errors": []}
    store.write_run_summary(spark, one, root)
    return run_totals(store_scan.scan_run_summaries(spark, root))


def _two_tables(spark: SparkSession, d: str, label: str) -> str:
    root = work_dir(spark, label)
    store.write_day_partitions(border(spark, d), root, "transborder_freight")
    cubes = N.norm_eurostat(decode_jsonstat(cube_payloads(spark, d)))
    store.write_day_partitions(cubes, root, "rail_eurostat_freight")
    return root


@query(
    "list_tables",
    "SELECT unnest(['rail_eurostat_freight', 'transborder_freight']) AS \"table\"",
)
def list_tables(spark: SparkSession, d: str) -> DataFrame:
    return store_scan.list_tables(spark, _two_tables(spark, d, "list"))


_INVENTORY_SQL = f"""
SELECT 'transborder_freight' AS "table", count(*) AS "rows" FROM ({BORDER_SQL})
UNION ALL SELECT 'rail_eurostat_freight', count(*) FROM ({CUBE_SQL})
"""


@query("store_inventory", _INVENTORY_SQL)
def store_inventory(spark: SparkSession, d: str) -> DataFrame:
    return store.store_inventory(spark, _two_tables(spark, d, "inventory")).where("rows > 0")


@query(
    "scan_with_ledger",
    f"""
    SELECT 'readable rows' AS what, count(*) AS n FROM ({BORDER_SQL})
    UNION ALL SELECT 'unreadable transborder_freight', count(DISTINCT snapshot_date) FROM ({BORDER_SQL})
    WHERE year(snapshot_date) = 1995
    UNION ALL SELECT 'unreadable pipeline_runs', 2
    """,
)
def scan_with_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Every day of one year gets a damaged file, and two run documents are none."""
    root = work_dir(spark, "ledger")
    store.write_day_partitions(border(spark, d), root, "transborder_freight")
    path = store_scan.table_path(root, "transborder_freight")
    for folder in leaf_folders(spark, path, 3):
        if folder.startswith("p_year=1995/"):
            write_note(spark, f"{path}/{folder}/part-damaged.parquet", "PAR1 cut off")
    store.write_run_summary(spark, {"run_id": "run_y", "success": True}, root)
    write_note(spark, f"{root}/pipeline_runs/cut.json", '{"run_id": "run_z", "succ')
    write_note(spark, f"{root}/pipeline_runs/other.json", '{"name": "no run"}')
    rows, _ = store_scan.scan_with_ledger(spark, root, "transborder_freight")
    ledger = store_scan.unreadable_files(spark, root)
    n = F.count(F.lit(1)).alias("n")
    lost = ledger.groupBy(F.concat(F.lit("unreadable "), F.col("table")).alias("what")).agg(n)
    return rows.agg(n).select(F.lit("readable rows").alias("what"), "n").unionByName(lost)


_EXPORT_SQL = f"""
SELECT 'transborder_freight' AS "table", count(*) AS "rows" FROM (SELECT DISTINCT * FROM ({BORDER_SQL}))
"""


@query("export_compacted", _EXPORT_SQL)
def export_compacted(spark: SparkSession, d: str) -> DataFrame:
    """Rows stored without their raw text, so that equal reports are equal rows."""
    root, out = work_dir(spark, "store"), work_dir(spark, "export")
    rows = border(spark, d).withColumn("raw_record", F.lit(None).cast("string"))
    store.write_day_partitions(rows, root, "transborder_freight")
    stats = store.export_compacted(spark, root, out, ["transborder_freight", "rail_tariff_rates"])
    return stats.select("table", "rows")


@query(
    "export_stats",
    f"""
    SELECT 'rail_carloadings' AS "table", count(*) AS "rows", true AS has_bytes FROM ({CARS_SQL})
    UNION ALL SELECT 'ocean_freight_rates', count(*), true FROM ({OCEAN_SQL})
    """,
)
def export_stats(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "stats")
    carloadings(spark, d).write.parquet(f"{out}/rail_carloadings")
    ocean(spark, d).write.parquet(f"{out}/ocean_freight_rates")
    stats = store.export_stats(spark, out, ["rail_carloadings", "ocean_freight_rates"])
    return stats.select("table", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "route_records",
    f"""
    SELECT 'rail_carloadings' AS "table", count(*) AS "rows" FROM ({CARS_SQL})
    UNION ALL SELECT 'ocean_freight_rates', count(*) FROM ({OCEAN_SQL})
    """,
)
def route_records(spark: SparkSession, d: str) -> DataFrame:
    mixed = dedup.union_all(
        carloadings(spark, d).withColumn("record_type", F.lit("rail_carloadings")),
        ocean(spark, d).withColumn("record_type", F.lit("ocean_freight_rates")),
        carloadings(spark, d).withColumn("record_type", F.lit("unheard_of")),
    )
    routed = store.route_records(mixed)
    counts = [
        routed[name].agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        for name in ("rail_carloadings", "ocean_freight_rates")
    ]
    return counts[0].unionByName(counts[1])


# --- duplicates and unions -------------------------------------------------------


@query(
    "dedup_keep_latest",
    f"""SELECT event_type, user_id, props, value, max(ingested_at) AS ingested_at
        FROM ({R.BATCHES}) GROUP BY 1, 2, 3, 4""",
)
def dedup_keep_latest(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_keep_latest(raw(spark, d, R.BATCHES))


@query("dedup_full_row", f"SELECT DISTINCT * FROM ({R.BATCHES})")
def dedup_full_row(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_full_row(raw(spark, d, R.BATCHES))


@query(
    "union_all",
    f"""SELECT commodity, count(*) AS "rows", sum(carloads) AS carloads
        FROM (SELECT commodity, carloads FROM ({CARS_SQL}) UNION ALL
              SELECT commodity, carloads FROM ({GRAIN_SQL})) GROUP BY 1""",
)
def union_all(spark: SparkSession, d: str) -> DataFrame:
    both = dedup.union_all(
        carloadings(spark, d), N.norm_grain_carloads(grain_raw(spark, d), AS_OF, RUN)
    )
    return both.groupBy("commodity").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("carloads").alias("carloads")
    )


@query(
    "union_distinct",
    f"""SELECT railroad, commodity FROM ({CARS_SQL}) UNION
        SELECT railroad, commodity FROM ({GRAIN_SQL})""",
)
def union_distinct(spark: SparkSession, d: str) -> DataFrame:
    grain = N.norm_grain_carloads(grain_raw(spark, d), AS_OF, RUN)
    return dedup.union_distinct(
        carloadings(spark, d).select("railroad", "commodity"), grain.select("railroad", "commodity")
    )


@query(
    "incremental_ingest",
    f"""SELECT source, snapshot_date, count(*) AS "rows", sum(value) AS value
        FROM ({INDICATORS_SQL}) GROUP BY 1, 2""",
)
def incremental_ingest_query(spark: SparkSession, d: str) -> DataFrame:
    """Files land in two rounds; each is loaded once and days stay whole."""
    landing, root, check = (work_dir(spark, x) for x in ("landing", "stream", "check"))
    feed = raw(spark, d, R.INDICATORS)
    schema = feed.schema

    def load() -> int:
        stamp = F.current_timestamp()
        return incremental_ingest(
            spark,
            landing,
            schema,
            lambda batch: N.norm_indicators(batch, ingested_at=stamp),
            root,
            "freight_indicators",
            check,
        )

    feed.where("units = 'Hours' AND value1 >= '5'").write.mode("append").parquet(landing)
    load()
    feed.where("NOT (units = 'Hours' AND value1 >= '5')").write.mode("append").parquet(landing)
    load()
    rows = store_scan.scan_table(spark, root, "freight_indicators")
    return rows.groupBy("source", "snapshot_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("value")
    )
