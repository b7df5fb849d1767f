"""Queries for the normalising projections and the lookups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.operators import lookups
from railyard.operators import normalize as N
from railyard.operators.quality import ingest_counters
from railyard.operators.report import drop_payload_columns
from railyard.session import work_dir
from railyard.sources.cube import decode_jsonstat
from railyard.sources.fixed_width import slice_fixed_width
from workload import raw as R
from workload.registry import query, raw

AS_OF = date(2024, 6, 30)
RUN = date(2024, 6, 1)
RUN_SQL = "DATE '2024-06-01'"

_ISO = (
    "regexp_full_match({0}, '\\d{{4}}-\\d{{2}}-\\d{{2}}"
    "(T[0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]+)?)?Z?)?')"
)


def iso_sql(column: str) -> str:
    """ISO date parsing as SQL."""
    return f"CASE WHEN {_ISO.format(column)} THEN TRY_CAST(substr({column}, 1, 10) AS DATE) END"


def number_sql(column: str) -> str:
    """Float parsing as SQL."""
    return f"TRY_CAST(NULLIF(trim({column}), '') AS DOUBLE)"


BORDER_SQL = f"""
WITH raw AS ({R.BORDER}), typed AS (
  SELECT *, {number_sql("VALUE")} AS v, {number_sql("SHIPWT")} AS w,
    {number_sql("FREIGHT_CHARGES")} AS f, TRY_CAST(MONTH AS BIGINT) AS m,
    TRY_CAST(YEAR AS BIGINT) AS y FROM raw
)
SELECT 'bts_transborder' AS source,
  last_day(make_date(y, m, 1)) AS snapshot_date,
  CASE WHEN TRDTYPE = '1' THEN 'import' ELSE 'export' END AS trade_type,
  CASE trim(COUNTRY) WHEN '1220' THEN 'CA' WHEN '2010' THEN 'MX' ELSE trim(COUNTRY) END AS country,
  y AS year, m AS month,
  CASE trim(DISAGMOT) WHEN '1' THEN 'vessel' WHEN '3' THEN 'air' WHEN '4' THEN 'mail'
    WHEN '5' THEN 'truck' WHEN '6' THEN 'rail' WHEN '7' THEN 'pipeline' WHEN '8' THEN 'other'
    WHEN '9' THEN 'foreign_trade_zone' ELSE 'unknown' END AS mode,
  TRY_CAST(trim(DISAGMOT) AS BIGINT) AS disagg_mode, source_file,
  NULLIF(trim(USASTATE), '') AS us_state, NULLIF(trim(DEPE), '') AS district_port,
  NULLIF(trim(COMMODITY2), '') AS commodity_2digit,
  NULLIF(trim(CANPROV), '') AS canada_province, NULLIF(trim(MEXSTATE), '') AS mexico_state,
  v AS value_usd, w AS ship_weight_kg, f AS freight_charges_usd,
  coalesce(trim(CONTCODE) = '1', false) AS containerized, NULLIF(trim(DF), '') AS distribution_flag
FROM (SELECT * FROM typed WHERE m BETWEEN 1 AND 12 AND v >= 0)
WHERE coalesce(w, 0) >= 0 AND coalesce(f, 0) >= 0
"""


def border(spark: SparkSession, d: str) -> DataFrame:
    return N.norm_transborder(raw(spark, d, R.BORDER))


@query("norm_transborder", BORDER_SQL)
def norm_transborder(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(border(spark, d))


CARS_SQL = f"""
WITH raw AS ({R.CARLOADINGS}), typed AS (
  SELECT *, {number_sql("coalesce(carloads, volume, count)")} AS v, {iso_sql("date")} AS day FROM raw
)
SELECT 'usda_agtransport' AS source, coalesce(day, {RUN_SQL}) AS snapshot_date,
  coalesce(railroad, carrier, 'unknown') AS railroad,
  coalesce(commodity, commodity_desc, 'unknown') AS commodity,
  coalesce(NULLIF(type, ''), traffic_type) AS traffic_type, v AS carloads,
  coalesce(units, 'carloads') AS units, coalesce(origin, origin_region) AS origin_region,
  coalesce(destination, destination_region) AS destination_region
FROM typed WHERE v >= 0
"""


def carloadings(spark: SparkSession, d: str) -> DataFrame:
    return N.norm_carloadings(raw(spark, d, R.CARLOADINGS), AS_OF, RUN)


@query("norm_carloadings", CARS_SQL)
def norm_carloadings(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(carloadings(spark, d))


GRAIN_SQL = f"""
WITH raw AS ({R.GRAIN})
SELECT 'usda_agtransport' AS source, coalesce({iso_sql("date")}, {RUN_SQL}) AS snapshot_date,
  railroad, 'Grain' AS commodity, CAST(NULL AS VARCHAR) AS traffic_type,
  {number_sql("all_cars")} AS carloads, 'cars' AS units, state AS origin_region,
  CAST(NULL AS VARCHAR) AS destination_region
FROM raw WHERE railroad <> '' AND {number_sql("all_cars")} >= 0
"""


def grain_raw(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d, R.GRAIN).withColumnRenamed("all_cars", "all")


@query("norm_grain_carloads", GRAIN_SQL)
def norm_grain_carloads(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(N.norm_grain_carloads(grain_raw(spark, d), AS_OF, RUN))


METRICS_SQL = f"""
WITH raw AS ({R.METRICS}), typed AS (
  SELECT *, coalesce(NULLIF(measure, ''), NULLIF(metric_name, ''), metric) AS label,
    {number_sql("coalesce(value, metric_value)")} AS v,
    coalesce(NULLIF(railroad, ''), carrier) AS rr FROM raw
)
SELECT 'usda_agtransport' AS source, coalesce({iso_sql("date")}, {RUN_SQL}) AS snapshot_date,
  rr AS railroad,
  replace(lower(CASE WHEN contains(label, '(') THEN trim(split_part(label, '(', 1))
    ELSE label END), ' ', '_') AS metric_name,
  v AS metric_value,
  coalesce(NULLIF(unit, ''), CASE WHEN label LIKE '%(%)'
    THEN lower(trim(regexp_extract(label, '\\(([^)]*)\\)$', 1))) ELSE 'unknown' END) AS unit,
  region, coalesce(NULLIF(variable, ''), segment) AS segment
FROM typed WHERE label <> '' AND v IS NOT NULL AND rr <> ''
"""


@query("norm_service_metrics", METRICS_SQL)
def norm_service_metrics(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(N.norm_service_metrics(raw(spark, d, R.METRICS), AS_OF, RUN))


INDICATORS_SQL = f"""
WITH raw AS ({R.INDICATORS}), typed AS (
  SELECT *, {number_sql("value1")} AS v, {iso_sql("date")} AS day FROM raw
)
SELECT 'bts_freight_indicators' AS source, id AS external_id, day AS snapshot_date, indicator,
  measure1, measure2, v AS value, units, source AS underlying_source
FROM typed WHERE id IS NOT NULL AND indicator IS NOT NULL AND v IS NOT NULL AND day IS NOT NULL
"""


@query("norm_indicators", INDICATORS_SQL)
def norm_indicators(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(N.norm_indicators(raw(spark, d, R.INDICATORS)))


INCIDENT_DATE_SQL = (
    f"coalesce({iso_sql('date')}, TRY_CAST(year || '-' || coalesce(NULLIF(month, ''), "
    "accidentmonth) || '-' || NULLIF(day, '') AS DATE))"
)
INCIDENTS_SQL = f"""
WITH raw AS ({R.INCIDENTS}), typed AS (
  SELECT *, {INCIDENT_DATE_SQL} AS d,
    incident_type = 'train_accident' AS f54 FROM raw
), final AS (
  SELECT 'fra_safety' AS source, reportkey AS external_id, incident_type, d AS incident_date,
    coalesce(NULLIF(reportingrailroadcode, ''), railroadcode) AS railroad_code,
    coalesce(NULLIF(reportingrailroadname, ''), railroadname) AS railroad_name,
    statename AS state, countyname AS county,
    CASE WHEN f54 THEN accidenttype ELSE equipmentinvolved END AS category,
    CAST(trunc({number_sql("CASE WHEN f54 THEN totalkilledform54 ELSE totalkilledform57 END")})
      AS BIGINT) AS total_killed,
    CAST(trunc({number_sql("CASE WHEN f54 THEN totalinjuredform54 ELSE totalinjuredform57 END")})
      AS BIGINT) AS total_injured,
    {number_sql("CASE WHEN f54 THEN totaldamagecost ELSE vehicledamagecost END")} AS damage_cost_usd,
    {number_sql("latitude")} AS latitude, {number_sql("longitude")} AS longitude, narrative
  FROM typed WHERE reportkey IS NOT NULL AND d IS NOT NULL
)
SELECT * FROM final WHERE coalesce(total_killed, 0) >= 0 AND coalesce(total_injured, 0) >= 0
  AND coalesce(damage_cost_usd, 0) >= 0
"""


@query("norm_safety_incidents", INCIDENTS_SQL)
def norm_safety_incidents(spark: SparkSession, d: str) -> DataFrame:
    reports = raw(spark, d, R.INCIDENTS)
    return drop_payload_columns(N.norm_safety_incidents(reports, F.col("incident_type")))


TARIFFS_SQL = f"""
WITH raw AS ({R.TARIFFS})
SELECT 'usda_agtransport' AS source, coalesce({iso_sql("date")}, {RUN_SQL}) AS snapshot_date,
  railroad, commodity,
  CASE WHEN origin_state <> '' THEN origin_city || ', ' || origin_state ELSE origin_city END
    AS origin,
  destination_city || ', ' || destination_state AS destination,
  CASE WHEN tariff_car <> '' THEN CAST((_cents + _cents % 2) / 100 AS DECIMAL(12, 2)) END
    AS rate_per_car,
  CASE WHEN fsc_car <> 'none' THEN CAST(_size + 0.12 AS DECIMAL(10, 2)) END AS fuel_surcharge,
  'USD' AS currency, train_type AS movement_type
FROM raw
WHERE railroad <> '' AND commodity <> '' AND origin_city <> '' AND tariff_car <> '10000000000'
"""


@query("norm_tariffs", TARIFFS_SQL)
def norm_tariffs(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(N.norm_tariffs(raw(spark, d, R.TARIFFS), AS_OF, RUN))


_CENSUS_SHAPE = "^[0-9]{2}-[A-Za-z]{3}-[0-9]{2}$"
CENSUS_SQL = f"""
WITH raw AS ({R.CENSUS}), parts AS (
  SELECT *, regexp_matches(mcs150_date, '{_CENSUS_SHAPE}') AS shaped,
    TRY_CAST(right(mcs150_date, 2) AS INTEGER) AS yy,
    CASE upper(substr(mcs150_date, 4, 3)) WHEN 'JAN' THEN 1 WHEN 'FEB' THEN 2 WHEN 'APR' THEN 4
      WHEN 'OCT' THEN 10 WHEN 'DEC' THEN 12 END AS mon FROM raw
), typed AS (
  SELECT *, CASE WHEN shaped THEN TRY_CAST(
      CAST(CASE WHEN yy >= 69 THEN 1900 + yy ELSE 2000 + yy END AS VARCHAR) || '-' ||
      CAST(mon AS VARCHAR) || '-' || substr(mcs150_date, 1, 2) AS DATE) END AS day FROM parts
)
SELECT 'fmcsa_carrier_census' AS source, coalesce(day, {RUN_SQL}) AS snapshot_date, dot_number,
  carrier_operation, phy_state AS state,
  TRY_CAST(NULLIF(nbr_power_unit, '') AS BIGINT) AS power_units,
  TRY_CAST(NULLIF(driver_total, '') AS BIGINT) AS driver_count,
  TRY_CAST(NULLIF(recent_mileage, '') AS BIGINT) AS mileage,
  TRY_CAST(NULLIF(recent_mileage_year, '') AS BIGINT) AS mileage_year
FROM typed
WHERE dot_number <> '' AND TRY_CAST(driver_total AS BIGINT) >= 0
  AND TRY_CAST(recent_mileage AS BIGINT) >= 0
"""


@query("norm_carrier_census", CENSUS_SQL)
def norm_carrier_census(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(N.norm_carrier_census(raw(spark, d, R.CENSUS), AS_OF, RUN))


SAMPLE_YEAR = 2004


def _waybill_sql() -> str:
    from railyard.constants import waybill_fields

    def cut(start: int, end: int) -> str:
        return f"NULLIF(trim(substr(line, {start + 1}, {end - start})), '')"

    columns = []
    for name, start, end, kind in waybill_fields():
        if kind == "int":
            columns.append(f"CAST(trunc(TRY_CAST({cut(start, end)} AS DOUBLE)) AS BIGINT) AS {name}")
        elif kind == "float":
            columns.append(f"TRY_CAST({cut(start, end)} AS DOUBLE) AS {name}")
        elif kind == "text":
            columns.append(f"{cut(start, end)} AS {name}")
    states = ", ".join(
        cut(start, end) for _, start, end, kind in waybill_fields() if kind == "state"
    )
    return f"""
WITH raw AS ({R.WAYBILLS}), parts AS (
  SELECT *, TRY_CAST(substr(line, 5, 2) AS INTEGER) AS yy FROM raw WHERE length(line) >= 247
), dated AS (
  SELECT *, TRY_CAST(CAST(CASE WHEN abs(2000 + yy - {SAMPLE_YEAR}) <= abs(1900 + yy - {SAMPLE_YEAR})
      THEN 2000 + yy ELSE 1900 + yy END AS VARCHAR) || '-' || substr(line, 1, 2) || '-' ||
      substr(line, 3, 2) AS DATE) AS snapshot_date FROM parts
), final AS (
  SELECT 'stb_waybill' AS source, snapshot_date,
    substr(line, 7, 2) || '/' || substr(line, 9, 2) AS accounting_period,
    {cut(35, 40)} AS stcc, NULLIF(concat_ws(',', {states}), '') AS interchange_states,
    {", ".join(columns)}
  FROM dated
)
SELECT * FROM final
WHERE snapshot_date IS NOT NULL AND carloads >= 0 AND stcc IS NOT NULL
  AND coalesce(transit_charges, 0) >= 0
"""


@query("norm_waybills", _waybill_sql())
def norm_waybills(spark: SparkSession, d: str) -> DataFrame:
    lines = raw(spark, d, R.WAYBILLS)
    return drop_payload_columns(N.norm_waybills(slice_fixed_width(lines), SAMPLE_YEAR))


OCEAN_SQL = f"""
WITH raw AS ({R.OCEAN}), typed AS (
  SELECT *, {number_sql("coalesce(rateUsd, rate_usd, rate)")} AS v,
    coalesce(publishedDate, published_date) AS published FROM raw
)
SELECT 'freightos_fbx' AS source, coalesce({iso_sql("published")}, {RUN_SQL}) AS snapshot_date,
  coalesce(routeCode, route_code, 'unknown') AS route_code, route AS route_description,
  coalesce(originPort, 'unknown') AS origin_port,
  coalesce(destinationPort, destination_port, 'unknown') AS destination_port,
  coalesce(tradeRoute, trade_lane, 'unknown') AS trade_lane,
  coalesce(containerType, '40GP') AS container_type, v AS rate_usd, 'USD' AS currency,
  'per_container' AS rate_unit, region
FROM typed WHERE v >= 0
"""


def ocean(spark: SparkSession, d: str) -> DataFrame:
    return N.norm_ocean_rates(raw(spark, d, R.OCEAN), AS_OF, RUN)


@query("norm_ocean_rates", OCEAN_SQL)
def norm_ocean_rates(spark: SparkSession, d: str) -> DataFrame:
    return drop_payload_columns(ocean(spark, d))


_FEED_COUNTS_SQL = f"""
SELECT 'rail_carloadings' AS "table", count(*) AS "rows", sum(carloads) AS amount
FROM (SELECT carloads FROM ({CARS_SQL}) UNION ALL SELECT carloads FROM ({GRAIN_SQL}))
UNION ALL
SELECT 'rail_service_metrics', count(*), sum(metric_value) FROM ({METRICS_SQL})
UNION ALL
SELECT 'rail_tariff_rates', count(*), CAST(sum(rate_per_car) AS DOUBLE) FROM ({TARIFFS_SQL})
"""


@query("route_feeds_to_carloadings", _FEED_COUNTS_SQL)
def route_feeds_to_carloadings(spark: SparkSession, d: str) -> DataFrame:
    feeds = {
        "carloadings": raw(spark, d, R.CARLOADINGS),
        "grain_carloads": grain_raw(spark, d),
        "service_metrics": raw(spark, d, R.METRICS),
        "tariffs": raw(spark, d, R.TARIFFS).drop("_cents", "_size"),
    }
    tables = N.route_feeds_to_carloadings(feeds, AS_OF, RUN)
    amount = {
        "rail_carloadings": "carloads",
        "rail_service_metrics": "metric_value",
        "rail_tariff_rates": "rate_per_car",
    }
    parts = [
        tables[name].agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(column).cast("double").alias("amount"),
        )
        for name, column in amount.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "count_feeds",
    f"""
    SELECT 'carloadings' AS feed, (SELECT count(*) FROM ({R.CARLOADINGS})) AS raw, count(*) AS kept FROM ({CARS_SQL})
    UNION ALL SELECT 'service_metrics', (SELECT count(*) FROM ({R.METRICS})), count(*) FROM ({METRICS_SQL})
    UNION ALL SELECT 'tariffs', (SELECT count(*) FROM ({R.TARIFFS})), count(*) FROM ({TARIFFS_SQL})
    """,
)
def count_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows of each feed beside the rows kept, both counted by the pass that writes."""
    table_of = {
        "carloadings": "rail_carloadings",
        "service_metrics": "rail_service_metrics",
        "tariffs": "rail_tariff_rates",
    }
    feeds = {
        "carloadings": raw(spark, d, R.CARLOADINGS),
        "service_metrics": raw(spark, d, R.METRICS),
        "tariffs": raw(spark, d, R.TARIFFS).drop("_cents", "_size"),
    }
    counted, seen = N.count_feeds(feeds)
    tables = N.route_feeds_to_carloadings(counted, AS_OF, RUN)
    root, kept = work_dir(spark, "feeds"), {}
    for feed, name in table_of.items():
        watched, kept[feed] = ingest_counters(tables[name], name)
        watched.write.parquet(f"{root}/{name}")
    rows = [(f, seen[f].get["raw"], kept[f].get["records"]) for f in feeds]
    return spark.createDataFrame(rows, "feed string, raw bigint, kept bigint")


# --- the annual cube -------------------------------------------------------------


def cube_payloads(spark: SparkSession, d: str) -> DataFrame:
    """One cube per market segment: nations by years, order totals and order counts.

    Orders are summed to cells first, so a document gathers at most one entry per cell.
    """
    cells = raw(
        spark,
        d,
        """
        SELECT c_mktsegment AS segment, c_nationkey AS geo, year(o_orderdate) - 1990 AS yr,
               CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3
        """,
    )
    values = F.array(
        F.struct((F.col("geo") * 20 + F.col("yr")).alias("k"), F.col("total").alias("v")),
        F.struct(((25 + F.col("geo")) * 20 + F.col("yr")).alias("k"), F.col("n").alias("v")),
    )
    text = (
        F.when(F.col("v") % 7 == 0, F.lit('":"'))
        .when(F.col("v") % 11 == 0, F.lit("null"))
        .when(F.col("v") % 13 == 0, F.concat(F.lit('"'), "v", F.lit('"')))
        .otherwise(F.col("v").cast("string"))
    )
    entry = F.concat(F.lit('"'), "k", F.lit('":'), text)
    body = (
        cells.select("segment", F.inline(values))
        .select("segment", entry.alias("entry"))
        .groupBy("segment")
        .agg(F.array_join(F.array_sort(F.collect_list("entry")), ",").alias("body"))
    )

    def dimension(name: str, codes: list[str], labels: list[str]) -> str:
        index = ",".join(f'"{c}":{i}' for i, c in enumerate(codes))
        label = ",".join(f'"{c}":"{x}"' for c, x in zip(codes, labels, strict=False))
        return f'"{name}":{{"category":{{"index":{{{index}}},"label":{{{label}}}}}}}'

    geos = [f"N{i}" for i in range(25)]
    years = [str(1990 + i) for i in range(20)]
    head = ",".join(
        [
            dimension("freq", ["A"], ["Annual"]),
            dimension("unit", ["THS_T", "MIO_TKM"], ["tonnes", "tonne-km"]),
            dimension("geo", geos, [f"Nation {i}" for i in range(20)]),
            dimension("time", years, years),
        ]
    )
    doc = F.concat(F.lit('{"dimension":{' + head + '},"value":{'), "body", F.lit("}}"))
    return body.select("segment", doc.alias("payload"))


CUBE_SQL = """
WITH cells AS (
  SELECT c_mktsegment AS segment, c_nationkey AS geo, year(o_orderdate) AS yr,
         CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3
), long AS (
  SELECT segment, geo, yr, 'THS_T' AS unit, total AS v FROM cells
  UNION ALL SELECT segment, geo, yr, 'MIO_TKM', n FROM cells
)
SELECT segment, 'N' || CAST(geo AS VARCHAR) AS country_code,
  CASE WHEN geo < 20 THEN 'Nation ' || CAST(geo AS VARCHAR) END AS country_name,
  unit, CAST(yr AS VARCHAR) AS period, CAST(v AS DOUBLE) AS value
FROM long WHERE v % 7 <> 0 AND v % 11 <> 0 AND v % 13 <> 0
"""


@query("decode_jsonstat", CUBE_SQL)
def decode_cube(spark: SparkSession, d: str) -> DataFrame:
    return decode_jsonstat(cube_payloads(spark, d), keep=["segment"])


@query(
    "norm_eurostat",
    f"""
    SELECT 'eurostat' AS source, make_date(CAST(period AS BIGINT), 12, 31) AS snapshot_date,
      period, country_code, country_name, unit,
      CASE WHEN unit = 'THS_T' THEN 'rail_goods_tonnes' ELSE 'rail_goods_tonne_km' END AS metric,
      value
    FROM ({CUBE_SQL})
    """,
)
def norm_eurostat(spark: SparkSession, d: str) -> DataFrame:
    decoded = decode_jsonstat(cube_payloads(spark, d))
    return drop_payload_columns(N.norm_eurostat(decoded))


# --- lookups ---------------------------------------------------------------------


@query(
    "lookup_mode",
    f"""
    SELECT DISAGMOT, CASE trim(DISAGMOT) WHEN '1' THEN 'vessel' WHEN '3' THEN 'air'
      WHEN '4' THEN 'mail' WHEN '5' THEN 'truck' WHEN '6' THEN 'rail' WHEN '7' THEN 'pipeline'
      WHEN '8' THEN 'other' WHEN '9' THEN 'foreign_trade_zone' ELSE 'unknown' END AS mode,
      count(*) AS "rows"
    FROM ({R.BORDER}) GROUP BY ALL
    """,
)
def lookup_mode(spark: SparkSession, d: str) -> DataFrame:
    lines = raw(spark, d, R.BORDER)
    named = lookups.lookup_mode(lines, lookups.mode_dimension(spark))
    return named.groupBy("DISAGMOT", "mode").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "lookup_country",
    f"""
    SELECT COUNTRY, CASE trim(COUNTRY) WHEN '1220' THEN 'CA' WHEN '2010' THEN 'MX'
      ELSE trim(COUNTRY) END AS country_code, count(*) AS "rows"
    FROM ({R.BORDER}) GROUP BY ALL
    """,
)
def lookup_country(spark: SparkSession, d: str) -> DataFrame:
    lines = raw(spark, d, R.BORDER).withColumnRenamed("COUNTRY", "code_text")
    named = lookups.lookup_country(lines, lookups.country_dimension(spark), "code_text")
    return named.groupBy(
        F.col("code_text").alias("COUNTRY"), F.col("country").alias("country_code")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "lookup_geo_label",
    """
    SELECT c_custkey, 'N' || CAST(c_nationkey AS VARCHAR) AS country_code, n_name AS country_name
    FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey
                             WHERE r_name <> 'ASIA') x ON c_nationkey = n_nationkey
    """,
)
def lookup_geo_label(spark: SparkSession, d: str) -> DataFrame:
    codes = raw(
        spark,
        d,
        "SELECT c_custkey, 'N' || CAST(c_nationkey AS STRING) AS country_code FROM customer",
    )
    labels = raw(
        spark,
        d,
        "SELECT 'N' || CAST(n_nationkey AS STRING) AS code, n_name AS label "
        "FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'"
    )
    return lookups.lookup_geo_label(codes, labels)


_ROUTE_VALUES = ", ".join(
    "('{}', '{}', '{}', '{}')".format(*r) for r in lookups.OCEAN_ROUTES
)
PORTS = """
SELECT l_orderkey, l_linenumber,
  CASE l_suppkey % 5 WHEN 0 THEN 'CNSHA' WHEN 1 THEN 'USLAX' WHEN 2 THEN 'NLRTM'
    WHEN 3 THEN 'USNYC' ELSE 'USMIA' END AS origin,
  CASE l_partkey % 6 WHEN 0 THEN 'CNSHA' WHEN 1 THEN 'USLAX' WHEN 2 THEN 'NLRTM'
    WHEN 3 THEN 'USNYC' WHEN 4 THEN 'PAAUA' ELSE 'SGSIN' END AS destination
FROM lineitem
"""


@query(
    "enrich_routes",
    f"""
    SELECT p.*, route_code, description FROM ({PORTS}) p
    JOIN (VALUES {_ROUTE_VALUES}) r(route_code, description, o, d)
      ON p.origin = r.o AND p.destination = r.d
    """,
)
def enrich_routes(spark: SparkSession, d: str) -> DataFrame:
    return lookups.enrich_routes(raw(spark, d, PORTS), lookups.route_dimension(spark))


SERIES_KEYS = """
SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'FRGSHPUSM649NCIS' WHEN 1 THEN 'FRGEXPUSM649NCIS'
  WHEN 2 THEN 'TRUCKD11' ELSE 'OTHER' END AS series_id
FROM events
"""
_SERIES_VALUES = ", ".join(
    "('{}', '{}', '{}', '{}')".format(*r) for r in lookups.INDEX_SERIES
)


@query(
    "enrich_series",
    f"""
    SELECT event_id, k.series_id, coalesce(title, k.series_id) AS title, units, source
    FROM ({SERIES_KEYS}) k
    LEFT JOIN (VALUES {_SERIES_VALUES}) s(series_id, title, source, units)
      ON k.series_id = s.series_id
    """,
)
def enrich_series(spark: SparkSession, d: str) -> DataFrame:
    return lookups.enrich_series(raw(spark, d, SERIES_KEYS), lookups.series_dimension(spark))
