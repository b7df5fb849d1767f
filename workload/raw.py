"""Raw-shape views of the given tables.

Each statement projects a whole table into the all-text shape of one feed, with dirty
values mixed in, in SQL that Spark and DuckDB read alike.  Numbers are written from
integers because the engines print large doubles differently.
"""

from __future__ import annotations


def ymd(ts: str) -> str:
    return (
        f"CAST(year({ts}) AS STRING) || '-' || lpad(CAST(month({ts}) AS STRING), 2, '0') "
        f"|| '-' || lpad(CAST(day({ts}) AS STRING), 2, '0')"
    )


def loose_ymd(ts: str) -> str:
    return (
        f"CAST(year({ts}) AS STRING) || '-' || CAST(month({ts}) AS STRING) "
        f"|| '-' || CAST(day({ts}) AS STRING)"
    )


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


BORDER = f"""
SELECT
  CAST(1 + l_linenumber % 2 AS STRING) AS TRDTYPE,
  CASE WHEN l_partkey % 5 = 0 THEN '  '
       ELSE ' S' || CAST(l_suppkey % 50 AS STRING) END AS USASTATE,
  CASE WHEN l_orderkey % 3 <> 1 THEN lpad(CAST(l_partkey % 9999 AS STRING), 4, '0') END AS DEPE,
  CASE WHEN l_orderkey % 3 <> 0 THEN lpad(CAST(l_suppkey % 99 AS STRING), 2, '0') END AS COMMODITY2,
  CASE WHEN l_partkey % 11 = 10 THEN ' 5 ' ELSE CAST(l_partkey % 11 AS STRING) END AS DISAGMOT,
  CASE WHEN l_linenumber % 4 = 1 THEN 'MX' ELSE '' END AS MEXSTATE,
  CASE WHEN l_linenumber % 2 = 0 THEN 'XO ' END AS CANPROV,
  CASE l_linenumber % 4 WHEN 0 THEN '1220' WHEN 1 THEN '2010' WHEN 2 THEN ' 1220'
       ELSE '5700' END AS COUNTRY,
  CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 59 = 0 THEN 'n/a'
       ELSE CAST({cents("l_extendedprice")} AS STRING) END AS VALUE,
  CASE WHEN l_orderkey % 41 = 0 THEN '-5' WHEN l_orderkey % 43 = 0 THEN ''
       ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) || '.5' END AS SHIPWT,
  CAST({cents("l_discount")} AS STRING) AS FREIGHT_CHARGES,
  CASE WHEN l_returnflag = 'A' THEN ' 1' ELSE l_returnflag END AS DF,
  CASE l_linenumber % 3 WHEN 0 THEN '1' WHEN 1 THEN 'X' ELSE '' END AS CONTCODE,
  CASE WHEN l_orderkey % 53 = 0 THEN '13'
       ELSE lpad(CAST(month(l_shipdate) AS STRING), 2, '0') END AS MONTH,
  CAST(year(l_shipdate) AS STRING) AS YEAR,
  'dot' || CAST(1 + l_orderkey % 3 AS STRING) AS source_file
FROM lineitem
"""

CARLOADINGS = f"""
SELECT
  CASE WHEN o_orderkey % 29 = 0 THEN NULL
       WHEN o_orderkey % 31 = 0 THEN {loose_ymd("o_orderdate")}
       WHEN o_orderkey % 2 = 0 THEN {ymd("o_orderdate")}
       ELSE {ymd("o_orderdate")} || 'T00:00:00.000' END AS date,
  CASE WHEN o_orderkey % 5 <> 0 THEN n_name END AS railroad,
  CASE WHEN o_orderkey % 61 <> 0 THEN n_name END AS carrier,
  CASE WHEN o_orderkey % 7 <> 0 THEN c_mktsegment END AS commodity,
  CASE WHEN o_orderkey % 77 <> 0 THEN c_mktsegment END AS commodity_desc,
  CASE o_orderstatus WHEN 'O' THEN '' WHEN 'F' THEN 'Originated' END AS type,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'Received' END AS traffic_type,
  CASE WHEN o_orderkey % 3 = 0 THEN o_cars END AS carloads,
  CASE WHEN o_orderkey % 3 = 1 THEN o_cars END AS volume,
  CASE WHEN o_orderkey % 3 = 2 THEN o_cars END AS count,
  CASE WHEN o_orderkey % 6 = 0 THEN 'cars' END AS units,
  CASE WHEN o_orderkey % 8 = 0 THEN 'Plains' END AS origin,
  o_orderpriority AS origin_region,
  CAST(NULL AS STRING) AS destination,
  o_orderstatus AS destination_region
FROM (
  SELECT *, CASE WHEN o_orderkey % 43 = 0 THEN '0' WHEN o_orderkey % 47 = 0 THEN 'bad'
                 WHEN o_orderkey % 67 = 0 THEN '-1' WHEN o_orderkey % 71 = 0 THEN NULL
                 WHEN o_orderkey % 13 = 0
                   THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '.5'
                 ELSE CAST({cents("o_totalprice")} AS STRING) END AS o_cars
  FROM orders
) o
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
"""

GRAIN = f"""
SELECT
  CASE WHEN o_orderkey % 29 = 0 THEN 'soon' ELSE {ymd("o_orderdate")} END AS date,
  CASE WHEN o_custkey % 17 = 0 THEN '' WHEN o_custkey % 19 = 0 THEN NULL
       ELSE 'RR' || CAST(o_custkey % 7 AS STRING) END AS railroad,
  o_orderstatus AS state,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '0'
       ELSE CAST({cents("o_totalprice")} AS STRING) END AS all_cars
FROM orders
"""

METRICS = f"""
SELECT
  CASE event_id % 4 WHEN 0 THEN 'Average ' || event_type || ' Speed (Mph)'
       WHEN 1 THEN '' WHEN 2 THEN event_type || ' (Cars)' ELSE NULL END AS measure,
  CASE WHEN event_id % 8 = 1 THEN 'Terminal Dwell ( Hours )'
       WHEN event_id % 8 = 5 THEN 'Cars On Line' END AS metric_name,
  CASE WHEN event_id % 8 = 3 THEN event_type END AS metric,
  CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN '1e3' WHEN 2 THEN '1d' WHEN 3 THEN NULL
       WHEN 4 THEN ' 12 ' ELSE CAST({cents("value")} AS STRING) END AS value,
  CASE WHEN event_id % 13 = 3 AND event_id % 2 = 0 THEN '7' END AS metric_value,
  CASE WHEN user_id % 5 = 0 THEN '' ELSE 'R' || CAST(user_id % 7 AS STRING) END AS railroad,
  CASE WHEN user_id % 10 = 0 THEN 'ALT' END AS carrier,
  CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE {ymd("ts")} END AS date,
  CASE WHEN event_id % 6 = 0 THEN 'given' WHEN event_id % 6 = 1 THEN '' END AS unit,
  event_type AS region,
  CASE WHEN event_id % 3 = 0 THEN 'Coal' ELSE '' END AS variable,
  CASE WHEN event_id % 9 <> 0 THEN 'Grain' END AS segment
FROM events
"""

INDICATORS = f"""
SELECT
  CASE WHEN event_id % 19 <> 0 THEN 'E' || CAST(event_id AS STRING) END AS id,
  CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN {loose_ymd("ts")}
       ELSE {ymd("ts")} || 'T06:30' END AS date,
  CASE WHEN event_id % 31 <> 0 THEN event_type END AS indicator,
  CAST(user_id AS STRING) AS measure1,
  CAST(NULL AS STRING) AS measure2,
  CASE event_id % 11 WHEN 0 THEN '.' WHEN 1 THEN '' WHEN 2 THEN '2.5e2'
       WHEN 3 THEN '-4' ELSE CAST({cents("value")} AS STRING) END AS value1,
  'Hours' AS units,
  'provider ' || event_type AS source
FROM events
"""

TARIFFS = f"""
SELECT
  CASE WHEN p_partkey % 9 = 0 THEN 'unknown' ELSE '2024-0' || CAST(1 + p_partkey % 9 AS STRING)
       || '-01' END AS date,
  p_brand AS railroad,
  CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS commodity,
  CASE WHEN p_partkey % 13 = 0 THEN '' ELSE p_name END AS origin_city,
  CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'NE' END AS origin_state,
  'City' || CAST(p_size AS STRING) AS destination_city,
  'OR' AS destination_state,
  CASE WHEN p_partkey % 7 = 0 THEN 'shuttle' END AS train_type,
  CASE WHEN p_partkey % 37 = 0 THEN '' WHEN p_partkey % 41 = 0 THEN '10000000000'
       ELSE substr(p_cents, 1, length(p_cents) - 2) || '.' || right(p_cents, 2) || '5' END
    AS tariff_car,
  CASE WHEN p_partkey % 43 = 0 THEN 'none'
       ELSE CAST(p_size AS STRING) || '.125' END AS fsc_car,
  CAST(p_cents AS BIGINT) AS _cents,
  p_size AS _size
FROM (SELECT *, CAST({cents("p_retailprice")} AS STRING) AS p_cents FROM part) p
"""

INCIDENTS = f"""
SELECT
  CASE WHEN o_orderkey % 2 = 0 THEN 'train_accident' ELSE 'highway_rail_crossing' END
    AS incident_type,
  CASE WHEN o_orderkey % 31 <> 0 THEN 'K' || CAST(o_orderkey AS STRING) END AS reportkey,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {ymd("o_orderdate")} || 'T00:00:00.000' END AS date,
  CAST(year(o_orderdate) AS STRING) AS year,
  CASE WHEN o_orderkey % 2 = 1 THEN CAST(month(o_orderdate) AS STRING) END AS month,
  CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(month(o_orderdate) AS STRING), 2, '0') END
    AS accidentmonth,
  CASE WHEN o_orderkey % 47 = 0 THEN '32' WHEN o_orderkey % 53 = 0 THEN ''
       ELSE CAST(day(o_orderdate) AS STRING) END AS day,
  CASE WHEN o_custkey % 4 <> 0 THEN 'C' || CAST(o_custkey % 9 AS STRING) ELSE '' END
    AS reportingrailroadcode,
  'P' || CAST(o_custkey % 9 AS STRING) AS railroadcode,
  CAST(NULL AS STRING) AS reportingrailroadname,
  'Road ' || CAST(o_custkey % 9 AS STRING) AS railroadname,
  o_orderstatus AS statename,
  o_orderpriority AS countyname,
  'Derailment' AS accidenttype,
  'Truck' AS equipmentinvolved,
  CASE WHEN o_orderkey % 59 = 0 THEN '-1' ELSE CAST(o_orderkey % 3 AS STRING) END
    AS totalkilledform54,
  CAST(o_orderkey % 5 AS STRING) || '.9' AS totalinjuredform54,
  CAST(o_orderkey % 2 AS STRING) AS totalkilledform57,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 4 AS STRING) END
    AS totalinjuredform57,
  CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS totaldamagecost,
  CASE WHEN o_orderkey % 9 = 0 THEN 'unknown'
       ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '.25' END AS vehicledamagecost,
  '41.5' AS latitude,
  '-' || CAST(o_custkey % 90 AS STRING) || '.75' AS longitude,
  CAST(NULL AS STRING) AS narrative
FROM orders
"""

CENSUS = f"""
SELECT
  CASE WHEN c_custkey % 97 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END AS dot_number,
  c_mktsegment AS carrier_operation,
  'N' || CAST(c_nationkey AS STRING) AS phy_state,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey % 40 AS STRING) END AS nbr_power_unit,
  CASE WHEN c_custkey % 89 = 0 THEN '-2' ELSE CAST(c_custkey % 60 AS STRING) END AS driver_total,
  CAST({cents("c_acctbal")} AS STRING) AS recent_mileage,
  CASE WHEN c_custkey % 3 = 0 THEN '2024' END AS recent_mileage_year,
  CASE WHEN c_custkey % 11 = 0 THEN '2024-01-05' WHEN c_custkey % 13 = 0 THEN '31-FEB-20'
       ELSE lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || '-' ||
         CASE c_custkey % 4 WHEN 0 THEN 'JAN' WHEN 1 THEN 'apr' WHEN 2 THEN 'Oct' ELSE 'DEC' END
         || '-' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') END AS mcs150_date,
  c_name AS legal_name
FROM customer
"""

OCEAN = f"""
SELECT
  CASE WHEN l_orderkey % 5 <> 0 THEN 'FBX' || CAST(n_nationkey AS STRING) END AS routeCode,
  CASE WHEN l_orderkey % 10 = 0 THEN 'ALT' || CAST(n_nationkey AS STRING) END AS route_code,
  n_name AS route,
  CASE WHEN l_linenumber <> 3 THEN 'O' || CAST(l_suppkey % 20 AS STRING) END AS originPort,
  CAST(NULL AS STRING) AS destinationPort,
  CASE WHEN l_linenumber = 2 THEN 'USLAX' END AS destination_port,
  CASE WHEN l_linenumber % 2 = 0 THEN r_name END AS tradeRoute,
  CASE WHEN l_linenumber % 3 = 0 THEN 'lane ' || r_name END AS trade_lane,
  'ignored' AS tradeLane,
  CASE WHEN l_linenumber = 5 THEN '20GP' END AS containerType,
  CASE WHEN l_orderkey % 3 = 0 THEN l_rate END AS rateUsd,
  CASE WHEN l_orderkey % 3 = 1 THEN l_rate END AS rate_usd,
  CASE WHEN l_orderkey % 3 = 2 THEN l_rate END AS rate,
  CASE WHEN l_orderkey % 23 = 0 THEN 'not-a-date' WHEN l_orderkey % 7 = 0 THEN NULL
       ELSE {ymd("l_shipdate")} || 'T00:00:00Z' END AS publishedDate,
  CASE WHEN l_orderkey % 14 = 0 THEN {ymd("l_shipdate")} END AS published_date,
  r_name AS region
FROM (
  SELECT *, CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN '-3'
                 WHEN l_orderkey % 41 = 0 THEN '0'
                 ELSE CAST({cents("l_extendedprice")} AS STRING) END AS l_rate
  FROM lineitem
) l
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


def _num(x: str, width: int) -> str:
    return f"lpad(CAST({x} AS STRING), {width}, '0')"


WAYBILLS = f"""
SELECT CASE WHEN l_orderkey % 61 = 0 THEN substr(line, 1, 200) ELSE line END AS line
FROM (
  SELECT *,
    CASE WHEN l_orderkey % 67 = 0 THEN '0230' ELSE
      lpad(CAST(month(l_shipdate) AS STRING), 2, '0')
      || lpad(CAST(day(l_shipdate) AS STRING), 2, '0') END
    || {_num("l_partkey % 100", 2)}
    || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') || right(CAST(year(l_shipdate) AS STRING), 2)
    || CASE WHEN l_orderkey % 71 = 0 THEN 'ABCD' ELSE {_num("l_linenumber", 4)} END
    || l_returnflag || rpad(l_linestatus || '1', 4, ' ') || '    '
    || {_num("l_linenumber", 2)} || '   ' || {_num("l_partkey % 50", 4)}
    || ' ' || 'T' || CASE WHEN l_linenumber = 3 THEN 'H' ELSE ' ' END
    || CASE WHEN l_orderkey % 73 = 0 THEN '     ' ELSE {_num("l_partkey % 100000", 5)} END
    || {_num("CAST(floor(l_quantity) AS BIGINT)", 7)}
    || CASE WHEN l_linenumber = 2 THEN '     .5' ELSE '       ' END
    || {_num("CAST(floor(l_extendedprice) AS BIGINT)", 9)}
    || CASE WHEN l_orderkey % 79 = 0 THEN '-00000001' ELSE '         ' END
    || {_num(cents("l_tax"), 9)}
    || '1' || '2' || ' ' || 'W' || ' ' || '0' || '1'
    || {_num("l_suppkey % 1000", 4)} || '1' || {_num("l_linenumber", 1)}
    || '00500' || '040' || {_num("l_linenumber % 4", 1)}
    || {_num("l_suppkey % 180", 3)} || '1'
    || CASE l_linenumber % 4 WHEN 0 THEN rpad('', 18, ' ')
            WHEN 1 THEN rpad('IL', 18, ' ') WHEN 2 THEN rpad('IL  MO', 18, ' ')
            ELSE rpad('  KSTX', 18, ' ') END
    || {_num("l_partkey % 180", 3)} || '2' || ' '
    || {_num("l_partkey % 90000", 5)} || '100' || '0660' || '00602' || '0108' || '0120' || '    '
    || 'R' || '4' || CASE WHEN l_linenumber = 7 THEN '  ' ELSE ' 1' END || '2' || '    '
    || rpad('', 46, ' ') || ' '
    || {_num("l_linenumber * 40", 6)} || {_num("CAST(floor(l_quantity) AS BIGINT) * 40", 9)}
    || {_num("CAST(floor(l_extendedprice) AS BIGINT) * 40", 11)} || {_num("l_linenumber", 6)} AS line
  FROM lineitem
) w
"""

RUNS = """
SELECT
  'run_' || CAST(d AS STRING) AS run_id,
  CAST(d AS TIMESTAMP) AS started_at,
  orders % 3 <> 0 AS success,
  CASE WHEN orders % 5 = 0 THEN CAST(NULL AS BIGINT) ELSE cents END AS total_records_written
FROM (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders,
         CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS cents
  FROM orders GROUP BY 1
) r
"""

BATCHES = """
SELECT event_type, user_id, CASE WHEN user_id % 10 = 0 THEN NULL ELSE props END AS props,
       CASE WHEN value < 2 THEN CAST('NaN' AS DOUBLE) ELSE round(value) END AS value,
       CAST('2024-05-01 00:00:00' AS TIMESTAMP) AS ingested_at
FROM events
UNION ALL
SELECT event_type, user_id, CASE WHEN user_id % 10 = 0 THEN NULL ELSE props END AS props,
       CASE WHEN value < 2 THEN CAST('NaN' AS DOUBLE) ELSE round(value) END AS value,
       CAST('2024-05-02 00:00:00' AS TIMESTAMP) AS ingested_at
FROM events WHERE value < 20
"""

LINKS = """
SELECT o_orderkey,
  '/sites/bts.dot.gov/files/transborder-raw/' || CAST(year(o_orderdate) AS STRING) || '/' ||
  CASE WHEN o_orderkey % 7 = 0 THEN 'Annual' ELSE
    CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'Feb' WHEN 3 THEN 'MARCH'
      WHEN 4 THEN 'April' WHEN 5 THEN 'may' WHEN 6 THEN 'June' WHEN 7 THEN 'Jul'
      WHEN 8 THEN 'August' WHEN 9 THEN 'Sept' WHEN 10 THEN 'October' WHEN 11 THEN 'Nov'
      ELSE 'December' END END
  || CAST(year(o_orderdate) AS STRING) || '.zip' AS url,
  o_orderdate
FROM orders
"""
