"""The canonical tables: column types, row constraints and storage settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from railyard.constants import waybill_fields

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "double": DoubleType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "decimal(12,2)": DecimalType(12, 2),
    "decimal(10,2)": DecimalType(10, 2),
    "array<string>": ArrayType(StringType()),
}


def struct_of(columns: str) -> StructType:
    """A schema from "name type, name type", available before a session exists."""
    pairs = (part.split() for part in columns.split(", "))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    """One canonical table.

    ``grain`` is ``day`` (a touched day is replaced) or ``year`` (a touched year is
    merged and de-duplicated).  ``date_column`` drives the partition key.
    """

    name: str
    ddl: str
    grain: str = "day"
    date_column: str = "snapshot_date"
    by_source: bool = False
    csv_copy: bool = True
    non_negative: tuple[str, ...] = ()
    ranges: tuple[tuple[str, float, float], ...] = ()

    @property
    def schema(self) -> StructType:
        return struct_of(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def partition_columns(self) -> list[str]:
        keys = ["p_year"] if self.grain == "year" else ["p_year", "p_month", "p_day"]
        return (["p_source"] if self.by_source else []) + keys


def _waybill_ddl() -> str:
    types = {"int": "bigint", "float": "double", "text": "string", "key": "string"}
    columns = ["source string", "snapshot_date date"]
    for name, _, _, kind in waybill_fields():
        if name == "waybill_date" or kind == "state":
            continue
        if name == "termination_bea_area":
            columns.append("interchange_states string")
        columns.append(f"{name} {types[kind]}")
    return ", ".join(columns) + ", ingested_at timestamp"


_WAYBILL_NON_NEGATIVE = (
    "carloads",
    "freight_revenue",
    "transit_charges",
    "miscellaneous_charges",
    "estimated_shortline_miles",
    "exact_expansion_factor",
    "theoretical_expansion_factor",
    "num_interchanges",
    "car_capacity",
    "nominal_car_capacity",
    "tare_weight",
    "outside_length",
    "outside_width",
    "outside_height",
    "extreme_outside_height",
    "num_axles",
    "num_articulated_units",
    "expanded_carloads",
    "expanded_tons",
    "expanded_freight_revenue",
    "expanded_trailer_container_count",
)

_TABLES = [
    Table(
        "rail_carloadings",
        "source string, snapshot_date date, railroad string, commodity string, "
        "traffic_type string, carloads double, units string, origin_region string, "
        "destination_region string, raw_record string, ingested_at timestamp",
        non_negative=("carloads",),
    ),
    Table(
        "rail_service_metrics",
        "source string, snapshot_date date, railroad string, metric_name string, "
        "metric_value double, unit string, region string, segment string, "
        "raw_record string, ingested_at timestamp",
    ),
    Table(
        "ocean_freight_rates",
        "source string, snapshot_date date, route_code string, route_description string, "
        "origin_port string, destination_port string, trade_lane string, "
        "container_type string, rate_usd double, currency string, rate_unit string, "
        "region string, raw_record string, ingested_at timestamp",
        non_negative=("rate_usd",),
    ),
    # Two feeds share this table, so a day is replaced per feed, not for both.
    Table(
        "freight_indicators",
        "source string, external_id string, snapshot_date date, indicator string, "
        "measure1 string, measure2 string, value double, units string, "
        "underlying_source string, raw_record string, ingested_at timestamp",
        by_source=True,
    ),
    Table(
        "rail_tariff_rates",
        "source string, snapshot_date date, railroad string, commodity string, "
        "origin string, destination string, rate_per_car decimal(12,2), "
        "fuel_surcharge decimal(10,2), currency string, movement_type string, "
        "raw_record string, ingested_at timestamp",
    ),
    # No raw_record: the census covers individuals.  Year grain: filing dates are
    # spread so thin that day folders would hold a handful of rows each.
    Table(
        "motor_carrier_census",
        "source string, snapshot_date date, dot_number string, carrier_operation string, "
        "state string, power_units bigint, driver_count bigint, mileage bigint, "
        "mileage_year bigint, ingested_at timestamp",
        grain="year",
        non_negative=("power_units", "driver_count", "mileage"),
    ),
    # Filed under the incident's own year: filing under the ingest day would store
    # the full history once more on every run.
    Table(
        "rail_safety_incidents",
        "source string, external_id string, incident_type string, incident_date date, "
        "railroad_code string, railroad_name string, state string, county string, "
        "category string, total_killed bigint, total_injured bigint, "
        "damage_cost_usd double, latitude double, longitude double, narrative string, "
        "raw_record string, ingested_at timestamp",
        grain="year",
        date_column="incident_date",
        non_negative=("total_killed", "total_injured", "damage_cost_usd"),
    ),
    Table(
        "rail_eurostat_freight",
        "source string, snapshot_date date, period string, country_code string, "
        "country_name string, unit string, metric string, value double, "
        "raw_record string, ingested_at timestamp",
    ),
    Table(
        "waybill_shipments",
        _waybill_ddl(),
        grain="year",
        csv_copy=False,
        non_negative=_WAYBILL_NON_NEGATIVE,
    ),
    Table(
        "transborder_freight",
        "source string, snapshot_date date, trade_type string, country string, "
        "year bigint, month bigint, mode string, disagg_mode bigint, source_file string, "
        "us_state string, district_port string, commodity_2digit string, "
        "canada_province string, mexico_state string, value_usd double, "
        "ship_weight_kg double, freight_charges_usd double, containerized boolean, "
        "distribution_flag string, raw_record string, ingested_at timestamp",
        non_negative=("value_usd", "ship_weight_kg", "freight_charges_usd"),
    ),
    Table(
        "aar_weekly_traffic",
        "source string, snapshot_date date, region string, week_number bigint, "
        "year bigint, category string, this_week_cars bigint, this_week_yoy_pct double, "
        "ytd_cars bigint, ytd_avg_week_cars bigint, ytd_yoy_pct double, "
        "raw_record string, ingested_at timestamp",
        non_negative=("this_week_cars", "ytd_cars", "ytd_avg_week_cars"),
        ranges=(("week_number", 1, 53),),
    ),
]
TABLES = {t.name: t for t in _TABLES}

RUN_SCHEMA = struct_of(
    "run_id string, started_at timestamp, finished_at timestamp, success boolean, "
    "sources_attempted array<string>, sources_succeeded array<string>, "
    "sources_failed array<string>, total_records_written bigint, errors array<string>, "
    "output_paths array<string>"
)


def table(name: str) -> Table:
    """Look a table up; an unknown name is an error, never an empty result."""
    try:
        return TABLES[name]
    except KeyError:
        raise ValueError(f"Unknown table: {name}") from None


def violations(name: str) -> list[tuple[str, Column]]:
    """(reason, predicate) pairs; a predicate is true when a row breaks that rule.

    Nulls pass.  NaN never passes a numeric rule, although Spark sorts it above
    every number.
    """
    spec = table(name)
    types = {f.name: f.dataType for f in spec.schema.fields}
    out = []
    for column in spec.non_negative:
        bad = F.col(column) < 0
        if isinstance(types[column], (DoubleType, FloatType)):
            bad = bad | F.isnan(column)
        out.append((f"{column} must be >= 0", F.coalesce(bad, F.lit(False))))
    for column, low, high in spec.ranges:
        bad = ~F.col(column).between(low, high)
        out.append((f"{column} must be in {low}..{high}", F.coalesce(bad, F.lit(False))))
    for column, kind in types.items():
        if isinstance(kind, DecimalType):
            limit = F.lit(10 ** (kind.precision - kind.scale))
            bad = F.abs(F.col(column)) >= limit
            out.append((f"{column} is too wide", F.coalesce(bad, F.lit(False))))
    return out


def constrained_columns(name: str) -> list[str]:
    """The columns that the table's constraints read."""
    spec = table(name)
    wide = [f.name for f in spec.schema.fields if isinstance(f.dataType, DecimalType)]
    return [*spec.non_negative, *(column for column, _, _ in spec.ranges), *wide]


def is_valid(name: str) -> Column:
    """True for rows that satisfy every constraint of the table."""
    ok = F.lit(True)
    for _, bad in violations(name):
        ok = ok & ~bad
    return ok
