"""Normalising projections: raw feed columns to the canonical tables.

Each function is one ``select`` followed by one ``where``: no shuffle, no join and no
Python per row.  Raw columns a feed does not have are treated as null.  A row that
misses a required value or breaks a table constraint is dropped;
:func:`railyard.operators.quality.quarantine` keeps such rows instead.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from railyard.constants import CENSUS_COLUMNS, COUNTRY_CODES, MODE_LABELS, waybill_fields
from railyard.functions import (
    blank_to_null,
    first_not_null,
    first_truthy,
    format_period,
    month_end,
    parse_dd_mon_yy,
    parse_fra_date,
    parse_iso_date,
    parse_mmddyy,
    parse_percent,
    place_label,
    raw_json,
    safe_decimal,
    safe_float,
    safe_int,
    slug_metric,
    strip,
    truthy,
    year_end,
)
from railyard.functions.stages import evaluate_beside
from railyard.functions.text import extract_unit
from railyard.schemas import constrained_columns, is_valid, table


class _Raw:
    """Raw columns by name, null where the feed has none."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self._names = set(df.columns)

    def __getitem__(self, name: str) -> Column:
        return F.col(name) if name in self._names else F.lit(None).cast("string")

    def some(self, *names: str) -> list[Column]:
        return [self[n] for n in names]

    @property
    def record(self) -> Column:
        if "raw_record" in self._names:
            return F.col("raw_record")
        return raw_json(*self.df.columns)


def _finish(
    raw: _Raw,
    name: str,
    columns: dict[str, Column],
    present: list[str],
    ingested_at: Column | None,
    given: Column | None = None,
    checks: dict[str, Column] | None = None,
    valid_only: bool = True,
    parsed: tuple[str, ...] = (),
) -> DataFrame:
    """Project to the table's schema and keep complete, valid rows.

    ``given`` is a predicate on raw columns and reaches the scan.  ``present`` names
    typed columns that must not be null, ``checks`` typed flags that must be true.

    The columns that the filters read, and those in ``parsed``, which share work with
    them, are one stage: otherwise the optimiser would push the filters below it and
    every parse in a filter would run a second time.  All other columns, ``raw_record``
    too, stand outside: what a query does not ask for is neither built nor read, and
    its predicates on them go down to the scan.
    """
    spec = table(name)
    columns = dict(columns)
    if "raw_record" in spec.columns:
        columns["raw_record"] = raw.record
    columns["ingested_at"] = F.current_timestamp() if ingested_at is None else ingested_at
    rows = raw.df if given is None else raw.df.where(given)
    ruled = constrained_columns(name) if valid_only else []
    stage = [f for f in spec.schema.fields if f.name in {*present, *ruled, *parsed}]
    early = {f.name: f"__typed_{i}" for i, f in enumerate(stage)}
    typed = [columns[f.name].cast(f.dataType).alias(early[f.name]) for f in stage]
    flags = [c.alias(flag) for flag, c in (checks or {}).items()]
    out = evaluate_beside(rows, *typed, *flags) if typed or flags else rows
    final = [
        F.col(early[f.name]).alias(f.name)
        if f.name in early
        else columns[f.name].cast(f.dataType).alias(f.name)
        for f in spec.schema.fields
    ]
    keep = F.lit(True)
    for column in present:
        keep = keep & F.col(early[column]).isNotNull()
    for flag in checks or {}:
        keep = keep & F.coalesce(F.col(flag), F.lit(False))
    out = out.where(keep).select(*final)
    return out.where(is_valid(name)) if valid_only else out


def _reported(parsed: Column, run_date: date | None, as_of: date) -> Column:
    return F.coalesce(parsed, F.lit(run_date or as_of))


def norm_carloadings(
    raw: DataFrame,
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
    valid_only: bool = True,
) -> DataFrame:
    """Weekly carloadings; the first of three value columns that is present counts."""
    r = _Raw(raw)
    carloads = safe_float(first_not_null(*r.some("carloads", "volume", "count")))
    columns = {
        "source": F.lit("usda_agtransport"),
        "snapshot_date": _reported(parse_iso_date(r["date"]), run_date, as_of),
        "railroad": first_not_null(*r.some("railroad", "carrier"), F.lit("unknown")),
        "commodity": first_not_null(*r.some("commodity", "commodity_desc"), F.lit("unknown")),
        "traffic_type": first_truthy(*r.some("type", "traffic_type")),
        "carloads": carloads,
        "units": first_not_null(r["units"], F.lit("carloads")),
        "origin_region": first_not_null(*r.some("origin", "origin_region")),
        "destination_region": first_not_null(*r.some("destination", "destination_region")),
    }
    return _finish(
        r, "rail_carloadings", columns, ["carloads"], ingested_at, valid_only=valid_only
    )


def norm_grain_carloads(
    raw: DataFrame,
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
    valid_only: bool = True,
) -> DataFrame:
    """Grain car counts per railroad, state and week, as carloadings."""
    r = _Raw(raw)
    cars = safe_float(r["all"])
    columns = {
        "source": F.lit("usda_agtransport"),
        "snapshot_date": _reported(parse_iso_date(r["date"]), run_date, as_of),
        "railroad": r["railroad"],
        "commodity": F.lit("Grain"),
        "traffic_type": F.lit(None),
        "carloads": cars,
        "units": F.lit("cars"),
        "origin_region": r["state"],
        "destination_region": F.lit(None),
    }
    given = truthy(r["railroad"]) & r["all"].isNotNull()
    return _finish(
        r, "rail_carloadings", columns, ["carloads"], ingested_at, given, valid_only=valid_only
    )


def norm_service_metrics(
    raw: DataFrame,
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Service metrics; the unit comes from the label when it is not given."""
    r = _Raw(raw)
    label = first_truthy(*r.some("measure", "metric_name", "metric", "indicator"))
    value = safe_float(first_not_null(*r.some("value", "metric_value")))
    railroad = first_truthy(*r.some("railroad", "carrier", "reporting_railroad"))
    columns = {
        "source": F.lit("usda_agtransport"),
        "snapshot_date": _reported(parse_iso_date(r["date"]), run_date, as_of),
        "railroad": railroad,
        "metric_name": slug_metric(label),
        "metric_value": value,
        "unit": first_truthy(r["unit"], extract_unit(label)),
        "region": r["region"],
        "segment": first_truthy(*r.some("variable", "segment")),
    }
    given = truthy(label) & truthy(railroad)
    return _finish(r, "rail_service_metrics", columns, ["metric_value"], ingested_at, given)


def norm_indicators(
    raw: DataFrame, source: str = "bts_freight_indicators", ingested_at: Column | None = None
) -> DataFrame:
    """Dated indicator observations; there is no fallback for a bad date."""
    r = _Raw(raw)
    columns = {
        "source": F.lit(source),
        "external_id": r["id"],
        "snapshot_date": parse_iso_date(r["date"]),
        "indicator": r["indicator"],
        "measure1": r["measure1"],
        "measure2": r["measure2"],
        "value": safe_float(r["value1"]),
        "units": r["units"],
        "underlying_source": r["source"],
    }
    given = r["id"].isNotNull() & r["indicator"].isNotNull() & r["value1"].isNotNull()
    return _finish(
        r, "freight_indicators", columns, ["value", "snapshot_date"], ingested_at, given
    )


def norm_safety_incidents(
    raw: DataFrame, incident_type: str | Column, ingested_at: Column | None = None
) -> DataFrame:
    """Incident reports of both forms.

    ``incident_type`` is "train_accident" (Form 54) or "highway_rail_crossing"
    (Form 57); a column lets one pass handle a mixed feed.
    """
    r = _Raw(raw)
    kind = incident_type if isinstance(incident_type, Column) else F.lit(incident_type)
    accident = kind == "train_accident"

    def by_form(form54: str, form57: str) -> Column:
        return F.when(accident, r[form54]).otherwise(r[form57])

    day = parse_fra_date(*r.some("date", "year", "month", "accidentmonth", "day"))
    columns = {
        "source": F.lit("fra_safety"),
        "external_id": r["reportkey"],
        "incident_type": kind,
        "incident_date": day,
        "railroad_code": first_truthy(*r.some("reportingrailroadcode", "railroadcode")),
        "railroad_name": first_truthy(*r.some("reportingrailroadname", "railroadname")),
        "state": r["statename"],
        "county": r["countyname"],
        "category": by_form("accidenttype", "equipmentinvolved"),
        "total_killed": safe_int(by_form("totalkilledform54", "totalkilledform57")),
        "total_injured": safe_int(by_form("totalinjuredform54", "totalinjuredform57")),
        "damage_cost_usd": safe_float(by_form("totaldamagecost", "vehicledamagecost")),
        "latitude": safe_float(r["latitude"]),
        "longitude": safe_float(r["longitude"]),
        "narrative": r["narrative"],
    }
    given = r["reportkey"].isNotNull()
    return _finish(r, "rail_safety_incidents", columns, ["incident_date"], ingested_at, given)


def norm_tariffs(
    raw: DataFrame,
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Published tariffs; money is rounded half to even."""
    r = _Raw(raw)
    columns = {
        "source": F.lit("usda_agtransport"),
        "snapshot_date": _reported(parse_iso_date(r["date"]), run_date, as_of),
        "railroad": r["railroad"],
        "commodity": r["commodity"],
        "origin": place_label(r["origin_city"], r["origin_state"]),
        "destination": place_label(r["destination_city"], r["destination_state"]),
        "rate_per_car": safe_decimal(r["tariff_car"], 12, 2),
        "fuel_surcharge": safe_decimal(r["fsc_car"], 10, 2),
        "currency": F.lit("USD"),
        "movement_type": r["train_type"],
    }
    given = (
        truthy(r["railroad"])
        & truthy(r["commodity"])
        & truthy(r["origin_city"])
        & truthy(r["destination_city"])
    )
    checks = {"_rate_fits": _fits(r["tariff_car"], 10), "_fsc_fits": _fits(r["fsc_car"], 8)}
    return _finish(r, "rail_tariff_rates", columns, [], ingested_at, given, checks)


def _fits(money: Column, digits: int) -> Column:
    """False for amounts that are numbers but too wide for their column, and for NaN.

    Amounts of 10^26 and more cannot even be rounded and count as missing.
    """
    size = F.abs(safe_float(money))
    limit = 10.0**digits - 0.005
    return F.coalesce((size < limit) | ((size >= 1e26) & ~F.isnan(size)), F.lit(True))


def norm_eurostat(decoded: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Decoded annual observations; the date is the last day of the period."""
    r = _Raw(decoded)
    value = r["value"].cast("double")
    day = year_end(strip(r["period"]).try_cast("int"))
    columns = {
        "source": F.lit("eurostat"),
        "snapshot_date": day,
        "period": r["period"],
        "country_code": r["country_code"],
        "country_name": r["country_name"],
        "unit": r["unit"],
        "metric": F.when(r["unit"] == "THS_T", F.lit("rail_goods_tonnes")).otherwise(
            F.lit("rail_goods_tonne_km")
        ),
        "value": value,
    }
    given = truthy(r["country_code"]) & truthy(r["period"]) & truthy(r["unit"])
    return _finish(
        r, "rail_eurostat_freight", columns, ["value", "snapshot_date"], ingested_at, given
    )


def norm_carrier_census(
    raw: DataFrame,
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Carrier profiles.  Identity columns are cut before anything else is read."""
    allowed = [c for c in CENSUS_COLUMNS if c in raw.columns]
    r = _Raw(raw.select(*allowed))
    columns = {
        "source": F.lit("fmcsa_carrier_census"),
        "snapshot_date": _reported(parse_dd_mon_yy(r["mcs150_date"]), run_date, as_of),
        "dot_number": r["dot_number"],
        "carrier_operation": r["carrier_operation"],
        "state": r["phy_state"],
        "power_units": safe_int(r["nbr_power_unit"]),
        "driver_count": safe_int(r["driver_total"]),
        "mileage": safe_int(r["recent_mileage"]),
        "mileage_year": safe_int(r["recent_mileage_year"]),
    }
    given = truthy(r["dot_number"])
    return _finish(r, "motor_carrier_census", columns, [], ingested_at, given)


def norm_waybills(
    slices: DataFrame, reference_year: int | Column, ingested_at: Column | None = None
) -> DataFrame:
    """Waybill fields; values are taken as written, not rescaled.

    ``slices`` holds stripped fields, as ``slice_fixed_width`` returns them, so they are
    not stripped again.
    """
    r = _Raw(slices)

    def text(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    parse = {"int": safe_int, "float": safe_float, "text": text}
    fields = waybill_fields()
    columns = {name: parse[kind](r[name]) for name, _, _, kind in fields if kind in parse}
    columns["source"] = F.lit("stb_waybill")
    columns["snapshot_date"] = parse_mmddyy(r["waybill_date"], reference_year)
    columns["accounting_period"] = format_period(r["accounting_period"])
    columns["stcc"] = r["stcc"]
    states = [text(r[name]) for name, _, _, kind in fields if kind == "state"]
    columns["interchange_states"] = text(F.concat_ws(",", *states))
    given = truthy(r["stcc"])
    numbers = tuple(name for name, _, _, kind in fields if kind in ("int", "float"))
    present = ["carloads", "snapshot_date"]
    return _finish(
        r, "waybill_shipments", columns, present, ingested_at, given, parsed=numbers
    )


def norm_transborder(
    raw: DataFrame,
    modes: dict[str, str] | None = None,
    countries: dict[str, str] | None = None,
    ingested_at: Column | None = None,
    valid_only: bool = True,
) -> DataFrame:
    """Border-trade lines; code labels come from small literal maps."""
    r = _Raw(raw)
    value = safe_float(r["VALUE"])
    month, year = safe_int(r["MONTH"]), safe_int(r["YEAR"])
    day = month_end(year, month)
    country = strip(r["COUNTRY"])
    mode = strip(F.coalesce(r["DISAGMOT"], F.lit("")))
    columns = {
        "source": F.lit("bts_transborder"),
        "snapshot_date": day,
        "trade_type": F.when(r["TRDTYPE"] == "1", F.lit("import")).otherwise(F.lit("export")),
        "country": F.coalesce(_label(countries or COUNTRY_CODES, country), country),
        "year": year,
        "month": month,
        "mode": F.coalesce(_label(modes or MODE_LABELS, mode), F.lit("unknown")),
        "disagg_mode": safe_int(mode),
        "source_file": r["source_file"],
        "us_state": blank_to_null(r["USASTATE"]),
        "district_port": blank_to_null(r["DEPE"]),
        "commodity_2digit": blank_to_null(r["COMMODITY2"]),
        "canada_province": blank_to_null(r["CANPROV"]),
        "mexico_state": blank_to_null(r["MEXSTATE"]),
        "value_usd": value,
        "ship_weight_kg": safe_float(r["SHIPWT"]),
        "freight_charges_usd": safe_float(r["FREIGHT_CHARGES"]),
        "containerized": F.coalesce(strip(r["CONTCODE"]) == "1", F.lit(False)),
        "distribution_flag": blank_to_null(r["DF"]),
    }
    given = r["TRDTYPE"].isNotNull() & truthy(r["COUNTRY"])
    return _finish(
        r,
        "transborder_freight",
        columns,
        ["value_usd", "snapshot_date"],
        ingested_at,
        given,
        valid_only=valid_only,
        parsed=("year", "month"),
    )


def _label(labels: dict[str, str], code: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(pairs, code)


def norm_weekly_traffic(rows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Parsed release rows; percentages lose their sign character."""
    r = _Raw(rows)
    columns = {
        "source": F.lit("aar_weekly"),
        "snapshot_date": parse_iso_date(r["week_end_date"]),
        "region": r["region"],
        "week_number": safe_int(r["week_number"]),
        "year": safe_int(r["year"]),
        "category": r["category"],
        "this_week_cars": safe_int(r["this_week_cars"]),
        "this_week_yoy_pct": parse_percent(r["this_week_yoy_pct"]),
        "ytd_cars": safe_int(r["ytd_cars"]),
        "ytd_avg_week_cars": safe_int(r["ytd_avg_week_cars"]),
        "ytd_yoy_pct": parse_percent(r["ytd_yoy_pct"]),
    }
    given = truthy(r["region"]) & truthy(r["category"])
    present = ["snapshot_date", "week_number", "year", "this_week_cars", "ytd_cars"]
    return _finish(r, "aar_weekly_traffic", columns, present, ingested_at, given)


def norm_ocean_rates(
    raw: DataFrame,
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Container spot rates; a bad or missing date falls back, it does not drop."""
    r = _Raw(raw)
    rate = safe_float(first_not_null(*r.some("rateUsd", "rate_usd", "rate")))
    published = first_not_null(*r.some("publishedDate", "published_date"))

    def either(camel: str, snake: str, default: str) -> Column:
        return first_not_null(r[camel], r[snake], F.lit(default))

    columns = {
        "source": F.lit("freightos_fbx"),
        "snapshot_date": _reported(parse_iso_date(published), run_date, as_of),
        "route_code": either("routeCode", "route_code", "unknown"),
        "route_description": either("route", "route_description", ""),
        "origin_port": either("originPort", "origin_port", "unknown"),
        "destination_port": either("destinationPort", "destination_port", "unknown"),
        "trade_lane": either("tradeRoute", "trade_lane", "unknown"),
        "container_type": either("containerType", "container_type", "40GP"),
        "rate_usd": rate,
        "currency": F.lit("USD"),
        "rate_unit": F.lit("per_container"),
        "region": r["region"],
    }
    return _finish(r, "ocean_freight_rates", columns, ["rate_usd"], ingested_at)


def route_feeds_to_carloadings(
    feeds: dict[str, DataFrame],
    as_of: date,
    run_date: date | None = None,
    ingested_at: Column | None = None,
) -> dict[str, DataFrame]:
    """Four agricultural transport feeds to their three tables.

    Feeds: ``carloadings``, ``grain_carloads``, ``service_metrics``, ``tariffs``; any
    may be absent.  Both car-count feeds end up in one table.
    """
    out: dict[str, DataFrame] = {}
    cars = [
        norm(feeds[name], as_of, run_date, ingested_at)
        for name, norm in (
            ("carloadings", norm_carloadings),
            ("grain_carloads", norm_grain_carloads),
        )
        if name in feeds
    ]
    if cars:
        out["rail_carloadings"] = cars[0] if len(cars) == 1 else cars[0].unionByName(cars[1])
    if "service_metrics" in feeds:
        out["rail_service_metrics"] = norm_service_metrics(
            feeds["service_metrics"], as_of, run_date, ingested_at
        )
    if "tariffs" in feeds:
        out["rail_tariff_rates"] = norm_tariffs(feeds["tariffs"], as_of, run_date, ingested_at)
    return out


def count_feeds(feeds: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """The same feeds, and a counter ``raw`` of each feed's rows before any filter.

    The counters fill in on the pass that writes the tables made from the feeds; tasks that
    run a second time for a lost executor count twice. Counting needs every raw row, so
    filters of the normalisers stay above the count.
    """
    seen = {name: Observation(f"feed {name}") for name in feeds}
    counted = {name: df.observe(seen[name], F.count(F.lit(1)).alias("raw")) for name, df in feeds.items()}
    return counted, seen
