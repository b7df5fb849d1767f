import json
from datetime import date
from decimal import Decimal

from railyard.constants import CENSUS_COLUMNS, waybill_fields
from railyard.operators import normalize as N
from railyard.operators import quality
from railyard.sources.fixed_width import short_lines, slice_fixed_width

AS_OF, RUN = date(2026, 8, 1), date(2026, 7, 1)


def test_carloadings(feed):
    raw = feed(
        {"date": "2031-02-06T10:20:30.000", "railroad": "Lakeline", "commodity": "Timber",
         "type": "Outbound", "carloads": "37.25"},
        {"date": "2031-02-06", "carrier": "Hilltop", "commodity_desc": "Salt", "volume": "6.125"},
        {"railroad": "Valley", "carloads": "0", "traffic_type": "Inbound"},
        {"railroad": "none given"},
        {"railroad": "negative", "carloads": "-1"},
        {"railroad": "nan", "carloads": "nan"},
    )
    rows = {r["railroad"]: r for r in N.norm_carloadings(raw, AS_OF, RUN).collect()}
    assert set(rows) == {"Lakeline", "Hilltop", "Valley"}
    assert rows["Lakeline"]["snapshot_date"] == date(2031, 2, 6)
    assert rows["Lakeline"]["carloads"] == 37.25 and rows["Lakeline"]["traffic_type"] == "Outbound"
    assert rows["Hilltop"]["carloads"] == 6.125 and rows["Hilltop"]["units"] == "carloads"
    assert rows["Valley"]["snapshot_date"] == RUN and rows["Valley"]["traffic_type"] == "Inbound"
    assert json.loads(rows["Hilltop"]["raw_record"])["volume"] == "6.125"


def test_run_date_goes_before_as_of(feed):
    row = N.norm_carloadings(feed({"carloads": "1"}), AS_OF).first()
    assert row["snapshot_date"] == AS_OF and row["railroad"] == "unknown"


def test_grain(feed):
    raw = feed(
        {"date": "2031-02-07", "railroad": "Lakeline", "state": "VT", "all": "14"},
        {"railroad": "", "all": "2"},
        {"railroad": "UP"},
    )
    (row,) = N.norm_grain_carloads(raw, AS_OF).collect()
    assert (row["commodity"], row["carloads"], row["units"], row["origin_region"]) == (
        "Grain", 14.0, "cars", "VT"
    )


def test_service_metrics(feed):
    raw = feed(
        {"measure": "Median Yard Wait (days)", "railroad": "Lakeline", "variable": "Coiled Steel",
         "value": "3.5", "date": "2031-02-06"},
        {"metric_name": "idle", "carrier": "Hilltop", "metric_value": "0", "unit": "hours"},
        {"measure": "x", "value": "1"},
    )
    rows = {r["railroad"]: r for r in N.norm_service_metrics(raw, AS_OF).collect()}
    assert set(rows) == {"Lakeline", "Hilltop"}
    assert rows["Lakeline"]["metric_name"] == "median_yard_wait"
    assert (rows["Lakeline"]["unit"], rows["Lakeline"]["segment"]) == ("days", "Coiled Steel")
    assert rows["Hilltop"]["metric_value"] == 0.0 and rows["Hilltop"]["unit"] == "hours"


def test_indicators_have_no_date_fallback(feed):
    raw = feed(
        {"id": "q7", "indicator": "Queue", "value1": "0.75", "date": "2031-01-31", "units": "Hours",
         "source": "provider"},
        {"id": "a", "indicator": "Queue", "value1": "1", "date": "soon"},
        {"id": "b", "indicator": "Queue", "date": "2031-01-31"},
    )
    (row,) = N.norm_indicators(raw, source="fred").collect()
    assert (row["source"], row["underlying_source"], row["value"]) == ("fred", "provider", 0.75)


def test_incidents(feed):
    form54 = feed({"reportkey": "k1", "date": "2026-01-02", "accidenttype": "Derailment",
                   "totalkilledform54": "0", "totaldamagecost": "910.5"})
    row = N.norm_safety_incidents(form54, "train_accident").first()
    assert (row["category"], row["total_killed"], row["damage_cost_usd"]) == ("Derailment", 0, 910.5)
    form57 = feed(
        {"reportkey": "k2", "year": "1988", "month": "11", "day": "05", "railroadcode": "HT",
         "vehicledamagecost": "5000", "equipmentinvolved": "Truck"},
        {"reportkey": "k3"},
        {"date": "1988-11-05"},
    )
    (row,) = N.norm_safety_incidents(form57, "highway_rail_crossing").collect()
    assert row["incident_date"] == date(1988, 11, 5)
    assert (row["railroad_code"], row["category"]) == ("HT", "Truck")


def test_tariffs(feed):
    base = {"commodity": "Barley", "origin_city": "Northfield", "origin_state": "VT",
            "destination_city": "Bath", "destination_state": "ME", "railroad": "HT",
            "date": "2031-04-01"}
    raw = feed(
        base | {"tariff_car": "77", "fsc_car": "1.5"},
        base | {"origin_state": None, "tariff_car": "0.125", "fsc_car": "x"},
        base | {"railroad": "wide", "tariff_car": "12345678901"},
        base | {"railroad": "absurd", "tariff_car": "1e30"},
        base | {"commodity": None},
    )
    rows = N.norm_tariffs(raw, AS_OF).collect()
    assert len(rows) == 3
    first = next(r for r in rows if r["origin"] == "Northfield, VT" and r["railroad"] == "HT")
    assert (first["rate_per_car"], first["fuel_surcharge"]) == (Decimal("77.00"), Decimal("1.50"))
    city = next(r for r in rows if r["origin"] == "Northfield")
    assert (city["rate_per_car"], city["fuel_surcharge"]) == (Decimal("0.12"), None)
    assert next(r for r in rows if r["railroad"] == "absurd")["rate_per_car"] is None


def test_census_never_reads_identity(feed):
    raw = feed({"dot_number": "1", "mcs150_date": "21-APR-26", "recent_mileage": "0",
                "legal_name": "A Person", "telephone": "555"}, {"dot_number": ""})
    df = N.norm_carrier_census(raw, AS_OF)
    (row,) = df.collect()
    assert row["snapshot_date"] == date(2026, 4, 21) and row["mileage"] == 0
    assert "A Person" not in str(row) and "raw_record" not in df.columns
    assert "legal_name" not in CENSUS_COLUMNS


def waybill(**fields) -> str:
    line = [" "] * 247
    values = {"waybill_date": "093015", "accounting_period": "1121", "carloads": "0012",
              "stcc": "24115", "freight_revenue": "000000808"} | fields
    for name, start, end, _ in waybill_fields():
        line[start:end] = list(values.get(name, "").ljust(end - start))
    return "".join(line)


def test_waybills(spark):
    lines = [
        waybill(interchange_state_1="IL", interchange_state_3="MO") + "\r",
        waybill(waybill_date="023024"),
        waybill(stcc=""),
        waybill(transit_charges="-00000001"),
        waybill()[:240],
        waybill(car_ownership="é", tcu_type="T"),
        waybill(tcu_type="\t") + "longer",
    ]
    df = spark.createDataFrame([(bytearray(x, "latin-1"),) for x in lines], "line binary")
    assert tuple(short_lines(df).first()) == (7, 1)
    rows = N.norm_waybills(slice_fixed_width(df), 2024).collect()
    assert len(rows) == 3
    assert {r["snapshot_date"] for r in rows} == {date(2015, 9, 30)}
    first = next(r for r in rows if r["interchange_states"])
    assert (first["interchange_states"], first["accounting_period"]) == ("IL,MO", "11/21")
    assert (first["freight_revenue"], first["carloads"], first["stcc"]) == (808.0, 12, "24115")
    odd = next(r for r in rows if r["car_ownership"])
    assert (odd["car_ownership"], odd["tcu_type"]) == ("�", "T")


def test_transborder(feed):
    def row(text):
        names = ("TRDTYPE,USASTATE,DEPE,DISAGMOT,MEXSTATE,CANPROV,COUNTRY,VALUE,SHIPWT,"
                 "FREIGHT_CHARGES,DF,CONTCODE,MONTH,YEAR")  # fmt: skip
        return dict(zip(names.split(","), text.split(","), strict=True))

    raw = feed(
        row("1,ME,0112,5,,ZZ,1220,318,4,9,2,1,11,2029"),
        row("2,VT,0212,6,,,2010,4711,15,3,1,X,11,2029"),
        row("1,WA,0604,2,,,5700,1,,,,,13,2026"),
        row("1,WA,0604,2,,,5700,,,,,,12,2026"),
        row("1,WA,0604,2,,,5700,5,-1,,,,12,2026"),
    )
    rows = {r["us_state"]: r for r in N.norm_transborder(raw).collect()}
    assert set(rows) == {"ME", "VT"}
    ak = rows["ME"]
    assert (ak["trade_type"], ak["country"], ak["mode"], ak["value_usd"]) == (
        "import", "CA", "truck", 318.0
    )
    assert ak["containerized"] is True and ak["snapshot_date"] == date(2029, 11, 30)
    assert (rows["VT"]["country"], rows["VT"]["containerized"]) == ("MX", False)


def test_quarantine_keeps_the_reason(feed):
    raw = feed({"TRDTYPE": "1", "COUNTRY": "1220", "VALUE": "5", "SHIPWT": "-1", "MONTH": "1",
                "YEAR": "2026"})
    rows = N.norm_transborder(raw, valid_only=False)
    good, bad = quality.quarantine(rows, "transborder_freight")
    assert good.count() == 0
    assert bad.first()["reject_reasons"] == ["ship_weight_kg must be >= 0"]


def test_ocean(feed):
    raw = feed(
        {"routeCode": "R1", "rateUsd": "812.5", "publishedDate": "2031-05-09", "tradeLane": "x"},
        {"route_code": "R2", "rate_usd": "0", "published_date": "not-a-date"},
        {"route_code": "R3"},
    )
    rows = {r["route_code"]: r for r in N.norm_ocean_rates(raw, AS_OF, RUN).collect()}
    assert set(rows) == {"R1", "R2"}
    assert rows["R1"]["snapshot_date"] == date(2031, 5, 9)
    assert rows["R1"]["trade_lane"] == "unknown" and rows["R1"]["container_type"] == "40GP"
    assert rows["R2"]["snapshot_date"] == RUN and rows["R2"]["rate_usd"] == 0.0


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    df = spark.createDataFrame([(waybill(),)], "line string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = N.norm_waybills(slice_fixed_width(df), 2024)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < max(sizes) < 8000
