"""Fixed values that the published feeds define.

Everything in this module is data that must equal the feeds' documentation for
results to be right; nothing here is logic.
"""

from __future__ import annotations

# Whitespace that a Python ``str.strip()`` removes.
PY_WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# DISAGMOT code -> mode of transportation.
MODE_LABELS = {
    "1": "vessel",
    "3": "air",
    "4": "mail",
    "5": "truck",
    "6": "rail",
    "7": "pipeline",
    "8": "other",
    "9": "foreign_trade_zone",
}

# Census country code -> ISO code.
COUNTRY_CODES = {"1220": "CA", "2010": "MX"}

# Border-trade CSV columns per view.
BORDER_VIEWS = {
    "dot1": (
        "TRDTYPE,USASTATE,DEPE,DISAGMOT,MEXSTATE,CANPROV,COUNTRY,VALUE,SHIPWT,"
        "FREIGHT_CHARGES,DF,CONTCODE,MONTH,YEAR"
    ),
    "dot2": (
        "TRDTYPE,USASTATE,COMMODITY2,DISAGMOT,MEXSTATE,CANPROV,COUNTRY,VALUE,SHIPWT,"
        "FREIGHT_CHARGES,DF,CONTCODE,MONTH,YEAR"
    ),
    "dot3": (
        "TRDTYPE,DEPE,COMMODITY2,DISAGMOT,COUNTRY,VALUE,SHIPWT,FREIGHT_CHARGES,DF,"
        "CONTCODE,MONTH,YEAR"
    ),
}
BORDER_COLUMNS = [
    "TRDTYPE",
    "USASTATE",
    "DEPE",
    "COMMODITY2",
    "DISAGMOT",
    "MEXSTATE",
    "CANPROV",
    "COUNTRY",
    "VALUE",
    "SHIPWT",
    "FREIGHT_CHARGES",
    "DF",
    "CONTCODE",
    "MONTH",
    "YEAR",
]

# English month names, in calendar order.
MONTH_NAMES = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]

# Weekly-release page title -> region label.
RELEASE_REGIONS = {
    "U.S. Rail Traffic": "US",
    "Canadian Rail Traffic": "Canada",
    "Mexican Rail Traffic": "Mexico",
    "North American Rail Traffic": "North America",
}

# Header words of a weekly-release table.
RELEASE_HEADER_WORDS = ["this week", "year-to-date", "cars", "vs 2025", "cumulative"]

# Container-index routes (route code, description, origin, destination).
OCEAN_ROUTES = [
    ("FBX01", "China/East Asia → North America West Coast", "CNSHA", "USLAX"),
    ("FBX02", "North America West Coast → China/East Asia", "USLAX", "CNSHA"),
    ("FBX03", "China/East Asia → North America East Coast", "CNSHA", "USNYC"),
    ("FBX11", "China/East Asia → North Europe", "CNSHA", "NLRTM"),
    ("FBX13", "China/East Asia → Mediterranean", "CNSHA", "ESBCN"),
    ("FBX14", "North Europe → China/East Asia", "NLRTM", "CNSHA"),
    ("FBX21", "North America West Coast → North Europe", "USLAX", "NLRTM"),
    ("FBX22", "North Europe → North America West Coast", "NLRTM", "USLAX"),
    ("FBX24", "North America East Coast → North Europe", "USNYC", "NLRTM"),
    ("FBX25", "North Europe → North America East Coast", "NLRTM", "USNYC"),
    ("FBX31", "North America East Coast → Central America", "USMIA", "PAAUA"),
    ("FBX41", "Intra-Asia", "CNSHA", "SGSIN"),
]

# Monthly index series (id, title, source, units).
INDEX_SERIES = [
    (
        "FRGSHPUSM649NCIS",
        "Cass Freight Index: Shipments",
        "Cass Information Systems",
        "Index Jan 1990=1",
    ),
    (
        "FRGEXPUSM649NCIS",
        "Cass Freight Index: Expenditures",
        "Cass Information Systems",
        "Index Jan 1990=1",
    ),
    (
        "TRUCKD11",
        "Truck Tonnage Index",
        "BTS / American Trucking Association",
        "Index 2015=100",
    ),
]

# The only census columns that may ever be read (no identity data).
CENSUS_COLUMNS = [
    "dot_number",
    "carrier_operation",
    "phy_state",
    "nbr_power_unit",
    "driver_total",
    "recent_mileage",
    "recent_mileage_year",
    "mcs150_date",
]

# 247-byte public-use waybill record; name, first byte, end byte
# (0-indexed, end-exclusive) and the type the field is normalised to.
WAYBILL_WIDTH = 247
WAYBILL_LAYOUT = """
waybill_date 0 6 key
accounting_period 6 10 key
carloads 10 14 int
car_ownership 14 15 text
aar_equipment_type 15 19 text
aar_mechanical_designation 19 23 text
stb_car_type 23 25 text
tofc_cofc_service_code 25 28 text
tofc_cofc_units 28 32 int
tcu_ownership 32 33 text
tcu_type 33 34 text
hazardous_boxcar_flag 34 35 text
stcc 35 40 key
billed_tons 40 47 float
actual_tons 47 54 float
freight_revenue 54 63 float
transit_charges 63 72 float
miscellaneous_charges 72 81 float
inter_intra_state_code 81 82 text
type_of_move 82 83 text
all_rail_intermodal_code 83 84 text
type_of_move_via_water 84 85 text
transit_code 85 86 text
substituted_truck_for_rail 86 87 text
rebill_code 87 88 text
estimated_shortline_miles 88 92 int
stratum_id 92 93 int
subsample_id 93 94 int
exact_expansion_factor 94 99 float
theoretical_expansion_factor 99 102 int
num_interchanges 102 103 int
origin_bea_area 103 106 int
origin_freight_territory 106 107 text
termination_bea_area 125 128 int
termination_freight_territory 128 129 text
reporting_period_length 129 130 text
car_capacity 130 135 int
nominal_car_capacity 135 138 int
tare_weight 138 142 int
outside_length 142 147 int
outside_width 147 151 int
outside_height 151 155 int
extreme_outside_height 155 159 int
wheel_bearings_type 159 160 text
num_axles 160 161 int
draft_gear 161 163 text
num_articulated_units 163 164 int
aar_error_codes 164 168 text
routing_error_flag 214 215 text
expanded_carloads 215 221 int
expanded_tons 221 230 int
expanded_freight_revenue 230 241 float
expanded_trailer_container_count 241 247 int
interchange_state_1 107 109 state
interchange_state_2 109 111 state
interchange_state_3 111 113 state
interchange_state_4 113 115 state
interchange_state_5 115 117 state
interchange_state_6 117 119 state
interchange_state_7 119 121 state
interchange_state_8 121 123 state
interchange_state_9 123 125 state
"""


def waybill_fields() -> list[tuple[str, int, int, str]]:
    """The waybill layout as (name, start, end, kind) tuples."""
    rows = (line.split() for line in WAYBILL_LAYOUT.strip().splitlines())
    return [(name, int(start), int(end), kind) for name, start, end, kind in rows]

# The publisher's names of monthly, cumulative and legacy archive members.
MONTHLY_MEMBER = r"(?i)^dot([123])_(0[1-9]|1[0-2])(\d{2})\.csv$"
CUMULATIVE_MEMBER = r"(?i)^dot([123])_ytd_(0[1-9]|1[0-2])(\d{2})\.csv$"
LEGACY_MEMBER = r"(?i)^TransBorder_\d+_(\d{2})(\d{2})\s*\((\d)\)\.csv$"
