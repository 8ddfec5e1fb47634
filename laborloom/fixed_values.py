"""Published classification tables that every plan joins against.

Fixed values: each table below states official codes, titles and assignments and
must not be edited to suit a query.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Industry hierarchy
# (sector, sector title, supersector, supersector title, domain letter, domain title)
# ---------------------------------------------------------------------------
HIERARCHY = [
    ("21", "Mining", "10", "Mining and Logging", "G", "Goods-producing"),
    ("23", "Construction", "20", "Construction", "G", "Goods-producing"),
    ("31", "Manufacturing", "30", "Manufacturing", "G", "Goods-producing"),
    ("42", "Wholesale Trade", "40", "Trade, Transportation, and Utilities", "S", "Service-providing"),
    ("44", "Retail Trade", "40", "Trade, Transportation, and Utilities", "S", "Service-providing"),
    ("48", "Transportation and Warehousing", "40", "Trade, Transportation, and Utilities", "S", "Service-providing"),
    ("22", "Utilities", "40", "Trade, Transportation, and Utilities", "S", "Service-providing"),
    ("51", "Information", "50", "Information", "S", "Service-providing"),
    ("52", "Finance and Insurance", "55", "Financial Activities", "S", "Service-providing"),
    ("53", "Real Estate", "55", "Financial Activities", "S", "Service-providing"),
    ("54", "Professional and Technical Services", "60", "Professional and Business Services", "S", "Service-providing"),
    ("55", "Management of Companies", "60", "Professional and Business Services", "S", "Service-providing"),
    ("56", "Administrative and Waste Services", "60", "Professional and Business Services", "S", "Service-providing"),
    ("61", "Educational Services", "65", "Private Education and Health Services", "S", "Service-providing"),
    ("62", "Health Care and Social Assistance", "65", "Private Education and Health Services", "S", "Service-providing"),
    ("71", "Arts, Entertainment, and Recreation", "70", "Leisure and Hospitality", "S", "Service-providing"),
    ("72", "Accommodation and Food Services", "70", "Leisure and Hospitality", "S", "Service-providing"),
    ("81", "Other Services", "80", "Other Services", "S", "Service-providing"),
]

# Domains as (code, name, includes government, goods only, supersectors).
DOMAINS = [
    ("00", "Total Non-Farm", True, False, ["10", "20", "30", "40", "50", "55", "60", "65", "70", "80", "90"]),
    ("05", "Total Private", False, False, ["10", "20", "30", "40", "50", "55", "60", "65", "70", "80"]),
    ("06", "Goods-Producing", False, True, ["10", "20", "30"]),
    ("07", "Service-Providing", True, False, ["40", "50", "55", "60", "65", "70", "80", "90"]),
    ("08", "Private Service-Providing", False, False, ["40", "50", "55", "60", "65", "70", "80"]),
]

# Domains built by summing; 00 is published, so it is selected instead.
SUMMED_DOMAINS = ["05", "06", "07", "08"]

# Goods-producing supersectors.
GOODS_SUPERSECTORS = ["10", "20", "30"]

# Six-digit industry codes as (six-digit code, code, type, name, quarterly-census NAICS).
INDUSTRIES = [
    ("000000", "00", "domain", "Total Non-Farm", ""),
    ("050000", "05", "domain", "Total Private", ""),
    ("060000", "06", "domain", "Goods-Producing Industries", ""),
    ("070000", "07", "domain", "Service-Providing Industries", ""),
    ("080000", "08", "domain", "Private Service-Providing", ""),
    ("100000", "10", "supersector", "Natural Resources and Mining", ""),
    ("200000", "20", "supersector", "Construction", ""),
    ("300000", "30", "supersector", "Manufacturing", ""),
    ("400000", "40", "supersector", "Trade, Transportation, and Utilities", ""),
    ("500000", "50", "supersector", "Information", ""),
    ("550000", "55", "supersector", "Financial Activities", ""),
    ("600000", "60", "supersector", "Professional and Business Services", ""),
    ("650000", "65", "supersector", "Education and Health Services", ""),
    ("700000", "70", "supersector", "Leisure and Hospitality", ""),
    ("800000", "80", "supersector", "Other Services", ""),
    ("900000", "90", "supersector", "Government", ""),
    ("102100", "21", "sector", "Mining, quarrying, and oil and gas extraction", "21"),
    ("310000", "31", "sector", "Durable goods", "31"),
    ("320000", "32", "sector", "Nondurable goods", "32"),
    ("414200", "41", "sector", "Wholesale trade", "42"),
    ("420000", "42", "sector", "Retail trade", "44"),
    ("430000", "43", "sector", "Transportation and warehousing", "48"),
    ("442200", "22", "sector", "Utilities", "22"),
    ("555200", "52", "sector", "Finance and insurance", "52"),
    ("555300", "53", "sector", "Real estate and rental and leasing", "53"),
    ("605400", "54", "sector", "Professional, scientific, and technical services", "54"),
    ("605500", "55", "sector", "Management of companies and enterprises", "55"),
    ("605600", "56", "sector", "Administrative and support and waste management", "56"),
    ("656100", "61", "sector", "Private educational services", "61"),
    ("656200", "62", "sector", "Health care and social assistance", "62"),
    ("707100", "71", "sector", "Arts, entertainment, and recreation", "71"),
    ("707200", "72", "sector", "Accommodation and food services", "72"),
    ("909100", "91", "sector", "Federal", "91"),
    ("909200", "92", "sector", "State government", "92"),
    ("909300", "93", "sector", "Local government", "93"),
]

# Government ownership code → sector; all three form supersector 90.
OWNERSHIP_SECTOR = {"1": "91", "2": "92", "3": "93"}
GOVERNMENT_SUPERSECTOR = "90"

# Three-digit manufacturing NAICS by goods kind.
NONDURABLE_SECTOR = "32"
NONDURABLE_NAICS3 = ["311", "312", "313", "314", "315", "316", "322", "323", "324", "325", "326"]
DURABLE_SECTOR = "31"
DURABLE_NAICS3 = ["321", "327", "331", "332", "333", "334", "335", "336", "337", "339"]
MANUFACTURING_SUPERSECTOR = "30"

# Every sector a fact can carry, as (sector, supersector, two-digit NAICS codes).
# Manufacturing comes from three digits and government from ownership, so these have none.
SECTORS = [
    ("21", "10", ["21"]),
    ("23", "20", ["23"]),
    ("31", "30", []),
    ("32", "30", []),
    ("22", "40", ["22"]),
    ("42", "40", ["42"]),
    ("44", "40", ["44", "44-45"]),
    ("48", "40", ["48", "48-49"]),
    ("51", "50", ["51"]),
    ("52", "55", ["52"]),
    ("53", "55", ["53"]),
    ("54", "60", ["54"]),
    ("55", "60", ["55"]),
    ("56", "60", ["56"]),
    ("61", "65", ["61"]),
    ("62", "65", ["62"]),
    ("71", "70", ["71"]),
    ("72", "70", ["72"]),
    ("81", "80", ["81"]),
    ("91", "90", []),
    ("92", "90", []),
    ("93", "90", []),
]

# Supersectors holding exactly one sector.
SINGLE_SECTOR_SUPERSECTORS = {"20": "23", "50": "51", "80": "81"}

# Sub-populations of the quarterly census that add up without overlap, as
# (name, ownership codes, aggregation levels: national and state).
STREAMS = [
    ("total", ["0"], ["10", "50"]),
    ("private", ["5"], ["14", "54"]),
    ("government", ["1", "2", "3"], ["11", "51"]),
    ("manufacturing", ["5"], ["15", "55"]),
]
ALL_INDUSTRIES_NAICS = "10"

# ---------------------------------------------------------------------------
# Turnover survey
# ---------------------------------------------------------------------------

# (survey industry code, code, type)
TURNOVER_INDUSTRIES = [
    ("000000", "00", "national"),
    ("100000", "05", "domain"),
    ("110099", "10", "supersector"),
    ("230000", "20", "supersector"),
    ("300000", "30", "supersector"),
    ("400000", "40", "supersector"),
    ("510000", "50", "supersector"),
    ("510099", "55", "supersector"),
    ("540099", "60", "supersector"),
    ("600000", "65", "supersector"),
    ("700000", "70", "supersector"),
    ("810000", "80", "supersector"),
]

# (element code, label while mapping, label in the output)
TURNOVER_ELEMENTS = [
    ("HI", "hires", "entries"),
    ("TS", "total_separations", "exits"),
]

# Series id layout as (field, first character counted from 1, length).
SERIES_FIELDS = [
    ("seasonal", 3, 1),
    ("industry_code", 4, 6),
    ("state_code", 10, 2),
    ("area_code", 12, 5),
    ("sizeclass_code", 17, 2),
    ("dataelement_code", 19, 2),
    ("ratelevel_code", 21, 1),
]

# ---------------------------------------------------------------------------
# geography
# ---------------------------------------------------------------------------

REGIONS = [("1", "Northeast"), ("2", "Midwest"), ("3", "South"), ("4", "West")]

# (division, name, region)
DIVISIONS = [
    ("1", "New England", "1"),
    ("2", "Middle Atlantic", "1"),
    ("3", "East North Central", "2"),
    ("4", "West North Central", "2"),
    ("5", "South Atlantic", "3"),
    ("6", "East South Central", "3"),
    ("7", "West South Central", "3"),
    ("8", "Mountain", "4"),
    ("9", "Pacific", "4"),
]

# (FIPS, name, division); the two territories belong to no division.
STATES = [
    ("01", "Alabama", "6"),
    ("02", "Alaska", "9"),
    ("04", "Arizona", "8"),
    ("05", "Arkansas", "7"),
    ("06", "California", "9"),
    ("08", "Colorado", "8"),
    ("09", "Connecticut", "1"),
    ("10", "Delaware", "5"),
    ("11", "District of Columbia", "5"),
    ("12", "Florida", "5"),
    ("13", "Georgia", "5"),
    ("15", "Hawaii", "9"),
    ("16", "Idaho", "8"),
    ("17", "Illinois", "3"),
    ("18", "Indiana", "3"),
    ("19", "Iowa", "4"),
    ("20", "Kansas", "4"),
    ("21", "Kentucky", "6"),
    ("22", "Louisiana", "7"),
    ("23", "Maine", "1"),
    ("24", "Maryland", "5"),
    ("25", "Massachusetts", "1"),
    ("26", "Michigan", "3"),
    ("27", "Minnesota", "4"),
    ("28", "Mississippi", "6"),
    ("29", "Missouri", "4"),
    ("30", "Montana", "8"),
    ("31", "Nebraska", "4"),
    ("32", "Nevada", "8"),
    ("33", "New Hampshire", "1"),
    ("34", "New Jersey", "2"),
    ("35", "New Mexico", "8"),
    ("36", "New York", "2"),
    ("37", "North Carolina", "5"),
    ("38", "North Dakota", "4"),
    ("39", "Ohio", "3"),
    ("40", "Oklahoma", "7"),
    ("41", "Oregon", "9"),
    ("42", "Pennsylvania", "2"),
    ("44", "Rhode Island", "1"),
    ("45", "South Carolina", "5"),
    ("46", "South Dakota", "4"),
    ("47", "Tennessee", "6"),
    ("48", "Texas", "7"),
    ("49", "Utah", "8"),
    ("50", "Vermont", "1"),
    ("51", "Virginia", "5"),
    ("53", "Washington", "9"),
    ("54", "West Virginia", "5"),
    ("55", "Wisconsin", "3"),
    ("56", "Wyoming", "8"),
    ("72", "Puerto Rico", None),
    ("78", "Virgin Islands", None),
]

NATIONAL_AREA = "US000"
NATIONAL_CODE = "00"
NATIONAL_NAME = "United States"
