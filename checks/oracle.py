"""The SQL each query must agree with.

Written stage by stage: unpivot first, one aggregate per sub-population, one per domain,
regions from divisions, and a plain self-join of levels and rates. The Spark plans reach
the same results in another order, so agreement says something.
"""

from __future__ import annotations

from collections.abc import Iterable

from checks import shapes
from checks.queries import YEARS
from laborloom import dimensions
from laborloom import fixed_values as fixed


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + str(value).replace("'", "''") + "'"


def table(name: str, columns: str, rows: Iterable[Iterable[object]]) -> str:
    """A constant table as a common table expression."""
    body = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def at(codes: list[str], index: str) -> str:
    return f"([{', '.join(map(_literal, codes))}])[({index}) % {len(codes)} + 1]"


def in_list(codes: Iterable[str]) -> str:
    return "(" + ", ".join(map(_literal, codes)) + ")"


def query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- quarterly census --------------------------------------------------------

_MONTH = "CASE WHEN (month(l_shipdate) - 1) % 3 + 1 = {k} THEN CASE WHEN l_discount = 0 THEN '0' " \
         "ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END END AS month{k}_emplvl"

BULK = f"""bulk AS (
  SELECT CASE WHEN l_partkey % 3 = 0 THEN 'US000'
              ELSE {at(shapes.STATE_CODES, 'l_partkey')} || '000' END AS area_fips,
         CASE WHEN l_linenumber <= 3 THEN CAST(l_linenumber AS VARCHAR)
              WHEN l_linenumber IN (4, 5, 6) THEN '5' ELSE '0' END AS own_code,
         CASE WHEN l_linenumber <= 3 THEN CASE WHEN l_suppkey % 11 = 0 THEN '102' ELSE '10' END
              WHEN l_linenumber IN (4, 5) THEN {at(shapes.NAICS2_CODES, 'l_suppkey')}
              WHEN l_linenumber = 6 THEN {at(shapes.NAICS3_CODES, 'l_suppkey')}
              ELSE '10' END AS industry_code,
         CASE WHEN l_linenumber <= 3 THEN CASE WHEN l_partkey % 3 = 0 THEN '11' ELSE '51' END
              WHEN l_linenumber IN (4, 5) THEN CASE WHEN l_partkey % 3 = 0 THEN '14' ELSE '54' END
              WHEN l_linenumber = 6 THEN CASE WHEN l_partkey % 3 = 0 THEN '15' ELSE '55' END
              ELSE CASE WHEN l_partkey % 3 = 0 THEN '10' ELSE '50' END END AS agglvl_code,
         CAST(year(l_shipdate) AS VARCHAR) AS year,
         CAST(quarter(l_shipdate) AS VARCHAR) AS qtr,
         {_MONTH.format(k=1)}, {_MONTH.format(k=2)}, {_MONTH.format(k=3)}
  FROM lineitem)"""

_MONTH_ROWS = "\n  UNION ALL\n".join(
    f"  SELECT area_fips, own_code, industry_code, agglvl_code, CAST(year AS INTEGER) AS year, "
    f"CAST(qtr AS INTEGER) AS qtr, {k} AS month_offset, CAST(month{k + 1}_emplvl AS DOUBLE) AS employment FROM bulk"
    for k in range(3))

MONTHLY = f"""month_rows AS (
{_MONTH_ROWS}),
monthly AS (
  SELECT area_fips, own_code, industry_code, agglvl_code, year, qtr, employment,
         make_date(year, (qtr - 1) * 3 + 1 + month_offset, 12) AS ref_date,
         CASE WHEN area_fips = 'US000' THEN 'national' ELSE 'state' END AS geographic_type,
         CASE WHEN area_fips = 'US000' THEN '00' ELSE substr(area_fips, 1, 2) END AS geographic_code
  FROM month_rows WHERE employment > 0)"""

_ROW = "ref_date, geographic_type, geographic_code, industry_type, industry_code, employment"


def _stream(name: str, where: str, crosswalk: str, on: str) -> str:
    return f"""{name} AS (
  SELECT ref_date, geographic_type, geographic_code, 'sector' AS industry_type,
         c.sector AS industry_code, CAST(sum(employment) AS DOUBLE) AS employment
  FROM monthly m JOIN {crosswalk} c ON {on}
  WHERE {where} GROUP BY ref_date, geographic_type, geographic_code, c.sector)"""


TOTAL = f"""total AS (
  SELECT ref_date, geographic_type, geographic_code, 'national' AS industry_type, '00' AS industry_code, employment
  FROM monthly WHERE own_code = '0' AND agglvl_code IN ('10', '50'))"""
PRIVATE = [
    table("naics2", "code, sector", dimensions.naics_sector().items()),
    _stream("private", "own_code = '5' AND agglvl_code IN ('14', '54')", "naics2", "m.industry_code = c.code"),
]
GOVERNMENT = [
    table("ownership", "code, sector", fixed.OWNERSHIP_SECTOR.items()),
    _stream("government", "own_code IN ('1', '2', '3') AND agglvl_code IN ('11', '51') AND industry_code = '10'",
            "ownership", "m.own_code = c.code"),
]
MANUFACTURING = [
    table("naics3", "code, sector", dimensions.manufacturing_sector().items()),
    _stream("manufacturing", "own_code = '5' AND agglvl_code IN ('15', '55')", "naics3", "m.industry_code = c.code"),
]
FACTS = [BULK, MONTHLY]
SECTORS = [*FACTS, *PRIVATE, *GOVERNMENT, *MANUFACTURING, f"""sectors AS (
  SELECT {_ROW} FROM private UNION ALL SELECT {_ROW} FROM government UNION ALL SELECT {_ROW} FROM manufacturing)"""]
SUPERSECTORS = [*SECTORS,
    table("parents", "sector, supersector", dimensions.sector_supersector().items()),
    """supersectors AS (
  SELECT ref_date, geographic_type, geographic_code, 'supersector' AS industry_type,
         p.supersector AS industry_code, CAST(sum(employment) AS DOUBLE) AS employment
  FROM sectors s JOIN parents p ON s.industry_code = p.sector
  GROUP BY ref_date, geographic_type, geographic_code, p.supersector)"""]
_DOMAIN_UNION = "\n  UNION ALL\n".join(
    f"  SELECT ref_date, geographic_type, geographic_code, 'domain' AS industry_type, '{domain}' AS industry_code, "
    f"CAST(sum(employment) AS DOUBLE) AS employment FROM supersectors "
    f"WHERE industry_code IN {in_list(dimensions.domain_supersectors(domain))} "
    f"GROUP BY ref_date, geographic_type, geographic_code"
    for domain in fixed.SUMMED_DOMAINS)
DOMAINS = [*SUPERSECTORS, f"domains AS (\n{_DOMAIN_UNION})"]
HIERARCHY = [*DOMAINS, TOTAL, f"""hierarchy AS (
  SELECT {_ROW} FROM total UNION ALL SELECT {_ROW} FROM sectors
  UNION ALL SELECT {_ROW} FROM supersectors UNION ALL SELECT {_ROW} FROM domains)"""]
DIVISIONS = [*HIERARCHY,
    table("state_division", "fips, division", dimensions.state_division().items()),
    """divisions AS (
  SELECT ref_date, 'division' AS geographic_type, d.division AS geographic_code, industry_type, industry_code,
         CAST(sum(employment) AS DOUBLE) AS employment
  FROM hierarchy h JOIN state_division d ON h.geographic_code = d.fips
  WHERE h.geographic_type = 'state' GROUP BY ref_date, industry_type, industry_code, d.division)"""]
REGIONS = [*DIVISIONS,
    table("division_region", "division, region", dimensions.division_region().items()),
    """regions AS (
  SELECT ref_date, 'region' AS geographic_type, r.region AS geographic_code, industry_type, industry_code,
         CAST(sum(employment) AS DOUBLE) AS employment
  FROM divisions d JOIN division_region r ON d.geographic_code = r.division
  GROUP BY ref_date, industry_type, industry_code, r.region)"""]
CES = [*REGIONS, f"""everywhere AS (
  SELECT {_ROW} FROM hierarchy UNION ALL SELECT {_ROW} FROM divisions UNION ALL SELECT {_ROW} FROM regions),
ces AS (
  SELECT ref_date, geographic_type, geographic_code, industry_type, industry_code,
         employment / 1000.0 AS employment FROM everywhere)"""]

_HIERARCHY_TABLE = table(
    "titles", "sector_code, sector_title, supersector_code, supersector_title, domain_code, domain_title",
    fixed.HIERARCHY)
_INDUSTRY_TABLE = table("industries", "ces_code, industry_code, industry_type, industry_name, qcew_naics",
                        fixed.INDUSTRIES)
_DOMAIN_TABLE = table("domain_flags", "domain_code, name, includes_govt, goods_only",
                      [row[:4] for row in fixed.DOMAINS])
_COMPONENT_TABLE = table("components", "supersector_code, sector_code", [
    (code, sector) for code, sectors in dimensions.supersector_components().items() for sector in sectors])
_PLACE_TABLES = [
    table("states", "fips, state_name", [row[:2] for row in fixed.STATES]),
    table("state_division", "fips, division", dimensions.state_division().items()),
    table("division_names", "division, division_name", [row[:2] for row in fixed.DIVISIONS]),
    table("division_region", "division, region", dimensions.division_region().items()),
    table("region_names", "region, region_name", fixed.REGIONS),
]
_AREA_TABLE = table("areas", "area_name, fips", [
    (fixed.NATIONAL_NAME, fixed.NATIONAL_CODE), *((name, fips) for fips, name, _ in fixed.STATES)])

QCEW_SQL = {
    "qcew_year_range_scan": query([BULK], f"""
        SELECT area_fips, own_code, industry_code, agglvl_code, year, qtr,
               month1_emplvl, month2_emplvl, month3_emplvl
        FROM bulk WHERE CAST(year AS INTEGER) BETWEEN {YEARS[0]} AND {YEARS[1]}"""),
    "qcew_monthly": query(FACTS, """
        SELECT area_fips, own_code, industry_code, agglvl_code, year, qtr, ref_date, employment FROM monthly"""),
    "qcew_geography": query(FACTS, """
        SELECT area_fips, geographic_type, geographic_code, industry_code, ref_date, employment FROM monthly"""),
    "qcew_total": query([*FACTS, TOTAL], f"SELECT {_ROW} FROM total"),
    "qcew_private_sectors": query([*FACTS, *PRIVATE], f"SELECT {_ROW} FROM private"),
    "qcew_govt_sectors": query([*FACTS, *GOVERNMENT], f"SELECT {_ROW} FROM government"),
    "qcew_mfg_split": query([*FACTS, *MANUFACTURING], f"SELECT {_ROW} FROM manufacturing"),
    "qcew_sectors": query(SECTORS, f"SELECT {_ROW} FROM sectors"),
    "qcew_supersectors": query(SUPERSECTORS, f"SELECT {_ROW} FROM supersectors"),
    "qcew_domains": query(DOMAINS, f"SELECT {_ROW} FROM domains"),
    "qcew_hierarchy": query(HIERARCHY, f"SELECT {_ROW} FROM hierarchy"),
    "qcew_divisions": query(DIVISIONS, f"SELECT {_ROW} FROM divisions"),
    "qcew_regions": query(REGIONS, f"SELECT {_ROW} FROM regions"),
    "qcew_to_ces": query(CES, f"SELECT {_ROW} FROM ces"),
    "qcew_to_ces_one_scan": query(CES, f"SELECT {_ROW} FROM ces"),
    "qcew_summary": query(CES, """
        SELECT count(*) AS n_rows, count(DISTINCT industry_code) AS n_industries FROM ces"""),
    "qcew_hierarchy_decode": query([*SECTORS, _HIERARCHY_TABLE], f"""
        SELECT {_ROW}, sector_title, supersector_code, supersector_title, domain_code, domain_title
        FROM sectors LEFT JOIN titles ON sectors.industry_code = titles.sector_code"""),
    "qcew_industry_decode": query([*CES, _INDUSTRY_TABLE], """
        SELECT c.*, i.ces_code, i.industry_name FROM ces c LEFT JOIN industries i
          ON (c.industry_type = 'sector' AND i.industry_type = 'sector' AND c.industry_code = i.qcew_naics)
          OR (c.industry_type = 'national' AND i.industry_type = 'domain' AND c.industry_code = i.industry_code)
          OR (c.industry_type IN ('supersector', 'domain') AND c.industry_type = i.industry_type
              AND c.industry_code = i.industry_code)"""),
    "qcew_domain_decode": query([*DOMAINS, _DOMAIN_TABLE], f"""
        SELECT {_ROW}, name, includes_govt, goods_only
        FROM domains JOIN domain_flags ON domains.industry_code = domain_flags.domain_code"""),
    "qcew_sector_codes_seen": query([*SECTORS, _HIERARCHY_TABLE], """
        SELECT DISTINCT industry_code AS sector_code FROM sectors
        WHERE industry_code IN (SELECT sector_code FROM titles)"""),
    "qcew_supersector_codes_seen": query([*SECTORS, _HIERARCHY_TABLE], """
        SELECT DISTINCT supersector_code FROM sectors JOIN titles ON industry_code = sector_code"""),
    "qcew_components_seen": query([*SECTORS, _COMPONENT_TABLE], """
        SELECT supersector_code, list_sort(list(DISTINCT sector_code)) AS sector_codes
        FROM sectors JOIN components ON industry_code = sector_code GROUP BY supersector_code"""),
    "geo_enrich": query([*SECTORS, *_PLACE_TABLES], f"""
        SELECT {_ROW}, state_name, d.division AS division_code, division_name,
               r.region AS region_code, region_name
        FROM sectors s LEFT JOIN states ON s.geographic_code = states.fips
        LEFT JOIN state_division d ON s.geographic_code = d.fips
        LEFT JOIN division_names USING (division) LEFT JOIN division_region r USING (division)
        LEFT JOIN region_names USING (region)
        WHERE geographic_type = 'state'"""),
    "geo_name_lookup": query([*SECTORS, _PLACE_TABLES[0], _AREA_TABLE], """
        SELECT areas.area_name, areas.fips, n.industry_code, n.ref_date, n.employment
        FROM (SELECT CASE WHEN geographic_type = 'national' THEN 'United States' ELSE state_name END AS area_name,
                     industry_code, ref_date, employment
              FROM sectors LEFT JOIN states ON geographic_code = fips) n
        JOIN areas ON n.area_name = areas.area_name"""),
}

# --- turnover survey ---------------------------------------------------------

_UNMAPPED = len(shapes.SURVEY_CODES) - 1

SURVEY = f"""base AS (
  SELECT {at(shapes.SURVEY_STATES, 'l_partkey')} AS state_code, 2 + l_suppkey % 11 AS ordinal,
         {at(shapes.SURVEY_ELEMENTS, 'l_linenumber')} AS dataelement_code,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS ref_date, l_quantity
  FROM lineitem),
levels AS (
  SELECT state_code, dataelement_code, ref_date, ordinal, CAST(sum(l_quantity) AS DOUBLE) AS level
  FROM base GROUP BY ALL
  UNION ALL
  SELECT state_code, dataelement_code, ref_date, 1, CAST(sum(l_quantity) AS DOUBLE)
  FROM base WHERE ordinal <> {_UNMAPPED} GROUP BY ALL
  UNION ALL
  SELECT state_code, dataelement_code, ref_date, 0, CAST(sum(l_quantity) AS DOUBLE)
  FROM base GROUP BY ALL),
survey AS (
  SELECT state_code, {at(shapes.SURVEY_CODES, 'ordinal')} AS industry_code, dataelement_code,
         'L' AS ratelevel_code, ref_date, level AS value FROM levels
  UNION ALL
  SELECT state_code, {at(shapes.SURVEY_CODES, 'ordinal')}, dataelement_code, 'R', ref_date,
         CASE WHEN ordinal = 1 THEN 0.5::DOUBLE
              ELSE pow(2.0::DOUBLE, ((ordinal + month(ref_date)) % 5 - 1)::DOUBLE) END
  FROM levels WHERE ordinal = 1 OR (ordinal * 7 + month(ref_date)) % 13 <> 0)"""

MAPPED = [SURVEY,
    table("turnover_industries", "source, code, kind", fixed.TURNOVER_INDUSTRIES),
    table("turnover_elements", "source, label", [row[:2] for row in fixed.TURNOVER_ELEMENTS]),
    """mapped AS (
  SELECT CASE WHEN state_code = '00' THEN 'national' ELSE 'state' END AS geographic_type,
         state_code AS geographic_code, i.kind AS industry_type, i.code AS industry_code,
         CASE WHEN ratelevel_code = 'L' THEN 'level' ELSE 'rate' END AS rate_or_level,
         e.label AS data_element, ref_date, value
  FROM survey s JOIN turnover_industries i ON s.industry_code = i.source
  JOIN turnover_elements e ON s.dataelement_code = e.source)"""]
PAIRS = [*MAPPED, """pairs AS (
  SELECT l.geographic_type, l.geographic_code, l.industry_code, l.data_element, l.ref_date,
         l.value AS level_value, r.value AS rate_value, l.value * 100.0::DOUBLE / r.value AS employment
  FROM mapped l JOIN mapped r
    ON l.geographic_type = r.geographic_type AND l.geographic_code = r.geographic_code
   AND l.industry_code = r.industry_code AND l.data_element = r.data_element AND l.ref_date = r.ref_date
  WHERE l.geographic_type = 'national' AND l.industry_type = 'supersector' AND r.industry_type = 'supersector'
    AND l.rate_or_level = 'level' AND r.rate_or_level = 'rate')"""]
_GROUP = "geographic_type, geographic_code, data_element, ref_date"
GOODS = [*PAIRS, f"""goods AS (
  SELECT {_GROUP}, CAST(sum(level_value) AS DOUBLE) AS level, CAST(sum(employment) AS DOUBLE) AS employment
  FROM pairs WHERE industry_code IN {in_list(fixed.GOODS_SUPERSECTORS)} GROUP BY ALL)"""]


def _domain(name: str, source: str, code: str) -> str:
    shared = "geographic_type, geographic_code, 'domain' AS industry_type, " \
             f"'{code}' AS industry_code"
    return f"""{name} AS (
  SELECT {shared}, 'level' AS rate_or_level, data_element, ref_date, level AS value FROM {source}
  UNION ALL
  SELECT {shared}, 'rate', data_element, ref_date, level / employment * 100.0::DOUBLE FROM {source})"""


DOMAIN_06 = [*GOODS, _domain("domain_06", "goods", "06")]
DOMAIN_08 = [*DOMAIN_06, """private AS (
  SELECT l.geographic_type, l.geographic_code, l.data_element, l.ref_date, l.value AS level,
         l.value * 100.0::DOUBLE / r.value AS employment
  FROM mapped l JOIN mapped r
    ON l.geographic_type = r.geographic_type AND l.geographic_code = r.geographic_code
   AND l.data_element = r.data_element AND l.ref_date = r.ref_date
  WHERE l.geographic_type = 'national' AND l.industry_code = '05' AND r.industry_code = '05'
    AND l.rate_or_level = 'level' AND r.rate_or_level = 'rate'),
private_services AS (
  SELECT p.geographic_type, p.geographic_code, p.data_element, p.ref_date,
         p.level - g.level AS level, p.employment - g.employment AS employment
  FROM private p JOIN goods g
    ON p.geographic_type = g.geographic_type AND p.geographic_code = g.geographic_code
   AND p.data_element = g.data_element AND p.ref_date = g.ref_date)""",
    _domain("domain_08", "private_services", "08")]
_MAPPED_ROW = "geographic_type, geographic_code, industry_type, industry_code, rate_or_level, data_element, " \
              "ref_date, value"
TURNOVER = [*DOMAIN_08, f"""combined AS (
  SELECT {_MAPPED_ROW} FROM mapped UNION ALL SELECT {_MAPPED_ROW} FROM domain_06
  UNION ALL SELECT {_MAPPED_ROW} FROM domain_08),
turnover AS (
  SELECT geographic_type, geographic_code, industry_type, industry_code, rate_or_level AS rate_level,
         CASE data_element WHEN 'hires' THEN 'entries' WHEN 'total_separations' THEN 'exits'
              ELSE data_element END AS data_element, ref_date, value
  FROM combined)"""]

JOLTS_SQL = {
    "jolts_mapped": query(MAPPED, f"SELECT {_MAPPED_ROW} FROM mapped"),
    "jolts_implied_employment": query(PAIRS, """
        SELECT geographic_type, geographic_code, industry_code, data_element, ref_date,
               CAST(sum(level_value) AS DOUBLE) AS level_value, rate_value, count(*) AS pairs,
               CAST(sum(employment) AS DOUBLE) AS employment
        FROM pairs GROUP BY geographic_type, geographic_code, industry_code, data_element, ref_date, rate_value"""),
    "jolts_domain06": query(DOMAIN_06, f"SELECT {_MAPPED_ROW} FROM domain_06"),
    "jolts_domain08": query(DOMAIN_08, f"SELECT {_MAPPED_ROW} FROM domain_08"),
    "jolts_to_ces": query(TURNOVER, """
        SELECT geographic_type, geographic_code, industry_type, industry_code, rate_level, data_element,
               ref_date, value
        FROM turnover ORDER BY geographic_type, geographic_code, industry_type, industry_code, ref_date,
               rate_level, data_element"""),
    "jolts_summary": query(TURNOVER, """
        SELECT count(*) AS n_rows, count(DISTINCT industry_code) AS n_industries,
               count(DISTINCT geographic_code) AS n_geographies FROM turnover"""),
}

# The survey with repeated, second, zero and missing values in some months.
HARD_SURVEY = SURVEY.replace("survey AS (", "plain AS (") + """,
survey AS (
  SELECT * FROM plain
  UNION ALL SELECT * REPLACE (value + 8 AS value) FROM plain WHERE ratelevel_code = 'L' AND month(ref_date) % 4 = 1
  UNION ALL SELECT * REPLACE (value * 2 AS value) FROM plain WHERE ratelevel_code = 'R' AND month(ref_date) % 6 = 2
  UNION ALL SELECT * FROM plain WHERE ratelevel_code = 'R' AND month(ref_date) % 6 = 2
  UNION ALL SELECT * REPLACE (0.0::DOUBLE AS value) FROM plain WHERE ratelevel_code = 'R' AND month(ref_date) % 6 = 3
  UNION ALL SELECT * REPLACE (NULL::DOUBLE AS value) FROM plain WHERE ratelevel_code = 'L' AND month(ref_date) = 5)"""

HARD_SQL = {f"{name}_hard": JOLTS_SQL[name].replace(SURVEY, HARD_SURVEY)
            for name in ("jolts_implied_employment", "jolts_domain06")}

# --- series files ------------------------------------------------------------

SERIES = f"""series AS (
  SELECT 'JT' || CASE WHEN l_returnflag = 'R' THEN 'U' ELSE 'S' END
         || {at(shapes.SURVEY_CODES, 'l_suppkey')} || {at(shapes.SURVEY_STATES, 'l_partkey')}
         || CASE WHEN l_suppkey % 10 = 0 THEN '12345' ELSE '00000' END
         || CASE WHEN l_quantity >= 45 THEN '01' ELSE '00' END
         || {at(shapes.SURVEY_ELEMENTS, 'l_linenumber')}
         || CASE WHEN l_linestatus = 'O' THEN 'L' ELSE 'R' END AS series_id,
         CAST(year(l_shipdate) AS VARCHAR) AS year,
         'M' || CASE WHEN l_linenumber = 7 THEN '13'
                     ELSE lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') END AS period,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value
  FROM lineitem),
parsed AS (
  SELECT series_id, year, period, value, substr(series_id, 3, 1) AS seasonal,
         substr(series_id, 4, 6) AS industry_code, substr(series_id, 10, 2) AS state_code,
         substr(series_id, 12, 5) AS area_code, substr(series_id, 17, 2) AS sizeclass_code,
         substr(series_id, 19, 2) AS dataelement_code, substr(series_id, 21, 1) AS ratelevel_code
  FROM series)"""

SERIES_SQL = {
    "jolts_parse_series": query([SERIES], """
        SELECT series_id, year, period, seasonal, industry_code, state_code, area_code, sizeclass_code,
               dataelement_code, ratelevel_code FROM parsed"""),
    "jolts_series_filter": query([SERIES], f"""
        SELECT state_code, industry_code, dataelement_code, ratelevel_code,
               make_date(CAST(year AS INTEGER), CAST(substr(period, 2, 2) AS INTEGER), 1) AS ref_date,
               CAST(value AS DOUBLE) AS value
        FROM parsed
        WHERE seasonal = 'S' AND area_code = '00000' AND sizeclass_code = '00' AND ratelevel_code IN ('L', 'R')
          AND industry_code IN {in_list(code for code, _, _ in fixed.TURNOVER_INDUSTRIES)}
          AND dataelement_code IN ('HI', 'TS') AND period <> 'M13'"""),
}

# The same records with faults in some orders' fields, of which the first one counts.
_FAULTY = SERIES.replace(
    "|| CASE WHEN l_linestatus = 'O' THEN 'L' ELSE 'R' END AS series_id",
    "|| CASE WHEN l_orderkey % 79 = 0 THEN '' WHEN l_linestatus = 'O' THEN 'L' ELSE 'R' END AS series_id").replace(
    "CAST(year(l_shipdate) AS VARCHAR) AS year",
    "CASE WHEN l_orderkey % 97 = 0 THEN '20x4' ELSE CAST(year(l_shipdate) AS VARCHAR) END AS year").replace(
    "'M' || CASE WHEN l_linenumber = 7 THEN '13'",
    "CASE WHEN l_orderkey % 83 = 0 THEN 'M1' ELSE 'M' || CASE WHEN l_linenumber = 7 THEN '13'").replace(
    "2, '0') END AS period", "2, '0') END END AS period").replace(
    "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value",
    "CASE WHEN l_orderkey % 89 = 0 THEN 'many' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value")
_SELECTED = SERIES_SQL["jolts_series_filter"].split("WHERE seasonal")[1]
CHECKED = [_FAULTY, f"""checked AS (
  SELECT *, CASE WHEN length(series_id) < 21 THEN 'series id' WHEN period = 'M1' THEN 'period'
                 WHEN selected AND year = '20x4' THEN 'year' WHEN selected AND value = 'many' THEN 'value' END AS problem
  FROM (SELECT *, seasonal{_SELECTED} AS selected FROM parsed))"""]
FILE_SQL = {
    "qcew_clustered_years": QCEW_SQL["qcew_year_range_scan"],
    "jolts_mapped_files": JOLTS_SQL["jolts_mapped"],
    "jolts_series_ingest": query(CHECKED, """
        SELECT state_code, industry_code, dataelement_code, ratelevel_code,
               make_date(CAST(year AS INTEGER), CAST(substr(period, 2, 2) AS INTEGER), 1) AS ref_date,
               CAST(value AS DOUBLE) AS value
        FROM checked WHERE selected AND problem IS NULL"""),
    "jolts_series_rejects": query(CHECKED, """
        SELECT problem, series_id, year, period, value, CAST(NULL AS VARCHAR) AS line
        FROM checked WHERE problem IS NOT NULL"""),
}

ORACLE_SQL: dict[str, str] = {**QCEW_SQL, **JOLTS_SQL, **HARD_SQL, **SERIES_SQL, **FILE_SQL}
