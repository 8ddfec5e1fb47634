"""Dimension tables and crosswalks as DataFrames, built from the fixed values.

A dimension is handed to Spark as an Arrow table, which the planner holds as a local
relation of known size: no parallelized collection, no job, and a proven broadcast bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from laborloom import fixed_values as fixed

#: Every dimension here is a short constant; more rows than this is a programming error.
MAX_DIMENSION_ROWS = 1000

ANY_NAICS = "*"


def dimension(spark: SparkSession, columns: Sequence[str], rows: Iterable[tuple]) -> DataFrame:
    """A constant table that is safe to broadcast."""
    rows = list(rows)
    if not 0 < len(rows) <= MAX_DIMENSION_ROWS:
        raise ValueError(f"a dimension holds 1 to {MAX_DIMENSION_ROWS} rows, not {len(rows)}")
    values = dict(zip(columns, (list(column) for column in zip(*rows))))
    return spark.createDataFrame(pa.table(values))


# --- lookups in plain Python -------------------------------------------------


def sector_codes() -> list[str]:
    """Sorted private sector codes of the hierarchy."""
    return sorted(row[0] for row in fixed.HIERARCHY)


def supersector_codes() -> list[str]:
    """Sorted private supersector codes of the hierarchy."""
    return sorted({row[2] for row in fixed.HIERARCHY})


def supersector_components() -> dict[str, list[str]]:
    """Supersector → sorted sector codes, government included."""
    pairs = [(row[2], row[0]) for row in fixed.HIERARCHY]
    pairs += [(fixed.GOVERNMENT_SUPERSECTOR, sector) for sector in fixed.OWNERSHIP_SECTOR.values()]
    return {
        code: sorted(sector for supersector, sector in pairs if supersector == code)
        for code in sorted({supersector for supersector, _ in pairs})
    }


def domain_supersectors(domain: str) -> list[str]:
    """Supersectors that make up a domain."""
    for code, _, _, _, members in fixed.DOMAINS:
        if code == domain:
            return list(members)
    raise ValueError(f"Unknown domain code: {domain!r}")


def sector_supersector() -> dict[str, str]:
    """Every sector a fact can carry → its supersector, nondurable manufacturing included."""
    return {sector: supersector for sector, supersector, _ in fixed.SECTORS}


def naics_sector() -> dict[str, str]:
    """Two-digit NAICS → private sector; manufacturing comes from three digits instead."""
    return {naics: sector for sector, _, codes in fixed.SECTORS for naics in codes}


def manufacturing_sector() -> dict[str, str]:
    """Three-digit NAICS → durable or nondurable sector."""
    return {
        **dict.fromkeys(fixed.NONDURABLE_NAICS3, fixed.NONDURABLE_SECTOR),
        **dict.fromkeys(fixed.DURABLE_NAICS3, fixed.DURABLE_SECTOR),
    }


def state_names() -> dict[str, str]:
    return {fips: name for fips, name, _ in fixed.STATES}


def state_division() -> dict[str, str]:
    return {fips: division for fips, _, division in fixed.STATES if division}


def division_region() -> dict[str, str]:
    return {division: region for division, _, region in fixed.DIVISIONS}


def state_region() -> dict[str, str]:
    """Every state's region, region by region."""
    found: dict[str, str] = {}
    for division, _, region in fixed.DIVISIONS:
        found.update((fips, region) for fips, _, home in fixed.STATES if home == division)
    return found


# --- dimension tables --------------------------------------------------------


def hierarchy(spark: SparkSession) -> DataFrame:
    columns = ["sector_code", "sector_title", "supersector_code", "supersector_title",
               "domain_code", "domain_title"]
    return dimension(spark, columns, fixed.HIERARCHY)


def industries(spark: SparkSession) -> DataFrame:
    columns = ["ces_code", "industry_code", "industry_type", "industry_name", "qcew_naics"]
    return dimension(spark, columns, fixed.INDUSTRIES)


def domains(spark: SparkSession) -> DataFrame:
    columns = ["domain_code", "name", "includes_govt", "goods_only"]
    return dimension(spark, columns, [row[:4] for row in fixed.DOMAINS])


def domain_members(spark: SparkSession) -> DataFrame:
    rows = [(code, supersector) for code, _, _, _, members in fixed.DOMAINS for supersector in members]
    return dimension(spark, ["domain_code", "supersector_code"], rows)


def components(spark: SparkSession) -> DataFrame:
    """Supersector and sector, with a mark on supersectors listed as holding a single sector."""
    rows = [(code, sector, code in fixed.SINGLE_SECTOR_SUPERSECTORS)
            for code, sectors in supersector_components().items() for sector in sectors]
    return dimension(spark, ["supersector_code", "sector_code", "is_single_sector"], rows)


def states(spark: SparkSession) -> DataFrame:
    """State with its division and region; territories have neither."""
    regions_of = state_region()
    rows = [(fips, name, division, regions_of.get(fips)) for fips, name, division in fixed.STATES]
    return dimension(spark, ["fips", "state_name", "division_code", "region_code"], rows)


def divisions(spark: SparkSession) -> DataFrame:
    return dimension(spark, ["division_code", "division_name", "region_code"], fixed.DIVISIONS)


def regions(spark: SparkSession) -> DataFrame:
    return dimension(spark, ["region_code", "region_name"], fixed.REGIONS)


def areas(spark: SparkSession) -> DataFrame:
    """Area name → FIPS for the states and the nation."""
    rows = [(fixed.NATIONAL_NAME, fixed.NATIONAL_CODE)]
    rows += [(name, fips) for fips, name in state_names().items()]
    return dimension(spark, ["area_name", "fips"], rows)


def turnover_industries(spark: SparkSession) -> DataFrame:
    return dimension(spark, ["source_code", "industry_code", "industry_type"], fixed.TURNOVER_INDUSTRIES)


def turnover_elements(spark: SparkSession) -> DataFrame:
    rows = [row[:2] for row in fixed.TURNOVER_ELEMENTS]
    return dimension(spark, ["dataelement_code", "data_element"], rows)


def sector_crosswalk(spark: SparkSession, streams: Sequence[str]) -> DataFrame:
    """(ownership, aggregation level, NAICS) → industry for the wanted sub-populations.

    No two sub-populations share an (ownership, level), so one join assigns them all.
    Published totals qualify whatever their NAICS and are listed under ``ANY_NAICS``.
    """
    rows = []
    for name, owners, levels in fixed.STREAMS:
        for owner in owners if name in streams else []:
            source = {
                "total": {ANY_NAICS: fixed.NATIONAL_CODE},
                "private": naics_sector(),
                "government": {fixed.ALL_INDUSTRIES_NAICS: fixed.OWNERSHIP_SECTOR.get(owner)},
                "manufacturing": manufacturing_sector(),
            }[name]
            rows += [(owner, level, naics, code) for level in levels for naics, code in source.items()]
    return dimension(spark, ["own_code", "agglvl_code", "naics", "industry_code"], rows)


def industry_closure(spark: SparkSession, levels: Sequence[str]) -> DataFrame:
    """(code, every industry it counts towards) at the wanted ``levels``.

    A sector counts towards itself, its supersector and each summed domain holding that
    supersector; the published total counts towards itself only.
    """
    rows = [(fixed.NATIONAL_CODE, "national", fixed.NATIONAL_CODE)]
    for sector, supersector in sector_supersector().items():
        rows.append((sector, "sector", sector))
        rows.append((sector, "supersector", supersector))
        rows += [(sector, "domain", domain) for domain in fixed.SUMMED_DOMAINS
                 if supersector in domain_supersectors(domain)]
    wanted = [row for row in rows if row[1] in levels]
    return dimension(spark, ["member_code", "industry_type", "industry_code"], wanted)
