"""Quarterly census of employment → monthly employment by industry and geography.

Two passes over the input, whatever its size:

1. every row that feeds a sum is reduced to (geography, sector, quarter) cells while the
   three months still sit side by side, so the unpivot triples cells and not the scan;
   the cells are then fanned out over industries and geographies and summed once more;
2. published totals are selected as they are, row by row.

With ``one_scan`` the totals go through the first pass's shuffle with their counts in the key
and their number beside them, and are written out as often again behind it. That reads the
input once, but shuffles what the second pass would only filter.

Employment counts are integers, hence exact as doubles in any order of summation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborloom import dimensions, schemas
from laborloom import fixed_values as fixed
from laborloom.functions import area_geography, is_any, n_unique, positive_count
from laborloom.operators import (
    CELL,
    MONTH_COLUMNS,
    lookup,
    months_long,
    over_geographies,
    over_industries,
    repeated,
    shared,
    sum_cells,
)

OUTPUT_COLUMNS = schemas.QCEW_OUTPUT.fieldNames()
ROW_KEY = ["geographic_type", "geographic_code", "industry_type", "industry_code"]
SECTOR_STREAMS = ["private", "government", "manufacturing"]
ALL_STREAMS = ["total", *SECTOR_STREAMS]
INDUSTRY_LEVELS = ["sector", "supersector", "domain"]
GEOGRAPHY_LEVELS = ["division", "region"]


# --- rows of the scan --------------------------------------------------------


def year_range(bulk: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Rows of the years ``start_year`` to ``end_year``, both included.

    The number decides, however the text spells it; on a partitioning by year it prunes. Text
    that is no number stops the query in any session.
    """
    # The first condition can prune folders, the second can stop the query.
    maybe = F.coalesce(F.expr("try_cast(year AS INT)").between(start_year, end_year), F.lit(True))
    return bulk.where(maybe).where(F.expr(schemas.strict_cast("year", "INT")).between(start_year, end_year))


def years_of(stored: DataFrame, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """A stored table in the input contract, cut to the given years where they are given.

    Where the table has the years' numbers, their folders or statistics prune; the text is
    read again on the rows that are left, so it still decides.
    """
    if start_year is None and end_year is None:
        return schemas.conform(stored, schemas.QCEW_INPUT)
    first, last = (-(1 << 31) if start_year is None else start_year), ((1 << 31) - 1 if end_year is None else end_year)
    if schemas.YEAR_NUMBER in stored.columns:
        stored = stored.where(F.col(schemas.YEAR_NUMBER).between(first, last))
    return year_range(schemas.conform(stored, schemas.QCEW_INPUT), first, last)


def monthly(bulk: DataFrame) -> DataFrame:
    """Long monthly rows of the whole input, source codes kept."""
    keys = ["area_fips", "own_code", "industry_code", "agglvl_code", "year", "qtr"]
    return months_long(_numeric(bulk, *keys[:4]), keys)


def with_geography(rows: DataFrame) -> DataFrame:
    return rows.select("*", *area_geography())


def total_rows(bulk: DataFrame) -> DataFrame:
    """Published all-ownership totals: selected, never summed, duplicates included."""
    totals = _numeric(
        bulk.where(_in_streams(["total"])),
        *area_geography(),
        F.lit("national").alias("industry_type"),
        F.lit(fixed.NATIONAL_CODE).alias("industry_code"),
    )
    return _rows(totals)


def _in_streams(streams: Sequence[str]) -> str:
    """Membership in sub-populations, as a predicate on scan columns."""
    return " OR ".join(f"({is_any('own_code', owners)} AND {is_any('agglvl_code', levels)})"
                       for name, owners, levels in fixed.STREAMS if name in streams)


def _numeric(bulk: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` with the quarter and the three counts as numbers."""
    return schemas.conform(bulk, schemas.QCEW_INPUT).select(
        *columns, *[F.expr(schemas.strict_cast(c, "INT")).alias(c) for c in ("year", "qtr")],
        *[positive_count(m).alias(m) for m in MONTH_COLUMNS])


def _rows(cells: DataFrame) -> DataFrame:
    return months_long(cells, ROW_KEY).select(*OUTPUT_COLUMNS)


# --- cells -------------------------------------------------------------------


def classified(bulk: DataFrame, streams: Sequence[str] = SECTOR_STREAMS) -> DataFrame:
    """Input rows of the wanted sub-populations with geography and industry, not yet summed."""
    naics = F.expr(f"CASE WHEN own_code = '0' THEN '{dimensions.ANY_NAICS}' ELSE industry_code END AS naics")
    keyed = _numeric(bulk.where(_in_streams(streams)), *area_geography(), "own_code", "agglvl_code", naics)
    crosswalk = dimensions.sector_crosswalk(bulk.sparkSession, streams)
    return lookup(keyed, crosswalk, ["own_code", "agglvl_code", "naics"]).select(*CELL, *MONTH_COLUMNS)


def sector_cells(bulk: DataFrame, streams: Sequence[str] = SECTOR_STREAMS) -> DataFrame:
    return sum_cells(classified(bulk, streams))


def _sector_rows(cells: DataFrame) -> DataFrame:
    return _rows(cells.withColumn("industry_type", F.lit("sector")))


def _cells_and_totals(bulk: DataFrame, one_scan: bool) -> tuple[DataFrame, DataFrame]:
    """Cells of all sub-populations and the rows of :func:`total_rows`."""
    if not one_scan:
        return sector_cells(bulk, ALL_STREAMS), total_rows(bulk)
    published = F.when(F.col("industry_code") == fixed.NATIONAL_CODE, F.struct(*MONTH_COLUMNS)).alias("published")
    cells = shared(classified(bulk, ALL_STREAMS).groupBy(*CELL, published).agg(
        *[F.sum(m).alias(m) for m in MONTH_COLUMNS], F.count(F.lit(1)).alias("copies")))
    totals = cells.where(F.col("published").isNotNull()).select(
        *CELL, "published.*", "copies", F.lit("national").alias("industry_type"))
    rows = repeated(months_long(totals, [*ROW_KEY, "copies"]), "copies")
    return cells.drop("published", "copies"), rows.select(*OUTPUT_COLUMNS)


# --- stages ------------------------------------------------------------------


def private_sectors(bulk: DataFrame) -> DataFrame:
    return _sector_rows(sector_cells(bulk, ["private"]))


def government_sectors(bulk: DataFrame) -> DataFrame:
    return _sector_rows(sector_cells(bulk, ["government"]))


def manufacturing_sectors(bulk: DataFrame) -> DataFrame:
    """Durable (31) and nondurable (32) manufacturing from three-digit industries."""
    return _sector_rows(sector_cells(bulk, ["manufacturing"]))


def sectors(bulk: DataFrame) -> DataFrame:
    return _sector_rows(sector_cells(bulk))


def supersectors(bulk: DataFrame) -> DataFrame:
    return _rows(sum_cells(over_industries(sector_cells(bulk), ["supersector"]), "industry_type"))


def domains(bulk: DataFrame, codes: Sequence[str] = fixed.SUMMED_DOMAINS) -> DataFrame:
    """Domains summed from their supersectors; 00 is published and not among them."""
    unknown = set(codes) - set(fixed.SUMMED_DOMAINS)
    if unknown:
        raise ValueError(f"Not a summed domain: {', '.join(sorted(unknown))}")
    cells = over_industries(sector_cells(bulk), ["domain"]).where(F.col("industry_code").isin(list(codes)))
    return _rows(sum_cells(cells, "industry_type"))


def hierarchy(bulk: DataFrame) -> DataFrame:
    """National and state rows at every industry level."""
    summed = _rows(sum_cells(over_industries(sector_cells(bulk), INDUSTRY_LEVELS), "industry_type"))
    return summed.unionByName(total_rows(bulk))


def _all_levels(cells: DataFrame) -> DataFrame:
    """Cells fanned out to sector, supersector and domain, with summed totals marked ``national``."""
    return over_industries(cells, ["national", *INDUSTRY_LEVELS])


def divisions(bulk: DataFrame) -> DataFrame:
    return _rows(sum_cells(over_geographies(_all_levels(sector_cells(bulk, ALL_STREAMS)), ["division"]), "industry_type"))


def regions(bulk: DataFrame) -> DataFrame:
    return _rows(sum_cells(over_geographies(_all_levels(sector_cells(bulk, ALL_STREAMS)), ["region"]), "industry_type"))


def to_ces(bulk: DataFrame, one_scan: bool = False) -> DataFrame:
    """The whole pipeline: employment in thousands at every industry and geography level."""
    # Totals reach divisions and regions as sums but stay unsummed at their own level.
    own_level = F.col("industry_type") != "national"
    cells, totals = _cells_and_totals(bulk, one_scan)
    summed = _rows(sum_cells(over_geographies(_all_levels(cells), GEOGRAPHY_LEVELS, keep_own=own_level), "industry_type"))
    return in_thousands(summed.unionByName(totals))


def in_thousands(rows: DataFrame) -> DataFrame:
    return rows.withColumn("employment", F.col("employment") / 1000.0)


def summary(rows: DataFrame) -> DataFrame:
    """Row count and exact number of distinct industries of a result."""
    # Counting per industry first keeps the distinct count off the full-width rows.
    counts = rows.groupBy("industry_code").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                      n_unique("industry_code").alias("n_industries"))


def is_empty(bulk: DataFrame) -> bool:
    """Whether the pipeline would give no row; stops at the first input row that counts."""
    return classified(bulk, ALL_STREAMS).where(F.greatest(*MONTH_COLUMNS) > 0).isEmpty()
