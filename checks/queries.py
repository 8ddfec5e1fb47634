"""Every query as (spark, table folder) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import shapes
from laborloom.plans import decode, jolts, qcew
from laborloom.sources import read_jolts, read_qcew, read_series

Query = Callable[[SparkSession, str], DataFrame]
#: Years of the range scan; the tables cover 1995 to 2001.
YEARS = (1996, 1999)


def over(shape: Query, plan: Callable[[DataFrame], DataFrame]) -> Query:
    """The query that applies ``plan`` to an input shape."""
    return lambda spark, sf_dir: plan(shape(spark, sf_dir))


def geography_counts(bulk: DataFrame) -> DataFrame:
    return qcew.with_geography(qcew.monthly(bulk)).select(
        "area_fips", "geographic_type", "geographic_code", "industry_code", "ref_date", "employment")


def parsed_series(series: DataFrame) -> DataFrame:
    return jolts.parse_series(series.select("series_id", "year", "period"))


QCEW_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "qcew_year_range_scan": lambda bulk: qcew.year_range(bulk, *YEARS),
    "qcew_monthly": qcew.monthly,
    "qcew_geography": geography_counts,
    "qcew_total": qcew.total_rows,
    "qcew_private_sectors": qcew.private_sectors,
    "qcew_govt_sectors": qcew.government_sectors,
    "qcew_mfg_split": qcew.manufacturing_sectors,
    "qcew_sectors": qcew.sectors,
    "qcew_supersectors": qcew.supersectors,
    "qcew_domains": qcew.domains,
    "qcew_hierarchy": qcew.hierarchy,
    "qcew_divisions": qcew.divisions,
    "qcew_regions": qcew.regions,
    "qcew_to_ces": qcew.to_ces,
    "qcew_to_ces_one_scan": lambda bulk: qcew.to_ces(bulk, one_scan=True),
    "qcew_summary": lambda bulk: qcew.summary(qcew.to_ces(bulk)),
    "qcew_hierarchy_decode": decode.hierarchy_titles,
    "qcew_industry_decode": decode.industry_names,
    "qcew_domain_decode": decode.domain_names,
    "qcew_sector_codes_seen": decode.sector_codes_seen,
    "qcew_supersector_codes_seen": decode.supersector_codes_seen,
    "qcew_components_seen": decode.components_seen,
    "geo_enrich": decode.place_names,
    "geo_name_lookup": decode.fips_by_name,
}

JOLTS_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "jolts_mapped": jolts.mapped,
    "jolts_implied_employment": jolts.supersector_employment,
    "jolts_domain06": jolts.domain_06,
    "jolts_domain08": jolts.domain_08,
    "jolts_to_ces": lambda survey: jolts.ordered(jolts.to_ces(survey)),
    "jolts_summary": lambda survey: jolts.summary(jolts.to_ces(survey)),
}

SERIES_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "jolts_parse_series": parsed_series,
    "jolts_series_filter": jolts.select_series,
}

HARD_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "jolts_implied_employment_hard": jolts.supersector_employment,
    "jolts_domain06_hard": jolts.domain_06,
}

#: Through files and the readers.
FILE_QUERIES: dict[str, Query] = {
    "qcew_clustered_years": lambda spark, sf_dir: read_qcew(spark, shapes.clustered_files(spark, sf_dir), *YEARS),
    "jolts_mapped_files": lambda spark, sf_dir: jolts.mapped(read_jolts(spark, shapes.survey_files(spark, sf_dir))),
    "jolts_series_ingest": lambda spark, sf_dir: jolts.select_series(
        read_series(spark, shapes.series_files(spark, sf_dir)), strict=False),
    "jolts_series_rejects": lambda spark, sf_dir: jolts.series_rejects(
        read_series(spark, shapes.series_files(spark, sf_dir))),
}

QUERIES: dict[str, Query] = {
    name: over(shape, plan)
    for shape, plans in [
        (shapes.qcew_bulk, QCEW_QUERIES),
        (shapes.jolts_survey, JOLTS_QUERIES),
        (shapes.jolts_series, SERIES_QUERIES),
        (shapes.hard_survey, HARD_QUERIES),
    ]
    for name, plan in plans.items()
} | FILE_QUERIES
