"""Job openings and labor turnover → hires and separations by industry.

Two passes over the input. One maps the published rows, without a shuffle. The other reads
the national rows of four industries, reduced at once to distinct observations, from which
two domains are derived: goods-producing (06) by summing its supersectors, private services
(08) as total private (05) less 06. Their rates are rebuilt from implied employment, since
rates do not add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom import dimensions, schemas
from laborloom import fixed_values as fixed
from laborloom.functions import ieee_div, is_any, n_unique, series_columns, state_geography, sum_or_zero
from laborloom.operators import implied_employment, level_rate_pairs, lookup, observations

OUTPUT_COLUMNS = schemas.JOLTS_OUTPUT.fieldNames()
MAPPED_COLUMNS = ["rate_or_level" if c == "rate_level" else c for c in OUTPUT_COLUMNS]
GROUP_KEY = ["geographic_type", "geographic_code", "data_element", "ref_date"]
SORT_KEY = ["geographic_type", "geographic_code", "industry_type", "industry_code", "ref_date",
            "rate_level", "data_element"]
TOTAL_PRIVATE = "05"
DERIVED_FROM = [TOTAL_PRIVATE, *fixed.GOODS_SUPERSECTORS]
SUPERSECTORS = [code for _, code, kind in fixed.TURNOVER_INDUSTRIES if kind == "supersector"]


# --- series files ------------------------------------------------------------


def parse_series(series: DataFrame) -> DataFrame:
    """Adds the fields coded in ``series_id``, which must carry no leading blanks."""
    return series.select("*", *series_columns())


def _in_scope(national_only: bool) -> str:
    return " AND ".join([
        "seasonal = 'S'",
        "period RLIKE '^M(0[1-9]|1[0-2])$'",
        "area_code = '00000'",
        "sizeclass_code = '00'",
        is_any("ratelevel_code", ["L", "R"]),
        is_any("industry_code", _source_codes()),
        is_any("dataelement_code", _source_elements()),
        f"state_code = '{fixed.NATIONAL_CODE}'" if national_only else "true",
    ])


def series_records(series: DataFrame, national_only: bool = False) -> DataFrame:
    """Series records with their fields, whether they are ``selected``, and their ``problem``.

    A problem is a wrong number of fields, an id of another length, a period that is no letter
    and two digits or, in records that would be selected, a year or value that is no number.
    Whatever the session's settings, such a record is neither read as something else nor lost.
    """
    if "line" not in series.columns:
        series = series.withColumn("line", F.lit(None).cast("string"))
    length = sum(size for _, _, size in fixed.SERIES_FIELDS) + len("JT")
    problem = f"""CASE WHEN line IS NOT NULL THEN 'number of fields'
        WHEN series_id IS NULL OR length(series_id) <> {length} THEN 'series id'
        WHEN period IS NULL OR NOT period RLIKE '^[A-Z][0-9][0-9]$' THEN 'period'
        WHEN selected AND (year IS NULL OR NOT year RLIKE '^[0-9]{{4}}$') THEN 'year'
        WHEN selected AND try_cast(value AS DOUBLE) IS NULL THEN 'value' END"""
    scope = F.expr(f"coalesce({_in_scope(national_only)}, false)")
    return parse_series(series).withColumn("selected", scope).withColumn("problem", F.expr(problem))


def select_series(series: DataFrame, national_only: bool = False, strict: bool = True) -> DataFrame:
    """Seasonally adjusted, all-area, all-size monthly observations in the input contract.

    A malformed record stops the query, or is left to :func:`series_rejects` if not ``strict``.
    """
    records = series_records(series, national_only)
    if strict:
        said = "'malformed ' || problem || ': ' || coalesce(line, concat_ws(' ', series_id, year, period, value))"
        good = F.expr(f"CASE WHEN problem IS NULL THEN selected ELSE CAST(raise_error({said}) AS BOOLEAN) END")
    else:
        good = F.expr("selected AND problem IS NULL")
    return records.where(good).selectExpr(
        "state_code", "industry_code", "dataelement_code", "ratelevel_code",
        "make_date(try_cast(year AS INT), try_cast(substring(period, 2, 2) AS INT), 1) AS ref_date",
        "try_cast(value AS DOUBLE) AS value",
    )


def series_rejects(series: DataFrame, national_only: bool = False) -> DataFrame:
    """The malformed records with what is wrong with each."""
    return series_records(series, national_only).where("problem IS NOT NULL").select(
        *schemas.SERIES_REJECT.fieldNames())


# --- published rows ----------------------------------------------------------


def _source_codes(codes: Sequence[str] | None = None) -> list[str]:
    return [source for source, code, _ in fixed.TURNOVER_INDUSTRIES if codes is None or code in codes]


def _source_elements() -> list[str]:
    return [source for source, _, _ in fixed.TURNOVER_ELEMENTS]


def mapped(survey: DataFrame) -> DataFrame:
    """Published rows under common industry codes and readable labels."""
    spark = survey.sparkSession
    # The inner joins imply these filters; stated on the scan's own columns they reach it.
    known = (schemas.conform(survey, schemas.JOLTS_INPUT)
             .where(is_any("industry_code", _source_codes()))
             .where(is_any("dataelement_code", _source_elements()))
             .withColumnRenamed("industry_code", "source_code"))
    coded = lookup(lookup(known, dimensions.turnover_industries(spark), "source_code"),
                   dimensions.turnover_elements(spark), "dataelement_code")
    kind = F.expr("CASE WHEN ratelevel_code = 'L' THEN 'level' ELSE 'rate' END AS rate_or_level")
    return coded.select("*", *state_geography(), kind).select(*MAPPED_COLUMNS)


def national(survey: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Distinct national observations of the given industries, read once for all uses."""
    nation = survey.where(is_any("state_code", [fixed.NATIONAL_CODE])).where(
        is_any("industry_code", _source_codes(codes)))
    return observations(mapped(nation))


# --- derived domains ---------------------------------------------------------


def supersector_employment(survey: DataFrame) -> DataFrame:
    """Employment implied by the national level and rate of each supersector."""
    return implied_employment(national(survey, SUPERSECTORS))


def goods_totals(observed: DataFrame) -> DataFrame:
    """Level and implied employment of 06 over the supersectors having both level and rate."""
    goods = observed.where(F.col("industry_code").isin(fixed.GOODS_SUPERSECTORS))
    return implied_employment(goods).groupBy(*GROUP_KEY).agg(
        sum_or_zero(F.col("level_value")).alias("level"),
        sum_or_zero(F.col("employment")).alias("employment"),
    )


def private_service_totals(observed: DataFrame) -> DataFrame:
    """Level and implied employment of 08, the rest of total private after 06."""
    goods = goods_totals(observed).withColumnsRenamed({"level": "goods_level", "employment": "goods_employment"})
    private = level_rate_pairs(observed.where(F.col("industry_code") == TOTAL_PRIVATE))
    return private.drop("industry_code").join(goods, on=GROUP_KEY).select(
        *GROUP_KEY,
        (F.col("level_value") - F.col("goods_level")).alias("level"),
        (F.col("employment") - F.col("goods_employment")).alias("employment"),
    )


def domain_rows(totals: DataFrame, code: str) -> DataFrame:
    """A level row and a rate row for each total of domain ``code``."""
    rate = ieee_div(F.col("level"), F.col("employment")) * 100.0
    both = F.array(
        F.struct(F.lit("level").alias("rate_or_level"), F.col("level").alias("value")),
        F.struct(F.lit("rate").alias("rate_or_level"), rate.alias("value")),
    )
    return totals.select(
        "*", F.lit("domain").alias("industry_type"), F.lit(code).alias("industry_code"), F.inline(both)
    ).select(*MAPPED_COLUMNS)


def domain_06(survey: DataFrame) -> DataFrame:
    return domain_rows(goods_totals(national(survey, fixed.GOODS_SUPERSECTORS)), "06")


def domain_08(survey: DataFrame) -> DataFrame:
    return domain_rows(private_service_totals(national(survey, DERIVED_FROM)), "08")


# --- whole pipeline ----------------------------------------------------------


def to_ces(survey: DataFrame) -> DataFrame:
    """Published and derived rows, in no particular order."""
    labels = {label: output for _, label, output in fixed.TURNOVER_ELEMENTS}
    observed = national(survey, DERIVED_FROM)
    return (
        mapped(survey)
        .unionByName(domain_rows(goods_totals(observed), "06"))
        .unionByName(domain_rows(private_service_totals(observed), "08"))
        .withColumnRenamed("rate_or_level", "rate_level")
        .replace(labels, subset=["data_element"])
    )


def ordered(rows: DataFrame) -> DataFrame:
    """Output order, for sinks and reports; costs two shuffles of the whole result.

    Finding the ranges samples the rows, so these are put behind an exchange first and the
    input is not read for it. Rows alike in every sort column are told apart by the part of
    that exchange they came from, which lets the range shuffle cut through a heavily repeated
    key instead of handing it to one task.
    """
    spread = rows.hint("rebalance").withColumn("split", F.spark_partition_id())
    return spread.orderBy(*SORT_KEY, "value", "split").drop("split")


def summary(rows: DataFrame) -> DataFrame:
    """Row count and exact numbers of distinct industries and geographies of a result."""
    counts = rows.groupBy("industry_code", "geographic_code").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                      n_unique("industry_code").alias("n_industries"),
                      n_unique("geographic_code").alias("n_geographies"))


def is_empty(survey: DataFrame) -> bool:
    """Whether the pipeline would give no row; derived rows exist only beside published ones."""
    return mapped(survey).isEmpty()
