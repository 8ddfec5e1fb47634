"""Labor-statistics inputs derived from ``lineitem``.

Census and series inputs are plain projections, one input row per line item, so a query
over them scans, joins and aggregates as many rows as the table holds. A third of all
census rows is national, which makes a few very hot groups.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborloom import fixed_values as fixed
from laborloom import schemas, sinks
from laborloom.operators import shared

STATE_CODES = [fips for fips, _, _ in fixed.STATES]
#: Two-digit codes as the census publishes them; 11, 31-33 and 99 feed no sector.
NAICS2_CODES = ["11", "21", "22", "23", "31-33", "42", "44-45", "48-49", "51", "52",
                "53", "54", "55", "56", "61", "62", "71", "72", "81", "99"]
NAICS3_CODES = [*fixed.NONDURABLE_NAICS3, *fixed.DURABLE_NAICS3]
#: The survey's industries in order, then one that maps to nothing.
SURVEY_CODES = [*(code for code, _, _ in fixed.TURNOVER_INDUSTRIES), "900000"]
SURVEY_ELEMENTS = ["HI", "TS", "JO"]
LAST_FIELD = "IF(l_linestatus = 'O', 'L', 'R')"
PERIOD = "'M' || IF(l_linenumber = 7, '13', lpad(CAST(month(l_shipdate) AS STRING), 2, '0'))"
SURVEY_STATES = ["00", "00", "00", "06", "41", "72"]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def quoted(text: str) -> str:
    return f"'{text}'"


def pick(codes: list[str], index: str) -> str:
    """SQL text for the code at position ``index % len(codes)``."""
    return f"element_at(split('{' '.join(codes)}', ' '), CAST({index} % {len(codes)} + 1 AS INT))"


def qcew_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = "l_partkey % 3 = 0"

    def level(national: str, state: str) -> str:
        return f"IF({nation}, '{national}', '{state}')"

    def month_count(k: int) -> str:
        # A zero stands for a suppressed count.
        count = "IF(l_discount = 0, '0', CAST(CAST(l_quantity AS BIGINT) AS STRING))"
        return f"CASE WHEN (month(l_shipdate) - 1) % 3 + 1 = {k} THEN {count} END AS month{k}_emplvl"

    # Line numbers 1 to 3 are government, 4 and 5 private, 6 manufacturing, 7 totals.
    return lineitem(spark, sf_dir).selectExpr(
        f"IF({nation}, '{fixed.NATIONAL_AREA}', {pick(STATE_CODES, 'l_partkey')} || '000') AS area_fips",
        "CASE WHEN l_linenumber <= 3 THEN CAST(l_linenumber AS STRING) "
        "WHEN l_linenumber <= 6 THEN '5' ELSE '0' END AS own_code",
        "CASE WHEN l_linenumber <= 3 THEN IF(l_suppkey % 11 = 0, '102', '10') "
        f"WHEN l_linenumber <= 5 THEN {pick(NAICS2_CODES, 'l_suppkey')} "
        f"WHEN l_linenumber = 6 THEN {pick(NAICS3_CODES, 'l_suppkey')} ELSE '10' END AS industry_code",
        f"CASE WHEN l_linenumber <= 3 THEN {level('11', '51')} WHEN l_linenumber <= 5 THEN {level('14', '54')} "
        f"WHEN l_linenumber = 6 THEN {level('15', '55')} ELSE {level('10', '50')} END AS agglvl_code",
        "CAST(year(l_shipdate) AS STRING) AS year",
        "CAST(quarter(l_shipdate) AS STRING) AS qtr",
        *[month_count(k) for k in (1, 2, 3)],
    )


def jolts_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One level and usually one rate per state, industry, element and month.

    Rates are powers of two, so implied employment is exact and sums do not depend on
    their order. Some rates are missing, which takes their supersector out of 06.
    """
    base = lineitem(spark, sf_dir).selectExpr(
        f"{pick(SURVEY_STATES, 'l_partkey')} AS state_code",
        "CAST(2 + l_suppkey % 11 AS INT) AS ordinal",
        f"{pick(SURVEY_ELEMENTS, 'l_linenumber')} AS dataelement_code",
        "trunc(l_shipdate, 'month') AS ref_date",
        "l_quantity",
    ).groupBy("state_code", "ordinal", "dataelement_code", "ref_date").agg(F.sum("l_quantity").alias("level"))

    # Every mapped industry also counts towards total private, every industry towards the total.
    unmapped = len(SURVEY_CODES) - 1
    members = F.expr(f"explode(array_compact(array(ordinal, IF(ordinal <> {unmapped}, 1, NULL), 0)))")
    levels = base.withColumn("member", members).groupBy(
        "state_code", "member", "dataelement_code", "ref_date").agg(F.sum("level").alias("level"))

    rate = ("CASE WHEN member = 1 THEN 0.5D WHEN (member * 7 + month(ref_date)) % 13 <> 0 "
            "THEN pow(2.0D, (member + month(ref_date)) % 5 - 1) END")

    def observation(kind: str, value: str) -> str:
        return (f"named_struct('state_code', state_code, 'industry_code', {pick(SURVEY_CODES, 'member')}, "
                f"'dataelement_code', dataelement_code, 'ratelevel_code', '{kind}', 'ref_date', ref_date, "
                f"'value', {value})")

    both = f"inline(array({observation('L', 'level')}, {observation('R', rate)}))"
    return levels.selectExpr(both).where("value IS NOT NULL")


def hard_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey with repeated, second, zero and missing values in some months."""
    month = "month(ref_date)"
    added = [  # value, whether it is added
        ("published", "true"),
        ("published + 8", f"ratelevel_code = 'L' AND {month} % 4 = 1"),
        ("published * 2", f"ratelevel_code = 'R' AND {month} % 6 = 2"),
        ("published", f"ratelevel_code = 'R' AND {month} % 6 = 2"),
        ("0.0D", f"ratelevel_code = 'R' AND {month} % 6 = 3"),
        ("CAST(NULL AS DOUBLE)", f"ratelevel_code = 'L' AND {month} = 5"),
    ]
    values = ", ".join(f"named_struct('value', {value}, 'added', {when})" for value, when in added)
    return jolts_survey(spark, sf_dir).withColumnRenamed("value", "published").selectExpr(
        *[c for c in schemas.JOLTS_INPUT.fieldNames() if c != "value"],
        f"inline(filter(array({values}), x -> x.added))").drop("added")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder for files that a query writes and reads again, in the folder that the cluster
    names in ``spark.checkpoint.dir``; on one machine without it, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="laborloom-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def clustered_files(spark: SparkSession, sf_dir: str) -> str:
    """The census written by year."""
    path = shared_path(spark, "census")
    sinks.write_clustered(qcew_bulk(spark, sf_dir), path)
    return path


def survey_files(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "survey")
    sinks.write_staged(jolts_survey(spark, sf_dir), path)
    return path


def series_files(spark: SparkSession, sf_dir: str) -> str:
    """Series files with a header, in which some records are malformed."""
    path = shared_path(spark, "series")
    jolts_series(spark, sf_dir, faults=True).write.csv(path, sep="\t", header=True)
    return path


def jolts_series(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Rows of a series file: both seasonal kinds, some sub-areas, size classes and annual
    averages (``M13``), with ``faults`` in some orders' records."""
    def field(text: str, order: int, fault: str) -> str:
        return f"IF(l_orderkey % {order} = 0, {fault}, {text})" if faults else text

    # Behind a generator, so that ids are put together once and not once per predicate.
    return shared(lineitem(spark, sf_dir).selectExpr(
        "concat('JT', IF(l_returnflag = 'R', 'U', 'S'), "
        f"{pick(SURVEY_CODES, 'l_suppkey')}, {pick(SURVEY_STATES, 'l_partkey')}, "
        "IF(l_suppkey % 10 = 0, '12345', '00000'), IF(l_quantity >= 45, '01', '00'), "
        f"{pick(SURVEY_ELEMENTS, 'l_linenumber')}, {field(LAST_FIELD, 79, quoted(''))}) AS series_id",
        f"{field('CAST(year(l_shipdate) AS STRING)', 97, quoted('20x4'))} AS year",
        f"{field(PERIOD, 83, quoted('M1'))} AS period",
        f"{field('CAST(CAST(l_quantity AS BIGINT) AS STRING)', 89, quoted('many'))} AS value",
        "'' AS footnote_codes",
    ))
