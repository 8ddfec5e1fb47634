"""Reports that join the monthly employment facts to the dimension tables.

Titles are attached after aggregation, on (industry × geography × month) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom import dimensions
from laborloom import fixed_values as fixed
from laborloom.operators import MONTH_COLUMNS, lookup
from laborloom.plans import qcew


def hierarchy_titles(bulk: DataFrame) -> DataFrame:
    """Sector rows with the titles of their sector, supersector and goods/services domain.

    Government and nondurable sectors have no hierarchy entry and keep empty titles.
    """
    titles = dimensions.hierarchy(bulk.sparkSession).withColumnRenamed("sector_code", "industry_code")
    return lookup(qcew.sectors(bulk), titles, "industry_code", how="left")


def industry_names(bulk: DataFrame) -> DataFrame:
    """Every output row with the six-digit code and name of its industry.

    Facts carry NAICS-style sector codes, in which 42 is wholesale; the common scheme uses
    42 for retail. Sectors are therefore matched on their NAICS code. Sectors that the
    scheme does not list (23, 51, 81) keep an empty name.
    """
    is_sector = F.col("industry_type") == "sector"
    named = dimensions.industries(bulk.sparkSession).select(
        F.col("industry_type").alias("scheme_type"),
        F.when(is_sector, F.col("qcew_naics")).otherwise(F.col("industry_code")).alias("industry_code"),
        "ces_code", "industry_name")
    scheme_type = F.when(F.col("industry_type") == "national", "domain").otherwise(F.col("industry_type"))
    facts = qcew.to_ces(bulk).withColumn("scheme_type", scheme_type)
    return lookup(facts, named, ["scheme_type", "industry_code"], how="left").drop("scheme_type")


def domain_names(bulk: DataFrame) -> DataFrame:
    """Domain rows with the domain's name and flags."""
    named = dimensions.domains(bulk.sparkSession).withColumnRenamed("domain_code", "industry_code")
    return lookup(qcew.domains(bulk), named, "industry_code")


def _sectors_seen(bulk: DataFrame) -> DataFrame:
    """Distinct sectors with employment: at most one row per sector, from one pass."""
    largest = F.max(F.greatest(*MONTH_COLUMNS)).alias("largest")
    return qcew.classified(bulk).groupBy(F.col("industry_code").alias("sector_code")).agg(largest).where(
        F.col("largest") > 0).select("sector_code")


def sector_codes_seen(bulk: DataFrame) -> DataFrame:
    valid = dimensions.hierarchy(bulk.sparkSession).select("sector_code")
    return lookup(_sectors_seen(bulk), valid, "sector_code", how="left_semi")


def supersector_codes_seen(bulk: DataFrame) -> DataFrame:
    parents = dimensions.hierarchy(bulk.sparkSession).select("sector_code", "supersector_code")
    return lookup(_sectors_seen(bulk), parents, "sector_code").select("supersector_code").distinct()


def components_seen(bulk: DataFrame) -> DataFrame:
    """Supersector → sorted list of its sectors that occur; the sets hold distinct codes only."""
    parents = dimensions.components(bulk.sparkSession)
    return lookup(_sectors_seen(bulk), parents, "sector_code").groupBy("supersector_code").agg(
        F.sort_array(F.collect_set("sector_code")).alias("sector_codes"))


def _place_names(rows: DataFrame) -> DataFrame:
    """State facts with the names of state, division and region."""
    spark = rows.sparkSession
    divisions = dimensions.divisions(spark).drop("region_code")
    places = lookup(lookup(dimensions.states(spark), divisions, "division_code", how="left"),
                    dimensions.regions(spark), "region_code", how="left")
    places = places.withColumnRenamed("fips", "geographic_code")
    return lookup(rows, places, "geographic_code", how="left")


def place_names(bulk: DataFrame) -> DataFrame:
    """State sector rows with the names of state, division and region."""
    return _place_names(qcew.sectors(bulk).where(F.col("geographic_type") == "state"))


def fips_by_name(bulk: DataFrame) -> DataFrame:
    """Sector rows keyed by area name, resolved back to FIPS through the name."""
    names = dimensions.states(bulk.sparkSession).select(F.col("fips").alias("geographic_code"), "state_name")
    facts = lookup(qcew.sectors(bulk), names, "geographic_code", how="left")
    is_nation = F.col("geographic_type") == "national"
    named = facts.withColumn("area_name", F.when(is_nation, fixed.NATIONAL_NAME).otherwise(F.col("state_name")))
    by_name = named.select("area_name", "industry_code", "ref_date", "employment")
    return lookup(by_name, dimensions.areas(bulk.sparkSession), "area_name")
