"""The input contract of the readers, and crosswalks against values written out here."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from builders import bag, census, census_row, observation, survey
from laborloom import dimensions, schemas
from laborloom.operators import pairing
from laborloom.plans import jolts, qcew
from laborloom.sources import LakeSource, read_jolts, read_qcew, read_series

YEARS = ["2018", "2019", " 2020", "2020 ", "02020", "2021", "2022"]


@pytest.mark.parametrize("name", schemas.QCEW_INPUT.fieldNames())
def test_census_without_a_column_stops(spark, tmp_path, name):
    census(spark, [census_row()]).drop(name).write.parquet(str(tmp_path / "bulk"))
    with pytest.raises(ValueError, match=name):
        read_qcew(spark, str(tmp_path / "bulk"))


@pytest.mark.parametrize("name", schemas.JOLTS_INPUT.fieldNames())
def test_survey_without_a_column_stops(spark, tmp_path, name):
    survey(spark, [observation("300000", "L", 1.0)]).drop(name).write.parquet(str(tmp_path / "turnover"))
    with pytest.raises(ValueError, match=name):
        read_jolts(spark, str(tmp_path / "turnover"))


def test_whole_numbers_are_read_as_text(spark, tmp_path):
    rows = census(spark, [census_row(year="2020")])
    rows.withColumns({c: F.col(c).cast("int") for c in ("year", "qtr")}).write.parquet(str(tmp_path / "bulk"))
    read = read_qcew(spark, str(tmp_path / "bulk"))
    assert read.schema == schemas.QCEW_INPUT and bag(read) == bag(rows)


def test_codes_in_folder_names_keep_their_zeros(spark, tmp_path):
    rows = census(spark, [census_row(area="06000"), census_row(area="41000")])
    rows.write.partitionBy("area_fips").parquet(str(tmp_path / "bulk"))
    assert bag(read_qcew(spark, str(tmp_path / "bulk"))) == bag(rows)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_numbers_stop_in_any_session(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = census(spark, [census_row()])
        for bad in (rows.withColumn("month1_emplvl", F.lit("many")), rows.withColumn("qtr", F.lit("5")),
                    rows.withColumn("year", F.lit("none"))):
            with pytest.raises(Exception, match="malformed|no such quarter"):
                qcew.monthly(bad).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_years_count_however_they_are_spelled(spark):
    bulk = census(spark, [census_row(year=y, qtr=q) for y in YEARS for q in ("1", "4", None)])
    kept = [r.year for r in qcew.year_range(bulk, 2019, 2021).collect()]
    assert sorted(kept) == sorted(YEARS[1:6] * 3)
    slices = [r.year for p in LakeSource().quarter_predicates(2019, 2021) for r in bulk.where(p).collect()]
    assert sorted(slices) == sorted(kept)


def test_series_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "series.txt"
    path.write_text("series_id \tperiod\tyear\tvalue\tfootnote_codes\nJTS100000000000000HIL\tM01\t2024\t12.5\t\n")
    assert [(r.ref_date.year, r.value) for r in jolts.select_series(read_series(spark, str(path))).collect()] == [(2024, 12.5)]
    path.write_text("series_id\tperiod\tvalue\tfootnote_codes\nJTS100000000000000HIL\tM01\t12.5\t\n")
    with pytest.raises(ValueError, match="year"):
        read_series(spark, str(path))
    assert read_series(spark, str(tmp_path / "nothing")).isEmpty()


def test_repeated_pairs_are_written_out_in_blocks(spark):
    key = ", ".join(f"'x' AS {c}" for c in pairing.SERIES_KEY[:-1]) + ", DATE'2024-01-01' AS ref_date"
    rows = spark.sql(f"SELECT {key}, kind AS rate_or_level, 2.0D AS value "
                     "FROM range(2500) CROSS JOIN (SELECT explode(array('level', 'rate')) AS kind)")
    pairs = pairing.level_rate_pairs(pairing.observations(rows))
    assert pairs.count() == 2500 * 2500
    assert "REPARTITION" in pairs._jdf.queryExecution().executedPlan().toString()


def test_crosswalks_written_out():
    assert dimensions.naics_sector() == {
        "21": "21", "22": "22", "23": "23", "42": "42", "44": "44", "44-45": "44", "48": "48", "48-49": "48",
        "51": "51", "52": "52", "53": "53", "54": "54", "55": "55", "56": "56", "61": "61", "62": "62",
        "71": "71", "72": "72", "81": "81"}
    parents = dimensions.sector_supersector()
    assert parents == {
        "21": "10", "23": "20", "31": "30", "32": "30", "22": "40", "42": "40", "44": "40", "48": "40", "51": "50",
        "52": "55", "53": "55", "54": "60", "55": "60", "56": "60", "61": "65", "62": "65", "71": "70", "72": "70",
        "81": "80", "91": "90", "92": "90", "93": "90"}
    for supersector, sectors in dimensions.supersector_components().items():
        assert all(parents[s] == supersector for s in sectors)
    made = dimensions.manufacturing_sector()
    assert {k for k, v in made.items() if v == "32"} == {
        "311", "312", "313", "314", "315", "316", "322", "323", "324", "325", "326"}
    assert {k for k, v in made.items() if v == "31"} == {
        "321", "327", "331", "332", "333", "334", "335", "336", "337", "339"}
    regions = dimensions.state_region()
    assert len(regions) == 51 and "72" not in regions and len(set(regions.values())) == 4
    # Connecticut and New York; Illinois and Ohio; Florida and Texas; California and Hawaii.
    for one, other in (("09", "36"), ("17", "39"), ("12", "48"), ("06", "15")):
        assert regions[one] == regions[other]
    assert len({regions[c] for c in ("09", "17", "12", "06")}) == 4
