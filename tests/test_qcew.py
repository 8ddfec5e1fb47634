from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date

import pytest

import laborloom
from builders import bag, census, census_row
from laborloom import dimensions, schemas
from laborloom import fixed_values as fixed
from laborloom.plans import qcew


def national_case(spark):
    rows = [census_row(own="0", naics="10", level="10", months=(150000, 151000, 152000))]
    rows += [census_row(naics=n, months=(e, e + 100, e + 200)) for n, e in [("23", 8000), ("42", 6000), ("51", 3000)]]
    rows += [census_row(own=o, naics="10", level="11", months=(e, e + 100, e + 200))
             for o, e in [("1", 2800), ("2", 5200), ("3", 14000)]]
    rows += [census_row(naics=n, level="15", months=(e, e + 50, e + 100)) for n, e in [("321", 1000), ("311", 2000)]]
    return census(spark, rows)


def values(df, **where):
    for name, value in where.items():
        df = df.where(df[name] == value)
    return sorted(row.employment for row in df.collect())


def test_every_level_of_the_nation(spark):
    january = qcew.to_ces(national_case(spark)).where("ref_date = date'2024-01-12'")
    got = {(row.industry_type, row.industry_code): row.employment for row in january.collect()}
    assert got == {
        ("national", "00"): 150.0,
        ("sector", "23"): 8.0, ("sector", "42"): 6.0, ("sector", "51"): 3.0,
        ("sector", "91"): 2.8, ("sector", "92"): 5.2, ("sector", "93"): 14.0,
        ("sector", "31"): 1.0, ("sector", "32"): 2.0,
        ("supersector", "20"): 8.0, ("supersector", "30"): 3.0, ("supersector", "40"): 6.0,
        ("supersector", "50"): 3.0, ("supersector", "90"): 22.0,
        ("domain", "05"): 20.0, ("domain", "06"): 11.0, ("domain", "07"): 31.0, ("domain", "08"): 9.0,
    }


def test_single_domains(spark):
    rows = qcew.domains(national_case(spark), ["06", "07"]).where("month(ref_date) = 1").collect()
    assert {row.industry_code: row.employment for row in rows} == {"06": 11000.0, "07": 31000.0}
    with pytest.raises(ValueError, match="99"):
        qcew.domains(national_case(spark), ["99"])


def test_output_contract(spark):
    result = qcew.to_ces(national_case(spark))
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in schemas.QCEW_OUTPUT]
    assert {row.ref_date for row in result.select("ref_date").distinct().collect()} == {
        date(2024, 1, 12), date(2024, 2, 12), date(2024, 3, 12)}


def test_quarters_become_months(spark):
    rows = qcew.monthly(census(spark, [census_row(qtr=q, months=(1, 2, 3)) for q in "1234"]))
    assert sorted((row.ref_date.month, row.employment) for row in rows.collect()) == [
        (month, float((month - 1) % 3 + 1)) for month in range(1, 13)]
    assert {row.ref_date.day for row in rows.collect()} == {12}


def test_zero_and_suppressed_months_vanish(spark):
    bulk = census(spark, [census_row(months=("0", None, 5)), census_row(naics="42", months=("0", "0", None))])
    rows = qcew.to_ces(bulk).where("industry_type = 'sector'").collect()
    assert [(row.industry_code, row.ref_date.month, row.employment) for row in rows] == [("23", 3, 0.005)]


def test_divisions_and_regions(spark):
    rows = [census_row(area=a, level="54", months=(30000,) * 3) for a in ("06000", "41000")]
    result = qcew.to_ces(census(spark, rows))
    assert values(result, geographic_type="division", geographic_code="9", industry_type="sector") == [60.0] * 3
    assert values(result, geographic_type="region", geographic_code="4", industry_type="domain",
                  industry_code="06") == [60.0] * 3
    assert values(result, geographic_type="state", geographic_code="06", industry_type="sector") == [30.0] * 3


def test_territories_reach_no_division(spark):
    rows = [census_row(area=a, level="54") for a in ("72000", "78000", "99000")]
    result = qcew.to_ces(census(spark, rows))
    assert {row.geographic_type for row in result.collect()} == {"state"}
    assert {row.geographic_code for row in result.collect()} == {"72", "78", "99"}


def test_totals_stay_unsummed_but_add_up_above(spark):
    rows = [census_row(area="06000", own="0", naics="10", level="50", months=(m, None, None)) for m in (7, 7, 9)]
    rows += [census_row(own="0", naics="10", level="10", months=(m, None, None)) for m in (4, 4)]
    result = qcew.to_ces(census(spark, rows))
    assert values(result, geographic_type="state") == [0.007, 0.007, 0.009]
    assert values(result, geographic_type="national") == [0.004, 0.004]
    assert values(result, geographic_type="division") == [0.023]
    assert values(result, geographic_type="region") == [0.023]


def test_range_codes_add_to_their_sector(spark):
    rows = [census_row(naics=n, months=(m, None, None)) for n, m in [("44", 1), ("44-45", 2), ("48-49", 4)]]
    rows += [census_row(naics=n, months=(100, None, None)) for n in ("11", "99", "31-33", "31")]
    got = qcew.private_sectors(census(spark, rows)).collect()
    assert {row.industry_code: row.employment for row in got} == {"44": 3.0, "48": 4.0}


def test_rows_outside_the_sub_populations_are_ignored(spark):
    rows = [census_row(level="16"), census_row(own="1", naics="102", level="11"), census_row(own="4", level="14"),
            census_row(own="0", level="14"), census_row(naics="311", level="14"), census_row(naics="23", level="15"),
            census_row(own=None), census_row(level=None), census_row(naics=None)]
    assert qcew.to_ces(census(spark, rows)).count() == 0
    assert qcew.is_empty(census(spark, rows))


def test_unknown_area_is_a_state_without_code(spark):
    row, = qcew.sectors(census(spark, [census_row(area=None, months=(5, None, None))])).collect()
    assert (row.geographic_type, row.geographic_code) == ("state", None)
    kept = qcew.to_ces(census(spark, [census_row(area=None, months=(5, None, None))]))
    assert kept.where("industry_type = 'sector'").count() == 1


@pytest.mark.parametrize("row", [census_row(months=("many", 1, 1)), census_row(months=("", 1, 1)),
                                 census_row(qtr="5"), census_row(year="soon")])
def test_broken_input_is_an_error(spark, row):
    with pytest.raises(Exception):
        qcew.to_ces(census(spark, [row])).collect()


def test_year_range_is_inclusive(spark):
    bulk = census(spark, [census_row(year=str(year)) for year in range(1999, 2006)] + [census_row(year="20031")])
    got = sorted(row.year for row in qcew.year_range(bulk, 2001, 2003).collect())
    assert got == ["2001", "2002", "2003"]


def test_path_frame_and_missing_path(spark, tmp_path):
    bulk = national_case(spark)
    bulk.write.parquet(str(tmp_path / "bulk"))
    assert bag(laborloom.map_qcew(spark, tmp_path / "bulk")) == bag(laborloom.map_qcew(spark, bulk))
    missing = laborloom.map_qcew(spark, tmp_path / "nothing")
    assert missing.count() == 0 and missing.columns == schemas.QCEW_OUTPUT.fieldNames()


def test_summary(spark):
    result = qcew.to_ces(national_case(spark))
    rows, industries = qcew.summary(result).first()
    assert rows == result.count() == 54
    assert industries == 18


def random_bulk(size=3000, seed=7):
    rng = random.Random(seed)
    areas = ["US000"] * 20 + [f"{fips}000" for fips, _, _ in fixed.STATES]
    naics2 = [*dimensions.naics_sector(), "11", "31-33"]
    naics3 = [*dimensions.manufacturing_sector(), "399"]
    rows = []
    for _ in range(size):
        area = rng.choice(areas)
        nation = area == "US000"
        kind = rng.choice(["total", "private", "government", "manufacturing"])
        own, level, naics = {
            "total": ("0", "10" if nation else "50", "10"),
            "private": ("5", "14" if nation else "54", rng.choice(naics2)),
            "government": (rng.choice("123"), "11" if nation else "51", rng.choice(["10", "102"])),
            "manufacturing": ("5", "15" if nation else "55", rng.choice(naics3)),
        }[kind]
        months = [rng.choice([None, 0, rng.randint(1, 10**6)]) for _ in range(3)]
        rows.append(census_row(area, own, naics, level, str(rng.choice([2023, 2024])), rng.choice("1234"), months))
    return rows


def brute_force(rows):
    """The pipeline on Python dictionaries, one stage at a time."""
    out, sectors = [], defaultdict(float)
    for area, own, naics, level, year, qtr, *months in rows:
        place = ("national", "00") if area == "US000" else ("state", area[:2])
        for offset, text in enumerate(months):
            if text is None or float(text) <= 0:
                continue
            day = date(int(year), (int(qtr) - 1) * 3 + 1 + offset, 12)
            if own == "0" and level in ("10", "50"):
                out.append((day, *place, "national", "00", float(text)))
            sector = None
            if own == "5" and level in ("14", "54"):
                sector = dimensions.naics_sector().get(naics)
            elif own in "123" and level in ("11", "51") and naics == "10":
                sector = fixed.OWNERSHIP_SECTOR[own]
            elif own == "5" and level in ("15", "55"):
                sector = dimensions.manufacturing_sector().get(naics)
            if sector:
                sectors[day, *place, "sector", sector] += float(text)
    supersectors = defaultdict(float)
    for (day, kind, code, _, sector), value in sectors.items():
        supersectors[day, kind, code, "supersector", dimensions.sector_supersector()[sector]] += value
    domains = defaultdict(float)
    for (day, kind, code, _, supersector), value in supersectors.items():
        for domain in ("05", "06", "07", "08"):
            if supersector in dimensions.domain_supersectors(domain):
                domains[day, kind, code, "domain", domain] += value
    for level in (sectors, supersectors, domains):
        out += [(*key, value) for key, value in level.items()]
    divisions = defaultdict(float)
    for day, kind, code, industry_type, industry, value in out:
        if kind == "state" and code in dimensions.state_division():
            divisions[day, "division", dimensions.state_division()[code], industry_type, industry] += value
    regions = defaultdict(float)
    for (day, _, code, industry_type, industry), value in divisions.items():
        regions[day, "region", dimensions.division_region()[code], industry_type, industry] += value
    for level in (divisions, regions):
        out += [(*key, value) for key, value in level.items()]
    return Counter(repr((*row[:5], row[5] / 1000.0)) for row in out)


def test_whole_pipeline_against_brute_force(spark):
    rows = random_bulk()
    assert bag(qcew.to_ces(census(spark, rows))) == brute_force(rows)


def test_one_scan_gives_the_same_rows(spark):
    rows = [census_row(own="0", level="10", naics="10", months=("5", "0", None))] * 3
    rows += [census_row(own="0", level="50", naics="10", area=a, months=("7", "8", "9")) for a in ("06000", "06000", "72000")]
    rows += [census_row(), census_row(area="41000", level="54"), census_row(own="1", level="11", naics="10")]
    rows += [census_row(own="0", level="10", naics="10", months=(m, "1", "1")) for m in ("-3", "2.5", None)]
    assert bag(qcew.to_ces(census(spark, rows), one_scan=True)) == bag(qcew.to_ces(census(spark, rows)))


def test_a_much_repeated_total_is_written_out_in_blocks(spark):
    from pyspark.sql import functions as F
    from laborloom.operators import repeated
    rows = spark.createDataFrame([("a", 10_000), ("b", 1), ("c", 4096), ("d", 4097)], "name string, copies long")
    got = {r.name: r["count"] for r in repeated(rows, "copies").groupBy("name").count().collect()}
    assert got == {"a": 10_000, "b": 1, "c": 4096, "d": 4097}
    totals = census(spark, [census_row(own="0", level="10", naics="10")]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(9000))))
    assert qcew.to_ces(totals.drop("n"), one_scan=True).count() == 27_000
