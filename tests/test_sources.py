from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from builders import bag, census, census_row, observation, survey
from laborloom import schemas, sinks
from laborloom.plans import jolts, qcew
from laborloom.sources import LakeSource, files, read_jolts, read_qcew, read_series


def test_missing_paths_are_empty_with_a_schema(spark, tmp_path):
    for read, schema in [(read_qcew, schemas.QCEW_INPUT), (read_jolts, schemas.JOLTS_INPUT)]:
        frame = read(spark, str(tmp_path / "nothing"))
        assert frame.schema == schema and frame.count() == 0


def test_partitioned_census_keeps_text_codes_and_prunes(spark, tmp_path):
    rows = [census_row(area=a, level="54", year=y) for a in ("06000", "41000") for y in ("2019", "2020", "2021")]
    path = str(tmp_path / "bulk")
    census(spark, rows).write.partitionBy("year").parquet(path)
    from laborloom.plans import qcew
    scan = qcew.year_range(schemas.conform(read_qcew(spark, path), schemas.QCEW_INPUT), 2020, 2021)
    assert bag(scan) == bag(census(spark, [row for row in rows if row[4] != "2019"]))
    assert len(scan.inputFiles()) >= 2
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*try_cast\(year|PartitionFilters: \[[^\]]*cast\(year", plan)


def test_series_file(spark, tmp_path):
    text = ("series_id                     \tyear\tperiod\t       value\tfootnote_codes\n"
            "JTS100000000000000HIL         \t2024\tM01\t        12.5\t\n"
            "JTS100000000000000HIL         \t2024\tM13\t        11.0\t\n"
            "JTS230000000000000TSR         \t2024\tM02\t         3.5\tP\n")
    path = tmp_path / "series.txt"
    path.write_text(text)
    rows = jolts.select_series(read_series(spark, str(path))).collect()
    assert sorted((r.industry_code, r.ref_date.month, r.value) for r in rows) == [
        ("100000", 1, 12.5), ("230000", 2, 3.5)]


def test_lake_tables(spark):
    rows = [census_row(year=str(y)) for y in (2002, 2003, 2025, 2026)]
    census(spark, rows).write.mode("overwrite").saveAsTable("default.qcew")
    survey(spark, [observation("300000", "L", 1.0)]).write.mode("overwrite").saveAsTable("default.jolts")
    lake = LakeSource(catalog="spark_catalog", schema="default")
    assert sorted(row.year for row in lake.read_qcew(spark).collect()) == ["2003", "2025"]
    assert [row.year for row in lake.read_qcew(spark, 2026, 2030).collect()] == ["2026"]
    assert lake.read_jolts(spark).count() == 1
    spark.sql("DROP TABLE default.qcew")
    spark.sql("DROP TABLE default.jolts")


def test_defaults_and_jdbc_slices():
    lake = LakeSource()
    assert (lake.host, lake.port, lake.catalog, lake.schema) == ("localhost", 8080, "hive", "default")
    assert lake.jdbc_url().endswith("://localhost:8080/hive/default")
    quarters = lake.quarter_predicates(2003, 2004)
    assert len(quarters) == len(set(quarters)) == 9
    assert quarters[0] == "year = '2003' AND qtr = '1'"
    states = lake.state_predicates()
    assert len(states) == len(set(states)) == 55 and states[0] == "state_code = '00'"


def test_jdbc_slices_cover_every_row_once(spark):
    lake = LakeSource()
    bulk = census(spark, [census_row(year=y, qtr=q) for y in ("2002", "2003", "2004", "2005")
                          for q in ("1", "2", "3", "4", "5", None)])
    seen = [row for p in lake.quarter_predicates(2003, 2004) for row in bulk.where(p).collect()]
    assert len(seen) == 12 and {row.year for row in seen} == {"2003", "2004"}
    states = survey(spark, [observation("300000", "L", 1.0, state=s) for s in ("00", "06", "72", "99", None)])
    assert sum(states.where(p).count() for p in lake.state_predicates() if "00" in p or "06" in p or "72" in p) == 5


def leaf_metric(frame, name):
    """A metric of the scans that ``frame`` runs, summed."""
    frame = frame.select("*")  # a new execution, as a second one of the same plan does not count files
    frame._jdf.collect()
    waiting, total = [frame._jdf.queryExecution().executedPlan()], 0
    while waiting:
        plan = waiting.pop()
        kind = plan.getClass().getSimpleName()
        inner = "executedPlan" if kind == "AdaptiveSparkPlanExec" else "plan" if kind.endswith("QueryStageExec") else None
        below = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
        if not below and plan.metrics().contains(name):
            total += plan.metrics().apply(name).value()
        waiting += below
    return total


@pytest.mark.parametrize("lacking", schemas.QCEW_INPUT.fieldNames())
@pytest.mark.parametrize("damaged_first", [True, False])
def test_a_file_without_a_column_is_named(spark, tmp_path, lacking, damaged_first):
    path = tmp_path / "bulk"
    whole = census(spark, [census_row()])
    for name, frame in zip(("a", "b") if damaged_first else ("b", "a"), (whole.drop(lacking), whole), strict=True):
        frame.coalesce(1).write.parquet(str(tmp_path / name))
        path.mkdir(exist_ok=True)
        next((tmp_path / name).glob("*.parquet")).rename(path / f"{name}.parquet")
    damaged = "a" if damaged_first else "b"
    with pytest.raises(ValueError, match=f"/{damaged}.parquet lacks {lacking}$"):
        read_qcew(spark, str(path))
    # Without the check the column is NULL there, as the reader would have it.
    if not damaged_first:
        assert read_qcew(spark, str(path), check=False).where(f"{lacking} IS NULL").count() == 1


def test_files_of_another_type_and_several_damaged_ones(spark, tmp_path):
    path, rows = str(tmp_path / "survey"), survey(spark, [observation("300000", "L", 1.0)])
    for drop in (["value"], ["value", "ref_date"], []):
        rows.drop(*drop).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="lacks value;.*lacks ref_date, value|lacks ref_date, value;.*lacks value"):
        read_jolts(spark, path)
    other = str(tmp_path / "types")
    rows.write.parquet(other)
    rows.withColumn("state_code", F.lit(6)).write.mode("append").parquet(other)
    with pytest.raises(Exception, match="state_code"):
        read_jolts(spark, other).collect()


def test_the_check_reads_no_rows_of_whole_files(spark, tmp_path):
    path = str(tmp_path / "bulk")
    rows = spark.range(50_000).selectExpr(*[f"cast(id as string) AS {c}" for c in schemas.QCEW_INPUT.fieldNames()])
    rows.coalesce(1).write.parquet(path)
    rows.limit(7).coalesce(1).drop("qtr").write.mode("append").parquet(path)
    fields = list(schemas.QCEW_INPUT)
    found = files.lacking_files(spark, path, fields, [])
    assert [r.columns for r in found.collect()] == [["qtr"]]
    assert leaf_metric(found, "numOutputRows") == 7


def test_extremes_and_every_stored_type(spark, tmp_path):
    path = str(tmp_path / "bulk")
    kinds = {"year": "smallint", "qtr": "tinyint", "month1_emplvl": "bigint", "month2_emplvl": "decimal(9,0)",
             "month3_emplvl": "double", "own_code": "int"}
    rows = census(spark, [census_row(), census_row(months=(None, "7", "0"))])
    stored = rows.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
    stored.write.parquet(path)
    assert read_qcew(spark, path).count() == 2
    stored.drop(*kinds).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="lacks own_code, year, qtr, month1_emplvl, month2_emplvl, month3_emplvl"):
        read_qcew(spark, path)


def test_clustered_years_are_read_alone(spark, tmp_path):
    years = [str(y) for y in range(2001, 2021)]
    rows = spark.range(4000).selectExpr(
        "lpad(cast(id % 50 as string), 2, '0') || '000' AS area_fips", "'5' AS own_code", "'23' AS industry_code",
        "'54' AS agglvl_code", f"element_at(split('{' '.join(years)}', ' '), cast(id % 20 + 1 as int)) AS year",
        "'1' AS qtr", "cast(id as string) AS month1_emplvl", "'2' AS month2_emplvl", "'3' AS month3_emplvl")
    odd = census(spark, [census_row(year=y) for y in (" 2010", "02010", "2010 ", None)])
    bulk = rows.unionByName(odd)
    path = str(tmp_path / "by_year")
    assert sinks.write_clustered(bulk, path) == 4004
    one, every = read_qcew(spark, path, 2010, 2010, check=False), read_qcew(spark, path)
    assert bag(one) == bag(qcew.year_range(bulk, 2010, 2010)) and one.count() == 203
    assert bag(every) == bag(bulk) and every.schema == schemas.QCEW_INPUT
    assert bag(read_qcew(spark, path, 2015)) == bag(qcew.year_range(bulk, 2015, 9999))
    assert leaf_metric(one, "filesSize") * 10 < leaf_metric(every, "filesSize")
    assert leaf_metric(one, "numOutputRows") == 203
    bulk.where("year IS NOT NULL").withColumn("year_number", F.expr("cast(year as int)")).write.mode(
        "overwrite").partitionBy("year_number").saveAsTable("default.qcew_by_year")
    lake = LakeSource(catalog="spark_catalog", schema="default", qcew_table="qcew_by_year")
    assert leaf_metric(lake.read_qcew(spark, 2010, 2010), "numOutputRows") == 203
    spark.sql("DROP TABLE default.qcew_by_year")


def test_a_large_group_is_cut_over_files(spark):
    rows = spark.range(200_000).selectExpr(
        "cast(id as string) AS area_fips", "'5' AS own_code", "uuid() AS industry_code", "'54' AS agglvl_code",
        "'2020' AS year", "'1' AS qtr", "cast(id as string) AS month1_emplvl", "'2' AS month2_emplvl", "'3' AS month3_emplvl")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        assert sinks.clustered(rows).select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.set(name, before)


LINES = ["series_id                     \tyear\tperiod\t       value\tfootnote_codes",
         "JTS100000000000000HIL         \t2024\tM01\t        12.5\t",
         "JTS100000000000000HIL         \t20x4\tM02\t        12.5\t",
         "JTS100000000000000HIL         \t2024\tM03\t        many\t",
         "JTS100000000000000HIL         \t2024\tM04\t\t",
         "JTS100000000000000HIL         \t2024",
         "JTS100000000000000HIL         \t2024\tM05\t1\t\tmore",
         "JTS1000000000HIL\t2024\tM06\t1\t",
         "JTS100000000000000HIL         \t2024\t6\t1\t",
         "JTU100000000000000HIL         \t2024\tM07\t-\t",
         "JTS230000000000000TSR         \t2024\tM13\t-\tP"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_series_records_are_counted_and_named(spark, tmp_path, ansi):
    path = tmp_path / "series.txt"
    path.write_text("\n".join(LINES) + "\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        series = read_series(spark, str(path))
        rejects = jolts.series_rejects(series).collect()
        assert sorted(r.problem for r in rejects) == [
            "number of fields", "number of fields", "period", "series id", "value", "value", "year"]
        assert {r.line for r in rejects if r.line} == {LINES[5], LINES[6]}
        kept = jolts.select_series(series, strict=False).collect()
        assert [(r.ref_date.month, r.value) for r in kept] == [(1, 12.5)]
        for line, said in zip(LINES[2:9], ("year", "value", "value", "number of fields", "number of fields", "series id",
                                           "period"), strict=True):
            path.write_text("\n".join([LINES[0], LINES[1], line]) + "\n")
            with pytest.raises(Exception, match=f"malformed {said}"):
                jolts.select_series(read_series(spark, str(path))).collect()
        path.write_text("\n".join([LINES[0], LINES[1], *LINES[9:]]) + "\n")
        assert jolts.select_series(read_series(spark, str(path))).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_series_files_must_agree_on_their_header(spark, tmp_path):
    folder = tmp_path / "series"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(LINES[:2]) + "\n")
    (folder / "b.txt").write_text("\n".join(LINES[:2]) + "\n")
    assert jolts.select_series(read_series(spark, str(folder))).count() == 2
    (folder / "b.txt").write_text("year\tseries_id\tperiod\tvalue\tfootnote_codes\n2024\tJTS100000000000000HIL\tM01\t1\t\n")
    with pytest.raises(Exception, match="header|schema"):
        read_series(spark, str(folder)).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_malformed_year_stops_the_range(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bulk = census(spark, [census_row(year="2024"), census_row(year="2O24")])
        with pytest.raises(Exception, match="malformed year"):
            qcew.year_range(bulk, 2020, 2024).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
