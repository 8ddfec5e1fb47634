"""The physical plans that make the pipelines hold at scale."""

from __future__ import annotations

import re

import pytest

from builders import census, census_row, observation, survey
from checks.queries import QUERIES
from laborloom.plans import decode, jolts, qcew
from laborloom.sources import read_jolts, read_qcew

SMALL = "/root/testdata/sf0.001"


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def bulk(spark, tmp_path):
    census(spark, [census_row(), census_row(own="0", level="10")]).write.parquet(str(tmp_path / "bulk"))
    return read_qcew(spark, str(tmp_path / "bulk"))


@pytest.fixture
def turnover(spark, tmp_path):
    rows = [observation(i, k, 2.0) for i in ("100000", "110099", "230000") for k in "LR"]
    survey(spark, rows).write.parquet(str(tmp_path / "turnover"))
    return read_jolts(spark, str(tmp_path / "turnover"))


def test_employment_takes_two_scans_and_two_shuffles(bulk):
    plan = initial_plan(qcew.to_ces(bulk))
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("BroadcastHashJoin") == 3
    # Months are unpivoted after the sums, never before them.
    assert plan.index("Expand") < plan.index("HashAggregate")


def test_employment_in_one_scan(bulk):
    assert final_plan(qcew.to_ces(bulk, one_scan=True)).count("FileScan parquet") == 1


def test_ordering_reads_the_input_no_further_time(spark, turnover):
    """The published rows and the derived ones: two scans, and none for finding the ranges."""
    rows = jolts.to_ces(turnover)
    assert final_plan(jolts.ordered(rows)).count("FileScan parquet") == 2
    plan = final_plan(jolts.ordered(rows))
    assert plan.index("rangepartitioning") < plan.index("REBALANCE_PARTITIONS_BY_NONE")


def test_a_count_is_cast_once(bulk):
    plan = qcew.total_rows(bulk)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(month1_emplvl") <= 1 and plan.count("month1_emplvl") < 12


def test_stream_filters_reach_the_scan(bulk):
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", initial_plan(qcew.total_rows(bulk)))
    assert len(scans) == 1 and "EqualTo(own_code,0)" in scans[0]


def test_unused_columns_are_not_read(bulk):
    schema = re.findall(r"ReadSchema: struct<(.*?)>", initial_plan(qcew.total_rows(bulk)))
    assert "industry_code" not in schema[0]
    schema = re.findall(r"ReadSchema: struct<(.*?)>", initial_plan(decode.sector_codes_seen(bulk)))
    assert "area_fips" not in schema[0] and "year" not in schema[0]


def test_turnover_takes_two_scans(turnover):
    plan = final_plan(jolts.to_ces(turnover))
    assert plan.count("FileScan parquet") == 2
    assert "ReusedExchange" in plan


def test_national_slice_is_filtered_in_the_scan(turnover):
    plan = initial_plan(jolts.domain_08(turnover))
    for pushed in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan):
        assert "EqualTo(state_code,00)" in pushed and "In(industry_code" in pushed


def test_published_rows_need_no_shuffle(turnover):
    assert "Exchange hashpartitioning" not in initial_plan(jolts.mapped(turnover))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = initial_plan(QUERIES[name](spark, SMALL))
    for banned in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, ENSURE"):
        if banned.startswith("SinglePartition") and name.endswith("summary"):
            continue
        assert banned not in plan, banned
