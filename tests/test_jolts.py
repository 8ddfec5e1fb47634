from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pytest

import laborloom
from builders import bag, observation, survey
from laborloom import schemas
from laborloom import fixed_values as fixed
from laborloom.plans import jolts

DOMAIN_CASE = [
    observation("100000", "L", 1000.0), observation("100000", "R", 2.5),
    observation("110099", "L", 100.0), observation("110099", "R", 2.0),
    observation("230000", "L", 200.0), observation("230000", "R", 4.0),
    observation("300000", "L", 300.0), observation("300000", "R", 3.0),
]


def derived(df, code):
    """(level, rate) values of a derived domain."""
    rows = df.where(df.industry_code == code).collect()
    return ([row.value for row in rows if row.rate_level == "level"],
            [row.value for row in rows if row.rate_level == "rate"])


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


def test_domains_by_hand(spark):
    result = jolts.to_ces(survey(spark, DOMAIN_CASE))
    (level_06,), (rate_06,) = derived(result, "06")
    (level_08,), (rate_08,) = derived(result, "08")
    assert (level_06, level_08) == (600.0, 400.0)
    assert rate_06 == pytest.approx(3.0) and rate_08 == pytest.approx(2.0)
    assert {row.industry_type for row in result.where("industry_code in ('05', '06', '08')").collect()} == {"domain"}


def test_output_contract(spark):
    result = jolts.to_ces(survey(spark, DOMAIN_CASE))
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in schemas.JOLTS_OUTPUT]


def test_labels_and_geography(spark):
    rows = [observation("300000", "L", 400.0), observation("300000", "R", 3.1, element="TS"),
            observation("300000", "L", 9.0, element="JO"), observation("900000", "L", 9.0),
            observation("000000", "L", 5.0, state="06"), observation("300000", None, 2.0, state=None)]
    got = Counter(tuple(row) for row in jolts.to_ces(survey(spark, rows)).collect())
    day = date(2024, 1, 1)
    assert got == Counter([
        ("national", "00", "supersector", "30", "level", "entries", day, 400.0),
        ("national", "00", "supersector", "30", "rate", "exits", day, 3.1),
        ("state", "06", "national", "00", "level", "entries", day, 5.0),
        ("state", None, "supersector", "30", "rate", "entries", day, 2.0),
    ])


def test_states_derive_nothing(spark):
    rows = [(("06",) + row[1:]) for row in DOMAIN_CASE]
    result = jolts.to_ces(survey(spark, rows))
    assert result.count() == len(rows) and {row.geographic_type for row in result.collect()} == {"state"}


def test_level_without_rate_leaves_06(spark):
    rows = [row for row in DOMAIN_CASE if row[1:] != DOMAIN_CASE[5][1:]]
    result = jolts.to_ces(survey(spark, rows))
    (level,), (rate,) = derived(result, "06")
    assert level == 400.0 and rate == pytest.approx(400 / 15000 * 100)
    assert derived(result, "08")[0] == [600.0]


def test_no_08_without_a_05_rate(spark):
    result = jolts.to_ces(survey(spark, DOMAIN_CASE[:1] + DOMAIN_CASE[2:]))
    assert derived(result, "06")[0] == [600.0] and derived(result, "08") == ([], [])


def test_zero_rate_follows_ieee(spark):
    rows = [observation("110099", "L", 100.0), observation("110099", "R", 0.0),
            observation("230000", "L", 200.0), observation("230000", "R", 4.0)]
    assert derived(jolts.to_ces(survey(spark, rows)), "06") == ([300.0], [0.0])
    rows = [observation("110099", "L", 0.0), observation("110099", "R", 0.0)]
    (level,), (rate,) = derived(jolts.to_ces(survey(spark, rows)), "06")
    assert level == 0.0 and math.isnan(rate)


def test_equal_employment_gives_infinite_08_rate(spark):
    rows = [observation("100000", "R", 5.0) if row[1] == "100000" and row[3] == "R" else row for row in DOMAIN_CASE]
    assert derived(jolts.to_ces(survey(spark, rows)), "08") == ([400.0], [math.inf])


def test_missing_values_sum_to_zero(spark):
    rows = [observation("110099", "L", None), observation("110099", "R", 2.0)]
    (level,), (rate,) = derived(jolts.to_ces(survey(spark, rows)), "06")
    assert level == 0.0 and math.isnan(rate)


def test_null_month_matches_nothing(spark):
    rows = [(*row[:4], None, row[5]) for row in DOMAIN_CASE]
    assert jolts.to_ces(survey(spark, rows)).count() == len(rows)


def brute_force(rows):
    """Derived rows from a plain nested-loop join, with IEEE arithmetic."""
    code = {source: (code, kind) for source, code, kind in fixed.TURNOVER_INDUSTRIES}
    national = [(code[i][0], e, d, "level" if k == "L" else "rate", v) for s, i, e, k, d, v in rows
                if s == "00" and i in code and e in ("HI", "TS")]

    def pairs(wanted):
        for c, e, d, kind, level in national:
            for c2, e2, d2, kind2, rate in national:
                if c in wanted and kind == "level" and kind2 == "rate" and (c, e, d) == (c2, e2, d2):
                    yield (e, d), level, np.float64(level) * 100.0 / np.float64(rate)

    goods = defaultdict(lambda: [np.float64(0), np.float64(0)])
    for key, level, employment in pairs(fixed.GOODS_SUPERSECTORS):
        goods[key][0] += level
        goods[key][1] += employment
    out = [("06", *key, level, level / employment * 100.0) for key, (level, employment) in goods.items()]
    for key, level, employment in pairs(["05"]):
        if key in goods:
            rest, jobs = level - goods[key][0], employment - goods[key][1]
            out.append(("08", *key, rest, rest / jobs * 100.0))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_duplicates_and_zeros_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [observation(rng.choice(["100000", "110099", "230000", "300000", "400000"]), rng.choice("LR"),
                        float(rng.choice([0, 1, 2, 4, 8, 16])), rng.choice(["00", "00", "06"]),
                        rng.choice(["HI", "TS", "JO"]), date(2024, rng.randint(1, 4), 1)) for _ in range(300)]
    observed = jolts.national(survey(spark, rows), jolts.DERIVED_FROM)
    labels = {"HI": "hires", "TS": "total_separations"}
    with np.errstate(all="ignore"):
        want = sorted((c, labels[e], d, lvl, rate) for c, e, d, lvl, rate in brute_force(rows))
    got = []
    for code, totals in [("06", jolts.goods_totals(observed)), ("08", jolts.private_service_totals(observed))]:
        for row in totals.collect():
            with np.errstate(all="ignore"):
                rate = np.float64(row.level) / np.float64(row.employment) * 100.0
            got.append((code, row.data_element, row.ref_date, row.level, rate))
    assert len(got) == len(want)
    key = [(c, e, d, lvl, str(rate)) for c, e, d, lvl, rate in want]
    by_key = sorted(zip(key, want), key=lambda pair: pair[0])
    for (_, w), g in zip(by_key, sorted(got, key=lambda r: (*r[:4], str(r[4])))):
        assert w[:4] == g[:4] and (same(w[4], g[4]) or w[4] == pytest.approx(g[4])), (w, g)


def test_implied_employment_counts_pairs(spark):
    rows = [observation("300000", "L", 100.0), observation("300000", "L", 300.0),
            observation("300000", "R", 2.0), observation("300000", "R", 2.0), observation("300000", "R", 4.0)]
    got = {row.rate_value: (row.level_value, row.pairs, row.employment)
           for row in jolts.supersector_employment(survey(spark, rows)).collect()}
    assert got == {2.0: (800.0, 4, 40000.0), 4.0: (400.0, 2, 10000.0)}


def test_output_order(spark):
    rows = DOMAIN_CASE + [observation("300000", "L", 1.0, state="41"), observation("300000", "L", 1.0, state="06")]
    got = [tuple(row)[:7] for row in laborloom.map_jolts(spark, survey(spark, rows)).collect()]
    order = [(t, g, it, i, d, r, e) for t, g, it, i, r, e, d in got]
    assert order == sorted(order) and len(order) == 14


def test_path_frame_and_missing_path(spark, tmp_path):
    frame = survey(spark, DOMAIN_CASE)
    frame.write.parquet(str(tmp_path / "survey"))
    assert bag(laborloom.map_jolts(spark, str(tmp_path / "survey"))) == bag(laborloom.map_jolts(spark, frame))
    missing = laborloom.map_jolts(spark, tmp_path / "nothing")
    assert missing.count() == 0 and missing.columns == schemas.JOLTS_OUTPUT.fieldNames()


def test_summary(spark):
    result = jolts.to_ces(survey(spark, DOMAIN_CASE + [observation("000000", "L", 1.0, state="06")]))
    assert tuple(jolts.summary(result).first()) == (13, 7, 2)


def test_select_series(spark):
    keep = [("JTS100000000000000HIL", "2024", "M01", "12.5"), ("JTS300000060000000TSR", "2023", "M12", "3")]
    drop = [("JTU100000000000000HIL", "2024", "M01", "1"), ("JTS100000001234500HIL", "2024", "M01", "1"),
            ("JTS100000000000001HIL", "2024", "M01", "1"), ("JTS900000000000000HIL", "2024", "M01", "1"),
            ("JTS100000000000000JOL", "2024", "M01", "1"), ("JTS100000000000000HIX", "2024", "M01", "1"),
            ("JTS100000000000000HIL", "2024", "M13", "1")]
    series = spark.createDataFrame([(*row, None) for row in keep + drop], schemas.SERIES_INPUT)
    selected = jolts.select_series(series)
    assert selected.schema.fieldNames() == schemas.JOLTS_INPUT.fieldNames()
    assert [f.dataType for f in selected.schema] == [f.dataType for f in schemas.JOLTS_INPUT]
    assert sorted(tuple(row) for row in selected.collect()) == [
        ("00", "100000", "HI", "L", date(2024, 1, 1), 12.5), ("06", "300000", "TS", "R", date(2023, 12, 1), 3.0)]
    assert [row.state_code for row in jolts.select_series(series, national_only=True).collect()] == ["00"]


def test_sums_do_not_depend_on_order(spark):
    """Values without an exact binary form, in ten partitionings: the same bits."""
    rng = random.Random(3)
    rows = [observation(code, kind, round(rng.uniform(0.1, 900), 3) if kind == "L" else rng.choice([0.1, 1.7, 3.3]))
            for code in ("110099", "230000", "300000", "100000") for kind in "LR" for _ in range(40)]
    found = set()
    for n in range(10):
        rng.shuffle(rows)
        given = survey(spark, rows).repartition(1 + n)
        found.add(tuple(sorted(repr(tuple(r)) for r in jolts.domain_06(given).collect())))
    assert len(found) == 1


def test_order_free_sum_of_odd_values(spark):
    from laborloom.functions import order_free_sum
    inf, nan = float("inf"), float("nan")
    cases = [([], None), ([None], None), ([0.1] * 10, 1.0), ([1e17, 0.1, -1e17], 0.1), ([inf, 1.0], inf), ([inf, -inf], nan),
             ([nan, 1.0], nan), ([1e300, 1e300, 1.0], 2e300), ([-inf, None, 2.5], -inf), ([1e18, -1e18, 3.5], 3.5)]
    for values, want in cases:
        rows = spark.createDataFrame([(v,) for v in values], "v double")
        got = rows.agg(order_free_sum(rows.v)).first()[0]
        assert repr(got) == repr(want), (values, got)
