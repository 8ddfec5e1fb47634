"""Small inputs in the two input contracts."""

from __future__ import annotations

from collections import Counter
from datetime import date

from laborloom import schemas


def census_row(area="US000", own="5", naics="23", level="14", year="2024", qtr="1", months=("1", "1", "1")):
    return (area, own, naics, level, year, qtr, *(None if m is None else str(m) for m in months))


def census(spark, rows):
    return spark.createDataFrame(rows, schemas.QCEW_INPUT)


def observation(industry, kind, value, state="00", element="HI", day=date(2024, 1, 1)):
    return (state, industry, element, kind, day, value)


def survey(spark, rows):
    return spark.createDataFrame(rows, schemas.JOLTS_INPUT)


def bag(df):
    """Rows as a multiset, with NaN equal to itself."""
    return Counter(repr(tuple(row)) for row in df.collect())
