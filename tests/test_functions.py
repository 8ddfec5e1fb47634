from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from laborloom.functions import ieee_div, n_unique, series_columns, sum_or_zero


def test_ieee_div_matches_floating_point(spark):
    numbers = [None, 0.0, 1.0, -2.5, 3.0, math.inf, -math.inf, math.nan]
    cases = [(a, b) for a in numbers for b in numbers]
    rows = spark.createDataFrame(cases, "a double, b double").select(
        "a", "b", ieee_div(F.col("a"), F.col("b")).alias("q")).collect()
    with np.errstate(all="ignore"):
        for a, b, q in rows:
            if a is None or b is None:
                assert q is None
            else:
                want = float(np.float64(a) / np.float64(b))
                assert q == want or (math.isnan(q) and math.isnan(want)), (a, b, q, want)


def test_sum_or_zero(spark):
    rows = spark.createDataFrame([("x", None), ("y", 1.5), ("y", None)], "k string, v double")
    got = {row.k: row.s for row in rows.groupBy("k").agg(sum_or_zero(F.col("v")).alias("s")).collect()}
    assert got == {"x": 0.0, "y": 1.5}


def test_n_unique_counts_null(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert rows.agg(n_unique("k").alias("n")).first().n == 3
    assert rows.where("k is not null").agg(n_unique("k").alias("n")).first().n == 2
    assert rows.where("false").agg(n_unique("k").alias("n")).first().n == 0


def test_series_fields(spark):
    ids = spark.createDataFrame([("JTS300000000000000TSR",), ("JTU510099061234501HIL",)], "series_id string")
    got = [tuple(row) for row in ids.select(*series_columns()).collect()]
    assert got == [("S", "300000", "00", "00000", "00", "TS", "R"),
                   ("U", "510099", "06", "12345", "01", "HI", "L")]
