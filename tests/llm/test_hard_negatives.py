"""Hard negatives against a plain search of all rows."""

from __future__ import annotations

import os
from fractions import Fraction
from math import floor, inf, nan

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from laborloom.llm import hard_negatives as hn
from laborloom.llm.oracle import ORACLE_SQL
from laborloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100, n_positives=5, n_negatives=10, low=30, high=90):
    whole = lambda x: floor(256 * Fraction(float(np.float32(x))))
    used = [(i, label, tuple(map(whole, v))) for i, v, label in rows
            if i is not None and label is not None and v is not None
            and all(x is not None and abs(x) < inf for x in v)]
    out = []
    for i, label, a in dict.fromkeys(r for r in used if r[0] % every == 0):
        dot = lambda b: sum(x * y for x, y in zip(a, b, strict=False))  # noqa: E731, B023
        near = sorted((-dot(b), j, other == label) for j, other, b in used if j != i)
        for p, j, _ in [r for r in near if r[2]][:n_positives]:
            within = [r for r in near if not r[2] and low * -p <= 100 * -r[0] <= high * -p][:n_negatives]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(within, 1)]
    return sorted(out)


def mined(frame, **more):
    return sorted(map(tuple, hn.mined(frame, F.col("vec_id") % 100 == 0, **more).collect()))


def random_rows(rng, n, dims, scale=0.2, labels=4):
    return [(i, [float(x) for x in np.float32(rng.normal(0, scale, dims))], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 8, 30])
def test_scores_are_exact(dims):
    rng = np.random.default_rng(dims)
    for most in (1, 2, 300, 1 << 20):
        anchors = rng.integers(-most, most + 1, (20, dims))
        rows = rng.integers(-most, most + 1, (3000, dims))
        wide = np.pad(anchors, ((0, 0), (0, -dims % 8)))
        assert (hn.whole_numbers(hn.bit_planes(anchors)) == wide).all()
        assert (hn.scores(wide, hn.bit_planes(rows)) == rows @ anchors.T).all()


def test_rows_packed_apart_score_together():
    values = [np.array([[1, -2, 3]]), np.array([[-300] * 9]), np.zeros((1, 0), dtype=np.int64), np.array([[5]])]
    packed = [hn.bit_planes(v)[0] for v in values]
    both = hn.common_planes([p.tobytes() for p in packed], np.array([p.shape[1] for p in packed]))
    whole = hn.whole_numbers(both)
    for row, v in zip(whole, values, strict=True):
        assert row.tolist() == v[0].tolist() + [0] * (16 - v.shape[1])


def test_scores_that_do_not_fit_raise():
    with pytest.raises(OverflowError):
        hn.scores(np.full((1, 8), 1 << 40), hn.bit_planes(np.full((1, 8), 1 << 40)))


def test_random_vectors(spark, monkeypatch):
    rows = random_rows(np.random.default_rng(1), 450, 20)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert mined(frame) == plain(rows)
    # Other bounds, many parts of rows and of anchors.
    monkeypatch.setattr(hn, "PART_ROWS", 60)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 2)
    assert mined(frame, n_positives=3, n_negatives=4, low=0, high=100) == plain(rows, 100, 3, 4, 0, 100)


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    rows = random_rows(rng, 130, 9, labels=3)
    copy = rows[17][1]
    rows += [(200, copy, 0), (200, copy, 0), (200, copy, 1), (300, [], 0), (301, copy[:4], 1), (302, copy + [1.0] * 8, 2)]
    rows += [(1000 + i, copy, i % 3) for i in range(120)]  # ties
    rows += [(5, rows[5][1], rows[5][2])] * 3  # repeated rows
    rows += [(400, None, 0), (401, copy, None), (None, copy, 0), (402, [nan] + copy[1:], 0), (403, [inf] + copy[1:], 1),
             (404, [None] + copy[1:], 1), (500, [-x for x in copy], 0), (600, [0.0] * 9, 2)]
    frame = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA + ", anchor long, planes string").repartition(4)
    assert mined(frame) == plain(rows)
    assert mined(frame.where("false")) == mined(frame.where("vec_id = 7")) == mined(frame.where("vec_id = 200")) == []


@pytest.mark.parametrize("sf", [SF])
def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{os.path.join(sf, 'embeddings.parquet')}'")
    frame = QUERIES["op11_hard_negative_mining"](spark, sf)
    want = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({ORACLE_SQL['op11_hard_negative_mining']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(want) and want
