"""Pair moments against pandas: gaps, offsets, constants, NaN, null keys, many groups over many tasks."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from paneloom.operators import moments, stats as ST

NAMES = ["a", "b", "c", "d"]
SCHEMA = "k string, a double, b double, c double, d double"


def values(rng, n):
    """Columns with gaps: one far from zero, one that is constant wherever ``a`` is missing."""
    cols = np.column_stack([rng.normal(size=n), 1e7 + rng.normal(size=n), rng.integers(0, 3, n).astype(float), rng.normal(size=n)])
    cols[:, 3] += cols[:, 0]
    gone = rng.random(cols.shape) < 0.3
    cols[gone[:, 0], 3] = 5.1
    return [[None if g else float(v) for v, g in zip(row, hole)] for row, hole in zip(cols, gone)]


def brute(rows, x, y):
    both = [(r[x], r[y]) for r in rows if r[x] is not None and r[y] is not None]
    if not both:
        return None, 0
    a, b = np.array(both).T
    if a.std() < 1e-9 or b.std() < 1e-9:
        return None, len(both)
    return float(np.corrcoef(a, b)[0, 1]), len(both)


@pytest.mark.parametrize("held", [moments.HELD_BYTES, 0])
def test_pairs_of_each_group(spark, held, monkeypatch):
    monkeypatch.setattr(moments, "HELD_BYTES", held)
    rng = np.random.default_rng(5)
    keys = [None if k == 0 else f"k{k}" for k in np.minimum(rng.integers(0, 40, 3_000), 12)]
    rows = [(k, *v) for k, v in zip(keys, values(rng, 3_000))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = {(r["k"], r["x"], r["y"]): (r["r"], r["n"]) for r in ST.corr_matrix(df, NAMES, ["k"]).collect()}
    assert len(got) == 13 * 6
    for (k, x, y), (r, n) in got.items():
        want = brute([dict(zip(NAMES, row[1:])) for row in rows if row[0] == k], x, y)
        assert n == want[1] and (r is None) == (want[0] is None)
        assert r is None or r == pytest.approx(want[0], abs=1e-7)


def test_pairs_over_all_rows(spark):
    rng = np.random.default_rng(6)
    rows = [("k", *v) for v in values(rng, 25_000)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["k", *NAMES]).astype({"k": str}).replace({np.nan: None}), SCHEMA)
    got = {(r["x"], r["y"]): (r["r"], r["n"]) for r in ST.corr_matrix(df, NAMES).collect()}
    assert list(sorted(got)) == list(combinations(NAMES, 2))
    for (x, y), (r, n) in got.items():
        want = brute([dict(zip(NAMES, row[1:])) for row in rows], x, y)
        assert n == want[1] and r == pytest.approx(want[0], abs=1e-7)


def test_odd_values(spark):
    rows = [(float(i), float(i * i), 5.1) for i in range(10)] + [(math.nan, None, 5.1), (None, math.inf, 5.1)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    got = {(r["x"], r["y"]): (r["r"], r["n"]) for r in ST.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"][0] == pytest.approx(np.corrcoef(range(10), np.arange(10) ** 2)[0, 1]) and got["a", "b"][1] == 10
    assert got["a", "c"] == (None, 11) and got["b", "c"] == (None, 11)
    assert ST.corr_matrix(df.limit(0), ["a", "b"]).count() == 0
    assert ST.corr_matrix(df.limit(0), ["a", "b"], ["c"]).count() == 0


def test_no_row_unfolds(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 9, "a double, b double")
    plan = ST.corr_matrix(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Generate") <= 1
