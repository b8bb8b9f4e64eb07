"""Partners of a band join counted by ranks, against the pairs themselves."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.operators.pairs import band_pairs
from paneloom.operators.ranges import _ends, band_counts
from paneloom.plans import edges as E, graph as G

SCHEMA = "k string, g string, v double"


def sample(spark):
    """Decimal steps whose differences round either way, a hot value, a hot group, missing and odd values."""
    rng = np.random.default_rng(9)
    steps = (rng.integers(0, 300, 400) / 10).tolist() + [12.3] * 60 + [0.0, -0.0, 1e-300, -5.0, 5.0, 1e17, 1e17 + 16]
    rows = [(f"k{i}", "hot" if i % 3 else f"g{i % 5}", v) for i, v in enumerate(steps)]
    rows += [("n1", None, 4.0), (None, "hot", 4.0), ("n2", "hot", None), ("n3", "hot", float("nan")), ("n4", "hot", float("inf"))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("equi,closed,width", [((), False, 5.0), (("g",), True, 1.4), (("g",), False, 0.1)])
def test_counts_equal_pairs(spark, equi, closed, width):
    df = sample(spark)
    pairs = band_pairs(df.filter(~F.isnan("v") & (F.abs("v") < float("inf"))), "k", "v", width, equi, closed).collect()
    want, other = Counter(), Counter()
    for r in pairs:
        for end in (r["k_a"], r["k_b"]):
            want[end] += 1
            other[end] += r["v_a"] != r["v_b"]
    assert {r["key"]: r["n"] for r in band_counts(df, "k", "v", width, equi, closed).collect()} == dict(want)
    got = {r["key"]: r["n"] for r in band_counts(df, "k", "v", width, equi, closed, apart=True).collect()}
    assert got == {k: n for k, n in other.items() if n}


def test_ends_are_tight():
    v = np.concatenate([np.random.default_rng(3).normal(scale=100, size=500).round(1), [0.0, 1e-300, -5.0, 5.0, 1e17, -1e17]])
    for closed in (False, True):
        ends = _ends(5.0, closed)(v)
        hi, lo = ends["hi"].to_numpy(), ends["lo"].to_numpy()
        out = (lambda gap: gap > 5.0) if closed else (lambda gap: gap >= 5.0)
        assert out(hi - v).all() and not out(np.nextafter(hi, -np.inf) - v).any()
        assert out(v - lo).all() and not out(v - np.nextafter(lo, np.inf)).any()


def test_empty(spark):
    df = sample(spark).limit(0)
    assert band_counts(df, "k", "v", 5.0).count() == 0 and band_counts(df, "k", "v", 5.0, ["g"]).count() == 0


def test_queries_build_no_pairs(spark, rows, monkeypatch):
    import __spark_entry__ as entry_points

    def never(*args, **kwargs):
        raise AssertionError("pairs were built")

    sf = "/root/testdata/sf0.001"
    from paneloom.catalog import fixtures as fx

    v, e = fx.graph(spark, sf)
    kpis, top = rows(G.graph_kpis(v, e)), [tuple(r) for r in G.degree(v, e).collect()]
    monkeypatch.setattr(E, "band_pairs", never)
    assert rows(entry_points.queries()["graph_kpis"](spark, sf)) == kpis
    assert [tuple(r) for r in entry_points.queries()["degree"](spark, sf).collect()] == top
