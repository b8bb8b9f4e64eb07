"""Pair operators and graph queries against brute force and hand-drawn graphs."""

import datetime as dt
import re
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneloom.operators.pairs import band_pairs, correlated_pairs
from paneloom.plans import edges as E, graph as G

D = dt.date(2020, 1, 1)


@pytest.mark.parametrize("hot", [1, 3, 1000])
@pytest.mark.parametrize("closed", [False, True])
def test_band_pairs(spark, hot, closed):
    rng = np.random.default_rng(3)
    # A third of the rows share one value: one hot bucket.
    values = np.where(rng.random(120) < 0.33, 10, rng.integers(-40, 40, 120))
    rows = [(f"k{i}", int(v), "g" if i % 4 else "h") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v int, g string")
    got = [(r["k_a"], r["k_b"]) for r in band_pairs(df, "k", "v", 5, ["g"], closed, hot).collect()]
    want = {
        tuple(sorted((a[0], b[0])))
        for a, b in combinations(rows, 2)
        if a[2] == b[2] and (abs(a[1] - b[1]) <= 5 if closed else abs(a[1] - b[1]) < 5)
    }
    assert len(got) == len(want) and {tuple(sorted(p)) for p in got} == want


def test_band_pairs_is_an_equi_join(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.rand(1).alias("v"))
    plan = band_pairs(df, "k", "v", 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_correlated_pairs_against_pandas(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(3, 40)).cumsum(axis=1)
    frames = []
    for i in range(40):
        series = base[i % 3] * rng.choice([-1, 1]) + rng.normal(size=40) * 0.4 + 1000 * i
        if i == 5:
            series = np.full(40, 7.0)
        keep = rng.random(40) < (0.9 if i != 6 else 0.2)
        days = np.flatnonzero(keep)
        frames.append(pd.DataFrame({"k": f"s{i:02d}", "d": [D + dt.timedelta(int(x)) for x in days], "v": series[days]}))
    # One series is constant on the days it shares with most others.
    odd = pd.DataFrame({"k": "zz", "d": [D + dt.timedelta(i) for i in range(60)], "v": [5.0] * 40 + list(range(20))})
    frame = pd.concat([*frames, odd])
    pivot = frame.pivot_table(index="d", columns="k", values="v")
    pivot = pivot[[c for c in pivot if pivot[c].notna().sum() >= 20]]
    corr = pivot.corr()
    want = {(a, b): corr.loc[a, b] for a, b in combinations(corr.columns, 2) if abs(corr.loc[a, b]) >= 0.85}
    df = spark.createDataFrame(list(frame.itertuples(index=False, name=None)), "k string, d date, v double")
    for block in (5, 1000):
        got = {(r["src"], r["dst"]): r["correlation"] for r in correlated_pairs(df, "k", "d", "v", 0.85, 20, block=block).collect()}
        assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)
    signed = correlated_pairs(df, "k", "d", "v", 0.85, 20, signed=True).collect()
    assert {(r["src"], r["dst"]) for r in signed} == {p for p, r in want.items() if r > 0}


def metrics(spark):
    rows = [
        ("AAA", "Europe", D, 50.0, 100.0), ("BBB", "Europe", D + dt.timedelta(14), 55.0, 900.0),
        ("CCC", "Europe", D + dt.timedelta(15), 54.99, 90.0), ("DDD", "Europe", D, 0.0, 10.0),
        ("EEE", "Unknown", D + dt.timedelta(1), 51.0, 0.0), ("FFF", None, D + dt.timedelta(1), 20.0, 5.0), ("GGG", "Asia", None, 21.0, 700.0),
    ]
    return spark.createDataFrame(rows, "iso_code string, continent string, peak_date date, avg_containment_health_index double, total_deaths_per_million double").withColumn("total_confirmed", F.lit(7).cast("long"))


def test_policy_edges(spark, rows):
    got = rows(E.policy_edges(metrics(spark)).select("src", "dst", "stringency_diff"))
    assert got == [("AAA", "CCC", 4.99), ("AAA", "EEE", 1.0), ("BBB", "CCC", 0.01), ("BBB", "EEE", 4.0), ("CCC", "EEE", 3.99), ("FFF", "GGG", 1.0)]


def test_spread_edges(spark, rows):
    got = rows(E.spread_edges(metrics(spark)).select("src", "dst", "peak_lag_days", "peak_date_source", "peak_date_target"))
    assert got == [("AAA", "BBB", 14, D, D + dt.timedelta(14)), ("BBB", "CCC", 1, D + dt.timedelta(14), D + dt.timedelta(15)), ("DDD", "BBB", 14, D, D + dt.timedelta(14))]


@pytest.fixture(scope="module")
def drawn(spark):
    """A five-node arc diagram: a>b>d>e, a>c>d, and a lone pair."""
    m = metrics(spark)
    arcs = spark.createDataFrame([("AAA", "BBB"), ("BBB", "DDD"), ("DDD", "EEE"), ("AAA", "CCC"), ("CCC", "DDD"), ("FFF", "GGG")], "src string, dst string").withColumn("type", F.lit(E.SPREAD))
    similar = spark.createDataFrame([("AAA", "BBB", -0.9), ("AAA", "CCC", 0.9), ("AAA", "GGG", 0.88)], "src string, dst string, correlation double").withColumn("type", F.lit(E.SIMILAR))
    v, e = E.build_graph(E.vertices_of(m), arcs, arcs, similar, E.policy_edges(m), E.belongs_edges(m))
    return v.cache(), e.cache()


def test_build(drawn, rows):
    v, e = drawn
    assert rows(G.graph_summary(v, e)) == [
        ("edge", E.BELONGS, 5), ("edge", E.SPREAD, 6), ("edge", E.SIMILAR, 3), ("edge", E.POLICY, 6), ("node", "Continent", 2), ("node", "Country", 7),
    ]
    assert rows(G.graph_kpis(v, e)) == [(7, 3, 6, 6)]
    assert e.filter("directed").count() == 11


def test_reach(drawn, rows):
    _, e = drawn
    assert rows(G.spread_reach(e, "AAA", 1)) == [("BBB", 1), ("CCC", 1)]
    assert rows(G.spread_reach(e, "AAA", 3)) == [("BBB", 1), ("CCC", 1), ("DDD", 2), ("EEE", 3)]
    assert rows(G.spread_reach(e, "EEE", 3)) == []


def test_reach_matches_recursive_sql(spark, drawn, rows):
    _, e = drawn
    e.filter(F.col("type") == E.SPREAD).createOrReplaceTempView("arcs")
    want = spark.sql("""WITH RECURSIVE r(id, hops) AS (SELECT dst, 1 FROM arcs WHERE src = 'AAA'
        UNION ALL SELECT a.dst, r.hops + 1 FROM r JOIN arcs a ON a.src = r.id WHERE r.hops < 3)
        SELECT id, min(hops) AS hops FROM r GROUP BY id""")
    assert rows(G.spread_reach(e, "AAA", 3)) == rows(want)


def test_cycles_do_not_return_to_the_source(spark, rows):
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string").withColumn("type", F.lit(E.SPREAD))
    assert rows(G.spread_reach(ring, "a", 12)) == [("b", 1), ("c", 2)]


def test_path_edges(drawn, rows):
    v, e = drawn
    assert rows(G.spread_edges_on_paths(e, "AAA", 2)) == [("AAA", "BBB", 0), ("AAA", "CCC", 0), ("BBB", "DDD", 1), ("CCC", "DDD", 1)]
    full = rows(G.spread_edges_on_paths(e, "AAA", 3, vertices=v))
    assert len(full) == 5 and full[0] == ("AAA", "BBB", 0, 100.0, 900.0)


def test_rankings(drawn, rows, spark):
    v, e = drawn
    assert [tuple(r) for r in G.hubs(v, e, 2).select("id", "connections").collect()] == [("AAA", 3), ("BBB", 1)]
    top = [tuple(r) for r in G.degree(v, e, 3).collect()]
    assert top == [("AAA", 8, "Europe"), ("CCC", 7, "Europe"), ("BBB", 7, "Europe")] or top[0][:2] == ("AAA", 8)
    dim = spark.createDataFrame([("AAA", "Elsewhere")], "iso3 string, continent string")
    assert G.degree(v, e, 1, dim=dim).first()["continent"] == "Elsewhere"
    assert rows(G.continent_density(v, e)) == [("Europe", 2)]
    assert rows(G.continent_density(v, e, both_orientations=True)) == [("Europe", 4)]
    assert rows(G.divergent_pairs(v, e)) == [("BBB", 900.0, "CCC", 90.0), ("FFF", 5.0, "GGG", 700.0)]
    assert G.divergent_pairs(v, e, both_orientations=True).count() == 4


def test_subgraph(drawn, rows):
    v, e = drawn
    nodes, links = G.top_subgraph(v, e, 3, [E.SIMILAR, E.SPREAD])
    assert rows(links) == [("AAA", "BBB", E.SPREAD), ("AAA", "BBB", E.SIMILAR), ("AAA", "GGG", E.SIMILAR)]
    assert rows(nodes.select("id", "size")) == [("AAA", 10), ("BBB", 11), ("GGG", 10)]


def test_graph_page(drawn):
    from paneloom.plans.pages import graph_page

    page = graph_page(*drawn, "AAA")
    assert page["reach"].count() == 4 and page["density"].count() == 1


def test_task_code_travels_without_the_package(tmp_path):
    """Executors have no copy of the package: the pickled function has to load and run on its own."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from paneloom.operators.pairs import _block_edges

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(_block_edges(0.5, False)))
    code = """
import pickle, sys
import pandas as pd
f = pickle.load(open(sys.argv[1], "rb"))
g = pd.DataFrame({"i": 0, "j": 0, "home": 0, "key": ["a", "b"], "days": [[1, 2, 3]] * 2, "values": [[1.0, 2.0, 3.0], [2.0, 4.0, 6.0]]})
print(len(f(g)), "paneloom" in sys.modules)
"""
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "f.pkl")], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["1", "False"]


def test_band_join_deals_a_hot_bucket_in_small_units(spark):
    """No unit compares more than two slices, however many rows share a bucket: 64 rows in slices of 8."""
    df = spark.range(64).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1.0).alias("v"))
    pairs = band_pairs(df, "k", "v", 5.0, hot=8)
    assert pairs.count() == 64 * 63 // 2 and "Generate inline" in pairs._jdf.queryExecution().toString()


@pytest.mark.parametrize("edges", ["policy", "spread"])
def test_no_row_unfolds_into_a_whole_unit(spark, monkeypatch, edges):
    """What one row unfolds into waits in memory until all of it is made, so it is a square of slices, not two slices."""
    from paneloom.operators import pairs as P

    n, seen, cut = 300, [], P._squares
    monkeypatch.setattr(P, "_squares", lambda size: seen.append(size) or cut(size))
    monkeypatch.setattr(P, "SQUARE", 16)
    data = [(f"k{i}", "Asia", D + dt.timedelta(i % 3), 50.0 + i % 4) for i in range(n)]
    m = spark.createDataFrame(data, "iso_code string, continent string, peak_date date, avg_containment_health_index double")
    got = E.policy_edges(m) if edges == "policy" else E.spread_edges(m)
    want = n * (n - 1) // 2 if edges == "policy" else n * n // 3
    assert seen == [16] and got.distinct().count() == got.count() == want and all(r["src"] < r["dst"] for r in got.collect() if edges == "policy")
    # Units of all sizes at once, with what goes along: none has more than the size on either side, and the pairs are the same.
    units = spark.createDataFrame([("g", False, [(f"a{i}", i, None) for i in range(a)], [(f"b{i}", i, "x") for i in range(b)]) for a, b in ((1, 1), (40, 3), (5, 33), (32, 16), (16, 16))],
        "g string, apart boolean, left array<struct<k:string,v:int,c0:string>>, right array<struct<k:string,v:int,c0:string>>")
    squares = units.mapInArrow(cut(16), units.schema)
    assert squares.selectExpr("max(greatest(size(left), size(right)))").first()[0] == 16 and squares.filter("size(left) = 0 OR size(right) = 0").isEmpty()
    pairs = lambda u: sorted(map(repr, u.selectExpr("g", "apart", "right", "inline(left) AS (k, v, c)").selectExpr("*", "inline(right) AS (l, w, d)").drop("right").collect()))
    assert pairs(squares) == pairs(units)


def test_what_goes_along_with_a_band(spark, rows):
    df = spark.createDataFrame([("a", 1.0, "x", 1), ("b", 2.0, None, 2), ("c", 9.0, "z", None)], "k string, v double, t string, n int")
    got = band_pairs(df, "k", "v", 8.0, carry=["t", "n"]).select("k_a", "t_a", "n_a", "k_b", "t_b", "n_b")
    sides = [tuple(sorted((r[:3], r[3:]), key=lambda side: side[0])) for r in rows(got)]
    assert sorted(sides, key=repr) == [(("a", "x", 1), ("b", None, 2)), (("b", None, 2), ("c", "z", None))]


def test_rounding_near_ties(spark):
    """The quick way rounds as decimals do, on ties and noise beside them, and gives no negative zero."""
    from paneloom.functions.numeric import round_half_up

    rng = np.random.default_rng(2)
    ties = (rng.integers(-20_000, 20_000, 2_000) + 0.5) / 1e4
    values = np.concatenate([ties, ties + 4e-10, ties - 4e-10, ties - 6e-10, rng.normal(size=2_000), rng.normal(size=500) * 1e9, [0.0, -0.0, -1e-12, 1e15]])
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    for digits in (0, 2, 4, 8, 9):
        exact = F.round(F.col("x").cast("decimal(28,9)"), digits).cast("double")
        pairs = df.select(round_half_up(F.col("x"), digits).alias("a"), exact.alias("b")).collect()
        assert [repr(r["a"]) for r in pairs] == [repr(r["b"]) for r in pairs]


@pytest.mark.parametrize("cells", [40, 10_000])
def test_correlations_by_tiles(spark, monkeypatch, cells):
    """Tiles cover every pair once however many there are, and copies of a series do not grow with the blocks."""
    from paneloom.operators import pairs as P

    monkeypatch.setattr(P, "CELLS", cells)
    monkeypatch.setattr(P, "TILES", 3)
    rows = [(f"s{k:02d}", D + dt.timedelta(day), float((day + k % 2) % 3 + day % (5 + k % 2))) for k in range(30) for day in range(12)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    found = correlated_pairs(df, "k", "d", "v", 0.99, 5, block=2)
    dealt = int(re.search(r"RepartitionByExpression \[i#\d+, j#\d+\], (\d+)", found._jdf.queryExecution().optimizedPlan().toString())[1])
    assert dealt == (6 if cells == 10_000 else 45)  # units: 15 blocks are 3 tiles, or 9 where a tile may hold 40 values
    assert sorted((r["src"], r["dst"]) for r in found.collect()) == [(f"s{a:02d}", f"s{b:02d}") for a in range(30) for b in range(a + 1, 30) if (b - a) % 2 == 0]


def test_stored_graph_keeps_bands_folded(spark, fresh, rows):
    import os

    from paneloom.sources import readers, versions, writers

    m, path = metrics(spark), fresh("graph")
    panel = spark.createDataFrame([("AAA", D, 1.0)], "ISO_Code string, Date date, New_Cases_7d double")
    whole = E.panel_graph(panel, m)
    nodes, links, bands = E.panel_graph(panel, m, folded=True)
    writers.write_graph(nodes, links, path, bands)
    v, e = readers.read_graph(spark, path)
    assert rows(v) == rows(whole[0]) and rows(e.select(*whole[1].columns)) == rows(whole[1])
    place = versions.current_path(spark, path)
    listed = spark.read.parquet(os.path.join(place, "edges"))
    assert {r["type"] for r in listed.select("type").collect()} == {E.BELONGS}
    assert spark.read.parquet(os.path.join(place, "bands", E.POLICY)).count() == 7
    # Where entities repeat nothing is folded and edges are made unique.
    twice = m.unionByName(m)
    nodes, links, bands = E.panel_graph(panel, twice, folded=True)
    assert not bands and rows(links.select("src", "dst", "type")) == rows(whole[1].select("src", "dst", "type"))


def curves(spark, n=24):
    """A panel of ``n`` entities in three continents (and none, and the unknown one), two patterns among them."""
    places = ["Asia", "Europe", None, "Unknown", "Asia"]
    rows = [(f"E{k:02d}", D + dt.timedelta(day), float((day + k % 2) % 3 + day % (5 + k % 2))) for k in range(n) for day in range(12)]
    nodes = [(f"E{k:02d}", places[k % 5], D + dt.timedelta(k % 7), 40.0 + k / 2, 100.0 * (k % 9)) for k in range(n)]
    m = spark.createDataFrame(nodes, "iso_code string, continent string, peak_date date, avg_containment_health_index double, total_deaths_per_million double")
    return spark.createDataFrame(rows, "ISO_Code string, Date date, New_Cases_7d double"), m


def test_similar_links_are_stored_folded(spark, fresh, rows):
    """One stored row for each entity, and the same links and answers as from the graph that holds them all."""
    import os

    from paneloom.sources import readers, versions, writers

    panel, m = curves(spark)
    v, whole = E.panel_graph(panel, m, threshold=0.9, min_points=5)
    path = fresh("graph")
    nodes, links, bands = E.panel_graph(panel, m, threshold=0.9, min_points=5, folded=True)
    writers.write_graph(nodes, links, path, bands)
    place = versions.current_path(spark, path)
    assert spark.read.parquet(os.path.join(place, "edges")).select("type").distinct().count() == 1  # memberships
    assert spark.read.parquet(os.path.join(place, "bands", E.SIMILAR)).count() == 24
    stored, edges = readers.read_graph(spark, path)
    assert whole.filter(F.col("type") == E.SIMILAR).count() == 132 and rows(edges.select(*whole.columns)) == rows(whole)
    # A part of the entities, and attributes that come along instead of being joined.
    top = lambda n: (lambda vertices: G.top_rated(vertices, n))
    some = readers.read_graph(spark, path, among=top(7))
    for k in (0, 1):
        assert rows(G.top_subgraph(*some, n=7)[k]) == rows(G.top_subgraph(v, whole, 7)[k])
    ends = readers.read_graph(spark, path, ends=["continent"])
    for options in ({}, {"both_orientations": True, "keep_unknown": True}, {"dim": m.selectExpr("iso_code AS iso3", "'Here' AS continent")}):
        found = G.continent_density(*ends, **options)
        assert rows(found) == rows(G.continent_density(v, whole, **options))
    plan = G.continent_density(*ends)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_paths_without_joining_arcs(spark, rows):
    """From the folded arcs: the same reach and edges on paths, linear steps, and no arc in an exchange or a join (F2)."""
    rng = np.random.default_rng(9)
    places = ["Asia", "Europe", None, "Unknown", ""]
    data = [(f"k{i:03d}", "Country", places[rng.choice(5, p=[0.6, 0.25, 0.05, 0.05, 0.05])], D + dt.timedelta(int(rng.integers(0, 60))) if i % 11 else None, float(i) if i % 7 else None) for i in range(160)]
    v = spark.createDataFrame(data, "id string, label string, continent string, peak_date date, total_deaths_per_million double")
    folded = v.selectExpr("id AS iso_code", "continent", "peak_date")
    edges = E.spread_edges(folded, 14).cache()
    first = min((r[3], r[0]) for r in data if r[2] == "Asia" and r[3])[1]
    for lag in (14, 1):
        arcs = edges.filter(F.col("peak_lag_days") <= lag)
        for src, k in ((first, 1), (first, 3), ("k011", 3), ("none", 2)):
            assert rows(G.spread_reach(None, src, k, band=(folded, float(lag)))) == rows(G.spread_reach(arcs, src, k))
        for vertices in (None, v):
            got = G.spread_edges_on_paths(None, first, 3, vertices=vertices, unique=True, band=(folded, float(lag)))
            want = G.spread_edges_on_paths(arcs, first, 3, vertices=vertices)
            assert got.columns == want.columns and got.dtypes == want.dtypes and rows(got) == rows(want) and got.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("MapInArrow")[0] and "Exchange" not in plan.split("MapInArrow")[0]
    assert rows(G.spread_reach(None, first, 3, band=(folded, 0.0))) == []


def test_counted_links_come_without_their_ends(spark, fresh, rows):
    """Every link is a row, without the columns that a count does not need."""
    from paneloom.sources import readers, writers

    panel, m = curves(spark)
    path = fresh("graph")
    nodes, links, bands = E.panel_graph(panel, m, threshold=0.9, min_points=5, folded=True)
    writers.write_graph(nodes, links, path, bands)
    v, edges = readers.read_graph(spark, path)
    _, bare = readers.read_graph(spark, path, named=False)
    assert set(edges.columns) - set(bare.columns) == {"src", "dst"} and rows(bare.select("type", "directed", "correlation")) == rows(edges.select("type", "directed", "correlation"))
    assert rows(G.graph_summary(v, bare)) == rows(G.graph_summary(v, edges))
    made = [line for line in bare._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow edges" in line]
    assert len(made) == 1 and "src" not in made[0]


@pytest.mark.parametrize("block", [3, 1_024])
def test_correlations_of_odd_values(spark, block):
    """Coefficients block by block against those of each pair: constants, tiny spreads beside offsets, and values whose squares overflow."""
    from paneloom.operators import pairs as P

    rng = np.random.default_rng(4)
    base = rng.normal(size=(4, 30)).cumsum(1)
    values = [base[i % 4] * s + o + rng.normal(size=30) * 0.2 * s for i in range(90) for s, o in [[(1.0, 0.0), (1e-7, 50.0), (1e80, 0.0), (0.0, 3.0), (1e-3, 1e6)][i % 5]]]
    masks = rng.random((len(values), 30)) < 0.85
    rows = [(0, 0, 0, f"s{i:02d}", np.flatnonzero(m).tolist(), v[m].tolist()) for i, (v, m) in enumerate(zip(values, masks))]
    frame = pd.DataFrame(rows, columns=["i", "j", "home", "key", "days", "values"])
    for signed in (False, True):
        got = {(r.src, r.dst): (r.correlation, r.n_days) for r in P._block_edges(0.85, signed, block)(frame).itertuples()}
        want = {}
        for a, b in combinations(range(len(values)), 2):
            both = masks[a] & masks[b]
            x, y = values[a][both], values[b][both]
            if max(np.abs(x).max(), np.abs(y).max()) > 1e30 or min(x.std(), y.std()) < 1e-9:
                continue
            r = np.corrcoef(x, y)[0, 1]
            assert abs(abs(r) - 0.85) > 1e-9
            if (r if signed else abs(r)) >= 0.85:
                want[f"s{a:02d}", f"s{b:02d}"] = (r, both.sum())
        small = {p for p in got if all(int(k[1:]) % 5 != 2 for k in p)}
        assert small == want.keys() and len(want) > 50 and all(got[p][0] == pytest.approx(want[p][0], abs=1e-6) and got[p][1] == want[p][1] for p in want)


def test_divergent_pairs_without_their_links(spark, rows):
    """Hot values, differences of doubles at the band's ends, and many ties of the gap, against all links."""
    rng = np.random.default_rng(5)
    for steps, n in ((3, 10), (1, 200), (400, 25)):
        values = np.where(rng.random(150) < 0.3, 12.3, rng.integers(0, 250, 150) / 10)
        data = [(f"k{i}", "Country", float(x), float(d)) for i, (x, d) in enumerate(zip(values, rng.integers(0, steps + 1, 150) * 100.0))]
        data += [("n1", "Country", None, 900.0), ("n2", "Country", 5.0, None), ("n3", "Country", float("nan"), 1e6), ("n4", "Country", float("inf"), 1e6)]
        v = spark.createDataFrame(data, "id string, label string, avg_containment_health_index double, total_deaths_per_million double")
        policy = v.select(F.col("id").alias("iso_code"), "avg_containment_health_index")
        edges = E.policy_edges(policy, 5.0)
        for both in (False, True):
            got = G.divergent_in_band(v, policy, 5.0, 100.0, n, both)
            assert "inline" not in got._jdf.queryExecution().toString()
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in G.divergent_pairs(v, edges, 100.0, n, both).collect()]


def test_divergent_pairs_of_odd_rates(spark, rows):
    """A rate that is not finite, and a gap below zero, give what the links give."""
    data = [("a", 1.0, 10.0), ("b", 2.0, float("inf")), ("c", 3.0, float("nan")), ("d", 9.0, 10.0), ("e", 2.5, 10.0)]
    v = spark.createDataFrame([(k, "Country", x, d) for k, x, d in data], "id string, label string, avg_containment_health_index double, total_deaths_per_million double")
    policy = v.select(F.col("id").alias("iso_code"), "avg_containment_health_index")
    for frame, gap in ((v, 5.0), (v.filter("total_deaths_per_million = 10"), -1.0)):
        assert repr(rows(G.divergent_in_band(frame, policy, 5.0, gap))) == repr(rows(G.divergent_pairs(frame, E.policy_edges(policy), gap)))
    empty = v.limit(0)
    assert rows(G.divergent_in_band(empty, policy.limit(0), 5.0)) == []
