"""Graph queries over vertex and edge tables (GQ1-GQ9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paneloom.operators.joins import in_both, with_continent
from paneloom.operators.ordering import top_n, union_all
from paneloom.operators.ranges import band_counts, furthest_pairs
from paneloom.plans.edges import (
    BELONGS, CORRELATION_MIN, MIN_POINTS, PEAK_LAG_MAX, POLICY, POLICY_DIFF_MAX, SIMILAR, SPREAD, UNKNOWN, correlation_edges, dated, spread_edges, undirected, unfold,
)
from paneloom.session import cut_lineage


def graph_summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes per label and edges per type."""
    nodes = vertices.groupBy(F.lit("node").alias("kind"), F.col("label").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    links = edges.groupBy(F.lit("edge").alias("kind"), F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return nodes.unionByName(links)


def graph_kpis(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Entities, similar pairs, policy pairs and spread arcs in one row."""
    nodes = vertices.agg(F.count_if(F.col("label") == "Country").alias("countries")).scalar()
    return edges.agg(
        F.count_if(F.col("type") == SIMILAR).alias("similar_pairs"),
        F.count_if(F.col("type") == POLICY).alias("policy_pairs"),
        F.count_if(F.col("type") == SPREAD).alias("spread_arcs"),
    ).select(nodes.alias("countries"), "similar_pairs", "policy_pairs", "spread_arcs")


def _degrees(edges: DataFrame, types: Sequence[str] | None, name: str) -> DataFrame:
    chosen = edges if types is None else edges.filter(F.col("type").isin(*types))
    return undirected(chosen).groupBy("id").agg(F.count(F.lit(1)).alias(name))


def hubs(vertices: DataFrame, edges: DataFrame, n: int = 15) -> DataFrame:
    """Entities with most similar-pattern links. Degrees are counted before the attributes join."""
    links = _degrees(edges, [SIMILAR], "connections")
    nodes = vertices.filter(F.col("label") == "Country").select(
        "id", "continent", "total_confirmed", F.round("total_deaths_per_million").alias("deaths_per_million")
    )
    return top_n(links.join(nodes, "id"), "connections", n, "id")


def degree(
    vertices: DataFrame, edges: DataFrame, n: int = 10, types: Sequence[str] | None = None, dim: DataFrame | None = None
) -> DataFrame:
    """Degree over all relations, the membership link included; continent from ``dim`` if given."""
    links = _degrees(edges, types, "degree")
    nodes = vertices.filter(F.col("label") == "Country").select("id", "continent")
    top = top_n(links.join(nodes, "id"), "degree", n, "id")
    return top if dim is None else with_continent(top, dim, "id", "continent")


def relation_counts(
    panel: DataFrame, metrics: DataFrame, threshold: float = CORRELATION_MIN, min_points: int = MIN_POINTS,
    policy: float = POLICY_DIFF_MAX, max_lag: int = PEAK_LAG_MAX, index: str = "avg_containment_health_index",
) -> DataFrame:
    """``(id, type, n)``: the links of each entity by type, as the graph of ``panel`` and ``metrics`` has them.

    Policy links and spread arcs are counted by ranks, without their pairs; only correlations must be compared.
    ``metrics`` has one row for each entity and feeds three parts, so it should be a stored table.
    """
    known = metrics.filter(F.col("continent").isNotNull() & ~F.col("continent").isin(*UNKNOWN))
    similar = undirected(correlation_edges(panel, threshold, min_points)).groupBy(F.col("id").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    dated = known.withColumn("_day", F.unix_date("peak_date"))
    parts = {
        SIMILAR: similar,
        POLICY: band_counts(metrics.filter(F.col(index) > 0), "iso_code", index, policy),
        SPREAD: band_counts(dated, "iso_code", "_day", max_lag, ["continent"], closed=True, apart=True),
        BELONGS: known.select(F.col("iso_code").alias("key"), F.lit(1).cast("long").alias("n")),
    }
    return union_all([part.select(F.col("key").alias("id"), F.lit(t).alias("type"), "n") for t, part in parts.items()])


def kpis_of_counts(metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """``graph_kpis`` from the links of each entity: every link has two ends."""
    entities = metrics.agg(F.count("iso_code").alias("countries")).scalar()
    links = lambda t: (F.coalesce(F.sum(F.when(F.col("type") == t, F.col("n"))), F.lit(0)) / 2).cast("long")
    return counts.agg(
        links(SIMILAR).alias("similar_pairs"), links(POLICY).alias("policy_pairs"), links(SPREAD).alias("spread_arcs")
    ).select(entities.alias("countries"), "similar_pairs", "policy_pairs", "spread_arcs")


def degree_of_counts(metrics: DataFrame, counts: DataFrame, n: int = 10, types: Sequence[str] | None = None) -> DataFrame:
    """``degree`` from the links of each entity."""
    chosen = counts if types is None else counts.filter(F.col("type").isin(*types))
    links = chosen.groupBy("id").agg(F.sum("n").alias("degree"))
    return top_n(links.join(metrics.select(F.col("iso_code").alias("id"), "continent"), "id"), "degree", n, "id")


def _arcs(edges: DataFrame, type_: str) -> DataFrame:
    return edges.filter(F.col("type") == type_).select("src", "dst")


def spread_reach(
    edges: DataFrame | None, src: str, k: int = 3, type_: str = SPREAD, band: Sequence | None = None
) -> DataFrame:
    """Nodes within ``k`` hops along directed edges, with their smallest hop count.

    Each step expands the nodes reached for the first time only and keeps one row per node, so the
    work of all steps together is bounded by the edges, not by the paths. A frontier is written out
    before the next step starts from it: plans stay short, and an empty one ends the search.
    ``edges`` should be a stored table, as it is scanned once per step. In their place ``band``, the rows and the width that
    fold spread arcs (``read_bands``), gives the same without building an arc.
    """
    if band is not None:
        return _reach_in_band(*band, src, k).filter("hops > 0").select(F.col("iso_code").alias("id"), "hops")
    arcs = _arcs(edges, type_)
    start = arcs.filter((F.col("src") == F.lit(src)) & (F.col("dst") != F.lit(src)))
    frontier = start.select(F.col("dst").alias("id")).distinct().withColumn("hops", F.lit(1))
    seen = None
    for hop in range(2, k + 1):
        frontier = cut_lineage(frontier, "frontier")
        seen = frontier if seen is None else seen.unionByName(frontier)
        if frontier.isEmpty():
            return seen
        step = arcs.join(frontier.select(F.col("id").alias("src")), "src", "left_semi")
        step = step.select(F.col("dst").alias("id")).distinct().filter(F.col("id") != F.lit(src))
        frontier = step.join(seen.select("id"), "id", "left_anti").withColumn("hops", F.lit(hop))
    return frontier if seen is None else seen.unionByName(frontier)


def _reach_in_band(rows: DataFrame, width: float, src: str, k: int) -> DataFrame:
    """``rows`` of the source, at no hops, and of the entities within ``k`` hops, with their smallest hop count.

    Whom an entity reaches depends on its continent and day alone, so a step goes by the different days of the entities
    reached for the first time, spread over the days that the band allows: it joins days, not entities, and is linear.
    """
    days = dated(rows).filter(F.col("iso_code").isNotNull() & F.col("_day").isNotNull())
    frontier = cut_lineage(days.filter(F.col("iso_code") == F.lit(src)).withColumn("hops", F.lit(0)), "frontier")
    seen, lags = frontier, [F.lit(lag) for lag in range(1, int(width) + 1)]
    for hop in range(1, k + 1):
        if not lags or frontier.isEmpty():
            break
        later = frontier.select("continent", F.explode(F.array(*[F.col("_day") + lag for lag in lags])).alias("_day")).distinct()
        step = days.join(later, ["continent", "_day"], "left_semi").join(seen.select("iso_code"), "iso_code", "left_anti")
        frontier = cut_lineage(step.withColumn("hops", F.lit(hop)).select(*frontier.columns), "frontier")
        seen = seen.unionByName(frontier)
    return seen.drop("_day")


def _paths_in_band(rows: DataFrame, width: float, src: str, k: int, vertices: DataFrame | None) -> DataFrame:
    """The arcs on paths of at most ``k`` hops: of the entities that they lie between alone, which bring the hops and the
    rates along, so that arcs are unfolded once and neither joined nor exchanged."""
    near, told = _reach_in_band(rows, width, src, k), ["hops"]
    if vertices is not None:
        rate = vertices.filter(F.col("label") == "Country").select(F.col("id").alias("iso_code"), F.col("total_deaths_per_million").alias("deaths_per_million"))
        near, told = near.join(rate, "iso_code", "left"), ["hops", "deaths_per_million"]
    arcs = spread_edges(near, int(width), told).filter(F.col("src_hops") < k)
    return arcs.select("src", "dst", F.col("src_hops").alias("from_hop"), *(f"{end}_{c}" for c in told[1:] for end in ("src", "dst")))


def spread_edges_on_paths(
    edges: DataFrame | None, src: str, k: int = 3, type_: str = SPREAD, vertices: DataFrame | None = None, unique: bool = False,
    band: Sequence | None = None,
) -> DataFrame:
    """Distinct edges on the paths of at most ``k`` hops, with the hop of their start and, when the
    vertices are given, the death rates of both ends. ``unique`` says that each edge is there once, as in a graph
    that was built; then they need no exchange, as no node starts edges at two hops. In place of the edges ``band`` gives
    the same, as in ``spread_reach``; entities occur once in it."""
    if band is not None:
        return _paths_in_band(*band, src, k, vertices)
    arcs = _arcs(edges, type_)
    first = arcs.filter(F.col("src") == F.lit(src)).withColumn("from_hop", F.lit(0))
    out = first
    if k > 1:
        inner = spread_reach(edges, src, k - 1, type_).select(F.col("id").alias("src"), F.col("hops").alias("from_hop"))
        out = first.unionByName(arcs.join(inner, "src").select("src", "dst", "from_hop"))
    out = out if unique else out.distinct()
    if vertices is None:
        return out
    rate = vertices.filter(F.col("label") == "Country").select("id", "total_deaths_per_million")
    a = rate.toDF("src", "src_deaths_per_million")
    b = rate.toDF("dst", "dst_deaths_per_million")
    return out.join(a, "src", "left").join(b, "dst", "left").select(
        "src", "dst", "from_hop", "src_deaths_per_million", "dst_deaths_per_million"
    )


def _with_ends(edges: DataFrame, vertices: DataFrame, col: str) -> DataFrame:
    """One attribute of both ends beside each edge, as ``a`` and ``b``; edges that carry it (``read_graph``) are not joined."""
    carried = [f"src_{col}", f"dst_{col}"]
    if set(carried) <= set(edges.columns):
        return edges.withColumnsRenamed(dict(zip(carried, "ab")))
    nodes = vertices.filter(F.col("label") == "Country").select("id", col)
    return edges.join(nodes.toDF("src", "a"), "src").join(nodes.toDF("dst", "b"), "dst")


def divergent_pairs(
    vertices: DataFrame, edges: DataFrame, gap: float = 500.0, n: int = 10, both_orientations: bool = False
) -> DataFrame:
    """Similar policy, different outcome: linked entities whose death rates differ by more than ``gap``."""
    linked = edges.filter(F.col("type") == POLICY).select("src", "dst")
    if both_orientations:
        linked = undirected(linked.withColumn("type", F.lit(POLICY))).select(
            F.col("id").alias("src"), F.col("other").alias("dst")
        )
    diff = F.abs(F.col("a") - F.col("b"))
    rated = _with_ends(linked, vertices, "total_deaths_per_million").filter((F.col("a") > 0) & (F.col("b") > 0))
    return _shown(rated.filter(diff > gap).orderBy(diff.desc(), "src", "dst").limit(n))


def _shown(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("src").alias("country_a"),
        F.round("a").alias("deaths_a"),
        F.col("dst").alias("country_b"),
        F.round("b").alias("deaths_b"),
    )


def divergent_in_band(
    vertices: DataFrame, rows: DataFrame, width: float, gap: float = 500.0, n: int = 10, both_orientations: bool = False,
    index: str = "avg_containment_health_index",
) -> DataFrame:
    """``divergent_pairs`` of the policy links that ``rows`` and ``width`` fold (``read_bands``), without building them.

    Where a death rate is not finite, or ``gap`` is negative, the links are built.
    """
    col = "total_deaths_per_million"
    nodes = vertices.filter(F.col("label") == "Country").select(F.col("id").alias("iso_code"), col)
    rated = cut_lineage(rows.join(nodes, "iso_code").filter((F.col(index) > 0) & (F.col(col) > 0)), "rates")
    if gap < 0 or not rated.filter(F.isnan(col) | (F.col(col) == float("inf"))).isEmpty():
        return divergent_pairs(vertices, unfold(rows, POLICY, width), gap, n, both_orientations)
    return _shown(furthest_pairs(rated, "iso_code", index, width, col, gap, n, both_orientations))


def continent_density(
    vertices: DataFrame, edges: DataFrame, dim: DataFrame | None = None,
    both_orientations: bool = False, keep_unknown: bool = False,
) -> DataFrame:
    """Similar-pattern links inside each continent, each pair once unless asked otherwise."""
    nodes = vertices.filter(F.col("label") == "Country")
    carried = [c for c in ("src_continent", "dst_continent") if c in edges.columns]
    if dim is not None:
        nodes, carried = with_continent(nodes.select("id", "label"), dim, "id", "continent"), []
    inside = _with_ends(edges.filter(F.col("type") == SIMILAR).select("src", "dst", *carried), nodes, "continent")
    inside = inside.filter(F.col("a") == F.col("b"))
    if not keep_unknown:
        inside = inside.filter(F.col("a") != "Unknown")
    count = F.count(F.lit(1)) * (2 if both_orientations else 1)
    return inside.groupBy(F.col("a").alias("continent")).agg(count.alias("internal_links"))


def top_rated(vertices: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` entities with the highest death rate."""
    rated = vertices.filter((F.col("label") == "Country") & F.col("total_deaths_per_million").isNotNull())
    return top_n(rated.select("id", "continent", "total_deaths_per_million"), "total_deaths_per_million", n, "id")


def top_subgraph(
    vertices: DataFrame, edges: DataFrame, n: int = 30, types: Sequence[str] = (SIMILAR, POLICY, SPREAD)
) -> tuple[DataFrame, DataFrame]:
    """Edges among the ``n`` entities with the highest death rate, and those of them that have one.

    Returns nodes with the size class of the drawing, and edges.
    """
    top = top_rated(vertices, n)
    links = in_both(edges.filter(F.col("type").isin(*types)).select("src", "dst", "type"), top)
    rate = F.col("total_deaths_per_million")
    size = F.when(rate != 0, F.greatest(F.lit(10), F.least(F.lit(38), (rate / 80).cast("int")))).otherwise(F.lit(12))
    linked = undirected(links).select("id").distinct()
    nodes = top.join(linked, "id", "left_semi").select("id", "continent", rate, size.alias("size"))
    return nodes, links


