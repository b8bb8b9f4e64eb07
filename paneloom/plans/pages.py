"""Pages that combine several plans: the live forecast (V32-V34) and the graph page."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from paneloom.plans import forecast as ML, graph as G, live as LV


def live_forecast(
    hist: DataFrame, live: DataFrame, since: str, batches: int | None = None, horizon: int = ML.HORIZON, trees: int = ML.TREES
) -> Mapping[str, DataFrame | float] | None:
    """Stitched series, importances and score for the given history and live rows.

    The model learns from the entities passed in: one entity gives a model of its own. Nothing is
    returned when there are too few complete rows.
    """
    shown = LV.live_clean(live, since)
    if batches is not None:
        shown = LV.visible_batches(shown, batches)
    target = LV.live_target(hist, shown, since)
    feats = [f for f in ML.LIVE_FEATURES if f in hist.columns]
    featured = ML.build_features(ML.combine(hist, target, feats), feats)
    names = ML.feature_names(featured, feats)
    result = ML.fit_forest(featured.dropna(subset=[*names, ML.TARGET]), names, trees=trees)
    if result is None:
        return None
    model, score = result
    fit = ML.fitted(featured, model, names, target)
    ahead = ML.forecast(model, ML.last_states(featured, target, feats), feats, horizon)
    return {
        "series": LV.stitch(hist, target, fit, ahead, since),
        "importances": ML.importances(hist.sparkSession, model, names),
        "score": score,
    }


def graph_page(vertices: DataFrame, edges: DataFrame, src: str, hops: int = 3, n: int = 30, dim: DataFrame | None = None) -> Mapping[str, DataFrame]:
    """Everything the graph page shows."""
    nodes, links = G.top_subgraph(vertices, edges, n)
    return {
        "kpis": G.graph_kpis(vertices, edges),
        "nodes": nodes,
        "links": links,
        "hubs": G.hubs(vertices, edges),
        "reach": G.spread_reach(edges, src, hops),
        "path_edges": G.spread_edges_on_paths(edges, src, hops, vertices=vertices),
        "density": G.continent_density(vertices, edges, dim),
        "degree": G.degree(vertices, edges, dim=dim),
    }
