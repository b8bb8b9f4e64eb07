"""Graph construction: entity nodes and typed edges (GE1-GE4, SNK7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paneloom.functions.numeric import round_half_up
from paneloom.operators.ordering import union_all
from paneloom.operators.pairs import band_pairs, correlated_pairs, curve_pairs, series_curves
from paneloom.session import cut_lineage

SIMILAR = "SIMILAR_EPIDEMIC_PATTERN"
POLICY = "SIMILAR_POLICY_RESPONSE"
SPREAD = "BORDER_SPREAD"
BELONGS = "BELONGS_TO"

# Thresholds of the three derived edge types.
CORRELATION_MIN = 0.85
MIN_POINTS = 60
POLICY_DIFF_MAX = 5.0
PEAK_LAG_MAX = 14

UNKNOWN = ("Unknown", "")


def correlation_edges(
    df: DataFrame,
    threshold: float = CORRELATION_MIN,
    min_points: int = MIN_POINTS,
    signed: bool = False,
    key: str = "ISO_Code",
    date: str = "Date",
    value: str = "New_Cases_7d",
) -> DataFrame:
    """Entities whose smoothed curves correlate over shared days; strong negatives count unless ``signed``."""
    return _similar(correlated_pairs(df, key, date, value, threshold, min_points, signed))


def _similar(pairs: DataFrame, carry: Sequence[str] = (), named: bool = True) -> DataFrame:
    ends = [f"{end}_{c}" for c in carry for end in ("src", "dst")]
    return pairs.select(*(["src", "dst"] if named else []), F.lit(SIMILAR).alias("type"), round_half_up(F.col("correlation"), 4).alias("correlation"), *ends)


def policy_edges(
    metrics: DataFrame, threshold: float = POLICY_DIFF_MAX, value: str = "avg_containment_health_index"
) -> DataFrame:
    """Entities whose mean policy index is positive and differs by less than the threshold."""
    rated = metrics.filter(F.col(value) > 0)
    pairs = band_pairs(rated, "iso_code", value, threshold)
    return pairs.select(
        F.least("k_a", "k_b").alias("src"),
        F.greatest("k_a", "k_b").alias("dst"),
        F.lit(POLICY).alias("type"),
        round_half_up(F.abs(F.col("v_a") - F.col("v_b")), 2).alias("stringency_diff"),
    )


def dated(metrics: DataFrame) -> DataFrame:
    """The entities of known continents, with the number of the day of their peak."""
    known = metrics.filter(F.col("continent").isNotNull() & ~F.col("continent").isin(*UNKNOWN))
    return known.withColumn("_day", F.unix_date("peak_date"))


def spread_edges(metrics: DataFrame, max_lag: int = PEAK_LAG_MAX, carry: Sequence[str] = ()) -> DataFrame:
    """From the earlier to the later peak, within one known continent and 1 to ``max_lag`` days. Columns in ``carry`` come
    along as ``src_`` and ``dst_`` of that name."""
    pairs = band_pairs(dated(metrics), "iso_code", "_day", max_lag, equi=["continent"], closed=True, carry=carry)
    forward = F.col("v_a") < F.col("v_b")
    sides = (("src", "a", "b"), ("dst", "b", "a"))
    told = [F.when(forward, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(f"{end}_{c}") for c in carry for end, x, y in sides]
    first, last = F.least("v_a", "v_b"), F.greatest("v_a", "v_b")
    return pairs.filter(F.col("v_a") != F.col("v_b")).select(
        F.when(forward, F.col("k_a")).otherwise(F.col("k_b")).alias("src"),
        F.when(forward, F.col("k_b")).otherwise(F.col("k_a")).alias("dst"),
        F.lit(SPREAD).alias("type"),
        (last - first).cast("int").alias("peak_lag_days"),
        F.date_from_unix_date(first.cast("int")).alias("peak_date_source"),
        F.date_from_unix_date(last.cast("int")).alias("peak_date_target"),
        *told,
    )


def belongs_edges(metrics: DataFrame) -> DataFrame:
    known = metrics.filter(F.col("continent").isNotNull() & ~F.col("continent").isin(*UNKNOWN))
    return known.select(
        F.col("iso_code").alias("src"), F.col("continent").alias("dst"), F.lit(BELONGS).alias("type")
    ).distinct()


def vertices_of(metrics: DataFrame) -> DataFrame:
    """Entity nodes with their attributes and one node per known continent."""
    attributes = [c for c in metrics.columns if c != "iso_code"]
    nodes = metrics.select(F.col("iso_code").alias("id"), F.lit("Country").alias("label"), *attributes)
    continents = (
        metrics.filter(F.col("continent").isNotNull() & ~F.col("continent").isin(*UNKNOWN))
        .select(F.col("continent").alias("id"))
        .distinct()
        .withColumn("label", F.lit("Continent"))
    )
    return nodes.unionByName(continents, allowMissingColumns=True)


def build_graph(vertices: DataFrame, *edges: DataFrame, unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """Unique nodes and edges with a common schema; an edge exists once per ends and type. ``unique`` says that the
    edges do so already, and spares their exchange."""
    from paneloom.operators.aggregates import dedupe_first

    nodes = dedupe_first(vertices, ["label", "id"])
    links = union_all(edges) if unique else dedupe_first(union_all(edges), ["src", "dst", "type"])
    directed = F.col("type").isin(SPREAD, BELONGS)
    return nodes, links.withColumn("directed", directed)


#: The column that names the entity in the rows of a folded type.
FOLD_KEYS = {SIMILAR: "key", POLICY: "iso_code", SPREAD: "iso_code"}


def band_rows(metrics: DataFrame, type_: str) -> DataFrame:
    """What the links of a band rest on, one row for each entity: from these columns its function builds them all."""
    columns = {POLICY: ["iso_code", "avg_containment_health_index"], SPREAD: ["iso_code", "continent", "peak_date"]}
    return metrics.select(*columns[type_])


def unfold(rows: DataFrame, type_: str, width: float, carry: Sequence[str] = (), named: bool = True) -> DataFrame:
    """The links of a type from its rows, as ``panel_graph`` gives them. For similar patterns the rows are curves, the
    width is the least correlation, and text columns in ``carry`` come along as ``src_`` and ``dst_`` of that name.
    Without ``named`` links have no ``src`` and ``dst``: a row for each all the same."""
    if type_ == SIMILAR:
        links = _similar(curve_pairs(rows, width, carry=carry, named=named), carry, named)
    else:
        links = policy_edges(rows, width) if type_ == POLICY else spread_edges(rows, int(width))
        links = links if named else links.drop("src", "dst")
    return links.withColumn("directed", F.lit(type_ == SPREAD))


def panel_graph(
    panel: DataFrame, metrics: DataFrame, threshold: float = CORRELATION_MIN, min_points: int = MIN_POINTS,
    policy: float = POLICY_DIFF_MAX, max_lag: int = PEAK_LAG_MAX, types: Sequence[str] = (SIMILAR, POLICY, SPREAD, BELONGS),
    folded: bool = False,
) -> tuple:
    """The graph of a prepared panel and its entity metrics, with the edges of the ``types`` asked for; the
    metrics, one row per entity, feed four of the five parts and are written out first.

    ``folded`` gives nodes, edges and bands, ``{type: (rows, width)}``: similar patterns, policy links and spread arcs,
    whose number grows with the square of the entities, stay folded into the rows that ``unfold`` builds them from, one
    for each entity, and the edges are the others, or None. Where entities repeat, so that links would have to be made
    unique, nothing is folded.
    """
    stored = cut_lineage(metrics, "metrics")
    widths = {SIMILAR: threshold, POLICY: policy, SPREAD: max_lag}
    bands = {}
    # Each part has an edge once where each entity has one row: correlations have one series for each key.
    unique = stored.groupBy("iso_code").count().filter("count > 1").isEmpty()
    if folded and unique:
        curves = series_curves(panel, "ISO_Code", "Date", "New_Cases_7d", min_points)
        bands = {t: (curves if t == SIMILAR else band_rows(stored, t), widths[t]) for t in types if t in widths}
    parts = {
        SIMILAR: lambda: correlation_edges(panel, threshold, min_points),
        POLICY: lambda: policy_edges(stored, policy),
        SPREAD: lambda: spread_edges(stored, max_lag),
        BELONGS: lambda: belongs_edges(stored),
    }
    listed = [parts[t]() for t in types if t not in bands]
    nodes, links = build_graph(vertices_of(stored), *(listed or [belongs_edges(stored.limit(0))]), unique=unique)
    return (nodes, links if listed else None, bands) if folded else (nodes, links)


def undirected(edges: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Each edge seen from both of its ends: ``(id, other, type)``, one pass over the edges."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("other")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("other")),
    )
    return edges.select(F.explode(ends).alias("e"), "type", *columns).select("e.id", "e.other", "type", *columns)
