"""Enriched gold table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from paneloom.operators.filters import valid_iso
from paneloom.operators.joins import EnrichmentReport, enrich
from paneloom.operators.schema import drop_columns, drop_empty_columns, rename_if_free
from paneloom.plans.panel import parse_dates
from paneloom.session import cut_lineage

# Columns that a source table carries under another name.
DUPLICATE_COLUMNS = (
    "income_support", "restriction_gatherings", "contact_tracing", "facial_coverings", "school_closures",
    "workplace_closures", "stay_home_requirements", "international_travel_controls",
    "restrictions_internal_movements", "stringency_index", "Daily hospital occupancy",
    "short_term_positivity_rate", "new_tests_per_thousand_7day_smoothed", "total_tests_per_thousand",
)

# Columns without use for the analyses.
USELESS_COLUMNS = (
    "145610-annotations", "142605-annotations", "142753-annotations", "Total confirmed cases of COVID-19",
    "Total confirmed deaths due to COVID-19",
    "Daily new confirmed cases of COVID-19 per million people (rolling 7-day average, right-aligned)",
    "Year", "Recovered",
)

RENAMES = {"stringency_index_weighted_average": "stringency_index"}


def prune(
    df: DataFrame,
    drop: Sequence[str] = DUPLICATE_COLUMNS + USELESS_COLUMNS,
    renames: Mapping[str, str] = RENAMES,
) -> tuple[DataFrame, list[str]]:
    """Drop duplicated and useless columns, rename what became free; also name the absent ones."""
    kept, missing = drop_columns(df, drop)
    return rename_if_free(kept, renames), missing


def build_gold(
    master: DataFrame,
    tables: Mapping[str, DataFrame],
    dim: DataFrame | None = None,
    order: Sequence[str] = (),
    drop_empty: bool = True,
) -> tuple[DataFrame, EnrichmentReport]:
    """Master panel enriched by the source tables, without empty, duplicated and useless columns.

    The joins are written out before the columns are counted, so they run once. Sorting is left to
    ``write_gold``, which range-partitions while it writes.
    """
    merged, report = enrich(valid_iso(parse_dates(master)), tables, dim, order)
    if drop_empty:
        merged = drop_empty_columns(cut_lineage(merged, "enriched"))
    gold, _ = prune(merged)
    return gold, report
