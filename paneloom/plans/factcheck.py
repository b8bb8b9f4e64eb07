"""Fact-check tables (FC1-FC3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paneloom.functions.dates import parse_day, week_start
from paneloom.functions.text import clean_text, unique_names
from paneloom.operators.filters import else_other
from paneloom.operators.joins import join_weekly
from paneloom.operators.schema import (
    columns_like,
    drop_derived,
    explode_columns,
    pick_low_cardinality,
    sniff_column,
)
from paneloom.operators.windows import running_total_col, series
from paneloom.session import cut_lineage

TOP_CATEGORIES = 15


def expand_factchecks(
    raw: DataFrame,
    dim: DataFrame,
    date: str | None = None,
    countries: Sequence[str] | None = None,
    category: str | None = None,
) -> DataFrame:
    """One record per check and mapped country: ``(ISO_Code, date, category, rating)``.

    Columns are found by name when not given. The country columns are stacked first and mapped by a
    single lookup join.
    """
    date = date or sniff_column(raw, "date", parse_day)
    countries = list(countries or [c for c in raw.columns if "country" in c.lower()])
    category = category or pick_low_cardinality(raw)
    if date is None or not countries:
        raise ValueError("a fact-check table needs a date column and a country column")
    day = F.col(date) if raw.schema[date].dataType.simpleString() == "date" else parse_day(date)
    unknown = F.lit("unknown")
    slim = raw.select(
        day.alias("date"),
        (F.col(category) if category else unknown).cast("string").alias("category"),
        (F.col("category") if "category" in raw.columns else unknown).cast("string").alias("rating"),
        *countries,
    ).filter(F.col("date").isNotNull())
    stacked = explode_columns(slim, countries, "_column", "_name")
    lookup = dim.filter(F.col("iso3").isNotNull()).select(F.col("name").alias("_name"), F.col("iso3").alias("ISO_Code"))
    return stacked.join(lookup, "_name").select("ISO_Code", "date", "category", "rating")


def weekly_factchecks(expanded: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """Checks per entity and week: total, one column per leading category, and the running total.

    Category columns are the ``top`` most frequent values, plus ``other`` when there are more. That short list shapes the
    schema and is read by the driver. The expanded checks are counted once, by entity, week and category; names, totals
    and columns come from that table of counts.
    """
    clean = expanded.select("ISO_Code", week_start("date").alias("_week"), clean_text("category").alias("category"))
    counts = cut_lineage(clean.groupBy("ISO_Code", "_week", "category").agg(F.count(F.lit(1)).alias("_n")), "checks")
    sizes = counts.groupBy("category").agg(F.sum("_n").alias("n")).orderBy(F.desc("n"), F.asc("category")).limit(top + 1)
    ranked = [r["category"] for r in sizes.collect()]
    leading, more = ranked[:top], ranked[top:]
    labelled = counts.withColumn("category", else_other(F.col("category"), leading))
    values = sorted({*leading, "other"} if more else leading)
    cells = [
        F.coalesce(F.sum(F.when(F.col("category") == F.lit(v), F.col("_n"))), F.lit(0)).alias(name)
        for v, name in zip(values, unique_names(values, taken=("ISO_Code", "_week")))
    ]
    weekly = labelled.groupBy("ISO_Code", "_week").agg(F.sum("_n").alias("factcheck_count"), *cells)
    total = running_total_col("factcheck_count", series("ISO_Code", "_week"))
    return weekly.withColumn("factcheck_cumulative", total)


def merge_factchecks(panel: DataFrame, weekly: DataFrame, date: str = "Date") -> DataFrame:
    """Weekly checks on every day of their week; columns of an earlier run are replaced."""
    clean = drop_derived(panel, prefixes=("factcheck_", "fc_"))
    return join_weekly(clean, weekly, ["ISO_Code"], date, weekly_date="_week", unique=True)


def coverage(df: DataFrame, col: str = "factcheck_count") -> DataFrame:
    """Rows that carry fact-check data, and their share in percent."""
    return df.agg(
        F.count(col).alias("matched"),
        F.try_divide(F.count(col).cast("double") * 100, F.count(F.lit(1))).alias("coverage_pct"),
    )


def category_columns(df: DataFrame) -> list[str]:
    return columns_like(df, prefixes=("fc_",))
