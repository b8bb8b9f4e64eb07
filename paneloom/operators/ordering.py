"""Sorts, top-k and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from paneloom.operators.aggregates import dedupe_first


def sort_panel(df: DataFrame, key: str = "ISO_Code", date: str = "Date") -> DataFrame:
    """Total order by a sampled range exchange on both columns, so a hot key is split by day."""
    return df.orderBy(key, date)


def top_n(df: DataFrame, metric: str, n: int, tie: str) -> DataFrame:
    """Largest ``n`` by ``metric``, nulls last, ties by name; each task keeps only ``n`` rows."""
    return df.orderBy(F.desc_nulls_last(metric), F.asc(tie)).limit(n)


def entities(df: DataFrame, key: str = "ISO_Code") -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_prefer(
    hist: DataFrame, live: DataFrame, key: str | Sequence[str], order: str = "Date", prefer: str = "hist"
) -> DataFrame:
    """Union with one row per key and day; the preferred side wins where both have the day."""
    keys = [key] if isinstance(key, str) else list(key)
    first, second = (hist, live) if prefer == "hist" else (live, hist)
    both = first.withColumn("_prio", F.lit(0)).unionByName(
        second.withColumn("_prio", F.lit(1)), allowMissingColumns=True
    )
    return dedupe_first(both, [*keys, order], ["_prio"]).drop("_prio")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNotNull()).distinct()
