"""Threshold classes (SC12, SC13) and the sign classes of the KPI row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quality_class(pct: Column) -> Column:
    """Share of missing values in percent: below 5 OK, below 30 WARN, else HIGH."""
    return F.when(pct < 5, "OK").when(pct < 30, "WARN").otherwise("HIGH")


def corr_strength(r: Column) -> Column:
    size = F.abs(r)
    return F.when(r.isNull(), None).when(size > 0.7, "strong").when(size > 0.4, "moderate").otherwise("weak")


def corr_direction(r: Column) -> Column:
    return F.when(r.isNull(), None).when(r > 0, "positive").otherwise("negative")


def corr_class(r: Column) -> Column:
    return F.concat_ws(" ", corr_strength(r), corr_direction(r))


def above_one(col: Column) -> Column:
    return F.when(col.isNotNull(), col > 1)
