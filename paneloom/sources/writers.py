"""Batch writers (SNK1-SNK4, SNK6, SNK7). Every writer targets a new path, never its own input."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from paneloom.functions.records import to_json_row
from paneloom.operators.schema import clean_nonfinite, to_double
from paneloom.sources.versions import BANDS, WIDTH, replace

TEXT_COLUMNS = ("ISO_Code", "Country", "Continent")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_gold(
    df: DataFrame,
    path: str,
    keep: Sequence[str] = TEXT_COLUMNS,
    sort_by: Sequence[str] = ("ISO_Code", "Date"),
) -> None:
    """Snappy Parquet; text columns outside ``keep`` become double first.

    Rows are range-partitioned and sorted by key and day, so that row-group statistics prune key
    and date filters and one hot key spreads over as many files as it needs.
    """
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    others = [c for c in df.columns if c not in text or c in keep]
    typed = to_double(df, except_=others)
    order = [c for c in sort_by if c in typed.columns]
    if order:
        typed = typed.repartitionByRange(*order).sortWithinPartitions(*order)
    typed.write.mode("overwrite").option("compression", "snappy").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the target as a whole and in one step, with NaN and infinities folded to null.

    ``read_table`` reads the version in force.
    """
    replace(df.sparkSession, path, clean_nonfinite(df).write.parquet)


def to_messages(df: DataFrame, day: str = "Date") -> DataFrame:
    """One JSON message per row, next to the day it belongs to."""
    message = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(day).alias("day"), message)


def keyed_messages(df: DataFrame, key: str = "ISO_Code") -> DataFrame:
    """``(key, value)``: messages of one entity share a key, so a topic keeps their order."""
    message = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), message) if key in df.columns else to_json_row(df)


def publish(
    df: DataFrame, options: dict[str, str] | None = None, path: str | None = None, day: str = "Date", key: str = "ISO_Code"
) -> None:
    """Send rows to a topic (``options``), keyed by entity, or lay them down as text files, one folder per
    day (``path``).

    Files follow the days; a day with many rows is cut into several files by the second range key.
    """
    if path is not None:
        (
            to_messages(df, day)
            .repartitionByRange(F.col("day"), F.xxhash64("value"))
            .write.mode("overwrite")
            .partitionBy("day")
            .text(path)
        )
    else:
        keyed_messages(df, key).write.format("kafka").options(**(options or {})).save()


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count; empty when the key holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def write_graph(
    vertices: DataFrame, edges: DataFrame | None, path: str, bands: Mapping[str, tuple[DataFrame, float]] | None = None
) -> None:
    """Replace the stored graph, all tables in one step; edges are laid out by type because queries filter on it.

    The links of a band (``panel_graph``) are stored as the rows that ``read_graph`` unfolds them from: a row for each
    entity, where the links themselves would be the square of that.
    """

    def write(folder: str) -> None:
        vertices.write.parquet(os.path.join(folder, "vertices"))
        if edges is not None:
            edges.write.partitionBy("type").parquet(os.path.join(folder, "edges"))
        for name, (rows, width) in (bands or {}).items():
            rows.withColumn(WIDTH, F.lit(float(width))).write.parquet(os.path.join(folder, BANDS, name))

    replace(vertices.sparkSession, path, write)
