"""Batch readers (SRC1-SRC7)."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paneloom.functions.dates import parse_day
from paneloom.sources.versions import BANDS, WIDTH, current_path, listed


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """Header CSV. Without a schema every column stays text and is typed later, in one pass;
    ``infer=True`` pays an extra scan and accepts quoted fields that span lines."""
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).option("multiLine", True).option("escape", '"').csv(path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_landing(spark: SparkSession, directory: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """``{name}.csv`` of a landing folder as named tables, in the given order of precedence.

    Absent and unreadable tables are left out.
    """
    tables = {}
    for name in names:
        try:
            table = read_csv_table(spark, os.path.join(directory, f"{name}.csv"))
        except AnalysisException:
            continue
        if table.columns:
            tables[name] = table
    return tables


def tag(df: DataFrame, **constants: object) -> DataFrame:
    """Constant columns, in one projection."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    """Long search-interest table with a real day and a numeric interest."""
    df = read_csv_table(spark, path).drop("isPartial")
    return df.withColumns(
        {"date": parse_day("date"), "search_interest": F.col("search_interest").try_cast("double")}
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Stored table, in the version in force, without the store's own row id."""
    return spark.read.parquet(current_path(spark, path)).drop("_id")


def read_bands(spark: SparkSession, path: str) -> dict[str, tuple[DataFrame, float]]:
    """The folded links of a stored graph by type: a row for each entity, and the width of the band."""
    place = os.path.join(current_path(spark, path), BANDS)
    bands = {}
    for name in listed(spark, place):
        rows = read_table(spark, os.path.join(place, name))
        width = rows.select(WIDTH).first()
        bands[name] = (rows.drop(WIDTH), width[0] if width else 1.0)
    return bands


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, os.path.join(current_path(spark, path), "vertices"))


def read_graph(
    spark: SparkSession, path: str, among: Callable[[DataFrame], DataFrame] | None = None, ends: Sequence[str] = (), named: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Stored vertices and edges of one version; a filter on the edge type reads only its folder.

    Links that are stored folded are unfolded as the edges are read, inside the tasks that read on: all of them, with
    their attributes, but none is written again. ``among`` gives, from the vertices, those (``id``) that both ends of an
    edge must be among: the others go before links are unfolded. Text attributes of the vertices in ``ends`` go to both ends of
    similar-pattern links, as ``src_`` and ``dst_`` of that name, by way of the folded rows, so that links need no join.
    Without ``named`` edges come without ``src`` and ``dst``, a row for each all the same, for those who count them.
    """
    from paneloom.operators.joins import in_both
    from paneloom.operators.ordering import union_all
    from paneloom.plans.edges import FOLD_KEYS, SIMILAR, unfold
    from paneloom.session import cut_lineage

    place = current_path(spark, path)
    vertices = read_vertices(spark, path)
    chosen = cut_lineage(among(vertices).select("id"), "among") if among else None
    parts = [read_table(spark, os.path.join(place, "edges"))] if "edges" in listed(spark, place) else []
    parts = [in_both(part, chosen) for part in parts] if among else parts
    parts = parts if named else [part.drop("src", "dst") for part in parts]
    for name, (rows, width) in read_bands(spark, path).items():
        if among:
            rows = rows.join(chosen, F.col(FOLD_KEYS[name]) == F.col("id"), "left_semi")
        carry = ends if name == SIMILAR else ()
        if carry:
            told = vertices.filter(F.col("label") == "Country").select(F.col("id").alias("key"), *carry)
            rows = cut_lineage(rows.join(told, "key", "left"), "carried")
        parts.append(unfold(rows, name, width, carry, named))
    return vertices, union_all(parts)


def read_key(df: DataFrame, key_col: str, value: object, order_col: str | None = None) -> DataFrame:
    """Rows of one key, ordered; the equality reaches the Parquet scan."""
    rows = df.filter(F.col(key_col) == F.lit(value))
    return rows.orderBy(order_col) if order_col else rows


def detect_fields(df: DataFrame | None) -> dict[str, str]:
    """Which spelling of the key fields a table uses, and whether its date is text.

    Read off the schema; no row is touched.
    """
    names = df.columns if df is not None else []
    date = "date" if "date" in names else "Date"
    iso = "iso_code" if "iso_code" in names else "ISO_Code"
    kind = "string"
    if date in names:
        kind = df.schema[date].dataType.simpleString()
    return {"date": date, "iso": iso, "date_type": kind}


def day_bound(df: DataFrame, since: str) -> Column:
    """``since`` as a literal of the type of the table's date field, so that the filter pushes down."""
    return F.lit(since).cast("string" if detect_fields(df)["date_type"] == "string" else "date")
