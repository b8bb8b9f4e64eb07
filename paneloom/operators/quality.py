"""Data quality reports (Q1-Q3). Each report is one aggregate, however many columns it covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paneloom.functions.classes import quality_class


def _long(one_row: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The single row ``c0..cn, total`` as one row per column."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n")) for i, c in enumerate(cols)]
    return one_row.select(F.explode(F.array(*cells)).alias("x"), "total").select("x.column", "x.n", "total")


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-null count and fill share of each column."""
    names = list(cols or df.columns)
    counted = df.agg(*[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(names)], F.count(F.lit(1)).alias("total"))
    return _long(counted, names).select(
        "column", F.col("n").alias("n_present"), _pct(F.col("n"), F.col("total")).alias("fill_pct")
    )


def null_report(df: DataFrame, cols: Sequence[str], total: int | Column | None = None) -> DataFrame:
    """Missing values of the key columns with their class; the base defaults to the rows of ``df``."""
    names = [c for c in cols if c in df.columns]
    base = F.count(F.lit(1)) if total is None else F.lit(total) if isinstance(total, int) else total
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(names)], base.alias("total"))
    pct = _pct(F.col("n"), F.col("total"))
    return _long(counted, names).select(
        "column", F.col("n").alias("n_null"), pct.alias("null_pct"), quality_class(pct).alias("status")
    )


def verify_load(df: DataFrame, present: Sequence[str] = ("disinfo_index", "factcheck_count")) -> DataFrame:
    """Rows, columns and how many rows carry the derived columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        *[F.count(F.col(c)).alias(f"n_{c}") for c in present if c in df.columns],
    )


def _pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100, whole)
