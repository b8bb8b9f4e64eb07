"""Prepared panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paneloom.functions.dates import parse_day
from paneloom.functions.numeric import row_mean
from paneloom.operators.filters import valid_iso
from paneloom.operators.schema import normalize_columns
from paneloom.operators.windows import increment_col, rolling_mean_col, series


def parse_dates(df: DataFrame, col: str = "Date") -> DataFrame:
    """The day column as DATE, whatever it was stored as."""
    kind = df.schema[col].dataType.simpleString()
    if kind == "date":
        return df
    if kind.startswith("timestamp"):
        return df.withColumn(col, F.col(col).cast("date"))
    return df.withColumn(col, parse_day(col))


def with_increments(df: DataFrame, key: str = "ISO_Code", date: str = "Date") -> DataFrame:
    """Daily increments of the cumulative columns and their trailing means; one exchange and sort."""
    w = series(key, date)
    daily = {
        new: increment_col(F.col(old).cast("double"), w)
        for old, new in (("Confirmed", "New_Cases"), ("Deaths", "New_Deaths"))
        if old in df.columns
    }
    return df.withColumns(daily).withColumns({f"{c}_7d": rolling_mean_col(c, w, 7) for c in daily})


def prepare_panel(df: DataFrame, code_length: int | None = 3) -> DataFrame:
    """Canonical names, real days, valid codes, increments and the defaults of derived columns.

    Entities other than countries may have codes of any length: pass ``code_length=None``.
    """
    rows = parse_dates(normalize_columns(df))
    coded = rows.filter(F.col("ISO_Code").isNotNull()) if code_length is None else valid_iso(rows, length=code_length)
    panel = with_increments(coded)
    extra = {}
    parts = ["stringency_index_vax", "stringency_index_nonvax"]
    if "stringency_index" not in panel.columns and set(parts) <= set(panel.columns):
        extra["stringency_index"] = row_mean(parts)
    if "Country" not in panel.columns:
        extra["Country"] = F.col("ISO_Code")
    return panel.withColumns(extra) if extra else panel
