"""Row filters and membership rewrites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paneloom.functions.dates import iso_day


def valid_iso(df: DataFrame, col: str = "ISO_Code", length: int = 3) -> DataFrame:
    """Codes of exactly ``length`` characters; null codes go too."""
    return df.filter(F.length(F.col(col)) == length)


def exclude_prefix(df: DataFrame, col: str = "ISO_Code", prefix: str = "OWI") -> DataFrame:
    """Drop aggregate pseudo-entities."""
    return df.filter(~F.col(col).startswith(prefix))


def valid_day(df: DataFrame, col: str = "Date") -> DataFrame:
    """Keep the ISO day found in the text; rows without one go."""
    return df.withColumn(col, iso_day(col)).filter(F.col(col) != "")


def drop_null(df: DataFrame, cols: Sequence[str], how: str = "any") -> DataFrame:
    return df.dropna(how=how, subset=list(cols))


def between_dates(df: DataFrame, low: object, high: object, col: str = "Date") -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(col).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def since(df: DataFrame, day: object, col: str = "Date") -> DataFrame:
    return df.filter(F.col(col) >= F.lit(day).cast("date"))


def before(df: DataFrame, day: object, col: str = "Date") -> DataFrame:
    return df.filter(F.col(col) < F.lit(day).cast("date"))


def split_at(df: DataFrame, day: object, col: str = "Date") -> tuple[DataFrame, DataFrame]:
    """Rows before the cut, rows on or after it."""
    return before(df, day, col), since(df, day, col)


def for_key(df: DataFrame, value: object, col: str = "ISO_Code") -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def keep_in(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def else_other(col: Column, values: Sequence[object], other: str = "other") -> Column:
    return F.when(col.isin(list(values)), col).otherwise(F.lit(other))


def else_other_by(df: DataFrame, col: str, top: DataFrame, other: str = "other") -> DataFrame:
    """Values outside ``top`` become ``other``. Spark sees how large ``top`` is and sends it to the rows or not."""
    known = top.select(F.col(col).alias("_known"))
    hit = df.join(known, F.col(col) == F.col("_known"), "left")
    return hit.withColumn(col, F.when(F.col("_known").isNotNull(), F.col(col)).otherwise(F.lit(other))).drop("_known")


def count_present(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(F.col(col)).alias("n_present"))


def not_blank(col: Column) -> Column:
    return col.isNotNull() & (F.trim(col) != "")
