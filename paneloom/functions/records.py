"""JSON records (SC11) and path arrays (SC14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def parse_json(col: Column | str) -> Column:
    """JSON object as ``map<string,string>``: a missing field stays apart from an explicit null.

    Text that is not a JSON object gives null.
    """
    return F.from_json(col, "map<string,string>")


def to_json_row(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text; nulls are kept as explicit nulls."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def path_edges(col: Column | str) -> Column:
    """Node array to its consecutive ``(src, dst)`` pairs, in path order."""
    path = F.col(col) if isinstance(col, str) else col
    return F.when(
        F.size(path) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(path) - 1),
            lambda i: F.struct(F.element_at(path, i).alias("src"), F.element_at(path, i + 1).alias("dst")),
        ),
    )
