"""Registry of queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its oracle over the same tables."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a fixed number of digits, by way of decimals: the noise of summation order goes
    first, so that ties come out alike in both engines. Adding zero turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(F.col(f.name).try_cast("decimal(28,9)"), digits).cast("double") + F.lit(0.0)).alias(f.name)
            if f.dataType.simpleString() == "double"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def round_sql(sql: str, cols: Sequence[str], digits: int = DIGITS) -> str:
    """The same rounding around an oracle."""
    replaced = ", ".join(f"(round(TRY_CAST({c} AS DECIMAL(28, 9)), {digits})::DOUBLE + 0.0)::DOUBLE AS {c}" for c in cols)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
