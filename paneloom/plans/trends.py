"""Search-interest indices (TR1-TR3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from paneloom.dims import DISINFO_GROUPS, PROSCIENCE_GROUPS
from paneloom.functions.numeric import balance, trust_ratio
from paneloom.operators.aggregates import index_columns
from paneloom.operators.joins import join_weekly
from paneloom.operators.schema import drop_derived
from paneloom.operators.windows import rolling_mean_col, series

TREND_COLUMNS = (
    "disinfo_index", "disinfo_max", "disinfo_terms_active", *DISINFO_GROUPS,
    "proscience_index", "proscience_max", *PROSCIENCE_GROUPS,
    "trust_ratio", "trust_ratio_smooth", "sentiment_balance",
)


def trends_index(
    long: DataFrame,
    groups: Mapping[str, Sequence[str]] = DISINFO_GROUPS,
    prefix: str = "disinfo",
    active: bool = True,
    threshold: float = 0.0,
    keys: Sequence[str] = ("ISO_Code", "country", "date"),
    term: str = "term_category",
    value: str = "search_interest",
) -> DataFrame:
    """Weekly index with its sub-indices as conditional means of the same aggregate; a sub-index
    without any of its terms is null."""
    subs = [F.avg(F.when(F.col(term).isin(list(terms)), F.col(value))).alias(name) for name, terms in groups.items()]
    weekly = long.groupBy(*keys).agg(*index_columns(value, prefix, threshold, active), *subs)
    return weekly.withColumnRenamed("date", "Date")


def disinfo_index(long: DataFrame) -> DataFrame:
    return trends_index(long)


def proscience_index(long: DataFrame) -> DataFrame:
    return trends_index(long, PROSCIENCE_GROUPS, "proscience", active=False)


def merge_trends(
    panel: DataFrame,
    disinfo: DataFrame | None,
    proscience: DataFrame | None,
    smooth: int = 4,
    key: str = "ISO_Code",
    date: str = "Date",
) -> DataFrame:
    """Both weekly tables on the daily panel, with ratio, smoothed ratio and balance.

    The smoothing frame counts panel rows. Columns of an earlier run are replaced.
    """
    merged = drop_derived(panel, TREND_COLUMNS)
    merged = join_weekly(merged, disinfo, [key], date)
    merged = join_weekly(merged, proscience, [key], date)
    if not {"disinfo_index", "proscience_index"} <= set(merged.columns):
        return merged
    merged = merged.withColumns(
        {
            "trust_ratio": trust_ratio("proscience_index", "disinfo_index"),
            "sentiment_balance": balance("proscience_index", "disinfo_index"),
        }
    )
    return merged.withColumn("trust_ratio_smooth", rolling_mean_col("trust_ratio", series(key, date), smooth))


def trend_means(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("trust_ratio").alias("trust_ratio_mean"), F.avg("sentiment_balance").alias("balance_mean"))
