"""Aggregations (A1-A19). All of them combine partially before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from paneloom.functions.dates import week_start, year_month
from paneloom.functions.numeric import log10_floor1


#: Types that a hash aggregate can update in place.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def last_present(value: str, order: str) -> Column:
    """Last non-null value by ``order``."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def peak_struct(value: str, date: str) -> Column:
    """Largest value with the earliest day it was reached on."""
    return F.max(
        F.when(
            F.col(value).isNotNull(),
            F.struct(F.col(value).alias("v"), (-F.unix_date(F.col(date))).alias("d")),
        )
    )


def latest_non_null(df: DataFrame, key: Sequence[str], order: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Per key and column, the last non-null value by ``order``; the last ``order`` itself is kept."""
    names = list(cols) if cols is not None else [c for c in df.columns if c not in (*key, order)]
    return df.groupBy(*key).agg(F.max(order).alias(order), *[last_present(c, order).alias(c) for c in names])


def latest_row(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Last whole row per key, nulls included.

    Where every column has a fixed width each one gets a buffer of its own, all of them moved by the same
    comparisons, so the values are of one row and Spark aggregates by hash. Texts and nested columns travel
    in one struct, which Spark sorts for.
    """
    rest = [c for c in df.columns if c not in key]
    if all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in rest):
        return df.groupBy(*key).agg(*[F.max_by(c, order).alias(c) for c in rest])
    packed = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return packed.select(*key, *[F.col("_row")[c].alias(c) for c in rest])


def global_kpis(
    df: DataFrame, key: str = "ISO_Code", date: str = "Date", cases: str = "Confirmed", deaths: str = "Deaths"
) -> DataFrame:
    """Entities, last day, rows, and the sums of the last known cumulative values."""
    per_key = df.groupBy(key).agg(
        F.max(date).alias("d"),
        F.count(F.lit(1)).alias("n"),
        last_present(cases, date).alias("c"),
        last_present(deaths, date).alias("x"),
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("entities"),
        F.max("d").alias("last_date"),
        F.sum("n").alias("rows"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("total_cases"),
        F.coalesce(F.sum("x"), F.lit(0)).cast("long").alias("total_deaths"),
    )


def panel_extent(df: DataFrame, key: str = "ISO_Code", date: str = "Date", value: object = None) -> DataFrame:
    """Distinct entities, first and last day, rows; for the whole panel or one entity.

    Counted over one row per entity, so the distinct count needs no set of its own.
    """
    rows = df if value is None else df.filter(F.col(key) == F.lit(value))
    per_key = rows.groupBy(key).agg(
        F.min(date).alias("a"), F.max(date).alias("z"), F.count(F.lit(1)).alias("n")
    )
    return per_key.agg(
        F.count(key).alias("entities"),
        F.min("a").alias("first_date"),
        F.max("z").alias("last_date"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def monthly_max(df: DataFrame, key: str, date: str, cols: Sequence[str], log_of: str | None = None) -> DataFrame:
    """Largest value per entity and month, and the log10 of one of them, floored at 1."""
    grouped = df.groupBy(key, year_month(date).alias("year_month")).agg(*[F.max(c).alias(c) for c in cols])
    if log_of is None:
        return grouped
    return grouped.withColumn("cases_log", log10_floor1(F.col(log_of).cast("double")))


def daily_totals(df: DataFrame, cols: Sequence[str], date: str = "Date") -> DataFrame:
    return df.groupBy(date).agg(*[F.sum(c).alias(c) for c in cols])


def weekly_mean(df: DataFrame, cols: Sequence[str], key: str = "ISO_Code", date: str = "Date") -> DataFrame:
    """Mean per entity and week on a gapless calendar, labelled with the Sunday that ends the week.

    Missing weeks are generated between a week and its successor, so no calendar is joined and no
    other entity's range matters.
    """
    weekly = df.filter(F.col(date).isNotNull()).groupBy(key, week_start(date).alias("_week")).agg(
        *[F.avg(c).alias(c) for c in cols]
    )
    following = F.lead("_week").over(Window.partitionBy(key).orderBy("_week"))
    until = F.coalesce(F.date_sub(following, 7), F.col("_week"))
    filled = weekly.withColumn("_until", until).withColumn(
        "_at", F.explode(F.sequence(F.col("_week"), F.col("_until"), F.expr("interval 7 days")))
    )
    real = F.col("_at") == F.col("_week")
    return filled.select(
        key, F.date_add("_at", 6).alias("week_end"), *[F.when(real, F.col(c)).alias(c) for c in cols]
    )


def peak(df: DataFrame, key: str, value: str, date: str = "Date") -> DataFrame:
    """Peak value and the first day it was reached."""
    packed = df.groupBy(key).agg(peak_struct(value, date).alias("_p"))
    return packed.select(
        key,
        F.date_from_unix_date(-F.col("_p.d")).alias("peak_date"),
        F.col("_p.v").alias("peak_value"),
    )


def weekly_index(
    df: DataFrame,
    keys: Sequence[str],
    value: str = "search_interest",
    prefix: str = "disinfo",
    threshold: float = 0.0,
    active: bool = True,
) -> DataFrame:
    """Mean and maximum over the terms of a week, and how many terms exceed ``threshold``."""
    return df.groupBy(*keys).agg(*index_columns(value, prefix, threshold, active))


def index_columns(value: str, prefix: str, threshold: float, active: bool) -> list[Column]:
    cols = [F.avg(value).alias(f"{prefix}_index"), F.max(value).alias(f"{prefix}_max")]
    if active:
        cols.append(F.count_if(F.col(value) > threshold).alias(f"{prefix}_terms_active"))
    return cols


def weekly_count(df: DataFrame, keys: Sequence[str], name: str = "factcheck_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, col: str, n: int = 15) -> DataFrame:
    """Most frequent values, ties by name."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col)).limit(n)


def top_totals(df: DataFrame, n: int = 10, key: str = "ISO_Code", value: str = "factcheck_count") -> DataFrame:
    total = df.groupBy(key).agg(F.sum(value).alias("total"))
    return total.orderBy(F.desc("total"), F.asc(key)).limit(n)


def infodemic_kpis(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means of the search indices with the class each one falls in."""
    names = {
        "disinfo_index": "disinfo_mean",
        "proscience_index": "proscience_mean",
        "trust_ratio": "trust_ratio_mean",
        "sentiment_balance": "balance_mean",
        "disinfo_terms_active": "terms_active_mean",
    }
    means = df.groupBy(*by).agg(*[F.avg(c).alias(a) for c, a in names.items() if c in df.columns])
    classes = {}
    if "trust_ratio_mean" in means.columns:
        classes["trust_class"] = F.when(F.col("trust_ratio_mean") > 1, "science").when(
            F.col("trust_ratio_mean").isNotNull(), "disinformation"
        )
    if "balance_mean" in means.columns:
        classes["balance_class"] = F.when(F.col("balance_mean") > 0, "science").when(
            F.col("balance_mean").isNotNull(), "disinformation"
        )
    return means.withColumns(classes) if classes else means


def factcheck_kpis(
    df: DataFrame,
    count: str = "factcheck_count",
    cumulative: str = "factcheck_cumulative",
    date: str = "Date",
    categories: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Totals, active period and the leading category.

    The weekly count is repeated on every day of its week, so the sum over days and the maximum of
    the running total are both returned.
    """
    shown = [c for c in categories if c.removeprefix("fc_").lower() not in ("nan", "none", "")]
    active = F.col(count) > 0
    sums = [F.sum(c).alias(f"_s_{i}") for i, c in enumerate(shown)]
    base = df.groupBy(*by).agg(
        F.sum(count).alias("sum_over_days"),
        F.max(cumulative).alias("cumulative_max"),
        F.min(F.when(active, F.col(date))).alias("first_date"),
        F.max(F.when(active, F.col(date))).alias("last_date"),
        *sums,
    )
    best = F.lit(None).cast("string")
    if shown:
        ranked = [
            F.when(F.col(f"_s_{i}") > 0, F.struct(F.col(f"_s_{i}").alias("s"), F.lit(-i).alias("r"), F.lit(c).alias("c")))
            for i, c in enumerate(shown)
        ]
        best = F.array_max(F.array(*ranked))["c"]
    return base.select(
        *by, "sum_over_days", "cumulative_max", "first_date", "last_date", best.alias("top_category")
    )


def replay_days(df: DataFrame, start: object, date: str = "Date") -> DataFrame:
    """Distinct days from ``start`` on, ascending; the filter runs below the aggregate."""
    return df.filter(F.col(date) >= F.lit(start).cast("date")).select(date).distinct().orderBy(date)


def positive_share(diff: Column) -> Column:
    """Share of positive day-over-day differences; the first row has none."""
    return F.count_if(diff > 0) / F.greatest(F.count(F.lit(1)) - 1, F.lit(1))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """First row per key by ``order``, ties by the remaining columns.

    A ``min`` over structs combines on the map side: any number of copies of one key shrinks to one
    row per task before the shuffle, where a ranking window would gather them all in one place.
    """
    rest = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.distinct()
    packed = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return packed.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def weeks_per_entity(df: DataFrame, entities: DataFrame, key: str = "ISO_Code") -> DataFrame:
    """Rows per listed entity, zero when the table has none."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    joined = entities.select(key).distinct().join(counted, key, "left")
    return joined.select(key, F.coalesce("n", F.lit(0)).alias("weeks"))


def weekly_extent(df: DataFrame, key: str = "ISO_Code", value: str = "factcheck_count") -> DataFrame:
    """Entities and grand total of a weekly table."""
    per_key = df.groupBy(key).agg(F.sum(value).alias("s"))
    return per_key.agg(F.count(key).alias("entities"), F.coalesce(F.sum("s"), F.lit(0)).alias("total"))


def country_metrics(
    df: DataFrame,
    key: str = "ISO_Code",
    date: str = "Date",
    latest: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    curve: str = "New_Cases_7d",
    continent: str = "Continent",
) -> DataFrame:
    """Latest attributes, peak of the smoothed curve and policy means, from one grouped pass."""
    latest = {c: a for c, a in (latest or LATEST_ATTRIBUTES).items() if c in df.columns}
    means = means or MEAN_INDICES
    whole = {"total_confirmed", "total_deaths"}
    packed = df.groupBy(key).agg(
        *([last_present(continent, date).alias("continent")] if continent in df.columns else []),
        *[last_present(c, date).alias(a) for c, a in latest.items()],
        peak_struct(curve, date).alias("_p"),
        *[F.avg(c).alias(a) for c, a in means.items() if c in df.columns],
    )
    have = set(packed.columns)
    zero = lambda a: F.coalesce(F.col(a), F.lit(0)).cast("long" if a in whole else "double") if a in have else F.lit(0.0)
    return packed.select(
        F.col(key).alias("iso_code"),
        (F.col("continent") if "continent" in have else F.lit(None).cast("string")).alias("continent"),
        *[zero(a).alias(a) for a in LATEST_ATTRIBUTES.values()],
        F.date_from_unix_date(-F.col("_p.d")).alias("peak_date"),
        F.coalesce("_p.v", F.lit(0.0)).cast("double").alias("peak_cases_7d"),
        *[zero(a).alias(a) for a in means.values()],
    )


# Attributes of an entity node and the panel column each one comes from.
LATEST_ATTRIBUTES = {
    "Confirmed": "total_confirmed",
    "Deaths": "total_deaths",
    "population": "population",
    "population_density": "population_density",
    "median_age": "median_age",
    "gdp_per_capita": "gdp_per_capita",
    "life_expectancy": "life_expectancy",
    "total_cases_per_million": "total_cases_per_million",
    "total_deaths_per_million": "total_deaths_per_million",
}
MEAN_INDICES = {
    "containment_health_index": "avg_containment_health_index",
    "stringency_index_vax": "avg_stringency_index_vax",
    "stringency_index_nonvax": "avg_stringency_index_nonvax",
}
