"""Result-set views over a prepared panel.

Every view takes the panel and, optionally, one entity and a date range. Without an entity the same
plan serves all of them at once. Availability guards work per entity: the values of an entity are counted
over its rows, which are at most one per day and lie together already, so a guard adds no join and the
panel is derived once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paneloom.dims import event_dim
from paneloom.functions.classes import above_one
from paneloom.functions.text import label_of
from paneloom.operators import aggregates as A, stats as ST
from paneloom.operators.filters import between_dates, for_key
from paneloom.operators.ordering import top_n
from paneloom.operators.schema import populated
from paneloom.operators.windows import running_total_col, series

KEY, DAY = "ISO_Code", "Date"
Range = tuple[str, str] | None

# Columns each view looks for, in order of preference.
STRINGENCY = ("stringency_index", "containment_health_index", "stringency_index_vax")
VACCINATION = ("people_fully_vaccinated_per_hundred", "people_vaccinated_per_hundred")
OCCUPANCY = ("daily_occupancy_hosp", "daily_occupancy_icu")
POLICIES = (
    "c1m_school_closing", "c2m_workplace_closing", "c3m_cancel_public_events", "c4m_restrictions_on_gatherings",
    "c5m_close_public_transport", "c6m_stay_at_home_requirements", "c7m_restrictions_on_internal_movement",
    "c8ev_international_travel_controls", "h6m_facial_coverings", "h7_vaccination_policy",
)
NARRATIVES = ("antivax_index", "denialism_index", "conspiracy_index", "altmed_index")
INTENTS = ("provax_action_index", "provax_trust_index", "info_seeking_index")
EXCESS = (
    "excess_mortality", "estimated_daily_excess_deaths", "excess_mortality_cumulative",
    "cumulative_estimated_daily_excess_deaths",
)
OUTCOME_PAIRS = (
    ("disinfo_index", "unwillingness_covid_vaccinate_this_week_pct_pop"),
    ("disinfo_index", "daily_vaccinations_smoothed"),
    ("provax_action_index", "daily_vaccinations_smoothed"),
    ("trust_ratio", "people_fully_vaccinated_per_hundred"),
)

# Column families of the correlation view.
FAMILIES: dict[str, tuple[str, ...]] = {
    "epidemiology": (
        "Confirmed", "Deaths", "New_Cases", "New_Deaths", "New_Cases_7d", "New_Deaths_7d",
        "new_cases_per_million", "new_deaths_per_million", "total_cases_per_million",
        "total_deaths_per_million", "cfr", "reproduction_rate", "positive_rate", "tests_per_case",
        "new_cases_7_day_avg_right", "new_deaths_7_day_avg_right",
    ),
    "vaccination": (
        "people_fully_vaccinated_per_hundred", "total_vaccinations_per_hundred",
        "people_vaccinated_per_hundred", "total_vaccinations", "people_fully_vaccinated",
        "people_vaccinated", "total_boosters", "new_vaccinations_smoothed", "people_unvaccinated",
        "willingness_covid_vaccinate_this_week_pct_pop", "unwillingness_covid_vaccinate_this_week_pct_pop",
        "uncertain_covid_vaccinate_this_week_pct_pop",
    ),
    "policy": (
        "stringency_index", "containment_health_index", "stringency_index_vax", "stringency_index_nonvax",
        "v2a_vaccine_availability__summary", *POLICIES,
    ),
    "health": ("daily_occupancy_icu", "daily_occupancy_hosp", "hospital_beds_per_thousand"),
    "excess": EXCESS,
    "demography": (
        "population", "population_density", "median_age", "gdp_per_capita", "life_expectancy",
        "hospital_beds_per_thousand",
    ),
    "testing": ("positive_rate", "new_tests_7day_smoothed", "tests_per_case"),
    "infodemic": (
        "disinfo_index", *NARRATIVES, "proscience_index", *INTENTS, "trust_ratio", "sentiment_balance",
    ),
    "factcheck": ("factcheck_count", "factcheck_cumulative"),
}


def scope(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """The entity and the date range of a page; both filters reach the scan of a stored panel."""
    rows = df if date_range is None else between_dates(df, *date_range)
    return rows if key is None else for_key(rows, key)


def _count(col: str) -> Column:
    """Values of a column in the entity of each row."""
    return F.count(col).over(Window.partitionBy(KEY))


def guarded(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """Rows of the entities in which each of ``cols`` has more than ``k`` values."""
    flags = {f"_g{i}": _count(c) for i, c in enumerate(cols)}
    counted = df.withColumns(flags)
    for flag in flags:
        counted = counted.filter(F.col(flag) > k)
    return counted.drop(*flags)


def _first_of(df: DataFrame, cols: Sequence[str], k: int | Mapping[str, int]) -> tuple[DataFrame, Column]:
    """Per entity, the first of ``cols`` with more than ``k`` values, named in ``_pick`` beside each row."""
    present = [c for c in cols if c in df.columns]
    need = k if isinstance(k, Mapping) else {c: k for c in present}
    counted = df.withColumns({f"_n{i}": _count(c) for i, c in enumerate(present)})
    pick = F.coalesce(*[F.when(F.col(f"_n{i}") > need[c], F.lit(c)) for i, c in enumerate(present)])
    value = F.coalesce(*[F.when(F.col("_pick") == c, F.col(c).cast("double")) for c in present])
    return counted.withColumn("_pick", pick).filter("_pick is not null"), value


def _long(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """Measures of one view as rows; a measure with too few values in an entity is left out there."""
    present = [c for c in cols if c in df.columns]
    counted = df.select(KEY, DAY, *present).withColumns({f"_n{i}": _count(c) for i, c in enumerate(present)})
    shown = [F.when(F.col(f"_n{i}") > k, F.col(c).cast("double")).alias(c) for i, c in enumerate(present)]
    return counted.select(KEY, DAY, *shown).unpivot([KEY, DAY], present, "measure", "value").filter("value is not null")


def global_kpi_row(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V1."""
    return A.global_kpis(scope(df, key, date_range))


def diffusion_frames(
    df: DataFrame, key: str | None = None, date_range: Range = None, metric: str = "Confirmed", fallback: str = "New_Cases_7d"
) -> DataFrame:
    """V2: monthly maxima of every number per entity, with the log10 of the metric."""
    rows = scope(df, key, date_range)
    numbers = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "bigint", "int", "float")]
    chosen = metric if metric in numbers else fallback
    return A.monthly_max(rows, KEY, DAY, numbers, chosen)


def global_curve(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V3."""
    return A.daily_totals(scope(df, key, date_range), ["New_Cases", "New_Cases_7d"])


def top_cases(df: DataFrame, key: str | None = None, date_range: Range = None, n: int = 15) -> DataFrame:
    """V4."""
    return _top(df, key, date_range, "Confirmed", n)


def top_deaths(df: DataFrame, key: str | None = None, date_range: Range = None, n: int = 15) -> DataFrame:
    """V5."""
    return _top(df, key, date_range, "Deaths", n)


def _top(df: DataFrame, key: str | None, date_range: Range, metric: str, n: int) -> DataFrame:
    return top_n(A.latest_non_null(scope(df, key, date_range), [KEY], DAY, [metric]).select(KEY, metric), metric, n, KEY)


def entity_header(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V6: extent, rows and continent of the last row."""
    rows = scope(df, key, date_range)
    last = F.max_by("Continent", DAY) if "Continent" in df.columns else F.lit("N/A")
    return rows.groupBy(KEY).agg(
        F.min(DAY).alias("first_date"), F.max(DAY).alias("last_date"), F.count(F.lit(1)).alias("rows"), last.alias("continent")
    )


def entity_kpis(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V7: the last row's headline values; stringency falls back along its chain."""
    rows = scope(df, key, date_range)
    have = lambda c: F.max_by(F.col(c).cast("double"), DAY) if c in df.columns else F.lit(None).cast("double")
    return rows.groupBy(KEY).agg(
        F.coalesce(have("Confirmed"), F.lit(0.0)).cast("long").alias("cases"),
        F.coalesce(have("Deaths"), F.lit(0.0)).cast("long").alias("deaths"),
        F.coalesce(have("stringency_index"), have("containment_health_index")).alias("stringency"),
        have("people_fully_vaccinated_per_hundred").alias("vaccinated_pct"),
        have("reproduction_rate").alias("rt"),
    )


def new_cases(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V8."""
    return scope(df, key, date_range).select(KEY, DAY, "New_Cases", "New_Cases_7d")


def new_deaths(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V9."""
    return scope(df, key, date_range).select(KEY, DAY, "New_Deaths", "New_Deaths_7d")


def rt_series(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V10."""
    rows = guarded(scope(df, key, date_range), ["reproduction_rate"], 10)
    return rows.select(KEY, DAY, "reproduction_rate", above_one(F.col("reproduction_rate")).alias("growing"))


def rt_vs_stringency(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V11, the points."""
    rows = guarded(scope(df, key, date_range), ["reproduction_rate"], 10)
    picked, value = _first_of(rows, STRINGENCY, 5)
    points = picked.select(KEY, DAY, value.alias("stringency"), F.col("reproduction_rate").cast("double").alias("rt"))
    return guarded(points.dropna(subset=["stringency", "rt"]), ["rt"], 5)


def rt_line(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V11, the line of each entity."""
    return ST.ols(rt_vs_stringency(df, key, date_range), "stringency", "rt", [KEY])


def vaccination_progress(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V12."""
    return _long(scope(df, key, date_range), VACCINATION, 5)


def vaccination_speed(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V13."""
    return guarded(scope(df, key, date_range), ["new_vaccinations_smoothed"], 5).select(KEY, DAY, "new_vaccinations_smoothed")


def occupancy(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V14."""
    return _long(scope(df, key, date_range), OCCUPANCY, 5)


def policy_matrix(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """Weekly means on a gapless calendar, labelled."""
    present = [c for c in POLICIES if c in df.columns]
    wide = A.weekly_mean(scope(df, key, date_range), present, KEY, DAY)
    labelled = wide.withColumnsRenamed({c: label_of(c) for c in present})
    return labelled.unpivot([KEY, "week_end"], [label_of(c) for c in present], "label", "value")


def cases_vs_stringency(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V16."""
    value = next((c for c in STRINGENCY[:2] if c in df.columns), None)
    curve = "New_Cases_7d" if "New_Cases_7d" in df.columns else "New_Cases"
    second = F.col(value).cast("double") if value else F.lit(None).cast("double")
    return scope(df, key, date_range).select(KEY, DAY, F.col(curve).alias("cases"), second.alias("stringency"))


def excess_daily(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """Daily excess deaths, or the percentage where an entity has no daily estimate."""
    rows, value = _first_of(scope(df, key, date_range), ("estimated_daily_excess_deaths", "excess_mortality"), 5)
    return rows.select(KEY, DAY, F.col("_pick").alias("measure"), value.alias("value")).dropna(subset=["value"])


def excess_cumulative(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """Running sum of the daily estimate, or the stored cumulative column where there is none."""
    daily, stored = "estimated_daily_excess_deaths", ("cumulative_estimated_daily_excess_deaths", "excess_mortality_cumulative")
    need = {daily: 5, **{c: 3 for c in stored}}
    rows, value = _first_of(scope(df, key, date_range), (daily, *stored), need)
    points = rows.select(KEY, DAY, "_pick", value.alias("value")).dropna(subset=["value"])
    total = running_total_col("value", series(KEY, DAY))
    return points.select(
        KEY, DAY, F.col("_pick").alias("measure"), F.when(F.col("_pick") == daily, total).otherwise(F.col("value")).alias("value")
    )


def correlation_family(
    df: DataFrame, family: str = "epidemiology", key: str | None = None, date_range: Range = None, per_entity: bool = False
) -> DataFrame:
    """Pairwise correlations of a family. Excess columns need more than three values."""
    rows = scope(df, key, date_range)
    cols = [c for c in FAMILIES[family] if c in df.columns]
    if family == "factcheck":
        cols += [c for c in df.columns if c.startswith("fc_")]
    if family == "excess":
        cols = populated(rows, cols, 3)
    return ST.corr_matrix(rows, cols, [KEY] if per_entity else [])


def explorer_points(df: DataFrame, x: str, y: str, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V20, the points."""
    return ST.scatter(scope(df, key, date_range), x, y, [KEY, DAY])


def explorer_summary(df: DataFrame, x: str, y: str, key: str | None = None, date_range: Range = None, per_entity: bool = True) -> DataFrame:
    """V20, line, coefficient and class."""
    rows, by = scope(df, key, date_range), [KEY] if per_entity else []
    line, r = ST.ols(rows, x, y, by), ST.pearson(rows, x, y, by).drop("n")
    return ST.attach(line, r, by)


def distribution(df: DataFrame, col: str, key: str | None = None, date_range: Range = None, per_entity: bool = True) -> Mapping[str, DataFrame]:
    """Histogram, box and description."""
    rows, by = scope(df, key, date_range), [KEY] if per_entity else []
    return {
        "histogram": ST.histogram(rows, col, 50, by),
        "box": ST.box_stats(rows, col, by),
        "describe": ST.describe_col(rows, col, by),
    }


def infodemic_row(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V22."""
    return A.infodemic_kpis(scope(df, key, date_range), [KEY])


def trust_series(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V23."""
    rows = guarded(scope(df, key, date_range), ["trust_ratio_smooth"], 3)
    return rows.select(KEY, DAY, "trust_ratio_smooth", above_one(F.col("trust_ratio_smooth")).alias("science_leads"))


def disinfo_vs_science(df: DataFrame, key: str | None = None, date_range: Range = None, events: DataFrame | None = None) -> DataFrame:
    """Both indices with the dated events."""
    rows = guarded(scope(df, key, date_range), ["disinfo_index", "proscience_index"], 3)
    dated = events if events is not None else event_dim(df.sparkSession)
    return rows.select(KEY, DAY, "disinfo_index", "proscience_index").join(dated, DAY, "left")


def stacked(df: DataFrame, cols: Sequence[str], k: int = 3) -> DataFrame:
    """Measures as layers: each value with the total of the layers up to it."""
    present = [c for c in cols if c in df.columns]
    rows = df.select(KEY, DAY, *present).withColumns({f"_n{i}": _count(c) for i, c in enumerate(present)})
    cells, below = [], F.lit(0.0)
    for i, c in enumerate(present):
        shown = F.col(f"_n{i}") > k
        below = below + F.when(shown, F.coalesce(F.col(c).cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
        cells.append(
            F.when(shown, F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"), below.alias("stacked")))
        )
    long = rows.select(KEY, DAY, F.explode(F.array(*cells)).alias("m")).filter("m is not null")
    return long.select(KEY, DAY, "m.measure", "m.value", "m.stacked").filter("value is not null")


def narratives(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V25."""
    return stacked(guarded(scope(df, key, date_range), ["disinfo_index"], 3), NARRATIVES)


def intents(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V26."""
    return stacked(guarded(scope(df, key, date_range), ["proscience_index"], 3), INTENTS)


def disinfo_vs_vaccination(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V27."""
    rows = guarded(scope(df, key, date_range), ["disinfo_index"], 3)
    return rows.select(KEY, DAY, "disinfo_index", "people_fully_vaccinated_per_hundred")


def outcome_grid(
    df: DataFrame, key: str | None = None, date_range: Range = None, pairs: Sequence[tuple[str, str]] = OUTCOME_PAIRS
) -> DataFrame:
    """Per entity, every declared pair with coefficient and line."""
    return ST.pair_grid(scope(df, key, date_range), pairs, [KEY])


def disinfo_vs_cases(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V29."""
    curve = "New_Cases_7d" if "New_Cases_7d" in df.columns else "new_cases_7_day_avg_right"
    rows = guarded(scope(df, key, date_range), ["disinfo_index"], 3)
    return rows.select(KEY, DAY, "disinfo_index", F.col(curve).alias("cases"))


def factcheck_row(df: DataFrame, key: str | None = None, date_range: Range = None) -> DataFrame:
    """V30."""
    rows = guarded(scope(df, key, date_range), ["factcheck_count"], 0)
    return A.factcheck_kpis(rows, categories=[c for c in df.columns if c.startswith("fc_")], by=[KEY])


def triangulation(
    df: DataFrame, key: str | None = None, date_range: Range = None, low: str = "2020-01-01", high: str = "2020-07-31"
) -> tuple[DataFrame, DataFrame]:
    """The series inside the window and its coefficient."""
    rows = guarded(guarded(scope(df, key, date_range), ["factcheck_count"], 0), ["disinfo_index"], 3)
    inside = between_dates(rows, low, high).select(KEY, DAY, "factcheck_count", "disinfo_index")
    shown = inside.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(KEY))).filter("_n > 5").drop("_n")
    return shown, ST.pearson(shown, "factcheck_count", "disinfo_index", [KEY])
