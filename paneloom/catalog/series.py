"""Aggregations, windows, snapshots and panel views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paneloom.catalog import fixtures as fx
from paneloom.catalog.base import query, round_sql, rounded, table
from paneloom.operators import aggregates as A, windows as W
from paneloom.plans import live as LV, views as V

WINDOW = "(PARTITION BY ISO_Code ORDER BY Date"


@query(
    "flagship_top15",
    f"""WITH {fx.PANEL}, last AS (
      SELECT ISO_Code, arg_max(Confirmed, Date) AS Confirmed, arg_max(New_Cases_7d, Date) AS New_Cases_7d FROM panel GROUP BY 1)
    SELECT ISO_Code, Confirmed, round(New_Cases_7d::DECIMAL(28, 9), 6)::DOUBLE AS New_Cases_7d FROM last ORDER BY Confirmed DESC, ISO_Code LIMIT 15""",
)
def flagship_top15(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared panel, latest snapshot, top 15: the path every page starts with."""
    snapshot = A.latest_non_null(fx.panel(spark, sf), ["ISO_Code"], "Date", ["Confirmed", "New_Cases_7d"])
    top = snapshot.orderBy(F.desc("Confirmed"), "ISO_Code").limit(15)
    return rounded(top.select("ISO_Code", "Confirmed", "New_Cases_7d"))


@query("prepare_panel", round_sql(
    f"WITH {fx.PANEL} SELECT ISO_Code, Date, Country, New_Cases, New_Deaths, New_Cases_7d, New_Deaths_7d, stringency_index FROM panel",
    ["New_Cases_7d", "New_Deaths_7d", "stringency_index"],
))
def prepare_panel(spark: SparkSession, sf: str) -> DataFrame:
    """D1."""
    return rounded(fx.panel(spark, sf).select(
        "ISO_Code", "Date", "Country", "New_Cases", "New_Deaths", "New_Cases_7d", "New_Deaths_7d", "stringency_index"
    ))


@query("global_kpis", f"""WITH {fx.GOLD}, s AS (
      SELECT ISO_Code, max(Date) AS d, count(*) AS n, arg_max(Confirmed, Date) AS c, arg_max(Deaths, Date) AS x FROM gold GROUP BY 1)
    SELECT count(*) AS entities, max(d) AS last_date, sum(n)::BIGINT AS rows, sum(c)::BIGINT AS total_cases, sum(x)::BIGINT AS total_deaths FROM s""")
def global_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """A1, V1."""
    return V.global_kpi_row(fx.panel(spark, sf))


@query("panel_extent", f"WITH {fx.NATIONS} SELECT count(DISTINCT ISO_Code) AS entities, min(Date) AS first_date, max(Date) AS last_date, count(*) AS rows FROM nations")
def panel_extent(spark: SparkSession, sf: str) -> DataFrame:
    """A2."""
    return A.panel_extent(fx.nations(spark, sf))


@query("latest_non_null", round_sql(
    f"""WITH {fx.GOLD} SELECT ISO_Code, max(Date) AS Date,
      arg_max(c1m_school_closing, Date) FILTER (WHERE c1m_school_closing IS NOT NULL) AS c1m_school_closing,
      arg_max(Country, Date) FILTER (WHERE Country IS NOT NULL) AS Country,
      arg_max(reproduction_rate, Date) FILTER (WHERE reproduction_rate IS NOT NULL) AS reproduction_rate FROM gold GROUP BY 1""",
    ["c1m_school_closing", "reproduction_rate"],
))
def latest_non_null(spark: SparkSession, sf: str) -> DataFrame:
    """A3."""
    return rounded(A.latest_non_null(fx.gold(spark, sf), ["ISO_Code"], "Date", ["c1m_school_closing", "Country", "reproduction_rate"]))


@query("latest_row", round_sql(
    f"""WITH {fx.GOLD} SELECT ISO_Code, Date, Country, c1m_school_closing, reproduction_rate FROM gold
    QUALIFY row_number() OVER (PARTITION BY ISO_Code ORDER BY Date DESC) = 1""",
    ["c1m_school_closing", "reproduction_rate"],
))
def latest_row(spark: SparkSession, sf: str) -> DataFrame:
    """A4: nulls of the last row are kept."""
    slim = fx.gold(spark, sf).select("ISO_Code", "Date", "Country", "c1m_school_closing", "reproduction_rate")
    return rounded(A.latest_row(slim, ["ISO_Code"], "Date"))


@query("monthly_max_log", round_sql(
    f"""WITH {fx.NATIONS}, c AS (SELECT *, (sum(n) OVER {WINDOW} ROWS UNBOUNDED PRECEDING))::DOUBLE AS Confirmed FROM nations)
    SELECT ISO_Code, strftime(Date, '%Y-%m') AS year_month, max(Confirmed) AS Confirmed, max(n) AS n,
      log10(greatest(max(Confirmed), 1)) AS cases_log FROM c GROUP BY 1, 2""",
    ["cases_log"],
))
def monthly_max_log(spark: SparkSession, sf: str) -> DataFrame:
    """A5, V2."""
    total = W.running_total(fx.nations(spark, sf), "ISO_Code", "Date", "n", "Confirmed")
    slim = total.select("ISO_Code", "Date", F.col("Confirmed").cast("double").alias("Confirmed"), "n")
    return rounded(V.diffusion_frames(slim))


@query("daily_totals", round_sql(
    f"WITH {fx.PANEL} SELECT Date, sum(New_Cases) AS New_Cases, sum(New_Cases_7d) AS New_Cases_7d FROM panel GROUP BY 1",
    ["New_Cases", "New_Cases_7d"],
))
def daily_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A6, V3."""
    return rounded(V.global_curve(fx.panel(spark, sf)))


@query("weekly_mean_calendar", round_sql(
    f"""WITH {fx.NATIONS}, w AS (SELECT ISO_Code, date_trunc('week', Date)::DATE AS wk, avg(n) AS n, avg(n_closed) AS n_closed FROM nations GROUP BY 1, 2),
    cal AS (SELECT ISO_Code, unnest(generate_series(min(wk), max(wk), INTERVAL 7 DAY))::DATE AS wk FROM w GROUP BY 1)
    SELECT ISO_Code, (wk + 6)::DATE AS week_end, w.n, w.n_closed FROM cal LEFT JOIN w USING (ISO_Code, wk)""",
    ["n", "n_closed"],
))
def weekly_mean_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """A7 with T10: Sunday labels and no missing week."""
    return rounded(A.weekly_mean(fx.nations(spark, sf), ["n", "n_closed"]))


@query("country_metrics", round_sql(
    f"WITH {fx.METRICS} SELECT * FROM metrics",
    ["population", "total_cases_per_million", "total_deaths_per_million", "peak_cases_7d", "avg_containment_health_index",
     "avg_stringency_index_vax", "avg_stringency_index_nonvax"],
))
def country_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A8."""
    return rounded(fx.metrics(spark, sf))


@query("peak", round_sql(f"WITH {fx.METRICS} SELECT ISO_Code, peak_date, peak_cases_7d AS peak_value FROM peaks", ["peak_value"]))
def peak(spark: SparkSession, sf: str) -> DataFrame:
    """A9 with T11."""
    return rounded(A.peak(fx.panel(spark, sf), "ISO_Code", "New_Cases_7d"))


@query("weekly_index", round_sql(
    f"""WITH {fx.TRENDS} SELECT ISO_Code, date, avg(search_interest) AS disinfo_index, max(search_interest) AS disinfo_max,
    count(*) FILTER (WHERE search_interest > {fx.THRESHOLD}) AS disinfo_terms_active FROM trends GROUP BY 1, 2""",
    ["disinfo_index", "disinfo_max"],
))
def weekly_index(spark: SparkSession, sf: str) -> DataFrame:
    """A10."""
    return rounded(A.weekly_index(fx.trends(spark, sf), ["ISO_Code", "date"], threshold=fx.THRESHOLD))


@query("weekly_count", f"WITH {fx.CHECKS} SELECT ISO_Code, _week, count(*) AS factcheck_count FROM check_clean GROUP BY 1, 2")
def weekly_count(spark: SparkSession, sf: str) -> DataFrame:
    """A11."""
    from paneloom.functions.dates import week_start

    dated = fx.expanded(spark, sf).select("ISO_Code", week_start("date").alias("_week"))
    return A.weekly_count(dated, ["ISO_Code", "_week"])


@query("top_values", "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 15")
def top_values(spark: SparkSession, sf: str) -> DataFrame:
    """A12."""
    return A.top_values(table(spark, sf, "documents"), "source", 15)


@query("top_categories_other", """WITH t AS (SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 15)
    SELECT CASE WHEN source IN (SELECT source FROM t) THEN source ELSE 'other' END AS source, lang, count(*) AS n FROM documents GROUP BY 1, 2""")
def top_categories_other(spark: SparkSession, sf: str) -> DataFrame:
    """A12 with F8: the rest becomes one value."""
    from paneloom.operators.filters import else_other_by

    docs = table(spark, sf, "documents").select("source", "lang")
    named = else_other_by(docs, "source", A.top_values(docs, "source", 15))
    return named.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("top_totals", f"WITH {fx.NATIONS} SELECT ISO_Code, sum(n)::BIGINT AS total FROM nations GROUP BY 1 ORDER BY total DESC, ISO_Code LIMIT 10")
def top_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A13."""
    return A.top_totals(fx.nations(spark, sf), 10, value="n")


@query("replay_days", "SELECT DISTINCT o_orderdate::DATE AS Date FROM orders WHERE o_orderdate::DATE >= DATE '1999-01-01' ORDER BY 1")
def replay_days(spark: SparkSession, sf: str) -> DataFrame:
    """A16."""
    return A.replay_days(table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("Date")), "1999-01-01")


@query("positive_share", round_sql(
    f"""WITH {fx.NATIONS}, d AS (SELECT ISO_Code, n - lag(n) OVER {WINDOW}) AS diff FROM nations)
    SELECT ISO_Code, count(*) FILTER (WHERE diff > 0)::DOUBLE / greatest(count(*) - 1, 1) AS share FROM d GROUP BY 1""", ["share"],
))
def positive_share(spark: SparkSession, sf: str) -> DataFrame:
    """A17."""
    w = W.series("ISO_Code", "Date")
    diffs = fx.nations(spark, sf).select("ISO_Code", (F.col("n") - F.lag("n").over(w)).alias("diff"))
    return rounded(diffs.groupBy("ISO_Code").agg(A.positive_share(F.col("diff")).alias("share")))


@query("dedupe_first", """SELECT o_custkey, o_orderdate::DATE AS Date, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey) = 1""")
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    """A18."""
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("Date"), "o_orderkey", "o_totalprice")
    return A.dedupe_first(orders, ["o_custkey", "Date"], ["o_orderkey"])


@query("weeks_per_entity", f"""WITH {fx.CHECKS}, w AS (SELECT DISTINCT ISO_Code, _week FROM check_clean),
    k AS (SELECT DISTINCT iso3 AS ISO_Code FROM check_dim WHERE iso3 IS NOT NULL UNION SELECT 'NONE')
    SELECT k.ISO_Code, count(w._week) AS weeks FROM k LEFT JOIN w USING (ISO_Code) GROUP BY 1""")
def weeks_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    """Zero for an entity without data."""
    from paneloom.plans.factcheck import weekly_factchecks

    listed = fx.check_dim(spark, sf).filter("iso3 is not null").select(F.col("iso3").alias("ISO_Code"))
    listed = listed.unionByName(spark.createDataFrame([("NONE",)], "ISO_Code string"))
    return A.weeks_per_entity(weekly_factchecks(fx.expanded(spark, sf)), listed)


@query("weekly_extent", f"WITH {fx.CHECKS} SELECT count(DISTINCT ISO_Code) AS entities, count(*) AS total FROM check_clean")
def weekly_extent(spark: SparkSession, sf: str) -> DataFrame:
    """A19, the totals."""
    from paneloom.plans.factcheck import weekly_factchecks

    return A.weekly_extent(weekly_factchecks(fx.expanded(spark, sf)))


@query("delta_clip", f"""WITH {fx.NATIONS} SELECT ISO_Code, Date, coalesce(greatest(n - lag(n) OVER {WINDOW}), 0), 0)::DOUBLE AS delta FROM nations""")
def delta_clip(spark: SparkSession, sf: str) -> DataFrame:
    """W1."""
    return W.increments(fx.nations(spark, sf), "ISO_Code", "Date", "n", "delta").select("ISO_Code", "Date", "delta")


@query("rolling_mean_7", round_sql(f"WITH {fx.NATIONS} SELECT ISO_Code, Date, avg(n) OVER {WINDOW} ROWS 6 PRECEDING) AS mean_7 FROM nations", ["mean_7"]))
def rolling_mean_7(spark: SparkSession, sf: str) -> DataFrame:
    """W2."""
    return rounded(W.rolling_mean(fx.nations(spark, sf), "ISO_Code", "Date", "n", 7, "mean_7").select("ISO_Code", "Date", "mean_7"))


@query("rolling_mean_4", round_sql(f"WITH {fx.GOLD} SELECT ISO_Code, Date, avg(c1m_school_closing) OVER {WINDOW} ROWS 3 PRECEDING) AS mean_4 FROM gold", ["mean_4"]))
def rolling_mean_4(spark: SparkSession, sf: str) -> DataFrame:
    """Nulls inside the frame are skipped."""
    return rounded(W.rolling_mean(fx.gold(spark, sf), "ISO_Code", "Date", "c1m_school_closing", 4, "mean_4").select("ISO_Code", "Date", "mean_4"))


@query("running_total", f"""WITH {fx.GOLD} SELECT ISO_Code, Date, CASE WHEN c6m_stay_at_home_requirements IS NOT NULL
    THEN sum(c6m_stay_at_home_requirements) OVER {WINDOW} ROWS UNBOUNDED PRECEDING) END AS total FROM gold""")
def running_total(spark: SparkSession, sf: str) -> DataFrame:
    """W4."""
    out = W.running_total(fx.gold(spark, sf), "ISO_Code", "Date", "c6m_stay_at_home_requirements", "total")
    return out.select("ISO_Code", "Date", "total")


@query("lags", f"""WITH {fx.NATIONS} SELECT ISO_Code, Date, lag(n, 7) OVER {WINDOW}) AS lag_7, lag(n, 14) OVER {WINDOW}) AS lag_14,
    lag(n, 21) OVER {WINDOW}) AS lag_21 FROM nations""")
def lags(spark: SparkSession, sf: str) -> DataFrame:
    """W5."""
    return W.add_lags(fx.nations(spark, sf), "n").select("ISO_Code", "Date", "lag_7", "lag_14", "lag_21")


@query("seeded_diff", f"""WITH {fx.NATIONS}, s AS (SELECT ISO_Code, arg_max(n, Date) AS seed FROM nations WHERE Date < DATE '1999-01-01' GROUP BY 1)
    SELECT ISO_Code, Date, (n - coalesce(lag(n) OVER {WINDOW}), seed))::BIGINT AS diff FROM nations JOIN s USING (ISO_Code) WHERE Date >= DATE '1999-01-01'""")
def seeded_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The first live row is compared with the last value before the cut."""
    daily = fx.nations(spark, sf)
    seeds = W.last_before(daily, "ISO_Code", "Date", "n", "1999-01-01", "seed")
    rows = daily.filter(F.col("Date") >= F.lit("1999-01-01").cast("date")).join(seeds, "ISO_Code")
    return rows.select("ISO_Code", "Date", W.seeded_diff(F.col("n"), F.col("seed"), W.series("ISO_Code", "Date")).alias("diff"))


@query("arrival_batches", f"""WITH {fx.GOLD} SELECT ISO_Code, Date FROM gold WHERE Date >= DATE '{fx.SINCE}'
    QUALIFY dense_rank() OVER (PARTITION BY ISO_Code ORDER BY date_trunc('second', received_at)) <= 5""")
def arrival_batches(spark: SparkSession, sf: str) -> DataFrame:
    """W8, LV3: the first five arrival seconds of each entity."""
    live = LV.live_clean(fx.gold(spark, sf), fx.SINCE)
    return LV.visible_batches(live, 5).select("ISO_Code", "Date")


@query("live_progress", round_sql(f"""WITH {fx.GOLD}, a AS (SELECT ISO_Code, Date,
      dense_rank() OVER (PARTITION BY ISO_Code ORDER BY date_trunc('second', received_at)) AS b FROM gold WHERE Date >= DATE '{fx.SINCE}')
    SELECT ISO_Code, count(*) FILTER (WHERE b <= 5) AS received_days, count(*) AS total_days,
      max(Date) FILTER (WHERE b <= 5) AS last_date, (count(*) FILTER (WHERE b <= 5)) * 100.0 / count(*) AS pct FROM a GROUP BY 1""", ["pct"]))
def live_progress(spark: SparkSession, sf: str) -> DataFrame:
    """SM6."""
    live = LV.live_clean(fx.gold(spark, sf).select("ISO_Code", "Date", "received_at"), fx.SINCE)
    return rounded(LV.live_progress(live, LV.visible_batches(live, 5)))


_LIVE = f"""{fx.PANEL},
hist AS (SELECT ISO_Code, Date, Confirmed, New_Cases_7d FROM panel WHERE Date < DATE '{fx.SINCE}'),
seeds AS (SELECT ISO_Code, arg_max(Confirmed, Date) AS seed, arg_max(New_Cases_7d, Date) AS seed_7d FROM hist GROUP BY 1),
live AS (
  SELECT p.ISO_Code, p.Date, p.CONF AS c, lag(p.CONF) OVER (PARTITION BY p.ISO_Code ORDER BY p.Date) AS prev,
    row_number() OVER (PARTITION BY p.ISO_Code ORDER BY p.Date) AS rn, seed, seed_7d
  FROM panel p LEFT JOIN seeds s USING (ISO_Code) WHERE p.Date >= DATE '{fx.SINCE}'),
shares AS (SELECT ISO_Code, count(*) FILTER (WHERE c - prev > 0)::DOUBLE / greatest(count(*) - 1, 1) AS share FROM live GROUP BY 1),
rolled AS (
  SELECT ISO_Code, Date, is_live, avg(v) OVER (PARTITION BY ISO_Code ORDER BY Date ROWS 6 PRECEDING) AS smooth FROM (
    SELECT ISO_Code, Date, FALSE AS is_live, New_Cases_7d AS v FROM hist
      QUALIFY row_number() OVER (PARTITION BY ISO_Code ORDER BY Date DESC) <= 6
    UNION ALL SELECT ISO_Code, Date, TRUE, greatest(c - coalesce(prev, seed, c), 0) FROM live) u),
target AS (
  SELECT l.ISO_Code, l.Date, CASE WHEN share > 0.7 THEN smooth
    WHEN rn = 1 THEN coalesce(seed_7d, 0) ELSE greatest(c, 0) END AS Live_Target
  FROM live l JOIN shares USING (ISO_Code) JOIN rolled r ON r.ISO_Code = l.ISO_Code AND r.Date = l.Date AND r.is_live)"""


def live_rows(spark: SparkSession, sf: str, confirmed: str) -> tuple[DataFrame, DataFrame]:
    panel = fx.panel(spark, sf)
    live = LV.live_clean(panel.select("ISO_Code", "Date", F.col(confirmed).alias("Confirmed"), "received_at"), fx.SINCE)
    return panel, live


@query("live_target", round_sql(f"WITH {_LIVE.replace('CONF', 'Confirmed')} SELECT ISO_Code, Date, Live_Target FROM target", ["Live_Target"]))
def live_target(spark: SparkSession, sf: str) -> DataFrame:
    """LV1, LV2, LV4 on cumulative values."""
    panel, live = live_rows(spark, sf, "Confirmed")
    return rounded(LV.live_target(panel, live, fx.SINCE).select("ISO_Code", "Date", "Live_Target"))


@query("live_target_daily", round_sql(f"WITH {_LIVE.replace('CONF', 'New_Cases')} SELECT ISO_Code, Date, Live_Target FROM target", ["Live_Target"]))
def live_target_daily(spark: SparkSession, sf: str) -> DataFrame:
    """LV4 on values that are no running total."""
    panel, live = live_rows(spark, sf, "New_Cases")
    return rounded(LV.live_target(panel, live, fx.SINCE).select("ISO_Code", "Date", "Live_Target"))


@query("seed_values", round_sql(f"WITH {_LIVE.replace('CONF', 'Confirmed')} SELECT ISO_Code, seed AS seed_confirmed, seed_7d FROM seeds", ["seed_7d"]))
def seed_values(spark: SparkSession, sf: str) -> DataFrame:
    """LV2."""
    return rounded(LV.seed_values(fx.panel(spark, sf), fx.SINCE))


@query("stitched_series", round_sql(f"""WITH {_LIVE.replace('CONF', 'Confirmed')},
    firsts AS (SELECT ISO_Code, min(Date) AS Date, arg_min(Live_Target, Date) AS v FROM target GROUP BY 1)
    SELECT ISO_Code, Date, New_Cases_7d AS value, 'history' AS kind FROM hist
    UNION ALL SELECT ISO_Code, Date, v, 'history' FROM firsts WHERE ISO_Code IN (SELECT ISO_Code FROM hist)
    UNION ALL SELECT ISO_Code, Date, Live_Target, 'live' FROM target""", ["value"]))
def stitched_series(spark: SparkSession, sf: str) -> DataFrame:
    """LV5, V32 without the model's parts."""
    panel, live = live_rows(spark, sf, "Confirmed")
    return rounded(LV.stitch(panel, LV.live_target(panel, live, fx.SINCE), since=fx.SINCE))


def _guard(source: str, col: str, k: int) -> str:
    return f"ISO_Code IN (SELECT ISO_Code FROM {source} GROUP BY 1 HAVING count({col}) > {k})"


@query("entity_header", f"""WITH {fx.PANEL} SELECT ISO_Code, min(Date) AS first_date, max(Date) AS last_date, count(*) AS rows,
    arg_max(Continent, Date) AS continent FROM panel GROUP BY 1""")
def entity_header(spark: SparkSession, sf: str) -> DataFrame:
    """V6."""
    return V.entity_header(fx.panel(spark, sf))


@query("entity_kpis", round_sql(f"""WITH {fx.PANEL} SELECT ISO_Code, Confirmed::BIGINT AS cases, Deaths::BIGINT AS deaths,
    coalesce(stringency_index, containment_health_index) AS stringency, people_fully_vaccinated_per_hundred AS vaccinated_pct,
    reproduction_rate AS rt FROM panel QUALIFY row_number() OVER (PARTITION BY ISO_Code ORDER BY Date DESC) = 1""",
    ["stringency", "vaccinated_pct", "rt"]))
def entity_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """V7."""
    return rounded(V.entity_kpis(fx.panel(spark, sf)))


@query("top_cases", f"WITH {fx.PANEL} SELECT ISO_Code, arg_max(Confirmed, Date) AS Confirmed FROM panel GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_cases(spark: SparkSession, sf: str) -> DataFrame:
    """V4."""
    return V.top_cases(fx.panel(spark, sf))


@query("top_deaths", f"WITH {fx.PANEL} SELECT ISO_Code, arg_max(Deaths, Date) AS Deaths FROM panel GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_deaths(spark: SparkSession, sf: str) -> DataFrame:
    """V5."""
    return V.top_deaths(fx.panel(spark, sf))


@query("new_cases_series", round_sql(f"WITH {fx.PANEL} SELECT ISO_Code, Date, New_Cases, New_Cases_7d FROM panel", ["New_Cases_7d"]))
def new_cases_series(spark: SparkSession, sf: str) -> DataFrame:
    """V8."""
    return rounded(V.new_cases(fx.panel(spark, sf)))


@query("scoped_page", round_sql(f"WITH {fx.PANEL} SELECT ISO_Code, Date, New_Cases, New_Cases_7d FROM panel WHERE ISO_Code = 'U7' AND Date BETWEEN DATE '{fx.SINCE}' AND DATE '2999-12-31'", ["New_Cases_7d"]))
def scoped_page(spark: SparkSession, sf: str) -> DataFrame:
    """V8 for one entity and a range of days, as a page shows it."""
    return rounded(V.new_cases(fx.panel(spark, sf), "U7", (fx.SINCE, "2999-12-31")))


@query("new_deaths_series", round_sql(f"WITH {fx.PANEL} SELECT ISO_Code, Date, New_Deaths, New_Deaths_7d FROM panel", ["New_Deaths_7d"]))
def new_deaths_series(spark: SparkSession, sf: str) -> DataFrame:
    """V9."""
    return rounded(V.new_deaths(fx.panel(spark, sf)))


@query("rt_series", round_sql(f"""WITH {fx.PANEL} SELECT ISO_Code, Date, reproduction_rate, reproduction_rate > 1 AS growing FROM panel
    WHERE {_guard('panel', 'reproduction_rate', 10)}""", ["reproduction_rate"]))
def rt_series(spark: SparkSession, sf: str) -> DataFrame:
    """V10."""
    return rounded(V.rt_series(fx.panel(spark, sf)))


_RT = f"""{fx.PANEL}, rt_points AS (
  SELECT ISO_Code, Date, stringency_index AS stringency, reproduction_rate AS rt FROM panel
  WHERE {_guard('panel', 'reproduction_rate', 10)} AND {_guard('panel', 'stringency_index', 5)}
    AND stringency_index IS NOT NULL AND reproduction_rate IS NOT NULL),
rt_shown AS (SELECT * FROM rt_points WHERE {_guard('rt_points', 'rt', 5)})"""


@query("rt_vs_stringency", round_sql(f"WITH {_RT} SELECT * FROM rt_shown", ["stringency", "rt"]))
def rt_vs_stringency(spark: SparkSession, sf: str) -> DataFrame:
    """V11, the points. Every entity's first populated index is the unified one here."""
    return rounded(V.rt_vs_stringency(fx.panel(spark, sf)))


@query("rt_line", round_sql(f"""WITH {_RT} SELECT ISO_Code, regr_count(rt, stringency)::BIGINT AS n, regr_slope(rt, stringency) AS slope,
    regr_intercept(rt, stringency) AS intercept, corr(rt, stringency) ** 2 AS r2 FROM rt_shown GROUP BY 1""", ["slope", "intercept", "r2"]))
def rt_line(spark: SparkSession, sf: str) -> DataFrame:
    """V11, the line per entity."""
    return rounded(V.rt_line(fx.panel(spark, sf)))


def _long_sql(cols: tuple, k: int) -> str:
    return " UNION ALL ".join(
        f"SELECT ISO_Code, Date, '{c}' AS measure, {c} AS value FROM panel WHERE {c} IS NOT NULL AND {_guard('panel', c, k)}" for c in cols
    )


@query("vaccination_progress", f"WITH {fx.PANEL} " + _long_sql(V.VACCINATION, 5))
def vaccination_progress(spark: SparkSession, sf: str) -> DataFrame:
    """V12."""
    return V.vaccination_progress(fx.panel(spark, sf))


@query("vaccination_speed", round_sql(f"WITH {fx.PANEL} SELECT ISO_Code, Date, new_vaccinations_smoothed FROM panel WHERE {_guard('panel', 'new_vaccinations_smoothed', 5)}", ["new_vaccinations_smoothed"]))
def vaccination_speed(spark: SparkSession, sf: str) -> DataFrame:
    """V13."""
    return rounded(V.vaccination_speed(fx.panel(spark, sf)))


@query("occupancy", f"WITH {fx.PANEL} " + _long_sql(V.OCCUPANCY, 5))
def occupancy(spark: SparkSession, sf: str) -> DataFrame:
    """V14."""
    return V.occupancy(fx.panel(spark, sf))


_LABELS = {
    "c1m_school_closing": "School Closing", "c2m_workplace_closing": "Workplace Closing",
    "c3m_cancel_public_events": "Cancel Public Events", "c4m_restrictions_on_gatherings": "Restrictions On Gatherings",
    "c5m_close_public_transport": "Close Public Transport", "c6m_stay_at_home_requirements": "Stay At Home Requirements",
    "c7m_restrictions_on_internal_movement": "Restrictions On Internal Movement",
    "c8ev_international_travel_controls": "International Travel Controls", "h6m_facial_coverings": "Facial Coverings",
    "h7_vaccination_policy": "Vaccination Policy",
}


@query("policy_matrix", round_sql(
    f"""WITH {fx.PANEL}, w AS (SELECT ISO_Code, date_trunc('week', Date)::DATE AS wk, {", ".join(f"avg({c}) AS {c}" for c in _LABELS)} FROM panel GROUP BY 1, 2),
    cal AS (SELECT ISO_Code, unnest(generate_series(min(wk), max(wk), INTERVAL 7 DAY))::DATE AS wk FROM w GROUP BY 1),
    full_w AS (SELECT * FROM cal LEFT JOIN w USING (ISO_Code, wk)) """
    + " UNION ALL ".join(f"SELECT ISO_Code, (wk + 6)::DATE AS week_end, '{l}' AS label, {c} AS value FROM full_w" for c, l in _LABELS.items()),
    ["value"],
))
def policy_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """V15."""
    return rounded(V.policy_matrix(fx.panel(spark, sf)))


@query("cases_vs_stringency", round_sql(f"WITH {fx.PANEL} SELECT ISO_Code, Date, New_Cases_7d AS cases, stringency_index AS stringency FROM panel", ["cases", "stringency"]))
def cases_vs_stringency(spark: SparkSession, sf: str) -> DataFrame:
    """V16."""
    return rounded(V.cases_vs_stringency(fx.panel(spark, sf)))


_EXCESS = f"""{fx.PANEL}, picked AS (
  SELECT ISO_Code, CASE WHEN count(estimated_daily_excess_deaths) > 5 THEN 'estimated_daily_excess_deaths'
    WHEN count(excess_mortality) > 5 THEN 'excess_mortality' END AS measure FROM panel GROUP BY 1)"""


@query("excess_daily", round_sql(f"""WITH {_EXCESS} SELECT * FROM (SELECT ISO_Code, Date, measure,
    CASE measure WHEN 'estimated_daily_excess_deaths' THEN estimated_daily_excess_deaths ELSE excess_mortality END AS value
    FROM panel JOIN picked USING (ISO_Code) WHERE measure IS NOT NULL) WHERE value IS NOT NULL""", ["value"]))
def excess_daily(spark: SparkSession, sf: str) -> DataFrame:
    """V17."""
    return rounded(V.excess_daily(fx.panel(spark, sf)))


@query("excess_cumulative", round_sql(f"""WITH {fx.PANEL} SELECT ISO_Code, Date, 'estimated_daily_excess_deaths' AS measure,
    sum(estimated_daily_excess_deaths) OVER {WINDOW} ROWS UNBOUNDED PRECEDING) AS value FROM panel
    WHERE estimated_daily_excess_deaths IS NOT NULL AND {_guard('panel', 'estimated_daily_excess_deaths', 5)}""", ["value"]))
def excess_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    """V18."""
    return rounded(V.excess_cumulative(fx.panel(spark, sf)))
