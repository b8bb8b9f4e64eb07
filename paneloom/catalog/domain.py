"""Enrichment, indices, fact-checks, statistics and their views."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paneloom.catalog import fixtures as fx
from paneloom.catalog.base import query, round_sql, rounded, table
from paneloom.catalog.core import _FIRST, INDICATORS, SHIP_ORDER, ships
from paneloom.operators import joins as J, stats as ST
from paneloom.plans import factcheck as FC, gold as G, trends as TR, views as V

FIRST_PRICE = """
first_price AS (
  SELECT ISO_Code, Date, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM (
    SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS ISO_Code, o_orderdate::DATE AS Date, o_totalprice, o_orderkey
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2)"""
WIDE_SHIPS = f"""{_FIRST},
wide_ships AS (SELECT ISO_Code, Date, {", ".join(f"max(value) FILTER (WHERE indicator = '{i}') AS {i.replace(' ', '_')}" for i in INDICATORS)}
  FROM firsts GROUP BY 1, 2)"""
ADDED = [i.replace(" ", "_") for i in INDICATORS]


def source_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Six source tables of the shapes an enrichment meets."""
    orders = fx.located_orders(spark, sf, "o_orderkey", "o_totalprice")
    prices = orders.select(F.col("n_name").alias("country"), F.col("Date").cast("string").alias("date"), "o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"))
    long = ships(spark, sf).select(
        F.col("ISO_Code").alias("iso_code"), F.col("Date").cast("string").alias("date"), "indicator", F.col("value").cast("string").alias("value"), *SHIP_ORDER
    )
    return {
        "prices": prices,
        "ships": long,
        "prices_again": prices,
        "by_maker": prices.withColumn("manufacturer", F.lit("m")),
        "undated": table(spark, sf, "part"),
        "unplaced": table(spark, sf, "orders").select(F.col("o_orderdate").alias("date"), "o_totalprice"),
    }


def enrichment(spark: SparkSession, sf: str) -> tuple[DataFrame, J.EnrichmentReport]:
    names = fx.nation_codes(spark, sf).select(F.col("n_name").alias("name"), F.col("code").alias("iso3"))
    return J.enrich(fx.nations(spark, sf), source_tables(spark, sf), names, ["o_orderkey", *SHIP_ORDER])


@query("enrich_left", f"""WITH {fx.NATIONS}, {FIRST_PRICE}, {WIDE_SHIPS}
    SELECT n.*, o_totalprice, {", ".join(ADDED)} FROM nations n LEFT JOIN first_price USING (ISO_Code, Date) LEFT JOIN wide_ships USING (ISO_Code, Date)""")
def enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    """Prices and pivoted indicators join, four tables are skipped."""
    return enrichment(spark, sf)[0]


@query("enrich_report", f"""WITH {fx.NATIONS}, {FIRST_PRICE}, {WIDE_SHIPS}, k AS (SELECT DISTINCT ISO_Code, Date FROM nations)
    SELECT 'prices' AS name, 'joined' AS status, '' AS reason, 'o_totalprice' AS added, count(*) AS matched FROM first_price SEMI JOIN k USING (ISO_Code, Date)
    UNION ALL SELECT 'ships', 'joined', '', '{",".join(sorted(ADDED))}', count(*) FROM wide_ships SEMI JOIN k USING (ISO_Code, Date)
    UNION ALL SELECT * FROM (VALUES ('prices_again', 'skipped', 'no new columns', '', NULL), ('by_maker', 'skipped', 'broken down by manufacturer', '', NULL),
      ('undated', 'skipped', 'no date column', '', NULL), ('unplaced', 'skipped', 'no place column', '', NULL))""")
def enrich_report(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each table, and the matched keys of those that joined."""
    told = enrichment(spark, sf)[1].rows(spark)
    return told.withColumn("added", F.array_join(F.sort_array("added"), ","))


@query("gold_build", f"""WITH {fx.NATIONS}, {FIRST_PRICE}, {WIDE_SHIPS}
    SELECT n.*, o_totalprice, {", ".join(ADDED)} FROM nations n LEFT JOIN first_price USING (ISO_Code, Date) LEFT JOIN wide_ships USING (ISO_Code, Date)""")
def gold_build(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched panel without empty, duplicated and useless columns."""
    names = fx.nation_codes(spark, sf).select(F.col("n_name").alias("name"), F.col("code").alias("iso3"))
    master = fx.nations(spark, sf).withColumns({"Year": F.year("Date"), "nothing": F.lit(None).cast("double")})
    return G.build_gold(master, source_tables(spark, sf), names, ["o_orderkey", *SHIP_ORDER])[0]


@query("map_country", f"""WITH {fx.CHECKS} SELECT doc_id, country2, iso3 AS ISO_Code FROM checks LEFT JOIN check_dim ON name = country2""")
def map_country(spark: SparkSession, sf: str) -> DataFrame:
    """J2."""
    slim = fx.checks(spark, sf).select("doc_id", "country2")
    return J.map_country(slim, "country2", fx.check_dim(spark, sf))[0]


@query("unmapped_names", f"""WITH {fx.CHECKS} SELECT country2, count(*) AS n_rows FROM checks
    WHERE country2 NOT IN (SELECT name FROM check_dim WHERE iso3 IS NOT NULL) GROUP BY 1""")
def unmapped_names(spark: SparkSession, sf: str) -> DataFrame:
    """J2, the report."""
    return J.unmapped_names(fx.checks(spark, sf), "country2", fx.check_dim(spark, sf))


@query("mapping_coverage", f"WITH {fx.CHECKS} SELECT count(iso3) AS mapped, count(*) AS total FROM checks LEFT JOIN check_dim ON name = country2")
def mapping_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """J2, the counts."""
    mapped, _ = J.map_country(fx.checks(spark, sf), "country2", fx.check_dim(spark, sf))
    return J.mapping_coverage(mapped)


@query("with_continent", f"""WITH {fx.NATIONS} SELECT ISO_Code, Date, CASE WHEN ISO_Code < 'N20' THEN Continent ELSE 'Unknown' END AS Continent FROM nations""")
def with_continent(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension that lacks the last five nations."""
    regions = table(spark, sf, "region")
    known = fx.nation_codes(spark, sf).filter(F.col("code") < "N20").join(regions, F.col("r_regionkey") == F.col("n_regionkey"))
    dim = known.select(F.col("code").alias("iso3"), F.col("r_name").alias("continent"))
    return J.with_continent(fx.nations(spark, sf).select("ISO_Code", "Date"), dim)


@query("match_count", """SELECT count(*) AS matched FROM (SELECT DISTINCT l_shipdate::DATE AS Date FROM lineitem
    WHERE l_shipdate::DATE IN (SELECT o_orderdate::DATE FROM orders))""")
def match_count(spark: SparkSession, sf: str) -> DataFrame:
    """J4."""
    left = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("Date"))
    right = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("Date"))
    return J.match_count(left, right, ["Date"])


@query("week_join", round_sql(f"""WITH {fx.GOLD}, {fx.TRENDS}, {fx.DIS_WEEKLY} SELECT g.ISO_Code, g.Date, Confirmed, {", ".join(fx.DIS_COLS)} FROM gold g
    LEFT JOIN dis_weekly d ON d.ISO_Code = g.ISO_Code AND d.Date = date_trunc('week', g.Date)""", [c for c in fx.DIS_COLS if c != "disinfo_terms_active"]))
def week_join(spark: SparkSession, sf: str) -> DataFrame:
    """J5."""
    panel = fx.gold(spark, sf).select("ISO_Code", "Date", "Confirmed")
    return rounded(J.join_weekly(panel, fx.dis_weekly(spark, sf)))


@query("work_list", """WITH w AS (SELECT n_name AS geo, t.event_type AS term_id FROM nation, (SELECT DISTINCT event_type FROM events) t),
    done AS (SELECT DISTINCT n_name AS geo, event_type AS term_id FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey WHERE value > 300)
    SELECT geo || '_' || term_id AS query_key, geo, term_id FROM w ANTI JOIN done USING (geo, term_id)""")
def work_list(spark: SparkSession, sf: str) -> DataFrame:
    """What is done is found in the events."""
    events = table(spark, sf, "events").select("user_id", F.col("event_type").alias("term_id"), "value")
    homes = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey"))
    names = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("geo"))
    done = events.filter("value > 300").join(homes, "user_id").join(names, "n_nationkey").select("geo", "term_id").distinct()
    return J.work_list(names.select("geo"), events.select("term_id").distinct(), done).select("query_key", "geo", "term_id")


@query("localized_term", """SELECT doc_id, source AS term_id, lang,
    CASE lang WHEN 'en' THEN source WHEN 'fr' THEN source || ' (fr)' ELSE 'default ' || source END AS keyword FROM documents""")
def localized_term(spark: SparkSession, sf: str) -> DataFrame:
    """Terms are the sources, keywords exist for two languages."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("term_id"), "lang")
    names = docs.select("term_id").distinct()
    cells = F.array(
        F.struct(F.lit("en").alias("lang"), F.col("term_id").alias("keyword")),
        F.struct(F.lit("fr").alias("lang"), F.concat("term_id", F.lit(" (fr)")).alias("keyword")),
        F.struct(F.lit("default").alias("lang"), F.concat(F.lit("default "), "term_id").alias("keyword")),
    )
    terms = names.select("term_id", F.explode(cells).alias("c")).select("term_id", "c.lang", "c.keyword")
    return J.localized_term(docs, terms)


@query("subindices", round_sql(f"WITH {fx.TRENDS}, {fx.DIS_WEEKLY} SELECT * FROM dis_weekly", [c for c in fx.DIS_COLS if c != "disinfo_terms_active"]))
def subindices(spark: SparkSession, sf: str) -> DataFrame:
    """TR1 (and J6): index and sub-indices in one aggregate; a group without terms is null."""
    return rounded(fx.dis_weekly(spark, sf))


@query("proscience_index", round_sql(f"WITH {fx.TRENDS}, {fx.PRO_WEEKLY} SELECT * FROM pro_weekly", fx.PRO_COLS))
def proscience_index(spark: SparkSession, sf: str) -> DataFrame:
    """TR2."""
    return rounded(fx.pro_weekly(spark, sf))


@query("trust_ratio", round_sql(f"WITH {fx.MERGED} SELECT ISO_Code, Date, trust_ratio, trust_ratio_smooth, sentiment_balance FROM merged",
    ["trust_ratio", "trust_ratio_smooth", "sentiment_balance"]))
def trust_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """TR3."""
    return rounded(fx.merged(spark, sf).select("ISO_Code", "Date", "trust_ratio", "trust_ratio_smooth", "sentiment_balance"))


@query("trend_means", round_sql(f"WITH {fx.MERGED} SELECT avg(trust_ratio) AS trust_ratio_mean, avg(sentiment_balance) AS balance_mean FROM merged", ["trust_ratio_mean", "balance_mean"]))
def trend_means(spark: SparkSession, sf: str) -> DataFrame:
    """TR3, the means."""
    return rounded(TR.trend_means(fx.merged(spark, sf)))


@query("expand_factchecks", f"WITH {fx.CHECKS} SELECT * FROM expanded")
def expand_factchecks(spark: SparkSession, sf: str) -> DataFrame:
    """FC1: columns found by name."""
    return FC.expand_factchecks(fx.checks(spark, sf), fx.check_dim(spark, sf))


_FC_TOTALS = f"""{fx.CHECKS}, check_weekly AS (
  SELECT *, sum(factcheck_count) OVER (PARTITION BY ISO_Code ORDER BY _week ROWS UNBOUNDED PRECEDING)::BIGINT AS factcheck_cumulative
  FROM (SELECT ISO_Code, _week, count(*) AS factcheck_count, count(*) FILTER (WHERE category = 'other') AS fc_other
    FROM check_labelled GROUP BY 1, 2))"""


@query("cumulative_weekly", f"WITH {_FC_TOTALS} SELECT * FROM check_weekly")
def cumulative_weekly(spark: SparkSession, sf: str) -> DataFrame:
    """FC2: totals, the column of the rest, and the running total."""
    weekly = FC.weekly_factchecks(fx.expanded(spark, sf))
    return weekly.select("ISO_Code", "_week", "factcheck_count", "fc_other", "factcheck_cumulative")


@query("weekly_categories", f"WITH {fx.CHECKS} SELECT ISO_Code, _week, 'fc_' || category AS measure, count(*) AS n FROM check_labelled GROUP BY 1, 2, 3")
def weekly_categories(spark: SparkSession, sf: str) -> DataFrame:
    """FC2: every category column, week by week."""
    weekly = FC.weekly_factchecks(fx.expanded(spark, sf))
    names = FC.category_columns(weekly)
    return weekly.select("ISO_Code", "_week", *names).unpivot(["ISO_Code", "_week"], names, "measure", "n").filter("n > 0")


@query("category_columns", f"WITH {fx.CHECKS} SELECT 'fc_' || category AS measure, count(*) AS n FROM check_labelled GROUP BY 1")
def category_columns(spark: SparkSession, sf: str) -> DataFrame:
    """FC2: every category column, summed."""
    weekly = FC.weekly_factchecks(fx.expanded(spark, sf))
    names = FC.category_columns(weekly)
    return weekly.select(*names).unpivot([], names, "measure", "v").groupBy("measure").agg(F.sum("v").alias("n"))


def checked_nations(spark: SparkSession, sf: str) -> DataFrame:
    return FC.merge_factchecks(fx.nations(spark, sf), FC.weekly_factchecks(fx.expanded(spark, sf)))


_CHECKED = f"""{_FC_TOTALS}, {fx.NATIONS}, checked AS (
  SELECT n.*, factcheck_count, fc_other, factcheck_cumulative FROM nations n
    LEFT JOIN check_weekly c ON c.ISO_Code = n.ISO_Code AND c._week = date_trunc('week', n.Date))"""


@query("merge_factchecks", f"WITH {_CHECKED} SELECT * FROM checked")
def merge_factchecks(spark: SparkSession, sf: str) -> DataFrame:
    """FC3."""
    cols = ["ISO_Code", "Country", "Continent", "Date", "n", "n_closed", "factcheck_count", "fc_other", "factcheck_cumulative"]
    return checked_nations(spark, sf).select(*cols)


@query("factcheck_coverage", round_sql(f"WITH {_CHECKED} SELECT count(factcheck_count) AS matched, count(factcheck_count) * 100.0 / count(*) AS coverage_pct FROM checked", ["coverage_pct"]))
def factcheck_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """FC3, the share."""
    return rounded(FC.coverage(checked_nations(spark, sf)))


@query("factcheck_kpis", f"""WITH {fx.CHECKS}, {fx.NATIONS}, daily AS (
      SELECT n.ISO_Code, n.Date, c.category, c.k FROM nations n LEFT JOIN (SELECT ISO_Code, _week, category, count(*) AS k FROM check_labelled GROUP BY 1, 2, 3) c
        ON c.ISO_Code = n.ISO_Code AND c._week = date_trunc('week', n.Date)),
    by_cat AS (SELECT ISO_Code, 'fc_' || category AS cat, sum(k) AS s FROM daily WHERE category IS NOT NULL GROUP BY 1, 2),
    best AS (SELECT ISO_Code, cat AS top_category FROM by_cat
      QUALIFY row_number() OVER (PARTITION BY ISO_Code ORDER BY s DESC, cat) = 1),
    run AS (SELECT ISO_Code, _week, sum(count(*)) OVER (PARTITION BY ISO_Code ORDER BY _week ROWS UNBOUNDED PRECEDING) AS cum, count(*) AS f FROM check_clean GROUP BY 1, 2)
    SELECT n.ISO_Code, sum(f)::BIGINT AS sum_over_days, max(cum)::BIGINT AS cumulative_max, min(Date) FILTER (WHERE f > 0) AS first_date,
      max(Date) FILTER (WHERE f > 0) AS last_date, any_value(top_category) AS top_category
    FROM nations n LEFT JOIN run r ON r.ISO_Code = n.ISO_Code AND r._week = date_trunc('week', n.Date) LEFT JOIN best b ON b.ISO_Code = n.ISO_Code
    GROUP BY n.ISO_Code HAVING count(f) > 0""")
def factcheck_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """A15, V30."""
    return V.factcheck_row(checked_nations(spark, sf))


@query("triangulation", round_sql(f"""WITH {_CHECKED}, t AS (SELECT ISO_Code, Date, factcheck_count, n::DOUBLE AS disinfo_index FROM checked
      WHERE ISO_Code IN (SELECT ISO_Code FROM checked GROUP BY 1 HAVING count(factcheck_count) > 0 AND count(n) > 3)
        AND Date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'),
    c AS (SELECT ISO_Code, count(*) FILTER (WHERE factcheck_count IS NOT NULL) AS n,
      CASE WHEN stddev_pop(factcheck_count) FILTER (WHERE disinfo_index IS NOT NULL) < 1e-9 OR stddev_pop(disinfo_index) FILTER (WHERE factcheck_count IS NOT NULL) < 1e-9 THEN NULL
      ELSE corr(factcheck_count, disinfo_index) END AS r FROM t GROUP BY 1 HAVING count(*) > 5)
    SELECT ISO_Code, n, CASE WHEN n >= 6 AND NOT isnan(r) THEN r END AS r FROM c""", ["r"]))
def triangulation(spark: SparkSession, sf: str) -> DataFrame:
    """ST9, V31: fact-checks against order counts inside a window."""
    rows = checked_nations(spark, sf).withColumn("disinfo_index", F.col("n").cast("double"))
    return rounded(V.triangulation(rows, low="1997-01-01", high="1999-12-31")[1].select("ISO_Code", "n", "r"))


@query("windowed_corr", round_sql(f"""WITH {fx.PANEL}, t AS (SELECT New_Cases::DOUBLE AS a, daily_occupancy_hosp AS b FROM panel WHERE Date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')
    SELECT count(*) AS n, corr(a, b) AS r, CASE WHEN abs(corr(a, b)) > 0.7 THEN 'strong' WHEN abs(corr(a, b)) > 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
      CASE WHEN corr(a, b) > 0 THEN 'positive' ELSE 'negative' END AS direction FROM t WHERE a IS NOT NULL AND b IS NOT NULL""", ["r"]))
def windowed_corr(spark: SparkSession, sf: str) -> DataFrame:
    """ST9 over all entities."""
    return rounded(ST.triangulate(fx.panel(spark, sf), "New_Cases", "daily_occupancy_hosp", "2024-01-05", "2024-01-20"))


_SAFE = "CASE WHEN stddev_pop({x}) FILTER (WHERE {y} IS NOT NULL) >= 1e-9 AND stddev_pop({y}) FILTER (WHERE {x} IS NOT NULL) >= 1e-9 THEN corr({x}, {y}) END"


@query("safe_corr", round_sql(f"""WITH {fx.PANEL}, c AS (SELECT ISO_Code, count(*) FILTER (WHERE reproduction_rate IS NOT NULL AND c1m_school_closing IS NOT NULL) AS n,
      {_SAFE.format(x="reproduction_rate", y="c1m_school_closing")} AS r0 FROM panel GROUP BY 1), d AS (SELECT ISO_Code, n, CASE WHEN n >= 6 THEN r0 END AS r FROM c)
    SELECT *, CASE WHEN r IS NULL THEN NULL WHEN abs(r) > 0.7 THEN 'strong' WHEN abs(r) > 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
      CASE WHEN r IS NULL THEN NULL WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction FROM d""", ["r"]))
def safe_corr(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 per entity."""
    return rounded(ST.pearson(fx.panel(spark, sf), "reproduction_rate", "c1m_school_closing", ["ISO_Code"]))


_FAMILY = ("stringency_index", "containment_health_index", "stringency_index_vax", "stringency_index_nonvax", *V.POLICIES)


@query("corr_matrix", round_sql(f"WITH {fx.PANEL} " + " UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, {_SAFE.format(x=x, y=y)} AS r, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM panel"
    for x, y in combinations(_FAMILY, 2)), ["r"]))
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """ST2, V19 for the policy family over all entities."""
    return rounded(V.correlation_family(fx.panel(spark, sf), "policy"))


_FAMILY_E = ("daily_occupancy_icu", "daily_occupancy_hosp")


@query("corr_matrix_by_entity", round_sql(f"""WITH {fx.PANEL} SELECT ISO_Code, 'daily_occupancy_icu' AS x, 'daily_occupancy_hosp' AS y,
    {_SAFE.format(x=_FAMILY_E[0], y=_FAMILY_E[1])} AS r, count(*) FILTER (WHERE daily_occupancy_icu IS NOT NULL AND daily_occupancy_hosp IS NOT NULL) AS n
    FROM panel GROUP BY 1 HAVING count(coalesce(daily_occupancy_icu, daily_occupancy_hosp)) >= 6""", ["r"]))
def corr_matrix_by_entity(spark: SparkSession, sf: str) -> DataFrame:
    """ST2 per entity."""
    return rounded(V.correlation_family(fx.panel(spark, sf), "health", per_entity=True))


def family_sql(cols: Sequence[str], name: str) -> str:
    """Every pair of ``cols`` over the whole table ``name``."""
    return " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {_SAFE.format(x=x, y=y)} AS r, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM {name}"
        for x, y in combinations(cols, 2))


_INFODEMIC = ("disinfo_index", *V.NARRATIVES, "proscience_index", *V.INTENTS, "trust_ratio", "sentiment_balance")


@query("corr_matrix_infodemic", round_sql(f"WITH {fx.MERGED} {family_sql(_INFODEMIC, 'merged')}", ["r"]))
def corr_matrix_infodemic(spark: SparkSession, sf: str) -> DataFrame:
    """V19 for the infodemic family over all entities."""
    return rounded(V.correlation_family(fx.merged(spark, sf), "infodemic"))


_VACCINATION = ("people_fully_vaccinated_per_hundred", "people_vaccinated_per_hundred", "new_vaccinations_smoothed")


@query("corr_matrix_vaccination", round_sql(f"WITH {fx.PANEL} {family_sql(_VACCINATION, 'panel')}", ["r"]))
def corr_matrix_vaccination(spark: SparkSession, sf: str) -> DataFrame:
    """V19 for the vaccination columns that the panel has."""
    return rounded(V.correlation_family(fx.panel(spark, sf), "vaccination"))


@query("corr_matrix_factcheck", round_sql(f"""WITH {_CHECKED}, week_cells AS (
      SELECT ISO_Code, _week, 0 AS k, 'factcheck_count' AS col, factcheck_count::DOUBLE AS v FROM check_weekly
      UNION ALL SELECT ISO_Code, _week, 1, 'factcheck_cumulative', factcheck_cumulative::DOUBLE FROM check_weekly
      UNION ALL SELECT w.ISO_Code, w._week, 2, 'fc_' || t.category, count(l.category)::DOUBLE
        FROM check_weekly w CROSS JOIN (SELECT DISTINCT category FROM check_labelled) t
          LEFT JOIN check_labelled l ON l.ISO_Code = w.ISO_Code AND l._week = w._week AND l.category = t.category GROUP BY ALL),
    day_cells AS (SELECT n.ISO_Code, n.Date, k, col, v FROM nations n JOIN week_cells c ON c.ISO_Code = n.ISO_Code AND c._week = date_trunc('week', n.Date))
    SELECT a.col AS x, b.col AS y, CASE WHEN stddev_pop(a.v) >= 1e-9 AND stddev_pop(b.v) >= 1e-9 THEN corr(a.v, b.v) END AS r, count(*) AS n
    FROM day_cells a JOIN day_cells b ON a.ISO_Code = b.ISO_Code AND a.Date = b.Date AND (a.k < b.k OR a.k = b.k AND a.col < b.col)
    GROUP BY 1, 2 HAVING count(*) >= 6""", ["r"]))
def corr_matrix_factcheck(spark: SparkSession, sf: str) -> DataFrame:
    """V19 for the fact-check family: totals and every category column."""
    return rounded(V.correlation_family(checked_nations(spark, sf), "factcheck"))


_EXCESS = [c for c in V.EXCESS if c in fx.MEASURES]


@query("corr_matrix_excess", round_sql(f"""WITH {fx.PANEL}, pairs AS ({family_sql(_EXCESS, 'panel')}),
    filled AS (SELECT col FROM (SELECT {", ".join(f"count({c}) AS {c}" for c in _EXCESS)} FROM panel) UNPIVOT (n FOR col IN ({", ".join(_EXCESS)})) WHERE n > 3)
    SELECT * FROM pairs WHERE x IN (SELECT col FROM filled) AND y IN (SELECT col FROM filled)""", ["r"]))
def corr_matrix_excess(spark: SparkSession, sf: str) -> DataFrame:
    """V19 for the excess columns with more than three values."""
    return rounded(V.correlation_family(fx.panel(spark, sf), "excess"))


@query("ols", round_sql("""SELECT regr_count(l_extendedprice, l_quantity)::BIGINT AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
    regr_intercept(l_extendedprice, l_quantity) AS intercept, corr(l_extendedprice, l_quantity) ** 2 AS r2 FROM lineitem""", ["slope", "intercept", "r2"], 4))
def ols(spark: SparkSession, sf: str) -> DataFrame:
    """ST3."""
    return rounded(ST.ols(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), 4)


@query("explorer", round_sql(f"""WITH {fx.PANEL}, c AS (SELECT ISO_Code, regr_count(New_Cases_7d, stringency_index)::BIGINT AS n, regr_slope(New_Cases_7d, stringency_index) AS s,
      regr_intercept(New_Cases_7d, stringency_index) AS i, {_SAFE.format(x="stringency_index", y="New_Cases_7d")} AS r0 FROM panel GROUP BY 1)
    SELECT ISO_Code, n, CASE WHEN n >= 6 THEN s END AS slope, CASE WHEN n >= 6 THEN i END AS intercept, CASE WHEN n >= 6 THEN r0 ** 2 END AS r2,
      CASE WHEN n >= 6 THEN r0 END AS r, CASE WHEN n < 6 OR r0 IS NULL THEN NULL WHEN abs(r0) > 0.7 THEN 'strong' WHEN abs(r0) > 0.4 THEN 'moderate' ELSE 'weak' END AS strength,
      CASE WHEN n < 6 OR r0 IS NULL THEN NULL WHEN r0 > 0 THEN 'positive' ELSE 'negative' END AS direction FROM c""", ["slope", "intercept", "r2", "r"]))
def explorer(spark: SparkSession, sf: str) -> DataFrame:
    """V20."""
    return rounded(V.explorer_summary(fx.panel(spark, sf), "stringency_index", "New_Cases_7d"))


@query("explorer_points", round_sql(f"WITH {fx.PANEL} SELECT ISO_Code, Date, stringency_index, New_Cases_7d FROM panel WHERE stringency_index IS NOT NULL AND New_Cases_7d IS NOT NULL", ["stringency_index", "New_Cases_7d"]))
def explorer_points(spark: SparkSession, sf: str) -> DataFrame:
    """V20, the points."""
    return rounded(V.explorer_points(fx.panel(spark, sf), "stringency_index", "New_Cases_7d"))


@query("describe", round_sql("""SELECT count(value) AS count, avg(value) AS mean, median(value) AS median, stddev_samp(value) AS std, min(value) AS min, max(value) AS max FROM events""",
    ["mean", "median", "std", "min", "max"], 5))
def describe(spark: SparkSession, sf: str) -> DataFrame:
    """ST4 with an exact median."""
    return rounded(ST.describe_col(table(spark, sf, "events"), "value"), 5)


@query("describe_by_type", round_sql("""SELECT event_type, count(value) AS count, avg(value) AS mean, median(value) AS median, stddev_samp(value) AS std, min(value) AS min, max(value) AS max FROM events GROUP BY 1""",
    ["mean", "median", "std", "min", "max"], 5))
def describe_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """ST4 per group."""
    return rounded(ST.describe_col(table(spark, sf, "events"), "value", ["event_type"]), 5)


@query("exact_quantiles", round_sql("SELECT quantile_cont(o_totalprice, 0.1) AS q0, quantile_cont(o_totalprice, 0.5) AS q1, quantile_cont(o_totalprice, 0.99) AS q2 FROM orders", ["q0", "q1", "q2"], 4))
def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """ST4 and ST6: the shared quantile operator."""
    return rounded(ST.exact_quantiles(table(spark, sf, "orders"), "o_totalprice", [0.1, 0.5, 0.99]), 4)


_HIST = """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
    c AS (SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 50)) + 1, 50)::INTEGER AS bin, count(*) AS n FROM orders, b GROUP BY 1)
    SELECT g.bin::INTEGER AS bin, lo + (hi - lo) / 50 * (g.bin - 1) AS bin_low, lo + (hi - lo) / 50 * g.bin AS bin_high, coalesce(n, 0) AS n
    FROM b, (SELECT unnest(range(1, 51)) AS bin) g LEFT JOIN c ON c.bin = g.bin"""


@query("histogram_50", round_sql(_HIST, ["bin_low", "bin_high"], 4))
def histogram_50(spark: SparkSession, sf: str) -> DataFrame:
    """ST5, V21."""
    return rounded(ST.histogram(table(spark, sf, "orders"), "o_totalprice"), 4)


_BOX = """WITH q AS (SELECT {g} quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3 FROM {t} {by}),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence FROM q)
    SELECT {g} q1, median, q3, low_fence, high_fence, min({v}) FILTER (WHERE {v} BETWEEN low_fence AND high_fence) AS low_whisker,
      max({v}) FILTER (WHERE {v} BETWEEN low_fence AND high_fence) AS high_whisker, count(*) FILTER (WHERE {v} NOT BETWEEN low_fence AND high_fence) AS n_outliers
    FROM {t} JOIN f {on} GROUP BY ALL"""
_BOX_COLS = ["q1", "median", "q3", "low_fence", "high_fence", "low_whisker", "high_whisker"]


@query("box_stats", round_sql(_BOX.format(g="", v="value", t="events", by="", on="ON true"), _BOX_COLS, 5))
def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    """ST6, V21."""
    return rounded(ST.box_stats(table(spark, sf, "events"), "value"), 5)


@query("box_stats_by_type", round_sql(_BOX.format(g="event_type,", v="value", t="events", by="GROUP BY event_type", on="USING (event_type)"), _BOX_COLS, 5))
def box_stats_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """ST6 per group."""
    return rounded(ST.box_stats(table(spark, sf, "events"), "value", ["event_type"]), 5)


@query("box_outliers", """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id, value FROM events, q WHERE value NOT BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def box_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """ST6, the points outside."""
    return ST.box_outliers(table(spark, sf, "events"), "value", keep=["event_id"])


# Events without a type, and values that are no number in the first hour of the day; SQL leaves these out.
_GAPS = """(SELECT coalesce(nullif(event_type, 'view'), '-') AS k, CASE WHEN hour(ts) <> 0 THEN value END AS value FROM events)"""


def gap_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select(
        F.nullif("event_type", F.lit("view")).alias("k"), F.when(F.hour("ts") == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )


def gap_named(df: DataFrame) -> DataFrame:
    return rounded(df.withColumn("k", F.coalesce("k", F.lit("-"))), 4)


@query("describe_gaps", round_sql(f"""SELECT k, count(value) AS count, avg(value) AS mean, median(value) AS median, stddev_samp(value) AS std, min(value) AS min, max(value) AS max FROM {_GAPS} GROUP BY 1""",
    ["mean", "median", "std", "min", "max"], 4))
def describe_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """ST4 with a null group and NaN."""
    return gap_named(ST.describe_col(gap_events(spark, sf), "value", ["k"]))


@query("histogram_gaps", round_sql(f"""WITH e AS (SELECT * FROM {_GAPS} WHERE value IS NOT NULL), b AS (SELECT k, min(value) AS lo, max(value) AS hi FROM e GROUP BY 1),
    c AS (SELECT k, least(floor((value - lo) / ((hi - lo) / 10)) + 1, 10)::INTEGER AS bin, count(*) AS n FROM e JOIN b USING (k) GROUP BY 1, 2)
    SELECT b.k, g.bin::INTEGER AS bin, lo + (hi - lo) / 10 * (g.bin - 1) AS bin_low, lo + (hi - lo) / 10 * g.bin AS bin_high, coalesce(n, 0) AS n
    FROM b CROSS JOIN (SELECT unnest(range(1, 11)) AS bin) g LEFT JOIN c ON c.bin = g.bin AND c.k = b.k""", ["bin_low", "bin_high"], 4))
def histogram_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """ST5 with a null group and NaN."""
    return gap_named(ST.histogram(gap_events(spark, sf), "value", 10, ["k"]))


@query("box_gaps", round_sql(_BOX.format(g="k,", v="value", t=f"(SELECT * FROM {_GAPS} WHERE value IS NOT NULL)", by="GROUP BY k", on="USING (k)"), _BOX_COLS, 4))
def box_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """ST6 with a null group and NaN."""
    return gap_named(ST.box_stats(gap_events(spark, sf), "value", ["k"]))


@query("usable_numeric", round_sql("""SELECT * FROM (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_linenumber']) AS "column",
    unnest([stddev_samp(l_quantity), stddev_samp(l_discount), stddev_samp(l_tax), stddev_samp(l_linenumber)]) AS std,
    unnest([count(l_quantity), count(l_discount), count(l_tax), count(l_linenumber)]) AS n FROM lineitem)""", ["std"]))
def usable_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """ST7: constants and text are left out."""
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_returnflag", F.lit(1.0).alias("flat"), F.lit(2020).alias("Year"))
    return rounded(ST.usable_numeric(lines))


_PAIRS = (("disinfo_index", "people_vaccinated_per_hundred"), ("trust_ratio", "people_fully_vaccinated_per_hundred"))


def _grid_sql(x: str, y: str) -> str:
    return f"""SELECT ISO_Code, '{x}' AS x, '{y}' AS y, n, CASE WHEN n >= 6 THEN r END AS r, CASE WHEN n >= 6 THEN s END AS slope, CASE WHEN n >= 6 THEN i END AS intercept
    FROM (SELECT ISO_Code, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n, {_SAFE.format(x=x, y=y)} AS r,
      regr_slope({y}, {x}) AS s, regr_intercept({y}, {x}) AS i FROM merged GROUP BY 1)"""


@query("outcome_grid", round_sql(f"WITH {fx.MERGED} " + " UNION ALL ".join(_grid_sql(x, y) for x, y in _PAIRS), ["r", "slope", "intercept"], 4))
def outcome_grid(spark: SparkSession, sf: str) -> DataFrame:
    """ST8, V28."""
    return rounded(V.outcome_grid(fx.merged(spark, sf), pairs=_PAIRS), 4)


@query("infodemic_kpis", round_sql(f"""WITH {fx.MERGED}, k AS (SELECT ISO_Code, avg(disinfo_index) AS disinfo_mean, avg(proscience_index) AS proscience_mean, avg(trust_ratio) AS trust_ratio_mean,
      avg(sentiment_balance) AS balance_mean, avg(disinfo_terms_active) AS terms_active_mean FROM merged GROUP BY 1)
    SELECT *, CASE WHEN trust_ratio_mean > 1 THEN 'science' WHEN trust_ratio_mean IS NOT NULL THEN 'disinformation' END AS trust_class,
      CASE WHEN balance_mean > 0 THEN 'science' WHEN balance_mean IS NOT NULL THEN 'disinformation' END AS balance_class FROM k""",
    ["disinfo_mean", "proscience_mean", "trust_ratio_mean", "balance_mean", "terms_active_mean"]))
def infodemic_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """A14, V22."""
    return rounded(V.infodemic_row(fx.merged(spark, sf)))


def _guard(cols: tuple, k: int) -> str:
    return "ISO_Code IN (SELECT ISO_Code FROM merged GROUP BY 1 HAVING " + " AND ".join(f"count({c}) > {k}" for c in cols) + ")"


@query("trust_series", round_sql(f"WITH {fx.MERGED} SELECT ISO_Code, Date, trust_ratio_smooth, trust_ratio_smooth > 1 AS science_leads FROM merged WHERE {_guard(('trust_ratio_smooth',), 3)}", ["trust_ratio_smooth"]))
def trust_series(spark: SparkSession, sf: str) -> DataFrame:
    """V23."""
    return rounded(V.trust_series(fx.merged(spark, sf)))


@query("disinfo_vs_science", round_sql(f"""WITH {fx.MERGED} SELECT Date, ISO_Code, disinfo_index, proscience_index,
    CASE Date WHEN DATE '2024-01-10' THEN 'first' WHEN DATE '2024-01-20' THEN 'second' END AS event FROM merged WHERE {_guard(('disinfo_index', 'proscience_index'), 3)}""",
    ["disinfo_index", "proscience_index"]))
def disinfo_vs_science(spark: SparkSession, sf: str) -> DataFrame:
    """V24 with events inside the range of the data."""
    from paneloom.dims import event_dim

    events = event_dim(spark, [("2024-01-10", "first"), ("2024-01-20", "second")])
    return rounded(V.disinfo_vs_science(fx.merged(spark, sf), events=events))


def _stack_sql(cols: tuple, guard: str) -> str:
    shown = {c: f"(count({c}) OVER (PARTITION BY ISO_Code)) > 3" for c in cols}
    flags = ", ".join(f"{s} AS s_{c}" for c, s in shown.items())
    parts = []
    for i, c in enumerate(cols):
        below = " + ".join(f"CASE WHEN s_{b} THEN coalesce({b}, 0) ELSE 0 END" for b in cols[: i + 1])
        parts.append(f"SELECT ISO_Code, Date, '{c}' AS measure, {c} AS value, {below} AS stacked FROM flagged WHERE s_{c} AND {c} IS NOT NULL")
    return f"WITH {fx.MERGED}, flagged AS (SELECT *, {flags} FROM merged WHERE {_guard((guard,), 3)}) " + " UNION ALL ".join(parts)


@query("narratives", round_sql(_stack_sql(V.NARRATIVES, "disinfo_index"), ["value", "stacked"]))
def narratives(spark: SparkSession, sf: str) -> DataFrame:
    """V25."""
    return rounded(V.narratives(fx.merged(spark, sf)))


@query("intents", round_sql(_stack_sql(V.INTENTS, "proscience_index"), ["value", "stacked"]))
def intents(spark: SparkSession, sf: str) -> DataFrame:
    """V26."""
    return rounded(V.intents(fx.merged(spark, sf)))


@query("disinfo_vs_vaccination", round_sql(f"WITH {fx.MERGED} SELECT ISO_Code, Date, disinfo_index, people_fully_vaccinated_per_hundred FROM merged WHERE {_guard(('disinfo_index',), 3)}", ["disinfo_index"]))
def disinfo_vs_vaccination(spark: SparkSession, sf: str) -> DataFrame:
    """V27."""
    return rounded(V.disinfo_vs_vaccination(fx.merged(spark, sf)))


@query("disinfo_vs_cases", round_sql(f"WITH {fx.MERGED} SELECT ISO_Code, Date, disinfo_index, New_Cases_7d AS cases FROM merged WHERE {_guard(('disinfo_index',), 3)}", ["disinfo_index", "cases"]))
def disinfo_vs_cases(spark: SparkSession, sf: str) -> DataFrame:
    """V29."""
    return rounded(V.disinfo_vs_cases(fx.merged(spark, sf)))
