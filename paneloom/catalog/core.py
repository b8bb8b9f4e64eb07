"""Sources, schema operators, filters, scalars and quality reports."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from paneloom.catalog import fixtures as fx
from paneloom.catalog.base import query, round_sql, rounded, table
from paneloom.functions import classes, dates, numeric, records, text
from paneloom.operators import filters, joins, ordering, quality, schema, windows
from paneloom.session import scratch_path
from paneloom.sources import readers, writers


@query(
    "csv_round_trip",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem",
)
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK1 then SRC1 and SRC2: header CSV out, text back in, typed late."""
    path = scratch_path(spark, "csv")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", dates.format_day("l_shipdate").alias("l_shipdate")
    )
    writers.write_csv(rows, path)
    back = readers.read_csv_table(spark, path)
    return back.select(
        F.col("l_orderkey").try_cast("long").alias("l_orderkey"),
        F.col("l_linenumber").try_cast("int").alias("l_linenumber"),
        F.col("l_quantity").try_cast("double").alias("l_quantity"),
        "l_returnflag",
        "l_shipdate",
    )


@query("csv_inferred", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2."""
    path = scratch_path(spark, "csv-inferred")
    writers.write_csv(table(spark, sf, "nation"), path)
    return readers.read_csv_table(spark, path, infer=True)


@query(
    "landing_tables",
    "SELECT 'customer.csv' AS name, count(*) AS n FROM customer UNION ALL SELECT 'supplier.csv', count(*) FROM supplier",
)
def landing_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SRC3 and SRC4: a landing folder, absent tables skipped, each table tagged."""
    folder = scratch_path(spark, "landing")
    for name in ("customer", "supplier"):
        writers.write_csv(table(spark, sf, name), f"{folder}/{name}.csv")
    tables = readers.read_landing(spark, folder, ["customer", "absent", "supplier"])
    tagged = [readers.tag(t.select(F.lit(1).alias("one")), name=f"{n}.csv") for n, t in tables.items()]
    return ordering.union_all(tagged).groupBy("name").agg(F.count("one").alias("n"))


@query(
    "gold_round_trip",
    f"WITH {fx.NATIONS} SELECT ISO_Code, Country, Continent, Date, n, n_closed, NULL::DOUBLE AS note FROM nations",
)
def gold_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2 and SRC5: text columns other than the names become double, ranges sorted by key and day."""
    path = scratch_path(spark, "gold")
    panel = fx.nations(spark, sf).withColumn("note", F.concat(F.lit("row of "), F.col("ISO_Code")))
    writers.write_gold(panel, path)
    return readers.read_table(spark, path)


@query(
    "full_refresh",
    "SELECT event_id, CASE WHEN event_type <> 'error' AND event_type <> 'click' THEN value END AS value FROM events",
)
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """SNK3 with P4: NaN and infinities arrive as null."""
    path = scratch_path(spark, "refresh")
    kind = F.col("event_type")
    dirty = F.when(kind == "error", F.lit(float("nan"))).when(kind == "click", F.lit(float("-inf"))).otherwise(F.col("value"))
    writers.full_refresh(table(spark, sf, "events").select("event_id", dirty.alias("value")), path)
    return readers.read_table(spark, path)


@query("read_key", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def read_key(spark: SparkSession, sf: str) -> DataFrame:
    """SRC6: the equality is pushed to the scan."""
    rows = readers.read_key(table(spark, sf, "orders"), "o_orderpriority", "1-URGENT", "o_orderkey")
    return rows.select("o_orderkey", "o_totalprice")


@query(
    "detect_fields",
    f"WITH {fx.NATIONS} SELECT 'Date' AS date, 'ISO_Code' AS iso, 'date' AS date_type, count(*) AS n FROM nations",
)
def detect_fields(spark: SparkSession, sf: str) -> DataFrame:
    """SRC7: read off the schema."""
    panel = fx.nations(spark, sf)
    found = readers.detect_fields(panel)
    return panel.agg(*[F.lit(v).alias(k) for k, v in found.items()], F.count(F.lit(1)).alias("n"))


@query(
    "assert_unique",
    "SELECT o_custkey, o_orderdate::DATE AS day, count(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1",
)
def assert_unique(spark: SparkSession, sf: str) -> DataFrame:
    """SNK6."""
    keyed = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return writers.assert_unique(keyed, ["o_custkey", "day"])


@query("publish_messages", "SELECT ts::DATE AS day, count(DISTINCT user_id) AS n FROM events GROUP BY 1")
def publish_messages(spark: SparkSession, sf: str) -> DataFrame:
    """SNK4: the panel as JSON messages, one folder per day, counted after reading them back."""
    path = scratch_path(spark, "messages")
    writers.publish(fx.gold(spark, sf), path=path)
    back = spark.read.text(path).withColumn("r", records.parse_json("value"))
    return back.filter(F.col("r")["Date"] == F.col("day").cast("string")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("normalize_columns", "SELECT o_orderkey AS ISO_Code, o_orderdate::DATE AS Date, o_totalprice AS Confirmed FROM orders")
def normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Aliases, and the canonical value first where both spellings exist."""
    orders = table(spark, sf, "orders")
    return schema.normalize_columns(
        orders.select(
            F.col("o_orderkey").alias("iso_code"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("confirmed")
        )
    )


@query(
    "pick_columns",
    "SELECT l_shipdate::DATE AS Date, count(*) AS n FROM lineitem GROUP BY 1",
)
def pick_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The date column found by name, else by trying to read values."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("string").alias("shipped"))
    assert schema.pick_column(lines, schema.DATE_CANDIDATES) is None
    found = schema.sniff_column(lines, "date", dates.parse_day)
    return lines.groupBy(dates.parse_day(found).alias("Date")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "pick_low_cardinality",
    "SELECT lang AS category, count(*) AS n FROM documents GROUP BY 1",
)
def pick_low_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    """The wide column is passed over."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("class"), F.col("lang").alias("category"))
    found = schema.pick_low_cardinality(docs, ["class", "category"], 20)
    return docs.groupBy(F.col(found).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "pick_populated",
    f"WITH {fx.GOLD} SELECT 'people_vaccinated_per_hundred' AS measure, count(people_vaccinated_per_hundred) AS n FROM gold",
)
def pick_populated(spark: SparkSession, sf: str) -> DataFrame:
    """P2d."""
    gold = fx.gold(spark, sf).withColumn("nothing", F.lit(None).cast("double"))
    found = schema.pick_populated(gold, ["absent", "nothing", "people_vaccinated_per_hundred"], 5)
    return gold.agg(F.lit(found).alias("measure"), F.count(found).alias("n"))


@query(
    "to_double",
    "SELECT o_orderkey, TRY_CAST(o_orderstatus AS DOUBLE) AS o_orderstatus, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority FROM orders",
)
def to_double(spark: SparkSession, sf: str) -> DataFrame:
    """One projection of lenient casts."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("priority")
    )
    return schema.to_double(orders, except_=["o_orderkey"])


@query("prune_columns", "SELECT o_orderkey, o_totalprice AS stringency_index FROM orders")
def prune_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicated and useless columns go, the name they free is taken."""
    from paneloom.plans.gold import prune

    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("stringency_index_weighted_average"),
        F.col("o_custkey").alias("stringency_index"),
        F.lit(2020).alias("Year"),
    )
    return prune(orders)[0]


@query("drop_derived", "SELECT o_orderkey FROM orders")
def drop_derived(spark: SparkSession, sf: str) -> DataFrame:
    """P7."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("fc_true"), F.lit(2).alias("trust_ratio"))
    return schema.drop_derived(orders, ["trust_ratio"], ["fc_", "factcheck_"])


@query("drop_empty_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def drop_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    """P8."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).cast("double").alias("nothing"))
    return schema.drop_empty_columns(orders)


@query(
    "columns_like",
    f"WITH {fx.GOLD} SELECT ISO_Code, Date, people_vaccinated_per_hundred, people_fully_vaccinated_per_hundred, c1m_school_closing FROM gold",
)
def columns_like(spark: SparkSession, sf: str) -> DataFrame:
    """P9."""
    gold = fx.gold(spark, sf)
    return gold.select("ISO_Code", "Date", *schema.columns_like(gold, ["_per_hundred"], ["c1m_"]))


@query(
    "with_default",
    f"WITH {fx.GOLD} SELECT ISO_Code, Date, coalesce(people_vaccinated_per_hundred, excess_mortality, 0) AS New_Confirmed FROM gold",
)
def with_default(spark: SparkSession, sf: str) -> DataFrame:
    """P10."""
    filled = schema.with_default(
        fx.gold(spark, sf), "New_Confirmed", "people_vaccinated_per_hundred", "excess_mortality", value=0.0
    )
    return filled.select("ISO_Code", "Date", "New_Confirmed")


@query(
    "row_mean",
    round_sql(
        f"""WITH {fx.GOLD} SELECT ISO_Code, Date, CASE WHEN stringency_index_vax IS NULL THEN stringency_index_nonvax
        WHEN stringency_index_nonvax IS NULL THEN stringency_index_vax
        ELSE (stringency_index_vax + stringency_index_nonvax) / 2 END AS stringency_index FROM gold""",
        ["stringency_index"],
    ),
)
def row_mean(spark: SparkSession, sf: str) -> DataFrame:
    """P11."""
    mean = numeric.row_mean(["stringency_index_vax", "stringency_index_nonvax"])
    return rounded(fx.gold(spark, sf).select("ISO_Code", "Date", mean.alias("stringency_index")))


@query(
    "unpivot_countries",
    f"""WITH {fx.CHECKS} SELECT doc_id, 'country1' AS source, country1 AS value FROM checks
    UNION ALL SELECT doc_id, 'country2', country2 FROM checks""",
)
def unpivot_countries(spark: SparkSession, sf: str) -> DataFrame:
    """P12."""
    slim = fx.checks(spark, sf).select("doc_id", "country1", "country2")
    return schema.explode_columns(slim, ["country1", "country2"])


_FIRST = """
ships AS (
  SELECT 'N' || lpad(s_nationkey::VARCHAR, 2, '0') AS ISO_Code, l_shipdate::DATE AS Date,
    l_returnflag || ' ' || l_linestatus AS indicator, l_quantity AS value, l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
firsts AS (
  SELECT ISO_Code, Date, indicator, arg_min(value, (l_orderkey, l_linenumber, l_partkey, value)) AS value
  FROM ships GROUP BY 1, 2, 3)"""

INDICATORS = ("A F", "A O", "N F", "N O", "R F", "R O")
SHIP_ORDER = ["l_orderkey", "l_linenumber", "l_partkey"]


def ships(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a long indicator table keyed by supplier nation and ship date."""
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("Date"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("indicator"), F.col("l_quantity").alias("value"),
    )
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    codes = fx.nation_codes(spark, sf).select(F.col("n_nationkey").alias("s_nationkey"), F.col("code").alias("ISO_Code"))
    return lines.join(suppliers, "l_suppkey").join(codes, "s_nationkey").drop("l_suppkey", "s_nationkey")


@query(
    "pivot_first",
    f"WITH {_FIRST} SELECT ISO_Code, Date, "
    + ", ".join(f"max(value) FILTER (WHERE indicator = '{i}') AS {i.replace(' ', '_')}" for i in INDICATORS)
    + " FROM firsts GROUP BY 1, 2",
)
def pivot_first(spark: SparkSession, sf: str) -> DataFrame:
    """The indicator names are found in the data."""
    return schema.pivot_first(ships(spark, sf), ["ISO_Code", "Date"], "indicator", "value", SHIP_ORDER)


@query(
    "open_cells",
    f"""WITH {fx.NATIONS}, sold AS (
      SELECT 'N' || lpad(s_nationkey::VARCHAR, 2, '0') AS ISO_Code, l_shipdate::DATE AS Date,
        replace(trim(p_name), ' ', '_') || '_' || p_partkey AS indicator, l_quantity AS value, l_orderkey, l_linenumber
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
    SELECT ISO_Code, Date, indicator, arg_min(value, (l_orderkey, l_linenumber, value))::DOUBLE AS value
    FROM sold SEMI JOIN nations USING (ISO_Code, Date) GROUP BY 1, 2, 3""",
)
def open_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A name for every row of the parts table, so cells stay rows and no name reaches the driver."""
    named = F.concat_ws(" ", "p_name", "p_partkey").alias("indicator")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), named)
    sold = ships(spark, sf).drop("indicator").join(parts, "l_partkey")
    return joins.enrich_cells(fx.nations(spark, sf), sold, "indicator", "value", ["l_orderkey", "l_linenumber"])


@query(
    "pivot_count",
    """SELECT source, count(*) FILTER (WHERE lang = 'de') AS fc_de, count(*) FILTER (WHERE lang = 'en') AS fc_en,
    count(*) FILTER (WHERE lang = 'es') AS fc_es, count(*) FILTER (WHERE lang = 'fr') AS fc_fr FROM documents GROUP BY 1""",
)
def pivot_count(spark: SparkSession, sf: str) -> DataFrame:
    """P14 with T5 names."""
    docs = table(spark, sf, "documents")
    langs = schema.category_values(docs, "lang")
    return schema.pivot_count(docs, ["source"], "lang", dict(zip(langs, text.unique_names(langs))))


@query(
    "display_labels",
    f"""WITH {fx.GOLD}, long AS (
      SELECT unnest(['c1m_school_closing', 'c8ev_international_travel_controls', 'h7_vaccination_policy']) AS name,
        unnest([c1m_school_closing, c8ev_international_travel_controls, h7_vaccination_policy]) AS v FROM gold)
    SELECT CASE name WHEN 'c1m_school_closing' THEN 'School Closing' WHEN 'h7_vaccination_policy' THEN 'Vaccination Policy'
      ELSE 'International Travel Cont' END AS label, count(v) AS n FROM long GROUP BY 1""",
)
def display_labels(spark: SparkSession, sf: str) -> DataFrame:
    """P15."""
    names = ["c1m_school_closing", "c8ev_international_travel_controls", "h7_vaccination_policy"]
    long = fx.gold(spark, sf).select(*names).unpivot([], names, "name", "v")
    return long.groupBy(text.label_expr("name", 25).alias("label")).agg(F.count("v").alias("n"))


@query("valid_iso", "SELECT o_orderkey, substr(o_orderpriority, 3) AS ISO_Code FROM orders WHERE length(substr(o_orderpriority, 3)) = 3")
def valid_iso(spark: SparkSession, sf: str) -> DataFrame:
    """F1."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.expr("substr(o_orderpriority, 3)").alias("ISO_Code"))
    return filters.valid_iso(orders)


@query("exclude_prefix", "SELECT p_partkey, p_brand FROM part WHERE NOT starts_with(p_brand, 'Brand#1')")
def exclude_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """F2."""
    return filters.exclude_prefix(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", "Brand#1")


@query(
    "valid_day",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS Date FROM orders WHERE o_orderstatus <> 'P'""",
)
def valid_day(spark: SparkSession, sf: str) -> DataFrame:
    """the day inside a text; text without one goes."""
    stamp = F.concat(F.lit("at "), F.col("o_orderdate").cast("string"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "soon").otherwise(stamp).alias("Date"))
    return filters.valid_day(orders)


@query(
    "drop_null",
    f"""WITH {fx.GOLD} SELECT 'any' AS how, count(*) AS n FROM gold WHERE c1m_school_closing IS NOT NULL AND c2m_workplace_closing IS NOT NULL
    UNION ALL SELECT 'all', count(*) FROM gold WHERE c1m_school_closing IS NOT NULL OR c2m_workplace_closing IS NOT NULL""",
)
def drop_null(spark: SparkSession, sf: str) -> DataFrame:
    """F4."""
    gold = fx.gold(spark, sf)
    cols = ["c1m_school_closing", "c2m_workplace_closing"]
    parts = [filters.drop_null(gold, cols, how).agg(F.count(F.lit(1)).alias("n")).select(F.lit(how).alias("how"), "n") for how in ("any", "all")]
    return ordering.union_all(parts)


@query(
    "date_cuts",
    """SELECT 'between' AS part, count(*) AS n FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
    UNION ALL SELECT 'before', count(*) FROM orders WHERE o_orderdate::DATE < DATE '1998-01-01'
    UNION ALL SELECT 'since', count(*) FROM orders WHERE o_orderdate::DATE >= DATE '1998-01-01'""",
)
def date_cuts(spark: SparkSession, sf: str) -> DataFrame:
    """F5 and F6."""
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("Date"))
    old, new = filters.split_at(orders, "1998-01-01")
    parts = {"between": filters.between_dates(orders, "1997-01-01", "1998-12-31"), "before": old, "since": new}
    return ordering.union_all([d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("part"), "n") for k, d in parts.items()])


@query("entity_slice", f"WITH {fx.NATIONS} SELECT Date, n FROM nations WHERE ISO_Code = 'N07'")
def entity_slice(spark: SparkSession, sf: str) -> DataFrame:
    """one entity's page."""
    return filters.for_key(fx.nations(spark, sf), "N07").select("Date", "n")


@query("else_other", "SELECT CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'other' END AS lang, count(*) AS n FROM documents GROUP BY 1")
def else_other(spark: SparkSession, sf: str) -> DataFrame:
    """F8."""
    label = filters.else_other(F.col("lang"), ["en", "fr"])
    return table(spark, sf, "documents").groupBy(label.alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@query("count_present", f"WITH {fx.GOLD} SELECT count(c1m_school_closing) AS n_present FROM gold")
def count_present(spark: SparkSession, sf: str) -> DataFrame:
    """F11."""
    return filters.count_present(fx.gold(spark, sf), "c1m_school_closing")


@query("not_blank", "SELECT turn, count(*) AS n FROM conversations WHERE text IS NOT NULL AND trim(text) <> '' GROUP BY 1")
def not_blank(spark: SparkSession, sf: str) -> DataFrame:
    """F12."""
    return table(spark, sf, "conversations").filter(filters.not_blank(F.col("text"))).groupBy("turn").agg(F.count(F.lit(1)).alias("n"))


@query(
    "day_functions",
    """SELECT o_orderkey, o_orderdate::DATE AS day, strftime(o_orderdate, '%Y-%m-%d') AS day_text,
    date_trunc('week', o_orderdate)::DATE AS week, strftime(o_orderdate, '%Y-%m') AS month,
    (DATE '2001-12-31' - o_orderdate::DATE)::INTEGER AS days_left, make_date(year(o_orderdate)::INTEGER, 1, 1) AS year_day FROM orders""",
)
def day_functions(spark: SparkSession, sf: str) -> DataFrame:
    """SC1-SC4, SC6 on dates spelled in four ways."""
    d = F.col("o_orderdate")
    style = F.col("o_orderstatus")
    spelled = (
        F.when(style == "O", F.date_format(d, "MM/dd/yyyy"))
        .when(style == "F", F.date_format(d, "dd MMM yyyy"))
        .otherwise(F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", dates.parse_day(spelled).alias("day"))
    return orders.select(
        "o_orderkey",
        "day",
        dates.format_day("day").alias("day_text"),
        dates.week_start("day").alias("week"),
        dates.year_month("day").alias("month"),
        dates.day_lag("day", F.lit("2001-12-31").cast("date")).alias("days_left"),
        dates.parse_year(F.year("day")).alias("year_day"),
    )


@query("stamped_events", "SELECT event_type, count(*) AS n, 1::BIGINT AS n_instants, true AS by_the_clock FROM events GROUP BY 1")
def stamped_events(spark: SparkSession, sf: str) -> DataFrame:
    """SC15: all events of a run get one instant, which is the driver's within a day's tolerance of clocks and waiting."""
    begun = int(time.time())
    stamped = table(spark, sf, "events").select("event_type", dates.utc_now().alias("received_at"))
    off = F.max(F.unix_seconds("received_at")) - begun
    return stamped.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("received_at").alias("n_instants"), off.between(-60, 86_400).alias("by_the_clock")
    )


@query("floor_second", "SELECT date_trunc('second', ts) AS second, count(*) AS n FROM events GROUP BY 1")
def floor_second(spark: SparkSession, sf: str) -> DataFrame:
    """SC5."""
    return table(spark, sf, "events").groupBy(dates.floor_second("ts").alias("second")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "numeric_functions",
    round_sql(
        f"""WITH {fx.GOLD} SELECT ISO_Code, Date,
        CASE WHEN estimated_daily_excess_deaths IS NOT NULL THEN greatest(estimated_daily_excess_deaths, 0) END AS clipped,
        CASE WHEN excess_mortality IS NOT NULL THEN log10(greatest(excess_mortality, 1)) END AS logged,
        excess_mortality / (reproduction_rate + 1) AS ratio, excess_mortality - reproduction_rate AS balance FROM gold""",
        ["clipped", "logged", "ratio", "balance"],
    ),
)
def numeric_functions(spark: SparkSession, sf: str) -> DataFrame:
    """SC9 and SC10."""
    return rounded(
        fx.gold(spark, sf).select(
            "ISO_Code",
            "Date",
            numeric.clip_low(F.col("estimated_daily_excess_deaths")).alias("clipped"),
            numeric.log10_floor1(F.col("excess_mortality")).alias("logged"),
            numeric.trust_ratio("excess_mortality", "reproduction_rate").alias("ratio"),
            numeric.balance("excess_mortality", "reproduction_rate").alias("balance"),
        )
    )


@query("json_fields", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    """SC11 both ways: the object is decoded, encoded again and decoded once more."""
    decoded = table(spark, sf, "events").select("event_id", records.parse_json("props").alias("m"))
    again = decoded.select("event_id", records.parse_json(F.to_json("m")).alias("m"))
    return again.select("event_id", F.col("m")["k"].alias("k"), F.try_element_at("m", F.lit("absent")).alias("absent"))


@query(
    "threshold_classes",
    """SELECT o_orderkey, CASE WHEN o_totalprice / 10000 < 5 THEN 'OK' WHEN o_totalprice / 10000 < 30 THEN 'WARN' ELSE 'HIGH' END AS quality,
    CASE WHEN abs(o_totalprice / 500000) > 0.7 THEN 'strong positive' WHEN abs(o_totalprice / 500000) > 0.4 THEN 'moderate positive'
      ELSE 'weak positive' END AS corr FROM orders""",
)
def threshold_classes(spark: SparkSession, sf: str) -> DataFrame:
    """SC12 and SC13."""
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", classes.quality_class(price / 10000).alias("quality"), classes.corr_class(price / 500000).alias("corr")
    )


@query(
    "path_edges",
    """WITH steps AS (SELECT conv_id, role AS src, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS dst FROM conversations)
    SELECT src, dst, count(*) AS n FROM steps WHERE dst IS NOT NULL GROUP BY 1, 2""",
)
def path_edges(spark: SparkSession, sf: str) -> DataFrame:
    """SC14: the turns of a conversation as a path."""
    return windows.path_steps(table(spark, sf, "conversations"), "conv_id", ["turn"], "role")


@query("sort_panel", f"WITH {fx.NATIONS} SELECT ISO_Code, Date, n FROM nations ORDER BY ISO_Code, Date")
def sort_panel(spark: SparkSession, sf: str) -> DataFrame:
    """O1."""
    return ordering.sort_panel(fx.nations(spark, sf).select("ISO_Code", "Date", "n"))


@query("top_customers", "SELECT c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_name LIMIT 15")
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    """O2 and O3."""
    return ordering.top_n(table(spark, sf, "customer").select("c_name", "c_acctbal"), "c_acctbal", 15, "c_name")


@query("entities", f"WITH {fx.NATIONS} SELECT DISTINCT ISO_Code FROM nations ORDER BY 1")
def entities(spark: SparkSession, sf: str) -> DataFrame:
    """O4."""
    return ordering.entities(fx.nations(spark, sf))


@query("union_terms", f"WITH {fx.TRENDS} SELECT term_category, count(*) AS n FROM trends GROUP BY 1")
def union_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The two term sets as one table."""
    both = ordering.union_all([fx.trends(spark, sf, fx.DIS_TERMS), fx.trends(spark, sf, fx.PRO_TERMS)])
    return both.groupBy("term_category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "union_prefer",
    f"""WITH {fx.NATIONS}, ship AS (
      SELECT 'N' || lpad(s_nationkey::VARCHAR, 2, '0') AS ISO_Code, l_shipdate::DATE AS Date, -count(*) AS n
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
    SELECT ISO_Code, Date, n FROM nations UNION ALL SELECT ISO_Code, Date, n FROM ship s
    WHERE NOT EXISTS (SELECT 1 FROM nations b WHERE b.ISO_Code = s.ISO_Code AND b.Date = s.Date)""",
)
def union_prefer(spark: SparkSession, sf: str) -> DataFrame:
    """History wins where both have the day."""
    hist = fx.nations(spark, sf).select("ISO_Code", "Date", "n")
    live = ships(spark, sf).groupBy("ISO_Code", "Date").agg((-F.count(F.lit(1))).alias("n"))
    return ordering.union_prefer(hist, live, "ISO_Code")


@query("distinct_values", "SELECT DISTINCT r_name AS Continent FROM region")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """U3."""
    return ordering.distinct_values(fx.nations(spark, sf), "Continent")


@query("new_columns", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def new_columns(spark: SparkSession, sf: str) -> DataFrame:
    """What a table adds to a panel that has its status and keys already."""
    orders = table(spark, sf, "orders").drop("o_custkey").withColumnRenamed("o_orderdate", "date")
    assert not schema.is_disaggregated(orders)
    return orders.select(*schema.new_columns(["o_orderstatus"], orders))


@query(
    "column_profile",
    round_sql(
        f"""WITH {fx.GOLD} SELECT unnest(['c1m_school_closing', 'reproduction_rate', 'Confirmed']) AS "column",
        unnest([count(c1m_school_closing), count(reproduction_rate), count(Confirmed)]) AS n_present,
        unnest([count(c1m_school_closing) * 100.0 / count(*), count(reproduction_rate) * 100.0 / count(*), count(Confirmed) * 100.0 / count(*)])::DOUBLE AS fill_pct
        FROM gold""",
        ["fill_pct"],
    ),
)
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Q1."""
    return rounded(quality.profile(fx.gold(spark, sf), ["c1m_school_closing", "reproduction_rate", "Confirmed"]))


@query(
    "null_report",
    round_sql(
        f"""WITH {fx.GOLD}, s AS (SELECT unnest(['ISO_Code', 'Date', 'c1m_school_closing', 'reproduction_rate']) AS "column",
        unnest([count(*) - count(ISO_Code), count(*) - count(Date), count(*) - count(c1m_school_closing), count(*) - count(reproduction_rate)]) AS n_null,
        count(*) AS t FROM gold)
        SELECT "column", n_null, (n_null * 100.0 / t)::DOUBLE AS null_pct,
        CASE WHEN n_null * 100.0 / t < 5 THEN 'OK' WHEN n_null * 100.0 / t < 30 THEN 'WARN' ELSE 'HIGH' END AS status FROM s""",
        ["null_pct"],
    ),
)
def null_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q2."""
    return rounded(quality.null_report(fx.gold(spark, sf), ["ISO_Code", "Date", "c1m_school_closing", "reproduction_rate"]))


@query(
    "verify_load",
    f"WITH {fx.MERGED} SELECT count(*) AS n_rows, 4::BIGINT AS n_columns, count(disinfo_index) AS n_disinfo_index FROM merged",
)
def verify_load(spark: SparkSession, sf: str) -> DataFrame:
    """Q3."""
    slim = fx.merged(spark, sf).select("ISO_Code", "Date", "disinfo_index", "trust_ratio")
    return quality.verify_load(slim)


@query("trend_reader", "SELECT user_id, ts::DATE AS date, CASE WHEN event_type <> 'view' THEN round(value, 2) END AS search_interest FROM events")
def trend_reader(spark: SparkSession, sf: str) -> DataFrame:
    """SRC4: days and interests come back typed, text that is no number as null."""
    path = scratch_path(spark, "trends")
    interest = F.when(F.col("event_type") == "view", F.lit("<1")).otherwise(F.round("value", 2).cast("string"))
    rows = table(spark, sf, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"), interest.alias("search_interest"), F.lit("False").alias("isPartial"))
    writers.write_csv(rows, path)
    return readers.read_trends(spark, path).select(F.col("user_id").cast("long").alias("user_id"), "date", "search_interest")
