"""Column and row operators on literal frames (traps T1-T8, T13, T17, T19, T22)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paneloom import dims
from paneloom.functions import dates, text
from paneloom.functions.numeric import row_mean
from paneloom.operators import aggregates as A, filters, joins, quality, schema
from paneloom.plans import factcheck, gold, panel, trends
from paneloom.sources import readers, writers


def day(text_):
    return dt.date.fromisoformat(text_)


def test_aliases_come_before_filters(spark, rows):
    raw = spark.createDataFrame([("ITA", "2020-01-01T10:00:00", "Europe", 5.0), (None, "2020-01-01", "x", 1.0)], "iso_code string, date string, continent string, confirmed double")
    out = panel.prepare_panel(raw)
    assert rows(out.select("ISO_Code", "Date", "Continent", "Confirmed", "Country")) == [("ITA", day("2020-01-01"), "Europe", 5.0, "ITA")]


def test_both_spellings_coalesce(spark, rows):
    raw = spark.createDataFrame([(None, "b"), ("a", "c")], "x string, y string").toDF("ISO_Code", "other")
    both = raw.withColumnRenamed("other", "iso_code_")
    out = schema.normalize_columns(both, {"iso_code_": "ISO_Code"})
    assert out.columns == ["ISO_Code"] and rows(out) == [("a",), ("b",)]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2020-03-01", "2020-03-01"), ("2020-03-01 13:00:00", "2020-03-01"), ("03/01/2020", "2020-03-01"),
        ("2020/03/01", "2020-03-01"), ("01 Mar 2020", "2020-03-01"), ("20200301", "2020-03-01"),
        ("soon", None), ("2020-13-45", None), ("", None), (None, None),
    ],
)
def test_lenient_days(spark, value, expected):
    got = spark.createDataFrame([(value,)], "v string").select(dates.parse_day("v")).first()[0]
    assert got == (day(expected) if expected else None)


def test_casts_never_raise(spark, rows):
    df = spark.createDataFrame([("Europe", " 5 ", "1e3", dt.date(2020, 1, 1))], "a string, b string, c string, d date")
    assert rows(schema.to_double(df)) == [(None, 5.0, 1000.0, None)]
    dirty = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.0,), (None,)], "v double")
    assert rows(schema.clean_nonfinite(dirty)) == [(1.0,), (None,), (None,), (None,), (None,)]


def test_pivot_takes_the_first_row_even_if_null(spark, rows):
    long = spark.createDataFrame(
        [("A", 1, "new tests", None, 1), ("A", 1, "new tests", 7.0, 2), ("A", 1, "beds", 3.0, 5), ("A", 1, "beds", 4.0, 4)],
        "k string, d int, indicator string, value double, seq int",
    )
    wide = schema.pivot_first(long, ["k", "d"], "indicator", "value", ["seq"])
    assert rows(wide.select("k", "d", "beds", "new_tests")) == [("A", 1, 4.0, None)]
    assert rows(schema.first_values(long, ["k", "d"], "indicator", "value", ["seq"])) == [("A", 1, "beds", 4.0), ("A", 1, "new tests", None)]


def test_pivot_of_many_names(spark):
    long = spark.range(400).select((F.col("id") % 2).alias("k"), F.concat(F.lit("n"), (F.col("id") % 90).cast("string")).alias("name"), F.col("id").alias("v"))
    wide = schema.pivot_first(long, ["k"], "name", "v")
    assert len(wide.columns) == 91 and {r["k"]: r["n4"] for r in wide.collect()} == {0: 4, 1: None}


@pytest.mark.parametrize("extra", ["int", "string"])
def test_latest_row_is_one_row(spark, extra):
    """Ties on the order give the values of one row; fixed widths are aggregated by hash, texts are not."""
    made = spark.range(0, 600, 1, 7).select((F.col("id") % 5).alias("k"), (F.col("id") % 3).cast("int").alias("d"), F.col("id").alias("a"), F.when(F.col("id") % 4 > 0, F.col("id")).cast(extra).alias("b"))
    last = A.latest_row(made, ["k"], "d")
    seen = {(r["k"], r["d"], r["a"], r["b"]) for r in made.collect()}
    got = [(r["k"], r["d"], r["a"], r["b"]) for r in last.collect()]
    assert len(got) == 5 and set(got) <= seen and {r[1] for r in got} == {2}
    plan = last._jdf.queryExecution().toString()
    assert ("SortAggregate" in plan) == (extra == "string")


def test_too_many_names_stay_rows(spark, rows):
    """Up to the limit names become columns; beyond it cells are rows, with the same values."""
    held = [("ITA", day("2021-02-01"))]
    grid = spark.createDataFrame([*held, ("FRA", day("2021-02-01"))], "ISO_Code string, Date date")
    cells = [("ITA", "2021-02-01", " new tests ", "4", 2), ("ITA", "2021-02-01", "new tests", "3", 1), ("ITA", "2021-02-01", "beds", None, 1), ("ITA", "2021-02-01", None, "9", 1), ("ESP", "2021-02-01", "beds", "1", 1)]
    long = spark.createDataFrame(cells, "ISO_Code string, date string, indicator string, value string, seq int")
    wide, told = joins.enrich(grid, {"t": long}, order=["seq"], max_names=3)
    assert not told.cells and set(wide.columns) >= {"new_tests", "beds"}
    same, told = joins.enrich(grid, {"t": long}, order=["seq"], max_names=2)
    assert same.columns == grid.columns and told.entries[0]["status"] == "cells"
    assert rows(told.cells["t"].select("indicator", "value")) == [("beds", None), ("new_tests", 3.0)]
    assert rows(told.matches().select("matched")) == [(1,)]
    with pytest.raises(ValueError, match="first_values"):
        schema.category_values(long, "indicator", limit=2)


def test_category_names():
    long_name = "a very long category name that goes on"
    assert text.unique_names([long_name, "x/y", "x y", "it's (so)."]) == ["fc_" + long_name.replace(" ", "_")[:25], "fc_x_y", "fc_x_y_2", "fc_its_so"]
    assert text.label_of("c1m_school_closing") == "School Closing"


def test_row_mean_skips_nulls(spark, rows):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "a double, b double")
    assert rows(df.select(row_mean(["a", "b"]))) == [(2.0,), (3.0,), (None,)]


def test_column_finders(spark):
    df = spark.createDataFrame([("x", f"2020-01-{d:02d}", d % 3) for d in range(1, 20)], "a string, when string, c int")
    assert schema.sniff_column(df, "date", dates.parse_day) == "when"
    late = df.withColumn("when", F.when(F.col("when") > "2020-01-12", F.col("when")))
    assert schema.sniff_column(late, "date", dates.parse_day) == "when"
    assert schema.sniff_column(df, "country", dates.parse_day) == "when" and schema.sniff_column(df, "country") is None
    assert schema.pick_low_cardinality(df, ["when", "c"], 5) == "c"
    assert schema.pick_populated(df.withColumn("e", F.lit(None)), ["e", "zz", "c"], 3) == "c"
    assert schema.drop_empty_columns(df.withColumn("e", F.lit(None))).columns == ["a", "when", "c"]


def test_filters(spark, rows):
    df = spark.createDataFrame([("ITA",), ("OWI_WRL",), ("OWI",), (None,), ("IT",)], "ISO_Code string")
    assert rows(filters.exclude_prefix(filters.valid_iso(df))) == [("ITA",)]
    dated = spark.createDataFrame([("on 2020-01-02T00:00",), ("none",), (None,)], "Date string")
    assert rows(filters.valid_day(dated)) == [("2020-01-02",)]


def enrichment_inputs(spark):
    master = spark.createDataFrame(
        [("ITA", day("2020-01-01"), 1.0), ("ITA", day("2020-01-02"), 2.0), ("VNM", day("2020-01-01"), 3.0)],
        "ISO_Code string, Date date, Confirmed double",
    )
    tables = {
        "tests": spark.createDataFrame(
            [("Italy", "2020-01-01", "10", "1", 2), ("Italy", "2020-01-01", "11", "1", 1), ("Viet Nam", "2020-01-01", "many", "1", 1), ("Atlantis", "2020-01-01", "9", "1", 1)],
            "country string, date string, tests string, Confirmed string, seq int",
        ),
        "long": spark.createDataFrame(
            [("ITA", "2020-01-02", "icu beds", "4", 1), ("ITA", "2020-01-02", "icu beds", "5", 2), ("OWI", "2020-01-02", "icu beds", "9", 1)],
            "iso_code string, date string, indicator string, value string, seq int",
        ),
        "again": spark.createDataFrame([("ITA", "2020-01-01", "99")], "iso_code string, date string, tests string"),
        "yearly": spark.createDataFrame([("ITA", 2020, "7.5")], "iso_code string, year int, beds string"),
        "ages": spark.createDataFrame([("ITA", "2020-01-01", "0-9", "1")], "iso_code string, date string, age_group string, v string"),
        "undated": spark.createDataFrame([("ITA", "1")], "iso_code string, v string"),
        "unplaced": spark.createDataFrame([("2020-01-01", "1")], "date string, v string"),
        "nowhere": spark.createDataFrame([("Atlantis", "2020-01-01", "1")], "country string, date string, w string"),
    }
    return master, tables


def test_enrichment(spark, rows):
    master, tables = enrichment_inputs(spark)
    out, report = joins.enrich(master, tables, dims.country_dim(spark), ["seq"])
    assert out.columns == ["ISO_Code", "Date", "Confirmed", "tests", "icu_beds", "beds"]
    assert rows(out) == [
        ("ITA", day("2020-01-01"), 1.0, 11.0, None, 7.5),
        ("ITA", day("2020-01-02"), 2.0, None, 4.0, None),
        ("VNM", day("2020-01-01"), 3.0, None, None, None),
    ]
    assert report.skipped == ["again", "ages", "undated", "unplaced", "nowhere"]
    assert rows(report.matches()) == [("long", 1), ("tests", 2), ("yearly", 1)]
    assert report.frame(spark).filter("status = 'joined'").count() == 3


def test_gold_build_prunes(spark):
    master, tables = enrichment_inputs(spark)
    master = master.withColumns({"Recovered": F.lit(1), "nothing": F.lit(None).cast("double"), "stringency_index_weighted_average": F.lit(2.0)})
    out, _ = gold.build_gold(master, tables, dims.country_dim(spark), ["seq"])
    assert set(out.columns) == {"ISO_Code", "Date", "Confirmed", "tests", "icu_beds", "beds", "stringency_index"}


def test_country_names(spark):
    found = {r["name"]: r["iso3"] for r in dims.country_dim(spark).collect()}
    expected = {
        "Italy": "ITA", "Viet Nam": "VNM", "Democratic Republic of Congo": "COD", "Cote d'Ivoire": "CIV", "Curacao": "CUW",
        "Bosnia and Herzegovina": "BIH", "Saint Lucia": "LCA", "Hong Kong": "HKG", "Myanmar": "MMR", "Macao": "MAC",
        "Sao Tome and Principe": "STP", "Kosovo": "XKX", "Turkiye": "TUR", "Falkland Islands": "FLK", "Wallis and Futuna": "WLF",
    }
    assert {k: found.get(k) for k in expected} == expected
    checks = {r["name"]: r["iso3"] for r in dims.factcheck_dim(spark).collect()}
    assert checks["UK"] == "GBR" and checks["Global"] is None and len(checks) == 76
    continents = [r["iso3"] for r in dims.continent_dim(spark).collect()]
    assert len(continents) == len(set(continents)) and all(len(c) == 3 for c in continents)


def test_unmapped_report(spark, rows):
    df = spark.createDataFrame([("Italy",), ("Nowhere",), ("Nowhere",), ("Global",)], "c string")
    dim = spark.createDataFrame([("Italy", "ITA"), ("Global", None)], "name string, iso3 string")
    mapped, unmapped = joins.map_country(df, "c", dim)
    assert rows(mapped) == [("Global", None), ("Italy", "ITA"), ("Nowhere", None), ("Nowhere", None)]
    assert rows(unmapped) == [("Global", 1), ("Nowhere", 2)]


def test_week_join_moves_sunday_back(spark, rows):
    daily = spark.createDataFrame([("A", day("2020-01-06")), ("A", day("2020-01-12")), ("A", day("2020-01-13"))], "ISO_Code string, Date date")
    weekly = spark.createDataFrame(
        [("A", "n", day("2020-01-12"), 5.0), ("A", "n", day("2020-01-08"), 6.0)], "ISO_Code string, country string, Date date, v double"
    )
    out = joins.join_weekly(daily, weekly)
    assert rows(out) == [("A", day("2020-01-06"), 5.0), ("A", day("2020-01-12"), 5.0), ("A", day("2020-01-13"), None)]
    assert joins.join_weekly(daily, None) is daily


def test_work_list_and_terms(spark, rows):
    geo = dims.geo_dim(spark)
    terms = dims.term_dim(spark, dims.DISINFO_TERMS)
    done = spark.createDataFrame([("IT", "antivax")], "geo string, term_id string")
    work = joins.work_list(geo, terms.select("term_id").distinct(), done)
    assert work.count() == 12 * 11 - 1
    words = {(r["geo"], r["term_id"]): r["keyword"] for r in joins.localized_term(work, terms).collect()}
    assert len(words) == 131
    assert words["DE", "covid_hoax"] == "Corona Lüge" and words["PL", "covid_hoax"] == "covid hoax" and words["IT", "microchip"] == "vaccine microchip"
    assert dims.term_dim(spark, dims.PROSCIENCE_TERMS).select("term_id").distinct().count() == 9


def test_trend_index_and_merge(spark, rows):
    long = spark.createDataFrame(
        [("ITA", "Italy", day("2020-01-05"), "antivax", 10.0), ("ITA", "Italy", day("2020-01-05"), "plandemic", 0.0), ("ITA", "Italy", day("2020-01-05"), "5g_covid", 2.0)],
        "ISO_Code string, country string, date date, term_category string, search_interest double",
    )
    index = trends.disinfo_index(long)
    assert rows(index) == [("ITA", "Italy", day("2020-01-05"), 4.0, 10.0, 2, 10.0, 0.0, 2.0, None)]
    pro = trends.proscience_index(long.withColumn("term_category", F.lit("book_vaccine")))
    assert "proscience_terms_active" not in pro.columns
    base = spark.createDataFrame([("ITA", day(f"2019-12-{d}")) for d in (29, 30, 31)], "ISO_Code string, Date date").withColumn("trust_ratio", F.lit(99.0))
    merged = trends.merge_trends(base, index, pro)
    got = rows(merged.select("Date", "trust_ratio", "trust_ratio_smooth", "sentiment_balance"))
    assert got == [(day("2019-12-29"), None, None, None)] + [(day(f"2019-12-{d}"), 0.8, 0.8, 0.0) for d in (30, 31)]
    assert "trust_ratio" not in trends.merge_trends(base, None, pro).columns


def test_factchecks(spark, rows):
    raw = spark.createDataFrame(
        [("2020-03-02", " India ", "Spain", "False"), ("2020-03-08", "India", None, "false "), ("2020-03-09", "India", "", None), ("bad", "India", None, "x"), ("2020-03-09", "Global", "Mars", "x")],
        "published_date string, country1 string, country2 string, class string",
    )
    expanded = factcheck.expand_factchecks(raw, dims.factcheck_dim(spark))
    assert expanded.count() == 4
    weekly = factcheck.weekly_factchecks(expanded)
    assert rows(weekly.select("ISO_Code", "_week", "factcheck_count", "fc_false", "fc_nan", "factcheck_cumulative")) == [
        ("ESP", day("2020-03-02"), 1, 1, 0, 1),
        ("IND", day("2020-03-02"), 2, 2, 0, 2),
        ("IND", day("2020-03-09"), 1, 0, 1, 3),
    ]
    assert "fc_other" not in weekly.columns
    daily = spark.createDataFrame([("IND", day("2020-03-03")), ("IND", day("2020-03-04")), ("IND", day("2020-04-01"))], "ISO_Code string, Date date")
    merged = factcheck.merge_factchecks(daily.withColumn("fc_old", F.lit(1)), weekly)
    assert "fc_old" not in merged.columns
    assert rows(factcheck.coverage(merged))[0][0] == 2
    kpi = rows(A.factcheck_kpis(merged, categories=factcheck.category_columns(merged)))
    assert kpi == [(4, 2, day("2020-03-03"), day("2020-03-04"), "fc_false")]


def test_more_than_fifteen_categories(spark):
    expanded = spark.range(40).select(
        F.lit("ITA").alias("ISO_Code"), F.lit("2020-01-01").cast("date").alias("date"), F.format_string("c%02d", F.col("id") % 18).alias("category"), F.lit("r").alias("rating")
    )
    row = factcheck.weekly_factchecks(expanded).first().asDict()
    cats = {k: v for k, v in row.items() if k.startswith("fc_")}
    assert len(cats) == 16 and sum(cats.values()) == 40 and cats["fc_other"] == 6


def test_quality(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None), ("d", 2.0)], "ISO_Code string, Confirmed double")
    assert rows(quality.null_report(df, ["ISO_Code", "Confirmed", "Deaths"])) == [("Confirmed", 2, 50.0, "HIGH"), ("ISO_Code", 0, 0.0, "OK")]
    assert rows(quality.null_report(df, ["Confirmed"], total=20)) == [("Confirmed", 2, 10.0, "WARN")]
    assert rows(quality.profile(df)) == [("Confirmed", 2, 50.0), ("ISO_Code", 4, 100.0)]


def test_csv_edges(spark, fresh, rows):
    path = fresh("csv")
    writers.write_csv(spark.createDataFrame([("a\nb", "x, \"y\"", "1")], "t string, u string, v string"), path)
    assert readers.read_csv_table(spark, path).columns == ["t", "u", "v"]
    quoted = fresh("quoted")
    import os
    os.makedirs(quoted)
    with open(f"{quoted}/a.csv", "w") as out:
        out.write('t,v\n"two\nlines ""quoted""",5\n')
    assert rows(readers.read_csv_table(spark, quoted, infer=True)) == [('two\nlines "quoted"', 5)]
    assert list(readers.read_landing(spark, quoted, ["missing", "a"])) == ["a"]


def test_trend_reader(spark, fresh, rows):
    path = fresh("trends")
    writers.write_csv(readers.tag(spark.createDataFrame([("2020-01-05", "7", "True")], "date string, search_interest string, isPartial string"), geo="IT"), path)
    assert rows(readers.read_trends(spark, path)) == [(day("2020-01-05"), 7.0, "IT")]


def test_gold_files_prune(spark, fresh):
    path = fresh("gold")
    df = spark.range(1000).select(F.format_string("N%02d", F.col("id") % 7).alias("ISO_Code"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 7).cast("int")).alias("Date"), F.lit("12").alias("v"))
    writers.write_gold(df, path)
    back = readers.read_table(spark, path)
    assert dict(back.dtypes)["v"] == "double" and back.count() == 1000
    plan = readers.read_key(back, "ISO_Code", "N03", "Date")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ISO_Code), EqualTo(ISO_Code,N03)]" in plan


def test_unique_key(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, d int")
    assert rows(writers.assert_unique(df, ["k", "d"])) == [("a", 1, 2)]
