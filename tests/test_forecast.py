"""Model pipeline: features, fit, forecast."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from paneloom.plans import forecast as ML, live as LV, pages
from paneloom.plans.panel import prepare_panel

D = dt.date(2020, 1, 1)
SINCE = "2020-03-21"
FEATS = ("stringency_index", "reproduction_rate")


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(5)
    rows = []
    for key in ("AAA", "BBB", "CCC"):
        total = 0.0
        for i in range(100):
            level = 50 + 30 * np.sin(i / 9)
            total += round(level + rng.normal())
            rows.append((key, D + dt.timedelta(i), total, float(level), float(1 + i % 7 / 10)))
    df = spark.createDataFrame(rows, "ISO_Code string, Date date, Confirmed double, stringency_index double, reproduction_rate double")
    return prepare_panel(df).cache()


@pytest.fixture(scope="module")
def model(spark, panel):
    live = LV.live_clean(panel.select("ISO_Code", "Date", "Confirmed").withColumn("received_at", F.current_timestamp()), SINCE)
    target = LV.live_target(panel, live, SINCE).cache()
    featured = ML.build_features(ML.combine(panel, target, FEATS), FEATS).cache()
    names = ML.feature_names(featured, FEATS)
    fitted, score = ML.fit_forest(featured.dropna(subset=[*names, ML.TARGET]), names, trees=20)
    return featured, target, names, fitted, score


def test_fit_explains_the_curve(model):
    assert model[4] > 0.8


def test_too_few_rows_give_no_model(panel):
    names = ["stringency_index"]
    assert ML.fit_forest(panel.limit(30), names, trees=2) is None


def test_forest_does_not_depend_on_how_rows_lie(model):
    featured, _, names, _, _ = model
    rows = featured.dropna(subset=[*names, ML.TARGET])
    one, other = (ML.fit_forest(rows.repartition(n), names, trees=5) for n in (1, 7))
    assert one[1] == other[1]
    scored = [ML.predict(rows, m[0], names).orderBy("ISO_Code", "Date").toPandas()["_pred"] for m in (one, other)]
    np.testing.assert_array_equal(*scored)


def test_forecast_step_by_step(spark, model):
    featured, target, names, fitted, _ = model
    states = ML.last_states(featured, target, FEATS)
    ahead = ML.forecast(fitted, states, FEATS, horizon=25).toPandas().sort_values(["ISO_Code", "Date"])
    assert ahead.groupby("ISO_Code").size().tolist() == [25] * 3 and (ahead["ML_Future"] >= 0).all()
    for row in states.collect():
        series, frozen = list(row["recent"]), [row[f] for f in FEATS]
        start = len(series)
        for _ in range(25):
            lags = [series[-n] if len(series) >= n else 0.0 for n in ML.LAGS]
            raw = fitted.predict(Vectors.dense([*frozen, *lags]))
            series.append(max(0.85 * series[-1] + 0.15 * raw, 0.0))
        want = [np.mean(series[start:][max(0, i - 6) : i + 1]) for i in range(25)]
        part = ahead[ahead["ISO_Code"] == row["ISO_Code"]]
        np.testing.assert_allclose(part["ML_Future"], want)
        assert part["Date"].iloc[0] == row["last_date"] + dt.timedelta(1)


def test_full_inertia_is_constant(model):
    featured, target, _, fitted, _ = model
    states = ML.last_states(featured, target, FEATS)
    ahead = ML.forecast(fitted, states, FEATS, horizon=5, alpha=1.0)
    spread = ahead.groupBy("ISO_Code").agg((F.max("ML_Future") - F.min("ML_Future")).alias("d"))
    assert all(r["d"] == pytest.approx(0) for r in spread.collect())


def test_history_wins_by_default(spark, rows):
    hist = spark.createDataFrame([("A", D, 1.0, 10.0)], "ISO_Code string, Date date, stringency_index double, New_Cases_7d double")
    live = spark.createDataFrame([("A", D, 99.0), ("A", D + dt.timedelta(1), 98.0)], "ISO_Code string, Date date, Live_Target double")
    both = ML.combine(hist, live, ["stringency_index"]).select("Date", "stringency_index", ML.TARGET)
    assert rows(both) == [(D, 1.0, 10.0), (D + dt.timedelta(1), None, 98.0)]
    assert rows(ML.combine(hist, live, ["stringency_index"], prefer="live").select("Date", "stringency_index", ML.TARGET))[0] == (D, 1.0, 99.0)


def test_fit_is_shown_for_live_days_only(model):
    featured, target, names, fitted, _ = model
    shown = ML.fitted(featured, fitted, names, target)
    assert shown.count() == target.count() and shown.filter("ML_Pred is null").count() == 0


def test_importances(spark, model):
    _, _, names, fitted, _ = model
    ranked = ML.importances(spark, fitted, names).collect()
    assert sorted(r["feature"] for r in ranked) == sorted(names) and sum(r["importance"] for r in ranked) == pytest.approx(1)


def test_pages(panel):
    live = panel.filter(F.col("Date") >= SINCE).select("ISO_Code", "Date", "Confirmed").withColumn("received_at", F.col("Date").cast("timestamp"))
    page = pages.live_forecast(panel, live, SINCE, batches=10, horizon=7, trees=5)
    kinds = {r["kind"]: r["count"] for r in page["series"].groupBy("kind").count().collect()}
    assert kinds == {"history": 3 * 81, "live": 30, "fit": 30, "forecast": 24}
    fallback, score = ML.fallback_fit(panel, FEATS, trees=5)
    assert fallback.count() == 300 and score > 0.5
