"""Random-forest fit and roll-forward (ML1-ML7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paneloom.operators.aggregates import dedupe_first
from paneloom.operators.ordering import union_prefer
from paneloom.operators.windows import rolling_mean_col, series
from paneloom.session import cut_lineage

KEY, DAY, TARGET = "ISO_Code", "Date", "New_Cases_7d"

# Model and forecast parameters.
LAGS = (7, 14, 21)
TREES, DEPTH, LEAF, SEED = 200, 8, 5, 42
MIN_TRAINING_ROWS = 30
HORIZON, INERTIA, SMOOTHING = 60, 0.85, 7

#: MLlib draws a bootstrap for each partition, so training rows are dealt by key into as many as their number asks
#: for, and sorted: the same rows give the same forest on any number of cores.
ROWS_PER_PARTITION = 20_000

# Policy features, with and without live data.
LIVE_FEATURES = (
    "containment_health_index", "stringency_index", "c1m_school_closing", "c2m_workplace_closing",
    "c6m_stay_at_home_requirements", "h6m_facial_coverings", "people_fully_vaccinated_per_hundred",
    "reproduction_rate", "positive_rate",
)
BASE_FEATURES = ("containment_health_index", "stringency_index", "c1m_school_closing", "reproduction_rate")


def feature_names(df: DataFrame, feats: Sequence[str], lags: Sequence[int] = LAGS) -> list[str]:
    return [f for f in feats if f in df.columns] + [f"lag_{n}" for n in lags]


def build_features(
    df: DataFrame,
    feats: Sequence[str],
    target: str = TARGET,
    lags: Sequence[int] = LAGS,
    key: str = KEY,
    date: str = DAY,
) -> DataFrame:
    """Smoothed policy features and lagged targets per entity; one exchange, one sort."""
    w = series(key, date)
    smooth = {f: rolling_mean_col(f, w, SMOOTHING) for f in feats if f in df.columns}
    return df.withColumns({**smooth, **{f"lag_{n}": F.lag(target, n).over(w) for n in lags}})


def combine(
    hist: DataFrame, live: DataFrame, feats: Sequence[str], key: str = KEY, date: str = DAY, prefer: str = "hist"
) -> DataFrame:
    """History and live days as one series; live rows take missing features from the history's day.

    A day that both sides have counts once, from the history unless ``prefer`` says otherwise.
    """
    have = [f for f in feats if f in live.columns]
    lacking = [f for f in feats if f not in live.columns and f in hist.columns]
    rows = live.select(key, date, *have, F.col("Live_Target").cast("double").alias(TARGET))
    if lacking:
        static = dedupe_first(hist.select(key, date, *lacking), [key, date])
        rows = rows.join(static, [key, date], "left")
    past = hist.select(key, date, *[f for f in feats if f in hist.columns], TARGET)
    return union_prefer(past, rows, key, date, prefer)


def training_set(
    hist: DataFrame, live: DataFrame | None, feats: Sequence[str], key: str = KEY, date: str = DAY
) -> DataFrame:
    """Complete feature rows of the combined series."""
    both = hist if live is None else combine(hist, live, feats, key, date)
    featured = build_features(both, feats, key=key, date=date)
    names = feature_names(featured, feats)
    return featured.dropna(subset=[*names, TARGET]).select(key, date, *names, TARGET)


def assemble(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="skip").transform(df)


def fit_forest(
    train: DataFrame, names: Sequence[str], target: str = TARGET, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, bootstrap: bool = True
) -> tuple[RandomForestRegressionModel, float] | None:
    """Forest and its in-sample R2, or nothing when there are too few rows to learn from.

    Without ``bootstrap`` every tree learns from every row: one tree of depth 1 is then the best single split, and
    one of depth 0 the mean.
    """
    values = [F.col(n).cast("double").alias(n) for n in names]
    order = [c for c in (KEY, DAY) if c in train.columns] or list(names)
    slim = train.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *values, F.col(target).cast("double").alias("label"))
    # Training passes over the rows many times: they are written once instead of derived each time.
    stored = cut_lineage(slim, "training")
    rows = stored.count()
    if rows <= MIN_TRAINING_ROWS:
        return None
    dealt = stored.repartition(max(1, -(-rows // ROWS_PER_PARTITION)), "_o0").sortWithinPartitions(*[f"_o{i}" for i in range(len(order))], *names, "label")
    data = assemble(dealt, names).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    forest = RandomForestRegressor(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        featureSubsetStrategy="all",
        bootstrap=bootstrap,
        subsamplingRate=1.0,
        seed=SEED,
        maxMemoryInMB=1024,
    )
    model = forest.fit(data)
    score = RegressionEvaluator(metricName="r2").evaluate(model.transform(data))
    data.unpersist()
    return model, score


def predict(df: DataFrame, model: RandomForestRegressionModel, names: Sequence[str], name: str = "_pred") -> DataFrame:
    """Prediction for every row, missing features as zero."""
    filled = df.withColumns({f"_f{i}": F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for i, n in enumerate(names)})
    ready = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(names))], outputCol="features").transform(filled)
    scored = model.transform(ready).withColumnRenamed("prediction", name)
    return scored.select(*df.columns, name)


def fitted(
    featured: DataFrame,
    model: RandomForestRegressionModel,
    names: Sequence[str],
    live: DataFrame | None = None,
    key: str = KEY,
    date: str = DAY,
) -> DataFrame:
    """Smoothed fit for every day, or for the live days only."""
    scored = predict(featured, model, names)
    smooth = scored.withColumn("ML_Pred", rolling_mean_col("_pred", series(key, date), SMOOTHING)).drop("_pred")
    if live is not None:
        smooth = smooth.join(live.select(key, date).distinct(), [key, date], "left_semi")
    return smooth


def last_states(
    featured: DataFrame, live: DataFrame, feats: Sequence[str], key: str = KEY, date: str = DAY
) -> DataFrame:
    """One row per entity: last live day, features of the last row up to it, and the recent targets
    in day order. At most ``max(LAGS)`` targets are kept, so the state has a fixed size."""
    keep = max(LAGS)
    newest = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date)))
    tail = live.select(key, date, "Live_Target").withColumn("_n", newest).filter(F.col("_n") <= keep)
    points = F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), F.col("Live_Target").alias("v"))))
    ends = tail.groupBy(key).agg(F.max(date).alias("last_date"), points["v"].alias("recent"))
    present = [f for f in feats if f in featured.columns]
    dated = featured.select(key, date, *present).join(ends.select(key, "last_date"), key).filter(F.col(date) <= F.col("last_date"))
    frozen = dated.groupBy(key).agg(F.max_by(F.struct(*present), date).alias("_f")).select(
        key, *[F.col("_f")[f].alias(f) for f in present]
    )
    return ends.join(frozen, key)


def forecast(
    model: RandomForestRegressionModel,
    states: DataFrame,
    feats: Sequence[str],
    horizon: int = HORIZON,
    alpha: float = INERTIA,
    key: str = KEY,
    date: str = DAY,
) -> DataFrame:
    """Roll every entity forward ``horizon`` days.

    No lag is shorter than the least of ``LAGS``, so the model's inputs of that many days ahead are known at
    once: a step is one ``transform`` over a row for each entity and day of a block, and a fold over the block's
    predictions keeps ``alpha`` of the previous value from day to day. Rows of an entity stay in their partition
    throughout, so steps need one exchange in all; the states are of fixed size.
    """
    present = [f for f in feats if f in states.columns]
    names = [*present, *(f"lag_{n}" for n in LAGS)]
    block = min(LAGS)
    grown = states.select(key, "last_date", *present, F.col("recent").cast("array<double>").alias("_grown"), F.size("recent").alias("_n0"))
    grown = grown.repartition(key)
    for start in range(0, horizon, block):
        days = grown.withColumn("_day", F.explode(F.sequence(F.lit(0), F.lit(min(block, horizon - start) - 1))))
        # An index before the start of the series gives null, and missing lags count as zero.
        lags = {f"lag_{n}": F.get("_grown", F.size("_grown") + F.col("_day") - F.lit(n)) for n in LAGS}
        raw = predict(days.withColumns(lags), model, names, "_raw")
        told = raw.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_day", "_raw"))).alias("_raws"), *[F.first(c).alias(c) for c in grown.columns if c != key])

        def onward(series: Column, step: Column) -> Column:
            last = F.coalesce(F.try_element_at(series, F.lit(-1)), F.lit(0.0))
            return F.concat(series, F.array(F.greatest(F.lit(alpha) * last + F.lit(1 - alpha) * step["_raw"], F.lit(0.0))))

        grown = told.withColumn("_grown", F.aggregate("_raws", F.col("_grown"), onward)).select(*grown.columns)
    ahead = grown.select(key, "last_date", F.posexplode(F.slice("_grown", F.col("_n0") + 1, horizon)).alias("_i", "_v"))
    days = ahead.withColumn(date, F.date_add("last_date", (F.col("_i") + 1).cast("int")))
    return days.select(key, date, rolling_mean_col("_v", series(key, date), SMOOTHING).alias("ML_Future"))


def importances(spark: SparkSession, model: RandomForestRegressionModel, names: Sequence[str]) -> DataFrame:
    """Features by importance; as many rows as the model has features."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), F.asc("feature"))


def fallback_fit(
    panel: DataFrame, feats: Sequence[str] = BASE_FEATURES, key: str = KEY, date: str = DAY, trees: int = TREES, **shape: object
) -> tuple[DataFrame, float] | None:
    """Actual and fitted curve without live data, from the base features; ``shape`` goes to ``fit_forest``."""
    featured = build_features(panel, feats, key=key, date=date)
    names = feature_names(featured, feats)
    result = fit_forest(featured.dropna(subset=[*names, TARGET]), names, trees=trees, **shape)
    if result is None:
        return None
    model, score = result
    return fitted(featured, model, names, key=key, date=date).select(key, date, TARGET, "ML_Pred"), score
