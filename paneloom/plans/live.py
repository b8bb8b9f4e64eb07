"""Live series beside the history (LV1-LV5, SM6). Every function treats all entities at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paneloom.functions.dates import floor_second
from paneloom.functions.numeric import clip_low
from paneloom.operators.aggregates import dedupe_first
from paneloom.operators.ordering import union_all
from paneloom.operators.windows import first_batches, rolling_mean_col, series
from paneloom.plans.panel import parse_dates

KEY, DAY = "ISO_Code", "Date"


def live_clean(live: DataFrame, since: str, key: str = KEY, date: str = DAY) -> DataFrame:
    """Readable days from ``since`` on, one row per entity and day: the one that arrived first."""
    dated = parse_dates(live, date).filter(F.col(date).isNotNull() & (F.col(date) >= F.lit(since).cast("date")))
    return dedupe_first(dated, [key, date], ["received_at"])


def seed_values(hist: DataFrame, since: str, key: str = KEY, date: str = DAY) -> DataFrame:
    """Last known cumulative value before the cut and the smoothed curve on that day."""
    known = hist.filter((F.col(date) < F.lit(since).cast("date")) & F.col("Confirmed").isNotNull())
    return known.groupBy(key).agg(
        F.max_by("Confirmed", date).alias("seed_confirmed"), F.max_by("New_Cases_7d", date).alias("seed_7d")
    )


def visible_batches(live: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """Rows of the first ``n`` arrival seconds of each entity."""
    return first_batches(live.withColumn("batch", floor_second("received_at")), key, "batch", n)


def live_progress(live: DataFrame, visible: DataFrame, key: str = KEY, date: str = DAY) -> DataFrame:
    """Days shown of days received, the last one shown, and the share in percent."""
    total = live.groupBy(key).agg(F.count(F.lit(1)).alias("total_days"))
    shown = visible.groupBy(key).agg(F.count(F.lit(1)).alias("received_days"), F.max(date).alias("last_date"))
    return total.join(shown, key, "left").select(
        key,
        F.coalesce("received_days", F.lit(0)).alias("received_days"),
        "total_days",
        "last_date",
        (F.coalesce("received_days", F.lit(0)) * 100.0 / F.greatest("total_days", F.lit(1))).alias("pct"),
    )


def live_target(
    hist: DataFrame, live: DataFrame, since: str, ratio: float = 0.7, warmup: int = 6, key: str = KEY, date: str = DAY
) -> DataFrame:
    """Smoothed daily values of the live series.

    A live series that mostly rises is cumulative: it is differenced from the last historical value,
    clipped and smoothed, with the tail of the historical curve as warm-up rows. Any other series is
    taken as it is, except that its first day continues the historical curve. Without a cumulative
    column the last historical value is held.
    """
    w = series(key, date)
    if "Confirmed" not in live.columns:
        last = hist.filter(F.col(date) < F.lit(since).cast("date")).groupBy(key).agg(
            F.max_by("New_Cases_7d", date).alias("_seed")
        )
        held = live.join(last, key, "left")
        return held.withColumn("Live_Target", F.coalesce("_seed", F.lit(0.0))).drop("_seed")
    known = hist.filter((F.col(date) < F.lit(since).cast("date")) & F.col("Confirmed").isNotNull())
    tail = (
        known.withColumn("_back", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date))))
        .filter(F.col("_back") <= warmup)
        .select(key, date, F.col("New_Cases_7d").cast("double").alias("_warm"), F.col("Confirmed").cast("double").alias("_hist"))
    )
    rows = live.withColumn("_live", F.lit(True)).unionByName(
        tail.withColumn("_live", F.lit(False)), allowMissingColumns=True
    )
    # History rows all lie before the cut and live rows after it, so one ordering by day serves both.
    confirmed = F.col("Confirmed").cast("double")
    # The first live row is compared with the last historical value when there is one, else with itself.
    start = F.coalesce(F.last("_hist", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), confirmed)
    ordered = rows.withColumns(
        {
            "_n": F.row_number().over(Window.partitionBy(key, "_live").orderBy(date)),
            "_prev": F.lag(confirmed).over(Window.partitionBy(key, "_live").orderBy(date)),
        }
    )
    rises = F.when(F.col("_live"), confirmed - F.col("_prev"))
    whole = Window.partitionBy(key)
    share = F.count_if(rises > 0).over(whole) / F.greatest(F.count_if(F.col("_live")).over(whole) - 1, F.lit(1))
    before = F.when(F.col("_n") == 1, start).otherwise(F.col("_prev"))
    shaped = ordered.withColumns(
        {
            "_cumulative": share > ratio,
            "_daily": F.when(F.col("_live"), clip_low(confirmed - before)).otherwise(F.col("_warm")),
            "_seed": F.coalesce(F.last("_warm").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        }
    )
    smooth = rolling_mean_col("_daily", w, warmup + 1)
    plain = F.when(F.col("_n") == 1, F.col("_seed")).otherwise(clip_low(confirmed))
    done = shaped.withColumn("Live_Target", F.when(F.col("_cumulative"), smooth).otherwise(plain))
    return done.filter("_live").select(*live.columns, "Live_Target")


def stitch(
    hist: DataFrame,
    live: DataFrame,
    fit: DataFrame | None = None,
    fcst: DataFrame | None = None,
    since: str | None = None,
    key: str = KEY,
    date: str = DAY,
) -> DataFrame:
    """One long series per entity, tagged by kind: history with a bridge to the first live value,
    live, fit, and the forecast led in by the last live value."""
    past = hist if since is None else hist.filter(F.col(date) < F.lit(since).cast("date"))

    def kind(df: DataFrame, value: str, name: str) -> DataFrame:
        return df.select(key, date, F.col(value).cast("double").alias("value"), F.lit(name).alias("kind"))

    ends = live.groupBy(key).agg(
        F.min(date).alias("d0"),
        F.min_by("Live_Target", date).alias("v0"),
        F.max(date).alias("d1"),
        F.max_by("Live_Target", date).alias("v1"),
    )
    bridge = ends.join(past.select(key).distinct(), key, "left_semi").select(key, F.col("d0").alias(date), F.col("v0"))
    parts = [kind(past, "New_Cases_7d", "history"), kind(bridge, "v0", "history"), kind(live, "Live_Target", "live")]
    if fit is not None:
        parts.append(kind(fit, "ML_Pred", "fit"))
    if fcst is not None:
        lead = ends.join(fcst.select(key).distinct(), key, "left_semi").select(key, F.col("d1").alias(date), F.col("v1"))
        parts += [kind(lead, "v1", "forecast"), kind(fcst, "ML_Future", "forecast")]
    return union_all(parts)
