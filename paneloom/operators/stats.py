"""Statistics (ST1-ST9): correlations, regression lines and exact distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from paneloom.functions.classes import corr_direction, corr_strength
from paneloom.functions.numeric import FLAT, both_count, safe_corr
from paneloom.operators.moments import pair_moments
from paneloom.session import cut_lineage

# Fewest complete rows for a correlation or a line.
MIN_ROWS = 6


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson over complete rows, null below six of them, with its class."""
    out = df.groupBy(*by).agg(both_count(F.col(x), F.col(y)).alias("n"), safe_corr(F.col(x), F.col(y)).alias("_r"))
    r = F.when(F.col("n") >= MIN_ROWS, F.col("_r"))
    return out.select(
        *by, "n", r.alias("r"), corr_strength(r).alias("strength"), corr_direction(r).alias("direction")
    )


def corr_matrix(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson for every pair of columns of a family, over the rows where both are present.

    The sums of all pairs come from matrix products inside tasks, so no row unfolds into pairs. Null for constants
    and for pairs that share a row with NaN or an infinity. Empty unless the family has two columns, and more than
    five rows hold at least one value.
    """
    names = [c for c in cols if c in df.columns]
    pairs = list(combinations(names, 2))
    if not pairs:
        keys = [df.schema[c] for c in by]
        fields = [T.StructField("x", T.StringType()), T.StructField("y", T.StringType())]
        fields += [T.StructField("r", T.DoubleType()), T.StructField("n", T.LongType())]
        return df.sparkSession.createDataFrame([], T.StructType([*keys, *fields]))
    sx, sy = F.sqrt(F.col("_vx") / F.col("_n")), F.sqrt(F.col("_vy") / F.col("_n"))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.col("_c") / F.col("_n"), sx * sy)))
    sound = (F.col("_odd") == 0) & (sx >= FLAT) & (sy >= FLAT)
    value = F.struct(F.col("_n").alias("n"), F.when(sound, r).alias("r"))
    each = pair_moments(df, names, by)
    found = each.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_p", value.alias("v")))).alias("_m"))
    table = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(x).alias("x"), F.lit(y).alias("y")) for i, (x, y) in enumerate(pairs, 1)])
    shown = found.filter(F.try_element_at("_m", F.lit(0))["n"] >= MIN_ROWS).select(*by, "_m", F.explode(table).alias("_t"))
    hit = F.try_element_at("_m", F.col("_t.p"))
    return shown.select(*by, "_t.x", "_t.y", hit["r"].alias("r"), F.coalesce(hit["n"], F.lit(0)).alias("n"))


def ols(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x``; null below six complete rows."""
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    out = df.groupBy(*by).agg(
        F.regr_count(cy, cx).alias("n"),
        F.regr_slope(cy, cx).alias("_s"),
        F.regr_intercept(cy, cx).alias("_i"),
        safe_corr(cx, cy).alias("_r"),
    )
    enough = F.col("n") >= MIN_ROWS
    return out.select(
        *by,
        "n",
        F.when(enough, F.col("_s")).alias("slope"),
        F.when(enough, F.col("_i")).alias("intercept"),
        F.when(enough, F.col("_r") * F.col("_r")).alias("r2"),
    )


def scatter(df: DataFrame, x: str, y: str, keep: Sequence[str] = ()) -> DataFrame:
    """The points behind a scatter plot: rows where both values are present."""
    return df.select(*keep, x, y).dropna(subset=[x, y])


def exact_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 20_000
) -> DataFrame:
    """Exact, linearly interpolated quantiles, one column ``q{i}`` per probability.

    A mergeable sketch of fixed size brackets each quantile from both sides. One conditional aggregate
    over the rows then sums up everything below a bracket, and only the values inside a bracket, a few
    times ``1/accuracy`` of all, are shuffled, counted and ordered. Nothing is sampled: the sketch only
    decides where to look, and the neighbours of each bracket are kept for ranks at its very edge.
    """
    rows = finite_rows(df, col, by)
    margin = 4.0 / accuracy
    low = [max(0.0, p - margin) for p in probs]
    high = [min(1.0, p + margin) for p in probs]
    bracket = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_total"),
        F.percentile_approx("_v", low, accuracy).alias("_lo"),
        F.percentile_approx("_v", high, accuracy).alias("_hi"),
    )
    placed = attach(rows, bracket, by)
    below, inside = [], []
    for i in range(len(probs)):
        lo, hi = F.col("_lo")[i], F.col("_hi")[i]
        below += [
            F.count_if(F.col("_v") < lo).alias(f"_below{i}"),
            F.max(F.when(F.col("_v") < lo, F.col("_v"))).alias(f"_pred{i}"),
            F.min(F.when(F.col("_v") > hi, F.col("_v"))).alias(f"_succ{i}"),
        ]
        inside.append(F.when(F.col("_v").between(lo, hi), F.lit(i)))
    frame = placed.groupBy(*by).agg(F.max("_total").alias("_total"), *below)
    near = placed.select(*by, "_v", F.explode(F.array_compact(F.array(*inside))).alias("_i"))
    core = near.groupBy(*by, "_i", "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = attach(running_counts(core, [*by, "_i"], "_v", "_n"), frame, by)
    ends, outs = [], []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("_total") - 1)
        reach = F.col(f"_below{i}") + F.col("_cum")
        mine = F.col("_i") == i
        for end, rank in (("a", F.floor(position)), ("b", F.ceil(position))):
            ends.append(F.min(F.when(mine & (reach > rank), F.col("_v"))).alias(f"_{end}{i}"))
    grouped = ranked.groupBy(*by).agg(
        F.first("_total").alias("_total"),
        *[F.first(f"_{kind}{i}").alias(f"_{kind}{i}") for i in range(len(probs)) for kind in ("below", "pred", "succ")],
        *ends,
    )
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("_total") - 1)

        def at(end: str, rank: Column) -> Column:
            early = F.when(rank < F.col(f"_below{i}"), F.col(f"_pred{i}"))
            return F.coalesce(early, F.col(f"_{end}{i}"), F.col(f"_succ{i}"))

        a, b = at("a", F.floor(position)), at("b", F.ceil(position))
        outs.append((a + (b - a) * (position - F.floor(position))).alias(f"q{i}"))
    return grouped.select(*by, *outs)


def running_counts(df: DataFrame, groups: Sequence[str], order: str, count: str) -> DataFrame:
    """``_cum``: the sum of ``count`` up to each row of its group, by ``order``, without a group in one task.

    Rows are dealt by range over group and order, so a group spreads over as many tasks as its size asks for. A
    window sums inside each task's share only; the shares' totals, a row for each group and task, are summed up by
    themselves and added. The dealt rows are a written table, so that a lost executor cannot deal them anew.
    """
    dealt = df.repartitionByRange(*groups, order).withColumn("_part", F.spark_partition_id())
    rows = cut_lineage(dealt, "ranks")
    inside = Window.partitionBy(*groups, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    shares = rows.groupBy(*groups, "_part").agg(F.sum(count).alias("_share"))
    ahead = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = shares.select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_part").alias("_g_part"), F.coalesce(F.sum("_share").over(ahead), F.lit(0)).alias("_before"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups], F.col("_part") == F.col("_g_part"))
    cumulated = rows.withColumn("_own", F.sum(count).over(inside)).join(before, same)
    return cumulated.withColumn("_cum", F.col("_own") + F.col("_before")).select(*df.columns, "_cum")


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns of ``stats``, one row per key, next to each row of ``df``: joined by key, nulls being a key
    too, or as a scalar when there is no key.

    The keyed statistics are written first, so the planner knows their size: a small table is sent to the
    rows, which then need no exchange, and a large one is joined.
    """
    if by:
        found = cut_lineage(stats, "stats").withColumnsRenamed({k: f"_key_{k}" for k in by})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in by])
        return df.join(found, same, "left").drop(*[f"_key_{k}" for k in by])
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return df.withColumn("_stats", row).select(*df.columns, *[F.col("_stats")[c].alias(c) for c in stats.columns])


def finite_rows(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the value as the double ``_v``, without missing values and NaN."""
    value = F.col(col).cast("double")
    return df.select(*keep, value.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def describe_col(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, exact median, deviation and range of the values; NaN counts as missing."""
    cast = F.col(col).cast("double")
    value = F.when(~F.isnan(cast), cast)
    basic = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    median = exact_quantiles(df, col, [0.5], by).withColumnRenamed("q0", "median")
    return attach(basic, median, by).select(*by, "count", "mean", "median", "std", "min", "max")


def histogram(df: DataFrame, col: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins count zero, NaN is missing."""
    rows = finite_rows(df, col, by)
    bounds = rows.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    place = F.when(
        F.col("_hi") > F.col("_lo"),
        F.least(F.floor((F.col("_v") - F.col("_lo")) / step) + 1, F.lit(bins)),
    ).otherwise(F.lit(1))
    counts = attach(rows, bounds, by).groupBy(*by, place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = bounds.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    edges = frame.select(
        *by,
        "bin",
        (F.col("_lo") + step * (F.col("bin") - 1)).alias("bin_low"),
        (F.col("_lo") + step * F.col("bin")).alias("bin_high"),
    )
    found = counts.withColumnsRenamed({k: f"_key_{k}" for k in (*by, "bin")})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in (*by, "bin")])
    filled = edges.join(found, same, "left").drop(*[f"_key_{k}" for k in (*by, "bin")])
    return filled.withColumn("n", F.coalesce("n", F.lit(0)))


def box_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 interquartile ranges, and outlier count."""
    fenced = _fences(df, col, by)
    placed = attach(finite_rows(df, col, by), fenced, by)
    inside = F.col("_v").between(F.col("low_fence"), F.col("high_fence"))
    return placed.groupBy(*by, "q1", "median", "q3", "low_fence", "high_fence").agg(
        F.min(F.when(inside, F.col("_v"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("_v"))).alias("high_whisker"),
        F.count_if(~inside).alias("n_outliers"),
    )


def box_outliers(df: DataFrame, col: str, by: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Rows outside the fences; NaN is missing."""
    placed = attach(df.select(*by, *keep, col), _fences(df, col, by), by)
    return placed.filter(~F.isnan(F.col(col).cast("double")) & ~F.col(col).between(F.col("low_fence"), F.col("high_fence"))).select(*by, *keep, col)


def _fences(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    quartiles = exact_quantiles(df, col, [0.25, 0.5, 0.75], by)
    reach = (F.col("q2") - F.col("q0")) * 1.5
    return quartiles.select(
        *by,
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        (F.col("q0") - reach).alias("low_fence"),
        (F.col("q2") + reach).alias("high_fence"),
    )


def usable_numeric(df: DataFrame, min_count: int = 20, cols: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns with some spread and more than ``min_count`` values."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    names = [c for c in (cols or numeric) if c != "Year" and "annotation" not in c.lower()]
    wide = df.agg(
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(names)],
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(names)],
    )
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("std"), F.col(f"n{i}").alias("n"))
        for i, c in enumerate(names)
    ]
    long = wide.select(F.explode(F.array(*cells)).alias("c")).select("c.column", "c.std", "c.n")
    return long.filter((F.col("std") > 0) & (F.col("n") > min_count))


def pair_grid(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Count, correlation and line for each declared pair of columns, from one aggregate."""
    present = [(x, y) for x, y in pairs if x in df.columns and y in df.columns]
    aggregates, cells = [], []
    for i, (x, y) in enumerate(present):
        cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
        aggregates += [
            both_count(cx, cy).alias(f"n{i}"),
            safe_corr(cx, cy).alias(f"r{i}"),
            F.regr_slope(cy, cx).alias(f"s{i}"),
            F.regr_intercept(cy, cx).alias(f"i{i}"),
        ]
        enough = F.col(f"n{i}") >= MIN_ROWS
        cells.append(
            F.struct(
                F.lit(x).alias("x"),
                F.lit(y).alias("y"),
                F.col(f"n{i}").alias("n"),
                F.when(enough, F.col(f"r{i}")).alias("r"),
                F.when(enough, F.col(f"s{i}")).alias("slope"),
                F.when(enough, F.col(f"i{i}")).alias("intercept"),
            )
        )
    wide = df.groupBy(*by).agg(*aggregates)
    fields = ["x", "y", "n", "r", "slope", "intercept"]
    return wide.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, *[f"c.{f}" for f in fields])


def triangulate(
    df: DataFrame, a: str, b: str, low: str = "2020-01-01", high: str = "2020-07-31", date: str = "Date", by: Sequence[str] = ()
) -> DataFrame:
    """Correlation of two columns inside a date window."""
    inside = df.filter(F.col(date).between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    return pearson(inside, a, b, by)
