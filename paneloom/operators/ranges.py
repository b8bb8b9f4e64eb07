"""Counting the partners of a band join, and finding those furthest apart, without building its pairs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paneloom.operators.stats import running_counts
from paneloom.session import cut_lineage


def band_counts(
    df: DataFrame, key: str, value: str, width: float, equi: Sequence[str] = (), closed: bool = False, apart: bool = False
) -> DataFrame:
    """``(key, n)``: in how many rows of ``band_pairs`` with the same arguments each row's key occurs, if in any.

    Partners of a value lie between two ends, so their number is a difference of two ranks. Values and ends are
    dealt by range and ranked by prefix counts: the work is linear in the rows however many pairs there are, and
    a value or group that holds most rows costs one row of counts. ``apart`` leaves out partners of the same value.
    Rows without a key, group or finite value have no partners.
    """
    given = [F.col(c).alias(f"_e{i}") for i, c in enumerate(equi)]
    by = [f"_e{i}" for i in range(len(equi))]
    rows = df.select(F.col(key).alias("key"), *given, (F.col(value).cast("double") + F.lit(0.0)).alias("_v"))
    rows = rows.dropna().filter(~F.isnan("_v") & (F.abs("_v") < float("inf")))
    counted = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_own"))
    held, ranked = _ranked_ends(counted, by, width, closed)
    upto = ranked.select(*by, F.col("_at").alias("lo"), F.col("_cum").alias("_below"))
    under = ranked.select(*by, F.col("_at").alias("hi"), (F.col("_cum") - F.col("_n")).alias("_under"))
    mine = F.col("_own") if apart else F.lit(1)
    found = held.join(upto, [*by, "lo"]).join(under, [*by, "hi"]).select(*by, "_v", (F.col("_under") - F.col("_below") - mine).alias("n"))
    return rows.join(found.filter("n > 0"), [*by, "_v"]).select("key", "n")


def _ranked_ends(counted: DataFrame, by: Sequence[str], width: float, closed: bool) -> tuple[DataFrame, DataFrame]:
    """The values (``_v``, with ``_own`` rows each) beside the ends ``lo`` and ``hi`` of their bands, as a stored table,
    and the running count ``_cum`` of rows up to each value or end ``_at``, which itself has ``_n``."""
    ends = F.pandas_udf(_ends(float(width), closed), "lo double, hi double")
    others = [c for c in counted.columns if c not in (*by, "_v")]
    held = cut_lineage(counted.withColumn("_ends", ends("_v")).select(*by, "_v", *others, "_ends.lo", "_ends.hi"), "ends")
    marks = F.array(
        F.struct(F.col("_v").alias("at"), F.col("_own").alias("own")),
        *[F.struct((F.col(c) + F.lit(0.0)).alias("at"), F.lit(0).cast("long").alias("own")) for c in ("lo", "hi")],
    )
    points = held.select(*by, F.explode(marks).alias("_m")).groupBy(*by, F.col("_m.at").alias("_at")).agg(F.sum("_m.own").alias("_n"))
    return held, running_counts(points, by, "_at", "_n")


def band_extremes(df: DataFrame, value: str, width: float, other: str) -> DataFrame:
    """The rows that have a finite ``value`` and an ``other``, with ``least`` and ``greatest``: the ends of ``other`` among
    the rows less than ``width`` away, the row itself included.

    Distinct values are ranked, and the partners of a value are a run of ranks. Ends are found once for each run of 2^k
    ranks that starts at a multiple of 2^k, and a run is put together of at most two of these for each k: the work is
    linear in the rows but for a logarithm, and no task holds more of a band than others.
    """
    v = F.col(value).cast("double") + F.lit(0.0)
    rows = df.withColumn("_v", v).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf")) & F.col(other).isNotNull())
    rows = cut_lineage(rows, "rated")
    valued = rows.groupBy("_v").agg(F.lit(1).cast("long").alias("_own"), F.min(other).alias("least"), F.max(other).alias("greatest"))
    held, ranked = _ranked_ends(valued, [], width, False)
    ranked = cut_lineage(ranked, "ranked")
    rank = ranked.filter("_n > 0").select(F.col("_at").alias("_v"), (F.col("_cum") - 1).alias("r"))
    start = ranked.select(F.col("_at").alias("lo"), F.col("_cum").alias("start"))  # the rank of the first in the band
    stop = ranked.select(F.col("_at").alias("hi"), (F.col("_cum") - F.col("_n")).alias("stop"))  # of the first behind it
    spans = cut_lineage(held.join(start, "lo").join(stop, "hi").select("_v", "start", "stop"), "spans")
    levels = F.explode(F.sequence(F.lit(0), F.lit(max(1, held.count()).bit_length()))).alias("k")
    ends = [F.min("least").alias("least"), F.max("greatest").alias("greatest")]
    nodes = held.join(rank, "_v").select(levels, "r", "least", "greatest").groupBy("k", F.expr("shiftright(r, k)").alias("node")).agg(*ends)
    asked = spans.select("start", "stop").distinct().select("start", "stop", levels)
    asked = asked.withColumns({"a": F.expr("shiftright(start + shiftleft(1L, k) - 1, k)"), "b": F.expr("shiftright(stop, k)")}).filter("a < b")
    odd = F.array(F.when(F.col("a") % 2 == 1, F.col("a")), F.when(F.col("b") % 2 == 1, F.col("b") - 1))
    parts = asked.select("start", "stop", "k", F.explode(F.array_compact(odd)).alias("node")).join(nodes, ["k", "node"])
    found = spans.join(parts.groupBy("start", "stop").agg(*ends), ["start", "stop"]).select("_v", "least", "greatest")
    return rows.join(found, "_v").drop("_v")


def furthest_pairs(
    df: DataFrame, key: str, value: str, width: float, other: str, gap: float, n: int, both_orientations: bool = False
) -> DataFrame:
    """``(src, a, dst, b)``: of all pairs of rows whose ``value`` differs by less than ``width``, the ``n`` whose ``other``
    differ most, by more than ``gap``, in that order and then by ``src`` and ``dst``; ``src`` is the lesser key, or either
    if ``both_orientations``. Keys occur once, ``other`` is finite and ``gap`` not negative.

    The ends of ``other`` in its band tell how far from each row its furthest partner is. A pair among the ``n`` has an
    end among the first ``2 n`` rows by that and then by key: each of these rows is an end of a pair no worse than any pair
    of the rows behind them, and as a pair has two ends, there are ``n`` such pairs. Only these rows meet all others.
    """
    if gap < 0:
        raise ValueError("gap must not be negative")
    reach = F.greatest(F.abs(F.col(other) - F.col("least")), F.abs(F.col("greatest") - F.col(other)))
    rows = cut_lineage(band_extremes(df.filter(F.col(key).isNotNull()), value, width, other).select(
        F.col(key).alias("key"), F.col(value).alias("at"), F.col(other).alias("far"), reach.alias("reach")
    ), "reach")
    first = cut_lineage(rows.filter(F.col("reach") > gap).orderBy(F.desc("reach"), "key").limit(2 * n), "first")
    x, y = first.select(*[F.col(c).alias(f"x_{c}") for c in ("key", "at", "far")]), rows.select(*[F.col(c).alias(f"y_{c}") for c in ("key", "at", "far")])
    near = F.abs(F.col("x_at") - F.col("y_at")) < width
    apart = F.abs(F.col("x_far") - F.col("y_far")) > gap
    met = y.join(F.broadcast(x), near & apart & (F.col("x_key") != F.col("y_key")))  # 2 n rows
    sides = [F.struct(F.col(f"{s}_key").alias("src"), F.col(f"{s}_far").alias("a"), F.col(f"{d}_key").alias("dst"), F.col(f"{d}_far").alias("b")) for s, d in ("xy", "yx")]
    sided = F.explode(F.array(*sides)) if both_orientations else F.when(F.col("x_key") < F.col("y_key"), sides[0]).otherwise(sides[1])
    pairs = met.select(sided.alias("p")).select("p.*").distinct()
    return pairs.orderBy(F.abs(F.col("a") - F.col("b")).desc(), "src", "dst").limit(n)


def _ends(width: float, closed: bool):
    """The last value below and the first above each value whose difference from it, as doubles give it, is out of
    the band. The difference never falls as the other value grows, so bisection over all doubles finds them."""

    def ordered(x: np.ndarray) -> np.ndarray:
        bits = x.view(np.int64)
        return np.where(bits < 0, np.iinfo(np.int64).min - bits, bits)

    def double(place: np.ndarray) -> np.ndarray:
        return np.where(place < 0, np.iinfo(np.int64).min - place, place).view(np.float64)

    def above(v: np.ndarray) -> np.ndarray:
        inside, outside = ordered(v), ordered(np.full(len(v), np.inf))
        for _ in range(65):
            middle = (inside >> 1) + (outside >> 1) + (inside & outside & 1)
            gap = double(middle) - v
            out = gap > width if closed else gap >= width
            inside, outside = np.where(out, inside, middle), np.where(out, middle, outside)
        return double(outside)

    def ends(values: pd.Series) -> pd.DataFrame:
        v = np.array(values, dtype=np.float64)
        with np.errstate(over="ignore"):
            return pd.DataFrame({"lo": -above(-v), "hi": above(v)})

    return ends
