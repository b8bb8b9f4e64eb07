"""Null-safe arithmetic (SC9, SC10, P11) and shared moments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Below this spread a series counts as constant: a rolled constant leaves a tiny residue.
FLAT = 1e-9


def clip_low(col: Column, low: float = 0.0) -> Column:
    """Lower clip that keeps null as null (``greatest`` alone would skip it)."""
    return F.when(col.isNotNull(), F.greatest(col, F.lit(low)))


def log10_floor1(col: Column) -> Column:
    return F.log10(clip_low(col, 1.0))


def round_half_up(col: Column, digits: int) -> Column:
    """Decimal rounding after dropping the noise of summation order, so that ties come out alike
    however the rows were distributed. Decimals decide near a tie only: elsewhere the nearest multiple is the same."""
    exact = F.round(col.cast("decimal(28,9)"), digits).cast("double")
    scale, slack = 10.0**digits, 10.0 ** (digits - 9) + 1e-5
    scaled = col.cast("double") * F.lit(scale)
    sure = (F.abs(scaled) < 1e9) & (F.abs(scaled - F.rint(scaled)) < F.lit(0.5 - slack))
    return F.when(sure, F.rint(scaled) / F.lit(scale) + F.lit(0.0)).otherwise(exact)


def trust_ratio(pro: Column | str, dis: Column | str) -> Column:
    return F.try_divide(_col(pro), _col(dis) + F.lit(1.0))


def balance(pro: Column | str, dis: Column | str) -> Column:
    return _col(pro) - _col(dis)


def row_mean(cols: Sequence[str]) -> Column:
    """Mean across columns of one row, nulls skipped; null when all are null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    count = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(total, count)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson over rows where both sides are present; null, not an error, for constants."""
    both = x.isNotNull() & y.isNotNull()
    mx, my = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    sx, sy = F.stddev_pop(mx), F.stddev_pop(my)
    r = F.try_divide(F.covar_pop(mx, my), sx * sy)
    return F.when((sx >= FLAT) & (sy >= FLAT), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def both_count(x: Column, y: Column) -> Column:
    return F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
