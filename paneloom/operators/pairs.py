"""Pairwise operators (J9-J11): band joins and the thresholded correlation of series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paneloom.functions.numeric import FLAT
from paneloom.session import cut_lineage


#: Pairs that are centred again at a time.
DOUBTFUL = 4_096

#: Comparisons, and slices, that a task of a band join gets; and its tasks at most.
UNIT, ROWS, MOST_PARTS = 4_096**2, 100_000, 20_000

#: Rows of each of two slices whose pairs are unfolded at a time.
SQUARE = 128

#: Tiles of series, unless one would hold more values than this; rows and columns of tiles that are compared at a time, few
#: enough that what is worked out about them stays in a core's cache; edges that are handed on together.
TILES, CELLS, SLAB, WIDE, SHEAF = 32, 1_000_000, 64, 256, 32_768

#: Centred values beyond this are squared apart, as products of their squares may overflow.
WILD = 1e30


def band_pairs(
    df: DataFrame,
    key: str,
    value: str,
    width: float,
    equi: Sequence[str] = (),
    closed: bool = False,
    hot: int = 4_096,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Unordered pairs of rows that agree on ``equi`` and lie within ``width`` of each other. Columns in ``carry`` come
    along as ``_a`` and ``_b`` of that name, so that no pair has to be joined.

    Values fall into buckets as wide as the band, so partners sit in the same or the next bucket and
    the theta join becomes an equi join with a residual. Rows of a bucket are packed into slices of about
    ``hot`` rows, and two slices that may hold partners are one unit of work, dealt by its own key: however
    many rows a bucket has, no unit compares more than two slices, there are as many tasks as the comparisons ask
    for, and pairs are unfolded inside the tasks. A row that unfolds hands on its rows only when it has made them all,
    so slices are cut into squares of ``SQUARE`` rows first: a task holds the pairs of a square, not of a unit. Within a
    bucket all pairs are results, so the work is of the order of the output.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    if df.schema[value].dataType.typeName() in ("double", "float"):
        rows = rows.filter(~F.isnan(value) & (F.abs(F.col(value)) < float("inf")))
    # The ends of the longs are left free for the neighbours.
    bucket = F.floor(F.col(value) / F.lit(width))
    bucket = F.greatest(F.least(bucket, F.lit(2**63 - 2)), F.lit(-(2**63) + 1))
    told = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = cut_lineage(rows.select(F.col(key).alias("k"), F.col(value).alias("v"), *told, *equi, bucket.alias("b")), "band")
    by = [*equi, "b"]
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("s", F.ceil(F.col("n") / F.lit(hot)).cast("int"))
    sliced = rows.join(sizes.filter("s > 1"), by, "left").withColumn(
        "p", F.pmod(F.xxhash64("k"), F.coalesce("s", F.lit(1))).cast("int")
    )
    held = ["k", "v", *(f"c{i}" for i in range(len(carry)))]
    slices = cut_lineage(sliced.groupBy(*by, "p").agg(F.collect_list(F.struct(*held)).alias("rows")), "slices")
    # One row: how many comparisons and slices there are.
    total = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("work"), F.sum("s").alias("slices")).first()
    parts = int(min(MOST_PARTS, max(1.0, (total["work"] or 0) / UNIT, (total["slices"] or 0) / ROWS)))
    unit = [*equi, "b", "home", "p", "q"]
    wanted = (F.col("home") > F.col("b")) | (F.col("p") <= F.col("q"))
    numbers = F.explode(F.sequence(F.lit(0), F.col("s") - 1))
    sides = [
        slices.select(*by, F.explode(F.array(F.col("b"), F.col("b") + 1)).alias("home"), "p", F.col("rows").alias("left"))
        .join(sizes.select(*equi, F.col("b").alias("home"), "s"), [*equi, "home"])
        .select(*equi, "b", "home", "p", numbers.alias("q"), "left"),
        slices.select(*equi, F.col("b").alias("home"), F.explode(F.array(F.col("b"), F.col("b") - 1)).alias("b"), F.col("p").alias("q"), F.col("rows").alias("right"))
        .join(sizes.select(*by, "s"), by)
        .select(*equi, "b", "home", numbers.alias("p"), "q", "right"),
    ]
    left, right = [side.filter(wanted).repartition(parts, *unit) for side in sides]
    apart = (F.col("home") > F.col("b")) | (F.col("p") != F.col("q"))
    units = left.join(right.hint("shuffle_merge"), unit).select(*equi, apart.alias("apart"), "left", "right")
    squares = units.mapInArrow(_squares(SQUARE), units.schema)
    ends = [[f"{c}_{end}" for c in ("k", "v", *carry)] for end in "ab"]
    half = squares.select(*equi, "apart", "right", F.inline("left").alias(*ends[0]))
    both = half.select(*equi, "apart", *ends[0], F.inline("right").alias(*ends[1]))
    gap = F.abs(F.col("v_a") - F.col("v_b"))
    near = gap <= width if closed else gap < width
    return both.filter(near & (F.col("apart") | (F.col("k_a") < F.col("k_b")))).select(*equi, *ends[0], *ends[1])


def _squares(size: int):
    """Units whose slices, ``left`` and ``right``, have at most ``size`` rows each and make up those of the units given."""

    def cut(rows: pa.ListArray) -> pa.ListArray:
        values = rows.flatten()
        return pa.ListArray.from_arrays(pa.array([*range(0, len(values), size), len(values)], pa.int32()), values)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.schema.get_field_index("left"), batch.schema.get_field_index("right")
            most = np.maximum(*(pc.list_value_length(batch.column(k)).to_numpy(zero_copy_only=False) for k in (left, right)))
            if (most <= size).any():
                yield batch.filter(pa.array(most <= size))
            for at in np.flatnonzero(most > size).tolist():
                a, b = (cut(batch.column(k).slice(at, 1)) for k in (left, right))
                row = batch.slice(at, 1).take(pa.array(np.zeros(len(a), np.int64)))
                for k in range(len(b)):
                    columns = row.columns
                    columns[left], columns[right] = a, b.take(pa.array(np.full(len(a), k)))
                    yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return squares


def series_curves(df: DataFrame, key: str, date: str, value: str, min_points: int = 60) -> DataFrame:
    """One row for each series, ``(key, days, values)``, in the order of its days; no longer than the calendar. Series
    with fewer days than ``min_points`` are left out."""
    cells = (
        df.filter(F.col(key).isNotNull() & F.col(date).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key).cast("string").alias("key"), F.unix_date(F.col(date)).alias("day"))
        .agg(F.avg(F.col(value).cast("double")).alias("v"))
    )
    return (
        cells.groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("day", "v"))).alias("c"))
        .filter(F.size("c") >= min_points)
        .select("key", F.col("c.day").alias("days"), F.col("c.v").alias("values"))
    )


def correlated_pairs(
    df: DataFrame,
    key: str,
    date: str,
    value: str,
    threshold: float = 0.85,
    min_points: int = 60,
    signed: bool = False,
    block: int = 1_024,
) -> DataFrame:
    """Pairs of series whose Pearson coefficient over their shared days reaches the threshold."""
    # Written once: their number and length decide the number of tiles, and then they are copied from there.
    return curve_pairs(cut_lineage(series_curves(df, key, date, value, min_points), "curves"), threshold, signed, block)


def curve_pairs(
    stored: DataFrame, threshold: float = 0.85, signed: bool = False, block: int = 1_024, carry: Sequence[str] = (), named: bool = True
) -> DataFrame:
    """``correlated_pairs`` of the rows of ``series_curves``, which should be a stored table. Text columns in ``carry``
    go along with each series and come out as ``src_`` and ``dst_`` of that name, so that no pair has to be joined. Without
    ``named`` a pair comes without its keys, for those who count pairs: Spark drops no column that a task hands on.

    A self join would emit a row per pair and day. Here every series is one row, the keys are hashed into tiles, and
    each pair of tiles is one unit of work that gets its
    coefficients from matrix products, ``block`` columns at a time, and hands on its edges as it finds them. Tiles
    are ``TILES`` or, where they would hold more than ``CELLS`` values, more: so a series is copied to a fixed number
    of units up to a size far beyond that of a block, and no task holds more than two tiles of bounded size.
    """
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("days")).alias("days")).first()
    blocks = max(1, -(-size["n"] // block))
    tiles = min(blocks, max(TILES, -(-size["n"] * (size["days"] or 0) // CELLS)))
    homed = stored.withColumn("home", F.pmod(F.xxhash64("key"), F.lit(tiles)).cast("int"))
    spread = homed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"), "home", "key", "days", "values", *carry
    )
    units = min(MOST_PARTS, tiles * (tiles + 1) // 2)
    dealt = spread.repartition(units, "i", "j").sortWithinPartitions("i", "j", "home")
    ends = "".join(f", `{end}_{c}` string" for c in carry for end in ("src", "dst"))
    keys = "src string, dst string, " if named else ""
    return dealt.mapInArrow(_tile_edges(threshold, signed, block, tuple(carry), named), f"{keys}correlation double, n_days long{ends}")


NAMES = ["src", "dst", "correlation", "n_days"]


def _unit_edges(
    unit: pa.Table, threshold: float, signed: bool, block: int, carry: Sequence[str] = (), named: bool = True
) -> Iterator[pa.RecordBatch]:
    """The edges between two tiles, or inside one, a slab of rows and a block of columns at a time."""
    i, j = unit["i"][0].as_py(), unit["j"][0].as_py()
    days = np.unique(pc.list_flatten(unit["days"]).to_numpy())
    a = _Tile(unit.filter(pc.equal(unit["home"], i)), days, carry)
    b = a if i == j else _Tile(unit.filter(pc.equal(unit["home"], j)), days, carry)
    names = [*NAMES[0 if named else 2 :], *(f"{end}_{c}" for c in carry for end in ("src", "dst"))]
    keys = a.keys if i == j else pa.concat_arrays([a.keys, b.keys])
    told = {c: a.told[c] if i == j else pa.concat_arrays([a.told[c], b.told[c]]) for c in carry}
    place = pc.rank(keys, tiebreaker="dense").to_numpy()
    behind, wide, room = len(keys) - len(b.keys), min(block, WIDE), np.empty((14, SLAB * min(block, WIDE)))

    def bound(sheaf: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        p, q, r, n = (np.concatenate(v) for v in zip(*sheaf))
        found = [pa.array(r), pa.array(n.astype(np.int64))]
        if named or carry:
            swap = place[p] > place[q]
            at = [pa.array(np.where(swap, *x)) for x in ((q, p), (p, q))]
            found = [*(keys.take(x) for x in at if named), *found, *(told[c].take(x) for c in carry for x in at)]
        return pa.RecordBatch.from_arrays(found, names=names)

    sheaf, held = [], 0
    for top in range(0, len(a.keys), SLAB):
        for left in range(top // wide * wide if i == j else 0, len(b.keys), wide):
            p, q, r, n = _correlated(a.part(top, SLAB), b.part(left, wide), threshold, signed, top - left if i == j else None, room)
            if len(p):
                sheaf.append((p + top, q + (behind + left), r, n))
                held += len(p)
            if held >= SHEAF:
                yield bound(sheaf)
                sheaf, held = [], 0
    if sheaf:
        yield bound(sheaf)


def _block_edges(threshold: float, signed: bool, block: int = 1_024):
    """All edges of one unit at once, for callers that hold it as a frame."""

    def edges(group: pd.DataFrame) -> pd.DataFrame:
        found = list(_unit_edges(pa.Table.from_pandas(group), threshold, signed, block))
        return pa.Table.from_batches(found).to_pandas() if found else pd.DataFrame({c: [] for c in NAMES})

    return edges


def _tile_edges(threshold: float, signed: bool, block: int, carry: Sequence[str] = (), named: bool = True):
    """The edges of a task's units, which lie one after the other."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(k).to_numpy() for k in (0, 1)])
            starts = [0, *(np.flatnonzero((np.diff(at) != 0).any(0)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(starts, starts[1:]):
                mine = tuple(at[:, start].tolist())
                if held and mine != unit:
                    yield from _unit_edges(pa.Table.from_batches(held).combine_chunks(), threshold, signed, block, carry, named)
                    held = []
                unit = mine
                held.append(batch.slice(start, stop - start))
        if held:
            yield from _unit_edges(pa.Table.from_batches(held).combine_chunks(), threshold, signed, block, carry, named)

    return edges


class _Tile:
    """Series on a common day axis: centred values (0 where absent), their squares and presence."""

    def __init__(self, rows: pa.Table | None = None, days: np.ndarray | None = None, carry: Sequence[str] = ()) -> None:
        if rows is None:
            return
        self.keys = pa.array(rows["key"].to_pylist(), pa.string())
        self.told = {c: pa.array(rows[c].to_pylist(), pa.string()) for c in carry}
        length = pc.list_value_length(rows["days"]).to_numpy().astype(np.int64)
        line, place = np.repeat(np.arange(len(length)), length), np.searchsorted(days, pc.list_flatten(rows["days"]).to_numpy())
        values = pc.list_flatten(rows["values"]).to_numpy().astype(float)
        with np.errstate(invalid="ignore"):
            centred = values - (np.bincount(line, values, len(length)) / length)[line]
        self.x, self.m = np.zeros((len(length), len(days))), np.zeros((len(length), len(days)))
        self.x[line, place], self.m[line, place] = centred, 1.0
        with np.errstate(over="ignore"):
            self.xx = self.x**2
        self.wild = not np.abs(self.x).max(initial=0.0) < WILD

    def part(self, start: int, size: int) -> _Tile:
        some = _Tile()
        some.x, some.m, some.xx = (v[start : start + size] for v in (self.x, self.m, self.xx))
        some.wild = self.wild
        return some


def _correlated(
    a: _Tile, b: _Tile, threshold: float, signed: bool, shift: int | None, room: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """Rows, columns, Pearson coefficients over shared days and numbers of these, of the pairs that reach the threshold;
    a series that is constant there reaches none. With a ``shift`` only pairs above the diagonal count, which lies so
    many columns to the right of the first. ``room``, 14 rows of as many values as there are pairs or more, is written over:
    memory that is in the cache already."""
    high, across = len(a.m), len(b.m)
    room = np.empty((14, high * across)) if room is None else room
    n, sx, sxx, sy, syy, sxy, nx, ny, vx, vy, c, cc, vv, t = (v[: high * across].reshape(high, across) for v in room)
    with np.errstate(all="ignore"):
        for out, left, right in ((n, a.m, b.m), (sx, a.x, b.m), (sxx, a.xx, b.m), (sy, a.m, b.x), (syy, a.m, b.xx), (sxy, a.x, b.x)):
            np.matmul(left, right.T, out=out)
        # n^2 times the variances and the covariance: whether a pair can reach the threshold needs neither root nor quotient.
        np.multiply(n, sxx, out=nx)
        np.multiply(n, syy, out=ny)
        np.subtract(nx, np.multiply(sx, sx, out=t), out=vx)
        np.subtract(ny, np.multiply(sy, sy, out=t), out=vy)
        np.subtract(np.multiply(n, sxy, out=c), np.multiply(sx, sy, out=t), out=c)
        np.multiply(vx, vy, out=vv)
        far = np.multiply(c, c, out=cc) >= np.multiply(vv, max(threshold, 0.0) ** 2 * (1 - 1e-6), out=t)
        # Sums of squares lose digits where the spread is tiny beside the offset: those pairs
        # are computed again from their shared days. No spread is above its sum of squares, so a tiny one makes a tiny product.
        if a.wild or b.wild:
            far |= (vx < nx * 2e-6) | (vy < ny * 2e-6)
        else:
            np.multiply(nx, ny, out=t)
            far |= vv < np.multiply(t, 2.1e-6, out=t)
        if shift is not None:
            far &= np.arange(across)[None, :] > np.arange(high)[:, None] + shift
        at = np.flatnonzero(far)
        p, q = np.divmod(at, across)
        n, sx, sy, sxx, syy, sxy = (v.ravel().take(at) for v in (n, sx, sy, sxx, syy, sxy))
        vx, vy = (sxx - sx * sx / n) / n, (syy - sy * sy / n) / n
        r = ((sxy - sx * sy / n) / n) / np.sqrt(vx * vy)
        flat = (vx < FLAT**2) | (vy < FLAT**2)
        doubtful = np.flatnonzero(~flat & ((vx < 1e-6 * sxx / n) | (vy < 1e-6 * syy / n)))
        r[flat | (n == 0)] = np.nan
        for start in range(0, len(doubtful), DOUBTFUL):
            part = doubtful[start : start + DOUBTFUL]
            r[part] = _exact_correlation(a, b, p[part], q[part])
        r = np.clip(r, -1.0, 1.0)
        hit = (r if signed else np.abs(r)) >= threshold
    return p[hit], q[hit], r[hit], n[hit]


def _exact_correlation(a: _Tile, b: _Tile, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Pearson of the pairs of rows ``p`` and ``q``, centred again on the days that each pair shares."""
    shared = a.m[p] * b.m[q]
    n = shared.sum(1, keepdims=True)
    x, y = a.x[p] * shared, b.x[q] * shared
    x, y = (x - x.sum(1, keepdims=True) / n) * shared, (y - y.sum(1, keepdims=True) / n) * shared
    n = n[:, 0]
    sd_x, sd_y = np.sqrt((x * x).sum(1) / n), np.sqrt((y * y).sum(1) / n)
    flat = (sd_x < FLAT) | (sd_y < FLAT)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(flat, np.nan, (x * y).sum(1) / n / (sd_x * sd_y))
