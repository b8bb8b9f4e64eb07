"""Second moments of all pairs of columns, by matrix products inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

#: Bytes of sums that a task holds for its groups before it sends them on.
HELD_BYTES = 64 << 20

#: A spread this small beside the column's own is computed again from the rows that the pair shares.
DOUBTFUL = 1e-6

MOMENTS = ("_mx", "_my", "_vx", "_vy", "_c")


def pair_moments(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, _p, _n, _vx, _vy, _c, _odd)``: rows, squared deviations and product of the ``_p``-th pair of ``names``.

    Pairs count from 1 in the order of ``itertools.combinations``; only rows where both are present count, and
    ``_odd`` of these hold NaN or an infinity. Pair 0 counts the rows with any value. A task centres each batch and
    group, gets the sums of all pairs from four matrix products of values and masks, and merges them without
    cancellation; rows never unfold into pairs, and what is shuffled is one row for each task, group and pair.
    A null key is a group; pairs without a common row, and groups without any value, have no row.
    """
    names, by = list(names), list(by)
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(names)])
    schema = T.StructType([df.schema[c] for c in by] + [T.StructField("_p", T.IntegerType()), T.StructField("_n", T.LongType())]
                          + [T.StructField(c, T.DoubleType()) for c in MOMENTS] + [T.StructField("_odd", T.LongType())])
    parts = rows.mapInArrow(_task(by, len(names)), schema)
    each = Window.partitionBy(*by, "_p")
    n = F.col("_n")
    gap = {a: F.col(f"_m{a}") - F.sum(n * F.col(f"_m{a}")).over(each) / F.sum(n).over(each) for a in "xy"}
    centred = parts.withColumns({f"_d{a}": col for a, col in gap.items()})
    sums = {"_vx": ("_dx", "_dx"), "_vy": ("_dy", "_dy"), "_c": ("_dx", "_dy")}
    return centred.groupBy(*by, "_p").agg(
        F.sum(n).alias("_n"),
        *[F.sum(F.col(c) + n * F.col(a) * F.col(b)).alias(c) for c, (a, b) in sums.items()],
        F.sum("_odd").alias("_odd"),
    )


def _task(by: list[str], width: int):
    keys = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(i).type for i in range(keys)]
            values = np.column_stack([batch.column(keys + i).to_numpy(zero_copy_only=False) for i in range(width)])
            there = np.column_stack([np.asarray(batch.column(keys + i).is_valid()) for i in range(width)])
            for key, at in _groups(batch, keys):
                found = _sums(values[at], there[at])
                held[key] = found if key not in held else _merged(held[key], found)
            if len(held) * 8 * width * width * 5 > HELD_BYTES:
                yield _told(held, by, kinds, width)
                held = {}
        if held:
            yield _told(held, by, kinds, width)

    return run


def _groups(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each group's key and its rows in the batch."""
    if not keys:
        yield (), np.arange(batch.num_rows)
        return
    code = np.zeros(batch.num_rows, np.int64)
    for i in range(keys):
        coded = batch.column(i).dictionary_encode(null_encoding="encode")
        code = np.unique(code * len(coded.dictionary) + coded.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        yield tuple(batch.column(i)[int(at[0])].as_py() for i in range(keys)), at


def _sums(values: np.ndarray, there: np.ndarray) -> list:
    """Rows with a value, and for each pair (i, j): rows, mean and squared deviations of i where j is present,
    product, rows with a value that is not finite."""
    fine = there & np.isfinite(values)
    seen, mask, strange = there.astype(float), fine.astype(float), (there & ~fine).astype(float)
    count = mask.sum(0)
    middle = np.where(fine, values, 0.0).sum(0) / np.maximum(count, 1)
    x = np.where(fine, values - middle, 0.0)
    n = seen.T @ seen
    both = np.maximum(mask.T @ mask, 1)
    s, ss, sxy = x.T @ mask, (x * x).T @ mask, x.T @ x
    v, c = ss - s * s / both, sxy - s * s.T / both
    mean = middle[:, None] + s / both
    odd = strange.T @ seen
    odd = odd + odd.T - strange.T @ strange
    doubt = np.triu(((v < DOUBTFUL * ss) | (v < DOUBTFUL * ss).T) & (n > 0) & (odd == 0), 1)
    for i, j in zip(*np.nonzero(doubt)):
        shared = fine[:, i] & fine[:, j]
        a, b = values[shared, i], values[shared, j]
        mean[i, j], mean[j, i] = a.mean(), b.mean()
        a, b = a - mean[i, j], b - mean[j, i]
        v[i, j], v[j, i] = a @ a, b @ b
        c[i, j] = c[j, i] = a @ b
    return [int(there.any(1).sum()), n, mean, v, c, odd]


def _merged(a: list, b: list) -> list:
    some_a, n_a, mean_a, v_a, c_a, odd_a = a
    some_b, n_b, mean_b, v_b, c_b, odd_b = b
    n = n_a + n_b
    gap = np.where((n_a > 0) & (n_b > 0), mean_b - mean_a, 0.0)
    share = n_b / np.maximum(n, 1)
    mean = np.where(n_a > 0, mean_a + gap * share, mean_b)
    return [some_a + some_b, n, mean, v_a + v_b + gap * gap * n_a * share, c_a + c_b + gap * gap.T * n_a * share, odd_a + odd_b]


def _told(held: dict[tuple, list], by: list[str], kinds: list, width: int) -> pa.RecordBatch:
    """The rows of all held groups, pairs without a common row left out."""
    first, second = np.triu_indices(width, 1)
    numbers, keys, cols = [], [], [[] for _ in range(7)]
    for key, (some, n, mean, v, c, odd) in held.items():
        if not some:
            continue
        hit = np.flatnonzero(n[first, second] > 0)
        i, j = first[hit], second[hit]
        numbers.append(np.concatenate([[0], hit + 1]))
        keys += [key] * (len(hit) + 1)
        for col, lead, rest in zip(cols, (some, 0, 0, 0, 0, 0, 0), (n[i, j], mean[i, j], mean[j, i], v[i, j], v[j, i], c[i, j], odd[i, j])):
            col.append(np.concatenate([[lead], rest]))
    joined = [np.concatenate(col) if col else np.zeros(0) for col in (numbers, *cols)]
    whole = (pa.int32(), pa.int64(), *[pa.float64()] * 5, pa.int64())
    arrays = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate(kinds)]
    arrays += [pa.array(col.astype(kind.to_pandas_dtype()), kind) for col, kind in zip(joined, whole)]
    return pa.RecordBatch.from_arrays(arrays, names=[*by, "_p", "_n", *MOMENTS, "_odd"])
