"""Per-entity series functions.

Frames count rows, not days. The functions run on panel cells, at most one row per entity and day, so
the longest partition is as long as the calendar however many raw records an entity has; raw records
are brought to cells by a partially combined aggregate first. All functions of one frame share the
specification that ``series`` returns, so that Spark plans a single exchange and sort for them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from paneloom.session import cut_lineage

#: Different steps that a task counts before it passes them on.
STEPS = 100_000


def series(key: str | Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*orders)


def increment_col(col: str | Column, w: WindowSpec) -> Column:
    """Difference to the previous row, never negative; zero where it cannot be formed."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.greatest(value - F.lag(value).over(w), F.lit(0)), F.lit(0))


def rolling_mean_col(col: str | Column, w: WindowSpec, n: int = 7) -> Column:
    """Trailing mean over ``n`` rows, nulls skipped."""
    return F.avg(col).over(w.rowsBetween(-(n - 1), 0))


def running_total_col(col: str | Column, w: WindowSpec) -> Column:
    return F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, 0))


def increments(df: DataFrame, key: str, order: str, col: str, name: str) -> DataFrame:
    return df.withColumn(name, increment_col(F.col(col).cast("double"), series(key, order)))


def rolling_mean(df: DataFrame, key: str, order: str, col: str, n: int = 7, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_{n}", rolling_mean_col(col, series(key, order), n))


def running_total(df: DataFrame, key: str, order: str, col: str, name: str) -> DataFrame:
    """Running sum; rows whose value is null keep null, as they are left out of the series."""
    total = running_total_col(col, series(key, order))
    return df.withColumn(name, F.when(F.col(col).isNotNull(), total))


def add_lags(df: DataFrame, col: str, lags: Sequence[int] = (7, 14, 21), key: str = "ISO_Code", order: str = "Date") -> DataFrame:
    w = series(key, order)
    return df.withColumns({f"lag_{n}": F.lag(col, n).over(w) for n in lags})


def seeded_diff(col: Column, seed: Column, w: WindowSpec) -> Column:
    """Difference to the previous row; the first row is compared with ``seed``."""
    first = F.row_number().over(w) == 1
    return col - F.when(first, seed).otherwise(F.lag(col).over(w))


def last_before(df: DataFrame, key: str, order: str, col: str, cut: object, name: str) -> DataFrame:
    """Last non-null value per key before a day."""
    rows = df.filter((F.col(order) < F.lit(cut).cast("date")) & F.col(col).isNotNull())
    return rows.groupBy(key).agg(F.max_by(col, order).alias(name))


def first_batches(df: DataFrame, key: str, batch: str, n: int) -> DataFrame:
    """Rows of the first ``n`` arrival batches per key; batches are ranked, not their rows."""
    batches = df.select(key, batch).distinct()
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy(batch))
    keep = batches.withColumn("_r", rank).filter(F.col("_r") <= n).drop("_r")
    return df.join(keep, [key, batch], "left_semi")


def _summed(steps: pa.Table) -> pa.Table:
    """One row for each step (src, dst)."""
    return steps.group_by(["src", "dst"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["src", "dst", "n"])


def path_steps(df: DataFrame, path: str, order: Sequence[str], node: str) -> DataFrame:
    """(src, dst, n): how often each node follows another in the paths by ``order``, ties by node.

    Rows are dealt by range over (path, order), so a path spreads over as many tasks as its length asks for.
    A task counts the steps inside its sorted rows, a batch at a time in Arrow; only its first and its last row go on, to be laid end to
    end with those of its neighbours. A null path is one path; steps to a null node are left out.
    """
    keys = [path, *[c for c in order if c not in (path, node)], node]
    dealt = df.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ends = dealt.select(F.col(path).alias("path"), F.col(node).cast("string").alias("node"))
    kind = df.schema[path].dataType.simpleString()
    names = ["part", "edge", "path", "src", "dst", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first, last = TaskContext.get().partitionId(), [], None, None

        def told(rows: pa.Table, edge: int, path: list | None = None) -> list[pa.RecordBatch]:
            size, kind_of = rows.num_rows, last.schema.field("path").type
            cols = [pa.array([part] * size, pa.int32()), pa.array([edge] * size, pa.int32()), pa.array(path or [None] * size, kind_of)]
            return pa.table([*cols, *[rows[c] for c in names[3:]]], names=names).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            first = rows.slice(0, 1) if first is None else first
            last = rows.slice(rows.num_rows - 1).to_batches()[0]
            before, after = rows.slice(0, rows.num_rows - 1), rows.slice(1)
            alike = pc.fill_null(pc.equal(before["path"], after["path"]), False)
            alike = pc.or_(alike, pc.and_(pc.is_null(before["path"]), pc.is_null(after["path"])))
            pairs = pa.table({"src": before["node"], "dst": after["node"]}).filter(pc.and_(alike, pc.is_valid(after["node"])))
            held.append(_summed(pairs.append_column("n", pa.array(np.ones(pairs.num_rows, np.int64)))))
            if sum(t.num_rows for t in held) > STEPS:
                held = [_summed(pa.concat_tables(held))]
                if held[0].num_rows > STEPS // 2:
                    yield from told(held[0], 0)
                    held = []
        if last is not None:
            if held:
                yield from told(_summed(pa.concat_tables(held)), 0)
            start, stop = first.to_pylist()[0], last.to_pylist()[0]
            one = lambda src, dst: pa.table([pa.array([src], pa.string()), pa.array([dst], pa.string()), pa.array([0], pa.int64())], names=names[3:])
            yield from told(one(None, start["node"]), 1, [start["path"]])
            yield from told(one(stop["node"], None), 2, [stop["path"]])

    counted = cut_lineage(ends.mapInArrow(run, f"part int, edge int, path {kind}, src string, dst string, n long"), "steps")
    # Two rows for each task: the last row of a part meets the first one of the next part that has rows.
    along = Window.orderBy("part", "edge")
    following = F.lead(F.struct("path", F.col("dst").alias("node"))).over(along)
    joints = counted.filter("edge > 0").withColumn("next", following).filter("edge = 2 and next is not null")
    joints = joints.filter(F.col("path").eqNullSafe(F.col("next.path")) & F.col("next.node").isNotNull())
    inside = counted.filter("edge = 0").select("src", "dst", "n")
    steps = inside.union(joints.select("src", F.col("next.node").alias("dst"), F.lit(1).cast("long").alias("n")))
    back = [F.col(c).cast(df.schema[node].dataType).alias(c) for c in ("src", "dst")]
    return steps.groupBy("src", "dst").agg(F.sum("n").alias("n")).select(*back, "n")
