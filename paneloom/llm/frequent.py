"""Frequent pieces of a corpus without a shuffle of all pieces: each task reports its own most frequent ones, and
only these reports are summed up. They steer caches alone, never a result."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paneloom.session import cut_lineage

HELD = 1_000_000  # pieces that a task counts at a time; beyond it the rarer ones are forgotten
LONGEST = 64  # bytes of a piece that is worth remembering
STEPS = 8  # classes of frequency between a number and its double


def split_pieces(texts: pa.Array) -> pa.ListArray:
    """Pieces of each text, where each space or line end begins a new one: a piece stands for itself behind a
    space, or begins with its line end."""
    return pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" \n"), pattern=" ")


def frequent_pieces(docs: DataFrame, count: int, held: int = HELD) -> list[str]:
    """At most ``count`` pieces of ``docs.text``, the most frequent first. Ties go to the smaller piece.

    The driver reads a histogram of frequencies, whose classes do not grow with the corpus, finds the class from
    which on ``count`` pieces suffice, and collects the pieces above it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def total() -> pa.Table:
            if not parts:
                return pa.table({"k": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
            return pa.concat_tables(parts).group_by("k").aggregate([("n", "sum")]).rename_columns(["k", "n"])

        for batch in batches:
            found = split_pieces(batch.column("text").drop_null()).flatten().value_counts()
            part = pa.table({"k": found.field("values"), "n": found.field("counts")})
            parts.append(part.filter(pc.and_(pc.less_equal(pc.binary_length(part["k"]), LONGEST), pc.not_equal(part["k"], ""))))
            if sum(map(len, parts)) > held:
                parts = [total()]
                if len(parts[0]) > held // 2:
                    parts = [parts[0].sort_by([("n", "descending"), ("k", "ascending")]).slice(0, held // 2)]
        for out in total().sort_by([("n", "descending"), ("k", "ascending")]).slice(0, count).combine_chunks().to_batches():
            yield out

    told = docs.select("text").mapInArrow(run, "k string, n long")
    step = F.floor(F.log2("n") * STEPS).cast("int")
    summed = cut_lineage(told.groupBy("k").agg(F.sum("n").alias("n")).withColumn("step", step), "frequent")
    least, left = None, count
    for row in summed.groupBy("step").agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        left -= row["n"]
        if left < 0:
            break
        least = row["step"]
    if least is None:
        return []
    return [row["k"] for row in sorted(summed.where(F.col("step") >= least).select("k", "n").collect(), key=lambda r: (-r["n"], r["k"]))]
