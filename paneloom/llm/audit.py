"""Filter interaction audit (13): a contingency tensor of the filters' verdicts, contracted for every order and step."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paneloom.session import cut_lineage

SPACE = " \t\n\u000b\f\r"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)  # what a contraction takes along one axis
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_rules(text: Column, min_words: int = 100, distinct: int = 80, capitals: int = 10, symbols: str = "[#$%&*|]") -> dict[str, Column]:
    """When a text fails: A, fewer than ``min_words`` words; B, fewer than ``distinct`` percent of them distinct;
    C, more than ``capitals`` percent of its code points are A-Z; D, it holds a symbol."""
    stripped = F.btrim(text, F.lit(SPACE))
    words = F.when(F.octet_length(stripped) == 0, F.array().cast("array<string>")).otherwise(F.split(stripped, "[ \\t-\\r]+", -1))
    upper = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < min_words,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * distinct,
        "C": upper.cast("long") * 100 > F.char_length(text).cast("long") * capitals,
        "D": text.rlike(symbols),
    }


def verdicts(docs: DataFrame, labels: DataFrame, rules=text_rules, copies: str = "E", id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> tuple[DataFrame, str]:
    """(part, code, good, toxic) of each document, and the filters' letters in the order of the code's bits.

    Texts leave the scan as a 128-bit digest and a few bits. Filter ``copies`` fails for every document whose
    text a smaller key holds: repeated digests are a table of their own, one row for a group of any size, so
    that its join with the documents splits where one text is very frequent.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tests = rules(F.col("text"))
    code = sum((F.when(test, 1 << k).otherwise(0) for k, test in enumerate(tests.values())), F.lit(0))
    digest = (F.xxhash64("text").alias("d1"), F.xxhash64(F.lit("second"), F.col("text")).alias("d2"))
    rows = cut_lineage(named.select("doc_id", "part", *digest, code.alias("code")), "verdicts")
    repeated = rows.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = rows.join(cut_lineage(repeated, "repeated"), ["d1", "d2"], "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << len(tests)).otherwise(0)
    return marked.select("part", (F.col("code") + copy).alias("code"), "good", "toxic"), "".join(tests) + copies


def steps_of(letters: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """Every (order, step), and what each contraction takes along each axis there, as rows x axes x 2."""
    steps, takes = [], {name: [] for name in ("kept", "removed", "failing", "unique")}
    for order in permutations(range(len(letters))):
        for step, own in enumerate(order):
            steps.append(("".join(letters[k] for k in order), step + 1))
            before = set(order[:step])
            takes["kept"].append([PASS if k in before or k == own else ALL for k in range(len(letters))])
            takes["removed"].append([FAIL if k == own else PASS if k in before else ALL for k in range(len(letters))])
            takes["failing"].append([FAIL if k == own else ALL for k in range(len(letters))])
            takes["unique"].append([FAIL if k == own else PASS for k in range(len(letters))])
    return steps, {name: np.array(rows, np.int64) for name, rows in takes.items()}


def contract(tensor: np.ndarray, takes: np.ndarray) -> np.ndarray:
    """``tensor`` (measures x 2 x ... x 2) contracted along all axes by each row of ``takes``: rows x measures."""
    axes = "abcdefghijklmnop"[: takes.shape[1]]
    terms = ",".join(["Z" + axes, *(f"Y{axis}" for axis in axes)])
    return np.einsum(f"{terms}->YZ", tensor, *(takes[:, k] for k in range(len(axes))), optimize="greedy")


def audit_cells(cells: DataFrame, letters: str) -> DataFrame:
    """The audit of (part, code, n, good, toxic), where ``code`` has bit k set if a row fails filter k.

    A part's cells are at most 2^filters rows, so they travel as one; parts are independent tasks' work.
    """
    steps, takes = steps_of(letters)
    orders, numbers = [s[0] for s in steps], [s[1] for s in steps]
    own = np.array([letters.index(order[step - 1]) for order, step in steps])
    shape = (3, *[2] * len(letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in zip(batch.column("part"), batch.column("held").to_pylist()):
                flat = np.zeros((3, 1 << len(letters)), np.int64)
                for cell in held:
                    flat[:, cell["code"]] += cell["n"], cell["good"], cell["toxic"]
                tensor = flat.reshape(shape).transpose(0, *range(len(letters), 0, -1))  # axis k is filter k
                found = {name: contract(tensor, take) for name, take in takes.items()}
                removed = found["removed"]
                shapley = np.bincount(own, removed[:, 0], len(letters)).astype(np.int64)[own]
                columns = (
                    found["kept"][:, 0], removed[:, 0], found["failing"][:, 0] - removed[:, 0], found["unique"][:, 0], removed[:, 1], removed[:, 2], shapley,
                )
                names = pa.array([part.as_py()] * len(steps), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(orders), pa.array(numbers, pa.int32()), *map(pa.array, columns)], names=["part", "filter_order", "step", *COUNTS]
                )

    gathered = cells.groupBy("part").agg(F.collect_list(F.struct("code", "n", "good", "toxic")).alias("held"))
    return gathered.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def audit_filters(docs: DataFrame, labels: DataFrame, rules=text_rules, copies: str = "E", id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """What every filter does at every step of every order of the filters, by part (values of ``part_col``).

    ``kept`` after the step, ``removed`` by it, ``redundant`` (it would have failed, but was gone before),
    ``unique_fails`` (no other filter fails), ``good_lost`` and ``toxic_lost`` among the removed, and ``shapley``, what the
    filter removes in all orders together. The corpus is read once and shuffled as small rows without text; the
    orders are worked out from the counts alone.

    Null texts count as empty ones, null parts as the empty name; a null key holds no text before others and fails
    no copy filter; rows that share key and text are no copies of each other, and each counts; of repeated labels the
    greatest holds, null labels are none; very long texts are judged whole; an empty table gives no rows; further
    columns are ignored.
    """
    rows, letters = verdicts(docs, labels, rules, copies, id_col, text_col, part_col)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return audit_cells(rows.groupBy("part", "code").agg(F.count("*").alias("n"), total("good"), total("toxic")), letters)
