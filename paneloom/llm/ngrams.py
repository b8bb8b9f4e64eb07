"""Hashed word and character n-grams of a text, and models fitted to labelled rows of them, in a task or side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paneloom.llm.tasks import WordHashes, chain, documents, mix

BITS = 16  # each kind of n-gram has 2^16 buckets
WORD_SIZES, CHAR_SIZES = (1, 2), (2, 4)
SHAPES = 6
KINDS = len(WORD_SIZES) + len(CHAR_SIZES)
WIDTH = (KINDS << BITS) + SHAPES
KEY_BITS = 2**24  # of the filter that finds labelled documents
FEATURE_BYTES = 256_000_000  # features of a sample that a model is fitted to, at most


class Grams:
    """Features in a task. A bucket holds the share of a text's n-grams of that kind, so long and short texts
    compare; behind the buckets come the shares of repeated n-grams and the length."""

    def __init__(self):
        self.hashes = WordHashes()

    def parts(self, text: str | None) -> tuple[list[np.ndarray], np.ndarray]:
        """Buckets of each n-gram by kind, and the shape of the text."""
        own = self.hashes.of((text or "").encode().split())
        points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.uint64)
        out, shape = [], []
        for base, sizes, repeats in ((own, WORD_SIZES, True), (points + np.uint64(1), CHAR_SIZES, False)):
            for size in sizes:
                grams = base[: max(0, len(base) - size + 1)]
                for k in range(1, size):
                    grams = chain(grams, base[k : k + len(grams)])
                if repeats:
                    shape.append(1 - len(np.unique(grams)) / len(grams) if len(grams) else 0.0)
                out.append((mix(grams) >> np.uint64(64 - BITS)).astype(np.int64) + (len(out) << BITS))
        lines = [x for x in (text or "").split("\n") if x.strip()]
        letters = points[(points > 64) & (points < 91) | (points > 96) & (points < 123)]
        shape.append(1 - len(set(lines)) / len(lines) if lines else 0.0)
        shape.append(float((letters < 91).mean()) if len(letters) else 0.0)
        shape.append(min(1.0, float(np.log10(1 + len(own))) / 6))
        shape.append(1.0)
        return out, np.array(shape)

    def sparse(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features and their values."""
        parts, shape = self.parts(text)
        ids, values = [], []
        for part in parts:
            distinct, counts = np.unique(part, return_counts=True)
            ids.append(distinct)
            values.append(counts / max(1, len(part)))
        ids.append(np.arange(WIDTH - SHAPES, WIDTH))
        return np.concatenate(ids), np.concatenate([*values, shape])

    def score(self, text: str | None, weights: np.ndarray) -> float:
        parts, shape = self.parts(text)
        return float(sum(weights[p].mean() for p in parts if len(p)) + shape @ weights[-SHAPES:])


@dataclass
class Rows:
    """Sparse rows of a sample with their labels."""

    ids: np.ndarray
    values: np.ndarray
    ends: np.ndarray
    labels: np.ndarray

    def __len__(self) -> int:
        return len(self.labels)

    def row(self, k: int) -> slice:
        return slice(self.ends[k - 1] if k else 0, self.ends[k])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.ids] * self.values, np.append(0, self.ends[:-1])) if len(self) else np.empty(0)


def labelled_keys(labels: DataFrame, label: str, among: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of all labelled rows. Rows without a label or key are left out; of repeated labels the greatest holds."""
    named = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label")).where("label is not null and doc_id is not null")
    named = named.where(among) if among is not None else named
    return named.groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, rows: int, among: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h, k, label, ids, vals) of at most ``rows`` labelled documents, those whose keys hash lowest: the same ones
    each time, spread over the table, and whole texts. The bound makes the keys safe to broadcast. Rows without a
    label or key are left out; of repeated labels the greatest holds, and of texts that share a key one counts."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    picked = labelled_keys(labels, label, among, id_col).orderBy(order, "doc_id").limit(rows)
    met = documents(docs, id_col, text_col).join(F.broadcast(picked), "doc_id")
    texts = met.groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text")).withColumn("h", order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            found = [grams.sparse(t) for t in batch.column("text").to_pylist()]
            cells = [batch.column("h"), batch.column("doc_id").cast(pa.string()), batch.column("label"), *(pa.array([np.asarray(f[k], kind).tobytes() for f in found], pa.binary()) for k, kind in ((0, "<i4"), (1, "<f4")))]
            yield pa.RecordBatch.from_arrays(cells, names=["h", "k", "label", "ids", "vals"])

    return texts.mapInArrow(run, "h long, k string, label int, ids binary, vals binary")


def fit_in_task(features: DataFrame, fit: Callable[[Rows], tuple[np.ndarray, list[float]]], most_bytes: int = FEATURE_BYTES) -> tuple[np.ndarray, list[float]]:
    """Weights and numbers of a model fitted to a bounded sample, in a task: only the model comes to the driver.

    The task takes the rows in the order of their hashes until their features fill ``most_bytes``, whatever the
    length of the texts; at least one row counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, labels, size = [], [], [], 0
        for batch in batches:
            for own, weight, label in zip(batch.column("ids"), batch.column("vals"), batch.column("label").to_pylist()):
                size += 2 * len(own.as_buffer())
                if size <= most_bytes or not labels:
                    ids.append(np.frombuffer(own.as_py(), "<i4"))
                    values.append(np.frombuffer(weight.as_py(), "<f4"))
                    labels.append(label)
        ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
        flat = [np.concatenate([np.empty(0, kind), *parts]) for kind, parts in ((np.int32, ids), (np.float32, values))]
        weights, numbers = fit(Rows(*flat, ends, np.array(labels, np.int64)))
        cells = [pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([numbers], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(cells, names=["weights", "numbers"])

    told = features.repartition(1).sortWithinPartitions("h", "k").mapInArrow(run, "weights binary, numbers array<double>").first()
    if told is None:  # a table without partitions has no task
        return fit(Rows(np.empty(0, np.int32), np.empty(0, np.float32), np.empty(0, np.int64), np.empty(0, np.int64)))
    return np.frombuffer(told["weights"], "<f4"), list(told["numbers"])


def likely(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is one of ``keys``, and a few others: texts without a label need no exchange. A key
    is a bit among ``KEY_BITS``, by its hash, and the words of 64 bits that are not empty go to all tasks, 2^18 at most."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(KEY_BITS))
    word, bit = F.floor(place / 64).cast("long"), (place % 64).cast("int")
    words = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    met = docs.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(words), "_word")
    return met.where("shiftright(_bits, _bit) & 1L = 1L").select(*docs.columns)


def labelled_texts(docs: DataFrame, keys: DataFrame, shards: int, rare: int | None = None, copies: int = 1) -> DataFrame:
    """(doc_id, copy, label, text) of ``keys`` dealt to ``shards`` tasks, in the order of a hash of the key; of texts that
    share a key one counts. Rows of the label ``rare`` are there ``copies`` times."""
    met = likely(docs, keys).repartition(shards, "doc_id").join(keys.repartition(shards, "doc_id"), "doc_id").withColumn("copy", F.lit(0))
    if copies > 1:
        number = F.sequence(F.lit(0), F.when(F.col("label") == rare, F.lit(copies - 1)).otherwise(F.lit(0)))
        met = met.withColumn("copy", F.explode(number)).repartition(shards, "doc_id", "copy")
    texts = met.groupBy("doc_id", "copy").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return texts.sortWithinPartitions(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "copy")


def fit_shards(texts: DataFrame, shards: int, fit: Callable[[Rows], np.ndarray | None], most_bytes: int = FEATURE_BYTES) -> np.ndarray | None:
    """The mean, by rows, of the weights that ``fit`` finds for each of the ``shards`` partitions of ``texts`` (text,
    label); None where it finds none anywhere.

    Features stay in the task that fits them. Where those of a partition would fill more than ``most_bytes``, it is fitted
    in parts, so every row counts whatever the length of the texts; a part without one of the labels borrows some of that
    label from the parts before. Weights are summed up in two rounds of tasks, and the driver gets the sum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        grams, held, spare, size = Grams(), [], {}, 0
        total, count = np.zeros(WIDTH), 0

        def close() -> None:
            nonlocal held, size, count
            own = {label for *_, label in held}
            lent = [row for label, some in spare.items() if label not in own for row in some]
            for label in own:
                spare[label] = [row for row in held if row[2] == label][-64:]
            found, n, held, size = held + lent, len(held), [], 0
            ends = np.cumsum([len(f[0]) for f in found], dtype=np.int64)
            weights = fit(Rows(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), ends, np.array([f[2] for f in found], np.int64)))
            if weights is not None:
                total[:] += weights * n
                count += n

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
                ids, values = grams.sparse(text.as_py())
                if held and size + 8 * len(ids) > most_bytes:
                    close()
                held.append((ids.astype(np.int32), values.astype(np.float32), label))
                size += 8 * len(ids)
        if held:
            close()
        if count:
            yield sums(TaskContext.get().partitionId(), total, count)

    def sums(part: int, total: np.ndarray, count: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.astype("<f8").tobytes()], pa.binary()), pa.array([count], pa.int64())], names=["part", "total", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, count = None, np.zeros(WIDTH), 0
        for batch in batches:
            for own, some, n in zip(*(batch.column(c) for c in ("part", "total", "n"))):
                part = own.as_py() if part is None else part
                total += np.frombuffer(some.as_buffer(), "<f8")
                count += n.as_py()
        if count:
            yield sums(part, total, count)

    schema = "part int, total binary, n long"
    found = texts.select("text", "label").mapInArrow(run, schema)
    for parts in (max(1, int(shards**0.5)), 1):
        found = found.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, schema)
    told = found.first()
    return None if told is None else (np.frombuffer(told["total"], "<f8") / told["n"]).astype(np.float32)


class Learner:
    """Adaptive gradient steps on sparse rows: each weight has a rate of its own, and decays a little."""

    def __init__(self, rate: float = 2.0, decay: float = 1e-4):
        self.weights, self.squares = np.zeros(WIDTH), np.full(WIDTH, 1e-8)
        self.rate, self.decay = rate, decay

    def step(self, rows: Rows, picked: np.ndarray, slopes: np.ndarray) -> None:
        """``slopes``: the loss's slope by the score of each picked row."""
        parts = [rows.row(k) for k in picked]
        ids = np.concatenate([rows.ids[p] for p in parts])
        push = np.concatenate([rows.values[p] * s for p, s in zip(parts, slopes)])
        touched, inverse = np.unique(ids, return_inverse=True)
        slope = np.bincount(inverse, push, len(touched)) / len(picked) + self.decay * self.weights[touched]
        self.squares[touched] += slope**2
        self.weights[touched] -= self.rate * slope / np.sqrt(self.squares[touched])

    def scores(self, rows: Rows, picked: np.ndarray) -> np.ndarray:
        return np.array([self.weights[rows.ids[p]] @ rows.values[p] for p in map(rows.row, picked)])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def platt(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities, by Newton steps on the logistic loss with targets
    drawn in from 0 and 1, so that separable scores end at finite values."""
    good, bad = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    spread = scores.std() or 1.0
    x = np.stack([scores / spread, np.ones(len(scores))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        w = w - np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * w), -5, 5)
    return float(w[0] / spread), float(w[1])


def platt_of_table(scores: DataFrame) -> tuple[float, float]:
    """``platt`` of the rows (score, label) of a stored table: the sums of each Newton step are an aggregate."""
    size = scores.agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"), F.stddev_pop("score").alias("spread")).first()
    spread = size["spread"] or 1.0
    target = F.when(F.col("label") == 1, F.lit((size["good"] + 1) / (size["good"] + 2))).otherwise(F.lit(1 / (size["bad"] + 2)))
    x, w = F.col("score") / F.lit(spread), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.least(x * F.lit(float(w[0])) + F.lit(float(w[1])), F.lit(500.0)), F.lit(-500.0))))
        own = scores.select(x.alias("x"), (p * (1 - p)).alias("v"), (p - target).alias("d"))
        s = own.agg(F.sum(F.expr("v * x * x")), F.sum(F.expr("v * x")), F.sum("v"), F.sum(F.expr("d * x")), F.sum("d")).first()
        hessian = np.array([[s[0], s[1]], [s[1], s[2]]]) + np.eye(2) * 1e-3
        move = np.clip(np.linalg.solve(hessian, np.array([s[3], s[4]]) + 1e-3 * w), -5, 5)
        w = w - move
        if np.abs(move).max() < 1e-10:
            break
    return float(w[0] / spread), float(w[1])
