"""LM scoring (6): an interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted hash
arrays in the shared folder, memory-mapped by the workers.

Tasks send sorted, compressed blocks of counts instead of a row for each n-gram: the exchanges stay at a few
bytes for a distinct bigram, and every array is dealt by hash or by a range of word numbers, so frequent words
are nobody's burden. Nothing of the size of the corpus reaches the driver.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from paneloom.llm.tasks import documents, mix, mounted_dir, words
from paneloom.session import cut_lineage

END = b"\nend"  # no word holds a line end
CHUNK = 2_000_000  # tokens that a task counts at a time
CACHED = 300_000  # words whose numbers a worker remembers
BLOCK = "part int, data binary"
LOW = np.uint64(32)


def ranges_of(parts: int) -> int:
    """How many ranges the word numbers fall into: fewer than parts, as every part sends to every range."""
    return max(1, parts // 4)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length; the first one ascends and is stored by its steps."""
    first, *rest = arrays
    cells = [np.diff(first, prepend=first.dtype.type(0)), *rest]
    raw = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes() for c in cells)
    return len(first).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    count = int.from_bytes(data[:8], "little")
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(data[8:], count * sum(widths), "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, width in zip(kinds, widths):
        out.append(np.ascontiguousarray(raw[at : at + count * width].reshape(width, count).T).view(kind).ravel())
        at += count * width
    return [np.cumsum(out[0], dtype=out[0].dtype), *out[1:]]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash ranges of equal width, ascending with the hash."""
    return (((hashes >> LOW) * np.uint64(parts)) >> LOW).astype(np.int64)


def blocks(parts: np.ndarray, count: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """A row for each part that has entries; ``parts`` ascends."""
    ends = np.searchsorted(parts, np.arange(count + 1))
    used = [p for p in range(count) if ends[p] < ends[p + 1]]
    data = [packed(*(a[ends[p] : ends[p + 1]] for a in arrays)) for p in used]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])


def store(folder: str, name: str, part: int, array: np.ndarray) -> None:
    """One file in one step, so that a repeated task replaces it by the same."""
    path = os.path.join(folder, f"{name}-{part}.npy")
    with open(fresh := f"{path}.{uuid.uuid4().hex}", "wb") as out:
        np.save(out, array)
    os.replace(fresh, path)


def stored(folder: str, name: str, parts: int, kind: str) -> list[np.ndarray]:
    paths = [os.path.join(folder, f"{name}-{p}.npy") for p in range(parts)]
    return [np.load(p, mmap_mode="r") if os.path.exists(p) else np.empty(0, kind) for p in paths]


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their values."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, *(np.bincount(inverse, v, len(distinct)).astype(np.int64) for v in values)


class Words:
    """Numbers of words in a task: places in the sorted array of all hashes, read by memory map."""

    def __init__(self, folder: str, parts: int, starts: list[int], counts: bool = False):
        self.starts, self.parts, self.known = np.array(starts), parts, {}
        self.hashes = stored(folder, "words", parts, "<u8")
        self.counts = stored(folder, "counts", parts, "<i8") if counts else None
        self.unknown = starts[-1] + 1  # behind the words and the beginning of a text

    def learn(self, found: set[bytes]) -> None:
        if len(self.known) > CACHED:
            self.known.clear()
        new = [w for w in found if w not in self.known]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
        order = np.argsort(hashes)
        asked = hashes[order]
        numbers = np.full(len(new), self.unknown)
        ends = np.searchsorted(part_of(asked, self.parts), np.arange(self.parts + 1))
        for p in np.flatnonzero(np.diff(ends)):
            own, held = slice(ends[p], ends[p + 1]), self.hashes[p]
            if len(held):
                at = np.minimum(np.searchsorted(held, asked[own]), len(held) - 1)
                numbers[own] = np.where(held[at] == asked[own], self.starts[p] + at, self.unknown)
        self.known.update(zip((new[k] for k in order), numbers.tolist()))

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, each with its end, and the number of tokens of each."""
        tokens = [words(t) for t in texts]
        for x in tokens:
            x.append(END)
        self.learn(set().union(*tokens))
        lengths = np.array([len(x) for x in tokens], np.int64)
        return np.concatenate([np.fromiter(map(self.known.__getitem__, x), np.int64, len(x)) for x in tokens]), lengths

    def count(self, numbers: np.ndarray) -> np.ndarray:
        return gathered(self.counts, self.starts, numbers)


def gathered(arrays: list[np.ndarray], starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Entries of an array that lies in consecutive parts; 0 behind its end."""
    asked, inverse = np.unique(numbers, return_inverse=True)
    out = np.zeros(len(asked), np.int64)
    ends = np.searchsorted(asked, starts)
    for p in np.flatnonzero(np.diff(ends)):
        if len(arrays[p]):
            out[ends[p] : ends[p + 1]] = arrays[p][asked[ends[p] : ends[p + 1]] - starts[p]]
    return out[inverse]


def before(numbers: np.ndarray, lengths: np.ndarray, begin: int) -> np.ndarray:
    """The word number in front of each; ``begin`` at the start of a text."""
    left = np.roll(numbers, 1)
    left[np.cumsum(lengths) - lengths] = begin
    return left


def text_chunks(batches: Iterator[pa.RecordBatch], characters: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        texts, start = batch.column("text"), 0
        while start < batch.num_rows:
            chunk, size = [], 0
            while size < characters and start + len(chunk) < batch.num_rows:
                chunk.append(texts[start + len(chunk)].as_py())
                size += len(chunk[-1] or "") + 1
            yield batch.slice(start, len(chunk)), chunk
            start += len(chunk)


def discounts(counts: list[int]) -> list[float]:
    """D1, D2 and D3 from how many n-grams are counted 1, 2, 3 and 4 times; those of tiny corpora, where a
    number is missing, fall back to half the count."""
    n1, n2, n3, n4 = counts
    if not all(counts):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [min(k, max(0.0, k - (k + 1) * y * b / a)) for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]


@dataclass(frozen=True)
class Model:
    """What tasks need to score: where the arrays lie, and a few numbers."""

    folder: str
    parts: int
    starts: list[int]  # first word number of each part; at the end the number of words
    tokens: int
    bigrams: int
    high: list[float]  # discounts of bigrams
    low: list[float]  # discounts of continuations
    rest: float  # what the discounts of continuations free, shared by all words and one unknown

    @property
    def vocabulary(self) -> int:
        return self.starts[-1]


def count_words(texts: DataFrame, folder: str, parts: int) -> tuple[list[int], int]:
    """Writes the sorted hashes and counts of all words; gives the first number of each part and the tokens."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in text_chunks(batches, 8 * CHUNK):
            seen = Counter({END: len(chunk)})
            for text in chunk:
                seen.update(words(text))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen))
            order = np.argsort(hashes)
            counts = np.fromiter(seen.values(), np.int64, len(seen))[order]
            yield blocks(part_of(hashes[order], parts), parts, hashes[order], counts)

    def reduce(rows: pa.Table) -> pa.Table:
        cells = [unpacked(d, "<u8", "<i8") for d in rows.column("data").to_pylist()]
        part = rows.column("part")[0].as_py()
        hashes, counts = summed(np.concatenate([c[0] for c in cells]), np.concatenate([c[1] for c in cells]))
        store(folder, "words", part, hashes)
        store(folder, "counts", part, counts)
        return pa.table({"part": pa.array([part], pa.int32()), "words": [len(hashes)], "tokens": [int(counts.sum())]})

    told = texts.select("text").mapInArrow(send, BLOCK).groupBy("part").applyInArrow(reduce, "part int, words long, tokens long").collect()
    sizes = {row["part"]: row["words"] for row in told}
    return [0, *np.cumsum([sizes.get(p, 0) for p in range(parts)]).tolist()], sum(row["tokens"] for row in told)


def count_bigrams(texts: DataFrame, folder: str, parts: int, starts: list[int]) -> tuple[list[int], list[int]]:
    """Writes the sorted bigram hashes with their counts, and for each word number as a context its total and
    how many followers it has once, twice and more, and as a follower its number of contexts.

    Gives how many bigrams, and how many continuations, are counted 1, 2, 3, 4 and more times."""
    begin = starts[-1]
    ranges = ranges_of(parts)
    width = begin // ranges + 1  # word numbers of a range

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered = Words(folder, parts, starts)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            part = part_of(mix(keys), parts)
            order = np.argsort(part, kind="stable")
            return blocks(part[order], parts, keys[order], counts.astype(np.int32)[order])

        for _, chunk in text_chunks(batches, CHUNK):
            numbers, lengths = numbered.numbers(chunk)
            held.append(before(numbers, lengths, begin).astype(np.uint64) << LOW | numbers.astype(np.uint64))
            size += len(numbers)
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def reduce(rows: pa.Table) -> pa.Table:
        cells = [unpacked(d, "<u8", "<i4") for d in rows.column("data").to_pylist()]
        part = rows.column("part")[0].as_py()
        keys, counts = summed(np.concatenate([c[0] for c in cells]), np.concatenate([c[1] for c in cells]))
        hashes = mix(keys)
        order = np.argsort(hashes)
        store(folder, "bigrams", part, hashes[order])
        store(folder, "times", part, counts[order].astype(np.uint32 if counts.max() < 1 << 32 else np.int64))
        left, right = (keys >> LOW).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        contexts = summed(left, counts, counts == 1, counts == 2, counts > 2)
        followers = summed(right, np.ones(len(right)))
        both = [blocks(x[0] // width, ranges, *x) for x in (contexts, followers)]
        tables = [pa.Table.from_batches([b]).append_column("kind", pa.array([k] * b.num_rows)) for b, k in zip(both, ("context", "follower"))]
        histogram = np.bincount(np.minimum(counts, 5), minlength=6)[1:].astype(np.int64)
        told = pa.table({"part": pa.array([-1], pa.int32()), "data": pa.array([histogram.tobytes()], pa.binary()), "kind": ["bigrams"]})
        return pa.concat_tables([*tables, told])

    def gather(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        size = max(0, min(width, begin + 1 - part * width))
        dense = np.zeros((5, size), np.int64)  # total, once, twice, more, contexts
        for kind, data in zip(rows.column("kind").to_pylist(), rows.column("data").to_pylist()):
            x = unpacked(data, *["<i8"] * (5 if kind == "context" else 2))
            for row, values in zip((range(4) if kind == "context" else [4]), x[1:]):
                dense[row, x[0] - part * width] += values
        store(folder, "numbers", part, dense)
        histogram = np.bincount(np.minimum(dense[4], 5), minlength=6)[1:].astype(np.int64)
        return pa.table({"part": pa.array([-1], pa.int32()), "data": pa.array([histogram.tobytes()], pa.binary()), "kind": ["words"]})

    kinds = f"{BLOCK}, kind string"
    sent = cut_lineage(texts.select("text").mapInArrow(send, BLOCK).groupBy("part").applyInArrow(reduce, kinds), "bigrams")
    dense = sent.where("part >= 0").groupBy("part").applyInArrow(gather, kinds)
    total = {"bigrams": np.zeros(5, np.int64), "words": np.zeros(5, np.int64)}
    for row in dense.union(sent.where("part < 0").select(dense.columns)).collect():
        total[row["kind"]] += np.frombuffer(row["data"], np.int64)
    return total["bigrams"].tolist(), total["words"].tolist()


def train(texts: DataFrame, parts: int | None = None) -> Model:
    """A model of all rows of ``texts`` (column text); a null text is an empty one, its end still counts."""
    spark = texts.sparkSession
    folder = mounted_dir(spark, "lm")
    if folder is None:
        raise RuntimeError("the model is memory-mapped: spark.checkpoint.dir must be a mounted folder")
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts, tokens = count_words(texts, folder, parts)
    bigrams, followers = count_bigrams(texts, folder, parts, starts)
    high, low = discounts(bigrams[:4]), discounts(followers[:4])
    freed = low[0] * followers[0] + low[1] * followers[1] + low[2] * sum(followers[2:])
    return Model(folder, parts, starts, tokens, sum(bigrams), high, low, freed / sum(bigrams) if sum(bigrams) else 1.0)


class Scorer:
    """A model opened in a task."""

    def __init__(self, model: Model):
        self.m, self.words = model, Words(model.folder, model.parts, model.starts, counts=True)
        self.bigrams = stored(model.folder, "bigrams", model.parts, "<u8")
        self.times = stored(model.folder, "times", model.parts, "<u4")
        ranges = ranges_of(model.parts)
        width = model.vocabulary // ranges + 1
        self.dense = [x if len(x) else np.zeros((5, 0), np.int64) for x in stored(model.folder, "numbers", ranges, "<i8")]
        self.ranges = np.minimum(np.arange(ranges + 1) * width, model.vocabulary + 1)

    def numbers(self, row: int, asked: np.ndarray) -> np.ndarray:
        return gathered([x[row] for x in self.dense], self.ranges, asked)

    def bigram_counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        hashes, inverse = np.unique(mix(left.astype(np.uint64) << LOW | right.astype(np.uint64)), return_inverse=True)
        out = np.zeros(len(hashes), np.int64)
        ends = np.searchsorted(part_of(hashes, self.m.parts), np.arange(self.m.parts + 1))
        for p in np.flatnonzero(np.diff(ends)):
            own, held = slice(ends[p], ends[p + 1]), self.bigrams[p]
            if len(held):
                at = np.minimum(np.searchsorted(held, hashes[own]), len(held) - 1)
                out[own] = np.where(held[at] == hashes[own], self.times[p][at], 0)
        return out[inverse]

    def log_probabilities(self, right: np.ndarray, left: np.ndarray) -> np.ndarray:
        m = self.m
        less = lambda c, d: np.select([c == 0, c == 1, c == 2], [0.0, d[0], d[1]], d[2])
        spread = self.numbers(4, right)
        low = (spread - less(spread, m.low)) / max(m.bigrams, 1) + m.rest / (m.vocabulary + 1)
        total, once, twice, more = (self.numbers(k, left) for k in range(4))
        count = self.bigram_counts(left, right)
        freed = m.high[0] * once + m.high[1] * twice + m.high[2] * more
        seen = total > 0
        total = np.maximum(total, 1)
        return np.log10(np.where(seen, (count - less(count, m.high) + freed * low) / total, low))

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        numbers, lengths = self.words.numbers(texts)
        first = np.cumsum(lengths) - lengths
        counts = self.words.count(numbers)
        base = np.log10((counts + 1) / (self.m.tokens + self.m.vocabulary + 1))
        model = self.log_probabilities(numbers, before(numbers, lengths, self.m.vocabulary))
        return {
            "n_tokens": lengths, "n_known": np.add.reduceat((counts > 0).astype(np.int64), first), "base_score": np.add.reduceat(base, first),
            "score": np.add.reduceat(model, first),
        }


def score_documents(docs: DataFrame, training: Column | Callable[[DataFrame], Column], id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each document's n_tokens, n_known, train_tokens, base_score (add-one unigrams), score (log10 of the
    model's probability) and perplexity, from a model of the rows where ``training`` holds.

    Words are lower-cased; each text has one end token, so null and empty texts have a score too. Unknown
    words share one place beside the vocabulary; repeated rows count, and are scored, each time; without
    training rows every score is 0; further columns are ignored.
    """
    model = train(documents(docs.where(training), id_col, text_col))
    docs = documents(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch, chunk in text_chunks(batches, CHUNK):
            scored = scorer.score(chunk)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(scored[n]) for n in names)], names=["doc_id", *names])

    out = docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.tokens).cast("long")).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
