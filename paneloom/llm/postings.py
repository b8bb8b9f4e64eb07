"""Benchmark decontamination (9): a positional inverted index over document shards, searched for phrases.

The index is partitioned by document, as search engines shard it: a shard is some megabytes of whole
documents, and holds for each term the sorted positions of its occurrences. Building and searching need no
shuffle, a frequent term never meets in one task, and a lost executor costs the shards it was working on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paneloom.llm.tasks import LOWER, SharedArrays, WordHashes, documents
from paneloom.session import cut_lineage

SHARD_BYTES = 4_000_000  # text of a shard; a longer document is a shard of its own
BLOCK_WORDS = 500_000  # query words that the driver and a task hold at a time
INDEX = "doc_ids array<{0}>, versions array<long>, n_words binary, terms binary, ends binary, positions binary"

#: Everything in ASCII but digits and letters separates terms; A-Z become a-z; bytes from 0x80 on are in terms.
TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in LOWER)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split() if text else []


def build_index(docs: DataFrame, vocabulary: SharedArrays | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Postings of ``docs`` (doc_id, text), a row for each shard: the documents with a hash of their texts and their word counts, the
    sorted term hashes, and the positions of all terms one after the other, with the end of each list.
    Positions run through the shard; one free place after each document keeps phrases from crossing.

    With ``vocabulary`` (an array "terms" of sorted hashes) only these terms are stored: postings that no
    query asks for would only cost space. Null texts have no words; keys may repeat or be null.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        wanted = None if vocabulary is None else vocabulary.open()["terms"]
        ids: list = []
        versions: list = []
        found: list[np.ndarray] = []
        size = 0

        def shard() -> pa.RecordBatch:
            counts = np.array([len(x) for x in found], np.int32)
            places = np.arange(counts.sum(), dtype=np.int64) + np.repeat(np.arange(len(counts)), counts)
            words = np.concatenate(found)
            if wanted is None:
                terms, codes = np.unique(words, return_inverse=True)
            else:
                at = np.minimum(np.searchsorted(wanted, words), max(len(wanted) - 1, 0))
                known = wanted[at] == words if len(wanted) else np.zeros(len(words), bool)
                terms, codes = np.unique(at[known], return_inverse=True)
                terms, places = wanted[terms], places[known]
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(terms)), dtype=np.int64)
            cells = [counts, terms.astype(np.uint64), ends, places[order].astype(np.int32)]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(id_type)), pa.array([versions], pa.list_(pa.int64())), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                names=["doc_ids", "versions", "n_words", "terms", "ends", "positions"],
            )

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for key, version, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "version", "text"))):
                ids.append(key)
                versions.append(version)
                found.append(hashes.of(terms_of(text)))
                size += len(text or "") + 1
                if size >= shard_bytes:
                    yield shard()
                    ids, versions, found, size = [], [], [], 0
        if ids:
            yield shard()

    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(run, INDEX.format(kind))


class Shard:
    """One row of the index in a task."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        cell = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)
        self.ids, self.versions = (batch.column(c)[row].values for c in ("doc_ids", "versions"))
        self.n_words = cell("n_words", np.int32).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.n_words + 1)))
        self.terms, self.ends, self.positions = cell("terms", np.uint64), cell("ends", np.int64), cell("positions", np.int32)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number in this shard of each term (any number for unknown ones), and its occurrences."""
        if not len(self.terms):
            return np.zeros(terms.shape, np.int64), np.zeros(terms.shape, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at, np.where(self.terms[at] == terms, np.diff(self.ends, prepend=0)[at], 0)

    def postings(self, number: int) -> np.ndarray:
        return self.positions[self.ends[number - 1] if number else 0 : self.ends[number]]

    def phrase(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Where the phrase starts: lists, shifted to its start, intersected from the rarest term on."""
        order = np.argsort(counts, kind="stable")
        starts = self.postings(numbers[order[0]]) - order[0]
        for k in order[1:]:
            held = self.postings(numbers[k])
            at = np.searchsorted(held, starts + k)
            at[at == len(held)] = 0
            starts = starts[held[at] == starts + k]
            if not len(starts):
                break
        return starts


def phrase_blocks(benchmark: DataFrame, window: int, block_words: int) -> tuple[SharedArrays, list[tuple[SharedArrays, list[str]]]]:
    """The vocabulary of the benchmark, and its windows in blocks of some ``block_words`` words.

    The driver holds one block at a time, and so does a task, whatever the size of the benchmark.
    """
    spark = benchmark.sparkSession
    hashes = WordHashes()
    seen: set[int] = set()
    blocks: list[tuple[SharedArrays, list[str]]] = []
    items: list[str] = []
    found: list[np.ndarray] = []

    def flush() -> None:
        lengths, owners, flat = [], [], []
        for number, words in enumerate(found):
            size = min(window, len(words))
            for start in range(len(words) - size + 1 if size else 0):
                lengths.append(size)
                owners.append(number)
                flat.append(words[start : start + size])
        arrays = {"lengths": np.array(lengths, np.int64), "owners": np.array(owners, np.int64), "words": np.concatenate(flat or [np.empty(0, np.uint64)])}
        blocks.append((SharedArrays(spark, "phrases", arrays), list(items)))

    for row in benchmark.select("doc_id", "text").toLocalIterator():
        items.append("null" if row["doc_id"] is None else str(row["doc_id"]))
        found.append(hashes.of(terms_of(row["text"])))
        seen.update(found[-1].tolist())
        if sum(map(len, found)) >= block_words:
            flush()
            items, found = [], []
    if items:
        flush()
    return SharedArrays(spark, "vocabulary", {"terms": np.array(sorted(seen), np.uint64)}), blocks


def find_phrases(index: DataFrame, blocks: list[tuple[SharedArrays, list[str]]]) -> DataFrame:
    """A row for each document of the index: version (the hash of its text), n_words, n_hit (words inside any occurrence) and the sorted
    distinct items that own an occurring phrase."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = []
        for shared, items in blocks:
            q = shared.open()
            queries.append((q["lengths"], np.concatenate(([0], np.cumsum(q["lengths"]))), q["owners"], q["words"], items))
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                edges = np.zeros(shard.starts[-1] + 1, np.int32)
                owned: list[set[str]] = [set() for _ in shard.ids]
                for lengths, begins, owners, words, items in queries:
                    if not len(lengths):
                        continue
                    numbers, counts = shard.lists(words)
                    rarest = np.minimum.reduceat(counts, begins[:-1])
                    for phrase in np.flatnonzero(rarest):
                        own = slice(begins[phrase], begins[phrase + 1])
                        starts = shard.phrase(numbers[own], counts[own])
                        if len(starts):
                            edges[starts] += 1
                            np.subtract.at(edges, starts + lengths[phrase], 1)
                            for document in np.unique(shard.document(starts)):
                                owned[document].add(items[owners[phrase]])
                hit = np.concatenate(([0], np.cumsum(np.cumsum(edges) > 0)))
                n_hit = hit[shard.starts[1:]] - hit[shard.starts[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [shard.ids, shard.versions, pa.array(shard.n_words), pa.array(n_hit.astype(np.int64)), pa.array([sorted(x) for x in owned], pa.list_(pa.string()))],
                    names=["doc_id", "version", "n_words", "n_hit", "items"],
                )

    return index.mapInArrow(run, f"doc_id {kind}, version long, n_words long, n_hit long, items array<string>")


def find_near(index: DataFrame, words: Sequence[str], within: int) -> DataFrame:
    """Proximity matches: (doc_id, first, last) of spans of at most ``within`` words that begin and end on
    query words and hold all of them, the shortest from each beginning. Words are single terms."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    terms = WordHashes().of([terms_of(w)[0] for w in dict.fromkeys(words)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                numbers, counts = shard.lists(terms)
                if not counts.all():
                    continue
                lists = [shard.postings(n).astype(np.int64) for n in numbers[np.argsort(counts, kind="stable")]]
                starts = np.unique(np.concatenate(lists))
                last = starts.copy()
                for held in lists:  # from the rarest list on, only beginnings near one of its entries live
                    at = np.searchsorted(held, starts)
                    alive = at < len(held)
                    starts, last, at = starts[alive], last[alive], at[alive]
                    last = np.maximum(last, held[at])
                    alive = last - starts < within
                    starts, last = starts[alive], last[alive]
                document = shard.document(starts)
                alive = document == shard.document(last)
                starts, last, document = starts[alive], last[alive], document[alive]
                base = shard.starts[document]
                yield pa.RecordBatch.from_arrays(
                    [shard.ids.take(pa.array(document)), pa.array(starts - base), pa.array(last - base)], names=["doc_id", "first", "last"]
                )

    return index.mapInArrow(run, f"doc_id {kind}, first long, last long")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    share: tuple[int, int] = (1, 20),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    block_words: int = BLOCK_WORDS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Each document's version (a hash of its text), n_words, n_hit, items and ``contaminated``: at least ``share`` of its words, and one
    at least, lie inside occurrences of benchmark windows of ``window`` words (all words of shorter items).

    Null and empty texts have no words and are clean; items without words match nothing; repeated rows each
    get their own result; very long texts are a shard of their own; an empty table gives no rows; further columns
    are ignored.
    """
    vocabulary, blocks = phrase_blocks(documents(benchmark, item_col, text_col), window, block_words)
    index = cut_lineage(build_index(documents(docs, id_col, text_col), vocabulary, shard_bytes), "postings")
    part, whole = share
    hit = (F.col("n_hit") > 0) & (F.col("n_hit") * whole >= F.col("n_words") * part)
    return find_phrases(index, blocks).withColumn("contaminated", hit)
