"""Substring dedup (11): prefix-partitioned suffix trees over the words of all documents.

A suffix begins at every word that a whole window follows; two suffixes that share the window meet in an internal
node as deep as the window. The suffixes are split by prefixes of different lengths: a suffix's prefix ends with the
first of its ``core``-word grams that hashes lowest in its window, so it is as long as the text makes it, and equal
windows have equal prefixes. Neighbouring suffixes share their core, and travel as one strip of words. Cores that
occur once have no internal node that deep and are left out before any text moves; strips that are alike are counted
where they are, and the subtrees of a core are built from different strips only. A core with too many different
strips for a task gets longer prefixes, up to the whole window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paneloom.llm.tasks import WordHashes, chain, documents, mix
from paneloom.session import cut_lineage

GROUP_WORDS = 1_000_000  # words of the strips whose subtrees a task builds at a time
CROWDED = 2_000  # different strips of one core, beyond which its prefixes get longer
CHUNK_WORDS = 2_000_000  # words that are hashed together
SENT = 500_000  # strips that a task remembers having sent the words of


def core_words(window: int) -> int:
    return max(1, window // 3)


def powers(hashes: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all grams of each size, by doubling; shorter by size - 1."""
    doubled = {1: hashes}
    size = 1
    while size * 2 <= max(sizes):
        half = doubled[size]
        doubled[size * 2] = chain(half[: max(0, len(half) - size)], half[size:])
        size *= 2
    out = {}
    for wanted in sizes:
        parts = [1 << k for k in range(wanted.bit_length() - 1, -1, -1) if wanted >> k & 1]
        grams, at = doubled[parts[0]], parts[0]
        for part in parts[1:]:
            count = max(0, len(hashes) - at - part + 1)
            grams = chain(grams[:count], doubled[part][at : at + count])
            at += part
        out[wanted] = mix(grams + np.uint64(wanted))
    return out


def first_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the lowest of each ``width`` neighbours, the first of equal ones."""
    places, low, size = np.arange(len(values)), values, 1

    def better(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray):
        keep = a <= b
        return np.where(keep, a, b), np.where(keep, at_a, at_b)

    while size * 2 <= width:
        low, places = better(low[: max(0, len(low) - size)], low[size:], places[: max(0, len(low) - size)], places[size:])
        size *= 2
    rest = width - size
    return better(low[: max(0, len(low) - rest)], low[rest:], places[: max(0, len(low) - rest)], places[rest:])[1]


class Strips:
    """The strips of texts that lie one after the other: runs of window starts with the same core."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, window: int):
        core = core_words(window)
        grams = powers(flat, [core, window])
        count = max(0, len(flat) - window + 1)
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(lengths)), lengths)
        inside = (np.arange(count) + window <= (starts + lengths)[owner[:count]]) if count else np.zeros(0, bool)
        cores = first_lowest(grams[core], window - core + 1)[:count]
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1] | (cores[1:] != cores[:-1])
        begin = np.flatnonzero(fresh)
        closing = inside.copy()
        closing[:-1] &= ~inside[1:] | fresh[1:]
        end = np.flatnonzero(closing)
        self.owner, self.start, self.count = owner[begin], begin - starts[owner[begin]], end - begin + 1
        self.core = grams[core][cores[begin]]
        whole = grams[window]
        self.strip = mix(chain(whole[begin], whole[end]) + self.count.astype(np.uint64))


def strip_keys(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, version, start, core, strip): a row for each strip of a document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "version", "start", "starts", "core", "strip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            held: list[np.ndarray] = []
            rows: list[int] = []

            def strips() -> pa.RecordBatch:
                found = Strips(np.concatenate(held), np.array([len(x) for x in held]), window)
                at = pa.array(np.array(rows)[found.owner])
                cells = [batch.column("doc_id").take(at), batch.column("version").take(at), pa.array(found.start.astype(np.int32)), pa.array(found.count.astype(np.int16))]
                return pa.RecordBatch.from_arrays([*cells, pa.array(found.core.view(np.int64)), pa.array(found.strip.view(np.int64))], names=names)

            size = 0
            for row, text in enumerate(batch.column("text")):
                own = hashes.of(text.as_py().encode().split()) if text.is_valid else np.empty(0, np.uint64)
                if len(own) >= window:
                    held.append(own)
                    rows.append(row)
                    size += len(own)
                if size >= CHUNK_WORDS or held and row == batch.num_rows - 1:
                    yield strips()
                    held, rows, size = [], [], 0

    return docs.select("doc_id", "version", "text").mapInArrow(run, f"doc_id {kind}, version long, start int, starts short, core long, strip long")


def strip_words(docs: DataFrame, window: int) -> DataFrame:
    """(core, strip, starts, words) of the strips listed in ``held`` of each document: the words of a strip once
    for each task that meets it, with the number of window starts in it."""
    names = ["core", "strip", "starts", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            out: list[tuple[int, int, int, bytes]] = []
            for text, held in zip(batch.column("text"), batch.column("held")):
                new = [x for x in held.as_py() if (x["core"], x["strip"]) not in sent]
                if not new:
                    continue
                words = text.as_py().encode().split()
                for x in new:
                    key = (x["core"], x["strip"])
                    if key not in sent:
                        sent.add(key)
                        out.append((*key, x["starts"], b" ".join(words[x["start"] : x["start"] + x["starts"] + window - 1])))
            if len(sent) > SENT:
                sent.clear()
            kinds = (pa.int64(), pa.int64(), pa.int16(), pa.binary())
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select("text", "held").mapInArrow(run, "core long, strip long, starts short, words binary")


class Subtrees:
    """The suffix trees of some strips, down to the depth of the window.

    ``ranks[d]`` numbers the nodes of depth d (1, 2, 4, ... and the window) that a suffix passes: equal numbers are
    one node. A node's children are told apart by the node that their next words pass.
    """

    def __init__(self, strips: list[bytes], window: int):
        words = [s.split(b" ") for s in strips]
        numbers: dict[bytes, int] = {}
        flat = np.array([numbers.setdefault(w, len(numbers)) for strip in words for w in strip], np.int64)
        lengths = np.array([len(strip) for strip in words], np.int64)
        starts = lengths - window + 1
        self.owner = np.repeat(np.arange(len(strips)), starts)
        self.at = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
        suffix = self.at + np.repeat(np.cumsum(lengths) - lengths, starts)
        rank, depth = flat, 1
        self.ranks = {1: rank[suffix]}
        while depth < window:
            step = min(depth, window - depth)
            node, next_node = rank[: len(rank) - step], rank[step:]  # step <= depth: two overlapping or touching parts
            _, rank = np.unique(node * (int(rank.max(initial=0)) + 1) + next_node, return_inverse=True)
            depth += step
            self.ranks[depth] = rank[suffix]

    def leaves(self, depth: int, weights: np.ndarray) -> np.ndarray:
        """For each suffix, how many occurrences lie below its node of this depth; a strip stands for ``weights``."""
        nodes = self.ranks[depth]
        return np.bincount(nodes, weights[self.owner], int(nodes.max(initial=-1)) + 1)[nodes]


def repeated_starts(strips: list[bytes], weights: np.ndarray, window: int) -> np.ndarray:
    """For each strip, a bit for each of its starts whose node of the window's depth is internal."""
    trees = Subtrees(strips, window)
    internal = trees.leaves(window, weights) >= 2
    bits = np.zeros(len(strips), np.uint64)
    np.bitwise_or.at(bits, trees.owner[internal], np.uint64(1) << trees.at[internal].astype(np.uint64))
    return bits.view(np.int64)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    """(core, strip, occurrences, words) from rows in the order of core and strip, some with a count, some with words."""
    last, number, words = None, 0, b""
    for batch in batches:
        for core, strip, n, own in zip(*(batch.column(c).to_pylist() for c in ("core", "strip", "n", "words"))):
            if (core, strip) != last:
                if last is not None:
                    yield *last, number, words
                last, number, words = (core, strip), 0, b""
            number += n
            words = own or words
    if last is not None:
        yield *last, number, words


def subtree_masks(rows: DataFrame, window: int, group_words: int) -> DataFrame:
    """(core, strip, mask): the repeated starts of each strip, from all strips of each core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def masks() -> pa.RecordBatch:
            bits = repeated_starts([x[3] for x in held], np.array([x[2] for x in held], np.int64), window)
            cells = [pa.array([x[k] for x in held], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([*cells, pa.array(bits)], names=["core", "strip", "mask"]).filter(pa.array(bits != 0))

        for row in merged(batches):
            if size >= group_words and row[0] != held[-1][0]:
                yield masks()
                held, size = [], 0
            held.append(row)
            size += row[3].count(b" ") + 1
        if held:
            yield masks()

    return rows.repartition("core").sortWithinPartitions("core", "strip").mapInArrow(run, "core long, strip long, mask long")


def window_masks(rows: DataFrame, window: int) -> DataFrame:
    """The same for crowded cores: here a suffix's prefix is its whole window, so that a core's suffixes spread over
    all tasks, a node is one prefix, and its occurrences are summed up before and after the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for core, strip, n, words in merged(batches):
            own = hashes.of(words.split(b" "))
            p1, p2 = (powers(own ^ np.uint64(seed), [window])[window].view(np.int64) for seed in (0, 0x5BD1E995))
            same = [pa.array(np.full(len(p1), x, np.int64)) for x in (core, strip, n)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(len(p1), dtype=np.int32)), pa.array(p1), pa.array(p2)], names=["core", "strip", "n", "at", "p1", "p2"])

    told = rows.repartition("core", "strip").sortWithinPartitions("core", "strip").mapInArrow(run, "core long, strip long, n long, at int, p1 long, p2 long")
    suffixes = cut_lineage(told, "suffixes")
    nodes = cut_lineage(suffixes.groupBy("p1", "p2").agg(F.sum("n").alias("leaves")).where("leaves >= 2").drop("leaves"), "nodes")
    bit = F.expr("shiftleft(1L, at)")
    return suffixes.join(nodes, ["p1", "p2"], "left_semi").groupBy("core", "strip").agg(F.bit_or(bit).alias("mask"))


def repeated_spans(docs: DataFrame, window: int, group_words: int = GROUP_WORDS, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, version, starts array<struct<start, mask>>): where repeated windows start in each document that has any."""
    keys = cut_lineage(strip_keys(docs, window), "strips")
    cores = cut_lineage(keys.groupBy("core").agg(F.count("*").alias("n")).where("n >= 2").drop("n"), "cores")
    alive = cut_lineage(keys.join(cores, "core"), "alive")
    counts = cut_lineage(alive.groupBy("core", "strip").agg(F.count("*").alias("n")), "counts")
    lists = alive.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "starts", "core", "strip")).alias("held"))
    same = F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("version") == F.col("v"))
    listed = docs.join(lists.withColumnsRenamed({"doc_id": "k", "version": "v"}), same).select("text", "held")
    words = cut_lineage(strip_words(listed, window), "words")
    rows = counts.withColumn("words", F.lit(None).cast("binary")).unionByName(words.select("core", "strip", F.lit(0).cast("long").alias("n"), "words"))
    crowds = cut_lineage(counts.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") > crowded).drop("n"), "crowds")
    masks = subtree_masks(rows.join(crowds, "core", "left_anti"), window, group_words)
    if not crowds.isEmpty():
        masks = masks.unionByName(window_masks(rows.join(crowds, "core", "left_semi"), window))
    found = alive.join(cut_lineage(masks, "masks"), ["core", "strip"])
    return found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "mask")).alias("starts"))


def covered(count: int, starts: list[dict], window: int) -> np.ndarray:
    """Which of ``count`` words lie inside a repeated window."""
    edges = np.zeros(count + 1, np.int64)
    begin = np.array([x["start"] for x in starts], np.int64)
    mask = np.array([x["mask"] for x in starts], np.int64)
    at = np.unique(np.concatenate([begin[mask >> k & 1 == 1] + k for k in range(core_span(window))]))
    edges[at] += 1
    edges[at + window] -= 1
    return np.cumsum(edges[:-1]) > 0


def core_span(window: int) -> int:
    """The most starts that a strip has."""
    return window - core_words(window) + 1


def dedup_substrings(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", group_words: int = GROUP_WORDS, crowded: int = CROWDED
) -> DataFrame:
    """(doc_id, n_words, n_removed, spans array<struct<start, end>>, text): each document's words outside all windows
    of ``window`` words that also start anywhere else, joined by one space, and the repeated spans, in words.

    Words are maximal runs of anything but ASCII white space. Every occurrence goes, the first one too, and windows
    are judged on the input. Null and empty texts and those shorter than a window have no repeats; rows that share a
    key, or key and text, are documents of their own; very long texts are taken whole; an empty table gives no rows;
    further columns are ignored. ``window`` may be 2 to 60.
    """
    if not 2 <= window <= 60:
        raise ValueError("a window has 2 to 60 words")
    named = documents(docs, id_col, text_col).withColumn("version", F.xxhash64(F.coalesce("text", F.lit(""))))
    kind = named.schema["doc_id"].dataType.simpleString()
    found = repeated_spans(named, window, group_words, crowded).withColumnsRenamed({"doc_id": "k", "version": "v"})
    joined = named.join(found, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("version") == F.col("v")), "left").select("doc_id", "text", "starts")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = ["doc_id", "n_words", "n_removed", "spans", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, spans, texts = [], [], [], []
            for text, starts in zip(batch.column("text"), batch.column("starts")):
                words = text.as_py().encode().split() if text.is_valid else []
                counts.append(len(words))
                own, kept, gone = [], words, 0
                if starts.is_valid:
                    inside = covered(len(words), starts.as_py(), window)
                    gone = int(inside.sum())
                    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False)).reshape(-1, 2)
                    own = [{"start": a, "end": b} for a, b in edge.tolist()]
                    kept, last = [], 0
                    for a, b in edge.tolist():
                        kept += words[last:a]
                        last = b
                    kept += words[last:]
                removed.append(gone)
                spans.append(own)
                texts.append(b" ".join(kept))
            cells = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(cells, names=names)

    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start:int,end:int>>, text string")
