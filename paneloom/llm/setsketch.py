"""MinHash near-dedup (8): SetSketch registers, banded, estimated jointly by likelihood, then verified."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from paneloom.llm.tasks import WordHashes, documents, map_documents, mix, shingle_hashes, words
from paneloom.session import cut_lineage


@dataclass(frozen=True)
class Sketch:
    """Registers of a set. ``base`` near 1 makes equal registers as telling as equal minima; ``rate`` keeps
    the smallest sets above 0. At similarity 0.8, 40 bands of 5 registers overlook a pair once in 8 million."""

    bands: int = 40
    rows: int = 5
    base: float = 1.001
    rate: float = 20.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @cached_property
    def edges(self) -> np.ndarray:
        """Ends of the intervals that hold an element's first, second, ... point: each is as likely."""
        k = np.arange(self.registers)
        return np.append(np.log1p(k / (self.registers - k)) / self.rate, np.inf)

    def of(self, elements: np.ndarray) -> np.ndarray:
        """Registers of distinct 64-bit elements.

        Each element owns one point in every interval, dealt to the registers by a permutation of its own;
        a register keeps its least point, on an exponential scale. Intervals ascend, so the points of the
        later ones are not made once every register is below them.
        """
        m, edges = self.registers, self.edges
        least = np.full(m, np.inf)
        step = mix(elements + np.uint64(0x51ED270B))
        shift = (step % np.uint64(m)).astype(np.int64)
        stride = self.strides[(step >> np.uint64(32)) % np.uint64(len(self.strides))]
        done, ahead = 0, -(-int(m * (np.log(m) + 2)) // len(elements))  # intervals that fill all registers as a rule
        while done < m and edges[done] <= least.max():
            k = np.arange(done, done := min(m, done + ahead))[:, None]
            uniform = (mix(elements + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53
            span = -np.expm1(-self.rate * (edges[k + 1] - edges[k]))
            points = edges[k] - np.log1p(-uniform * span) / self.rate
            np.minimum.at(least, ((shift + k * stride) % m).ravel(), points.ravel())
        level = np.floor(1 - np.log(least) / np.log(self.base))
        return np.clip(level, 0, 65535).astype(np.uint16)

    @cached_property
    def strides(self) -> np.ndarray:
        """Steps that visit every register."""
        k = np.arange(1, self.registers)
        return k[np.gcd(k, self.registers) == 1]

    def similarity(self, n_left, n_right, above, below) -> np.ndarray:
        """The Jaccard similarity of greatest joint likelihood, given set sizes and in how many registers the
        left value is above or below the right one. The likelihood has one peak; bisection on its slope."""
        u = n_left / (n_left + n_right)
        v, equal, k = 1 - u, self.registers - above - below, (self.base - 1) / self.base
        chance = lambda x: -np.log1p(-np.clip(x, 1e-12, None) * k) / np.log(self.base)

        def log_likelihood(j):
            p, q = chance(u - v * j), chance(v - u * j)
            return above * np.log(p) + below * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, None))

        low, high = np.zeros(np.shape(u)), np.minimum(u / v, v / u)
        for _ in range(24):
            a, b = low + (high - low) / 3, high - (high - low) / 3
            rising = log_likelihood(a) < log_likelihood(b)
            low, high = np.where(rising, a, low), np.where(rising, high, b)
        return (low + high) / 2


def sketches(docs: DataFrame, size: int, sketch: Sketch) -> DataFrame:
    """(doc_id, version, n_shingles, d1, d2, registers): the set of word shingles as its size, a 128-bit digest and
    its registers, which are null for an empty set."""

    def make():
        hashes = WordHashes()

        def score(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"n_shingles": [], "d1": [], "d2": [], "registers": []}
            for text in texts:
                found = shingle_hashes(hashes.of(words(text)), size)
                d1, d2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                for column, value in zip(out.values(), (len(found), int(d1), int(d2), sketch.of(found).tobytes() if len(found) else None)):
                    column.append(value)
            out["registers"] = pa.array(out["registers"], pa.binary())
            return out

        return score

    return map_documents(docs, make, "n_shingles long, d1 long, d2 long, registers binary", ("doc_id", "version"))


def band_rows(classes: DataFrame, sketch: Sketch) -> DataFrame:
    """(band, bucket, rep): a row for each class and band."""
    wide = 2 * sketch.rows
    keys = [F.xxhash64(F.lit(k), F.substring("registers", k * wide + 1, wide)) for k in range(sketch.bands)]
    return classes.select(F.posexplode(F.array(*keys)).alias("band", "bucket"), "rep")


def matrix(registers: pa.Array, sketch: Sketch) -> np.ndarray:
    """The registers of a column, a row each, without copying them."""
    width = 2 * sketch.registers
    first = registers.offset * width
    return np.frombuffer(registers.buffers()[2], np.uint16, len(registers) * sketch.registers, first).reshape(-1, sketch.registers)


def compare(sketch: Sketch, n_left, left: np.ndarray, n_right, right: np.ndarray, least: float) -> np.ndarray:
    """Estimated similarity of row i on the left and row i on the right; 0 where the set sizes alone, or far
    too few equal registers, rule ``least`` out."""
    out = np.zeros(len(left))
    n_left, n_right = np.asarray(n_left, float), np.asarray(n_right, float)
    able = np.flatnonzero(np.minimum(n_left, n_right) >= least * np.maximum(n_left, n_right))
    equal = (left[able] == right[able]).sum(1)
    able = able[equal >= (least - 0.05) * sketch.registers]
    if len(able):
        x, y = left[able], right[able]
        out[able] = sketch.similarity(n_left[able], n_right[able], (x > y).sum(1), (x < y).sum(1))
    return out


def likely_stars(stars: DataFrame, classes: DataFrame, sketch: Sketch, least: float) -> DataFrame:
    """For each class the most similar of its bucket centres, as pairs (a, b)."""
    side = lambda c: classes.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    kind = classes.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                sizes = [x.column(name).to_numpy() for name in ("n_a", "n_b")]
                found = compare(sketch, sizes[0], matrix(x.column("r_a"), sketch), sizes[1], matrix(x.column("r_b"), sketch), least)
                near = pa.array(found >= least)
                yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b"), pa.array(found)], names=["a", "b", "near"]).filter(near)

    scored = stars.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, f"a {kind}, b {kind}, near double")
    best = scored.groupBy("b").agg(F.max("near").alias("near"))
    return scored.join(best, ["b", "near"]).groupBy("b").agg(F.min("a").alias("a"))


class Block:
    """Classes of a bucket in a task."""

    def __init__(self, cell: pa.ListScalar, sketch: Sketch):
        self.rows = cell.values
        self.label, self.rep, self.stray = (np.array(self.rows.field(f).to_pylist(), object) for f in ("label", "rep", "stray"))
        self.registers, self.n = matrix(self.rows.field("registers"), sketch), self.rows.field("n").to_numpy()
        self.sets: dict[int, np.ndarray] = {}

    def likely(self, k: int, others: Block, sketch: Sketch, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Which others of another component class ``k`` may be linked with, the likeliest first; two strays
        meet once."""
        met = np.flatnonzero((others.label != self.label[k]) & (~others.stray.astype(bool) | (others.rep > self.rep[k])))
        mine = np.broadcast_to(self.registers[k], (len(met), sketch.registers))
        found = compare(sketch, np.full(len(met), self.n[k]), mine, others.n[met], others.registers[met], least)
        order = np.argsort(-found, kind="stable")
        return met[order[found[order] >= least]], mine

    def elements(self, k: int, hashes: WordHashes, size: int) -> np.ndarray:
        if k not in self.sets:
            self.sets[k] = shingle_hashes(hashes.of(words(self.rows.field("text")[k].as_py())), size)
        return self.sets[k]


def stray_links(
    members: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int, sketch: Sketch, least: float, block: int
) -> DataFrame:
    """Links (a, b) inside buckets whose classes are still in several components.

    In such a bucket the classes outside its largest component, the strays, meet all others. Both sides are
    dealt into blocks of about ``block`` classes, and a task compares a block with a block: a first pass, by
    registers alone, finds the buckets that hold a likely pair; a second one, over these buckets with their
    texts, verifies the likely pairs where they are, the likeliest first. Only links leave a task, and of a
    class and a component one is enough. A pair that shares several bands is verified in the first one.
    """
    kind = classes.schema["rep"].dataType.simpleString()
    held = members.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    parts = held.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    most = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("size").alias("all"), F.max(F.struct("size", "label")).alias("top")).where("parts > 1")
    mixed = cut_lineage(
        held.join(most.select("bucket", "all", F.col("top.label").alias("top")), "bucket")
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.ceil(F.col("all") / block)))
        .select("bucket", "band", "part", "rep", "label", (F.col("label") != F.col("top")).alias("stray")),
        "mixed",
    )

    def blocks(full: DataFrame, *more: str) -> DataFrame:
        cell = F.collect_list(F.struct("rep", "label", "stray", "n", "registers", *more))
        strays = full.where("stray").groupBy("bucket", "band", "part").agg(cell.alias("strays")).drop("part")
        return strays.join(full.groupBy("bucket", "part").agg(cell.alias("others")).drop("part"), "bucket")

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            hit = []
            for row in range(x.num_rows):
                strays, others = (Block(x.column(name)[row], sketch) for name in ("strays", "others"))
                hit.append(any(len(strays.likely(k, others, sketch, least)[0]) for k in range(len(strays.rep))))
            yield pa.RecordBatch.from_arrays([x.column("bucket")], names=["bucket"]).filter(pa.array(hit, pa.bool_()))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for x in batches:
            for row in range(x.num_rows):
                strays, others = (Block(x.column(name)[row], sketch) for name in ("strays", "others"))
                band, ends = x.column("band")[row].as_py(), []
                for k in range(len(strays.rep)):
                    met, mine = strays.likely(k, others, sketch, least)
                    shared = (others.registers[met] == mine[: len(met)]).reshape(-1, sketch.bands, sketch.rows).all(2)
                    done: set = set()
                    for m in met[shared.argmax(1) == band] if len(met) else ():
                        if others.label[m] not in done and linked(strays.elements(k, hashes, size), others.elements(m, hashes, size), percent):
                            done.add(others.label[m])
                            ends.append(sorted((strays.rep[k], others.rep[m])))
                if ends:
                    yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends]), pa.array([e[1] for e in ends])], names=["a", "b"])

    full = mixed.join(classes, "rep")
    flagged = cut_lineage(blocks(full).mapInArrow(flag, "bucket long").distinct(), "flagged")
    whole = full.join(flagged, "bucket").join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    return blocks(whole, "text").mapInArrow(link, f"a {kind}, b {kind}")


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(left) + len(right) - both)


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach ``percent``. The smaller key's text is kept from row
    to row, as stars come with their centre."""
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"t_{c}"))
    kind = pairs.schema["a"].dataType.simpleString()
    joined = pairs.join(side("b"), "b").join(side("a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, left = WordHashes(), None, None
        for x in batches:
            kept = []
            for a, b in zip(x.column("t_a"), x.column("t_b")):
                if a != last or left is None:
                    last, left = a, shingle_hashes(hashes.of(words(a.as_py())), size)
                right = shingle_hashes(hashes.of(words(b.as_py())), size)
                kept.append(linked(left, right, percent))
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(rep, label): the least class reachable over ``links`` (a, b), for every class that has a link.

    Large-star and small-star steps in turn: every node hands its neighbours on to the least of them. The
    edges of a step are a written table; hubs are reduced before they are joined back, and their joins split.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    mark = None
    while True:
        edges = cut_lineage(edges, "edges")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            return edges.select(F.col("v").alias("rep"), F.col("u").alias("label"))
        mark = new
        least = edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("o"))
        down = edges.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("o"))
        least = least.union(down).groupBy("x").agg(F.min("o").alias("o")).select("x", F.least("x", "o").alias("o"))
        large = edges.join(least, edges.u == least.x).select("v", F.col("o").alias("u")).distinct()
        small = large.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("o"))
        handed = large.join(small, large.v == small.x)
        edges = handed.select(F.col("u").alias("v"), F.col("o").alias("u")).where("u < v").union(handed.select("v", F.col("o").alias("u"))).distinct()


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    sketch: Sketch = Sketch(),
    margin: float = 0.14,
    block: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document's version (a hash of its text), n_shingles, component_id and ``kept``, for links at ``percent`` of Jaccard similarity
    between sets of ``size``-word shingles.

    ``margin`` is how far below ``percent`` an estimate may lie before the pair is given up: 5 standard
    deviations of the default sketch. Equal sets are one class from the start. Classes that share a band meet the least class of the bucket, so
    a bucket of any size gives one pair for each member; the most likely pair of each is verified on whole
    texts. Where a bucket is left in several components, those outside the largest meet all others in blocks.
    Every pair that shares a band is thus in one component or compared, and no group is ever gathered whole.

    Texts without words have empty sets and are linked with nothing; fewer words than ``size`` make one
    shingle; rows that share a doc_id are one document; rows with a null doc_id are linked with nothing, and
    stay, their component null; very long texts are compared whole; an empty table gives no rows; further columns
    are ignored.
    """
    docs = documents(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    drawn = cut_lineage(sketches(docs, size, sketch), "sketches")
    able = drawn.where("n_shingles > 0 and doc_id is not null")
    whole = able.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    whole = cut_lineage(whole, "classes")
    classes = whole.select("rep", "n", "registers")
    bands = cut_lineage(band_rows(classes, sketch), "bands")
    centres = bands.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").drop("z")
    members = cut_lineage(bands.join(centres, "bucket").select("bucket", "band", "rep", "a"), "members")
    least = percent / 100 - margin
    stars = members.where("a < rep").select("a", F.col("rep").alias("b")).distinct()
    texts = cut_lineage(docs.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id"), "texts")
    links = verify(likely_stars(stars, classes, sketch, least), texts, size, percent)
    labels = components(links)
    more = cut_lineage(stray_links(members.drop("a"), classes, labels, texts, size, percent, sketch, least, block), "links")
    if not more.isEmpty():
        labels = components(more.union(labels.select("label", "rep")))
    named = whole.select("d1", "d2", "rep").join(labels, "rep", "left").select("d1", "d2", F.coalesce("label", "rep").alias("label"))
    out = drawn.drop("registers").join(named, ["d1", "d2"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("label")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "version", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
