"""Fill-in-middle transformation (12): a wavelet matrix over character classes locates the cuts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from paneloom.llm.tasks import documents

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHUNK = 8_000_000  # bytes of text in one wavelet matrix; a longer text has its own
WORD = 64  # bits between two stored ranks

# Classes of a code point: letters are A-Z and a-z; each class but INSIDE begins a unit.
INSIDE, FIRST, SPACE, OTHER = range(4)


class Bits:
    """A row of bits with ranks: how many are set before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate((packed, np.zeros(WORD // 8 - len(packed) % (WORD // 8), np.uint8)))
        self.words = packed.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at // WORD, (at % WORD).astype(np.uint64)
        inside = self.words[np.minimum(word, len(self.words) - 1)] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)


class WaveletMatrix:
    """Ranks of every symbol in a row of symbols below 2^``levels``: a row of bits for each level, from the
    highest bit on; the next level's symbols stand with this level's zeros before its ones."""

    def __init__(self, symbols: np.ndarray, levels: int = 2):
        self.levels: list[tuple[Bits, int]] = []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of ``symbol`` stand before each place."""
        low, high = np.zeros_like(at), at
        for depth, (bits, zeros) in enumerate(self.levels):
            a, b = bits.rank(low), bits.rank(high)
            if symbol >> (len(self.levels) - 1 - depth) & 1:
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return high - low


def classes_of(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of every code point of UTF-8 texts that lie one after the other, and its place in bytes.
    ``begins`` are the places where texts begin: a run of letters does not go on there."""
    points = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[points]
    folded = lead | 0x20
    letter = (folded >= 97) & (folded <= 122)
    going_on = np.concatenate(([False], letter[:-1]))
    going_on[np.searchsorted(points, begins[begins < len(data)])] = False
    space = (lead == 32) | (lead >= 9) & (lead <= 13)
    return np.where(letter, np.where(going_on, INSIDE, FIRST), np.where(space, SPACE, OTHER)).astype(np.uint8), points


class Units:
    """Units (runs of letters, single other code points) of texts that lie one after the other."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        begins = np.concatenate(([0], ends[:-1]))
        symbols, self.points = classes_of(data, begins)
        self.matrix = WaveletMatrix(symbols)
        self.first, self.last = np.searchsorted(self.points, begins), np.searchsorted(self.points, ends)
        self.before = self.units_before(self.first)
        self.count = self.units_before(self.last) - self.before

    def units_before(self, at: np.ndarray) -> np.ndarray:
        """How many units begin before each code point: the ranks of the three classes that begin one."""
        return sum(self.matrix.rank(symbol, at) for symbol in (FIRST, SPACE, OTHER))

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The code point behind the first ``units`` units of each text: the last place before which no more
        than these begin, found by bisection on the counts, all texts side by side."""
        low, high, wanted = self.first.copy(), self.last.copy(), self.before + units
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            fits = self.units_before(middle) <= wanted
            low, high = np.where(open_ & fits, middle, low), np.where(open_ & ~fits, middle - 1, high)
        return low

    def byte(self, at: np.ndarray, size: int) -> np.ndarray:
        return np.append(self.points, size)[at]


def draws(key: Column) -> list[Column]:
    """The first four groups of eight digits of the SHA-256 of ``1:`` and the key, as numbers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def infill(docs: DataFrame, plain: int = 90, spm: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each document, for training a model to fill gaps.

    A text of ``n`` units (runs of A-Z and a-z, other code points singly) is cut twice behind whole units, by
    numbers drawn from its key. ``form`` is psm, prefix, suffix and middle behind their marks, or spm, with the
    suffix in front, for ``spm`` percent; plain texts stay: ``100 - plain`` percent, empty ones and those that hold a mark.

    Null texts count as empty ones, a null key is drawn from as an empty name; rows that share a key are drawn
    alike, each by its own text; very long texts are cut whole; an empty table gives no rows; further columns are ignored.
    Rows are independent, so there is no exchange.
    """
    named = documents(docs, id_col, text_col)
    kind = named.schema["doc_id"].dataType.simpleString()
    h1, h2, h3, h4 = draws(F.col("doc_id"))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = F.when((F.col("text") == "") | marked | (h3 % 100 >= plain), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    rows = named.withColumn("text", F.coalesce("text", F.lit(""))).select("doc_id", "text", form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            texts = batch.column("text")
            sizes = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + CHUNK)))
                yield transform(batch.slice(start, stop - start))
                start = stop

    def transform(rows: pa.RecordBatch) -> pa.RecordBatch:
        bodies = [x.as_py().encode() for x in rows.column("text")]
        ends = np.cumsum([len(b) for b in bodies], dtype=np.int64)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        units = Units(data, ends)
        n, forms = units.count, rows.column("form").to_pylist()
        drawn = [rows.column(h).to_numpy() % (n + 1) for h in ("h1", "h2")]
        cuts = [units.cut(pick(*drawn)) for pick in (np.minimum, np.maximum)]
        begins = np.concatenate(([0], ends[:-1]))
        a, b = (units.byte(cut, len(data)) - begins for cut in cuts)
        whole = np.array([f == "plain" for f in forms], bool)
        outputs = [assemble(f, body[:x], body[x:y], body[y:]) for f, body, x, y in zip(forms, bodies, a.tolist(), b.tolist())]
        cells = [
            rows.column("doc_id"), pa.array(n), rows.column("form"), pa.array(cuts[0] - units.first, mask=whole), pa.array(cuts[1] - cuts[0], mask=whole),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(cells, names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def assemble(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if form == "plain":
        return prefix + middle + suffix
    return s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle


def restored(output: Column, form: Column) -> Column:
    """The exact text behind an output. The marks cannot arise anew where parts meet, as each begins and ends
    with a sign that is nowhere else in it."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    part = lambda k: F.element_at(parts, k)
    return F.when(form == "plain", output).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(F.concat(part(2), part(4), part(3)))
