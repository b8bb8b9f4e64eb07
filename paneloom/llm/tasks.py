"""Helpers shared by the operators: columns of a document table, code inside tasks, shared files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paneloom.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names: other columns, whatever their names, stay behind."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name in df.columns:
        name = f"_{name}"
    return name


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII takes the fast built-in, which does the same there."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower())
    )


def crc_of_id(id_col: str = "doc_id") -> Column:
    """CRC-32 of the key as decimal text; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(LOWER).split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen last. ``of`` clears the memory when it is full."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all windows of ``size`` words; fewer words make one window."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    out = mix(hashes[:count] + np.uint64(size))
    for k in range(1, size):
        out = chain(out, hashes[k : k + count])
    return np.unique(out)


def map_documents(
    docs: DataFrame, make: Callable[[], Callable[[list], dict[str, list]]], schema: str, carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One output row for each row: ``make`` runs once in a task and gives a function from the texts of
    a batch to the new columns. The columns in ``carry`` go along untouched."""
    kept = [f"{name} {docs.schema[name].dataType.simpleString()}" for name in carry]
    names = [*carry, *(part.split()[0] for part in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            new = score(batch.column("text").to_pylist())
            arrays = {n: batch.column(n) for n in carry} | {n: v if isinstance(v, pa.Array) else pa.array(v) for n, v in new.items()}
            yield pa.RecordBatch.from_arrays([arrays[n] for n in names], names=names)

    return docs.select(*dict.fromkeys((*carry, "text"))).mapInArrow(run, ", ".join([*kept, schema]))


def mounted_dir(spark: SparkSession, name: str) -> str | None:
    """A new folder below the shared one as a path that every worker can open and memory-map, or None
    where the shared folder is not a mounted file system."""
    uri = urlparse(scratch_path(spark, name))
    if uri.scheme not in ("", "file"):
        return None
    os.makedirs(uri.path, exist_ok=True)
    return uri.path


class SharedArrays:
    """Read-only arrays for the tasks: one file in the shared folder that workers memory-map, so that all
    workers of a machine share its pages; a broadcast of the same bytes where nothing is mounted.

    Meant for arrays of bounded size, as the driver holds them once.
    """

    def __init__(self, spark: SparkSession, name: str, arrays: dict[str, np.ndarray]):
        self.places, parts, at = {}, [], 0
        for key, array in arrays.items():
            data = np.ascontiguousarray(array).tobytes()
            self.places[key] = (at, array.dtype.str, len(array))
            pad = -len(data) % 8
            parts += [data, b"\0" * pad]
            at += len(data) + pad
        blob, folder = b"".join(parts) or bytes(8), mounted_dir(spark, name)  # an empty file cannot be mapped
        self.path = self.sent = None
        if folder is None:
            self.sent = spark.sparkContext.broadcast(blob)
        else:
            self.path = os.path.join(folder, f"{name}.bin")
            part = f"{self.path}.{uuid.uuid4().hex}"
            with open(part, "wb") as out:
                out.write(blob)
            os.replace(part, self.path)

    def open(self) -> dict[str, np.ndarray]:
        whole = np.memmap(self.path, np.uint8, "r") if self.path else np.frombuffer(self.sent.value, np.uint8)
        return {
            key: whole[at : at + np.dtype(kind).itemsize * count].view(kind) for key, (at, kind, count) in self.places.items()
        }
