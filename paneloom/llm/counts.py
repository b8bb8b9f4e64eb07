"""Token counts (4): a broadcast table of frequent pre-token lengths, worker caches for the rest."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from paneloom.llm.frequent import LONGEST, frequent_pieces
from paneloom.llm.tasks import documents, map_documents

FREQUENT = 50_000  # pre-tokens in the broadcast table: about 1 MB, as none is longer than LONGEST bytes
CACHED = 300_000  # pre-tokens that a worker remembers, none longer either
SPACE_SIGN = "▁"
SEGMENT = re.compile(r"\n| +[^ \n]*|[^ \n]+")


def load(path: str):
    """The model, if its pieces allow counting by pre-tokens: no piece holds a line end, or a space sign
    behind another character, text is taken as it is, and a space is put before it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    crossing = [p for p in pieces if "\n" in p or SPACE_SIGN in p.lstrip(SPACE_SIGN)]
    probe = model.encode(" \n a  b", out_type=str)
    if crossing or probe != [SPACE_SIGN * 2, "<0x0A>", f"{SPACE_SIGN}a", SPACE_SIGN, f"{SPACE_SIGN}b"]:
        raise ValueError(f"{path} cannot be counted by pre-tokens")
    return model


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text where single spaces or line ends stand between words: a word stands for itself
    behind a space, or begins with its line end. Otherwise the segments, each marked by a leading NUL."""
    whole = " " + text.replace(SPACE_SIGN, " ")
    marked = whole.replace("\n", " \n")
    if "  " in marked or marked[-1] == " " or "\0" in marked:
        return ["\0" + s for s in SEGMENT.findall(whole)]
    return marked.split(" ")[1:]


@dataclass(frozen=True)
class LengthTable:
    """A compact hash table of pre-tokens and their lengths: open addressing over their bytes, which lie one after
    the other, so any byte may occur in them."""

    slots: np.ndarray  # number of an entry plus 1, 0 where free
    ends: np.ndarray
    data: bytes
    lengths: np.ndarray

    @classmethod
    def of(cls, entries: dict[str, int]) -> LengthTable:
        keys = [k.encode() for k in entries]
        slots = np.zeros(max(8, 1 << (2 * len(keys)).bit_length()), np.int32)
        for number, key in enumerate(keys, 1):
            at = xxhash.xxh3_64_intdigest(key) % len(slots)
            while slots[at]:
                at = (at + 1) % len(slots)
            slots[at] = number
        return cls(slots, np.cumsum([0, *map(len, keys)], dtype=np.int64), b"".join(keys), np.array(list(entries.values()), np.int32))

    def find(self, word: str) -> int | None:
        key = word.encode()
        at = xxhash.xxh3_64_intdigest(key) % len(self.slots)
        while number := int(self.slots[at]):
            if self.data[self.ends[number - 1] : self.ends[number]] == key:
                return int(self.lengths[number - 1])
            at = (at + 1) % len(self.slots)
        return None


class Lengths(dict):
    """Tokens of a pre-token: what this worker has met, then the broadcast table, else the model."""

    def __init__(self, model, table: LengthTable | None = None, cached: int = CACHED):
        super().__init__()
        self.model, self.table, self.limit = model, table or LengthTable.of({}), cached

    def __missing__(self, word: str) -> int:
        value = self.table.find(word)
        if value is None:
            value = self.count(word)
        if len(word) <= LONGEST:
            self[word] = value
        return value

    def count(self, word: str) -> int:
        tokens = lambda text: len(self.model.encode(text, num_threads=1))
        if word[:1] != "\0":
            return tokens(word) - (word[:1] == "\n")
        segment = word[1:]
        if segment[:1] == " ":
            return tokens(segment[1:]) or 1
        return 1 if segment == "\n" else tokens("\n" + segment) - 2

    def total(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self) > self.limit:
            self.clear()
        return sum(map(self.__getitem__, pre_tokens(text)))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """Each document's n_bytes, n_tokens and ``over_limit``, exactly as the model's library counts.

    The frequent pre-tokens come from reports of all tasks; no pre-token is shuffled, and the broadcast has
    ``frequent`` entries at most. Null and empty texts have no tokens; repeated rows each get theirs; very
    long texts are counted whole; an empty table gives no rows; further columns are ignored.
    """
    docs = documents(docs, id_col, text_col)
    lengths = Lengths(load(path))
    plain = [p for p in frequent_pieces(docs, frequent) if "\0" not in p and SPACE_SIGN not in p and p != "\n"]
    sent = docs.sparkSession.sparkContext.broadcast(LengthTable.of({p: lengths.count(p) for p in plain}))

    def make():
        known = Lengths(load(path), sent.value)
        return lambda texts: {"n_tokens": [known.total(text) for text in texts]}

    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = map_documents(sized, make, "n_tokens long", ("doc_id", "n_bytes"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
