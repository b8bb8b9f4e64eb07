"""BPE encoding and decoding (3): a minimal acyclic transducer of frequent words, exact merges for the rest."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from paneloom.llm.frequent import frequent_pieces, split_pieces
from paneloom.llm.tasks import SharedArrays, documents

LEXICON_WORDS = 50_000  # words compiled into the transducer: about 2 MB
CACHED = 400_000  # pieces, and words, that a worker remembers
SIDE_BY_SIDE = 32  # bytes of the longest words that are merged side by side
UNRANKED = 1 << 40
CHUNK = 4_000_000  # bytes of text that are looked up together

# The pattern that splits text before merges, for text whose code points beyond ASCII are replaced by
# an ASCII one of their class: a letter that no contraction has, a digit, a sign, or white space that is no space.
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
STAND_IN = {"a": "A", "1": "0", "!": "!"}
#: A piece that is empty, a mere line end, or holds other white space: its text is split by the pattern instead.
ODD = re.compile(r"\n?\Z|.+\s", re.DOTALL)


class Alphabet(dict):
    """The stand-in of each code point met, for ``str.translate``. What class a code point has is asked of the
    library itself, as its tables are those of another Unicode version than Python's: the code point belongs to
    the class of the sign in front of it if the library does not part them."""

    def __init__(self):
        super().__init__((point, point) for point in range(128))
        from tokenizers import pre_tokenizers

        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    def __missing__(self, point: int) -> str:
        found = next((own for sign, own in STAND_IN.items() if len(self.split(sign + chr(point))) == 1), "\t")
        self[point] = found
        return found

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return WORD.findall(text)
        return [text[m.start() : m.end()] for m in WORD.finditer(text.translate(self))]


class Vocabulary:
    """A byte-level BPE file: the bytes of each id, the merges by pairs of ids, the added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        if told["model"]["type"] != "BPE" or told["normalizer"] or told["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a plain byte-level BPE")
        if told["pre_tokenizer"].get("add_prefix_space") or not told["pre_tokenizer"].get("use_regex", True):
            raise ValueError(f"{path} splits words in another way")
        ids = told["model"]["vocab"]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        signs = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        values = {sign: b for b, sign in signs.items()}
        self.first = [ids[signs[b]] for b in range(256)]
        self.added = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.bytes: list[bytes] = [b""] * (max([*ids.values(), *self.added.values()]) + 1)
        for token, number in ids.items():
            self.bytes[number] = bytes(values[sign] for sign in token)
        for token, number in self.added.items():
            self.bytes[number] = token.encode()
        pairs = (x.split(" ") if isinstance(x, str) else x for x in told["model"]["merges"])
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.merges = {(a, b): (rank, new) for rank, (a, b, new) in enumerate(merges)}
        keys = np.array([a << 32 | b for a, b, _ in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order, np.array([new for *_, new in merges], np.int64)
        self.cut = re.compile("|".join(f"({re.escape(x)})" for x in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.alphabet = Alphabet()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of the lowest rank is merged, the leftmost first, until none is left.
        A heap of pairs over a chain of pieces keeps words of any length near linear time."""
        ids, after, ahead = [self.first[b] for b in word], list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        none = (1 << 60, -1)
        heap = [(self.merges.get((ids[k], ids[k + 1]), none)[0], k, ids[k], ids[k + 1]) for k in range(len(ids) - 1)]
        heap = [x for x in heap if x[0] < none[0]]
        heapify(heap)
        while heap:
            _, k, a, b = heappop(heap)
            n = after[k] if ids[k] == a else len(ids)
            if n >= len(ids) or ids[n] != b:
                continue  # one of the two has been merged meanwhile
            ids[k], ids[n] = self.merges[a, b][1], -1
            after[k] = after[n]
            if after[n] < len(ids):
                ahead[after[n]] = k
            for x, y in ((ahead[k], k), (k, after[k])):
                if x >= 0 and y < len(ids) and (rank := self.merges.get((ids[x], ids[y]), none)[0]) < none[0]:
                    heappush(heap, (rank, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; UNRANKED for pairs without a merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], UNRANKED)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words. Short words of about one length are merged side by side, a pair of each
        in a step; longer ones, of which there are few, one by one."""
        out: list[list[int]] = [[]] * len(words)
        groups: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            groups.setdefault((len(word) - 1).bit_length(), []).append(k)
        for size, group in groups.items():
            if 1 << size > SIDE_BY_SIDE or not len(self.keys):
                for k in group:
                    out[k] = self.merge(words[k])
                continue
            for start in range(0, len(group), 20_000):
                part = group[start : start + 20_000]
                for k, ids in zip(part, self.merge_side_by_side([words[k] for k in part])):
                    out[k] = ids
        return out

    def merge_side_by_side(self, words: list[bytes]) -> list[list[int]]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = max(2, int(lengths.max()))
        ids = np.full((len(words), width), -1, np.int64)
        ids[np.arange(width) < lengths[:, None]] = np.array(self.first)[np.frombuffer(b"".join(words), np.uint8)]
        rank = self.rank(ids[:, :-1], ids[:, 1:])
        alive, column = np.arange(len(words)), np.arange(width)
        while True:
            at = rank[alive].argmin(1)
            best = rank[alive, at]
            alive, at, best = (x[best < UNRANKED] for x in (alive, at, best))
            if not len(alive):
                break
            own, old = ids[alive], rank[alive]
            behind = column > at[:, None]
            own = np.where(behind, np.pad(own[:, 1:], ((0, 0), (0, 1)), constant_values=-1), own)
            row = np.arange(len(alive))
            own[row, at] = self.merged[best]
            old = np.where(behind[:, :-1], np.pad(old[:, 1:], ((0, 0), (0, 1)), constant_values=UNRANKED), old)
            inner = np.flatnonzero(at < width - 1)
            old[inner, at[inner]] = self.rank(own[inner, at[inner]], own[inner, at[inner] + 1])
            later = np.flatnonzero(at > 0)
            old[later, at[later] - 1] = self.rank(own[later, at[later] - 1], own[later, at[later]])
            ids[alive], rank[alive] = own, old
        kept = (ids >= 0).sum(1).tolist()
        return [row[:n] for row, n in zip(ids.tolist(), kept)]


def compile_words(entries: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """A minimal acyclic transducer as flat arrays.

    Words are added in order; a finished branch is replaced by an equal one seen before, so suffixes are
    shared. Each arc puts out how many words come before its branch; these numbers add up to a word's place
    in order, where its ids are found.
    """
    words = sorted(entries)
    nodes: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    known: dict[tuple[bool, tuple[tuple[int, int], ...]], int] = {}
    path: list[list] = [[False, []]]  # of the last word: whether a word ends there, finished arcs
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            form = (final, tuple(arcs))
            if form not in known:
                known[form] = len(nodes)
                nodes.append(form)
            path[-1][1].append((last[len(path) - 1], known[form]))

    for word in words:
        shared = next((k for k, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(shared)
        path.extend([False, []] for _ in word[shared:])
        path[-1][0] = True
        last = word
    close(0)
    nodes.append((path[0][0], tuple(path[0][1])))
    held = np.zeros(len(nodes), np.int64)
    keys, targets, outputs = [], [], []
    for number, (final, arcs) in enumerate(nodes):  # targets come before the nodes that lead to them
        count = int(final)
        for byte, target in arcs:
            keys.append(number * 256 + byte)
            targets.append(target)
            outputs.append(count)
            count += held[target]
        held[number] = count
    ids = [entries[w] for w in words]
    return {
        "keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32), "outputs": np.array(outputs, np.int32),
        "final": np.array([final for final, _ in nodes], np.int8), "ends": np.cumsum([0, *map(len, ids)], dtype=np.int64),
        "ids": np.array(list(chain.from_iterable(ids)), np.int32),
    }


def look_up(lexicon: dict[str, np.ndarray], words: list[bytes]) -> list[list[int] | None]:
    """Ids of each word, None for words outside the lexicon: all words walk the transducer side by side."""
    if not words or not len(lexicon["keys"]):
        return [None] * len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
    state, place = np.full(len(words), len(lexicon["final"]) - 1), np.zeros(len(words), np.int64)
    alive = np.flatnonzero(lengths > 0)
    lost = lengths == 0
    for k in range(int(lengths.max())):
        alive = alive[lengths[alive] > k]
        if not len(alive):
            break
        key = state[alive] * 256 + flat[begins[alive] + k]
        at = np.minimum(np.searchsorted(lexicon["keys"], key), len(lexicon["keys"]) - 1)
        found = lexicon["keys"][at] == key
        lost[alive[~found]] = True
        alive, at = alive[found], at[found]
        state[alive] = lexicon["targets"][at]
        place[alive] += lexicon["outputs"][at]
    lost |= lexicon["final"][state] == 0
    ends, ids = lexicon["ends"], lexicon["ids"]
    return [None if gone else ids[ends[p] : ends[p + 1]].tolist() for gone, p in zip(lost.tolist(), place.tolist())]


def words_of(piece: str, alphabet: Alphabet) -> list[str] | None:
    """Words that the pattern finds in a piece of plainly spaced text; None for an odd piece. ASCII letters, and
    letters with one full stop or comma behind them, need no pattern."""
    if piece.isascii():
        if piece.isalpha():
            return [f" {piece}"]
        if piece[-1:] in (".", ",") and piece[:-1].isalpha():
            return [f" {piece[:-1]}", piece[-1]]
    if ODD.match(piece):
        return None
    return alphabet.words(piece if piece[0] == "\n" else f" {piece}")


class Encoder:
    """Exact encoding in a task, with the transducer in front of the merges and memories in front of both."""

    def __init__(self, vocabulary: Vocabulary, lexicon: dict[str, np.ndarray] | None = None, cached: int = CACHED):
        self.v, self.lexicon, self.cached = vocabulary, lexicon or compile_words({}), cached
        self.pieces: dict[str, tuple[int, ...] | None] = {}  # None: odd
        self.words: dict[str, tuple[int, ...]] = {}

    def learn_words(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        found = look_up(self.lexicon, [w.encode() for w in new])
        unseen = [w for w, ids in zip(new, found) if ids is None]
        self.words.update((w, tuple(ids)) for w, ids in zip(new, found) if ids is not None)
        self.words.update(zip(unseen, map(tuple, self.v.merge_all([w.encode() for w in unseen]))))

    def learn_pieces(self, pieces: list[str]) -> None:
        new = {p: words_of(p, self.v.alphabet) for p in pieces if p not in self.pieces}
        self.learn_words(set(chain.from_iterable(inside for inside in new.values() if inside)))
        word = self.words.__getitem__
        for piece, inside in new.items():
            self.pieces[piece] = None if inside is None else word(inside[0]) if len(inside) == 1 else tuple(chain.from_iterable(map(word, inside)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each.

        Texts are split into pieces that begin at spaces and line ends, and each different piece is encoded once;
        the ids of its occurrences are gathered by offsets. Texts with odd pieces or added tokens are encoded by
        themselves; added tokens inside a text are themselves, as the library does by default.
        """
        if len(self.pieces) > self.cached:
            self.pieces.clear()
        if len(self.words) > self.cached:
            self.words.clear()
        texts = texts.fill_null("")
        lists = split_pieces(pc.binary_join_element_wise(pa.scalar("\n"), texts, pa.scalar("")))
        coded = lists.flatten().dictionary_encode()
        pieces, codes, starts = coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.learn_pieces(pieces)
        found = [self.pieces[p] for p in pieces]
        odd = np.array([x is None for x in found], bool)[codes]
        odd[starts[:-1]] = False  # the empty piece in front of the line end given to each text
        lengths = np.fromiter((len(x or ()) for x in found), np.int64, len(found))
        table = np.fromiter(chain.from_iterable(x or () for x in found), np.int32, int(lengths.sum()))
        own = lengths[codes]
        ends = np.cumsum(own)
        ids = table[np.repeat((np.cumsum(lengths) - lengths)[codes] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate(([0], ends))[starts]
        alone = np.add.reduceat(odd, starts[:-1]) > 0 if len(texts) else odd
        for token in self.v.added:
            alone |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        parts = [np.array(self.encode_alone(texts[k].as_py()), np.int32) if alone[k] else ids[edges[k] + 1 : edges[k + 1]] for k in range(len(texts))]
        return np.concatenate([*parts, np.empty(0, np.int32)]), np.array([len(p) for p in parts], np.int64)

    def encode_alone(self, text: str) -> list[int]:
        out: list[int] = []
        for part in (self.v.cut.split(text) if self.v.cut else [text]):
            if part in self.v.added:
                out.append(self.v.added[part])
            elif part:
                inside = self.v.alphabet.words(part)
                self.learn_words(set(inside))
                out += chain.from_iterable(map(self.words.__getitem__, inside))
        return out


def decode_ids(vocabulary: Vocabulary, ids: list[int]) -> str:
    """Text of ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace")


def build_lexicon(docs: DataFrame, path: str, words: int = LEXICON_WORDS) -> SharedArrays:
    """The transducer of the most frequent words of all documents, as a file that workers memory-map."""
    vocabulary = Vocabulary(path)
    pieces = frequent_pieces(docs, words)
    inside = dict.fromkeys(chain.from_iterable(words_of(p, vocabulary.alphabet) or [] for p in pieces))
    frequent = [w.encode() for w in list(inside)[:words]]
    entries = dict(zip(frequent, vocabulary.merge_all(frequent)))
    return SharedArrays(docs.sparkSession, "lexicon", compile_words(entries))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", words: int = LEXICON_WORDS, decode: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of each document, with ``decode`` also ``decoded``, the text of the ids.

    Exactly what the vocabulary's library gives, whatever the lexicon holds. Null and empty texts have no
    ids; repeated rows each get theirs; very long texts are encoded whole; an empty table gives no rows; further
    columns are ignored.
    """
    docs = documents(docs, id_col, text_col)
    lexicon = build_lexicon(docs, path, words)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "ids", "decoded"][: 2 + decode]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(path), lexicon.open())
        for batch in batches:
            start, sizes = 0, np.cumsum(np.asarray(pc.binary_length(batch.column("text")).fill_null(0), np.int64))
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + CHUNK)))
                rows = batch.slice(start, stop - start)
                ids, counts = encoder.encode(rows.column("text"))
                ends = np.concatenate(([0], np.cumsum(counts)))
                cells = [rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))]
                if decode:
                    cells.append(pa.array([decode_ids(encoder.v, ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cells, names=names)
                start = stop

    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decode)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give an empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            texts = [decode_ids(vocabulary, x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
