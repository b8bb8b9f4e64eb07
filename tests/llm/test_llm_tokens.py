"""Encoding and counting on code points of all planes and control characters, through Spark, against the libraries."""

import random
import sys

from paneloom.llm import bpe, catalog, counts, frequent

PLACES = [(0, 0x250), (0x250, 0x2000), (0x2000, 0x3100), (0x3100, 0xD800), (0xE000, 0x10000), (0x10000, 0x20000), (0x20000, 0x110000)]


def odd_texts(count, seed):
    rng = random.Random(seed)
    sign = lambda: chr(rng.randrange(*rng.choice(PLACES)))
    scrap = lambda: rng.choice([sign, sign, lambda: chr(rng.randrange(33)), lambda: rng.choice(["'ll", "'S", " a", "a", "1", "!", "  ", " b.", "\n", "<|endoftext|>", "\x01", "▁"])])()
    return ["".join(scrap() for _ in range(rng.randint(0, 12))) for _ in range(count)]


def newer_points():
    """Every code point up to U+31FFF that Python's own tables do not name, and some beyond, between letters."""
    import unicodedata

    new = [chr(c) for c in range(0x80, 0x32000) if unicodedata.category(chr(c)) == "Cn"]
    return ["".join(f"{rng}{c}'ll 1{c}!{c} {c}a" for c in new[k : k + 100]) for k, rng in zip(range(0, len(new), 100), "abc" * len(new))]


def test_encoding_of_any_code_point(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(catalog.BYTE_BPE)
    texts = odd_texts(3000, 1) + newer_points()[:400] + ["𘹎'll"]
    out = bpe.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), catalog.BYTE_BPE, words=100, decode=True).collect()
    assert len(out) == len(texts)
    for row in out:
        expected = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == expected, ascii(texts[row["doc_id"]])
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)


def test_chunks_of_one_text_encode_alike(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(odd_texts(200, 5) + [None, "", "plain words only", "plain words\nonly"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, bpe.encode_documents(docs, catalog.BYTE_BPE, words=10).collect()))
    monkeypatch.setattr(bpe, "CHUNK", 1)
    assert sorted(map(tuple, bpe.encode_documents(docs, catalog.BYTE_BPE, words=10).collect())) == whole


def test_counts_of_any_code_point(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=catalog.PIECE_BPE)
    long = "supercalifragilisticexpialidocious"
    texts = odd_texts(3000, 2) + [f"hello hello hello hello a\x01b a\x01b a\x01b {long} {long} the", f"one {long}"]
    texts += [f"x{chr(c)}y x{chr(c)}y {chr(c)} z" * 3 for c in range(33)]
    out = counts.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), catalog.PIECE_BPE).collect()
    for row in out:
        assert row["n_tokens"] == len(library.encode(texts[row["doc_id"]])), ascii(texts[row["doc_id"]])


def test_length_table_finds_what_it_holds_and_nothing_else():
    entries = {f"w{k}\x01{'é' * (k % 3)}": k for k in range(5000)}
    table = counts.LengthTable.of(entries)
    assert all(table.find(k) == v for k, v in entries.items()) and table.find("w1") is None and counts.LengthTable.of({}).find("") is None
    assert sys.getsizeof(table.data) < 100_000


def test_frequent_pieces_are_bounded_and_in_order(spark):
    rows = [(" ".join(["a"] * 9 + ["b"] * 5 + ["c"] * 5 + [f"r{k}" for k in range(50)] + ["x" * 100] * 20) + "\nb",), (None,), ("",)]
    docs = spark.createDataFrame(rows, "text string")
    assert frequent.frequent_pieces(docs, 3) == ["a", "b", "c"] and frequent.frequent_pieces(docs, 2) == ["a", "b"]
    assert frequent.frequent_pieces(docs, 54)[:3] == ["a", "b", "c"] and frequent.frequent_pieces(docs.limit(0), 5) == []
    assert frequent.frequent_pieces(docs, 3, held=4)[0] == "a"
