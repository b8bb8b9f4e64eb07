"""Substring dedup against all windows counted in plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paneloom.llm import substrings


def plain(rows, window):
    texts = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (key, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def texts(seed, count=120):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 3)) for _ in range(rng.randint(3, 60))) for _ in range(8)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "x"), (4, "the " * 300), (5, "the " * 40 + "end"), (6, "one two " * 50), (None, passages[0]), (None, None)]
    for k in range(10, 10 + count):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(["é", "B", "b", "😀"]) + str(rng.randint(0, 300)) for _ in range(rng.randint(0, 40))))
        rows.append((k, rng.choice([" ", "\n", "  ", "\x0b"]).join(parts)))
    return rows + [rows[20], (20, rows[21][1]), (30, "another text under one key " + passages[1])]


def found(spark, rows, window, **limits):
    clash = ("version", "core", "strip", "start", "starts", "spans", "k", "v", "n", "words", "held", "mask")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in clash})
    out = substrings.dedup_substrings(docs, window, **limits).collect()
    assert all(r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"]) for r in out)
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in out), key=repr)


@pytest.mark.parametrize("window", [2, 5, 35])
def test_removed_words_are_those_of_all_repeated_windows(spark, window):
    rows = texts(window)
    expected = sorted(plain(rows, window), key=repr)
    assert any(r[2] for r in expected) and any(not r[2] for r in expected)
    assert found(spark, rows, window) == expected


def test_small_groups_and_longer_prefixes_change_nothing(spark):
    rows = texts(7)
    expected = sorted(plain(rows, 9), key=repr)
    assert found(spark, rows, 9, group_words=1) == expected
    assert found(spark, rows, 9, crowded=0) == expected
    assert found(spark, rows, 9, crowded=1) == expected


def test_very_long_text_and_empty_table(spark):
    long = " ".join(f"w{k % 70_001}" for k in range(140_000))
    assert [r[1:3] for r in found(spark, [(1, long), (2, "w1 w2 w3")], 35)] == [(140_000, 139_998), (3, 0)]
    assert found(spark, [], 35) == []


def test_strips_cover_every_window_once():
    import numpy as np

    rng = np.random.default_rng(3)
    for window in (2, 3, 10, 35):
        lengths = rng.integers(window, 4 * window, 20)
        flat = rng.integers(0, 3, lengths.sum()).astype(np.uint64)
        strips = substrings.Strips(flat, lengths, window)
        starts = Counter((int(o), int(s) + k) for o, s, n in zip(strips.owner, strips.start, strips.count) for k in range(n))
        assert starts == Counter((o, s) for o, n in enumerate(lengths.tolist()) for s in range(n - window + 1))
        assert strips.count.max() <= substrings.core_span(window)
