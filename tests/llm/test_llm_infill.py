"""Fill-in-middle against a plain regular expression, and the wavelet matrix against counting."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from paneloom.llm import infill
from test_llm_brute_force import scraps

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def plain_infill(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(b"1:" + (b"" if key is None else str(key).encode())).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def frame(spark, rows):
    clash = ("n", "form", "h1", "h2", "output", "prefix_chars")
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in clash})


def test_infill_equals_the_pattern_and_gives_the_text_back(spark):
    rng = random.Random(1)
    odd = [None, "", " ", "a", "\n", "é", "<P>", "x <M> y", "<", "<P", "<S<M", "\x00\x01", "😀" * 9, "Ab" * 50_000 + " é " * 20_000, "aZ[`{@"]
    rows = [(k, t) for k, t in enumerate(odd)] + [(1000 + k, t) for k, t in enumerate(scraps(600))] + [(None, "null key"), (None, None), (5, "again"), (5, "again")]
    rows += [(5000 + k, rng.choice(["<", "<P", "S>", ">", "M>x<"]) * rng.randint(1, 9) + "word") for k in range(300)]
    out = infill.infill(frame(spark, rows)).withColumn("whole", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda t: tuple(map(str, t))
    assert sorted((key(r) for r in out)) == sorted(key((k, *plain_infill(k, t), t or "")) for k, t in rows)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert infill.infill(frame(spark, [])).count() == 0


def test_cuts_do_not_depend_on_what_shares_a_chunk(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(scraps(200, 9))]
    whole = sorted(map(tuple, infill.infill(frame(spark, rows)).collect()))
    monkeypatch.setattr(infill, "CHUNK", 40)
    assert sorted(map(tuple, infill.infill(frame(spark, rows)).collect())) == whole


def test_ranks_equal_counting():
    rng = np.random.default_rng(2)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, size, dtype=np.uint8)
        matrix, at = infill.WaveletMatrix(symbols), np.arange(size + 1)
        for symbol in range(4):
            assert matrix.rank(symbol, at).tolist() == [0, *np.cumsum(symbols == symbol).tolist()]
