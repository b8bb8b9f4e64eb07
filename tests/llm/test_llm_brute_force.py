"""Operators against plain Python versions, public libraries, round trips and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from paneloom.llm import bpe, catalog, counts, lines, lm, ngrams, postings, quality, ranking, setsketch, sharding
from paneloom.llm.tasks import SharedArrays, WordHashes

SF = "/root/testdata/sf0.001"
BPE, PIECES = catalog.BYTE_BPE, catalog.PIECE_BPE
SCRAPS = [
    " ", "\n", "  ", "\t", "a", "b", "The", " of", "'s", "'re", "é", "ß", "123", "٣", "!!", "...", "<|endoftext|>", "\xa0", " ", "\x1c", "\x85",
    "漢字", "😀", "é", "worthless", "\r\n", "_", "$$$", "\x00", "▁", "<s>", "<unk>", "THE", "hello",
]


def scraps(count, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 24))) for _ in range(count)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def plain_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


# 1


def test_shards_follow_weights_and_growth_moves_only_into_new_shards(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = sharding.shard_documents(keys, (1.0, 2.0, 0.0, 1.0), (4.0,)).collect()
    share = Counter(r["shard"] for r in out)
    assert set(share) == {0, 1, 3} and abs(share[1] / 20_000 - 0.5) < 0.02
    moved = [r for r in out if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {4} and abs(len(moved) / 20_000 - 0.5) < 0.02
    for shard in share:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(share[shard]))


def test_shard_depends_on_key_and_count_alone(spark, docs):
    of = lambda d: {r["doc_id"]: r["shard"] for r in sharding.shard_documents(d).collect()}
    whole = of(docs)
    assert of(docs.where("doc_id % 3 = 0")) == {k: v for k, v in whole.items() if k % 3 == 0}


# 2


def test_bitmaps_hold_only_words_with_a_dropped_line(spark):
    line = "a line of more than twenty characters"
    rows = [(k, "\n".join(f"own line {k} number {n} is unlike the others" for n in range(130)) + "\n" + f"  {line.upper() if k else line}  ") for k in range(3)]
    marks = lines.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["dropped"] for r in marks} == {0: {2: 4}, 1: {2: 4}}


# 3 and 4


def test_encoding_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    mixed = scraps(1500) + list(texts.values())
    out = bpe.encode_documents(spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string"), BPE, words=500, decode=True)
    for row in out.collect():
        expected = library.encode(mixed[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == expected
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False) == mixed[row["doc_id"]]


def test_any_ids_decode_as_in_the_library(spark):
    from tokenizers import Tokenizer

    rng, library = random.Random(5), Tokenizer.from_file(BPE)
    ids = [[rng.randrange(50_257) for _ in range(rng.randint(0, 6))] for _ in range(800)]
    out = bpe.decode_documents(spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>"), BPE)
    assert all(r["text"] == library.decode(ids[r["doc_id"]], skip_special_tokens=False) for r in out.collect())


def test_transducer_is_minimal_and_exact():
    entries = {w.encode(): [k, k + 1] for k, w in enumerate(["", "tap", "taps", "top", "tops", "stop", "stops", "é"])}
    lexicon = bpe.compile_words(entries)
    probes = [*entries, b"ta", b"topss", b"x", b"sto"]
    assert bpe.look_up(lexicon, probes)[1:8] == [entries[w] for w in probes[1:8]]
    assert bpe.look_up(lexicon, probes)[8:] == [None] * 4
    right = set()  # one state for each set of possible endings

    def endings(prefix):
        return frozenset(w[len(prefix) :] for w in entries if w.startswith(prefix))

    for w in entries:
        right |= {endings(w[:k]) for k in range(len(w) + 1)}
    assert len(lexicon["final"]) == len(right)


def test_shared_arrays_come_back_with_and_without_a_mounted_folder(spark, monkeypatch):
    arrays = {"a": np.arange(5, dtype=np.int32), "b": np.array([2**63], np.uint64), "none": np.empty(0, np.int8)}
    for shared in (SharedArrays(spark, "t", arrays), monkeypatch.setattr("paneloom.llm.tasks.mounted_dir", lambda *_: None) or SharedArrays(spark, "t", arrays)):
        assert all((shared.open()[k] == v).all() for k, v in arrays.items())


def test_token_counts_equal_the_library(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    mixed = scraps(1500, 4) + list(texts.values())
    out = counts.count_tokens(spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string"), PIECES, limit=100, frequent=300)
    for row in out.collect():
        text = mixed[row["doc_id"]]
        assert (row["n_tokens"], row["n_bytes"]) == (len(library.encode(text)), len(text.encode()))
        assert row["over_limit"] == (row["n_tokens"] > 100)


# 5 and 7


def test_base_counts():
    def slow(text):
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        seen, doubles = set(), 0
        for line in text.split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                doubles += line in seen
                seen.add(line)
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubles, len(inside)

    rng = random.Random(8)
    for text in ["", "a", "a b", "a b c a b c", "a a a a", "x\x85y\xa0z"] + ["".join(rng.choice(["a ", "b ", "c\n", "# ", "\n", "\t", "é"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]:
        assert quality.base_counts(text, WordHashes()) == slow(text)


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ranked = [r for r in entry_points.queries()["op7_quality_ranking"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    good = [r["score"] for r in ranked if labels[r["doc_id"]]]
    bad = [r["score"] for r in ranked if not labels[r["doc_id"]]]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in ranked]) > 0.93
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in ranked)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    judged = quality.judge_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"), among=~held).where(held).collect()
    right = [(r["probability"] >= 0.5) == labels[r["doc_id"]] for r in judged if r["doc_id"] in labels]
    assert np.mean(right) > 0.93


def test_platt_and_cut():
    scores, labels = np.array([-3.0, -2, -1, 1, 2, 3]), np.array([0, 0, 0, 1, 1, 1])
    slope, shift = ngrams.platt(scores, labels)
    assert 0 < slope < 100 and abs(shift) < 0.5
    assert ranking.quantile_cut(scores, labels) == 0
    assert ranking.quantile_cut(np.array([3.0, 1, 2]), np.array([0, 0, 1])) == 2.5
    assert ranking.quantile_cut(scores, labels * 0) > 3 and ranking.quantile_cut(scores, labels * 0 + 1) < -3


# 6


def test_language_model_equals_a_plain_one(spark, docs, texts):
    trained = {k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2}
    tokens = {k: [*plain_words(t), "\n"] for k, t in texts.items()}
    uni, bi = Counter(), Counter()
    for k in trained:
        uni.update(tokens[k])
        bi.update(zip(["<", *tokens[k]], tokens[k]))
    n, v = sum(uni.values()), len(uni)
    total, follow, spread = Counter(), defaultdict(Counter), Counter()
    for (a, b), c in bi.items():
        total[a] += c
        follow[a][min(c, 3)] += 1
        spread[b] += 1
    histogram = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
    high, low = lm.discounts(histogram(bi.values())), lm.discounts(histogram(spread.values()))
    less = lambda c, d: d[min(c, 3) - 1] if c else 0
    rest = sum(less(c, low) for c in spread.values()) / len(bi)

    def p1(w):
        return (spread[w] - less(spread[w], low)) / len(bi) + rest / (v + 1)

    def p2(a, w):
        if not total[a]:
            return p1(w)
        return (bi[a, w] - less(bi[a, w], high) + sum(high[k - 1] * c for k, c in follow[a].items()) * p1(w)) / total[a]

    assert math.isclose(sum(map(p1, spread)) + p1("\0"), 1)
    for a in ["<", max(total, key=total.get), min(total)]:
        assert math.isclose(sum(p2(a, w) for w in spread) + p2(a, "\0"), 1)
    for row in entry_points.queries()["op6_language_model"](spark, SF).collect():
        own = tokens[row["doc_id"]]
        assert row["held_out"] == (row["doc_id"] not in trained) and row["train_tokens"] == n
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(w in uni for w in own))
        assert math.isclose(row["base_score"], sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert math.isclose(row["score"], sum(math.log10(p2(a, w)) for a, w in zip(["<", *own], own)), rel_tol=1e-9)


def test_packed_arrays_come_back():
    keys, values = np.array([1, 5, 5, 2**63], np.uint64), np.array([3, -1, 0, 9], np.int32)
    assert all((a == b).all() for a, b in zip((keys, values), lm.unpacked(lm.packed(keys, values), "<u8", "<i4")))


# 8


def plain_components(sets, percent):
    inside = defaultdict(set)
    for k, s in sets.items():
        for x in s:
            inside[x].add(k)
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in {p for group in inside.values() for p in combinations(sorted(group), 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: root(k) for k in sets}


def shingles(text, size):
    words = plain_words(text)
    size = min(size, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_chains_and_crowds(spark, size):
    rng = random.Random(size)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(120)]
    for k in range(220):  # a crowd of near copies that drifts: its ends are no longer alike
        if k % 3 == 0:
            base[rng.randrange(120)] = rng.choice(vocabulary)
        own = list(base)
        own[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append((k, " ".join(own)))
    for k in range(220, 320):  # half a passage shared by many that are no copies
        rows.append((k, " ".join(base[:80] + [rng.choice(vocabulary) for _ in range(40)])))
    rows += [(400 + k, rows[7][1]) for k in range(30)] + [(500, "one"), (501, "ONE"), (502, "two words"), (503, "Two  Words")]
    out = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=size, percent=80, block=16)
    expected = plain_components({k: shingles(t, size) for k, t in rows}, 80)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == expected


def test_five_word_shingles_on_the_tables(docs, texts):
    sets = {k: shingles(t, 5) for k, t in texts.items()}
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in setsketch.near_duplicates(docs, size=5).collect()}
    expected = plain_components({k: s for k, s in sets.items() if s}, 80)
    assert got == {k: (expected.get(k, k), len(sets[k])) for k in texts}


def test_estimate_is_close():
    sketch, rng = setsketch.Sketch(), np.random.default_rng(2)
    for similarity in (0.3, 0.6, 0.8, 0.95):
        found = []
        for _ in range(30):
            both = int(1000 * similarity / (1 + similarity))
            pool = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            a, b = sketch.of(pool[:500]), sketch.of(pool[500 - both : 1000 - both])
            found.append(sketch.similarity(np.array([500.0]), np.array([500.0]), np.array([(a > b).sum()]), np.array([(a < b).sum()]))[0])
        assert abs(np.mean(found) - similarity) < 0.03


def test_registers_merge():
    sketch, pool = setsketch.Sketch(), np.random.default_rng(4).integers(0, 2**63, 900, dtype=np.uint64)
    assert (np.maximum(sketch.of(pool[:500]), sketch.of(pool[400:])) == sketch.of(pool)).all()


# 9


def test_phrases_and_blocks_of_queries(spark):
    rng = random.Random(6)
    words = ["a", "b", "c", "é"]
    bodies = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    items = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    frame = lambda rows, key: spark.createDataFrame(list(enumerate(rows)), f"{key} long, text string")
    out = postings.decontaminate(frame(bodies, "doc_id"), frame(items, "item_id"), window=5, block_words=40, shard_bytes=300).collect()
    for row in out:
        own, hit, found = bodies[row["doc_id"]].split(), set(), set()
        for number, item in enumerate(items):
            q = item.split()
            size = min(5, len(q))
            for s in range(len(q) - size + 1 if size else 0):
                for k in range(len(own) - size + 1):
                    if own[k : k + size] == q[s : s + size]:
                        hit |= set(range(k, k + size))
                        found.add(str(number))
        assert (row["n_words"], row["n_hit"], row["items"]) == (len(own), len(hit), sorted(found))
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(own))


def test_proximity(spark):
    bodies = ["x a y b z", "a", "b a", "a y y y b", "b y a y b", None]
    index = postings.build_index(spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string"))
    got = sorted(map(tuple, postings.find_near(index, ["A", "b"], 3).collect()))
    assert got == [(0, 1, 3), (2, 0, 1), (4, 0, 2), (4, 2, 4)]


def test_decoded_digest_is_that_of_the_text(spark, texts):
    for row in entry_points.queries()["op3_bpe_round_trip"](spark, SF).collect():
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_merges_side_by_side_one_by_one_and_of_very_long_words():
    from tokenizers import Tokenizer

    vocabulary, library, rng = bpe.Vocabulary(BPE), Tokenizer.from_file(BPE), random.Random(9)
    words = ["".join(rng.choice("aetoinshré") for _ in range(rng.randint(1, 70))) for _ in range(400)]
    words += ["a" * 30_000, "ab" * 9, "".join(rng.choice("ethaion") for _ in range(20_000))]
    together = vocabulary.merge_all([w.encode() for w in words])
    for word, ids in zip(words, together):
        assert ids == vocabulary.merge(word.encode()) == library.encode(word, add_special_tokens=False).ids
