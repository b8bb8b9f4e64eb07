"""The pipeline's rows against plain Python stages; the classifier's verdicts are taken from its operator."""

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
from paneloom.llm import catalog, ranking
from test_llm_brute_force import BPE, SF, plain_components, shingles


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_lines(texts):
    key = lambda line: lower(line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for k, text in texts.items():
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(k)
    last = {line: max(ks) for line, ks in holders.items() if len(ks) >= 3}
    return {k: "\n".join(x for x in t.split("\n") if last.get(key(x), k) == k) for k, t in texts.items()}


def plain_contaminated(text, windows):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", lower(text))
    hit = set()
    for size in {len(w) for w in windows}:
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in windows:
                hit |= set(range(k, k + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_pipeline_equals_plain_stages(spark):
    from tokenizers import Tokenizer

    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    good = {r["doc_id"] for r in ranking.rank_quality(docs, labels, "quality").collect() if r["predicted"]}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] in good}
    assert 0 < len(texts) < docs.count()
    texts = plain_lines(texts)
    sets = {k: shingles(t, 5) for k, t in texts.items()}
    component = plain_components({k: s for k, s in sets.items() if s}, 80)
    texts = {k: t for k, t in texts.items() if component.get(k, k) == k}
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", lower(r["text"] or ""))
        size = min(13, len(words))
        windows |= {tuple(words[k : k + size]) for k in range(len(words) - size + 1 if size else 0)}
    clean = {k: t for k, t in texts.items() if not plain_contaminated(t, windows)}
    assert len(clean) < len(texts)
    library = Tokenizer.from_file(BPE)
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(clean)
    for k, text in clean.items():
        assert out[k]["ids"] == library.encode(text, add_special_tokens=False).ids
        assert out[k]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_are_those_of_the_contract():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    assert catalog.BYTE_BPE and corpus_pipeline.ORACLE_SQL is None


def test_rows_that_share_a_key_are_judged_by_themselves(spark, tmp_path):
    passage = " ".join(f"bench{k}" for k in range(30))
    clean = [" ".join(f"word{j}x{k}" for k in range(60)) for j in range(5)]
    rows = [(1, passage), (1, clean[0]), (2, passage), (3, clean[1]), (3, clean[1]), (None, clean[2]), (None, passage), (4, None), (5, clean[3] + " end"), (6, clean[3])]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(9, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = lambda out: sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert kept(corpus_pipeline.quality(spark, docs, str(tmp_path))) == sorted(rows, key=repr)
    assert kept(corpus_pipeline.decontamination(spark, docs, str(tmp_path))) == sorted([r for r in rows if r[1] != passage], key=repr)
    near = kept(corpus_pipeline.near_duplicate(spark, docs, str(tmp_path)))
    assert near == sorted([(1, passage), (1, clean[0]), (3, clean[1]), (None, clean[2]), (None, passage), (4, None), (5, clean[3] + " end")], key=repr)


def test_quality_judges_rows_by_their_text(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = {r["doc_id"]: r["predicted"] for r in ranking.rank_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"), "quality").collect()}
    bad, good = (min(k for k, v in verdicts.items() if v == verdict) for verdict in (0, 1))
    other = docs.where(f"doc_id = {bad}").selectExpr(f"{good}L AS doc_id", "text", "lang", "source", "n_chars")
    out = corpus_pipeline.quality(spark, docs.unionByName(other), SF).where(f"doc_id = {good}").collect()
    assert len(out) == 1 and out[0]["text"] == docs.where(f"doc_id = {good}").first()["text"]
