"""Every operator and stage on null, empty, very long and repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneloom.llm import bpe, catalog, counts, licenses, lines, lm, postings, quality, ranking, setsketch, sharding

PROSE = "The quick brown fox jumps over the lazy dog near the river bank while seven wise men watch from afar"
LONG = " ".join(f"word{k % 997} item{k}" for k in range(60_000))
ROWS = [
    (1, None), (2, ""), (3, " \n\t\n "), (4, PROSE), (4, PROSE), (5, PROSE), (6, PROSE + " today"), (7, LONG), (None, PROSE), (None, None),
    (8, "Licensed under CC BY-NC 4.0."), (9, "\n".join([PROSE] * 3)), (10, "*** $$$ ### " * 40), (11, "a"), (12, "a"), (13, PROSE.upper()),
]
LABELS = [(4, 1, 0), (6, 1, 0), (10, 0, 0), (7, 1, 0), (9, 1, 0), (8, None, 0), (None, 0, 0), (99, 0, 1)]
CLASH = ("shard", "slot", "n_lines", "n_dropped", "dropped", "version", "key", "__key", "__id", "rep", "label", "ids", "score", "size", "component_id", "kept", "h1", "at")

OPERATORS = {
    "shards": lambda d, l, b: sharding.shard_documents(d),
    "lines": lambda d, l, b: lines.dedup_lines(d),
    "encode": lambda d, l, b: bpe.encode_documents(d, catalog.BYTE_BPE, decode=True),
    "counts": lambda d, l, b: counts.count_tokens(d, catalog.PIECE_BPE),
    "quality": lambda d, l, b: quality.judge_quality(d, l),
    "lm": lambda d, l, b: lm.score_documents(d, F.lit(True)),
    "ranking": lambda d, l, b: ranking.rank_quality(d, l),
    "near": lambda d, l, b: setsketch.near_duplicates(d, size=2),
    "phrases": lambda d, l, b: postings.decontaminate(d, b),
    "licenses": lambda d, l, b: licenses.scan_licenses(d),
}


def tables(spark, rows, labels, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("lang", "source")})
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return (
        docs.withColumns({c: F.lit("clash") for c in CLASH}),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash")),
        spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash")),
    )


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_give_one_row_each(spark, name):
    docs, labels, items = tables(spark, ROWS, LABELS, [(1, PROSE), (2, None), (None, PROSE), (3, "!!"), (4, "fox")])
    out = OPERATORS[name](docs, labels, items).select("doc_id").collect()
    assert sorted(str(r[0]) for r in out) == sorted(str(k) for k, _ in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(spark, name):
    assert OPERATORS[name](*tables(spark, [], [], [])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_beside_empty_tables(spark, name):
    docs, labels, items = tables(spark, ROWS, [], [])
    assert OPERATORS[name](docs, labels, items).count() == len(ROWS)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pipeline_stages_on_odd_rows(spark, tmp_path, rows):
    docs, labels, items = tables(spark, rows, LABELS if rows else [], [(1, PROSE)] if rows else [])
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    assert bool(docs.count()) == bool(rows)


def test_defined_results(spark):
    docs, labels, items = tables(spark, ROWS, LABELS, [(1, PROSE), (4, "fox"), (None, "zebra")])
    of = lambda df: {(r["doc_id"], k): r for k, r in enumerate(df.collect())}
    near = OPERATORS["near"](docs, labels, items).collect()
    label = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near if r["doc_id"] is not None}
    assert label[4][1] == label[5][1] == label[6][1] == label[13][1] == 4 and label[11] == (1, 11, True) and label[12] == (1, 11, False)
    assert label[1] == (0, 1, True) and label[2] == (0, 2, True) and label[3] == (0, 3, True)
    assert all(r["component_id"] is None and r["kept"] for r in near if r["doc_id"] is None)
    hit = {r["doc_id"]: r for r in OPERATORS["phrases"](docs, labels, items).collect()}
    assert hit[4]["items"] == ["1", "4"] and hit[4]["contaminated"] and hit[1]["n_words"] == 0 and not hit[1]["contaminated"]
    kept = {r["doc_id"]: r["text"] for r in OPERATORS["lines"](docs, labels, items).collect() if r["doc_id"] is not None}
    assert kept[4] == kept[5] == kept[9] == "" and kept[13] == PROSE.upper() and kept[1] == "" and kept[3] == " \n\t\n "
    found = {r["doc_id"]: r for r in OPERATORS["licenses"](docs, labels, items).collect()}
    assert found[8]["whole"] == "CC-BY-NC-4.0-notice" and found[8]["parts"] == ["CC-BY-NC-4.0-notice"] and found[4]["parts"] == []
    assert len(of(OPERATORS["shards"](docs, labels, items))) == len(ROWS)
