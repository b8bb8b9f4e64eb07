"""The corpus pipeline: five stages from raw documents to token ids, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paneloom.catalog.base import table
from paneloom.llm.bpe import encode_documents
from paneloom.llm.catalog import BYTE_BPE
from paneloom.llm.lines import dedup_lines
from paneloom.llm.postings import decontaminate
from paneloom.llm.ranking import rank_quality
from paneloom.llm.setsketch import near_duplicates
from paneloom.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep(docs: DataFrame, judged: DataFrame, verdict) -> DataFrame:
    """The rows of ``docs`` that a stage keeps. A row is known by its key and a hash of its text, on which alone
    the verdict rests, so rows that share a key are judged each by itself; null keys and texts are known too."""
    good = judged.where(verdict).select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct()
    rows = docs.select(*COLUMNS).withColumn("__own", F.xxhash64("text"))
    return rows.join(good, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__version")), "left_semi").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking of quality predicts 1 for, judged where they are, without an exchange of texts.

    Every row is judged by its own text: null and empty texts like any other, repeated rows alike; without labels
    all stay; an empty table gives no rows; columns beyond those of ``documents`` go.
    """
    judged = rank_quality(docs, table(spark, sf_dir, "labels"), "quality", carry=COLUMNS)
    return judged.where(F.col("predicted") == 1).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least three share, but in the last of them; n_chars follows.

    Null texts become empty; rows that share a key are one document for the count and lose the same lines; a null
    key is a document smaller than all others; an empty table gives no rows; further columns go.
    """
    return dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five-word shingles, similarity 0.8 or more.

    Texts without words are no copies and stay, and so do rows without a key. Rows that share a key are versions of
    one document and share its group; equal ones count once, different texts stay. An empty table gives no rows;
    further columns go.
    """
    judged = cut_lineage(near_duplicates(docs, size=5, percent=80), "judged")
    stay = keep(docs, judged, F.col("kept"))
    equal = judged.where("kept and doc_id is not null").groupBy("doc_id", "version").agg(F.count("*").alias("n")).where("n > 1")
    if equal.isEmpty():
        return stay
    return stay.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(stay.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of the benchmark.

    Every row is judged by its own text, so of rows that share a key some may stay. Null and empty texts stay;
    without a benchmark all do; an empty table gives no rows; further columns go.
    """
    return keep(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")), ~F.col("contaminated"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document left, and a digest of their decoded text.

    Null and empty texts have no ids; rows that share a key each get theirs; an empty table gives no rows.
    """
    coded = encode_documents(docs, BYTE_BPE, decode=True)
    return coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicate),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: The classifier and the encoder cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut_lineage(docs, "corpus")
    return docs
