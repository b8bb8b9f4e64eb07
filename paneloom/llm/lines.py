"""Line dedup (2): range-partitioned line hashes, first occurrences streamed, keep bitmaps returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paneloom.llm.tasks import documents, lower_ascii, unused
from paneloom.session import cut_lineage

SPACE = " \t\n\u000b\f\r"
KEY = ["h1", "h2"]


def split_lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def version(text):
    """31 bits that tell different texts under one key apart."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(0x7FFFFFFF)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, at) of each line whose key has ``min_chars`` code points: 128 bits of hash, and the
    version of the text and the line's position packed into one long."""
    lines = docs.select("doc_id", version(F.col("text")).alias("v"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    key = lower_ascii(F.btrim("line", F.lit(SPACE)))
    return (
        lines.select("doc_id", (F.shiftleft("v", 32) + F.col("pos")).alias("at"), key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"), "doc_id", "at")
    )


def keep_bitmaps(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The lines that go, as (doc_id, version, dropped map<int, bigint>, n_dropped): the map holds the words
    of 64 lines that have a bit set, so a kept document costs nothing and a row has no text.

    A line's key is the stripped, lower-cased line. A key of ``min_chars`` code points or more in at least
    ``min_docs`` documents stays only in the largest doc_id that holds it. Rows that share a doc_id are one
    document for the count; a null doc_id is one document too, smaller than all others.

    Hashes are dealt by range over (hash, document) and sorted, so a line that millions of documents share
    spreads over many tasks; each gives one first occurrence for a document, and only one partial count for
    a hash and task goes on. Marking is a join on the hash, whose hot keys the adaptive plan splits.
    """
    rows = cut_lineage(line_hashes(documents(docs, id_col, text_col), min_chars), "lines")
    inside = Window.partitionBy(*KEY, "doc_id").orderBy("at")  # the range exchange already brings these together
    ranged = rows.repartitionByRange(*KEY, "doc_id").withColumn("nth", F.row_number().over(inside))
    first = ranged.where(F.col("nth") == 1)
    repeated = (
        first.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs).drop("n")
    )
    repeated = cut_lineage(repeated, "repeated")  # as a table of its own, the plan can split its join
    gone = rows.join(repeated, KEY).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = gone.groupBy("doc_id", F.shiftright("at", 32).alias("version"), F.expr("cast((at & 4294967295) >> 6 as int)").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    return words.groupBy("doc_id", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` cut to the kept lines, and ``n_lines``, ``n_dropped`` added or replaced."""
    own, key, mark, dropped, number = (unused(docs, f"__{n}") for n in ("version", "key", "mark", "dropped", "number"))
    marks = bitmaps.select(*[F.col(a).alias(b) for a, b in zip(("doc_id", "version", "dropped", "n_dropped"), (key, mark, dropped, number))])
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn(own, version(F.col(text_col)))
    joined = keyed.join(marks, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(mark)), "left")
    word = lambda i: F.coalesce(F.element_at(dropped, F.floor(i / 64).cast("int")), F.lit(0))
    kept = F.filter(split_lines(F.col(text_col)), lambda line, i: F.expr("1L").bitwiseAND(F.call_function("shiftright", word(i), i % 64)) == 0)
    new = {
        "n_lines": F.size(split_lines(F.col(text_col))).cast("long"),
        "n_dropped": F.coalesce(number, F.lit(0)).cast("long"),
        text_col: F.when(F.col(dropped).isNull(), text).otherwise(F.array_join(kept, "\n")),
    }
    return joined.withColumns(new).drop(own, key, mark, dropped, number)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without their repeated lines; a null or empty text is one empty line and stays empty."""
    return drop_lines(docs, keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), id_col, text_col)
