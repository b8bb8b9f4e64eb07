"""Keyed idempotent upsert of bulletins (SM4, SM7, SNK5).

A micro-batch is reduced to one row per key and appended as its own ``run=<id>/batch=<n>`` folder. The
run is the query's id, which Spark keeps in the checkpoint: a retried batch overwrites its own folder,
and a run with a new checkpoint never touches what another run wrote. Reading merges the versions of
a key by the messages' position in the source alone, so it does not matter which run or batch brought
them. No micro-batch touches what earlier ones wrote, so its cost depends on the batch and not on the
table, and there is no operator state to grow. ``compact`` folds old versions together from time to time.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paneloom.streaming.bulletins import dead_letters, good

KEYS = ("ISO_Code", "Date")
#: Place of a message inside its file or partition of a batch, behind the position that the source gives.
LINE = "line"
#: With fields merged one by one: the position that each field's value came from.
PLACES = "places"


def reduce_batch(rows: DataFrame, order: str = "offset", merge: str = "record", keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key: the payload of the last position and the first arrival.

    The position is ``order``, and ``line`` where the rows have it. ``merge='fields'`` lets a later
    message override field by field, so a field it lacks keeps its value while an explicit null
    replaces it; the row then also holds the position of each field, against which still later rows,
    even of messages that arrive out of order, are judged.
    """
    at = F.struct(*[c for c in (order, LINE) if c in rows.columns])
    placed = rows.withColumn("_at", at)
    if merge == "record":
        last = F.max_by(F.struct("New_Confirmed", F.to_json("payload").alias("payload")), "_at")
        packed = placed.groupBy(*keys).agg(
            last.alias("_p"), F.min("received_at").alias("received_at"), F.max("_at").alias("_at")
        )
        return packed.select(
            *keys,
            F.col("_p.New_Confirmed").alias("New_Confirmed"),
            F.from_json("_p.payload", "map<string,string>").alias("payload"),
            "received_at",
            "_at.*",
        )
    known = F.try_element_at(PLACES, F.col("field")) if PLACES in rows.columns else F.lit(None)
    fields = placed.select(*keys, "_at", "received_at", *[c for c in (PLACES,) if c in rows.columns], F.explode_outer("payload").alias("field", "text"))
    fields = fields.withColumn("_field_at", F.coalesce(F.when(F.col("field").isNotNull(), known), "_at"))
    newest = fields.groupBy(*keys, "field").agg(
        F.max_by(F.struct("text"), "_field_at").alias("v"),
        F.max("_field_at").alias("_field_at"),
        F.min("received_at").alias("received_at"),
        F.max("_at").alias("_at"),
    )

    def gathered(value):
        return F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("field").isNotNull(), F.struct(F.col("field"), value)))))

    merged = newest.groupBy(*keys).agg(
        gathered(F.col("v.text")).alias("payload"),
        gathered(F.col("_field_at")).alias(PLACES),
        F.min("received_at").alias("received_at"),
        F.max("_at").alias("_at"),
    )
    cases = F.coalesce(
        F.try_element_at("payload", F.lit("New_Confirmed")), F.try_element_at("payload", F.lit("Confirmed")), F.lit("0")
    )
    return merged.select(*keys, cases.try_cast("double").alias("New_Confirmed"), "payload", PLACES, "received_at", "_at.*")


def upsert_stream(
    parsed: DataFrame,
    target: str,
    checkpoint: str,
    order: str = "offset",
    merge: str = "record",
    once: bool = True,
    rejects: str | None = None,
) -> StreamingQuery:
    """Start the upsert of parsed bulletins into ``target``; resumes from ``checkpoint``.

    ``order`` is the position that the source gives its messages; messages that share it, the lines
    of one file, follow each other as they are read. Unreadable messages go to ``rejects`` if given.
    With ``once`` the query ends when the input available at its start is consumed.
    """
    run: dict[str, str] = {}
    started = threading.Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        place = os.path.join(f"run={run['id']}", f"batch={batch_id}")
        numbered = batch.withColumn(LINE, F.monotonically_increasing_id())
        arrived = good(numbered).withColumn("received_at", F.current_timestamp())
        reduce_batch(arrived, order, merge).write.mode("overwrite").parquet(os.path.join(target, place))
        if rejects is not None:
            dead_letters(batch).write.mode("overwrite").parquet(os.path.join(rejects, place))

    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    run["id"] = query.id
    started.set()
    return query


def read_live(spark: SparkSession, target: str, order: str = "offset", merge: str = "record") -> DataFrame:
    """Current table: every key once, later messages over earlier ones."""
    merged = reduce_batch(spark.read.parquet(target).drop("run", "batch"), order, merge)
    return merged.drop(order, LINE, PLACES)


def compact(spark: SparkSession, source: str, target: str, order: str = "offset", merge: str = "record") -> None:
    """Write the merged table, with its positions, to a new path as a run of its own.

    The stream goes on writing to the new path; whatever arrives there is judged by position as before.
    """
    current = reduce_batch(spark.read.parquet(source).drop("run", "batch"), order, merge)
    current.write.mode("overwrite").parquet(os.path.join(target, "run=base", "batch=0"))


def upsert_once(
    parsed: DataFrame, target: str, checkpoint: str, order: str = "offset", merge: str = "record", timeout: int | None = None
) -> DataFrame:
    """Consume what is available, however long it takes unless ``timeout`` says otherwise, and return the
    live table."""
    query = upsert_stream(parsed, target, checkpoint, order, merge)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("the stream did not drain in time")
    try:
        return read_live(parsed.sparkSession, target, order, merge)
    except AnalysisException as error:
        raise RuntimeError("the stream held no message") from error
