"""Keyed state in front of the live table (SM4, SNK5): only what changes the table is written.

For each key the state store holds the last message and its first arrival, in a streaming aggregate, so no key
costs a call into Python. Only where silent keys are to be dropped, a processor with timers holds them, without payload.
A message at or below that position, a repeat or a late one, writes nothing. The rows go to the same
``run=<id>/batch=<n>`` folders as those of ``upsert`` and are read by the same ``read_live``, which judges
by position alone; so dropping the state of a silent key costs at most a row that loses against an
earlier one. Each task reduces what it read to one row per key and Arrow batch before the exchange, so a
key that holds most of the messages sends few rows.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from paneloom.streaming.bulletins import good
from paneloom.streaming.upsert import KEYS, LINE, read_live

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
TURN_KEY = "streaming.sql.batchId"  # a local property of each task of a micro-batch
TURN = "_turn"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def place_fields(parsed: DataFrame, order: str) -> list[T.StructField]:
    """The parts of a position: the fields of ``order``, or ``order`` itself, and the line."""
    kind = parsed.schema[order].dataType
    parts = kind.fields if isinstance(kind, T.StructType) else [parsed.schema[order]]
    return [T.StructField(f"_p{i}", f.dataType) for i, f in enumerate(parts)] + [T.StructField(LINE, T.LongType())]


def flat_rows(parsed: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    """Readable messages with the parts of their position side by side."""
    kind = parsed.schema[order].dataType
    parts = [F.col(order)[f.name] for f in kind.fields] if isinstance(kind, T.StructType) else [F.col(order)]
    return good(parsed).select(
        *keys,
        "New_Confirmed",
        F.to_json("payload").alias("payload"),
        F.unix_micros(F.current_timestamp()).alias("received_at"),
        *[p.alias(f"_p{i}") for i, p in enumerate(parts)],
    )


def newest_of_batches(flat: DataFrame, keys: Sequence[str], places: Sequence[str]) -> DataFrame:
    """The last message of each key in each Arrow batch, lines numbered as they are read, with the number of the
    micro-batch that read it."""

    def newest(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        context = TaskContext.get()
        at = context.partitionId() << 33
        turn = int(context.getLocalProperty(TURN_KEY))
        for batch in batches:
            if not batch.num_rows:
                continue
            lines = pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64))
            at += batch.num_rows
            turns = pa.array(np.full(batch.num_rows, turn))
            rows = pa.RecordBatch.from_arrays([*batch.columns, lines, turns], names=[*batch.schema.names, LINE, TURN])
            by = [(c, "ascending") for c in (*keys, *places)]
            rows = rows.take(pc.sort_indices(rows, sort_keys=by, null_placement="at_start"))
            ends = np.ones(rows.num_rows, dtype=bool)
            ends[:-1] = False
            for key in keys:
                column = rows.column(key)
                ends[:-1] |= pc.not_equal(column[:-1], column[1:]).to_numpy(zero_copy_only=False)
            yield rows.filter(pa.array(ends))

    longs = [T.StructField(c, T.LongType()) for c in (LINE, TURN)]
    return flat.mapInArrow(newest, T.StructType([*flat.schema.fields, *longs]))


class LatestBulletin(StatefulProcessor):
    """Lets a message through that lies behind all earlier ones of its key, with the first arrival.

    With ``idle_ms`` a timer drops the state of a key that has been silent for that long.
    """

    def __init__(self, names: Sequence[str], keys: Sequence[str], places: Sequence[T.StructField], idle_ms: int | None):
        self.names, self.keys, self.idle_ms = list(names), list(keys), idle_ms
        self.places = [f.name for f in places]
        longs = [T.StructField(c, T.LongType()) for c in ("received_at", "until")]
        self.schema = T.StructType([*places, *longs])

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        def rank(place):
            return [(v is not None, v) for v in place]

        held = self.last.get()
        place, arrived, until = (held[:-2], held[-2], held[-1]) if held is not None else (None, None, None)
        top = None
        for row in rows:
            arrived = row["received_at"] if arrived is None else min(arrived, row["received_at"])
            found = [row[c] for c in self.places]
            if place is None or rank(found) > rank(place):
                place, top = found, row
        if self.idle_ms is not None:
            if until is not None:
                self.handle.deleteTimer(until)
            until = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(until)
        if top is not None or self.idle_ms is not None:
            self.last.update((*place, arrived, until))
        if top is None:
            return iter(())
        values = {**top.asDict(), **dict(zip(self.keys, key)), "received_at": arrived}
        return iter([Row(**{c: values[c] for c in self.names})])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_by_key(reduced: DataFrame, keys: Sequence[str], places: Sequence[str]) -> DataFrame:
    """For each key of a micro-batch the last message so far, with the micro-batch it came in and the first arrival.

    A streaming aggregate: the state is read and written by the engine, without a call into Python for a key. A
    message at the position of an earlier one loses, as the earlier micro-batch is the greater.
    """
    rest = [c for c in reduced.columns if c not in (*keys, *places, TURN, "received_at")]
    top = F.max(F.struct(*places, (-F.col(TURN)).alias("_sooner"), *rest)).alias("_top")
    found = reduced.groupBy(*keys).agg(top, F.min("received_at").alias("_arrived"))
    values = {"received_at": F.col("_arrived"), TURN: -F.col("_top._sooner"), **{c: F.col(c) for c in keys}}
    return found.select(*[values.get(c, F.col("_top")[c]).alias(c) for c in reduced.columns])


def changes(parsed: DataFrame, order: str = "offset", keys: Sequence[str] = KEYS, idle_ms: int | None = None) -> DataFrame:
    """Stream of the last messages of the keys that a micro-batch holds, positions still in parts; those that change the
    live table came in that micro-batch (``TURN``). With ``idle_ms`` there are no others."""
    places = place_fields(parsed, order)
    names = [f.name for f in places]
    reduced = newest_of_batches(flat_rows(parsed, order, keys), keys, names)
    if idle_ms is None:
        return latest_by_key(reduced, keys, names)
    processor = LatestBulletin(reduced.columns, keys, places, idle_ms)
    return reduced.groupBy(*keys).transformWithState(processor, reduced.schema, "Update", "ProcessingTime")


def stored_rows(flat: DataFrame, kind: T.DataType, order: str, keys: Sequence[str]) -> DataFrame:
    """Changed rows in the form of the live table's versions."""
    if isinstance(kind, T.StructType):
        position = F.struct(*[F.col(f"_p{i}").alias(f.name) for i, f in enumerate(kind.fields)])
    else:
        position = F.col("_p0")
    return flat.select(
        *keys,
        "New_Confirmed",
        F.from_json("payload", "map<string,string>").alias("payload"),
        F.timestamp_micros("received_at").alias("received_at"),
        position.alias(order),
        LINE,
    )


def state_stream(
    parsed: DataFrame,
    target: str,
    checkpoint: str,
    order: str = "offset",
    keys: Sequence[str] = KEYS,
    idle_ms: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Start the upsert with keyed state; resumes, state included, from ``checkpoint``.

    Whole records are merged, as with ``merge='record'`` of ``upsert_stream``; unreadable messages write
    nothing. The state lies in RocksDB below the checkpoint, so it is not bounded by an executor's memory.
    With ``once`` timers go off in batches that hold messages only, as each batch without any would ask for
    another.
    """
    spark = parsed.sparkSession
    run: dict[str, str] = {}
    started = threading.Event()
    kind = parsed.schema[order].dataType

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        place = os.path.join(target, f"run={run['id']}", f"batch={batch_id}")
        stored_rows(batch.filter(F.col(TURN) == batch_id), kind, order, keys).write.mode("overwrite").parquet(place)

    wanted = {PROVIDER: ROCKSDB, **({NO_DATA: "false"} if once else {})}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        writer = changes(parsed, order, keys, idle_ms).writeStream.foreachBatch(write).outputMode("update")
        writer = writer.option("checkpointLocation", checkpoint)
        query = (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    run["id"] = query.id
    started.set()
    return query


def state_upsert_once(
    parsed: DataFrame, target: str, checkpoint: str, order: str = "offset", idle_ms: int | None = None
) -> DataFrame:
    """Consume what is available and return the live table."""
    state_stream(parsed, target, checkpoint, order, idle_ms=idle_ms).awaitTermination()
    return read_live(parsed.sparkSession, target, order)
