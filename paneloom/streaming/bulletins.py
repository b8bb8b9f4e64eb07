"""Bulletins: source, normalisation and the replayable message set (SRC8, SM1-SM3, SM5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paneloom.functions.records import parse_json
from paneloom.operators.schema import COLUMN_ALIASES, normalize_columns
from paneloom.sources.writers import to_messages

# Spellings accepted in a message.
MESSAGE_ALIASES = {"iso_code": "ISO_Code", "date": "Date"}

MESSAGE_SCHEMA = "value string"


def read_bulletins(spark: SparkSession, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Stream of messages ``(value, offset)`` from the earliest position.

    ``offset`` is what orders messages: on a topic its time, partition and offset, as offsets compare
    within a partition only. With ``path`` a folder of text files takes the place of the topic, ordered
    by file time, name and block; the upsert numbers the lines of a block as they are read. The position
    already reached is kept by the query's checkpoint.
    """
    if path is not None:
        reader = spark.readStream.schema(MESSAGE_SCHEMA).options(**options)
        meta = F.col("_metadata")
        place = F.struct(
            F.unix_micros(meta["file_modification_time"]).alias("time"), meta["file_path"].alias("file"), meta["file_block_start"].alias("block")
        )
        return reader.text(path).select("value", place.alias("offset"))
    topic = spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**options).load()
    return topic.select(F.col("value").cast("string").alias("value"), F.struct("timestamp", "partition", "offset").alias("offset"))


def normalize_record(df: DataFrame) -> DataFrame:
    """A stored row as it is published: no store id, canonical names, ``New_Confirmed`` always there."""
    clean = normalize_columns(df.drop("_id"), COLUMN_ALIASES)
    sources = [F.col(c) for c in ("New_Confirmed", "Confirmed") if c in clean.columns]
    return clean.withColumn("New_Confirmed", F.coalesce(*sources, F.lit(0)))


def replay_batches(df: DataFrame, start: str, date: str = "Date") -> DataFrame:
    """Messages of the days from ``start`` on, tagged by day; written by ``publish`` one folder per day."""
    clean = normalize_record(df)
    return to_messages(clean.filter(F.col(date) >= F.lit(start).cast("date")), date)


def _rename_field(record: Column, old: str, new: str) -> Column:
    """Rename a field of the record unless the new name is taken."""
    rename = F.map_contains_key(record, F.lit(old)) & ~F.map_contains_key(record, F.lit(new))
    renamed = F.transform_keys(record, lambda name, _: F.when(name == old, F.lit(new)).otherwise(name))
    return F.when(rename, renamed).otherwise(record)


def parse_bulletins(stream: DataFrame, value: str = "value", aliases: Mapping[str, str] = MESSAGE_ALIASES) -> DataFrame:
    """Messages to ``(ISO_Code, Date, New_Confirmed, payload, ok)`` beside their other columns.

    The payload keeps every field as text under its canonical name, explicit nulls included. Text
    that is no JSON object is marked ``ok = false`` and does not stop the stream.
    """
    rest = [c for c in stream.columns if c != value]
    record = stream.select(*rest, F.col(value).alias("raw"), parse_json(F.col(value)).alias("_r"))
    payload = F.col("_r")
    for old, new in aliases.items():
        payload = _rename_field(payload, old, new)
    named = record.withColumn("payload", payload)
    cases = F.coalesce(F.try_element_at("payload", F.lit("New_Confirmed")), F.try_element_at("payload", F.lit("Confirmed")), F.lit("0"))
    return named.select(
        *rest,
        F.coalesce(F.try_element_at("payload", F.lit("ISO_Code")), F.lit("Unknown")).alias("ISO_Code"),
        F.coalesce(F.try_element_at("payload", F.lit("Date")), F.lit("N/A")).alias("Date"),
        cases.try_cast("double").alias("New_Confirmed"),
        "payload",
        "raw",
        F.col("_r").isNotNull().alias("ok"),
    )


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter("ok").drop("ok", "raw")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that could not be read, as they came."""
    return parsed.filter(~F.col("ok")).select("raw", *[c for c in parsed.columns if c == "offset"])
