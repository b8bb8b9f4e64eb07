"""Sharding (1): weighted rendezvous hashing of record keys, JVM-side only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paneloom.llm.tasks import documents, unused
from paneloom.session import cut_lineage

DIGITS = 13  # hex digits of the digest that make the uniform number: 52 bits, exact in a double


def bid(key: Column, shard: int, weight: float) -> Column:
    """What ``shard`` bids for ``key``: an exponential variable with rate ``weight``; the least bid wins.

    Bids depend on the key and the shard alone, so a further shard changes only the keys that it wins.
    """
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    uniform = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**DIGITS))
    return F.struct((-F.ln(uniform) / F.lit(float(weight))).alias("bid"), F.lit(shard).alias("shard"))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """Struct (bid, shard) of the winning shard; shards of weight 0 take nothing."""
    bids = [bid(key, shard, weight) for shard, weight in enumerate(weights) if weight > 0]
    if not bids:
        raise ValueError("at least one shard needs a weight above 0")
    return bids[0] if len(bids) == 1 else F.least(*bids)


def assign(df: DataFrame, keys: Sequence[str], weights: Sequence[float], grown: Sequence[float] = ()) -> DataFrame:
    """``df`` with ``shard``, and with ``grown_shard`` as if the shards in ``grown`` stood behind the others.

    Columns of these names in ``df`` are replaced. A null key is a key of its own.
    """
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys])
    name = unused(df, "__won")
    won = df.withColumn(name, winner(key, weights))
    more = [bid(key, len(weights) + i, w) for i, w in enumerate(grown) if w > 0]
    after = F.least(name, *more) if more else F.col(name)
    return won.withColumn("grown_shard", after["shard"]).withColumn("shard", F.col(name)["shard"]).drop(name)


def with_slots(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``slot``: the gapless place of each row inside its shard, by ``order``.

    Rows are dealt by range over (shard, order), so a shard spreads over as many tasks as its size asks
    for. Each task numbers its sorted rows; only one count for each shard and task is summed up. The
    numbered rows are a written table, so that a lost executor cannot change their numbers.
    """
    cols = ["shard", *order]
    numbered = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__at", F.monotonically_increasing_id())
    rows = cut_lineage(numbered, "shards").withColumn("__part", F.shiftright("__at", 33))
    counts = rows.groupBy("shard", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    slot = F.col("__at") - F.col("__first") + F.col("__before")
    return rows.join(starts, ["shard", "__part"]).withColumn("slot", slot).drop("__at", "__part", "__first", "__before")


def shard_documents(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * 24, grown: Sequence[float] = (1.0,), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document with its shard, its slot there and the shard it would have with ``grown`` added.

    A null text has no bytes (size 8, crc 0); a null key is one key; rows that share a key share a shard
    and have slots of their own; an empty table gives no rows; further columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    sized = documents(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )
    placed = assign(sized, ["doc_id"], weights, grown)
    return with_slots(placed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
