"""Shards by jump consistent hashing, DataFrame functions only.

A document's shard follows from its doc_id and the number of shards alone: a
generator seeded with the id jumps to ever higher shards, and the last one below
the number of shards is taken (Lamping and Veach). There is no table of ranges, and one more
shard takes rows into itself only. Shards are near equal in rows, not exactly.
Ids are unsigned 64-bit numbers here (a negative one counts from 2^64 down).

Inside its shard a row gets a place by doc_id, then text_crc32, then size. Places
come from one sort by range: each partition's rows before it are known from
counts by shard and partition, so no shard is ever gathered in one task. Equal
rows are told apart before the sort, so an id or a text that holds a third
of all rows is dealt over many partitions as well.

Defined cases: NULL text has no bytes (size 8, text_crc32 0); NULL doc_id counts
as id 0 for the shard and comes before all others in its place; rows given twice
get a place each; columns other than doc_id and text are ignored; an empty
table gives an empty result; fewer than one shard raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import staged

#: The published generator: key * FACTOR + 1 modulo 2^64, of which the upper 31
#: bits are drawn. Fixed values.
FACTOR, MODULUS, DROPPED, DRAWN = 2862933555777941757, 1 << 64, 1 << 33, 1 << 31


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (int) of a long column among ``shards``. Each step goes at least one
    shard up, so ``shards`` steps are always enough."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")

    def drawn(k: Column) -> Column:
        # 20 by 19 digits below 2^64 * FACTOR < 10^38: never rounded
        product = k.cast("decimal(20,0)") * F.lit(FACTOR).cast("decimal(19,0)") + F.lit(1)
        return (product % F.lit(str(MODULUS)).cast("decimal(20,0)")).cast("decimal(20,0)")

    def jump(s: Column) -> Column:
        high = F.floor(s["key"] / F.lit(DROPPED)).cast("double")
        return F.floor((s["at"] + 1) * (F.lit(float(DRAWN)) / (high + 1.0)))

    def step(s: Column, _: Column) -> Column:
        return F.when(jump(s) < shards, F.struct(drawn(s["key"]).alias("key"), jump(s).alias("at"))).otherwise(s)

    unsigned = F.coalesce(key, F.lit(0)).cast("decimal(20,0)")
    unsigned = F.when(unsigned < 0, unsigned + F.lit(str(MODULUS)).cast("decimal(20,0)")).otherwise(unsigned)
    first = F.struct(drawn(unsigned).alias("key"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), first, step, lambda s: s["at"].cast("int"))


def keyed(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, grown_shard (with one shard more),
    without places; map-only."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    key = F.col("doc_id").cast("long")
    return docs.select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"), jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``keyed`` with ``slot``: gapless from 0 within a shard."""
    order = ["shard", "doc_id", "text_crc32", "size", "row"]
    rows = staged(keyed(docs, shards).withColumn("row", F.monotonically_increasing_id()), "keyed")
    # place = partition * 2^33 + row of the sorted partition; fixed once written
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("place", F.monotonically_increasing_id()).drop("row"), "placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    # one row for each partition and shard in it
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    starts = parts.select("shard", "part", (before - F.col("first")).alias("shift"))
    return (placed.join(starts, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("place") + F.col("shift")).alias("slot"), "grown_shard"))
