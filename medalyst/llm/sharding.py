"""Sharding by longest processing time: the largest group goes to the shard with the least so far, through a heap.

Rows with the same text form a group and stay together. A group above ``total / (shards * grain)`` bytes is scheduled by
itself: there are at most ``shards * grain`` of those, whatever the table's size. All smaller groups are gathered by hash into as many
packets, and packets are scheduled like groups, so the heap sees at most ``2 * shards * grain`` items and the shards differ by
about one packet at the end. A group larger than a whole shard's share makes its shard as large as that group.

Defined cases: NULL text counts as empty (size 1) and belongs to the group of empty texts; NULL ids, equal ids and repeated rows are rows
like any others; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalyst.session import durable, shuffle_width

LAW = "bytes"


def longest_first(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Item name -> shard: by falling size (ties by name), each to the least loaded shard (ties by number)."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, name in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = loads[0]
        heapq.heapreplace(loads, (load + size, shard))
        placed[name] = shard
    return placed


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, grain: int = 512) -> DataFrame:
    """Per row ``doc_id, size, text_crc32, group_key, shard``."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = durable(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
                               F.crc32(body).alias("text_crc32"), F.md5(body).alias("group_key")))
    groups = durable(rows.groupBy("group_key").agg(F.sum("size").alias("size")))
    total = groups.agg(F.sum("size")).first()[0] or 0
    pieces = shards * grain
    packet = F.concat(F.lit("packet "), F.pmod(F.xxhash64("group_key"), F.lit(pieces)).cast("string"))
    item = lambda size: F.when(F.col(size) * pieces > total, F.col("group_key")).otherwise(packet)
    # at most `pieces` large groups and `pieces` packets, by construction
    items = groups.select(item("size").alias("item"), "size").groupBy("item").agg(F.sum("size").alias("size")).collect()
    placed = longest_first([(row["size"], row["item"]) for row in items], shards)
    table = spark.createDataFrame(list(placed.items()), "item string, shard int")
    large = F.broadcast(table.where(~F.col("item").startswith("packet ")).select(F.col("item").alias("group_key"), F.col("shard").alias("_large")))
    packets = F.broadcast(table.where(F.col("item").startswith("packet ")).select(F.col("item").alias("_packet"), F.col("shard").alias("_small")))
    return (rows.join(large, "group_key", "left").withColumn("_packet", packet).join(packets, "_packet", "left")
            .select("doc_id", "size", "text_crc32", "group_key", F.coalesce("_large", "_small").alias("shard")))


def slots(rows: DataFrame, shard: str, order: list[Column], tie_key: Column, out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap and without one task per shard.

    Rows fall into buckets by the hash of ``tie_key``; a bucket is numbered by itself and starts after the rows of the earlier
    buckets of its shard. The offsets table has shards x buckets rows.
    """
    buckets = shuffle_width(rows.sparkSession)
    cut = rows.withColumn("_bucket", F.pmod(F.xxhash64(tie_key), F.lit(buckets)))
    earlier = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .select(shard, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")))
    here = Window.partitionBy(shard, "_bucket").orderBy(*order)
    return (cut.withColumn("_row", F.row_number().over(here)).join(F.broadcast(offsets), [shard, "_bucket"])
            .withColumn(out, (F.col("_row") - 1 + F.col("_offset")).cast("bigint")).drop("_bucket", "_row", "_offset"))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, grain: int = 512) -> DataFrame:
    """``assign`` with the law, the slot and the (here always NULL) shard under one more shard."""
    placed = durable(assign(docs, doc_id, text, shards, grain))
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size"), F.col("group_key")]
    tie = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("group_key"))
    return slots(placed, "shard", order, tie).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
