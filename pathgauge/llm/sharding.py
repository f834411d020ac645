"""Shards of near-equal bytes by longest-processing-time scheduling of groups of equal texts."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathgauge.llm.common import id_and_text, settle

#: A group that holds at least 1 / (shards * GRAIN) of all bytes is scheduled by itself.
GRAIN = 1024
#: Smaller groups are pooled by hash into this many items.
POOLS = 16384


def longest_first(sizes: dict, shards: int) -> dict:
    """Item -> shard: largest items first, each to the least-loaded shard (the lowest of equals)."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1; null and empty texts are equal.
    Rows of equal text stay together. Groups are scheduled longest first: one
    that is large against a shard as an item of its own (at most shards * GRAIN
    of them), the others pooled by hash (POOLS items). So at most 32,768 items
    for 16 shards reach the driver however many groups there are, and loads
    differ by no more than the smallest items, unless one group outweighs a
    shard. ``slot`` counts from 0 within a shard without gaps; rows are dealt into
    parts one by one to be counted, so however many are equal, no part has more
    than its share. ``grown_shard`` is null:
    the law is ``bytes``. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = settle(
        id_and_text(docs, id_col, text_col).select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("digest"),
        )
    ).withColumn("row", F.monotonically_increasing_id())  # fixed by the checkpoint
    groups = settle(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    pool = F.pmod(F.xxhash64("digest"), F.lit(POOLS)).cast("int")
    large = F.col("bytes") * (shards * GRAIN) >= F.lit(total)
    items = (
        groups.select(F.when(large, F.col("digest")).alias("digest"), F.when(~large, pool).alias("pool"), "bytes")
        .groupBy("digest", "pool")
        .agg(F.sum("bytes").alias("bytes"))
    )
    placed = longest_first({(r.digest or "", -1 if r.pool is None else r.pool): r.bytes for r in items.collect()}, shards)
    own = spark.createDataFrame([(d, s) for (d, _), s in placed.items() if d], "digest string, own_shard int")
    pooled = spark.createDataFrame([(p, s) for (d, p), s in placed.items() if not d], "pool int, pool_shard int")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        rows.join(F.broadcast(own), "digest", "left")
        .withColumn("pool", pool)
        .join(F.broadcast(pooled), "pool", "left")
        .withColumn("shard", F.coalesce("own_shard", "pool_shard"))
        .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
        .select("doc_id", "size", "text_crc32", "digest", "row", "shard", "part")
    )
    # A shard is numbered part by part; this table has at most shards * parts rows.
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        dealt.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    )
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "digest", "row")
    return (
        dealt.withColumn("at", F.row_number().over(within) - 1)
        .join(F.broadcast(first), ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("at")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
