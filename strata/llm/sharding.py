"""Sharding by longest processing time: groups that stay together, the largest first,
each to the least-loaded shard through a heap.

A group is all documents of one text.  The heap schedules at most ``2 * shards * fine``
items, whatever the data: groups larger than ``total / (shards * fine)`` bytes one by one
(there are fewer than ``shards * fine`` of them), and all smaller groups in as many hash
bundles.  Shards end up within about one bundle of each other, unless one group alone is
larger than a shard's share.

Defined results: a NULL text is an empty one; copies share a shard; rows that repeat a
document each take a slot; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty
from strata.session import settle, work_path

SHARDS, FINE, OVERHEAD = 40, 250, 16
CELL_ROWS = 50_000  # rows that one window numbers, on average


def longest_first(items: list[tuple[int, object]], shards: int) -> list[tuple[object, int]]:
    """(key, shard) of (bytes, key) items, the largest first; ties by key."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out.append((key, shard))
    return out


def assigned(docs: DataFrame, shards: int = SHARDS, fine: int = FINE) -> DataFrame:
    """doc_id, size, text_crc32, group digest and shard of every row."""
    spark = docs.sparkSession
    text = text_or_empty()
    data = text.cast("binary")
    items = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.md5(data).alias("digest"),
    )
    items = settle(items, work_path(spark, "shard-items"))
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * fine)).cast("int")
    groups = items.groupBy("digest").agg(F.sum("size").alias("bytes"))
    total = items.agg(F.sum("size")).first()[0] or 0
    own = F.col("bytes") > total // (shards * fine)
    sums = (
        groups.select(F.when(own, F.col("digest")).alias("alone"), F.when(~own, bundle).alias("bundle"), "bytes")
        .groupBy("alone", "bundle")
        .agg(F.sum("bytes").alias("bytes"))
    )
    to_place = [(r["bytes"], (r["alone"] or "", -1 if r["bundle"] is None else r["bundle"])) for r in sums.collect()]
    plan = longest_first(to_place, shards)
    alone = spark.createDataFrame([(k[0], s) for k, s in plan if k[0]], "digest string, alone int")
    bundles = spark.createDataFrame([(k[1], s) for k, s in plan if not k[0]], "bundle int, bundled int")
    # Both plans have at most shards * fine rows.
    return (
        items.withColumn("bundle", bundle)
        .join(F.broadcast(alone), "digest", "left")
        .join(F.broadcast(bundles), "bundle", "left")
        .select("doc_id", "size", "text_crc32", "digest", F.coalesce("alone", "bundled").alias("shard"))
    )


def sharded(docs: DataFrame, shards: int = SHARDS, fine: int = FINE) -> DataFrame:
    """``assigned`` rows with ``slot``, gapless from 0 in each shard.

    Rows are numbered inside cells of a shard, and a cell starts after the rows of the
    cells before it; no window covers a shard.
    """
    placed = settle(assigned(docs, shards, fine), work_path(docs.sparkSession, "shard-rows"))
    cells = 1 + placed.count() // (shards * CELL_ROWS)
    rows = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(cells)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    at = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "digest"))
    return rows.withColumn("at", at).join(starts, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "digest", "shard", (F.col("start") + F.col("at") - 1).alias("slot")
    )
