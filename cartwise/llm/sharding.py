"""Sharding by best-fit-decreasing bin packing of indivisible groups (equal texts).

A row's size is its text's UTF-8 bytes plus ``ROW_BYTES``. Groups sorted by size
(largest first) enter the bin with the tightest remaining capacity that holds
them, found in a balanced tree of bins by remaining capacity; if none does, a
new bin opens. For a given number of shards the capacity is the smallest (in
steps of ``STEP``) that needs no more bins, so sizes come out nearly equal: the
law is ``bytes``. A group larger than an equal share gets a shard of its own.

Scale. Only groups of over 1 / (shards * ``FINE``) of all bytes are packed by
themselves (there are at most shards * ``FINE``); the others are bundled by a hash
of their text into shards * ``BUNDLES`` bundles, packed like groups, so what is
packed on the driver and broadcast has a fixed bound and a group is never
divided. Group sizes are sums with partial aggregation. Slots are counted from
a range partitioning by (shard, text digest, doc_id): a large group spans many
tasks, and only row counts per task and shard are added up.

Defined results: null text has size ``ROW_BYTES``, crc 0, and is grouped with the
empty text; repeated rows get slots of their own; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.llm.common import Scratch, shuffle_parts, table

SHARDS = 24
ROW_BYTES = 8
FINE = 1000
BUNDLES = 256
STEP = 0.0005


class CapacityTree:
    """A treap of (remaining capacity, bin): insert, and take out the tightest bin that holds a size."""

    def __init__(self) -> None:
        self.root = None
        self.rng = np.random.default_rng(3)

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[0] > b[0]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[1] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def insert(self, remaining: int, number: int) -> None:
        left, right = self._split(self.root, (remaining, number))
        node = [self.rng.random(), (remaining, number), None, None]
        self.root = self._merge(self._merge(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        parent, node = None, right
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            right = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(left, right)
        return node[1]


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size (given largest first); every size must fit a bin."""
    tree, bins, out = CapacityTree(), 0, []
    for size in sizes:
        held = tree.take(size)
        if held is None:
            if size > capacity:
                raise ValueError("a group exceeds the capacity")
            held, bins = (capacity, bins), bins + 1
        out.append(held[1])
        tree.insert(held[0] - size, held[1])
    return out


def pack(sizes: list[int], shards: int) -> list[int]:
    """Bins 0 .. shards - 1 of nearly equal content; sizes are given largest first."""
    alone, total = 0, sum(sizes)
    while alone < shards - 1 and alone < len(sizes) and sizes[alone] * (shards - alone) > total:
        total -= sizes[alone]
        alone += 1
    rest, left = sizes[alone:], shards - alone
    if not rest:
        return list(range(alone))
    least = max(-(-total // left), rest[0])
    tries = 0
    while True:
        bins = best_fit_decreasing(rest, math.ceil(least * (1 + STEP * tries)))
        if max(bins) < left:
            return [*range(alone), *(alone + b for b in bins)]
        tries = tries + 1 if tries < 20 else tries * 2


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"))
    rows = scratch.write(rows.select("doc_id", (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
                                     F.crc32("text").alias("text_crc32"), F.md5("text").alias("digest")), "rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = F.col("bytes") * (shards * FINE) > total
    bundle = F.pmod(F.xxhash64("digest"), F.lit(shards * BUNDLES))
    item = F.when(large, F.col("digest")).otherwise(bundle.cast("string"))
    # at most shards * (FINE + BUNDLES) items: a fixed bound for the driver and the broadcast
    items = groups.groupBy(item.alias("item")).agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), "item").collect()
    bins = pack([r.bytes for r in items], shards)
    placed = spark.createDataFrame([(r.item, b) for r, b in zip(items, bins, strict=True)], "item string, shard int")
    alone = placed.where(F.length("item") == 32).withColumnRenamed("item", "digest")
    bundled = placed.where(F.length("item") < 32).select(F.col("item").alias("bundle"), F.col("shard").alias("bundle_shard"))
    dealt = (rows.join(F.broadcast(alone), "digest", "left").withColumn("bundle", bundle.cast("string"))
             .join(F.broadcast(bundled), "bundle", "left").withColumn("shard", F.coalesce("shard", "bundle_shard")))
    return number_slots(dealt.select("doc_id", "size", "text_crc32", "digest", "shard"), scratch)


def number_slots(dealt: DataFrame, scratch: Scratch) -> DataFrame:
    order = ["shard", "digest", "doc_id"]
    parts = shuffle_parts(dealt.sparkSession)
    ranged = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    placed = scratch.write(ranged.withColumn("at", at), "placed")
    task = F.shiftright("at", 33)
    counts = placed.groupBy(task.alias("task"), "shard").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task and shard: tasks are ranges of shards, so at most tasks + shards rows
    offsets = counts.select(F.col("task"), F.col("shard"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("begin")).alias("shift"))
    numbered = placed.withColumn("task", task).join(F.broadcast(offsets), ["task", "shard"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") + F.col("shift")).alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
