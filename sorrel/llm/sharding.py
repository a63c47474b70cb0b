"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import shared_dir

_MASK = (1 << 64) - 1


def _mixed(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def ring(n_shards: int, n_virtual: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; a shard's nodes don't depend on how many other shards there are."""
    return sorted((_mixed(_mixed(s) ^ v) - (1 << 63), s) for s in range(n_shards) for v in range(n_virtual))


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    """Row limits of the shards. Without slack they add up to `total` and differ by one at most, so every shard fills exactly."""
    if slack:
        return [-(-int(total * (1 + slack)) // n_shards) + 1] * n_shards
    return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]


def fill(nodes: list[tuple[int, int]], counts: dict[int, int], limits: list[int]) -> list[tuple[int, int, int, int]]:
    """(first rank, past the last rank, shard, first slot): keys in ring order take the next shard clockwise that has room.

    `counts` has the number of keys of each arc. The keys between two nodes are alike to the ring, so whole runs of them move;
    there are as many runs as nodes, and one more each time a shard fills up in the middle of an arc.
    """
    runs, left, rank = [], list(limits), 0
    for arc in range(len(nodes) + 1):
        todo, node = counts.get(arc, 0), arc
        while todo:
            shard = nodes[node % len(nodes)][1]
            if taken := min(todo, left[shard]):
                runs.append((rank, rank + taken, shard, limits[shard] - left[shard]))
                left[shard] -= taken
                rank += taken
                todo -= taken
            node += 1
    return runs


def shard_documents(docs: DataFrame, n_shards: int = 8, n_virtual: int = 128, slack: float = 0.0) -> DataFrame:
    """Deal documents to shards; returns doc_id, size, text_crc32, shard and slot.

    A document's place on the ring is a hash of its doc_id. It belongs to the next virtual node clockwise; if that node's
    shard is full, it goes on clockwise to the first shard with room. `slack` widens the limit of a shard's rows
    over the mean; at 0 row counts differ by one at most. slot numbers a shard's rows from 0 without gaps.

    Two passes over narrow rows (no texts): rows are sorted by ring position in range partitions, partition counts give global ranks
    by prefix sums, and one count for each of the ring's arcs (a fixed number) settles on the driver which ranks go where.

    Null texts have size 1 and checksum 0. Null ids share one place on the ring. Rows that repeat get slots of their own.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1).cast("long")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(F.col("doc_id").cast("long")).alias("place"))
    order = ["place", "doc_id", "text_crc32", "size"]
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).checkpoint()

    nodes = ring(n_shards, n_virtual)
    places = np.array([p for p, _ in nodes], np.int64)

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, place.to_numpy(), side="left").astype("int32"))

    row = F.monotonically_increasing_id()
    rows = rows.withColumn("row", row).select("*", F.shiftright("row", 33).alias("part"), F.col("row").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    counted = rows.groupBy("part", arc_of("place").alias("arc")).count().groupBy("part", "arc").agg(F.sum("count").alias("n"))
    arcs: dict[int, int] = {}
    parts: dict[int, int] = {}
    # at most partitions + arcs rows, as both are in order: each arc spans neighbouring partitions
    for r in counted.toLocalIterator():
        arcs[r.arc] = arcs.get(r.arc, 0) + r.n
        parts[r.part] = parts.get(r.part, 0) + r.n
    bases, total = {}, 0
    for p in sorted(parts):
        bases[p] = total
        total += parts[p]
    runs = fill(nodes, arcs, capacities(total, n_shards, slack))
    starts, shards, slots = (np.array([r[i] for r in runs], np.int64) for i in (0, 2, 3))
    base_of = np.zeros(max(bases, default=0) + 1, np.int64)
    for p, b in bases.items():
        base_of[p] = b

    @F.pandas_udf("struct<shard int, slot long>")
    def dealt(part: pd.Series, at: pd.Series) -> pd.DataFrame:
        rank = base_of[part.to_numpy()] + at.to_numpy()
        run = np.searchsorted(starts, rank, side="right") - 1
        return pd.DataFrame({"shard": shards[run].astype("int32"), "slot": slots[run] + rank - starts[run]})

    return rows.withColumn("to", dealt("part", "at")).select("doc_id", "size", "text_crc32", "to.shard", "to.slot")


def place_of(doc_place: int, nodes: list[tuple[int, int]]) -> int:
    """The shard that a place belongs to before any limit."""
    return nodes[bisect_left(nodes, (doc_place, -1)) % len(nodes)][1]


def op9_consistent_hash_shards(spark, sf_dir: str) -> DataFrame:
    from sorrel.llm.common import documents

    out = shard_documents(documents(spark, sf_dir), n_shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
