"""SimHash near-dedup with pigeonring filtering."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sorrel.llm.common import documents, written
from sorrel.llm.components import connected_components

#: Segments of a fingerprint, clockwise from its lowest bits.
SEGMENTS, BITS = 8, 8
#: Buckets up to this size compare all their pairs; larger ones are searched from one fingerprint to the next; those above LARGE are split first.
SMALL, LARGE = 32, 4096


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes, signed; 0 if there are none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Bits that are set in over half the hashes of the text's shingles (repeats included), signed."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)
    return majority(hashes)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fingerprint (a signed 64-bit integer) of every document."""

    @F.pandas_udf("long")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in text], dtype="int64")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("fp"))


def chain_keys(radius: int) -> list[tuple[int, list[int]]]:
    """(start, segments that must be equal) of every way a chain may begin.

    With m segments on a ring and at most `radius` differing bits there is a start from which every chain of l segments has at most
    l * radius / m of them. The segments of a chain with a budget of 0 are equal; while the budget is 1, at most one of the further segments differs.
    """
    budgets = [length * radius // SEGMENTS for length in range(1, SEGMENTS + 1)]
    exact, more = budgets.count(0), budgets.count(1)
    if radius and not exact:
        raise ValueError(f"the radius must be below {SEGMENTS}")
    drops = range(exact, exact + more) if radius else [SEGMENTS]
    return [(s, [(s + j) % SEGMENTS for j in range(min(SEGMENTS, exact + more)) if j != d]) for s in range(SEGMENTS) for d in drops]


def _within(x: np.ndarray, start: np.ndarray | int, radius: int) -> np.ndarray:
    """Whether differences keep to the budget of each chain from `start` on, and so of the whole ring."""
    shift = np.asarray(start, np.uint64) * np.uint64(BITS)
    x = (x >> shift) | (x << ((np.uint64(64) - shift) & np.uint64(63)))
    ok = np.ones(x.shape, bool)
    for length in range(1, SEGMENTS):
        ok &= np.bitwise_count(x & np.uint64((1 << (length * BITS)) - 1)) <= length * radius // SEGMENTS
    return ok & (np.bitwise_count(x) <= radius)


def links(distinct: DataFrame, radius: int = 3, large: int = LARGE) -> DataFrame:
    """(a, b) of linked fingerprints: enough of them that fingerprints within `radius` of each other are connected.

    Every fingerprint goes to one bucket for each beginning of a chain (24 buckets of 32 equal bits at radius 3), buckets are sorted, and a stream over each
    partition checks the further chain budgets before the full distance. A bucket isn't expanded into all its pairs: in a large one, each fingerprint
    reached is compared with those not reached yet, and one link to its group's first fingerprint is returned. Only one bucket is held at a time. A bucket of more than `large` fingerprints is split by
    each of its other segments: they are more than the bits that may differ, so linked fingerprints agree in at least one of them and meet in that part.
    """
    keys = chain_keys(radius)

    def segment(i: int):
        return F.shiftrightunsigned("fp", BITS * i).bitwiseAND(F.lit((1 << BITS) - 1))

    def key(k: int, segments: list[int]):
        packed = F.lit(k).cast("long")
        for i in segments:
            packed = F.shiftleft(packed, BITS).bitwiseOR(segment(i))
        return packed

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = distinct.repartition(parts, F.xxhash64("fp"))  # a small table, but each row becomes many
    if max(len(segments) for _, segments in keys) * BITS > 56:
        spread = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.xxhash64(key(k, segments[:4]), key(k, segments[4:])).alias("key")) for k, (_, segments) in enumerate(keys)])).alias("x"))
    else:
        spread = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), key(k, segments).alias("key")) for k, (_, segments) in enumerate(keys)])).alias("x"))
    start_of = np.array([s for s, _ in keys], np.uint64)
    spread = spread.select("x.key", "x.k", "fp")
    hot = written(spread.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > large).select("key", F.lit(True).alias("hot")), "large-buckets")
    if SEGMENTS - len(keys[0][1]) > radius and not hot.isEmpty():
        others = [[i for i in range(SEGMENTS) if i not in segments] for _, segments in keys]
        split = F.get(F.array(*[F.array(*[F.xxhash64("key", F.lit(i), segment(i)) for i in free]) for free in others]), F.col("k"))
        spread = spread.join(hot, "key", "left").select(F.explode(F.when(F.col("hot"), split).otherwise(F.array("key"))).alias("key"), "k", "fp")
    spread = spread.repartition(parts, "key").sortWithinPartitions("key", "fp")

    def search(batches):
        rest = None
        for batch in batches:
            got = [batch.column(i).to_numpy() for i in range(3)]
            if rest is not None:
                got = [np.concatenate(x) for x in zip(rest, got, strict=True)]
            key, k, fp = got
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            rest = [x[done:].copy() for x in got]
            yield from bucketed(key[:done], k[:done], fp[:done])
        if rest is not None:
            yield from bucketed(*rest)

    def bucketed(key, k, fp):
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(at, len(key)))
        bits, in_small = fp.view(np.uint64), np.repeat(size <= SMALL, size)
        left = np.repeat(np.append(at[1:], len(key))[: len(at)], size) - np.arange(len(key))
        for d in range(1, SMALL):
            a = np.flatnonzero(in_small & (left > d))
            if not len(a):
                break
            a = a[_within(bits[a] ^ bits[a + d], start_of[k[a]], radius)]
            yield from linked(fp[a], fp[a + d])
        for s, n in zip(at[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            free, start = np.arange(s, s + n), int(start_of[k[s]])
            while len(free):
                root, front, free = free[0], free[:1], free[1:]
                while len(front) and len(free):
                    reached = np.zeros(len(free), bool)
                    for f in range(0, len(front), 64):
                        reached |= _within(bits[front[f : f + 64], None] ^ bits[None, free], start, radius).any(axis=0)
                    front, free = free[reached], free[~reached]
                    yield from linked(np.full(len(front), fp[root]), fp[front])

    def linked(a, b):
        if len(a):
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return spread.mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id: the smallest doc_id reachable over fingerprints within `radius` bits.

    Texts are lower-cased (A-Z), split into words `[^\\x20\\x09-\\x0D]+` and hashed in shingles of words joined by a space; a text of fewer words is one shingle. Equal fingerprints
    are one node, however many documents share it. Null and empty texts have fingerprint 0, linked like any other. A null doc_id names no
    component: one of only null ids has a null component_id. Repeated rows each have their row. An empty table gives an empty result. Other columns are ignored.
    """
    fp = written(fingerprints(docs, shingle), "fingerprints")
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(distinct.select("fp"), radius))
    tied = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # a written table, so that the join with a large component isn't bound to the aggregate's partitions and may be split
    component = written(tied.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    of_fp = tied.select("fp", "root").join(component, "root").select("fp", "component_id")
    return fp.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash_pigeonring(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
