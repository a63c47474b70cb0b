"""Near copies by exact Jaccard similarity of word shingles: SimHash links first, then bands of minimum hashes for the pairs that its index can't reach."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sorrel.llm.common import NO_ID, forget, slices, strings, written
from sorrel.llm.components import connected_components
from sorrel.llm.simhash import links, majority
from sorrel.llm.words import mixed, whole, windows, word_hashes

#: Differing bits of the 64-bit SimHash of a shingle set up to which pairs are found by its index. A pair of 0.95 differs in some 5 bits, one of 0.8 in some 10, and up to 20, which no index of 64 bits tells from chance.
RADIUS = 3
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 7) ** 32, about 0.0005; one of 0.5 shares one with probability 0.22.
BANDS, ROWS = 32, 7
#: Pairs whose minimum hashes agree in fewer than their expected share less this aren't compared exactly: four standard deviations of 224 hashes at 0.8, so one pair of 0.8 in 30,000 is lost to it, far fewer than to the bands.
MARGIN = 0.107
#: Nodes of a bucket whose minimum hashes a task holds at a time.
CHUNK = 2048
#: Bits of the filter of nodes whose sets are wanted: 8 MB at any number of nodes. Where it fills up it lets more sets pass, which are dropped after.
FILTER_BITS = 1 << 26
#: Rounds in which the texts of a bucket are compared with one of them, before all that are still apart are compared with each other.
STARS = 2
_SEEDS = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(2, BANDS, ROWS)
_SEEDS[1] |= np.uint64(1)


def shingle_sets(words: np.ndarray, counts: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words has none."""
    hashes, first = windows(words, shingle), np.cumsum(counts) - counts
    out = []
    for at, n in zip(first.tolist(), counts.tolist(), strict=True):
        out.append(np.unique(hashes[at : at + n - shingle + 1] if n >= shingle else windows(words[at : at + n], n) if n else words[:0]))
    return out


def bands(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text, band) keys of sets that aren't empty, each a hash of the band's number and its minimum hashes; and (text, hash) the last byte of every minimum hash."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    values = np.concatenate(sets)
    out, last = np.empty((len(sets), BANDS), np.uint64), np.empty((len(sets), BANDS * ROWS), np.uint8)
    for b in range(BANDS):
        key = np.full(len(sets), b, np.uint64)
        for r in range(ROWS):
            low = np.minimum.reduceat((values ^ _SEEDS[0, b, r]) * _SEEDS[1, b, r], starts)
            last[:, b * ROWS + r] = mixed(low).astype(np.uint8)
            key = mixed(key ^ low)
        out[:, b] = key
    return out, last


def _listed(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))


def _shingled(docs: DataFrame, shingle: int, with_sets: bool, passing: np.ndarray | None = None) -> DataFrame:
    """doc_id, node (a hash of the text's shingle set), its values (the set itself, or the keys of its bands), the set's size, and, with the keys, the last bytes of its minimum hashes and its SimHash. `passing`: only rows whose node may be in the filter."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    names = ["doc_id", "node", "values", "size", "last", "fp"]

    def of(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int64)
            for a, b in slices(lengths, 500_000):
                sets = shingle_sets(*word_hashes(texts.slice(a, b - a)), shingle)
                node = pa.array(np.array([xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64))
                values, last = sets, [None] * len(sets)
                if not with_sets and any(len(s) for s in sets):
                    keys, bytes_ = map(iter, bands([s for s in sets if len(s)]))
                    values = [next(keys) if len(s) else s for s in sets]
                    last = [next(bytes_).tobytes() if len(s) else None for s in sets]
                if passing is not None:
                    place = node.to_numpy() & (FILTER_BITS - 1)
                    chosen = np.flatnonzero((passing[place >> 6] >> (place & 63)) & 1)
                    yield pa.record_batch([batch.column(0).slice(a, b - a).take(pa.array(chosen)), node.take(pa.array(chosen)), _listed([sets[i] for i in chosen]), pa.array([len(sets[i]) for i in chosen], pa.int32()), pa.nulls(len(chosen), pa.binary()), pa.nulls(len(chosen), pa.int64())], names)
                    continue
                fp = pa.nulls(len(sets), pa.int64()) if with_sets else pa.array([majority(s) for s in sets], pa.int64())
                yield pa.record_batch([batch.column(0).slice(a, b - a), node, _listed(values), pa.array([len(s) for s in sets], pa.int32()), pa.array(last, pa.binary()), fp], names)

    return rows.mapInArrow(of, "doc_id long, node long, values array<long>, size int, last binary, fp long")


def _alike(a: str, b: str, threshold: float):
    """Sets of the similarity `threshold` or more differ in size by no more than that share."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def _agreement(threshold: float) -> int:
    """How many minimum hashes of a pair of that similarity agree at least; two bytes also agree by chance."""
    return int(BANDS * ROWS * (threshold - MARGIN))


def simhash_pairs(nodes: DataFrame, threshold: float, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of nodes (node, size, fp) to compare exactly: of each fingerprint, its first node with its others, and with the first node of the smallest fingerprint that SimHash links it to.

    At most one pair for each node and one for each fingerprint, however large a group of near copies is.
    """
    nodes = nodes.where("size > 0")
    firsts = written(nodes.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("x")).select("fp", "x.node", "x.size"), "fingerprints")
    linked = links(firsts.select("fp"), radius).select(F.greatest("a", "b").alias("fp"), F.least("a", "b").alias("to")).where("fp != to").groupBy("fp").agg(F.min("to").alias("to"))
    own = firsts.select("fp", F.col("node").alias("a"), F.col("size").alias("x"))
    same = nodes.select("fp", F.col("node").alias("b"), F.col("size").alias("y")).join(own, "fp").where("a != b")
    near = linked.join(firsts.select("fp", F.col("node").alias("b"), F.col("size").alias("y")), "fp").join(own.withColumnRenamed("fp", "to"), "to")
    return same.select("a", "b", "x", "y").unionByName(near.select("a", "b", "x", "y")).where(_alike("x", "y", threshold)).select("a", "b")


def _tied(roots: DataFrame, found: DataFrame) -> DataFrame:
    """`roots` (node, root) after more pairs (a, b): a component that is known comes in as its star, not with all pairs that made it, so only what is new takes rounds."""
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))


def _apart(now: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets (key, band, node, least, size) with their nodes' roots; a bucket that is one component is done."""
    now = now.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return written(now.join(left, "key"), "apart")


def _likely(pairs: DataFrame, lasts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose minimum hashes agree often enough for the threshold: the bytes of both travel, not the sets."""

    def of(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for c in ("x", "y"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= _agreement(threshold)))

    both = pairs.join(lasts.select(F.col("node").alias("a"), F.col("last").alias("x")), "a").join(lasts.select(F.col("node").alias("b"), F.col("last").alias("y")), "b")
    return both.mapInArrow(of, "a long, b long")


def _likely_in_buckets(apart: DataFrame, lasts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of different roots that share a bucket, may have the similarity by their sizes, and agree in their minimum hashes as in `_likely`.

    A bucket's nodes are dealt to chunks that a task holds one at a time as a matrix of bytes; every node of the bucket passes by each chunk. Only pairs that agree leave a task, once each: from the bucket of the first band that they share. (If that bucket has been dropped, or one of them has left it as its centre,
    they are connected already or have been compared.)
    """
    counts = apart.groupBy("key").agg(F.count("*").alias("n")).select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    rows = apart.select("key", "band", "node", "root", "size").join(lasts, "node").join(counts, "key")
    home = rows.withColumns({"chunk": F.pmod(F.xxhash64("node", F.lit(3)), F.col("chunks")).cast("int"), "role": F.lit(0)})
    visit = rows.withColumns({"chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "role": F.lit(1)})
    tasks = int(apart.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = home.unionByName(visit).repartition(tasks, "key", "chunk").sortWithinPartitions("key", "chunk", "role")

    def of(batches):
        now, held = None, []
        for batch in batches:
            if not len(batch):
                continue
            key, chunk, role, node, root, size, band = (batch.column(c).to_numpy() for c in ("key", "chunk", "role", "node", "root", "size", "band"))
            last = np.frombuffer(b"".join(batch.column("last").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(chunk) != 0) | (np.diff(role) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if (key[a], chunk[a]) != now:
                    now, held = (key[a], chunk[a]), []
                if role[a] == 0:
                    held.append((node[a:b], root[a:b], size[a:b], last[a:b]))
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held = [tuple(np.concatenate(x) for x in zip(*held, strict=True))]
                nodes, roots, sizes, lasts_ = held[0]
                for i in range(a, b):
                    ok = np.flatnonzero((nodes < node[i]) & (roots != root[i]) & (np.minimum(sizes, size[i]) >= threshold * np.maximum(sizes, size[i])))
                    same = lasts_[ok] == last[i]
                    near = same.sum(axis=1) >= _agreement(threshold)
                    # a pair is looked at in the first band that it shares
                    first = same[near].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[i]
                    ok = ok[near][first]
                    if len(ok):
                        yield pa.record_batch([pa.array(nodes[ok]), pa.array(np.full(len(ok), node[i]))], ["a", "b"])

    return dealt.mapInArrow(of, "a long, b long")


def _filter(nodes: DataFrame) -> np.ndarray:
    """A bit for each node, by its last bits: words of 64 bits are put together by Spark, so what reaches the driver is bounded by the filter's size."""
    at = F.pmod("node", F.lit(FILTER_BITS))
    bits = nodes.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for batch in bits.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The (a, b) whose sets have the Jaccard similarity `threshold` or more. Sets are made again from the texts, and only those of the pairs' nodes are sent."""
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    sets = _shingled(docs, shingle, True, _filter(wanted)).select("node", "values").groupBy("node").agg(F.first("values").alias("values"))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("values").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("values").alias("y")), "b")
    sizes = both.select("a", "b", (F.size("x") + F.size("y")).alias("all"), F.size(F.array_intersect("x", "y")).alias("shared"))
    found = written(sizes.where(F.col("shared") / (F.col("all") - F.col("shared")) >= threshold).select("a", "b"), "found")
    forget(pairs)
    return found


def near_copies(docs: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id and component_id: the smallest doc_id reachable over texts whose sets of word shingles have the Jaccard similarity `threshold` or more.

    Equal sets are one node, however many documents share it. Nodes whose SimHashes are linked by the pigeonring index (`simhash.links`) are compared first; what this connects isn't compared again. SimHash alone loses most pairs of
    0.8 to 0.9, so nodes that share one of 32 bands of 7 minimum hashes are candidates, too. In each of a few rounds the nodes of a bucket that aren't connected with its centre are
    compared with it: its node with the smallest doc_id, which copies mostly come from, then that of the nodes apart from it, and so on. Those of a bucket that are still apart after these are all compared by their
    minimum hashes within tasks, so a large group of near copies isn't expanded into rows of pairs. Sets travel only for pairs whose minimum hashes agree; the similarity itself is exact. That a pair shares a band, and that its hashes agree, is likely, not certain.

    Texts are lower-cased and split into words `[^\\x20\\x09-\\x0D]+`. Null and empty texts have the empty set, and are copies of each other. A null doc_id names no component: one of only null
    ids has a null component_id. Repeated rows each have their row. An empty table gives an empty result. Other columns are ignored.
    """
    sketched = written(_shingled(docs, shingle, False), "sketches")
    nodes = sketched.groupBy("node").agg(F.first("values").alias("values"), F.first("size").alias("size"), F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("least"))
    bytes_ = sketched.select("node", "last").where("last is not null")
    keys = written(nodes.select("node", "least", "size", F.posexplode("values").alias("band", "key")), "band-keys")
    several = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = written(keys.join(several, "key"), "shared-bands")
    forget(keys)
    wanted = shared.select("node").distinct()
    lasts = written(bytes_.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "minimum-hashes")
    roots = connected_components(_confirmed(simhash_pairs(sketched.select("node", "size", "fp").dropDuplicates(["node"]), threshold), docs, shingle, threshold))
    apart, old = _apart(shared, roots), [shared]
    for _ in range(STARS):
        centre = apart.groupBy("key").agg(F.min(F.struct("least", "node", "root", "size")).alias("c")).select("key", F.col("c.node").alias("a"), F.col("c.root").alias("centre_root"), F.col("c.size").alias("centre_size"))
        pairs = apart.join(centre, "key").where("node != a and root != centre_root").where(_alike("size", "centre_size", threshold)).select("a", F.col("node").alias("b")).distinct()
        roots = _tied(roots, _confirmed(_likely(pairs, lasts, threshold), docs, shingle, threshold))
        # a bucket's centre has been compared with all of it
        rest = apart.join(centre.select("key", "a"), "key").where("node != a").drop("a", "root")
        done, apart = apart, _apart(rest, roots)
        forget(*old)
        old = [done]
    roots = _tied(roots, _confirmed(_likely_in_buckets(apart, lasts, threshold), docs, shingle, threshold))
    forget(lasts, apart, *old)
    least = sketched.groupBy("node").agg(F.min("doc_id").alias("least"))
    tied = written(least.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "tied")
    component = written(tied.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    return sketched.select("doc_id", "node").join(tied.join(component, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
