"""Near copies among vectors: an exact range join in which pivots cut the vectors into cells, and cells join independently."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import forget, written
from sorrel.llm.components import connected_components

#: A cell aims at so many vectors; pivots are limited in number and in bytes, since every task gets them all. Cells that are larger for that are cut into chunks.
CELL, MOST_PIVOTS, PIVOT_BYTES = 2048, 2048, 16 << 20
#: Vectors of a cell that a task holds at a time, in bytes; those that visit it stream by.
CHUNK_BYTES = 2 << 20
#: Distances and cosines carry an error below this; pairs so near the threshold are computed again without matrix products.
SLACK = 1e-9
_CELL = ["label", "dim", "pivot", "ring"]


def _valid(vector):
    """Vectors that have a direction: not null, no null or non-finite component, not zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Vectors of length 1. Dividing by the largest component first keeps squares within range."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    return unit(values[starts[rows][:, None] + np.arange(dim)].astype(np.float64))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _by_group(batch: pa.RecordBatch):
    """Rows of the batch by label and dimension."""
    labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_numpy()
    groups: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(labels, dims.tolist(), strict=True)):
        groups.setdefault(key, []).append(i)
    return {k: np.array(v) for k, v in groups.items()}


def _homes(nodes: DataFrame, pivots: dict[tuple, np.ndarray], eps: float) -> DataFrame:
    """Each vector's home: the nearest pivot of its label and dimension (-1: there is none), and the ring of the distance to it."""

    def of(batches):
        for batch in batches:
            pivot, ring = np.full(len(batch), -1, np.int32), np.zeros(len(batch), np.int32)
            for key, rows in _by_group(batch).items():
                if key in pivots:
                    d = _distances(_matrix(batch.column("embedding"), rows, key[1]), pivots[key])
                    pivot[rows] = d.argmin(axis=1)
                    ring[rows] = d.min(axis=1) // eps
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(ring)], [*batch.schema.names, "pivot", "ring"])

    kind = dict(nodes.dtypes)["embedding"]
    return nodes.mapInArrow(of, f"node long, label string, dim int, copies long, embedding {kind}, pivot int, ring int")


def _visits(homes: DataFrame, pivots: dict[tuple, np.ndarray], eps: float) -> DataFrame:
    """Each vector with every cell and ring that may hold a partner of it.

    A partner y at home with pivot q lies within eps. It is nearer to q than to the vector's own pivot p, so the vector is at most eps beyond the plane midway between p and q; and by the triangle inequality
    its distance to q differs from y's by at most eps, which leaves three rings.
    """

    def of(batches):
        for batch in batches:
            row, pivot, ring = [], [], []
            for key, rows in _by_group(batch).items():
                if key not in pivots:
                    row.append(rows)
                    pivot.append(np.full(len(rows), -1))
                    ring.append(np.zeros(len(rows)))
                    continue
                centres = pivots[key]
                d = _distances(_matrix(batch.column("embedding"), rows, key[1]), centres)
                own = d.argmin(axis=1)
                apart = np.maximum(_distances(centres, centres)[own], 1e-300)
                at, to = np.nonzero((d * d - d.min(axis=1, keepdims=True) ** 2) / (2 * apart) <= eps + SLACK)
                near, far = np.maximum(d[at, to] - eps - SLACK, 0) // eps, (d[at, to] + eps + SLACK) // eps
                for step in range(4):
                    some = near + step <= far
                    row.append(rows[at[some]])
                    pivot.append(to[some])
                    ring.append(near[some] + step)
            if row:
                at = pa.array(np.concatenate(row))
                out = [batch.column(n).take(at) for n in ("node", "label", "dim", "copies", "embedding")]
                yield pa.RecordBatch.from_arrays([*out, pa.array(np.concatenate(pivot).astype(np.int32)), pa.array(np.concatenate(ring).astype(np.int32))], ["node", "label", "dim", "copies", "embedding", "pivot", "ring"])

    return homes.mapInArrow(of, homes.schema)


class _Chunk:
    """The vectors of one chunk of a cell, against which others are compared as they come."""

    def __init__(self, threshold: float):
        self.threshold, self.nodes, self.rows = threshold, np.zeros(0, np.int64), None

    def add(self, nodes, rows) -> None:
        self.nodes = np.concatenate([self.nodes, nodes])
        self.rows = rows if self.rows is None else np.concatenate([self.rows, rows])
        self.links, self.root = np.zeros(len(self.nodes), np.int64), np.arange(len(self.nodes))

    def meet(self, nodes, copies, rows) -> list[tuple[int, int]]:
        """Count the visitors linked with each vector; returns one edge for each visitor that has a link."""
        cos = rows @ self.rows.T
        for i, j in zip(*np.nonzero(np.abs(cos - self.threshold) < SLACK), strict=True):
            cos[i, j] = math.fsum(rows[i] * self.rows[j])
        linked = cos >= self.threshold
        linked |= nodes[:, None] == self.nodes
        self.links += copies @ linked
        some = np.flatnonzero(linked.any(axis=1))
        linked = linked[some]
        low = np.where(linked, self.root, len(self.nodes)).min(axis=1)
        high = np.where(linked, self.root, -1).max(axis=1)
        for i in np.flatnonzero(low < high):  # at most one merge for each vector of the chunk changes anything
            roots = np.unique(self.root[linked[i]])
            if len(roots) > 1:
                self.root[np.isin(self.root, roots)] = roots[0]
        first = linked.argmax(axis=1)
        edges = np.stack([nodes[some], self.nodes[first]], axis=1)
        return edges[edges[:, 0] != edges[:, 1]]

    def end(self):
        """(vector, links with itself and others), and edges from each vector to the first of its group."""
        tied = np.flatnonzero(self.root != np.arange(len(self.nodes)))
        return (self.nodes, self.links), np.stack([self.nodes[tied], self.nodes[self.root[tied]]], axis=1)


def _compared(dealt: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, null, links) and (node, other, null) of chunks that are sorted by cell and chunk, those at home first."""

    def batch_of(nodes, links=None, others=None):
        null = pa.nulls(len(nodes), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), null if others is None else pa.array(others, pa.int64()), null if links is None else pa.array(links, pa.int64())], ["a", "b", "n"])

    def ended(chunk):
        if chunk is not None and chunk.rows is not None:
            (own, links), edges = chunk.end()
            yield batch_of(own, links=links)
            yield batch_of(edges[:, 0], others=edges[:, 1])

    def of(batches):
        now, chunk = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*_CELL, "chunk")), strict=True))
            roles, nodes, copies = batch.column("role").to_numpy(), batch.column("node").to_numpy(), batch.column("copies").to_numpy()
            at = 0
            while at < len(keys):
                to = at
                while to < len(keys) and keys[to] == keys[at] and roles[to] == roles[at]:
                    to += 1
                if keys[at] != now:
                    yield from ended(chunk)
                    now, chunk = keys[at], _Chunk(threshold)
                for a in range(at, to, 2048):
                    b = min(a + 2048, to)
                    rows = _matrix(batch.column("embedding"), np.arange(a, b), keys[at][1])
                    if roles[at] == 0:
                        chunk.add(nodes[a:b], rows)
                    elif chunk.rows is not None:
                        edges = chunk.meet(nodes[a:b], copies[a:b], rows)
                        yield batch_of(edges[:, 0], others=edges[:, 1])
                at = to
        yield from ended(chunk)

    return dealt.mapInArrow(of, "a long, b long, n long")


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """All columns of `vectors` (vec_id, embedding, label) with n_links, component_id and kept: links are pairs of the same label whose cosine is `threshold` (above 0) or more.

    Equal vectors of a label are one node, however many rows share it. A bounded sample of the nodes are pivots; every node is at home with the nearest pivot of its label, in the ring of its distance to it.
    It also visits each cell and ring that may hold a partner (see `_visits`), so a cell needs no other: each ordered pair meets once, where the second is at home. Cells are cut into chunks that fit
    in memory and visitors stream by, in matrix products. Only counts and edges of a spanning forest leave a task, so groups of near copies aren't expanded into pairs.
    In many dimensions, vectors far from each other are pruned by neither rule: then all of one label are compared, which is what such data take.

    Links need equal labels that aren't null and equal dimensions. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. A null vec_id counts as a vector, but names no
    component: one of only null ids has a null component_id. Repeated rows are vectors of their own, linked with each other. Columns that bear a name of the result's are replaced. An empty table gives an empty result.
    """
    eps = math.sqrt(2 - 2 * threshold)
    own = [c for c in vectors.columns if c not in ("n_links", "component_id", "kept")]
    rows = vectors.select(F.struct(*own).alias("row"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("embedding"))
    rows = rows.withColumn("valid", F.col("label").isNotNull() & _valid(F.col("embedding")))
    found = rows.where("valid").groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = written(found.select(F.monotonically_increasing_id().alias("node"), "label", F.size("embedding").alias("dim"), "copies", "embedding", "least"), "vectors")
    n, widest = nodes.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    pivots: dict[tuple, list] = {}
    for r in nodes.orderBy(F.xxhash64("embedding"), "node").limit(min(n // CELL, MOST_PIVOTS, PIVOT_BYTES // (8 * widest))).collect():
        pivots.setdefault((r.label, r.dim), []).append(r.embedding)
    centres = {k: unit(np.array(v, np.float64)) for k, v in pivots.items()}

    homes = written(_homes(nodes.drop("least"), centres, eps), "homes")
    cells = homes.groupBy(*_CELL).agg(F.count("*").alias("n")).select(*_CELL, F.ceil(F.col("n") * F.col("dim") * 8 / CHUNK_BYTES).cast("int").alias("chunks"))
    cells = written(cells, "cells")
    some = ["node", "copies", "embedding", *_CELL]
    at_home = homes.join(cells, _CELL).select(*some, F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("role"))
    visiting = _visits(homes, centres, eps).join(cells, _CELL).select(*some, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("role"))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = at_home.unionByName(visiting).repartition(tasks, *_CELL, "chunk").sortWithinPartitions(*_CELL, "chunk", "role")
    met = written(_compared(dealt, threshold), "links")
    links = met.where("n is not null").select(F.col("a").alias("node"), (F.col("n") - 1).alias("links"))
    roots = connected_components(met.where("b is not null").select("a", "b"))
    tied = written(nodes.join(links, "node").join(roots, "node", "left").select("label", "embedding", "links", "least", F.coalesce("root", "node").alias("root")), "tied")
    component = written(tied.groupBy("root").agg(F.min("least").alias("component")), "components")
    result = written(tied.join(component, "root").select(F.col("label").alias("l"), F.col("embedding").alias("e"), "links", "component"), "nodes")
    forget(homes, cells, met)
    joined = rows.join(result, F.col("valid") & (F.col("label") == F.col("l")) & (F.xxhash64("embedding") == F.xxhash64("e")) & (F.col("embedding") == F.col("e")), "left")
    component_id = F.when(F.col("valid"), F.col("component")).otherwise(F.col("id"))
    return joined.select(*[F.col("row").getField(c).alias(c) for c in own], F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"), component_id.eqNullSafe(F.col("id")).alias("kept"))


def op11_embedding_range_join(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")).select("vec_id", "n_links", "component_id", "kept")


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= CAST('0.93' AS DOUBLE)),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(reach.b) AS component_id, a = min(reach.b) AS kept
FROM reach LEFT JOIN (SELECT a AS of_, count(*) AS n FROM links GROUP BY a) ON a = of_ GROUP BY a
"""
