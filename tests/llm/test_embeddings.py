"""Near copies among vectors against all pairs, with vectors that have no direction, ties, repeated rows and several cells."""

import math
import random

import numpy as np
import pytest

from sorrel.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, source string"


def brute(rows, threshold):
    """(n_links, component) of each row by all pairs."""
    def good(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    unit = [np.array(r[1], np.float32).astype(float) if good(r) else None for r in rows]
    unit = [None if u is None else u / np.abs(u).max() for u in unit]
    n, root = [0] * len(rows), list(range(len(rows)))
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                n[i] += 1
                n[j] += 1
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    least = {}
    for r, x in zip(rows, root):
        if r[0] is not None:
            least[x] = min(least.get(x, r[0]), r[0])
    return sorted(((r[0], k, least.get(x), r[0] == least.get(x)) for r, k, x in zip(rows, n, root)), key=str)


def vectors(seed, n, dim):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dim))
    out = []
    for i in range(n):
        v = rnd.normal(size=dim) if i % 3 == 0 else centres[rnd.integers(6)] + rnd.normal(size=dim) * rnd.choice([0.05, 0.25])
        out.append((i, (v * rnd.choice([1, 3.5])).astype(np.float32).tolist(), int(rnd.choice([0, 0, 1, 2])), "x", "s"))
    return out


@pytest.mark.parametrize("dim", [2, 5, 24])
def test_near_vectors(spark, monkeypatch, dim):
    monkeypatch.setattr(embeddings, "CELL", 40)
    monkeypatch.setattr(embeddings, "CHUNK_BYTES", 30 * 8 * dim)
    rows = vectors(dim, 300, dim)
    same = rows[1][1]
    odd = [None, [], [0.0] * dim, [math.nan] * dim, [math.inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0] * (dim + 1), [2.0] * (dim + 1), [1e-40] * dim, [3e38] * dim]
    rows += [(400 + i, same, rows[1][2], "x", "s") for i in range(60)] + [rows[4], rows[4], (None, rows[7][1], rows[7][2], None, None), (None, [-x for x in rows[7][1]], 5, None, None)]
    rows += [(500 + i, v, i % 2, None, None) for i, v in enumerate(odd)] + [(600, same, None, None, None), (601, [2 * x for x in same], rows[1][2], None, None)]
    random.Random(1).shuffle(rows)
    for threshold in (0.93, 0.6):
        got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA), threshold)
        assert got.columns == ["vec_id", "embedding", "label", "source", "n_links", "component_id", "kept"]
        got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()), key=str)
        assert got == brute(rows, threshold) and sum(r[1] for r in got) > 1000


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert embeddings.near_vectors(empty).count() == 0
    assert embeddings.near_vectors(spark.createDataFrame([(1, None, 1, None, None)], SCHEMA)).first().kept


def test_threshold_itself_links(spark):
    """A cosine of exactly 0.6, which products of integers give."""
    rows = [(1, [1.0, 0.0], 1, None, None), (2, [3.0, 4.0], 1, None, None), (3, [3.0, 4.001], 1, None, None)]
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.6).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
