"""Periodic runs against all periods at all places, on words over small alphabets and on documents with nulls, long texts and repeats."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies

from sorrel.llm import periodic

SCHEMA = "doc_id long, text string, runs string, source string"


def brute(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b, q) for (a, b), q in found.items())


def found(words, least):
    return [tuple(r) for r in periodic.runs(np.array(words, np.int64), np.array([len(words)]), least).tolist()]


@settings(max_examples=400, deadline=None)
@given(strategies.lists(strategies.integers(0, 2), max_size=90), strategies.sampled_from([2, 3, 5, 7, 8, 12, 20]))
def test_small_alphabets(words, least):
    assert found(words, least) == brute(words, least)


@settings(max_examples=300, deadline=None)
@given(strategies.lists(strategies.tuples(strategies.lists(strategies.integers(0, 1), min_size=1, max_size=9), strategies.integers(1, 6)), max_size=9), strategies.sampled_from([2, 12]))
def test_repeated_parts(parts, least):
    """Repetitions of repetitions: the periods of inner runs are far smaller than those of outer ones."""
    inner = [x for part, times in parts for x in part * times]
    for words in (inner, inner * 2 + inner[: len(inner) // 2], [2, *inner, *inner, 3, *inner, *inner]):
        assert found(words, least) == brute(words, least)


def test_structured_words():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(512)]
    for words in (fib[-1], thue, [0] * 500, [0, 1] * 200 + [0] * 50, ([0] * 30 + [1]) * 9, ([0, 0, 1] * 11 + [0]) * 7):
        for least in (2, 12):
            assert found(words, least) == brute(words, least)


def test_texts_dont_meet():
    words = np.array([1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1])
    assert len(periodic.runs(words, np.array([6, 6]), 12)) == 0 and len(periodic.runs(words, np.array([6, 6]), 6)) == 2


def digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    r = brute(w, 12)
    gone = {i for a, b, q in r for i in range(a + q, b)}
    listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in sorted(r, key=lambda x: (x[0], x[2])))
    best = min(((a - b, a, q) for a, b, q in r), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(r), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def texts():
    rnd = random.Random(11)
    out = []
    for i in range(250):
        body = []
        for _ in range(rnd.randint(0, 5)):
            part = [rnd.choice(["a", "B", "é", "b", f"w{rnd.randint(0, 60)}"]) for _ in range(rnd.randint(1, 30))]
            body += part * rnd.choice([1, 1, 1, 2, 3, 7])
        out.append((i, rnd.choice([" ", "\n", "  ", "\t"]).join(body)))
    return [*out, (300, None), (301, ""), (302, " \n "), (303, "one"), (304, "x " * 12), (305, "x " * 11), (306, " ".join(f"w{k % 700}" for k in range(2500))), (None, "a b " * 9), (None, None), out[4], out[4]]


@pytest.mark.parametrize("block", [500, 2_000_000])
def test_query(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(periodic, "BLOCK", block)
    rows = texts()
    spark.createDataFrame([(i, t, "r", "s") for i, t in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = periodic.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted((digest(*r) for r in rows), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and sum(r[1] for r in want) > 100


def test_clashing_names_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b " * 8, "r", "s")], SCHEMA)
    row = periodic.periodic_runs(df, 4).first()
    assert row.asDict(recursive=True) == {"doc_id": 1, "text": "a b " * 8, "source": "s", "n_words": 16, "runs": [{"start": 0, "length": 16, "period": 2}], "collapsed_text": "a b"}
    assert periodic.periodic_runs(df.limit(0)).count() == 0
