"""Collocations against counting all phrases, with odd bytes, several languages, cuts of the stream, ties and nulls."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sorrel.llm import collocations

SCHEMA = "doc_id long, text string, lang string, rank string, phrase string"


def brute(rows, least, covered, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= covered * f[p[i:j]]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    vocab = ["the", "The", "a", "b\x01c", "b", "b\x0ec", "\x00", "naïve", "É", "Æ9", "x|y", " ", "zz ", "long" * 30] + [f"w{i}" for i in range(12)]
    out = []
    for i in range(160):
        parts = []
        for _ in range(rnd.randint(0, 60)):
            parts.append("new york city hall" if rnd.random() < 0.1 else rnd.choice(vocab[: rnd.choice([3, 8, 26])]))
            parts.append(rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", "; "]))
        out.append((i, "".join(parts), rnd.choice(["en", "en", "de", "", None, "und", "x\ty z"]), "r", "p"))
    return [*out, (None, None, None, None, None), (1, "", "en", None, None), (2, "the", "fr", None, None), (3, "the a " * 3000, "en", None, None), out[5], out[5]]


@pytest.mark.parametrize(("least", "covered", "top"), [(30, 80, 2000), (2, 80, 2000), (5, 100, 7)])
def test_collocations(spark, monkeypatch, rows, least, covered, top):
    monkeypatch.setattr(collocations, "BLOCK", 2000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = collocations.collocations(df, least, covered, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, covered, top)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 10


def test_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).count() == 0
    spread = spark.createDataFrame([(i, "a b", "en", None, None) for i in range(30)], SCHEMA)
    assert [tuple(r) for r in collocations.collocations(spread).collect()] == [("en", 1, "a b", 30, 30, 30, 60, 1_000_000)]
