"""Steps that are done in parts give what one pass gives, with parts of any width."""

import statistics

import pytest
from pyspark.sql import functions as F

from sorrel.operators import clusters, layout


@pytest.fixture(scope="module")
def places(spark):
    import random

    rnd = random.Random(12)
    rows = [(f"f{i % 2}", f"Chr{rnd.choice([1, 2, 10])}", rnd.choice([rnd.randint(1, 400), rnd.randint(1, 20_000), 77]), rnd.random(), rnd.uniform(-1, 1), i) for i in range(900)]
    return rows, spark.createDataFrame(rows, "dataset_id string, chr string, pos long, pval double, beta double, src_row long").repartition(5).cache()


@pytest.mark.parametrize("width", [1, 7, 50, 1000, 10**9])
@pytest.mark.parametrize("distance", [0, 20, 5000])
def test_islands_are_stitched(places, width, distance):
    rows, df = places
    got = {r.src_row: r.island for r in clusters.islands(df, distance, ["dataset_id", "chr"], width=width).collect()}
    want, last, no = {}, None, 0
    for f, c, p, *_, i in sorted(rows, key=lambda r: r[:3]):
        if last is None or last[:2] != (f, c):
            no = 1
        elif p - last[2] > distance:
            no += 1
        want[i], last = no, (f, c, p)
    assert got == want


def test_signals_and_ranks(places):
    rows, df = places
    members = clusters.signals(df.withColumns({"bonferroni_significant": F.col("pval") < 0.3, "bh_significant": F.lit(True)}), 40)
    got = clusters.ranking(members).collect()
    natural = {"Chr1": 1, "Chr2": 2, "Chr10": 10}
    for f in ("f0", "f1"):
        own = [r for r in got if r.dataset_id == f]
        order = sorted(own, key=lambda r: (1 if r.pval < 0.3 else 2, r.pval, -abs(r.beta), r.pos, r.src_row))
        assert [r.candidate_rank for r in order] == list(range(1, len(own) + 1))
        by_place = sorted(own, key=lambda r: (natural[r.chr], r.pos))
        assert [r.signal_no for r in by_place] == sorted(r.signal_no for r in own) and {r.signal_no for r in own} == set(range(1, by_place[-1].signal_no + 1))
        for no in {r.signal_no for r in own}:
            best = min((r for r in own if r.signal_no == no), key=lambda r: (r.pval, -abs(r.beta), r.pos, r.src_row))
            assert [r.src_row for r in own if r.signal_no == no and r.is_lead] == [best.src_row]


@pytest.mark.parametrize("width", [1, 13, 65_536])
def test_medians_are_exact(spark, monkeypatch, places, width):
    monkeypatch.setattr(layout, "BIN", width)
    rows, df = places
    want = {}
    for f, c, p, *_ in rows:
        want.setdefault((f, c), []).append(p)
    got = {(r.dataset_id, r.chr): r.m for r in layout.medians(df, ["dataset_id", "chr"], "pos", "m").collect()}
    assert got == {k: float(statistics.median(v)) for k, v in want.items()}
    odd = spark.createDataFrame([("a", -5), ("a", -90_000), ("a", None), ("b", None)], "k string, v long")
    assert [tuple(r) for r in layout.medians(odd, ["k"], "v", "m").collect()] == [("a", -45_002.5)]
