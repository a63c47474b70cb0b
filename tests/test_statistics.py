import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from sorrel.functions.numeric import bounded_minimum, chi2_isf_1, log_t_sf, neg_log10_decimal
from sorrel.operators import clusters, layout
from sorrel.operators import statistics as st


def table(spark, families):
    return spark.createDataFrame([(f, p, i) for f, ps in families.items() for i, p in enumerate(ps)], "dataset_id string, pval double, i int")


def step_up(ps):
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    out, best = [0.0] * len(ps), 1.0
    for k in range(len(ps), 0, -1):
        i = order[k - 1]
        best = min(best, ps[i] * (len(ps) / k))
        out[i] = best
    return out


def test_step_up_goldens(spark):
    got = st.adjust(table(spark, {"a": [0.09, 0.01, 0.021, 0.02, 0.015], "b": [0.02, 0.04, 0.02, 0.04]})).orderBy("dataset_id", "i").collect()
    assert [r.bh_p for r in got] == pytest.approx([0.09, 0.02625, 0.02625, 0.02625, 0.02625, 0.04, 0.04, 0.04, 0.04])
    assert [r.n_tests for r in got] == [5] * 5 + [4] * 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.one_of(hs.floats(1e-300, 1), hs.sampled_from([0.01, 0.02, 1.0, 5e-324])), min_size=1, max_size=60))
def test_step_up_any(spark, ps):
    got = st.adjust(table(spark, {"a": ps})).orderBy("i").collect()
    want = step_up(ps)
    # ties share the smallest of their values
    low = {}
    for p, w in zip(ps, want):
        low[p] = min(w, low.get(p, 2))
    assert [r.bh_p for r in got] == [low[p] for p in ps]
    assert [r.bonferroni_significant for r in got] == [p <= 0.05 / len(ps) for p in ps]


def test_ranks_over_many_bins(spark):
    rnd = random.Random(2)
    ps = [rnd.random() ** rnd.choice([1, 9]) or 0.5 for _ in range(5000)] + [0.25] * 50
    got = {r.p: r.rank for r in st.ranked(table(spark, {"a": ps}), "pval", ["dataset_id"]).collect()}
    order = np.sort(ps)
    assert got == {p: int(np.searchsorted(order, p, side="right")) for p in set(ps)}


def test_log_step_up(spark):
    ps = [0.01, 0.04, 0.03, 0.2]
    df = spark.createDataFrame([("a", -math.log10(p), i) for i, p in enumerate(ps)] + [("b", 400.0, 9), ("b", 350.0, 10)], "dataset_id string, neg_log10_pvalue double, i int")
    got = {r.i: r for r in st.adjust_log(df).collect()}
    assert [10 ** -got[i].neg_log10_p_bh for i in range(4)] == pytest.approx([0.04, 0.16 / 3, 0.16 / 3, 0.2])
    assert got[0].bh_significant and not got[2].bh_significant
    assert got[9].neg_log10_p_bh == pytest.approx(400 - math.log10(2)) and got[9].bonferroni_significant


def test_inflation(spark):
    got = {r.dataset_id: r.lambda_gc for r in st.inflation(table(spark, {"a": [0.01, 0.05, 0.5], "b": [1.0, 1.0], "c": [0.5, 0.5, 0.01, 0.05]})).collect()}
    chi = lambda p: NormalDist().inv_cdf(p / 2) ** 2
    assert got["a"] == pytest.approx(3.8414588206941285 / 0.454936423119572)
    assert got["b"] == 0 and got["c"] == pytest.approx((chi(0.05) + chi(0.5)) / 2 / 0.454936423119572)


def test_quantile(spark):
    ps = [1.0, 0.9, 0.5, 0.3, 0.05, 1e-5, 1e-12, 1e-100, 1e-300]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(chi2_isf_1("p")).collect()
    assert [r[0] for r in got] == pytest.approx([NormalDist().inv_cdf(p / 2) ** 2 for p in ps], rel=1e-12)
    tiny = spark.createDataFrame([(5e-324,)], "p double").select(chi2_isf_1("p")).first()[0]
    assert math.isfinite(tiny) and tiny > 1400


def test_decimal_logs(spark):
    cases = {"1e-400": 400.0, "0.05": -math.log10(0.05), "1": 0.0, "2.5E-3": -math.log10(0.0025), "0": None, "1.5": None, "x": None, "": None, "-0.1": None}
    got = {r.t: r.v for r in spark.createDataFrame([(k,) for k in cases], "t string").select("t", neg_log10_decimal("t").alias("v")).collect()}
    assert {k for k, v in got.items() if v is None} == {k for k, v in cases.items() if v is None}
    assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in cases.items() if v is not None)


def test_t_tail():
    # one degree of freedom is the Cauchy distribution
    for t in (0.0, 0.1, 1.0, 30.0, 1e5):
        assert math.exp(log_t_sf(t, 1)) == pytest.approx(0.5 - math.atan(t) / math.pi, rel=1e-6)
    assert math.exp(log_t_sf(8.0, 61)) == pytest.approx(4.39864e-11 / 2, rel=0.6)
    assert math.isfinite(log_t_sf(1e6, 200))
    assert bounded_minimum(lambda x: (x - 2) ** 2, -12, 12) == pytest.approx(2, abs=1e-6)


def positions(spark, rows):
    return spark.createDataFrame([("d", c, p, v, b, i) for i, (c, p, v, b) in enumerate(rows)], "dataset_id string, chr string, pos long, pval double, beta double, src_row long")


def test_signals(spark):
    # a gap of the distance merges, one more splits; chained; chromosomes apart; natural order
    df = positions(spark, [("Chr1", 100, 1e-9, 1.0), ("Chr1", 200, 1e-9, -2.0), ("Chr1", 300, 1e-9, 2.0), ("Chr1", 401, 1e-3, 0.1), ("Chr10", 50, 1e-8, 1.0), ("Chr2", 60, 1e-8, 1.0)])
    got = clusters.signals(df, 100).orderBy("src_row").collect()
    assert [r.signal_id for r in got] == ["d_peak_0001"] * 3 + ["d_peak_0002", "d_peak_0004", "d_peak_0003"]
    assert [r.is_lead for r in got] == [False, True, False, True, True, True]
    assert {r.signal_no for r in clusters.signals(positions(spark, [("c", 5, 0.1, 0.0), ("c", 5, 0.2, 0.0), ("c", 6, 0.2, 0.0)]), 0).where("pos = 5").collect()} == {1}


def test_ranking(spark):
    df = positions(spark, [("Chr1", 1, 1e-9, 1.0), ("Chr1", 9, 1e-12, 1.0), ("Chr2", 5, 1e-9, -3.0)]).withColumns({"bonferroni_significant": F.col("src_row") != 1, "bh_significant": F.lit(True)})
    got = {r.src_row: r for r in clusters.ranking(clusters.signals(df, 100)).collect()}
    assert [got[i].candidate_rank for i in (2, 0, 1)] == [1, 2, 3]
    assert got[1].priority_reasons == "bh_significant;lead_variant_of_signal;member_of_multi_variant_signal" and got[1].priority_tier == 2


def test_layout(spark):
    df = positions(spark, [("Chr01", 100, 0.5, 0.0), ("Chr01", 300, 0.5, 0.0), ("Chr02", 50, 0.5, 0.0), ("Chr02", 200, 0.01, 0.0)])
    assert [r.x for r in layout.manhattan(df).orderBy("src_row").collect()] == [100, 300, 350, 500]
    contigs = spark.createDataFrame([("Chr01", 1), ("Chr02", 0)], "chr string, contig_order int")
    assert [r.x for r in layout.contiguous_layout(df, contigs).orderBy("src_row").collect()] == [151, 351, 0, 150]
