"""The mixed model with kinship against dense algebra, p-values far in the tail, kinship over many blocks, and alignment of the tables."""

import math

import numpy as np
import pytest

from sorrel.functions.numeric import chi2_isf, chi2_isf_sql, chi2_median, log_t_sf
from sorrel.operators import genotypes
from sorrel.operators.contract import ContractError
from sorrel.plans import queries


def t_tail(t, df):
    """P(T > t) by integrating the density over u = atan(x / sqrt(df)), where it is a power of a cosine."""
    c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(math.pi)
    low = math.atan(t / math.sqrt(df))
    u = np.linspace(low, math.pi / 2, 200_001)
    f = np.exp(c + (df - 1) * np.log(np.maximum(np.cos(u), 1e-300)))
    h = u[1] - u[0]
    return h / 3 * (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum())


@pytest.mark.parametrize("df", [1, 2, 3, 10, 61, 400])
def test_tails_of_whole_arrays(df):
    t = np.array([0.0, 1e-9, 0.01, 0.5, 1.0, 2.0, 4.0, 8.0, -2.0])
    got = log_t_sf(t, df)
    assert np.allclose(np.exp(got), [t_tail(abs(x), df) for x in t], rtol=1e-7, atol=0)
    assert got.tolist() == pytest.approx([log_t_sf(float(x), df) for x in t], rel=1e-13)
    # far out the tail is a power of t
    far = log_t_sf(np.array([1e40, 1e80, np.inf]), df)
    assert far[1] - far[0] == pytest.approx(-40 * df * math.log(10), rel=1e-9) and far[2] == -math.inf


def test_query_against_dense_algebra(spark, tmp_path):
    rnd = np.random.default_rng(4)
    n, m = 24, 150
    vectors = rnd.normal(size=(m, n)) * 0.12 + 0.08 * np.repeat(rnd.normal(size=(m, 3)), 8, axis=1)
    vectors[7] = 1.0  # one dosage for all samples but missing ones
    spark.createDataFrame([(i, [float(np.float32(x)) for x in v], i % 10) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.marker_id: r for r in queries.mixed_model(spark, str(tmp_path)).collect()}

    x32 = vectors.astype(np.float32).astype(float)
    g = np.where(x32 < -0.05, 0.0, np.where(x32 < 0.05, 1.0, 2.0))
    g[(np.arange(m)[:, None] * 31 + np.arange(n) * 17) % 41 == 0] = np.nan
    freq = np.nanmean(g, axis=1) / 2
    missing = np.isnan(g).mean(axis=1)
    kept = np.flatnonzero((np.minimum(freq, 1 - freq) >= 0.05) & (missing <= 0.1))
    z = np.where(np.isnan(g), 2 * freq[:, None], g) - 2 * freq[:, None]
    k = z[kept].T @ z[kept] / (2 * freq[kept] * (1 - freq[kept])).sum()
    y = 100 * x32[np.arange(m) % 10 < 5].mean(axis=0) + np.arange(n) % 5
    values, vecs = np.linalg.eigh(k)
    first = vecs[:, -1] * np.sign(vecs[np.abs(vecs[:, -1]).argmax(), -1])
    x = np.column_stack([np.ones(n), np.arange(n) % 3, first])

    def reml(log_delta):
        v = k + math.exp(log_delta) * np.eye(n)
        vi = np.linalg.inv(v)
        p = vi - vi @ x @ np.linalg.inv(x.T @ vi @ x) @ x.T @ vi
        return (n - 3) * math.log(y @ p @ y) + np.linalg.slogdet(v)[1] + np.linalg.slogdet(x.T @ vi @ x)[1]

    grid = np.linspace(-12, 12, 2401)
    at = grid[np.argmin([reml(d) for d in grid])]
    fine = np.linspace(max(-12, at - 0.01), min(12, at + 0.01), 2001)
    vi = np.linalg.inv(k + math.exp(fine[np.argmin([reml(d) for d in fine])]) * np.eye(n))
    assert set(got) == set(kept.tolist()) and len(kept) > 60
    for j in kept:
        d = np.column_stack([x, z[j]])
        a = np.linalg.inv(d.T @ vi @ d)
        b = a @ d.T @ vi @ y
        e = y - d @ b
        se = math.sqrt(e @ vi @ e / (n - 4) * a[3, 3])
        assert got[j].beta == pytest.approx(b[3], rel=1e-3, abs=2e-4) and got[j].se == pytest.approx(se, rel=1e-3)
        assert got[j].neg_log10_pvalue == pytest.approx(-math.log10(2 * t_tail(abs(b[3] / se), n - 4)), rel=2e-3, abs=2e-4)


def test_kinship_is_added_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(genotypes, "FAN", 3)
    rnd = np.random.default_rng(1)
    g = rnd.integers(0, 3, (11, 90))
    long = spark.createDataFrame([(f"s{i:02d}", j, int(g[i, j])) for i in range(11) for j in range(90)], "sample_id string, marker_id int, dosage int")
    z = genotypes.centred(long, genotypes.marker_checks(long))
    got = {(r.sample_a, r.sample_b): r.k for r in genotypes.kinship(z, tile=4, block=7).collect()}
    freq = g.mean(axis=0) / 2
    zz = g - 2 * freq
    k = zz @ zz.T / (2 * freq * (1 - freq)).sum()
    assert len(got) == 66 and all(v == pytest.approx(k[int(a[1:]), int(b[1:])], abs=1e-12) and a <= b for (a, b), v in got.items())


def chi2_tail(x, df):
    m, odd = divmod(df, 2)
    h = x / 2
    if odd:
        return math.erfc(math.sqrt(h)) + sum(math.exp(-h + (j - 0.5) * math.log(h) - math.lgamma(j + 0.5)) for j in range(1, m + 1))
    return sum(math.exp(-h + j * math.log(h) - math.lgamma(j + 1)) for j in range(m))


def test_chi_square_quantiles(spark):
    """Against bisection of the closed tails, from which they differ by 1e-9 at most, and medians from tables."""
    import duckdb

    table = [0.454936423119572, 1.386294361119891, 2.365973884375338, 3.356693980033321, 4.351460191095526, 5.348120627447116, 6.345811195521517, 7.344121497701792, 8.342832692252953, 9.341817765591895]
    assert [chi2_median(k) for k in range(1, 11)] == pytest.approx(table, rel=1e-12)
    ps = [0.999, 0.95, 0.9, 0.89, 0.5, 0.3, 0.05, 1e-4, 1e-16, 1e-100, 1e-300]
    rows = spark.createDataFrame([(p,) for p in [*ps, 1.0]], "p double").select("p", *[chi2_isf("p", k).alias(f"k{k}") for k in range(1, 11)]).collect()
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT unnest({[*ps, 1.0]})::DOUBLE AS p")
    for k in range(1, 11):
        other = dict(con.execute(chi2_isf_sql("t", "p", k)).fetchall())
        for r in rows:
            x = r[f"k{k}"]
            assert other[r.p] == pytest.approx(x, rel=1e-12, abs=1e-12)
            if r.p == 1:
                assert x == 0
                continue
            low, high = 1e-9, 3000.0
            for _ in range(200):
                middle = (low + high) / 2
                low, high = (middle, high) if chi2_tail(middle, k) > r.p else (low, middle)
            assert x == pytest.approx(low, rel=1e-9), (k, r.p)
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError, match="degrees"):
            chi2_isf("p", bad)


def test_tables_must_match(spark):
    def frames(**change):
        parts = {
            "wide": [("s1", "0", "1"), ("s2", "2", "NA")], "markers": ["m1", "m2"], "variants": [("m1", "c", 5, "A", "C", "asm"), ("m2", "c", 9, "G", "T", "asm")],
            "phenotypes": [("s2", "t", "g"), ("s1", "t", "g")], "samples": [("s1", "k"), ("s2", "k")],
        } | change
        return (
            spark.createDataFrame(parts["wide"], "sample_id string, m1 string, m2 string"), parts["markers"], spark.createDataFrame(parts["variants"], "marker_id string, chr string, pos long, ref string, alt string, assembly_id string"),
            spark.createDataFrame(parts["phenotypes"], "sample_id string, trait string, unit string"), spark.createDataFrame(parts["samples"], "sample_id string, cohort_id string"),
        )

    declared = {"trait": "t", "unit": "g", "cohort_id": "k", "assembly_id": "asm"}
    genotypes.aligned(*frames(), **declared)
    broken = {
        "repeated markers": {"markers": ["m1", "m1"]}, "header only": {"markers": ["m1", "m3"]}, "variant c:5:A:C is there": {"variants": [("m1", "c", 5, "A", "C", "asm"), ("m2", "c", 5, "A", "C", "asm")]},
        "two different bases": {"variants": [("m1", "c", 5, "A", "A", "asm"), ("m2", "c", 9, "G", "T", "asm")]}, "assembly_id is": {"variants": [("m1", "c", 5, "A", "C", "asm"), ("m2", "c", 9, "G", "T", "b")]},
        "sample of the genotypes": {"wide": [("s1", "0", "1"), ("s1", "0", "1")]}, "isn't in all": {"samples": [("s1", "k"), ("s3", "k")]}, "trait is": {"phenotypes": [("s2", "t", "g"), ("s1", "u", "g")]},
        "unit is": {"phenotypes": [("s2", "t", "g"), ("s1", "t", "kg")]}, "cohort_id is": {"samples": [("s1", "k"), ("s2", "l")]},
    }
    for match, change in broken.items():
        with pytest.raises(ContractError, match=match):
            genotypes.aligned(*frames(**change), **declared)
