"""Steps whose cost once grew faster than their input, or whose numbers only fitted small tables."""

import numpy as np
import pytest

from sorrel.operators import genotypes


@pytest.mark.parametrize("samples", [1, 7, 23])
def test_kinship_of_one_block_shuffles_no_product(spark, samples):
    g = np.random.default_rng(samples).integers(0, 3, (samples, 9))
    g[:, 0] = 1
    long = spark.createDataFrame([(int(i), j, int(g[i, j])) for i in range(samples) for j in range(9)], "sample_id long, marker_id int, dosage int")
    z = genotypes.centred(long, genotypes.marker_checks(long))
    df = genotypes.kinship(z, tile=2, wide=5)
    got = {(r.sample_a, r.sample_b): r.k for r in df.collect()}
    freq = g.mean(axis=0) / 2
    zz, scale = g - 2 * freq, (2 * freq * (1 - freq)).sum()
    k = zz @ zz.T / scale
    assert len(got) == samples * (samples + 1) // 2 and all(a <= b and v == pytest.approx(k[a, b], abs=1e-12) for (a, b), v in got.items())
    assert df._jdf.queryExecution().executedPlan().toString().count("FlatMapGroupsInPandas") <= 2  # packing alone: nothing is grouped after (the plan is shown once or twice)


def test_kinship_leaves_tasks_by_value(spark):
    """Equal values stand together, so that they are written once; in the order of samples each is written in full."""
    from pyspark.sql import functions as F

    g = np.random.default_rng(5).integers(0, 3, (60, 5))
    long = spark.createDataFrame([(f"s{i}", j, int(g[i, j])) for i in range(60) for j in range(5)], "sample_id string, marker_id int, dosage int")
    rows = genotypes.kinship(genotypes.centred(long, genotypes.marker_checks(long))).withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 60 * 61 // 2 and all(r.sample_a <= r.sample_b for r in rows)
    for t in {r.task for r in rows}:
        k = np.array([r.k for r in rows if r.task == t])
        assert (np.diff(k) >= -1e-9).all()
    x = np.array([0.5, -0.25, 3e300, -0.0, -2.0, 1e-300, 0.5])
    assert x[np.concatenate(list(genotypes._from_least(x)))].tolist() == sorted(x)
    assert sorted(np.concatenate(list(genotypes._from_least(np.resize(x, 3 * genotypes.STEP // 2)))).tolist()) == list(range(3 * genotypes.STEP // 2))


def test_oligos_are_measured_as_arrays(spark):
    """The same as the column expressions, for oligos of any length and letters; what ends a tract at one end of a row doesn't reach another."""
    import random

    from pyspark.sql import functions as F

    from sorrel.functions.text import complementary_run, gc_fraction, longest_run, melting_celsius
    from sorrel.operators import oligos

    rnd = random.Random(3)
    texts = ["".join(rnd.choice(al) for _ in range(rnd.randint(2, 26))) for al in ("ACGT", "AT", "A", "ACGTN") for _ in range(40)] + ["ACGT", "AATT", "GGGGGG", "CG"]
    df = spark.createDataFrame(list(zip(texts, texts[::-1], strict=True)), "a string, b string")
    got = oligos.measured(df, "a").withColumn("pair", oligos.complementary_tract("a", "b"))
    want = df.select("a", "b", F.length("a"), gc_fraction("a"), melting_celsius("a"), longest_run("a"), complementary_run("a", "a"), complementary_run("a", "b"))
    key = lambda r: tuple(x if not isinstance(x, float) else pytest.approx(x, abs=1e-9) for x in r)
    assert [tuple(r) for r in got.collect()] == [key(r) for r in want.collect()]
    assert "lambda" not in got._jdf.queryExecution().toString()


def test_tied_designs_leave_only_those_that_rank(spark):
    """A part that comes again and again gives many pairs of one score; only the smallest products of these are rows."""
    from sorrel.operators import oligos

    unit = "GATTACCAGTCAGGCTAACGTCA"
    sequence = (unit * 20)[:361]
    s = oligos.Settings(max_self_match=30, max_pair_match=30, max_homopolymer=9, min_tm_C=10.0, max_tm_C=90.0, max_tm_difference_C=40.0)
    alt = "A" if sequence[150] != "A" else "C"
    designs = oligos._designed(sequence, 150, alt, None, [], s)[1]
    assert s.alternatives <= len(designs) <= 3 * s.alternatives
    assert len({x["score"] for x in designs}) < len(designs)


def test_more_signals_than_their_numbers_have_digits(spark, tmp_path):
    """10,010 signals of one family: numbers of five digits are cut by neither side."""
    import duckdb

    from sorrel.plans.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute(f"COPY (SELECT i AS l_orderkey, i * 97 AS l_partkey, i * 11 AS l_suppkey, 1::INT AS l_linenumber, 5.0::DOUBLE AS l_quantity, 1000.0 + i AS l_extendedprice, 0.05::DOUBLE AS l_discount, 0.02::DOUBLE AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus FROM range(10010) t(i)) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    for name in ("candidate_snps", "association_peaks"):
        df = QUERIES[name](spark, str(tmp_path))
        found = con.execute(ORACLE_SQL[name])
        at = [c[0] for c in found.description].index("signal_id")
        want = sorted(r[at] for r in found.fetchall())
        assert len(set(want)) == 10010 and want[-1] == "A_F_peak_9999" and "A_F_peak_10010" in want
        assert sorted(r.signal_id for r in df.select("signal_id").collect()) == want


def test_set_differences_read_each_key_once(spark):
    from sorrel.operators.contract import set_differences

    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k long, t string")
    right = spark.createDataFrame([(2, "b"), (3, "a"), (3, "a"), (None, "c")], "k long, t string")
    df = set_differences(left, right, ["k", "t"])
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == [(1, "a", "left"), (3, "a", "right"), (None, "c", "left"), (None, "c", "right")]
    assert "Join" not in df._jdf.queryExecution().toString()


def test_discoveries_come_from_counts(spark):
    from pyspark.sql import functions as F

    from sorrel.operators import customer
    from sorrel.operators import statistics as st

    rows = spark.createDataFrame([("d", f"bad{i}", None, "aligned_to_ALT") for i in range(2)] + [("d", None, float(i % 9), "unresolved_strand" if i % 4 == 0 else "aligned_to_ALT") for i in range(50)] + [("e", "bad", None, "as_reported")], "dataset_id string, reason string, neg_log10_pvalue double, effect_orientation string")
    whole = customer.discoveries(rows, st.adjust_log(rows.where("reason is null").drop("reason")))
    assert sorted(map(tuple, customer.counted_discoveries(rows).collect())) == sorted(map(tuple, whole.collect()))


def test_hits_are_counted_without_being_made(spark):
    """Blocks over one another and over the edges of bins: counts, statuses and reached places are those of all hits."""
    import random

    from pyspark.sql import functions as F

    from sorrel.operators import crossref, intervals

    rnd = random.Random(8)
    blocks = spark.createDataFrame([(f"k{i}", rnd.choice(["T1", "T2"]), 500 + rnd.choice([0, 40]) + q, rnd.choice([1, 7, 900, 5000]), rnd.choice(["Q1", "Q2"]), q, 30_000, rnd.choice("+-"), 1.0) for i, q in enumerate(rnd.randrange(0, 24_000) for _ in range(60))], "chain_id string, t_name string, t_start long, size long, q_name string, q_start long, q_size long, strand string, score double")
    source = spark.createDataFrame([(f"c{i}", rnd.choice(["Q1", "Q2", "Q3"]), rnd.choice([1, 2048, 2049, 4096, rnd.randint(1, 30_000)]), "A", "C") for i in range(400)], "candidate_id string, chr string, pos long, ref string, alt string")
    hits = intervals.map_points(source, blocks, "candidate_id")
    counts = {(r.chr, r.pos): r.n_hits for r in intervals.hit_counts(source, blocks).collect()}
    assert counts == {(r.chr, r.pos): r.n for r in hits.groupBy("chr", "pos").agg((F.count("*") / F.countDistinct("candidate_id")).cast("long").alias("n")).collect()} and max(counts.values()) > 2
    reached = lambda h: {(r.candidate_id, r.target_chr, r.target_pos, r.strand) for r in h.collect()}
    merged = intervals.diagonals(blocks)
    assert reached(intervals.map_points(source, merged, "candidate_id")) == reached(hits) and merged.count() < 60
    base = F.expr("substring('ACGT', cast(target_pos % 4 as int) + 1, 1)")
    want = crossref.mapped(source, hits, hits.select("target_chr", "target_pos").distinct().withColumn("target_base", base))
    columns = sorted(want.columns)
    plain = lambda df: sorted((tuple(r) for r in df.select(columns).collect()), key=str)
    assert plain(crossref.mapped_in_place(source, blocks, base)) == plain(want)
    short = crossref.mapped_in_place(source, blocks, base, 1)
    assert plain(short.where("n_hits < 2")) == plain(want.where("n_hits < 2")) and short.count() == 400
    assert {(r.candidate_id, r.status) for r in short.collect()} == {(r.candidate_id, r.status) for r in want.collect()}


_BLOCKS = [(f"k{i}", "T1", 500 * i, 900, "Q1", 300 * i, 30_000, "+-"[i % 2], 1.0) for i in range(60)], "chain_id string, t_name string, t_start long, size long, q_name string, q_start long, q_size long, strand string, score double"


def test_hits_are_made_by_many_tasks(spark):
    """However small what the join reads is: a point may have many hits."""
    from pyspark.sql import functions as F

    from sorrel.operators import intervals

    points = spark.range(1, 18_001, 1, 1).selectExpr("concat('c', id) AS candidate_id", "'Q1' AS chr", "id AS pos")
    hits = intervals.map_points(points, spark.createDataFrame(*_BLOCKS), "candidate_id").withColumn("task", F.spark_partition_id())
    rows = hits.collect()
    place = lambda r, b: b[2] + (r.pos - 1 if b[7] == "+" else b[6] - r.pos) - b[5] + 1
    starts = {b[0]: (b[5] if b[7] == "+" else b[6] - b[5] - b[3], b) for b in _BLOCKS[0]}
    assert sorted((r.pos, r.chain_id) for r in rows) == sorted((p, c) for c, (low, b) in starts.items() for p in range(low + 1, low + b[3] + 1) if p <= 18_000)
    assert all(r.target_pos == place(r, starts[r.chain_id][1]) for r in rows) and len({r.task for r in rows}) == 4


def test_alleles_are_turned_once_for_a_candidate(spark):
    from pyspark.sql import functions as F

    from sorrel.operators import crossref

    source = spark.createDataFrame([("c1", "Q1", 700, "A", "C"), ("c2", "Q1", 29_999, "G", "T")], "candidate_id string, chr string, pos long, ref string, alt string")
    df = crossref.mapped_in_place(source, spark.createDataFrame(*_BLOCKS), F.lit("A"))
    rows = df.collect()
    assert {(r.candidate_id, r.strand, r.mapped_ref, r.mapped_alt, r.status) for r in rows if r.strand == "+"} == {("c1", "+", "A", "C", "multimap")}
    assert all((r.mapped_ref, r.mapped_alt) == ("C", "A") for r in rows if r.strand == "-" and r.candidate_id == "c2")
    above = df._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "translate" not in above and "map(" not in above


def test_candidates_are_screened_together(spark):
    """Those of one length and offset in one set of arrays, in any number of parts, as one by one; reasons alone need no ranks and write nothing."""
    import random

    from sorrel.operators import oligos
    from sorrel.sources import scratch

    rnd = random.Random(6)
    rows, known = [], []
    for n in range(60):
        length, sign = rnd.choice([40, 150, 150, 361]), rnd.choice("+-")
        sequence, at, start = "".join(rnd.choice(rnd.choice(["ACGT", "GC", "ACGT"])) for _ in range(length)), length // 2, 1000 * n + 1
        ref, alt = sequence[at], "ACGT"["ACGT".index(sequence[at]) - 1]
        turn = (lambda x: x.translate(str.maketrans("ACGT", "TGCA"))) if sign == "-" else (lambda x: x)
        rows.append((f"c{n}", start + at, turn(ref), turn(alt), sign, sequence, at, start, start + length - 1))
        known += [(f"c{n}", start + rnd.randrange(length), "T" * rnd.choice([1, 2])) for _ in range(rnd.randrange(3))]
    df = spark.createDataFrame(rows, "candidate_id string, pos long, ref string, alt string, strand string, sequence string, offset int, interval_start long, interval_end long").coalesce(1)
    v = spark.createDataFrame(known, "candidate_id string, v_pos long, v_ref string")
    s = oligos.Settings(max_pair_match=4, max_self_match=5)
    ids = lambda x: sorted(map(tuple, x.collect()))
    before = len(scratch._PATHS)
    got = ids(oligos.rejections(df, s, v))
    assert len(scratch._PATHS) == before and got == ids(oligos.design(df, s, v, 400)[1])
    assert {"primer_dimer_screen", "cohort_variant_in_binding_site", "tm_difference"} <= {r[1] for r in got}
    want = []
    for c, _, _, alt, sign, sequence, at, low, high in rows:
        span = (lambda a, b, high=high: (high - b + 1, high - a)) if sign == "-" else (lambda a, b, low=low: (low + a, low + b - 1))
        other = alt.translate(str.maketrans("ACGT", "TGCA")) if sign == "-" else alt
        why, found = oligos._designed(sequence, at, other, span, [(x[1], x[1] + len(x[2]) - 1) for x in known if x[0] == c], s)
        want += [(c, k, n) for k, n in (why or ({} if found else {"insufficient_product_interval": 1})).items()]
    assert got == sorted(want)


def test_sequences_are_cut_once(spark):
    """The cohort's variants are made of the same rows as the candidates."""
    from sorrel.plans.queries import QUERIES

    df = QUERIES["primer_rejections"](spark, "/root/testdata/sf0.001")
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString() and df.count() > 0
