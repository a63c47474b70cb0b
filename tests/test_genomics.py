import gzip
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.functions.text import complementary_run, identity, longest_run, melting_celsius, percent_decode, percent_encode, reverse_complement
from sorrel.operators import assays, crossref, genotypes, intervals, oligos
from sorrel.plans.queries import META
from sorrel.sources import readers
from sorrel.streaming import associations as streams

TURN = str.maketrans("ACGT", "TGCA")


def test_sequences(spark):
    df = spark.createDataFrame([("CGTTCCAAAGATGTGGGCATGAGCTTAC", "AAAA", "TTTT")], "s string, a string, b string")
    r = df.select(melting_celsius("s").alias("tm"), complementary_run("a", "b").alias("ab"), complementary_run("a", "a").alias("aa"), longest_run("s").alias("run"), reverse_complement("s").alias("rc")).first()
    assert round(r.tm, 2) == 60.32 and (r.ab, r.aa, r.run) == (4, 0, 3) and r.rc == df.first().s[::-1].translate(TURN)
    t = spark.createDataFrame([("a b*~+é",)], "t string").select(percent_encode("t").alias("e")).withColumn("d", percent_decode("e")).first()
    assert t.e == "a%20b%2A~%2B%C3%A9" and t.d == "a b*~+é"
    import hashlib
    import json

    i = spark.createDataFrame([("Chr1", 5)], "chr string, pos long").select(identity("x-", ("pos", "number"), ("chr", "text"))).first()[0]
    assert i == "x-" + hashlib.sha256((json.dumps({"chr": "Chr1", "pos": 5}, sort_keys=True, indent=2) + "\n").encode()).hexdigest()[:20]


def test_fasta(spark, tmp_path):
    seq = {"chrA": "ACGTN" * 61 + "AC", "chrB": "GATTACA" * 9}
    path = tmp_path / "r.fa"
    path.write_text("".join(f">{k} note\n" + "".join(v[i : i + 40] + "\n" for i in range(0, len(v), 40)) for k, v in seq.items()))
    contigs = readers.scan_fasta(str(path))
    assert [(c.name, c.length, c.line_bases, c.line_bytes) for c in contigs] == [("chrA", 307, 40, 41), ("chrB", 63, 40, 41)]
    (tmp_path / "r.fai").write_text("".join(f"{c.name}\t{c.length}\t{c.offset}\t{c.line_bases}\t{c.line_bytes}\n" for c in contigs))
    assert readers.read_fai(str(tmp_path / "r.fai")) == contigs
    assert readers.bases(str(path), contigs, "chrA", 39, 85) == seq["chrA"][38:85] and readers.bases(str(path), contigs, "chrB", 1, 9, "-") == seq["chrB"][:9][::-1].translate(TURN)
    with pytest.raises(ValueError, match="outside"):
        readers.bases(str(path), contigs, "chrB", 1, 64)
    chunks = readers.sequence_chunks(spark, str(path), 25)
    spans = spark.createDataFrame([(i, *x) for i, x in enumerate([("chrA", 1, 307), ("chrA", 25, 26), ("chrB", 40, 63), ("chrA", 99, 176)])], "k int, chr string, start long, end long")
    got = {r.k: r.bases for r in intervals.slices(spans, chunks, "k", 25).collect()}
    assert got == {r.k: seq[r.chr][r.start - 1 : r.end] for r in spans.collect()}
    path.write_text(">a\nACG\nA\nACG\n")
    with pytest.raises(readers.SchemaError):
        readers.scan_fasta(str(path))


def test_annotation_files(spark, tmp_path):
    (tmp_path / "g.gff3").write_text("##gff\nc1\t.\tgene\t5\t20\t.\t+\t.\tName=x;ID=a%20b+c\nc1\t.\texon\t5\t9\t.\t+\t.\tID=e\n")
    (tmp_path / "g.gtf").write_text('c1\t.\tgene\t7\t9\t.\t-\t.\tgene_id "g 1"; x "y";\n')
    assert [(r.gene_id, r.g_start, r.g_end) for r in readers.genes(spark, str(tmp_path / "g.gff3")).collect()] == [("a b+c", 5, 20)]
    assert [(r.gene_id, r.strand) for r in readers.genes(spark, str(tmp_path / "g.gtf")).collect()] == [("g 1", "-")]
    with gzip.open(tmp_path / "v.vcf.gz", "wt") as f:
        f.write("##fileformat=VCFv4.2\n##reference=demo\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nc1\t4\t.\tTA\tT,TAA\t.\tPASS\t.\n")
    assert [(r.v_pos, r.v_ref, r.v_alt) for r in readers.vcf(spark, str(tmp_path / "v.vcf.gz"), "demo").collect()] == [(4, "TA", "T"), (4, "TA", "TAA")]
    with pytest.raises(readers.SchemaError):
        readers.vcf(spark, str(tmp_path / "v.vcf.gz"), "other")
    (tmp_path / "m.bed").write_text("track x\nc1\t0\t5\n")
    assert [tuple(r) for r in readers.bed(spark, str(tmp_path / "m.bed")).collect()] == [("c1", 0, 5)]
    contigs = spark.createDataFrame([("c1", 4)], "chr string, length long")
    assert readers.intervals_outside(spark.sql("select 'c1' c, 1 s, 4 e union all select 'c1', 3, 5 union all select 'z', 1, 1"), contigs, "c", "s", "e").count() == 2


def test_mask_ends(spark):
    spans = spark.createDataFrame([(1, "c", 6, 9), (2, "c", 5, 9), (3, "c", 1, 2), (4, "d", 1, 9)], "k int, chr string, start long, end long")
    mask = spark.createDataFrame([("c", 2, 5)], "m_chr string, m_start long, m_end long")
    assert {r.k: r.mask_overlap for r in intervals.masked(spans, mask, "k").collect()} == {1: False, 2: True, 3: False, 4: False}


def test_overlap_brute_force(spark):
    rnd = random.Random(4)
    span = lambda: (s := rnd.randint(1, 900), s + rnd.choice([0, 3, 50, 400]))
    left, right = [(i, rnd.choice("xy"), *span()) for i in range(80)], [(i, rnd.choice("xy"), *span()) for i in range(80)]
    got = intervals.overlapping(spark.createDataFrame(left, "a int, ca string, s long, e long"), spark.createDataFrame(right, "b int, cb string, s2 long, e2 long"), ("s", "e"), ("s2", "e2"), [("ca", "cb")], width=64)
    assert sorted((r.a, r.b) for r in got.collect()) == sorted((x[0], y[0]) for x in left for y in right if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])


def test_neighbour_window_uses_the_variants_end(spark):
    c = spark.createDataFrame([("a", "c", 9, "A", "G")], "candidate_id string, chr string, pos long, ref string, alt string")
    v = spark.createDataFrame([("c", 4, "TA", "T"), ("c", 4, "T", "A"), ("c", 13, "A", "C"), ("c", 14, "A", "C"), ("c", 9, "A", "G")], "v_chr string, v_pos long, v_ref string, v_alt string")
    assert sorted((r.v_pos, r.v_ref, r.distance_bp) for r in intervals.neighbours(c, v, 4).collect()) == [(4, "TA", -5), (13, "A", 4)]


def test_cross_reference(spark):
    hits = spark.createDataFrame([("s1", "c1", "t", 3, "+"), ("s7", "c1", "t", 8, "+"), ("s15", "c3", "t", 21, "+"), ("s15", "c4", "t", 31, "+"), ("s21", "c2", "t", 34, "-")], "candidate_id string, chain_id string, target_chr string, target_pos long, strand string")
    source = spark.createDataFrame([(f"s{p}", "s", p, "A", "C") for p in (1, 5, 7, 15, 21)], "candidate_id string, chr string, pos long, ref string, alt string")
    bases = spark.createDataFrame([("t", 3, "A"), ("t", 8, "G"), ("t", 34, "G"), ("t", 21, "A"), ("t", 31, "A")], "target_chr string, target_pos long, target_base string")
    mapping = crossref.mapped(source, hits, bases)
    assert {r.candidate_id: r.status for r in mapping.collect()} == {"s1": "mapped", "s5": "unmapped", "s7": "ambiguous", "s15": "multimap", "s21": "mapped"}
    target = spark.createDataFrame([("t1", "t", 34, "T", "G"), ("t2", "t", 3, "A", "G")], "t_id string, t_chr string, t_pos long, t_ref string, t_alt string")
    compared = crossref.compared(mapping, target)
    assert [(r.candidate_id, r.t_id, r.allele_alignment) for r in compared.collect()] == [("s21", "t1", "REF_ALT_swapped")]
    account = {(r.side, r.candidate_id): (r.status, r.reason, r.linked_candidates) for r in crossref.account(source, mapping, compared, target).collect()}
    assert len(account) == 7 and account["source", "s1"][1] == "mapped_coordinate_no_matching_target_candidate" and account["target", "t1"] == ("compared", "linked_by_verified_alleles", "s21") and account["target", "t2"][0] == "not_compared"
    assert {r.status for r in crossref.mapped(source, None, None).collect()} == {"not_assessed"}


def test_mixed_model(spark):
    rnd = np.random.default_rng(3)
    n, m = 48, 12
    g = rnd.integers(0, 3, (n, m)).astype(float)
    g[0, 0] = np.nan
    g[:, m - 1] = 1.0
    long = spark.createDataFrame([(f"{i:03d}", j, None if np.isnan(g[i, j]) else int(g[i, j])) for i in range(n) for j in range(m)], "sample_id string, marker_id int, dosage int")
    checks = genotypes.marker_checks(long)
    z = genotypes.centred(long, checks)
    ids, k = genotypes.matrix(genotypes.kinship(z))
    freq = np.nanmean(g, axis=0) / 2
    zz = (np.where(np.isnan(g), 2 * freq, g) - 2 * freq)
    assert np.allclose(k, zz @ zz.T / (2 * freq * (1 - freq)).sum(), atol=1e-9)
    y = g[:, 3] * 2 + rnd.normal(size=n)
    x = np.column_stack([np.ones(n), rnd.normal(size=n)])
    model = genotypes.fit_null(y, x, k)
    v = k + model.delta * np.eye(n)
    vi = np.linalg.inv(v)
    got = {r.marker_id: r for r in genotypes.test_markers(z, ids, model).collect()}
    for j in range(m - 1):
        d = np.column_stack([x, zz[:, j]])
        a = np.linalg.inv(d.T @ vi @ d)
        b = a @ d.T @ vi @ y
        e = y - d @ b
        s2 = e @ vi @ e / (n - 3)
        assert got[j].beta == pytest.approx(b[2], rel=1e-6, abs=1e-9) and got[j].se == pytest.approx(math.sqrt(s2 * a[2, 2]), rel=1e-6)
    assert got[m - 1].reason == "collinear" and got.pop(m - 1).beta is None
    assert max(got, key=lambda j: got[j].neg_log10_pvalue) == 3
    assert "monomorphic" not in {r.reasons for r in checks.where("marker_id = 3").collect()}
    pcs = genotypes.components(k, 2)
    assert np.allclose(k @ pcs, pcs * np.linalg.eigvalsh(k)[::-1][:2], atol=1e-8) and (pcs[np.abs(pcs).argmax(axis=0), [0, 1]] > 0).all()
    with pytest.raises(ValueError, match="isn't in all"):
        genotypes.ids_aligned({"a": long, "b": long.where("sample_id != '003'")})


def test_wide_genotypes(spark, tmp_path):
    path = tmp_path / "g.tsv"
    path.write_text("sample_id\tm0\tm1\n001\t0\tNA\nNA\t2\t1\n")
    assert sorted((r.sample_id, r.marker_id, r.dosage) for r in readers.genotypes(spark, str(path)).collect() if r.dosage is not None) == [("001", "m0", 0), ("NA", "m0", 2), ("NA", "m1", 1)]
    path.write_text("sample_id\tm0\n001\t3\n")
    with pytest.raises(Exception, match="a genotype is 3"):
        readers.genotypes(spark, str(path)).collect()


ONE = "candidate_id string, pos long, ref string, alt string, strand string, sequence string, offset int, interval_start long, interval_end long"


@pytest.mark.parametrize("strand", ["+", "-"])
def test_primer_design(spark, strand):
    rnd = random.Random(8)
    seq = "".join(rnd.choice("ACGT") for _ in range(240))
    offset, alt = 120, next(b for b in "ACGT" if b != seq[120])
    s = oligos.Settings(min_length=19, max_length=20, min_product_bp=75, max_product_bp=80, min_tm_C=45, max_tm_C=70, max_tm_difference_C=8, max_self_match=5, max_pair_match=6)
    turn = lambda x: x if strand == "+" else x.translate(TURN)
    pos = 1001 + offset if strand == "+" else 1240 - offset
    df = spark.createDataFrame([("c", pos, turn(seq[offset]), turn(alt), strand, seq, offset, 1001, 1240)], ONE)
    found, rejected = oligos.design(df, s)
    rc = lambda x: x[::-1].translate(TURN)
    run = lambda a, b: max((k for k in range(1, len(a) + 1) if any(a[i : i + k] in rc(b) for i in range(len(a) - k + 1))), default=0)
    oligo = sorted({x for n in (19, 20) for i in range(240 - n + 1) for x in (seq[i : i + n], rc(seq[i : i + n]), seq[i : i + n - 1] + alt)})
    tm = {r.o: r.t for r in spark.createDataFrame([(x,) for x in oligo], "o string").select("o", melting_celsius("o").alias("t")).collect()}

    def failures(x):
        gc = sum(b in "GC" for b in x) / len(x)
        longest = max(len(m) for m in __import__("re").findall("A+|C+|G+|T+", x))
        return [n for n, bad in (("tm_out_of_range", not s.min_tm_C <= tm[x] <= s.max_tm_C), ("gc_out_of_range", not s.min_gc_fraction <= gc <= s.max_gc_fraction), ("homopolymer", longest > s.max_homopolymer), ("self_complementarity_screen", run(x, x) > s.max_self_match)) if bad]

    from collections import Counter

    reasons, designs = Counter(), []
    for n in (19, 20):
        left = offset - n + 1
        ref = seq[left : offset + 1]
        other = ref[:-1] + alt
        if bad := failures(ref) + failures(other):
            reasons.update(bad)
            continue
        for product in range(75, 81):
            for c in (19, 20):
                end = left + product
                if end - c <= offset:
                    continue
                common = rc(seq[end - c : end])
                t = [tm[ref], tm[other], tm[common]]
                bad = failures(common) + ["tm_difference"] * (max(t) - min(t) > s.max_tm_difference_C)
                if bad:
                    reasons.update(bad)
                elif max(run(ref, common), run(other, common)) > s.max_pair_match:
                    reasons["primer_dimer_screen"] += 1
                else:
                    spans = [(left, offset + 1), (end - c, end)]
                    spans = [(1001 + x, 1000 + y) if strand == "+" else (1240 - y + 1, 1240 - x) for x, y in spans]
                    designs.append((round(sum(abs(x - s.target_tm_C) for x in t) + max(t) - min(t), 6), product, ref, other, common, spans))
    assert {r.reason: r.n for r in rejected.collect()} == dict(reasons) and designs
    got = found.orderBy("rank").collect()
    assert [(r.score, r["product"]) for r in got] == [x[:2] for x in sorted(designs)[:3]]
    for r in got:
        assert (r.score, r["product"], r.specific_ref, r.specific_alt, r.common, [(r.specific_start, r.specific_end), (r.common_start, r.common_end)]) in designs
        assert r.pair_match == max(run(r.specific_ref, r.common), run(r.specific_alt, r.common)) and r.cohort_binding_check == "unavailable"
    # a variant at the candidate's place blocks all designs, one that no binding site holds none, and one of two bases counts to its end
    whole = lambda v: any(x <= v[0] + len(v[1]) - 1 and v[0] <= y for d in designs for x, y in d[5])
    for v in ((pos, "A"), (pos + 500, "A")):
        some, why = oligos.design(df, s, spark.createDataFrame([("c", *v)], "candidate_id string, v_pos long, v_ref string"), window=60)
        hit = why.where("reason = 'cohort_variant_in_binding_site'").first()
        assert (hit.n if hit else 0) == (len(designs) if whole(v) else 0)
        assert {r.cohort_binding_check for r in some.collect()} <= {"checked_within_context_window", "partial_window_unverified"}


def test_primer_reasons_and_settings(spark, tmp_path):
    s = oligos.Settings()
    seq = "ACGT" * 30
    rows = [("a", 61, "A", "AC", "+", seq, 60, 1, 120), ("b", 61, "A", "C", "+", seq[:-1] + "N", 60, 1, 120), ("c", 5, "A", "C", "+", seq, 4, 1, 120), ("d", 61, "A", "C", "+", seq, 60, 1, 120), ("e", 30, "C", "A", "+", "AAGCTTCGATCGTACGGATCATGCAAGTC" + "CTTGCA" * 4, 29, 1, 53)]
    designs, reasons = oligos.design(spark.createDataFrame(rows, ONE), s)
    got = {r.candidate_id: r.rejections for r in oligos.reason_text(reasons).collect()}
    assert got["a"] == "not_biallelic_snp:1" and got["b"] == "ambiguous_flanking_bases:1" and got["c"] == "insufficient_flanks:1" and "self_complementarity_screen" in got["d"]
    assert set(got) == {"a", "b", "c", "d", "e"} and designs.count() == 0
    marked = oligos.markers(spark.createDataFrame(rows, ONE).select("candidate_id"), designs, reasons).collect()
    assert all(r.design_count == 0 and r.validation_state == "not_designed" for r in marked)
    with pytest.raises(Exception, match="disagree for x"):
        oligos.design(spark.createDataFrame([("x", 61, "C", "A", "+", seq, 60, 1, 120)], ONE), s)[1].collect()
    path = tmp_path / "p.toml"
    path.write_text("schema_version = 1\n[primer]\nmin_tm_C = 50\nmax_product_bp = 150\n")
    assert oligos.load_settings(str(path)) == oligos.Settings(min_tm_C=50, max_product_bp=150)
    for text in ("schema_version = 2\n[primer]\n", "schema_version = 1\n[primer]\nodd = 1\n", "schema_version = 1\n[primer]\nmin_length = 0\n", "schema_version = 1\n[primer]\nmin_length = 30\nmax_length = 20\n", "schema_version = 1\n[primer]\nmin_length = true\n", "schema_version = 1\n[primer]\nalternatives = 101\n", "schema_version = 1\n[primer]\nmin_tm_C = nan\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            oligos.load_settings(str(path))


def test_review_rules(spark):
    numbers = {"design_id": "d", "n_sample_attempts": 50, "n_samples": 40, "n_comparable_samples": 40, "n_comparable_replicated_samples": 5, "call_rate": 0.99, "complete_sample_call_rate": 0.99, "concordance": 0.99, "n_replicate_disagreements": 0, "n_failed_controls": 0, "n_incomplete_control_plates": 0}
    df = spark.createDataFrame([numbers, {**numbers, "design_id": "e", "concordance": 0.5, "n_failed_controls": 1}, {**numbers, "design_id": "f", "n_sample_attempts": 0}])
    got = {r.design_id: r for r in assays.review(df, META).collect()}
    assert got["d"].state == "assay_validated" and got["d"].acceptance == "accepted"
    assert got["e"].reasons == "insufficient_concordance;n_failed_controls" and got["e"].state == "computational_candidate"
    assert got["f"].acceptance == "not_assessed"
    up = {**META, "requested_state": "population_validated"}
    r = assays.review(df, up).where("design_id = 'd'").first()
    assert (r.state, r.acceptance, r.reasons) == ("assay_validated", "rejected_requested_state", "prior_assay_validation_required")
    before = spark.createDataFrame([("d", "assay_validated", "", "measured", "d0")], "design_id string, previous_state string, previous_simulated_state string, previous_scope string, previous_dataset string")
    assert assays.review(df, up, before).where("design_id = 'd'").first().state == "population_validated"
    r = assays.review(df, {**META, "data_scope": "synthetic"}).where("design_id = 'd'").first()
    assert r.state == "computational_candidate" and r.simulated_state == "assay_validated" and r.reasons.endswith(";synthetic_only_not_operational_validation")
    assert {r.state: r.n for r in assays.state_counts(assays.review(df, META)).collect()} == {"computational_candidate": 2, "assay_validated": 1, "population_validated": 0}


def test_stream(spark, tmp_path):
    good = dict(zip(["chr", "rs", "pos", "n_miss", "allele1", "allele0", "af", "beta", "se", "logl_H1", "l_remle", "l_mle", "p_wald", "pval", "p_score"], ["Chr1", ".", "5", "0", "A", "G", "0.3", "1", "1", "1", "1", "1", "0.1", "0.1", "0.1"]))
    rows = [{**good, "k": 1}, {**good, "k": 1}, {**good, "k": 2, "af": "7"}, {**good, "k": 3}]
    df = spark.createDataFrame(rows).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = streams.valid_rows(stream, ["k"]).writeStream.format("memory").queryName("valid").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.k for r in spark.sql("select k from valid").collect()) == [1, 3]
    q = streams.counts(stream, ["chr"]).writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.sql("select n from counted").collect()] == [4]
    typed = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withColumns({"pval": F.col("pval").cast("double"), "dataset_id": F.lit("d")})
    q = typed.writeStream.foreachBatch(streams.adjust_batches(str(tmp_path / "out"), ["dataset_id"])).option("checkpointLocation", str(tmp_path / "c3")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).where("n_tests = 4").count() == 4


def test_redesign_history(spark):
    one = spark.createDataFrame([("d1", "c", "A", "G"), ("d2", "c", "A", "T")], "design_id string, candidate_id string, ref string, alt string")
    two = spark.createDataFrame([("e1", "c", "A", "G"), ("d1", "c", "A", "G")], one.schema)
    edges = spark.createDataFrame([("d1", "e1", "c"), ("d2", "e1", "c"), ("d9", "e1", "c"), ("d1", "d1", "c"), ("d1", "e1", "z")], "prior_design_id string, replacement_design_id string, candidate_id string")
    got = {(r.prior_design_id, r.replacement_design_id, r.candidate_id): r.reason for r in assays.history_violations(edges, one, two).collect()}
    assert got == {("d1", "e1", "c"): "repeated edge", ("d2", "e1", "c"): "candidate or alleles change", ("d9", "e1", "c"): "not a previous design and a distinct known replacement", ("d1", "d1", "c"): "not a previous design and a distinct known replacement", ("d1", "e1", "z"): "candidate or alleles change"}
