import pytest
from pyspark.sql import functions as F

from sorrel.functions.text import natural_key
from sorrel.operators import contract, crossref, intervals, layout, reports, statistics
from sorrel.sources import readers


def test_disagreements(spark):
    def found(**change):
        t = {"summary": [("a", 100, 1.05, 2, 3), ("b", 50, 0.9, 0, 0)], "tests": [("a", 100, 1.05), ("b", 50, 0.9)], "peaks": [("a", "s1"), ("a", "s2")], "members": [("a", "s1"), ("a", "s1"), ("a", "s2")], "ranks": [("a", "s1", 1), ("a", "s1", 2), ("a", "s2", 3)]} | change
        kinds = {"summary": "dataset_id string, n_tests long, lambda_gc double, n_signals long, n_candidates long", "tests": "dataset_id string, n_tests long, lambda_gc double", "peaks": "dataset_id string, signal_id string", "members": "dataset_id string, signal_id string", "ranks": "dataset_id string, signal_id string, candidate_rank int"}
        return sorted((r.dataset_id, r.check) for r in reports.disagreements(*[spark.createDataFrame(t[k], kinds[k]) for k in ("summary", "tests", "peaks", "members", "ranks")]).collect())

    assert found() == []
    assert found(tests=[("a", 101, 1.05), ("b", 50, 0.9)]) == [("a", "n_tests")]
    assert found(tests=[("a", 100, 1.05 + 1e-7), ("b", 50, 0.9 + 1e-12)]) == [("a", "lambda_gc")]
    assert found(peaks=[("a", "s1")]) == [("a", "n_signals"), ("a", "unknown_signals")]
    assert found(ranks=[("a", "s1", 1), ("a", "s1", 2), ("a", "s2", 4)]) == [("a", "dense_ranks")]
    assert found(ranks=[("a", "s1", 1), ("a", "s1", 1), ("a", "s2", 3)]) == [("a", "dense_ranks")]
    assert found(members=[("a", "s1")]) == [("a", "n_members")]
    summary = spark.createDataFrame([("a", 2, 3), ("b", 0, 0)], "dataset_id string, n_signals long, n_candidates long")
    assert tuple(reports.totals(summary).first()) == (2, 2, 3)
    rows = spark.createDataFrame([("a", "r", "t"), ("a", "r", "u"), ("b", None, "t")], "dataset_id string, reference string, trait string")
    assert sorted(tuple(r) for r in reports.mixed(rows, {"reference": "r", "trait": "t"}).collect()) == [("a", "trait"), ("b", "reference")]


def test_levels_and_p_values(spark):
    for x in (0, -1, 1.5, True, "x", float("nan")):
        with pytest.raises(contract.ContractError):
            contract.unit_interval(alpha=x)
    contract.unit_interval(alpha=1)
    with pytest.raises(contract.ContractError):
        contract.unit_interval(closed=False, alpha=1)
    good = [(1, 0.5, "d"), (2, 1.0, "d")]
    kind = "src_row long, pval double, dataset_id string"
    assert statistics.adjust(spark.createDataFrame(good, kind)).count() == 2
    for x in (0.0, -0.1, 1.1, float("nan"), float("inf"), None):
        df = spark.createDataFrame([*good, (3, x, "d")], kind)
        assert [r.src_row for r in contract.p_violations(df, "pval").collect()] == [3]
        with pytest.raises(Exception, match="isn't a p-value"):
            statistics.adjust(df).collect()


@pytest.mark.parametrize(
    "name,text,message",
    [
        ("genes", "c1\tx\tgene\t1\t9\t.\t+\t.\n", "not a GFF"),
        ("genes", "c1\tx\tgene\t9\t1\t.\t+\t.\tID=a\n", "interval"),
        ("genes", "c1\tx\tgene\t1\tx\t.\t+\t.\tID=a\n", "interval"),
        ("genes", "c1\tx\tgene\t1\t9\t.\t=\t.\tID=a\n", "strand"),
        ("genes", "c1\tx\tgene\t1\t9\t.\t+\t.\tName=a\n", "no gene id"),
        ("genes", "##FASTA\n>c1\n", "embedded"),
        ("bed", "c1\t5\n", "not a BED"),
        ("bed", "c1\t5\t5\n", "interval"),
        ("vcf", "##reference=r\n#CHROM\tPOS\nc1\t5\t.\tA\tC\n", "not a VCF"),
        ("vcf", "##reference=r\n#CHROM\tPOS\nc1\t0\t.\tA\tC\t.\tPASS\t.\n", "position"),
        ("vcf", "##reference=r\nc1\t5\t.\tA\tC\t.\tPASS\t.\n", "header"),
    ],
)
def test_malformed_records(spark, tmp_path, name, text, message):
    path = tmp_path / "x.txt"
    path.write_text(text)
    with pytest.raises(Exception, match=message):
        getattr(readers, name)(spark, str(path)).collect()


def test_candidates_and_neighbours(spark):
    good = {"candidate_id": "c", "chr": "1", "pos": 5, "ref": "A", "alt": "C", "beta": "0.5", "se": "0.1", "neg_log10_pvalue": "3", "effect_orientation": "aligned_to_ALT", "effect_allele": "C", "other_allele": "A"}
    odd = {"none": {}, "empty": {"ref": ""}, "se": {"se": "0"}, "nan": {"beta": "nan"}, "way": {"effect_orientation": "odd"}, "alleles": {"effect_allele": "G"}, "turned": {"effect_allele": "G", "other_allele": "T", "effect_orientation": "unresolved_strand"}}
    rows = [good | {"candidate_id": k, "pos": i} | v for i, (k, v) in enumerate(odd.items())] + [good | {"candidate_id": "twice", "pos": 90}, good | {"candidate_id": "again", "pos": 90}]
    got = {r.candidate_id: r.reason for r in crossref.candidate_violations(spark.createDataFrame(rows)).collect()}
    assert got == {"empty": "a field is empty", "se": "invalid effect, standard error or p-value", "nan": "invalid effect, standard error or p-value", "way": "unknown effect orientation", "alleles": "effect alleles disagree with REF/ALT", "twice": "repeated candidate or variant", "again": "repeated candidate or variant"}
    c = spark.createDataFrame([("c", "1", 100)], "candidate_id string, chr string, pos long")
    v = spark.createDataFrame([("1", 95, "A", "C"), ("1", 96, "C", "G"), ("1", 97, "AN", "C"), ("1", 98, "A", "A"), ("1", 900, "N", "C")], "v_chr string, v_pos long, v_ref string, v_alt string")
    found = intervals.neighbour_violations(c, v, 10, F.lit("A")).collect()
    assert sorted((r.v_pos, r.reason) for r in found) == [(96, "REF isn't the sequence"), (97, "alleles are unsupported"), (98, "alleles are unsupported")]


def test_ranked(spark):
    names = [f"Chr{i % 13}" for i in range(200)] + ["scaffold", "Chr07"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string").repartition(5)
    got = {r.id: r.place for r in layout.ranked(df, [*natural_key("name"), F.col("id")], "place").collect()}
    want = [r.id for r in df.orderBy(*natural_key("name"), "id").collect()]
    assert [got[i] for i in want] == list(range(1, 203))
