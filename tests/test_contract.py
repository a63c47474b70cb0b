import pytest
from pyspark.sql import functions as F

from sorrel.operators import contract, customer
from sorrel.sources import readers, writers

HEADER = "\t".join(contract.COLUMNS)
ROWS = [
    ["Chr01", ".", "1000", "0", "A", "G", "0.30", "0.05", "0.01", "-1", "1", "1", "1e-3", "1e-4", "1e-5"],
    ["Chr01", ".", "2000", "0", "C", "T", "0.45", "-0.02", "0.02", "-1", "1", "1", "5e-2", "4e-2", "3e-2"],
    ["Chr02", ".", "1500", "1", "T", "A", "0.10", "0.11", "0.03", "-1", "1", "1", "9e-3", "8e-3", "7e-3"],
]


def written(tmp_path, rows, header=HEADER):
    path = tmp_path / "a.txt"
    path.write_text("\n".join([header, *("\t".join(r) for r in rows)]) + "\n")
    return str(path)


def check(spark, tmp_path, rows, expected=None):
    return contract.validate(readers.associations(spark, written(tmp_path, rows)), list(contract.COLUMNS), expected)


def changed(column, value, row=0):
    out = [list(r) for r in ROWS]
    out[row][contract.COLUMNS.index(column)] = value
    return out


def test_good(spark, tmp_path):
    assert check(spark, tmp_path, ROWS, 3) == 3
    rows = readers.analysis(readers.associations(spark, written(tmp_path, ROWS))).orderBy("src_row").collect()
    assert [(r.chr, r.pos, r.pval, r.src_row) for r in rows] == [("Chr01", 1000, 1e-4, 1), ("Chr01", 2000, 4e-2, 2), ("Chr02", 1500, 8e-3, 3)]


@pytest.mark.parametrize(("column", "value"), [("af", "1.10"), ("af", "-0.10"), ("pos", "abc"), ("pos", "0"), ("pos", "+5"), ("pos", "--5"), ("n_miss", "-1"), ("n_miss", "1.5"), ("pval", "1.5"), ("pval", "0"), ("beta", "inf"), ("se", "-1"), ("beta", "1d"), ("chr", " "), ("allele0", "")])
def test_bad_value(spark, tmp_path, column, value):
    with pytest.raises(contract.RowError, match=f"row 1, column {column}"):
        check(spark, tmp_path, changed(column, value))


def test_other_failures(spark, tmp_path):
    with pytest.raises(contract.DuplicateError, match="rows 1 and 2"):
        check(spark, tmp_path, [ROWS[0], [*ROWS[0][:2], "01000", *ROWS[0][3:]]])
    with pytest.raises(contract.RowCountError):
        check(spark, tmp_path, ROWS, 4)
    with pytest.raises(contract.SchemaError):
        readers.associations(spark, written(tmp_path, ROWS, HEADER.replace("\taf", "")))
    with pytest.raises(contract.RowError, match="row 2 has another number"):
        check(spark, tmp_path, [ROWS[0], ROWS[1][:-1], ROWS[2]])
    # the first broken row wins over a later repeat, and the other way around
    with pytest.raises(contract.RowError):
        check(spark, tmp_path, changed("af", "2") + [ROWS[1]])
    with pytest.raises(contract.DuplicateError):
        check(spark, tmp_path, [ROWS[0], ROWS[0], *changed("af", "2", 2)[2:]])


def test_first_rule_wins(spark, tmp_path):
    rows = [list(r) for r in ROWS]
    for c in ("af", "pos", "p_wald"):
        rows[0][contract.COLUMNS.index(c)] = "x"
    with pytest.raises(contract.RowError, match="column pos"):
        check(spark, tmp_path, rows)


def test_na_is_text(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('id\tv\n001\t"a ""b"""\nNA\t\n')
    got = readers.table(spark, str(path), ("id",)).orderBy("src_row").collect()
    assert [(r.id, r.v) for r in got] == [("001", 'a "b"'), ("NA", "")]


def test_source_rows_over_many_splits(spark, tmp_path):
    path = tmp_path / "big.tsv"
    path.write_text("i\n" + "".join(f"{i}\n" for i in range(30_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert readers.table(spark, str(path)).where(F.col("src_row") != F.col("i").cast("long") + 1).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


BASE = {"pos": "1", "ref": "A", "alt": "C", "effect_allele": "A", "other_allele": "C", "effect": "2", "standard_error": "0.5", "sample_size": "10", "frequency": "0.8", "pvalue": "0.01", "neg_log10": ""}


def normalised(spark, rows, **kw):
    return customer.normalise(spark.createDataFrame([{**BASE, **r, "i": i} for i, r in enumerate(rows)]), **kw).orderBy("i").collect()


def test_customer_alignment(spark):
    r = normalised(spark, [{}])[0]
    assert (r.beta, round(r.effect_allele_frequency, 9), r.effect_allele, r.effect_orientation, r.reason) == (-2.0, 0.2, "C", "aligned_to_ALT", None)
    unknown = normalised(spark, [{"effect_allele": "T", "other_allele": "G"}], strand_known=False)[0]
    assert unknown.reason is None and unknown.beta == 2.0 and unknown.effect_orientation == "unresolved_strand"
    assert normalised(spark, [{"effect": "1"}], odds_ratio=True)[0].beta == 0.0


def test_customer_reasons(spark):
    got = normalised(spark, [{"pvalue": "1e-400"}, {"pvalue": "0"}, {"pvalue": "0", "neg_log10": "500"}, {"pvalue": "0.01", "neg_log10": "2"}, {"pvalue": "0.01", "neg_log10": "2.1"}, {"sample_size": "0"}, {"standard_error": "0"}, {"frequency": "1.2"}, {"effect_allele": "G"}, {"ref": "AT"}])
    assert [r.reason is None for r in got] == [True, False, True, True, False, False, False, False, False, False]
    assert got[0].neg_log10_pvalue == 400 and got[2].neg_log10_pvalue == 500


def test_at_most(spark):
    assert contract.at_most(spark.range(3), 3, "rows").count() == 3
    with pytest.raises(contract.ContractError):
        contract.at_most(spark.range(4), 3, "rows")


def test_published(spark, tmp_path):
    with writers.published(str(tmp_path / "out")) as stage:
        writers.write_tsv(spark.createDataFrame([(2, 1.5e-14, None), (1, None, True)], "a int, b double, c boolean"), str(stage / "t.tsv"), ["a"])
    assert (tmp_path / "out/t.tsv").read_text() == "a\tb\tc\n1\t\tTrue\n2\t1.5e-14\t\n"
    with pytest.raises(FileExistsError), writers.published(str(tmp_path / "out")):
        pass
    with pytest.raises(RuntimeError), writers.published(str(tmp_path / "other")):
        raise RuntimeError
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    files = writers.manifest(tmp_path / "out")
    writers.verify(tmp_path / "out", files)
    (tmp_path / "out/t.tsv").write_text("x")
    with pytest.raises(ValueError, match="t.tsv"):
        writers.verify(tmp_path / "out", files)
    assert writers.run_identity("a", {"x": "1"}, {"p": 2})["run_id"] == writers.run_identity("a", {"x": "1"}, {"p": 2})["run_id"]
    with pytest.raises(ValueError, match="plain"):
        writers.safe_path(str(tmp_path), "../x")
    assert "| 1 | 2 |" in writers.markdown("t", {"s": spark.sql("select 1 as a, 2 as b")})
