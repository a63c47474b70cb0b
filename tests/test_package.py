"""The package that is handed on: what it holds, and what each disagreement among a batch's tables does."""

import json
import random
import shutil
from pathlib import Path

import pytest

from sorrel.__main__ import main
from sorrel.operators import reports
from sorrel.operators.contract import COLUMNS, ContractError, DuplicateError, SchemaError
from sorrel.plans import jobs
from sorrel.sources import readers, writers
from sorrel.sources.readers import checksum

REGION = 'config_schema_version = 1\ndataset_id = "one"\n[[regions]]\nregion_id = "a"\nchrom = "Chr01"\nstart = 1\nend = 9000\ntitle = "t"\noutput_filename = "a.png"\n'


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    """A batch of three datasets by a manifest, of which the last has no discovery."""
    root = tmp_path_factory.mktemp("batch") / "data"
    root.mkdir()
    rnd, sets = random.Random(4), ""
    for name in ("one", "two", "none"):
        rows = [[f"Chr{rnd.randint(1, 3):02d}", ".", str(1000 + 37 * i), "0", "A", "G", "0.3", f"{rnd.uniform(-1, 1):.6g}", "0.1", "1", "1", "1", "0.5", f"{0.2 + 0.8 * rnd.random() if name == 'none' or i % 10 else rnd.random() * 1e-9:.6g}", "0.5"] for i in range(150)]
        (root / f"{name}.tsv").write_text("\n".join("\t".join(r) for r in [list(COLUMNS), *rows]) + "\n")
        sets += f'[[datasets]]\ndataset_id = "{name}"\nreference = "r"\ntrait = "{name}_trait"\nmember_filename = "{name}.tsv"\nmember_sha256 = "{checksum(str(root / f"{name}.tsv"))}"\nrow_count = 150\n'
    (root / "m.toml").write_text('schema_version = 1\n[pvalue_columns]\nprimary = "pval"\n' + sets)
    assert main(["batch", "--manifest", f"{root}/m.toml", "--data", str(root), "--distance", "100", "--out", f"{root.parent}/out"]) == 0
    return root.parent / "out"


def test_contents(spark, batch, tmp_path):
    assert main(["package", "--batch", str(batch), "--require-provenance", "--out", f"{tmp_path}/p"]) == 0
    m = json.loads((tmp_path / "p/reproducibility/run_manifest.json").read_text())
    assert m["parameters"] == {"alpha": 0.05, "fdr_level": 0.05, "clustering_distance": 100}
    by = {d["dataset_id"]: d for d in m["datasets"]}
    assert (by["one"]["n_candidates"], by["none"]["n_candidates"]) == (15, 0) and by["two"]["trait"] == "two_trait" and by["one"]["n_tests"] == 150
    on_disk = {str(p.relative_to(tmp_path / "p")) for p in (tmp_path / "p").rglob("*") if p.is_file()}
    listed = {a["relative_path"]: a for a in m["artifacts"]}
    assert on_disk == set(listed) | {"reproducibility/run_manifest.json", "provenance.json"}
    assert all(checksum(str(tmp_path / "p" / k)) == a["sha256"] and (tmp_path / "p" / k).stat().st_size == a["bytes"] for k, a in listed.items())
    assert {a["role"] for a in listed.values()} == {"batch_summary", "diagnostics", "association_peaks", "candidate_ranking", "candidate_snps", "significant_variants", "manhattan", "qq", "provenance.json", "report"}
    assert spark.read.parquet(f"{tmp_path}/p/artifacts/manhattan").count() == 450
    short, long = ((tmp_path / "p" / x).read_text() for x in ("executive_summary.md", "analysis_report.md"))
    assert short.count("one_peak_") == 3 and long.count("one_peak_") == 10 and "12 more" in short and "5 more" in long and "No variant passes" in short
    sums = dict(x.split("\t") for x in (tmp_path / "p/reproducibility/input_checksums.tsv").read_text().splitlines()[1:])
    assert sums == {n: checksum(str(batch.parent / "data" / f"{n}.tsv")) for n in ("one", "two", "none")}
    assert json.loads((tmp_path / "p/reproducibility/software_versions.json").read_text())["analysis"]["packages"]["pyspark"]


def test_same_twice(spark, batch, tmp_path):
    for x in "ab":
        jobs.package(spark, batch, tmp_path / x)
    assert writers.manifest(tmp_path / "a") == writers.manifest(tmp_path / "b")


def edited(folder: Path, name: str, change):
    """Replace the lines of a table, or of each part of one."""
    for path in [folder / name] if (folder / name).is_file() else sorted((folder / name).glob("part-*")):
        head, *rows = [x.split("\t") for x in path.read_text().splitlines()]
        rows = [r for r in (change(dict(zip(head, r, strict=True))) for r in rows) if r]
        path.write_text("".join("\t".join(x) + "\n" for x in [head, *([str(r[c]) for c in head] for r in rows)]))


@pytest.mark.parametrize(
    "name,change,error,message",
    [
        ("batch_summary.tsv", lambda r: r | {"n_bh": int(r["n_bh"]) + 1}, ContractError, "n_bh"),
        ("batch_summary.tsv", lambda r: r | {"lambda_gc": float(r["lambda_gc"]) * 1.001}, ContractError, "lambda_gc"),
        ("batch_summary.tsv", lambda r: r | {"alpha": 0.01 if r["dataset_id"] == "two" else 0.05}, ContractError, "one set of parameters"),
        ("batch_summary.tsv", lambda r: r | {"dataset_id": "one"}, DuplicateError, "summed up more than once"),
        ("batch_summary.tsv", lambda r: r if r["dataset_id"] != "two" else None, ContractError, "two, .*foreign_rows"),
        ("diagnostics.tsv", lambda r: r if r["dataset_id"] != "none" else None, ContractError, "none, diagnostics, rows"),
        ("diagnostics.tsv", lambda r: r | {"source_sha256": "0" * 64}, ContractError, "source_sha256"),
        ("diagnostics.tsv", lambda r: r | {"n_bonferroni": 0}, ContractError, "one, diagnostics, n_bonferroni"),
        ("association_peaks.tsv", lambda r: r | {"n_variants": 9}, ContractError, "n_variants"),
        ("association_peaks.tsv", lambda r: r | {"trait": "other"}, ContractError, "one, peaks, trait"),
        ("candidate_snps.tsv", lambda r: r | {"signal_id": "lost"}, ContractError, "one, members, unknown_signals"),
        ("candidate_snps.tsv", lambda r: r if r["pos"] != "1000" else None, ContractError, "members, rows"),
        ("significant_variants.tsv", lambda r: r if r["pos"] != "1000" else None, ContractError, "significant, rows"),
        ("candidate_ranking.tsv", lambda r: r | {"candidate_rank": int(r["candidate_rank"]) + 1}, ContractError, "dense_ranks"),
        ("candidate_ranking.tsv", lambda r: r | {"reference": ""}, ContractError, "one, ranks, reference"),
        ("candidate_ranking.tsv", lambda r: r | {"pos": 7, "chr": "Chr01"}, DuplicateError, "in ranks"),
        ("candidate_ranking.tsv", lambda r: r | {"pos": int(r["pos"]) + 1}, ContractError, "no member"),
    ],
)
def test_disagreements(spark, batch, tmp_path, name, change, error, message):
    shutil.copytree(batch, tmp_path / "b", ignore=shutil.ignore_patterns("*.crc"))
    edited(tmp_path / "b", name, change)
    with pytest.raises(ValueError, match="differ from the manifest"):
        jobs.package(spark, tmp_path / "b", tmp_path / "p")
    (tmp_path / "b/provenance.json").unlink()
    with pytest.raises(error, match=message):
        jobs.package(spark, tmp_path / "b", tmp_path / "p")


def test_refused(spark, batch, tmp_path):
    shutil.copytree(batch, tmp_path / "b", ignore=shutil.ignore_patterns("*.crc", "provenance.json"))
    with pytest.raises(ContractError, match="provenance"):
        jobs.package(spark, tmp_path / "b", tmp_path / "p", need_provenance=True)
    jobs.package(spark, tmp_path / "b", tmp_path / "q")
    assert json.loads((tmp_path / "q/reproducibility/software_versions.json").read_text())["analysis"] is None
    path = tmp_path / "b/batch_summary.tsv"
    path.write_text("\n".join(x.rsplit("\t", 1)[0] for x in path.read_text().replace("clustering_distance", "other").splitlines()) + "\n")
    with pytest.raises(SchemaError, match="clustering_distance"):
        jobs.package(spark, tmp_path / "b", tmp_path / "r")


def test_copied(spark, tmp_path):
    (tmp_path / "s/t").mkdir(parents=True)
    for name in ("a.tsv", "t/part-0", "t/_SUCCESS", "t/.x.crc", "other.tsv"):
        (tmp_path / "s" / name).write_text(name)
    got = writers.copied(spark, tmp_path / "s", tmp_path / "o", ("t", "a.tsv"))
    assert [(r["relative_path"], r["bytes"]) for r in got] == [("a.tsv", 5), ("t/part-0", 8)]
    assert writers.manifest(tmp_path / "o") == {r["relative_path"]: r["sha256"] for r in got}
    assert writers.copied(spark, tmp_path / "s", tmp_path / "o", ("t", "a.tsv")) == got
    with pytest.raises(FileNotFoundError):
        writers.copied(spark, tmp_path / "s", tmp_path / "o", ("b.tsv",))
    (tmp_path / "s/link.tsv").symlink_to(tmp_path / "s/a.tsv")
    for name in ("link.tsv", "../s/a.tsv", "/etc/hostname"):
        with pytest.raises(ValueError):
            writers.copied(spark, tmp_path / "s", tmp_path / "o", (name,))


def test_preview_and_uneven(spark):
    kind = "dataset_id string, chr string, pos long, allele1 string, allele0 string"
    ranks = spark.createDataFrame([("a", "1", 5, "A", "C", 1), ("a", "1", 6, "A", "C", 2), ("a", "1", 7, "A", "C", 3)], kind + ", candidate_rank int").selectExpr("*", "1 as priority_tier", "'s' as signal_id", "'x' as priority_reasons")
    members = spark.createDataFrame([("a", "1", 5, "A", "C", 0.1, 2.0), ("a", "1", 5, "A", "C", 0.1, 1.0), ("b", "1", 6, "A", "C", 0.2, 1.0)], kind + ", pval double, beta double")
    got = [(r.candidate_rank, r.n_matches, r.pval, r.beta) for r in reports.preview(ranks, members, 2).orderBy("candidate_rank").collect()]
    assert got == [(1, 2, 0.1, 1.0), (2, 0, None, None)]
    assert [(r.pos, r.n) for r in reports.repeated(members).collect()] == [(5, 2)]
    s = spark.createDataFrame([(1, 0.5, None, "x"), (2, 0.5, None, None)], "a int, b double, c string, d string")
    assert sorted(tuple(r) for r in reports.uneven(s, ("a", "b", "c", "d")).collect()) == [("a", 2), ("d", 2)]


def test_plot_commands(spark, batch, tmp_path):
    args = ["--manifest", f"{batch.parent}/data/m.toml", "--data", f"{batch.parent}/data", "--dataset", "one"]
    (tmp_path / "r.toml").write_text(REGION)
    assert main(["manhattan", *args, "--out", f"{tmp_path}/m"]) == 0 and main(["qq", *args, "--out", f"{tmp_path}/q"]) == 0
    assert spark.read.parquet(f"{tmp_path}/m/manhattan").count() == 150 and not (tmp_path / "m/qq").exists() and (tmp_path / "q/qq").exists()
    assert main(["all", *args, "--regions", f"{tmp_path}/r.toml", "--out", f"{tmp_path}/all"]) == 0
    assert {p.name for p in (tmp_path / "all").iterdir()} >= {"manhattan", "qq", "regional", "top_variants_by_region.tsv"}
    assert main(["regional", *args, "--chrom", "Chr02", "--start", "1000", "--end", "3000", "--out", f"{tmp_path}/one"]) == 0
    got = spark.read.parquet(f"{tmp_path}/one/regional")
    assert got.count() > 5 and got.where("chr != 'Chr02' or pos not between 1000 and 3000").count() == 0
    for odd in (["--chrom", "Chr02"], ["--chrom", "Chr02", "--start", "5", "--end", "4"], ["--chrom", "Chr02", "--start", "1", "--end", "4", "--regions", f"{tmp_path}/r.toml"], ["--chrom", "Chr09", "--start", "1", "--end", "4"]):
        assert main(["regional", *args, *odd, "--out", f"{tmp_path}/odd"]) == 1


def test_reference_command(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">c1\nACGTAC\nGT\n")
    (tmp_path / "a.fa.fai").write_text("c1\t8\t4\t6\t7\n")
    text = 'schema_version = 1\nreference = "r"\nassembly_id = "v1"\nspecies = "s"\nsource = "made"\nlicense = "none"\ndata_scope = "synthetic"\ndataset_ids = ["one"]\n'
    text += "".join(f'[{role}]\npath = "{n}"\nassembly_id = "v1"\nsha256 = "{checksum(str(tmp_path / n))}"\n' for role, n in (("fasta", "a.fa"), ("fai", "a.fa.fai")))
    (tmp_path / "b.toml").write_text(text)
    args = ["reference", "--bundle", f"{tmp_path}/b.toml", "--assembly-id", "v1", "--reference", "r", "--dataset-id"]
    assert main([*args, "one", "--out", f"{tmp_path}/o"]) == 0 and main([*args, "two", "--out", f"{tmp_path}/x"]) == 1
    got = json.loads((tmp_path / "o/reference.json").read_text())
    assert got["contigs"] == [{"name": "c1", "length": 8, "offset": 4, "line_bases": 6, "line_bytes": 7}] and set(got["checksums"]) == {"fasta", "fai"}


def test_fasta(spark, tmp_path):
    rnd = random.Random(1)
    want = {f"s{i:03d}": "".join(rnd.choice("ACGT") for _ in range(rnd.choice([1, 59, 60, 61, 361]))) for i in range(200)}
    path = tmp_path / "f.fasta"
    writers.write_fasta(spark.createDataFrame(list(want.items()), "name string, sequence string").repartition(7), str(path), "name", "sequence")
    assert path.read_text() == "".join(f">{k}\n" + "".join(x[i : i + 60] + "\n" for i in range(0, len(x), 60)) for k, x in sorted(want.items()))
    assert {r.name: r.sequence for r in readers.fasta_records(spark, str(path)).collect()} == want and [p.name for p in tmp_path.iterdir()] == ["f.fasta"]
    writers.write_fasta(spark.createDataFrame([], "name string, sequence string"), str(tmp_path / "e.fasta"), "name", "sequence")
    assert (tmp_path / "e.fasta").read_text() == ""
