import json
import random

import pytest

from sorrel.__main__ import main
from sorrel.operators.contract import COLUMNS


@pytest.fixture
def tables(tmp_path):
    rnd = random.Random(6)
    out = []
    for name in ("one", "two"):
        rows = [[f"Chr{rnd.randint(1, 3):02d}", ".", str(1000 + 37 * i), "0", "A", "G", "0.3", f"{rnd.uniform(-1, 1):.6g}", "0.1", "1", "1", "1", "0.5", f"{rnd.random() if i % 40 else rnd.random() * 1e-9:.6g}", "0.5"] for i in range(200)]
        (tmp_path / f"{name}.tsv").write_text("\n".join("\t".join(r) for r in [list(COLUMNS), *rows]) + "\n")
        out += ["--table", f"{name}={tmp_path}/{name}.tsv"]
    return out


def lines(path):
    return [x.split("\t") for x in path.read_text().splitlines()]


def test_batch_and_report(spark, tmp_path, tables):
    out = tmp_path / "out"
    assert main(["batch", *tables, "--distance", "100", "--out", str(out)]) == 0
    summary = lines(out / "batch_summary.tsv")
    assert len(summary) == 3 and summary[1][0] == "one"
    assert len(lines(out / "candidate_ranking.tsv")) > 5 and spark.read.parquet(str(out / "manhattan")).count() == 400
    assert main(["report", "--batch", str(out), "--out", str(tmp_path / "report")]) == 0
    assert set(json.loads((tmp_path / "report/manifest.json").read_text())) == {"batch_summary.tsv", "association_peaks.tsv", "candidate_ranking.tsv", "report.md"}
    assert main(["batch", *tables, "--distance", "100", "--out", str(out)]) == 1
    ranking = out / "candidate_ranking.tsv"
    ranking.write_text("\n".join(ranking.read_text().splitlines()[:-1]) + "\n")
    assert main(["report", "--batch", str(out), "--out", str(tmp_path / "again")]) == 1 and not (tmp_path / "again").exists()


def test_validate(spark, tmp_path, tables):
    assert main(["validate", *tables, "--rows", "one=200", "--rows", "two=201", "--out", str(tmp_path / "v")]) == 1
    found = json.loads((tmp_path / "v/validation.json").read_text()) if (tmp_path / "v").exists() else {}
    assert found["one"]["ok"] and not found["two"]["ok"] and "RowCountError" in found["two"]["error"]


def test_regions(spark, tmp_path, tables):
    (tmp_path / "r.toml").write_text('[[regions]]\nregion_id = "b"\nchrom = "Chr02"\nstart = 1\nend = 9000\ntitle = "t"\n[[regions]]\nregion_id = "a"\nchrom = "Chr01"\nstart = 1\nend = 9000\ntitle = "t"\n')
    assert main(["top-variants", *tables, "--regions", str(tmp_path / "r.toml"), "--out", str(tmp_path / "o")]) == 0
    assert [r[1] for r in lines(tmp_path / "o/top_variants_by_region.tsv")[1:]] == ["b", "a", "b", "a"]


def test_customer_context_and_primers(spark, tmp_path):
    rnd = random.Random(2)
    seq = "".join(rnd.choice("ACGT") for _ in range(700))
    (tmp_path / "r.fa").write_text(">chrA\n" + "\n".join(seq[i : i + 60] for i in range(0, 700, 60)) + "\n")
    other = {"A": "C", "C": "G", "G": "T", "T": "A"}
    rows = [["chrA", str(p), seq[p - 1], other[seq[p - 1]], seq[p - 1], other[seq[p - 1]], "2", "0.5", "1e-400" if p == 350 else "0.5", "20"] for p in (300, 350, 420)]
    (tmp_path / "s.tsv").write_text("\n".join("\t".join(r) for r in [["C", "BP", "R", "A", "EA", "OA", "B", "SE", "P", "N"], *rows]) + "\n")
    (tmp_path / "c.toml").write_text("\n".join(f'{k} = "{v}"' for k, v in {"chr": "C", "pos": "BP", "ref": "R", "alt": "A", "effect_allele": "EA", "other_allele": "OA", "effect": "B", "standard_error": "SE", "pvalue": "P", "sample_size": "N"}.items()))
    assert main(["customer-summary", "--table", f"{tmp_path}/s.tsv", "--fasta", f"{tmp_path}/r.fa", "--columns", f"{tmp_path}/c.toml", "--distance", "10", "--out", f"{tmp_path}/sum"]) == 0
    assert len(lines(tmp_path / "sum/candidate_ranking.tsv")) == 2
    (tmp_path / "k.tsv").write_text("candidate_id\tchr\tpos\tref\talt\tstrand\n" + "".join(f"k{s}\tchrA\t350\t{seq[349]}\t{other[seq[349]]}\t{s}\n" for s in "+-"))
    (tmp_path / "v.vcf").write_text(f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nchrA\t360\t.\t{seq[359]}\t{other[seq[359]]}\t.\tPASS\t.\n")
    (tmp_path / "m.bed").write_text("chrA\t100\t180\n")
    assert main(["context", "--candidates", f"{tmp_path}/k.tsv", "--fasta", f"{tmp_path}/r.fa", "--vcf", f"{tmp_path}/v.vcf", "--mask", f"{tmp_path}/m.bed", "--primers", "--out", f"{tmp_path}/ctx"]) == 0
    head, *got = lines(tmp_path / "ctx/candidate_context.tsv")
    got = [dict(zip(head, r)) for r in got]
    assert [(r["snp_offset"], r["mask_overlap"], r["neighbor_count"]) for r in got] == [("180", "True", "1")] * 2
    assert got[0]["sequence"] == seq[169:530] and got[1]["sequence"] == seq[169:530][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert (tmp_path / "ctx/designs.tsv").exists()
    (tmp_path / "k.tsv").write_text(f"candidate_id\tchr\tpos\tref\talt\tstrand\nk\tchrA\t350\t{other[seq[349]]}\t{seq[349]}\t+\n")
    assert main(["context", "--candidates", f"{tmp_path}/k.tsv", "--fasta", f"{tmp_path}/r.fa", "--out", f"{tmp_path}/bad"]) == 1


def test_individual_gwas(spark, tmp_path):
    rnd = random.Random(9)
    ids = ["001", "NA", *(f"s{i}" for i in range(38))]
    g = {i: [rnd.randint(0, 2) for _ in range(8)] for i in ids}
    (tmp_path / "g.tsv").write_text("\t".join(["sample_id", *(f"m{j}" for j in range(8))]) + "\n" + "".join("\t".join([i, *map(str, g[i])]) + "\n" for i in ids))
    (tmp_path / "p.tsv").write_text("sample_id\tvalue\tage\n" + "".join(f"{i}\t{g[i][2] * 3 + rnd.gauss(0, 1):.5f}\t{rnd.randint(1, 9)}\n" for i in reversed(ids)))
    assert main(["individual-gwas", "--genotypes", f"{tmp_path}/g.tsv", "--phenotype", f"{tmp_path}/p.tsv", "--covariate", "age", "--out", f"{tmp_path}/o"]) == 0
    head, *rows = lines(tmp_path / "o/associations.tsv")
    best = max(rows, key=lambda r: float(r[head.index("neg_log10_pvalue")] or 0))
    assert len(rows) == 8 and best[head.index("marker_id")] == "m2"
