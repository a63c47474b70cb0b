"""Commands over declared inputs: a manifest's datasets and the regions of one of them."""

import random

import pytest

from sorrel.__main__ import main
from sorrel.operators.contract import COLUMNS
from sorrel.sources import declared
from sorrel.sources.readers import checksum

REGION = '[[regions]]\nregion_id = "{i}"\nchrom = "{c}"\nstart = {s}\nend = {e}\ntitle = "t"\noutput_filename = "{f}"\n'


def regions(path, *changes, head='config_schema_version = 1\ndataset_id = "one"\n'):
    path.write_text(head + "".join(REGION.format(**{"i": f"r{k}", "c": "Chr01", "s": 1, "e": 9000, "f": f"r{k}.png"} | x) for k, x in enumerate(changes)))
    return str(path)


@pytest.fixture
def data(tmp_path):
    tmp_path = tmp_path / "data"
    tmp_path.mkdir()
    rnd = random.Random(6)
    sets = ""
    for name in ("one", "two"):
        rows = [[f"Chr{rnd.randint(1, 3):02d}", ".", str(1000 + 37 * i), "0", "A", "G", "0.3", "0.5", "0.1", "1", "1", "1", "0.5", f"{rnd.random():.6g}", "0.5"] for i in range(120)]
        path = tmp_path / f"{name}.tsv"
        path.write_text("\n".join("\t".join(r) for r in [list(COLUMNS), *rows]) + "\n")
        sets += f'[[datasets]]\ndataset_id = "{name}"\nreference = "r"\ntrait = "{name}_trait"\nmember_filename = "{name}.tsv"\nmember_sha256 = "{checksum(str(path))}"\nrow_count = 120\n'
    (tmp_path / "m.toml").write_text('schema_version = 1\n[pvalue_columns]\nprimary = "pval"\n' + sets)
    return tmp_path


def test_manifest(spark, data):
    args = ["--manifest", f"{data}/m.toml", "--data", str(data)]
    assert main(["validate", *args, "--out", f"{data.parent}/v"]) == 0
    assert main(["diagnostics", *args, "--dataset", "two", "--out", f"{data.parent}/d"]) == 0
    assert [x.split("\t")[0] for x in (data.parent / "d/diagnostics.tsv").read_text().splitlines()[1:]] == ["two"]
    assert main(["diagnostics", *args, "--dataset", "three", "--out", f"{data.parent}/x"]) == 1
    assert main(["diagnostics", *args, "--table", "a=b", "--out", f"{data.parent}/x"]) == 1 and main(["diagnostics", "--out", f"{data.parent}/x"]) == 1
    (data / "two.tsv").write_text((data / "two.tsv").read_text().replace("0.3", "0.4"))
    assert main(["validate", *args, "--out", f"{data.parent}/w"]) == 1 and main(["diagnostics", *args, "--out", f"{data.parent}/x"]) == 1


def test_regional(spark, data):
    args = ["regional", "--manifest", f"{data}/m.toml", "--data", str(data), "--dataset", "one"]
    path = regions(data.parent / "r.toml", {}, {"c": "Chr02", "e": 3000})
    assert main([*args, "--regions", path, "--out", f"{data.parent}/o"]) == 0
    got = spark.read.parquet(f"{data.parent}/o/regional")
    assert {r.region_id for r in got.select("region_id").distinct().collect()} == {"r0", "r1"} and got.where("region_id = 'r1' and (chr != 'Chr02' or pos > 3000)").count() == 0
    assert len((data.parent / "o/top_variants_by_region.tsv").read_text().splitlines()) == 3
    assert main([*args, "--regions", regions(data.parent / "r.toml", {"c": "Chr09"}), "--out", f"{data.parent}/p"]) == 1 and not (data.parent / "p").exists()


@pytest.mark.parametrize("change", [{"i": "a-b"}, {"s": 0}, {"s": 5, "e": 4}, {"f": "a.pdf"}, {"f": "../a.png"}, {"f": "/a.png"}, {"f": "a\\\\b.png"}, {"c": ""}, {"s": '"1"'}])
def test_broken_regions(spark, tmp_path, change):
    assert declared.load_region_config(spark, regions(tmp_path / "r.toml", {}), "one").count() == 1
    with pytest.raises(declared.SchemaError):
        declared.load_region_config(spark, regions(tmp_path / "r.toml", change), "one")


def test_broken_region_documents(spark, tmp_path):
    for text, name in ((("config_schema_version = 2\n"), "one"), ("config_schema_version = 1\n", "two"), ("", "one")):
        with pytest.raises(declared.SchemaError):
            declared.load_region_config(spark, regions(tmp_path / "r.toml", {}, head=text + 'dataset_id = "one"\n'), name)
    for rows in ((), ({}, {"i": "r0"}), ({}, {"f": "r0.png"})):
        with pytest.raises(declared.SchemaError):
            declared.load_region_config(spark, regions(tmp_path / "r.toml", *rows), "one")
