"""FASTA files read by Spark, candidates held against their sequences, and families corrected over a stream."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sorrel.operators import statistics as st
from sorrel.operators.contract import ContractError
from sorrel.sources import readers
from sorrel.streaming import associations as streams


def test_contigs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "RANGE", 3)
    seq = {"chrA": "ACGTN" * 61 + "AC", "chr B": "GATTACA" * 9, "c": "A"}
    path = tmp_path / "r.fa"
    path.write_text("".join(f">{k} note\r\n" + "".join(v[i : i + 40] + "\r\n" for i in range(0, len(v), 40)) + "\n" for k, v in seq.items()))
    assert [tuple(r) for r in readers.fasta_contigs(spark, str(path)).orderBy("contig_no").collect()] == [("chrA", 1, 307, 40), ("chr", 2, 63, 40), ("c", 3, 1, 1)]
    chunks = {(r.contig, r.chunk_no): r.bases for r in readers.sequence_chunks(spark, str(path), 17).collect()}
    assert "".join(chunks["chrA", i] for i in range(19)) == seq["chrA"] and {len(chunks["chrA", i]) for i in range(18)} == {17}


@pytest.mark.parametrize(
    ("text", "reason"),
    [(">a\nACG\nA\nACG\n", "uneven"), (">a\nACG\nACGT\n", "uneven"), (">\nACG\n", "without a name"), ("ACG\n>a\nA\n", "outside"), (">a\nA\n>a x\nC\n", "more than once")],
)
def test_broken_sequences(spark, tmp_path, text, reason):
    (tmp_path / "r.fa").write_text(text)
    with pytest.raises(Exception, match=reason):
        readers.fasta_contigs(spark, str(tmp_path / "r.fa")).collect()


def test_candidates_and_sequences(spark, tmp_path):
    path = tmp_path / "f.fa"
    path.write_text(">k%201 chr=c\nACGT\nAC\n>k+2\nGGG\n")
    records = readers.fasta_records(spark, str(path))
    assert {r.name: r.sequence for r in records.collect()} == {"k 1": "ACGTAC", "k+2": "GGG"}
    sums = {"k 1": hashlib.sha256(b"ACGTAC").hexdigest(), "k+2": hashlib.sha256(b"GGG").hexdigest()}

    def table(rows):
        return spark.createDataFrame(rows, "candidate_id string, sequence_sha256 string")

    good = list(sums.items())
    assert {r.candidate_id: r.sequence for r in readers.with_sequences(table(good), records).collect()} == {"k 1": "ACGTAC", "k+2": "GGG"}
    for rows, reason in ((good[:1], "without a candidate"), ([*good, ("z", "0")], "without a sequence"), ([*good, good[0]], "more than once"), ([good[0], ("k+2", "0")], "SHA-256")):
        with pytest.raises(ContractError, match=reason):
            readers.with_sequences(table(rows), records)


def test_families_over_a_stream(spark, tmp_path):
    """After the last batch, rows and families have what the whole table gives; a batch that comes again changes nothing."""
    rows = [(f"d{i % 3}", ((i * 7919) % 1009 + 1) / (1010 if i % 5 else 1010 * 1e5), i) for i in range(600)]
    whole = spark.createDataFrame(rows, "dataset_id string, pval double, k long")
    for i in range(4):
        whole.where(F.col("k") % 4 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    counted = str(tmp_path / "counts")
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream.writeStream.foreachBatch(streams.count_batches(counted, ["dataset_id"])).option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert len([p for p in (tmp_path / "counts").iterdir() if p.name.startswith("batch_id")]) == 4
    got = {r.k: (r.n_tests, r.bh_p, r.bonferroni_p, r.bh_significant) for r in streams.adjusted_so_far(whole, counted, ["dataset_id"]).collect()}
    assert got == {r.k: (r.n_tests, r.bh_p, r.bonferroni_p, r.bh_significant) for r in st.adjust(whole).collect()} and any(x[3] for x in got.values())
    want = {r.dataset_id: tuple(r) for r in st.diagnostics(whole).collect()}
    assert {r.dataset_id: tuple(r) for r in streams.diagnostics_so_far(spark, counted, ["dataset_id"]).collect()} == want
    # an empty batch, and one that is run again
    again = streams.count_batches(counted, ["dataset_id"])
    again(whole.limit(0), 9)
    before = spark.read.parquet(f"{counted}/batch_id=1").collect()
    again(spark.createDataFrame([(r.dataset_id, r.p) for r in before for _ in range(r.n)], "dataset_id string, pval double"), 1)
    assert {r.dataset_id: tuple(r) for r in streams.diagnostics_so_far(spark, counted, ["dataset_id"]).collect()} == want
