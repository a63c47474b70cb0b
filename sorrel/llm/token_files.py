"""Flat token files: unsigned ids without any framing, 64-bit document offsets beside them, both memory-mapped by readers."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.llm.common import documents, scratch, slices, strings, written
from sorrel.llm.tokens import encoder, tokenizer_path

MANIFEST = "part int, file string, width int, n_docs long, n_ids long"
ENTRIES = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, width: int = 2, file_chars: int = 256_000_000) -> DataFrame:
    """Tokenize documents and write their ids, in ascending doc_id order, as flat files under `path`; returns the manifest.

    Documents are range-partitioned by doc_id, in parts of about `file_chars` bytes of text at most, and each partition writes one pair of files: `<name>.bin` has nothing but unsigned little-endian ids
    of `width` bytes, `<name>.idx` has the number of documents n, n + 1 offsets into the ids (both 64-bit), the doc_ids (64-bit) and a byte each that says
    whether there is an id. A task writes under a name of its own and the manifest lists only the files of tasks that ended well, so a
    task that runs twice leaves no wrong rows. `part` orders the files: a part's first id is the sum of n_ids of the parts before.

    Null and empty texts are a single end id. Null ids come first. Rows that share an id keep the order of their texts. An empty
    table writes no files. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = {2: "<u2", 4: "<u4"}[width]

    def write(batches):
        part, enc, bin_out, name = TaskContext.get().partitionId(), encoder(tokenizer), None, ""
        ids, known, counts = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if bin_out is None:
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                fs, root = _filesystem(path)
                fs.create_dir(root, recursive=True)
                bin_out = fs.open_output_stream(f"{root}/{name}.bin")
            texts = strings(batch.column(1))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
            for a, b in slices(lengths, 1_000_000):
                flat, n = enc.encode([x.encode() for x in texts[a:b].to_pylist()], end_id)
                if len(flat) and int(flat.max()) >= 1 << (8 * width):
                    raise ValueError(f"an id doesn't fit in {width} bytes")
                bin_out.write(flat.astype(kind).tobytes())
                counts.append(n)
            ids.append(batch.column(0).fill_null(0).to_numpy())
            known.append(batch.column(0).is_valid().to_numpy(zero_copy_only=False))
        if bin_out is not None:
            bin_out.close()
            n = np.concatenate(counts)
            with fs.open_output_stream(f"{root}/{name}.idx") as out:
                out.write(np.array([len(n)], "<u8").tobytes() + np.concatenate([[0], np.cumsum(n)]).astype("<u8").tobytes() + np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(known).astype("u1").tobytes())
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([width], pa.int32()), pa.array([len(n)], pa.int64()), pa.array([int(n.sum())], pa.int64())], ["part", "file", "width", "n_docs", "n_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // file_chars)), "doc_id").sortWithinPartitions("doc_id", "text")
    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


def _ranges(fs: pafs.FileSystem, name: str):
    """A function that gives the values from one byte to another: of the mapped file if it is local, else by reading just them."""
    if isinstance(fs, pafs.LocalFileSystem):
        whole = pa.memory_map(name).read_buffer()
        return lambda a, b, kind: np.frombuffer(whole.slice(a, b - a), kind) if b > a else np.zeros(0, kind)
    f = fs.open_input_file(name)
    return lambda a, b, kind: np.frombuffer(f.read_at(b - a, a), kind)


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Read the files back: doc_id, start (ids before the document in the whole set), n_tokens, ids_crc32 (of the ids as 32-bit integers).

    Bases are prefix sums of the manifest's n_ids, a row for each file.
    """
    parts = sorted((r.part, r.n_ids) for r in manifest.select("part", "n_ids").toLocalIterator())
    bases, total = {}, 0
    for part, n in parts:
        bases[part] = total
        total += n

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                fs, root = _filesystem(path)
                idx, ids, width = _ranges(fs, f"{root}/{r['file']}.idx"), _ranges(fs, f"{root}/{r['file']}.bin"), r["width"]
                n = int(idx(0, 8, "<u8")[0])
                for a in range(0, n, 2000):
                    b = min(n, a + 2000)
                    o = idx(8 + 8 * a, 16 + 8 * b, "<u8").astype(np.int64)
                    doc_ids, valid = idx(16 + 8 * (n + a), 16 + 8 * (n + b), "<i8"), idx(16 + 16 * n + a, 16 + 16 * n + b, "u1").astype(bool)
                    flat = memoryview(ids(width * int(o[0]), width * int(o[-1]), f"<u{width}").astype("<u4").tobytes())
                    crc = [zlib.crc32(flat[4 * (s - o[0]) : 4 * (e - o[0])]) for s, e in zip(o[:-1], o[1:], strict=True)]
                    yield pa.record_batch([pa.array(doc_ids, pa.int64(), mask=~valid), pa.array(o[:-1] + bases[r["part"]]), pa.array(np.diff(o)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("part", "file", "width").repartition(n, "file").mapInArrow(read, ENTRIES)


def op7_flat_token_files(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    manifest = write_token_files(documents(spark, sf_dir), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, manifest)
