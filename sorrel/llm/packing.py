"""Packing by concatenation: prefix sums give every document its place in one long token stream, which is cut into equal windows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import documents, slices, strings, written
from sorrel.llm.tokens import MOST_WORDS, encoder, forget_words, tokenizer_path

TOKENS = "part int, doc_id long, local_start long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def token_table(docs: DataFrame, tokenizer: str, end_id: int, most_words: int = MOST_WORDS) -> DataFrame:
    """First pass: ids of every document (unsigned 32-bit, little-endian), its partition, and its first id's place within that partition."""

    def encode(batches):
        part, place, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer, most_words)
        for batch in batches:
            texts = strings(batch.column(1))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int64)
            for a, b in slices(lengths, 1_000_000):
                ids, counts = enc.encode([x.encode() for x in texts[a:b].to_pylist()], end_id)
                starts = np.cumsum(counts) - counts
                blob = ids.astype("<u4").tobytes()
                yield pa.record_batch([pa.array(np.full(b - a, part, np.int32)), batch.column(0).slice(a, b - a), pa.array(starts + place), pa.array(counts), pa.array([blob[4 * s : 4 * (s + n)] for s, n in zip(starts, counts, strict=True)], pa.binary())], ["part", "doc_id", "local_start", "n_tokens", "ids"])
                place += int(counts.sum())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, TOKENS)


def pack(docs: DataFrame, tokenizer: str, sequence_length: int = 4096, end_id: int = 2, most_words: int = MOST_WORDS) -> DataFrame:
    """Pack all documents into sequences of `sequence_length` ids; returns a boundary record for each piece of a document, with its ids.

    First pass: tokenize, write the ids to the shared folder, and add up each partition's ids. The totals (one number for each partition)
    give partition bases by prefix sums. Second pass: every document's place in the stream is its partition's base plus its place within, and
    the stream is cut each `sequence_length` ids. Only the very last sequence needs padding. No text is shuffled.
    The second pass needs no tokenizer: workers first forget the words (up to `most_words`) that they remember of the first, and hold some 4 MB of ids at a time.

    Null and empty texts are a single end id. Repeated rows are packed as often as they occur. An empty table gives no pieces.
    Other columns are ignored.
    """
    table = written(token_table(docs, tokenizer, end_id, most_words), "packing-tokens")
    totals = sorted((r.part, r.n) for r in table.groupBy("part").agg(F.sum("n_tokens").alias("n")).toLocalIterator())
    bases = np.zeros(totals[-1][0] + 1 if totals else 1, np.int64)
    total = 0
    for part, n in totals:
        bases[part] = total
        total += n

    def cut(batches):
        forget_words()
        for batch in (whole.slice(a, b - a) for whole in batches for a, b in slices(whole.column(3).to_numpy(), 1_000_000)):
            part, counts = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            place = bases[part] + batch.column(2).to_numpy()
            first, last = place // sequence_length, (place + counts - 1) // sequence_length
            pieces = (last - first + 1) if len(counts) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(counts)), pieces)
            sequence = np.repeat(first, pieces) + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(sequence * sequence_length, place[row])
            end = np.minimum((sequence + 1) * sequence_length, place[row] + counts[row])
            start = begin - place[row]
            ids = batch.column(4)
            blobs = [memoryview(ids[int(r)].as_buffer())[4 * s : 4 * (s + n)] for r, s, n in zip(row, start, end - begin, strict=True)]
            yield pa.record_batch(
                [batch.column(1).take(pa.array(row)), pa.array(start), pa.array(end - begin), pa.array([zlib.crc32(x) for x in blobs], pa.int64()), pa.array(counts[row]), pa.array(sequence), pa.array(begin - sequence * sequence_length), pa.array([bytes(x) for x in blobs], pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return table.mapInArrow(cut, PIECES + ", ids binary")


def op8_concatenate_and_cut(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")).drop("ids")
