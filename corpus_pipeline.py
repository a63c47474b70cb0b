"""A corpus pipeline of the numbered operators: each stage works on all that the one before kept, is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.llm.common import written
from sorrel.llm.decontamination import decontaminated
from sorrel.llm.lines import dedup_lines
from sorrel.llm.near_copies import near_copies
from sorrel.llm.packing import pack
from sorrel.llm.quality import judge
from sorrel.llm.tokens import tokenizer_path

#: The columns that every stage but the last returns.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT) if text != "text" else docs.select(*DOCUMENT)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; of the others, the lines that fail go."""
    return _documents(judge(docs.select(*DOCUMENT)).where("kept"), "clean_text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller doc_id holds go; a document stays even if no line does."""
    return _documents(dedup_lines(docs.select(*DOCUMENT)), "kept_text")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more) stays, the one with the smallest doc_id. Rows with a null doc_id stay.

    Texts whose SimHashes are linked by op6's index are compared first. Pairs of 0.8 differ in up to 20 of 64 SimHash bits, which no index tells from chance, so those that are still apart are found by minimum hashes.
    """
    copies = near_copies(docs).where("doc_id != component_id").select("doc_id").distinct()
    return _documents(docs.join(copies, "doc_id", "left_anti"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go, whether or not they have an id."""
    return _documents(decontaminated(docs.select(*DOCUMENT), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the documents' pieces in sequences of 4096 ids. Executors have worked for other stages before, so workers remember fewer words than in op8."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), most_words=200_000).drop("ids")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_near_dedup), ("benchmark decontamination", benchmark_decontamination), ("packing", packing)]

#: Components of near copies and token ids can't be said in SQL; tests/llm holds each operator against brute force, and the stages' documents against those planted.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
