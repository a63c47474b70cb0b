"""Line dedup: the first document that holds a line keeps it; the others get a bitmap of the lines they lose."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorrel.llm.common import documents, written

#: A key's documents are sorted in ranges of doc_id of about so many documents (16 ranges at least, 1024 at most), so a line that a third of all documents share is spread over as many groups.
RANGE_DOCS, RANGES = 250_000, (16, 1024)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _split(text):
    return F.split(text, "\n", -1)


def line_key(line):
    """The line without white space at both ends, A-Z lower-cased. lower() gives the same for ASCII and is far faster there."""
    key = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, _UPPER, _LOWER))


def line_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, text_hash, n_dropped, keep) of documents that lose lines: `keep` is a compressed bitmap of the lines that stay, a map from a
    block of 64 lines to its bits without the blocks that keep all their lines. Texts aren't returned or shuffled.

    Two 64-bit hashes stand for each line's key. Hashes are range-partitioned together with a range of the documents and sorted by document and position, so that a stream over the
    partition meets the first occurrence first: later documents of the range lose the line. What is left, one row for each key and range,
    is compared over the ranges (at most as many rows a key as there are ranges). A key shared by a third of all documents so never meets in one task.

    Rows are told apart by doc_id and a hash of the text: repeated rows get the same bitmap. Rows with a null doc_id keep all lines and don't count for others.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text")).where("doc_id is not null")
    n_ranges = max(RANGES[0], min(RANGES[1], rows.count() // RANGE_DOCS))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n_ranges for i in range(1, n_ranges)], 50 * n_ranges)).first()[0] or []
    span = F.size(F.filter(F.lit(sorted(set(cuts))), lambda c: F.col("doc_id") > c)) if cuts else F.lit(0)
    lines = rows.select("doc_id", span.cast("short").alias("span"), F.xxhash64("text").alias("text_hash"), F.posexplode(_split(F.col("text"))).alias("pos", "line")).select("doc_id", "span", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    lines = lines.where(F.length("key") >= min_chars).select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(17), "key").alias("h2"), "span", "doc_id", "text_hash", "pos")
    lines = written(lines, "line-hashes")  # dealing out by range reads its input twice

    key = ["h", "h2", "span"]
    streamed = lines.repartitionByRange(n, "h", "span").withColumn("first", F.min("doc_id").over(Window.partitionBy(*key).orderBy("doc_id", "pos")))
    later = streamed.where("doc_id > first").select("doc_id", "text_hash", "pos")
    firsts = streamed.where("doc_id = first").groupBy(*key, "doc_id", "text_hash").agg(F.collect_list("pos").alias("at"))
    firsts = firsts.withColumn("first", F.min("doc_id").over(Window.partitionBy("h", "h2"))).where("doc_id > first")
    dropped = later.unionByName(firsts.select("doc_id", "text_hash", F.explode("at").alias("pos")))
    bits = dropped.repartition(n, "doc_id", "text_hash").groupBy("doc_id", "text_hash", F.shiftright("pos", 6).alias("block")).agg(F.bitwise_not(F.bit_or(F.expr("shiftleft(1L, pos & 63)"))).alias("bits"))
    return bits.groupBy("doc_id", "text_hash").agg(F.sum(64 - F.bit_count("bits")).alias("n_dropped"), F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("keep"))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """All columns of `docs` with n_lines, n_dropped and kept_text.

    Keys of at least `min_chars` characters that two or more documents hold lose all their lines but those of the smallest doc_id. Null and empty
    texts are one empty line. Other lines stay as they are. Columns of `docs` that bear a name of the result's are replaced. An empty table gives an empty result.
    """
    maps = line_bitmaps(docs, min_chars)
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    # the documents' columns travel in one struct, so their names meet no others
    rows = docs.select(F.struct(*own).alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64(_text()).alias("hash"))
    joined = rows.join(maps, (F.col("key") == F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    keep = F.filter(_split(text), lambda _, i: F.coalesce(F.try_element_at("keep", F.shiftright(i, 6)), F.lit(-1)).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(63))) != 0)
    result = [F.size(_split(text)).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.when(F.col("n_dropped").isNull(), text).otherwise(F.array_join(keep, "\n")).alias("kept_text")]
    return joined.select("row", *result).select(*[F.col("row").getField(c).alias(c) for c in own], "n_lines", "n_dropped", "kept_text")


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = rf"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines),
owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.*, o.owner IS NOT NULL AND k.doc_id > o.owner AS gone FROM keyed k LEFT JOIN owners o ON k.key = o.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
