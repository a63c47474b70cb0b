"""Readers. Large files are read by Spark; small declared files (settings, FASTA indexes) on the driver."""

from __future__ import annotations

import hashlib
import tomllib
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorrel.operators.contract import COLUMNS, ChecksumError, ContractError, DuplicateError, SchemaError, finite, integer, set_differences
from sorrel.sources.scratch import written

#: Lines of a range of which one task adds up what stands before each.
RANGE = 65_536
ANALYSIS = ("chr", "pos", "allele1", "allele0", "af", "beta", "pval")


def checksum(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def check_checksum(path: str, expected: str) -> None:
    if checksum(path) != expected.lower():
        raise ChecksumError(f"{path} has another SHA-256 than declared")


def numbered(df: DataFrame, first: int = 1, head=None) -> DataFrame:
    """Add src_row, the rows' place in their files, by prefix sums over file blocks: no task gets all rows. With `head` (a condition), also head_no: how many rows up to this one meet it."""
    is_head = F.lit(0) if head is None else F.when(head, 1).otherwise(0)
    meta = df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"), is_head.alias("_h"))
    w = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = meta.groupBy("_f", "_b").agg(F.count("*").alias("_n"), F.min("_i").alias("_first"), F.sum("_h").alias("_hs")).withColumns({"_before": F.coalesce(F.sum("_n").over(w), F.lit(0)), "_heads": F.coalesce(F.sum("_hs").over(w), F.lit(0))})
    out = meta.join(starts, ["_f", "_b"]).withColumn("src_row", F.col("_before") + F.col("_i") - F.col("_first") + first)
    if head is not None:
        out = out.withColumn("head_no", F.col("_heads") + F.sum("_h").over(Window.partitionBy("_f", "_b").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)))
    return out.drop("_f", "_b", "_i", "_n", "_first", "_before", "_h", "_hs", "_heads")


def sums_before(rows: DataFrame, group: list[str], order: str, **terms) -> DataFrame:
    """Add for each name the sum of its term over the rows of the group that come before in `order` (a bigint column), by ranges of it."""
    rows = rows.withColumns({"_range": F.floor(F.col(order) / RANGE), **{f"_{n}": F.coalesce(x, F.lit(0)) for n, x in terms.items()}})
    totals = rows.groupBy(*group, "_range").agg(*[F.sum(f"_{n}").alias(f"_t_{n}") for n in terms])
    over = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, "_range", *[F.coalesce(F.sum(f"_t_{n}").over(over), F.lit(0)).alias(f"_b_{n}") for n in terms])
    within = Window.partitionBy(*group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(totals, [*group, "_range"]).withColumns({n: F.col(f"_b_{n}") + F.coalesce(F.sum(f"_{n}").over(within), F.lit(0)) for n in terms})
    return out.drop("_range", *[f"_{n}" for n in terms], *[f"_b_{n}" for n in terms])


def table(spark: SparkSession, path: str, required: tuple[str, ...] | None = None, exact: bool = False, ragged: bool = True) -> DataFrame:
    """A tab-separated table as text columns and src_row; empty cells are empty text, NA stays NA, and ragged rows are kept in _corrupt.

    Ragged rows show only if whole rows are parsed; without `ragged` the parser skips columns that aren't asked for.
    """
    first = spark.read.text(path).limit(1).collect()
    header = first[0][0].rstrip("\r").split("\t") if first else []
    if len(set(header)) != len(header) or (exact and tuple(header) != required) or (required and not set(required) <= set(header)):
        raise SchemaError(f"{path} has the columns {header}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, *["_corrupt"] * ragged)])
    rows = spark.read.options(sep="\t", header=True, quote='"', escape='"', nullValue="\x00", emptyValue="", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", columnPruning=not ragged).schema(schema).csv(path)
    return numbered(rows).select(*[F.coalesce(c, F.lit("")).alias(c) for c in header], *["_corrupt"] * ragged, "src_row")


def associations(spark: SparkSession, path: str, ragged: bool = True) -> DataFrame:
    return table(spark, path, COLUMNS, exact=True, ragged=ragged)


def analysis(rows: DataFrame) -> DataFrame:
    """The typed columns that analyses need, of 15."""
    kinds = {"pos": integer, "af": finite, "beta": finite, "pval": finite}
    return rows.select(*[kinds[c](c).alias(c) if c in kinds else F.trim(c).alias(c) for c in ANALYSIS], "src_row")


def settings(path: str, known: dict[str, type], needed: tuple[str, ...] = ()) -> dict:
    """A declared TOML file: unknown keys, missing keys and other types are errors."""
    got = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    if (odd := set(got) - set(known)) or (odd := set(needed) - set(got)):
        raise SchemaError(f"{path}: {sorted(odd)}")
    for k, v in got.items():
        if not isinstance(v, known[k]) or (known[k] is int and isinstance(v, bool)):
            raise SchemaError(f"{path}: {k} isn't {known[k].__name__}")
    return got


def regions(spark: SparkSession, path: str) -> DataFrame:
    """region_id, region_no, chr, start, end, title in declared order."""
    got = tomllib.loads(Path(path).read_text(encoding="utf-8"))["regions"]
    rows = [(r["region_id"], i, r["chrom"], int(r["start"]), int(r["end"]), r["title"]) for i, r in enumerate(got)]
    if len({r[0] for r in rows}) != len(rows) or any(not 1 <= r[3] <= r[4] for r in rows):
        raise SchemaError(f"{path}: region ids must differ, and 1 <= start <= end")
    return spark.createDataFrame(rows, "region_id string, region_no int, chr string, start long, end long, title string")


@dataclass(frozen=True)
class Contig:
    name: str
    length: int
    offset: int
    line_bases: int
    line_bytes: int


def scan_fasta(path: str) -> list[Contig]:
    """Names, lengths and layout of a FASTA file's sequences; lines of uneven width are errors."""
    out, name, length, offset, width, size, short, at = [], None, 0, 0, 0, 0, False, 0

    def close():
        if name is not None:
            out.append(Contig(name, length, offset, width, size))

    with open(path, "rb") as f:
        for line in f:
            bases = line.rstrip(b"\r\n")
            if line.startswith(b">"):
                close()
                words = bases[1:].split()
                if not words:
                    raise SchemaError(f"{path}: a sequence without a name")
                name, length, offset, width, size, short = words[0].decode(), 0, at + len(line), 0, 0, False
            elif bases:
                if name is None or short or (width and len(bases) > width):
                    raise SchemaError(f"{path}: lines of uneven width in {name}")
                width, size = width or len(bases), size or len(line)
                short, length = len(bases) < width, length + len(bases)
            at += len(line)
    close()
    if len({c.name for c in out}) != len(out):
        raise SchemaError(f"{path}: repeated names")
    return out


def read_fai(path: str) -> list[Contig]:
    rows = [x.split("\t") for x in Path(path).read_text().splitlines()]
    return [Contig(r[0], *map(int, r[1:5])) for r in rows]


def bases(path: str, contigs: list[Contig], name: str, start: int, end: int, strand: str = "+") -> str:
    """Bases of one interval (1-based, ends included) by seeking in the file."""
    c = next(c for c in contigs if c.name == name)
    if not 1 <= start <= end <= c.length:
        raise ValueError(f"{name}:{start}-{end} is outside 1-{c.length}")

    def place(i: int) -> int:
        return c.offset + i // c.line_bases * c.line_bytes + i % c.line_bases

    with open(path, "rb") as f:
        f.seek(place(start - 1))
        text = f.read(place(end - 1) + 1 - place(start - 1)).replace(b"\n", b"").replace(b"\r", b"").decode().upper()
    return text if strand == "+" else text[::-1].translate(str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"))


def _fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with bases of a FASTA file: head_no, contig, src_row, value (no white space at its end) and before, the bases of its sequence before it. A line before the first header and a header without a name are errors."""
    lines = written(numbered(spark.read.text(path), head=F.col("value").startswith(">")).withColumn("value", F.regexp_replace("value", r"[ \t\r\n]+$", "")), "fasta-lines")
    name = F.regexp_extract("value", r"^>\s*(\S+)", 1)
    heads = lines.where(F.col("value").startswith(">")).select("head_no", _must(name != "", "a sequence without a name", path, name).alias("contig"))
    if twice := heads.groupBy("contig").count().where("count > 1").limit(1).collect():
        raise SchemaError(f"{path}: {twice[0].contig} is there more than once")
    body = lines.where((F.col("value") != "") & ~F.col("value").startswith(">"))
    body = body.join(heads, "head_no", "left").withColumn("value", _must(F.col("contig").isNotNull(), "bases outside a sequence", path))
    return sums_before(body, ["head_no"], "src_row", before=F.length("value").cast("bigint"))


def _contigs_of(lines: DataFrame, path: str) -> DataFrame:
    """contig, its place in the file, length and line_bases; all lines of a sequence but its last must be as wide as its first."""
    n = F.length("value")
    per = lines.groupBy("head_no", "contig").agg(F.sum(n).alias("length"), F.min_by(n, "src_row").alias("line_bases"), F.max(n).alias("_widest"), F.max_by(n, "src_row").alias("_last"), F.count("*").alias("_lines"))
    even = (F.col("_widest") <= F.col("line_bases")) & (F.col("length") == F.col("line_bases") * (F.col("_lines") - 1) + F.col("_last"))
    checked = F.when(even, F.col("length")).otherwise(F.raise_error(F.concat(F.lit(f"{path}: lines of uneven width in "), F.col("contig"))).cast("bigint"))
    return per.select("contig", F.col("head_no").cast("int").alias("contig_no"), checked.alias("length"), "line_bases")


def fasta_contigs(spark: SparkSession, path: str) -> DataFrame:
    """contig, contig_no (from 1), length and line_bases of the sequences of a FASTA file, from prefix sums over its lines; the file isn't read on the driver. Uneven lines, repeated and missing names are errors."""
    return _contigs_of(_fasta_lines(spark, path), path)


def sequence_chunks(spark: SparkSession, path: str, chunk: int = 1000) -> DataFrame:
    """contig, chunk_no and bases, for joins by place: each line goes to the chunks that it touches by the bases before it."""
    first = F.col("before")
    cut = _fasta_lines(spark, path).select("contig", first.alias("first"), "value", F.explode(F.sequence(F.floor(first / chunk), F.floor((first + F.length("value") - 1) / chunk))).alias("chunk_no"))
    low = F.greatest(F.col("chunk_no") * chunk - F.col("first"), F.lit(0))
    high = F.least((F.col("chunk_no") + 1) * chunk - F.col("first"), F.length("value"))
    part = cut.withColumns({"_l": low, "_h": high}).select("contig", "chunk_no", F.struct("first", F.expr("substring(value, cast(_l + 1 as int), cast(_h - _l as int))").alias("part")).alias("x"))
    return part.groupBy("contig", "chunk_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["part"]), "").alias("bases"))


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """name (percent-decoded) and sequence, upper case, of a FASTA file of short sequences such as candidates' flanks; each is put together in one row."""
    lines = _fasta_lines(spark, path)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("before", "value"))), lambda x: x["value"]), "")
    name = F.url_decode(F.replace("contig", F.lit("+"), F.lit("%2B")))
    return lines.groupBy("head_no", "contig").agg(F.upper(whole).alias("sequence")).select(name.alias("name"), "sequence")


def with_sequences(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates (candidate_id, sequence_sha256) with their sequence. Both sides must have the same ids, each once, and the sequences their declared checksums."""
    for rows, key, what in ((candidates, "candidate_id", "candidate"), (records, "name", "sequence")):
        if twice := rows.groupBy(key).count().where("count > 1").limit(1).collect():
            raise DuplicateError(f"{what} {twice[0][0]} is there more than once")
    if odd := set_differences(candidates, records.withColumnRenamed("name", "candidate_id"), ["candidate_id"]).limit(1).collect():
        raise ContractError(f"{odd[0].candidate_id} is a candidate without a sequence" if odd[0].side == "left" else f"{odd[0].candidate_id} is a sequence without a candidate")
    joined = candidates.join(records, F.col("candidate_id") == F.col("name")).drop("name")
    if bad := joined.where(F.sha2("sequence", 256) != F.col("sequence_sha256")).limit(1).collect():
        raise ChecksumError(f"the sequence of {bad[0].candidate_id} has another SHA-256 than declared")
    return joined


def _must(ok, what: str, path: str, value=None):
    """The value (the line itself, if none is given), or an error that quotes the line. Files are read by Spark, so the first broken line that a task meets is named."""
    value = F.col("value") if value is None else value
    return F.when(F.coalesce(ok, F.lit(False)), value).otherwise(F.raise_error(F.concat(F.lit(f"{path}: {what}: "), F.col("value"))).cast("string"))


def _records(spark: SparkSession, path: str, skipped: str, fields: int, exact: bool, what: str) -> DataFrame:
    """Lines that aren't empty and don't begin with one of the `skipped`, which must have as many fields."""
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").rlike(skipped))
    n = F.size(F.split("value", "\t"))
    return lines.select(_must(n == fields if exact else n >= fields, what, path).alias("value"))


def _span(f, start: int, end: int, path: str, one_based: bool = True) -> tuple:
    """Two whole numbers with start <= end (1-based) or start < end (0-based), as bigint columns."""
    a, b = f[start].try_cast("bigint"), f[end].try_cast("bigint")
    ok = f[start].rlike("^[0-9]+$") & f[end].rlike("^[0-9]+$") & ((a >= 1) & (a <= b) if one_based else a < b)
    return tuple(_must(ok, "coordinates aren't an interval", path, f[i]).cast("bigint") for i in (start, end))


def genes(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, g_chr, g_start, g_end, strand of gene features of a GFF3 or GTF file; percent-encoded ids are decoded. Records without nine fields, an interval, a strand or an id are errors, and so are embedded sequences."""
    f = F.split("value", "\t")
    whole = spark.read.text(path).where(F.col("value").startswith("##FASTA"))
    if whole.limit(1).collect():
        raise SchemaError(f"{path}: embedded sequences aren't supported")
    rows = _records(spark, path, "^#", 9, True, "not a GFF or GTF record")
    rows = rows.withColumn("value", _must(f[6].isin("+", "-", ".", "?"), "not a strand", path)).withColumns({"_from": _span(f, 3, 4, path)[0], "_to": _span(f, 3, 4, path)[1]}).select("_from", "_to", "value", *[F.split("value", "\t")[i].alias(n) for i, n in ((0, "g_chr"), (2, "feature"), (6, "strand"), (8, "attributes"))])
    gff = F.url_decode(F.replace(F.regexp_extract("attributes", r"(?:^|;)\s*ID=([^;]*)", 1), F.lit("+"), F.lit("%2B")))
    gtf = F.regexp_extract("attributes", r'gene_id "([^"]*)"', 1)
    name = F.when(F.contains("attributes", F.lit("=")), gff).otherwise(gtf)
    return rows.where("feature = 'gene'").select(_must((name != "") & ~name.rlike("[\t\r\n]"), "no gene id", path, name).alias("gene_id"), "g_chr", F.col("_from").alias("g_start"), F.col("_to").alias("g_end"), "strand")


def bed(spark: SparkSession, path: str) -> DataFrame:
    """m_chr, m_start and m_end (0-based, half-open). Records without three fields or an interval are errors."""
    f = F.split("value", "\t")
    low, high = _span(f, 1, 2, path, one_based=False)
    return _records(spark, path, "^(#|track|browser)", 3, False, "not a BED record").select(f[0].alias("m_chr"), low.alias("m_start"), high.alias("m_end"))


def intervals_outside(spans: DataFrame, contigs: DataFrame, chr_: str, start: str, end: str) -> DataFrame:
    """Intervals that aren't within a contig (chr, length) of the assembly."""
    c = contigs.select(F.col("chr").alias("_c"), "length")
    return spans.join(c, F.col(chr_) == F.col("_c"), "left").where(F.col("_c").isNull() | (F.col(start) < 1) | (F.col(end) < F.col(start)) | (F.col(end) > F.col("length"))).drop("_c", "length")


def vcf(spark: SparkSession, path: str, reference: str | None = None) -> DataFrame:
    """v_chr, v_pos, v_ref, v_alt and filter, a row for each ALT; gzip files are read as they are. There must be one header of columns and, with `reference`, one ##reference line, which names it. Records without eight fields or a position are errors."""
    heads = [r[0] for r in spark.read.text(path).where(F.col("value").rlike("^(##reference=|#CHROM\t)")).limit(3).collect()]
    named = [h.strip().partition("=")[2] for h in heads if h.startswith("##")]
    if len(heads) - len(named) != 1 or (reference is not None and named != [reference]):
        raise SchemaError(f"{path} needs one header of columns{f' and one reference, {reference}' if reference is not None else ''}")
    f = F.split("value", "\t")
    rows = _records(spark, path, "^#", 8, False, "not a VCF record")
    at = _must(f[1].rlike("^[0-9]+$") & (f[1].try_cast("bigint") >= 1), "not a position", path, f[1]).cast("bigint")
    return rows.select(f[0].alias("v_chr"), at.alias("v_pos"), f[3].alias("v_ref"), F.explode(F.split(f[4], ",")).alias("v_alt"), f[6].alias("filter"))


def genotypes(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, marker_id, dosage of a wide table; any cell but 0, 1, 2 and NA is an error."""
    wide = table(spark, path, ("sample_id",))
    markers = [c for c in wide.columns if c not in ("sample_id", "_corrupt", "src_row")]
    long = wide.unpivot(["sample_id"], markers, "marker_id", "cell")
    bad = F.raise_error(F.concat(F.lit("a genotype is "), F.col("cell")))
    return long.select("sample_id", "marker_id", F.when(F.col("cell").isin("0", "1", "2"), F.col("cell").try_cast("int")).when(F.col("cell") == "NA", F.lit(None).cast("int")).otherwise(bad.cast("int")).alias("dosage"))
