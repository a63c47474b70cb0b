"""Domain views of the given tables, as SQL that Spark and other engines read alike, so a query and its oracle start from the same rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels")


def d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


_U = "CAST((l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709 + l_linenumber * 15485863) % 1000003 + 1 AS DOUBLE) / " + d(1000004.0)

#: Association rows; a family for each pair of flags. src_row orders them.
VARIANTS = f"""
SELECT l_returnflag || '_' || l_linestatus AS dataset_id, 'Chr' || (l_suppkey % 11 + 1) AS chr, l_partkey * 1000 + l_linenumber * 10 AS pos,
       CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'C' ELSE 'G' END AS allele1, 'T' AS allele0, l_discount AS af,
       l_extendedprice / {d(1e5)} - {d(0.5)} AS beta, l_tax + {d(0.01)} AS se,
       CASE WHEN l_partkey % 97 = 0 THEN ({_U}) * {d(1e-7)} ELSE {_U} END AS pval,
       (l_orderkey * 1000003 + l_partkey) * 8 + l_linenumber AS src_row
FROM lineitem"""

#: The same rows as text, some of them broken.
TEXT_ROWS = """
SELECT l_returnflag || '_' || l_linestatus AS dataset_id, CASE WHEN l_orderkey % 1009 = 0 THEN ' ' ELSE 'Chr' || (l_suppkey % 11 + 1) END AS chr, '.' AS rs,
       CASE WHEN l_orderkey % 503 = 1 THEN '+' ELSE '' END || CAST(l_partkey * 10 + l_linenumber AS STRING) || CASE WHEN l_orderkey % 401 = 0 THEN '.5' ELSE '' END AS pos,
       CASE WHEN l_suppkey % 97 = 5 THEN '-1' ELSE '0' END AS n_miss, 'A' AS allele1, CASE WHEN l_partkey % 811 = 0 THEN '' ELSE 'G' END AS allele0,
       CASE WHEN l_orderkey % 307 = 2 THEN '1.10' ELSE '0.30' END AS af, CASE WHEN l_orderkey % 211 = 3 THEN 'nan' ELSE '5e-2' END AS beta, CASE WHEN l_partkey % 613 = 4 THEN '-0.5' ELSE '0.01' END AS se,
       '-1.5' AS logl_H1, '1' AS l_remle, '.5' AS l_mle, CASE WHEN l_orderkey % 199 = 7 THEN '1e-400' ELSE '1e-3' END AS p_wald, CASE WHEN l_suppkey % 89 = 6 THEN '0' ELSE '1e-4' END AS pval, CASE WHEN l_partkey % 907 = 9 THEN '1.5' ELSE '1E-5' END AS p_score,
       (l_orderkey * 1000003 + l_partkey) * 8 + l_linenumber AS src_row
FROM lineitem"""

#: Six ranges of each chromosome.
REGIONS = "SELECT 'region_' || n_nationkey AS region_id, n_nationkey AS region_no, 'Chr' || (n_nationkey % 11 + 1) AS chr, CAST(n_nationkey * 20000 AS BIGINT) AS start, CAST(n_nationkey * 20000 + 150000 AS BIGINT) AS \"end\" FROM nation"

GENES = "SELECT 'gene' || p_partkey AS gene_id, 'Chr' || (p_partkey % 9 + 1) AS g_chr, p_partkey * 1000 + 200 AS g_start, p_partkey * 1000 + 200 + p_size * 10 AS g_end FROM part"

#: Candidates at places of orders: REF and ALT differ.
CANDIDATES = """
SELECT 'c' || o_orderkey AS candidate_id, 'Chr' || (o_custkey % 11 + 1) AS chr, o_orderkey * 97 % 2000000 + 1 AS pos,
       substring('ACGT', CAST(o_orderkey % 4 AS INT) + 1, 1) AS ref, substring('ACGT', CAST((o_orderkey + 1 + o_custkey % 3) % 4 AS INT) + 1, 1) AS alt,
       CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE 'wald' END AS test, CASE WHEN o_orderkey % 17 = 0 THEN 'log_odds' ELSE 'linear' END AS effect_scale, 'additive' AS trait_coding, 'mm' AS trait_unit,
       CASE WHEN o_orderkey % 19 = 0 THEN 'unresolved_strand' ELSE 'aligned_to_ALT' END AS effect_orientation,
       CASE WHEN o_orderkey % 23 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(o_orderkey % 7 AS DOUBLE) - CAST(3.5 AS DOUBLE) END AS beta
FROM orders"""

#: Ungapped blocks of chains from places of candidates (the query side) on both strands; some overlap, so a place may be hit twice.
BLOCKS = """
SELECT 'chain' || p_partkey AS chain_id, 'T' || (p_partkey % 11 + 1) AS t_name, p_partkey * 1700 % 2000000 AS t_start, CAST(500 + p_size * 40 AS BIGINT) AS size,
       'Chr' || (p_partkey % 11 + 1) AS q_name, p_partkey * 1700 % 2000000 + 100 AS q_start, CAST(3000000 AS BIGINT) AS q_size, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand, CAST(p_partkey % 50 AS DOUBLE) AS score
FROM part"""

#: Lines of a chain file: a chain for each order, with a block for each of its items; some are broken in one way or another.
CHAIN_LINES = """
SELECT CAST(o.o_orderkey * 1000 AS BIGINT) AS src_row,
       CASE WHEN o.o_orderkey % 613 = 1 THEN 'chain 5 T1' ELSE 'chain ' || CASE WHEN o.o_orderkey % 617 = 2 THEN '-1' ELSE CAST(o.o_custkey AS STRING) END || ' T' || CAST(o.o_orderkey % 3 + 1 AS STRING) || ' 5000000 + ' || CAST(o.o_orderkey AS STRING) || ' '
         || CAST(o.o_orderkey + n.total + n.tgaps + CASE WHEN o.o_orderkey % 619 = 3 THEN 1 ELSE 0 END AS STRING) || ' Q' || CAST(o.o_orderkey % 2 + 1 AS STRING) || CASE WHEN o.o_orderkey % 631 = 4 THEN ' 700' ELSE ' 6000000' END || CASE WHEN o.o_orderkey % 641 = 5 THEN ' *' WHEN o.o_orderkey % 2 = 0 THEN ' -' ELSE ' +' END
         || ' 7 ' || CAST(7 + n.total + n.qgaps AS STRING) || ' c' || CAST(CASE WHEN o.o_orderkey % 643 = 6 THEN o.o_orderkey - 1 ELSE o.o_orderkey END AS STRING) END AS value
FROM orders o JOIN items n ON o.o_orderkey = n.l_orderkey
UNION ALL
SELECT CAST(l_orderkey * 1000 + k AS BIGINT), CASE WHEN l_orderkey % 647 = 7 AND k = 1 THEN 'x' WHEN l_orderkey % 653 = 8 AND k = 1 THEN '-3 0 0' ELSE CAST(l_quantity AS STRING) END
         || CASE WHEN k = n_items THEN CASE WHEN l_orderkey % 659 = 9 THEN ' 1 1' ELSE '' END WHEN l_orderkey % 661 = 10 AND k = 1 THEN '' WHEN l_orderkey % 673 = 11 AND k = 1 THEN ' 4' ELSE ' ' || CAST(l_linenumber AS STRING) || ' ' || CAST(l_partkey % 5 AS STRING) END
FROM placed"""
CHAIN_ITEMS = """
placed AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n_items FROM lineitem),
items AS (SELECT l_orderkey, sum(l_quantity) AS total, sum(CASE WHEN k < n_items THEN l_linenumber ELSE 0 END) AS tgaps, sum(CASE WHEN k < n_items THEN l_partkey % 5 ELSE 0 END) AS qgaps FROM placed GROUP BY l_orderkey)"""

#: Dosages: 64 markers of each vector, 0, 1, 2 or missing.
DOSAGES_SPARK = "SELECT vec_id AS sample_id, marker_id, CASE WHEN (vec_id * 31 + marker_id * 17) % 41 = 0 THEN NULL WHEN x < -0.05D THEN 0 WHEN x < 0.05D THEN 1 ELSE 2 END AS dosage FROM (SELECT vec_id, posexplode(embedding) AS (marker_id, x) FROM embeddings)"
DOSAGES = f"SELECT vec_id AS sample_id, marker_id, CASE WHEN (vec_id * 31 + marker_id * 17) % 41 = 0 THEN NULL WHEN x < {d(-0.05)} THEN 0 WHEN x < {d(0.05)} THEN 1 ELSE 2 END AS dosage FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS marker_id FROM embeddings)"

#: Assay returns of 20 designs.
ASSAYS = """
SELECT 'd' || (user_id % 20) AS design_id, 's' || (event_id % 37) AS sample_id, 'b0' AS batch_id, CASE WHEN event_id % 20 < 10 THEN 'p0' ELSE 'p1' END AS plate_id,
       CASE event_id % 10 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'sample' END AS control_type,
       CASE WHEN event_id % 10 = 1 THEN CASE WHEN event_id % 1013 = 171 THEN '1' ELSE 'NA' END WHEN event_id % 29 = 3 THEN 'NA' WHEN event_id % 10 = 0 THEN CAST(event_id % 3 AS STRING) ELSE CAST((event_id % 37) % 3 AS STRING) END AS call,
       CASE WHEN event_id % 31 = 4 THEN 'NA' WHEN event_id % 53 = 5 AND user_id % 3 = 0 THEN '0' ELSE CAST((event_id % 37) % 3 AS STRING) END AS reference_genotype,
       CASE WHEN event_id % 10 = 0 THEN CAST(event_id % 3 AS STRING) ELSE 'NA' END AS expected_genotype
FROM events"""

DESIGNS = "SELECT 'd' || s_suppkey AS design_id, 'c' || CAST((s_suppkey - s_suppkey % 3) / 3 AS INT) AS candidate_id FROM supplier"

#: Numbers that should be p-values, some of which aren't.
P_VALUES = f"SELECT (l_orderkey * 1000003 + l_partkey) * 8 + l_linenumber AS src_row, CASE WHEN l_orderkey % 211 = 0 THEN NULL WHEN l_orderkey % 223 = 1 THEN CAST('nan' AS DOUBLE) WHEN l_orderkey % 227 = 2 THEN CAST('inf' AS DOUBLE) WHEN l_orderkey % 229 = 3 THEN {d(0.0)} WHEN l_orderkey % 233 = 4 THEN {d(1.5)} ELSE {_U} END AS p FROM lineitem"

#: Consecutive upper-case sequences of 22 letters A, C, G and T from whole texts; the last of a text may be shorter.
_LETTERS = "translate(upper(regexp_replace(text, '[^A-Za-z]', ''{})), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC')"
# cut by a pattern in one pass: a substring counts its way through all letters before it, so one for each oligo is quadratic in the text
OLIGOS_SPARK = f"SELECT doc_id, posexplode(regexp_extract_all(letters, '.{{{{1,22}}}}', 0)) AS (no, oligo) FROM (SELECT doc_id, {_LETTERS.format('')} AS letters FROM documents) WHERE letters <> ''"
OLIGOS = f"SELECT doc_id, CAST(no AS INT) AS no, substring(letters, no * 22 + 1, 22) AS oligo FROM (SELECT doc_id, letters, unnest(range(0, (length(letters) + 21) // 22)) AS no FROM (SELECT doc_id, {_LETTERS.format(", 'g'")} AS letters FROM documents) WHERE letters <> '')"

#: Summary statistics under another contract, as text.
CUSTOMER = """
SELECT 'cohort' || (l_suppkey % 3) AS dataset_id, 'Chr' || (l_suppkey % 11 + 1) AS chr, CAST(l_partkey * 1000 + l_linenumber * 10 AS STRING) AS pos, 'A' AS ref, 'C' AS alt,
       CASE WHEN l_linenumber % 2 = 0 THEN 'A' WHEN l_orderkey % 101 = 0 THEN 'G' ELSE 'C' END AS effect_allele, CASE WHEN l_linenumber % 2 = 0 THEN 'C' ELSE 'A' END AS other_allele,
       CAST(l_quantity - 25 AS STRING) AS effect, CASE WHEN l_orderkey % 97 = 1 THEN '0' ELSE '0.5' END AS standard_error, CASE WHEN l_orderkey % 89 = 2 THEN '1.5' ELSE '120' END AS sample_size,
       CASE WHEN l_orderkey % 83 = 3 THEN '1.25' WHEN l_orderkey % 5 = 0 THEN '' ELSE '0.25' END AS frequency,
       CASE WHEN l_partkey % 97 = 0 THEN CAST(l_orderkey % 9 + 1 AS STRING) || 'e-' || CAST(300 + l_partkey % 200 AS STRING) WHEN l_orderkey % 79 = 4 THEN '0' ELSE '0.' || CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 9000 + 1000 AS STRING) END AS pvalue,
       CASE WHEN l_orderkey % 158 = 4 THEN '500.5' ELSE '' END AS neg_log10, 'v' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS candidate_id
FROM lineitem"""


def portable(sql: str) -> str:
    """For engines that have no STRING type name."""
    return sql.replace("AS STRING)", "AS VARCHAR)")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view over tables of `sf_dir`."""
    used = [t for t in TABLES if re.search(rf"\bFROM {t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", sql)
    return spark.sql(sql.replace('"end"', "`end`"), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})
