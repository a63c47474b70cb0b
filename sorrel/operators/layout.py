"""Plot data: genome-wide positions, regions and their top variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.functions.text import natural_key
from sorrel.sources.scratch import written


#: Values of a bin in which an exact median is looked for.
BIN = 65_536


def medians(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """keys and the exact median of a column of whole numbers, from counts: bins of values are added up to find the one or two that hold the middle, and only their distinct values are ranked. No task holds a group's values."""
    counted = written(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("bigint").alias("_v")).agg(F.count("*").alias("_n")).withColumn("_bin", F.floor(F.col("_v") / BIN)), "counted-values")
    of = Window.partitionBy(*keys)
    totals = counted.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_in"))
    totals = totals.select(*keys, "_bin", "_in", F.coalesce(F.sum("_in").over(of.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_in").over(of).alias("_m"))
    low, high = F.floor((F.col("_m") + 1) / 2), F.ceil((F.col("_m") + 1) / 2)
    chosen = totals.where((F.col("_before") < high) & (F.col("_before") + F.col("_in") >= low)).drop("_in")
    last = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    rows = counted.join(chosen, [*keys, "_bin"]).withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_n") + 1)
    weight = sum((F.when((F.col("_first") <= r) & (F.col("_last") >= r), 1).otherwise(0) for r in (low, high)), F.lit(0))
    return rows.groupBy(*keys).agg((F.sum(F.col("_v") * weight) / F.lit(2.0)).alias(name))


def chromosomes(df: DataFrame, family: str = "dataset_id") -> DataFrame:
    """Rows, largest and median position of each chromosome, its natural order, and the offset that lays it after those before."""
    per = df.groupBy(family, "chr").agg(F.count("*").alias("n"), F.max("pos").alias("max_pos")).join(medians(df, [family, "chr"], "pos", "median_pos"), [family, "chr"])
    w = Window.partitionBy(family).orderBy(*natural_key("chr"))
    before = F.coalesce(F.sum("max_pos").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.withColumns({"chr_order": F.row_number().over(w), "offset": before, "label": F.replace("chr", F.lit("Chr"), F.lit(""))}).withColumn("tick", F.col("offset") + F.col("median_pos"))


def offsets(df: DataFrame, family: str = "dataset_id") -> DataFrame:
    """family, chr and the offset alone, without medians."""
    per = df.groupBy(family, "chr").agg(F.max("pos").alias("max_pos"))
    before = F.sum("max_pos").over(Window.partitionBy(family).orderBy(*natural_key("chr")).rowsBetween(Window.unboundedPreceding, -1))
    return per.select(family, "chr", F.coalesce(before, F.lit(0)).alias("offset"))


def manhattan(df: DataFrame, family: str = "dataset_id") -> DataFrame:
    """Add x, the position along all chromosomes, and y, -log10(p)."""
    return df.join(offsets(df, family), [family, "chr"]).withColumns({"x": F.col("pos") + F.col("offset"), "y": -F.log10("pval")}).drop("offset")


def contiguous_layout(df: DataFrame, contigs: DataFrame, family: str = "dataset_id") -> DataFrame:
    """The second contract: each contig starts at a cursor and takes max - min + 1 places."""
    spans = df.groupBy(family, "chr").agg(F.min("pos").alias("low"), F.max("pos").alias("high")).join(contigs, "chr")
    w = Window.partitionBy(family).orderBy("contig_order").rowsBetween(Window.unboundedPreceding, -1)
    cursor = spans.withColumn("cursor", F.coalesce(F.sum(F.col("high") - F.col("low") + 1).over(w), F.lit(0)))
    return df.join(cursor.select(family, "chr", "low", "cursor"), [family, "chr"]).withColumn("x", F.col("cursor") + F.col("pos") - F.col("low")).drop("low", "cursor")


def in_regions(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Variants in each region (region_id, region_no, chr, start, end), bounds included."""
    r = regions.withColumnRenamed("chr", "_chr")
    return df.join(r, (F.col("chr") == F.col("_chr")) & F.col("pos").between(F.col("start"), F.col("end"))).drop("_chr")


def top_by_region(df: DataFrame, regions: DataFrame, keys: list[str] = ["dataset_id"]) -> DataFrame:
    """The smallest p of each region, the first source row on ties."""
    found = in_regions(df, regions)
    best = F.min_by(F.struct("chr", "pos", "allele1", "allele0", "af", "beta", "pval"), F.struct("pval", "src_row"))
    return found.groupBy(*keys, "region_id", "region_no").agg(best.alias("top"), F.count("*").alias("n_variants")).select(*keys, "region_id", "region_no", "n_variants", "top.*")


def ranked(df: DataFrame, order: list[Column], name: str, within: list[str] = []) -> DataFrame:
    """Add the row's place in an order, among all rows or those that are alike in the columns `within`: rows are dealt to ranges of it, numbered within each, and added to the rows of the ranges before. Rows that tie must not differ in what
    is ordered by."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = {f"_k{i}": c for i, c in enumerate(order)}
    # written, so that a row keeps its range
    rows = written(df.withColumns(keys).repartitionByRange(n, *within, *keys).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*within, "_range").agg(F.count("*").alias("_n")).select(*within, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*within, "_range").orderBy(*keys))
    return rows.join(starts, [*within, "_range"]).withColumn(name, F.col("_before") + place).drop("_range", "_before", *keys)
