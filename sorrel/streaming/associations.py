"""Association rows as a stream: the row contract, duplicates within a watermark, windowed counts, and corrections of whole families that go on over all batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.operators import statistics as st
from sorrel.operators.contract import violation
from sorrel.sources.scratch import written


def valid_rows(stream: DataFrame, key: list[str], time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Rows that keep the contract, each key once within the watermark."""
    return stream.withWatermark(time, late).where(violation().isNull()).dropDuplicatesWithinWatermark(key)


def counts(stream: DataFrame, keys: list[str], time: str = "ts", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    w = stream.withWatermark(time, late).groupBy(F.window(time, window), *keys)
    return w.agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def adjust_batches(target: str, family: list[str]):
    """For foreachBatch: each micro-batch is a family of its own (batch_id), corrected and appended."""

    def batch(df: DataFrame, batch_id: int) -> None:
        st.adjust(df.withColumn("batch_id", F.lit(batch_id)), family=["batch_id", *family]).write.mode("append").parquet(target)

    return batch


def count_batches(target: str, family: list[str], p: str = "pval"):
    """For foreachBatch: the counts of each micro-batch's distinct p-values, in a folder of its own, so a batch that is run again replaces itself. Counts are all that a family's corrections need, and they add up over batches."""

    def batch(df: DataFrame, batch_id: int) -> None:
        st.p_counts(df, p, family).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return batch


def families_so_far(spark: SparkSession, target: str, family: list[str]) -> DataFrame:
    """Ranked p-values of whole families over all batches that `count_batches` has written, as `statistics.ranked` gives them for a table."""
    return st.ranked_counts(written(spark.read.parquet(target).groupBy(*family, "p").agg(F.sum("n").alias("n")), "p-values"), family)


def adjusted_so_far(rows: DataFrame, target: str, family: list[str], p: str = "pval", alpha: float = 0.05, fdr: float = 0.05) -> DataFrame:
    """Rows of any batch with their family's corrections over all batches so far, as `statistics.adjust` would give them for the whole."""
    return st.adjust(rows, p, family, alpha, fdr, families_so_far(rows.sparkSession, target, family))


def diagnostics_so_far(spark: SparkSession, target: str, family: list[str], alpha: float = 0.05, fdr: float = 0.05) -> DataFrame:
    """One row for each family over all batches so far, as `statistics.diagnostics`; no rows are read but the counts."""
    at = families_so_far(spark, target, family)
    return st.diagnostics(at, "p", family, alpha, fdr, at)
