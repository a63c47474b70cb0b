"""Multiple-testing corrections and inflation, for any number of independent families in one plan.

A family is never pooled with another. Ranks over a whole family aren't taken in one task: p-values are counted, dealt to fixed bins in order, and
prefix sums over the bins' totals (a few thousand rows for each family) join the bins together. The distinct p-values with their counts are written once: all steps read that small table, and the rows
themselves are read once to count and once to join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorrel.functions.numeric import CHI2_MEDIAN_1, chi2_isf, chi2_isf_1, chi2_median
from sorrel.operators.contract import p_value, unit_interval
from sorrel.sources.scratch import written

_BINS = 4096


def _bin(p: Column) -> Column:
    """Ascending with p: 4096 bins of equal width, and one for each power of two below the first."""
    return F.when(p >= 1.0 / _BINS, F.floor(p * _BINS)).otherwise(-F.ceil(-F.log2(F.greatest(p, F.lit(5e-324)))) - 1).cast("int")


def ranked(df: DataFrame, p: str, family: list[str]) -> DataFrame:
    """family, p, n (rows with that p), rank (of the last of them, ascending), m (rows of the family) and bin, for each distinct p."""
    return ranked_counts(written(p_counts(df, p, family), "p-values"), family)


def p_counts(df: DataFrame, p: str, family: list[str]) -> DataFrame:
    """family, p and n, the rows with that p: all that corrections and inflation need. Counts of parts of a family add up to those of the whole."""
    return df.groupBy(*family, p_value(p).alias("p")).agg(F.count("*").alias("n"))


def ranked_counts(counted: DataFrame, family: list[str]) -> DataFrame:
    """The same as `ranked` from the counts of distinct p-values (a written table, as it is read twice)."""
    counted = counted.withColumn("bin", _bin(F.col("p")))
    in_bin = Window.partitionBy(*family, "bin").orderBy("p")
    before = Window.partitionBy(*family).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy(*family, "bin").agg(F.sum("n").alias("in_bin"))
    totals = totals.select(*family, "bin", F.coalesce(F.sum("in_bin").over(before), F.lit(0)).alias("before"), F.sum("in_bin").over(Window.partitionBy(*family)).alias("m"))
    local = counted.withColumn("local", F.sum("n").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)))
    return local.join(totals, [*family, "bin"]).select(*family, "p", "n", "bin", (F.col("before") + F.col("local")).alias("rank"), "m")


def _suffix(df: DataFrame, value: str, family: list[str], best) -> DataFrame:
    """The best of `value` over this p and all larger ones."""
    here = df.withColumn("_here", best(value).over(Window.partitionBy(*family, "bin").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)))
    bins = df.groupBy(*family, "bin").agg(best(value).alias("_best"))
    bins = bins.select(*family, "bin", best("_best").over(Window.partitionBy(*family).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)).alias("_after"))
    both = F.least if best is F.min else F.greatest
    return here.join(bins, [*family, "bin"]).withColumn("_suffix", both("_here", "_after"))


def adjust(df: DataFrame, p: str = "pval", family: list[str] = ["dataset_id"], alpha: float = 0.05, fdr: float = 0.05, at: DataFrame | None = None) -> DataFrame:
    """Add n_tests, bonferroni_p, bh_p and their flags: Bonferroni p <= alpha / m; Benjamini-Hochberg step-up with ties. `at`: the ranked p-values, if they are there already."""
    unit_interval(alpha=alpha, fdr=fdr)
    steps = _suffix((ranked(df, p, family) if at is None else at).withColumn("raw", F.col("p") * (F.col("m") / F.col("rank"))), "raw", family, F.min)
    steps = steps.select(*family, F.col("p").alias(p), F.col("m").alias("n_tests"), F.least("_suffix", F.lit(1.0)).alias("bh_p"))
    out = df.join(steps, [*family, p])
    return out.withColumns({"bonferroni_p": F.least(F.col(p) * F.col("n_tests"), F.lit(1.0)), "bonferroni_significant": F.col(p) <= F.lit(alpha) / F.col("n_tests"), "bh_significant": F.col("bh_p") <= fdr})


def ranked_log(df: DataFrame, nlp: str, family: list[str]) -> DataFrame:
    """The same as `ranked` for -log10 p-values; p is their negative, so that it ascends with the p-value. Bins are a 64th wide."""
    return ranked_log_counts(written(df.groupBy(*family, (-F.col(nlp)).alias("p")).agg(F.count("*").alias("n")), "log-p-values"), family)


def ranked_log_counts(counted: DataFrame, family: list[str]) -> DataFrame:
    """The same from the counts n of distinct p (a written table, as it is read twice)."""
    counted = counted.withColumn("bin", F.floor(F.col("p") * 64).cast("long"))
    before = Window.partitionBy(*family).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy(*family, "bin").agg(F.sum("n").alias("in_bin"))
    totals = totals.select(*family, "bin", F.coalesce(F.sum("in_bin").over(before), F.lit(0)).alias("before"), F.sum("in_bin").over(Window.partitionBy(*family)).alias("m"))
    local = counted.withColumn("local", F.sum("n").over(Window.partitionBy(*family, "bin").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)))
    return local.join(totals, [*family, "bin"]).withColumn("rank", F.col("before") + F.col("local"))


def adjust_log(df: DataFrame, nlp: str = "neg_log10_pvalue", family: list[str] = ["dataset_id"], alpha: float = 0.05, fdr: float = 0.05) -> DataFrame:
    """The same in log space, for p-values below the double range: a running maximum of nlp - log10(m / rank), 0 at least."""
    return _adjusted_log(df, ranked_log(df, nlp, family), nlp, family, alpha, fdr)


def adjust_log_counts(counted: DataFrame, nlp: str = "neg_log10_pvalue", family: list[str] = ["dataset_id"], alpha: float = 0.05, fdr: float = 0.05) -> DataFrame:
    """The same for distinct values with their counts n (a written table): a row each."""
    return _adjusted_log(counted, ranked_log_counts(counted.select(*family, (-F.col(nlp)).alias("p"), "n"), family), nlp, family, alpha, fdr)


def _adjusted_log(df: DataFrame, at: DataFrame, nlp: str, family: list[str], alpha: float, fdr: float) -> DataFrame:
    unit_interval(closed=False, alpha=alpha, fdr=fdr)
    steps = at.withColumn("raw", -F.col("p") - F.log10(F.col("m") / F.col("rank")))
    steps = _suffix(steps, "raw", family, F.max).select(*family, (-F.col("p")).alias(nlp), F.col("m").alias("n_tests"), F.greatest("_suffix", F.lit(0.0)).alias("neg_log10_p_bh"))
    out = df.join(steps, [*family, nlp]).withColumn("neg_log10_p_bonferroni", F.greatest(F.lit(0.0), F.col(nlp) - F.log10("n_tests")))
    return out.withColumns({"bonferroni_significant": F.col("neg_log10_p_bonferroni") >= -F.log10(F.lit(alpha)), "bh_significant": F.col("neg_log10_p_bh") >= -F.log10(F.lit(fdr))})


def _middle(at: DataFrame) -> DataFrame:
    """The rows that hold the middle one or two ranks of their family, with how many of the two they hold as weight."""
    at = at.withColumn("first", F.col("rank") - F.col("n") + 1)
    low, high = F.floor((F.col("m") + 1) / 2), F.ceil((F.col("m") + 1) / 2)
    weight = F.when((F.col("first") <= low) & (F.col("rank") >= low), 1).otherwise(0) + F.when((F.col("first") <= high) & (F.col("rank") >= high), 1).otherwise(0)
    return at.where((F.col("first") <= high) & (F.col("rank") >= low)).withColumn("weight", weight)


def _statistic(middle: DataFrame, p: str, degrees: int) -> DataFrame:
    """Add x, the chi-square statistic of p; only the middle rows get here, so its steps cost nothing."""
    return middle.withColumn("x", chi2_isf_1(p) if degrees == 1 else chi2_isf(p, degrees))


def _median_of(degrees: int) -> Column:
    return F.lit(CHI2_MEDIAN_1 if degrees == 1 else chi2_median(degrees))


def inflation_log(df: DataFrame, nlp: str = "neg_log10_pvalue", family: list[str] = ["dataset_id"], degrees: int = 1) -> DataFrame:
    """n_tests, lambda_gc and status of each family of -log10 p-values of a test with so many degrees of freedom; a middle value above 300 has no chi-square tail and isn't assessed."""
    middle = _statistic(_middle(ranked_log(df, nlp, family)), "power(10D, p)", degrees)
    out = middle.groupBy(*family).agg(F.max("m").alias("n_tests"), F.max(-F.col("p")).alias("most"), (F.sum(F.col("x") * F.col("weight")) / F.lit(2.0)).alias("median_chi2"))
    far = F.col("most") > 300
    return out.select(*family, "n_tests", F.when(~far, F.col("median_chi2") / _median_of(degrees)).alias("lambda_gc"), F.when(far, "not_assessed").otherwise("diagnostic_only").alias("status"))


def quantile_points_log(df: DataFrame, nlp: str = "neg_log10_pvalue", family: list[str] = ["dataset_id"]) -> DataFrame:
    """Data of a quantile plot under the second contract: expected -log10((rank - 1/2) / m) of each distinct value's last rank."""
    return ranked_log(df, nlp, family).select(*family, (-F.col("p")).alias("observed"), F.col("n").alias("n_points"), (-F.log10((F.col("rank") - F.lit(0.5)) / F.col("m"))).alias("expected"))


def inflation(df: DataFrame, p: str = "pval", family: list[str] = ["dataset_id"], degrees: int = 1) -> DataFrame:
    """n_tests, median_chi2 and lambda_gc of each family: p-values become chi-square statistics with so many degrees of freedom first, and the middle one or two are averaged."""
    return _inflation(ranked(df, p, family), family, degrees)


def _inflation(at: DataFrame, family: list[str], degrees: int = 1) -> DataFrame:
    out = _statistic(_middle(at), "p", degrees).groupBy(*family).agg(F.max("m").alias("n_tests"), (F.sum(F.col("x") * F.col("weight")) / F.lit(2.0)).alias("median_chi2"))
    return out.withColumn("lambda_gc", F.col("median_chi2") / _median_of(degrees))


def quantile_points(df: DataFrame, p: str = "pval", family: list[str] = ["dataset_id"]) -> DataFrame:
    """Data of a quantile plot, a row for each distinct p: observed -log10(p), how many rows have it, and the expected -log10(rank / (m + 1)) of its last rank."""
    return ranked(df, p, family).select(*family, (-F.log10("p")).alias("observed"), F.col("n").alias("n_points"), (-F.log10(F.col("rank") / (F.col("m") + 1))).alias("expected"))


def diagnostics(df: DataFrame, p: str = "pval", family: list[str] = ["dataset_id"], alpha: float = 0.05, fdr: float = 0.05, at: DataFrame | None = None) -> DataFrame:
    """One row for each family: tests, thresholds, discoveries, the largest rejected p (null if none) and inflation. All of them follow from the distinct p-values with their counts, so the rows are read once.

    `at`: the ranked p-values, if they are there already.
    """
    unit_interval(alpha=alpha, fdr=fdr)
    at = ranked(df, p, family) if at is None else at
    steps = _suffix(at.withColumn("raw", F.col("p") * (F.col("m") / F.col("rank"))), "raw", family, F.min)
    chosen = {"n_bonferroni": F.col("p") <= F.lit(alpha) / F.col("m"), "n_bh": F.least("_suffix", F.lit(1.0)) <= fdr}
    counts = steps.groupBy(*family).agg(F.max("m").alias("n_tests"), *[F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)).alias(n) for n, x in chosen.items()], F.max(F.when(chosen["n_bh"], F.col("p"))).alias("bh_raw_p_cutoff"), F.min("p").alias("min_p"))
    return counts.withColumn("bonferroni_threshold", F.lit(alpha) / F.col("n_tests")).join(_inflation(at, family).select(*family, "lambda_gc"), family)
