"""Normalisation of summary statistics with declared columns: alleles, effects, and p-values in log space."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.functions.numeric import neg_log10_decimal
from sorrel.operators.contract import finite, integer
from sorrel.operators.statistics import adjust_log_counts
from sorrel.sources.scratch import written

_BASE = "^[ACGT]$"


def normalise(rows: DataFrame, odds_ratio: bool = False, to_alt: bool = True, strand_known: bool = True) -> DataFrame:
    """Add reason (null: valid), beta, effect_allele_frequency, effect_allele, other_allele, effect_orientation and neg_log10_pvalue.

    Text columns: pos, ref, alt, effect_allele, other_allele, effect, standard_error, sample_size, frequency (empty: none), pvalue, and neg_log10 (empty: none). The first rule that a row breaks is its reason.
    A p-value of 0 needs neg_log10; with both, they must agree to 1e-10. On a known strand effects are turned towards ALT.
    """
    flip = {"A": "T", "C": "G", "G": "C", "T": "A"}
    comp = {k: F.translate(k, "".join(flip), "".join(flip.values())) for k in ("ref", "alt")}
    pair = F.array_sort(F.array("effect_allele", "other_allele"))
    same = pair == F.array_sort(F.array("ref", "alt"))
    fits = same if strand_known else same | (pair == F.array_sort(F.array(comp["ref"], comp["alt"])))
    effect, se, n = finite("effect"), finite("standard_error"), integer("sample_size")
    given, parsed = finite("neg_log10"), neg_log10_decimal("pvalue")
    zero = F.col("pvalue").rlike(r"^[+-]?0*\.?0*([eE][+-]?\d+)?$")
    agree = F.abs(given - parsed) <= F.greatest(F.lit(1e-10), F.lit(1e-10) * F.greatest(F.abs(given), F.abs(parsed)))
    af = finite("frequency")
    rules = [
        (integer("pos") > 0, "pos isn't a positive integer"),
        (F.col("ref").rlike(_BASE) & F.col("alt").rlike(_BASE) & (F.col("ref") != F.col("alt")), "REF/ALT isn't a single-base pair"),
        (F.col("effect_allele").rlike(_BASE) & F.col("other_allele").rlike(_BASE) & (F.col("effect_allele") != F.col("other_allele")), "invalid effect/other allele"),
        (fits, "effect alleles disagree with REF/ALT"),
        (n > 0, "sample size isn't a positive integer"),
        (effect.isNotNull(), "effect isn't a finite number"),
        (se > 0, "standard error isn't positive"),
        ((effect > 0) if odds_ratio else F.lit(True), "odds ratio isn't positive"),
        ((F.col("frequency") == "") | af.between(0, 1), "frequency is outside 0 to 1"),
        (F.when(zero, given >= 0).otherwise(parsed.isNotNull()), "p-value isn't in (0, 1], or is 0 without its logarithm"),
        ((F.col("neg_log10") == "") | zero | agree, "p-value and its logarithm disagree"),
    ]
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in rules])
    turn = F.lit(strand_known and to_alt) & (F.col("effect_allele") == F.col("ref"))
    beta = F.ln(effect) if odds_ratio else effect
    out = rows.withColumns({"reason": reason, "beta": F.when(turn, -beta).otherwise(beta), "effect_allele_frequency": F.when(turn, 1 - af).otherwise(af), "neg_log10_pvalue": F.coalesce(given, parsed)})
    aligned = F.lit(strand_known and to_alt)
    out = out.withColumn("effect_orientation", F.lit("unresolved_strand" if not strand_known else "aligned_to_ALT" if to_alt else "as_reported"))
    return out.withColumns({"effect_allele": F.when(aligned, F.col("alt")).otherwise(F.col("effect_allele")), "other_allele": F.when(aligned, F.col("ref")).otherwise(F.col("other_allele"))})


def split_invalid(normalised: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, excluded rows with their reason)."""
    return normalised.where("reason is null").drop("reason"), normalised.where("reason is not null")


def discoveries(normalised: DataFrame, adjusted: DataFrame, family: str = "dataset_id") -> DataFrame:
    """Input, tested, excluded, unresolved and significant rows of each family."""
    read = normalised.groupBy(family).agg(F.count("*").alias("n_input"), F.count_if(F.col("reason").isNotNull()).alias("n_excluded"))
    tested = adjusted.groupBy(family).agg(F.count("*").alias("n_tests"), F.count_if("bonferroni_significant").alias("bonferroni_discoveries"), F.count_if("bh_significant").alias("bh_discoveries"), F.count_if(F.col("effect_orientation") == "unresolved_strand").alias("n_unresolved"))
    return read.join(tested, family, "left").fillna(0)


def counted_discoveries(normalised: DataFrame, nlp: str = "neg_log10_pvalue", family: str = "dataset_id", alpha: float = 0.05, fdr: float = 0.05) -> DataFrame:
    """The same as `discoveries` of the rows and their corrections in log space. Rows are read once, to be counted by their value; what is corrected and joined are distinct values."""
    bad, unresolved = F.col("reason").isNotNull(), F.col("effect_orientation") == "unresolved_strand"
    counts = normalised.groupBy(family, F.when(~bad, F.col(nlp)).alias(nlp)).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.count_if(~bad & unresolved).alias("unresolved"))
    counts = written(counts, "values")
    read = counts.groupBy(family).agg(F.sum("n").alias("n_input"), F.sum("bad").alias("n_excluded"))
    valid = counts.where(F.col("n") > F.col("bad")).withColumn("n", F.col("n") - F.col("bad"))
    found = adjust_log_counts(valid, nlp, [family], alpha, fdr)
    some = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    tested = found.groupBy(family).agg(F.sum("n").alias("n_tests"), some("bonferroni_significant").alias("bonferroni_discoveries"), some("bh_significant").alias("bh_discoveries"), F.sum("unresolved").alias("n_unresolved"))
    return read.join(tested, family, "left").fillna(0)
