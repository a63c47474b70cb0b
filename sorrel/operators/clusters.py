"""Distance-based signals among significant positions, their lead variants, and candidate rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorrel.functions.text import natural_key
from sorrel.operators.layout import ranked


#: Width of the bins of positions by which islands are found.
WIDTH = 1_000_000


def islands(df: DataFrame, distance: int, keys: list[str], position: str = "pos", width: int = WIDTH) -> DataFrame:
    """Add island: numbered from 1 within `keys`; a gap of more than `distance` to the position before opens a new one.

    Bins of positions are searched apart, so no task holds all of a chromosome. Each bin's first and last position are then laid beside those of the bins around it, which says whether its first position goes on from an
    earlier bin and how many islands opened before.
    """
    rows = df.withColumn("_bin", F.floor(F.col(position) / width))
    w = Window.partitionBy(*keys, "_bin").orderBy(position)
    rows = rows.withColumn("_opens", F.when(F.col(position) - F.lag(position).over(w) > distance, 1).otherwise(0))
    bins = rows.groupBy(*keys, "_bin").agg(F.min(position).alias("_low"), F.max(position).alias("_high"), F.sum("_opens").alias("_inner"))
    over = Window.partitionBy(*keys).orderBy("_bin")
    first = F.when(F.col("_low") - F.lag("_high").over(over) <= distance, 0).otherwise(1)
    bins = bins.withColumn("_first", first).withColumn("_before", F.col("_first") + F.coalesce(F.sum(F.col("_first") + F.col("_inner")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # rows at one position are peers, whichever comes first
    here = F.sum("_opens").over(w.rangeBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_here", here).join(bins.select(*keys, "_bin", "_before"), [*keys, "_bin"]).withColumn("island", F.col("_before") + F.col("_here")).drop("_bin", "_opens", "_here", "_before")


def _numbered(rows: DataFrame, family: str, order: list) -> DataFrame:
    """Add signal_no, which goes on from chromosome to chromosome in `order`, and n_members. Islands are counted for each chromosome, so only chromosomes are in one task."""
    sizes = rows.groupBy(family, "chr", "island").agg(F.count("*").alias("n_members"))
    last = rows.groupBy(family, "chr").agg(F.max("island").alias("_last"), *[F.first(c).alias(c) for c in order if isinstance(c, str)])
    before = F.coalesce(F.sum("_last").over(Window.partitionBy(family).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(sizes, [family, "chr", "island"]).join(last.select(family, "chr", before.alias("_start")), [family, "chr"])
    return rows.withColumn("signal_no", F.col("_start") + F.col("island")).drop("_start", "island")


def signals(significant: DataFrame, distance: int, family: str = "dataset_id") -> DataFrame:
    """Add signal_no, signal_id, n_members and is_lead to significant variants.

    Signals are numbered within a family by natural chromosome order, then position. The lead is the smallest p, then the largest |beta|, then position, then source row.
    """
    rows = _numbered(islands(significant, distance, [family, "chr"]), family, natural_key("chr"))
    lead = F.struct(F.col("pval").alias("p"), (-F.abs("beta")).alias("b"), F.col("pos").alias("at"), F.col("src_row").alias("r"))
    leads = rows.groupBy(family, "signal_no").agg(F.min(lead).alias("_lead"))
    rows = rows.join(leads, [family, "signal_no"]).withColumn("is_lead", F.col("_lead").eqNullSafe(lead)).drop("_lead")
    return rows.withColumn("signal_id", F.format_string("%s_peak_%04d", F.col(family), F.col("signal_no")))


def peaks(members: DataFrame, family: str = "dataset_id") -> DataFrame:
    """One row for each signal: its span, size, and lead."""
    lead = F.col("is_lead")
    picked = [F.max(F.when(lead, F.col(c))).alias(f"lead_{c}") for c in ("pos", "allele1", "allele0", "pval", "beta", "af")]
    return members.groupBy(family, "signal_id", "chr").agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.count("*").alias("n_variants"), *picked)


def ranking(members: DataFrame, family: str = "dataset_id") -> DataFrame:
    """Add priority_tier (1 Bonferroni, 2 BH only), priority_reasons and candidate_rank: tier, p, |beta| descending, position, source row."""
    tier = F.when(F.col("bonferroni_significant"), 1).otherwise(2)
    reasons = F.concat_ws(";", F.when(F.col("bonferroni_significant"), "bonferroni_significant"), F.when(F.col("bh_significant"), "bh_significant"), F.when(F.col("is_lead"), "lead_variant_of_signal"), F.when(F.col("n_members") > 1, "member_of_multi_variant_signal").otherwise("single_variant_signal"))
    rows = members.withColumns({"priority_tier": tier, "priority_reasons": reasons})
    return ranked(rows, [F.col("priority_tier"), F.col("pval"), -F.abs("beta"), F.col("pos"), F.col("src_row")], "candidate_rank", [family])


def log_ranking(significant: DataFrame, distance: int, contigs: DataFrame, family: str = "dataset_id") -> DataFrame:
    """The second contract: signals numbered over contigs in declared order, rank by -nlp, contig, position, candidate_id; the tier isn't a key.

    `contigs` (chr, contig_order) is the list of an assembly's sequences.
    """
    rows = _numbered(islands(significant.join(contigs, "chr"), distance, [family, "chr"]), family, ["contig_order"])
    rows = rows.withColumns({"signal_id": F.format_string("signal-%05d", F.col("signal_no")), "priority_tier": F.when(F.col("bonferroni_significant"), "Bonferroni").otherwise("BH_only")})
    return ranked(rows, [-F.col("neg_log10_pvalue"), F.col("contig_order"), F.col("pos"), F.col("candidate_id")], "candidate_rank", [family])
