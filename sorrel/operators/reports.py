"""Checks of a report's tables against one another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def close(a: Column, b: Column) -> Column:
    """Equal to a relative 1e-9 or an absolute 1e-12."""
    return F.abs(a - b) <= F.greatest(F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b)), F.lit(1e-12))


def disagreements(summary: DataFrame, diagnostics: DataFrame, peaks: DataFrame, members: DataFrame, ranks: DataFrame, family: str = "dataset_id") -> DataFrame:
    """(family, check, expected, actual) of every check that fails.

    `summary` (n_tests, lambda_gc, n_signals, n_candidates) is held against `diagnostics` (n_tests, lambda_gc), against the rows of `peaks` and of `members`, and against `ranks` (signal_id, candidate_rank), whose ranks must be 1 to n and
    whose signals must be among the peaks. Families of the summary that another table lacks count as 0 there.
    """
    s = summary.select(family, *[F.col(c).cast("double").alias(f"_{c}") for c in ("n_tests", "lambda_gc", "n_signals", "n_candidates")])
    known = peaks.select(family, "signal_id").distinct().withColumn("_known", F.lit(1))
    counted = {
        "peaks": peaks.groupBy(family).agg(F.count("*").alias("n_peaks")),
        "members": members.groupBy(family).agg(F.count("*").alias("n_members")),
        "ranks": ranks.join(known, [family, "signal_id"], "left").groupBy(family).agg(F.count("*").alias("n_ranked"), F.max("candidate_rank").alias("top"), F.countDistinct("candidate_rank").alias("n_ranks"), F.count_if(F.col("_known").isNull()).alias("unknown")),
    }
    rows = reduce(lambda x, y: x.join(y, family, "left"), counted.values(), s.join(diagnostics.select(family, "n_tests", "lambda_gc"), family, "left")).fillna(0)
    checks = [
        ("n_tests", F.col("_n_tests"), F.col("n_tests"), F.col("_n_tests") == F.col("n_tests")),
        ("lambda_gc", F.col("_lambda_gc"), F.col("lambda_gc"), close(F.col("_lambda_gc"), F.col("lambda_gc"))),
        ("n_signals", F.col("_n_signals"), F.col("n_peaks"), F.col("_n_signals") == F.col("n_peaks")),
        ("n_members", F.col("_n_candidates"), F.col("n_members"), F.col("_n_candidates") == F.col("n_members")),
        ("n_ranked", F.col("_n_candidates"), F.col("n_ranked"), F.col("_n_candidates") == F.col("n_ranked")),
        ("dense_ranks", F.col("n_ranked"), F.col("top"), (F.col("n_ranked") == F.col("top")) & (F.col("n_ranked") == F.col("n_ranks"))),
        ("unknown_signals", F.lit(0.0), F.col("unknown"), F.col("unknown") == 0),
    ]
    listed = F.array(*[F.struct(F.lit(name).alias("check"), e.cast("double").alias("expected"), x.cast("double").alias("actual"), ok.alias("ok")) for name, e, x, ok in checks])
    return rows.select(family, F.explode(listed).alias("x")).where("not x.ok").select(family, "x.check", "x.expected", "x.actual")


#: What a summary may declare of a dataset, and all rows of its tables must agree with.
DECLARED = ("reference", "trait", "source_sha256")


def artifact_disagreements(summary: DataFrame, tables: dict[str, DataFrame], family: str = "dataset_id") -> DataFrame:
    """(family, table, check, expected, actual) of every check of a package's tables that fails.

    `summary` has a row for each family: n_tests, n_bonferroni, n_bh, lambda_gc, n_signals, n_candidates, and maybe reference, trait and source_sha256. `tables` are diagnostics, significant, peaks, members and ranks.

    rows: a diagnostics row for each family, as many peaks as signals, and as many rows of the others as candidates. foreign_rows: of families that the summary hasn't. A declared column's name: rows with another value than the
    summary's, for tables that have that column. n_tests, n_bonferroni, n_bh and lambda_gc: as in diagnostics. n_variants: the peaks' sizes add up to the candidates. unknown_signals: rows of members and ranks whose signal no peak has.
    dense_ranks: ranks are 1 to n. A family without rows in a table counts as 0 there, and a null in a compared cell as another value. Each table is reduced to a row for each family before it meets another.
    """
    known = tables["peaks"].select(family, "signal_id").distinct().withColumn("_known", F.lit(True))
    declared = [c for c in DECLARED if c in summary.columns]
    here = summary.withColumn("_here", F.lit(True))
    zero, found = F.lit(0.0), []
    for name, df in tables.items():
        texts = [c for c in declared if c in df.columns]
        sums = {"n": F.count("*")}
        if name in ("members", "ranks"):
            df = df.join(known, [family, "signal_id"], "left")
            sums["unknown"] = F.count_if(F.col("_known").isNull())
        if name == "ranks":
            sums |= {"top": F.max("candidate_rank"), "low": F.min("candidate_rank")}
        if name == "peaks":
            sums["members"] = F.sum("n_variants")
        measures = ("n_tests", "n_bonferroni", "n_bh", "lambda_gc") if name == "diagnostics" else ()
        sums |= {f"_{c}": F.max(F.col(c).cast("double")) for c in measures}
        parts = df.groupBy(family, *texts).agg(*[x.alias(k) for k, x in sums.items()])
        parts = parts.select(*[F.col(c).alias(f"_{c}" if c in texts else c) for c in parts.columns])
        odd = {c: F.sum(F.when(F.col(f"_{c}").eqNullSafe(F.col(c)), 0).otherwise(F.col("n"))) for c in texts}
        whole = parts.join(here.select(family, *texts, "_here"), family, "left").groupBy(family)
        whole = whole.agg(F.sum("n").alias("_rows"), *[x.alias(f"_odd_{c}") for c, x in odd.items()], *[(F.max if k[0] == "_" or k == "top" else F.min if k == "low" else F.sum)(k).alias(f"_at_{k}") for k in sums if k != "n"])
        if name == "ranks":
            whole = whole.join(df.groupBy(family).agg(F.countDistinct("candidate_rank").alias("_ranks")), family)
        both = here.select(family, "_here", "n_tests", "n_bonferroni", "n_bh", "lambda_gc", "n_signals", "n_candidates").join(whole, family, "full_outer").withColumn("_rows", F.coalesce("_rows", F.lit(0)))
        ours, rows = F.col("_here").isNotNull(), F.col("_rows").cast("double")
        expected = F.lit(1.0) if name == "diagnostics" else F.col("n_signals" if name == "peaks" else "n_candidates").cast("double")
        checks = [("foreign_rows", zero, F.when(ours, zero).otherwise(rows), ours), ("rows", expected, rows, ~ours | expected.eqNullSafe(rows))]
        checks += [(c, zero, F.col(f"_odd_{c}"), ~ours | (F.coalesce(f"_odd_{c}", F.lit(0)) == 0)) for c in texts]
        for c in measures:
            a, b = F.col(c).cast("double"), F.col(f"_at__{c}")
            checks.append((c, a, b, ~ours | (F.coalesce(close(a, b), F.lit(False)) if c == "lambda_gc" else a.eqNullSafe(b)) | (a.isNull() & b.isNull())))
        if name == "peaks":
            checks.append(("n_variants", F.col("n_candidates"), F.coalesce("_at_members", F.lit(0)), ~ours | (F.coalesce("_at_members", F.lit(0)) == F.col("n_candidates"))))
        if name in ("members", "ranks"):
            checks.append(("unknown_signals", zero, F.col("_at_unknown"), ~ours | (F.coalesce("_at_unknown", F.lit(0)) == 0)))
        if name == "ranks":
            dense = (F.col("_at_low") == 1) & (F.col("_at_top") == F.col("_rows")) & (F.col("_ranks") == F.col("_rows"))
            checks.append(("dense_ranks", rows, F.col("_at_top"), ~ours | (F.col("_rows") == 0) | F.coalesce(dense, F.lit(False))))
        listed = F.array(*[F.struct(F.lit(k).alias("check"), e.cast("double").alias("expected"), x.cast("double").alias("actual"), ok.alias("ok")) for k, e, x, ok in checks])
        found.append(both.select(family, F.lit(name).alias("table"), F.explode(listed).alias("x")).where("not x.ok").select(family, "table", "x.check", "x.expected", "x.actual"))
    return reduce(DataFrame.unionByName, found)


def uneven(summary: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, n_values) of the columns that haven't one value throughout; a null is a value. One package describes one run with one set of parameters."""
    counted = summary.agg(*[(F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "n_values").where("n_values is null or n_values != 1")


#: Fixed value: what a variant is, within a family.
VARIANT = ("chr", "pos", "allele1", "allele0")


def preview(ranks: DataFrame, members: DataFrame, most: int, family: str = "dataset_id") -> DataFrame:
    """The first `most` ranked candidates of each family with pval and beta of the member that is the same variant, and n_matches, the members that are: 1 where both tables hold the variant once. Without a match, pval and beta are null."""
    chosen = ranks.where(F.col("candidate_rank") <= most).select(family, "candidate_rank", "priority_tier", "signal_id", *VARIANT, "priority_reasons")
    found = members.join(chosen.select(family, *VARIANT).distinct(), [family, *VARIANT], "left_semi").groupBy(family, *VARIANT)
    found = found.agg(F.count("*").alias("n_matches"), F.min_by("pval", F.struct("pval", "beta")).alias("pval"), F.min_by("beta", F.struct("pval", "beta")).alias("beta"))
    return chosen.join(found, [family, *VARIANT], "left").fillna(0, ["n_matches"])


def repeated(df: DataFrame, family: str = "dataset_id") -> DataFrame:
    """Variants that a family's table holds more than once, with how often."""
    return df.groupBy(family, *VARIANT).agg(F.count("*").alias("n")).where("n > 1")


def mixed(df: DataFrame, columns: dict[str, str], family: str = "dataset_id") -> DataFrame:
    """(family, column) of the columns that hold another value than declared, or several."""
    per = df.groupBy(family).agg(*[F.count_if(~F.col(c).eqNullSafe(F.lit(v))).alias(c) for c, v in columns.items()])
    return per.unpivot([family], list(columns), "column", "n").where("n > 0").select(family, "column")


def totals(summary: DataFrame) -> DataFrame:
    """Datasets, signals and candidates of a report. Families aren't pooled: the sums only say how much there is."""
    return summary.agg(F.count("*").alias("n_datasets"), F.sum("n_signals").alias("n_signals"), F.sum("n_candidates").alias("n_candidates"))
