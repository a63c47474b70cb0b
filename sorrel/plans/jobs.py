"""Whole jobs: files in, a result folder out. Each is one call chain of operators with a few final writes."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.operators import assays, clusters, contract, crossref, customer, genotypes, intervals, layout, oligos, reports
from sorrel.functions.text import percent_encode
from sorrel.operators import statistics as st
from sorrel.sources import chains, readers, writers
from sorrel.sources.scratch import written


def load(spark: SparkSession, paths: dict[str, str], sums: dict[str, str] | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """Validate each dataset's table (checksum, header, rows, repeats, count), then all of them as typed rows with dataset_id."""
    out = None
    for name, path in paths.items():
        if sums and name in sums:
            readers.check_checksum(path, sums[name])
        contract.validate(readers.associations(spark, path), list(contract.COLUMNS), (counts or {}).get(name))
        one = readers.analysis(readers.associations(spark, path, ragged=False)).withColumn("dataset_id", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def validate_all(spark: SparkSession, paths: dict[str, str], sums: dict[str, str] | None = None, counts: dict[str, int] | None = None) -> dict[str, dict]:
    """The outcome of every dataset; a failure of one doesn't stop the others."""
    out = {}
    for name, path in paths.items():
        try:
            if sums and name in sums:
                readers.check_checksum(path, sums[name])
            n = contract.validate(readers.associations(spark, path), list(contract.COLUMNS), (counts or {}).get(name))
            out[name] = {"ok": True, "rows": n, "sha256": readers.checksum(path), "error": None}
        except (contract.ContractError, OSError) as e:
            out[name] = {"ok": False, "rows": 0, "sha256": None, "error": f"{type(e).__name__}: {e}"}
    return out


def told(df: DataFrame, about: dict[str, dict[str, str]] | None) -> DataFrame:
    """Add what is declared of each dataset (reference, trait, source_sha256)."""
    if not about:
        return df
    names = sorted({k for x in about.values() for k in x})
    rows = df.sparkSession.createDataFrame([(d, *(x.get(k) for k in names)) for d, x in about.items()], ", ".join(f"{c} string" for c in ("dataset_id", *names)))
    return df.join(F.broadcast(rows), "dataset_id", "left")


def diagnostics(rows: DataFrame, out: Path, alpha: float, fdr: float, about: dict[str, dict[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """The significant variants and the families' summary, both written once; `about`: what is declared of each dataset. The p-values are counted once for both."""
    at = st.ranked(rows, "pval", ["dataset_id"])
    summary = written(st.diagnostics(rows, alpha=alpha, fdr=fdr, at=at), "diagnostics")
    writers.write_tsv(told(summary, about), str(out / "diagnostics.tsv"), ["dataset_id"])
    significant = written(st.adjust(rows, alpha=alpha, fdr=fdr, at=at).where("bonferroni_significant or bh_significant"), "significant")
    writers.write_parts(significant, str(out / "significant_variants.tsv"), ["dataset_id", "src_row"])
    return significant, summary


def candidates(rows: DataFrame, out: Path, alpha: float, fdr: float, distance: int, about: dict[str, dict[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Significant variants, signals, members and ranking; the ranking and the families' summary."""
    significant, summary = diagnostics(rows, out, alpha, fdr, about)
    members = written(told(clusters.signals(significant, distance), about), "members")
    ranked = written(clusters.ranking(members), "ranked")
    writers.write_tsv(told(clusters.peaks(members), about), str(out / "association_peaks.tsv"), ["dataset_id", "signal_id"])
    writers.write_parts(members, str(out / "candidate_snps.tsv"), ["dataset_id", "signal_id", "pos", "src_row"])
    writers.write_tsv(ranked, str(out / "candidate_ranking.tsv"), ["dataset_id", "candidate_rank"])
    return ranked, summary


def manhattan(rows: DataFrame, out: Path) -> None:
    """Plot data, one row for each point, as Parquet: tables of this size aren't collected."""
    layout.manhattan(rows).write.parquet(str(out / "manhattan"))


def qq(rows: DataFrame, out: Path) -> None:
    """Data of a quantile plot, one row for each distinct p, as Parquet."""
    st.quantile_points(rows).write.parquet(str(out / "qq"))


def plots(rows: DataFrame, out: Path) -> None:
    manhattan(rows, out)
    qq(rows, out)


def regional(rows: DataFrame, regions: DataFrame, out: Path) -> None:
    """Plot data of each region's variants as Parquet, and the regions' top variants; a region without variants is an error."""
    inside = layout.in_regions(rows, regions).withColumn("y", -F.log10("pval"))
    if empty := regions.join(inside, "region_id", "left_anti").orderBy("region_no").limit(1).collect():
        raise contract.ContractError(f"region {empty[0].region_id} has no variants")
    inside.write.partitionBy("region_id").parquet(str(out / "regional"))
    top_variants(rows, regions, out)


def top_variants(rows: DataFrame, regions: DataFrame, out: Path) -> None:
    writers.write_tsv(layout.top_by_region(rows, regions), str(out / "top_variants_by_region.tsv"), ["dataset_id", "region_no"])


def batch(rows: DataFrame, out: Path, alpha: float, fdr: float, distance: int, about: dict[str, dict[str, str]] | None = None) -> None:
    """Everything for all datasets at once; one shared scan. The summary also says with what parameters, and what is declared of the datasets."""
    rows = rows.persist()
    plots(rows, out)
    ranked, summary = candidates(rows, out, alpha, fdr, distance, about)
    per = ranked.groupBy("dataset_id").agg(F.countDistinct("signal_id").alias("n_signals"), F.count("*").alias("n_candidates"))
    summary = summary.join(per, "dataset_id", "left").fillna(0, ["n_signals", "n_candidates"])
    summary = summary.withColumns({"alpha": F.lit(float(alpha)), "fdr_level": F.lit(float(fdr)), "clustering_distance": F.lit(distance)})
    writers.write_tsv(told(summary, about), str(out / "batch_summary.tsv"), ["dataset_id"])
    rows.unpersist()


#: Columns of a batch's tables that are numbers; all others are text, whatever they look like.
WHOLE = ("n_tests", "n_bonferroni", "n_bh", "n_signals", "n_candidates", "candidate_rank", "priority_tier", "pos", "start", "end", "n_variants", "n_members", "signal_no", "lead_pos", "src_row", "clustering_distance")
REAL = ("af", "beta", "pval", "bonferroni_p", "bh_p", "lambda_gc", "min_p", "bonferroni_threshold", "bh_raw_p_cutoff", "lead_pval", "lead_beta", "lead_af", "alpha", "fdr_level")
PARAMETERS = ("alpha", "fdr_level", "clustering_distance")
#: What of a batch's folder a package may hold: tables of one file, and tables and plot data in parts.
ARTIFACTS = ("batch_summary.tsv", "diagnostics.tsv", "association_peaks.tsv", "candidate_ranking.tsv", "candidate_snps.tsv", "significant_variants.tsv", "manhattan", "qq")


def batch_tables(spark: SparkSession, source: Path) -> dict[str, DataFrame]:
    """summary, diagnostics, significant, peaks, members and ranks of a batch folder, which must be as its provenance says (if it has one), agree in all that they share, and be of one run."""
    if (source / "provenance.json").exists():
        writers.verify(source, json.loads((source / "provenance.json").read_text(encoding="utf-8"))["outputs"])

    def read(name: str) -> DataFrame:
        kinds = dict.fromkeys(WHOLE, "bigint") | dict.fromkeys(REAL, "double")
        rows = spark.read.csv(str(writers.safe_path(str(source), name)), sep="\t", header=True, quote="")
        return rows.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else c for c in rows.columns])

    names = {"summary": "batch_summary", "diagnostics": "diagnostics", "significant": "significant_variants", "peaks": "association_peaks", "members": "candidate_snps", "ranks": "candidate_ranking"}
    tables = {k: read(f"{n}.tsv") for k, n in names.items()}
    summary = tables["summary"]
    if lost := set(PARAMETERS) - set(summary.columns):
        raise contract.SchemaError(f"batch_summary.tsv lacks {sorted(lost)}")
    if twice := summary.groupBy("dataset_id").count().where("count > 1").limit(1).collect():
        raise contract.DuplicateError(f"dataset {twice[0].dataset_id} is summed up more than once")
    if odd := reports.uneven(summary, PARAMETERS).collect():
        raise contract.ContractError(f"one batch has one set of parameters, but {odd[0].column} has {odd[0].n_values} values")
    rest = {k: x for k, x in tables.items() if k != "summary"}
    if odd := reports.artifact_disagreements(summary, rest).orderBy("dataset_id", "table", "check").limit(10).collect():
        raise contract.ContractError("tables disagree: " + "; ".join(f"{r.dataset_id}, {r.table}, {r.check}: expected {r.expected}, found {r.actual}" for r in odd))
    return tables


def report(spark: SparkSession, source: Path, out: Path) -> None:
    """Check a batch folder's tables against one another, then copy the small ones with a Markdown report and a manifest."""
    tables = batch_tables(spark, source)
    summary, ranked = tables["summary"], tables["ranks"]
    in_all = reports.totals(summary)
    writers.copied(spark, source, out, ("batch_summary.tsv", "association_peaks.tsv", "candidate_ranking.tsv"))
    (out / "report.md").write_text(writers.markdown("Association report", {"Totals (families aren't pooled)": in_all, "Datasets": summary.orderBy("dataset_id"), "Best candidates": ranked.orderBy("candidate_rank", "dataset_id")}), encoding="utf-8")
    (out / "manifest.json").write_text(writers.json_text(writers.manifest(out)), encoding="utf-8")


#: What a package doesn't claim; both of its reports say so.
LIMITS = (
    "Published summary statistics are summed up here; no association study was run again.",
    "A signal is a cluster by physical distance, neither a linkage block nor an independent locus.",
    "A lead variant isn't said to be causal. Tiers order candidates for validation; they say nothing of biological weight.",
    "Families are corrected apart, and totals only add up counts. Coordinates of different references aren't compared.",
    "lambda_gc is a diagnostic figure; no p-value was changed by it.",
)


def package(spark: SparkSession, source: Path, out: Path, need_provenance: bool = False, most_datasets: int = 1000) -> None:
    """A package to hand on: a short and a long report, a copy of the batch's tables and plot data under artifacts/, and what is needed to check it under reproducibility/.

    Nothing is computed again. Only the named tables and plot data are copied, by tasks; the reports show the first 3 and 10 candidates of each dataset. With `need_provenance`, a batch without a record of its run is refused.
    """
    record = source / "provenance.json"
    if need_provenance and not record.exists():
        raise contract.ContractError(f"{source.name} has no provenance.json")
    tables = batch_tables(spark, source)
    contract.at_most(tables["summary"], most_datasets, "datasets")
    for k in ("members", "ranks"):
        if twice := reports.repeated(tables[k]).limit(1).collect():
            raise contract.DuplicateError(f"{twice[0].dataset_id}: variant {twice[0].chr}:{twice[0].pos} is there {twice[0].n} times in {k}")
    datasets = [r.asDict() for r in tables["summary"].orderBy("dataset_id").collect()]
    best: dict[str, list] = {}
    for r in reports.preview(tables["ranks"], tables["members"], 10).orderBy("dataset_id", "candidate_rank").collect():
        if r.n_matches != 1:
            raise contract.ContractError(f"{r.dataset_id}: candidate {r.candidate_rank} is no member of a signal")
        best.setdefault(r.dataset_id, []).append(r)
    copies = writers.copied(spark, source, out / "artifacts", ARTIFACTS + (("provenance.json",) if record.exists() else ()))
    for name, text in (("executive_summary.md", _report_text("Summary", datasets, best, 3, False)), ("analysis_report.md", _report_text("Analysis report", datasets, best, 10, True))):
        (out / name).write_text(text, encoding="utf-8")
    folder = out / "reproducibility"
    folder.mkdir()
    known = json.loads(record.read_text(encoding="utf-8")) if record.exists() else {}
    (folder / "input_checksums.tsv").write_text("dataset_id\tsource_sha256\n" + "".join(f"{d['dataset_id']}\t{d.get('source_sha256') or ''}\n" for d in datasets), encoding="utf-8")
    (folder / "software_versions.json").write_text(writers.json_text({"report": writers.environment(), "analysis": known.get("environment")}), encoding="utf-8")
    texts = [{"relative_path": x, "sha256": readers.checksum(str(out / x)), "bytes": (out / x).stat().st_size} for x in ("executive_summary.md", "analysis_report.md", "reproducibility/input_checksums.tsv", "reproducibility/software_versions.json")]
    content = {"parameters": {k: datasets[0][k] for k in PARAMETERS} if datasets else {}, "datasets": [{k: v for k, v in d.items() if k not in PARAMETERS} for d in datasets], "limits": LIMITS, "run_id": known.get("run_id"), "artifacts": [{**c, "relative_path": f"artifacts/{c['relative_path']}", "role": c["relative_path"].split("/")[0].removesuffix(".tsv")} for c in copies] + [x | {"role": "report"} for x in texts]}
    (folder / "run_manifest.json").write_text(writers.json_text(content), encoding="utf-8")


def _table_text(head: tuple[str, ...], rows: list[tuple]) -> list[str]:
    return ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(writers.cell(x) for x in r) + " |" for r in rows), ""]


def _report_text(title: str, datasets: list[dict], best: dict[str, list], most: int, full: bool) -> str:
    """Markdown of one of a package's reports."""
    columns = ("dataset_id", *(c for c in ("reference", "trait", *(("source_sha256",) if full else ())) if datasets and c in datasets[0]), "n_tests", "n_bonferroni", "n_bh", "lambda_gc", "n_signals", "n_candidates")
    out = [f"# {title}", ""]
    if datasets:
        out += ["Parameters: " + ", ".join(f"{k} = {datasets[0][k]}" for k in PARAMETERS) + ", for each family apart.", ""]
    out += ["## Datasets", "", *_table_text(columns, [tuple(d[c] for c in columns) for d in datasets])]
    out += [f"In all {len(datasets)} datasets: {sum(d['n_signals'] for d in datasets)} signals and {sum(d['n_candidates'] for d in datasets)} candidates, counted apart.", "", "## Candidates", ""]
    for d in datasets:
        rows = best.get(d["dataset_id"], [])[:most]
        out += [f"### {d['dataset_id']}", ""]
        if not rows:
            out += ["No variant passes either correction.", ""]
            continue
        out += _table_text(("rank", "tier", "signal", "chr", "pos", "p", "beta", "reasons"), [(r.candidate_rank, r.priority_tier, r.signal_id, r.chr, r.pos, r.pval, r.beta, r.priority_reasons) for r in rows])
        if d["n_candidates"] > len(rows):
            out += [f"{d['n_candidates'] - len(rows)} more are in [artifacts/candidate_ranking.tsv](artifacts/candidate_ranking.tsv).", ""]
    if full:
        out += ["## Methods", "", "Bonferroni holds the chance of any false discovery in a family at alpha. Benjamini-Hochberg holds their expected share at fdr_level, if tests are independent or depend positively.", "", "## Files", "", "reproducibility/run_manifest.json lists all files with their checksums.", ""]
    return "\n".join([*out, "## Limits", "", *(f"* {x}" for x in LIMITS), ""])


def customer_summary(spark: SparkSession, table: str, columns: dict[str, str], fasta: str, out: Path, alpha: float, fdr: float, distance: int, exclude: bool = False, most_rows: int = 1_000_000, degrees: int = 1, **declared) -> None:
    """Normalise, correct in log space, cluster and rank a table whose columns are declared (role to column)."""
    raw = contract.at_most(readers.table(spark, table, tuple(columns.values())), most_rows, "rows")
    rows = raw.select(*[F.col(c).alias(r) for r, c in columns.items()], *[F.lit("").alias(r) for r in ("frequency", "neg_log10") if r not in columns], "src_row")
    valid, excluded = customer.split_invalid(customer.normalise(rows, **declared))
    if not exclude and (bad := excluded.limit(1).collect()):
        raise contract.RowError(f"row {bad[0].src_row}: {bad[0].reason}")
    excluded = excluded.withColumn("dataset_id", F.lit("summary"))
    valid = valid.withColumns({"dataset_id": F.lit("summary"), "pos": F.col("pos").cast("bigint"), "candidate_id": F.concat_ws(":", "chr", "pos", "ref", "alt")})
    if twice := valid.groupBy("candidate_id").count().where("count > 1").limit(1).collect():
        raise contract.DuplicateError(f"{twice[0].candidate_id} is there more than once")
    order = contig_order(spark, fasta)
    writers.write_parts(excluded, str(out / "excluded_rows.tsv"), ["src_row"])
    summary_tables(valid, excluded, order, out, alpha, fdr, distance, degrees)


def contig_order(spark: SparkSession, fasta: str) -> DataFrame:
    return readers.fasta_contigs(spark, fasta).select(F.col("contig").alias("chr"), F.col("contig_no").alias("contig_order"))


def summary_tables(valid: DataFrame, excluded: DataFrame, order: DataFrame, out: Path, alpha: float, fdr: float, distance: int, degrees: int = 1) -> None:
    """Corrections in log space, ranking, discoveries, inflation, plot data and a report of normalised rows. `excluded`: rows of the same families that weren't tested."""
    adjusted = written(st.adjust_log(valid, alpha=alpha, fdr=fdr), "adjusted")
    adjusted.write.parquet(str(out / "normalised"))
    ranked = written(clusters.log_ranking(adjusted.where("bonferroni_significant or bh_significant"), distance, order), "ranked")
    writers.write_tsv(ranked, str(out / "candidate_ranking.tsv"), ["dataset_id", "candidate_rank"])
    layout.contiguous_layout(adjusted, order).select("dataset_id", "candidate_id", "chr", "pos", "x", F.col("neg_log10_pvalue").alias("y")).write.parquet(str(out / "manhattan"))
    st.quantile_points_log(adjusted).write.parquet(str(out / "qq"))
    reasons = valid.select("dataset_id", F.lit(None).cast("string").alias("reason")).unionByName(excluded.select("dataset_id", "reason"))
    found = customer.discoveries(reasons, adjusted).join(st.inflation_log(adjusted, degrees=degrees).drop("n_tests"), "dataset_id", "left").withColumn("chi_square_df", F.lit(degrees)).orderBy("dataset_id")
    rows = [r.asDict() for r in contract.at_most(found, 1000, "families").collect()]
    (out / "statistical_diagnostics.json").write_text(writers.json_text(rows), encoding="utf-8")
    (out / "summary_report.md").write_text(writers.markdown("Summary statistics", {"Families (not pooled)": found, "Best candidates": ranked.orderBy("candidate_rank", "dataset_id").select("dataset_id", "candidate_rank", "signal_id", "chr", "pos", "neg_log10_pvalue", "priority_tier"), "Excluded rows": excluded.groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason")}), encoding="utf-8")


def context(spark: SparkSession, chosen: DataFrame, fasta: str, out: Path, flank: int, window: int, variants: DataFrame | None = None, mask: DataFrame | None = None, chunk: int = 1000) -> DataFrame:
    """Flanks, neighbours and mask overlap of candidates (candidate_id, chr, pos, ref, alt, strand), whose REF must be the sequence's base."""
    sizes = readers.fasta_contigs(spark, fasta).select(F.col("contig").alias("chr"), "length")
    chunks = readers.sequence_chunks(spark, fasta, chunk).persist()
    spans = intervals.flanks(chosen, sizes, flank)
    flanking = intervals.slices(spans.selectExpr("candidate_id", "chr", "interval_start as start", "interval_end as end"), chunks, "candidate_id", chunk)
    turned = F.when(F.col("strand") == "-", F.reverse(F.translate("bases", "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"))).otherwise(F.col("bases"))
    rows = spans.join(flanking, "candidate_id").withColumn("sequence", turned)
    wrong = rows.where(F.expr("substring(bases, cast(pos - interval_start + 1 as int), 1)") != F.col("ref")).limit(1).collect()
    if wrong:
        raise contract.RowError(f"{wrong[0].candidate_id}: REF isn't the base of the sequence")
    if mask is not None:
        hit = intervals.masked(rows.selectExpr("candidate_id", "chr", "interval_start as start", "interval_end as end"), mask, "candidate_id").select("candidate_id", "mask_overlap")
        rows = rows.join(hit, "candidate_id")
    near = None
    if variants is not None:
        near = intervals.neighbours(chosen.select("candidate_id", "chr", "pos", "ref", "alt"), variants, window)
        known = near.select("v_chr", "v_pos", "v_ref", "v_alt").distinct().withColumn("k", F.concat_ws(":", "v_chr", "v_pos", "v_ref", "v_alt"))
        held = intervals.slices(known.selectExpr("k", "v_chr as chr", "v_pos as start", "v_pos + greatest(length(v_ref), 1) - 1 as end"), chunks, "k", chunk)
        if odd := intervals.neighbour_violations(chosen, known.join(held, "k", "left"), window, F.col("bases")).limit(1).collect():
            raise contract.RowError(f"variant {odd[0].k}: {odd[0].reason}")
        if twice := near.groupBy("candidate_id", "v_pos", "v_ref", "v_alt").count().where("count > 1").limit(1).collect():
            raise contract.DuplicateError(f"variant {twice[0].v_pos} {twice[0].v_ref}>{twice[0].v_alt} is there more than once near {twice[0].candidate_id}")
        counts = near.groupBy("candidate_id").agg(F.count("*").alias("neighbor_count"))
        rows = rows.join(counts, "candidate_id", "left").fillna(0, ["neighbor_count"])
        writers.write_parts(near, str(out / "neighbors.tsv"), ["candidate_id", "v_pos", "v_ref", "v_alt"])
    writers.write_tsv(rows.drop("bases").withColumn("sequence_sha256", F.sha2("sequence", 256)), str(out / "candidate_context.tsv"), ["candidate_id"])
    named = rows.select(F.concat(percent_encode("candidate_id"), *[F.concat(F.lit(f" {c}="), percent_encode(c)) for c in ("chr", "pos", "strand")], F.lit(" sha256="), F.sha2("sequence", 256)).alias("name"), "sequence")
    writers.write_fasta(named, str(out / "flanking_sequences.fasta"), "name", "sequence")
    return rows


def primers(rows: DataFrame, out: Path, settings: oligos.Settings, variants: DataFrame | None = None, window: int | None = None, known: DataFrame | None = None) -> None:
    """Designs and rejection counts of candidates with their context (sequence on the candidate's strand). `variants` (v_chr, v_pos, v_ref, v_alt) are the cohort's; those within `window` of a candidate may block designs. `known` (candidate_id, v_pos, v_ref) are neighbours already found."""
    chosen = rows.select("candidate_id", "chr", "pos", "ref", "alt", "strand", "sequence", F.col("snp_offset").cast("int").alias("offset"), "interval_start", "interval_end")
    if variants is not None:
        known = intervals.neighbours(chosen.select("candidate_id", "chr", "pos", "ref", "alt"), variants, window or 0).select("candidate_id", "v_pos", "v_ref")
    designs, rejected = oligos.design(chosen, settings, known, window)
    designs = designs.persist()
    writers.write_tsv(designs, str(out / "designs.tsv"), ["candidate_id", "rank"])
    writers.write_tsv(oligos.markers(chosen.drop("sequence"), designs, rejected), str(out / "marker_candidates.tsv"), ["candidate_id"])
    best = designs.groupBy("candidate_id").agg(F.count("*").alias("designs"), F.min("score").alias("best_score"))
    (out / "marker_design_report.md").write_text(writers.markdown("Primer design report", {"Designs by candidate": best.orderBy("candidate_id"), "Reasons": rejected.groupBy("reason").agg(F.sum("n").alias("n")).orderBy("reason")}), encoding="utf-8")
    designs.unpersist()


def assay_review(results: DataFrame, designs: DataFrame, meta: dict, out: Path, previous: DataFrame | None = None, history: DataFrame | None = None, earlier: DataFrame | None = None, most_rows: int = 100_000) -> None:
    """Results that keep the contract are measured and reviewed; the first that doesn't is an error. `history`: redesign edges from designs of `earlier` to these."""
    contract.at_most(results, most_rows, "assay rows")
    if "allele_encoding" in results.columns:
        identity = tuple(c for c in ("candidate_id", "ref", "alt") if c in results.columns and c in designs.columns)
        if bad := assays.violations(results, designs, meta["conditions_id"], identity).orderBy("src_row").limit(1).collect():
            raise contract.RowError(f"row {bad[0].src_row}: {bad[0].reason}")
    if lost := results.join(designs, "design_id", "left_anti").limit(1).collect():
        raise contract.RowError(f"design {lost[0].design_id} isn't known")
    if history is not None and (bad := assays.history_violations(history, earlier, designs).orderBy("prior_design_id", "replacement_design_id").limit(1).collect()):
        raise contract.RowError(f"redesign of {bad[0].prior_design_id} by {bad[0].replacement_design_id}: {bad[0].reason}")
    measured = written(assays.metrics(results), "metrics")
    reviewed = written(assays.review(measured, meta, previous), "states")
    for name, df, order in (("metrics", measured, ["design_id"]), ("states", reviewed, ["design_id"]), ("state_counts", assays.state_counts(reviewed), ["state"]), ("alternatives", assays.alternatives(designs, reviewed), ["design_id", "alternative_id"]), ("validated_panel", assays.panel(designs, reviewed), ["design_id"])):
        writers.write_tsv(df, str(out / f"{name}.tsv"), order)
    if history is not None:
        writers.write_tsv(history, str(out / "redesign_history.tsv"), ["prior_design_id", "replacement_design_id"])


def check_snps(rows: DataFrame, chunks: DataFrame, name: str, chunk: int = 1000) -> None:
    """Variants (chr, pos, ref, alt) must be two different single bases, REF that of the sequence at their place."""
    single = F.col("ref").rlike("^[ACGT]$") & F.col("alt").rlike("^[ACGT]$") & (F.col("ref") != F.col("alt"))
    places = rows.select("chr", "pos").distinct().withColumn("k", F.concat_ws(":", "chr", "pos"))
    bases = places.where("pos >= 1").join(intervals.slices(places.where("pos >= 1").selectExpr("k", "chr", "pos as start", "pos as end"), chunks, "k", chunk), "k", "left").select("chr", "pos", "bases")
    odd = rows.join(bases, ["chr", "pos"], "left").where(~F.coalesce(single & (F.col("bases") == F.col("ref")), F.lit(False))).limit(1).collect()
    if odd:
        raise contract.RowError(f"{odd[0][name]}: REF isn't the base at {odd[0].chr}:{odd[0].pos}, or REF and ALT aren't two single bases")


@dataclass(frozen=True)
class Assembly:
    """One side of a cross-reference: what its tables must say of themselves, and its sequence and genes."""

    reference: str
    assembly_id: str
    dataset_ids: tuple[str, ...]
    fasta: str
    annotation: str | None = None


def _candidate_table(spark: SparkSession, path: str, assembly: Assembly, chunks: DataFrame, trait: str, most: int) -> DataFrame:
    """A candidate table that keeps its contract: whole rows of one analysis of the trait, of the assembly's own datasets, with REF as in its sequence."""
    text = contract.at_most(readers.table(spark, path, crossref.CANDIDATE), most, "candidates")
    rows = text.select(*[F.trim(c).alias(c) for c in crossref.CANDIDATE if c != "pos"], contract.integer("pos").alias("pos"))
    if bad := crossref.candidate_violations(rows, crossref.CANDIDATE).orderBy("candidate_id").limit(1).collect():
        raise contract.RowError(f"{path}, {bad[0].candidate_id}: {bad[0].reason}")
    if rows.select(*crossref.FAMILY).distinct().limit(2).count() > 1:
        raise contract.ContractError(f"{path} holds more than one analysis")
    foreign = (F.col("trait") != trait) | (F.col("reference") != assembly.reference) | (F.col("assembly_id") != assembly.assembly_id) | ~F.col("dataset_id").isin(*assembly.dataset_ids)
    if odd := rows.where(foreign).limit(1).collect():
        raise contract.ContractError(f"{path}, {odd[0].candidate_id}: not of trait {trait}, or of another assembly or dataset than declared")
    check_snps(rows, chunks, "candidate_id")
    return rows


def _annotated(spark: SparkSession, rows: DataFrame, assembly: Assembly, side: str) -> DataFrame:
    """Nearest genes of each candidate of a side, ties kept."""
    if assembly.annotation is None:
        none = F.lit(None).cast("string")
        near = rows.select("candidate_id", "chr", "pos", none.alias("gene_id"), none.cast("bigint").alias("gene_start"), none.cast("bigint").alias("gene_end"), none.alias("gene_strand"), none.cast("bigint").alias("distance_bp"), F.lit("no_annotation_supplied").alias("annotation_status"))
    else:
        genes = readers.genes(spark, assembly.annotation)
        contigs = readers.fasta_contigs(spark, assembly.fasta).select(F.col("contig").alias("chr"), "length")
        if odd := readers.intervals_outside(genes, contigs, "g_chr", "g_start", "g_end").limit(1).collect():
            raise contract.RowError(f"{assembly.annotation}: gene {odd[0].gene_id} isn't within its contig")
        strands = genes.select("gene_id", "g_chr", "g_start", "g_end", F.col("strand").alias("gene_strand")).distinct()
        near = intervals.nearest(rows, genes, "candidate_id").join(strands.withColumnRenamed("g_chr", "chr"), ["gene_id", "chr", "g_start", "g_end"], "left")
        near = near.select("candidate_id", "chr", "pos", "gene_id", F.col("g_start").alias("gene_start"), F.col("g_end").alias("gene_end"), "gene_strand", F.col("distance").alias("distance_bp"), F.col("relation").alias("annotation_status"))
    return near.join(rows.select("candidate_id", "dataset_id", "reference", "assembly_id", "ref", "alt", "trait"), "candidate_id").withColumn("side", F.lit(side))


def cross_reference(spark: SparkSession, source_table: str, source: Assembly, out: Path, trait: str, target_table: str | None = None, target: Assembly | None = None, chain: str | None = None, most: int = 10_000, most_blocks: int = 1_000_000, most_hits: int = 100_000) -> None:
    """Annotate candidates of one or two assemblies with genes; map those of the source over a checked chain, compare them with those of the target, and account for every candidate of both sides."""
    if (target is None) != (target_table is None) or (chain is not None and target is None):
        raise contract.ContractError("a target needs a table and an assembly, and a chain needs a target")
    if target is not None and target.assembly_id == source.assembly_id:
        raise contract.ContractError("the two sides are of one assembly")
    sides, chunks = {"source": (source_table, source)} | ({"target": (target_table, target)} if target else {}), {}
    rows, notes = {}, []
    for side, (path, assembly) in sides.items():
        chunks[side] = written(readers.sequence_chunks(spark, assembly.fasta), "chunks")
        rows[side] = written(_candidate_table(spark, path, assembly, chunks[side], trait, most), "candidates")
        notes.append(_annotated(spark, rows[side], assembly, side))
    annotations = written(notes[0] if len(notes) == 1 else notes[0].unionByName(notes[1]), "annotations")
    writers.write_parts(annotations, str(out / "candidate_annotations.tsv"), ["side", "candidate_id", "gene_start"])
    own = rows["source"].select("candidate_id", "chr", "pos", "ref", "alt")
    if chain is None:
        mapping = crossref.mapped(own, None, None)
        account = mapping.select(F.lit("source").alias("side"), "candidate_id", "status", "reason", F.lit(0).cast("bigint").alias("n_hits"), F.lit("").alias("linked_candidates"))
        if target is not None:
            account = account.unionByName(rows["target"].select(F.lit("target").alias("side"), "candidate_id", F.lit("not_compared").alias("status"), F.lit("no_source_comparison_not_evidence_of_absence").alias("reason"), F.lit(0).cast("bigint").alias("n_hits"), F.lit("").alias("linked_candidates")))
        n_compared = 0
    else:
        contigs = {side: readers.fasta_contigs(spark, x.fasta).select(F.col("contig").alias("chr"), "length") for side, (_, x) in sides.items()}
        blocks = chains.chain_blocks(spark, chain, contigs["source"], contigs["target"], most_blocks)
        hits = contract.at_most(written(intervals.map_points(own, blocks, "candidate_id"), "hits"), most_hits, "mapping hits")
        places = hits.select("target_chr", "target_pos").distinct().withColumn("k", F.concat_ws(":", "target_chr", "target_pos"))
        bases = intervals.slices(places.selectExpr("k", "target_chr as chr", "target_pos as start", "target_pos as end"), chunks["target"], "k", 1000)
        mapping = crossref.mapped(own, hits, places.join(bases, "k").select("target_chr", "target_pos", F.col("bases").alias("target_base")))
        mapping = written(mapping.join(hits.select("candidate_id", "chain_id", "target_chr", "target_pos", "chain_score", "block_size"), ["candidate_id", "chain_id", "target_chr", "target_pos"], "left"), "mapping")
        pairs = written(crossref.compared_in_full(mapping, rows["source"], rows["target"]), "comparisons")
        genes = {side: intervals.gene_ids(annotations.where(F.col("side") == side), "candidate_id").withColumnsRenamed({"candidate_id": key, "gene_ids": f"{side}_gene_ids"}) for side, key in (("source", "candidate_id"), ("target", "t_id"))}
        writers.write_parts(pairs.join(genes["source"], "candidate_id").join(genes["target"], "t_id"), str(out / "cross_reference_comparison.tsv"), ["candidate_id", "t_id"])
        account = crossref.account(own, mapping, pairs, rows["target"].select(F.col("candidate_id").alias("t_id")))
        n_compared = pairs.count()
    account = written(account, "accounting")
    writers.write_parts(mapping, str(out / "coordinate_mappings.tsv"), ["candidate_id"])
    writers.write_parts(account, str(out / "candidate_accounting.tsv"), ["side", "candidate_id"])
    states = {r.status: r.n for r in account.where("side = 'source'").groupBy("status").agg(F.count("*").alias("n")).collect()}
    summary = {"trait": trait, "n_source": rows["source"].count(), "n_target": rows["target"].count() if target else 0, "n_comparisons": n_compared, "cross_reference_status": "not_assessed" if chain is None else "assessed_against_supplied_chain", "source_status_counts": {x: states.get(x, 0) for x in ("mapped", "unmapped", "multimap", "ambiguous", "not_assessed")}}
    (out / "comparison_summary.json").write_text(writers.json_text(summary), encoding="utf-8")
    text = [
        "# Candidates across assemblies", "", *(f"* {k}: {v}" for k, v in summary.items()), "",
        "A unique hit is unique in the supplied alignment only. Candidates without a counterpart are no evidence of absence, families aren't pooled, one cohort on two assemblies is no replication, and a near gene isn't a causal one.", "",
    ]
    (out / "comparison_report.md").write_text("\n".join(text), encoding="utf-8")


def individual_gwas(long: DataFrame, phenotype: DataFrame, covariates: list[str], out: Path, min_maf: float = 0.01, max_missing: float = 0.1, n_components: int = 2, most_samples: int = 1000, max_sample_missing: float = 0.1, most_markers: int = 100_000, most_cells: int = 5_000_000, variants: DataFrame | None = None, order: DataFrame | None = None, dataset_id: str = "individual", alpha: float = 0.05, fdr: float = 0.05, distance: int = 0) -> None:
    """Marker and sample checks, kinship, components, a null model and a test of each marker. `phenotype`: sample_id, value and the covariates. With `variants` (marker_id, chr, pos, ref, alt) and the `order` of their contigs, also what follows
    from the tests: corrections, clusters, ranking, discoveries, inflation and plot data."""
    import numpy as np

    genotypes.ids_aligned({"genotypes": long, "phenotype": phenotype})
    size = long.agg(F.countDistinct("sample_id").alias("samples"), F.countDistinct("marker_id").alias("markers"), F.count("*").alias("cells")).first()
    if size.samples < 4 or size.samples > most_samples or size.markers > most_markers or size.cells > most_cells or size.cells != size.samples * size.markers:
        raise contract.ContractError(f"{size.samples} samples, {size.markers} markers and {size.cells} cells: there must be 4 to {most_samples} samples, {most_markers} markers and {most_cells} cells at most, and a cell for each")
    values = phenotype.agg(F.countDistinct("value").alias("n"), F.count_if(F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf"))).alias("odd")).first()
    if values.odd or values.n < 3:
        raise contract.RowError("the phenotype must be finite and have three values or more")
    scales = phenotype.agg(*[f(F.col(c)).alias(f"{n}_{c}") for c in covariates for n, f in (("mean", F.avg), ("scale", F.stddev_pop))]).first().asDict() if covariates else {}
    if flat := [c for c in covariates if not (scales[f"scale_{c}"] or 0) > 0 or not np.isfinite(scales[f"scale_{c}"])]:
        raise contract.RowError(f"covariates must be finite and vary: {flat}")
    samples = written(genotypes.sample_checks(long, max_sample_missing), "sample-checks")
    if bad := samples.where("not ok").limit(1).collect():
        raise contract.RowError(f"sample {bad[0].sample_id} misses {bad[0].missing:.3f} of its markers")
    checks = written(genotypes.marker_checks(long, min_maf, max_missing), "marker-checks")
    z = written(genotypes.centred(long, checks), "centred")
    ids, k = genotypes.matrix(genotypes.kinship(z), most_samples)
    eigen = np.linalg.eigvalsh(k)[::-1]
    if n_components > np.count_nonzero(eigen > max(float(eigen[0]), 1) * 1e-10):
        raise contract.ContractError("more components than the kinship has positive rank")
    scores = genotypes.components(k, n_components)
    rows = {r.sample_id: r for r in genotypes.scaled(phenotype, covariates).collect()}
    x = np.column_stack([np.ones(len(ids)), *[[rows[i][c] for i in ids] for c in covariates], scores])
    model = genotypes.fit_null(np.array([rows[i].value for i in ids], float), x, k)
    tests = written(genotypes.test_markers(z, ids, model), "associations")
    spark = long.sparkSession
    writers.write_tsv(checks, str(out / "marker_checks.tsv"), ["marker_id"])
    writers.write_tsv(samples, str(out / "sample_qc.tsv"), ["sample_id"])
    writers.write_tsv(tests, str(out / "associations.tsv"), ["marker_id"])
    np.save(out / "kinship.npy", k)
    (out / "kinship.samples.txt").write_text("\n".join(map(str, ids)) + "\n")
    if n_components:
        pcs = spark.createDataFrame([(i, *map(float, r)) for i, r in zip(ids, scores, strict=True)], ["sample_id", *(f"PC{j + 1}" for j in range(n_components))])
        writers.write_tsv(pcs, str(out / "pc_scores.tsv"), ["sample_id"])
    n_tests = tests.where("reason = ''").count()
    record = {
        "model": "y = intercept + covariates + components + beta * ALT dosage + u + e", "kinship": "Z Z' / (2 sum p (1 - p))", "imputation": "mean dosage of each marker", "covariance_ratio": model.delta, "log_ratio_bounds": [-12, 12],
        "residual_df": model.df, "pvalue": "two-sided t; the ratio is fitted without markers and held", "covariates": scales, "n_components": n_components, "component_eigenvalues": [float(v) for v in eigen[:n_components]],
        "n_samples": size.samples, "n_input_markers": size.markers, "n_kinship_markers": z.select("marker_id").distinct().count(), "n_tests": n_tests,
    }
    (out / "model.json").write_text(writers.json_text(record), encoding="utf-8")
    if variants is None or order is None:
        return
    named = variants.select("marker_id", "chr", "pos", "ref", "alt")
    tested = tests.where("reason = ''").join(named, "marker_id").withColumns({"dataset_id": F.lit(dataset_id), "candidate_id": F.concat_ws(":", "chr", "pos", "ref", "alt"), "effect_allele": F.col("alt"), "other_allele": F.col("ref"), "effect_orientation": F.lit("aligned_to_ALT")}).drop("reason")
    tested = tested.join(checks.select("marker_id", F.col("alt_frequency").alias("effect_allele_frequency")), "marker_id")
    excluded = checks.where("reasons != ''").select("marker_id", F.col("reasons").alias("reason")).unionByName(tests.where("reason != ''").select("marker_id", F.lit("collinear_with_covariates").alias("reason"))).withColumn("dataset_id", F.lit(dataset_id))
    writers.write_tsv(excluded, str(out / "excluded_markers.tsv"), ["marker_id"])
    summary_tables(tested, excluded, order, out, alpha, fdr, distance)
