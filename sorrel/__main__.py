"""Commands over files: python -m sorrel COMMAND --help."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.operators import genotypes
from sorrel.operators.contract import ContractError
from sorrel.operators.oligos import Settings, load_settings
from sorrel.plans import jobs
from sorrel.sources import declared, readers, scratch, writers


#: Commands over association tables.
TABLES = ("validate", "plots", "manhattan", "qq", "top-variants", "regional", "regions", "all", "diagnostics", "candidates", "batch")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sorrel")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *tables: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--out", required=True)
        for t in tables:
            c.add_argument(f"--{t}", required=True)
        return c

    for name in TABLES:
        c = command(name)
        c.add_argument("--table", action="append", default=[], metavar="DATASET=PATH")
        c.add_argument("--manifest", help="TOML file of datasets with checksums and row counts, instead of --table, --sha256 and --rows")
        c.add_argument("--data", help="folder of the manifest's files")
        c.add_argument("--dataset", action="append", default=[], help="of the manifest's datasets, only these")
        c.add_argument("--sha256", action="append", default=[], metavar="DATASET=HEX")
        c.add_argument("--rows", action="append", default=[], metavar="DATASET=N")
        if name in ("top-variants", "regions", "all"):
            c.add_argument("--regions", required=True)
        if name == "regional":
            c.add_argument("--regions", help="region document, instead of --chrom, --start and --end")
            c.add_argument("--chrom")
            c.add_argument("--start", type=int)
            c.add_argument("--end", type=int)
        if name in ("diagnostics", "candidates", "batch"):
            c.add_argument("--alpha", type=float, default=0.05)
            c.add_argument("--fdr", type=float, default=0.05)
        if name in ("candidates", "batch"):
            c.add_argument("--distance", type=int, required=True)
    command("report", "batch")
    c = command("package", "batch")
    c.add_argument("--require-provenance", action="store_true")
    command("reference", "bundle", "dataset-id", "reference", "assembly-id")
    c = command("customer-summary", "table", "fasta")
    c.add_argument("--columns", help="TOML file: which column has what")
    c.add_argument("--metadata", help="TOML file with columns, scales and identity, instead of --columns")
    c.add_argument("--max-rows", type=int, default=1_000_000)
    c.add_argument("--distance", type=int, required=True)
    c.add_argument("--alpha", type=float, default=0.05)
    c.add_argument("--fdr", type=float, default=0.05)
    c.add_argument("--exclude-invalid", action="store_true")
    c.add_argument("--odds-ratio", action="store_true")
    c = command("context", "candidates", "fasta")
    c.add_argument("--flank", type=int, default=180)
    c.add_argument("--window", type=int, default=180)
    c.add_argument("--vcf")
    c.add_argument("--reference", help="what the VCF's ##reference line must name")
    c.add_argument("--mask")
    c.add_argument("--primers", action="store_true", help="also design primers")
    c.add_argument("--primer-settings", help="TOML file with [primer]")
    c = command("assay-review", "results", "designs", "metadata")
    c.add_argument("--previous", help="table of earlier states")
    c.add_argument("--history", help="table of redesigns, with --previous-designs")
    c.add_argument("--previous-designs", help="table of the designs before")
    c.add_argument("--max-rows", type=int, default=100_000)
    c = command("cross-reference", "source", "source-bundle", "trait")
    c.add_argument("--target")
    c.add_argument("--target-bundle")
    c.add_argument("--chain-metadata", help="TOML file of a reviewed chain between the two assemblies")
    c.add_argument("--max-candidates", type=int, default=10_000)
    c = command("primers", "context", "neighbors")
    c.add_argument("--window", type=int, required=True, help="bases around a candidate within which neighbours are known")
    c.add_argument("--primer-settings", help="TOML file with [primer]")
    c = command("individual-gwas", "genotypes", "phenotype")
    c.add_argument("--covariate", action="append", default=[])
    c.add_argument("--config", help="TOML file with limits, components and covariates")
    c.add_argument("--variants", help="variant table, with --samples, --bundle and --config: tables are held against each other and the sequence")
    c.add_argument("--samples", help="sample table with cohort and covariates")
    c.add_argument("--bundle", help="TOML file of the assembly")
    return p


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def _datasets(a: argparse.Namespace) -> tuple[dict[str, str], dict[str, str], dict[str, int], dict[str, dict[str, str]]]:
    """Paths, checksums, row counts and declared texts of the datasets that are named one by one or by a manifest."""
    if not a.manifest:
        if not a.table or a.data or a.dataset:
            raise ContractError("name datasets by --table, or by --manifest with --data")
        return _pairs(a.table), _pairs(a.sha256), {k: int(v) for k, v in _pairs(a.rows).items()}, {k: {"source_sha256": v} for k, v in _pairs(a.sha256).items()}
    if not a.data or a.table or a.sha256 or a.rows:
        raise ContractError("a manifest needs --data, and says itself what the tables are")
    m = declared.load_manifest(a.manifest)
    chosen = [m.dataset(x) for x in a.dataset] if a.dataset else m.datasets
    paths = m.paths(a.data)
    return {d.dataset_id: paths[d.dataset_id] for d in chosen}, {d.dataset_id: d.member_sha256 for d in chosen}, {d.dataset_id: d.row_count for d in chosen}, {d.dataset_id: {"reference": d.reference, "trait": d.trait, "source_sha256": d.member_sha256} for d in chosen}


def _regions(spark: SparkSession, a: argparse.Namespace, names: list[str]) -> DataFrame:
    """The regions of a document of the one dataset, or the one that the arguments name."""
    if len(names) != 1:
        raise ContractError("regions are of one dataset")
    one = [getattr(a, x, None) for x in ("chrom", "start", "end")]
    if a.regions:
        if any(x is not None for x in one):
            raise ContractError("--regions, or --chrom with --start and --end")
        return declared.load_region_config(spark, a.regions, names[0])
    if None in one or not one[0] or not 1 <= one[1] <= one[2]:
        raise ContractError("--regions, or --chrom with --start and --end, from 1 up")
    return spark.createDataFrame([("region", 1, *one)], "region_id string, region_no int, chr string, start long, end long")


def _run(spark: SparkSession, a: argparse.Namespace, out: Path) -> bool:
    if a.command in TABLES:
        paths, sums, counts, about = _datasets(a)
        if a.command == "validate":
            found = jobs.validate_all(spark, paths, sums, counts)
            (out / "validation.json").write_text(writers.json_text(found))
            return all(x["ok"] for x in found.values())
        rows = jobs.load(spark, paths, sums, counts)
        if a.command in ("plots", "manhattan", "qq"):
            getattr(jobs, a.command)(rows, out)
        elif a.command == "top-variants":
            jobs.top_variants(rows, readers.regions(spark, a.regions), out)
        elif a.command in ("regional", "regions", "all"):
            regions = _regions(spark, a, list(paths))
            if a.command == "all":
                jobs.plots(rows, out)
            jobs.regional(rows, regions, out)
        elif a.command == "diagnostics":
            jobs.diagnostics(rows, out, a.alpha, a.fdr, about)
        else:
            getattr(jobs, a.command)(rows, out, a.alpha, a.fdr, a.distance, about)
    elif a.command == "report":
        jobs.report(spark, Path(a.batch), out)
    elif a.command == "package":
        jobs.package(spark, Path(a.batch), out, a.require_provenance)
    elif a.command == "reference":
        bundle = declared.load_bundle(a.bundle)
        if odd := bundle.foreign(a.dataset_id, reference=a.reference, assembly_id=a.assembly_id):
            raise ContractError(f"the bundle isn't of {odd}")
        about = {"reference": bundle.reference, "assembly_id": bundle.assembly_id, "dataset_ids": bundle.dataset_ids, "contigs": [vars(c) for c in bundle.contigs], "checksums": {k: readers.checksum(x) for k, x in bundle.files.items()}}
        (out / "reference.json").write_text(writers.json_text(about), encoding="utf-8")
    elif a.command == "customer-summary":
        roles = ("chr", "pos", "ref", "alt", "effect_allele", "other_allele", "effect", "standard_error", "sample_size", "frequency", "pvalue", "neg_log10")
        how = {"exclude": a.exclude_invalid, "odds_ratio": a.odds_ratio}
        if a.metadata:
            m = declared.load_summary_metadata(a.metadata)
            columns = {{"effect_allele_frequency": "frequency", "neg_log10_pvalue": "neg_log10"}.get(k, k): v for k, v in m["columns"].items()}
            how = {"exclude": m["invalid_row_policy"] == "exclude", "odds_ratio": m["effect_type"] == "odds_ratio", "to_alt": m["target_effect_allele"] == "ALT", "strand_known": m["effect_strand"] == "forward", "degrees": m.get("chi_square_df", 1)}
        elif a.columns:
            columns = readers.settings(a.columns, dict.fromkeys(roles, str), ("chr", "pos", "pvalue"))
        else:
            raise ContractError("customer-summary needs --columns or --metadata")
        jobs.customer_summary(spark, a.table, columns, a.fasta, out, a.alpha, a.fdr, a.distance, most_rows=a.max_rows, **how)
    elif a.command == "context":
        chosen = readers.table(spark, a.candidates, ("candidate_id", "chr", "pos", "ref", "alt", "strand")).select("candidate_id", "chr", F.col("pos").cast("long").alias("pos"), "ref", "alt", "strand")
        variants = readers.vcf(spark, a.vcf, a.reference) if a.vcf else None
        rows = jobs.context(spark, chosen, a.fasta, out, a.flank, a.window, variants, readers.bed(spark, a.mask) if a.mask else None)
        if a.primers:
            jobs.primers(rows, out, load_settings(a.primer_settings) if a.primer_settings else Settings(), variants, a.window)
    elif a.command == "assay-review":
        previous = readers.table(spark, a.previous, ("design_id", "previous_state", "previous_simulated_state", "previous_scope", "previous_dataset")).select("design_id", "previous_state", "previous_simulated_state", "previous_scope", "previous_dataset") if a.previous else None
        if bool(a.history) != bool(a.previous_designs):
            raise ContractError("--history and --previous-designs go together")
        history = readers.table(spark, a.history, ("prior_design_id", "replacement_design_id", "candidate_id")) if a.history else None
        earlier = readers.table(spark, a.previous_designs, ("design_id", "candidate_id", "ref", "alt")) if a.history else None
        designs = readers.table(spark, a.designs, ("design_id", "candidate_id", *(("ref", "alt") if a.history else ())))
        designs = designs.select(*[c for c in ("design_id", "candidate_id", "ref", "alt") if c in designs.columns])
        jobs.assay_review(readers.table(spark, a.results, ("design_id", "sample_id")), designs, declared.load_assay_metadata(a.metadata), out, previous, history, earlier, a.max_rows)
    elif a.command == "cross-reference":
        sides = [declared.load_bundle(x) if x else None for x in (a.source_bundle, a.target_bundle)]
        assemblies = [jobs.Assembly(b.reference, b.assembly_id, b.dataset_ids, b.files["fasta"], b.files.get("annotation")) if b else None for b in sides]
        chain = None
        if a.chain_metadata:
            if sides[1] is None:
                raise ContractError("a chain needs a target")
            chain = declared.load_chain_metadata(a.chain_metadata, sides[0].assembly_id, sides[1].assembly_id)[1]
        jobs.cross_reference(spark, a.source, assemblies[0], out, a.trait, a.target, assemblies[1], chain, a.max_candidates)
    elif a.command == "primers":
        folder = Path(a.context)
        rows = readers.table(spark, str(folder / "candidate_context.tsv"), ("candidate_id", "chr", "pos", "ref", "alt", "strand", "snp_offset", "interval_start", "interval_end", "sequence_sha256"))
        rows = readers.with_sequences(rows.drop("sequence"), readers.fasta_records(spark, str(folder / "flanking_sequences.fasta"))).withColumns({c: F.col(c).cast("long") for c in ("pos", "snp_offset", "interval_start", "interval_end")})
        near = readers.table(spark, a.neighbors, ("candidate_id", "v_pos", "v_ref")).select("candidate_id", F.col("v_pos").cast("long").alias("v_pos"), "v_ref")
        if odd := near.join(rows, "candidate_id", "left_anti").limit(1).collect():
            raise ContractError(f"a neighbour of {odd[0].candidate_id}, which isn't a candidate")
        jobs.primers(rows, out, load_settings(a.primer_settings) if a.primer_settings else Settings(), window=a.window, known=near)
    else:
        c = declared.load_individual_config(a.config) if a.config else declared.INDIVIDUAL_DEFAULTS | {"min_maf": 0.01, "n_pcs": 2}
        names, more = [*a.covariate, *(x for x in c["covariates"] if x not in a.covariate)], {}
        if a.variants:
            if not (a.samples and a.bundle and a.config):
                raise ContractError("--variants needs --samples, --bundle and --config")
            bundle = declared.load_bundle(a.bundle)
            if odd := bundle.foreign(c["dataset_id"], reference=c["reference"], assembly_id=c["assembly_id"]):
                raise ContractError(f"the bundle isn't of {odd}")
            variants = readers.table(spark, a.variants, ("marker_id", "chr", "pos", "ref", "alt", "assembly_id")).withColumn("pos", F.col("pos").cast("long"))
            samples = readers.table(spark, a.samples, ("sample_id", "cohort_id", *names))
            values = readers.table(spark, a.phenotype, ("sample_id", "trait", "value", "unit"))
            wide = readers.table(spark, a.genotypes, ("sample_id",))
            header = [x for x in wide.columns if x not in ("sample_id", "_corrupt", "src_row")]
            genotypes.aligned(wide, header, variants, values, samples, trait=c["trait"], unit=c["trait_unit"], cohort_id=c["cohort_id"], assembly_id=c["assembly_id"])
            jobs.check_snps(variants, readers.sequence_chunks(spark, bundle.files["fasta"]), "marker_id")
            phenotype = values.select("sample_id", F.col("value").cast("double").alias("value")).join(samples.select("sample_id", *[F.col(x).cast("double").alias(x) for x in names]), "sample_id")
            more = {"variants": variants, "order": jobs.contig_order(spark, bundle.files["fasta"]), "dataset_id": c["dataset_id"], "alpha": c["alpha"], "fdr": c["fdr_level"], "distance": c["clustering_distance"]}
        else:
            phenotype = readers.table(spark, a.phenotype, ("sample_id", "value", *names)).select("sample_id", *[F.col(x).cast("double").alias(x) for x in ("value", *names)])
        jobs.individual_gwas(readers.genotypes(spark, a.genotypes), phenotype, names, out, c["min_maf"], c["max_marker_missing"], c["n_pcs"], c["max_samples"], c["max_sample_missing"], c["max_markers"], c["max_genotype_cells"], **more)
    return True


def _inputs(a: argparse.Namespace) -> dict[str, str]:
    """Checksums of all files that the arguments name, whole or after a =, and of the files of folders."""
    out = {}
    for value in (x for k, v in vars(a).items() if k != "out" for x in (v if isinstance(v, list) else [v])):
        path = Path(value.split("=", 1)[-1]) if isinstance(value, str) else None
        if path is not None and path.is_file():
            out[str(value)] = readers.checksum(str(path))
        elif path is not None and path.is_dir():
            out |= {f"{value}/{k}": x for k, x in writers.manifest(path).items()}
    return out


def _audited(spark: SparkSession, a: argparse.Namespace, stage: Path) -> bool:
    """Run, and leave a record of what the run depends on and gave; inputs that change meanwhile are an error."""
    before = _inputs(a)
    ok = _run(spark, a, stage)
    if _inputs(a) != before:
        raise ContractError("inputs changed during the run")
    parameters = {k: v for k, v in vars(a).items() if k not in ("command", "out")}
    record = writers.run_identity(a.command, before, parameters) | {"outputs": writers.manifest(stage), "environment": writers.environment()}
    (stage / "provenance.json").write_text(writers.json_text(record), encoding="utf-8")
    return ok


def main(args: list[str] | None = None) -> int:
    a = _parser().parse_args(args)
    spark = SparkSession.builder.appName(f"sorrel {a.command}").getOrCreate()
    try:
        with writers.published(a.out) as stage:
            return 0 if _audited(spark, a, stage) else 1
    except (ContractError, OSError, ValueError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    finally:
        scratch.clear(spark)


if __name__ == "__main__":
    sys.exit(main())
