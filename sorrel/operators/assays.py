"""Assay returns: measures of each design, review states, alternatives and panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metrics(rows: DataFrame, key: str = "design_id") -> DataFrame:
    """The measures of each design from its results: key, sample_id, control_type (sample, positive, negative), call (0, 1, 2 or NA), reference_genotype, expected_genotype, batch_id, plate_id."""
    called, known = F.col("call") != "NA", F.col("reference_genotype") != "NA"
    sample = F.col("control_type") == "sample"
    flags = rows.withColumns({"s": sample, "c": sample & called, "k": sample & called & known, "ok": sample & called & known & (F.col("call") == F.col("reference_genotype"))})
    bad = ((F.col("control_type") == "positive") & (F.col("call") != F.col("expected_genotype"))) | ((F.col("control_type") == "negative") & called)
    whole = flags.groupBy(key).agg(F.count_if("s").alias("n_sample_attempts"), F.count_if("c").alias("n_called"), F.count_if("k").alias("n_comparable_calls"), F.count_if("ok").alias("n_concordant"), F.count_if(~F.col("s")).alias("n_controls"), F.count_if(bad).alias("n_failed_controls"))
    # samples first, so that a design's repeats are combined before they meet
    per_sample = flags.where("s").groupBy(key, "sample_id").agg(F.count("*").alias("n"), F.count_if("c").alias("n_c"), F.max("k").alias("any_k"), F.size(F.collect_set(F.when(F.col("c"), F.col("call")))).alias("calls"))
    many = F.col("n") > 1
    samples = per_sample.groupBy(key).agg(F.count("*").alias("n_samples"), F.count_if("any_k").alias("n_comparable_samples"), F.count_if(F.col("n") == F.col("n_c")).alias("n_complete_samples"), F.count_if(many).alias("n_replicated_samples"), F.count_if(many & (F.col("n_c") >= 2)).alias("n_comparable_replicated_samples"), F.count_if(many & (F.col("n_c") < F.col("n"))).alias("n_replicate_groups_with_no_call"), F.count_if(many & (F.col("calls") > 1)).alias("n_replicate_disagreements"))
    per_plate = rows.groupBy(key, "batch_id", "plate_id").agg(F.array_sort(F.collect_set(F.when(F.col("control_type") == "positive", F.col("expected_genotype")))).alias("expected"), F.count_if(F.col("control_type") == "negative").alias("negatives"))
    incomplete = (F.col("expected") != F.array(F.lit("0"), F.lit("1"), F.lit("2"))) | (F.col("negatives") == 0)
    plates = per_plate.groupBy(key).agg(F.count("*").alias("n_plates"), F.count_if(incomplete).alias("n_incomplete_control_plates"))
    out = whole.join(samples, key, "left").join(plates, key)
    out = out.fillna(0)

    def share(a: str, b: str):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b))

    return out.withColumns({"n_no_calls": F.col("n_sample_attempts") - F.col("n_called"), "call_rate": share("n_called", "n_sample_attempts"), "concordance": share("n_concordant", "n_comparable_calls"), "complete_sample_call_rate": share("n_complete_samples", "n_samples")})


def violations(results: DataFrame, designs: DataFrame, conditions: str, identity: tuple[str, ...] = ("candidate_id",)) -> DataFrame:
    """The rule that each row of results breaks, first in this order: its design and identity, encoding and conditions, ids, calls, controls, no-call reasons, repeats, sample definitions.

    Only rows that break one are returned, with their columns and reason. A repeat is a later row (src_row) with the same design, batch, plate, sample and replicate; a sample's control type and genotypes may not change within a candidate.
    """
    known = designs.select("design_id", *[F.col(c).alias(f"_{c}") for c in identity], F.lit(True).alias("_known"))
    rows = results.join(known, "design_id", "left")
    same = F.col("_known")
    for c in identity:
        same = same & (F.col(c) == F.col(f"_{c}"))
    levels, kind = ("0", "1", "2", "NA"), F.col("control_type")
    expected, truth, call, why = (F.col(c) for c in ("expected_genotype", "reference_genotype", "call", "no_call_reason"))
    first = F.min("src_row").over(Window.partitionBy("design_id", "batch_id", "plate_id", "sample_id", "replicate_id"))
    definition = F.struct("control_type", "expected_genotype", "reference_genotype")
    sample = Window.partitionBy("candidate_id", "sample_id")
    rules = [
        (same, "unknown design, or identity mismatch"),
        ((F.col("allele_encoding") == "ALT_0_1_2_forward") & (F.col("conditions_id") == conditions), "allele direction or measurement conditions mismatch"),
        ((F.col("sample_id") != "") & (F.col("replicate_id") != "") & (F.col("plate_id") != "") & (F.col("batch_id") != ""), "an id is empty"),
        (call.isin(*levels) & expected.isin(*levels) & truth.isin(*levels), "a call isn't 0, 1, 2 or NA"),
        (kind.isin("sample", "positive", "negative"), "unknown control type"),
        ((kind != "positive") | ((expected != "NA") & (truth == "NA")), "a positive control needs an expected genotype and no truth"),
        ((kind != "negative") | ((expected == "NA") & (truth == "NA")), "a negative control expects no call"),
        ((kind != "sample") | (expected == "NA"), "a sample has no expected genotype"),
        ((call != "NA") | (kind == "negative") | (why != ""), "a no-call needs a reason"),
        ((call == "NA") | (why == ""), "a call has no no-call reason"),
        (F.col("src_row") == first, "repeated result"),
        (F.min(definition).over(sample) == F.max(definition).over(sample), "a sample's definition changes"),
    ]
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in rules])
    return rows.withColumn("reason", reason).where("reason is not null").drop("_known", *[f"_{c}" for c in identity])


def history_violations(history: DataFrame, previous: DataFrame, designs: DataFrame, identity: tuple[str, ...] = ("candidate_id", "ref", "alt")) -> DataFrame:
    """Redesign edges (prior_design_id, replacement_design_id, candidate_id) that don't link a previous design to a distinct known one of the same candidate and alleles, or that repeat."""
    old = previous.select(F.col("design_id").alias("prior_design_id"), F.struct(*identity).alias("_old"))
    new = designs.select(F.col("design_id").alias("replacement_design_id"), F.struct(*identity).alias("_new"))
    n = F.count("*").over(Window.partitionBy("prior_design_id", "replacement_design_id"))
    rows = history.withColumn("_n", n).join(old, "prior_design_id", "left").join(new, "replacement_design_id", "left")
    reason = F.when(F.col("_old").isNull() | F.col("_new").isNull() | (F.col("prior_design_id") == F.col("replacement_design_id")), "not a previous design and a distinct known replacement").when((F.col("_old") != F.col("_new")) | (F.col("candidate_id") != F.col("_new.candidate_id")), "candidate or alleles change").when(F.col("_n") > 1, "repeated edge")
    return rows.withColumn("reason", reason).where("reason is not null").drop("_n", "_old", "_new")


#: Measures and the threshold that each is held to, in the order in which shortfalls are listed.
THRESHOLDS = (("n_samples", "minimum_samples"), ("n_comparable_samples", "minimum_comparable_samples"), ("n_comparable_replicated_samples", "minimum_replicated_samples"), ("call_rate", "minimum_call_rate"), ("complete_sample_call_rate", "minimum_call_rate"), ("concordance", "minimum_concordance"))


def review(measured: DataFrame, meta: dict, previous: DataFrame | None = None, key: str = "design_id") -> DataFrame:
    """state, simulated_state, acceptance and reasons of each design under one declared review.

    `previous` has key, previous_state, previous_simulated_state, previous_scope and previous_dataset. States go up one step at a time, and synthetic data never leave the first.
    """
    absent = ("unknown", "not_applicable")
    rows = measured
    if previous is not None:
        rows = rows.join(previous, key, "left")
    else:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("previous_state", "previous_simulated_state", "previous_scope", "previous_dataset")})
    synthetic = meta["data_scope"] == "synthetic"
    approved = meta["analyst_approved"] and meta["analyst_review_reference"] not in absent and meta["reviewer_id"] not in absent
    short = [F.when(F.coalesce(F.col(m) < meta[t], F.lit(True)), F.lit(f"insufficient_{m}")) for m, t in THRESHOLDS]
    faults = [F.when(F.col(m) > 0, F.lit(m)) for m in ("n_replicate_disagreements", "n_failed_controls", "n_incomplete_control_plates")]

    def declared(ok: bool, reason: str):
        return F.lit(None if ok else reason).cast("string")

    first = F.array_compact(F.array(declared(approved, "analyst_review_not_approved"), declared(meta["measurement_conditions"] not in absent, "measurement_conditions_unverified"), *short, *faults, declared(meta["reference_method"] not in absent, "reference_method_unverified")))
    before = F.when((F.lit(synthetic)) & (F.col("previous_scope") == "synthetic"), F.col("previous_simulated_state")).otherwise(F.col("previous_state"))
    scoped = meta["population_scope_confirmed"] and meta["population_evidence_reference"] not in absent and meta["target_population"] not in absent
    second = F.array_compact(F.array(F.when(~F.coalesce(before.isin("assay_validated", "population_validated"), F.lit(False)), "prior_assay_validation_required"), declared(scoped, "population_scope_evidence_required"), F.when(F.col("previous_dataset") == meta["validation_dataset_id"], "distinct_population_validation_dataset_required")))
    wanted = meta["requested_state"]
    passed = F.size("_first") == 0
    rows = rows.withColumns({"_first": first, "_second": second if wanted == "population_validated" else F.array().cast("array<string>")})
    reasons = F.when(passed, F.col("_second")).otherwise(F.col("_first"))
    state = F.when(~passed | F.lit(wanted == "computational_candidate"), "computational_candidate").when(F.lit(wanted == "population_validated") & (F.size("_second") == 0), "population_validated").otherwise("assay_validated")
    default, acceptance = ("promotion_not_requested", F.lit("promotion_not_requested")) if wanted == "computational_candidate" else ("criteria_met_within_declared_scope", F.when(F.size(reasons) == 0, "accepted").otherwise("rejected_requested_state"))
    text = F.when(F.size(reasons) == 0, default).otherwise(F.array_join(reasons, ";"))
    none = F.col("n_sample_attempts") == 0
    return rows.select(
        key,
        F.when(none | F.lit(synthetic), "computational_candidate").otherwise(state).alias("state"),
        F.when(none | F.lit(not synthetic), "").otherwise(state).alias("simulated_state"),
        F.when(none, "not_assessed").otherwise(acceptance).alias("acceptance"),
        F.when(none, "no_sample_measurements").otherwise(F.concat(text, F.lit(";synthetic_only_not_operational_validation" if synthetic else ""))).alias("reasons"),
    )


def state_counts(reviewed: DataFrame, states: tuple[str, ...] = ("computational_candidate", "assay_validated", "population_validated")) -> DataFrame:
    """How many designs have each state; states without any are listed with 0."""
    counts = reviewed.agg(*[F.count_if(F.col("state") == s).alias(s) for s in states])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.col(s).alias("n")) for s in states])).alias("x")).select("x.*")


def alternatives(designs: DataFrame, reviewed: DataFrame) -> DataFrame:
    """For each design, the other designs of its candidate that are still computational candidates."""
    open_ = designs.join(reviewed.where("state = 'computational_candidate'").select("design_id"), "design_id").select(F.col("design_id").alias("alternative_id"), "candidate_id")
    return designs.select("design_id", "candidate_id").join(open_, "candidate_id").where("design_id != alternative_id")


def panel(designs: DataFrame, reviewed: DataFrame) -> DataFrame:
    return designs.join(reviewed.where("state = 'population_validated'"), "design_id")
