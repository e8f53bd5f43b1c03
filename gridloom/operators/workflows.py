"""Workflows that chain operators: typed quantile bins, a QC-ready cohort, worst consequences."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators import evaluation, family, ml, popgen, qc, windows
from gridloom.operators.joins import trios
from gridloom.plans.views import Cohort
from gridloom.session import written


def typed_quantile_bins(df: DataFrame, score: str, key: str, by: str, n_bins: int, name: str = "bin", subset: Column | None = None, desc: bool = False, seed: int = 0) -> DataFrame:
    """Quantile bins computed apart for rows where `by` holds and for the others, in one column; missing outside the subset.

    Scores that sit on merged boundaries are spread by a hash of the key, so reruns agree.
    """
    part = df if subset is None else df.filter(subset)
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    yes, no = (windows.quantile_boundaries(part.filter(F.col(by) == v), score, n_bins) for v in (True, False))
    b = F.when(F.col(by), windows.quantile_bin(F.col(score), yes, u, n_bins, desc)).otherwise(windows.quantile_bin(F.col(score), no, u, n_bins, desc))
    return df.withColumn(name, b if subset is None else F.when(subset, b))


def classifier_inputs(sites: DataFrame, alleles: DataFrame, entries: DataFrame, fam: DataFrame, truth: DataFrame, impute: bool = True) -> DataFrame:
    """The feature table with what the cells say: transmissions within trios, inbreeding and raw allele counts by site."""
    trio = family.trio_stats(trios(entries, fam)).select("vid", "n_transmitted_raw")
    counts = qc.genotype_counts(entries, ["vid"])
    n = [F.col(f"n_{k}") for k in ("hom_ref", "het", "hom_var")]
    inbreeding = counts.select("vid", qc.inbreeding(*n).alias("InbreedingCoeff"))
    raw = counts.select("vid", (F.col("n_het") + 2 * F.col("n_hom_var")).alias("ac_raw"))
    return evaluation.feature_table(sites, evaluation.allele_data(alleles), inbreeding, truth, trio, raw, impute)


def classified_sites(features: DataFrame, held_out: Column, trees: int = 500, depth: int = 5, fp_to_tp: float = 1.0, snv_bin: int = 91, indel_bin: int = 86) -> tuple[DataFrame, PipelineModel]:
    """Features with the classifier's verdict, rank bin and filters, and the model.

    True positives have a truth flag or are transmitted singletons, false ones fail the hard filters; sites in held_out are
    not trained on. Sites are binned by falling probability within their type; the probability at the last bin that passes
    is that type's cutoff.
    """
    d = written(features.withColumn("is_snv", F.col("allele_type") == "snv"), "features")
    d = ml.training_labels(d, [*evaluation.TRUTH, "transmitted_singleton"], "fail_hard_filters", held_out)
    train = ml.balanced(d, "vid", fp_to_tp).withColumns({c: F.col(c).cast("double") for c in evaluation.NUMERIC})
    words = {c: F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in evaluation.CATEGORICAL}
    model = ml.train_forest(train.withColumns(words), evaluation.NUMERIC, evaluation.CATEGORICAL, trees=trees, depth=depth, key="vid")
    out = ml.apply_forest(model, d.withColumns({f"__{c}": F.col(c) for c in evaluation.CATEGORICAL}).withColumns(words))
    out = out.drop(*evaluation.CATEGORICAL).withColumnsRenamed({f"__{c}": c for c in evaluation.CATEGORICAL})
    out = written(out.select(*d.columns, "predicted", F.col("prob_TP").alias("rf_probability"), (1 - F.col("prob_TP")).alias("score")), "scored")
    ranked = windows.stratified_rank(out, ["is_snv"], "score", "vid")
    n = {r["is_snv"]: r["n"] for r in ranked.groupBy("is_snv").agg(F.count("*").alias("n")).collect()}  # two types
    size = F.when(F.col("is_snv"), n.get(True, 0)).otherwise(n.get(False, 0) + n.get(None, 0))
    ranked = ranked.withColumn("bin", windows.rank_bin(F.col("rank"), size, 100))
    cut = ranked.agg(F.min(F.when(F.col("is_snv") & (F.col("bin") <= snv_bin), F.col("rf_probability"))).alias("s"), F.min(F.when(~F.col("is_snv") & (F.col("bin") <= indel_bin), F.col("rf_probability"))).alias("i")).first()
    return ml.pass_by_bin(ml.final_filters(ranked, cut["s"] or 0.0, cut["i"] or 0.0), snv_bin, indel_bin), model


def worst_of(items: Column, severity: list[str]) -> Column:
    """The item that comes first in the order of severity; missing if none is known."""
    order = F.array(*[F.lit(s) for s in severity])
    return F.get(F.filter(order, lambda s: F.array_contains(items, s)), F.lit(0))


def site_annotations(cohort: Cohort, n_samples: int) -> DataFrame:
    """rows with call statistics, inbreeding, exact HWE p value and type flags, as the configurable site filter reads them."""
    from gridloom.functions import expr as X

    q = qc.variant_qc(cohort.entries, n_samples)
    q = qc.with_hwe(q).withColumn("inbreeding", qc.inbreeding(F.col("n_hom_ref"), F.col("n_het"), F.col("n_hom_var")))
    rows = cohort.rows.drop("AC").withColumns({"is_snv": X.is_snp("ref", "alt"), "biallelic": ~F.col("was_split")})
    return rows.join(q.select("vid", "AC", "AN", "AF", "call_rate", "inbreeding", "p_hwe", "n_called"), "vid")


def qc_ready(cohort: Cohort, n_samples: int, thresholds: dict | None = None, r2: float | None = 0.1, window: int = 1_000_000) -> Cohort:
    """Sites that pass the configurable filter, pruned for linkage, with the parameters as constants and call rates per sample."""
    sites = site_annotations(cohort, n_samples).filter(qc.site_filter(thresholds))
    if r2 is not None:
        sites = popgen.ld_prune(cohort.entries.join(sites.select("vid"), "vid", "left_semi"), sites, r2, window)
    entries = cohort.entries.join(sites.select("vid"), "vid", "left_semi")
    n_sites = sites.count()
    rate = entries.groupBy("sid").agg((F.count("n_alt") / F.lit(float(max(1, n_sites)))).alias("sample_callrate"))
    return Cohort(sites, cohort.cols.join(rate, "sid", "left"), entries, {**cohort.constants, "thresholds": thresholds or {}, "r2": r2, "window": window})


def drop_failing_samples(cohort: Cohort, failing: DataFrame) -> Cohort:
    """The cohort without the samples listed by sid."""
    return Cohort(cohort.rows, cohort.cols.join(failing.select("sid"), "sid", "left_anti"), cohort.entries.join(failing.select("sid"), "sid", "left_anti"), cohort.constants)


def relatedness_step(entries: DataFrame, kinship_cut: float = 0.125, k: int = 4) -> DataFrame:
    """Samples to drop: PCA, kinship from the components, then the fewest samples that break all pairs at or above the cut."""
    _, scores, _ = popgen.pca(entries, k)
    pairs = popgen.pc_relate(entries, scores, min_kinship=kinship_cut)
    return popgen.maximal_independent_set(pairs).withColumnRenamed("node", "sid")


def sex_concordance(imputed: DataFrame, recorded: DataFrame, by: str) -> DataFrame:
    """Matches and mismatches of imputed and recorded sex per cohort; samples that lack either are counted apart."""
    both = recorded.join(imputed.select("sid", F.col("is_female").alias("seen")), "sid", "left")
    same = F.when(F.col("seen").isNull() | F.col("is_female").isNull(), "unknown").when(F.col("seen") == F.col("is_female"), "match").otherwise("mismatch")
    return both.groupBy(by, same.alias("verdict")).agg(F.count("*").alias("n"))
