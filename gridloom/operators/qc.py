"""Site, sample and genotype quality control."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators.aggregates import median_mad
from gridloom.session import written


def hard_filter_fails(qd: str = "QD", fs: str = "FS", mq: str = "MQ") -> Column:
    return (F.col(qd) < 2) | (F.col(fs) > 60) | (F.col(mq) < 30)


def allele_balance_fails(n_alt: str = "n_alt", dp: str = "dp", ad_alt: str = "ad_alt") -> Column:
    """hom-ref with balance above 0.1, het outside 0.2 to 0.8, hom-var below 0.9; missing where call or balance is."""
    ab = F.try_divide(F.col(ad_alt).cast("double"), F.col(dp).cast("double"))
    fails = F.when(X.is_hom_ref(n_alt), ab > 0.1).when(X.is_het(n_alt), (ab < 0.2) | (ab > 0.8)).otherwise(ab < 0.9)
    return F.when(F.col(n_alt).isNotNull(), fails)


def depth_fails(dp: str = "dp", ad_sum: Column | None = None) -> Column:
    """Depth above 100, or reads in the alleles under 0.9 of the depth."""
    share = F.try_divide(ad_sum.cast("double"), F.col(dp).cast("double")) < 0.9 if ad_sum is not None else F.lit(False)
    return (F.col(dp) > 100) | share


def site_filter(thresholds: dict[str, float | None] | None = None) -> Column:
    """Configurable site filter over AF, call_rate, inbreeding, p_hwe, QD, FS, MQ, is_snv and biallelic; None skips a test.

    Default cutoffs are fixed values; strictness is that of each comparison below.
    """
    t = {"AF": 0.001, "call_rate": 0.99, "inbreeding": -0.8, "p_hwe": 1e-8, "QD": 2.0, "FS": 60.0, "MQ": 30.0, "snv": 1, "biallelic": 1, **(thresholds or {})}
    tests = {
        "AF": lambda v: F.col("AF") > v, "call_rate": lambda v: F.col("call_rate") > v, "inbreeding": lambda v: F.col("inbreeding") > v, "p_hwe": lambda v: F.col("p_hwe") > v,
        "QD": lambda v: F.col("QD") >= v, "FS": lambda v: F.col("FS") <= v, "MQ": lambda v: F.col("MQ") >= v, "snv": lambda v: F.col("is_snv"), "biallelic": lambda v: F.col("biallelic"),
    }
    return X.all_of([f(t[k]) for k, f in tests.items() if t.get(k) is not None])


def genotype_counts(entries: DataFrame, keys: list[str]) -> DataFrame:
    g = F.col("n_alt")
    return entries.groupBy(*keys).agg(F.count_if(g == 0).alias("n_hom_ref"), F.count_if(g == 1).alias("n_het"), F.count_if(g == 2).alias("n_hom_var"), F.count(g).alias("n_called"))


def variant_qc(entries: DataFrame, n_samples: int) -> DataFrame:
    """Per site: counts, call rate over all samples (absent cells included), AC, AN, AF and mean GQ; one pass."""
    g = F.col("n_alt")
    aggs = [F.count(g).alias("n_called"), F.count_if(g == 1).alias("n_het"), F.count_if(g == 0).alias("n_hom_ref"), F.count_if(g == 2).alias("n_hom_var"), F.coalesce(F.sum(g), F.lit(0)).alias("AC")]
    if "gq" in entries.columns:
        aggs.append(F.avg("gq").alias("gq_mean"))
    d = entries.groupBy("vid").agg(*aggs)
    return d.withColumns({"call_rate": F.col("n_called") / F.lit(float(n_samples)), "AN": 2 * F.col("n_called"), "AF": F.try_divide(F.col("AC").cast("double"), 2.0 * F.col("n_called"))})


def sample_qc(entries: DataFrame, rows: DataFrame, n_sites: int) -> DataFrame:
    """Per sample: call rate, genotype counts, allele type counts and their ratios; one pass over the cells."""
    kinds = rows.select("vid", X.is_snp("ref", "alt").alias("snp"), X.is_insertion("ref", "alt").alias("ins"), X.is_deletion("ref", "alt").alias("del"), X.is_transition("ref", "alt").alias("ti"))
    g = F.col("n_alt")
    of = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), g)), F.lit(0))
    d = entries.join(kinds, "vid").groupBy("sid").agg(
        F.count(g).alias("n_called"), F.count_if(g == 1).alias("n_het"), F.count_if(g == 2).alias("n_hom_var"), of("snp").alias("n_snp"), of("ins").alias("n_insertion"), of("del").alias("n_deletion"),
        F.coalesce(F.sum(F.when(F.col("ti") & F.col("snp"), g)), F.lit(0)).alias("n_ti"),
    )
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), b.cast("double"))
    return d.withColumns({
        "call_rate": F.col("n_called") / F.lit(float(n_sites)), "missingness": 1 - F.col("n_called") / F.lit(float(n_sites)), "het_rate": ratio("n_het", F.col("n_called")),
        "r_ti_tv": ratio("n_ti", F.col("n_snp") - F.col("n_ti")), "r_insertion_deletion": ratio("n_insertion", F.col("n_deletion")), "r_het_hom_var": ratio("n_het", F.col("n_hom_var")),
    })


def inbreeding(n_hom_ref: Column, n_het: Column, n_hom_var: Column) -> Column:
    """1 - observed / expected heterozygotes (2 p q n), from genotype counts."""
    n = (n_hom_ref + n_het + n_hom_var).cast("double")
    p = F.try_divide(2.0 * n_hom_ref + n_het, 2 * n)
    return 1 - F.try_divide(n_het.cast("double"), 2 * p * (1 - p) * n)


def hwe_exact(n_hom_ref: int, n_het: int, n_hom_var: int) -> float:
    """Exact Hardy-Weinberg p value (Wigginton et al. 2005): probability of all het counts no likelier than the one seen."""
    n, rare = n_hom_ref + n_het + n_hom_var, 2 * min(n_hom_ref, n_hom_var) + n_het
    if n == 0:
        return float("nan")
    # log P(het) up to a constant: n! / (hom_rare! het! hom_common!) 2^het
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 2 * n + 1)))])
    het = np.arange(rare % 2, rare + 1, 2)
    lp = het * np.log(2.0) - log_fact[(rare - het) // 2] - log_fact[het] - log_fact[n - het - (rare - het) // 2]
    p = np.exp(lp - lp.max())
    p /= p.sum()
    return float(min(1.0, p[p <= p[het == n_het][0] * (1 + 1e-12)].sum()))


def with_hwe(counts: DataFrame, name: str = "p_hwe") -> DataFrame:
    """counts with the exact p value: a vectorised function over the distinct count triples, joined back."""

    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([hwe_exact(int(x), int(y), int(z)) for x, y, z in zip(a, b, c)])

    keys = ["n_hom_ref", "n_het", "n_hom_var"]
    return counts.join(counts.select(*keys).distinct().withColumn(name, p(*keys)), keys)


def impute_sex(entries: DataFrame, x_sites: DataFrame, aaf_threshold: float = 0.05, female: float = 0.5, male: float = 0.6) -> DataFrame:
    """f_stat per sample over chromosome X sites (Purcell et al. 2007): (observed - expected homs) / (called - expected)."""
    e = entries.join(x_sites.select("vid"), "vid", "left_semi").filter("n_alt is not null")
    af = e.groupBy("vid").agg((F.sum("n_alt") / (2.0 * F.count("*"))).alias("af"), F.count("*").alias("n"))
    af = af.filter((F.col("af") > aaf_threshold) & (F.col("af") < 1 - aaf_threshold))
    # Expected homozygosity with the small-sample correction 2n / (2n - 1).
    exp = 1 - 2 * F.col("af") * (1 - F.col("af")) * F.try_divide(2.0 * F.col("n"), 2.0 * F.col("n") - 1)
    d = e.join(af, "vid").groupBy("sid").agg(F.count("*").alias("n_called"), F.sum(exp).alias("expected_homs"), F.count_if(F.col("n_alt") != 1).alias("observed_homs"))
    f = F.try_divide(F.col("observed_homs") - F.col("expected_homs"), F.col("n_called") - F.col("expected_homs"))
    return d.withColumn("f_stat", f).withColumn("is_female", F.when(F.col("f_stat") < female, True).when(F.col("f_stat") > male, False))


def sex_class(f: Column, y: Column, is_female: Column) -> Column:
    """ambiguous, aneuploid, female or male from the X inbreeding f and the normalised Y coverage y; first match wins."""
    ambiguous = ((f >= 0.5) & y.isNotNull() & (y <= 0.1)) | f.isNull() | ((f >= 0.4) & (f <= 0.6) & y.isNotNull() & (y > 0.1))
    aneuploid = y.isNotNull() & (y > 0.1) & (f < 0.4)
    return F.when(ambiguous, "ambiguous_sex").when(aneuploid, "sex_aneuploidy").when(is_female, "female").otherwise("male")


def ploidy_ratios(entries: DataFrame, rows: DataFrame, x: str = "chrX", y: str = "chrY", normal: str = "chr20") -> DataFrame:
    """Mean depth of X and Y over that of an autosome, per sample."""
    d = entries.join(rows.select("vid", "contig"), "vid").groupBy("sid").agg(*[F.avg(F.when(F.col("contig") == c, F.col("dp"))).alias(n) for n, c in (("x", x), ("y", y), ("base", normal))])
    return d.select("sid", F.try_divide("x", "base").alias("x_ploidy_ratio"), F.try_divide("y", "base").alias("y_ploidy_ratio"))


def stratified_outliers(df: DataFrame, key: str, strata: list[str], metrics: list[str], lower: float = 4.0, upper: float = 4.0, per_metric: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(key, strata, metric, value, med, mad, fails): value <= med - k mad or >= med + k mad within its stratum.

    Samples without a stratum are a stratum. The metrics are written once, as medians and deviations read them again.
    """
    long = written(df.unpivot([key, *strata], metrics, "metric", "value"), "metrics")
    m = median_mad(long, [*strata, "metric"], "value")
    lo, hi = F.lit(lower), F.lit(upper)
    for name, (a, b) in (per_metric or {}).items():
        lo, hi = F.when(F.col("metric") == name, F.lit(a)).otherwise(lo), F.when(F.col("metric") == name, F.lit(b)).otherwise(hi)
    own = [*strata, "metric"]
    m = m.select(*[F.col(k).alias(f"__m{i}") for i, k in enumerate(own)], "med", "mad")
    out = long.join(m, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__m{i}")) for i, k in enumerate(own)]))
    return out.select(key, *own, "value", "med", "mad").withColumn("fails", (F.col("value") <= F.col("med") - lo * F.col("mad")) | (F.col("value") >= F.col("med") + hi * F.col("mad")))


def failing_metrics(outliers: DataFrame, key: str) -> DataFrame:
    """Per key the sorted set of metric names that fail."""
    return outliers.groupBy(key).agg(F.array_sort(F.collect_set(F.when(F.col("fails"), F.col("metric")))).alias("failing"))


def genotype_qc_chain(cohort, n_samples: int):
    """Autosomal sites that pass the hard filter, cells that pass allele balance and depth, then sites by call rate and count."""
    c = cohort.filter_rows(X.is_autosome("contig") & ~hard_filter_fails())
    c = c.filter_entries(F.coalesce(~allele_balance_fails(), F.lit(True)) & F.coalesce(~depth_fails(), F.lit(True)))
    good = variant_qc(c.entries, n_samples).filter((F.col("call_rate") >= 0.05) & (F.col("AC") >= 1))
    c.rows = c.rows.join(good.select("vid"), "vid", "left_semi")
    c.entries = c.entries.join(good.select("vid"), "vid", "left_semi")
    return c.annotate_constants(call_rate=0.05, min_ac=1)
