"""Family statistics over trio rows (child_, father_ and mother_ n_alt per site and trio)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.aggregates import call_stats


def _g() -> tuple[Column, Column, Column]:
    return F.col("child_n_alt"), F.col("father_n_alt"), F.col("mother_n_alt")


def called() -> Column:
    c, f, m = _g()
    return c.isNotNull() & f.isNotNull() & m.isNotNull()


def transmitted() -> Column:
    """Alternate alleles that het parents passed on: the child's alleles less those that hom-var parents must give."""
    c, f, m = _g()
    forced = F.when(f == 2, 1).otherwise(0) + F.when(m == 2, 1).otherwise(0)
    return F.least(F.greatest(c - forced, F.lit(0)), n_het_parents())


def n_het_parents() -> Column:
    _, f, m = _g()
    return F.when(f == 1, 1).otherwise(0) + F.when(m == 1, 1).otherwise(0)


def mendel_code() -> Column:
    """Code of a Mendelian inconsistency on an autosome, missing where consistent or not called.

    1 both parents hom-var, child het; 2 both hom-ref, child het; 3 and 4 father or mother alone hom-ref, child hom-var;
    5 both hom-ref, child hom-var; 6 and 7 father or mother alone hom-var, child hom-ref; 8 both hom-var, child hom-ref.
    """
    c, f, m = _g()
    return F.when(called(), (
        F.when((f == 2) & (m == 2) & (c == 1), 1).when((f == 0) & (m == 0) & (c == 1), 2)
        .when((f == 0) & (m != 0) & (c == 2), 3).when((m == 0) & (f != 0) & (c == 2), 4).when((f == 0) & (m == 0) & (c == 2), 5)
        .when((f == 2) & (m != 2) & (c == 0), 6).when((m == 2) & (f != 2) & (c == 0), 7).when((f == 2) & (m == 2) & (c == 0), 8)
    ))


def trio_stats(trio: DataFrame, adj: Column | None = None) -> DataFrame:
    """Per site: transmitted, untransmitted, de novo and allele counts of parents and children; raw, and adj where given."""
    c, f, m = _g()
    trio = trio.filter(called())
    aggs = []
    for name, where in (("raw", F.lit(True)), *((("adj", adj),) if adj is not None else ())):
        s = lambda x, w=where: F.coalesce(F.sum(F.when(w, x)), F.lit(0)).cast("long")
        aggs += [
            s(transmitted()).alias(f"n_transmitted_{name}"), s(n_het_parents() - transmitted()).alias(f"n_untransmitted_{name}"),
            F.count_if(where & (f == 0) & (m == 0) & (c > 0)).alias(f"n_de_novos_{name}"), s(f + m).alias(f"ac_parents_{name}"), s(c).alias(f"ac_children_{name}"), F.count_if(where).alias(f"n_trios_{name}"),
        ]
    return trio.groupBy("vid").agg(*aggs)


def mendel_errors(trio: DataFrame) -> DataFrame:
    return trio.groupBy("vid").agg(F.count(mendel_code()).alias("errors"))


def tdt(trio: DataFrame) -> DataFrame:
    """Transmission disequilibrium per site: t, u and (t - u)^2 / (t + u) (Spielman et al. 1993); consistent trios only."""
    t, u = F.sum(transmitted()), F.sum(n_het_parents() - transmitted())
    d = trio.filter(called() & mendel_code().isNull()).groupBy("vid").agg(F.coalesce(t, F.lit(0)).cast("long").alias("t"), F.coalesce(u, F.lit(0)).cast("long").alias("u"))
    return d.withColumn("chi2", F.try_divide(F.pow(F.col("t") - F.col("u"), F.lit(2)).cast("double"), (F.col("t") + F.col("u")).cast("double")))


def singletons(trio: DataFrame, ac: DataFrame) -> DataFrame:
    """Per site: trios with a transmitted singleton (AC 2, child and a parent non-ref) and an untransmitted one (AC 1, child hom-ref, a parent non-ref)."""
    c, f, m = _g()
    parent = (f > 0) | (m > 0)
    d = trio.join(ac.select("vid", "AC"), "vid")
    return d.groupBy("vid").agg(F.count_if((F.col("AC") == 2) & (c > 0) & parent).alias("n_transmitted"), F.count_if((F.col("AC") == 1) & (c == 0) & parent).alias("n_untransmitted"))


def unrelated_call_stats(entries: DataFrame, fam: DataFrame) -> DataFrame:
    """Per site: allele counts among samples that are nobody's child in the pedigree (founders and samples outside it)."""
    founders = entries.join(fam.select(F.col("proband").alias("sid")), "sid", "left_anti")
    return founders.groupBy("vid").agg(*[v.alias(f"unrelated_{k}") for k, v in call_stats().items()])


def singleton_totals(trio: DataFrame, ac: DataFrame, synonymous: DataFrame | None = None, most_ac: int = 2) -> DataFrame:
    """One row: (site, trio) totals of transmitted and untransmitted singletons and their ratio.

    Sites have at most most_ac copies in the cohort and, where given, are among the synonymous ones (vid).
    """
    few = ac.filter(F.col("AC").between(1, most_ac))
    if synonymous is not None:
        few = few.join(synonymous.select("vid"), "vid", "left_semi")
    s = singletons(trio, few)
    t, u = F.coalesce(F.sum("n_transmitted"), F.lit(0)), F.coalesce(F.sum("n_untransmitted"), F.lit(0))
    d = s.agg(F.count("*").alias("n_sites"), t.cast("long").alias("n_transmitted"), u.cast("long").alias("n_untransmitted"))
    return d.withColumn("ratio", F.try_divide(F.col("n_transmitted").cast("double"), F.col("n_untransmitted").cast("double")))


def de_novo(trio: DataFrame, prior_af: DataFrame, min_prior: float = 100 / 30_000_000, mutation: float = 1 / 30_000_000) -> DataFrame:
    """Posterior of a de novo call for sites where the child is het and both parents hom-ref (Samocha et al. 2014).

    P(de novo | data) = d (1 - s) / (d (1 - s) + h s), with d the mutation prior, h = 1 - (1 - af)^4 the prior that a
    parent carries the allele, and s the chance that a carrier looks hom-ref, 10^(-q/10) of the lower parental quality.
    """
    c, f, m = _g()
    d = trio.filter((c == 1) & (f == 0) & (m == 0)).join(prior_af, "vid", "left")
    af = F.greatest(F.coalesce(F.col("prior_af"), F.lit(0.0)), F.lit(min_prior))
    h = 1 - F.pow(1 - af, F.lit(4))
    missed = F.pow(F.lit(10.0), -F.least("father_gq", "mother_gq") / 10)
    p = F.try_divide(mutation * (1 - missed), mutation * (1 - missed) + h * missed)
    ab = F.try_divide(F.col("child_ad_alt").cast("double"), F.col("child_dp").cast("double"))
    level = F.when((p > 0.99) & (ab > 0.3), "HIGH").when((p > 0.5) & (ab > 0.2), "MEDIUM").when(p > 0.05, "LOW")
    return d.select("vid", "proband", p.alias("p_de_novo"), level.alias("confidence"))


def pedigree(families: DataFrame, ids: DataFrame) -> DataFrame:
    """(fam_id, child, father, mother, sex) with the three ids mapped and sex as 1 or 2; incomplete trios are dropped."""
    out = families
    for role in ("child", "father", "mother"):
        out = out.join(ids.select(F.col("id").alias(role), F.col("name").alias(f"{role}_name")), role)
    return out.select("fam_id", *[F.col(f"{r}_name").alias(r) for r in ("child", "father", "mother")], F.when(F.col("is_female"), 2).otherwise(1).alias("sex"))
