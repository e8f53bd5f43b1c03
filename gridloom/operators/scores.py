"""Ranked scores from several sources, cached annotations and sanity counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators.joins import interval_join
from gridloom.operators.windows import stratified_rank
from gridloom.sources.io import exists

#: How each source's score is oriented so that low is good.
ORIENT: dict[str, Callable[[Column], Column]] = {
    "forest": lambda s: 1 - s,
    "recalibration": lambda s: -s,
    "network": lambda s: -s,
    "legacy_forest": lambda s: s,
}


def default_subsets() -> dict[str, Column]:
    """The seven sub-ranks: singleton, biallelic, both, and the four of them among sites with an allele count."""
    s, b, ac = F.col("singleton"), ~F.col("was_split"), F.col("ac") > 0
    return {"singleton_rank": s, "biallelic_rank": b, "biallelic_singleton_rank": s & b, "adj_rank": ac, "adj_singleton_rank": s & ac, "adj_biallelic_rank": b & ac, "adj_biallelic_singleton_rank": s & b & ac}


def ranked_scores(sites: DataFrame, source: str, score: str, subsets: dict[str, Column] | None = None) -> DataFrame:
    """Sites with a non-ref call, scored low-is-good, ranked within snv and indel with sub-ranks."""
    if source not in ORIENT:
        raise ValueError(f"unknown score source {source!r}")
    d = sites.filter("n_nonref > 0").withColumns({"snv": X.is_snp("ref", "alt"), "score": ORIENT[source](F.col(score))})
    return stratified_rank(d, ["snv"], "score", "vid", default_subsets() if subsets is None else subsets)


def read_multiallelic_scores(raw: DataFrame, score: str) -> DataFrame:
    """One row per alternate of (Contig, Pos, Ref, Alt as a comma list, score), in minimal representation."""
    d = raw.select(F.col("Contig").alias("contig"), F.col("Pos").cast("bigint").alias("position"), F.col("Ref").alias("ref"), F.explode(F.split("Alt", ",")).alias("alt"), F.col(score).cast("double").alias("score"))
    m = F.when(F.col("alt") == "*", F.struct("position", "ref", "alt")).otherwise(X.min_rep("position", "ref", "alt"))
    return d.select("contig", m.alias("m"), "score").select("contig", "m.*", "score")


def rank_sanity(ranked: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """(rank, in_subset, has_rank, n): a rank must be there exactly for the rows of its subset."""
    rows = F.array(*[F.struct(F.lit(k).alias("rank"), F.coalesce(p, F.lit(False)).alias("in_subset"), F.col(k).isNotNull().alias("has_rank")) for k, p in ranks.items()])
    return ranked.select(F.explode(rows).alias("x")).groupBy("x.rank", "x.in_subset", "x.has_rank").agg(F.count("*").alias("n"))


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], overwrite: bool = False) -> DataFrame:
    """The table at path, built and written first if it is not there."""
    if overwrite or not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def site_counts(entries: DataFrame) -> DataFrame:
    """n_nonref, ac, ac_raw and singleton per site."""
    g, adj = F.col("n_alt"), X.is_adj("n_alt", "gq", "dp", "ad_alt")
    d = entries.groupBy("vid").agg(F.count_if(g > 0).alias("n_nonref"), F.coalesce(F.sum(F.when(adj, g)), F.lit(0)).alias("ac"), F.coalesce(F.sum(g), F.lit(0)).alias("ac_raw"))
    return d.withColumn("singleton", F.col("ac_raw") == 1)


def filter_low_confidence(sites: DataFrame, drop: list[DataFrame], keep: DataFrame | None = None) -> DataFrame:
    """Sites outside all of the drop regions and, where given, inside the keep regions."""
    for regions in drop:
        sites = interval_join(sites, regions, "left_anti")
    return sites if keep is None else interval_join(sites, keep, "left_semi")


def filter_alleles(sites: DataFrame, keep: Callable[[Column], Column]) -> DataFrame:
    """Sites with the alternates for which keep holds; kept_index maps new to old places; sites left with none go."""
    index = F.filter(F.sequence(F.lit(1), F.size("alts")), lambda i: keep(F.get("alts", i - 1)))
    d = sites.withColumn("kept_index", F.when(F.size("alts") > 0, index).otherwise(F.array().cast("array<int>")))
    return d.withColumn("alts", F.transform("kept_index", lambda i: F.get("alts", i - 1))).filter(F.size("alts") > 0)


def vqsr_pass(snv_cut: float, indel_cut: float, score: str = "score") -> Column:
    """Type-specific score cutoff in one expression."""
    return F.when(X.is_snp("ref", "alt"), F.col(score) >= snv_cut).when(X.is_indel("ref", "alt"), F.col(score) >= indel_cut).otherwise(F.lit(False))


def ratio_per_bin(bins: DataFrame, keys: list[str], bin_column: str, top: str, bottom: str) -> DataFrame:
    """Plot data: ratio of two counts per bin and of their running sums."""
    from gridloom.operators.windows import cumulative

    d = cumulative(bins, keys, bin_column, [top, bottom])
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return d.withColumns({"ratio": ratio(top, bottom), "cumulative_ratio": ratio(f"{top}_cum", f"{bottom}_cum")})
