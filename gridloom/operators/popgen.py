"""Frequencies, multi-allelic splitting, linkage, principal components and relatedness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions.expr import is_adj, min_rep
from gridloom.operators import packed
from gridloom.operators.aggregates import call_stats
from gridloom.operators.windows import downsample_index, running_counts
from gridloom.session import with_checkpoints


def stratified_freq(entries: DataFrame, samples: DataFrame, downsamplings: tuple[int, ...] = (), extra: dict[str, Column] | None = None, subpop: str | None = None) -> DataFrame:
    """(vid, freq_index, stratum, level, AC, AN, AF, n_hom) over strata that overlap.

    0 all adj cells, 1 all cells, then populations, sexes, sex x population, subpopulations, extra ones, downsamplings.
    Downsamplings take the first n samples of a shuffled order, of all samples ("global") and of each population that has
    as many; the sizes of the populations are added to the sizes asked for, and sizes above the cohort's are left out.
    Each sample knows the strata it belongs to, so overlapping strata are one explode and one aggregation.
    """
    s = samples.withColumn("sex", F.when(F.col("is_female"), "XX").otherwise("XY"))
    sets: list[tuple[str, Column]] = [("adj", F.lit("all")), ("raw", F.lit("all")), ("pop", F.col("pop")), ("sex", F.col("sex")), ("sex_pop", F.concat_ws("_", "sex", "pop"))]
    if subpop is not None:
        sets.append(("subpop", F.when(F.col(subpop).isNotNull(), F.concat_ws("_", "pop", subpop))))
    sets += list((extra or {}).items())
    if downsamplings:
        n_of = {r["pop"]: r["n"] for r in samples.groupBy("pop").agg(F.count("*").alias("n")).collect()}  # a row a population
        sizes = sorted(n for n in {*downsamplings, *(v for k, v in n_of.items() if k is not None)} if n <= sum(n_of.values()))
        s = downsample_index(s, "sid", "pop")
        for n in sizes:
            sets.append((f"downsample_{n}", F.when(F.col("global_index") < n, "global")))
            some = [k for k, v in n_of.items() if k is not None and n <= v]
            if some:
                sets.append((f"downsample_{n}", F.when((F.col("group_index") < n) & F.col("pop").isin(some), F.col("pop"))))
    order = {name: i for i, name in enumerate(dict.fromkeys(k for k, _ in sets))}
    labels = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(order[k]).alias("freq_index"), F.lit(k).alias("stratum"), v.alias("level"))) for k, v in sets]))
    cells = entries.join(s.select("sid", labels.alias("g")), "sid").withColumn("adj", is_adj("n_alt", "gq", "dp", "ad_alt"))
    cells = cells.select("vid", "n_alt", "adj", F.explode("g").alias("g")).filter((F.col("g.stratum") == "raw") | F.col("adj"))
    return cells.groupBy("vid", "g.freq_index", "g.stratum", "g.level").agg(*[v.alias(k) for k, v in call_stats().items()])


def split_multi(sites: DataFrame, keep_star: bool = True) -> DataFrame:
    """One row per alternate allele of (contig, position, ref, alts, ...): a_index, was_split and the minimal representation."""
    d = sites.select("*", F.posexplode("alts").alias("__i", "alt")).withColumn("a_index", F.col("__i") + 1).withColumn("was_split", F.size("alts") > 1).drop("__i")
    d = d if keep_star else d.filter("alt <> '*'")
    m = F.when(F.col("alt") == "*", F.struct(F.col("position"), F.col("ref"), F.col("alt"))).otherwise(min_rep("position", "ref", "alt"))
    return d.withColumn("__m", m).withColumns({"position": F.col("__m.position"), "ref": F.col("__m.ref"), "alt": F.col("__m.alt")}).drop("__m")


def split_cells(cells: DataFrame, sites: DataFrame) -> DataFrame:
    """Cells of split_multi() rows: (vid, sid, a_index, n_alt, ad_ref, ad_alt, dp, gq, pl) for each alternate.

    The call is downcoded: other alternates count as reference. Depths are those of the reference and the alternate; of
    likelihoods by genotype (pl, in the usual order of pairs of alleles) each of the three classes by copies of the
    alternate keeps its lowest, and the quality is the second lowest of these less the lowest, at most 99. Sites with one
    alternate keep their gq where there are no likelihoods.
    """
    n = sites.select("vid", F.size("alts").alias("n_alts"))
    d = cells.join(n, "vid").withColumn("a_index", F.explode(F.sequence(F.lit(1), F.col("n_alts"))))
    d = d.withColumn("n_alt", downcode(F.col("alleles"), F.col("a_index")))
    if "ad" in cells.columns:
        d = d.withColumns({"ad_ref": F.get("ad", F.lit(0)), "ad_alt": F.get("ad", F.col("a_index"))}).drop("ad")
    if "pl" in cells.columns:
        # The pair (j, k), j <= k, of allele indices lies at k (k + 1) / 2 + j.
        alleles = F.sequence(F.lit(0), F.col("n_alts"))
        pairs = F.flatten(F.transform(alleles, lambda k: F.transform(F.sequence(F.lit(0), k), lambda j: F.struct(j.alias("j"), k.alias("k")))))
        d = d.withColumn("__pairs", F.arrays_zip(pairs.alias("pair"), F.col("pl").alias("value")))
        copies = lambda x: (x["pair"]["j"] == F.col("a_index")).cast("int") + (x["pair"]["k"] == F.col("a_index")).cast("int")
        of = lambda n: F.filter("__pairs", lambda x: copies(x) == n)
        lowest = [F.array_min(F.transform(of(n), lambda x: x["value"])) for n in range(3)]
        d = d.withColumn("__pl", F.when(F.col("pl").isNotNull(), F.array(*lowest)))
        known = F.array_sort(F.array_compact("__pl"))
        gq = F.least(F.get(known, F.lit(1)) - F.get(known, F.lit(0)), F.lit(99))
        d = d.withColumn("gq", F.when(F.col("__pl").isNotNull(), gq).when(F.col("n_alts") == 1, F.col("gq"))).withColumn("pl", F.col("__pl")).drop("__pl", "__pairs")
    return d.drop("n_alts", "alleles")


def downcode(alleles: Column, a_index: Column) -> Column:
    """Number of copies of one alternate in a call given as an array of allele indices; missing for no call."""
    return F.when(alleles.isNotNull(), F.size(F.filter(alleles, lambda a: a == a_index)))


def pc_project(entries: DataFrame, loadings: DataFrame) -> DataFrame:
    """(sid, pc, score): sum over sites of (g - 2p) / sqrt(n 2p(1 - p)) times the loading; n is the number of sites with 0 < p < 1."""
    use = loadings.filter((F.col("p") > 0) & (F.col("p") < 1))
    n = use.agg(F.count_distinct("vid").alias("n_sites"))
    norm = (F.col("n_alt") - 2 * F.col("p")) / F.sqrt(F.col("n_sites") * 2 * F.col("p") * (1 - F.col("p")))
    return entries.filter("n_alt is not null").join(use.crossJoin(F.broadcast(n)), "vid").groupBy("sid", "pc").agg(F.sum(norm * F.col("loading")).alias("score"))


def pca(entries: DataFrame, k: int = 10) -> tuple[list[float], DataFrame, DataFrame]:
    """(eigenvalues, scores (sid, pc, score), loadings (vid, pc, loading, p)) of Hardy-Weinberg normalised genotypes.

    Sites that do not vary are left out and missing cells count as the mean. The number of samples is not bounded: see
    packed.component_rows. Signs are fixed by the largest absolute score.
    """
    calls = packed.called(entries)
    order = packed.sample_order(calls)
    cells = packed.pack(calls, order)
    values, vectors, sites = packed.component_rows(cells, len(order), k)
    spark = entries.sparkSession
    if vectors is not None:
        vectors = packed.turned(spark, vectors)
    return values.tolist(), packed.score_rows(spark, order, vectors, values), packed.loadings_of(cells, sites, vectors, values)


def pca_with_relateds(entries: DataFrame, related: DataFrame, k: int = 10) -> DataFrame:
    """Scores of unrelated samples from the fit and of related ones by projection."""
    _, scores, loadings = pca(entries.join(related.select("sid"), "sid", "left_anti"), k)
    return scores.unionByName(pc_project(entries.join(related.select("sid"), "sid", "left_semi"), loadings))


def pc_relate(entries: DataFrame, scores: DataFrame, min_maf: float = 0.01, min_kinship: float | None = None, block: int | None = None) -> DataFrame:
    """(i, j, kin): residual products over sites, with allele frequencies per sample regressed on the components (Conomos et al. 2016).

    Only samples with scores take part. With min_kinship only pairs at or above it are returned. See packed.kinship.
    """
    order = packed.sample_order(scores)
    x = packed.design(scores, order)
    cells = packed.pack(packed.called(entries), order)
    return packed.kinship(cells, order, x, min_maf, min_kinship, block)


def maximal_independent_set(pairs: DataFrame, tie: DataFrame | None = None, rounds: int = 1000, keep: bool = False) -> DataFrame:
    """Nodes (node) to drop so that no pair (i, j) is left, by removing vertices of the highest degree; with keep, those that stay.

    Each round removes every vertex that is the first of its neighbourhood by (degree, tie, id): such vertices are never
    adjacent, so a round does what many single removals would, and the number of rounds is the length of the longest
    chain of ties. Pairs are those above a kinship threshold, far fewer than samples squared.
    """
    with_checkpoints(pairs.sparkSession)
    edges = pairs.select(F.col("i").alias("u"), F.col("j").alias("v")).filter("u <> v")
    edges = edges.union(edges.select("v", "u")).distinct().checkpoint()
    dropped = edges.select(F.col("u").alias("node")).limit(0)
    for _ in range(rounds):
        degree = edges.groupBy("u").agg(F.count("*").alias("d"))
        rank = degree.join(tie.select(F.col("node").alias("u"), "tie"), "u", "left") if tie is not None else degree.withColumn("tie", F.lit(0))
        order = rank.select("u", F.struct("d", F.coalesce("tie", F.lit(0)).alias("tie"), "u").alias("o"))
        best = edges.join(order.select(F.col("u").alias("v"), F.col("o").alias("ov")), "v").groupBy("u").agg(F.max("ov").alias("around"))
        out = order.join(best, "u").filter("o > around").select(F.col("u").alias("node"))
        if out.isEmpty():
            break
        dropped = dropped.union(out).checkpoint()
        edges = edges.join(dropped.withColumnRenamed("node", "u"), "u", "left_anti").join(dropped.withColumnRenamed("node", "v"), "v", "left_anti").select("u", "v").checkpoint()
        if edges.isEmpty():
            break
    if keep:
        return pairs.select(F.col("i").alias("node")).union(pairs.select("j")).distinct().join(dropped, "node", "left_anti")
    return dropped


def ld_prune(entries: DataFrame, sites: DataFrame, r2: float = 0.2, window: int = 500_000) -> DataFrame:
    """Sites kept so that no pair within the window has a squared correlation of r2 or more; greedy in order of position.

    Where fewer cells of a sample meet within the window than sites do, the cells are joined, else packed sites are
    compared. See packed.linked_by_cells, packed.linked_pairs and packed.first_choice: the same sites as a walk along each
    contig, without one task a contig.
    """
    calls = packed.called(entries.join(sites.select("vid").hint("merge"), "vid", "left_semi"))
    of_sites, of_cells = packed.meetings(calls, sites, window)
    if of_cells < of_sites:
        linked = packed.linked_by_cells(calls, sites, r2, window)
    else:
        order = packed.sample_order(calls)
        linked = packed.linked_pairs(packed.pack(calls, order), sites, len(order), r2, window)
    return sites.join(packed.first_choice(linked).hint("merge"), "vid", "left_anti")


def ks_statistic(df: DataFrame, group: str, a: str, b: str, x: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic: the largest gap between the two empirical distributions, ties taken together."""
    two = df.filter(F.col(group).isin(a, b))
    c = running_counts(two, [], x, {"na": F.count_if(F.col(group) == a), "nb": F.count_if(F.col(group) == b)})
    total = two.filter(F.col(x).isNotNull()).agg(F.count_if(F.col(group) == a).cast("double").alias("ta"), F.count_if(F.col(group) == b).cast("double").alias("tb"))
    gap = F.abs(F.try_divide(F.col("na_before") + F.col("na"), "ta") - F.try_divide(F.col("nb_before") + F.col("nb"), "tb"))
    return c.crossJoin(F.broadcast(total)).select(gap.alias("gap")).agg(F.max("gap").alias("statistic"))
