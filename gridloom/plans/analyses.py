"""Queries over ranks, bins, frequencies, outliers and families."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions import expr as X
from gridloom.operators import aggregates as A
from gridloom.operators import evaluation, family, popgen, qc, windows
from gridloom.plans.registry import query, r6, rounded
from gridloom.plans.views import table, view

_SNV = "(length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt)"


def _scored(spark, d):
    return view(spark, d, "v_variants").withColumns({"snv": X.is_snp("ref", "alt"), "score": 1 - F.col("QD") / 30})


@query(f"""SELECT vid, {_SNV} AS snv, row_number() OVER (PARTITION BY {_SNV} ORDER BY 1 - QD / 30, vid) - 1 AS rank FROM v_variants""")
def stratified_rank(spark, d):
    return windows.stratified_rank(_scored(spark, d), ["snv"], "score", "vid").select("vid", "snv", "rank")


@query(f"""WITH b AS (SELECT *, {_SNV} AS snv, 1 - QD / 30 AS score FROM v_variants)
SELECT vid, row_number() OVER w - 1 AS rank,
  CASE WHEN AC = 1 THEN sum(CASE WHEN AC = 1 THEN 1 ELSE 0 END) OVER r - 1 END AS singleton_rank,
  CASE WHEN NOT was_split THEN sum(CASE WHEN NOT was_split THEN 1 ELSE 0 END) OVER r - 1 END AS biallelic_rank
FROM b WINDOW w AS (PARTITION BY snv ORDER BY score, vid), r AS (PARTITION BY snv ORDER BY score, vid ROWS UNBOUNDED PRECEDING)""")
def subranks(spark, d):
    out = windows.stratified_rank(_scored(spark, d), ["snv"], "score", "vid", {"singleton_rank": F.col("AC") == 1, "biallelic_rank": ~F.col("was_split")})
    return out.select("vid", "rank", "singleton_rank", "biallelic_rank")


def _binned(spark, d, n_bins: int = 20):
    """(…, bin_id, bin): every site once per ranking it takes part in, with the bin of its rank among its type."""
    sets = {"rank": None, "singleton_rank": F.col("AC") == 1, "biallelic_rank": ~F.col("was_split")}
    v = windows.stratified_rank(_scored(spark, d), ["snv"], "score", "vid", {k: p for k, p in sets.items() if p is not None})
    long = v.withColumn("x", F.explode(F.array(*[F.struct(F.lit(k).alias("bin_id"), F.col(k).alias("r")) for k in sets]))).select(*v.columns, "x.*").filter("r is not null")
    n = long.groupBy("snv", "bin_id").agg(F.count("*").alias("n_type"))
    return long.join(F.broadcast(n), ["snv", "bin_id"]).withColumn("bin", windows.rank_bin(F.col("r"), F.col("n_type"), n_bins))


_BINNED = f"""WITH b AS (SELECT *, {_SNV} AS snv, 1 - QD / 30 AS score FROM v_variants),
k AS (SELECT *, 'rank' AS bin_id FROM b UNION ALL SELECT *, 'singleton_rank' FROM b WHERE AC = 1 UNION ALL SELECT *, 'biallelic_rank' FROM b WHERE NOT was_split),
g AS (SELECT *, row_number() OVER (PARTITION BY snv, bin_id ORDER BY score, vid) - 1 AS r, count(*) OVER (PARTITION BY snv, bin_id) AS n_type FROM k),
x AS (SELECT *, cast(ceil((r + 1) / cast(greatest(1, floor(n_type / 20.0)) AS double)) AS BIGINT) AS bin FROM g)
"""


@query(_BINNED + "SELECT bin_id, snv, bin, count(*) AS n, min(score) AS lo, max(score) AS hi FROM x GROUP BY bin_id, snv, bin")
def rank_bins(spark, d):
    return _binned(spark, d).groupBy("bin_id", "snv", F.col("bin").cast("bigint").alias("bin")).agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))


@query(_BINNED + """SELECT bin_id, contig, snv, NOT was_split AS bi_allelic, AC = 1 AS singleton, bin, count(*) AS n,
  count(*) FILTER (WHERE length(alt) > length(ref)) AS n_ins, count(*) FILTER (WHERE length(alt) < length(ref) AND alt <> '*') AS n_del,
  count(*) FILTER (WHERE ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS n_ti, count(*) FILTER (WHERE snv AND ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS n_tv,
  count(*) FILTER (WHERE abs(length(ref) - length(alt)) = 1) AS n_1bp_indel, count(*) FILTER (WHERE abs(length(ref) - length(alt)) % 3 = 0) AS n_mod3bp_indel,
  count(*) FILTER (WHERE omni) AS n_omni, count(*) FILTER (WHERE hapmap) AS n_hapmap, count(*) FILTER (WHERE QD < 2 OR FS > 60 OR MQ < 30) AS fail_hard_filters,
  round(min(score), 6) AS min_score, round(max(score), 6) AS max_score FROM x GROUP BY ALL""")
def binned_evaluation(spark, d):
    keys = {"bin_id": F.col("bin_id"), "contig": F.col("contig"), "snv": F.col("snv"), "bi_allelic": ~F.col("was_split"), "singleton": F.col("AC") == 1, "bin": F.col("bin").cast("bigint")}
    names = {"insertion": "n_ins", "deletion": "n_del", "transition": "n_ti", "transversion": "n_tv", "length_1": "n_1bp_indel", "length_3n": "n_mod3bp_indel", "omni": "n_omni", "hapmap": "n_hapmap"}
    what = {**evaluation.measures(list(names)), "fail_hard_filters": qc.hard_filter_fails()}
    return rounded(evaluation.tally(_binned(spark, d), keys, what).withColumnsRenamed(names))


@query(_BINNED + """SELECT bin, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score, count(*) AS n, count(*) FILTER (WHERE length(alt) > length(ref)) AS n_ins,
  count(*) FILTER (WHERE omni OR hapmap) AS n_truth, count(*) FILTER (WHERE AC = 1) AS n_singleton FROM x WHERE bin_id = 'rank' GROUP BY bin""")
def bin_score_agg(spark, d):
    b = _binned(spark, d).filter("bin_id = 'rank'").groupBy(F.col("bin").cast("bigint").alias("bin"))
    return rounded(b.agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count("*").alias("n"), F.count_if(X.is_insertion("ref", "alt")).alias("n_ins"), F.count_if(F.col("omni") | F.col("hapmap")).alias("n_truth"), F.count_if(F.col("AC") == 1).alias("n_singleton")))


@query("""SELECT bin, count(*) AS n, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM (
  SELECT p_retailprice, 1 + cast((q[1] < p_retailprice) AS BIGINT) + cast((q[2] < p_retailprice) AS BIGINT) + cast((q[3] < p_retailprice) AS BIGINT) + cast((q[4] < p_retailprice) AS BIGINT) AS bin
  FROM part, (SELECT quantile_cont(p_retailprice, [0.2, 0.4, 0.6, 0.8]) AS q FROM part)) GROUP BY bin""")
def quantile_bins(spark, d):
    p = table(spark, d, "part")
    cuts = windows.quantile_boundaries(p, "p_retailprice", 5)
    b = p.withColumn("bin", windows.quantile_bin(F.col("p_retailprice"), cuts, F.lit(0.0), 5).cast("bigint"))
    return b.groupBy("bin").agg(F.count("*").alias("n"), F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))


@query(_BINNED + "SELECT bin_id, snv, bin, min(score) AS min_score, max(score) AS max_score, cast(count(*) AS BIGINT) AS n FROM x GROUP BY bin_id, snv, bin")
def reaggregate_contigs(spark, d):
    per = _binned(spark, d).groupBy("bin_id", "contig", "snv", F.col("bin").cast("bigint").alias("bin")).agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count("*").alias("n"))
    return per.groupBy("bin_id", "snv", "bin").agg(F.min("min_score").alias("min_score"), F.max("max_score").alias("max_score"), F.sum("n").alias("n"))


@query(_BINNED + """, c AS (SELECT bin, count(*) FILTER (WHERE ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS ti, count(*) FILTER (WHERE snv AND ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS tv FROM x WHERE bin_id = 'rank' AND snv GROUP BY bin)
SELECT bin, round(ti / nullif(cast(tv AS double), 0), 6) AS ratio, round(sum(ti) OVER (ORDER BY bin) / nullif(cast(sum(tv) OVER (ORDER BY bin) AS double), 0), 6) AS cum_ratio FROM c""")
def cumulative_ratio(spark, d):
    c = _binned(spark, d).filter("bin_id = 'rank' and snv").groupBy(F.col("bin").cast("bigint").alias("bin")).agg(F.count_if(X.is_transition("ref", "alt")).alias("ti"), F.count_if(X.is_transversion("ref", "alt")).alias("tv"))
    c = windows.cumulative(c, [], "bin", ["ti", "tv"])
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return rounded(c.select("bin", ratio("ti", "tv").alias("ratio"), ratio("ti_cum", "tv_cum").alias("cum_ratio")))


@query("""SELECT sid, pop, row_number() OVER (ORDER BY md5('0/' || sid), sid) - 1 AS global_index, row_number() OVER (PARTITION BY pop ORDER BY md5('0/' || sid), sid) - 1 AS group_index FROM v_samples""")
def downsample_index(spark, d):
    return rounded(windows.downsample_index(view(spark, d, "v_samples").select("sid", "pop"), "sid", "pop"))


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders) WHERE k % 7 = 0")
def systematic_sample(spark, d):
    o = windows.stratified_rank(table(spark, d, "orders"), ["o_orderstatus"], "o_orderkey", "o_orderkey")
    return o.filter((F.col("rank") + 1) % 7 == 0).select("o_orderkey", "o_custkey")


_SAMPLE_METRICS = "SELECT sid, pop, count(n_alt) AS n_called, count(*) FILTER (WHERE n_alt = 1) AS n_het, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS ac FROM v_sparse JOIN v_samples USING (sid) GROUP BY sid, pop"


def _sample_metrics(spark, d):
    e = view(spark, d, "v_sparse").join(view(spark, d, "v_samples").select("sid", "pop"), "sid")
    return e.groupBy("sid", "pop").agg(F.count("n_alt").alias("n_called"), A.count_where(X.is_het("n_alt")).alias("n_het"), F.coalesce(F.sum("n_alt"), F.lit(0)).alias("ac"))


@query(f"""WITH q AS ({_SAMPLE_METRICS}), l AS (SELECT sid, pop, 'n_called' AS metric, n_called AS value FROM q UNION ALL SELECT sid, pop, 'n_het', n_het FROM q UNION ALL SELECT sid, pop, 'ac', ac FROM q),
m AS (SELECT pop, metric, median(value) AS med FROM l GROUP BY pop, metric), s AS (SELECT pop, metric, 1.4826 * median(abs(value - med)) AS mad FROM l JOIN m USING (pop, metric) GROUP BY pop, metric)
SELECT sid, metric, value <= med - 2 * mad OR value >= med + 2 * mad AS fails FROM l JOIN m USING (pop, metric) JOIN s USING (pop, metric)""")
def mad_outliers(spark, d):
    return qc.stratified_outliers(_sample_metrics(spark, d), "sid", ["pop"], ["n_called", "n_het", "ac"], 2, 2).select("sid", "metric", "fails")


@query("""WITH c AS (SELECT vid, n_alt, pop, CASE WHEN is_female THEN 'XX' ELSE 'XY' END AS sex, gq >= 20 AND dp >= 10 AND (n_alt <> 1 OR cast(ad_alt AS double) / dp > 0.2) AS adj FROM v_entries JOIN v_samples USING (sid)),
s AS (SELECT vid, n_alt, 0 AS i, 'adj' AS stratum, 'all' AS level FROM c WHERE adj UNION ALL SELECT vid, n_alt, 1, 'raw', 'all' FROM c UNION ALL SELECT vid, n_alt, 2, 'pop', pop FROM c WHERE adj
  UNION ALL SELECT vid, n_alt, 3, 'sex', sex FROM c WHERE adj UNION ALL SELECT vid, n_alt, 4, 'sex_pop', sex || '_' || pop FROM c WHERE adj)
SELECT vid, cast(i AS BIGINT) AS freq_index, stratum, level, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS "AC", 2 * count(n_alt) AS "AN", round(sum(n_alt) / nullif(2.0 * count(n_alt), 0), 6) AS "AF", count(*) FILTER (WHERE n_alt = 2) AS n_hom
FROM s GROUP BY vid, i, stratum, level""")
def stratified_freq(spark, d):
    return rounded(popgen.stratified_freq(view(spark, d, "v_entries"), view(spark, d, "v_samples").filter("sid < 150")))


@query("SELECT pop, is_female, grouping(pop) AS g_pop, grouping(is_female) AS g_sex, count(n_alt) AS n, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS ac FROM v_sparse JOIN v_samples USING (sid) GROUP BY GROUPING SETS ((pop, is_female), (pop), (is_female), ())")
def grouping_sets_freq(spark, d):
    e = view(spark, d, "v_sparse").join(view(spark, d, "v_samples").select("sid", "pop", "is_female"), "sid")
    g = e.groupingSets([["pop", "is_female"], ["pop"], ["is_female"], []], "pop", "is_female")
    return g.agg(F.grouping("pop").cast("bigint").alias("g_pop"), F.grouping("is_female").cast("bigint").alias("g_sex"), F.count("n_alt").alias("n"), F.coalesce(F.sum("n_alt"), F.lit(0)).alias("ac"))


@query("SELECT pop, cohort, count(*) AS n, round(count(*) / cast(sum(count(*)) OVER (PARTITION BY pop) AS double), 6) AS share FROM v_samples GROUP BY pop, cohort")
def normalised_counts(spark, d):
    c = view(spark, d, "v_samples").groupBy("pop", "cohort").agg(F.count("*").alias("n"))
    return c.withColumn("share", r6(F.col("n") / F.sum("n").over(W.partitionBy("pop")).cast("double")))


@query(f"""WITH q AS ({_SAMPLE_METRICS}), c AS (SELECT n_het, count(*) FILTER (WHERE pop = 'ASIA') AS a, count(*) FILTER (WHERE pop = 'EUROPE') AS b FROM q WHERE pop IN ('ASIA', 'EUROPE') GROUP BY n_het)
SELECT round(max(g), 6) AS statistic FROM (SELECT abs(sum(a) OVER o / cast(sum(a) OVER () AS double) - sum(b) OVER o / cast(sum(b) OVER () AS double)) AS g FROM c WINDOW o AS (ORDER BY n_het))""")
def ks_statistic(spark, d):
    return rounded(popgen.ks_statistic(_sample_metrics(spark, d), "pop", "ASIA", "EUROPE", "n_het"))


@query("""SELECT bin, n, cast(sum(n) OVER (ORDER BY bin) AS BIGINT) AS n_cum, round(sum(n) OVER (ORDER BY bin) / cast(sum(n) OVER () AS double), 6) AS share FROM (
  SELECT cast(CASE WHEN l_extendedprice < 5000 THEN -1 WHEN l_extendedprice > 50000 THEN 10 WHEN l_extendedprice = 50000 THEN 9 ELSE floor((l_extendedprice - 5000) / 4500) END AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1)""")
def histogram(spark, d):
    h = windows.cumulative(A.histogram(table(spark, d, "lineitem"), "l_extendedprice", 5000.0, 50000.0, 10), [], "bin", ["n"])
    return rounded(h.select("bin", "n", F.col("n_cum").cast("bigint").alias("n_cum"), (F.col("n_cum") / F.max("n_cum").over(W.partitionBy())).alias("share")))


@query()
def approx_quantiles(spark, d):
    q = [i / 100 for i in range(1, 100)]
    t = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", q, 1000).alias("q"))
    return t.select("l_returnflag", F.posexplode("q").alias("percent", "value"))


_TRIO = """(SELECT vid, fam_id, proband, max(n_alt) FILTER (WHERE role = 'c') AS c, max(n_alt) FILTER (WHERE role = 'f') AS f, max(n_alt) FILTER (WHERE role = 'm') AS m, max(gq) FILTER (WHERE role = 'c') AS c_gq
FROM v_entries JOIN (SELECT fam_id, proband, proband AS sid, 'c' AS role FROM v_fam UNION ALL SELECT fam_id, proband, father, 'f' FROM v_fam UNION ALL SELECT fam_id, proband, mother, 'm' FROM v_fam) USING (sid)
GROUP BY vid, fam_id, proband HAVING count(DISTINCT role) = 3)"""
_T = "greatest(0, least(c - CASE WHEN f = 2 THEN 1 ELSE 0 END - CASE WHEN m = 2 THEN 1 ELSE 0 END, h))"
_CALLED = f"(SELECT *, {_T} AS t FROM (SELECT *, CASE WHEN f = 1 THEN 1 ELSE 0 END + CASE WHEN m = 1 THEN 1 ELSE 0 END AS h FROM {_TRIO} WHERE c IS NOT NULL AND f IS NOT NULL AND m IS NOT NULL))"
_MENDEL = "((f = 2 AND m = 2 AND c < 2) OR (f = 0 AND m = 0 AND c > 0) OR (c = 2 AND (f = 0 OR m = 0)) OR (c = 0 AND (f = 2 OR m = 2)))"


def _trios(spark, d, fields=("n_alt",)):
    from gridloom.operators.joins import trios

    return trios(view(spark, d, "v_entries"), view(spark, d, "v_fam"), list(fields))


@query(f"SELECT vid, fam_id, proband, c AS child_n_alt, f AS father_n_alt, m AS mother_n_alt FROM {_TRIO}")
def trio_join(spark, d):
    return rounded(_trios(spark, d))


@query(f"""SELECT vid, cast(sum(t) AS BIGINT) AS n_transmitted_raw, cast(sum(h - t) AS BIGINT) AS n_untransmitted_raw, count(*) FILTER (WHERE f = 0 AND m = 0 AND c > 0) AS n_de_novos_raw,
  cast(sum(f + m) AS BIGINT) AS ac_parents_raw, cast(sum(c) AS BIGINT) AS ac_children_raw, count(*) AS n_trios_raw FROM {_CALLED} GROUP BY vid""")
def trio_stats(spark, d):
    return family.trio_stats(_trios(spark, d))


@query(f"SELECT vid, count(*) FILTER (WHERE c IS NOT NULL AND f IS NOT NULL AND m IS NOT NULL AND {_MENDEL}) AS errors FROM {_TRIO} GROUP BY vid")
def mendel_errors(spark, d):
    return family.mendel_errors(_trios(spark, d))


@query(f"""SELECT vid, t, u, round((t - u) * (t - u) / nullif(cast(t + u AS double), 0), 6) AS chi2 FROM (
  SELECT vid, cast(sum(t) AS BIGINT) AS t, cast(sum(h - t) AS BIGINT) AS u FROM {_CALLED} WHERE NOT {_MENDEL} GROUP BY vid)""")
def tdt(spark, d):
    return rounded(family.tdt(_trios(spark, d)))


@query(f"""SELECT vid, count(*) FILTER (WHERE "AC" = 2 AND c > 0 AND (f > 0 OR m > 0)) AS n_transmitted, count(*) FILTER (WHERE "AC" = 1 AND c = 0 AND (f > 0 OR m > 0)) AS n_untransmitted
FROM {_TRIO} JOIN (SELECT vid, 1 + vid % 3 AS "AC" FROM v_variants) USING (vid) GROUP BY vid""")
def transmitted_singletons(spark, d):
    ac = view(spark, d, "v_variants").select("vid", (1 + F.col("vid") % 3).alias("AC"))
    return family.singletons(_trios(spark, d), ac)


@query("""SELECT sex, recorded, count(*) AS n FROM (SELECT CASE WHEN y IS NOT NULL AND f >= 0.5 AND y <= 0.1 OR f IS NULL OR f >= 0.4 AND f <= 0.6 AND y > 0.1 THEN 'ambiguous_sex'
    WHEN y > 0.1 AND f < 0.4 THEN 'sex_aneuploidy' WHEN CASE WHEN f < 0.5 THEN true WHEN f > 0.6 THEN false END THEN 'female' ELSE 'male' END AS sex, CASE WHEN is_female THEN 'female' ELSE 'male' END AS recorded
  FROM (SELECT is_female, CASE WHEN sid % 17 = 0 THEN NULL ELSE (sid % 11) / 10.0 END AS f, CASE WHEN sid % 13 = 0 THEN NULL ELSE (sid % 5) / 20.0 END AS y FROM v_samples)) GROUP BY sex, recorded""")
def sex_concordance(spark, d):
    s = view(spark, d, "v_samples").select("is_female", F.when(F.col("sid") % 17 != 0, F.col("sid") % 11 / 10.0).alias("f"), F.when(F.col("sid") % 13 != 0, F.col("sid") % 5 / 20.0).alias("y"))
    seen = F.when(F.col("f") < 0.5, True).when(F.col("f") > 0.6, False)
    recorded = F.when(F.col("is_female"), "female").otherwise("male")
    return s.groupBy(qc.sex_class(F.col("f"), F.col("y"), seen).alias("sex"), recorded.alias("recorded")).agg(F.count("*").alias("n"))


@query(f"""WITH b AS (SELECT vid, {_SNV} AS snv, CASE WHEN vid % 7 = 0 THEN NULL ELSE QD END AS qd, CASE WHEN vid % 5 = 0 THEN NULL ELSE FS END AS fs FROM v_variants),
m AS (SELECT snv, median(qd) AS mq, median(fs) AS mf FROM b GROUP BY snv)
SELECT vid, round(coalesce(qd, mq), 6) AS qd, round(coalesce(fs, mf), 6) AS fs, qd IS NULL AS qd_imputed FROM b JOIN m USING (snv)""")
def median_impute(spark, d):
    from gridloom.operators import ml

    v = view(spark, d, "v_variants").select("vid", X.is_snp("ref", "alt").alias("snv"), F.when(F.col("vid") % 7 != 0, F.col("QD")).alias("qd"), F.when(F.col("vid") % 5 != 0, F.col("FS")).alias("fs"))
    m = ml.median_impute(v, ["qd", "fs"], ["snv"])
    return rounded(m.select("vid", "qd", "fs", F.col("feature_imputed.qd").alias("qd_imputed")))
