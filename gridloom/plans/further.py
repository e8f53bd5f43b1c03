"""Further queries: site quality, axes, typed bins, cutoffs, workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators import family, ml, qc, scores, workflows
from gridloom.plans.analyses import _BINNED, _binned, _trios
from gridloom.plans.registry import query, rounded
from gridloom.plans.views import Cohort, table, view

SEVERITY = ["STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE", "ECONOMY"]


@query("SELECT vid, round(avg(gq), 6) AS gq_mean FROM v_entries GROUP BY vid HAVING count(n_alt) / 150.0 >= 0.93 AND avg(gq) >= 20 AND coalesce(sum(n_alt), 0) >= 1")
def site_quality(spark, d):
    q = qc.variant_qc(view(spark, d, "v_entries"), 150).filter("call_rate >= 0.93 and gq_mean >= 20 and AC >= 1")
    return rounded(q.select("vid", "gq_mean"))


@query("""WITH s AS (SELECT vid FROM v_variants WHERE contig NOT IN ('chrX', 'chrY') AND NOT (QD < 2 OR FS > 60 OR MQ < 30)),
e AS (SELECT *, cast(ad_alt AS double) / dp AS ab FROM v_entries SEMI JOIN s USING (vid)),
k AS (SELECT * FROM e WHERE coalesce(NOT (CASE WHEN n_alt IS NULL THEN NULL WHEN n_alt = 0 THEN ab > 0.1 WHEN n_alt = 1 THEN ab < 0.2 OR ab > 0.8 ELSE ab < 0.9 END), true) AND dp <= 100)
SELECT vid, count(*) AS n_cells, count(n_alt) AS n_called FROM k GROUP BY vid HAVING count(n_alt) / 150.0 >= 0.05 AND coalesce(sum(n_alt), 0) >= 1""")
def genotype_qc_chain(spark, d):
    c = qc.genotype_qc_chain(Cohort.load(spark, d), 150)
    return c.entries.groupBy("vid").agg(F.count("*").alias("n_cells"), F.count("n_alt").alias("n_called"))


@query("""SELECT v.vid, count(*) AS n_cells, count(e.n_alt) AS n_left FROM (SELECT vid FROM v_variants WHERE vid < 20) v CROSS JOIN (SELECT sid FROM v_samples WHERE sid < 150) s
LEFT JOIN (SELECT * FROM v_entries WHERE gq >= 50) e ON e.vid = v.vid AND e.sid = s.sid GROUP BY v.vid""")
def unfilter_entries(spark, d):
    c = Cohort.load(spark, d).filter_rows("vid < 20").filter_cols("sid < 150").filter_entries("gq >= 50").unfilter_entries()
    return c.entries.groupBy("vid").agg(F.count("*").alias("n_cells"), F.count("n_alt").alias("n_left"))


@query("SELECT vid, contig, position FROM v_variants WHERE (contig = 'chr2' AND position >= 1000 AND position < 20000) OR (contig = 'chr20' AND position >= 1)")
def interval_filter(spark, d):
    return view(spark, d, "v_variants").filter(X.in_intervals("contig", "position", ["chr2:1000-20000", "chr20"])).select("vid", "contig", "position")


@query("""SELECT p_partkey, CASE WHEN contains(t, ' STANDARD ') THEN 'STANDARD' WHEN contains(t, ' PROMO ') THEN 'PROMO' WHEN contains(t, ' SMALL ') THEN 'SMALL' WHEN contains(t, ' MEDIUM ') THEN 'MEDIUM'
  WHEN contains(t, ' LARGE ') THEN 'LARGE' WHEN contains(t, ' ECONOMY ') THEN 'ECONOMY' END AS worst FROM (SELECT p_partkey, ' ' || p_type || ' ' AS t FROM part)""")
def worst_consequence(spark, d):
    return table(spark, d, "part").select("p_partkey", workflows.worst_of(F.split("p_type", " "), SEVERITY).alias("worst"))


@query("""WITH b AS (SELECT p_retailprice AS x, p_size > 25 AS snv FROM part), q AS (SELECT snv, quantile_cont(x, [0.25, 0.5, 0.75]) AS c FROM b GROUP BY snv)
SELECT snv, 1 + cast((c[1] < x) AS BIGINT) + cast((c[2] < x) AS BIGINT) + cast((c[3] < x) AS BIGINT) AS bin, count(*) AS n FROM b JOIN q USING (snv) GROUP BY 1, 2""")
def typed_quantile_bins(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("x"), (F.col("p_size") > 25).alias("snv"))
    b = workflows.typed_quantile_bins(p, "x", "p_partkey", "snv", 4)
    return b.groupBy("snv", F.col("bin").cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


@query("""SELECT sid, round(avg(dp) FILTER (WHERE contig = 'chrX') / nullif(avg(dp) FILTER (WHERE contig = 'chr20'), 0), 6) AS x_ploidy_ratio,
  round(avg(dp) FILTER (WHERE contig = 'chrY') / nullif(avg(dp) FILTER (WHERE contig = 'chr20'), 0), 6) AS y_ploidy_ratio FROM v_entries JOIN v_variants USING (vid) GROUP BY sid""")
def ploidy_ratios(spark, d):
    return rounded(qc.ploidy_ratios(view(spark, d, "v_entries"), view(spark, d, "v_variants")))


@query(_BINNED + "SELECT min(score) FILTER (WHERE snv AND bin = 15) AS snv_cut, min(score) FILTER (WHERE NOT snv AND bin = 12) AS indel_cut FROM x WHERE bin_id = 'rank'")
def bin_cutoffs(spark, d):
    b = _binned(spark, d).groupBy("bin_id", "snv", "bin").agg(F.min("score").alias("min_score"))
    s, i = ml.cutoff_from_bins(b, "rank", 15, 12)
    return spark.createDataFrame([(s, i)], "snv_cut double, indel_cut double")


_COUNTS = """(SELECT vid, count(*) FILTER (WHERE n_alt > 0) AS n_nonref, coalesce(sum(n_alt), 0) AS ac_raw,
  coalesce(sum(n_alt) FILTER (WHERE gq >= 20 AND dp >= 10 AND (n_alt <> 1 OR cast(ad_alt AS double) / dp > 0.2)), 0) AS ac FROM v_entries GROUP BY vid)"""


@query(f"""WITH s AS (SELECT vid, c.ac AS ac, was_split, (length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt) AS snv, FS AS score
  FROM (SELECT vid, ref, alt, was_split, FS FROM v_variants) v JOIN {_COUNTS} c USING (vid) WHERE n_nonref > 0)
SELECT vid, row_number() OVER w - 1 AS rank,
  CASE WHEN NOT was_split AND ac > 0 THEN cast(sum(CASE WHEN NOT was_split AND ac > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY snv ORDER BY -score, vid ROWS UNBOUNDED PRECEDING) AS BIGINT) - 1 END AS adj_biallelic_rank
FROM s WINDOW w AS (PARTITION BY snv ORDER BY -score, vid)""")
def ranked_scores(spark, d):
    sites = view(spark, d, "v_variants").drop("AC").join(scores.site_counts(view(spark, d, "v_entries")), "vid")
    return scores.ranked_scores(sites, "recalibration", "FS").select("vid", "rank", "adj_biallelic_rank")


@query("SELECT 'adj_rank' AS rank, n_c > 0 AS in_subset, n_c > 0 AS has_rank, count(*) AS n FROM (SELECT vid, ac AS n_c FROM " + _COUNTS + " WHERE n_nonref > 0) GROUP BY 2, 3")
def rank_sanity(spark, d):
    sites = view(spark, d, "v_variants").drop("AC").join(scores.site_counts(view(spark, d, "v_entries")), "vid")
    r = scores.ranked_scores(sites, "forest", "QD")
    return scores.rank_sanity(r, {"adj_rank": F.col("ac") > 0})


@query("SELECT sid, s, pop, contig, count(n_alt) AS n_called FROM v_entries JOIN v_samples USING (sid) JOIN v_variants USING (vid) GROUP BY sid, s, pop, contig")
def entries_with_axes(spark, d):
    c = Cohort.load(spark, d)
    return c.table().groupBy("sid", "s", "pop", "contig").agg(F.count("n_alt").alias("n_called"))


@query("SELECT o_custkey % 50 AS k, count(DISTINCT x) AS n FROM (SELECT o_custkey, unnest([o_orderstatus, o_orderpriority]) AS x FROM orders) GROUP BY 1")
def explode_distinct(spark, d):
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("k"), F.explode(F.array("o_orderstatus", "o_orderpriority")).alias("x"))
    return o.groupBy("k").agg(F.count_distinct("x").alias("n"))


@query("""SELECT vid, count(*) FILTER (WHERE a) AS n_trios_adj, cast(coalesce(sum(c) FILTER (WHERE a), 0) AS BIGINT) AS ac_children_adj FROM (
  SELECT c.vid, c.n_alt AS c, c.gq >= 20 AND fa.gq >= 20 AND mo.gq >= 20 AS a FROM v_fam f JOIN v_entries c ON c.sid = f.proband JOIN v_entries fa ON fa.sid = f.father AND fa.vid = c.vid
  JOIN v_entries mo ON mo.sid = f.mother AND mo.vid = c.vid WHERE c.n_alt IS NOT NULL AND fa.n_alt IS NOT NULL AND mo.n_alt IS NOT NULL) GROUP BY vid""")
def trio_stats_adj(spark, d):
    adj = (F.col("child_gq") >= 20) & (F.col("father_gq") >= 20) & (F.col("mother_gq") >= 20)
    return family.trio_stats(_trios(spark, d, ("n_alt", "gq")), adj).select("vid", "n_trios_adj", "ac_children_adj")


@query("""SELECT cohort, verdict, count(*) AS n FROM (SELECT cohort, CASE WHEN sid % 7 = 0 THEN 'unknown' WHEN (sid % 3 = 0) = is_female THEN 'match' ELSE 'mismatch' END AS verdict FROM v_samples) GROUP BY cohort, verdict""")
def sex_verdicts(spark, d):
    s = view(spark, d, "v_samples")
    seen = s.select("sid", F.when(F.col("sid") % 7 != 0, F.col("sid") % 3 == 0).alias("is_female"))
    return workflows.sex_concordance(seen, s.select("sid", "cohort", "is_female"), "cohort")


@query()
def qc_ready_cohort(spark, d):
    c = workflows.qc_ready(Cohort.load(spark, d), 150, {"call_rate": 0.9, "inbreeding": None, "p_hwe": None, "FS": None, "MQ": None}, 0.3, 5_000)
    return c.cols.filter("sample_callrate is not null").select("sid", "sample_callrate")


@query()
def relatedness(spark, d):
    e = view(spark, d, "v_entries").select("vid", "sid", "n_alt")
    return workflows.relatedness_step(e, 0.05, 2)
