"""Queries over the feature table, binned evaluation, frequency strata and split cells, and round trips through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators import evaluation, family, joins, ml, popgen
from gridloom.plans.registry import query, rounded
from gridloom.plans.views import Cohort, table, view
from gridloom.session import shared_folder
from gridloom.sources import io

_SNV = "(length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt)"
_SUBSETS = {
    "passed_once": "transmitted_singleton", "unsplit": "NOT was_split", "unsplit_passed_once": "NOT was_split AND transmitted_singleton",
    "de_novo_likely": "p_de_novo > 0.5", "de_novo_strong": "p_de_novo > 0.9", "silent": "consequence = 'synonymous_variant'",
}
_RANKS = ", ".join(f"CASE WHEN {p} THEN cast(sum(CASE WHEN {p} THEN 1 ELSE 0 END) OVER w AS BIGINT) - 1 END AS {k}" for k, p in _SUBSETS.items())
#: Some sites have no alternate, so their type is missing: they are ranked among themselves.
_HOLES = f"""h AS (SELECT * EXCLUDE (alt, score), CASE WHEN vid % 31 <> 0 THEN alt END AS alt, CASE WHEN vid % 37 <> 0 THEN score END AS score FROM v_annotated),
r AS (SELECT *, row_number() OVER w - 1 AS rank, {_RANKS} FROM (SELECT *, CASE WHEN alt IS NOT NULL THEN {_SNV} END AS snv FROM h) WINDOW w AS (PARTITION BY snv ORDER BY score NULLS LAST, vid ROWS UNBOUNDED PRECEDING))"""
_LONG = "l AS (" + " UNION ALL ".join(f"SELECT *, '{k}' AS rank_id, {k} AS r0 FROM r WHERE {k} IS NOT NULL" for k in ("rank", *_SUBSETS)) + "), x AS (SELECT *, cast(ceil((r0 + 1) / cast(greatest(1, floor(count(*) OVER (PARTITION BY snv, rank_id) / 20.0)) AS double)) AS BIGINT) AS bin FROM l)"


def _holes(spark, d):
    v = view(spark, d, "v_annotated")
    return v.withColumns({"alt": F.when(F.col("vid") % 31 != 0, F.col("alt")), "score": F.when(F.col("vid") % 37 != 0, F.col("score"))})


@query(f"WITH {_HOLES} SELECT vid, rank, {', '.join(_SUBSETS)} FROM r")
def family_subranks(spark, d):
    from gridloom.operators.windows import stratified_rank

    s = _holes(spark, d).withColumn("snv", X.is_snp("ref", "alt"))
    return stratified_rank(s, ["snv"], "score", "vid", evaluation.family_subsets()).select("vid", "rank", *_SUBSETS)


@query(f"""WITH {_HOLES}, {_LONG}, y AS (SELECT *, length(alt) - length(ref) AS grown, ref || alt IN ('AG', 'GA', 'CT', 'TC') AS ti, consequence IS NOT DISTINCT FROM 'synonymous_variant' AS quiet,
  unrelated_ac = 1 AND ac_raw < 3 AS rare FROM x)
SELECT rank_id, snv, bin, contig, {', '.join(f"{k} IS NOT NULL AS in_{k}" for k in _SUBSETS)}, count(*) AS n, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
  count(*) FILTER (WHERE grown > 0 AND alt <> '*') AS insertion, count(*) FILTER (WHERE grown < 0 AND alt <> '*') AS deletion, count(*) FILTER (WHERE ti) AS transition, count(*) FILTER (WHERE snv AND NOT ti) AS transversion,
  count(*) FILTER (WHERE abs(grown) = 1) AS length_1, count(*) FILTER (WHERE abs(grown) % 3 = 0) AS length_3n, count(*) FILTER (WHERE fail_hard_filters) AS hard_filtered, count(*) FILTER (WHERE transmitted_singleton) AS passed_once,
  count(*) FILTER (WHERE p_de_novo > 0.5) AS de_novo_likely, count(*) FILTER (WHERE p_de_novo > 0.5 AND quiet) AS de_novo_likely_silent, count(*) FILTER (WHERE p_de_novo > 0.99) AS de_novo_sure, count(*) FILTER (WHERE p_de_novo > 0.99 AND quiet) AS de_novo_sure_silent,
  count(*) FILTER (WHERE confidence = 'HIGH') AS de_novo_confident, count(*) FILTER (WHERE inheritance = 'De novo constitutive') AS de_novo_validated,
  cast(sum(CASE WHEN rare THEN t ELSE 0 END) AS BIGINT) AS passed, cast(sum(CASE WHEN rare AND quiet THEN t ELSE 0 END) AS BIGINT) AS passed_silent,
  cast(sum(CASE WHEN rare THEN u ELSE 0 END) AS BIGINT) AS kept, cast(sum(CASE WHEN rare AND quiet THEN u ELSE 0 END) AS BIGINT) AS kept_silent,
  count(*) FILTER (WHERE n_transmitted = 1) AS passed_in_one, count(*) FILTER (WHERE n_untransmitted = 1) AS kept_in_one, cast(sum(CASE WHEN unrelated_ac = 0 THEN errors ELSE 0 END) AS BIGINT) AS errors,
  count(*) FILTER (WHERE unrelated_ac = 0 AND errors > 0) AS erring, count(*) FILTER (WHERE unrelated_ac = 1 AND t = 1) AS passed_in_training, count(*) FILTER (WHERE hapmap) AS hapmap, count(*) FILTER (WHERE omni) AS omni, count(*) FILTER (WHERE mills) AS mills, count(*) FILTER (WHERE kgp_phase1_hc) AS kgp_phase1_hc
FROM y GROUP BY rank_id, snv, bin, contig, {', '.join(f"in_{k}" for k in _SUBSETS)}""")
def full_bin_evaluation(spark, d):
    subsets = evaluation.family_subsets()
    return rounded(evaluation.bin_evaluation(evaluation.ranked_bins(_holes(spark, d), "score", subsets, 20), list(subsets), ["contig"]))


_FEATURES = f"""WITH s AS (SELECT vid, ref, alt, vid % 3 = 0 AS multi, was_split, cast(1 AS BIGINT) AS a_index, MQ, QD, FS,
  CASE WHEN vid % 8 = 0 THEN NULL ELSE cast(vid % 19 AS double) END AS mq_rank, CASE WHEN vid % 9 = 0 THEN NULL ELSE cast(vid % 23 AS double) END AS sor, cast(vid % 17 AS double) AS read_pos,
  CASE WHEN vid % 7 = 0 THEN NULL ELSE vid % 40 / 20.0 - 1 END AS f, hapmap, omni, vid % 7 = 0 AS mills, vid % 11 = 0 AS kgp, vid % 3 AS tr, AC FROM v_variants),
k AS (SELECT *, CASE WHEN multi AND {_SNV} THEN 'mixed' WHEN multi AND alt <> '*' THEN 'multi-indel' WHEN multi THEN 'indel' WHEN {_SNV} THEN 'snv' WHEN alt <> '*' THEN 'indel' END AS variant_type FROM s),
m AS (SELECT variant_type AS vt, median(f) AS f, median(QD) AS qd, median(mq_rank) AS mq_rank, median(sor) AS sor FROM k GROUP BY variant_type)
SELECT vid, variant_type, CASE WHEN alt = '*' THEN 'star' WHEN {_SNV} THEN 'snv' WHEN length(alt) > length(ref) THEN 'ins' WHEN length(alt) < length(ref) THEN 'del' ELSE 'complex' END AS allele_type,
  cast(CASE WHEN multi THEN 1 ELSE 0 END + CASE WHEN alt <> '*' THEN 1 ELSE 0 END AS BIGINT) AS n_alt_alleles, coalesce(variant_type = 'mixed', false) AS was_mixed, alt = '*' AS has_star,
  round(coalesce(k.f, m.f), 6) AS "InbreedingCoeff", round(k.QD, 6) AS "QD", round(coalesce(k.mq_rank, m.mq_rank), 6) AS "MQRankSum", round(coalesce(k.sor, m.sor), 6) AS "SOR", read_pos AS "ReadPosRankSum",
  tr = 1 AND AC = 2 AS transmitted_singleton, k.QD < 2 OR FS > 60 OR MQ < 30 AS fail_hard_filters, cast(AC AS BIGINT) AS ac_raw, mills, kgp AS kgp_phase1_hc
FROM k JOIN m ON k.variant_type IS NOT DISTINCT FROM m.vt"""


@query(_FEATURES)
def feature_table(spark, d):
    v, vid = view(spark, d, "v_variants"), F.col("vid")
    some = lambda k, x: F.when(vid % k != 0, x)
    sites = v.select("vid", "ref", "alt", "was_split", F.lit(1).cast("long").alias("a_index"), "MQ", "QD", "FS", some(8, (vid % 19).cast("double")).alias("MQRankSum"), some(9, (vid % 23).cast("double")).alias("SOR"), (vid % 17).cast("double").alias("ReadPosRankSum"))
    whole = v.select("vid", "ref", F.when(vid % 3 == 0, F.array(F.concat("ref", F.lit("A")), "alt")).otherwise(F.array("alt")).alias("alts"))
    out = evaluation.feature_table(
        sites, evaluation.allele_data(whole), v.select("vid", some(7, vid % 40 / 20.0 - 1).alias("InbreedingCoeff")), v.select("vid", "hapmap", "omni", (vid % 7 == 0).alias("mills"), (vid % 11 == 0).alias("kgp_phase1_hc")),
        v.select("vid", (vid % 3).alias("n_transmitted_raw")), v.select("vid", F.col("AC").alias("ac_raw")),
    )
    return rounded(out.select("vid", *evaluation.CATEGORICAL, *evaluation.NUMERIC, "transmitted_singleton", "fail_hard_filters", "ac_raw", "mills", "kgp_phase1_hc"))


_ADJ = "gq >= 20 AND dp >= 10 AND (n_alt <> 1 OR cast(ad_alt AS double) / dp > 0.2)"


@query(f"""WITH s AS (SELECT sid, pop, cohort, row_number() OVER (ORDER BY md5('0/' || sid), sid) - 1 AS g, row_number() OVER (PARTITION BY pop ORDER BY md5('0/' || sid), sid) - 1 AS p, count(*) OVER (PARTITION BY pop) AS n
  FROM v_samples WHERE sid < 150), z AS (SELECT DISTINCT k FROM (SELECT unnest([20, 60]) AS k UNION ALL SELECT n FROM s) WHERE k <= 150),
m AS (SELECT sid, 'downsample_' || k AS stratum, 'global' AS level FROM s, z WHERE g < k UNION ALL SELECT sid, 'downsample_' || k, pop FROM s, z WHERE p < k AND k <= n UNION ALL SELECT sid, 'subpop', pop || '_' || cohort FROM s)
SELECT vid, stratum, level, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS "AC", 2 * count(n_alt) AS "AN" FROM v_entries JOIN m USING (sid) WHERE {_ADJ} GROUP BY vid, stratum, level""")
def downsampled_freq(spark, d):
    s = view(spark, d, "v_samples").filter("sid < 150")
    f = popgen.stratified_freq(view(spark, d, "v_entries"), s, (20, 60), subpop="cohort")
    return f.filter("stratum like 'downsample%' or stratum = 'subpop'").select("vid", "stratum", "level", "AC", "AN")


@query("""WITH c AS (SELECT vid, sid, CASE WHEN n_alt IS NOT NULL THEN [CASE WHEN n_alt = 2 THEN 2 ELSE 0 END, CASE WHEN n_alt >= 1 THEN 1 ELSE 0 END] END AS al, [dp, ad_alt, gq] AS ad,
  [gq, dp, ad_alt, gq + 1, dp + 2, ad_alt + 3] AS pl FROM v_entries),
x AS (SELECT *, unnest([1, 2]) AS a_index FROM c),
y AS (SELECT *, CASE WHEN a_index = 1 THEN [least(pl[1], pl[4], pl[6]), least(pl[2], pl[5]), pl[3]] ELSE [least(pl[1], pl[2], pl[3]), least(pl[4], pl[5]), pl[6]] END AS q FROM x)
SELECT vid, cast(a_index AS BIGINT) AS a_index, count(al) AS n_called, cast(coalesce(sum(len(list_filter(al, lambda a: a = a_index))), 0) AS BIGINT) AS ac, cast(sum(ad[1]) AS BIGINT) AS ad_ref,
  cast(sum(ad[a_index + 1]) AS BIGINT) AS ad_alt, cast(sum(q[1] + 2 * q[2] + 3 * q[3]) AS BIGINT) AS pl, cast(sum(least(99, list_sort(q)[2] - list_sort(q)[1])) AS BIGINT) AS gq FROM y GROUP BY vid, a_index""")
def split_cells(spark, d):
    e, g = view(spark, d, "v_entries"), F.col("n_alt")
    call = F.when(g.isNotNull(), F.array(F.when(g == 2, 2).otherwise(0), F.when(g >= 1, 1).otherwise(0)))
    cells = e.select("vid", "sid", call.alias("alleles"), F.array("dp", "ad_alt", "gq").alias("ad"), F.array("gq", "dp", "ad_alt", F.col("gq") + 1, F.col("dp") + 2, F.col("ad_alt") + 3).alias("pl"), "gq")
    s = popgen.split_cells(cells, view(spark, d, "v_variants").select("vid", F.array("alt", F.lit("G")).alias("alts")))
    pl = F.get("pl", F.lit(0)) + 2 * F.get("pl", F.lit(1)) + 3 * F.get("pl", F.lit(2))
    return s.groupBy("vid", F.col("a_index").cast("long").alias("a_index")).agg(
        F.count("n_alt").alias("n_called"), F.coalesce(F.sum("n_alt"), F.lit(0)).cast("long").alias("ac"), F.sum("ad_ref").cast("long").alias("ad_ref"), F.sum("ad_alt").cast("long").alias("ad_alt"),
        F.sum(pl).cast("long").alias("pl"), F.sum("gq").cast("long").alias("gq"),
    )


@query("""SELECT vid, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS "unrelated_AC", 2 * count(n_alt) AS "unrelated_AN", count(*) FILTER (WHERE n_alt = 2) AS unrelated_n_hom
FROM v_entries ANTI JOIN (SELECT proband AS sid FROM v_fam) USING (sid) GROUP BY vid""")
def unrelated_call_stats(spark, d):
    return family.unrelated_call_stats(view(spark, d, "v_entries"), view(spark, d, "v_fam")).drop("unrelated_AF")


@query("""SELECT i, j, a.rank AS rank_i, b.rank AS rank_j FROM (SELECT o_custkey AS i, o_orderkey % 1000 AS j FROM orders) p
LEFT JOIN (SELECT sid, row_number() OVER (ORDER BY sid) AS rank FROM v_samples WHERE sid % 3 <> 0) a ON a.sid = i LEFT JOIN (SELECT sid, row_number() OVER (ORDER BY sid) AS rank FROM v_samples WHERE sid % 3 <> 0) b ON b.sid = j""")
def rank_pairs(spark, d):
    from gridloom.operators.windows import stratified_rank

    pairs = table(spark, d, "orders").select(F.col("o_custkey").alias("i"), (F.col("o_orderkey") % 1000).alias("j"))
    s = stratified_rank(view(spark, d, "v_samples").filter("sid % 3 <> 0").withColumn("all", F.lit(1)), ["all"], "sid", "sid")
    return joins.rank_pairs(pairs, s.select("sid", (F.col("rank") + 1).alias("rank"))).select("i", "j", "rank_i", "rank_j")


@query("SELECT k, side FROM (SELECT o_custkey AS k, 'both' AS side FROM orders INTERSECT SELECT c_custkey, 'both' FROM customer UNION ALL (SELECT c_custkey, 'customer' FROM customer EXCEPT SELECT o_custkey, 'customer' FROM orders))")
def key_sets(spark, d):
    o, c = table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return joins.intersect_keys(o, c, ["k"]).withColumn("side", F.lit("both")).unionByName(joins.except_keys(c, o, ["k"]).withColumn("side", F.lit("customer")))


@query("""SELECT tp, fp, train, label, predicted, count(*) AS n FROM (SELECT *, train0 AND label IS NOT NULL AS train FROM (SELECT hapmap AS tp, QD < 5 AS fp, vid % 4 <> 0 AS train0,
  CASE WHEN hapmap AND QD < 5 THEN NULL WHEN hapmap THEN 'TP' WHEN QD < 5 THEN 'FP' END AS label, CASE WHEN vid % 3 = 1 THEN 'TP' ELSE 'FP' END AS predicted FROM v_variants)) GROUP BY ALL""")
def prediction_summary(spark, d):
    v = view(spark, d, "v_variants").withColumn("low", F.col("QD") < 5)
    t = ml.training_labels(v, ["hapmap"], "low", F.col("vid") % 4 == 0).withColumn("predicted", F.when(F.col("vid") % 3 == 1, "TP").otherwise("FP"))
    return ml.prediction_summary(t)


@query("""SELECT vid, s, n_alt, position, ref, alt FROM v_entries JOIN v_samples USING (sid) JOIN v_variants USING (vid) WHERE gq >= 30""")
def vcf_round_trip(spark, d):
    """Cells written as VCF text and read back; what the filter removed is missing in its place."""
    c, path = Cohort.load(spark, d), shared_folder(spark, "vcf")
    samples = c.cols.join(c.entries.select("sid").distinct(), "sid", "left_semi").select("sid", "s")
    sites = c.rows.join(c.entries.select("vid").distinct(), "vid", "left_semi")
    sites = sites.select("vid", "contig", "position", F.col("vid").cast("string").alias("rsid"), "ref", F.array("alt").alias("alts"), F.array().cast("array<string>").alias("filters"))
    g = F.col("n_alt")
    calls = F.when(g.isNotNull(), F.array((g == 2).cast("int"), (g >= 1).cast("int")))
    io.export_vcf(sites, path, c.entries.filter("gq >= 30").select("vid", "sid", calls.alias("alleles"), "gq", "dp"), samples)
    back, names, cells = io.read_vcf(spark, f"{path}/shards", header=f"{path}/header")
    back = back.select("vid", F.col("rsid").cast("long").alias("site"), "position", "ref", F.get("alts", F.lit(0)).alias("alt"))
    out = cells.filter("gq is not null").join(back, "vid").join(names, "sid")
    return out.select(F.col("site").alias("vid"), "s", F.col("n_alt").cast("long").alias("n_alt"), "position", "ref", "alt")


@query("""SELECT vid, contig, position, round(QD, 6) AS qd, hapmap FROM v_variants""")
def table_round_trip(spark, d):
    """Nested rows exported as flat text and read back with types."""
    path = shared_folder(spark, "table")
    v = view(spark, d, "v_variants").select("vid", F.struct("contig", "position").alias("locus"), F.struct(F.col("QD").alias("qd")).alias("info"), "hapmap")
    io.export_table(v, path)
    t = io.read_table(spark, path, types={"vid": "bigint", "hapmap": "boolean"})
    return rounded(t.select("vid", F.col("`locus.contig`").alias("contig"), F.col("`locus.position`").cast("bigint").alias("position"), F.col("`info.qd`").cast("double").alias("qd"), "hapmap"))


@query("SELECT vid, contig, position FROM v_variants WHERE (contig, position // 100000) IN (SELECT contig, position // 100000 FROM v_variants WHERE vid % 50 = 0)")
def bed_round_trip(spark, d):
    """Regions written as BED text, read back, and joined to the sites they hold."""
    path, v = shared_folder(spark, "bed"), view(spark, d, "v_variants")
    k = F.floor(F.col("position") / 100_000)
    r = v.filter("vid % 50 = 0").select("contig", (k * 100_000 - 1).cast("string").alias("a"), ((k + 1) * 100_000 - 1).cast("string").alias("b")).distinct()
    r.select(F.concat_ws("\t", "contig", "a", "b")).write.mode("overwrite").text(path)
    return joins.interval_join(v, io.read_bed(spark, path), "left_semi").select("vid", "contig", "position")


@query("SELECT sid, s, cohort, count(n_alt) AS n_called FROM v_entries JOIN v_samples USING (sid) GROUP BY sid, s, cohort")
def cohort_round_trip(spark, d):
    """A cohort with constants written, read back and aggregated by sample."""
    path = shared_folder(spark, "cohort")
    Cohort.load(spark, d).annotate_constants(build=38, source="block").write(path)
    c = Cohort.read(spark, path)
    if c.constants != {"build": 38, "source": "block"}:
        raise ValueError("the cohort's constants were lost")
    return c.entries.join(c.cols, "sid").groupBy("sid", "s", "cohort").agg(F.count("n_alt").alias("n_called"))
