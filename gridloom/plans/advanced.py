"""Queries over projections, sex imputation, pedigrees, models and relatedness."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators import family, ml, popgen, qc
from gridloom.plans.registry import query, r6, rounded
from gridloom.plans.views import table, view


def _loadings(spark, d):
    v = view(spark, d, "v_variants").filter("vid < 200").select("vid", (F.col("vid") % 97 / 100.0).alias("p"))
    return v.crossJoin(spark.range(4).select(F.col("id").cast("int").alias("pc"))).withColumn("loading", ((F.col("vid") * (F.col("pc") + 3)) % 23 - 11) / 10.0)


@query("""WITH l AS (SELECT vid, (vid % 97) / 100.0 AS p, cast(pc AS int) AS pc, ((vid * (pc + 3)) % 23 - 11) / 10.0 AS loading FROM v_variants, (SELECT unnest([0, 1, 2, 3]) AS pc) WHERE vid < 200),
u AS (SELECT * FROM l WHERE p > 0 AND p < 1), n AS (SELECT count(DISTINCT vid) AS n FROM u)
SELECT sid, cast(pc AS BIGINT) AS pc, round(sum((n_alt - 2 * p) / sqrt(n * 2 * p * (1 - p)) * loading), 5) AS score FROM v_entries JOIN u USING (vid), n WHERE n_alt IS NOT NULL GROUP BY sid, pc""")
def pc_project(spark, d):
    s = popgen.pc_project(view(spark, d, "v_entries"), _loadings(spark, d))
    return s.select("sid", F.col("pc").cast("bigint").alias("pc"), F.round("score", 5).alias("score"))


@query("SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS n_k FROM events GROUP BY event_type")
def json_fields(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(F.get_json_object("props", "$.k")).alias("n_k"))


@query("""WITH e AS (SELECT * FROM v_entries WHERE vid % 24 = 22 AND n_alt IS NOT NULL), a AS (SELECT vid, sum(n_alt) / (2.0 * count(*)) AS af, count(*) AS n FROM e GROUP BY vid),
s AS (SELECT sid, count(*) AS n_called, sum(1 - 2 * af * (1 - af) * (2.0 * n) / (2.0 * n - 1)) AS ex, count(*) FILTER (WHERE n_alt <> 1) AS ob FROM e JOIN a USING (vid) WHERE af > 0.05 AND af < 0.95 GROUP BY sid)
SELECT sid, n_called, ob AS observed_homs, round(ex, 6) AS expected_homs, round((ob - ex) / nullif(n_called - ex, 0), 6) AS f_stat,
  CASE WHEN (ob - ex) / nullif(n_called - ex, 0) < 0.5 THEN true WHEN (ob - ex) / nullif(n_called - ex, 0) > 0.6 THEN false END AS is_female FROM s""")
def sex_f_stat(spark, d):
    x = view(spark, d, "v_variants").filter("contig = 'chrX'")
    return rounded(qc.impute_sex(view(spark, d, "v_entries"), x).select("sid", "n_called", "observed_homs", "expected_homs", "f_stat", "is_female"))


@query("""SELECT vid, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS ac_raw, cast(coalesce(sum(n_alt) FILTER (WHERE gq >= 20 AND dp >= 10 AND (n_alt <> 1 OR cast(ad_alt AS double) / dp > 0.2)), 0) AS BIGINT) AS ac_adj FROM v_entries GROUP BY vid""")
def allele_counts_adj(spark, d):
    adj = X.is_adj("n_alt", "gq", "dp", "ad_alt")
    return view(spark, d, "v_entries").groupBy("vid").agg(F.coalesce(F.sum("n_alt"), F.lit(0)).cast("bigint").alias("ac_raw"), F.coalesce(F.sum(F.when(adj, F.col("n_alt"))), F.lit(0)).cast("bigint").alias("ac_adj"))


@query("""SELECT fam_id, a.s AS child, b.s AS father, c.s AS mother, CASE WHEN f.is_female THEN 2 ELSE 1 END AS sex FROM v_fam f
JOIN v_samples a ON a.sid = proband JOIN v_samples b ON b.sid = father JOIN v_samples c ON c.sid = mother""")
def pedigree_build(spark, d):
    return family.pedigree(view(spark, d, "v_fam").withColumnRenamed("proband", "child"), view(spark, d, "v_samples").select(F.col("sid").alias("id"), F.col("s").alias("name")))


@query("""SELECT vid, CASE WHEN (snv AND p < 0.3) OR (NOT snv AND p < 0.5) THEN 1 ELSE 0 END AS rf, CASE WHEN coalesce(f < -0.3, false) THEN 1 ELSE 0 END AS inb, CASE WHEN ac = 0 THEN 1 ELSE 0 END AS ac0,
  CASE WHEN af IN (0.0, 1.0) THEN 1 ELSE 0 END AS mono, CASE WHEN (snv AND bin <= 91) OR (NOT snv AND bin <= 86) THEN 1 ELSE 0 END AS pass FROM (
  SELECT vid, (length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt) AS snv, QD / 30 AS p, CASE WHEN vid % 9 = 0 THEN NULL ELSE (vid % 20) / 10.0 - 1 END AS f, vid % 6 AS ac, (vid % 5) / 4.0 AS af, vid % 101 AS bin FROM v_variants)""")
def final_filters(spark, d):
    v = view(spark, d, "v_variants").select("vid", X.is_snp("ref", "alt").alias("is_snv"), (F.col("QD") / 30).alias("rf_probability"), F.when(F.col("vid") % 9 != 0, F.col("vid") % 20 / 10.0 - 1).alias("inbreeding"), (F.col("vid") % 6).alias("ac_adj"), (F.col("vid") % 5 / 4.0).alias("af_raw"), (F.col("vid") % 101).alias("bin"))
    out = ml.pass_by_bin(ml.final_filters(v, 0.3, 0.5), 91, 86)
    has = lambda n: F.array_contains("filters", n).cast("int")
    return out.select("vid", has("RF").alias("rf"), has("InbreedingCoeff").alias("inb"), has("AC0").alias("ac0"), has("MonoAllelic").alias("mono"), has("PASS").alias("pass"))


def _multi(spark, d):
    v = view(spark, d, "v_variants").filter("alt <> '*'")
    alts = F.when(F.col("vid") % 3 == 0, F.array(F.concat("ref", F.lit("A")), F.col("alt"), F.lit("*"))).otherwise(F.array("alt"))
    return v.select("vid", "contig", "position", "ref", alts.alias("alts"))


_TRIM = r"""SELECT vid, a_index, was_split, position + lead AS position, substr(r, 1 + lead) AS ref, substr(a, 1 + lead) AS alt FROM (
  SELECT *, coalesce(list_max(list_filter(range(0, least(length(r), length(a))), lambda i: substr(r, 1, i) = substr(a, 1, i))), 0) AS lead FROM (
    SELECT *, substr(ref, 1, length(ref) - tail) AS r, substr(alt, 1, length(alt) - tail) AS a FROM (
      SELECT *, coalesce(list_max(list_filter(range(0, least(length(ref), length(alt))), lambda i: right(ref, i) = right(alt, i))), 0) AS tail FROM s)))"""


@query("""WITH m AS (SELECT vid, position, ref, CASE WHEN vid % 3 = 0 THEN [ref || 'A', alt, '*'] ELSE [alt] END AS alts FROM v_variants WHERE alt <> '*'),
s AS (SELECT vid, position, ref, unnest(alts) AS alt, unnest(range(1, length(alts) + 1)) AS a_index, length(alts) > 1 AS was_split FROM m)
SELECT vid, cast(a_index AS BIGINT) AS a_index, was_split, position, ref, alt FROM s WHERE alt = '*' UNION ALL
SELECT vid, cast(a_index AS BIGINT), was_split, position, ref, alt FROM (""" + _TRIM.replace("FROM s)))", "FROM s WHERE alt <> '*')))") + ")")
def split_multi(spark, d):
    return popgen.split_multi(_multi(spark, d)).select("vid", F.col("a_index").cast("bigint").alias("a_index"), "was_split", "position", "ref", "alt")


@query("""WITH s AS (SELECT vid, 1 AS a_index, false AS was_split, position, 'CA' || ref || 'TT' AS ref, 'CA' || alt || 'TT' AS alt FROM v_variants WHERE alt <> '*')
SELECT vid, position, ref, alt FROM (""" + _TRIM + ")")
def min_rep(spark, d):
    v = view(spark, d, "v_variants").filter("alt <> '*'").select("vid", "position", F.concat(F.lit("CA"), "ref", F.lit("TT")).alias("ref"), F.concat(F.lit("CA"), "alt", F.lit("TT")).alias("alt"))
    return v.select("vid", X.min_rep("position", "ref", "alt").alias("m")).select("vid", "m.*")


@query("""WITH g AS (SELECT vid, count(*) FILTER (WHERE n_alt = 0) AS a, count(*) FILTER (WHERE n_alt = 1) AS b, count(*) FILTER (WHERE n_alt = 2) AS c FROM v_entries GROUP BY vid),
r AS (SELECT *, a + b + c AS n, 2 * least(a, c) + b AS rare FROM g), e AS (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS h FROM r),
l AS (SELECT *, h * ln(2) - lgamma((rare - h) // 2 + 1) - lgamma(h + 1) - lgamma(n - h - (rare - h) // 2 + 1) AS lp FROM e), p AS (SELECT *, exp(lp - max(lp) OVER (PARTITION BY vid)) AS p FROM l),
o AS (SELECT *, max(p) FILTER (WHERE h = b) OVER (PARTITION BY vid) AS seen FROM p)
SELECT vid, round(least(1.0, sum(p) FILTER (WHERE p <= seen * (1 + 1e-9)) / sum(p)), 6) AS p_hwe FROM o GROUP BY vid""")
def hwe_exact(spark, d):
    return rounded(qc.with_hwe(qc.genotype_counts(view(spark, d, "v_entries"), ["vid"])).select("vid", "p_hwe"))


@query()
def rf_train_apply(spark, d):
    v = view(spark, d, "v_variants").withColumns({"fails": qc.hard_filter_fails(), "kind": X.allele_type("ref", "alt"), "truth": F.col("hapmap") & (F.col("QD") > 5)})
    v = ml.training_labels(v.drop("AC"), ["truth", "omni"], "fails", X.in_intervals("contig", "position", ["chr20"]))
    model = ml.train_forest(ml.balanced(v, "vid"), ["QD", "FS", "MQ"], ["kind"], trees=20, key="vid")
    return ml.apply_forest(model, v).select("vid", "label", "train", "predicted", r6("prob_TP").alias("prob_TP"))


@query()
def population_rf(spark, d):
    e = table(spark, d, "embeddings")
    x = e.select("vec_id", F.when(F.col("vec_id") % 4 != 0, F.col("label").cast("string")).alias("known"), *[F.get("embedding", F.lit(i)).cast("double").alias(f"pc{i}") for i in range(10)])
    return ml.assign_population(x, [f"pc{i}" for i in range(10)], "known", 0.5, trees=20).select("vec_id", "known", "assigned")


def _sparse(spark, d):
    return view(spark, d, "v_sparse").select("vid", "sid", "n_alt")


@query()
def pca(spark, d):
    return popgen.pca(_sparse(spark, d), 4)[1]


@query()
def pca_with_relateds(spark, d):
    """Components of all samples but the probands, which are projected."""
    return popgen.pca_with_relateds(_sparse(spark, d), view(spark, d, "v_fam").select(F.col("proband").alias("sid")), 4)


@query()
def kinship(spark, d):
    e = _sparse(spark, d)
    return popgen.pc_relate(e, popgen.pca(e, 2)[1], min_kinship=0.1)


@query()
def independent_set(spark, d):
    pairs = table(spark, d, "orders").select((F.col("o_custkey") % 200).alias("i"), (F.col("o_orderkey") % 211).alias("j")).filter("i <> j and (i * 7 + j) % 13 = 0").distinct()
    return popgen.maximal_independent_set(pairs)


@query()
def ld_prune(spark, d):
    """Within 1,000,000 bases, the window that the surveyed calls with r2 = 0.1 leave at its default."""
    return popgen.ld_prune(_sparse(spark, d), view(spark, d, "v_variants"), 0.1, 1_000_000).select("vid", "contig", "position")


@query("""WITH r AS (SELECT vid, proband, max(n_alt) FILTER (WHERE role = 'c') AS c, max(n_alt) FILTER (WHERE role = 'f') AS f, max(n_alt) FILTER (WHERE role = 'm') AS m, min(gq) FILTER (WHERE role <> 'c') AS q,
  max(dp) FILTER (WHERE role = 'c') AS dp, max(ad_alt) FILTER (WHERE role = 'c') AS ad FROM v_entries
  JOIN (SELECT proband, proband AS sid, 'c' AS role FROM v_fam UNION ALL SELECT proband, father, 'f' FROM v_fam UNION ALL SELECT proband, mother, 'm' FROM v_fam) USING (sid) GROUP BY vid, proband HAVING count(DISTINCT role) = 3),
x AS (SELECT vid, proband, cast(ad AS double) / dp AS ab, 1 - pow(1 - greatest((vid % 50) / 1000.0, 100 / 30000000.0), 4) AS h, pow(10.0, -q / 10.0) AS s FROM r WHERE c = 1 AND f = 0 AND m = 0),
y AS (SELECT *, (1 - s) / 30000000 / ((1 - s) / 30000000 + h * s) AS p FROM x)
SELECT vid, proband, round(p, 6) AS p_de_novo, CASE WHEN p > 0.99 AND ab > 0.3 THEN 'HIGH' WHEN p > 0.5 AND ab > 0.2 THEN 'MEDIUM' WHEN p > 0.05 THEN 'LOW' END AS confidence FROM y""")
def de_novo(spark, d):
    from gridloom.operators.joins import trios

    t = trios(view(spark, d, "v_entries"), view(spark, d, "v_fam"), ["n_alt", "gq", "dp", "ad_alt"])
    prior = view(spark, d, "v_variants").select("vid", (F.col("vid") % 50 / 1000.0).alias("prior_af"))
    return rounded(family.de_novo(t, prior))
