"""Queries over projection, filters, joins, sets and plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators import aggregates as A
from gridloom.operators import joins as J
from gridloom.operators import qc
from gridloom.plans.registry import query, r6, rounded
from gridloom.plans.views import table, view
from gridloom.sources.io import flatten

#: Regions of the interval queries: (contig, start, end), half-open.
REGIONS = [(f"chr{c}", s, s + 9_000) for c in (1, 2, 3, 7, 22) for s in (1_000, 15_000, 40_000)] + [("chrX", 1, 30_000), ("chr1", 5_000, 12_000)]
_REGIONS_SQL = "(VALUES " + ", ".join(f"('{c}', {s}, {e})" for c, s, e in REGIONS) + ") AS r(contig, s, e)"


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "contig string, start long, end long")


@query("SELECT l_orderkey AS order_id, l_partkey AS part_id, round(l_extendedprice * (1 - l_discount), 6) AS net, l_returnflag AS flag FROM lineitem WHERE l_quantity > 45")
def scan_project_rename(spark, d):
    t = table(spark, d, "lineitem").filter("l_quantity > 45")
    return t.select("l_orderkey", "l_partkey", r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), "l_returnflag").withColumnsRenamed({"l_orderkey": "order_id", "l_partkey": "part_id", "l_returnflag": "flag"})


@query("SELECT vid, contig AS locus_contig, position + 1 AS locus_position, ref AS alleles_ref, alt AS alleles_alt FROM v_variants")
def struct_flatten(spark, d):
    v = view(spark, d, "v_variants").select("vid", F.struct("contig", "position").alias("locus"), F.struct("ref", "alt").alias("alleles"))
    return flatten(v.withColumn("locus", F.col("locus").withField("position", F.col("locus.position") + 1)), "_")


@query("SELECT token, count(*) AS n, count(DISTINCT p_partkey) AS n_parts FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS token FROM part) GROUP BY token")
def explode_tokens(spark, d):
    t = table(spark, d, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("token"))
    return t.groupBy("token").agg(F.count("*").alias("n"), F.count_distinct("p_partkey").alias("n_parts"))


@query("SELECT contig, count(*) AS n, count(*) FILTER (WHERE QD < 2 OR FS > 60 OR MQ < 30) AS n_fail FROM v_variants GROUP BY contig")
def hard_filter(spark, d):
    return view(spark, d, "v_variants").groupBy("contig").agg(F.count("*").alias("n"), A.count_where(qc.hard_filter_fails()).alias("n_fail"))


@query("SELECT vid, contig, position FROM v_variants WHERE CASE WHEN length(ref) = 1 AND length(alt) = 1 AND alt <> '*' THEN QD >= 5 AND FS <= 50 WHEN alt <> '*' THEN QD >= 10 AND FS <= 70 ELSE false END")
def type_threshold_filter(spark, d):
    v = view(spark, d, "v_variants")
    ok = X.case([(X.is_snp("ref", "alt"), (F.col("QD") >= 5) & (F.col("FS") <= 50)), (X.is_indel("ref", "alt"), (F.col("QD") >= 10) & (F.col("FS") <= 70))], F.lit(False), missing_false=True)
    return v.filter(ok).select("vid", "contig", "position")


@query("""WITH g AS (SELECT vid FROM v_entries GROUP BY vid HAVING sum(n_alt) / (2.0 * count(n_alt)) > 0.3 AND count(n_alt) / 150.0 > 0.93)
SELECT vid, contig, position FROM v_variants JOIN g USING (vid) WHERE length(ref) = 1 AND length(alt) = 1 AND alt <> '*'""")
def filter_by_row_aggregate(spark, d):
    good = qc.variant_qc(view(spark, d, "v_entries"), 150).filter("AF > 0.3 and call_rate > 0.93")
    return J.semi(view(spark, d, "v_variants").filter(X.is_snp("ref", "alt")), good, ["vid"]).select("vid", "contig", "position")


@query("SELECT c_custkey AS sid FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 1 AND c_nationkey % 5 < 4 AND c_acctbal > 0")
def pass_flag_conjunction(spark, d):
    c = table(spark, d, "customer")
    flags = {"pass_depth": F.col("c_custkey") % 2, "pass_id": F.when(F.col("c_custkey") % 3 == 1, 1).otherwise(0), "pass_sex": (F.col("c_nationkey") % 5 < 4).cast("int"), "pass_dup": (F.col("c_acctbal") > 0).cast("int")}
    return c.withColumns(flags).filter(A.all_flags(list(flags))).select(F.col("c_custkey").alias("sid"))


@query("""SELECT vid, count(*) AS n, count(*) FILTER (WHERE f) AS n_fail, count(*) FILTER (WHERE f IS NULL) AS n_missing FROM (
  SELECT vid, CASE WHEN n_alt IS NULL THEN NULL WHEN n_alt = 0 THEN ab > 0.1 WHEN n_alt = 1 THEN ab < 0.2 OR ab > 0.8 ELSE ab < 0.9 END AS f
  FROM (SELECT *, cast(ad_alt AS double) / dp AS ab FROM v_entries)) GROUP BY vid""")
def allele_balance_filter(spark, d):
    e = view(spark, d, "v_entries").withColumn("f", qc.allele_balance_fails())
    return e.groupBy("vid").agg(F.count("*").alias("n"), F.count_if("f").alias("n_fail"), F.count_if(F.col("f").isNull()).alias("n_missing"))


@query("SELECT vid, count(*) FILTER (WHERE NOT (dp > 100 OR cast(ad_alt + dp / 2 AS double) / dp < 0.9)) AS n_kept FROM (SELECT vid, dp, ad_alt FROM v_entries) GROUP BY vid")
def depth_filter(spark, d):
    e = view(spark, d, "v_entries").withColumn("f", qc.depth_fails(ad_sum=F.col("ad_alt") + F.col("dp") / 2))
    return e.groupBy("vid").agg(F.count_if(~F.col("f")).alias("n_kept"))


@query("SELECT contig, count(*) AS n FROM v_variants WHERE contig NOT IN ('chrX', 'chrY') GROUP BY contig")
def autosome_filter(spark, d):
    return view(spark, d, "v_variants").filter(X.is_autosome("contig")).groupBy("contig").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey AS vid, s_name AS supplier, q.best FROM part
LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS best FROM lineitem GROUP BY l_partkey) q ON l_partkey = p_partkey LEFT JOIN supplier ON s_suppkey = q.best""")
def lookup_join(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("vid")).agg(F.min("l_suppkey").alias("best"))
    p = J.lookup(table(spark, d, "part").select(F.col("p_partkey").alias("vid")), li, ["vid"])
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("best"), F.col("s_name").alias("supplier"))
    return J.lookup(p, s, ["best"]).select("vid", "supplier", "best")


@query("""SELECT v.vid, s.score FROM v_variants v LEFT JOIN (SELECT contig, position, max(QD) AS score FROM v_variants WHERE vid % 3 = 0 GROUP BY contig, position) s
  ON v.contig = s.contig AND v.position = s.position""")
def partial_key_lookup(spark, d):
    v = view(spark, d, "v_variants")
    scores = v.filter("vid % 3 = 0").select("contig", "position", F.col("QD").alias("score"))
    return J.lookup(v.select("vid", "contig", "position"), scores, ["contig", "position"], [F.col("score").desc()]).select("vid", "score")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_join(spark, d):
    o = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi(table(spark, d, "customer"), o, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_join(spark, d):
    o = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return J.anti(table(spark, d, "customer"), o, ["c_custkey"]).select("c_custkey", "c_name")


@query(f"SELECT vid, contig, position FROM v_variants v WHERE EXISTS (SELECT 1 FROM {_REGIONS_SQL} WHERE r.contig = v.contig AND v.position >= r.s AND v.position < r.e)")
def interval_semi(spark, d):
    return J.interval_join(view(spark, d, "v_variants"), regions(spark), "left_semi").select("vid", "contig", "position")


@query(f"SELECT vid, contig, position FROM v_variants v WHERE NOT EXISTS (SELECT 1 FROM {_REGIONS_SQL} WHERE r.contig = v.contig AND v.position >= r.s AND v.position < r.e)")
def interval_anti(spark, d):
    return J.interval_join(view(spark, d, "v_variants"), regions(spark), "left_anti").select("vid", "contig", "position")


@query(f"SELECT vid, EXISTS (SELECT 1 FROM {_REGIONS_SQL} WHERE r.contig = v.contig AND v.position >= r.s AND v.position < r.e) AS lcr FROM v_variants v")
def interval_flag(spark, d):
    return J.interval_flag(view(spark, d, "v_variants"), regions(spark), "lcr", ["vid"]).select("vid", "lcr")


@query("""SELECT vid, max(CASE WHEN t = 'hapmap' THEN true END) AS hapmap, max(CASE WHEN t = 'omni' THEN true END) AS omni, max(CASE WHEN t = 'mills' THEN true END) AS mills,
  max(CASE WHEN t = 'kgp' THEN true END) AS kgp FROM (
  SELECT vid, 'hapmap' AS t FROM v_variants WHERE hapmap UNION ALL SELECT vid, 'omni' FROM v_variants WHERE omni
  UNION ALL SELECT vid, 'mills' FROM v_variants WHERE length(ref) <> length(alt) UNION ALL SELECT vid, 'kgp' FROM v_variants WHERE QD > 20) GROUP BY vid""")
def outer_truth_flags(spark, d):
    v = view(spark, d, "v_variants")
    sets = {"hapmap": v.filter("hapmap"), "omni": v.filter("omni"), "mills": v.filter("length(ref) <> length(alt)"), "kgp": v.filter("QD > 20")}
    return J.outer_flags(sets, ["vid"])


@query("""SELECT p_partkey, min(r_regionkey) AS first_region FROM part CROSS JOIN region
  WHERE contains(p_name || ' ' || p_type || ' ' || p_brand, substr(r_name, 1, 1)) GROUP BY p_partkey""")
def substring_theta_join(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("text"))
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("first_region"), F.substring("r_name", 1, 1).alias("mark"))
    return J.first_contained(p, r, "text", "mark", "first_region").select("p_partkey", "first_region")


@query("""SELECT c_custkey AS sid, CASE WHEN c_custkey % 11 = 0 THEN 'renamed' WHEN c_custkey % 7 = 0 THEN 'part5' WHEN o.p IS NOT NULL THEN o.p ELSE c_mktsegment END AS cohort
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS p FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) o ON o_custkey = c_custkey""")
def precedence_merge(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("sid"), F.col("c_mktsegment").alias("cohort"))
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("sid"), F.col("o_orderpriority").alias("p"))
    fixed = lambda m, name: c.filter(F.col("sid") % m == 0).select("sid", F.lit(name).alias("p"))
    return J.precedence(c, [(o, "p"), (fixed(7, "part5"), "p"), (fixed(11, "renamed"), "p")], "sid", "cohort")


@query("SELECT contig, count(*) AS n, cast(sum(position) AS BIGINT) AS total FROM (SELECT * FROM v_variants WHERE vid % 2 = 0 UNION ALL SELECT * FROM v_variants WHERE vid % 3 = 0) GROUP BY contig")
def union_all(spark, d):
    v = view(spark, d, "v_variants")
    return v.filter("vid % 2 = 0").unionByName(v.filter("vid % 3 = 0")).groupBy("contig").agg(F.count("*").alias("n"), F.sum("position").alias("total"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def distinct_by_key(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return J.distinct_by_key(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("""SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS n_discount, count(*) FILTER (WHERE l_tax = 0.02) AS n_tax,
  min(l_quantity) + 0.0 AS lo, max(l_quantity) AS hi, round(avg(l_extendedprice), 6) AS mean_price FROM lineitem GROUP BY l_returnflag""")
def count_where_suite(spark, d):
    t = table(spark, d, "lineitem")
    return rounded(t.groupBy("l_returnflag").agg(F.count("*").alias("n"), A.count_where(F.col("l_discount") > 0.05).alias("n_discount"), A.count_where(F.col("l_tax") == 0.02).alias("n_tax"), (F.min("l_quantity") + 0.0).alias("lo"), F.max("l_quantity").alias("hi"), F.avg("l_extendedprice").alias("mean_price")))


@query("SELECT sid, cast(sum(CASE WHEN n_alt > 0 THEN 1 ELSE 0 END) AS BIGINT) AS by_sum, count(*) FILTER (WHERE n_alt > 0) AS by_count FROM v_sparse GROUP BY sid")
def sum_bool_vs_count(spark, d):
    p = X.is_non_ref("n_alt")
    return view(spark, d, "v_sparse").groupBy("sid").agg(F.sum(F.coalesce(p, F.lit(False)).cast("int")).alias("by_sum"), F.count_if(p).alias("by_count"))


@query("SELECT vid, round(count(*) FILTER (WHERE n_alt > 0) / cast(count(*) AS double), 6) AS share FROM v_entries GROUP BY vid")
def fraction_nulls(spark, d):
    return rounded(view(spark, d, "v_entries").groupBy("vid").agg(A.fraction(F.col("n_alt") > 0).alias("share")))


@query("""SELECT vid, round(avg(gq) FILTER (WHERE n_alt = 1), 6) AS gq_het, cast(sum(n_alt) FILTER (WHERE gq >= 20) AS BIGINT) AS ac_gq,
  count(*) FILTER (WHERE gq >= 20 AND n_alt = 2) AS hom_gq, max(dp) FILTER (WHERE n_alt IS NULL) AS dp_missing FROM v_entries GROUP BY vid""")
def filtered_agg(spark, d):
    g, het = F.col("gq") >= 20, F.col("n_alt") == 1
    return rounded(view(spark, d, "v_entries").groupBy("vid").agg(
        A.filtered(het, F.avg, F.col("gq")).alias("gq_het"), A.filtered(g, F.sum, F.col("n_alt")).cast("bigint").alias("ac_gq"), A.count_where(g & (F.col("n_alt") == 2)).alias("hom_gq"), A.filtered(F.col("n_alt").isNull(), F.max, F.col("dp")).alias("dp_missing")))


@query("""SELECT vid, contig, position, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS "AC", 2 * count(n_alt) AS "AN", round(sum(n_alt) / nullif(2.0 * count(n_alt), 0), 6) AS "AF",
  count(*) FILTER (WHERE n_alt = 2) AS n_hom FROM v_entries JOIN v_variants USING (vid) WHERE NOT (QD < 2 OR FS > 60 OR MQ < 30) GROUP BY vid, contig, position""")
def call_stats(spark, d):
    sites = view(spark, d, "v_variants").filter(~qc.hard_filter_fails()).select("vid", "contig", "position")
    e = view(spark, d, "v_entries").groupBy("vid").agg(*[v.alias(k) for k, v in A.call_stats().items()])
    return rounded(e.join(sites, "vid").select("vid", "contig", "position", "AC", "AN", "AF", "n_hom"))


@query("""SELECT vid, cohort, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS "AC", 2 * count(n_alt) AS "AN", round(sum(n_alt) / nullif(2.0 * count(n_alt), 0), 6) AS "AF",
  count(*) FILTER (WHERE n_alt = 2) AS n_hom FROM v_entries JOIN v_samples USING (sid) GROUP BY vid, cohort""")
def cohort_call_stats(spark, d):
    e = view(spark, d, "v_entries").join(view(spark, d, "v_samples").select("sid", "cohort"), "sid")
    return rounded(e.groupBy("vid", "cohort").agg(*[v.alias(k) for k, v in A.call_stats().items()]))


@query("SELECT CASE WHEN alt = '*' THEN 'Other' WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' ELSE 'INDEL' END AS class, count(*) AS n FROM v_variants GROUP BY 1")
def variant_class(spark, d):
    return view(spark, d, "v_variants").groupBy(X.variant_class("ref", "alt").alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT contig, count(*) FILTER (WHERE ti) AS n_ti, count(*) FILTER (WHERE snv AND NOT ti) AS n_tv, round(count(*) FILTER (WHERE ti) / cast(nullif(count(*) FILTER (WHERE snv AND NOT ti), 0) AS double), 6) AS ti_tv
FROM (SELECT contig, ref || alt IN ('AG', 'GA', 'CT', 'TC') AS ti, length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt AS snv FROM v_variants) GROUP BY contig""")
def ti_tv(spark, d):
    v = view(spark, d, "v_variants").groupBy("contig").agg(A.count_where(X.is_transition("ref", "alt")).alias("n_ti"), A.count_where(X.is_transversion("ref", "alt")).alias("n_tv"))
    return rounded(v.withColumn("ti_tv", F.try_divide(F.col("n_ti").cast("double"), F.col("n_tv").cast("double"))))


@query("SELECT vid, round(pow(10.0, -QD / 10), 6) AS p, round(CASE WHEN QD > 0 THEN -10 * log10(QD / 100) END, 6) AS q FROM v_variants")
def phred(spark, d):
    return view(spark, d, "v_variants").select("vid", r6(X.from_phred("QD")).alias("p"), r6(X.to_phred(F.col("QD") / 100)).alias("q"))


@query("SELECT o_custkey, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY o_custkey")
def collect_by_key_sizes(spark, d):
    c = A.collect_by_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "orders")
    return c.select("o_custkey", F.size("orders").cast("bigint").alias("n"), F.get("orders", F.lit(0))["o_orderkey"].alias("first_key"), F.element_at("orders", -1)["o_orderkey"].alias("last_key"))


@query("SELECT l_shipmode AS k, l_linestatus AS value, count(*) AS n FROM (SELECT l_returnflag AS l_shipmode, l_linestatus FROM lineitem) GROUP BY 1, 2")
def counter_map_exploded(spark, d):
    c = A.counter(table(spark, d, "lineitem"), ["l_returnflag"], "l_linestatus")
    return c.select(F.col("l_returnflag").alias("k"), F.explode("counts").alias("value", "n"))


@query("""SELECT vid, cohort, cast(least(sum(n_alt), 2 * count(n_alt) - sum(n_alt)) AS BIGINT) AS mac, 2 * count(n_alt) AS an,
  round(1 - count(n_alt) / cast(max(size) AS double), 6) AS missingness FROM v_entries JOIN v_samples USING (sid)
  JOIN (SELECT cohort, count(*) AS size FROM v_samples WHERE sid < 150 GROUP BY cohort) s USING (cohort) GROUP BY vid, cohort""")
def nested_group_cohort(spark, d):
    s = view(spark, d, "v_samples").filter("sid < 150").select("sid", "cohort")
    size = s.groupBy("cohort").agg(F.count("*").alias("size"))
    e = view(spark, d, "v_entries").join(s, "sid").groupBy("vid", "cohort").agg(*[v.alias(k) for k, v in A.call_stats().items()]).join(size, "cohort")
    mac = F.when(F.col("AN") > 0, F.least("AC", F.col("AN") - F.col("AC")))
    return rounded(e.select("vid", "cohort", mac.alias("mac"), F.col("AN").alias("an"), (1 - F.col("AN") / 2.0 / F.col("size")).alias("missingness")))


@query("""SELECT vid, count(n_alt) AS n_called, round(count(n_alt) / 150.0, 6) AS call_rate, count(*) FILTER (WHERE n_alt = 1) AS n_het, cast(coalesce(sum(n_alt), 0) AS BIGINT) AS ac,
  round(avg(gq), 6) AS gq_mean FROM v_entries GROUP BY vid""")
def row_axis_qc(spark, d):
    return rounded(qc.variant_qc(view(spark, d, "v_entries"), 150).select("vid", "n_called", "call_rate", "n_het", F.col("AC").alias("ac"), "gq_mean"))


@query("""SELECT sid, count(n_alt) AS n_called, round(1 - count(n_alt) / 200.0, 6) AS missingness, count(*) FILTER (WHERE n_alt = 1) AS n_het,
  round(count(*) FILTER (WHERE n_alt = 1) / cast(nullif(count(n_alt), 0) AS double), 6) AS het_rate,
  cast(coalesce(sum(n_alt) FILTER (WHERE length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt), 0) AS BIGINT) AS n_snp,
  cast(coalesce(sum(n_alt) FILTER (WHERE length(alt) > length(ref)), 0) AS BIGINT) AS n_insertion
FROM v_entries JOIN v_variants USING (vid) GROUP BY sid""")
def col_axis_qc(spark, d):
    q = qc.sample_qc(view(spark, d, "v_entries"), view(spark, d, "v_variants"), 200)
    return rounded(q.select("sid", "n_called", "missingness", "n_het", "het_rate", "n_snp", "n_insertion"))


@query("SELECT sid, pop, count(*) FILTER (WHERE n_alt > 0) AS n_non_ref, count(*) FILTER (WHERE n_alt = 2) AS n_hom FROM v_sparse JOIN v_samples USING (sid) GROUP BY sid, pop")
def group_cols(spark, d):
    e = view(spark, d, "v_sparse").join(view(spark, d, "v_samples").select("sid", "pop"), "sid")
    return e.groupBy("sid", "pop").agg(A.count_where(X.is_non_ref("n_alt")).alias("n_non_ref"), A.count_where(X.is_hom_var("n_alt")).alias("n_hom"))


@query("""SELECT vid, round(1 - het / nullif(2 * p * (1 - p) * n, 0), 6) AS f FROM (
  SELECT vid, cast(count(*) FILTER (WHERE n_alt = 1) AS double) AS het, cast(count(n_alt) AS double) AS n, 1 - sum(n_alt) / (2.0 * count(n_alt)) AS p FROM v_entries GROUP BY vid)""")
def inbreeding(spark, d):
    g = qc.genotype_counts(view(spark, d, "v_entries"), ["vid"])
    return rounded(g.select("vid", qc.inbreeding(F.col("n_hom_ref"), F.col("n_het"), F.col("n_hom_var")).alias("f")))


@query("""WITH m AS (SELECT c_mktsegment AS k, median(c_acctbal) AS med FROM customer GROUP BY 1)
SELECT k, round(max(med), 6) AS med, round(1.4826 * median(abs(c_acctbal - med)), 6) AS mad FROM customer JOIN m ON c_mktsegment = k GROUP BY k""")
def median_mad(spark, d):
    return rounded(A.median_mad(table(spark, d, "customer").withColumnRenamed("c_mktsegment", "k"), ["k"], "c_acctbal"))


@query("""SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 5) AS var, min(l_quantity) + 0.0 AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY l_returnflag""")
def merged_stats(spark, d):
    parts = table(spark, d, "lineitem").groupBy("l_returnflag", (F.col("l_orderkey") % 16).alias("p")).agg(*[v.alias(k) for k, v in A.stats("l_quantity").items()])
    m = A.merge_stats(parts, ["l_returnflag"])
    return m.select("l_returnflag", "n", r6("mean").alias("mean"), F.round(F.try_divide("m2", "n"), 5).alias("var"), (F.col("min") + 0.0).alias("lo"), F.col("max").alias("hi"))


@query("SELECT props_key AS kind, count(*) AS n, count(value) AS n_value FROM (SELECT event_type AS props_key, value FROM events) GROUP BY 1")
def value_counts(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), F.count("value").alias("n_value"))


@query("""WITH k AS (SELECT pos, sum(e) AS total, count(*) AS n FROM (SELECT unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY pos)
SELECT cast(pos AS BIGINT) AS pos, round(total, 4) AS total FROM k""")
def array_agg_elements(spark, d):
    t = A.element_wise_sum(table(spark, d, "embeddings").select(F.lit(1).alias("k"), F.col("embedding").cast("array<double>").alias("embedding")), ["k"], "embedding")
    return t.select(F.col("pos").cast("bigint").alias("pos"), F.round("total", 4).alias("total"))


@query("""SELECT s.stratum, s.level, count(*) AS n, cast(sum(c_custkey) AS BIGINT) AS total FROM (
  SELECT c_custkey, 'all' AS stratum, 'all' AS level FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, 'rich', 'yes' FROM customer WHERE c_acctbal > 5000) s GROUP BY s.stratum, s.level""")
def overlapping_strata(spark, d):
    c = table(spark, d, "customer")
    strata = {"all": F.lit("all"), "segment": F.col("c_mktsegment"), "rich": F.when(F.col("c_acctbal") > 5000, "yes")}
    return A.overlapping_strata(c, strata, {"n": F.count("*"), "total": F.sum("c_custkey")}, [])
