"""Round trips through text files, filters by regions, alleles and scores, calls with phase, and the classifier's chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import expr as X
from gridloom.operators import aggregates, qc, scores, workflows
from gridloom.plans.registry import query, r6, rounded
from gridloom.plans.views import view
from gridloom.session import shared_folder
from gridloom.sources import bgzip, io

_SNV = "(length(ref) = 1 AND length(alt) = 1 AND alt <> '*' AND ref <> alt)"


def _sites(spark, d):
    none = F.array().cast("array<string>")
    return view(spark, d, "v_variants").select("vid", "contig", "position", F.col("vid").cast("string").alias("rsid"), "ref", F.array("alt").alias("alts"), none.alias("filters"), "QD", "hapmap")


@query("SELECT contig, position, vid, ref, alt, round(QD, 6) AS qd, hapmap FROM v_variants")
def sites_only_round_trip(spark, d):
    """Sites without samples as block-gzip VCF shards, read back by blocks."""
    path = shared_folder(spark, "sites")
    io.export_vcf(_sites(spark, d), path, info=["QD", "hapmap"], bgzip_shards=True)
    back, _, _ = io.read_vcf(spark, f"{path}/shards", header=f"{path}/header", info={"QD": "double", "hapmap": "boolean"})
    return rounded(back.select("contig", "position", F.col("rsid").cast("bigint").alias("vid"), "ref", F.get("alts", F.lit(0)).alias("alt"), F.col("QD").alias("qd"), F.coalesce("hapmap", F.lit(False)).alias("hapmap")))


@query("SELECT contig AS chromosome, count(*) AS n, sum(position) AS positions FROM v_variants WHERE contig <> 'chrY' GROUP BY contig")
def chromosome_files(spark, d):
    """A folder of lines for each chromosome; the chromosome comes from the names of the files, lines of unknown contigs are skipped."""
    path = shared_folder(spark, "chromosomes")
    lines = io.vcf_lines(_sites(spark, d)).select(F.split("line", "\t")[0].alias("file"), F.col("line").alias("value"))
    bad = F.when(F.col("file") == "chrY", F.regexp_replace("value", "^chrY", "decoy")).otherwise(F.col("value"))
    lines.withColumn("value", bad).repartition("file").write.partitionBy("file").text(path)
    head = spark.createDataFrame([("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",)], "value string")
    head.write.text(f"{path}-head")
    sites, _, _ = io.read_vcf(spark, [p for p in io.list_files(spark, path) if "file=" in p], header=f"{path}-head")
    return io.with_chromosome(sites).groupBy("chromosome").agg(F.count("*").alias("n"), F.sum("position").alias("positions"))


@query("SELECT vid, sid, cast(n_alt AS BIGINT) AS n_alt FROM v_entries WHERE sid < 6")
def matrix_text_round_trip(spark, d):
    """A delimited matrix, a column a sample, written as text and read back as cells."""
    path = shared_folder(spark, "matrix")
    wide = view(spark, d, "v_entries").filter("sid < 6").groupBy("vid").pivot("sid").agg(F.first("n_alt"))
    io.export_table(wide, path)
    m = io.read_matrix_text(spark, path, "vid", "n_alt")
    return m.select(F.col("vid").cast("bigint").alias("vid"), F.col("col").cast("bigint").alias("sid"), F.col("n_alt").cast("bigint").alias("n_alt"))


@query("SELECT vid AS f0, contig AS f1, position AS f2, round(QD, 6) AS f3 FROM v_variants")
def headless_round_trip(spark, d):
    """Text without a header, types found by looking, spread over partitions."""
    path = shared_folder(spark, "headless")
    io.export_table(view(spark, d, "v_variants").select("vid", "contig", "position", "QD"), path, header=False)
    t = io.read_table(spark, path, header=False, impute=True, min_partitions=6)
    return rounded(t.select(F.col("f0").cast("bigint").alias("f0"), "f1", F.col("f2").cast("bigint").alias("f2"), F.col("f3").cast("double").alias("f3")))


@query("SELECT contig, position, ref, alt, CASE WHEN vid % 3 = 0 THEN 'stop' ELSE 'mild' END AS worst, vid % 7 AS depth FROM v_variants")
def json_round_trip(spark, d):
    """One JSON document a line, keyed by the VCF text inside, read with a declared schema."""
    path = shared_folder(spark, "json")
    v = view(spark, d, "v_variants")
    text = F.concat_ws("\t", "contig", F.col("position").cast("string"), F.lit("."), "ref", "alt")
    v.select(F.to_json(F.struct(text.alias("input"), F.when(F.col("vid") % 3 == 0, "stop").otherwise("mild").alias("worst"), F.struct((F.col("vid") % 7).alias("depth")).alias("more"))).alias("value")).write.text(path)
    j = io.read_json_annotations(spark, path, "input string, worst string, more struct<depth:bigint>")
    return j.select("contig", "position", "ref", "alt", "worst", F.col("more.depth").alias("depth"))


@query("SELECT contig, position AS start, position + 5 AS stop FROM v_variants")
def interval_list_round_trip(spark, d):
    """Interval lists in both notations: contig:start-end, end left out, and columns, end included."""
    v, path = view(spark, d, "v_variants"), shared_folder(spark, "intervals")
    s = lambda c: F.col(c).cast("string")
    colon = v.filter("vid % 2 = 0").select(F.concat("contig", F.lit(":"), s("position"), F.lit("-"), (F.col("position") + 5).cast("string")).alias("value"))
    columns = v.filter("vid % 2 = 1").select(F.concat_ws("\t", "contig", s("position"), (F.col("position") + 4).cast("string"), F.lit("+"), F.lit("t")).alias("value"))
    bgzip.write_lines(colon.unionByName(columns), path)
    return io.read_intervals(spark, path).select("contig", "start", F.col("end").alias("stop"))


@query("SELECT fam_id, proband, nullif(father, 0) AS father, mother, is_female FROM v_fam UNION ALL SELECT fam_id, father, NULL, NULL, false FROM v_fam")
def pedigree_round_trip(spark, d):
    """Trios and their fathers as pedigree text."""
    path, f = shared_folder(spark, "fam"), view(spark, d, "v_fam")
    s = lambda c: F.col(c).cast("string")
    child = f.select(F.concat_ws("\t", s("fam_id"), s("proband"), s("father"), s("mother"), F.when(F.col("is_female"), "2").otherwise("1"), F.lit("0")).alias("value"))
    child.unionByName(f.select(F.concat_ws("\t", s("fam_id"), s("father"), F.lit("0"), F.lit("0"), F.lit("1"), F.lit("0")).alias("value"))).write.text(path)
    p = io.read_fam(spark, path)
    return p.select(*[F.col(c).cast("bigint").alias(c) for c in ("fam_id", "proband", "father", "mother")], "is_female")


@query("SELECT contig, count(*) AS n, min(position) AS first FROM v_variants WHERE contig IN ('chr1', 'chrX') GROUP BY contig")
def contig_split_round_trip(spark, d):
    """A write with a folder for each contig; a filter on the contig reads its folder only."""
    path = shared_folder(spark, "by_contig")
    io.export_by_contig(view(spark, d, "v_variants").select("vid", "contig", "position"), path)
    return spark.read.parquet(path).filter(F.col("contig").isin("chr1", "chrX")).groupBy("contig").agg(F.count("*").alias("n"), F.min("position").alias("first"))


@query(f"SELECT vid, CASE WHEN {_SNV} THEN QD >= 12 WHEN alt <> '*' AND length(ref) <> length(alt) THEN QD >= 8 ELSE false END AS pass FROM v_variants")
def score_cut_by_type(spark, d):
    v = view(spark, d, "v_variants")
    return v.select("vid", scores.vqsr_pass(12.0, 8.0, "QD").alias("pass"))


@query("""WITH r AS (SELECT contig, position - 500 AS a, position + 200 AS b FROM v_variants WHERE vid % 41 = 0), k AS (SELECT contig, min(position) AS a, max(position) - 1000 AS b FROM v_variants GROUP BY contig)
SELECT vid FROM v_variants v WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.contig = v.contig AND v.position >= a AND v.position < b) AND EXISTS (SELECT 1 FROM k WHERE k.contig = v.contig AND v.position >= a AND v.position < b)""")
def outside_low_confidence(spark, d):
    v = view(spark, d, "v_variants")
    drop = v.filter("vid % 41 = 0").select("contig", (F.col("position") - 500).alias("start"), (F.col("position") + 200).alias("end"))
    keep = v.groupBy("contig").agg(F.min("position").alias("start"), (F.max("position") - 1000).alias("end"))
    return scores.filter_low_confidence(v, [drop], keep).select("vid")


@query("""SELECT vid, list_filter([alt, 'G', '*'], lambda a: a <> '*' AND a <> ref) AS alts, list_filter([1, 2, 3], lambda i: [alt, 'G', '*'][i] <> '*' AND [alt, 'G', '*'][i] <> ref) AS kept FROM v_variants
WHERE len(list_filter([alt, 'G', '*'], lambda a: a <> '*' AND a <> ref)) > 0""".replace("list_filter([1, 2, 3]", "list_transform(list_filter([1, 2, 3]").replace("<> ref) AS kept", "<> ref), lambda x: cast(x AS INTEGER)) AS kept"))
def kept_alleles(spark, d):
    v = view(spark, d, "v_variants").select("vid", "ref", F.array("alt", F.lit("G"), F.lit("*")).alias("alts"))
    return scores.filter_alleles(v, lambda a: (a != "*") & (a != F.col("ref"))).select("vid", "alts", F.col("kept_index").alias("kept"))


@query(f"SELECT vid, coalesce(vid % 10 / 100.0 > 0.001, false) AND (vid % 50 / 50.0) > 0.2 AND QD >= 2 AND FS <= 60 AND MQ >= 30 AND {_SNV} AND NOT was_split AS keep FROM v_variants")
def configurable_filter(spark, d):
    v = view(spark, d, "v_variants").withColumns({"AF": F.col("vid") % 10 / 100.0, "call_rate": F.col("vid") % 50 / 50.0, "is_snv": X.is_snp("ref", "alt"), "biallelic": ~F.col("was_split")})
    return v.select("vid", qc.site_filter({"inbreeding": None, "p_hwe": None, "call_rate": 0.2}).alias("keep"))


@query("""WITH c AS (SELECT vid, sid, n_alt, CASE WHEN n_alt = 1 AND sid % 2 = 0 THEN '1|0' WHEN n_alt = 1 AND sid % 3 = 0 THEN '1/0' WHEN n_alt = 1 THEN '0/1' WHEN n_alt = 2 THEN '1|1' WHEN n_alt = 0 THEN '0/0' ELSE './1' END AS gt FROM v_entries)
SELECT vid, count(*) FILTER (WHERE gt = '1|0') AS phased_literal, count(*) FILTER (WHERE gt IN ('0/1', '1/0')) AS unphased_literal, count(*) FILTER (WHERE n_alt = 1) AS het_ref,
  count(*) FILTER (WHERE n_alt IS NOT NULL) AS rebuilt, count(*) FILTER (WHERE gt LIKE '%|%') AS phased FROM c GROUP BY vid""")
def phased_calls(spark, d):
    """Calls from text, compared with literals, without their phase, and built again from the number of copies."""
    g, s = F.col("n_alt"), F.col("sid")
    text = F.when((g == 1) & (s % 2 == 0), "1|0").when((g == 1) & (s % 3 == 0), "1/0").when(g == 1, "0/1").when(g == 2, "1|1").when(g == 0, "0/0").otherwise("./1")
    c = view(spark, d, "v_entries").select("vid", "n_alt", X.parse_call(text).alias("c")).select("vid", "n_alt", "c.*")
    same = X.unphased("alleles") == X.call_of("n_alt")
    return c.groupBy("vid").agg(
        F.count_if(X.same_call("alleles", "phased", "1|0")).alias("phased_literal"), F.count_if(X.same_call("alleles", "phased", "1/0")).alias("unphased_literal"),
        F.count_if(X.is_het_ref("alleles")).alias("het_ref"), F.count_if(same).alias("rebuilt"), F.count_if("phased").alias("phased"),
    )


@query("""WITH c AS (SELECT vid, CASE WHEN n_alt = 0 THEN [0, 0] WHEN n_alt = 1 THEN [0, 1 + sid % 2] WHEN n_alt = 2 THEN [1 + sid % 2, 2] END AS al FROM v_entries),
a AS (SELECT vid, i, coalesce(sum(len(list_filter(al, lambda x: x = i))), 0) AS ac, count(*) FILTER (WHERE al[1] = i AND al[2] = i) AS hom FROM c, (SELECT unnest([0, 1, 2]) AS i) GROUP BY vid, i),
l AS (SELECT vid, list(cast(ac AS BIGINT) ORDER BY i) AS "AC", cast(sum(ac) AS BIGINT) AS "AN", list(hom ORDER BY i) AS homozygote_count FROM a GROUP BY vid)
SELECT vid, array_to_string("AC", ',') AS "AC", array_to_string(list_transform("AC", lambda x: cast(round(1e6 * x / "AN") AS BIGINT)), ',') AS af_millionths, "AN", array_to_string(homozygote_count, ',') AS homozygote_count FROM l""")
def allele_call_stats(spark, d):
    g, odd = F.col("n_alt"), (1 + F.col("sid") % 2).cast("int")
    call = F.when(g == 0, F.array(F.lit(0), F.lit(0))).when(g == 1, F.array(F.lit(0), odd)).when(g == 2, F.array(odd, F.lit(2)))
    e = view(spark, d, "v_entries")
    s = aggregates.call_stats_by_allele(e.select("vid", call.alias("alleles")), e.select("vid").distinct().withColumn("alts", F.array(F.lit("C"), F.lit("G"))))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return s.select("vid", text("AC").alias("AC"), text(F.transform("AF", lambda x: F.round(1e6 * x).cast("bigint"))).alias("af_millionths"), "AN", text("homozygote_count").alias("homozygote_count"))


def _inputs(spark, d):
    v, vid = view(spark, d, "v_variants"), F.col("vid")
    some = lambda k, x: F.when(vid % k != 0, x)
    sites = v.select("vid", "ref", "alt", "was_split", F.lit(1).cast("long").alias("a_index"), "MQ", "QD", "FS", some(8, (vid % 19).cast("double")).alias("MQRankSum"), some(9, (vid % 23).cast("double")).alias("SOR"), (vid % 17).cast("double").alias("ReadPosRankSum"))
    whole = v.select("vid", "ref", F.when(vid % 3 == 0, F.array(F.concat("ref", F.lit("A")), "alt")).otherwise(F.array("alt")).alias("alts"))
    truth = v.select("vid", "hapmap", "omni", (vid % 7 == 0).alias("mills"), (vid % 11 == 0).alias("kgp_phase1_hc"))
    return workflows.classifier_inputs(sites, whole, view(spark, d, "v_entries"), view(spark, d, "v_fam"), truth)


@query(f"""WITH g AS (SELECT vid, count(*) FILTER (WHERE n_alt = 1) AS het, count(n_alt) AS n, coalesce(sum(n_alt), 0) AS ac FROM v_entries GROUP BY vid),
f AS (SELECT vid, ac, 1 - het / nullif(2 * (1 - ac / (2.0 * n)) * (ac / (2.0 * n)) * n, 0) AS f FROM g),
r AS (SELECT vid, proband, max(n_alt) FILTER (WHERE role = 'c') AS c, max(n_alt) FILTER (WHERE role = 'f') AS p, max(n_alt) FILTER (WHERE role = 'm') AS m FROM v_entries
  JOIN (SELECT proband, proband AS sid, 'c' AS role FROM v_fam UNION ALL SELECT proband, father, 'f' FROM v_fam UNION ALL SELECT proband, mother, 'm' FROM v_fam) USING (sid) GROUP BY vid, proband HAVING count(DISTINCT role) = 3),
t AS (SELECT vid, sum(least(greatest(c - (CASE WHEN p = 2 THEN 1 ELSE 0 END) - (CASE WHEN m = 2 THEN 1 ELSE 0 END), 0), (CASE WHEN p = 1 THEN 1 ELSE 0 END) + (CASE WHEN m = 1 THEN 1 ELSE 0 END))) AS tr
  FROM r WHERE c IS NOT NULL AND p IS NOT NULL AND m IS NOT NULL GROUP BY vid),
k AS (SELECT v.*, f.f, f.ac AS raw, t.tr, CASE WHEN vid % 3 = 0 AND {_SNV} THEN 'mixed' WHEN vid % 3 = 0 AND alt <> '*' THEN 'multi-indel' WHEN vid % 3 = 0 THEN 'indel' WHEN {_SNV} THEN 'snv' WHEN alt <> '*' THEN 'indel' END AS variant_type
  FROM v_variants v LEFT JOIN f USING (vid) LEFT JOIN t USING (vid)),
m AS (SELECT variant_type AS vt, median(f) AS f FROM k GROUP BY variant_type)
SELECT vid, variant_type, round(coalesce(k.f, m.f), 6) AS "InbreedingCoeff", f IS NULL AS imputed, cast(raw AS BIGINT) AS ac_raw, tr = 1 AND raw = 2 AS transmitted_singleton FROM
  (SELECT k.*, m.f AS mf FROM k JOIN m ON k.variant_type IS NOT DISTINCT FROM m.vt) k JOIN (SELECT vt, f FROM m) m ON k.variant_type IS NOT DISTINCT FROM m.vt""".replace("f IS NULL AS imputed", "k.f IS NULL AS imputed"))
def classifier_inputs(spark, d):
    """What trios, genotype counts and allele counts give the classifier, from the cells."""
    out = _inputs(spark, d)
    return rounded(out.select("vid", "variant_type", "InbreedingCoeff", F.col("feature_imputed.InbreedingCoeff").alias("imputed"), "ac_raw", "transmitted_singleton"))


@query()
def classified_sites(spark, d):
    """Cells to filters: trio statistics, features, 500 trees on ten features with chr20 held out, rank bins, filters."""
    f = _inputs(spark, d).join(view(spark, d, "v_variants").select("vid", "contig", "position"), "vid")
    f = f.withColumns({"inbreeding": F.col("InbreedingCoeff"), "ac_adj": F.col("ac_raw"), "af_raw": F.col("ac_raw") / 300.0})
    out, _ = workflows.classified_sites(f, X.in_intervals("contig", "position", ["chr20"]))
    return out.select("vid", "label", "train", "predicted", r6("rf_probability").alias("rf_probability"), "bin", F.array_join("filters", ",").alias("filters"))


