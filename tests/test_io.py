from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from gridloom.sources import io

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
chr1\t100\trs1\tA\tC,T\t50\tPASS\tQD=3.5;AC=1,2;DB\tGT:AD:DP:GQ\t0/1:5,6,0:11:40\t1|2:0,3,4:7:20
chr2\t5\t.\tG\tGA\t.\tLowQD;Bad\tQD=.\tGT:DP\t./.:.\t0/0:9
weird\t5\t.\tG\tA\t.\t.\t.\tGT\t0/0\t0/0
"""


def test_vcf(spark, tmp_path):
    p = tmp_path / "x.vcf.gz"
    p.write_bytes(gzip.compress(VCF.encode()))
    sites, samples, cells = io.read_vcf(spark, str(p), info={"QD": "double", "AC": "array<int>", "DB": "boolean"})
    s = {r["position"]: r for r in sites.collect()}
    assert set(s) == {100, 5} and s[100]["alts"] == ["C", "T"] and s[100]["QD"] == 3.5 and s[100]["AC"] == [1, 2] and s[100]["DB"] is True and s[5]["QD"] is None
    assert s[5]["filters"] == ["Bad", "LowQD"] and s[100]["filters"] == [] and s[5]["rsid"] is None
    assert [r["s"] for r in samples.orderBy("sid").collect()] == ["S1", "S2"]
    c = {(r["vid"], r["sid"]): r for r in cells.collect()}
    a, b = c[s[100]["vid"], 0], c[s[100]["vid"], 1]
    assert (a["alleles"], a["n_alt"], a["gq"], a["dp"], a["ad"], a["phased"]) == ([0, 1], 1, 40, 11, [5, 6, 0], False) and b["n_alt"] == 2 and b["phased"]
    assert c[s[5]["vid"], 0]["n_alt"] is None and c[s[5]["vid"], 1]["n_alt"] == 0
    io.export_vcf(sites, str(tmp_path / "out"), cells, ["S1", "S2"])
    back, _, calls = io.read_vcf(spark, str(tmp_path / "out/shards"), header=str(tmp_path / "out/header"))
    assert back.select("contig", "position", "ref", "alts").exceptAll(sites.select("contig", "position", "ref", "alts")).count() == 0 and back.count() == 2
    assert calls.filter("n_alt is not null").count() == 3


def test_vcf_export_keeps_places(spark, tmp_path):
    """Cells that were filtered away, and sites without any, leave gaps in their own places; QUAL, INFO, phase and filters stay."""
    p = tmp_path / "x.vcf"
    p.write_text(VCF.split("weird")[0])
    sites, samples, cells = io.read_vcf(spark, str(p), info={"QD": "double", "AC": "array<int>", "DB": "boolean"})
    assert {r["position"]: r["filters"] for r in sites.collect()} == {100: [], 5: ["Bad", "LowQD"]}
    io.export_vcf(sites, str(tmp_path / "o"), cells.filter("dp = 7"), samples, ["QD", "AC", "DB"])
    lines = sorted(r[0].split("\t") for r in spark.read.text(str(tmp_path / "o/shards")).collect())
    assert lines[0] == ["chr1", "100", "rs1", "A", "C,T", "50", "PASS", "QD=3.5;AC=1,2;DB", "GT:AD:DP:GQ", "./.", "1|2:0,3,4:7:20"]
    assert lines[1][5:] == [".", "Bad;LowQD", ".", "GT:AD:DP:GQ", "./.", "./."]
    assert spark.read.text(str(tmp_path / "o/header")).collect()[1][0].split("\t")[8:] == ["FORMAT", "S1", "S2"]


def test_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("s\tlocus\tv\nx\tchr1:7\t3\ny\tchr2:9\t.\n")
    t = {r["s"]: r for r in io.read_table(spark, str(tmp_path / "a.tsv"), types={"locus": "locus", "v": "int"}).collect()}
    assert t["x"]["locus"]["position"] == 7 and t["x"]["v"] == 3 and t["y"]["v"] is None
    (tmp_path / "b.tsv").write_text("1\ta\n2\tb\n")
    assert io.read_table(spark, str(tmp_path / "b.tsv"), header=False, impute=True, min_partitions=3).columns == ["f0", "f1"]
    (tmp_path / "m.tsv").write_text("site\tS1\tS2\nv1\t0\t1\n")
    assert io.read_matrix_text(spark, str(tmp_path / "m.tsv"), "site").count() == 2


def test_regions_and_pedigrees(spark, tmp_path):
    (tmp_path / "r.bed").write_text("track x\nchr1\t0\t10\tbait\nchr2\t5\t6\n")
    assert sorted((r["contig"], r["start"], r["end"]) for r in io.read_bed(spark, str(tmp_path / "r.bed")).collect()) == [("chr1", 1, 11), ("chr2", 6, 7)]
    (tmp_path / "i.txt").write_text("@HD\nchr1:5-9\nchr2\t3\t4\t+\tx\n")
    assert sorted((r["contig"], r["start"], r["end"]) for r in io.read_intervals(spark, str(tmp_path / "i.txt")).collect()) == [("chr1", 5, 9), ("chr2", 3, 5)]
    (tmp_path / "p.fam").write_text("f1\tc\td\tm\t2\t0\nf1\td\t0\t0\t1\t0\n")
    f = {r["proband"]: r for r in io.read_fam(spark, str(tmp_path / "p.fam")).collect()}
    assert f["c"]["is_female"] and f["d"]["father"] is None and f["d"]["is_female"] is False


def test_json_flatten_export(spark, tmp_path):
    (tmp_path / "j.json").write_text('{"input": "chr1\\t7\\t.\\tA\\tT", "worst": "stop", "n": {"a": 1, "b": {"c": 2}}}\n')
    j = io.read_json_annotations(spark, str(tmp_path / "j.json"), "input string, worst string, n struct<a:int,b:struct<c:int>>")
    r = j.first()
    assert (r["contig"], r["position"], r["ref"], r["alt"], r["worst"]) == ("chr1", 7, "A", "T", "stop")
    assert io.flatten(j).columns[-2:] == ["n.a", "n.b.c"]
    io.export_table(j.withColumn("l", F.array(F.lit(1), F.lit(2))), str(tmp_path / "out"))
    back = io.read_table(spark, str(tmp_path / "out")).first()
    assert back["n.b.c"] == "2" and back["l"] == "[1,2]"
    assert io.exists(spark, str(tmp_path / "j.json")) and not io.exists(spark, str(tmp_path / "nope")) and len(io.list_files(spark, str(tmp_path), ".json")) == 1


def test_partitioned_and_plink(spark, sf_dir, tmp_path):
    from gridloom.plans.views import view

    v = view(spark, sf_dir, "v_variants").filter("vid < 20")
    io.export_by_contig(v, str(tmp_path / "by"))
    assert spark.read.parquet(str(tmp_path / "by")).filter("contig = 'chr3'").count() == 1
    s = view(spark, sf_dir, "v_samples").filter("sid < 3")
    io.export_plink_text(v, s, view(spark, sf_dir, "v_entries").filter("sid < 3"), str(tmp_path / "pl"))
    line = spark.read.text(str(tmp_path / "pl/tped")).first()[0].split(" ")
    assert len(line) == 4 + 2 * 3
