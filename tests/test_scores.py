from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.operators import scores
from gridloom.plans.views import view


def _sites(spark, sf_dir):
    counts = scores.site_counts(view(spark, sf_dir, "v_entries"))
    return view(spark, sf_dir, "v_variants").drop("AC").join(counts, "vid").withColumn("p", F.col("QD") / 30)


@pytest.mark.parametrize("source", sorted(scores.ORIENT))
def test_ranks_match_subsets(spark, sf_dir, source):
    r = scores.ranked_scores(_sites(spark, sf_dir), source, "p")
    bad = scores.rank_sanity(r, scores.default_subsets()).filter("in_subset <> has_rank")
    assert bad.count() == 0 and r.count() > 0
    first = r.filter("rank = 0 and snv").first()
    want = r.filter("snv").agg(F.min("score")).first()[0]
    assert first["score"] == want


def test_multiallelic_scores(spark):
    raw = spark.createDataFrame([("chr1", 10, "CA", "C,CAA,*", "0.5")], "Contig string, Pos long, Ref string, Alt string, s string")
    assert sorted(tuple(r) for r in scores.read_multiallelic_scores(raw, "s").collect()) == [("chr1", 10, "C", "CA", 0.5), ("chr1", 10, "CA", "*", 0.5), ("chr1", 10, "CA", "C", 0.5)]


def test_cached(spark, tmp_path):
    calls = []
    build = lambda: calls.append(1) or spark.range(3).toDF("x")
    for _ in range(2):
        assert scores.cached(spark, str(tmp_path / "t"), build).count() == 3
    assert len(calls) == 1


def test_filters(spark):
    d = spark.createDataFrame([(1, "c", 5, ["A", "*"]), (2, "c", 50, ["*"])], "vid long, contig string, position long, alts array<string>")
    f = scores.filter_alleles(d, lambda a: a != "*").collect()
    assert [(r["vid"], r["alts"], r["kept_index"]) for r in f] == [(1, ["A"], [1])]
    lcr = spark.createDataFrame([("c", 1, 10)], "contig string, start long, end long")
    every = spark.createDataFrame([("c", 1, 100)], "contig string, start long, end long")
    assert [r["vid"] for r in scores.filter_low_confidence(d, [lcr], every).collect()] == [2]
    v = spark.createDataFrame([("A", "T", 2.0), ("A", "AT", 2.0), ("A", "*", 9.0)], "ref string, alt string, score double")
    assert [r["x"] for r in v.select(scores.vqsr_pass(1.0, 3.0).alias("x")).collect()] == [True, False, False]
    b = spark.createDataFrame([(1, 2, 4), (2, 1, 0)], "bin long, ti long, tv long")
    assert [(r["ratio"], r["cumulative_ratio"]) for r in scores.ratio_per_bin(b, [], "bin", "ti", "tv").orderBy("bin").collect()] == [(0.5, 0.5), (None, 0.75)]
