from __future__ import annotations

import random
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import aggregates as A
from gridloom.operators import family, joins, ml, popgen, qc, windows
from gridloom.plans.views import Cohort, view


def test_hwe_against_enumeration():
    for hom, het, var in ((10, 0, 5), (3, 7, 2), (0, 1, 9), (20, 20, 20), (1, 0, 0)):
        n, rare = hom + het + var, 2 * min(hom, var) + het
        w = {h: comb(n, h) * comb(n - h, (rare - h) // 2) * 2**h for h in range(rare % 2, rare + 1, 2) if n - h >= (rare - h) // 2}
        total = sum(w.values())
        assert qc.hwe_exact(hom, het, var) == pytest.approx(sum(v for v in w.values() if v <= w[het]) / total)


def test_merged_statistics(spark):
    r = random.Random(0)
    x = [(i % 7, r.gauss(5, 2)) for i in range(500)]
    d = spark.createDataFrame(x, "k long, x double")
    m = A.merge_stats(d.groupBy("k").agg(*[v.alias(n) for n, v in A.stats("x").items()]).withColumn("all", F.lit(1)), ["all"]).first()
    v = np.array([b for _, b in x])
    assert m["n"] == 500 and m["mean"] == pytest.approx(v.mean()) and m["m2"] / m["n"] == pytest.approx(v.var()) and m["min"] == v.min() and m["max"] == v.max()


def test_ranks_are_dense_and_exclusive(spark):
    r = random.Random(1)
    rows = [(i, r.random() < 0.5, r.choice([None, *[x / 10 for x in range(10)]]), r.random() < 0.3) for i in range(2000)]
    d = spark.createDataFrame(rows, "id long, snv boolean, score double, flag boolean")
    got = windows.stratified_rank(d, ["snv"], "score", "id", {"sub": F.col("flag")}, pieces=7).collect()
    for snv in (True, False):
        order = sorted((x for x in rows if x[1] == snv), key=lambda x: (x[2] is None, x[2] or 0, x[0]))
        want = {x[0]: i for i, x in enumerate(order)}
        sub = {x[0]: i for i, x in enumerate(x for x in order if x[3])}
        for g in got:
            if g["snv"] == snv:
                assert g["rank"] == want[g["id"]] and g["sub"] == sub.get(g["id"])


def test_quantile_bins_spread_over_merged_boundaries(spark):
    assert windows.merge_boundaries([1.0, 1.0, 2.0]) == ([1.0, 2.0], [0, 2], [1, 0])
    d = spark.createDataFrame([(0.5, 0.0), (0.5, 0.99), (1.0, 0.99), (1.5, 0.0), (9.0, 0.5), (None, 0.1)], "s double, u double")
    got = [x[0] for x in d.select(windows.quantile_bin(F.col("s"), [1.0, 1.0, 2.0], F.col("u"), 4)).collect()]
    assert got == [1, 2, 2, 3, 4, None]
    down = [x[0] for x in d.select(windows.quantile_bin(F.col("s"), [1.0, 1.0, 2.0], F.col("u"), 4, desc=True)).collect()]
    assert down == [3, 2, 2, 1, 0, None]
    rank = spark.range(4).select(windows.rank_bin(F.col("id"), F.lit(4), 2).alias("b")).collect()
    assert [x["b"] for x in rank] == [1, 1, 2, 2]
    assert spark.range(3).select(windows.rank_bin(F.col("id"), F.lit(3), 100).alias("b")).collect()[2]["b"] == 3


TRIOS = [
    # child, father, mother -> transmitted, untransmitted, de novo, Mendel code
    (1, 1, 0, 1, 0, 0, None), (0, 1, 0, 0, 1, 0, None), (2, 1, 1, 2, 0, 0, None), (1, 1, 1, 1, 1, 0, None), (1, 0, 0, 0, 0, 1, 2), (1, 2, 1, 0, 1, 0, None), (2, 2, 1, 1, 0, 0, None),
    (1, 2, 2, 0, 0, 0, 1), (2, 0, 1, 1, 0, 0, 3), (2, 1, 0, 1, 0, 0, 4), (2, 0, 0, 0, 0, 1, 5), (0, 2, 0, 0, 0, 0, 6), (0, 0, 2, 0, 0, 0, 7), (0, 2, 2, 0, 0, 0, 8), (0, 0, 0, 0, 0, 0, None),
]


def test_trio_golden(spark):
    d = spark.createDataFrame([(i, i, i, *t[:3]) for i, t in enumerate(TRIOS)], "vid long, fam_id long, proband long, child_n_alt long, father_n_alt long, mother_n_alt long")
    s = {r["vid"]: r for r in family.trio_stats(d).collect()}
    code = {r["vid"]: r["c"] for r in d.select("vid", family.mendel_code().alias("c")).collect()}
    for i, t in enumerate(TRIOS):
        assert (s[i]["n_transmitted_raw"], s[i]["n_untransmitted_raw"], s[i]["n_de_novos_raw"], code[i]) == t[3:], t


def test_incomplete_trios_are_left_out(spark):
    e = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 1, 0), (2, 2, 0)], "vid long, sid long, n_alt long")
    fam = spark.createDataFrame([(9, 3, 1, 2)], "fam_id long, proband long, father long, mother long")
    assert [tuple(r) for r in joins.trios(e, fam).select("vid", "child_n_alt", "father_n_alt", "mother_n_alt").collect()] == [(1, 2, 0, 1)]


def test_lookup_is_unique_and_left(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    right = spark.createDataFrame([(1, "b"), (1, "a")], "k long, v string")
    assert sorted(joins.lookup(left, right, ["k"]).collect(), key=str) == [(1, "a"), (1, "a"), (2, None)]


def test_interval_edges(spark):
    p = spark.createDataFrame([("c", x) for x in (9, 10, 19, 20, 10_000, 25_000)], "contig string, position long")
    r = spark.createDataFrame([("c", 10, 20), ("c", 9_999, 20_001), ("c", 10, 12)], "contig string, start long, end long")
    assert sorted(x["position"] for x in joins.interval_join(p, r, "left_semi").collect()) == [10, 19, 10_000]
    assert sorted(x["position"] for x in joins.interval_join(p, r, "left_anti", width=7).collect()) == [9, 20, 25_000]


def _entries(spark, n_sites=60, n_samples=14, seed=3):
    r = np.random.default_rng(seed)
    p = r.uniform(0.1, 0.9, n_sites)
    g = r.binomial(2, p[:, None], (n_sites, n_samples))
    return g, spark.createDataFrame([(i, j, int(g[i, j])) for i in range(n_sites) for j in range(n_samples)], "vid long, sid long, n_alt long")


def test_pca_against_numpy(spark):
    g, e = _entries(spark)
    values, scores, loadings = popgen.pca(e, 3)
    p = g.mean(1) / 2
    ok = (p > 0) & (p < 1)
    z = (g[ok] - 2 * p[ok, None]) / np.sqrt(ok.sum() * 2 * p[ok, None] * (1 - p[ok, None]))
    w = np.sort(np.linalg.eigvalsh(z.T @ z))[::-1][:3]
    assert values == pytest.approx(w.tolist())
    s = np.zeros((g.shape[1], 3))
    for r in scores.collect():
        s[r["sid"], r["pc"]] = r["score"]
    assert (s**2).sum(0) == pytest.approx(w)
    back = {(r["sid"], r["pc"]): r["score"] for r in popgen.pc_project(e, loadings).collect()}
    for (sid, pc), v in back.items():
        assert v == pytest.approx(s[sid, pc], abs=1e-8)


def test_independent_set_leaves_no_pair(spark):
    r = random.Random(2)
    pairs = {(r.randint(0, 40), r.randint(0, 40)) for _ in range(90)}
    pairs = [(a, b) for a, b in pairs if a != b]
    gone = {x["node"] for x in popgen.maximal_independent_set(spark.createDataFrame(pairs, "i long, j long")).collect()}
    assert all(a in gone or b in gone for a, b in pairs) and len(gone) < 41


def test_ld_prune(spark):
    g, _ = _entries(spark, 30, 40)
    g[5], g[7] = g[4], g[4]
    e = spark.createDataFrame([(i, j, int(g[i, j])) for i in range(30) for j in range(40)], "vid long, sid long, n_alt long")
    sites = spark.createDataFrame([(i, "chr1", 100 * i) for i in range(30)], "vid long, contig string, position long")
    kept = {r["vid"] for r in popgen.ld_prune(e, sites, 0.8, 1000).collect()}
    assert 4 in kept and 5 not in kept and 7 not in kept
    far = {r["vid"] for r in popgen.ld_prune(e, sites, 0.8, 50).collect()}
    assert 5 in far


def test_split_multi(spark):
    d = spark.createDataFrame([(1, "chr1", 10, "CA", ["C", "CAA", "*"]), (2, "chr1", 50, "A", ["T"])], "vid long, contig string, position long, ref string, alts array<string>")
    got = sorted((r["vid"], r["a_index"], r["was_split"], r["position"], r["ref"], r["alt"]) for r in popgen.split_multi(d).collect())
    assert got == [(1, 1, True, 10, "CA", "C"), (1, 2, True, 10, "C", "CA"), (1, 3, True, 10, "CA", "*"), (2, 1, False, 50, "A", "T")]
    assert popgen.split_multi(d, keep_star=False).count() == 3
    x = spark.createDataFrame([([0, 2],), ([2, 2],), (None,)], "a array<int>").select(popgen.downcode(F.col("a"), F.lit(2)).alias("n")).collect()
    assert [r["n"] for r in x] == [1, 2, None]


def test_outliers_with_zero_spread_fail(spark):
    d = spark.createDataFrame([(i, "a", 5.0 if i < 9 else 50.0) for i in range(10)], "s long, g string, m double")
    out = qc.stratified_outliers(d, "s", ["g"], ["m"])
    assert all(r["fails"] for r in out.collect())
    assert qc.failing_metrics(out, "s").filter("size(failing) = 1").count() == 10


def test_cohort_axes(spark, sf_dir):
    c = Cohort.load(spark, sf_dir)
    few = c.filter_rows("vid < 3").filter_cols("sid < 4").filter_entries("n_alt > 0")
    assert few.count() == (3, 4)
    grid = few.unfilter_entries().entries
    assert grid.count() == 12 and grid.filter("n_alt is not null").count() == few.entries.count()
    both = c.filter_rows("vid < 2").union_rows(c.filter_rows("vid = 2"))
    assert both.rows.count() == 3
    s = qc.variant_qc(view(spark, sf_dir, "v_entries"), 150)
    assert s.filter("AN <> 2 * n_called").count() == 0
    chain = qc.genotype_qc_chain(c, 150)
    assert 0 < chain.rows.count() < c.rows.count() and chain.constants["min_ac"] == 1


def test_cohort_round_trip(spark, sf_dir, tmp_path):
    c = Cohort.load(spark, sf_dir)
    c.write(str(tmp_path / "c"))
    back = Cohort.read(spark, str(tmp_path / "c"))
    assert back.count() == c.count() and back.entries.exceptAll(c.entries).count() == 0


def test_forest_and_filters(spark, tmp_path):
    r = random.Random(7)
    rows = [(i, r.random(), r.random(), r.choice(["snv", "ins"])) for i in range(600)]
    d = spark.createDataFrame(rows, "vid long, a double, b double, kind string").withColumns({"truth": F.when(F.col("a") > 0.6, True), "fails": F.col("a") < 0.4})
    lab = ml.training_labels(d, ["truth"], "fails", F.col("vid") % 10 == 0)
    assert lab.filter("truth is null and tp is not null").count() == 0
    model = ml.train_forest(ml.balanced(lab, "vid"), ["a", "b"], ["kind"], trees=20)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = ml.apply_forest(type(model).load(str(tmp_path / "m")), lab)
    assert ml.test_accuracy(out.filter("test")) > 0.95
    imp = ml.feature_importance(model)
    assert set(imp) == {"a", "b", "kind"} and imp["a"] > imp["b"]
    reg = ml.RunRegistry(spark, str(tmp_path / "runs"))
    reg.record("x", accuracy=0.5)
    reg.record("x", accuracy=0.9)
    assert reg.runs()["x"]["accuracy"] == 0.9 and reg.path("x", "model").endswith("/x/model")


def test_forest_is_dealt_to_tasks(spark, monkeypatch):
    """Sites that lie in one small file are trained on and scored by several tasks, and the forest is the same wherever they lie."""
    monkeypatch.setattr(ml, "TREE_ROWS", 1000)
    r = random.Random(8)
    rows = [(i, r.random(), "TP" if r.random() < 0.5 else "FP") for i in range(400)]
    d = spark.createDataFrame(rows, "vid long, a double, label string")
    one, many = (ml.train_forest(x, ["a"], [], trees=10, depth=3, key="vid") for x in (d.coalesce(1), d.orderBy(F.desc("a")).repartition(7)))
    shown = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]  # noqa: E731  (the first line names the object)
    assert shown(one) == shown(many)
    assert ml.dealt(d.coalesce(1), 4, "vid").rdd.getNumPartitions() == 4
    assert ml.apply_forest(one, d.coalesce(1)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert ml.apply_forest(one, d.coalesce(1)).count() == 400


def test_kolmogorov_smirnov(spark):
    r = random.Random(4)
    x = [("a", r.randint(0, 20)) for _ in range(80)] + [("b", r.randint(4, 25)) for _ in range(60)] + [("c", 1)]
    got = popgen.ks_statistic(spark.createDataFrame(x, "g string, v long"), "g", "a", "b", "v").first()[0]
    a, b = [v for g, v in x if g == "a"], [v for g, v in x if g == "b"]
    assert got == pytest.approx(max(abs(sum(u <= t for u in a) / len(a) - sum(u <= t for u in b) / len(b)) for t in range(26)))


def test_precedence_and_flags(spark):
    base = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "k long, l string")
    one, two = spark.createDataFrame([(1, "a"), (2, "a")], "k long, n string"), spark.createDataFrame([(2, "b")], "k long, n string")
    assert sorted(tuple(r) for r in joins.precedence(base, [(one, "n"), (two, "n")], "k", "l").collect()) == [(1, "a"), (2, "b"), (3, "x")]
    flags = {r["k"]: (r["p"], r["q"]) for r in joins.outer_flags({"p": one, "q": two}, ["k"]).collect()}
    assert flags == {1: (True, None), 2: (True, True)}
