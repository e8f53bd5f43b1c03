"""Ranks, outliers and quantiles with missing strata, missing values and ties: every row comes out, right by plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import evaluation, joins, ml, qc, quantiles, windows


def test_rank_keeps_rows_without_a_stratum(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, *[x / 4 for x in range(9)]]), r.random() < 0.5) for i in range(900)]
    d = spark.createDataFrame(rows, "id long, g string, score double, flag boolean")
    for pieces in (None, 1, 9):
        got = {x["id"]: (x["rank"], x["sub"]) for x in windows.stratified_rank(d, ["g"], "score", "id", {"sub": F.col("flag")}, pieces=pieces).collect()}
        assert len(got) == len(rows)
        for g in ("a", "b", None):
            order = sorted((x for x in rows if x[1] == g), key=lambda x: (x[2] is None, x[2] or 0, x[0]))
            sub = {x[0]: i for i, x in enumerate(x for x in order if x[3])}
            assert all(got[x[0]] == (i, sub.get(x[0])) for i, x in enumerate(order))


def test_rank_by_a_text_key_and_empty_tables(spark):
    d = spark.createDataFrame([("b", None, 1), ("a", None, 1), ("c", 2.0, 1)], "id string, score double, g int")
    assert {x["id"]: x["rank"] for x in windows.stratified_rank(d, ["g"], "score", "id").collect()} == {"c": 0, "a": 1, "b": 2}
    assert windows.stratified_rank(d.limit(0), ["g"], "score", "id").count() == 0


def test_outliers_of_samples_without_a_stratum(spark):
    rows = [(i, "p" if i % 5 else None, float(i % 7), float(100 if i == 10 else i % 3)) for i in range(40)]
    out = qc.stratified_outliers(spark.createDataFrame(rows, "s long, g string, m double, k double"), "s", ["g"], ["m", "k"]).collect()
    assert len(out) == 80
    v = np.array([x[3] for x in rows if x[1] is None])
    med = np.median(v)
    mad = 1.4826 * np.median(abs(v - med))
    got = next(x for x in out if x["s"] == 10 and x["metric"] == "k")
    assert (got["med"], got["mad"]) == pytest.approx((med, mad)) and got["fails"]


def test_bins_of_sites_without_a_type(spark):
    rows = [(i, "A", "T" if i % 4 else None, i / 7, i % 3 == 0, False, 0.7, "x") for i in range(60)]
    d = spark.createDataFrame(rows, "vid long, ref string, alt string, score double, transmitted_singleton boolean, was_split boolean, p_de_novo double, consequence string")
    subsets = {"once": F.col("transmitted_singleton")}
    b = evaluation.ranked_bins(d, "score", subsets, 5)
    assert b.filter("rank_id = 'rank'").count() == 60 and b.filter("rank_id = 'once'").count() == 20
    out = evaluation.bin_evaluation(b, ["once"], what={})
    assert out.filter("rank_id = 'rank'").agg(F.sum("n")).first()[0] == 60 and out.filter("snv is null and rank_id = 'rank'").agg(F.sum("n")).first()[0] == 15


def test_quantiles_of_many_columns_together(spark):
    r = random.Random(8)
    rows = [(g, r.choice([None, r.gauss(0, 5)]), r.randint(0, 6), float("nan") if r.random() < 0.1 else r.random(), 7.0, None) for g in (1, 2, None) for _ in range(r.randint(200, 400))]
    d = spark.createDataFrame(rows, "g int, a double, b long, c double, same double, never double")
    q = [0.0, 0.25, 0.5, 0.999, 1.0]
    columns = ["a", "b", "c", "same", "never"]
    got = {(x["g"], x["column"], x["i"]): x["value"] for x in quantiles.exact_quantiles_of(d, ["g"], columns, q).collect()}
    want = {}
    for g in (1, 2, None):
        for i, c in enumerate(columns):
            v = [x[i + 1] for x in rows if x[0] == g and x[i + 1] is not None and x[i + 1] == x[i + 1]]
            want |= {(g, c, j): float(np.quantile(v, p)) for j, p in enumerate(q) if v}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert quantiles.exact_quantiles_of(d.limit(0), ["g"], columns, q).count() == 0
    many = {x["i"]: x["value"] for x in quantiles.exact_quantiles_of(d, [], ["b"], [i / 100 for i in range(1, 100)]).collect()}
    v = [x[2] for x in rows]
    assert all(many[i] == pytest.approx(np.quantile(v, (i + 1) / 100)) for i in range(99))


def test_quantiles_where_brackets_are_narrow(spark, monkeypatch):
    """With a sketch much finer than a bracket only values inside brackets are kept, and the picked ones are exact."""
    d = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("x"))
    v = np.sort(np.array([r[0] for r in d.collect()]))
    q = [0.1, 0.5, 0.9]
    got = {r["i"]: r["value"] for r in quantiles.exact_quantiles_of(d, [], ["x"], q).collect()}
    assert all(got[i] == pytest.approx(np.quantile(v, p)) for i, p in enumerate(q))


def test_medians_of_groups_fill_features(spark):
    d = spark.createDataFrame([("a", 1.0, None), ("a", None, 2.0), ("a", 5.0, 4.0), (None, None, 9.0), (None, 3.0, None), ("z", None, None)], "k string, x double, y double")
    out = ml.median_impute(d, ["x", "y"], ["k"])
    assert sorted(((r["k"], r["x"], r["y"], r["feature_imputed"]["x"]) for r in out.collect()), key=str) == sorted([("a", 1.0, 3.0, False), ("a", 3.0, 2.0, True), ("a", 5.0, 4.0, False), (None, 3.0, 9.0, True), (None, 3.0, 9.0, False), ("z", None, None, True)], key=str)


def test_regions_of_all_lengths(spark):
    """Points and regions from single positions to whole chromosomes, against every pair."""
    r = random.Random(12)
    regions = [(r.choice("xy"), a, a + n) for n in [1, 2, 100, 9_999, 10_000, 150_000, 2_000_000, 90_000_000, 0] for a in [r.randint(0, 200_000_000) for _ in range(3)]]
    points = [(i, r.choice("xyz"), p) for i, p in enumerate([x for _, a, b in regions for x in (a - 1, a, b - 1, b)] + [r.randint(0, 250_000_000) for _ in range(300)])]
    p, t = spark.createDataFrame(points, "id long, contig string, position long"), spark.createDataFrame(regions, "contig string, start long, end long")
    want = {i for i, c, x in points if any(c == k and a <= x < b for k, a, b in regions)}
    for width, most in ((10_000, 2), (7, 8)):  # the widest bins of the second are far narrower than a chromosome
        assert joins.region_bins(t, width).groupBy("__contig", "__start", "__end").count().agg(F.max("count")).first()[0] <= most
        assert sorted(x["id"] for x in joins.interval_join(p, t, "left_semi", width).collect()) == sorted(want)
        assert sorted(x["id"] for x in joins.interval_join(p, t, "left_anti", width).collect()) == sorted({i for i, _, _ in points} - want)
    assert joins.interval_join(p, t.limit(0), "left_semi").count() == 0 and joins.interval_join(p, t.limit(0), "left_anti").count() == len(points)
