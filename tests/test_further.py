"""Quantiles, containment joins, precedence, final filters and cohorts on small tables, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import aggregates, family, joins, ml, popgen, windows
from gridloom.plans.views import Cohort


def test_exact_quantiles(spark):
    r = random.Random(2)
    data = [(k, float(r.choice([1, 2, 2, 5, 8, 13]) if k == "ties" else r.gauss(0, 9))) for k in ("ties", "wide", None) for _ in range(301)] + [("one", 4.0), ("none", None)]
    d = spark.createDataFrame(data, "k string, x double")
    q = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(x["k"], x["i"]): x["value"] for x in windows.exact_quantiles(d, ["k"], "x", q).collect()}
    for k in ("ties", "wide", None, "one"):
        for i, v in enumerate(np.quantile([x for kk, x in data if kk == k], q)):
            assert got[k, i] == pytest.approx(v)
    assert not any(k == "none" for k, _ in got)
    mad = {x["k"]: (x["med"], x["mad"]) for x in aggregates.median_mad(d, ["k"], "x").collect()}
    v = np.array([x for k, x in data if k == "wide"])
    assert mad["wide"] == pytest.approx((np.median(v), 1.4826 * np.median(abs(v - np.median(v)))))


def test_first_contained(spark):
    r = random.Random(5)
    texts = [("".join(r.choice("abc") for _ in range(r.randint(0, 14))),) for _ in range(60)] + [(None,)]
    parts = list(dict.fromkeys((i, "".join(r.choice("abc") for _ in range(r.randint(2, 5)))) for i in range(25)))
    left, right = spark.createDataFrame(texts, "t string"), spark.createDataFrame(parts, "o int, p string")
    got = {x["t"]: x["o"] for x in joins.first_contained(left.distinct(), right, "t", "p", "o").collect()}
    assert got == {t: min(o for o, p in parts if p in t) for (t,) in texts if t is not None and any(p in t for _, p in parts)}
    both = right.unionByName(spark.createDataFrame([(7, "")], "o int, p string"))
    assert joins.first_contained(left.filter("t = ''"), both, "t", "p", "o").first()["o"] == 7


def test_precedence_keeps_final_labels(spark):
    base = spark.createDataFrame([(1, "x"), (2, "PROGRAM x"), (3, None)], "k int, label string")
    out = joins.precedence(base, [(spark.createDataFrame([(1, "y"), (2, "y"), (3, "y")], "k int, n string"), "n")], "k", "label", unless="program")
    assert {x["k"]: x["label"] for x in out.collect()} == {1: "y", 2: "PROGRAM x", 3: "y"}


def test_final_filters(spark):
    rows = [(1, True, 0.1, -0.5, 0, 0.0, 1, 3.0, True), (2, False, 0.9, None, 4, 0.5, 8, 2.0, False)]
    d = spark.createDataFrame(rows, "vid int, is_snv boolean, rf_probability double, inbreeding double, ac_adj int, af_raw double, ac_raw int, QD double, imp boolean")
    d = d.withColumn("feature_imputed", F.struct(F.col("imp").alias("QD")))
    out = {x["vid"]: x for x in ml.final_filters(d, 0.5, 0.5, imputed={"QD": "QD"}).collect()}
    assert out[1]["filters"] == ["AC0", "InbreedingCoeff", "MonoAllelic", "RF"] and out[2]["filters"] == []
    assert (out[1]["QD"], out[2]["QD"]) == (None, 2.0) and (out[1]["singleton"], out[2]["singleton"]) == (True, False)
    with pytest.raises(Exception, match="no probability"):
        ml.final_filters(d.withColumn("rf_probability", F.lit(None).cast("double")), 0.5, 0.5).collect()


def test_cohort_keeps_constants(spark, sf_dir, tmp_path):
    c = Cohort.load(spark, sf_dir).filter_rows("vid < 3").annotate_constants(r2=0.1, names=["a"])
    c.write(str(tmp_path / "c"))
    assert Cohort.read(spark, str(tmp_path / "c")).constants == {"r2": 0.1, "names": ["a"]}


def test_independent_set_keeps(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "i int, j int")
    drop = {x["node"] for x in popgen.maximal_independent_set(pairs).collect()}
    keep = {x["node"] for x in popgen.maximal_independent_set(pairs, keep=True).collect()}
    assert drop | keep == {1, 2, 3, 5, 6} and not drop & keep and 2 in drop
    assert not any(i in keep and j in keep for i, j in [(1, 2), (2, 3), (5, 6)])


def test_singleton_totals(spark):
    trio = spark.createDataFrame([(1, 1, 1, 0), (2, 0, 1, 0), (3, 1, 0, 1), (4, 1, 1, 1)], "vid int, child_n_alt int, father_n_alt int, mother_n_alt int")
    ac = spark.createDataFrame([(1, 2), (2, 1), (3, 2), (4, 9)], "vid int, AC int")
    r = family.singleton_totals(trio, ac).first()
    assert (r["n_sites"], r["n_transmitted"], r["n_untransmitted"], r["ratio"]) == (3, 2, 1, 2.0)
    r = family.singleton_totals(trio, ac, spark.createDataFrame([(1,), (4,)], "vid int")).first()
    assert (r["n_sites"], r["n_transmitted"], r["n_untransmitted"], r["ratio"]) == (1, 1, 0, None)
