from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridloom.functions import expr as X


def one(spark, c, **values):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean", list: "array<string>"}
    d = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)] if v is not None else 'boolean'}" for k, v in values.items()))
    return d.select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("ref", "alt", "kind"),
    [("A", "C", "snp"), ("AT", "AC", "snp"), ("AT", "GC", "mnp"), ("A", "AT", "ins"), ("AG", "ATG", "ins"), ("AT", "A", "del"), ("A", "*", "star"), ("AT", "GCC", "complex"), ("ATG", "AG", "del")],
)
def test_allele_classes(spark, ref, alt, kind):
    got = one(spark, F.struct(X.is_snp("r", "a").alias("snp"), X.is_mnp("r", "a").alias("mnp"), X.is_insertion("r", "a").alias("ins"), X.is_deletion("r", "a").alias("del"), X.is_complex("r", "a").alias("complex"), X.is_star("a").alias("star")), r=ref, a=alt)
    assert [k for k, v in got.asDict().items() if v] == [kind]


@pytest.mark.parametrize(
    ("given", "want"),
    [((10, "CATT", "CACT"), (12, "T", "C")), ((10, "A", "C"), (10, "A", "C")), ((10, "CTT", "CT"), (10, "CT", "C")), ((10, "AAT", "AT"), (10, "AA", "A")), ((5, "GATC", "GTTC"), (6, "A", "T")), ((1, "AC", "AC"), (1, "A", "A"))],
)
def test_min_rep(spark, given, want):
    m = one(spark, X.min_rep("p", "r", "a"), p=given[0], r=given[1], a=given[2])
    assert (m["position"], m["ref"], m["alt"]) == want


def test_missing_predicate(spark):
    assert one(spark, X.if_else(F.col("p"), F.lit(1), F.lit(2)), p=None) is None
    assert one(spark, X.if_else(F.col("p"), F.lit(1), F.lit(2), missing_false=True), p=None) == 2
    assert one(spark, X.case([(F.lit(False), F.lit(1)), (F.col("p"), F.lit(2))], F.lit(3)), p=True) == 2
    assert one(spark, X.case([(F.col("p"), F.lit(1)), (F.lit(True), F.lit(2))], F.lit(3)), p=None) is None
    assert one(spark, X.case([(F.col("p"), F.lit(1)), (F.lit(True), F.lit(2))], F.lit(3), missing_false=True), p=None) == 2


def test_kleene(spark):
    assert one(spark, F.col("p") | F.lit(True), p=None) is True
    assert one(spark, F.col("p") | F.lit(False), p=None) is None
    assert one(spark, F.col("p") & F.lit(False), p=None) is False


def test_loci(spark):
    assert tuple(one(spark, X.parse_variant("v"), v="chr1:5:A:T")) == ("chr1", 5, "A", "T")
    assert tuple(one(spark, X.parse_locus("v"), v="chrX:77")) == ("chrX", 77)
    assert X.parse_interval("chr2:10-20") == ("chr2", 10, 20) and X.parse_interval("chr2")[0] == "chr2"
    assert one(spark, X.contig_rank("k"), k="chrX") == 22 and one(spark, X.contig_rank("k"), k="zzz") is None
    assert one(spark, X.is_autosome("k"), k="chrX") is False
    assert one(spark, X.in_intervals("k", "p", ["chr1:5-9"]), k="chr1", p=8) is True and one(spark, X.in_intervals("k", "p", ["chr1:5-9"]), k="chr1", p=9) is False


def test_numbers(spark):
    assert one(spark, X.to_phred("p"), p=0.001) == pytest.approx(30) and one(spark, X.from_phred("q"), q=30.0) == pytest.approx(0.001)
    assert one(spark, X.to_phred("p"), p=0.0) is None
    assert one(spark, X.not_missing_marker("s"), s=".") is None
    assert one(spark, X.binary_search(F.array(*[F.lit(v) for v in (1.0, 2.0, 2.0, 5.0)]), F.col("x")), x=2.0) == 1
    assert one(spark, X.variant_type(F.col("r"), F.col("a")), r="A", a=["T", "AT", "*"]) == "mixed"
    assert one(spark, X.variant_type(F.col("r"), F.col("a")), r="A", a=["T", "C"]) == "multi-snv"
