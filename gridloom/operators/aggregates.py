"""Aggregates over an axis of a cohort and over plain groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(p: Column) -> Column:
    """Rows where p holds; missing counts as false."""
    return F.count_if(p)


def fraction(p: Column) -> Column:
    """Share of all rows where p holds; missing rows count below the line."""
    return F.try_divide(F.count_if(p).cast("double"), F.count("*").cast("double"))


def filtered(p: Column, agg, x: Column) -> Column:
    """agg over the rows where p holds."""
    return agg(F.when(p, x))


def call_stats(n_alt: str = "n_alt", where: Column | None = None) -> dict[str, Column]:
    """AC, AN, AF and the number of homozygotes of the alternate allele; AF is missing where nothing is called."""
    g = F.col(n_alt) if where is None else F.when(where, F.col(n_alt))
    ac, an = F.coalesce(F.sum(g), F.lit(0)).cast("long"), (2 * F.count(g)).cast("long")
    return {"AC": ac, "AN": an, "AF": F.try_divide(ac.cast("double"), an.cast("double")), "n_hom": F.count_if(g == 2).cast("long")}


def call_stats_by_allele(cells: DataFrame, sites: DataFrame) -> DataFrame:
    """(vid, AC, AF, AN, homozygote_count) of calls that are arrays of allele indices; the arrays have a place for each allele.

    sites: (vid, alts). Place 0 is the reference. Copies are counted by (site, allele) before anything is gathered, so a
    site's group has one row an allele. Sites without a call have zeros, AN 0 and missing frequencies.
    """
    each = cells.filter("alleles is not null").select("vid", F.explode(F.array_distinct("alleles")).alias("a"), F.col("alleles").alias("c"))
    copies, size = F.size(F.filter("c", lambda x: x == F.col("a"))), F.size("c")
    per = each.groupBy("vid", "a").agg(F.sum(copies).cast("long").alias("ac"), F.count_if((copies == size) & (size > 1)).alias("hom"))
    per = per.groupBy("vid").agg(F.map_from_entries(F.collect_list(F.struct("a", F.struct("ac", "hom")))).alias("m"), F.sum("ac").alias("AN"))
    d = sites.select("vid", F.size("alts").alias("n")).join(per, "vid", "left")
    of = lambda name: F.transform(F.sequence(F.lit(0), F.col("n")), lambda i: F.coalesce(F.try_element_at("m", i)[name], F.lit(0)).cast("long"))
    d = d.select("vid", of("ac").alias("AC"), F.coalesce("AN", F.lit(0)).cast("long").alias("AN"), of("hom").alias("homozygote_count"))
    return d.select("vid", "AC", F.transform("AC", lambda x: F.try_divide(x.cast("double"), F.col("AN").cast("double"))).alias("AF"), "AN", "homozygote_count")


def counter(df: DataFrame, keys: list[str], x: str, name: str = "counts") -> DataFrame:
    """Per key a map value -> count, by way of the (key, value) counts."""
    c = df.groupBy(*keys, x).agg(F.count("*").alias("__n")).filter(F.col(x).isNotNull())
    return c.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(x, "__n")))).alias(name))


def median_mad(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Median, and 1.4826 times the median absolute deviation, per key; values are counted first, so no task holds a key's rows."""
    from gridloom.operators.windows import exact_quantiles

    names = [F.col(k).alias(f"__m_{k}") for k in keys]
    same = [F.col(k).eqNullSafe(F.col(f"__m_{k}")) for k in keys]
    med = exact_quantiles(df, keys, x, [0.5]).select(*names, F.col("value").alias("med"))
    apart = df.join(med, same).withColumn("__apart", F.abs(F.col(x) - F.col("med")))
    mad = exact_quantiles(apart, keys, "__apart", [0.5]).select(*keys, (F.lit(1.4826) * F.col("value")).alias("mad"))
    return mad.join(med, same).select(*keys, "med", "mad")


def stats(x: str) -> dict[str, Column]:
    """Mergeable statistics: n, mean and m2 (sum of squared deviations) with extremes and sum."""
    c = F.col(x).cast("double")
    return {"n": F.count(c), "mean": F.avg(c), "m2": F.var_pop(c) * F.count(c), "min": F.min(c), "max": F.max(c), "sum": F.sum(c)}


def merge_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Merge rows of stats(): m2 adds up with the spread of the group means around the common one."""
    grand = F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n"))
    # sum n (mean - grand)^2 = sum n mean^2 - (sum n mean)^2 / sum n
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - F.try_divide(F.pow(F.sum(F.col("n") * F.col("mean")), F.lit(2)), F.sum("n"))
    return df.groupBy(*keys).agg(F.sum("n").alias("n"), grand.alias("mean"), (F.sum("m2") + between).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"), F.sum("sum").alias("sum"))


def histogram(df: DataFrame, x: str, lo: float, hi: float, bins: int) -> DataFrame:
    """(bin, n): bin -1 below lo, `bins` above hi; the last bin is closed."""
    c = F.col(x)
    at = F.when(c < lo, -1).when(c > hi, bins).when(c == hi, bins - 1).otherwise(F.floor((c - lo) / ((hi - lo) / bins)).cast("int"))
    return df.filter(c.isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def element_wise_sum(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """(keys, pos, total): sums of array elements by their place."""
    return df.select(*keys, F.posexplode(x).alias("pos", "e")).groupBy(*keys, "pos").agg(F.sum("e").alias("total"))


def collect_by_key(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))


def overlapping_strata(df: DataFrame, strata: dict[str, Column], aggs: dict[str, Column], keys: list[str]) -> DataFrame:
    """Aggregates over strata that overlap: each row goes to every stratum whose label is not missing, in one pass."""
    labels = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("stratum"), v.cast("string").alias("level"))) for k, v in strata.items()]))
    return df.withColumn("__s", F.explode(labels)).groupBy(*keys, F.col("__s.stratum").alias("stratum"), F.col("__s.level").alias("level")).agg(*[v.alias(k) for k, v in aggs.items()])


def all_flags(flags: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f) == 1 for f in flags])
