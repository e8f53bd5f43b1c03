"""Exact quantiles of many columns and groups together, by narrowing value ranges.

Pass one makes a rank sketch of every column and group in one aggregation and takes from it, for every wanted quantile,
a bracket of two values whose ranks lie safely on either side. Pass two counts: values inside a bracket by value, all
others only by the gap between brackets that they fall in, with the least and greatest of a gap. Running sums over the gaps, then within one bracket, give
every value its exact rank, and the wanted one is picked. So the input is read twice whatever the number of columns,
groups and quantiles; no task holds the values of a group, only the few that share a bracket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions.expr import binary_search

#: Ranks in the sketch are off by at most 1 / ACCURACY of the rows; brackets are four times as wide.
ACCURACY = 20_000
MARGIN = 4 / ACCURACY


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _brackets(d: DataFrame, keys: list[str], columns: list[str], q: list[float]) -> DataFrame:
    """(__k0.., __b): for each column its number of values, the bracket ends in order and whether the gap below each is inside one."""
    edges = sorted({e for v in q for e in (v - MARGIN, v + MARGIN)})
    inner = [e for e in edges if 0 < e < 1]
    at = {e: i for i, e in enumerate(inner)}

    def one(c: str) -> Column:
        p = F.percentile_approx(c, inner, ACCURACY) if inner else F.array().cast("array<double>")
        return F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), p.alias("p"))

    value = lambda p, e: F.get(p, F.lit(at[e])) if e in at else F.lit(float("-inf") if e <= 0 else float("inf"))

    def finished(x: Column) -> Column:
        ends = F.array(*[F.struct(value(x["p"], v - MARGIN).alias("lo"), value(x["p"], v + MARGIN).alias("hi")) for v in q])
        bounds = F.array_sort(F.array_distinct(F.flatten(F.transform(ends, lambda e: F.array(e["lo"], e["hi"])))))
        inside = F.transform(bounds, lambda b, i: F.exists(ends, lambda e: (e["lo"] < b) & (b <= e["hi"])))
        return F.struct(x["column"].alias("column"), x["n"].alias("n"), bounds.alias("bounds"), inside.alias("inside"))

    found = d.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.array(*[one(c) for c in columns]).alias("__b"))
    found = found.withColumn("__b", F.transform(F.filter("__b", lambda x: x["n"] > 0), finished))
    return found


def exact_quantiles_of(df: DataFrame, keys: list[str], columns: list[str], q: list[float]) -> DataFrame:
    """(keys, column, i, value): exact quantiles of each column per key, interpolated between neighbours; i is the place in q.

    Missing keys are a key; missing values and NaN are left out, and a column without values in a group gives no row.
    """
    clean = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    d = df.select(*keys, *[v.alias(f"__v{i}") for i, v in enumerate(clean.values())])
    names = [f"__v{i}" for i in range(len(columns))]
    b = _brackets(d, keys, names, q)
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    d = d.join(b, _all(same)) if keys else d.crossJoin(F.broadcast(b))  # one row
    own = [f"__g{i}" for i in range(len(keys))]
    value = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*names)) if len(names) > 1 else None
    d = d.select(*[F.col(k).alias(g) for k, g in zip(keys, own)], *([value.alias("__m")] if value is not None else names), F.explode("__b").alias("__x"))
    v = F.try_element_at("__m", F.col("__x.column")) if value is not None else F.col(names[0])
    d = d.withColumn("__v", v).filter(F.col("__v").isNotNull())
    d = d.withColumn("__gap", binary_search(F.col("__x.bounds"), F.col("__v")))
    keep = F.coalesce(F.get("__x.inside", F.col("__gap")), F.lit(False)) | (F.get("__x.bounds", F.col("__gap")) == F.col("__v"))
    by = [*own, "__column"]
    c = d.groupBy(*own, F.col("__x.column").alias("__column"), "__gap", F.when(keep, F.col("__v")).alias("__value")).agg(F.count("*").alias("__c"), F.first("__x.n").alias("__n"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
    # Ranks: rows of the gaps before, then within the gap (values that were not kept come first).
    per = c.groupBy(*by, "__gap").agg(F.sum("__c").alias("__s"))
    up = W.partitionBy(*by).orderBy("__gap").rowsBetween(W.unboundedPreceding, -1)
    per = per.select(*[F.col(k).alias(f"{k}_") for k in [*by, "__gap"]], F.coalesce(F.sum("__s").over(up), F.lit(0)).alias("__before"))
    c = c.join(per, _all([F.col(k).eqNullSafe(F.col(f"{k}_")) for k in [*by, "__gap"]]))
    inside = W.partitionBy(*by, "__gap").orderBy(F.col("__value").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    c = c.withColumn("__first", F.col("__before") + F.coalesce(F.sum("__c").over(inside), F.lit(0)))
    last = F.col("__first") + F.col("__c") - 1
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(x)) * (F.col("__n") - 1)).alias("at")) for i, x in enumerate(q)])
    h = c.withColumn("__t", F.explode(F.filter(wanted, lambda t: (F.ceil(t["at"]) >= F.col("__first")) & (F.floor(t["at"]) <= last))))
    low, high = F.floor("__t.at"), F.ceil("__t.at")
    first = F.col("__first")

    def ranked(r: Column) -> Column:
        """The value of rank r if it lies here. In few rows it may be next to its bracket: the first or last of a gap."""
        beside = F.when(r == first, F.col("__least")).when(r == last, F.col("__most"))
        return F.when((r >= first) & (r <= last), F.coalesce("__value", beside, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")))

    h = h.groupBy(*by, F.col("__t.i").alias("i"), F.col("__t.at").alias("__at")).agg(F.max(ranked(low)).alias("__lo"), F.max(ranked(high)).alias("__hi"))
    real = F.element_at(F.create_map(*[F.lit(x) for pair in zip(names, columns) for x in pair]), F.col("__column"))
    return h.select(*[F.col(g).alias(k) for g, k in zip(own, keys)], real.alias("column"), "i", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (F.col("__at") - F.floor("__at"))).alias("value"))
