"""Ranks, bins and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.functions.expr import binary_search
from gridloom.operators.quantiles import exact_quantiles_of


#: About so many rows are numbered in one task.
PIECE = 100_000
FINEST = 1024


def _piece(df: DataFrame, x: Column, pieces: int | None = None) -> Column:
    """Number of the piece between quantiles of x that a row falls in; so many pieces that one holds about PIECE rows."""
    q = [i / FINEST for i in range(1, FINEST)]
    found = df.agg(F.count("*").alias("n"), F.percentile_approx(x, q, 10_000).alias("cuts")).first()
    pieces = min(FINEST, pieces or -(-found["n"] // PIECE))
    cuts = [found["cuts"][round(i * FINEST / pieces) - 1] for i in range(1, pieces)] if found["cuts"] else []
    return binary_search(F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]).cast("array<double>"), x)


def stratified_rank(df: DataFrame, strata: list[str], score: str, key: str, subsets: dict[str, Column] | None = None, pieces: int | None = None) -> DataFrame:
    """Adds rank, 0-based within strata in order of (score, key), and for each subset its own rank, missing outside it.

    No task sorts a whole stratum: rows fall into pieces between quantiles of the score, which are a function of the
    row; counts per (stratum, piece) are summed up, and rows are ranked within their piece. Missing scores come last, in
    pieces between quantiles of the key where it is a number. Rows whose stratum is missing are a stratum.
    """
    subsets = subsets or {}
    x = F.col(score).cast("double")
    piece = F.when(x.isNotNull(), _piece(df, x, pieces))
    if dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        late = F.when(x.isNull(), F.col(key).cast("double"))
        piece = F.coalesce(piece, FINEST + 1 + _piece(df.filter(x.isNull()), late, pieces))
    piece = F.coalesce(piece, F.lit(2 * FINEST + 2))
    flags = {f"__f_{n}": F.coalesce(p, F.lit(False)) for n, p in subsets.items()}
    d = df.withColumns({"__piece": piece, **flags})
    totals = [F.count("*").alias("__n"), *[F.count_if(f).alias(f"__n{f}") for f in flags]]
    counts = d.groupBy(*strata, "__piece").agg(*totals)
    up = W.partitionBy(*strata).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    names = ["__n", *[f"__n{f}" for f in flags]]
    at = [*strata, "__piece"]
    base = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(at)], *[F.coalesce(F.sum(n).over(up), F.lit(0)).alias(f"__b{n}") for n in names])
    inside = W.partitionBy(*at).orderBy(F.col(score).asc_nulls_last(), F.col(key))
    run = inside.rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumns({"__r": F.row_number().over(inside) - 1, **{f"__r{f}": F.sum(F.col(f).cast("long")).over(run) - 1 for f in flags}})
    # One struct on either side: missing strata are equal, and no filter on the piece's formula is carried to the other side.
    own, other = (F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cs)]) for cs in (at, [f"__k{i}" for i in range(len(at))]))
    d = d.join(base, own.eqNullSafe(other))
    ranks = {"rank": (F.col("__b__n") + F.col("__r")).cast("long"), **{n: F.when(F.col(f"__f_{n}"), F.col(f"__b__n__f_{n}") + F.col(f"__r__f_{n}")).cast("long") for n in subsets}}
    return d.withColumns(ranks).select(*df.columns, *ranks)


def rank_bin(rank: Column, n: Column, n_bins: int) -> Column:
    """ceil((rank + 1) / floor(n / n_bins)); what remains is in bin n_bins + 1; the width is at least 1."""
    return F.ceil((rank + 1) / F.greatest(F.lit(1), F.floor(n / n_bins))).cast("int")


def running_counts(df: DataFrame, keys: list[str], x: str, counts: dict[str, Column], pieces: int = 64) -> DataFrame:
    """One row per (keys, x), x not missing: each count, and under <name>_before its sum over the smaller x of the key.

    Rows are counted per value first; the values fall into pieces between approximate quantiles, whose counts are summed
    up, and running sums within a piece do the rest, so no task holds all values of a key.
    """
    c = df.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(*[v.alias(k) for k, v in counts.items()])
    cuts = c.agg(F.percentile_approx(F.col(x).cast("double"), [i / pieces for i in range(1, pieces)], 10_000)).first()[0] or []
    c = c.withColumn("__piece", binary_search(F.array(*[F.lit(float(v)) for v in sorted(set(cuts))]).cast("array<double>"), F.col(x).cast("double")))
    per = c.groupBy(*keys, "__piece").agg(*[F.sum(k).alias(f"__n_{k}") for k in counts])
    up = W.partitionBy(*keys).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    base = per.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__piece").alias("__at"), *[F.coalesce(F.sum(f"__n_{k}").over(up), F.lit(0)).alias(f"__b_{k}") for k in counts])
    inside = W.partitionBy(*keys, "__piece").orderBy(x).rowsBetween(W.unboundedPreceding, -1)
    c = c.withColumns({f"__i_{k}": F.coalesce(F.sum(k).over(inside), F.lit(0)) for k in counts})
    # One struct on either side: missing keys are equal, and no filter on the piece's formula is carried to the other side.
    own = F.struct(F.col("__piece").alias("p"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    other = F.struct(F.col("__at").alias("p"), *[F.col(f"__k_{k}").alias(f"k{i}") for i, k in enumerate(keys)])
    return c.join(base, own.eqNullSafe(other)).select(*keys, x, *counts, *[(F.col(f"__i_{k}") + F.col(f"__b_{k}")).alias(f"{k}_before") for k in counts])


def exact_quantiles(df: DataFrame, keys: list[str], x: str, q: list[float]) -> DataFrame:
    """(keys, i, value): the exact quantiles of x per key, interpolated between neighbours; i is the place in q."""
    return exact_quantiles_of(df, keys, [x], q).drop("column")


def quantile_boundaries(df: DataFrame, score: str, n_bins: int, accuracy: int | None = None) -> list[float]:
    """The n_bins - 1 interior quantiles: exact, or approximate with an accuracy."""
    q = [i / n_bins for i in range(1, n_bins)]
    if accuracy:
        return list(df.agg(F.percentile_approx(score, q, accuracy)).first()[0] or [])
    return [r["value"] for r in exact_quantiles(df, [], score, q).orderBy("i").collect()]  # n_bins - 1 rows


def merge_boundaries(boundaries: list[float]) -> tuple[list[float], list[int], list[int]]:
    """(distinct boundaries, their first places, how many equal ones follow each)."""
    kept, first, merged = [], [], []
    for i, b in enumerate(boundaries):
        if kept and b == kept[-1]:
            merged[-1] += 1
        else:
            kept.append(b)
            first.append(i)
            merged.append(0)
    return kept, first, merged


def quantile_bin(score: Column, boundaries: list[float], u: Column, n_bins: int, desc: bool = False) -> Column:
    """Bin of a score: 1 to n_bins in rising order, or n_bins less that with desc.

    A score's place among (-inf, boundaries, inf) is the first whose value is not smaller. Scores at a boundary that
    stands for several bins are spread over them by u in [0, 1).
    """
    kept, first, merged = merge_boundaries(boundaries)
    at = binary_search(F.array(*[F.lit(b) for b in kept]).cast("array<double>"), score)
    place, more = F.get(F.array(*[F.lit(i) for i in [*first, len(boundaries)]]), at), F.get(F.array(*[F.lit(m) for m in [*merged, 0]]), at)
    bin_ = (place + F.floor(u * (more + 1))).cast("int")
    out = F.lit(n_bins - 1) - bin_ if desc else bin_ + 1
    return F.when(score.isNotNull(), out)


def cumulative(df: DataFrame, keys: list[str], order: str, columns: list[str], suffix: str = "_cum") -> DataFrame:
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({f"{c}{suffix}": F.sum(c).over(w) for c in columns})


def hash_order(key: Column | str, seed: int = 0) -> Column:
    """A reproducible shuffle order: md5 of seed and key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}/"), k.cast("string")))


def downsample_index(df: DataFrame, key: str, group: str, seed: int = 0) -> DataFrame:
    """global_index and group_index of each row in shuffled order, 0-based.

    The order is that of a hash of the key, whose first two digits deal the rows into pieces of one size; counts per
    piece are summed up and rows are numbered within their piece.
    """
    d = df.withColumn("__h", hash_order(key, seed)).withColumn("__p", F.substring("__h", 1, 2))
    n = d.groupBy(group, "__p").agg(F.count("*").alias("__n"))
    before = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    all_ = n.groupBy("__p").agg(F.sum("__n").alias("__n")).select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__ball"))  # 256 rows at most
    own = n.select(F.col(group).alias("__g"), F.col("__p").alias("__gp"), F.coalesce(F.sum("__n").over(W.partitionBy(group).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__bown"))
    d = d.withColumns({
        "__i": F.row_number().over(W.partitionBy("__p").orderBy("__h", key)) - 1,
        "__j": F.row_number().over(W.partitionBy(group, "__p").orderBy("__h", key)) - 1,
    })
    d = d.join(all_, "__p").join(own, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__p") == F.col("__gp")))
    return d.select(*df.columns, (F.col("__ball") + F.col("__i")).alias("global_index"), (F.col("__bown") + F.col("__j")).alias("group_index"))
