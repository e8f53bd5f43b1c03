"""Joins by key and by interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def distinct_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__nth", F.row_number().over(w)).filter("__nth = 1").drop("__nth")


def lookup(left: DataFrame, right: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """left with the fields of the right row of its key; right is made unique by key first, so no left row is repeated."""
    order = order or [F.col(c) for c in right.columns if c not in keys] or [F.lit(1)]
    return left.join(distinct_by_key(right, keys, order), keys, "left")


def semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_anti")


def outer_flags(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Union of all keys with one flag per table: true where the table has the key, missing elsewhere."""
    tagged = [t.select(*keys, F.lit(name).alias("__from")) for name, t in tables.items()]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    return every.groupBy(*keys).agg(*[F.max(F.when(F.col("__from") == n, True)).alias(n) for n in tables])


#: Bins of each level are so many times as wide as those of the level below; so many levels reach over any chromosome.
WIDER, LEVELS = 8, 8


def region_bins(regions: DataFrame, width: int) -> DataFrame:
    """(__contig, __start, __end, __level, __rbin): each region in the one or two bins of the finest level where it needs no more."""
    first, last = F.col("start"), F.greatest(F.col("end") - 1, F.col("start"))
    at = lambda x, w: F.floor(x / w)
    level = F.lit(LEVELS - 1)
    for i in reversed(range(LEVELS - 1)):
        w = width * WIDER**i
        level = F.when(at(last, w) - at(first, w) <= 1, i).otherwise(level)
    r = regions.select(F.col("contig").alias("__contig"), first.alias("__start"), F.col("end").alias("__end"), last.alias("__last"), level.alias("__level"))
    w = F.lit(width) * F.pow(F.lit(WIDER), F.col("__level")).cast("bigint")
    return r.withColumn("__rbin", F.explode(F.sequence(F.floor(F.col("__start") / w), F.floor(F.col("__last") / w)))).drop("__last")


def interval_join(points: DataFrame, regions: DataFrame, how: str, width: int = 10_000) -> DataFrame:
    """left_semi or left_anti of points (contig, position) against half-open regions (contig, start, end).

    Regions lie in nested bins: one or two rows each, however long. For every level that some region uses, points are
    joined on (contig, bin) by equality with the bounds as a condition; what one level has decided is not asked again.
    """
    r = region_bins(regions, width)
    used = sorted(x[0] for x in r.select("__level").distinct().collect())  # LEVELS at most
    rest, hits = points, []
    for level in used:
        at = r.filter(F.col("__level") == level)
        on = (F.col("contig") == F.col("__contig")) & (F.col("__bin") == F.col("__rbin")) & (F.col("position") >= F.col("__start")) & (F.col("position") < F.col("__end"))
        p = rest.withColumn("__bin", F.floor(F.col("position") / (width * WIDER**level)))
        hits.append(p.join(at, on, "left_semi").drop("__bin"))
        rest = p.join(at, on, "left_anti").drop("__bin")
    if how == "left_anti":
        return rest
    out = points.limit(0) if not hits else hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return out


def interval_flag(points: DataFrame, regions: DataFrame, name: str, key: list[str], width: int = 10_000) -> DataFrame:
    hits = interval_join(points, regions, "left_semi", width).select(*key).distinct().withColumn(name, F.lit(True))
    return points.join(hits, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def first_contained(left: DataFrame, right: DataFrame, text: str, part: str, order: str, most_gram: int = 8) -> DataFrame:
    """For each left row the first right row, in order, whose part is contained in the text; rows without one are dropped.

    A part is contained only where its first k characters are, k being the length of the shortest part (most_gram at
    most): texts are laid out over their distinct runs of k characters and joined on them by equality, whatever the size
    of either side. Of empty parts, which every text contains, only the first in order matters.
    """
    r = right.filter(F.col(part).isNotNull())
    k = r.filter(F.length(part) > 0).agg(F.min(F.length(part))).first()[0]
    k = min(most_gram, k or 1)
    t = left.withColumn("__grams", F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - k + 1, F.lit(1))), lambda i: F.substring(F.col(text), i, F.lit(k)))))
    t = t.withColumn("__gram", F.explode("__grams")).drop("__grams")
    best = F.min(F.struct(F.col(order), *[F.col(c) for c in right.columns if c != order])).alias("__best")
    hit = t.join(r.filter(F.length(part) > 0).withColumn("__key", F.substring(part, 1, k)), (F.col("__gram") == F.col("__key")) & F.col(text).contains(F.col(part)))
    hit = hit.select(*left.columns, *right.columns)
    empty = r.filter(F.length(part) == 0).orderBy(order, *[c for c in right.columns if c != order]).limit(1)
    hit = hit.unionByName(left.filter(F.col(text).isNotNull()).crossJoin(F.broadcast(empty)).select(*left.columns, *right.columns))
    return hit.groupBy(*left.columns).agg(best).select(*left.columns, *[F.col(f"__best.{c}").alias(c) for c in right.columns])


def precedence(base: DataFrame, sources: list[tuple[DataFrame, str]], key: str, label: str, unless: str | None = None) -> DataFrame:
    """label of base, overwritten by each source in turn (the later wins) where it has the key.

    unless: text that marks a label as final; a label that holds it (in any case) is not overwritten.
    """
    out = base
    for i, (t, name) in enumerate(sources):
        one = t.groupBy(key).agg(F.min(name).alias(f"__l{i}"))
        new = F.col(f"__l{i}")
        if unless is not None:
            new = F.when(F.coalesce(F.lower(label).contains(unless.lower()), F.lit(False)), F.col(label)).otherwise(new)
        out = out.join(one, key, "left").withColumn(label, F.coalesce(new, F.col(label))).drop(f"__l{i}")
    return out


def intersect_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that both sides have; missing keys are equal to each other."""
    return left.select(*keys).intersect(right.select(*keys))


def except_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of the left side that the right side lacks."""
    return left.select(*keys).subtract(right.select(*keys))


def annotate_many(left: DataFrame, tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """left with a struct per table: its row of the key, or missing; each table is made unique by key first."""
    for name, t in tables.items():
        rest = [c for c in t.columns if c not in keys]
        one = distinct_by_key(t, keys, [F.col(c) for c in rest] or [F.lit(1)])
        left = left.join(one.select(*keys, F.struct(*rest).alias(name)), keys, "left")
    return left


def rank_pairs(pairs: DataFrame, ranks: DataFrame, node: str = "sid", rank: str = "rank") -> DataFrame:
    """pairs (i, j, ...) with the ranks of both ends (rank_i, rank_j), missing where a node has none."""
    for end in ("i", "j"):
        pairs = pairs.join(ranks.select(F.col(node).alias(end), F.col(rank).alias(f"rank_{end}")), end, "left")
    return pairs


def trios(entries: DataFrame, fam: DataFrame, fields: list[str] = ["n_alt"]) -> DataFrame:  # noqa: B006
    """One row per (site, complete trio) with child_, father_ and mother_ fields.

    Only cells of family members are shuffled; each is sent to the trios it takes part in, and one aggregation by
    (site, trio) puts the three together, in place of a chain of three joins.
    """
    roles = fam.select("fam_id", "proband", F.explode(F.array(*[F.struct(F.col(c).alias("sid"), F.lit(r).alias("role")) for r, c in (("child", "proband"), ("father", "father"), ("mother", "mother"))])).alias("r"))
    roles = roles.select("fam_id", "proband", "r.sid", "r.role")
    cells = entries.select("vid", "sid", *fields).join(roles, "sid")
    aggs = [F.max(F.when(F.col("role") == r, F.col(f))).alias(f"{r}_{f}") for r in ("child", "father", "mother") for f in fields]
    return cells.groupBy("vid", "fam_id", "proband").agg(F.count_distinct("role").alias("__n"), *aggs).filter("__n = 3").drop("__n")
