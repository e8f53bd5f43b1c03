"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of all words, at most `cap` times its own words; what is above the cap is
shared again by weight until no target exceeds its cap. Sorted by cap / weight, the capped sources are a prefix, so
the water level is one windowed pass over the source table. Every document of a source expects e = target / words
copies. The documents of a source are laid on a line in order of size, each e long; one random offset u per source
shifts the line, and a document is emitted once for each whole number its stretch crosses:
floor(r * e + e + u) - floor(r * e + u) for rank r. Ordering by size spreads the sample over all sizes, so the words
taken stay near the target, and a document is taken at most ceil(e) <= cap times.

Ranks need no task that holds a whole source: rows are counted per (source, size, slice) first, slices being two hex
digits of md5(doc_id), and the counts are summed up; only rows of one slice are ranked against each other.

Cases: null or blank text has size 0 and is taken or not like any other; a null source is a source of its own, last (take() keeps documents without words once);
a source without words has target 0 and takes nothing; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut, text_or_empty

CAP = 3.0
WEIGHTS = (1, 2, 3)
SEED = "gridloom"


def n_words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source_offset(source: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(seed + "/"), F.coalesce(source, F.lit("\u0000"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(cells: DataFrame, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, __size, n): one row a source; the windows run over this table only."""
    s = cells.groupBy("source").agg(F.sum(F.col("__size") * F.col("n")).alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("w", weight)
    by_ratio = W.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    s = s.withColumn("left", F.sum("source_size").over(everything) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    s = s.withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("left") / F.col("w_left"))
    # The level fits from the first source on that it does not lift above its cap.
    s = s.withColumn("fit", F.min(F.when(F.lit(cap) * F.col("source_size") >= F.col("level") * F.col("w"), F.struct(F.col("source_size") / F.col("w"), "level"))).over(everything))
    return s.select("source", "source_size", F.least(F.lit(cap) * F.col("source_size"), F.col("w") * F.col("fit")["level"]).alias("target"))


def sized(docs: DataFrame) -> DataFrame:
    """docs with __size, the words of the text, and __slice, two hex digits of md5(doc_id)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.withColumns({"__size": n_words(text_or_empty()), "__slice": F.substring(F.md5(key), 1, 2)})


def mix(rows: DataFrame, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """rows of sized() with __source_size, __target and __copies. Each row is shuffled once, by its cell."""
    cells = cut(rows.groupBy("source", "__size", "__slice").agg(F.count("*").alias("n")), "cells")
    targets = source_targets(cells, cap, weights)
    sizes = cells.groupBy("source", "__size").agg(F.sum("n").alias("n"))
    size_base = sizes.select("source", "__size", (F.sum("n").over(W.partitionBy("source").orderBy("__size")) - F.col("n")).alias("size_base"))
    slice_base = cells.select("source", "__size", "__slice", (F.sum("n").over(W.partitionBy("source", "__size").orderBy("__slice")) - F.col("n")).alias("slice_base"))

    def joined(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
        right = right.withColumnsRenamed({n: f"__r_{n}" for n in names})
        on = [left[n].eqNullSafe(right[f"__r_{n}"]) for n in names]
        return left.join(right, on).drop(*[f"__r_{n}" for n in names])

    base = joined(joined(slice_base, size_base, ["source", "__size"]), targets, ["source"])
    base = base.select("source", "__size", "__slice", (F.col("slice_base") + F.col("size_base")).alias("__base"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    own = W.partitionBy("source", "__size", "__slice").orderBy(F.col("doc_id").asc_nulls_first())
    out = joined(rows.withColumn("__within", F.row_number().over(own) - 1), base, ["source", "__size", "__slice"])
    r = F.col("__base") + F.col("__within")
    e = F.coalesce(F.try_divide(F.col("__target"), F.col("__source_size").cast("double")), F.lit(0.0))
    u = _source_offset(F.col("source"), seed)
    copies = F.floor((r + 1).cast("double") * e + u) - F.floor(r.cast("double") * e + u)
    return out.withColumn("__copies", F.least(copies, F.lit(int(-(-cap // 1)))).cast("long")).drop("__within", "__base")


def take(docs: DataFrame, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """Each document as often as the mix takes it. Documents without words are free: they stay once."""
    m = mix(sized(docs), cap, weights, seed)
    times = F.when(F.col("__size") == 0, 1).otherwise(F.col("__copies")).cast("int")
    return m.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(sized(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "source", "__size", "__slice"), "sizes")
    return mix(rows).select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"))


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS slice FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
sw AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM s),
lv AS (
  SELECT *, (sum(source_size) OVER () - 3.0 * coalesce(sum(source_size) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) AS level
  FROM sw WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(3.0 * source_size, w * (
    SELECT CAST(level AS DOUBLE) FROM lv WHERE 3.0 * source_size >= level * w ORDER BY source_size / w, level LIMIT 1)) AS target,
    CAST(CAST('0x' || substr(md5('gridloom/' || coalesce(source, chr(0))), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
  FROM lv),
r AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, slice, doc_id NULLS FIRST) - 1 AS r FROM sized)
SELECT r.doc_id, r.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
  CAST(r.size * least(3, floor((r.r + 1) * coalesce(t.target / nullif(CAST(t.source_size AS DOUBLE), 0), 0) + t.u)
                       - floor(r.r * coalesce(t.target / nullif(CAST(t.source_size AS DOUBLE), 0), 0) + t.u)) AS BIGINT) AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
"""
