"""Hard negatives of anchors by a Voronoi-partitioned exact nearest-neighbour join.

Vectors are integers (floor(256 * x) of each component), so scores, their inner products with an anchor, are exact. The
highest inner products are the nearest points once every vector s gets one more coordinate sqrt(M - |s|^2), M being the
largest squared length, and anchors get 0: then |a, s|^2 = |a|^2 + M - 2 score.

Pivots are k-means centres of a bounded sample (they decide cost, never results). Every vector lies in the cell of its
nearest pivot j, at a distance d from it; every anchor knows its distance to each pivot. A vector can be within t of
anchor a only if |a, p_j| - t <= d <= |a, p_j| + t, so

* positives: counts of each label's vectors by cell and distance give each anchor a radius t that surely holds enough
  vectors of its label;
* negatives: the wanted scores are a share of the positive scores, which is a ring around the anchor: the outer radius
  bounds d as above and the inner one r by r - |a, p_j| <= d.

Anchors of near cells make up a region, which takes the union of its anchors' bounds for each cell; vectors are copied
to just the regions whose bounds they meet. A region's anchors are cut into blocks and its vectors into chunks by hash,
both of bounded size, and each block meets each chunk in a task of its own that computes all scores between them and
keeps the first few of each anchor; windows with a group limit merge these. So neither a region that holds most anchors
nor a cell full of copies becomes one task. How many regions a vector is copied to is bounded by their number
(`regions`, times the blocks of anchors); on data without clusters, in many dimensions, bounds exclude little.

Cases: rows with a null label, a null vector or a null or non-finite component take no part, nor do vectors of a
length other than the most common one or whose squared integer length is 2^62 or more (scores would not fit a long).
Repeated rows are rows of their own, so a copy of an anchor counts as another row. A null id ranks after all others. An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import cut, small_side

#: Vectors the pivots are fitted on.
SAMPLE = 4096
#: Rings that distances from a pivot are counted in.
RINGS = 64
#: At most about so many anchors, and so many other vectors, meet in a task.
BLOCK, CHUNK = 1024, 2048


def integers(vectors: DataFrame, anchor: Column, label: Column | str = "label", scale: int = 256) -> DataFrame:
    """(rid, id, label, anchor, q, norm2) of the rows of (vec_id, embedding, label) that take part, as a written table."""
    x = F.transform("embedding", lambda v: v.cast("double") * scale)
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    d = vectors.select(F.col("vec_id").alias("id"), (F.col(label) if isinstance(label, str) else label).alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.when(~bad, x).alias("x"))
    d = d.filter("label is not null and x is not null")
    size = d.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    norm2 = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + F.floor(v).cast("double") * F.floor(v).cast("double"))
    d = d.filter(F.size("x") == (size["n"] if size else 0)).withColumn("norm2", norm2).filter(F.col("norm2") < 2.0**62)
    return cut(d.select(F.monotonically_increasing_id().alias("rid"), "id", "label", "anchor", F.transform("x", lambda v: F.floor(v).cast("int")).alias("q"), "norm2"), "integers")


def fit_pivots(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of x, fewer if it has fewer distinct rows."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    c = x[np.random.default_rng(0).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 0))


def _matrix(column: pa.ChunkedArray | pa.Array, dtype: type = np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def dealt(rows: DataFrame, pivots: int, regions: int) -> tuple[DataFrame, float]:
    """rows with cell and d, anchors also with region and away (their distance to each pivot); and the largest norm2."""
    most = rows.agg(F.max("norm2")).first()[0] or 0.0
    sample = rows.orderBy(F.xxhash64("id", "q"), "rid").limit(SAMPLE).select("q", "norm2").collect()
    q = np.array([[*r["q"], math.sqrt(max(0.0, most - r["norm2"]))] for r in sample], dtype=float).reshape(len(sample), len(sample[0]["q"]) + 1 if sample else 1)
    p = fit_pivots(q, pivots)
    region_of = _distances(p, fit_pivots(p, regions)).argmin(1) if len(p) else np.zeros(0, int)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, n2 = _matrix(b.column("q")), b.column("norm2").to_numpy(zero_copy_only=False)
            d = _distances(np.column_stack([x, np.sqrt(np.maximum(most - n2, 0))]), p)
            away = _distances(np.column_stack([x, np.zeros(len(x))]), p)
            is_anchor = b.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
            cell = d.argmin(1)
            out = [
                pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]),
                pa.array([int(r) if a else None for r, a in zip(region_of[away.argmin(1)], is_anchor)], pa.int32()),
                pa.array([r.tolist() if a else None for r, a in zip(away, is_anchor)], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*b.columns, *out], names=[*b.schema.names, "cell", "d", "region", "away"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in rows.columns) + ", cell int, d double, region int, away array<double>"
    return cut(rows.mapInArrow(deal, schema), "dealt"), most


def _spare(most: float) -> float:
    """What rounding may add to a distance."""
    return 1e-6 * math.sqrt(most) + 1e-9


def radii(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(rid, t) of anchors: within t of each there are k + 1 vectors of its label, itself one of them; null if there are fewer."""
    widest = rows.agg(F.max("d")).first()[0] or 1.0
    step = (widest or 1.0) / RINGS
    rings = rows.groupBy("label", "cell", F.ceil(F.col("d") / step).alias("ring")).agg(F.count("*").alias("n"))
    up = W.partitionBy("label", "cell").orderBy("ring").rowsBetween(W.unboundedPreceding, -1)
    near = rings.withColumn("before", F.coalesce(F.sum("n").over(up), F.lit(0))).filter(F.col("before") <= k)
    reach = anchors.select("rid", "label", F.posexplode("away").alias("cell", "a")).join(near, ["label", "cell"]).select("rid", "n", (F.col("a") + F.col("ring") * step).alias("t"))
    run = W.partitionBy("rid").orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    return reach.withColumn("sum", F.sum("n").over(run)).groupBy("rid").agg(F.min(F.when(F.col("sum") > k, F.col("t"))).alias("t"))


def _copied(rows: DataFrame, bounds: DataFrame, keys: list[str], blocks: dict[int, int], chunks: int) -> DataFrame:
    """rows, once for each block of each region whose bounds they meet, with (region, block, chunk)."""
    met = rows.drop("anchor", "away", "region").join(bounds, keys).filter("d >= low and d <= high")
    per = F.element_at(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]), F.col("region")) if blocks else F.lit(1)
    return met.select("rid", "id", "label", "q", "norm2", "region", F.explode(F.sequence(F.lit(0), per - 1)).alias("block"), F.pmod(F.xxhash64("rid"), F.lit(chunks)).cast("int").alias("chunk"))


def _scores(a: pa.Table, s: pa.Table) -> np.ndarray:
    """Exact integer inner products: in doubles where |a| |s| stays below 2^53, else in 64-bit integers."""
    most = math.sqrt(float(np.max(a["norm2"].to_numpy()))) * math.sqrt(float(np.max(s["norm2"].to_numpy())))
    kind = np.float64 if most < 2.0**52 else np.int64
    return (_matrix(a["q"], kind) @ _matrix(s["q"], kind).T).astype(np.int64)


FOUND = "rid long, place int, other long, other_id long, score long"
FOUND_ARROW = pa.schema([("rid", pa.int64()), ("place", pa.int32()), ("other", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())])


def _joined(anchors: DataFrame, copied: DataFrame, chunks: int, local) -> DataFrame:
    """FOUND rows of every (block of anchors, chunk of vectors)."""
    a = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return FOUND_ARROW.empty_table()
        # Ties go to the smaller id, nulls last: with rows in that order a stable sort by score is enough.
        order = np.lexsort((right["rid"].to_numpy(), right["id"].fill_null(0).to_numpy(), right["id"].is_null().to_numpy()))
        right = right.take(pa.array(order))
        rid, ids = right["rid"].to_numpy(), right["id"].combine_chunks()
        rows, places, at, score = [], [], [], []
        for i, place, hits, values in local(left, right, _scores(left, right), rid):
            rows += [i] * len(hits)
            places += [place] * len(hits)
            at += hits.tolist()
            score += values.tolist()
        at = np.array(at, dtype=np.int64)
        return pa.Table.from_arrays([pa.array(left["rid"].to_numpy()[np.array(rows, dtype=np.int64)]), pa.array(places, pa.int32()), pa.array(rid[at]), ids.take(pa.array(at)), pa.array(score, pa.int64())], schema=FOUND_ARROW)

    keys = ["region", "block", "chunk"]
    return a.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInArrow(meet, FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of each key by score, then id, with their place from 1."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), F.col("other_id").asc_nulls_last(), "other")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def hard_negatives(rows: DataFrame, k_pos: int = 5, k_neg: int = 5, low: int = 80, high: int = 100, pivots: int = 64, regions: int = 12, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from a table of integers().

    An anchor's positives are the first k_pos other rows of its label; for each of them the first k_neg rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score are returned. low <= high.
    """
    rows, most = dealt(rows, pivots, regions)
    anchors = rows.filter("anchor")
    n_of = {r["region"]: r["n"] for r in anchors.groupBy("region").agg(F.count("*").alias("n")).collect()}  # a row a region
    blocks = {r: -(-n // block) for r, n in n_of.items()}
    chunks = max(1, -(-rows.count() // chunk))
    per = F.element_at(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]), F.col("region")) if blocks else F.lit(1)
    anchors = cut(anchors.select("rid", "id", "label", "q", "norm2", "region", F.pmod(F.xxhash64("rid"), per).cast("int").alias("block"), "away"), "anchors")
    spare = _spare(most)

    # Positives.
    t = anchors.join(radii(rows, anchors, k_pos), "rid", "left").select("label", "region", F.coalesce("t", F.lit(float("inf"))).alias("t"), F.posexplode("away").alias("cell", "a"))
    bounds = t.groupBy("label", "region", "cell").agg((F.min(F.col("a") - F.col("t")) - spare).alias("low"), (F.max(F.col("a") + F.col("t")) + spare).alias("high"))

    def positives(left: pa.Table, right: pa.Table, score: np.ndarray, rid: np.ndarray):
        labels = right["label"].to_numpy()
        for i, (r, label) in enumerate(zip(left["rid"].to_pylist(), left["label"].to_pylist())):
            able = np.flatnonzero((labels == label) & (rid != r))
            hits = able[np.argsort(-score[i, able], kind="stable")[:k_pos]]
            yield i, 0, hits, score[i, hits]

    copied = _copied(rows, small_side(cut(bounds, "bounds")), ["label", "cell"], blocks, chunks)
    slim = anchors.drop("away", "id")
    pos = _first(_joined(slim, copied, chunks, positives), ["rid"], k_pos)
    pos = cut(pos.select("rid", F.col("nth").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Negatives: scores from low / 100 to high / 100 of a positive's, a ring of each anchor.
    wanted = pos.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("wanted"))
    with_wanted = anchors.join(wanted, "rid")
    real = F.filter("wanted", lambda w: w["positive_score"] >= 0)
    far = lambda share: F.sqrt(F.greatest(F.col("norm2") + most - 2 * share, F.lit(0.0)))
    ring = with_wanted.select("region", "away", F.transform(real, lambda w: w["positive_score"].cast("double")).alias("p"), "norm2").filter("size(p) > 0")
    ring = ring.withColumns({"out": far(F.array_min("p") * low / 100) + spare, "in": far(F.array_max("p") * high / 100) - spare})
    ring = ring.select("region", "out", "in", F.posexplode("away").alias("cell", "a"))
    bounds = ring.groupBy("region", "cell").agg((F.min(F.greatest(F.col("a") - F.col("out"), F.col("in") - F.col("a"))) - spare).alias("low"), (F.max(F.col("a") + F.col("out")) + spare).alias("high"))

    def negatives(left: pa.Table, right: pa.Table, score: np.ndarray, rid: np.ndarray):
        labels = right["label"].to_numpy()
        for i, (label, want) in enumerate(zip(left["label"].to_pylist(), left["wanted"].to_pylist())):
            able = np.flatnonzero(labels != label)
            able = able[np.argsort(-score[i, able], kind="stable")]
            values = score[i, able]
            for w in want:
                p = w["positive_score"]
                # 100 * value <= high * p and low * p <= 100 * value, without products that could overflow
                top, bottom = high * p // 100, -(-low * p // 100)
                first = int(np.searchsorted(-values, -top, side="left"))
                last = first + int(np.searchsorted(-values[first : first + k_neg], -bottom, side="right"))
                yield i, w["place"], able[first:last], values[first:last]

    copied = _copied(rows, F.broadcast(cut(bounds, "bounds")), ["cell"], blocks, chunks)  # a row for each region and cell
    neg = _first(_joined(with_wanted.drop("away", "id"), copied, chunks, negatives), ["rid", "place"], k_neg)
    out = neg.join(pos, ["rid", "place"]).join(anchors.select("rid", F.col("id").alias("anchor_id")), "rid")
    return out.select("anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label))
