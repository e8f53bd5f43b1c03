"""Embedding near-duplicates with a robust-pruned flat graph.

Unit vectors are dealt to overlapping shards, each to its nearest few cluster centres (k-means on a bounded sample).
Every shard builds a flat neighbour graph: candidates are the nearest members and a few random ones, robust pruning
drops a candidate that a closer kept one already covers, and reverse edges are added. The adjacency lists of all shards
are united per vector. Then every vector is searched for in each of its shards over the united graph: a greedy search
from the shard's medoid (and from the query's own vertex, as every query is one) that first follows the best vertices
and then expands each vertex in range until no new one is in range. Similarities are computed in double precision
when a vertex is visited, so each reported link is verified; recall is audited against brute force on a query set.

Centres follow density, so a dense group gets many of them, and pairs of its members may share none of their nearest.
Therefore all linked pairs of the sample are looked at before vectors are dealt: centres between which such pairs have
no shard in common become one shard, until no linked pair of the sample is parted. Shards of more than two blocks have
no graph: they are cut into blocks of `block` members and each two blocks are compared exactly, in a task of their own.

Equal vectors are one vertex with a multiplicity. A pair that shares several shards is counted in the lowest of them.
A task holds the vectors of two blocks at most. Work and rows sent grow with the square of a shard's blocks.

Cases: vectors that are null, of a length other than the most common one, zero, or that hold null or non-finite
components link with nothing; repeated rows of one vec_id are vectors of their own that share the id; an empty table
gives no rows; a null vec_id takes part like any other; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import components, cut

SAMPLE, SHARD_ROWS, MOST_SHARDS, OVERLAP = 8192, 1500, 1024, 3
NEAREST, RANDOM, DEGREE, ALPHA, BEAM, STEP = 40, 12, 20, 1.2, 32, 6


def unit_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): the unit vector as little-endian doubles, null where the vector is not usable."""
    by_size = vectors.groupBy(F.size(column).alias("n")).count().filter("n > 0").orderBy(F.desc("count"), "n").first()
    dim = by_size["n"] if by_size else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                v = np.array([np.nan]) if x is None or len(x) != dim or any(e is None for e in x) else np.array(x, np.float64)
                big = np.abs(v).max() if np.isfinite(v).all() else 0.0
                out.append((v / big / np.linalg.norm(v / big)).astype("<f8").tobytes() if big > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")).mapInArrow(run, "vec_id long, v binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def nearest_shards(x: np.ndarray, c: np.ndarray, shard: np.ndarray, overlap: int) -> np.ndarray:
    """(rows of x) x overlap: the shards of the nearest centres, nearest first; centre i belongs to shard[i], a centre's number."""
    own, at = np.unique(shard, return_inverse=True)
    sims = x @ c.T
    best = np.full((len(x), len(own)), -np.inf)
    for i, j in enumerate(at):
        np.maximum(best[:, j], sims[:, i], out=best[:, j])
    return own[np.argsort(-best, axis=1, kind="stable")[:, : min(overlap, len(own))]]


def joined_centres(x: np.ndarray, c: np.ndarray, radius: float, overlap: int) -> np.ndarray:
    """The shard of each centre: centres are joined until every pair of rows of x in range has a shard in common."""
    shard = np.arange(len(c))
    while True:
        near = nearest_shards(x, c, shard, overlap)
        parted = np.zeros((len(c), len(c)), bool)
        for lo in range(0, len(x), 512):
            a, b = np.nonzero(x[lo : lo + 512] @ x.T >= radius)
            a += lo
            common = _common(near, a, b)
            parted[near[a[~common], 0], near[b[~common], 0]] = True
        a, b = np.nonzero(parted)
        if not len(a):
            return shard
        shard = _forest(a, b, len(c))[shard]


def _common(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), bool)
    for i in range(near.shape[1]):
        for j in range(near.shape[1]):
            out |= near[a, i] == near[b, j]
    return out


def centres(nodes: DataFrame, n: int, radius: float, seed: int = 5, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means on the SAMPLE vertices with the lowest hashes, one centre for about SHARD_ROWS vertices, and the shard of each."""
    rows = nodes.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()
    x = _matrix([r["v"] for r in rows])
    k = int(min(MOST_SHARDS, max(1, -(-n // SHARD_ROWS)), len(x)))
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        for j in range(k):
            if (near == j).any():
                m = x[near == j].sum(0)
                c[j] = m / (np.linalg.norm(m) or 1.0)
    return c, joined_centres(x, c, radius, OVERLAP)


def to_shards(nodes: DataFrame, c: np.ndarray, shard: np.ndarray, overlap: int = OVERLAP) -> DataFrame:
    """nodes with the sorted list of their nearest `overlap` shards."""
    sent = nodes.sparkSession.sparkContext.broadcast((c, shard))  # MOST_SHARDS centres at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = nearest_shards(_matrix(batch["v"].to_pylist()), *sent.value, overlap)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.sort(near, 1).tolist(), pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"])

    return nodes.mapInArrow(run, "node long, v binary, copies long, shards array<int>")


def pruned_graph(v: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) rows of the robust-pruned graph with reverse edges."""
    m, rng = len(v), np.random.default_rng(seed)
    near = min(NEAREST, m - 1)
    if near < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    src, dst = [], []
    for lo in range(0, m, 256):
        hi = min(m, lo + 256)
        sims = v[lo:hi] @ v.T
        sims[np.arange(hi - lo), np.arange(lo, hi)] = -np.inf
        cand = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        cand = np.concatenate([cand, rng.integers(0, m, (hi - lo, RANDOM))], 1)
        own = np.take_along_axis(sims, cand, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        cand, own = np.take_along_axis(cand, order, 1), np.take_along_axis(own, order, 1)
        alive, kept = np.isfinite(own), np.zeros(own.shape, bool)
        cv = v[cand]
        between = cv @ cv.transpose(0, 2, 1)
        for j in range(cand.shape[1]):
            take = alive[:, j] & (kept.sum(1) < DEGREE)
            kept[:, j] = take
            covered = ALPHA * (1 - between[:, j]) <= 1 - own
            alive[take] &= ~covered[take]
        rows, cols = np.nonzero(kept)
        src.append(rows + lo)
        dst.append(cand[rows, cols])
    a, b = np.concatenate(src), np.concatenate(dst)
    pairs = np.unique(np.concatenate([a * m + b, b * m + a]))
    a, b = pairs // m, pairs % m
    order = np.lexsort((-np.einsum("ij,ij->i", v[a], v[b]), a))
    a, b = a[order], b[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return a[rank < 2 * DEGREE], b[rank < 2 * DEGREE]


def range_search(v: np.ndarray, lists: np.ndarray, queries: np.ndarray, starts: list[int], radius: float) -> np.ndarray:
    """(queries x members) bool: the members found in range of each query. lists: m x degree, padded with -1."""
    q, m, n = v[queries], len(v), len(queries)
    sims, open_ = np.full((n, m), -np.inf), np.zeros((n, m), bool)
    rows = np.arange(n)
    for s in [*starts, None]:
        at = queries if s is None else np.full(n, s)
        sims[rows, at] = np.einsum("ij,ij->i", q, v[at])
        open_[rows, at] = True
    active = rows
    while len(active):
        best = np.where(open_[active], sims[active], -np.inf)
        k = min(STEP, m)
        top = np.argpartition(-best, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(best, top, 1)
        beam = min(BEAM, m)
        bar = -np.partition(-sims[active], beam - 1, axis=1)[:, beam - 1]
        go = np.isfinite(value) & ((value >= bar[:, None]) | (value >= radius))
        hit = go.any(1)
        query, vertex = np.repeat(active[hit], go[hit].sum(1)), top[go]
        active = active[hit]
        if not len(active):
            break
        open_[query, vertex] = False
        near = lists[vertex]
        qq, nn = np.repeat(query, near.shape[1]), near.ravel()
        ok = nn >= 0
        qq, nn = qq[ok], nn[ok]
        new = ~np.isfinite(sims[qq, nn])
        qq, nn = qq[new], nn[new]
        if len(qq):
            key = np.unique(qq * m + nn)
            qq, nn = key // m, key % m
            sims[qq, nn] = np.einsum("ij,ij->i", q[qq], v[nn])
            open_[qq, nn] = True
    return sims >= radius


def _forest(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Smallest member reachable from each of m members over the edges (a, b)."""
    label = np.arange(m)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _roots(hit: np.ndarray) -> np.ndarray:
    """For the rows, then the columns, of a bool matrix: a row that is reachable over its true cells, -1 where a line has none."""
    n = len(hit)
    root = np.full(sum(hit.shape), -1, np.int64)
    for s in np.flatnonzero(hit.any(1)):
        if root[s] < 0:
            root[s], rows = s, np.array([s])
            while len(rows):
                cols = np.flatnonzero(hit[rows].any(0) & (root[n:] < 0))
                root[n + cols] = s
                rows = np.flatnonzero(hit[:, cols].any(1) & (root[:n] < 0))
                root[rows] = s
    return root


def compared(x: pd.DataFrame, y: pd.DataFrame, same: bool, shard: int, radius: float) -> pd.DataFrame:
    """(node, found, root) by exact comparison of two blocks of a shard; found counts pairs that share no lower shard."""
    vx, vy = _matrix(x["v"].tolist()), _matrix(y["v"].tolist())
    sx, sy = np.stack(x["shards"].to_list()), np.stack(y["shards"].to_list())
    cx, cy = x["copies"].to_numpy(np.float64), y["copies"].to_numpy(np.float64)
    hit, row_sums, col_sums = np.zeros((len(vx), len(vy)), bool), np.zeros(len(vx)), np.zeros(len(vy))
    for lo in range(0, len(vx), 512):
        part = vx[lo : lo + 512] @ vy.T >= radius
        if same:
            part[np.arange(len(part)), np.arange(lo, lo + len(part))] = False
        hit[lo : lo + 512] = part
        for s in np.intersect1d(sx[sx < shard], sy[sy < shard]):
            part &= ~((sx[lo : lo + 512] == s).any(1)[:, None] & (sy == s).any(1)[None, :])
        row_sums[lo : lo + 512] = part @ cy
        col_sums += cx[lo : lo + 512] @ part
    root, ids = _roots(hit), np.concatenate([x["node"].to_numpy(), y["node"].to_numpy()])
    found = np.concatenate([row_sums, np.zeros(len(vy)) if same else col_sums])
    use = root >= 0
    return pd.DataFrame({"node": ids[use], "found": found[use].astype(np.int64), "root": ids[root[use]]})


def links(vectors: DataFrame, radius: float = 0.9, block: int = 4096) -> DataFrame:
    """(vec_id, v is usable, n_links, component_id, kept) for every row of vectors."""
    units = cut(unit_vectors(vectors), "units")
    nodes = units.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    if not n:
        return units.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    placed = cut(to_shards(nodes.select("node", "v", "copies"), *centres(nodes, n, radius)), "placed")
    every = placed.select("*", F.explode("shards").alias("shard"))
    sizes = every.groupBy("shard").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))  # MOST_SHARDS rows at most
    every = every.join(F.broadcast(cut(sizes, "sizes")), "shard")
    members = every.filter("blocks <= 2")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        v, ids = _matrix(pdf["v"].tolist()), pdf["node"].to_numpy()
        a, b = pruned_graph(v)
        ends = np.searchsorted(a, np.arange(len(v) + 1))
        return pd.DataFrame({"node": ids, "near": [ids[b[i:j]] for i, j in zip(ends, ends[1:])]})

    graph = members.select("shard", "node", "v").groupBy("shard").applyInPandas(build, "node long, near array<long>")
    united = cut(graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    whole = members.join(united, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        v, ids, copies = _matrix(pdf["v"].tolist()), pdf["node"].to_numpy(), pdf["copies"].to_numpy()
        m, shard, part = len(v), int(pdf["shard"].iloc[0]), int(pdf["block"].iloc[0])
        shards = np.stack(pdf["shards"].to_list())
        near = [np.asarray(x, np.int64) for x in pdf["near"]]
        lists = np.full((m, max(1, max(map(len, near)))), -1, np.int64)
        for i, x in enumerate(near):
            at = np.searchsorted(ids, x)
            at[at == m] = 0
            lists[i, : len(x)] = np.where(ids[at] == x, at, -1)
        medoid = int((v @ v.mean(0)).argmax())
        queries = np.arange(m)[np.arange(m) // block == part]
        pairs = []
        for lo in range(0, len(queries), 256):
            q = queries[lo : lo + 256]
            r, c = np.nonzero(range_search(v, lists, q, [medoid], radius))
            pairs.append(np.stack([q[r], c], 1))
        p = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
        p = p[p[:, 0] != p[:, 1]]
        if pdf["blocks"].iloc[0] == 1:  # what one end has found the other has too
            p = np.unique(np.concatenate([p, p[:, ::-1]]), axis=0)
        common = np.full(len(p), 2**31 - 1)
        for i in range(shards.shape[1]):
            for j in range(shards.shape[1]):
                s, t = shards[p[:, 0], i], shards[p[:, 1], j]
                common = np.where(s == t, np.minimum(common, s), common)
        own = common == shard
        found = np.bincount(p[own, 0], weights=copies[p[own, 1]], minlength=m).astype(np.int64)
        root = _forest(p[:, 0], p[:, 1], m)
        use = (found > 0) | (root != np.arange(m))
        return pd.DataFrame({"node": ids[use], "found": found[use], "root": ids[root[use]]})

    found = whole.select("shard", "block", "blocks", "node", "v", "copies", "shards", "near").groupBy("shard", "block").applyInPandas(search, "node long, found long, root long")
    dealt = every.filter("blocks > 2").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("shard", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "v", "copies", "shards")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        shard, low, high = (int(pdf[c].iloc[0]) for c in ("shard", "low", "high"))
        x, y = pdf[pdf["mine"] == low], pdf[pdf["mine"] == high]
        return compared(x, y, low == high, shard, radius) if len(x) and len(y) else pd.DataFrame({"node": [], "found": [], "root": []}, dtype=np.int64)

    exact = dealt.groupBy("shard", "low", "high").applyInPandas(compare, "node long, found long, root long")
    found = cut(found.unionByName(exact), "found")
    counts = found.groupBy("node").agg(F.sum("found").alias("found"))
    labels = components(found.select("node", "root"))
    named = nodes.join(labels, "node", "left").withColumn("c", F.coalesce("component", "node"))
    ids = named.groupBy("c").agg(F.min("first_id").alias("component_id"))
    table = named.join(ids, "c").join(counts, "node", "left")
    table = table.select(F.col("v").alias("node_v"), "component_id", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = units.join(table, units["v"] == table["node_v"], "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.col("vec_id").eqNullSafe(component)).alias("kept"))


def audit_recall(vectors: DataFrame, result: DataFrame, radius: float = 0.9, every: int = 20) -> DataFrame:
    """One row (linked, found, recall): links of the vectors whose id is divisible by `every`, by brute force over all rows.

    The query set is sent to all tasks in blocks of 4096 queries, each block meets every row once.
    """
    units = unit_vectors(vectors).filter("v is not null")
    queries = units.filter(F.col("vec_id") % every == 0).distinct()
    asked = queries.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() // 4096))))).groupBy("g").agg(F.collect_list(F.struct("vec_id", "v")).alias("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_id, out_v, out_n = [], [], []
            for q, r in zip(batch["q"].to_pylist(), batch["rows"].to_pylist()):
                hits = (_matrix([x["v"] for x in q]) @ _matrix(r).T >= radius).sum(1)
                out_id += [x["vec_id"] for x in q]
                out_v += [x["v"] for x in q]
                out_n += hits.tolist()
            yield pa.record_batch([pa.array(out_id, pa.int64()), pa.array(out_v, pa.binary()), pa.array(out_n, pa.int64())], names=["vec_id", "v", "n"])

    rows = units.withColumn("h", F.pmod(F.xxhash64("v", "vec_id"), F.lit(max(1, units.count() // 4096 + 1)))).groupBy("h").agg(F.collect_list("v").alias("rows"))
    exact = asked.crossJoin(rows).select("q", "rows")
    n = exact.mapInArrow(run, "vec_id long, v binary, n long").groupBy("vec_id", "v").agg(F.sum("n").alias("n"))
    n = n.groupBy("vec_id").agg((F.max("n") - 1).alias("linked"))
    both = n.join(result.groupBy("vec_id").agg(F.max("n_links").alias("found")), "vec_id")
    return both.agg(F.sum("linked").alias("linked"), F.sum(F.least("found", "linked")).alias("found"), F.coalesce(F.try_divide(F.sum(F.least("found", "linked")), F.sum("linked")), F.lit(1.0)).alias("recall"))


def op6_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
