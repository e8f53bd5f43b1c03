"""Genotype cells packed by site, and what vectorised kernels make of them: components, kinship, linkage.

A packed row holds the calls of one site, of the samples that have one only: their places in the order of the samples
(32 bits each, rising) and their copies (a byte each). So a table of packed rows is as large as the cells it holds,
however many samples there are. Tasks take so many sites at a time that a batch has about ENTRIES cells; where most of
the batch's grid is filled they turn it into a dense matrix. Nothing that is samples by samples is ever held, and the
driver holds the ids of the samples only.
"""

from __future__ import annotations

import gc
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.tall import ROWS, Noise, Tall, each_part, mix, orthonormal, split, tall
from gridloom.operators.windows import stratified_rank
from gridloom.session import written

NONE = 255
#: About so many cells are in one dense matrix, and in one batch of packed sites.
CELLS, ENTRIES = 1 << 22, 1 << 18
#: Sites in a batch at most, and samples in a row of partial sums.
SITES, PART = 1024, 512
#: Multiply-adds in dense blocks that cost as much as one pair of cells that goes through a shuffle.
PAIR_COST = 5000


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside get Arrow batches of at most so many rows, and read files in batches of as many."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    was = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, str(max(1, rows)))
    try:
        yield
    finally:
        for k, v in zip(keys, was):
            spark.conf.set(k, v)


def called(entries: DataFrame) -> DataFrame:
    """(vid, sid, n_alt): the cells with a call, as a written table."""
    return written(entries.filter("n_alt is not null").select("vid", F.col("sid").cast("long").alias("sid"), F.col("n_alt").cast("int").alias("n_alt")), "cells")


def sample_order(cells: DataFrame) -> np.ndarray:
    """The samples that have a call, in order of sid."""
    return np.sort(cells.select("sid").distinct().toArrow()["sid"].to_numpy())  # one number a sample


def pack(cells: DataFrame, order: np.ndarray) -> DataFrame:
    """(vid, p, at, call) for each site with a call by the samples of order: frequency of the alternate, places and calls as bytes."""
    spark = cells.sparkSession
    sent = spark.sparkContext.broadcast(np.asarray(order, np.int64))

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in batches:
            size = b.column("sid").value_lengths().to_numpy(zero_copy_only=False)
            sid, call = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("sid", "call"))
            row, at = np.repeat(np.arange(len(size)), size), np.searchsorted(known, sid)
            ok = at < len(known)
            ok[ok] = known[at[ok]] == sid[ok]
            row, at, call = row[ok], at[ok].astype(np.int32), call[ok].astype(np.uint8)
            by = np.lexsort((at, row))
            row, at, call = row[by], at[by], call[by]
            n = np.bincount(row, minlength=len(size))
            stop, some = np.cumsum(n), np.flatnonzero(n)
            p = np.bincount(row, call, len(size))[some] / (2.0 * n[some])
            of = lambda x: pa.array([x[stop[i] - n[i] : stop[i]].tobytes() for i in some], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vid").take(pa.array(some)), pa.array(p, pa.float64()), of(at), of(call)], names=["vid", "p", "at", "call"])

    widest = cells.groupBy("vid").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    sites = cells.groupBy("vid").agg(F.collect_list("sid").alias("sid"), F.collect_list("n_alt").alias("call"))
    with batches_of(spark, _at_once(widest)):
        return written(sites.mapInArrow(to_bytes, f"vid {dict(cells.dtypes)['vid']}, p double, at binary, call binary"), "packed")


def _at_once(widest: int) -> int:
    return min(SITES, max(1, ENTRIES // widest))


def sites_at_once(packed: DataFrame) -> int:
    """Sites that a batch takes, by the site with the most calls."""
    return _at_once(packed.agg(F.max(F.octet_length("call"))).first()[0] or 1)


def flat(b: pa.RecordBatch, at: str = "at", call: str = "call") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, calls, number of cells of each site) of a batch, site after site."""
    places, calls = b.column(at), b.column(call)
    return np.frombuffer(b"".join(places.to_pylist()), np.int32), np.frombuffer(b"".join(calls.to_pylist()), np.uint8), pc.binary_length(calls).to_numpy(zero_copy_only=False).astype(np.int64)


def matrix(b: pa.RecordBatch, n: int) -> np.ndarray:
    """The calls of a batch as sites x samples."""
    at, call, size = flat(b)
    g = np.full((len(size), n), NONE, np.uint8)
    g[np.repeat(np.arange(len(size)), size), at] = call
    return g


def _normalised(b: pa.RecordBatch, sites: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, normalised calls, cells of each site); what is not called is zero."""
    at, call, size = flat(b)
    p = np.repeat(b.column("p").to_numpy(), size)
    return at, (call - 2 * p) / np.sqrt(sites * 2 * p * (1 - p)), size


def _sums(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of the rows of x over runs of so many."""
    return np.add.reduceat(x, np.cumsum(size) - size, axis=0)


def _spread(z: np.ndarray, at: np.ndarray, size: np.ndarray, m: np.ndarray, total: np.ndarray) -> None:
    """total += Z'Z m, of a batch's sites; m and total have a row a column, which is gone through by itself."""
    if 8 * len(at) >= len(size) * m.shape[1]:
        d = np.zeros((len(size), m.shape[1]))
        d[np.repeat(np.arange(len(size)), size), at] = z
        total += (d.T @ (d @ m.T)).T
        return
    at, start = at.astype(np.intp), np.cumsum(size) - size
    for x, y in zip(m, total):
        np.add.at(y, at, z * np.repeat(np.add.reduceat(z * x[at], start), size))


def components(packed: DataFrame, n: int, k: int, extra: int = 6, tol: float = 1e-7, most: int = 1000, held: int = 12) -> tuple[np.ndarray, np.ndarray, int]:
    """component_rows() with the eigenvectors as one array, samples x k."""
    values, vectors, sites = component_rows(packed, n, k, extra, tol, most, held)
    return values, np.zeros((n, len(values))) if vectors is None else vectors.whole(), sites


def component_rows(packed: DataFrame, n: int, k: int, extra: int = 6, tol: float = 1e-7, most: int = 1000, held: int = 12, rows: int = ROWS) -> tuple[np.ndarray, Tall | None, int]:
    """(eigenvalues, eigenvectors samples x k, sites used) of the Gram matrix of normalised calls, largest first.

    Randomised block Krylov iteration (Musco and Musco 2015): a thin random matrix is multiplied by the Gram matrix round
    after round, one pass over the sites each; the new columns are made orthogonal to all so far and the driver solves
    the small projected problem, until the residuals of the k pairs are below tol of the largest eigenvalue (or the space
    is exhausted; after `most` rounds it warns). Images of columns are in the space of those after them, so only the last
    ones are kept, and when the columns of `held` rounds are there the best half of their combinations replaces them
    (a thick restart). All matrices with a row a sample lie in the shared folder (see tall), some `held` times samples x
    (k + extra) numbers however many rounds; the driver has their products with one another only. Without sites that vary
    there are no eigenvectors.
    """
    spark = packed.sparkSession
    use = packed.filter("p > 0 and p < 1")
    sites = use.count()
    k = min(k, n)
    if not sites or not k:
        return np.zeros(k), None, sites
    width = min(n, k + extra)
    tasks = max(1, min(use.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism))

    def times(v: Tall, basis: list[Tall]) -> tuple[Tall, np.ndarray]:
        """The Gram matrix times v, and the products of the basis with that."""
        image = tall(spark, n, v.width, rows)

        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, total = v.columns(), np.zeros((v.width, n))
            for b in batches:
                if b.num_rows:
                    at, z, size = _normalised(b, sites)
                    _spread(z, at, size, m, total)
            for part in range(v.parts):
                for lo in range(part * rows, part * rows + v.size(part), PART):
                    y = total[:, lo : min(lo + PART, (part + 1) * rows)].T
                    if y.any():
                        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([lo - part * rows], pa.int32()), pa.array([y.tobytes()], pa.binary())], names=["part", "lo", "y"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for part, lo, y in zip(*(b.column(c).to_pylist() for c in ("part", "lo", "y"))):
                    x = total.setdefault(part, np.zeros((v.size(part), v.width)))
                    if y is not None:
                        y = np.frombuffer(y).reshape(-1, v.width)
                        x[lo : lo + len(y)] += y
            for part, x in total.items():
                image.write(part, x)
                across = np.vstack([q.read(part).T @ x for q in basis])
                yield pa.RecordBatch.from_arrays([pa.array([across.tobytes()], pa.binary())], names=["across"])

        sums = use.coalesce(tasks).mapInArrow(kernel, "part int, lo int, y binary")
        every = spark.range(v.parts).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("lo"), F.lit(None).cast("binary").alias("y"))
        found = sums.union(every).repartition(min(v.parts, 2 * tasks), "part").mapInArrow(add, "across binary").toArrow()  # a small matrix a part
        return image, sum(np.frombuffer(x.as_buffer()) for x in found["across"]).reshape(-1, v.width)

    with batches_of(spark, sites_at_once(use)):
        start = Noise("noise", n, width, rows)
        first = tall(spark, n, width, rows)
        none, gram = mix(spark, [(start, np.eye(width))], first, [])
        v = orthonormal(spark, first, [], none, gram, 1e-300, n)
        first.drop()
        basis, t = [v], np.zeros((0, 0))
        image, across = times(v, basis)
        for left in range(most, 0, -1):
            grown = np.zeros((len(across), len(across)))
            grown[: len(t), : len(t)] = t
            grown[:, len(t) :] = across
            grown[len(t) :] = across.T
            grown[len(t) :, len(t) :] = (across[len(t) :] + across[len(t) :].T) / 2
            t = grown
            values, s = (x[..., ::-1] for x in np.linalg.eigh(t))
            new = tall(spark, n, v.width, rows)
            again, gram = mix(spark, [(image, np.eye(v.width)), *split(basis, -across)], new, basis)
            image.drop()
            last = s[-v.width :, :k]
            rest = np.sqrt(np.maximum(np.einsum("ik,ij,jk->k", last, gram, last), 0))
            v = None
            if rest.max() > tol * max(values[0], 1e-300) and left > 1:
                v = orthonormal(spark, new, basis, again, gram, 1e-12 * max(values[0], 1e-300), n - len(t))
            elif left == 1 and rest.max() > tol * max(values[0], 1e-300) and n > len(t):
                warnings.warn(f"components: residual {rest.max() / values[0]:.1e} of the largest eigenvalue after {most} rounds")
            new.drop()
            if v is None:
                break
            if len(t) >= held * width:
                few = max(1, held // 2) * width
                best = tall(spark, n, few, rows)
                mix(spark, split(basis, s[:, :few]), best, [])
                for q in basis:
                    q.drop()
                basis, t = [best], np.diag(values[:few])
            basis.append(v)
            image, across = times(v, basis)
            if left % 4 == 0:  # Spark deletes the shuffle files of finished rounds once both sides have dropped their plans
                gc.collect()
                spark.sparkContext._jvm.System.gc()
        vectors = tall(spark, n, k, rows)
        mix(spark, split(basis, s[:, :k]), vectors, [])
        for q in basis:
            q.drop()
        return values[:k], vectors, sites


def turned(spark: SparkSession, vectors: Tall) -> Tall:
    """The columns with the signs that make the largest absolute number of each positive."""

    def largest(part: int) -> np.ndarray:
        x = vectors.read(part)
        return x[np.abs(x).argmax(0), np.arange(x.shape[1])]

    top = np.array(each_part(spark, vectors.parts, largest))
    sign = np.where(top[np.abs(top).argmax(0), np.arange(vectors.width)] < 0, -1.0, 1.0)
    out = tall(spark, vectors.n, vectors.width, vectors.rows)
    mix(spark, [(vectors, np.diag(sign))], out, [])
    vectors.drop()
    return out


def score_rows(spark: SparkSession, order: np.ndarray, vectors: Tall | None, values: np.ndarray) -> DataFrame:
    """(sid, pc, score): the eigenvectors times the roots of the eigenvalues; zeros where there are none."""
    ids, root, k = spark.sparkContext.broadcast(np.asarray(order, np.int64)), np.sqrt(np.maximum(values, 0)), len(values)
    shape = vectors or Tall("", len(order), k)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in b.column("id").to_pylist():
                own = ids.value[part * shape.rows : part * shape.rows + shape.size(part)]
                score = np.zeros(len(own) * k) if vectors is None else (vectors.read(part) * root).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, k)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(own))), pa.array(score)], names=["sid", "pc", "score"])

    tasks = max(1, min(shape.parts, 2 * spark.sparkContext.defaultParallelism))
    return written(spark.range(0, shape.parts, 1, tasks).mapInArrow(kernel, "sid long, pc int, score double"), "scores")


def design(scores: DataFrame, order: np.ndarray, rows: int = ROWS) -> Tall:
    """A column of ones and the components of the samples of order, from (sid, pc, score)."""
    spark, pcs = scores.sparkSession, sorted(r[0] for r in scores.select("pc").distinct().collect())  # a row a component
    sent, out = spark.sparkContext.broadcast(np.asarray(order, np.int64)), tall(spark, len(order), 1 + len(pcs), rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(sent.value, b.column("sid").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(at // rows), pa.array(at % rows), b.column("pc"), b.column("score")], names=["part", "at", "pc", "score"])

    def put(t: pa.Table) -> pa.Table:
        part = t["part"][0].as_py()
        x = np.full((out.size(part), out.width), np.nan)
        x[:, 0] = 1
        x[t["at"].to_numpy(), 1 + np.searchsorted(pcs, t["pc"].to_numpy())] = t["score"].to_numpy()
        if t.num_rows != x[:, 1:].size or np.isnan(x).any():
            raise ValueError("scores must hold one number for each sample and component")
        out.write(part, x)
        return pa.table({"part": pa.array([part], pa.int64())})

    rows_ = scores.select("sid", F.col("pc").cast("int").alias("pc"), "score").mapInArrow(place, "part long, at long, pc int, score double")
    rows_.groupBy("part").applyInArrow(put, "part long").count()
    return out


def _whole(spark: SparkSession, x: np.ndarray | Tall) -> Callable[[], np.ndarray]:
    """For tasks: the rows of x, which is sent if it is an array of the driver, else read."""
    if isinstance(x, Tall):
        return x.whole
    sent = spark.sparkContext.broadcast(x)
    return lambda: sent.value


def loadings_of(packed: DataFrame, sites: int, vectors: Tall | None, values: np.ndarray) -> DataFrame:
    """(vid, pc, loading, p): the right singular vectors, site by site."""
    root = np.sqrt(np.maximum(values, 0))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for b in batches:
            if not b.num_rows:
                continue
            m = vectors.whole() if m is None else m
            at, z, size = _normalised(b, sites)
            t = _sums(z[:, None] * m[at], size)
            k = t.shape[1]
            load = np.divide(t, root, out=np.full_like(t, np.nan), where=root > 0).ravel()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.column("vid").to_numpy(), k)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(t))), pa.array(load, from_pandas=True), pa.array(np.repeat(b.column("p").to_numpy(), k)),
            ], names=["vid", "pc", "loading", "p"])

    with batches_of(packed.sparkSession, sites_at_once(packed)):
        return written(packed.filter("p > 0 and p < 1").mapInArrow(kernel, "vid long, pc int, loading double, p double"), "loadings")


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-squares coefficients of each site, from its normal equations."""
    return np.einsum("sij,sj->si", np.linalg.pinv(a, rcond=1e-10, hermitian=True), b)


def _fits(g: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each site the least-squares coefficients of its calls on the columns of x, over the samples that are called."""
    called = (g != NONE).astype(float)
    k = x.shape[1]
    a = (called @ (x[:, :, None] * x[:, None, :]).reshape(len(x), k * k)).reshape(-1, k, k)
    return _solved(a, (np.where(g == NONE, 0, g) * called) @ x)


def kinship(packed: DataFrame, order: np.ndarray, x: np.ndarray | Tall, min_maf: float, min_kinship: float | None, block: int | None = None) -> DataFrame:
    """(i, j, kin) of pairs of samples, i < j, that have a common site; with min_kinship those at or above it.

    x: a column of ones and the components, a row a sample (see design). Each site's calls are regressed on x once. Where sites are
    called in few samples, the pairs of called samples of a site are added up by pair, which grows with the cells; where
    they are called in many, blocks of samples are multiplied, which is quadratic in samples.
    """
    n = len(order)
    c = F.octet_length("call").cast("double")
    met, sites = packed.agg(F.sum(c * (c - 1) / 2), F.count("*")).first()
    if block is None and (met or 0.0) * PAIR_COST < sites * n * n / 2:
        return kinship_of_met(packed, order, x, min_maf, min_kinship)
    return kinship_by_blocks(packed, order, x, min_maf, min_kinship, block)


def kinship_of_met(packed: DataFrame, order: np.ndarray, x: np.ndarray | Tall, min_maf: float, min_kinship: float | None, most: int = 1 << 19) -> DataFrame:
    """kinship() from the pairs of samples that meet at a site; a task holds about `most` of them."""
    spark = packed.sparkSession
    whole, ids = _whole(spark, x), spark.sparkContext.broadcast(np.asarray(order, np.int64))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = None
        for b in batches:
            if not b.num_rows:
                continue
            every = whole() if every is None else every
            at, call, size = flat(b)
            row, own = np.repeat(np.arange(len(size)), size), every[at]
            k = own.shape[1]
            beta = _solved(_sums((own[:, :, None] * own[:, None, :]).reshape(len(at), k * k), size).reshape(-1, k, k), _sums(call[:, None] * own, size))
            mu = np.einsum("ck,ck->c", own, beta[row]) / 2
            ok = (mu > min_maf) & (mu < 1 - min_maf)
            at, row, r, s = ids.value[at[ok]], row[ok], (call - 2 * mu)[ok], np.sqrt(mu[ok] * (1 - mu[ok]))
            later = np.cumsum(np.bincount(row, minlength=len(size)))[row] - np.arange(len(row)) - 1  # cells of the site after this one
            ends, lo = np.cumsum(later), 0
            while lo < len(row):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
                i = np.repeat(np.arange(lo, hi), later[lo:hi])
                j = i + 1 + np.arange(len(i)) - np.repeat(ends[lo:hi] - later[lo:hi] - ends[lo] + later[lo], later[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(at[i]), pa.array(at[j]), pa.array(r[i] * r[j]), pa.array(s[i] * s[j])], names=["i", "j", "up", "down"])
                lo = hi

    with batches_of(spark, sites_at_once(packed)):
        pairs = packed.mapInArrow(meet, "i long, j long, up double, down double").repartition("i", "j")
        pairs = pairs.groupBy("i", "j").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        kin = pairs.select("i", "j", (F.col("up") / (4 * F.col("down"))).alias("kin"))
        return written(kin if min_kinship is None else kin.filter(F.col("kin") >= min_kinship), "kinship")


def kinship_by_blocks(packed: DataFrame, order: np.ndarray, x: np.ndarray | Tall, min_maf: float, min_kinship: float | None, block: int | None = None) -> DataFrame:
    """kinship() by products of blocks.

    Every pair of sample blocks (the upper triangle) takes its two slices of all sites, batch after batch in order, and adds up the
    products of residuals and of standard deviations in two matrices of block x block. Pairs at or above min_kinship leave
    the task; pairs without a common site do not.
    """
    spark, n = packed.sparkSession, len(order)
    size = block or min(2048, max(64, -(-n // 8)))
    blocks = -(-n // size)
    whole, sent = _whole(spark, x), spark.sparkContext.broadcast(np.asarray(order, np.int64))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = None
        for b in batches:
            if not b.num_rows:
                continue
            every = whole() if every is None else every
            g = matrix(b, n)
            beta = _fits(g, every).tobytes()
            key = b.column("vid")[0].as_py()
            cut = [g[:, i * size : (i + 1) * size].tobytes() for i in range(blocks)]
            yield pa.RecordBatch.from_arrays([pa.array([key] * blocks), pa.array(range(blocks), pa.int32()), pa.array(cut, pa.binary()), pa.array([beta] * blocks, pa.binary())], names=["batch", "block", "g", "beta"])

    with batches_of(spark, CELLS // max(1, n)):
        s = written(packed.mapInArrow(slices, "batch long, block int, g binary, beta binary"), "slices")
    left, right = s.select("batch", F.col("block").alias("a"), F.col("g").alias("ga"), "beta"), s.select("batch", F.col("block").alias("b"), F.col("g").alias("gb"))
    pairs = left.join(right, "batch").filter("a <= b").select("a", "b", "batch", "ga", "gb", "beta")
    pairs = pairs.repartition(max(1, blocks * (blocks + 1) // 2), "a", "b").sortWithinPartitions("a", "b")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            a, b = now
            ids = sent.value
            first, second = ids[a * size : (a + 1) * size], ids[b * size : (b + 1) * size]
            for lo in range(0, len(first), 256):
                d = down[lo : lo + 256]
                kin = np.divide(up[lo : lo + 256], 4 * d, out=np.full_like(d, -np.inf), where=d > 0)
                ok = (d > 0) & (kin >= (-np.inf if min_kinship is None else min_kinship)) & (first[lo : lo + 256, None] < second)
                i, j = np.nonzero(ok)
                yield pa.RecordBatch.from_arrays([pa.array(first[lo + i]), pa.array(second[j]), pa.array(kin[i, j])], names=["i", "j", "kin"])

        def half(g: np.ndarray, which: int, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            mu = beta @ every[which * size : (which + 1) * size].T / 2
            ok = (g != NONE) & (mu > min_maf) & (mu < 1 - min_maf)
            return np.where(ok, g - 2 * mu, 0.0), np.sqrt(np.where(ok, mu * (1 - mu), 0.0))

        now, up, down, every = None, np.zeros((0, 0)), np.zeros((0, 0)), whole()
        for batch in batches:
            for a, b, ga, gb, beta in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ga", "gb", "beta"))):
                if (a, b) != now:
                    if now is not None:
                        yield from out()
                    now, na, nb = (a, b), min(size, n - a * size), min(size, n - b * size)
                    up, down = np.zeros((na, nb)), np.zeros((na, nb))
                fit = np.frombuffer(beta).reshape(-1, x_width)
                (ra, sa), (rb, sb) = half(np.frombuffer(ga, np.uint8).reshape(-1, na), a, fit), half(np.frombuffer(gb, np.uint8).reshape(-1, nb), b, fit)
                up += ra.T @ rb
                down += sa.T @ sb
        if now is not None:
            yield from out()

    x_width = x.width if isinstance(x, Tall) else x.shape[1]
    with batches_of(spark, 4):
        return written(pairs.mapInArrow(add, "i long, j long, kin double"), "kinship")


def linked_pairs(packed: DataFrame, sites: DataFrame, n: int, r2: float, window: int) -> DataFrame:
    """(contig, a, pa, b, pb): sites a before b (by position, then vid) within the window whose squared correlation is r2 or more.

    A pair is one row of two packed sites, met by an equality join on position bins and compared as it streams by.
    """
    at = packed.select("vid", "at", "call").join(sites.select("vid", "contig", "position").hint("merge"), "vid").withColumn("bin", F.floor(F.col("position") / window))
    left = at.select("contig", F.col("vid").alias("a"), F.col("position").alias("pa"), F.col("at").alias("ata"), F.col("call").alias("ca"), F.explode(F.array("bin", F.col("bin") + 1)).alias("bin"))
    right = at.select("contig", F.col("vid").alias("b"), F.col("position").alias("pb"), F.col("at").alias("atb"), F.col("call").alias("cb"), "bin")
    near = left.join(right.hint("merge"), ["contig", "bin"]).filter((F.col("pb") - F.col("pa")).between(0, window) & ((F.col("pa") < F.col("pb")) | (F.col("a") < F.col("b"))))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rows = np.arange(b.num_rows, dtype=np.int64) * n
            (x, cx, nx), (y, cy, ny) = flat(b, "ata", "ca"), flat(b, "atb", "cb")
            x, y = np.repeat(rows, nx) + x, np.repeat(rows, ny) + y
            to = np.minimum(np.searchsorted(x, y), len(x) - 1)
            both = x[to] == y
            row, x, y = y[both] // n, cx[to[both]].astype(float), cy[both].astype(float)
            m, sx, sy, xy, xx, yy = (np.bincount(row, v, len(rows)) for v in (np.ones(len(row)), x, y, x * y, x * x, y * y))
            cov, vx, vy = m * xy - sx * sy, m * xx - sx * sx, m * yy - sy * sy
            ok = (vx > 0) & (vy > 0)
            ok[ok] = cov[ok] * cov[ok] / (vx[ok] * vy[ok]) >= r2
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("contig", "a", "pa", "b", "pb")], names=["contig", "a", "pa", "b", "pb"]).filter(pa.array(ok))

    with batches_of(packed.sparkSession, sites_at_once(packed)):
        return written(near.select("contig", "a", "pa", "b", "pb", "ata", "ca", "atb", "cb").mapInArrow(keep, "contig string, a long, pa long, b long, pb long"), "linked")


def meetings(cells: DataFrame, sites: DataFrame, window: int) -> tuple[float, float]:
    """(pairs of sites, pairs of cells of a sample) in the same or the next bin of the window's size, as linked_pairs and linked_by_cells would meet them."""
    at = cells.join(sites.select("vid", "contig", F.floor(F.col("position") / window).alias("bin")).hint("merge"), "vid")

    def pairs(keys: list[str], counted: DataFrame) -> float:
        n = counted.groupBy(*keys, "bin").agg(F.count("*").cast("double").alias("n"))
        n = n.select(*keys, F.explode(F.array(F.struct("bin", "n", F.lit(0.0).alias("before")), F.struct((F.col("bin") + 1).alias("bin"), F.lit(0.0).alias("n"), F.col("n").alias("before")))).alias("x"))
        n = n.groupBy(*keys, "x.bin").agg(F.sum("x.n").alias("n"), F.sum("x.before").alias("before"))
        return n.agg(F.sum(F.col("n") * (F.col("n") + F.col("before")))).first()[0] or 0.0

    return pairs(["contig"], at.select("vid", "contig", "bin").distinct()), pairs(["sid", "contig"], at)


def linked_by_cells(cells: DataFrame, sites: DataFrame, r2: float, window: int) -> DataFrame:
    """linked_pairs() from the pairs of cells of a sample, added up by pair of sites: sites without a common sample never meet.

    Tables that grow with the sites are merged, here and where the walk is made: as files they may look small enough to be broadcast.
    """
    place = sites.select("vid", "contig", "position")
    at = cells.join(place.hint("merge"), "vid").withColumn("bin", F.floor(F.col("position") / window))
    left = at.select("sid", "contig", F.col("vid").alias("a"), F.col("position").alias("pa"), F.col("n_alt").alias("x"), F.explode(F.array("bin", F.col("bin") + 1)).alias("bin"))
    right = at.select("sid", "contig", F.col("vid").alias("b"), F.col("position").alias("pb"), F.col("n_alt").alias("y"), "bin")
    near = left.join(right.hint("merge"), ["sid", "contig", "bin"]).filter((F.col("pb") - F.col("pa")).between(0, window) & ((F.col("pa") < F.col("pb")) | (F.col("a") < F.col("b"))))
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    sums = {"m": F.lit(1.0), "sx": x, "sy": y, "xy": x * y, "xx": x * x, "yy": y * y}
    s = near.groupBy("a", "b").agg(*[F.sum(v).alias(k) for k, v in sums.items()]).filter("m > 1")
    s = s.select("a", "b", F.expr("m * xy - sx * sy").alias("cov"), F.expr("m * xx - sx * sx").alias("vx"), F.expr("m * yy - sy * sy").alias("vy"))
    s = s.filter((F.col("vx") > 0) & (F.col("vy") > 0)).filter(F.col("cov") * F.col("cov") / (F.col("vx") * F.col("vy")) >= r2).select("a", "b")
    s = s.join(place.select(F.col("vid").alias("a"), "contig", F.col("position").alias("pa")).hint("merge"), "a").join(place.select(F.col("vid").alias("b"), F.col("position").alias("pb")).hint("merge"), "b")
    return written(s.select("contig", "a", "pa", "b", "pb"), "linked")


def first_choice(linked: DataFrame, segment: int = 4096) -> DataFrame:
    """(vid) of the sites that a walk in order of position drops: those with an earlier linked site that stays.

    Sites are numbered along their contig and cut into segments of so many. In a round every segment walks its own
    undecided sites: a site goes if an earlier neighbour is known to stay, stays if all are known to go, and else waits
    for the next round, in which the segments before it have decided more. So the result is that of the walk, no task
    holds more than a segment's pairs, and rounds end when dependencies do (the first open segment always finishes).
    """
    nodes = linked.select("contig", F.col("a").alias("vid"), F.col("pa").alias("position")).union(linked.select("contig", "b", "pb")).distinct()
    rank = stratified_rank(nodes, ["contig"], "position", "vid").join(linked.select(F.col("b").alias("vid")).distinct().withColumn("late", F.lit(True)).hint("merge"), "vid", "left")
    rank = written(rank.select("vid", "rank", F.floor(F.col("rank") / segment).alias("segment"), F.coalesce("late", F.lit(False)).alias("late")), "order")
    p = linked.select("contig", "a", "b").join(rank.select(F.col("vid").alias("a"), F.col("late").alias("a_late"), F.col("rank").alias("ra")).hint("merge"), "a")
    p = written(p.join(rank.select(F.col("vid").alias("b"), F.col("rank").alias("rb"), "segment").hint("merge"), "b").select("contig", "segment", "a", "a_late", "ra", "b", "rb"), "pairs")
    total = p.select("b").distinct().count()
    done = written(p.select(F.col("b").alias("vid"), F.lit(False).alias("gone")).limit(0), "decided")

    def walk(table: pa.Table) -> pa.Table:
        t = table.sort_by([("rb", "ascending"), ("ra", "ascending")])
        state: dict[int, bool | None] = {}
        b, seen = None, []

        def close() -> None:
            if b is not None:
                state[b] = True if any(s is False for s in seen) else False if all(seen) else None

        for a, late, gone, nb in zip(*(t[c].to_pylist() for c in ("a", "a_late", "gone", "b"))):
            if nb != b:
                close()
                b, seen = nb, []
            seen.append(False if not late else state[a] if a in state else gone)
        close()
        known = [(v, g) for v, g in state.items() if g is not None]
        return pa.table({"vid": pa.array([v for v, _ in known], pa.int64()), "gone": pa.array([g for _, g in known], pa.bool_())})

    found = 0
    while found < total:
        state = done.select(F.col("vid").alias("a"), "gone")
        open_ = p.join(done.select(F.col("vid").alias("b")).hint("merge"), "b", "left_anti").join(state.hint("merge"), "a", "left")
        done = written(done.unionByName(open_.groupBy("contig", "segment").applyInArrow(walk, "vid long, gone boolean")), "decided")
        found = done.count()
    return done.filter("gone").select("vid")
