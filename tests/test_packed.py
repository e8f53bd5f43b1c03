"""Components, kinship and linkage over packed cells, against numpy and a walk in order."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from gridloom.operators import packed, popgen
from gridloom.plans.catalogue import QUERIES
from gridloom.plans.views import view


def cohort(n_sites, n_samples, seed, missing=0.05, groups=3):
    """Calls of a cohort of a few populations with some relatives; -1 is no call."""
    r = np.random.default_rng(seed)
    p = np.clip(r.uniform(0.05, 0.95, n_sites)[:, None] + 0.15 * r.normal(size=(n_sites, groups)), 0.02, 0.98)
    g = r.binomial(2, p[:, np.arange(n_samples) % groups])
    for j in range(0, n_samples - 3, 10):  # a child of two
        g[:, j + 2] = r.binomial(1, g[:, j] / 2) + r.binomial(1, g[:, j + 1] / 2)
    return np.where(r.random(g.shape) < missing, -1, g)


def entries(spark, g):
    return spark.createDataFrame([(int(i), int(j), None if g[i, j] < 0 else int(g[i, j])) for i, j in np.ndindex(*g.shape)], "vid long, sid long, n_alt int")


def normalised(g):
    called = g >= 0
    p = np.where(called, g, 0).sum(1) / (2 * np.maximum(called.sum(1), 1))
    ok = (p > 0) & (p < 1)
    return np.where(called, (g - 2 * p[:, None]) / np.sqrt(ok.sum() * 2 * p * (1 - p))[:, None], 0)[ok] if ok.any() else np.zeros((0, g.shape[1]))


def test_components(spark):
    with np.errstate(divide="ignore", invalid="ignore"):
        g = cohort(400, 90, 1)
        g[5] = 0
        z = normalised(g)
    values, scores, loadings = popgen.pca(entries(spark, g), 4)
    w, v = np.linalg.eigh(z.T @ z)
    assert values == pytest.approx(w[::-1][:4].tolist(), abs=1e-6 * w[-1])
    s = np.zeros((90, 4))
    for r in scores.collect():
        s[r["sid"], r["pc"]] = r["score"]
    for c in range(4):
        assert abs(s[:, c] @ v[:, -1 - c]) == pytest.approx(np.sqrt(w[-1 - c]), rel=1e-6)
    load = np.zeros((400, 4))
    for r in loadings.collect():
        load[r["vid"], r["pc"]] = r["loading"]
    load = np.delete(load, 5, 0)
    assert np.allclose(load.T @ load, np.eye(4), atol=1e-6) and np.allclose(z.T @ load, s, atol=1e-6)


def test_components_of_small_and_empty_tables(spark):
    e = entries(spark, np.array([[0, 1], [2, 1], [1, 1]]))
    values, scores, _ = popgen.pca(e, 5)
    assert len(values) == 2 and scores.count() == 4
    for few in (e.limit(0), e.filter("vid = 2 and sid = 9")):
        values, scores, loadings = popgen.pca(few, 3)
        assert values == [] and scores.count() == 0 and loadings.count() == 0


def test_projection_of_relateds(spark):
    g = cohort(300, 40, 2, missing=0)
    e = entries(spark, g)
    out = popgen.pca_with_relateds(e, spark.createDataFrame([(i,) for i in (2, 12, 22)], "sid long"), 2)
    got = {(r["sid"], r["pc"]): r["score"] for r in out.collect()}
    assert len(got) == 80
    keep = [j for j in range(40) if j not in (2, 12, 22)]
    _, scores, loadings = popgen.pca(e.filter("sid not in (2, 12, 22)"), 2)
    own = {(r["sid"], r["pc"]): r["score"] for r in scores.collect()}
    assert all(got[j, c] == pytest.approx(own[j, c], abs=1e-8) for j in keep for c in range(2))
    load = {(r["vid"], r["pc"]): (r["loading"], r["p"]) for r in loadings.collect()}
    sites = [v for v in range(300) if (v, 0) in load]
    want = sum((g[v, 12] - 2 * load[v, 0][1]) / np.sqrt(len(sites) * 2 * load[v, 0][1] * (1 - load[v, 0][1])) * load[v, 0][0] for v in sites)
    assert got[12, 0] == pytest.approx(want)


def slow_kinship(g, x, min_maf):
    """Residuals site by site, then all pairs."""
    n = g.shape[1]
    up, down = np.zeros((n, n)), np.zeros((n, n))
    for row in g:
        c = row >= 0
        if not c.any():
            continue
        mu = x @ np.linalg.lstsq(x[c], row[c], rcond=None)[0] / 2
        ok = c & (mu > min_maf) & (mu < 1 - min_maf)
        r, s = np.where(ok, row - 2 * mu, 0), np.where(ok, np.sqrt(np.where(ok, mu * (1 - mu), 0)), 0)
        up += np.outer(r, r)
        down += np.outer(s, s)
    return up, down


@pytest.mark.parametrize("block", [None, 37])
def test_kinship(spark, block):
    g = cohort(250, 300, 3)
    e = entries(spark, g)
    x = np.column_stack([np.ones(300), np.random.default_rng(0).normal(size=(300, 2))])
    scores = spark.createDataFrame([(i, c, float(x[i, c + 1])) for i in range(300) for c in range(2)], "sid long, pc int, score double")
    up, down = slow_kinship(g, x, 0.05)
    got = {(r["i"], r["j"]): r["kin"] for r in popgen.pc_relate(e, scores, 0.05, block=block).collect()}
    assert set(got) == {(i, j) for i in range(300) for j in range(i + 1, 300) if down[i, j] > 0}
    assert all(k == pytest.approx(up[i, j] / (4 * down[i, j]), abs=1e-9) for (i, j), k in got.items())
    few = {(r["i"], r["j"]) for r in popgen.pc_relate(e, scores, 0.05, min_kinship=0.1, block=block).collect()}
    assert few == {p for p, k in got.items() if k >= 0.1} and (0, 2) in few


def test_kinship_of_few_calls(spark):
    """Sites called in few of many samples: pairs that meet, as by blocks, and packed rows no wider than their calls."""
    r = np.random.default_rng(6)
    g = np.full((60, 2000), -1)
    for row in g:
        row[r.choice(2000, 12, replace=False)] = r.integers(0, 3, 12)
    g[:20, 7], g[:20, 9] = r.integers(0, 3, 20), r.integers(0, 3, 20)
    e = spark.createDataFrame([(int(i), int(j), int(g[i, j])) for i, j in np.argwhere(g >= 0)], "vid long, sid long, n_alt int")
    order = packed.sample_order(e)
    x = np.column_stack([np.ones(len(order)), np.random.default_rng(0).normal(size=(len(order), 1))])
    cells = packed.pack(e, order)
    assert max(len(c["at"]) + len(c["call"]) for c in cells.collect()) <= 5 * 14
    up, down = slow_kinship(g[:, order], x, 0.05)
    want = {(order[i], order[j]): up[i, j] / (4 * down[i, j]) for i, j in zip(*np.nonzero(np.triu(down, 1)))}
    for out in (packed.kinship(cells, order, x, 0.05, None), packed.kinship_of_met(cells, order, x, 0.05, None, most=30), packed.kinship_by_blocks(cells, order, x, 0.05, None)):
        got = {(k["i"], k["j"]): k["kin"] for k in out.collect()}
        assert set(got) == set(want) and all(v == pytest.approx(want[p], abs=1e-9) for p, v in got.items())


def test_components_of_few_calls(spark):
    r = np.random.default_rng(8)
    g = np.full((300, 400), -1)
    for row in g:
        row[r.choice(400, 9, replace=False)] = r.integers(0, 3, 9)
    z = normalised(g)
    e = spark.createDataFrame([(int(i), int(j), int(g[i, j])) for i, j in np.argwhere(g >= 0)], "vid long, sid long, n_alt int")
    values, scores, _ = popgen.pca(e, 3)
    assert values == pytest.approx(np.linalg.eigvalsh(z.T @ z)[::-1][:3].tolist(), rel=1e-6)
    s = np.zeros((400, 3))
    for k in scores.collect():
        s[k["sid"], k["pc"]] = k["score"]
    assert np.allclose(z.T @ (z @ s), s * values, atol=1e-5 * values[0])
    cells = packed.pack(e, packed.sample_order(e))
    again, vectors, _ = packed.components(cells, 400, 3, held=3)  # with restarts
    assert again.tolist() == pytest.approx(values, rel=1e-9) and np.allclose(vectors.T @ vectors, np.eye(3))
    with pytest.warns(UserWarning, match="after 2 rounds"):
        assert packed.components(cells, 400, 3, most=2)[1].shape == (400, 3)


def test_components_lie_outside_the_driver(spark):
    """Matrices of several files give the components; of 150,000 samples the driver holds little more than the ids."""
    g = cohort(200, 90, 11)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = normalised(g)
    e = entries(spark, g).filter("n_alt is not null")
    values, vectors, _ = packed.component_rows(packed.pack(e, np.arange(90)), 90, 4, rows=17)
    assert vectors.parts == 6 and values == pytest.approx(np.linalg.eigvalsh(z.T @ z)[::-1][:4], rel=1e-9)
    v = vectors.whole()
    assert np.allclose(v.T @ v, np.eye(4)) and np.allclose(z.T @ (z @ v), v * values, atol=1e-6 * values[0])
    n = 150_000
    many = spark.range(n).selectExpr("id % 30 as vid", "id as sid", "cast(hash(id) % 3 + 2 as int) % 3 as n_alt")
    more = spark.range(n).selectExpr("id * 7 % 30 as vid", "id as sid", "cast(hash(id, 1) % 3 + 2 as int) % 3 as n_alt")
    many = many.union(more.filter("vid <> sid % 30"))
    tracemalloc.start()
    try:
        _, scores, _ = popgen.pca(many, 4)
        packed.design(scores, packed.sample_order(scores))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert scores.count() == 4 * n and peak < 16 << 20  # a matrix of 10 columns has 12 MB


def slow_prune(g, position, contig, r2, window):
    gone = set()
    order = sorted(range(len(g)), key=lambda v: (position[v], v))
    for t, b in enumerate(order):
        for a in order[:t]:
            if contig[a] == contig[b] and position[b] - position[a] <= window and a not in gone:
                both = (g[a] >= 0) & (g[b] >= 0)
                x, y = g[a][both].astype(float), g[b][both].astype(float)
                if len(x) and x.var() > 0 and y.var() > 0 and np.cov(x, y, bias=True)[0, 1] ** 2 / (x.var() * y.var()) >= r2:
                    gone.add(b)
                    break
    return set(range(len(g))) - gone


@pytest.mark.parametrize("segment", [4096, 3])
def test_pruning_is_the_walk_in_order(spark, segment, monkeypatch):
    r = np.random.default_rng(4)
    g = cohort(120, 30, 5)
    for v in range(1, 120):  # chains of sites that resemble the one before
        if r.random() < 0.7:
            g[v] = np.where(r.random(30) < 0.8, g[v - 1], g[v])
    position, contig = [int(x) for x in r.integers(0, 3000, 120)], [f"chr{x}" for x in r.integers(1, 3, 120)]
    for v in range(0, 120, 10):
        position[v] = position[v - 1]
    sites = spark.createDataFrame([(v, contig[v], position[v]) for v in range(120)], "vid long, contig string, position long")
    walk = packed.first_choice
    monkeypatch.setattr(packed, "first_choice", lambda linked: walk(linked, segment))
    kept = {x["vid"] for x in popgen.ld_prune(entries(spark, g), sites, 0.2, 900).collect()}
    assert kept == slow_prune(g, position, contig, 0.2, 900) and 10 < len(kept) < 110


def test_cells_that_meet_link_the_same_sites(spark):
    """Few calls of many samples: joined cells and compared sites give the same pairs, and the walk over them."""
    r = np.random.default_rng(9)
    g = np.full((150, 400), -1)
    for v, row in enumerate(g):
        row[r.choice(40, 8, replace=False) if v % 2 else r.choice(400, 10, replace=False)] = 0
    g = np.where(g < 0, -1, r.integers(0, 3, g.shape))
    position, contig = [int(x) for x in r.integers(0, 5000, 150)], [f"chr{x}" for x in r.integers(1, 3, 150)]
    position[20:30] = position[10:20]
    e = spark.createDataFrame([(int(i), int(j), int(g[i, j])) for i, j in np.argwhere(g >= 0)], "vid long, sid long, n_alt int")
    sites = spark.createDataFrame([(v, contig[v], position[v]) for v in range(150)], "vid long, contig string, position long")
    of_sites, of_cells = packed.meetings(e, sites, 2000)
    assert 0 < of_cells < of_sites
    order = packed.sample_order(e)
    pairs = [{tuple(x) for x in d.select("contig", "a", "pa", "b", "pb").collect()} for d in (packed.linked_by_cells(e, sites, 0.3, 2000), packed.linked_pairs(packed.pack(e, order), sites, len(order), 0.3, 2000))]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 20
    kept = {x["vid"] for x in popgen.ld_prune(e, sites, 0.3, 2000).collect()}
    assert kept == slow_prune(g, position, contig, 0.3, 2000) and len(kept) < 150


def test_pruning_query_reaches_a_million_bases(spark, sf_dir):
    """Sites of sf0.001 that are linked to one more than 2,000 bases before them go as well."""
    cells = view(spark, sf_dir, "v_sparse").select("vid", "sid", "n_alt").collect()
    rows = view(spark, sf_dir, "v_variants").select("vid", "contig", "position").collect()
    at, sid = {x["vid"]: i for i, x in enumerate(rows)}, {s: i for i, s in enumerate({c["sid"] for c in cells})}
    g = np.full((len(rows), len(sid)), -1)
    for c in cells:
        if c["vid"] in at:
            g[at[c["vid"]], sid[c["sid"]]] = c["n_alt"]
    by = lambda window: {rows[i]["vid"] for i in slow_prune(g, [x["position"] for x in rows], [x["contig"] for x in rows], 0.1, window)}
    kept = {x["vid"] for x in QUERIES["ld_prune"](spark, sf_dir).collect()}
    assert kept == by(1_000_000) and len(kept) < len(by(2_000))
