from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import hard_negatives as H
from gridloom.llm.queries import LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows):
    """(anchor, positive, rank, negative, scores), every pair of an anchor and a row looked at."""
    able = []
    for i, (v, x, label) in enumerate(rows):
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        able.append((i, v, (label + 1) % 10 if v is not None and v % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in x]))
    size = Counter(len(a[3]) for a in able).most_common(1)[0][0] if able else 0
    able = [a for a in able if len(a[3]) == size]
    out = []
    for i, v, label, x in able:
        if v is None or v % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), w is None, w or 0, j, other) for j, w, other, y in able if j != i))
        for ps, pnull, p, _, _ in [s for s in scored if s[4] == label][:5]:
            good = [s for s in scored if s[4] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out += [(v, None if pnull else p, r, None if s[1] else s[2], -ps, -s[0]) for r, s in enumerate(good, 1)]
    return Counter(out)


def made(seed, n, dim, scale=1.0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)) * scale
    x[n // 3 : 2 * n // 3] = x[0]  # a third of all rows are copies
    x[2 * n // 3 : 3 * n // 4] = x[5] + 0.1 * r.normal(size=(3 * n // 4 - 2 * n // 3, dim))
    rows = [(i * 5, [float(np.float32(c)) for c in v], int(k)) for i, (v, k) in enumerate(zip(x, r.integers(0, 4, n)))]
    odd = [(1000, None, 1), (1100, [1.0] * dim, None), (1200, [float("nan")] + [1.0] * (dim - 1), 1), (1300, [None] + [1.0] * (dim - 1), 1), (1400, [1.0], 1), (None, rows[3][1], 2), (None, rows[0][1], 1), (1500, [0.0] * dim, 2), (1500, [0.0] * dim, 2)]
    return rows + odd + rows[40:45]


@pytest.mark.parametrize("seed,n,dim,scale", [(1, 300, 6, 1.0), (2, 420, 3, 30.0), (3, 60, 12, 0.01)])
def test_query_against_all_pairs(spark, tmp_path, seed, n, dim, scale):
    rows = made(seed, n, dim, scale)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = LLM_QUERIES["op12_hard_negatives"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    want = slow(rows)
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 5


def test_small_blocks_and_chunks(spark):
    rows = made(4, 300, 4)
    table = H.integers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    got = H.hard_negatives(table, pivots=20, regions=3, block=2, chunk=17)
    assert Counter(tuple(r) for r in got.collect()) == slow(rows)


def test_bounds_keep_clustered_vectors_apart(spark):
    r = np.random.default_rng(9)
    centres = r.normal(size=(12, 8)) * 5
    rows = [(i, (centres[i % 12] + 0.1 * r.normal(size=8)).tolist(), i % 24 // 12) for i in range(1200)]
    table, most = H.dealt(H.integers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0), 24, 12)
    anchors = table.filter("anchor")
    t = anchors.join(H.radii(table, anchors, 5), "rid").select("label", "region", "t", F.posexplode("away").alias("cell", "a"))
    bounds = t.groupBy("label", "region", "cell").agg(F.min(F.col("a") - F.col("t")).alias("low"), F.max(F.col("a") + F.col("t")).alias("high"))
    regions = anchors.select("region").distinct().count()
    n = H._copied(table, bounds, ["label", "cell"], {}, 1).count()
    assert regions >= 4 and n < 0.5 * regions * table.count()


def test_large_components_stay_exact(spark):
    rows = [(i * 50, [float(2**21 + i), 1.0 + i, -3.0], i % 2) for i in range(12)]
    table = H.integers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    assert Counter(tuple(r) for r in H.hard_negatives(table).collect()) == slow(rows)


def test_cases(spark):
    for rows in ([], [(100, [1.0, 2.0], 1)], [(100, None, 1), (200, None, None)]):
        d = spark.createDataFrame(rows, SCHEMA).withColumns({"rid": F.lit(1), "region": F.lit("x"), "q": F.lit(2)})
        assert H.hard_negatives(H.integers(d, F.col("vec_id") % 100 == 0)).count() == 0
