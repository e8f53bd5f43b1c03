from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
import pytest

from gridloom.llm import packing, token_index
from gridloom.llm.bpe import PieceEncoder, default_tokenizer
from gridloom.llm.common import scratch_path

from .cases import docs, rows


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda s: [*t.encode(s or "", add_special_tokens=False).ids, 2]


def test_pieces_are_exact(exact):
    e = PieceEncoder(default_tokenizer(), max_entries=50)
    texts = [r[1] for r in rows()] + ["a\n\nb\n", "a.\nB c!! d's 'll it's\nx", "12,3 4.5%%% e$$$\nq", "a\tb c\n\td", " lead", "trail ", "a\x1cb \x1c c", "　 x", "\n", " ", "é   x", "!! ,, .."]
    for _ in range(2):
        assert [array("I", x).tolist() for x in e.encode_many(texts)] == [exact(t)[:-1] for t in texts]


def test_shards_round_trip(spark, exact, tmp_path):
    """Every document is read back through directory, index and payload alone."""
    folder = tmp_path.as_uri()
    m = token_index.write_shards(docs(spark), folder, shard_ids=500)
    back = token_index.read_back(folder, m).join(token_index.directory(spark, folder).select("shard_no", "base"), "shard_no").collect()
    want = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in rows()))
    got = sorted(back, key=lambda r: r["base"] + r["at"])
    assert len({r["shard"] for r in got}) > 1
    reader, at, seen = token_index.KeyedReader(folder), 0, {}
    for (known, doc_id, text), r in zip(want, got, strict=True):
        ids, key = exact(text), doc_id if known else None
        assert (r["base"] + r["at"], r["n_read"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        assert reader.get(key, seen.get(key, 0)).tolist() == ids
        seen[key] = seen.get(key, 0) + 1
        at += len(ids)
    assert reader.get(987654) is None and reader.get(1, 5) is None and reader.get(-3) is None


def test_index_is_minimal_and_perfect():
    for n in (0, 1, 2, 7, 3000):
        h = token_index.key_hash(list(range(n)), [0] * n)
        pilots, place = token_index.build_index(h)
        assert sorted(place.tolist()) == list(range(n))


def _check_packing(p, want):
    got = {}
    for r in p:
        got.setdefault((r["doc_id"], r["ids_crc32"], r["start"], r["length"]), []).append(r)
    assert sorted((k[0] is not None, k[0] or 0, *k[1:]) for k, v in got.items() for _ in v) == sorted((k[0] is not None, k[0] or 0, *k[1:]) for k in want)
    at = {}
    for r in sorted(p, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    return at


def test_packing(spark, exact):
    want = []
    for r in rows():
        ids = exact(r[1])
        n, k = len(ids), -(-len(ids) // 64)
        cuts = [0, *range(n - 64 * (k - 1), n + 1, 64)]
        want += [(r[0], zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b])), a, b - a) for a, b in zip(cuts, cuts[1:])]
    p = packing.pack(docs(spark), 64, block_rows=3).collect()
    at = _check_packing(p, want)
    assert max(at.values()) <= 64
    assert len(at) <= 1.03 * sum(w[3] for w in want) / 64 + 2


def test_plan_covers_demand_near_the_bound():
    rng = np.random.default_rng(0)
    lengths = list(range(1, 257))
    demand = rng.integers(0, 40, 256) + 1
    chosen = packing.plan(lengths, demand.tolist(), 256)
    assert all(sum(c) <= 256 for c, _ in chosen)
    for length, n in zip(lengths, demand):
        assert sum(c.count(length) * t for c, t in chosen) == n
    assert sum(t for _, t in chosen) <= 1.02 * (np.array(lengths) @ demand) / 256 + 1


@pytest.mark.parametrize(("n", "most"), [(1_000, 0.015), (10_000, 0.006)])
def test_program_carries_the_result(n, most):
    """Demands like those of short documents: the program covers them near its bound and best-fit alone is not better."""
    rng = np.random.default_rng(3)
    size, demand = np.unique(np.clip(rng.lognormal(5.9, 0.8, n).astype(int), 4, 1023), return_counts=True)
    size, demand = size[::-1], demand[::-1]
    configs, x, bound = packing.solve(size, demand, 1024)
    covered = np.zeros(len(size))
    for (used, counts), times in zip(configs, x):
        assert size[used] @ counts <= 1024
        covered[used] += counts * times
    assert (covered >= demand - 1e-6).all() and bound <= x.sum() <= (1 + most) * bound
    total = sum(t for _, t in packing.plan(size.tolist(), demand.tolist()))
    assert np.floor(x + 1e-9).sum() > 0.5 * total
    assert total <= sum(t for _, t in packing.best_fit(size, demand, 1024))


def test_priced_configuration_is_the_best():
    size, prices = np.array([9, 7, 5, 4]), np.array([0.95, 0.7, 0.58, 0.4])
    best = max(np.dot(c, prices) for c in np.ndindex(3, 4, 5, 6) if np.dot(c, size) <= 20)
    price, used, counts = packing.priced_configurations(size, prices, np.full(4, 50.0), 20, 0.01)[0]
    assert price == pytest.approx(best) and size[used] @ counts <= 20
    value, _ = packing.knapsack(size, prices, 20)
    assert value[20] == pytest.approx(best)


def test_empty(spark):
    e = docs(spark, [])
    assert packing.pack(e).count() == 0
    folder = scratch_path(spark, "none")
    if "://" not in folder:
        folder = "file://" + folder
    assert token_index.write_shards(e, folder).count() == 0
    assert token_index.KeyedReader(folder).get(1) is None
