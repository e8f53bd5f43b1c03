from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from gridloom.llm import periodic_runs as P
from gridloom.llm.queries import LLM_QUERIES

from .cases import docs, rows


def slow_runs(w, least=6, exponent=4):
    """Every period, every maximal stretch; a stretch that already has a smaller period is not counted again."""
    seen = {}
    for p in range(1, len(w)):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i + p - s >= 2 * p and not any(a <= s and i + p <= b for a, b in seen):
                seen[s, i + p] = p
            i += 1
    return sorted((s, e - s, p) for (s, e), p in seen.items() if e - s >= max(least, exponent * p))


def slow_edit(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def slow_row(doc_id, text):
    w = slow_edit(doc_id, [x for x in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if x])
    runs = slow_runs(w)
    best = min(runs, key=lambda r: (-(r[1] * 10**6 // r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = [*best, best[1] * 1000 // best[2]] if best else [None] * 4
    return [len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))]


def texts():
    r = random.Random(2)
    out = [(i, x[1]) for i, x in enumerate(rows())]
    for i in range(300):
        k, n = r.choice([1, 2, 3, 30]), r.randint(0, 70)
        out.append((1000 + i, r.choice(["", " "]) + r.choice([" ", "\n", "\t \v"]).join(r.choice("abcdefghijklmnopqrstuvwxyzäöüßABCDEF"[:k]) for _ in range(n))))
    out += [(5000, "a b c " * 300), (5001, "x " * 2000), (5002, " ".join(f"u{i}" for i in range(900)) + " " + " ".join(f"v{i % 200}" for i in range(900))), (5003, "a b a b a b a b c a b a b a b a b")]
    return out


def test_runs_against_all_periods():
    r = random.Random(5)
    for _ in range(1500):
        w = slow_edit(r.randrange(10**6), [r.randrange(r.choice([1, 2, 2, 3, 5])) for _ in range(r.randint(0, 50))])
        for exponent in (2, 3, 4):
            assert P.runs_of(w, 6, exponent) == slow_runs(w, 6, exponent), w


def test_collisions_cost_no_truth(monkeypatch):
    monkeypatch.setattr(P, "MOD", 7)  # nearly all hashes agree
    r = random.Random(6)
    for _ in range(400):
        w = [r.randrange(2) for _ in range(r.randint(0, 30))] * r.randint(1, 4)
        assert P.runs_of(w, 6, 2) == slow_runs(w, 6, 2), w


def test_work_stays_near_linear(monkeypatch):
    n, old = [0], P.Extensions.right
    monkeypatch.setattr(P.Extensions, "right", lambda self, i, j: n.__setitem__(0, n[0] + 1) or old(self, i, j))
    for w in (["a"] * 20_000, ["a", "b", "c"] * 7_000):
        n[0] = 0
        assert len(P.runs_of(w, 6, 4)) == 1 and n[0] < 10 * len(w)


def test_query(spark, tmp_path):
    spark.createDataFrame(texts(), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = LLM_QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    by = {r[0]: list(r[1:]) for r in got.collect()}
    assert len(by) == len(texts())
    for i, t in texts():
        assert by[i] == slow_row(i, t), (i, t)
    assert sum(v[0] > 0 for v in by.values()) > 50


def test_cases(spark):
    d = docs(spark).withColumnsRenamed({"size": "runs", "start": "__text"})
    out = P.periodic_runs(d)
    assert out.count() == d.count() and out.columns == [c for c in d.columns if c != "runs"] + list(P.ADDED)
    assert out.filter("text is null and (n_words <> 0 or collapsed_text <> '')").count() == 0
    assert P.planted(d).count() == d.count()
    assert P.periodic_runs(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(d, exponent=1)
