from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from xxhash import xxh64_intdigest

from gridloom.llm import bucket_digest, line_dedup, simhash, vector_dedup
from gridloom.llm.common import components, cut

from .cases import docs, rows


def closure(nodes, links):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7), (None, 3)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == closure({x for e in real for x in e}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(t):
    w = [x for x in (t or "").encode().lower().split()]
    if not w:
        return 0
    s = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_simhash_classes(spark):
    d = docs(spark)
    got = simhash.classes(d).collect()
    assert sorted((r["fp"] & (2**64 - 1)) for r in got) == sorted(slow_fingerprint(r[1]) for r in rows())
    fps = defaultdict(list)
    for r in rows():
        fps[slow_fingerprint(r[1])].append(r[0])
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    label = closure(fps, links)
    least = defaultdict(list)
    for f, ids in fps.items():
        least[label[f]] += [i for i in ids if i is not None]
    none = lambda x: -1 if x is None else x
    want = [(none(r[0]), min(least[label[slow_fingerprint(r[1])]], default=-1)) for r in rows()]
    assert sorted((none(r["doc_id"]), none(r["component_id"])) for r in got) == sorted(want)
    kept = simhash.keep_one(d)
    assert kept.count() == len(set(label.values())) and kept.columns == d.columns


def test_simhash_links_of_dense_groups(spark):
    """Clouds of fingerprints around centres: components over the index are those of all pairs."""
    r = random.Random(5)
    fps = set()
    for _ in range(6):
        c = r.getrandbits(64)
        for _ in range(80):
            x = c
            for b in r.sample(range(64), r.randint(0, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(300)}
    want = closure(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    signed = lambda x: x - 2**64 if x >> 63 else x
    got = {x["fp"]: x["component"] for x in simhash.linked_components(spark.createDataFrame([(signed(x),) for x in fps], "fp long")).collect()}
    groups = lambda m: sorted(sorted(g) for g in _groups(m).values() if len(g) > 1)
    assert groups(got) == groups({signed(k): v for k, v in want.items()})


def _groups(m):
    out = defaultdict(list)
    for k, v in m.items():
        out[v].append(k)
    return out


def test_digests(spark):
    d = docs(spark)
    got = bucket_digest.fingerprint_with_edits(d).collect()
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    by = defaultdict(list)
    for r, n in zip(order, order[1:] + order[:1]):
        t, u = r[1] or "", n[1] or ""
        by[r[0]].append((len(t), bucket_digest.digest(t), bucket_digest.digest(t[: len(t) - len(t) // 2] + u[: len(t) // 2])))
    have = defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["n_chars"], r["fingerprint"], r["edited_fingerprint"]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in by.items()}
    assert bucket_digest.fingerprint_with_edits(docs(spark, [])).count() == 0
    assert bucket_digest.fingerprint_with_edits(docs(spark, rows()[:1])).first()["near_next"] == 1.0


def _shingles(line):
    """One shingle at every character, by slicing."""
    k = line_dedup.WIDTH
    return {line[i : i + k] for i in range(max(1, len(line) - k + 1))}


def similar_lines(lines, threshold=0.8):
    """All pairs of line numbers with that Jaccard similarity, by brute force over lines that share a shingle."""
    sets, holders = [_shingles(x) for x in lines], defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for own in holders.values():
        for k, i in enumerate(own):
            for j in own[k + 1 :]:
                shared[i, j] += 1
    return [(i, j) for (i, j), n in shared.items() if n >= threshold * (len(sets[i]) + len(sets[j]) - n) - 1e-9]


def test_line_dedup(spark):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(500)]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, base = line(30), [line(40) for _ in range(10)]
    data = []
    for i in range(60):
        b = base[i % 10].split()
        if i >= 10:
            b[r.randrange(40)] = "changed"
        data.append((i, "\n".join([line(20), " ".join(b), "", shared if i % 2 else line(3), line(12)])))
    data += [(100, None), (101, ""), (102, "\n \n"), (103, data[0][1]), (103, data[0][1])]
    d = spark.createDataFrame(data, "doc_id long, text string")
    got = {x["doc_id"]: x for x in line_dedup.dedup_lines(d).collect()}
    seen = [(i, p, x) for i, t in dict(data).items() if t for p, x in enumerate(t.split("\n")) if x.strip()]
    distinct = sorted({x for _, _, x in seen})
    sets = {x: _shingles(x) for x in distinct}
    links = [(a, b) for a in distinct for b in distinct if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    label = closure(distinct, links)
    first = {}
    for i, p, x in sorted(seen):
        first.setdefault(label[x], (i, p))
    for i, t in dict(data).items():
        if not t:
            assert got[i]["text"] == t and got[i]["n_dropped"] == 0
            continue
        keep = [x for p, x in enumerate(t.split("\n")) if not x.strip() or first[label[x]] == (i, p)]
        assert got[i]["text"] == "\n".join(keep), i
    assert line_dedup.dedup_lines(docs(spark)).count() == len(rows())
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_vector_links(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16))
    x[100:160] = x[0] + 0.15 * rng.normal(size=(60, 16))
    x[200:230] = x[5]
    x[300:340] = x[7] + 0.3 * rng.normal(size=(40, 16))
    data = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [1.0]), (704, [None] * 16), (0, [float(v) for v in x[0]])]
    d = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    result = vector_dedup.links(d)
    got = result.collect()
    assert len(got) == len(data)
    ids = np.array([*range(600), 0])
    u = np.concatenate([x, x[:1]])
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    n = near.sum(1) - 1
    want = defaultdict(list)
    for i, k in zip(ids, n):
        want[i].append(int(k))
    have = defaultdict(list)
    for r in got:
        have[r["vec_id"]].append(r["n_links"])
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    total = sum(map(sum, want.values()))
    assert all(h <= w for i in range(600) for h, w in zip(sorted(have[i]), sorted(want[i])))
    assert sum(sum(have[i]) for i in range(600)) >= 0.95 * total
    assert all(have[i] == [0] for i in (700, 701, 702, 703, 704))
    audit = vector_dedup.audit_recall(d, result).first()
    assert audit["recall"] >= 0.9
    assert vector_dedup.links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vector_links_over_shards(spark):
    """12,000 vectors in eight shards, most pairs of shards not shared: recall by the audit and by brute force, nothing over."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(400, 24))
    x = centre[rng.integers(0, 400, 12_000)] + 0.33 * rng.normal(size=(12_000, 24))
    d = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    result = cut(vector_dedup.links(d), "links")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(u[i : i + 1000] @ u.T >= 0.9).sum(1) - 1 for i in range(0, 12_000, 1000)])
    got = {r["vec_id"]: r["n_links"] for r in result.collect()}
    have = np.array([got[i] for i in range(12_000)])
    assert want.sum() > 20_000 and (have <= want).all() and have.sum() >= 0.95 * want.sum()
    assert vector_dedup.audit_recall(d, result).first()["recall"] >= 0.95


def test_vector_links_of_a_dense_group(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "SHARD_ROWS", 60)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 32))
    x[:1000] = x[0] + 0.25 * rng.normal(size=(1000, 32))
    d = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(1) - 1
    for block in (256, 4096):
        got = {r["vec_id"]: r for r in vector_dedup.links(d, block=block).collect()}
        have = np.array([got[i]["n_links"] for i in range(3000)])
        assert (have <= want).all()
        assert have.sum() >= 0.99 * want.sum(), (block, have.sum() / want.sum())
        assert {got[i]["component_id"] for i in range(1000)} == {0}


def test_lines_of_few_shingles(spark):
    """Short lines with one or two edits anywhere: nearly all similar pairs are found, and none that is not similar."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    flat = []
    for _ in range(300):
        base = " ".join(word() for _ in range(r.randint(8, 20)))
        flat.append(base)
        for _ in range(4):
            x = base
            for _ in range(r.randint(1, 2)):
                at = r.randrange(len(x))
                x = x[:at] + r.choice(["", "q", "zz "]) + x[at + r.randint(0, 2) :]
            flat.append(x)
    flat = list(dict.fromkeys(flat))
    d = spark.createDataFrame(list(enumerate(flat)), "doc_id long, text string")
    rows = line_dedup.lines(d)
    sig = cut(line_dedup.signatures(rows), "signatures")
    of = {x["line"]: x["component"] for x in line_dedup.line_components(sig, rows).join(sig, "id").join(rows.select("a", "b", "line"), ["a", "b"]).collect()}
    links = similar_lines(flat)
    want = closure(range(len(flat)), links)
    found = sum(flat[i] in of and of[flat[i]] == of.get(flat[j]) for i, j in links)
    assert len(links) > 200 and found >= 0.97 * len(links)
    for group in _groups(of).values():
        at = {want[flat.index(x)] for x in group}
        assert len(at) == 1  # never joins what brute force keeps apart


def test_recall_on_documents(spark, sf_dir):
    """Over the whole test table: components are those of brute force over all character shingles."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = line_dedup.lines(d)
    sig = cut(line_dedup.signatures(rows), "signatures")
    of = {x["line"]: x["component"] for x in line_dedup.line_components(sig, rows).join(sig, "id").join(rows.select("a", "b", "line").distinct(), ["a", "b"]).collect()}
    flat = [x["line"] for x in rows.select("line").distinct().collect()]
    links = similar_lines(flat)
    found = sum(flat[i] in of and of[flat[i]] == of.get(flat[j]) for i, j in links)
    assert found >= 0.97 * len(links)
    assert sum(len(g) - 1 for g in _groups(of).values()) <= sum(len(g) - 1 for g in _groups(closure(range(len(flat)), links)).values())


def test_clashing_names(spark):
    """Columns named as the operators' own are passed on, or replaced where the docstring says so."""
    from pyspark.sql import functions as F

    from gridloom.llm import toxicity

    names = ("drop", "n_lines", "n_dropped", "keep_id", "keep_hash", "component", "component_id", "fp", "row_hash", "score")
    d = docs(spark).drop("row_hash").withColumns({n: F.lit(f"own {n}") for n in names})
    out = line_dedup.dedup_lines(d)
    assert out.count() == d.count() and out.filter("drop = 'own drop' and score = 'own score'").count() == d.count()
    assert out.columns == [c for c in d.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns and kept.filter("keep_id = 'own keep_id' and fp = 'own fp'").count() == kept.count()
    assert toxicity.score(d, 0.25).filter("score = 0.25").count() == d.count()


def test_large_tables_are_shuffled(spark, monkeypatch):
    """The results beyond the bound of broadcasts are those within it."""
    from gridloom.llm import common

    d = docs(spark)
    small = (sorted(map(str, line_dedup.dedup_lines(d).collect())), sorted(map(str, simhash.classes(d).collect())))
    keep = common.small_side
    for m in (common, line_dedup, simhash):
        monkeypatch.setattr(m, "small_side", lambda df, most_bytes=0: keep(df, -1))
    assert (sorted(map(str, line_dedup.dedup_lines(d).collect())), sorted(map(str, simhash.classes(d).collect()))) == small


def test_crowded_buckets(spark, monkeypatch):
    """Lines that share a long passage: the index of rare shingles finds what meeting all members finds."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    flat = [f"{passage} {' '.join(word() for _ in range(40))}" for _ in range(70)]
    flat += [x[:-9] for x in flat[:20]]
    d = spark.createDataFrame(list(enumerate(flat)), "doc_id long, text string")
    want = closure(range(len(flat)), similar_lines(flat))
    for hot in (2, 32, 1000):
        monkeypatch.setattr(line_dedup, "HOT", hot)
        kept = {x["doc_id"] for x in line_dedup.dedup_lines(d).filter("n_dropped = 0").collect()}
        assert kept == set(want.values()), hot


def test_lines_without_blanks(spark):
    r = random.Random(6)
    data = []
    for i in range(40):
        x = "".join(chr(0x4E00 + r.randrange(3000)) if i % 2 else r.choice("abcdefghijklmnopqrstuvwxyz0123456789/=") for _ in range(200))
        at = r.randrange(5) if i % 4 < 2 else r.randrange(200)
        data += [(2 * i, x), (2 * i + 1, x[:at] + "#" + x[at:])]
    got = line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string"))
    assert {x["doc_id"]: x["n_dropped"] for x in got.collect()} == {i: i % 2 for i in range(80)}


def test_members_outside_join_before_all_meet(spark, monkeypatch):
    """Lines of one long passage with heads of many lengths: those that belong to the large component do not meet it whole."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8)))
    passage = " ".join(word() for _ in range(60))
    flat = [" ".join([*(word() for _ in range(r.randint(4, 14))), passage]) for _ in range(400)]
    d = spark.createDataFrame(list(enumerate(flat)), "doc_id long, text string")
    pairs = []

    def counted(df, label):
        out = cut(df, label)
        if label == "met":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "cut", counted)
    rows = line_dedup.lines(d)
    sig = cut(line_dedup.signatures(rows), "signatures")
    of = {x["line"]: x["component"] for x in line_dedup.line_components(sig, rows).join(sig, "id").join(rows.select("a", "b", "line"), ["a", "b"]).collect()}
    links = similar_lines(flat)
    assert len(links) > 1000 and sum(flat[x] in of and flat[y] in of and of[flat[x]] == of[flat[y]] for x, y in links) == len(links)
    assert 0 < sum(pairs) < 14_000  # 18,777 where all that is outside meets all at once


def test_signing_needs_no_pattern(spark):
    """Words are signed without a pattern match a shingle, and each pair is judged on code points, those of four bytes too."""
    from pyspark.sql import functions as F

    r = random.Random(17)
    plan = line_dedup.signatures(line_dedup.lines(docs(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
    pairs = []
    for letters in ("abcde fghij", "\u00e4\u00f6\u4e00\u4e01 x", "\U0001f600\U0001f601\U0001f602 y"):
        for n in (1, 5, 11, 12, 13, 40, 150):
            x = "".join(r.choice(letters) for _ in range(n))
            at = r.randrange(n)
            pairs += [(x, x), (x, x[:at] + "#" + x[at:]), (x, x + "#"), (x * 3, x * 2)]
    got = spark.createDataFrame(pairs, "x string, y string").select("x", "y", line_dedup.similar(F.col("x"), F.col("y"), 0.8).alias("s")).collect()
    for row in got:
        a, b = _shingles(row["x"]), _shingles(row["y"])
        assert row["s"] == (len(a & b) >= 0.8 * len(a | b) - 1e-9), row
    assert 30 < sum(row["s"] for row in got) < len(got)


def test_bits_rule_out_only_pairs_that_are_not_similar(spark):
    """Lines of all lengths, with repeated shingles too: no similar pair is ruled out, most of the others are, and those are not judged."""
    from pyspark.sql import functions as F

    r = random.Random(31)
    word = lambda: "".join(r.choice("abcdefghijä丁\U0001f600") for _ in range(r.randint(2, 9)))
    flat = ["ab " * 60, "ab " * 50 + "c", "x", "xy"]
    for n in (2, 5, 12, 40, 120, 400):
        for _ in range(8):
            base = [word() for _ in range(n)]
            flat += [" ".join(w if r.random() < kept else word() for w in base) for kept in (1, 0.99, 0.99, 0.98, 0.98, 0.7, 0.4)]
    flat = list(dict.fromkeys(flat))
    texts = spark.createDataFrame(list(enumerate(flat)), "id long, line string")
    bits = cut(line_dedup.shingle_bits(texts), "bits")
    ids = spark.range(len(flat))
    pairs = ids.select(F.col("id").alias("x")).crossJoin(ids.select(F.col("id").alias("y"))).filter("x < y")
    got = {(p["x"], p["y"]) for p in line_dedup.possible(pairs, bits, 0.8).collect()}
    links = {tuple(sorted(p)) for p in similar_lines(flat)}
    assert len(links) > 60 and links <= got and len(got) < 3 * len(links), (len(links), len(got), len(links - got))
