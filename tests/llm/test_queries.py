"""The ten queries as they are called, over small whole tables, against code that shares nothing with the operators."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import regex

from gridloom.llm import bucket_digest, line_dedup, pii, secrets, toxicity
from gridloom.llm.bpe import default_tokenizer
from gridloom.llm.queries import LLM_QUERIES

from .cases import rows
from .test_near_duplicates import closure, similar_lines, slow_fingerprint
from .test_spans import TEXTS, _personal, _secrets

EXTRA = [
    ("x " * 190 + "client_id=abcd1234 " + "y " * 5 + "Zx9Kq2Lm8Pw4Rt6Yv1Bn3 https://api.x.com/v1"),
    ("user_name: bobby" + " " * 383 + "Zx9Kq2Lm8Pw4Rt6Yv1Bn3"),
    ("user_name: bobby" + " " * 385 + "Zx9Kq2Lm8Pw4Rt6Yv1Bn3"),
    ("z" * 399 + " client_id=abcd1234 Zx9Kq2Lm8Pw4Rt6Yv1Bn3 server: db.x " + "w " * 300 + "https://far.example"),
    "call 415-555-2671 or 415-555-2672, mail jane (at) example (dot) com, order 1234567890",
]


def table():
    """(doc_id, text, lang, source, n_chars) with cases of every operator; ids do not repeat here."""
    out = [(i, r[1], r[2], r[3], r[4]) for i, r in enumerate(rows())]
    return out + [(1000 + i, t, "en", "s", 1) for i, t in enumerate([*TEXTS, *EXTRA])]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(table(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int("w7" in (r[1] or "").split())) for r in table()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    x = np.random.default_rng(1).normal(size=(60, 8))
    x[20:40] = x[0] + 0.12 * x[20:40]
    v = [(i, r.tolist()) for i, r in enumerate(x)] + [(60, None), (61, [0.0] * 8), (62, [float("inf")] + [0.0] * 7)]
    spark.createDataFrame(v, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def run(spark, made):
    return lambda name: (lambda d: ({c: t for c, t in d.dtypes}, [r.asDict() for r in d.collect()]))(LLM_QUERIES[name](spark, made))


def line_up(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def linked(text, scope=400):
    """Weak spans with complements in scope, every pair looked at."""
    found = [(a, b, secrets.ROLE[k], k) for a, _, b, k in _secrets(text)]
    weak = [(m.start(), m.end(), "id", "weak_id", 3) for m in re.finditer(secrets.WEAK_ID, text)]
    mixed = lambda s: re.search("[A-Z]", s) and re.search("[a-z]", s) and len(re.findall("[0-9]", s)) >= 2
    weak += [(m.start(), m.end(), "secret", "weak_secret", 4) for m in re.finditer(secrets.WEAK_SECRET, text) if mixed(m.group())]
    weak += [(m.start(), m.end(), "endpoint", "endpoint", 5) for m in re.finditer(secrets.WEAK_ENDPOINT, text)]
    weak = [w for w in weak if not any(a < w[1] and w[0] < b for a, b, _, _ in found)]
    at = defaultdict(list)
    for x in [*found, *weak]:
        at[x[2]].append(x[0])
    near = lambda w, role: any(abs(w[0] - s) <= scope for s in at[role])
    need = {"id": ["secret"], "secret": ["id"], "endpoint": ["id", "secret"]}
    return [(w[0], w[4], w[1], w[3]) for w in weak if all(near(w, r) for r in need[w[2]])]


def test_op1(run):
    kinds, got = run("op1_secret_scan")
    assert {k: kinds[k] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")} == {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(table())
    for i, t, *_ in table():
        base, more = _secrets(t or ""), linked(t or "")
        assert [by[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[3] == k for s in base) for k in ("assign", "access", "hex")]
        assert by[i]["base_sha256"] == hashlib.sha256(line_up(base).encode()).hexdigest()
        assert by[i]["spans"] == line_up([*base, *more]), t
    assert sum(r["n_linked"] > 0 for r in got) >= 3


def test_op2(run):
    kinds, got = run("op2_pii")
    assert [kinds[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == ["bigint"] * 4 and kinds["base_sha256"] == kinds["spans"] == "string"
    by = {r["doc_id"]: r for r in got}
    makers = {k: regex.compile(p) for k, p in pii.GENERATORS.items()}
    for i, t, *_ in table():
        t, base = t or "", _personal(t or "")
        assert [by[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[3] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert by[i]["base_sha256"] == hashlib.sha256(line_up(base).encode()).hexdigest()
        spans = [(int(a), k, int(b)) for k, a, b in (x.rsplit(":", 2) for x in by[i]["spans"].split(",") if x)]
        assert {(a, k, b) for a, _, b, k in base} <= set(spans)
        extra = [s for s in spans if s[1] in makers]
        assert len(extra) == by[i]["n_extra"]
        for a, k, b in extra:
            assert any((m.start(), m.end()) == (a, b) for m in makers[k].finditer(t))
            assert not any(x < b and a < y for x, _, y, _ in base)
        assert not any(x[0] < y[2] and y[0] < x[2] for x, y in combinations(extra, 2))


def exact(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_op3(run):
    kinds, got = run("op3_token_index")
    assert [kinds[k] for k in ("doc_id", "start", "n_tokens", "ids_crc32")] == ["bigint"] * 4
    want, at = {}, 0
    for i, t, *_ in sorted(table()):
        ids = exact(t)
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def test_op4(run):
    kinds, got = run("op4_simhash")
    assert (kinds["doc_id"], kinds["fingerprint"], kinds["component_id"]) == ("bigint", "string", "bigint")
    fp = {i: slow_fingerprint(t) for i, t, *_ in table()}
    label = closure(fp, [(a, b) for a, b in combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fp[i]:016x}", label[i]) for i in fp}


def loop_digest(text):
    """The digest by plain loops: bucket counts, the three cuts of the sorted counts, two bits a bucket, a length byte."""
    data, counts = text.encode(), [0] * 256
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[int(bucket_digest._TABLES[0][a]) ^ int(bucket_digest._TABLES[1][b]) ^ int(bucket_digest._TABLES[2][c])] += 1
    order = sorted(counts)
    cuts = (order[63], order[127], order[191])
    codes = [sum(n > q for q in cuts) for n in counts] if len(data) >= 3 else [0] * 256
    bits = "".join(f"{c:02b}" for c in codes)
    return f"{min(255, round(math.log(1 + len(data)) / math.log(1.1))):02x}{int(bits, 2):0128x}", codes


def loop_likeness(x, y):
    (p, a), (q, b) = x, y
    apart = sum((0, 1, 2, 6)[abs(i - j)] for i, j in zip(a, b))
    apart += min(64, 2 * max(0, abs(int(p[:2], 16) - int(q[:2], 16)) - 1))
    mean = 256 * sum((0, 1, 2, 6)[abs(i - j)] for i in range(4) for j in range(4)) / 16
    return max(0.0, 1 - apart / mean)


def test_op5(run):
    kinds, got = run("op5_bucket_digest")
    assert [kinds[k] for k in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")] == ["bigint", "string", "string", "string", "double", "double"]
    order = [(i, t or "") for i, t, *_ in sorted(table())]
    by = {r["doc_id"]: r for r in got}
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        own, edit, after = loop_digest(t), loop_digest(changed), loop_digest(following)
        r = by[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own[0], edit[0])
        assert r["near_edited"] == pytest.approx(loop_likeness(own, edit)) and r["near_next"] == pytest.approx(loop_likeness(own, after))


def test_op6(run, spark, made):
    kinds, got = run("op6_vector_graph")
    assert [kinds[k] for k in ("vec_id", "n_links", "component_id", "kept")] == ["bigint", "bigint", "bigint", "boolean"]
    v = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{made}/embeddings.parquet").collect()}
    ok = {i: [float(e) for e in x] for i, x in v.items() if x is not None and all(math.isfinite(e) for e in x) and any(x)}
    cosine = lambda a, b: sum(p * q for p, q in zip(a, b)) / math.sqrt(sum(p * p for p in a)) / math.sqrt(sum(q * q for q in b))
    links = [(a, b) for a, b in combinations(ok, 2) if cosine(ok[a], ok[b]) >= 0.9]
    label, n = closure(v, links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(links) > 50
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (n[i], label[i], label[i] == i) for i in v}


def test_op7(run):
    _, got = run("op7_line_dedup")
    where = [(i, p, x) for i, t, *_ in sorted(table()) if t for p, x in enumerate(t.split("\n")) if x.strip(line_dedup.BLANKS)]
    distinct = sorted({x for _, _, x in where})
    label, first = closure(range(len(distinct)), similar_lines(distinct)), {}
    of = {x: label[k] for k, x in enumerate(distinct)}
    for i, p, x in where:
        first.setdefault(of[x], (i, p))
    by = {r["doc_id"]: r for r in got}
    for i, t, *_ in table():
        lines = t.split("\n") if t is not None else []
        kept = [x for p, x in enumerate(lines) if not x.strip(line_dedup.BLANKS) or first[of[x]] == (i, p)]
        text = "\n".join(kept)
        assert (by[i]["n_lines"], by[i]["n_dropped"], by[i]["n_chars"]) == (len(lines), len(lines) - len(kept), len(text))
        assert by[i]["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op8(run):
    kinds, got = run("op8_best_fit_packing")
    assert kinds == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    want = {}
    for i, t, *_ in table():
        ids = exact(t)
        bounds = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        want |= {(i, k): (a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))}
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    full = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == full[r["sequence_id"]]
        full[r["sequence_id"]] += r["length"]
    assert max(full.values()) <= 1024 and len(full) <= -(-sum(full.values()) // 1024) + 1


def test_op10(run, spark, made):
    kinds, got = run("op10_toxicity")
    assert [kinds[k] for k in ("doc_id", "held_out", "score", "predicted")] == ["bigint", "boolean", "double", "int"]
    assert len(got) == len(table())
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    again = {r["doc_id"]: r["score"] for r in run("op10_toxicity")[1]}
    assert again == {r["doc_id"]: r["score"] for r in got}


def test_classifier_by_loops():
    """The forward pass: words by two hashed rows, every window of every width, the largest response, a logistic unit."""
    rng = np.random.default_rng(5)
    texts = ["some bad words, here", "", "one", "two words", " ".join(f"w{i % 50}" for i in range(300))]
    ids = toxicity.WordIds()
    docs = [ids.of(t) for t in texts]
    model = toxicity.train(docs, np.array([1, 0, 0, 1, 0]), steps=3)
    model.bias = rng.normal(size=model.bias.shape).astype(np.float32)
    model.scale, model.shift = 1.7, -0.3
    for text, score in zip(texts, model.scores(docs)):
        v = []
        for w in text.encode().lower().split():
            core = w.strip(toxicity.EDGE)
            one, two = 1 + zlib.crc32(core) % (toxicity.VOCABULARY - 1), 1 + zlib.crc32(b"^" + core[: toxicity.STEM]) % (toxicity.VOCABULARY - 1)
            v.append([float(a) + float(b) for a, b in zip(model.embed[one], model.embed[two])])
        v += [[0.0] * toxicity.WIDTH] * max(toxicity.SPANS)
        z, k = float(model.offset), 0
        for width, f in zip(toxicity.SPANS, model.filters):
            for c in range(toxicity.FILTERS):
                starts = range(len(v) - max(toxicity.SPANS) + 1)
                best = max(sum(float(f[j, e, c]) * (v[s + j][e] if s + j < len(v) else 0.0) for j in range(width) for e in range(toxicity.WIDTH)) for s in starts)
                z += max(0.0, best + float(model.bias[k])) * float(model.weights[k])
                k += 1
        assert score == pytest.approx(1 / (1 + math.exp(-(1.7 * z - 0.3))), abs=1e-4)
