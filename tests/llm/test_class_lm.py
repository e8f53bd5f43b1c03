from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import class_lm as M
from gridloom.llm.queries import LLM_QUERIES

from .cases import docs, rows


def corpus(n=300):
    """Three kinds of words that follow each other, and some words of their own."""
    r = random.Random(3)
    kinds = [[f"{k}{i}" for i in range(20)] for k in "abc"]
    return [(i, " ".join(r.choice(kinds[j % 3]) if r.random() > 0.03 else f"x{r.randrange(400)}" for j in range(r.randint(3, 60)))) for i in range(n)]


END = ""


def words_of(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    return [w for w in low.translate({c: " " for c in range(9, 14)}).split(" ") if w] + [END]


def learns(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 != 2


def check(data, got):
    """Base columns by plain loops."""
    train = Counter(w for i, t in data if learns(i) for w in words_of(t))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t in data:
        w = words_of(t)
        base = sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w)
        want[i, not learns(i), len(w), sum(train[x] > 0 for x in w), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want


def test_query(spark, tmp_path):
    data = [*corpus(), *[(1000 + i, r[1]) for i, r in enumerate(rows())], (None, "A b A"), (None, None), (5, "Again"), (7000, "İ É ß X Y z\x1cw")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = LLM_QUERIES["op13_class_lm"](spark, str(tmp_path))
    assert [t for c, t in got.dtypes][:7] == ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    got = got.collect()
    check(data, got)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores_from_the_table_of_words(spark):
    """The score of every document again, by loops over words with the classes and counts that the model reports."""
    data = corpus()
    d = spark.createDataFrame(data, "doc_id long, text string")
    for frequent, clustered in ((1 << 16, 1 << 14), (1 << 16, 50), (40, 20)):  # with few frequent words most are looked up by joins
        s, model = M.class_lm(d, F.col("doc_id") % 5 != 0, 4, 3, frequent=frequent, clustered=clustered)
        words = {r["word"]: (r["n"], r["class"]) for r in model.words.collect()}
        train = Counter(w for i, t in data if i % 5 for w in words_of(t))
        assert {w: n for w, (n, _) in words.items()} == dict(train)
        k, n = 4, sum(train.values())
        count, unknown = Counter(), Counter()
        for i, t in data:
            if i % 5:
                seq = [END, *words_of(t)]
                for a, b in zip(seq, seq[1:]):
                    for x in {words[a][1]} | ({"?"} if train[a] == 1 else set()):
                        count[x, words[b][1]] += 1
                        unknown[x] += train[b] == 1
        tokens = Counter()
        for w, (c, cls) in words.items():
            tokens[cls] += c
        once = (sum(c == 1 for c in train.values()) + 1) / (n + 2)

        def p(a, b):
            before = sum(count[a, c] for c in range(k + 1))
            u = (unknown[a] + 50 * once) / (before + 50)
            return u if b == "?" else (1 - u) * (count[a, b] + 50 * tokens[b] / n) / (before + 50)

        for a in [*range(k + 1), "?"]:
            assert abs(sum(p(a, b) for b in [*range(k + 1), "?"]) - 1) < 1e-9
        for r in s.collect():
            seq = words_of(dict(data)[r["doc_id"]])
            cls = [words[w][1] if w in words else "?" for w in seq]
            want = sum(math.log10(p(a, b)) for a, b in zip([words[END][1], *cls], cls)) + sum(math.log10(words[w][0] / tokens[words[w][1]]) for w in seq if w in words)
            assert abs(want - r["score"]) < 1e-6 and abs(r["perplexity"] - 10 ** (-r["score"] / r["n_tokens"])) < 1e-6 * r["perplexity"]
        assert all(a <= b + 1e-6 for a, b in zip(model.history, model.history[1:])) and (clustered < 100 or model.history[-1] > model.history[0])
        held = [r for r in s.collect() if not r["learn"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_classes_are_those_of_the_text(spark):
    d = spark.createDataFrame(corpus(600), "doc_id long, text string")
    _, model = M.class_lm(d, F.lit(True), 6, 6)
    kinds = {}
    for r in model.words.filter("n >= 20").collect():
        kinds.setdefault(r["class"], Counter())[r["word"][:1]] += 1
    assert sum(max(c.values()) for c in kinds.values()) >= 0.95 * sum(sum(c.values()) for c in kinds.values())


def test_exchange_gain_is_the_change_of_the_likelihood():
    r = np.random.default_rng(1)
    for _ in range(20):
        seq, k = r.integers(0, 9, 200), 3
        cls = np.append(r.integers(0, k, 8), k)  # word 8 is the end
        table = lambda c: np.bincount(c[seq[:-1]] * (k + 2) + c[seq[1:]], minlength=(k + 2) ** 2).reshape(k + 2, k + 2).astype(float)  # noqa: E731, B023
        w = int(r.integers(0, 8))
        right = np.bincount(cls[seq[1:][seq[:-1] == w]], minlength=k + 2).astype(float)
        left = np.bincount(cls[seq[:-1][seq[1:] == w]], minlength=k + 2).astype(float)
        best, gain, after = M.exchange(table(cls), int(cls[w]), right, left, float(((seq[:-1] == w) & (seq[1:] == w)).sum()), k)
        trial = [M.likelihood(table(np.where(np.arange(9) == w, c, cls))) for c in range(k)]
        moved = np.where(np.arange(9) == w, best, cls)
        assert np.array_equal(after, table(moved)) and abs(max(trial) - trial[best]) < 1e-6
        assert abs(trial[best] - trial[cls[w]] - gain) < 1e-6


def test_cases(spark):
    d = docs(spark)
    s, _ = M.class_lm(d, F.lit(True))
    assert s.count() == d.count()
    for data, learn in (([], F.lit(True)), (rows(), F.lit(False))):
        s, model = M.class_lm(docs(spark, data), learn)
        got = s.collect()
        assert len(got) == len(data) and all(r["score"] == 0 and r["base_score"] == 0 for r in got) and model.n_tokens == 0
    with pytest.raises(ValueError):
        M.class_lm(d, F.lit(True), 126)


def test_a_task_makes_one_row_of_class_pairs(spark):
    """However many words and neighbours a task has met, and the sum over tasks is that of a loop."""
    h, n, r = 40, 6, np.random.default_rng(2)
    classes = np.append(np.arange(h) % 4, 5)
    rows = [(i, [int(o) for o in np.unique(r.integers(0, 2 * h + 2, 30))]) for i in range(h)]
    rows = [(i, o, [int(x) for x in r.integers(1, 9, len(o))]) for i, o in rows]
    near = spark.createDataFrame(rows, "id int, others array<int>, counts array<long>").repartition(7)
    want = np.zeros((n, n))
    for i, others, counts in rows:
        for o, c in zip(others, counts):
            if o <= h:
                want[classes[i], classes[o]] += c
            elif o == 2 * h + 1:
                want[classes[h], classes[i]] += c
    assert M._class_tables(near, classes, n).count() == near.rdd.getNumPartitions()
    assert (M._class_table(near, classes, n) == want).all()


def test_parts_of_the_codes_are_tagged_in_turn_and_go(spark, monkeypatch):
    """Scores are the same however many parts there are, and no coded document is left on disk."""
    d, learn = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(5, "doc_id"), F.col("doc_id") % 5 != 0
    made, coded = [], M.coded
    monkeypatch.setattr(M, "coded", lambda *a: made.append(coded(*a)) or made[-1])
    got = []
    for parts in (1, 3):
        monkeypatch.setattr(M, "PARTS", parts)
        s, _ = M.class_lm(d, learn, 4, 2, frequent=40, clustered=20)
        got.append({r["doc_id"]: r["score"] for r in s.collect()})
        files = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in made[-1].inputFiles()]
        assert len(files) > 1 and not any(f.getFileSystem(spark._jsc.hadoopConfiguration()).exists(f) for f in files)
    assert len(got[0]) == 300 and got[0] == pytest.approx(got[1])
