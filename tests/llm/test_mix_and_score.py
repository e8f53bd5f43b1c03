from __future__ import annotations

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from gridloom.llm import mixing, toxicity

from .cases import docs, rows


def targets(sizes, cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        free = sum(w[s] for s in sizes if s not in capped)
        out = {s: cap * sizes[s] if s in capped else (left * w[s] / free if free else 0) for s in sizes}
        over = {s for s in sizes if s not in capped and out[s] > cap * sizes[s]}
        if not over:
            return out
        capped |= over


def test_mix(spark):
    r = random.Random(4)
    data = [(i, " ".join("w" for _ in range(r.randint(0, 60))), "en", r.choice(["a"] * 20 + ["b", "c", "d", None]), 1, 7, 7, "h", "l") for i in range(1500)]
    m = mixing.mix(mixing.sized(docs(spark, data))).select("doc_id", "source", F.col("__size").alias("size_"), "__target", "__source_size", "__copies").collect()
    sizes = defaultdict(int)
    for x in data:
        sizes[x[3]] += len(x[1].split())
    want, taken = targets(sizes), defaultdict(int)
    for x in m:
        assert x["__source_size"] == sizes[x["source"]] and abs(x["__target"] - want[x["source"]]) < 1e-6
        assert 0 <= x["__copies"] <= 3
        taken[x["source"]] += x["__copies"] * x["size_"]
    for s, t in taken.items():
        assert abs(t - want[s]) <= 0.05 * want[s] + 70
    again = mixing.mix(mixing.sized(docs(spark, data).repartition(7))).select("doc_id", "__copies").collect()
    assert sorted(tuple(x) for x in again) == sorted((x["doc_id"], x["__copies"]) for x in m)


def test_mix_cases(spark):
    d = docs(spark)
    t = mixing.take(d)
    assert t.columns == d.columns
    assert mixing.mix(mixing.sized(d)).count() == len(rows())
    assert mixing.take(docs(spark, [])).count() == 0


def test_toxicity(spark):
    r = random.Random(8)
    common = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    bad = ["zorg", "blarp", "quonk"]
    data, labels = [], []
    for i in range(900):
        w = [r.choice(common) for _ in range(r.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", ",", "!"]))
        data.append((i, " ".join(w), r.choice(["en", "de", None]), "a", 1, 7, 7, "h", "l"))
        labels.append((i, 1, int(toxic)))
    d, lab = docs(spark, data + [x for x in rows() if x[0] is None]), spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model, cuts = toxicity.fit(d, lab, per_class=400)
    got = toxicity.score(d, model).withColumn("held", toxicity.held_out_column()).collect()
    assert len(got) == len(data) + 2 and all(0 <= x["score"] <= 1 for x in got)
    held = [x for x in got if x["held"] and x["doc_id"] is not None]
    assert sum((x["score"] >= 0.5) == (x["doc_id"] % 5 == 0) for x in held) >= 0.95 * len(held)
    assert toxicity.score(docs(spark, []), model).count() == 0
    assert toxicity.fit(d, lab.filter("toxic = 0"))[0] == 0.0
    assert toxicity.score(d, toxicity.fit(d, lab.limit(0))[0]).filter("score = 0").count() == len(got)


def test_toxicity_is_calibrated_on_all_rows_aside(spark):
    """On those that training leaves aside, not only on those of them that are among the documents picked for training."""
    r = random.Random(9)
    common = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    data = [(i, " ".join([r.choice(common) for _ in range(r.randint(5, 60))] + ["zorg"] * (i % 5 == 0)), "en", "a", 1, 7, 7, "h", "l") for i in range(900)]
    d, lab = docs(spark, data), spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(900)], "doc_id long, quality int, toxic int")
    aside = {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 and zlib.crc32(f"{i}/aside".encode()) % 4 == 0}
    model = toxicity.fit(d, lab, per_class=60)[0]
    assert sum(x["n"] for x in toxicity.calibration_counts(d, lab, model).collect()) == len(aside)
    own = [(x["score"], x["doc_id"] % 5 == 0) for x in toxicity.score(d, model).collect() if x["doc_id"] in aside]
    assert abs(sum(s for s, _ in own) - sum(t for _, t in own)) <= 1 + 0.02 * len(own)
