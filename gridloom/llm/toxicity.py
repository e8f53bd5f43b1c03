"""Toxicity: a convolutional text classifier trained in numpy and applied on Spark.

Words (ASCII lower case, edge punctuation stripped) and their first four letters are hashed to rows of an embedding
table and added; filters of widths 1, 2
and 3 slide over the whole text, each keeps its largest response, and a logistic unit weighs them. Scores are
calibrated on all labelled rows of a quarter that training leaves aside, so that 0.5 is the most likely side; thresholds
by language are chosen on the same rows and used where documents are rejected. The driver gets how many of these rows
there are by language, label and logit, in steps of 1/STEPS. A score depends on the text alone.

The filters learn from at most `per_class` labelled documents of each class (a documented bound: those with the lowest hash of
doc_id, less those of more than `most_chars` characters); their words are hashed on the executors and the driver gets
word ids only. Scoring covers all rows and whole texts.

Cases: null and empty texts are scored like any other (as padding only); very long texts are scored whole, in a batch of
their own; repeated rows are scored each and learned from once; a document with several labels counts as toxic if one
says so; labels without a value or a document are not learned from; without any usable labels of both classes every
score is the share of positive labels (0 if none); a null doc_id is held out; other columns are passed on, except that
score() replaces a column named score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import cut, text_batches, text_or_empty

VOCABULARY, WIDTH, FILTERS, SPANS = 1 << 18, 8, 16, (1, 2, 3)
#: Logits of calibration rows are counted in steps of 1/STEPS, up to MOST steps from zero.
STEPS, MOST = 64, 1 << 13
PAD, STEM, EDGE = 0, 4, b".,;:!?\"'()[]{}<>*%$&#|-_~`/\\+="


class WordIds(dict):
    """Word -> its two rows of the embedding table, of the word and of its first letters, packed; emptied at `most` words."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        core = word.strip(EDGE)
        stem = core.decode("utf-8", "replace")[:STEM].encode()
        self[word] = rows = 1 + zlib.crc32(core) % (VOCABULARY - 1) + VOCABULARY * (1 + zlib.crc32(b"^" + stem) % (VOCABULARY - 1))
        return rows

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _line_up(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in a row with max(SPANS) pads after each document, where each begins, and the end of its windows.

    Windows begin at a document's words and at the pad after them, so none reaches into the next document.
    """
    gap, parts, starts, at = np.full(max(SPANS), PAD, np.int64), [], [], 0
    for d in docs:
        starts.append(at)
        parts += [d, gap]
        at += len(d) + len(gap)
    starts = np.array(starts, np.int64)
    return np.concatenate([*parts, gap]), starts, starts + np.array([len(d) for d in docs], np.int64) + 1


@dataclass
class Cnn:
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    scale: float = 1.0
    shift: float = 0.0

    def responses(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pooled filter responses (documents x filters), and the unpooled ones of each width."""
        x = self.embed[ids % VOCABULARY] + self.embed[ids // VOCABULARY]
        n, pooled, raw = len(ids) - max(SPANS), [], []
        bounds = np.stack([starts, ends], 1).ravel()
        for w, f in zip(SPANS, self.filters):
            r = x[:n] @ f[0]
            for j in range(1, w):
                r += x[j : n + j] @ f[j]
            raw.append(r)
            pooled.append(np.maximum.reduceat(r, bounds, axis=0)[::2])
        return np.maximum(np.concatenate(pooled, 1) + self.bias, 0), raw

    def logits(self, docs: list[np.ndarray], most: int = 60_000) -> np.ndarray:
        out, i = [], 0
        while i < len(docs):
            j, words = i, 0
            while j < len(docs) and (j == i or words + len(docs[j]) <= most):
                words += len(docs[j])
                j += 1
            h, _ = self.responses(*_line_up(docs[i:j]))
            out.append(h @ self.weights + self.offset)
            i = j
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(docs).astype(np.float64) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(docs: list[np.ndarray], y: np.ndarray, steps: int = 1000, batch: int = 32, rate: float = 0.08, seed: int = 7) -> Cnn:
    """Balanced batches, logistic loss, Adagrad; gradients flow to the pooled positions only."""
    rng = np.random.default_rng(seed)
    f32 = np.float32
    m = Cnn(
        rng.normal(0, 0.02, (VOCABULARY, WIDTH)).astype(f32),
        [rng.normal(0, 0.5 / w**0.5, (w, WIDTH, FILTERS)).astype(f32) for w in SPANS],
        np.zeros(FILTERS * len(SPANS), f32),
        rng.normal(0, 0.1, FILTERS * len(SPANS)).astype(f32),
        0.0,
    )
    m.embed[PAD] = 0
    seen = [np.full(a.shape, 1e-2, f32) for a in (m.embed, *m.filters, m.bias, m.weights)] + [np.full(1, 1e-2, f32)]
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    share /= share.sum()
    for _ in range(steps):
        rows = rng.choice(len(docs), min(batch, len(docs)), p=share)
        ids, starts, ends = _line_up([docs[i] for i in rows])
        h, raw = m.responses(ids, starts, ends)
        g = ((_sigmoid(h @ m.weights + m.offset) - y[rows]) / len(rows)).astype(f32)
        gh = g[:, None] * m.weights * (h > 0)
        g_filters, touched, moved = [], [], []
        for k, (w, r) in enumerate(zip(SPANS, raw)):
            own = gh[:, k * FILTERS : (k + 1) * FILTERS]
            at = np.stack([s + r[s:e].argmax(0) for s, e in zip(starts, ends)])
            gf = np.zeros_like(m.filters[k])
            for j in range(w):
                word = ids[at + j]
                gf[j] = np.einsum("bf,bfd->df", own, m.embed[word % VOCABULARY] + m.embed[word // VOCABULARY])
                touched += [word.ravel() % VOCABULARY, word.ravel() // VOCABULARY]
                moved += [(own[:, :, None] * m.filters[k][j].T[None]).reshape(-1, WIDTH)] * 2
            g_filters.append(gf)
        rows_, grad = np.concatenate(touched), np.concatenate(moved)
        unique, back = np.unique(rows_, return_inverse=True)
        g_embed = np.zeros((len(unique), WIDTH), f32)
        np.add.at(g_embed, back, grad)
        g_embed[unique == PAD] = 0
        seen[0][unique] += g_embed**2
        m.embed[unique] -= rate * g_embed / np.sqrt(seen[0][unique])
        for i, (a, ga) in enumerate(zip((*m.filters, m.bias, m.weights), (*g_filters, gh.sum(0), g @ h)), 1):
            seen[i] += ga**2
            a -= rate * ga / np.sqrt(seen[i])
        seen[-1] += g.sum() ** 2
        m.offset -= float(rate * g.sum() / np.sqrt(seen[-1][0]))
    return m


def calibrate(logits: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Platt scaling with softened targets, by Newton steps, over n rows of each logit and label."""
    n1, n0 = n[y == 1].sum(), n[y == 0].sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    mean = (n * logits).sum() / n.sum()
    spread = max(1e-6, float(np.sqrt((n * (logits - mean) ** 2).sum() / n.sum())))
    z, a, b = logits / spread, 1.0, 0.0
    for _ in range(steps):
        p = _sigmoid(a * z + b)
        d, w = n * (p - target), n * (p * (1 - p) + 1e-9)
        grad = np.array([(d * z).sum() + 1e-3 * a, d.sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(hess, grad)
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
    return (a / spread, b) if a > 0 else (1e-6, float(np.log((n1 + 1) / (n0 + 1))))


def language_thresholds(scores: np.ndarray, y: np.ndarray, n: np.ndarray, langs: np.ndarray, least: int = 30) -> dict:
    """By language the cut of the highest F0.5, which weighs clean documents more, over n calibration rows of each score, label and language.

    Languages with few positives use the common cut (None), and that is 0.5 where there are few positives in all.
    """

    def best(own: np.ndarray) -> float:
        s, at = np.unique(-scores[own], return_inverse=True)
        all_, hit = np.cumsum(np.bincount(at, n[own])), np.cumsum(np.bincount(at, n[own] * y[own]))
        k = int(np.argmax(1.25 * hit / (all_ + 0.25 * hit[-1])))
        return min(0.9, max(0.3, float(-(s[k] + s[k + 1]) / 2 if k + 1 < len(s) else -s[k])))

    out = {None: best(np.ones(len(y), bool)) if (n * y).sum() >= least else 0.5}
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        if (n * y)[own].sum() >= least:
            out[lang] = best(own)
    return out


def held_out_column():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_rows(docs: DataFrame, labels: DataFrame, per_class: int, most_chars: int = 20_000) -> DataFrame:
    """(doc_id, toxic, lang, words): at most per_class training documents of each class, words as packed ids.

    The documents with the lowest hashes of doc_id are taken, one row each, less those of more than most_chars characters.
    Only ids are sorted; texts are joined after and go no further than the task that hashes their words.
    """
    known = labels.filter(~held_out_column() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    pick = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    ids = F.broadcast(pick[0].union(pick[1]))  # 2 * per_class rows at most
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), lang.alias("lang"))
    rows = rows.filter(F.char_length("text") <= most_chars).join(ids, "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("d")).select("doc_id", "toxic", "d.lang", "d.text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds()
        for batch in batches:
            packed = [words.of(t).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=["doc_id", "toxic", "lang", "words"])

    return rows.mapInArrow(hashed, "doc_id long, toxic int, lang string, words binary")


def calibration_counts(docs: DataFrame, labels: DataFrame, model: Cnn) -> DataFrame:
    """(toxic, lang, step, n): all labelled documents that training leaves aside, by label, language and logit."""
    aside = ~held_out_column() & (F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit("/aside")).cast("binary")) % 4 == 0)
    known = labels.filter(aside & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.filter(aside).select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), text_or_empty().alias("text"))
    spark = docs.sparkSession
    text_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # VOCABULARY x WIDTH floats and the filters: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, ids = sent.value, WordIds()
        for batch in batches:
            step = np.clip(np.round(m.logits([ids.of(t) for t in batch.column(2).to_pylist()]) * STEPS), -MOST, MOST)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(step.astype(np.int32))], names=["doc_id", "lang", "step"])

    steps = rows.mapInArrow(run, "doc_id long, lang string, step int").groupBy("doc_id").agg(F.min(F.struct("step", "lang")).alias("d"))
    return steps.join(known, "doc_id").groupBy("toxic", "d.lang", "d.step").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500) -> tuple[Cnn | float, dict]:
    """(model, thresholds by language). A quarter of the labelled rows, all of them, is kept for calibration."""
    rows = sorted(labelled_rows(docs, labels, per_class).collect(), key=lambda r: r["doc_id"])
    y = np.array([r["toxic"] for r in rows], dtype=np.int64)
    aside = np.array([zlib.crc32(f"{r['doc_id']}/aside".encode()) % 4 == 0 for r in rows], dtype=bool)
    if len(set(y[~aside].tolist())) < 2 or len(set(y[aside].tolist())) < 2:
        return (float(y.mean()) if len(y) else 0.0), {None: 0.5}
    model = train([np.frombuffer(r["words"], np.int64) for r, a in zip(rows, aside) if not a], y[~aside])
    seen = [r for r in calibration_counts(docs, labels, model).collect() if r["toxic"] in (0, 1)]  # languages x steps at most
    toxic, steps, n = (np.array([r[c] for r in seen], dtype=np.float64) for c in ("toxic", "step", "n"))
    model.scale, model.shift = calibrate(steps / STEPS, toxic, n)
    return model, language_thresholds(_sigmoid(model.scale * steps / STEPS + model.shift), toxic, n, np.array([r["lang"] for r in seen], dtype=object))


def score(docs: DataFrame, model: Cnn | float) -> DataFrame:
    """docs with a column score, in place of any so named; every row, whole texts."""
    docs = docs.drop("score")
    if not isinstance(model, Cnn):
        return docs.withColumn("score", F.lit(float(model)))
    spark = docs.sparkSession
    text_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # VOCABULARY x WIDTH floats and the filters: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, ids = sent.value, WordIds()
        for batch in batches:
            s = m.scores([ids.of(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, score double")


def rejected(cuts: dict) -> Column:
    """Whether a scored row lies at or above the cut of its language."""
    cut = F.lit(cuts[None])
    for lang, c in cuts.items():
        if lang is not None:
            cut = F.when(F.col("lang") == lang, F.lit(c)).otherwise(cut)
    return F.col("score") >= cut


def rejected_rows(docs: DataFrame, model: Cnn | float, cuts: dict) -> DataFrame:
    """(__id, __hash, __lang) of the rows at or above their language's cut, as a written table; texts go to the classifier and not back."""
    text, lang = text_or_empty(), F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    key = [F.col("doc_id").cast("long").alias("__id"), F.xxhash64(text).alias("__hash"), lang.alias("__lang")]
    sent = None
    if not isinstance(model, Cnn):
        rows = docs.select(*key).withColumn("score", F.lit(float(model)))
    else:
        text_batches(docs.sparkSession)
        sent = docs.sparkSession.sparkContext.broadcast(model)  # VOCABULARY x WIDTH floats and the filters: a fixed size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, ids = sent.value, WordIds()
            for batch in batches:
                s = m.scores([ids.of(t) for t in batch.column(3).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(s, pa.float64())], names=["__id", "__hash", "__lang", "score"])

        rows = docs.select(*key, text.alias("text")).mapInArrow(run, "__id long, __hash long, __lang string, score double")
    rows = rows.withColumn("lang", F.col("__lang"))
    out = cut(rows.filter(F.coalesce(rejected(cuts), F.lit(False))).select("__id", "__hash", "__lang").distinct(), "rejected")
    if sent is not None:
        sent.unpersist()
    return out


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, cuts = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    s = score(docs.select("doc_id", "lang", text_or_empty().alias("text")), model)
    return s.select("doc_id", held_out_column().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), rejected(cuts).alias("rejected_for_language"))
