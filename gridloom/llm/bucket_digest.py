"""Document fingerprints: quartile bucket digests.

Every run of three bytes is hashed to one of 256 buckets; a bucket's code says in which quartile of the document's own
bucket counts its count lies. The digest is a byte for the length (logarithmic) and 256 codes of two bits, as 130 hex
digits. Two digests differ by the sum over buckets of 1, 2 or 6 for codes one, two or three apart, plus a bounded
penalty for lengths; the likeness is 1 minus that difference over the difference expected of unrelated codes, and 0
beyond it.

Cases: null text counts as empty; texts under three bytes have no triplets and share the all-zero codes; rows of one
doc_id are ordered by text; a null doc_id comes first; a table of one row has itself as its next document; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import text_batches, text_or_empty

BUCKETS = 256
_TABLES = np.stack([np.random.default_rng(k).permutation(256) for k in (101, 202, 303)]).astype(np.uint8)
_APART = np.array([0, 1, 2, 6], np.int64)
#: Mean difference of two independent codes times the number of buckets: (6 * 1 + 4 * 2 + 2 * 6) / 16 a bucket.
UNRELATED = BUCKETS * 26 / 16
EMPTY_ID = -(2**63)


def codes(data: bytes) -> np.ndarray:
    """Quartile code 0 to 3 of each bucket."""
    b = np.frombuffer(data, np.uint8)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.uint8)
    counts = np.bincount(_TABLES[0][b[:-2]] ^ _TABLES[1][b[1:-1]] ^ _TABLES[2][b[2:]], minlength=BUCKETS)
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    return (counts[:, None] > cuts).sum(1).astype(np.uint8)


def digest(text: str) -> str:
    data = text.encode("utf-8", "replace")
    c = codes(data).reshape(-1, 4)
    packed = (c[:, 0] << 6 | c[:, 1] << 4 | c[:, 2] << 2 | c[:, 3]).astype(np.uint8)
    length = min(255, round(np.log1p(len(data)) / np.log(1.1)))
    return bytes([length]).hex() + packed.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for those as far apart as unrelated ones."""
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8) for s in (a, b))
    diff = 0
    for shift in (6, 4, 2, 0):
        diff += int(_APART[np.abs((x[1:] >> shift & 3).astype(np.int64) - (y[1:] >> shift & 3).astype(np.int64))].sum())
    diff += min(64, 2 * max(0, abs(int(x[0]) - int(y[0])) - 1))
    return max(0.0, 1.0 - diff / UNRELATED)


def edited(text: str, following: str) -> str:
    """text with its last half replaced by as much of the start of the following document."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def in_order_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (b, ghost, id, doc_id, text), dealt by ranges of doc_id and sorted, each range ended by the row that follows it.

    Range bounds are quantiles of doc_id; the first row of each range is sent to the range before it too (that of the
    first range to the last), marked ghost. The driver sees one id per range. Texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(EMPTY_ID)).alias("id"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    steps = [i / (4 * parts) for i in range(1, 4 * parts)]
    bounds = rows.agg(F.percentile_approx("id", steps, 10_000)).first()[0] or []
    cuts = [float("-inf"), *sorted({float(x) for x in bounds} or {0.0}), float("inf")]
    bucketed = lambda df: Bucketizer(splits=cuts, inputCol="d", outputCol="b").transform(df.withColumn("d", F.col("id").cast("double"))).withColumn("b", F.col("b").cast("int"))
    firsts = sorted(bucketed(rows.select("id")).groupBy("b").agg(F.min("id").alias("id")).collect())
    if not firsts:
        return rows.select(F.lit(0).alias("b"), F.lit(0).alias("ghost"), "id", "doc_id", "text")
    before = {r["b"]: firsts[i - 1]["b"] for i, r in enumerate(firsts)}
    targets = F.array(*[F.lit(before.get(b, 0)) for b in range(len(cuts) - 1)])
    at = bucketed(rows).withColumn("own", F.struct(F.col("b").alias("b"), F.lit(0).alias("ghost")))
    ghost = F.struct(F.get(targets, F.col("b")).alias("b"), F.lit(1).alias("ghost"))
    is_first = F.col("id").isin([r["id"] for r in firsts])
    sent = at.select("id", "doc_id", "text", F.explode(F.when(is_first, F.array("own", ghost)).otherwise(F.array("own"))).alias("to"))
    sent = sent.select("to.b", "to.ghost", "id", "doc_id", "text")
    return sent.repartition(parts, "b").sortWithinPartitions("b", "ghost", "id", "text")


def fingerprint_with_edits(docs: DataFrame) -> DataFrame:
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            d, out = batch.to_pydict(), [[] for _ in range(7)]
            for b, ghost, doc_id, text in zip(d["b"], d["ghost"], d["doc_id"], d["text"]):
                own = digest(text)
                if held is not None and held[0] == b:
                    _, was_id, was_text, was = held
                    changed = edited(was_text, text)
                    print_ = digest(changed)
                    row = (was_id, len(was_text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), was, print_, likeness(was, print_), likeness(was, own))
                    for column, v in zip(out, row):
                        column.append(v)
                held = None if ghost else (b, doc_id, text, own)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return in_order_with_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op5_bucket_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
