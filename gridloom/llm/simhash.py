"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link at up to `distance` differing bits. Cut into k = floor(distance / 2) + 1 segments, two
linked fingerprints have a segment that differs by one bit at most. Every fingerprint is therefore indexed under each
of its segments with each single bit wiped out (64 keys in all): two linked fingerprints share a key, whatever the bit.
An equality join on the keys finds the candidates and the differing bits are counted inside the join's condition.

Groups of near copies are not expanded into pairs. Distinct fingerprints only are indexed. In a first round each
member of a key's bucket is compared with the bucket's smallest and largest members, and the links found are contracted into
components. In a second round the members outside the bucket's largest component are compared with all members of
other components, each pair under the first key it shares. A linked pair of one bucket is either inside one component after the first round or has a member
outside the largest one, so no link is lost.

Cases: null text counts as empty; texts without words have fingerprint zero and link like any other; very long texts
are read whole, their shingles counted in pieces; equal fingerprints are one node, so copies cost nothing; repeated rows
keep a row each; columns other than doc_id and text are only passed on, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.common import components, cut, small_side, text_batches, text_or_empty


def fingerprint(text: str | None, shingle: int = 4) -> bytes:
    """8 bytes, highest bit first: the majority of each bit over the XXH64 (seed 42) of all word shingles."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return bytes(8)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    digests = b"".join([xxh64_digest(line[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())])
    n, counts = len(digests) // 8, np.zeros(64, np.int64)
    packed = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 16):
        counts += np.unpackbits(packed[i : i + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, row_hash, fp): fp as a signed 64-bit integer, row_hash of the text to tell rows of one doc_id apart."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [int.from_bytes(fingerprint(t, shingle), "big", signed=True) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.int64())], names=["doc_id", "row_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("row_hash"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, row_hash long, fp long")


def variant_masks(distance: int, bits: int = 64) -> list[int]:
    """Signed masks: every segment without each one of its bits."""
    k, out = distance // 2 + 1, []
    for s in range(k):
        lo, hi = s * bits // k, (s + 1) * bits // k
        segment = (1 << hi) - (1 << lo)
        out += [segment & ~(1 << b) for b in range(lo, hi)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in out]


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def first_shared(difference: Column, masks: list[int]) -> Column:
    """The first key that two fingerprints share, from the bits in which they differ."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(masks))):
        out = F.when(difference.bitwiseAND(F.lit(masks[i])) == 0, F.lit(i)).otherwise(out)
    return out


def linked_components(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(fp, component) for each distinct fp that has a link; component is the smallest fp reachable.

    Sizes, smallest and largest members of buckets are aggregations, combined before the shuffle; only members of
    buckets of three or more are looked up again, and no task holds a bucket.
    """
    masks = variant_masks(distance)
    key = ["variant", "bits"]
    keys = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias(*key))
    buckets = keys.groupBy(*key).agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count("*").alias("n")).filter("n > 1")
    buckets = cut(buckets, "buckets")
    # Most buckets hold two fingerprints that met by chance: their smallest and largest are all there is to compare.
    pairs = buckets.filter(_near("low", "high", distance)).select(F.col("low").alias("fp"), F.col("high").alias("pivot"))
    members = cut(keys.join(small_side(cut(buckets.filter("n > 2"), "crowds")), key), "variants")
    met = [members.filter((F.col("fp") != F.col(p)) & _near("fp", p, distance)).select("fp", F.col(p).alias("pivot")) for p in ("low", "high")]
    labels = cut(components(pairs.union(met[0]).union(met[1])), "first")
    larger = members.select(*key, "fp").join(small_side(labels).withColumnRenamed("node", "fp"), "fp", "left")
    larger = cut(larger.select(*key, "fp", F.coalesce("component", "fp").alias("c")), "larger")
    per = larger.groupBy(*key, "c").agg(F.count("*").alias("m"))
    main = per.groupBy(*key).agg(F.max(F.struct("m", "c")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
    main = small_side(cut(main.select(*key, F.col("top.c").alias("main")), "main"))
    outside = larger.join(main, key).filter("c <> main").select(*key, F.col("fp").alias("x"), F.col("c").alias("cx"))
    once = first_shared(F.col("x").bitwiseXOR(F.col("fp")), masks) == F.col("l.variant")
    probe = (F.col("cx") != F.col("c")) & _near("x", "fp", distance) & once
    across = outside.alias("o").join(larger.alias("l"), (F.col("o.variant") == F.col("l.variant")) & (F.col("o.bits") == F.col("l.bits")) & probe).select("cx", "c")
    across = cut(across.distinct(), "across")
    if across.isEmpty():
        return labels.select(F.col("node").alias("fp"), "component")
    second = components(across)
    joined = labels.union(second.select(F.col("node"), F.col("component"))).select(F.col("node").alias("fp"))
    joined = joined.distinct().join(labels.select(F.col("node").alias("fp"), F.col("component").alias("c1")), "fp", "left").withColumn("c1", F.coalesce("c1", "fp"))
    return joined.join(second.select(F.col("node").alias("c1"), F.col("component").alias("c2")), "c1", "left").select("fp", F.coalesce("c2", "c1").alias("component"))


def classes(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """One row per input row: doc_id, row_hash, fp, component (smallest fp), component_id (smallest doc_id linked)."""
    rows = cut(fingerprints(docs, shingle), "fingerprints")
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    linked = cut(linked_components(nodes.select("fp"), distance), "linked")
    named = nodes.join(small_side(linked), "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    ids = linked.join(nodes, "fp").groupBy("component").agg(F.min("first_id").alias("least"))
    table = named.join(small_side(cut(ids, "ids")), "component", "left").select("fp", "component", F.coalesce("least", "first_id").alias("component_id"))
    return rows.join(table, "fp").select("doc_id", "row_hash", "fp", "component", "component_id")


def keep_one(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """docs with one row of each class: the smallest (doc_id, row_hash), once even if that row repeats."""
    c = classes(docs, distance, shingle)
    best = c.groupBy("component").agg(F.min(F.struct("doc_id", "row_hash")).alias("b")).select(F.col("b.doc_id").alias("__keep_id"), F.col("b.row_hash").alias("__keep_hash"))
    named = docs.withColumn("__row_hash", F.xxhash64(text_or_empty()))
    kept = named.join(best, F.col("doc_id").cast("long").eqNullSafe(F.col("__keep_id")) & (F.col("__row_hash") == F.col("__keep_hash")))
    once = W.partitionBy("__keep_id", "__keep_hash").orderBy(F.lit(0))
    return kept.withColumn("__nth", F.row_number().over(once)).filter("__nth = 1").select(*docs.columns)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return c.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
