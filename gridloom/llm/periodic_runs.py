"""Runs of repeated word groups in texts, by Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping q. Every run
has a root: a Lyndon word (smaller than all its proper suffixes) of length q that is the longest Lyndon word beginning at
its place, under the order of words or under the reversed order. So each document is scanned from right to left under
both orders with a stack of Lyndon words: at word i the factor beginning there swallows the next factor as long as the
suffix at i is the smaller one, which leaves nxt[i], the end of the longest Lyndon word at i. Wherever the word at
nxt[i] equals that at i, the pair is extended to both sides; what comes out with at least the wanted length is a run.

Suffixes are compared, and pairs extended to the right, by their longest common extension: a few words are compared
directly; where they agree, binary search over a rolling hash finds the length, and the words it covers are compared
themselves, so a collision costs time and never a wrong answer. Stretches that were compared are remembered by
distance, so a long run is verified once and not again from each of its words. Extensions to the left go likewise over
hashes. No suffix array is built, and memory is a few lists of the length of one document.

Documents are independent: no shuffle, no state between rows. One document is one unit of work.

Cases: a null text counts as empty; texts without words have no run; very long texts are read whole; repeated rows give
a row each; a null doc_id is an id like any other; other columns of the input stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import text_batches, text_or_empty

ADDED = ("n_words", "runs", "collapsed_text")
ADDED_SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string"
ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
MOD, BASE = (1 << 61) - 1, 1_000_003_579
#: So many words are compared one by one before hashes are asked.
DIRECT = 8


class Extensions:
    """Longest common extensions of one sequence of word numbers."""

    def __init__(self, ids: list[int]):
        self.ids, self.n = ids, len(ids)
        self.hashes: list[int] | None = None
        self.powers: list[int] = []
        self.known: dict[int, tuple[int, int]] = {}

    def _same(self, i: int, j: int, k: int) -> bool:
        """Whether the hashes of k words from i and from j agree."""
        h, p = self.hashes, self.powers[k]
        return (h[i + k] - h[i] * p - h[j + k] + h[j] * p) % MOD == 0

    def _hash(self) -> None:
        if self.hashes is None:
            self.hashes = list(accumulate(self.ids, lambda h, x: (h * BASE + x + 1) % MOD, initial=0))
            self.powers = list(accumulate(range(self.n), lambda p, _: p * BASE % MOD, initial=1))

    def right(self, i: int, j: int) -> int:
        """Number of equal words from i and from j on, i < j."""
        ids, n, d = self.ids, self.n, j - i
        stop = min(j + DIRECT, n)
        k = j
        while k < stop and ids[k] == ids[k - d]:
            k += 1
        if k < stop or k == n:
            return k - j
        lo, hi = self.known.get(d, (n, n))
        if lo <= i <= hi:
            return hi - i
        self._hash()
        low, high = DIRECT, n - j
        while low < high:  # the largest length whose hashes agree
            mid = (low + high + 1) // 2
            if self._same(i, j, mid):
                low = mid
            else:
                high = mid - 1
        end = i + low
        until = min(end, lo) if i < lo <= end else end  # what is known to be equal from lo on is not compared again
        if ids[i:until] != ids[j : until + d]:
            end = next(x for x in range(i, until) if ids[x] != ids[x + d])
        elif until < end:
            end = hi
        self.known[d] = (i, end)
        return end - i

    def left(self, i: int, j: int) -> int:
        """Number of equal words that end before i and before j, i < j."""
        ids = self.ids
        k = 0
        while k < i and k < DIRECT and ids[i - 1 - k] == ids[j - 1 - k]:
            k += 1
        if k < DIRECT or k == i:
            return k
        self._hash()
        low, high = k, i
        while low < high:
            mid = (low + high + 1) // 2
            if self._same(i - mid, j - mid, mid):
                low = mid
            else:
                high = mid - 1
        if ids[i - low : i] != ids[j - low : j]:
            low = next(x for x in range(low) if ids[i - 1 - x] != ids[j - 1 - x])
        return low


def lyndon_pairs(rank: list[int], ext: Extensions) -> Iterator[tuple[int, int]]:
    """(i, nxt[i]) for which the words there are equal; rank: the sequence in one order, with a lowest value at its end."""
    n = len(rank) - 1
    nxt = [0] * n
    for i in range(n - 1, -1, -1):
        a, j = rank[i], i + 1
        while True:
            b = rank[j]
            if a < b:
                j = nxt[j]
            elif a > b:
                break
            else:
                k = ext.right(i, j)
                if rank[i + k] < rank[j + k]:
                    j = nxt[j]
                else:
                    break
        nxt[i] = j
        if rank[j] == a:
            yield i, j


def runs_of(words: list, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with at least max(least, exponent * period) words, exponent 2 or more, sorted."""
    place: dict = {}
    ids = [place.setdefault(w, len(place)) for w in words]
    n = len(ids)
    if n < max(least, exponent) or len(place) == n:
        return []
    ext, found = Extensions(ids), {}
    for rank in ([*ids, -1], [*(-x for x in ids), -n]):
        last: dict[int, tuple[int, int]] = {}  # of each period the run met last: its other roots need no second look
        for i, j in lyndon_pairs(rank, ext):
            q = j - i
            a, b = last.get(q, (n, n))
            if a <= i and j < b:
                continue
            start, end = i - ext.left(i, j), j + ext.right(i, j)
            if end - start >= 2 * q:
                last[q] = (start, end)
                if end - start >= max(least, exponent * q):
                    found[start, q] = end - start
    return sorted((s, length, q) for (s, q), length in found.items())


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return [w for w, g in zip(words, gone) if not g]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """docs with n_words, runs (start, length, period, sorted by start, then period) and collapsed_text.

    runs are those of max(least, exponent * period) words or more; exponent is at least 2. collapsed_text keeps the words
    outside of what repeats, joined by single spaces. Columns of docs with these names are replaced.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    text_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ADDED]
    work = next(c for c in (f"__text{i}" for i in range(len(rest) + 1)) if c not in rest)
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, *T._parse_datatype_string(ADDED_SCHEMA).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, runs, kept = [], [], []
            for t in batch.column(len(rest)).to_pylist():
                words = t.encode().split()  # bytes split at the six ASCII blanks
                found = runs_of(words, least, exponent)
                n.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                kept.append(b" ".join(collapsed(words, found)).decode())
            added = [pa.array(n, pa.int64()), pa.array(runs, ARROW_RUNS), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *added], names=[*rest, *ADDED])

    return docs.select(*[F.col(f"`{c}`") for c in rest], text_or_empty(f"`{text}`").alias(work)).mapInArrow(scan, schema)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by crc32 of its id, the words from a on repeat with a period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, at(i).cast("int"))), " ")).otherwise(F.lit(""))

    edited = F.get(F.transform(F.array(words), repeat), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, edited).otherwise(text_or_empty()).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    # a / b > c / d as a * d > c * b: exact
    better = lambda x, y: (x["length"] * y["period"] > y["length"] * x["period"]) | ((x["length"] * y["period"] == y["length"] * x["period"]) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda acc, x: F.when(better(x, acc), x).otherwise(acc))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))), "")
    d = d.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    return d.select(
        "doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"),
        F.floor(1000 * F.col("b.length") / F.col("b.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
