"""Packing documents into sequences of bounded length.

A configuration linear program over the histogram of piece lengths is solved by multiplicative weights: every length
has a price, a knapsack dynamic program finds the dearest configurations under the prices, and the prices of what they
cover fall, until all of the histogram is covered. The solution is rounded down to whole multiplicities and what this
leaves is packed best-fit decreasing. The program sees only the histogram, which has at most `capacity` rows whatever
the corpus; the pieces themselves are numbered within their length on Spark, the pieces of a frequent length in many
blocks, and look their place up in the plan.

Cases: null text counts as empty (one end id); very long texts are encoded whole and cut into as many pieces as they
need; documents with an equal doc_id are told apart by their text and are packed each, repeated rows too; columns other
than doc_id and text are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridloom.llm.bpe import END_ID, default_tokenizer, encoder
from gridloom.llm.common import cut, text_batches, text_or_empty

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, tie long"
#: Pieces of one length that a task numbers; frequent lengths are dealt over as many blocks as that takes.
BLOCK_ROWS = 50_000


def cut_pieces(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ids by the tokenizer, end id appended, longer documents cut so that only the first piece is short."""
    path, spark = tokenizer or default_tokenizer(), docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), struct.pack("<I", END_ID)
        for batch in batches:
            d, out = batch.to_pydict(), [[] for _ in range(6)]
            for doc, tie, ids in zip(d["doc_id"], d["tie"], encode.encode_many(d["text"])):
                ids += end
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    for column, v in zip(out, (doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), tie)):
                        column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "tie"])

    return rows.mapInArrow(pieces, PIECES)


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(highest total price that fits, piece that reaches it) for every room from 0 to capacity; -1 where a smaller room does as well.

    The unbounded knapsack by dynamic program, O(capacity * lengths); lengths descend, so of equal values the one with
    longer pieces wins.
    """
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    first = len(lengths) - np.searchsorted(lengths[::-1], np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        k = first[c]
        if k < len(lengths):
            total = prices[k:] + value[c - lengths[k:]]
            j = int(total.argmax())
            if total[j] > value[c] + 1e-12:
                value[c], choice[c] = total[j], k + j
    return value, choice


def _filled(counts: dict[int, int], lengths: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """counts with the longest pieces left added as long as one fits; lengths descend."""
    counts = {j: k for j, k in counts.items() if k > 0}
    room, left = capacity - sum(int(lengths[j]) * k for j, k in counts.items()), most.copy()
    for j, k in counts.items():
        left[j] -= k
    at = 0
    while True:
        at = max(at, len(lengths) - int(np.searchsorted(lengths[::-1], room, side="right")))
        more = np.flatnonzero(left[at:] >= 1)
        if not len(more):
            return counts
        at += int(more[0])
        take = min(int(left[at]), room // int(lengths[at]))
        if take < 1:
            continue
        counts[at] = counts.get(at, 0) + take
        room -= take * int(lengths[at])
        left[at] -= take
        at += 1


def priced_configurations(lengths: np.ndarray, prices: np.ndarray, rest: np.ndarray, capacity: int, within: float) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(total price, lengths used, their counts) of the best configurations with each open length, dearest first.

    One dynamic program prices them all; those that lie `within` the dearest are returned. The program takes a length any
    number of times: counts above what is left of it are cut down, and the room this gives is filled with the longest
    pieces left that fit.
    """
    value, choice = knapsack(lengths, prices, capacity)
    at = np.maximum.accumulate(np.where(choice >= 0, np.arange(capacity + 1), 0))
    total, most = np.where(rest > 0, prices + value[capacity - lengths], -1.0), np.ceil(rest - 1e-9)
    out, best = [], 0.0
    for i in np.argsort(-total, kind="stable"):
        if total[i] < (1 - within) * best or total[i] < 0:
            break
        counts, c = {int(i): 1}, int(at[capacity - lengths[i]])
        while choice[c] >= 0:
            j = int(choice[c])
            counts[j] = counts.get(j, 0) + 1
            c = int(at[c - lengths[j]])
        if any(k > most[j] for j, k in counts.items()):
            counts = _filled({j: min(k, int(most[j])) for j, k in counts.items()}, lengths, most, capacity)
        used = np.fromiter(counts, np.int64, len(counts))
        n = np.fromiter(counts.values(), np.int64, len(counts))
        price = float(prices[used] @ n)
        best = max(best, price)
        out.append((price, used, n))
    return sorted((x for x in out if x[0] >= (1 - within) * best), key=lambda x: -x[0])


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, within: float = 0.01, step: float = 0.3, rate: float = 0.1, bias: float = 0.2) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, float]:
    """(configurations, fractional multiplicities, lower bound) for the program min sum x, config @ x >= demand.

    Multiplicative weights: the price of a length is (length / capacity)^(1 + bias), times exp(-rate * covered share of
    its demand), and none once it is covered. Each round prices the configurations by the knapsack program and takes all
    that lie `within` the dearest one, each as often as leaves no length covered by more than `step` of its demand
    (or one piece) in the round. The bias lets long pieces, which are hard to place, be covered while short ones are left.
    It ends when all demand is covered. The bound is sum(length * demand) / capacity: prices of length / capacity are
    feasible in the dual program.
    """
    demand = demand.astype(np.float64)
    rest, base = demand.copy(), (lengths / capacity) ** (1 + bias)
    found: dict[tuple[bytes, bytes], float] = {}
    while (rest > 0).any():
        prices = np.where(rest > 0, base * np.exp(-rate * (1 - rest / demand)), 0.0)
        room = np.minimum(rest, np.maximum(step * demand, 1.0))
        for k, (_, used, counts) in enumerate(priced_configurations(lengths, prices, rest, capacity, within)):
            one = min(1.0, float((rest[used] / counts).min()))
            times = max(float((room[used] / counts).min()), one if k == 0 else 0.0)
            if times < one - 1e-9:
                continue
            key = (used.tobytes(), counts.tobytes())
            found[key] = found.get(key, 0.0) + times
            rest[used] -= counts * times
            room[used] -= counts * times
        rest[rest < 1e-9] = 0.0
    configs = [(np.frombuffer(u, np.int64), np.frombuffer(n, np.int64)) for u, n in found]
    return configs, np.array(list(found.values())), float(lengths @ demand) / capacity


def plan(lengths: list[int], demand: list[int], capacity: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence in order, how many such sequences)]: covers exactly the demand.

    The program's multiplicities are rounded down and the pieces that this leaves are packed best-fit decreasing. The
    configurations taken last, when little was left to choose from, waste most and may be left to best-fit too: of the
    roundings that keep those with at most so much waste, as long as they are the greater part, the one with the fewest
    sequences is used.
    """
    order = np.argsort(lengths)[::-1]
    size, demand_ = np.array(lengths, np.int64)[order], np.array(demand, np.int64)[order]
    full: list[tuple[tuple[int, ...], int]] = []
    if len(size) and size[0] == capacity:
        full, size, demand_ = [((capacity,), int(demand_[0]))], size[1:], demand_[1:]
    if not len(size):
        return full
    configs, x, _ = solve(size, demand_, capacity)
    whole = [(u, n, int(t), capacity - int(size[u] @ n)) for (u, n), t in zip(configs, np.floor(x + 1e-9)) if t >= 1]
    best: list[tuple[tuple[int, ...], int]] | None = None
    for most in (capacity, 64, 16, 4, 1, 0):
        left, out = demand_.copy(), []
        for used, counts, times, waste in whole:
            times = min(times, int((left[used] // counts).min())) if waste <= most else 0
            if times > 0:
                left[used] -= counts * times
                out.append((tuple(int(size[j]) for j, c in sorted(zip(used, counts)) for _ in range(c)), times))
        kept = sum(t for _, t in out)
        out += best_fit(size, left, capacity)
        if best is None or sum(t for _, t in out) < min(2 * kept, sum(t for _, t in best)):
            best = out
    return full + best


def best_fit(size: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: each new sequence takes the largest length that still fits, as often as it repeats. Sizes descend."""
    out, left = [], left.copy()
    while left.any():
        config, room = np.zeros_like(left), capacity
        for j in range(len(size)):
            take = min(int(left[j]), room // int(size[j]))
            if take:
                config[j], room = take, room - take * int(size[j])
        j_last = np.flatnonzero(config)
        times = max(1, int((left[j_last] // config[j_last]).min()))
        left -= config * times
        out.append((tuple(int(s) for s, c in zip(size, config) for _ in range(c)), times))
    return out


def place_table(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, pieces a sequence, first sequence and offset of the first such piece, of each stretch of ranks."""
    at: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    first = 0
    for config, times in chosen:
        offset = 0
        for length in dict.fromkeys(config):
            each = config.count(length)
            rows.setdefault(length, []).append((at.get(length, 0), each, first, offset))
            at[length] = at.get(length, 0) + each * times
            offset += each * length
        first += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()}


def pack(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every piece with its sequence_id and offset. The histogram (at most `capacity` rows) is all that the driver sees."""
    pieces = cut(cut_pieces(docs, capacity, tokenizer), "pieces")
    hist = pieces.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()
    places = place_table(plan([r[0] for r in hist], [r[1] for r in hist], capacity)) if hist else {}
    blocks = docs.sparkSession.createDataFrame([(r[0], -(-r[1] // block_rows)) for r in hist], "length long, blocks long")
    pieces = pieces.join(F.broadcast(blocks), "length")  # `capacity` rows at most
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "tie", "piece"), F.col("blocks")))
    counts = pieces.groupBy("length", "block").count()
    base = counts.select("length", "block", (F.sum("count").over(W.partitionBy("length").orderBy("block")) - F.col("count")).alias("base"))
    own = W.partitionBy("length", "block").orderBy(F.col("doc_id").asc_nulls_first(), "tie", "piece", "start")
    ranked = pieces.withColumn("within", F.row_number().over(own) - 1).join(base, ["length", "block"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("within")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                own = length == k
                lo, each, first, at = places[int(k)]
                j = np.searchsorted(lo, rank[own], side="right") - 1
                inside = rank[own] - lo[j]
                sequence[own], offset[own] = first[j] + inside // each[j], at[j] + inside % each[j] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
