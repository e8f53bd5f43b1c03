"""Class-based n-gram language model: exchange clustering of words, class transitions and word emissions.

P(word | word before) = P(class | class before) * P(word | class). Tokens are words with A-Z lower-cased, then one end
per document; the end has a class of its own and is also what comes before the first word.

* Counts of all words of the training documents are summed by word. The FREQUENT first words by count are numbered and
  known to every task; any other has at most a 1/FREQUENT share of all tokens and is looked up by joins.
* Documents are coded once: numbers of frequent words, and places in the document's own list of other words.
* Exchange clustering (Brown et al. 1992; Uszkoreit and Brants 2008): the first CLUSTERED words start in classes by rank. Their
  neighbour counts are one row a word. In a round each task takes its words in turn, takes each out of its class, puts it
  where the likelihood of the class bigrams gains most (all terms, not an approximation), and goes on with its own
  changed tables; between rounds all moves come together. A round that would lower the likelihood is retried with half of
  its moves, so it never falls.
* Every other word then takes the class that gains most, to the first order, by its counts with the classes of its
  neighbours. All words of the training documents have a count and a class, whatever their number.
* Transitions count all tokens under the final classes, smoothed by `prior` tokens spread as the classes are. What comes
  instead of a word that training never saw is one event, as in the unigram base: its share after a class is that of
  words met once (left out, each of them would be unknown), and after an unknown word transitions are those after words
  met once. P over all words and the unknown event sums to 1 after any class.

The driver holds FREQUENT words and tables of classes squared. Rows of a hot word are summed before they are shuffled.

Cases: a null or empty text is one end; a null doc_id counts as an empty id (it trains); repeated rows are documents of
their own; very long texts are read whole; without training documents every score is 0 (as the base); an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import cut, drop_cut, drop_files, file_parts, free_shuffles, text_batches, text_or_empty

#: Words that every task knows, and those among them that exchange clustering moves.
FREQUENT = 1 << 17
CLUSTERED = 1 << 14
#: Distinct entries that a task gathers before it passes them on.
HELD = 500_000
#: Parts of the coded documents that are tagged one after the other; each shuffles its codes and other words, then frees them.
PARTS = 4
END = ""


def tokens(text: str) -> list[bytes]:
    """Lower-cased words (bytes fold A-Z only and split at the six ASCII blanks)."""
    return text.encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all tokens of (text); the end is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        held: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                held.update(tokens(t))
            held[b""] += b.num_rows
            if len(held) > HELD:
                yield out()
                held.clear()
        yield out()

    return docs.select(text_or_empty().alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Numbers(dict):
    """Numbers of the frequent words; any other word gets -1 - its place among the others of the document, `mine`."""

    mine: dict[bytes, int]

    def __missing__(self, word: bytes) -> int:
        return -1 - self.mine.setdefault(word, len(self.mine))


def coded(docs: DataFrame, learn: Column, frequent: list[str]) -> DataFrame:
    """(row, doc_id, learn, codes, others): 32-bit codes, a frequent word's number or -1 - its place among the document's others."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Numbers((w.encode(), i) for i, w in enumerate(known.value))
        end = np.array([number[b""]], np.int32).tobytes()
        for b in batches:
            codes, others = [], []
            for t in b.column("text").to_pylist():
                words, number.mine = tokens(t), {}
                codes.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)).tobytes() + end)
                others.append(pa.array(list(number.mine), pa.binary()).cast(pa.string()))
            names = pa.chunked_array(others, pa.string()).combine_chunks()
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, others)], dtype=np.int32)), names)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), b.column("learn"), pa.array(codes, pa.binary()), lists], names=["row", "doc_id", "learn", "codes", "others"])

    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", learn.alias("learn"), text_or_empty().alias("text"))
    return cut(d.mapInArrow(code, f"row long, doc_id {dict(docs.dtypes)['doc_id']}, learn boolean, codes binary, others array<string>"), "coded")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the length of each list."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a batch of documents, and the number of each document."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.int32), np.array([len(x) // 4 for x in parts], dtype=np.int64)


def neighbours(train: DataFrame, h: int) -> DataFrame:
    """(id, others, counts): of each of the first h words its counts with the word after it (0 to h) and before it (h + 1 on).

    h stands for all other words. A document's first word comes after the end of the one before, whichever it is.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            keys, at = np.unique(np.concatenate(held), return_inverse=True)
            n = np.bincount(at, np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array((keys // (h + 1)).astype(np.int32)), pa.array((keys % (h + 1)).astype(np.int32)), pa.array(n.astype(np.int64))], names=["u", "v", "n"])

        held, counts, size = [], [], 0
        for b in batches:
            flat, _ = _codes(b.column("codes"))
            ids = np.where(flat < 0, h, np.minimum(flat, h)).astype(np.int64)
            key, n = np.unique(np.concatenate([[0], ids[:-1]]) * (h + 1) + ids, return_counts=True)
            held.append(key)
            counts.append(n)
            size += len(key)
            if size > 4 * HELD:
                yield out()
                held, counts, size = [], [], 0
        if held:
            yield out()

    p = train.select("codes").mapInArrow(pairs, "u int, v int, n long").groupBy("u", "v").agg(F.sum("n").alias("n"))
    both = F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("other"), "n"), F.struct(F.col("v").alias("id"), (F.col("u") + h + 1).alias("other"), "n"))
    # At most 2 (H + 1) entries a word.
    both = p.select(F.explode(both).alias("x")).select("x.*").filter(F.col("id") < h)
    return cut(both.groupBy("id").agg(F.collect_list("other").alias("others"), F.collect_list("n").alias("counts")), "neighbours")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.where(x > 0, x, 1.0))


def likelihood(table: np.ndarray) -> float:
    """The part of the log-likelihood that depends on classes: of counts of class pairs."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def exchange(table: np.ndarray, own: int, right: np.ndarray, left: np.ndarray, self_n: float, k: int) -> tuple[int, float, np.ndarray]:
    """(best class, gain over staying, table after the move) of one word; right, left: its counts by class after and before it."""
    t = table.copy()
    t[own] -= right
    t[:, own] -= left
    t[own, own] += self_n
    r, c = right.copy(), left.copy()
    r[own] -= self_n
    c[own] -= self_n
    rows, cols = (t.sum(1) + c)[:k], (t.sum(0) + r)[:k]  # what comes before and after the word is there whatever its class
    m, w = t[:k], t[:, :k].T
    d = np.arange(k)
    a, b = np.flatnonzero(r), np.flatnonzero(c)
    gain = (_xlogx(m[:, a] + r[a]) - _xlogx(m[:, a])).sum(1) + (_xlogx(w[:, b] + c[b]) - _xlogx(w[:, b])).sum(1)
    # The cell of a class with itself takes from both sides.
    x = t[d, d]
    gain += _xlogx(x + r[:k] + c[:k] + self_n) + _xlogx(x) - _xlogx(x + r[:k]) - _xlogx(x + c[:k])
    gain -= _xlogx(rows + right.sum()) - _xlogx(rows) + _xlogx(cols + left.sum()) - _xlogx(cols)
    best = int(gain.argmax())
    if gain[best] <= gain[own] + 1e-7:
        best = own
    t[best] += r
    t[:, best] += c
    t[best, best] += self_n
    return best, float(gain[best] - gain[own]), t


def _class_tables(near: DataFrame, classes: np.ndarray, n: int) -> DataFrame:
    """(counts): a table of class pairs from each task, as bytes."""
    h = len(classes) - 1

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n)
        for b in batches:
            other, size = _flat(b.column("others"))
            count, _ = _flat(b.column("counts"))
            own = classes[np.repeat(b.column("id").to_numpy(), size)]
            after = other <= h
            total += np.bincount(own[after] * n + classes[other[after]], count[after], n * n)
            rest = other == 2 * h + 1
            total += np.bincount(classes[h] * n + own[rest], count[rest], n * n)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.int64).tobytes()], pa.binary())], names=["counts"])

    return near.mapInArrow(tables, "counts binary")


def _class_table(near: DataFrame, classes: np.ndarray, n: int) -> np.ndarray:
    """Counts of class pairs over the neighbour counts; pairs after words that are not frequent come from the other side."""
    rows = _class_tables(near, classes, n).collect()  # a task's classes squared; the neighbours of CLUSTERED words are a few tasks
    return sum((np.frombuffer(r["counts"], np.int64) for r in rows), np.zeros(n * n, np.int64)).astype(float).reshape(n, n)


def cluster(near: DataFrame, h: int, end: int, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each frequent word and of the rest, class pairs, likelihood after each round). Class k is the end's, k + 1 the rest's."""
    n = k + 2
    classes = np.append(np.arange(h) % k, k + 1)
    classes[end] = k
    table = _class_table(near, classes, n)
    history = [likelihood(table)]
    for _ in range(rounds):
        now, was = table, classes

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine, t = was.copy(), now.copy()
            for b in batches:
                ids, to, gains = b.column("id").to_numpy(), [], []
                other, size = _flat(b.column("others"))
                count, _ = _flat(b.column("counts"))
                stop = np.cumsum(size)
                for i, lo, hi in zip(ids, stop - size, stop):
                    if i == end:
                        to.append(k)
                        gains.append(0.0)
                        continue
                    o, c = other[lo:hi], count[lo:hi]
                    after = o <= h
                    right = np.bincount(mine[o[after]], c[after], n)
                    left = np.bincount(mine[o[~after] - h - 1], c[~after], n)
                    best, gain, t = exchange(t, int(mine[i]), right, left, float(c[o == i].sum()), k)
                    mine[i] = best
                    to.append(best)
                    gains.append(gain)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(to, pa.int32()), pa.array(gains, pa.float64())], names=["id", "to", "gain"])

        moved = [r for r in near.mapInArrow(move, "id int, to int, gain double").collect() if r["to"] != classes[r["id"]]]  # a row a frequent word
        moved.sort(key=lambda r: (-r["gain"], r["id"]))
        while moved:
            trial = classes.copy()
            trial[[r["id"] for r in moved]] = [r["to"] for r in moved]
            after = _class_table(near, trial, n)
            if likelihood(after) > history[-1]:
                classes, table = trial, after
                break
            moved = moved[: len(moved) // 2]
        history.append(likelihood(table))
        if not moved:
            break
    return classes, table, history


def other_words(train: DataFrame, frequent: list[str], classes: np.ndarray, table: np.ndarray, k: int) -> DataFrame:
    """(word, n, class) of the words that were not clustered: the class that gains most by their neighbours' classes."""
    h, n = len(classes) - 1, k + 2
    sent = train.sparkSession.sparkContext.broadcast(frequent[h:])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = pa.chunked_array(names).dictionary_encode().combine_chunks()
            at = words.indices.to_numpy()[np.concatenate(held)].astype(np.int64)
            key, count = np.unique(at * (n * n) + np.concatenate(around), return_counts=True)
            return pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(key // (n * n))), pa.array((key % (n * n)).astype(np.int32)), pa.array(count.astype(np.int64))], names=["word", "around", "n"])

        known = pa.array(sent.value, pa.string())
        names, held, around, base = [known], [], [], len(known)
        for b in batches:
            flat, size = _codes(b.column("codes"))
            mine, own = b.column("others").flatten(), b.column("others").value_lengths().to_numpy(zero_copy_only=False)
            c = classes[np.where(flat < 0, h, np.minimum(flat, h))]
            ends = np.append(c[1:], k)
            pair = np.concatenate([[k], c[:-1]]) * n + ends
            wanted = (flat < 0) | (flat >= h)
            first = np.repeat(np.cumsum(own) - own, size)
            names.append(mine)
            held.append(np.where(flat < 0, base + first - 1 - flat, flat - h)[wanted])
            around.append(pair[wanted])
            base += len(mine)
            if base > len(known) + HELD or sum(map(len, held)) > 4 * HELD:
                yield out()
                names, held, around, base = [known], [], [], len(known)
        if held:
            yield out()

    # Dealt by word once, for both sums; a task has summed what it met, so a word comes from it at most classes squared times.
    seen = train.select("codes", "others").mapInArrow(contexts, "word string, around int, n long").repartition("word").groupBy("word", "around").agg(F.sum("n").alias("n"))
    # Classes squared entries a word at most.
    per_word = seen.groupBy("word").agg(F.sum("n").alias("n"), F.collect_list("around").alias("arounds"), F.collect_list("n").alias("counts"))
    rows, cols = table.sum(1), table.sum(0)
    weight = np.log((table + 0.1) / np.outer(rows + 0.1 * n, cols + 0.1 * n))
    gains = (weight[:k][:, None, :] + weight[:, :k].T[:, :, None]).reshape(k, n * n).T.copy()  # of a word between classes (l, r)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            around, size = _flat(b.column("arounds"))
            count, _ = _flat(b.column("counts"))
            best = []
            starts, lo = np.cumsum(size) - size, 0
            while lo < len(size):  # so many entries at a time bound the matrix of gains; a word has at most n * n
                hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + 20_000, side="right")) - 1) if starts[-1] > starts[lo] + 20_000 else len(size)
                part = slice(starts[lo], starts[hi - 1] + size[hi - 1])
                best.append(np.add.reduceat(gains[around[part]] * count[part][:, None], starts[lo:hi] - starts[lo]).argmax(1))
                lo = hi
            chosen = np.concatenate(best) if best else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), pa.array(chosen.astype(np.int32))], names=["word", "n", "class"])

    return cut(per_word.mapInArrow(choose, "word string, n long, class int"), "others")


@dataclass
class ClassModel:
    """What training gathers: classes of all words (a table) and tables of classes squared."""

    words: DataFrame  # word, n, class; the end is the empty word
    n_tokens: int
    n_words: int
    class_tokens: np.ndarray
    log_next: np.ndarray  # log10 P(class | class before); the last row and column are the unknown event
    history: list[float]


def tagged(codes: DataFrame, frequent_n: np.ndarray, frequent_class: np.ndarray, others: DataFrame, n_tokens: int, n_words: int, k: int) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, base_score, log_n, tags): a tag is a token's class, plus 128 for words met once; k + 1 is unknown.

    codes, a cut() table, is used up: the files of a part go once it is tagged.
    """
    words = others.hint("merge")  # sent to all tasks it takes 15 times the room of its files
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)

    def looked_up(part: DataFrame) -> DataFrame:
        wanted = part.select("row", F.posexplode("others").alias("place", "word"))
        found = wanted.join(words, "word").groupBy("row").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("ns"), F.collect_list("class").alias("classes"))
        rows = part.select("row", "doc_id", "learn", "codes", F.size("others").alias("n_others")).join(found, "row", "left")
        return rows.select("doc_id", "learn", "codes", "n_others", none("places", "array<int>"), none("ns", "array<long>"), none("classes", "array<int>"))

    space = np.log10(n_tokens + n_words + 1.0)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat, size = _codes(b.column("codes"))
            own = b.column("n_others").to_numpy().astype(np.int64)
            first = np.cumsum(own) - own
            place, met = _flat(b.column("places"))
            at = np.repeat(first, met) + place
            n_of, class_of = np.zeros(own.sum() + 1, np.int64), np.full(own.sum() + 1, k + 1)
            n_of[at], class_of[at] = _flat(b.column("ns"))[0], _flat(b.column("classes"))[0]
            rare = flat < 0
            look = np.where(rare, np.repeat(first, size) - 1 - flat, 0)
            safe = np.where(rare, 0, flat)
            n = np.where(rare, n_of[look], frequent_n[safe])
            tags = np.where(rare, class_of[look], frequent_class[safe]) + 128 * (n == 1)
            starts = np.cumsum(size) - size
            sums = lambda x: np.add.reduceat(x, starts)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("learn"), pa.array(size.astype(np.int64)), pa.array(sums((n > 0).astype(np.int64))),
                pa.array(sums(np.log10(n + 1.0)) - size * space), pa.array(sums(np.log10(np.maximum(n, 1)))),
                pa.array([t.tobytes() for t in np.split(tags.astype(np.uint8), starts[1:])], pa.binary()),
            ], names=["doc_id", "learn", "n_tokens", "n_known", "base_score", "log_n", "tags"])

    schema = f"doc_id {dict(codes.dtypes)['doc_id']}, learn boolean, n_tokens long, n_known long, base_score double, log_n double, tags binary"
    done = []
    for part in file_parts(codes, PARTS):
        done.append(cut(looked_up(part).mapInArrow(tag, schema), "tagged"))
        drop_files(part)
        free_shuffles(codes.sparkSession)
    return reduce(DataFrame.unionAll, done)


def _split(tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (tags & 127).astype(np.int64), tags >= 128


def transitions(train: DataFrame, k: int) -> np.ndarray:
    """Counts (class before or k + 1 for words met once, class or k + 1 for words met once): of all tokens, twice in rows and columns of k + 1."""
    n = k + 2

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * n)
        for b in batches:
            c, once = _split(np.frombuffer(b"".join(b.column("tags").to_pylist()), np.uint8))
            before, before_once = np.concatenate([[k], c[:-1]]), np.concatenate([[False], once[:-1]])  # each document ends with the end
            for x, y, m in ((before, c, None), (np.full(len(c), n - 1), c, before_once), (before, np.full(len(c), n - 1), once), (np.full(len(c), n - 1), np.full(len(c), n - 1), once & before_once)):
                key = x * n + y
                total += np.bincount(key if m is None else key[m], minlength=n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], names=["cell", "n"])

    out = np.zeros(n * n)
    for r in train.select("tags").mapInArrow(cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # classes squared
        out[r["cell"]] = r["n"]
    return out.reshape(n, n)


def smoothed(counts: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """(log10 P(next | before), tokens by class) from transitions()."""
    known = counts[:, :-1]
    totals = known[:-1].sum(0)
    n = totals.sum()
    if n == 0:
        return np.zeros_like(counts), totals
    once = (counts[:-1, -1].sum() + 1) / (n + 2)
    before = known.sum(1, keepdims=True)
    unknown = (counts[:, -1:] + prior * once) / (before + prior)
    with np.errstate(divide="ignore"):
        return np.log10(np.hstack([(1 - unknown) * (known + prior * totals / n) / (before + prior), unknown])), totals


def class_lm(docs: DataFrame, learn: Column, n_classes: int = 64, rounds: int = 3, prior: float = 50.0, frequent: int = FREQUENT, clustered: int = CLUSTERED) -> tuple[DataFrame, ClassModel]:
    """(doc_id, learn, n_tokens, n_known, base_score, score, perplexity) of all rows of (doc_id, text), and the model.

    learn: which rows train. n_classes is at most 125. base_score is that of the add-one unigram model.
    """
    if not 1 <= n_classes <= 125:
        raise ValueError("n_classes must be from 1 to 125")
    spark, k = docs.sparkSession, n_classes
    text_batches(spark)
    counts = cut(word_counts(docs.filter(learn)), "counts")
    sums = counts.filter("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_words = int(sums["n"]), int(sums["v"])
    # The first `frequent` words; a share of 1 / (32 frequent), which at most 32 times as many can have, is asked first.
    first = counts.filter(F.col("n") * (32 * frequent) >= n_tokens).orderBy(F.desc("n"), "word").limit(frequent).collect()
    ends = counts.filter(F.col("word") == END).collect()
    drop_cut(counts)
    free_shuffles(spark)
    top = sorted({END: 0, **{r["word"]: r["n"] for r in [*first, *ends]}}.items(), key=lambda r: (r[0] != END, -r[1], r[0]))
    names, ns = [w for w, _ in top], np.array([n for _, n in top], dtype=np.int64)
    codes = coded(docs, learn, names)
    train = codes.filter("learn")
    h = min(clustered, len(names))
    near = neighbours(train, h)
    classes, table, history = cluster(near, h, 0, k, rounds)
    drop_cut(near)
    free_shuffles(spark)
    others = other_words(train, names, classes, table, k)
    free_shuffles(spark)
    class_of = np.append(classes[:h], np.zeros(len(names) - h, np.int64))
    numbered = spark.createDataFrame([(w, i) for i, w in enumerate(names) if i >= h], "word string, id int")
    for r in others.join(F.broadcast(numbered), "word").select("id", "class").collect():  # at most `frequent` words
        class_of[r["id"]] = r["class"]
    tags = tagged(codes, ns, class_of, others, n_tokens, n_words, k)
    log_next, totals = smoothed(transitions(tags.filter("learn"), k), prior)
    with np.errstate(divide="ignore"):
        emit = np.append(np.where(totals > 0, np.log10(np.maximum(totals, 1)), 0.0), 0.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            size = b.column("n_tokens").to_numpy()
            c, _ = _split(np.frombuffer(b"".join(b.column("tags").to_pylist()), np.uint8))
            starts = np.cumsum(size) - size
            before = np.concatenate([[k], c[:-1]])
            before[starts] = k
            s = np.add.reduceat(log_next[before, c] - emit[c], starts) + b.column("log_n").to_numpy() if n_tokens else np.zeros(len(size))
            keep = ["doc_id", "learn", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in keep], pa.array(s), pa.array(np.power(10.0, np.minimum(-s / size, 300)))], names=[*keep, "score", "perplexity"])

    kinds = dict(tags.dtypes)
    scored = tags.mapInArrow(score, f"doc_id {kinds['doc_id']}, learn boolean, n_tokens long, n_known long, base_score double, score double, perplexity double")
    words = spark.createDataFrame([(w, int(n), int(c)) for (w, n), c in zip(top[:h], classes) if n], "word string, n long, class int").unionByName(others)
    return scored, ClassModel(words, n_tokens, n_words, totals, log_next, history)


def op13_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    left_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2
    s, model = class_lm(spark.read.parquet(f"{sf_dir}/documents.parquet"), ~left_out)
    return s.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
