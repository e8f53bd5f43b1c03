"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

Two lines are near-duplicates if the Jaccard similarity of their sets of WIDTH-character shingles, one beginning at every
character, is 0.8 or more; this is computed exactly, from the two texts, for every candidate pair. Components of these
links are found by distributed label propagation, and of each component the first occurrence, by (doc_id, line number),
stays.

Candidates come from signatures of 24 minima of hash XOR constant, in 16 bands of 3 minima that lie apart, since neighbours
often are one shingle. To sign all shingles would cost most of the work, so a signature takes a hash for each word with
the first letters of the next, one for the second half of a word of more than 6 letters, and in words of more than 12 (text
without blanks) one for every 12 characters: what an edit changes is about as much as it changes of all shingles. What this
loses against all shingles is measured in the README.

Equal lines are one node, known by 128 bits of hash. Buckets are not expanded into pairs: each member meets the
bucket's smallest and largest members; after those links are contracted, members outside the bucket's largest component
meet the members of other components, a few of the largest at first, since most members that it lacks are similar to many
of its members. Buckets of more than HOT lines mostly hold lines that share a passage and nothing
else; in place of the second meeting their lines are indexed, each under its rarest signed shingles: of n the first
n - ceil(LOOSE n) + 1 in order of frequency, of which two lines whose signed sets are LOOSE similar must share one. The
places of a shared shingle in both lines bound what they can share from there on, which rules out most pairs of lines
that only share a passage. Here a line's shingles are those that begin at a chunk of up to 6 non-blank characters, chunks
beginning at words. LOOSE lies below the threshold, as signed sets and full sets differ a little.

Before a pair is judged, 2,048 bits of each line's set of all shingles must leave it possible; this rules out no similar pair.

Cases: blank lines are never compared and always stay; null text stays null; very long texts and lines are read whole;
repeated rows of one doc_id and text count as one document and are treated alike; an empty table gives no rows; all
columns of the input are passed on, except that n_lines and n_dropped replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import components, cut, small_side, text_or_empty

SHINGLES = r"(?s)(?=(.{1,12}))(?:\S(?=\S{12})|\S{1,6})"
WIDTH = 12
BLANKS = " \t\r\f\v"
HOT, LOOSE = 32, 0.76
#: Minima of a signature, and the bands: which three minima make each. They lie apart, as neighbours often are one shingle.
SIGNED = 24
BANDS = [(j, j + 8, j + 16) for j in range(8)] + [(j, (j + 5) % SIGNED, (j + 14) % SIGNED) for j in range(0, SIGNED, 3)]
#: Members of a bucket's largest component that the members outside meet before they meet all of it.
DRAWN = 8
#: Letters of the next word that a signed word takes along (twice as many after its second half), and letters of its first half.
LEAD, HALF = 4, 6
KEYS = [f"k{j}" for j in range(len(BANDS))]
#: A set of hashes as 64 bits each: those of its hashes whose next five bits are j.
BITS = [f"s{j}" for j in range(32)]


def _constants(n: int) -> list[int]:
    """n signed 32-bit constants, spread over the top bits so that the minima look in different places."""
    out = []
    for j in range(n):
        x = (j * (1 << 32) // n + (2654435761 * (j + 1)) % ((1 << 32) // n)) % (1 << 32)
        out.append(x - (1 << 32) if x >> 31 else x)
    return out


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, pos, line, id): the lines that are not blank; id is 128 bits of the line."""
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("row_hash"), F.posexplode_outer(F.split(text_or_empty(), "\n")).alias("pos", "line"))
    return rows.filter(F.ltrim("line", F.lit(BLANKS)) != "").withColumns({"a": F.xxhash64("line"), "b": F.xxhash64(F.lit(7), "line")})


def _characters(line: Column) -> Column:
    """Four bytes a character, so that a piece is cut out without a walk from the start."""
    return F.encode(line, "UTF-32")


def _starts(characters: Column) -> Column:
    return F.sequence(F.lit(1), F.greatest(F.octet_length(characters) - 4 * WIDTH + 1, F.lit(1)), F.lit(4))


def _every_shingle(characters: Column) -> Column:
    """The hash of a shingle at every character that has WIDTH of them from there on; a shorter line is one shingle."""
    return F.transform(_starts(characters), lambda i: F.xxhash64(F.substring(characters, i, F.lit(4 * WIDTH))))


def signed(rows: DataFrame) -> DataFrame:
    """(a, b, begin, h, t): what a signature is made of, two hashes a row. begin is 1 in one row of each of rows (a, b, line), else 0."""
    words = rows.select("a", "b", F.split("line", " ").alias("w"))
    words = words.select("a", "b", "w", F.posexplode_outer("w").alias("p", "x")).filter((F.col("p") == 0) | (F.col("p") < F.size("w") - 1))
    n, after = F.char_length("x"), F.get("w", F.col("p") + 1)
    whole, tail = F.hash("x", F.substring(after, 1, LEAD)), F.hash(F.substring("x", HALF + 1, HALF), F.substring(after, 1, 2 * LEAD))
    wide = F.when(n > WIDTH, _characters(F.col("x")))
    places = F.when(n > WIDTH, F.sequence(F.lit(0), n - WIDTH + 1)).otherwise(F.array(F.lit(0)))
    words = words.select("a", "b", "p", whole.alias("h"), F.when(n.between(HALF + 1, WIDTH), tail).otherwise(whole).alias("t"), wide.alias("c"), F.explode_outer(places).alias("i"))
    within = F.hash(F.substring(F.col("c"), F.col("i") * 4 - 3, F.lit(4 * WIDTH)))
    h, t = (F.when(F.col("i") == 0, F.col(x)).otherwise(within).alias(x) for x in ("h", "t"))
    return words.select("a", "b", ((F.col("p") == 0) & (F.col("i") == 0)).cast("int").alias("begin"), h, t)


def signatures(rows: DataFrame) -> DataFrame:
    """(id, a, b, rows, k0, k1, ...) for each distinct line: a number, its hashes, its count and the keys of its bands.

    The numbers hold within one written table only: they name lines in joins, and no result depends on their order.
    """
    minima = [f"m{j}" for j in range(SIGNED)]
    least = [F.min(F.least(*[F.col(x).bitwiseXOR(F.lit(c)) for x in ("h", "t")])).alias(m) for m, c in zip(minima, _constants(SIGNED))]
    per_line = signed(rows).groupBy("a", "b").agg(F.sum("begin").alias("rows"), *least)
    keys = [F.xxhash64(F.lit(j), *[minima[i] for i in band]).alias(k) for j, (k, band) in enumerate(zip(KEYS, BANDS))]
    return per_line.select(F.monotonically_increasing_id().alias("id"), "a", "b", "rows", *keys)


def _shingle_set(line: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(SHINGLES), F.lit(1)), lambda s: F.hash(s)))


def shingle_bits(texts: DataFrame) -> DataFrame:
    """(id, ones, more, s0, s1, ...) of each line: BITS of the set of its shingles' hashes, how many are set, and how many more shingles begin in it."""
    rows = texts.select("id", _characters(F.col("line")).alias("c"))
    rows = rows.select("id", "c", F.explode_outer(_starts(F.col("c"))).alias("i")).select("id", F.xxhash64(F.substring("c", F.col("i"), F.lit(4 * WIDTH))).alias("h"))
    rows = rows.select("id", F.expr(f"(h >>> 6) & {len(BITS) - 1}").alias("j"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    sets = rows.groupBy("id").agg(F.count("*").alias("n"), *[F.bit_or(F.when(F.col("j") == j, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(s) for j, s in enumerate(BITS)])
    ones = sum((F.bit_count(s) for s in BITS), F.lit(0))
    return sets.select("id", ones.alias("ones"), "n", *BITS).select("id", "ones", (F.col("n") - F.col("ones")).alias("more"), *BITS)


def can_be_similar(a: str, b: str, threshold: float) -> Column:
    """False only where the shingle_bits of the rows named a and b rule out that similarity.

    Each bit that only one set has is a shingle that only that line has: u and v so many at least are not shared, and of the n that
    begin in a line n - u at most are. min(n - u, m - v) >= threshold (min(n - u, m - v) + u + v), solved for the bits that both
    have, so that these are counted once.
    """
    both = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseAND(F.col(f"{b}.{s}"))) for s in BITS), F.lit(0))
    ones, more = F.col(f"{a}.ones") + F.col(f"{b}.ones"), F.least(F.col(f"{a}.more"), F.col(f"{b}.more"))
    return both * (1 + threshold) >= threshold * ones - (1 - threshold) * more - 1e-9


def possible(pairs: DataFrame, bits: DataFrame, threshold: float) -> DataFrame:
    """The (x, y) pairs that their lines' bits do not rule out."""
    both = pairs.join(bits.alias("a"), F.col("x") == F.col("a.id")).join(bits.alias("b"), F.col("y") == F.col("b.id"))
    return both.filter(can_be_similar("a", "b", threshold)).select("x", "y")


def _let(x: Column, f) -> Column:
    """f(x) with x computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def similar(a: Column, b: Column, threshold: float) -> Column:
    """Whether two lines have at least that Jaccard similarity of all their shingles."""
    a, b = (_let(_characters(x), _every_shingle) for x in (a, b))
    return F.size(F.array_intersect(a, b)) >= threshold * F.size(F.array_union(a, b)) - 1e-9


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (x, y) pairs of line ids whose lines are similar. They are judged in a table of their own, where each set is made once."""
    x, y = texts.select(F.col("id").alias("x"), F.col("line").alias("lx")), texts.select(F.col("id").alias("y"), F.col("line").alias("ly"))
    both = pairs.join(x, "x").join(y, "y")
    return cut(both.select("x", "y", similar(F.col("lx"), F.col("ly"), threshold).alias("near")), "judged").filter("near").select("x", "y")


def rarest_shingles(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, a, key, place, size, prefix): the prefix of each line's shingles in order of (number of lines that have it, hash)."""
    long = sets.select("id", "a", F.explode("set").alias("h"))
    frequency = long.groupBy("h").agg(F.count("*").alias("df"))
    ordered = long.join(frequency, "h").groupBy("id", "a").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("s"))
    n = F.size("s")
    prefix = F.slice("s", F.lit(1), n - F.ceil(threshold * n - 1e-9).cast("int") + 1)
    ordered = ordered.select("id", "a", n.alias("size"), F.transform(prefix, lambda p: p["h"]).alias("prefix"))
    ordered = ordered.select("id", "a", "size", "prefix", F.posexplode("prefix").alias("place", "h"))
    return ordered.select("id", "a", F.xxhash64(F.lit(len(BANDS)), "h").alias("key"), "place", "size", "prefix")


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of keys whose key occurs more than once. Only the keys are counted; most lines are alone under theirs."""
    several = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    return keys.join(small_side(cut(several, "keys")), "key", "left_semi")


def with_pivots(keys: DataFrame, drawn: bool = False) -> DataFrame:
    """keys (key, id, a, ...) of buckets with several members, with the members that all others meet, and the bucket's size.

    Sizes and pivots come from an aggregation, combined before the shuffle, and are joined back, so no task holds a bucket.
    """
    pivots = [F.min_by("id", "a"), F.max_by("id", "a")] + ([F.min_by("id", F.xxhash64("a"))] if drawn else [])
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), *[p.alias(f"p{i}") for i, p in enumerate(pivots)]).filter("n > 1")
    buckets = buckets.select("key", "n", F.array_distinct(F.array(*[F.col(f"p{i}") for i in range(len(pivots))])).alias("pivots"))
    return keys.join(small_side(cut(buckets, "buckets")), "key")


def line_components(sig: DataFrame, rows: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(id, component) of the distinct lines that have near-duplicates."""
    shared = cut(shared_keys(sig.select("id", "a", "b", F.explode(F.array(*KEYS)).alias("key"))), "shared")
    members = cut(with_pivots(shared), "bands")
    wanted = small_side(cut(members.select("id", "a", "b").distinct(), "wanted"))
    texts = cut(rows.select("a", "b", "line").join(wanted, ["a", "b"]).groupBy("id", "a").agg(F.first("line").alias("line")), "texts")
    bits = small_side(cut(shingle_bits(texts), "bits"))
    crowded = members.filter(F.col("n") > HOT).select("id").distinct()
    sets = cut(texts.join(crowded, "id", "left_semi").select("id", "a", _shingle_set(F.col("line")).alias("set")), "sets")
    rare = cut(with_pivots(cut(rarest_shingles(sets, LOOSE), "prefixes"), drawn=True), "rare")
    nowhere = F.lit(None).cast("int")
    members = members.drop("b").withColumns({"place": nowhere, "size": nowhere, "prefix": F.lit(None).cast("array<int>")})
    first = members.unionByName(rare).select("id", F.explode("pivots").alias("pivot")).filter("id <> pivot")
    first = first.select(F.least("id", "pivot").alias("x"), F.greatest("id", "pivot").alias("y")).distinct()
    labels = cut(components(verified(cut(possible(first, bits, threshold), "possible"), texts, threshold)), "labels")
    larger = members.filter(F.col("n").between(3, HOT)).unionByName(rare.filter("n > 2")).select("key", "id", "place", "size", "prefix")
    larger = larger.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id"))
    parts = larger.groupBy("key", "c").agg(F.count("*").alias("m")).groupBy("key").agg(F.max_by("c", "m").alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    split = larger.join(small_side(cut(parts.select("key", "main"), "parts")), "key").join(bits, "id")
    split = cut(split.select("key", "id", "place", "size", "prefix", "c", "main", "ones", "more", *BITS), "split")
    labels, split = drawn_first(split, labels, texts, threshold)
    met = outside_pairs(split, split, F.col("o.c") != F.col("l.c"), F.col("o.place").isNull() | _once(), threshold)
    links = verified(cut(met, "met"), texts, threshold)
    if links.isEmpty():
        return labels.select(F.col("node").alias("id"), "component")
    return components(labels.select("node", "component").union(links)).select(F.col("node").alias("id"), "component")


def _once() -> Column:
    """Whether a bucket of an indexed shingle is that of the first one that both prefixes have."""
    before = lambda t: F.slice(F.col(f"{t}.prefix"), F.lit(1), F.col(f"{t}.place"))
    return F.size(F.array_intersect(before("o"), before("l"))) == 0


def outside_pairs(split: DataFrame, others: DataFrame, which: Column, last: Column, threshold: float) -> DataFrame:
    """(x, y) of members outside their bucket's largest component (o) and others of the bucket (l) that bits and places do not rule out.

    The conditions stand in the order of their cost; last, which compares arrays, is for the few pairs that pass the others.
    """
    both = F.col("o.size") + F.col("l.size")
    left = lambda t: F.col(f"{t}.size") - F.col(f"{t}.place")
    placed = F.col("o.place").isNull() | (F.least(left("o"), left("l")) * (1 + LOOSE) >= LOOSE * both - 1e-9)
    met = split.filter("c <> main").alias("o").join(others.alias("l"), (F.col("o.key") == F.col("l.key")) & which & placed & can_be_similar("o", "l", threshold) & last)
    return met.select(F.least("o.id", "l.id").alias("x"), F.greatest("o.id", "l.id").alias("y")).distinct()


def drawn_first(split: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(labels, split) after members outside met up to DRAWN of their bucket's largest component, drawn by hash.

    Most members that belong to that component are similar to many of it; they join it here and need not meet it whole.
    """
    draws = [F.min_by("id", F.xxhash64(F.lit(j), "key", "id")) for j in range(DRAWN)]
    drawn = split.filter("c = main").groupBy("key").agg(F.count("*").alias("n"), F.array(*draws).alias("ids")).filter(F.col("n") > DRAWN)
    drawn = small_side(cut(drawn.select("key", F.explode(F.array_distinct("ids")).alias("id")), "drawn"))
    links = verified(cut(outside_pairs(split, split.join(drawn, ["key", "id"], "left_semi"), F.lit(True), F.lit(True), threshold), "met"), texts, threshold)
    if links.isEmpty():
        return labels, split
    labels = cut(components(labels.select("node", "component").union(links)), "labels")
    now, top = (small_side(labels.select(F.col("node").alias(k), F.col("component").alias(v))) for k, v in (("id", "c"), ("main", "top")))
    again = split.drop("c").join(now, "id", "left").join(top, "main", "left")
    return labels, again.select("key", "id", "place", "size", "prefix", F.coalesce("c", "id").alias("c"), F.coalesce("top", "main").alias("main"), "ones", "more", *BITS)


def dropped_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, row_hash, drop): the line numbers that go, for each document that loses some."""
    rows = lines(docs)
    sig = cut(signatures(rows), "signatures")
    labels = sig.select("id", "a", "b", "rows").join(small_side(cut(line_components(sig, rows, threshold), "components")), "id", "left")
    labels = cut(labels.filter("rows > 1 or component is not null").select("a", "b", F.coalesce("component", "id").alias("c")), "repeated")
    named = rows.select("doc_id", "pos", "row_hash", "a", "b").join(small_side(labels), ["a", "b"])
    named = cut(named.select(F.struct("doc_id", "pos", "row_hash").alias("at"), "c").distinct(), "lines")
    keep = named.groupBy("c").agg(F.min("at").alias("keep"), F.count("*").alias("n")).filter("n > 1").drop("n")
    gone = named.join(small_side(cut(keep, "first")), "c").filter("not (at <=> keep)").select("at.*")
    return gone.groupBy("doc_id", "row_hash").agg(F.collect_list("pos").alias("drop"))


def dedup_lines(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """docs with duplicate lines cut out of text, and the columns n_lines (of the old text) and n_dropped, in place of any so named."""
    gone = small_side(cut(dropped_lines(docs, threshold), "dropped")).withColumnsRenamed({"doc_id": "__id", "row_hash": "__hash", "drop": "__drop"})
    named = docs.withColumn("__row_hash", F.xxhash64(text_or_empty()))
    both = named.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row_hash") == F.col("__hash")), "left")
    both = both.withColumn("__lines", F.when(F.col("__drop").isNotNull(), F.split("text", "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n"))
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = F.coalesce(feeds + 1, F.lit(0)).cast("long")
    n_dropped = F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).cast("long")
    old = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    columns = [text.alias("text") if c == "text" else F.col(c) for c in old]
    return both.select(*columns, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
