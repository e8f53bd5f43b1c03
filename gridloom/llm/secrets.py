"""Secret scan with multipart credential linking.

Strong spans are found in every text: assignments of a value of 12 or more characters to a secret's name, access
identifiers and long hexadecimal runs. Other parts of credentials are weak on their own: identifiers (client ids,
account keys), free-standing mixed tokens and endpoints. They are linked by an interval join within a scope: a weak
identifier is reported if a secret part begins within `scope` code points of it, a weak secret if an identifier does,
an endpoint if both do. The join needs no pairs: per document and block of `scope` code points only the first and last
start of each role are kept, each part meets the summaries of its own block and of the two beside it, and these decide
exactly whether a complement is near enough.

Everything is built of DataFrame functions. Texts are scanned once and never shuffled; what is joined are the parts of
documents that have weak ones.

Cases: null text counts as empty; repeated rows give a row each, with equal results; weak spans that overlap a strong
one are not reported again; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import cut, text_or_empty
from gridloom.llm.spans import TAGGED, joined, n_of, tagged, with_matches

ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]++)"
#: Shorter ones would fail the length test and an access or hexadecimal run never contains a longer one later on.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WEAK_ID = r"(?:(?i:access_?key(?:_?id)?|client_?id|account_?id|user_?name))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{4,}+|(?<![A-Z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}+"
WEAK_ENDPOINT = r"(?i:https?)://[^\s\"'<>]{4,}+|(?<![A-Za-z0-9_])(?:(?i:host|hostname|endpoint|server))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:/-]{4,}+"
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}


def _mixed(s: Column) -> Column:
    """A free-standing token that looks random: capitals, small letters and digits."""
    return s.rlike("[A-Z]") & s.rlike("[a-z]") & s.rlike("[0-9]") & (F.length(F.regexp_replace(s, "[^0-9]", "")) >= 2)


def _apart(spans: Column, strong: Column) -> Column:
    """Those of spans that overlap none of the strong ones."""
    return F.filter(spans, lambda w: ~F.exists(strong, lambda b: (b["start"] < w["stop"]) & (w["start"] < b["stop"])))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, base, parts): tagged strong spans, and tagged weak ones that may be reported."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = with_matches(rows, "text", {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "weak_secret": WEAK_SECRET})
    rows = rows.withColumns({
        "assign": F.filter("assign", lambda s: F.char_length(F.regexp_extract(s["text"], ASSIGN, 1)) >= 12),
        "weak_secret": F.filter("weak_secret", lambda s: _mixed(s["text"])),
    })
    rows = rows.withColumn("base", F.concat(*[tagged(F.col(k), k, i) for i, k in enumerate(KINDS[:3])]).cast(TAGGED))
    any_secret = F.size("base") + F.size("weak_secret") > 0
    rows = with_matches(rows, "text", {"weak_id": WEAK_ID, "endpoint": WEAK_ENDPOINT}, {"weak_id": any_secret, "endpoint": any_secret})
    weak = F.concat(*[tagged(F.col(k), k, i) for i, k in enumerate(KINDS) if i >= 3]).cast(TAGGED)
    return rows.select("doc_id", F.xxhash64("text").alias("row_hash"), "base", F.when(F.size(weak) > 0, _apart(weak, F.col("base"))).otherwise(weak).alias("weak"))


def link(found: DataFrame, scope: int = 400) -> DataFrame:
    """(doc_id, row_hash, linked): the weak spans whose complements lie within the scope, once for each distinct row."""
    key = ["doc_id", "row_hash"]
    some = found.filter(F.size("weak") > 0).select(*key, F.explode(F.concat("base", "weak")).alias("s")).distinct()
    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv]), F.col("s.kind"))
    some = some.select(*key, "s", role.alias("role"), F.floor(F.col("s.start") / scope).alias("block"))
    ends = some.groupBy(*key, "block").agg(*[f(F.when(F.col("role") == r, F.col("s.start"))).alias(f"{n}_{r}") for r in ("id", "secret") for n, f in (("lo", F.min), ("hi", F.max))])
    near = ends.select(*key, F.explode(F.array(*[F.struct((F.col("block") + d).alias("block"), F.lit(d).alias("d")) for d in (-1, 0, 1)])).alias("to"), *[f"{n}_{r}" for r in ("id", "secret") for n in ("lo", "hi")])
    # Seen from a part, block + d = its own: d = 1 is the block before it, d = -1 the one after.
    seen = near.groupBy(*key, F.col("to.block").alias("block")).agg(
        *[f(F.when(F.col("to.d") == d, F.col(f"{end}_{r}"))).alias(f"{name}_{r}") for r in ("id", "secret") for name, d, end, f in (("before", 1, "hi", F.max), ("in", 0, "lo", F.min), ("after", -1, "lo", F.min))]
    )
    w = some.filter(F.col("s.rank") >= 3).withColumnsRenamed({"doc_id": "w_id", "row_hash": "w_hash", "block": "w_block"})
    both = w.join(seen, w["w_id"].eqNullSafe(seen["doc_id"]) & (w["w_hash"] == seen["row_hash"]) & (w["w_block"] == seen["block"]))

    def has(r: str) -> Column:
        at = F.col("s.start")
        return F.coalesce(F.col(f"in_{r}").isNotNull() | (at - F.col(f"before_{r}") <= scope) | (F.col(f"after_{r}") - at <= scope), F.lit(False))

    good = F.when(F.col("role") == "id", has("secret")).when(F.col("role") == "secret", has("id")).otherwise(has("id") & has("secret"))
    return both.filter(good).groupBy("w_id", "w_hash").agg(F.collect_list("s").alias("linked"))


def secret_spans(docs: DataFrame, scope: int = 400) -> DataFrame:
    """One row per document row: doc_id, base (strong spans) and linked (weak spans reported), tagged."""
    found = cut(scan(docs), "secrets")
    links = link(found, scope)
    out = found.join(links, found["doc_id"].eqNullSafe(links["w_id"]) & (found["row_hash"] == links["w_hash"]), "left")
    return out.select("doc_id", "base", F.coalesce("linked", F.array().cast(TAGGED)).alias("linked"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = [n_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]]
    return s.select("doc_id", *n, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
