"""Personal data: strong formats, plus candidates judged by gradient-boosted trees.

Strong spans (email, IP address, payment card, international phone number) are found by pattern and checks in every
text. High-recall generators propose further spans that may overlap each other and one another's kinds: free-standing
digit groups, written-out email addresses, account numbers with a country code, dates, street addresses and names after
a title. Features of a candidate's format and of the words beside it go through boosted regression trees; a calibrated
threshold selects what is reported, and of candidates that overlap the most likely one stays.

The trees are fitted per call on TRAIN_ROWS texts made from TEMPLATES by hashing (a documented bound that does not
depend on the data). The generators find the candidates in these texts as they do in documents, and the same feature
columns describe them. Two thirds of the templates train; the threshold is calibrated on texts of the other third, whose
words and formats the trees have not seen. report() gives precision and recall there. The trees are written out as one
Column expression: finding, features and scoring are DataFrame functions only; texts are scanned once and not shuffled.

Cases: null text counts as empty; very long texts are scanned whole; repeated rows give a row each; candidates that
overlap a strong span are not reported; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import text_or_empty
from gridloom.llm.spans import TAGGED, joined, n_of, tagged, with_matches

_LOCAL = "[A-Za-z0-9._%+-]"
#: A run of local-part characters matches from its start or not at all; \G lets a match begin where the last one ended.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
DIGITS = r"(?<![A-Za-z0-9.,+-])[(]?[0-9](?:[ ().-]?[0-9]){6,18}(?![A-Za-z0-9])"
SPELLED = r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,40} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{2,40} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,6}(?![A-Za-z])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE = r"(?<![A-Za-z0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[12][0-9])?[0-9]{2}|[12][0-9]{3}-[0-9]{2}-[0-9]{2})(?![A-Za-z0-9/-])"
ADDRESS = (
    r"(?<![\p{L}0-9])[0-9]{1,5}[a-z]? (?:\p{Lu}[\p{L}'.-]{1,20} ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Terrace)(?!\p{L})"
    r"|(?<!\p{L})\p{Lu}[\p{L}-]{2,25}(?:stra(?:ß|ss)e|weg|platz|gasse|allee) [0-9]{1,4}[a-z]?(?![A-Za-z0-9])"
    r"|(?<!\p{L})(?:[Cc]alle|[Rr]ue|[Aa]venida|[Pp]laza) (?:(?:de|del|la|des|du) ){0,2}\p{Lu}[\p{L}'-]{2,25},? [0-9]{1,4}(?![A-Za-z0-9])"
)
NAME = r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Herr|Frau|Sra?|Señora?|Monsieur|Madame|Mme)\.? \p{Lu}[\p{L}'-]{1,20}(?: \p{Lu}[\p{L}'-]{1,20})?(?!\p{L})"
GENERATORS = {"number": DIGITS, "spelled_email": SPELLED, "account": ACCOUNT, "date": DATE, "address": ADDRESS, "name": NAME}
KINDS = ("email", "ip", "card", "phone", *GENERATORS)
CONTEXT = 24
NEAR_WORDS = {
    "w_phone": r"(?i)\b(?:tel|phone|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone|whatsapp)\b",
    "w_identity": r"(?i)\b(?:ssn|social security|passport|national id|dni|tax id|steuernummer)\b",
    "w_bank": r"(?i)\b(?:iban|account|konto|cuenta|compte|card|visa|mastercard)\b",
    "w_mail": r"(?i)\b(?:e-?mail|mail|contact|write to|reach)\b",
    "w_birth": r"(?i)\b(?:born|birth|birthday|dob|geboren|geburtsdatum|nacid[oa]|nacimiento|n[eé]e?|naissance)\b",
    "w_place": r"(?i)\b(?:address|lives?|living|resides?|home|wohnt|adresse|domicilio|vive|habite|deliver|ship)\b",
    "w_other": r"(?i)\b(?:order|invoice|version|isbn|page|total|doi|ticket|article|bestellung|issn|part|published|released|opened|held|edition|updated)\b",
}
#: (kind of span, 1 if personal, words before, shape): 0 is a digit, x a small letter, X a capital, the rest stands for itself.
TEMPLATES = (
    ("number", 1, "call", "000-000-0000"), ("number", 1, "phone:", "(000) 000-0000"), ("number", 1, "tel", "000 00 00 00"), ("number", 1, "mobile", "0000000000"),
    ("number", 1, "fax:", "0000 000000"), ("number", 1, "whatsapp", "000 000 000"), ("number", 1, "my phone is", "000.000.0000"), ("number", 1, "telefon", "0000-0000000"),
    ("number", 1, "ssn", "000-00-0000"), ("number", 1, "social security", "000-00-0000"), ("number", 1, "ssn:", "000000000"), ("number", 1, "passport", "000000000"),
    ("number", 1, "dni", "00000000"), ("number", 1, "konto", "0000000000"), ("number", 1, "account", "00000000"), ("number", 1, "tax id", "00-0000000"),
    ("number", 0, "order", "0000000000"), ("number", 0, "invoice", "0000-000000"), ("number", 0, "ticket", "000-000-0000"), ("number", 0, "part", "000-00-0000"),
    ("number", 0, "isbn", "000-0-00-000000-0"), ("number", 0, "version", "0.0.00.000"), ("number", 0, "total", "0000000"), ("number", 0, "issn", "0000-0000"),
    ("number", 0, "the", "00000000"), ("number", 0, "and", "0000000000000000"), ("number", 0, "of", "0000 0000"), ("number", 0, "with", "000 000 000"),
    ("number", 0, "is", "0000000000"), ("number", 0, "that", "000000000000"), ("number", 0, "doi", "00.0000.0000"), ("number", 0, "page", "000-0000"),
    ("spelled_email", 1, "mail", "xxxx at xxxxx dot xxx"), ("spelled_email", 1, "contact", "xxx.xxxx (at) xxxxxx (dot) xxx"), ("spelled_email", 1, "the", "xxxxxx [at] xxxxx [dot] xxx"),
    ("spelled_email", 1, "reach me:", "xxxxxx (at) xxxxxx dot xx"), ("spelled_email", 1, "write to", "xxxxxxxx at xxxxxx dot xxx"), ("spelled_email", 1, "or", "xxx (at) xxxxxxx (dot) xx"),
    ("spelled_email", 0, "look", "xxxx at xxx dot xxxxx"), ("spelled_email", 0, "was", "xxx at xxxxxx dot xxxx"), ("spelled_email", 0, "we met", "xxxx at xxxxxxx dot xxxxxx"),
    ("account", 1, "iban", "XX00 0000 0000 0000 0000 00"), ("account", 1, "account", "XX00000000000000000000"), ("account", 1, "konto", "XX00 0000 0000 0000 0000 00"),
    ("account", 1, "cuenta", "XX00 0000 0000 0000 0000 0000"), ("account", 1, "pay to", "XX00 0000 0000 0000 0000 00"), ("account", 1, "compte", "XX0000000000000000000000000"),
    ("account", 0, "part", "XX00XXXX0000XXXX"), ("account", 0, "the", "XX000000XXXX"), ("account", 0, "order", "XX000000000000"),
    ("date", 1, "born on", "00.00.1900"), ("date", 1, "birth:", "00/00/1900"), ("date", 1, "dob", "1900-00-00"), ("date", 1, "geboren am", "00.00.1900"), ("date", 1, "date of birth", "00-00-1900"), ("date", 1, "nacido", "00/00/1900"),
    ("date", 0, "on", "2000-00-00"), ("date", 0, "published", "00.00.2000"), ("date", 0, "from", "00.00.2000"), ("date", 0, "updated", "00/00/2000"), ("date", 0, "held on", "00/00/00"), ("date", 0, "until", "00-00-2000"),
    ("address", 1, "lives at", "000 Xxxxxx Street"), ("address", 1, "address:", "0000 Xxxxxxx Xxxx Road"), ("address", 1, "wohnt", "Xxxxxstraße 00"), ("address", 1, "home", "00 Xxxxxx Lane"),
    ("address", 1, "vive en", "calle Xxxxxxx 00"), ("address", 1, "ship to", "0000 Xxxxx Avenue"), ("address", 0, "page", "00 Xxxx Street"), ("address", 0, "edition", "0 Xxxx Drive"), ("address", 0, "opened", "00 Xxxxx Court"),
    ("name", 1, "contact", "Mr. Xxxxx Xxxxxxx"), ("name", 1, "write to", "Frau Xxxxxxx"), ("name", 1, "and", "Dr. Xxxxxx Xxxxx"), ("name", 1, "call", "Mrs Xxxxxx"), ("name", 1, "with", "Señora Xxxxxx"), ("name", 1, "for", "Monsieur Xxxxxxx"),
    ("name", 0, "part", "Dr Xxxx"), ("name", 0, "article", "Dr. Xxxxxxxx"), ("name", 0, "edition", "Mr Xxx"),
)
TRAIN_ROWS = 9000
FEATURES = ("n_digits", "n_chars", "n_groups", "longest", "paren", "dash", "dot", "space", "bracket", "luhn", "date", "early", "grouped", "covers", *(f"is_{k}" for k in GENERATORS), *NEAR_WORDS)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return F.when(n > 0, total % 10 == 0).otherwise(F.lit(False))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def features(text: Column, before: Column, kind: Column, after: Column) -> dict[str, Column]:
    """Numbers that describe a candidate's format, the words before it and whether digits go on after it."""
    has = lambda p: text.rlike(p).cast("int")
    groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
    return {
        "n_digits": F.length(_digits(text)), "n_chars": F.length(text), "n_groups": F.size(groups), "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "paren": has(r"[(][0-9]+[)]"), "dash": has("-"), "dot": has(r"\."), "space": has(" "), "bracket": has(r"[(\[](?:at|dot)"), "luhn": luhn(_digits(text)).cast("int"),
        "date": has(r"^(?:[12][0-9]{3}[-./][0-9]{2}[-./][0-9]{2}|[0-9]{2}[-./][0-9]{2}[-./][12][0-9]{3})$"), "early": has(r"(?:^|[-./])19[0-9]{2}(?:$|[-./])"), "grouped": has(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "covers": (~after.rlike(r"^[0-9.-]*[0-9]")).cast("int"), **{f"is_{k}": (kind == k).cast("int") for k in GENERATORS}, **{k: before.rlike(p).cast("int") for k, p in NEAR_WORDS.items()},
    }


def _described(text: Column, span: Column, kind: Column) -> dict[str, Column]:
    """features() of a span of a text."""
    first = F.greatest(span["start"] - CONTEXT, F.lit(0))
    return features(span["text"], F.substring(text, first + 1, span["start"] - first), kind, F.substring(text, span["stop"] + 1, F.lit(4)))


def training_rows(spark: SparkSession, n: int = TRAIN_ROWS) -> DataFrame:
    """(id, template, kind, label, features) of the candidates that the generators find in n made texts; kind is null where none does.

    Text i takes template i mod their number, filled by hashes, between hashed plain words. A candidate counts as what its
    template is if it covers at least half of the span; others of the same text are left out.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(y).alias("label"), F.lit(words + " ").alias("words"), F.lit(shape).alias("shape")) for k, y, words, shape in TEMPLATES])
    plain = F.array(*[F.lit(w) for w in ("so it went ", "as we know, ", "they said ", "in short ", "a note: ", "")])

    def filled(c: Column, place: Column) -> Column:
        draw = lambda n: F.pmod(F.xxhash64(F.col("id"), place), F.lit(n)).cast("int")
        return F.when(c == "0", draw(10).cast("string")).when(c == "x", F.char(draw(26) + 97)).when(c == "X", F.char(draw(26) + 65)).otherwise(c)

    made = spark.range(n).withColumn("template", (F.col("id") % len(TEMPLATES)).cast("int")).withColumn("t", F.element_at(kinds, F.col("template") + 1))
    # Years keep their century, and a tenth of the texts lose their words, so that the trees do not lean on them alone.
    shape = F.regexp_replace(F.regexp_replace("t.shape", "1900", "\u0001\u000200"), "2000", "\u0003\u000400")
    body = F.translate(F.array_join(F.transform(F.split(shape, ""), filled), ""), "\u0001\u0002\u0003\u0004", "1920")
    words = F.when(F.pmod(F.xxhash64("id", F.lit("w")), F.lit(10)) == 0, F.lit("")).otherwise(F.col("t.words"))
    lead = F.concat(F.element_at(plain, F.pmod(F.xxhash64("id", F.lit("l")), F.lit(6)).cast("int") + 1), words)
    made = made.select("id", "template", "t.label", lead.alias("lead"), body.alias("body"), F.concat(lead, body, F.lit(" and so on.")).alias("text"))
    made = _one_kind(with_matches(made, "text", GENERATORS))
    start, stop = F.length("lead"), F.length("lead") + F.length("body")
    covered = lambda s: 2 * (F.least(s["stop"], stop) - F.greatest(s["start"], start)) >= F.length("body")
    found = F.concat(*[F.transform(F.filter(k, covered), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["text"].alias("text"))) for k in GENERATORS])
    names = F.concat(*[F.transform(F.filter(k, covered), _named(k)) for k in GENERATORS])
    rows = made.select("id", "template", "label", "text", F.explode_outer(F.arrays_zip(found.alias("span"), names.alias("kind"))).alias("c"))
    rows = rows.select("id", "template", "label", "text", F.col("c.span").alias("span"), F.col("c.kind").alias("kind"))
    return rows.select("id", "template", "kind", "label", *[v.cast("double").alias(k) for k, v in _described(F.col("text"), F.col("span"), F.col("kind")).items()])


def _one_kind(rows: DataFrame) -> DataFrame:
    """Digit groups that a more specific generator proposes as well are left to it: kinds of one span don't compete."""
    inside = lambda s: F.exists(F.concat("date", "account"), lambda o: (o["start"] <= s["start"]) & (s["stop"] <= o["stop"]))
    return rows.withColumn("number", F.when(F.size("number") > 0, F.filter("number", lambda s: ~inside(s))).otherwise(F.col("number")))


def _named(kind: str):
    return lambda _: F.lit(kind)


@dataclass
class Tree:
    """A regression tree of depth 2: (feature, cut) at the root and in both halves, four leaf values."""

    splits: tuple[tuple[int, float], ...]
    leaves: tuple[float, ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        (f, c), (fl, cl), (fr, cr) = self.splits
        return np.where(x[:, f] <= c, np.where(x[:, fl] <= cl, self.leaves[0], self.leaves[1]), np.where(x[:, fr] <= cr, self.leaves[2], self.leaves[3]))

    def column(self, x: list[Column]) -> Column:
        (f, c), (fl, cl), (fr, cr) = self.splits
        half = lambda g, cut, a, b: F.when(x[g] <= cut, F.lit(a)).otherwise(F.lit(b))
        return F.when(x[f] <= c, half(fl, cl, *self.leaves[:2])).otherwise(half(fr, cr, *self.leaves[2:]))


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[int, float]:
    best, at = -1.0, (0, float("inf"))
    for f in range(x.shape[1]):
        for c in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= c
            gain = g[left].sum() ** 2 / (h[left].sum() + ridge) + g[~left].sum() ** 2 / (h[~left].sum() + ridge)
            if gain > best:
                best, at = gain, (f, float(c))
    return at


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, rate: float = 0.5, ridge: float = 1.0) -> list[Tree]:
    """Newton boosting of the logistic loss with trees of depth 2."""
    z, out = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        root = _split(x, g, h, ridge)
        left = x[:, root[0]] <= root[1]
        subs = [_split(x[s], g[s], h[s], ridge) if s.any() else (0, float("inf")) for s in (left, ~left)]
        cells = [s & m for s, sub in zip((left, ~left), subs) for m in (x[:, sub[0]] <= sub[1], x[:, sub[0]] > sub[1])]
        tree = Tree((root, *subs), tuple(float(rate * g[c].sum() / (h[c].sum() + ridge)) for c in cells))
        out.append(tree)
        z += tree.predict(x)
    return out


@dataclass
class Judge:
    trees: list[Tree]
    threshold: float

    def margin(self, x: dict[str, Column]) -> Column:
        total = F.lit(0.0)
        for t in self.trees:
            total = total + t.column([x[k] for k in FEATURES])
        return total


def _fitted(spark: SparkSession, precision: float) -> tuple[Judge, dict[str, float]]:
    every = training_rows(spark).orderBy("id", "kind", "n_chars").collect()  # a few candidates a made text
    rows = [r for r in every if r["kind"] is not None]
    x = np.array([[r[k] for k in FEATURES] for r in rows])
    y = np.array([r["label"] for r in rows], dtype=float)
    aside = np.array([r["template"] % 3 == 1 for r in rows])
    trees = boost(x[~aside], y[~aside])
    z = sum(t.predict(x[aside]) for t in trees)
    order = np.argsort(-z, kind="stable")
    right = np.cumsum(y[aside][order]) / np.arange(1, len(order) + 1)
    last = np.append(np.diff(z[order]) != 0, True)
    good = np.flatnonzero((right >= precision) & last)
    judge = Judge(trees, float(z[order][good[-1]]) if len(good) else float("inf"))
    taken = z >= judge.threshold
    wanted = {r["id"] for r in every if r["template"] % 3 == 1 and r["label"] == 1}
    proposed = {r["id"] for r in rows} & wanted
    reported = {r["id"] for r, t in zip((r for r, a in zip(rows, aside) if a), taken) if t} & wanted
    return judge, {
        "generator_recall": len(proposed) / max(1, len(wanted)), "precision": float(y[aside][taken].mean()) if taken.any() else 1.0, "recall": len(reported) / max(1, len(wanted)), "texts": float(len(wanted)),
    }


def fit(spark: SparkSession, precision: float = 0.97) -> Judge:
    """Trees on the training templates; the lowest margin that keeps the wanted precision on the calibration templates."""
    return _fitted(spark, precision)[0]


def report(spark: SparkSession, precision: float = 0.97) -> dict[str, float]:
    """On texts of calibration templates: recall of the generators, precision and recall of what is reported."""
    return _fitted(spark, precision)[1]


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def personal_spans(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """One row per document row: doc_id, base (strong spans) and extra (candidates reported), tagged."""
    judge = judge or fit(docs.sparkSession)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = _one_kind(with_matches(rows, "text", {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, **GENERATORS}))
    n_digits = lambda s: F.length(_digits(s["text"]))
    rows = rows.withColumns({
        "ip": F.filter("ip", lambda s: ~F.exists(F.split(s["text"], r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) > 3) | (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(999)) > 255))),
        "card": F.filter("card", lambda s: n_digits(s).between(12, 19) & luhn(_digits(s["text"]))),
        "phone": F.filter("phone", lambda s: n_digits(s).between(9, 15)),
    })
    rows = rows.withColumn("base", F.concat(*[tagged(F.col(k), k, i) for i, k in enumerate(KINDS[:4])]).cast(TAGGED))

    def judged(kind: str, rank: int) -> Column:
        def one(s: Column) -> Column:
            x = _described(F.col("text"), s, F.lit(kind))
            return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind"), judge.margin(x).alias("z"))

        return F.when(F.size(kind) > 0, F.transform(kind, one))

    z = "array<struct<start:int,rank:int,stop:int,kind:string,z:double>>"
    parts = [F.coalesce(judged(k, i), F.array().cast(z)).cast(z) for i, k in enumerate(KINDS) if i >= 4]
    rows = rows.select("doc_id", "base", F.concat(*parts).alias("scored"))
    chosen = F.filter("scored", lambda c: (c["z"] >= judge.threshold) & ~F.exists("base", lambda b: _overlap(b, c)))
    rows = rows.select("doc_id", "base", F.when(F.size("scored") > 0, chosen).otherwise(F.col("scored")).alias("chosen"))
    better = lambda a, b: (a["z"] > b["z"]) | ((a["z"] == b["z"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["rank"] < b["rank"]))))
    best = F.filter("chosen", lambda c: ~F.exists("chosen", lambda o: _overlap(o, c) & better(o, c)))
    extra = F.transform(F.when(F.size("chosen") > 1, best).otherwise(F.col("chosen")), lambda c: c.dropFields("z"))
    return rows.select("doc_id", "base", extra.cast(TAGGED).alias("extra"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = personal_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = [n_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]]
    return s.select("doc_id", *n, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "extra")).alias("spans"), F.size("extra").cast("long").alias("n_extra"))
