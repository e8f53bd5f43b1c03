"""Small document tables that every operator must get through."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, start long, row_hash string, line string"


def rows():
    """Nulls in any column, empty and long texts, ties and repeated rows, and extra columns with clashing names."""
    r = random.Random(1)
    words = [f"w{i}" for i in range(400)] + ["Ünï", "mañana", "don't", "x,y", "A.B"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, long = text(60), "\n".join(text(40) for _ in range(80))
    out = [
        (1, base, "en", "a", None), (2, base, "en", "a", 1), (3, base + " tail", "de", "b", 1), (4, None, None, None, None), (5, "", "en", "a", 0), (6, "  \n\t ", "en", None, 5),
        (7, long, "en", "b", 9), (8, long + "\n" + text(5), "en", "b", 9), (9, "x" * 3000, "fr", "c", 1), (10, "one", "en", "c", 1), (10, "one", "en", "c", 1), (10, "two words", "en", "c", 1),
        (None, "no id here at all", "en", "a", 1), (None, None, None, None, None), (11, "a  b\t c\n\n d <|endoftext|> e ", "en", "a", 1),
    ]
    out += [(20 + i, text(r.randint(1, 90)), r.choice(["en", "de"]), r.choice("abcd"), 1) for i in range(40)]
    return [(*x, 7, 7, "h", "l") for x in out]


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
