"""Positions of regular-expression matches as Column expressions, for the operators that find spans in whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,stop:int,text:string>>"


def with_matches(df: DataFrame, text: str, patterns: dict[str, str], when: dict[str, Column] | None = None) -> DataFrame:
    """Adds for each name the leftmost non-overlapping matches of its pattern, as (start, stop, text) in code points.

    A text is what lies between the matches and the matches in turn, so the positions are running sums of lengths;
    texts without a match, most of them, are scanned once. when: a condition under which a pattern is tried at all.
    """
    when = when or {}
    found = {n: F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)) for n, p in patterns.items()}
    found = {n: F.when(when[n], m).otherwise(F.array().cast("array<string>")) if n in when else m for n, m in found.items()}
    df = df.withColumns({f"__m_{n}": m for n, m in found.items()})
    spans = {}
    for n, p in patterns.items():
        m = F.col(f"__m_{n}")
        pairs = F.arrays_zip(m.alias("m"), F.slice(F.split(F.col(text), p, -1), 1, F.size(m)).alias("gap"))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.char_length(x["gap"])
            stop = start + F.char_length(x["m"])
            return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), stop.alias("stop"), x["m"].alias("text")))).alias("out"))

        spans[n] = F.when(F.size(m) > 0, F.aggregate(pairs, zero, step, lambda a: a["out"])).otherwise(F.array().cast(SPAN))
    return df.withColumns(spans).drop(*[f"__m_{n}" for n in patterns])


def tagged(spans: Column, kind: str, rank: int) -> Column:
    """(start, rank, stop, kind) structs: they sort by start, then by the order of the kinds."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))


TAGGED = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def joined(spans: Column) -> Column:
    """kind:start:end of each tagged span in order, joined by commas."""
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
