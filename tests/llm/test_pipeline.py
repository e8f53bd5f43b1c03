from __future__ import annotations

from collections import Counter
from itertools import combinations

import corpus_pipeline
from gridloom.llm.queries import LLM_QUERIES, LLM_SQL

from .cases import docs as cases
from .cases import rows
from .test_near_duplicates import closure, slow_fingerprint


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name in ("toxicity", "line_dedup", "simhash_near_dedup"):
            assert 0.5 * n < docs.count() <= n
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def test_queries_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_SQL) <= set(LLM_QUERIES)


def test_stages_take_all_cases(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, extra columns with clashing names, and an empty table."""
    spark.createDataFrame([(r[0], 1, int(i % 3 == 0)) for i, r in enumerate(rows())], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        d = cases(spark)
        out = stage(spark, d, str(tmp_path))
        got = out.collect()
        if name == "best_fit_packing":
            pieces = Counter()
            for r in got:
                pieces[r["sequence_id"]] += r["length"]
            assert max(pieces.values()) <= 1024 and sum(r["piece"] == 0 for r in got) == d.count()
        else:
            assert out.columns == d.columns and 0 < len(got)
            ids = {r["doc_id"] for r in got}
            assert ids <= {r[0] for r in rows()}
        assert stage(spark, cases(spark, []), str(tmp_path)).count() == 0


def test_near_duplicate_stage_keeps_one_of_each_class(spark):
    out = corpus_pipeline.drop_near_duplicates(spark, cases(spark), "").collect()
    every = list(dict.fromkeys((r[0], r[1]) for r in rows()))
    prints = [slow_fingerprint(t) for _, t in every]
    links = [(i, j) for i, j in combinations(range(len(every)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    least = closure(range(len(every)), links)
    assert len(out) == len({least[i] for i in range(len(every))})
    at = {e: i for i, e in enumerate(every)}
    assert len({least[at[r["doc_id"], r["text"]]] for r in out}) == len(out)


def test_line_stage_follows_the_text(spark):
    """Lines that repeat stay once, documents that lose all they had go, and n_chars is that of the text."""
    line = "a line of quite some words that is long enough to count as one"
    data = [(1, f"first\n{line}", "en", "a", 99), (2, f"{line}\nsecond own line", "en", "a", 99), (3, line, "en", "a", 99), (4, None, None, None, None)]
    d = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_lines(spark, d, "").collect()}
    assert got[1] == (f"first\n{line}", 99) and got[2] == ("second own line", 15) and 3 not in got and 4 in got
