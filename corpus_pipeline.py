"""A corpus pipeline of five stages: toxicity, line deduplication, near-duplicates, source mixing, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents. run() applies them to
the documents table. SQL expresses none of the first three stages as a whole, so ORACLE_SQL is None; the stages are
tested on all cases, the near-duplicate and line stages against brute force.

Cases, in every stage: a null text counts as empty, empty texts are clean and stay (equal ones as one near-duplicate class),
very long texts are read whole, a null in any other column is a value, repeated rows are rows of their own until the
near-duplicate stage keeps one of them, extra columns of any name are passed on, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import line_dedup, mixing, packing, simhash, toxicity
from gridloom.llm.common import cut, small_side


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity cut of their language stay. Only the rejected rows' keys come back from scoring."""
    model, cuts = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    bad = toxicity.rejected_rows(docs, model, cuts)
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (key == F.col("__hash")) & F.col("lang").eqNullSafe(F.col("__lang"))
    return docs.join(small_side(bad), same, "left_anti")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Duplicate lines go; a document that loses every line it had goes too. n_chars follows the text."""
    d = line_dedup.dedup_lines(docs)
    d = d.filter((F.col("n_dropped") == 0) | F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return d.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
