"""Helpers that the operators of this subpackage share: scratch tables, Arrow batches, components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.session import shared_folder


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, named by spark.checkpoint.dir.

    Where it is unset, a session in one JVM, as in tests, gets a temporary folder; on a cluster this is an error.
    """
    return shared_folder(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/gridloom/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs start from the files, not from its lineage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame) -> list:
    """(file system, path) of the folders that hold the files of a cut() table."""
    spark = df.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}]
    return [(p.getFileSystem(spark._jsc.hadoopConfiguration()), p) for p in paths]


def drop_cut(*tables: DataFrame) -> None:
    """Delete the files of cut() tables that nothing will read again."""
    for df in tables:
        for files, path in _folders(df):
            files.delete(path, True)


def file_parts(df: DataFrame, most: int) -> list[DataFrame]:
    """df, a cut() table, as at most that many tables of some of its files each."""
    files = sorted(df.inputFiles())
    return [df.sparkSession.read.schema(df.schema).parquet(*files[i::most]) for i in range(min(most, len(files)))] or [df]


def drop_files(df: DataFrame) -> None:
    """Delete the files of one of the file_parts() that nothing will read again."""
    spark = df.sparkSession
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, df.inputFiles()):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does once both sides have dropped their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_side(df: DataFrame, most_bytes: int = 12 << 20) -> DataFrame:
    """df, a cut() table, to be broadcast if its files hold at most most_bytes, else to be joined by shuffling.

    Beyond the bound both sides of the join are shuffled tables, so adaptive execution can split a key with many rows.
    """
    return F.broadcast(df) if sum(files.getContentSummary(path).getLength() for files, path in _folders(df)) <= most_bytes else df


def text_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds; the default of 10,000 rows is too much for long documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table, by min-label propagation with pointer jumping.

    edges: two columns of one orderable type; self edges and repeats are allowed. Returns (node, component) for
    every node of an edge; component is the smallest node reachable. Every round joins the labels to the edges,
    takes minima per node (combined before the shuffle, so a hub is one partial row per task) and then replaces
    each label by its label's label. The label table is written to the shared folder each round; a round's own labels
    are one table for both joins, sent to all tasks while it is small, else shuffled as a table of its own, which lets
    adaptive execution split a component with many nodes.
    """
    a, b = (F.col(c) for c in edges.columns)
    both = edges.select(a.alias("u"), b.alias("v")).filter("u is not null and v is not null and u <> v")
    both = cut(both.union(both.select("v", "u")).distinct(), "edges")
    labels = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l"), F.lit(True).alias("moved")), "labels")
    old: list[DataFrame] = []
    for _ in range(max_rounds):
        if not labels.filter("moved").limit(1).count():
            break
        sent = small_side(labels.select("u", "l"))
        near = both.join(sent.withColumnsRenamed({"u": "v", "l": "near"}), "v").groupBy("u").agg(F.min("near").alias("near"))
        low = labels.join(near, "u").select("u", "l", F.least("l", "near").alias("m"))
        new = low.join(sent.withColumnsRenamed({"u": "m", "l": "mm"}), "m").select("u", F.least("m", "mm").alias("l"), (F.least("m", "mm") < F.col("l")).alias("moved"))
        old, labels = [labels], cut(new, "labels")
        drop_cut(*old)
    else:
        raise RuntimeError("components did not converge")
    drop_cut(both)
    return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))
