"""Session settings that the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, label: str | None = None) -> str:
    """The folder that all executors share, named by spark.checkpoint.dir, or a new one below it.

    Where it is unset, a session in one JVM, as in tests, gets a temporary folder; on a cluster this is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/") if label is None else f"{path.rstrip('/')}/gridloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: later jobs read the files and not its lineage."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_checkpoints(spark: SparkSession) -> None:
    """Let checkpoint() write to the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
