"""Registration of named queries with their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.plans.views import duck

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; sql may name the views of gridloom.plans.views."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = duck(sql)
        return f

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame) -> DataFrame:
    """df with doubles rounded to six digits and integers as bigint."""
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])
