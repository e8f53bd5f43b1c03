"""Every query with DuckDB text gives DuckDB's rows."""

from __future__ import annotations

from pathlib import Path

import pytest

from gridloom.plans.catalogue import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    return None if v is None or v != v else float(f"{float(v):.6g}") if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a = sorted((tuple(plain(r[c]) for c in names) for r in got.collect()), key=key)
    b = sorted((tuple(plain(v) for v in r) for r in want.fetchall()), key=key)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
